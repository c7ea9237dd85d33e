"""Fingerprints: likeness of edited texts, chains against brute force, every row's successor."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, strategies as st

from rategauge.llm import syncmers
from tests.llm.conftest import EDGES, SCHEMA, prose


def text_of(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n)]


def like(a, b):
    return syncmers.likeness(syncmers.fingerprint(" ".join(a)), syncmers.fingerprint(" ".join(b)))


@pytest.mark.parametrize("n, least", [(200, 0.75), (2000, 0.9), (20_000, 0.95)])
def test_inserts_cuts_and_moves(n, least):
    w = text_of(n)
    assert like(w, w) == 1.0
    assert like(w, w[: n // 2] + text_of(10, 9) + w[n // 2 :]) >= least
    assert like(w, w[: n // 3] + w[n // 3 + 10 :]) >= least
    assert like(w, text_of(n, 7)) == 0.0
    halves = like(w, w[n // 2 :] + w[: n // 2])  # another order: only one half is in a chain
    assert 0.2 < halves < 0.6
    assert like(w, w[: n // 2] + text_of(n // 2, 8)) == pytest.approx(1 / 3, abs=0.15)


def test_many_small_edits():
    w, r = text_of(20_000), random.Random(3)
    changed = [x if r.random() > 0.02 else x + "q" for x in w]
    assert like(w, changed) > 0.75


def test_repeated_anchors_count_by_place():
    line = text_of(40, 4)
    assert like(line * 30, line * 30) == 1.0
    assert like(line * 30, line * 15) == pytest.approx(0.5, abs=0.1)


def test_anchors_grow_with_the_text():
    sizes = [len(syncmers.fingerprint(" ".join(text_of(n))).hashes) for n in (20, 2000, 20_000, 200_000)]
    assert sizes[0] >= 10 and sizes[3] > 8 * sizes[2] > 60 * sizes[1] / 2


@given(st.permutations(range(9)), st.permutations(range(12)))
def test_chain_is_the_longest_common_subsequence(a, b):
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    assert syncmers.chain(x, y) == best[-1][-1]


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_every_row_and_its_successor(spark, monkeypatch, parts):
    """Ranges of ids, of digests where ids are equal or null; rows that repeat."""
    docs = [(r[0], r[1]) for r in EDGES] + [(None, prose(k, 30)) for k in range(20)] + [(50, prose(k, 20 + k)) for k in range(30)]
    docs += [(k, prose(k, 5 + k % 40)) for k in range(100, 160)] + [(-(1 << 63), "low"), ((1 << 63) - 1, "high")]
    total = sum(len((t or "").encode()) for _, t in docs)
    monkeypatch.setattr(syncmers, "RANGE_BYTES", -(-total // parts))
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], SCHEMA).repartition(5)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    ordered = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), digest(d[1])))
    want = []
    for k, (i, t) in enumerate(ordered):
        t, u = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        new, mark = syncmers.edited(t, u), syncmers.fingerprint(t)
        changed = syncmers.fingerprint(new)
        near = syncmers.likeness(mark, changed), syncmers.likeness(mark, syncmers.fingerprint(u))
        want.append((i, len(t), digest(new), mark.shown(), changed.shown(), *near))
    assert sorted(map(tuple, syncmers.fingerprints(frame).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("n", [0, 1, 3, 60, 5000])
def test_no_anchor_is_left_out(n):
    text = " ".join(text_of(n))
    mark = syncmers.fingerprint(text)
    hashes, at = syncmers.closed_syncmers(text)
    assert mark.hashes.tolist() == hashes.tolist() and mark.places.tolist() == at.tolist()
    read = syncmers.read_fingerprint(mark.shown())
    assert read.hashes.tolist() == hashes.tolist() and read.places.tolist() == at.tolist()


def test_one_changed_word_in_a_long_text_is_seen():
    """Each anchor counts: a share of them could miss the change and call the texts alike."""
    w = text_of(3000)
    for k in range(0, 3000, 100):
        assert like(w, [*w[:k], "qqqqqqqq", *w[k + 1 :]]) < 1.0
