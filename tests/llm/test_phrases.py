"""Phrase mining against brute force, and automata against counters."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from rategauge.llm import phrases
from rategauge.llm.automata import Automaton, ranked
from tests.llm.conftest import EDGES


def counts(docs, longest):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(upper, upper.lower()))):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                found.update((lang or "und", *w[i : i + k]) for i in range(len(w) - k + 1))
    return found


def brute(docs, longest, least, percent, top):
    found = counts(docs, longest)
    total = Counter()
    for g, n in found.items():
        total[g[0]] += n * (len(g) == 2)
    common = {g: n for g, n in found.items() if n >= least and len(g) > 2}
    out = []
    for g, a in common.items():
        inside = (h for h, n in common.items() if len(h) > len(g) and h[0] == g[0] and 100 * n >= percent * a)
        if any(h[i : i + len(g) - 1] == g[1:] for h in inside for i in range(1, len(h) - len(g) + 2)):
            continue
        cuts = []
        for k in range(2, len(g)):
            l, r = found[g[:k]], found[(g[0], *g[k:])]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((g[0], -score, -a, " ".join(g[1:]), l, r))
    rows, last, rank = [], None, 0
    for lang, score, a, phrase, l, r in sorted(out, key=lambda x: (x[0], x[1], x[2], x[3].encode())):
        rank = rank + 1 if lang == last else 1
        last = lang
        if rank <= top:
            rows.append((lang, rank, phrase, -a, l, r, total[lang], -score))
    return rows


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda x: x[:2])


@pytest.mark.parametrize("longest, ranges", [(3, 1), (3, 9), (4, 12)])
def test_edges(spark, edges, clashing, nothing, monkeypatch, longest, ranges):
    if ranges > 1:
        monkeypatch.setattr(phrases, "RANGE_BYTES", 60_000 // ranges)
        monkeypatch.setattr(phrases, "RANGE_GRAMS", 40)
    want = brute([(r[1], r[2]) for r in EDGES], longest, 2, 50, 100)
    assert len(want) > 5
    options = dict(longest=longest, least=2, top=100)
    assert got(phrases.collocations(edges, **options)) == want
    assert got(phrases.collocations(clashing, **options)) == want
    assert phrases.collocations(nothing, **options).count() == 0


def test_ties_hot_words_and_unknown_langs(spark, monkeypatch):
    """One word begins and ends most phrases; its ranges need counts of other ranges."""
    monkeypatch.setattr(phrases, "RANGE_BYTES", 8_000)
    monkeypatch.setattr(phrases, "RANGE_GRAMS", 20)
    docs = [(f"the w{i} the, The w{i}! the\tthe\nw{i}  the w{i % 5}", "en" if i % 3 else None) for i in range(200)]
    docs = docs + docs + [("é \U0001F600 the É", "fr"), (None, "fr"), ("", None), ("x" * 100_000, "fr")] * 3
    frame = spark.createDataFrame(docs, "text string, lang string").repartition(4)
    for top in (7, 1000):
        assert got(phrases.collocations(frame, least=2, top=top)) == brute(docs, 3, 2, 50, top)


words = st.sampled_from(["a", "b", "ab", "é", "\U0001F600", "z"])
shards = st.lists(st.lists(st.lists(words, min_size=1, max_size=3), max_size=30), min_size=1, max_size=3)


@settings(max_examples=150, deadline=None)
@given(shards, st.lists(st.lists(words, min_size=1, max_size=3).map(tuple), max_size=4))
def test_slices_and_union(found, cuts):
    """Every prefix is in one range, with its count and those of its own prefixes."""
    cuts = sorted(set(cuts))
    parts = [[] for _ in range(len(cuts) + 1)]
    want = Counter(tuple(s[:k]) for shard in found for s in shard for k in range(1, len(s) + 1))
    for shard in found:
        flat = pa.array([w for s in shard for w in s], pa.large_string())
        symbols, place = ranked(flat)
        ends = np.cumsum([len(s) for s in shard], dtype=int)
        rows = [place[e - len(s) : e].tolist() + [-1] * (3 - len(s)) for s, e in zip(shard, ends)]
        places = [np.array([r[d] for r in rows], np.int64) for d in range(3)]
        for part, blob in zip(parts, Automaton.build(symbols, places, 3).slices(cuts)):
            if blob:
                part.append(Automaton.unpacked(blob))
    seen = {}
    for k, part in enumerate(parts):
        cut = cuts[k - 1] if k else ()
        if part:
            for level in Automaton.union(part).frequent(1, cut):
                for sequence, weight, path in level:
                    assert sequence not in seen and sequence >= cut and (k == len(cuts) or sequence < cuts[k])
                    assert path == tuple(want[sequence[:d]] for d in range(1, len(sequence))) or len(sequence) == 1
                    seen[sequence] = weight
    assert seen == want
