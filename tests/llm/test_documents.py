"""Operators on documents against brute force, on texts of every awkward kind."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rategauge.llm import minhash, mixing, pieces, pii, quality, repeats, suffix_levels, suffix_trees, syncmers
from rategauge.llm.queries import PIECE_MODEL
from rategauge.plans.scratch import stored
from tests.helpers import python_free
from tests.llm.conftest import EDGES, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MODEL = PIECE_MODEL


def all_rows(df, key="doc_id"):
    return sorted((tuple(r) for r in df.collect()), key=repr)


OPERATORS = {
    "minhash": lambda d: minhash.near_duplicates(d, words=2),
    "levels": suffix_levels.deduplicated,
    "trees": suffix_trees.deduplicated,
    "pieces": lambda d: pieces.encoded(d, MODEL),
    "pii": lambda d: pii.found(d, DETECTOR),
    "mixing": mixing.mixture,
    "syncmers": syncmers.fingerprints,
    "quality": lambda d: quality.ledger(d).select("doc_id", *quality.MEASURES, quality.FAILURES),
}
DETECTOR = pii.fit([])


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_and_clashing_columns(edges, clashing, nothing, name):
    run = OPERATORS[name]
    plain, odd = run(edges), run(clashing)
    assert plain.columns == odd.columns
    assert plain.count() == len(EDGES)
    assert all_rows(plain) == all_rows(odd)
    assert run(nothing).count() == 0


def shingles(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    w = WORD.findall((text or "").translate(str.maketrans(upper, upper.lower())))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(map(lambda x: (x,), w))


def brute_components(docs, percent=80):
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets}


def test_minhash(edges):
    want = brute_components([(r[0], r[1]) for r in EDGES])
    for doc_id, n, component, kept in minhash.near_duplicates(edges, words=2).collect():
        if doc_id is None:
            assert component is None and kept
        else:
            assert (n, component, kept) == (*want[doc_id], want[doc_id][1] == doc_id)


def test_minhash_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = brute_components([tuple(r) for r in docs.collect()])
    got = {r[0]: (r[1], r[2]) for r in minhash.near_duplicates(docs, words=2).collect()}
    assert got == want


def test_chains_and_outsiders_of_a_bucket(spark, monkeypatch):
    """Near-copies that drift away from the first one: links across a bucket's components."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "CHUNK", 8)
    words = [f"w{i}" for i in range(100)]
    docs = []
    for step in range(60):
        words[(step * 3) % 100 : (step * 3) % 100 + 2] = [f"n{step}a", f"n{step}b"]
        if step % 7 != 6:
            docs.append((step, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in minhash.near_duplicates(frame, words=2).collect()}
    assert got == brute_components(docs)


def brute_removed(rows, tokens, width):
    seqs = [tokens(t or "") for _, t in rows]
    count = Counter(s[i : i + width] for s in seqs for i in range(len(s) - width + 1))
    out = []
    for s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - width + 1):
            if count[s[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        out.append((s, gone))
    return out


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_levels(spark, edges, batches):
    got = Counter(map(tuple, suffix_levels.deduplicated(edges, batches).collect()))
    want = Counter()
    for (doc_id, _), (s, gone) in zip(((r[0], r[1]) for r in EDGES), brute_removed([(r[0], r[1]) for r in EDGES], str.encode, 400)):
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(b for b, g in zip(s, gone) if not g)
        want[doc_id, len(s), sum(gone), spans, hashlib.sha256(left).hexdigest()] += 1
    assert got == want


def test_level_ranks_and_matches(edges):
    source = repeats.keyed(edges, "doc_id", "text")
    rows = stored(repeats.segment_table(source, suffix_levels.BYTES), "segments")
    family = suffix_levels.Family()
    for n in range(1, 6):
        family.add(rows)
        assert sorted(family.levels) == [k for k in range(3) if n >> k & 1]
    anchors = rows.select("h").distinct().count()
    assert [m.count() == anchors for m in family.matched] == [False, True, True, True, True]
    assert family.groups().agg(F.sum("n")).first()[0] == 5 * rows.count()


def test_only_what_a_scan_matched_is_compared(edges, monkeypatch):
    """Without the scans nothing is found."""
    whole = suffix_levels.deduplicated(edges).agg(F.sum("n_removed")).first()[0]
    monkeypatch.setattr(suffix_levels.Family, "matches", lambda self, array: array.select("h").where("false"))
    assert whole > 0 == suffix_levels.deduplicated(edges).agg(F.sum("n_removed")).first()[0]


def test_only_deep_nodes_of_a_group_are_removed(spark, monkeypatch):
    """Windows shared by different contexts: found by the comparison in groups, or by longer prefixes."""
    docs = [(k, prose(50 + k, 40) + " " + prose(7, 60) + " " + prose(90 + k, 30)) for k in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = Counter()
    for (doc_id, _), (s, gone) in zip(docs, brute_removed(docs, lambda t: tuple(WORD.findall(t)), 35)):
        want[doc_id, len(s), sum(gone)] += 1
    got = lambda: Counter((r.doc_id, r.n_words, r.n_removed) for r in suffix_trees.deduplicated(frame).collect())
    assert got() == want and all(60 <= k[2] < 70 for k in want)
    with monkeypatch.context() as patch:
        patch.setattr(repeats, "GROUP", 2)
        assert got() == want
    monkeypatch.setattr(repeats, "_compared", lambda laid, tokens: laid.selectExpr("id", "th", "s AS first", "s AS last").where("false"))
    assert sum(k[2] for k in got()) < sum(k[2] for k in want)


def test_windows_of_one_hash_are_told_apart():
    import numpy as np

    values = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], np.uint8)
    starts = np.array([0, 3, 6, 1])
    one = np.zeros(9, np.uint64)
    assert repeats.repeated(values, one, starts, 3).tolist() == [True, False, True, False]
    assert repeats.repeated(values, np.arange(9, dtype=np.uint64), starts, 3).tolist() == [False] * 4


class Direct:
    """Stands for a table; what would run in a task is handed back."""

    def mapInArrow(self, run, schema):
        return run


def segment_rows(texts, tokens):
    import pyarrow as pa

    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.record_batch([ids, ids, pa.array(texts, pa.string())], names=["id", "th", "text"])
    return [tuple(r.values()) for out in repeats.segment_table(Direct(), tokens)(iter([batch])) for r in out.to_pylist()]


@pytest.mark.parametrize("tokens", [suffix_levels.BYTES, suffix_trees.WORDS], ids=["bytes", "words"])
def test_memory_does_not_grow_with_a_text(tokens):
    """A text longer than a piece is taken alone, but hashed in parts."""
    import tracemalloc

    import pyarrow as pa

    text = " ".join(map(str, range(600_000)))
    batch = pa.record_batch([pa.array([1]), pa.array([1]), pa.array([text])], names=["id", "th", "text"])
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in repeats.segment_table(Direct(), tokens)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > 1000 and peak < 16 * len(text)


@pytest.mark.parametrize("tokens", [suffix_levels.BYTES, suffix_trees.WORDS], ids=["bytes", "words"])
def test_segments_do_not_depend_on_where_parts_end(tokens, monkeypatch):
    texts = [r[1] for r in EDGES] + ["a" * 900, prose(5, 900), prose(5, 300) + "  " + prose(6, 400), None, "\u00e9 " * 500]
    whole = segment_rows(texts, tokens)
    for chunk in (tokens.width, tokens.width + 1, 999):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        monkeypatch.setattr(repeats, "PIECE", chunk)
        assert segment_rows(texts, tokens) == whole and len(whole) > 20


def test_trees(edges):
    docs = [(r[0], r[1]) for r in EDGES]
    got = Counter((r[0], r[1], r[2], r[4]) for r in suffix_trees.deduplicated(edges).collect())
    want = Counter()
    for (doc_id, _), (s, gone) in zip(docs, brute_removed(docs, lambda t: tuple(WORD.findall(t)), 35)):
        left = " ".join(w for w, g in zip(s, gone) if not g)
        want[doc_id, len(s), sum(gone), hashlib.sha256(left.encode()).hexdigest()] += 1
    assert got == want


def test_pieces_round_trip(edges):
    rows = pieces.encoded(edges, MODEL)
    assert all(r.round_trip for r in rows.collect())
    back = Counter(map(tuple, pieces.decoded(rows, MODEL).collect()))
    assert back == Counter((r[0], r[1] or "") for r in EDGES)


@pytest.mark.parametrize("text", [" a  b ", "a" * 300, "日本語テキスト" * 30, "\x00\n\t", " " * 40, "=" * 70 + "Hello, world"])
def test_pieces_are_the_best_cut(text):
    v = pieces.Codec(MODEL).vocabulary
    text = " " + text
    best, back = [0.0], [(0, [])]
    for end in range(1, len(text) + 1):
        raw = text[end - 1].encode()
        top, step = best[end - 1] + pieces.BYTE_SCORE * len(raw), (end - 1, [v.byte[b] for b in raw])
        for start in range(end - 1, max(-1, end - 1 - v.longest), -1):
            found = v.score.get(text[start:end])
            if found and best[start] + found[0] >= top:
                top, step = best[start] + found[0], (start, [found[1]])
        best.append(top)
        back.append(step)
    ids, at = [], len(text)
    while at:
        at, step = back[at]
        ids = step + ids
    assert [i for part in pieces.viterbi(text, v) for i in part] == ids


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in FORMATS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and pii.luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans():
    import random

    r = random.Random(3)
    made = ["".join(r.choice("a1.@+-% 0()9") for _ in range(r.randint(0, 60))) for _ in range(4000)]
    for text in made + [row[1] or "" for row in EDGES]:
        assert pii.base_spans(text) == brute_spans(text)
    assert [k for k, *_ in pii.base_spans(EDGES[-1][1])] == ["email", "ip", "card", "phone"]


def test_counts_and_places_of_spans(edges):
    for r in pii.found(edges, DETECTOR).collect():
        assert r.n_spans == len(r.spans.split(",")) * bool(r.spans)
        assert r.n_spans >= r.n_email + r.n_ip + r.n_card + r.n_phone
    one = edges.where("doc_id = 12").select("doc_id", "text")
    base = brute_spans(one.first().text)
    shown = [f"{s[0]}:{s[1]}:{s[2]}" for s in base]
    got = pii.found(one, DETECTOR).first()
    assert (got.n_email, got.n_ip, got.n_card, got.n_phone, got.n_spans) == (1, 1, 1, 1, 4)
    assert got.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest() and got.spans.split(",") == shown


def test_added_spans_hold_out():
    examples = pii.made_examples(120, seed=99)
    right = wrong = missed = 0
    for text, span, label in examples:
        chosen = span.span in DETECTOR.added(text, [])
        right += chosen and label
        wrong += chosen and not label
        missed += label and not chosen
    assert right > 150 and wrong <= 0.05 * right
    assert DETECTOR.added("A long uninterruptedsentencewithoutanysecret, on 2024-01-02 at the. End", []) == []


def test_redaction(edges):
    out = {r.doc_id: r.text for r in pii.redacted(edges, DETECTOR).collect()}
    assert out[12] == "mail [EMAIL] now, ip [IP], card [CARD], call [PHONE]"
    assert out[4] is None and out[9] == EDGES[9][1]
    assert pii.redacted(edges, DETECTOR).columns == edges.columns


def test_mixing(edges):
    rows = mixing.mixture(edges).collect()
    assert rows and all(r.taken <= 3 * r.size for r in rows)
    total = sum(r.size for r in rows)
    targets = {}
    for r in rows:
        targets[r.source_size] = r.target
        assert r.target <= 3 * r.source_size + 1e-9
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    copies = Counter(r[0] for r in mixing.mixed(edges).select("doc_id").collect())
    taken = {r.doc_id: r.taken for r in rows if r.size and r.doc_id not in (None, 2)}
    assert all(copies[d] * next(r.size for r in rows if r.doc_id == d) == t for d, t in taken.items())
    assert mixing.mixed(edges).columns == edges.columns


def test_mixing_is_near_its_targets(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('w ', int(1 + id % 7)) AS text", "concat('s', id % 4) AS source"
    )
    rows = mixing.mixture(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target) <= 7 for r in rows)


def test_native_operators_use_no_python(edges):
    assert python_free(quality.ledger(edges)) and python_free(mixing.mixture(edges))


def test_ablations(edges):
    entries = quality.ledger(edges)
    rows = {r.rule: r for r in quality.ablations(entries, quality.STANDARD).collect()}
    masks = [r[0] for r in entries.select("failures").collect()]
    for rule, _ in quality.RULES:
        b = quality.bit(rule)
        assert (rows[rule].failed, rows[rule].failed_alone) == (
            sum(m & b != 0 for m in masks), sum(m == b for m in masks))


def test_syncmers(edges):
    docs = edges.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    texts = {r[0]: r[1] or "" for r in EDGES if r[0] is not None}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        after = texts[order[(k + 1) % len(order)]]
        half = len(texts[i]) // 2
        changed = texts[i][: len(texts[i]) - half] + after[:half]
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[i].n_chars == len(texts[i]) and 0 <= got[i].near_edited <= 1
    assert got[1].fingerprint == got[2].fingerprint
    assert got[9].near_edited > 0.1 > got[9].near_next


def test_closed_syncmers_by_definition():
    text = EDGES[0][1]
    h, at = syncmers.closed_syncmers(text)
    k, s = syncmers.K, syncmers.S
    value = {p: syncmers._hashes(__import__("numpy").frombuffer(text[p : p + s].encode("utf-32-le"), "uint32"), s)[0] for p in range(len(text) - s + 1)}
    want = [p for p in range(len(text) - k + 1)
            if min(value[q] for q in range(p, p + k - s + 1)) in (value[p], value[p + k - s])]
    assert at.tolist() == want and len(h) == len(want)


@pytest.mark.parametrize(
    "text, want",
    [
        ("12 4111 1111 1111 1111", [("card", "4111 1111 1111 1111")]),
        ("2024-05-01 4111 1111 1111 1111", [("card", "4111 1111 1111 1111")]),
        ("visa: 4111 1111 1111 1111 12/27 cvv 123", [("card", "4111 1111 1111 1111")]),
        ("call 555-123-4567 2024-05-01 10:00", [("phone", "555-123-4567")]),
        ("key: " + "aB3x" * 61, [("secret", "aB3x" * 61)]),
        ("On 2024-01-02 we sold 1,200 units for 12.50 and 300 400 500", []),
        ("isbn 978-3-16-148410-0 page 12", []),
    ],
)
def test_numbers_next_to_others_and_whole_secrets(text, want):
    assert [(k, text[s:e]) for k, s, e in DETECTOR.added(text, pii.base_spans(text))] == want


def test_candidates_are_all_parts_of_whole_groups():
    found = {(c.kind, "12 345-6789 (0123) 4567890"[c.start : c.end]) for c in pii.candidates("12 345-6789 (0123) 4567890")}
    assert ("phone", "345-6789") in found and ("phone", "(0123) 4567890") in found and ("card", "12 345-6789 (0123") in found
    assert ("phone", "4567890") in found and ("card", "345-6789 (0123) 4567890") in found
    assert not any(t.startswith(("2", "5", "7")) for _, t in found)


def test_added_spans_of_long_texts_in_linear_time():
    import time

    numbers = " ".join(str(7919 * k % 1_000_003) for k in range(60_000))
    took = []
    for text in (numbers[: len(numbers) // 4], numbers):
        start = time.process_time()
        out = DETECTOR.added(text, pii.base_spans(text))
        took.append(time.process_time() - start)
        ends = sorted((s, e) for _, s, e in out)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert took[1] < 12 * took[0] + 1


def test_round_trips_are_told_from_others():
    import pyarrow as pa
    from array import array

    codec = pieces.shared_codec(MODEL)
    texts = [r[1] or "" for r in EDGES] + ["\x00", " ", "a" * 3000]
    ids = [list(array("i", codec.encode(t))) for t in texts]
    lists = pa.array(ids, pa.list_(pa.int32()))
    assert codec.restores(lists, texts) == [True] * len(texts) == [codec.decode(i) == t for i, t in zip(ids, texts)]
    assert codec.restores(lists, [t + "x" for t in texts]) == [False] * len(texts)
    assert codec.restores(lists.slice(3, 4), texts[3:7]) == [True] * 4
    assert codec.restores(lists.slice(0, 0), []) == []


def test_frequent_segments_are_searched_once(monkeypatch):
    from array import array

    searched = []
    for search in ("viterbi", "short_viterbi"):
        real = getattr(pieces, search, None)
        monkeypatch.setattr(pieces, search, lambda t, v, real=real: searched.append(t) or real(t, v), raising=False)
    monkeypatch.setattr(pieces, "CACHE_SEGMENTS", 20)
    codec = pieces.Codec(MODEL)
    text = " ".join(f"often {k}" for k in range(200))
    ids = codec.encode(text)
    assert searched.count(" often") <= 2  # once for each generation at most; a cleared table searched it again
    assert len(codec.cache) <= 20 and codec.decode(array("i", ids)) == text


@pytest.mark.parametrize("text", [" ", " a", "  a", "日本", "\x00\n", " " * 20, "=" * 32, " Hello,wörld", " \U0001f600x"])
def test_short_segments_are_cut_like_long_ones(text):
    v = pieces.Codec(MODEL).vocabulary
    assert pieces.short_viterbi(text, v) == [i for part in pieces.viterbi(text, v) for i in part]
