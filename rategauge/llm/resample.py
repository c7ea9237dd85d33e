"""Importance resampling of documents towards a target's distribution of n-gram features.

A feature is a run of 1 to ``longest`` consecutive words of the lower-cased (A-Z) text, joined by one
space; its bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``. A document's weight is the sum
of its features' gains, the scaled logarithm of how much likelier a bucket is in the target than in
the documents; with a Gumbel variate of its id added, the highest scores are a draw without replacement.

Head and tail. Words and pairs that all documents use most get their CRC state and bucket once, in a
table that goes to every task (``HEAD_WORDS`` and ``HEAD_PAIRS`` entries of at most ``HEAD_BYTES`` bytes).
A feature that is not in it takes its CRC directly, a longer one from the state of the run before its
last word. Both give the same number, so the table changes the work and no result, and bucket totals
are exact.

Scale. Texts are read twice, for the head and for the buckets, which are stored. Totals are one
histogram per task, added up; only the head and one gain per bucket reach the driver. Ranks come from a
sort by ranges and the rows in the ranges before, never from one task.

Defined results: null and empty texts have no features and weight 0; rows that repeat count as often
as they occur and get ranks of their own; a null id is the empty text in the draw and last among ties;
an empty table gives an empty result, an empty target has no features; columns other than id and text
play no part.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rategauge.llm.arrays import ascii_lower, pieces, runs, strings, utf8
from rategauge.llm.text import whole
from rategauge.plans.scratch import stored

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 20_000, 20_000, 64
#: Distinct words (or pairs) that a task counts before it gives them out.
HELD = 1 << 18
#: Steps of a power of two in which counts are told apart.
STEPS = 8

#: Bytes of words: digits, lower-case letters and all that is not ASCII (fixed by contract).
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Head:
    """CRC state after a frequent word, and the CRC of a frequent pair."""

    words: dict[bytes, int] = field(default_factory=dict)
    pairs: dict[bytes, int] = field(default_factory=dict)


def _words(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the place of each word among them, and where each row's words start (n + 1)."""
    raw, at = utf8(column)
    raw = ascii_lower(raw)
    starts, ends = runs(_WORD[raw], at)
    coded = strings(raw, starts, ends).dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    return distinct, coded.indices.to_numpy().astype(np.int64), np.searchsorted(starts, at)


def _pairs(place: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``first * size + second`` of every pair of neighbours of one row, and where it starts."""
    inner = np.ones(max(len(place) - 1, 0), bool)
    edges = at[1:-1]
    inner[edges[(edges > 0) & (edges < len(place))] - 1] = False
    where = np.flatnonzero(inner)
    return place[where] * size + place[where + 1], where


def features(column: pa.Array, longest: int, head: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of every feature, the row of each, and the number of words of each row."""
    distinct, place, at = _words(column)
    states = np.array([head.words.get(w) if w in head.words else zlib.crc32(w) for w in distinct], np.uint32)
    n_words = np.diff(at)
    row = np.repeat(np.arange(len(n_words)), n_words)
    crc, rows = [states[place]] if len(place) else [np.zeros(0, np.uint32)], [row]
    run, run_states, start = place, states, np.arange(len(place))
    names: list[bytes] = distinct
    for k in range(2, longest + 1):
        start = start[start + k - 1 < at[row[start] + 1]] if len(start) else start
        if not len(start):
            break
        kept = run[np.searchsorted(previous, start)] if k > 2 else run[start]
        key, inverse = np.unique(kept * len(distinct) + place[start + k - 1], return_inverse=True)
        first, last = np.divmod(key, len(distinct))
        found = []
        now: list[bytes] = []
        for f, w in zip(first.tolist(), last.tolist()):
            name = b"%b %b" % (names[f], distinct[w]) if k == 2 else b""
            known = head.pairs.get(name) if k == 2 else None
            found.append(zlib.crc32(b" " + distinct[w], int(run_states[f])) if known is None else known)
            now.append(name)
        run, run_states, names, previous = inverse, np.array(found, np.uint32), now, start
        crc.append(run_states[inverse])
        rows.append(row[start])
    return np.concatenate(crc), np.concatenate(rows), n_words


def head_of(docs: DataFrame, pairs: bool, text: str = "text") -> Head:
    """The most frequent words and pairs of all documents, as many as fit and all of a count or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[tuple[bool, bytes], int] = {}

        def given() -> pa.RecordBatch:
            keys = list(count)
            columns = [pa.array([p for p, _ in keys], pa.bool_()), pa.array([w for _, w in keys], pa.binary()), pa.array(list(count.values()), pa.int64())]
            return pa.record_batch(columns, names=["pair", "feature", "n"])

        for batch in pieces(batches):
            distinct, place, at = _words(batch.column("text"))
            short = [len(w) <= HEAD_BYTES for w in distinct]
            for w, n, fits in zip(distinct, np.bincount(place, minlength=len(distinct)).tolist(), short):
                if fits:
                    count[False, w] = count.get((False, w), 0) + n
            if pairs and len(distinct):
                keys, n_pairs = np.unique(_pairs(place, at, len(distinct))[0], return_counts=True)
                first, last = np.divmod(keys, len(distinct))
                for f, w, n in zip(first.tolist(), last.tolist(), n_pairs.tolist()):
                    if short[f] and short[w]:
                        name = b"%b %b" % (distinct[f], distinct[w])
                        count[True, name] = count.get((True, name), 0) + n
            if len(count) >= HELD:
                yield given()
                count.clear()
        yield given()

    source = docs.select(whole(text).alias("text"))
    found = source.mapInArrow(run, "pair boolean, feature binary, n long").groupBy("pair", "feature").agg(F.sum("n").alias("n"))
    found = stored(found.withColumn("step", F.floor(F.log2("n") * STEPS)), "vocabulary")
    words = _most(found.where("NOT pair"), HEAD_WORDS)
    two = _most(found.where("pair"), HEAD_PAIRS) if pairs else []
    return Head({w: zlib.crc32(w) for w in words}, {w: zlib.crc32(w) for w in two})


def _most(found: DataFrame, limit: int) -> list[bytes]:
    """Features above the lowest count (to an eighth of a power of two) that at most ``limit`` pass."""
    steps = sorted(found.groupBy("step").count().collect(), reverse=True)
    passed = np.cumsum([n for _, n in steps])
    kept = int(np.searchsorted(passed, limit, side="right"))
    if not kept:
        return []
    return [bytes(r.feature) for r in found.where(F.col("step") >= steps[kept - 1].step).select("feature").collect()]


def bucketed(docs: DataFrame, longest: int, buckets: int, head: Head, id: str, text: str) -> DataFrame:
    """``(id, n_words, buckets)``: the bucket of every feature, packed."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            crc, row, n_words = features(batch.column("text"), longest, head)
            order = np.argsort(row, kind="stable")
            data = (crc[order] % np.uint32(buckets)).astype(kind).tobytes()
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]) * kind().itemsize
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
            yield pa.record_batch([batch.column("id"), pa.array(n_words, pa.int64()), packed.cast(pa.binary())], names=["id", "n_words", "buckets"])

    source = docs.select(F.col(id).cast("long").alias("id"), whole(text).alias("text"))
    return source.mapInArrow(run, "id long, n_words long, buckets binary")


def _places(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All packed buckets, and how many each row has."""
    kind = np.dtype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), kind), np.array([len(b) // kind.itemsize for b in blobs], np.int64)


def totals(table: DataFrame, buckets: int) -> np.ndarray:
    """Features of every bucket over all rows of :func:`bucketed`; one histogram per task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            places, _ = _places(batch.column("buckets"), buckets)
            sums += np.bincount(places, minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in table.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed odds, floored; in doubles."""
    size = len(source)
    s_all, t_all = float(source.sum()), float(target.sum())
    odds = (target + 1.0) * (s_all + size) / ((source + 1.0) * (t_all + size))
    return np.array([math.floor(1000 * math.log(x)) for x in odds.tolist()], np.int64)


def gumbel(id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate that depends on the id alone, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def ranks(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` from 1 in the given order, without a task that sees them all.

    Rows are sorted by ranges; a row's rank is its place in its range and the rows of those before, of
    which one count each reaches the driver. Rows equal in the order may part at a range's edge.
    """
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(*order, "salt").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    sizes = sorted(dealt.groupBy("part").count().collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = rows.sparkSession.createDataFrame([(part, n) for (part, _), n in zip(sizes, before)], "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order, "salt"))
    return (
        dealt.withColumn("place", place)
        .join(F.broadcast(offsets), "part")  # one row per partition of the sort
        .withColumn("rank", F.col("before") + F.col("place"))
        .drop("salt", "part", "place", "before")
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    percent: int = 10,
    least_words: int = 20,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every row; rows that are not drawn have no rank."""
    head = head_of(docs, longest > 1, text)
    table = stored(bucketed(docs, longest, buckets, head, id, text), "buckets")
    wanted = target.select(F.lit(None).cast("long").alias("id"), F.col(target_text).alias("text"))
    gain = gains(totals(table, buckets), totals(bucketed(wanted, longest, buckets, head, "id", "text"), buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, sizes = _places(batch.column("buckets"), buckets)
            upto = np.concatenate([[0], np.cumsum(gain[places])])
            ends = np.cumsum(sizes)
            weight = upto[ends] - upto[ends - sizes]
            noise = np.array([gumbel(v, seed) for v in batch.column("id").to_pylist()], np.int64)
            columns = [batch.column("id"), batch.column("n_words"), *map(pa.array, (sizes, weight, weight + noise))]
            yield pa.record_batch(columns, names=["id", "n_words", "n_features", "weight", "score"])

    scores = stored(table.mapInArrow(run, "id long, n_words long, n_features long, weight long, score long"), "scores")
    eligible = F.col("n_words") >= least_words
    draw = percent * scores.where(eligible).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features")]
    ranked = ranks(scores.where(eligible), order)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scores.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias(id), "n_features", "weight", "score", "rank")
