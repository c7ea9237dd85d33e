"""Nearest vectors by inner product: multi-index hashing of learned rotated binary codes.

Codes. Vectors get one more component that makes all of them as long as the longest, so the largest
inner product is the smallest angle. They are projected on their principal axes (at most 64) and
rotated so that signs lose as little as possible (iterative quantisation); several rotations from
different starts give ``BITS`` bits. The rotations are fitted on a sample of ``SAMPLE`` vectors.

Index. Vectors are dealt into blocks. In a block the code's ``SUBSTRINGS`` substrings are indexed each
in a table of its own. If two codes differ in at most ``SUBSTRINGS * (p + 1) - 1`` bits, some substring
differs in at most p bits; so probing all substrings within p bits of the query's finds every code
within that radius. p grows until the radius holds ``WANTED`` codes. Where the substrings to probe are
more than the block has codes, the codes are compared one by one instead, which finds the same. All
codes within the radius, ties included, are ranked by the inner product of the original vectors.

Scale. Vectors stay in their block; queries meet every block, in batches, and give at most k + 1
vectors from each. Equal vectors are one class, of which the smallest k + 1 ids are enough, so a vector
that a third of the rows repeat is one entry and one query. Pairs exist in a task's memory only.

Inner products are summed in double precision in the same way for every pair, so equal vectors tie.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor rows without an id or with another number of components than most have (of equally many, the
larger number); rows that repeat are rows of their own, and a query leaves out itself alone; ties go to
the smaller id; without queries or vectors the result is empty; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rategauge.plans.scratch import stored

BITS, SUBSTRINGS = 256, 16
#: Components that are rotated, and turns of the fit.
AXES, TURNS = 64, 30
#: Vectors that the rotations are fitted on.
SAMPLE = 20_000
#: Codes that a query takes from a block at least.
WANTED = 128
#: Vectors of a block: more than this are dealt into more blocks, fewer than the second never.
BLOCK, SMALL = 1 << 18, 1 << 11
#: Queries that probe at a time.
BATCH = 128

_MASKS = np.arange(1 << 16, dtype=np.uint32).astype(np.uint16)
_FLIPS = [_MASKS[np.bitwise_count(_MASKS) == p] for p in range(5)]


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, as stored."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


@dataclass(frozen=True)
class Coder:
    """Projections whose signs are the bits, and the length all vectors are brought to."""

    planes: np.ndarray
    length: float

    @classmethod
    def fitted(cls, sample: np.ndarray, length: float, seed: int = 5) -> Coder:
        wide = cls(np.zeros((0, 0)), length).lifted(sample.astype(np.float64))
        _, _, axes = np.linalg.svd(wide, full_matrices=False)
        axes = axes[:AXES].T
        low, rng, planes = wide @ axes, np.random.Generator(np.random.PCG64(seed)), []
        while sum(p.shape[1] for p in planes) < BITS:
            turn = np.linalg.qr(rng.standard_normal((low.shape[1], low.shape[1])))[0]
            for _ in range(TURNS):
                signs = np.where(low @ turn > 0, 1.0, -1.0)
                u, _, v = np.linalg.svd(low.T @ signs)
                turn = u @ v
            planes.append(axes @ turn)
        return cls(np.concatenate(planes, axis=1)[:, :BITS], length)

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.length**2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """``BITS`` bits a row, in bytes."""
        return np.packbits(self.lifted(x.astype(np.float64), query) @ self.planes > 0, axis=1)


class Block:
    """Tables of the substrings of some codes."""

    def __init__(self, codes: np.ndarray):
        codes = np.ascontiguousarray(codes)
        self.size = len(codes)
        self.long = codes.view(np.uint64)
        parts = codes.view(np.uint16)
        self.rows = [np.argsort(part, kind="stable") for part in parts.T]
        keys = np.arange((1 << 16) + 1)
        self.starts = [np.searchsorted(part[rows], keys) for part, rows in zip(parts.T, self.rows)]

    def within(self, query: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query, row)`` of codes with a substring that differs in exactly ``p`` bits."""
        queries, rows = [], []
        parts = query.view(np.uint16)
        for table, starts, part in zip(self.rows, self.starts, parts.T):
            keys = (part[:, None] ^ _FLIPS[p][None, :]).astype(np.int64)
            first, count = starts[keys], starts[keys + 1] - starts[keys]
            who = np.repeat(np.arange(len(query)), count.sum(axis=1))
            first, count = first.ravel(), count.ravel()
            step = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            queries.append(who)
            rows.append(table[np.repeat(first, count) + step])
        return np.concatenate(queries), np.concatenate(rows)

    def find(self, query: np.ndarray, wanted: int) -> list[np.ndarray]:
        """For each query's code, the rows of all codes within the smallest radius that holds ``wanted``."""
        query = np.ascontiguousarray(query)
        long, out = query.view(np.uint64), [np.arange(self.size)] * len(query)
        if self.size <= wanted:
            return out
        open_, pairs, probes = np.arange(len(query)), np.zeros(0, np.int64), 0
        for p, flips in enumerate(_FLIPS):
            probes += SUBSTRINGS * len(flips) * (1 + self.size / (1 << 16))
            if probes > self.size or not len(open_):
                break
            who, rows = self.within(query[open_], p)
            pairs = np.unique(np.concatenate([pairs[np.isin(pairs // self.size, open_)], open_[who] * self.size + rows]))
            who, rows = np.divmod(pairs, self.size)
            far = np.bitwise_count(long[who] ^ self.long[rows]).sum(axis=1, dtype=np.int64)
            sure = SUBSTRINGS * (p + 1) - 1
            edges = np.searchsorted(who, np.stack([open_, open_ + 1]))
            left = []
            for q, a, b in zip(open_.tolist(), *edges.tolist()):
                near = far[a:b]
                if np.count_nonzero(near <= sure) >= wanted:
                    out[q] = rows[a:b][near <= np.partition(near, wanted - 1)[wanted - 1]]
                else:
                    left.append(q)
            open_ = np.array(left, np.int64)
        for q in open_.tolist():
            far = np.bitwise_count(self.long ^ long[q]).sum(axis=1, dtype=np.int64)
            out[q] = np.flatnonzero(far <= np.partition(far, wanted - 1)[wanted - 1])
        return out


def _usable(vector: str) -> Column:
    """Not null, no null or non-finite component, and one that is not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _encoded(rows: DataFrame, coder: Coder, query: bool) -> DataFrame:
    """``rows`` with the code of ``vector``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = coder.codes(matrix(batch.column("vector")), query)
                yield batch.append_column("code", pa.array([c.tobytes() for c in codes], pa.binary()))

    fields = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{fields}, code binary")


def _longest(rows: DataFrame) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vector")).astype(np.float64)
                yield pa.record_batch([pa.array([float(np.sqrt((x * x).sum(axis=1).max()))])], names=["length"])

    return rows.select("vector").mapInArrow(run, "length double").agg(F.max("length")).first()[0]


def nearest(
    vectors: DataFrame, is_query: Column | str, k: int = 20, wanted: int = WANTED, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, <id>, score)``: each query row's ``k`` nearest rows but itself.

    ``is_query`` is a column, or SQL, on the rows of ``vectors``.
    """
    spark = vectors.sparkSession
    is_query = F.expr(is_query) if isinstance(is_query, str) else is_query
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    if dict(rows.dtypes)["vector"] != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.where(F.col("id").isNotNull() & _usable("vector"))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id}` long, score double")
    rows = rows.where(F.size("vector") == common.n)

    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    smallest = rows.select("id", "vector").withColumn("place", place).where(F.col("place") <= k + 1)
    classes = stored(smallest.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    count = classes.count()
    sample = classes.select("vector").sample(min(1.0, 1.2 * SAMPLE / count), seed=3) if count > SAMPLE else classes.select("vector")
    coder = Coder.fitted(np.array([r.vector for r in sample.limit(SAMPLE).collect()], np.float64), _longest(classes))

    asked = rows.where("asks").select("vector").distinct().withColumn("ask", F.monotonically_increasing_id())
    asked = stored(_encoded(asked, coder, query=True), "asked")
    blocks = max(-(-count // BLOCK), min(spark.sparkContext.defaultParallelism, count // SMALL), 1)
    indexed = _encoded(classes, coder, query=False).withColumn("side", F.lit(0))
    indexed = indexed.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int"))
    indexed = indexed.withColumn("ask", F.lit(None).cast("long"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asking = asked.withColumn("ids", F.lit(None).cast("array<long>")).withColumn("side", F.lit(1)).withColumn("block", every)
    columns = ["block", "side", "ask", "ids", "vector", "code"]
    dealt = indexed.select(columns).unionByName(asking.select(columns))
    dealt = dealt.repartitionById(blocks, "block").sortWithinPartitions("block", "side")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        of, block, x, ids, first = None, None, None, None, None
        for batch in batches:
            at = batch.column("block").to_numpy()
            side = batch.column("side").to_numpy()
            edges = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                now = batch.slice(a, b - a)
                if side[a] == 0:
                    if at[a] != of:
                        of, parts, block = at[a], [], None
                    parts.append(now)
                    continue
                if at[a] != of:
                    continue  # a block without vectors
                if block is None:
                    whole = pa.Table.from_batches(parts).combine_chunks()
                    parts = []
                    x = matrix(whole.column("vector").chunk(0))
                    lists = whole.column("ids").chunk(0)
                    ids, first = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                    block = Block(_bytes(whole.column("code").chunk(0)))
                for start in range(0, now.num_rows, BATCH):
                    some = now.slice(start, BATCH)
                    q, asks = matrix(some.column("vector")), some.column("ask").to_numpy()
                    found = block.find(_bytes(some.column("code")), wanted)
                    yield _best(asks, [_ranked(v, r, x, ids, first, k + 1) for v, r in zip(q, found)])

    schema = "ask long, id long, score double, own boolean"
    near = dealt.mapInArrow(search, schema)
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "id", F.desc("own"))
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = near.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score", "own"))).alias("near"))

    queries = rows.where("asks").select(F.col("id").alias("query_id"), "vector").join(asked.select("ask", "vector"), "vector")
    itself = F.array_position(F.transform("near", lambda e: e["own"] & (e["id"] == F.col("query_id"))), True)
    out = queries.select("query_id", "ask").join(lists, "ask").withColumn("itself", itself)
    others = F.slice(F.filter("near", lambda e, i: i + 1 != F.col("itself")), 1, k)
    return out.select("query_id", F.posexplode(others).alias("rank", "e")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("e.id").alias(id), F.col("e.score").alias("score")
    )


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), BITS // 8)


def _ranked(query: np.ndarray, rows: np.ndarray, x: np.ndarray, ids: np.ndarray, first: np.ndarray, k: int):
    """``(ids, scores, own)`` of the best ``k`` rows among the classes ``rows``, ties to smaller ids."""
    query = query.astype(np.float64)
    near = x[rows].astype(np.float64)
    score = (near * query).sum(axis=1)
    if len(rows) > k:
        keep = score >= np.partition(score, len(score) - k)[len(score) - k]
        rows, near, score = rows[keep], near[keep], score[keep]
    own = (near == query).all(axis=1)
    sizes = first[rows + 1] - first[rows]
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    each, score, own = ids[np.repeat(first[rows], sizes) + step], np.repeat(score, sizes), np.repeat(own, sizes)
    order = np.lexsort((~own, each, -score))[:k]
    return each[order], score[order], own[order]


def _best(asks: np.ndarray, found: list) -> pa.RecordBatch:
    ask = np.repeat(asks, [len(f[0]) for f in found])
    columns = [pa.array(ask)] + [pa.array(np.concatenate([f[i] for f in found])) for i in range(3)]
    return pa.record_batch(columns, names=["ask", "id", "score", "own"])
