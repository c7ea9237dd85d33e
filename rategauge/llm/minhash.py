"""Near-duplicates by circulant MinHash, banding and exact Jaccard.

A document is the set of its distinct word shingles. Shingle hashes fall on ``UNIVERSE`` places; one
permutation (sigma) spreads them, a second one (pi) is read at a place circularly shifted by 0, 1,
2, ..., and each shift's minimum over the set is one signature coordinate. So two permutations give
all coordinates, and the values of one shingle for all shifts are one contiguous slice of pi.
Signatures are cut into bands; documents that agree on a whole band are candidates; every link is
confirmed on the full sets (by 64-bit shingle hashes).

With 40 bands of 5 rows a pair at similarity 0.8 meets in some band with probability
1 - (1 - 0.8 ** 5) ** 40 = 1 - 1.2e-7; above that, more surely still.

Scale. Texts with equal sets are one class, which goes on as one node. A band's bucket is never
brought into one task and its pairs are never rows: first every member is compared with one pivot of
the bucket, and links give components. As long as that helps, buckets whose members are in different
components take a new pivot from outside the largest one. Buckets still open are dealt into blocks, and
pairs across components are compared in them in memory, by a longer signature and then on their full sets. A block joins what it links and gives out only links that join two of its
components, so its rows are fewer than its members whatever the number of alike pairs. Buckets of
the same members count once. Joins have one row per key on one side; a hot key is split by AQE.

Defined results: null and empty texts, and texts of blanks, have no shingles and are linked with
nothing; a text with fewer words than ``words`` is one shingle; rows that repeat are in one component;
an empty table gives an empty result; each row counts by its own text, also where ids repeat; a row
with a null id is linked as others and takes the smallest id it reaches, null and kept if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rategauge.llm.arrays import hashed_words, mix, pieces, signed
from rategauge.llm.components import components
from rategauge.llm.text import whole
from rategauge.plans.scratch import stored

UNIVERSE = 1 << 22
BANDS, ROWS = 40, 5
#: Coordinates of the closer look at pairs across components, and how far below the similarity, in
#: standard deviations of their share, a pair is still confirmed on its sets (one in three million
#: pairs just at the similarity lies lower).
SKETCH, SIGMAS = 1024, 5
#: Members of a bucket that one task compares: so many outsiders with so many members. A member counts
#: once for each ``HEAVY`` shingles of its set and once more.
BLOCK, CHUNK = 256, 2048
HEAVY = 512
#: New pivots are tried while they leave at most this share of outsiders.
SHRINK = 0.75

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingled(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    hashes, at = hashed_words(column, lower=True)
    grams = mix(hashes + np.uint64(1))
    for k in range(1, words):
        if len(hashes) > k:
            grams = mix(grams[: len(hashes) - k] * _STEP + hashes[k:])
        else:
            grams = grams[:0]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = mix(short * _STEP + hashes[k : k + 1])
            yield short
        else:
            yield np.zeros(0, np.uint64)


class Circulant:
    """Signatures of ``size`` coordinates from two permutations of ``UNIVERSE`` places."""

    def __init__(self, size: int, seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.sigma = rng.permutation(UNIVERSE).astype(np.int32)
        pi = rng.permutation(UNIVERSE).astype(np.uint32)
        ring = np.concatenate([pi, pi[: size - 1]])
        self.shifts = np.lib.stride_tricks.sliding_window_view(ring, size)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = self.sigma[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)]
        parts = [self.shifts[places[i : i + 2048]].min(axis=0) for i in range(0, len(places), 2048)]
        return np.minimum.reduce(parts)


@cache
def circulant(size: int, seed: int = 7) -> Circulant:
    """The same permutations for all tasks of one Python worker, made once (32 MB each)."""
    return Circulant(size, seed)


def _bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    for column in signature.reshape(bands, rows).T:
        key = mix(key ^ column.astype(np.uint64) * _STEP)
    return signed(key)


def signatures(
    docs: DataFrame, words: int = 5, bands: int = BANDS, rows: int = ROWS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(id, th, n_shingles, set_a, set_b, keys)``: text and set digests, one key per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            maker = circulant(bands * rows)
            sizes, first, second, keys = [], [], [], []
            for shingles in shingled(batch.column("text"), words):
                sizes.append(len(shingles))
                first.append(int(signed(np.add.reduce(mix(shingles), keepdims=True))[0]))
                second.append(int(signed(np.bitwise_xor.reduce(mix(shingles * _STEP), keepdims=True))[0]))
                if len(shingles):
                    keys.append(_bands(maker.signature(shingles), bands, rows))
                else:
                    keys.append(np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            yield pa.record_batch(
                [
                    batch.column("id"),
                    batch.column("th"),
                    pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))),
                ],
                names=["id", "th", "n_shingles", "set_a", "set_b", "keys"],
            )

    schema = "id long, th long, n_shingles long, set_a long, set_b long, keys array<long>"
    return _keyed(docs, id, text).mapInArrow(run, schema)


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(id, th, text)``: rows equal in id and text have one key."""
    t = whole(text)
    return docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(t).alias("th"), t.alias("text"))


def sketches(texts: DataFrame, words: int) -> DataFrame:
    """``(id, coordinates, shingles)``: one byte of each of ``SKETCH`` coordinates, and the sorted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            maker = circulant(SKETCH, seed=8)
            marks, sets = [], []
            for shingles in shingled(batch.column("text"), words):
                values = maker.signature(shingles) * np.uint32(2654435761) >> np.uint32(24)
                marks.append(values.astype(np.uint8).tobytes())
                sets.append(shingles.tobytes())
            columns = [batch.column("id"), pa.array(marks, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.record_batch(columns, names=["id", "coordinates", "shingles"])

    return texts.select("id", "text").mapInArrow(run, "id long, coordinates binary, shingles binary")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text_a"):
            left = list(shingled(batch.column("text_a"), words))
            right = shingled(batch.column("text_b"), words)
            hold = []
            for x, y in zip(left, right):
                hold.append(_alike(x, y, percent))
            yield batch.select(["a", "b"]).filter(pa.array(hold, pa.bool_()))

    joined = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _open(named: DataFrame) -> DataFrame:
    """``(key, id, n, label, main, chunks, blocks, out)``: members of buckets with several labels.

    ``named`` is ``(key, id, n, label)``. Of a bucket's labels the largest is its main one; ``out`` marks
    members with another. Buckets of the same members are one.
    """
    weight = 1 + F.floor(F.col("n") / HEAVY)
    draws = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"draw{k}") for k in (1, 2)]
    sizes = named.groupBy("key", "label").agg(F.sum(weight).alias("weight"), F.count("*").alias("count"), *draws)
    mixed = sizes.groupBy("key").agg(
        F.count("*").alias("labels"),
        F.sum("weight").alias("all"),
        F.max(F.struct(F.col("weight"), F.col("label"))).alias("main"),
        F.sum("count").alias("count"),
        *(F.bit_xor(f"draw{k}").alias(f"draw{k}") for k in (1, 2)),
    )
    chunks = F.ceil(F.col("all") / CHUNK).cast("int").alias("chunks")
    blocks = F.ceil((F.col("all") - F.col("main.weight")) / BLOCK).cast("int").alias("blocks")
    mixed = mixed.where("labels > 1").select("count", "draw1", "draw2", F.struct("key", F.col("main.label").alias("main"), chunks, blocks).alias("m"))
    mixed = mixed.groupBy("count", "draw1", "draw2").agg(F.min("m").alias("m")).select("m.*")
    return stored(named.join(mixed, "key").withColumn("out", F.col("label") != F.col("main")), "open")


def _pivoted(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of each bucket's smallest outsider with members of other labels."""
    pivots = opened.where("out").groupBy("key").agg(F.min(F.struct("id", "n", "label")).alias("p"))
    close = F.expr(f"label <> p.label AND 100 * least(n, p.n) >= {percent} * greatest(n, p.n)")
    pairs = opened.join(pivots, "key").where(close)
    pairs = pairs.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct()
    left, right = (sets.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b")))
            hold = [_alike(*(np.frombuffer(x, np.uint64) for x in pair), percent) for pair in both]
            yield batch.select(["a", "b"]).filter(pa.array(hold, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(run, "a long, b long")


def _across(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of one bucket and different labels, enough to join all that are alike.

    Every pair to compare has an outsider. Outsiders are dealt into blocks and all members into chunks;
    a block meets every chunk of its bucket in some task. The task compares the two in memory: pairs
    that agree in enough coordinates of a longer signature are confirmed on their full sets, but only
    while their labels are not joined yet. So no group is bounded by a task's memory, and a task gives
    out fewer links than it has labels.
    """
    marked = opened.join(sets, "id")
    draw = F.xxhash64("id")
    chunk, block = F.pmod(draw, F.col("chunks")), F.pmod(draw, F.col("blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "chunk", "block", "out", "id", "label", "coordinates", "shingles"]
    inner = marked.withColumn("chunk", chunk.cast("int")).withColumn("block", every("blocks"))
    outer = marked.where("out").withColumn("block", block.cast("int")).withColumn("chunk", every("chunks"))
    inner = inner.withColumn("out", F.lit(False))
    dealt = outer.select(columns).unionByName(inner.select(columns))
    dealt = dealt.repartition("key", "chunk", "block").sortWithinPartitions("key", "chunk", "block", "out")
    p = percent / 100
    enough = int(np.floor(SKETCH * p - SIGMAS * np.sqrt(SKETCH * p * (1 - p))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            ids = group.column("id").to_numpy()
            labels = group.column("label").to_numpy().copy()
            outs = group.column("out").to_numpy(zero_copy_only=False)
            flat = b"".join(group.column("coordinates").to_pylist())
            marks = np.frombuffer(flat, np.uint8).reshape(len(ids), SKETCH)
            sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
            links = []
            for i in np.flatnonzero(outs):
                rivals = np.flatnonzero(~outs & (labels != labels[i]))
                agree = (marks[rivals] == marks[i]).sum(axis=1)
                likely = np.argsort(-agree, kind="stable")[: np.count_nonzero(agree >= enough)]
                for j in rivals[likely]:
                    if labels[i] != labels[j] and _alike(sets[i], sets[j], percent):
                        links.append((ids[i], ids[j]))
                        labels[labels == labels[j]] = labels[i]
            if links:
                left, right = np.sort(np.array(links, np.int64), axis=1).T
                yield pa.record_batch([pa.array(left), pa.array(right)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with one (key, chunk, block), also across batches."""
    names = ("key", "chunk", "block")
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = np.stack([batch.column(c).to_numpy() for c in names])
        cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            now = tuple(at[:, a])
            if now != last and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def grouped(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id, th, n_shingles, top)`` for every row: the key ``top(no, id, th)`` of its component's first.

    ``top`` is null for rows without shingles, ``top.no`` tells that its id is null.
    """
    sigs = stored(signatures(docs, words, bands, rows, id, text), "signatures")
    digest = ["set_a", "set_b", "n_shingles"]
    own = F.struct(F.col("id").isNull().alias("no"), "id", "th")
    classes = sigs.where("n_shingles > 0").groupBy(*digest).agg(F.min(own).alias("rep"), F.first("keys").alias("keys"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    band_rows = stored(
        classes.select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), F.explode("keys").alias("key")), "bands"
    )

    first = F.min(F.struct("id", "n")).alias("p")
    shared = band_rows.groupBy("key").agg(first, F.count("*").alias("c")).where("c > 1")
    members = stored(band_rows.join(shared, "key").select("key", "id", "n", "p", "c"), "buckets")
    need = classes.select(F.col("node"), "rep").join(members.select(F.col("id").alias("node")).distinct(), "node")
    source = _keyed(docs, id, text)
    same = source["id"].eqNullSafe(need["rep.id"]) & (source["th"] == need["rep.th"])
    texts = source.join(need, same).select(F.col("node").alias("id"), "text")
    texts = stored(texts.dropDuplicates(["id"]), "candidates")

    # Sets of too different sizes cannot reach the similarity.
    close = F.expr(f"100 * least(n, p.n) >= {percent} * greatest(n, p.n)")
    pairs = members.where(F.col("id") != F.col("p.id")).where(close)
    pairs = pairs.select(F.col("p.id").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(confirmed(pairs, texts, words, percent), "links")
    labels = components(links)

    # Buckets whose members are not all in one component yet: the pivot is done, the rest is compared.
    members = members.where("c > 2 AND id <> p.id").select("key", "id", "n")

    def opened(labels: DataFrame) -> DataFrame:
        named = members.join(stored(labels, "labels"), "id", "left")
        return _open(named.select("key", "id", "n", F.coalesce("component", "id").alias("label")))

    table = opened(labels)
    need = texts.join(table.select("id").distinct(), "id", "left_semi")
    sets = stored(sketches(need, words), "sketches")
    outside, before = table.where("out").count(), None
    while outside and (before is None or outside < SHRINK * before):
        links = stored(links.unionByName(_pivoted(table, sets, percent)), "links")
        labels = components(links)
        table, before = opened(labels), outside
        outside = table.where("out").count()
    if outside:
        more = stored(_across(table, sets, percent), "links")
        labels = components(links.unionByName(more))

    nodes = classes.select(*digest, "node", "rep").join(labels.withColumnRenamed("id", "node"), "node", "left")
    nodes = stored(nodes.withColumn("component", F.coalesce("component", "node")).drop("node"), "nodes")
    tops = nodes.groupBy("component").agg(F.min("rep").alias("top"))
    of_class = nodes.join(tops, "component").select(*digest, "top")
    return sigs.join(of_class, digest, "left").select("id", "th", "n_shingles", "top")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``docs``."""
    found = grouped(docs, words, percent, bands, rows, id, text)
    found = found.select(F.col("id").alias(id), "n_shingles", F.coalesce("top.id", "id").alias("component_id"))
    return found.withColumn("kept", F.col(id).eqNullSafe(F.col("component_id")))


def one_of_each(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows of ``docs``: one of each component, and all without shingles.

    It is the row of the smallest id, null ids last; of rows that repeat in id and text, one.
    """
    found = stored(grouped(docs, words, percent, bands, rows, id, text), "groups").where("top IS NOT NULL")
    is_top = F.col("id").eqNullSafe(F.col("top.id")) & (F.col("th") == F.col("top.th"))
    gone = found.where(~is_top).select(F.col("id").alias("gone"), F.col("th").alias("gone_th")).distinct()
    twice = found.where(is_top).groupBy(F.col("id").alias("again"), F.col("th").alias("again_th")).count().where("count > 1").drop("count")
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col(id).cast("long").alias("id"), F.xxhash64(whole(text)).alias("th"))
    left = held.join(gone, F.col("id").eqNullSafe(F.col("gone")) & (F.col("th") == F.col("gone_th")), "left_anti")
    left = left.join(twice, F.col("id").eqNullSafe(F.col("again")) & (F.col("th") == F.col("again_th")), "left")
    alone = left.where("again_th IS NULL").select("row.*")
    order = Window.partitionBy("id", "th").orderBy(*(F.col(f"row.`{name}`") for name in docs.columns))
    first = left.where("again_th IS NOT NULL").withColumn("place", F.row_number().over(order)).where("place = 1")
    return alone.unionByName(first.select("row.*"))
