"""Nearest vectors: the index against all codes, recall and exact rows against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rategauge.llm import hamming

SCHEMA = "vec_id long, embedding array<float>"
ASKS = "vec_id % 20 = 0"


def brute(rows, k, every=20):
    """Each query row's nearest others, ties to the smaller id; rows that repeat are others."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, q) in enumerate(good):
        if i % every == 0:
            near = sorted((-float((x * q).sum()), j) for m, (j, x) in enumerate(good) if m != n)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(near, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def vectors(n, d, seed=0):
    return np.random.default_rng(seed).standard_normal((n, d)).astype(np.float32)


@pytest.mark.parametrize("size", [200, 3000])
def test_index_finds_every_code_within_the_radius(size):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (size, hamming.BITS // 8), np.uint8)
    codes[: size // 4] = codes[0] ^ (rng.random((size // 4, hamming.BITS // 8)) < 0.1)  # a dense cluster
    query = np.concatenate([codes[:4], rng.integers(0, 256, (3, hamming.BITS // 8), np.uint8)])
    index = hamming.Block(codes)
    for q, rows in zip(query, index.find(query, 30)):
        far = np.bitwise_count(codes ^ q).sum(axis=1)
        radius = far[rows].max()
        assert len(rows) >= 30 and sorted(rows) == np.flatnonzero(far <= radius).tolist()
    for p in range(3):
        who, rows = index.within(query, p)
        parts = np.bitwise_count(codes.view(np.uint16)[None] ^ query.view(np.uint16)[:, None])
        assert set(zip(who.tolist(), rows.tolist())) == set(zip(*(x.tolist() for x in np.nonzero((parts == p).any(axis=2)))))


def test_edges(spark, monkeypatch):
    """Few vectors are all found, so the rows are those of brute force."""
    x = vectors(60, 5)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(20, x[3].tolist()), (20, x[20].tolist()), (40, x[40].tolist()), (100, x[3].tolist()), (7, x[7].tolist())]
    rows += [(120, None), (140, []), (160, [0.0] * 5), (180, [1.0, None, 1.0, 1.0, 1.0]), (200, [math.nan] * 5), (220, [math.inf] * 5), (None, x[0].tolist())]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, 6)
    assert got(hamming.nearest(frame, ASKS, k=6)) == want
    odd = frame.withColumns({c: F.lit("x") for c in "id vector asks place ask block side code ids near own score rank n".split()})
    assert got(hamming.nearest(odd, ASKS, k=6)) == want
    monkeypatch.setattr(hamming, "SMALL", 8)  # several blocks
    assert got(hamming.nearest(frame, ASKS, k=6)) == want
    assert got(hamming.nearest(frame.withColumn("embedding", F.col("embedding").cast("array<double>")), ASKS, k=6)) == want
    assert got(hamming.nearest(frame, ASKS, k=100)) == brute(rows, 100)
    other = frame.unionByName(spark.createDataFrame([(300, [1.0, 2.0])], SCHEMA))
    assert got(hamming.nearest(other, ASKS, k=6)) == want


def test_empty(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert hamming.nearest(nothing, ASKS).count() == 0
    assert hamming.nearest(spark.createDataFrame([(1, [1.0])], SCHEMA), ASKS).count() == 0
    assert hamming.nearest(spark.createDataFrame([(20, [1.0])], SCHEMA), ASKS).count() == 0
    assert hamming.nearest(nothing, ASKS).columns == ["query_id", "rank", "vec_id", "score"]


def test_a_vector_that_a_third_repeat(spark, monkeypatch):
    monkeypatch.setattr(hamming, "SMALL", 64)
    x = vectors(400, 16, 3)
    rows = [(i, (x[0] if i % 3 == 0 else v).tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found, want = got(hamming.nearest(frame, ASKS, k=20)), brute(rows, 20)
    assert [r for r in found if r[0] % 3 == 0] == [r for r in want if r[0] % 3 == 0]
    assert len(set(found) & set(want)) >= 0.95 * len(want)


@pytest.mark.parametrize("lengths", ["equal", "spread"])
def test_recall(spark, monkeypatch, lengths):
    monkeypatch.setattr(hamming, "SMALL", 1024)
    x = vectors(4000, 64, 5)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "spread":
        x *= np.random.default_rng(2).uniform(0.2, 1.0, (len(x), 1)).astype(np.float32)
    rows = list(enumerate(x.tolist()))
    found = got(hamming.nearest(spark.createDataFrame(rows, SCHEMA), ASKS, k=20))
    want = brute(rows, 20)
    assert [r[:2] for r in found] == [r[:2] for r in want]
    exact = {(i, j): s for i, _, j, s in want}
    hits = [(i, j) for i, _, j, s in found if (i, j) in exact]
    assert len(hits) >= 0.9 * len(want)
    assert all(s == exact[i, j] for i, _, j, s in found if (i, j) in exact)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    found, want = got(hamming.nearest(table, ASKS, k=20)), brute(rows, 20)
    assert len(set(r[:3:2] for r in found) & set(r[:3:2] for r in want)) >= 0.9 * len(want)
