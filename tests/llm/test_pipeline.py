"""The pipeline's stages on awkward rows, each against what its operator says of them."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from rategauge.llm import minhash, pieces
from rategauge.llm.queries import PIECE_MODEL
from tests.llm.conftest import EDGES, SCHEMA, prose

A, B = prose(5, 200), prose(6, 200)
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return Counter(map(tuple, df.collect()))


def table(spark, *pairs):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], SCHEMA).repartition(3)


def ids(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_edges_and_empty_tables(spark, edges, nothing, name):
    out = STAGES[name](spark, edges, "")
    if name != "sentencepiece_ids":
        assert out.columns == list(corpus_pipeline.COLUMNS)
        assert {r.doc_id for r in out.select("doc_id").collect()} <= {r[0] for r in EDGES}
    assert STAGES[name](spark, nothing, "").count() == 0


def test_near_dedup_by_row_not_by_id(spark):
    """One id with two texts: the copy goes, the other text stays."""
    stage = STAGES["minhash_near_dedup"]
    assert ids(stage(spark, table(spark, (3, A), (5, A), (5, B)), "")) == [(3, A), (5, B)]
    assert ids(stage(spark, table(spark, (None, A), (None, A), (None, B), (7, B + " x")), "")) == [(7, B + " x"), (None, A)]
    assert ids(stage(spark, table(spark, (4, A), (4, A), (4, A), (9, A)), "")) == [(4, A)]
    assert ids(stage(spark, table(spark, (1, None), (2, None), (2, ""), (None, " ")), "")) == [(1, None), (2, ""), (2, None), (None, " ")]


def test_near_dedup_keeps_one_of_each_component(spark, edges):
    kept = rows(STAGES["minhash_near_dedup"](spark, edges, ""))
    found = minhash.near_duplicates(edges).collect()
    groups = {r.component_id for r in found if r.n_shingles and r.component_id is not None}
    assert Counter(r[0] for r in kept.elements() if (r[1] or "").split() and r[0] is not None) == Counter(groups)
    assert all(n == 1 for r, n in kept.items() if (r[1] or "").split())


def test_redaction_and_ids_keep_every_row(spark, edges):
    clean = STAGES["pii_redaction"](spark, edges, "")
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted((r[0] for r in EDGES), key=repr)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in clean.collect())
    out = STAGES["sentencepiece_ids"](spark, clean, "")
    codec = pieces.Codec(PIECE_MODEL)
    assert Counter(codec.decode(r.ids) for r in out.collect()) == Counter(r.text or "" for r in clean.collect())


def test_links_of_a_block_join_components_only(spark, monkeypatch):
    """A dense bucket gives out fewer links than it has members, and the same components."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "CHUNK", 32)
    base = [f"w{i}" for i in range(60)]
    docs = [(k, " ".join(base[:k % 9] + [f"n{k}"] + base[k % 9 :] + [f"e{k}", f"f{k}"])) for k in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    named = frame.selectExpr("1L AS key", "doc_id AS id", "60L AS n", "doc_id % 50 AS label")
    texts = frame.selectExpr("doc_id AS id", "text")
    sets_table = minhash.sketches(texts, 2)
    opened = minhash._open(named)
    tasks = opened.selectExpr("max(chunks * blocks)").first()[0]
    links = minhash._across(opened, sets_table, 80).collect()
    assert 50 <= len(links) < 50 * tasks  # fewer than labels from each task
    one = minhash._pivoted(opened, sets_table, 80).collect()
    pivot = min(r.id for r in opened.where("out").collect())
    assert one and all(pivot in tuple(r) for r in one) and len(one) < len(docs)
    parent = {k: k % 50 for k in range(50)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: {tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} for i, t in docs}
    for a, b in links:
        assert 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
        parent[root(a % 50)] = root(b % 50)
    for a, _ in docs:
        for b, _ in docs[: a]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                assert root(a % 50) == root(b % 50)
