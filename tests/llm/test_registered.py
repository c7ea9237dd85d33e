"""The registered text queries against their SQL, and the pipeline against its parts."""

from __future__ import annotations

import pytest

import corpus_pipeline
from rategauge.llm import minhash, pieces, pii, quality
from rategauge.llm.queries import ORACLES, PIECE_MODEL, QUERIES
from rategauge.plans.scratch import stored
from tools.compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    verdict = compare(spark, duck(sf_dir), sf_dir, name)
    assert verdict.startswith("ok"), verdict


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = stored(quality.ledger(docs), "ledger").where(quality.kept(quality.STANDARD)).select(*corpus_pipeline.COLUMNS)
    kept = {r[0] for r in minhash.near_duplicates(good).where("kept").select("doc_id").collect()}
    texts = dict(good.select("doc_id", "text").collect())
    detector, codec = pii.fitted(good.where(good.doc_id.isin(sorted(kept)))), pieces.Codec(PIECE_MODEL)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {r.doc_id for r in rows} <= kept and all(r.round_trip for r in rows)
    for r in rows:
        clean = pii.redact(texts[r.doc_id], pii.spans_of(texts[r.doc_id], detector)[1])
        assert codec.decode(r.ids) == clean
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "pii_redaction", "source_mixing", "sentencepiece_ids"]
