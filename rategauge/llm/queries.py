"""The registered queries of this subpackage; each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rategauge.llm import hamming, html, minhash, mixing, oracles, phrases, pieces, pii, quality, resample, suffix_levels, suffix_trees, syncmers, urls
from rategauge.plans.shipping import shipped

#: Where the public vocabulary is; every executor can read it.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark, sf_dir):
    """Components of documents whose 2-word shingle sets are 80 % alike."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_suffix_array_dedup(spark, sf_dir):
    """What is left of each text without its repeated 400-byte strings."""
    return suffix_levels.deduplicated(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark, sf_dir):
    """What is left of each text without its repeated 35-word windows."""
    return suffix_trees.deduplicated(_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark, sf_dir):
    """Ids of every whole text, and whether they decode to it."""
    return pieces.encoded(_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op5_pii(spark, sf_dir):
    """Counts and places of personal data in every whole text."""
    return pii.found(_table(spark, sf_dir, "documents"))


def op6_url_filters(spark, sf_dir):
    """Rules first, then the learnt path templates. A page is labelled by the row of its id."""
    pages = _table(spark, sf_dir, "pages")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), bad.alias("bad"))
    return urls.judged_urls(pages, labels)


def op7_mixing(spark, sf_dir):
    """Words each document gives to a mix of sources weighing 5, 2, 1, repeating."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op8_fingerprints(spark, sf_dir):
    """Each document's fingerprint, that of its edited text, and likenesses."""
    return syncmers.fingerprints(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html.extracted(_table(spark, sf_dir, "pages"))


def op10_quality_rules(spark, sf_dir):
    """Measurements, the failure mask and the verdict of the standard policy."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    entries = quality.ledger(docs)
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality.fails(quality.BASE).alias("base_failed"),
        quality.kept(quality.STANDARD).alias("kept"),
        quality.FAILURES,
    )


def op11_phrase_mining(spark, sf_dir):
    """The 2,000 best phrases of two or three words of each lang."""
    return phrases.collocations(_table(spark, sf_dir, "documents"), longest=3, least=10, percent=50, top=2000)


def op12_importance_resampling(spark, sf_dir):
    """A tenth of the documents, drawn by how much likelier their words are in the benchmark."""
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return resample.resampled(docs, target, longest=1, buckets=10_000, seed=2024, percent=10, least_words=20)


def op13_nearest_neighbours(spark, sf_dir):
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    return hamming.nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op5_pii": op5_pii,
    "op6_url_filters": op6_url_filters,
    "op7_mixing": op7_mixing,
    "op8_fingerprints": op8_fingerprints,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLES = oracles.ORACLES
