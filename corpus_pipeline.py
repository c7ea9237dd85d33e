"""From raw documents to token ids: five stages, each stored before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rategauge.llm import minhash, mixing, pieces, pii, quality
from rategauge.llm.queries import PIECE_MODEL
from rategauge.plans.scratch import stored
from rategauge.plans.shipping import shipped

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps.

    The ledger is stored before the policy reads it: a filter on its bits would otherwise be pushed
    below the measurements, and Catalyst would write their whole tree out for every use.

    Null and empty texts have too few words and go; rows that repeat are judged alike; ids play no part;
    an empty table stays empty.
    """
    entries = stored(quality.ledger(docs.select(*COLUMNS)).select(*COLUMNS, quality.FAILURES), "ledger")
    return entries.where(quality.kept(quality.STANDARD)).select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: five-word shingles, similarity 0.8.

    The smallest id stays, an id before null; of rows with one id and text, one; of rows with one id and
    different texts, each by its own text. Texts without words are no copies of each other and stay; an
    empty table stays empty.
    """
    shipped(spark)
    return minhash.one_of_each(docs.select(*COLUMNS), words=5, percent=80)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind; n_chars follows.

    Every row stays. A null text and its n_chars are null, an empty text is empty; rows that repeat are
    redacted alike.
    """
    shipped(spark)
    clean = pii.redacted(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it.

    A null source is a source of its own; null and empty texts have no words, so they stay as their
    source's share has it; an empty table stays empty.
    """
    return mixing.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_ids, ids, round_trip)`` of every document of the mix.

    Null and empty texts have no ids; rows that repeat and null ids are rows as others.
    """
    shipped(spark)
    return pieces.encoded(docs, PIECE_MODEL)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("pii_redaction", pii_redaction),
    ("source_mixing", source_mixing),
    ("sentencepiece_ids", sentencepiece_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The last stage's ids come from a Viterbi search over a vocabulary file: no SQL expresses it.
ORACLE_SQL = None
