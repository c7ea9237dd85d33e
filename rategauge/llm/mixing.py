"""Mix sources to target weights by hash thresholds.

Every document has a 60-bit hash of its id and text. A source that should give ``copies + f`` times
its words gives every document ``copies`` times and once more those whose hash is below a threshold.
The threshold comes from histograms: words are summed by source and the first 12 bits of the hash,
the bucket in which the running sum passes what is still wanted is looked up, and only the documents
of that bucket are summed by the next 12 bits, five times in all. So the threshold is exact to the
hash and no document is ever sorted; the documents are filtered where they lie. The hash at which
the sum passes is taken if that comes nearer, so a source is off by half a document at most.

Built from SQL functions only. The texts are read once; what follows reads a stored table of id,
source, size and hash. Sums are taken per task before the shuffle, so a source with a third of all
rows is not gathered. The histograms have one row per source and at most 4096 buckets, the table of
sources one row per source; it is ordered in one task.

Defined results: a null or empty text has size 0 and takes 0 words; null is a source of its own,
last in order; rows equal in id and text have one hash and are taken together, with their sizes
summed; a source without words has target 0; an empty table gives an empty result; columns other
than id, text and source play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rategauge.llm.text import whole, word_count
from rategauge.plans.scratch import stored

WEIGHTS = (5, 2, 1)
CAP = 3
BITS, STEP = 60, 12


def document_hash(id: str, text: str) -> Column:
    """60 bits that depend on id and text only, so that reruns agree."""
    of_text = F.md5(whole(text))
    key = F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"), of_text)
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(id, key, size, hash)``; the key orders sources by code point, null last."""
    key = F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))
    return docs.select(
        F.col(id).alias("id"),
        key.alias("key"),
        word_count(whole(text)).alias("size"),
        document_hash(id, text).alias("hash"),
    )


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``(key, source_size, target, copies, rest)``: words wanted of each source.

    The sources share all words by weight; none gets more than ``cap`` times its own, and what is
    above goes to the others by weight. That is one level: a source gets the smaller of its cap and
    level * weight. With sources ordered by cap / weight, the level is that of the first source that
    stays below its cap.
    """
    rank = Window.orderBy("key")
    order = Window.orderBy("fill", "key")
    every = Window.partitionBy(F.lit(0))
    df = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    df = df.withColumn("weight", F.get(cycle, (F.row_number().over(rank) - 1) % len(weights)))
    df = df.withColumn("fill", cap * F.col("source_size") / F.col("weight"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns(
        {
            "total": F.sum("source_size").over(every),
            "full": F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)),
            "open": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    df = df.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "key", "level"))).over(every)
    df = df.withColumn("level", level["level"])
    target = F.least(cap * F.col("source_size").cast("double"), F.col("level") * F.col("weight"))
    df = df.withColumn("target", F.coalesce(target, F.lit(0.0)))
    copies = F.when(
        F.col("source_size") > 0,
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap).cast("long")),
    ).otherwise(0)
    df = df.withColumn("copies", copies.cast("long"))
    rest = F.col("target") - F.col("copies") * F.col("source_size")
    return df.select("key", "source_size", "target", "copies", rest.alias("rest"))


def thresholds(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with ``below``: documents of a smaller hash give their words once more."""
    state = wanted.withColumn("bucket", F.lit(0).cast("long"))
    for bits in range(STEP, BITS + 1, STEP):
        outer = F.shiftright("hash", BITS - bits + STEP)
        of_bucket = sizes.withColumn("bucket", outer).join(
            state.select("key", "bucket"), ["key", "bucket"], "left_semi"
        )
        histogram = of_bucket.groupBy("key", F.shiftright("hash", BITS - bits).alias("inner")).agg(
            F.sum("size").alias("words")
        )
        running = F.sum("words").over(Window.partitionBy("key").orderBy("inner"))
        histogram = histogram.withColumn("upto", running)
        passed = histogram.join(state.select("key", "rest"), "key").where("upto > rest")
        first = passed.groupBy("key").agg(F.min(F.struct("inner", "upto", "words")).alias("first"))
        state = stored(
            state.drop("bucket", "words")
            .join(first, "key", "left")
            .withColumn("bucket", F.col("first.inner"))
            .withColumn("rest", F.col("rest") - F.coalesce(F.expr("first.upto - first.words"), F.lit(0)))
            .withColumn("words", F.col("first.words"))
            .drop("first"),
            "thresholds",
        )
    nearer = F.coalesce(2 * F.col("rest") > F.col("words"), F.lit(False)).cast("long")
    below = (F.coalesce("bucket", F.lit(0)) + nearer).alias("below")
    return state.select("key", "source_size", "target", "copies", below)


def mixture(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    cap: float = CAP,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``(id, size, source_size, target, taken)`` of every document."""
    sizes = stored(sized(docs, id, text, source), "sizes")
    chosen = thresholds(sizes, stored(targets(sizes, weights, cap), "targets"))
    times = F.col("copies") + (F.col("hash") < F.col("below")).cast("long")
    return sizes.join(chosen, "key").select(
        F.col("id").alias(id), "size", "source_size", "target", (times * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    cap: float = CAP,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The documents themselves, each as often as the mix takes it (0 to ``cap`` times)."""
    sizes = stored(sized(docs, id, text, source), "sizes")
    chosen = thresholds(sizes, stored(targets(sizes, weights, cap), "targets"))
    key = F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))
    marked = docs.select(
        F.struct("*").alias("row"), key.alias("key"), document_hash(id, text).alias("hash")
    ).join(chosen.select("key", "copies", "below"), "key")
    times = F.col("copies") + (F.col("hash") < F.col("below")).cast("long")
    repeats = F.explode(F.array_repeat(F.lit(1), times.cast("int")))
    return marked.select("row", repeats.alias("_")).select("row.*")
