"""Exact substring dedup by a family of suffix levels of logarithmic number.

Documents come in batches. A batch's suffixes (those at the anchors of ``repeats``, one in about a
hundred bytes, each with the digest of what follows) are sorted into an array of their own and
merge-scanned against the levels there are: an anchor that the batch shares with a level, or with
itself, may lie in a long match. Then the batch becomes a level, and levels of equal rank merge into one
of the next, so a family of n batches has at most log2(n) + 1 levels and every row is rewritten that
often. A level keeps, per anchor and context, how often it occurs and where first, in the order of
digests, which brings equal suffixes together as the order of texts would. Only suffixes that some scan
matched go on to the comparison of whole windows.

Defined results: a null or empty text has no bytes; texts shorter than a window lose nothing; rows that
repeat are copies of each other; rows with null ids are judged and returned as others; an empty table
gives an empty result; columns other than id and text play no part.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rategauge.llm import repeats
from rategauge.llm.arrays import utf8
from rategauge.plans.scratch import stored

WIDTH, GRAM = 400, 200
BATCHES = 4

BYTES = repeats.Tokens(
    width=WIDTH,
    k=GRAM,
    kind=np.uint8,
    values=utf8,
    strings=lambda text: text.encode(),
    glue=b"",
    count=lambda text: F.octet_length(text).cast("long"),
    digest=lambda text: F.sha2(text.cast("binary"), 256),
)


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("h", "c").agg(F.sum("n").alias("n"), F.min("rep").alias("rep"))


@dataclass
class Family:
    """Levels by rank; a level of rank r holds 2 ** r batches. ``matched`` has the anchors scans found."""

    levels: dict[int, DataFrame] = field(default_factory=dict)
    matched: list[DataFrame] = field(default_factory=list)

    def add(self, rows: DataFrame) -> None:
        """Sort a batch of segments, scan it against the levels, merge levels of equal rank."""
        array = stored(repeats.counted(rows).sortWithinPartitions("h", "c"), "array")
        self.matched.append(stored(self.matches(array), "matches"))
        if 0 not in self.levels:
            self.levels[0] = array
            return
        level, rank = array, 0
        while rank in self.levels:
            level, rank = _merged(self.levels.pop(rank), level), rank + 1
        self.levels[rank] = stored(level.sortWithinPartitions("h", "c"), "level")

    def matches(self, array: DataFrame) -> DataFrame:
        """``h``: anchors of the batch that occur in it more than once or in a level."""
        own = array.groupBy("h").agg(F.sum("n").alias("n"))
        found = own.where("n > 1").select("h")
        for level in self.levels.values():
            found = found.unionByName(own.select("h").join(level.select("h").distinct().hint("merge"), "h"))
        return found.distinct()

    def groups(self) -> DataFrame:
        """``(h, c, n, rep)`` of all batches, of matched anchors alone."""
        matched = self.matched[0]
        for more in self.matched[1:]:
            matched = matched.unionByName(more)
        matched = stored(matched.distinct(), "matched")
        levels = [level.join(matched, "h", "left_semi") for level in self.levels.values()]
        out = levels[0]
        for level in levels[1:]:
            out = _merged(out, level)
        return out


def deduplicated(docs: DataFrame, batches: int = BATCHES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    source = repeats.keyed(docs, id, text)
    batch = F.pmod(F.xxhash64("id", "th"), F.lit(batches))
    rows = stored(repeats.segment_table(source, BYTES), "segments")
    family = Family()
    for k in range(batches):
        family.add(rows.where(batch == k))
    out = repeats.removed(source, rows, family.groups(), BYTES)
    return out.withColumnRenamed("n", "n_bytes").withColumnRenamed("id", id)
