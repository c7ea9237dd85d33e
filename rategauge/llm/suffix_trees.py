"""Exact dedup of repeated word windows by suffix trees over partitions of prefixes.

Suffixes (those at the anchors of ``repeats``, one in about ten words) are dealt to groups by a
prefix: first that of the anchor's k words. A prefix that leads to one context only is a leaf or, if
it occurs more than once, an edge down to a node at least a window deep, and done. Where it branches
into several contexts, and these fit a task (``repeats.GROUP``), the task takes the group whole: the
windows of its contexts are sorted, and where neighbours agree over a window or more there is an internal
node as deep; all windows below such nodes are repeated, and their union are the maximal repeats. Where
they do not fit, the prefix is lengthened to the whole window for these alone, so that a group is a
node and its leaves are counted where they lie. Children are in the order of hashes, not of words, which
leaves the nodes the same; no subtree needs pointers, and none is larger than the stated number.

Defined results: as for ``suffix_levels``, with words for bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rategauge.llm import repeats
from rategauge.llm.text import words
from rategauge.plans.scratch import stored

WIDTH, GRAM = 35, 18

WORDS = repeats.Tokens(
    width=WIDTH,
    k=GRAM,
    kind=np.uint64,
    values=repeats.word_values,
    strings=repeats.word_strings,
    glue=b" ",
    count=lambda text: F.size(words(text)).cast("long"),
    digest=lambda text: F.sha2(F.array_join(words(text), " ").cast("binary"), 256),
)


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256)`` of every row, with ``n_spans``."""
    source = repeats.keyed(docs, id, text)
    rows = stored(repeats.segment_table(source, WORDS), "suffixes")
    out = repeats.removed(source, rows, repeats.counted(rows), WORDS)
    return out.withColumnRenamed("n", "n_words").withColumnRenamed("id", id)
