"""Collocated phrases mined with weighted acyclic automata of word n-grams.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words
``[^\\x20\\x09]+``. A task turns every ``SHARD_WORDS`` words into one automaton (``automata``): sequences
``lang, word, word, ...`` of sorted n-grams, weighted by their counts. Automata are cut at common
prefixes of sequences; each prefix range is united in one task, which sums weights and keeps frequent
n-grams with the weights of their prefixes. The cuts are quantiles of sampled n-grams: they decide
only how even the ranges are, and a hot word is spread over as many ranges as it needs.

A cut of a phrase looks up its first part, which is a prefix, and the rest, which is a prefix of the
reversed sequence. So frequent n-grams are dealt once more to ranges of reversed sequences and walked
in order; the walk composes each phrase with the counts of the parts on its path. No part is joined,
so a word that ends a third of all phrases is no hot key.

Counts are Python integers or 64-bit sums and scores exact integers of any size.

Defined results: null and empty texts have no words; a null lang is ``und``; rows that repeat count as
often as they occur; an empty table gives an empty result; a score and count that tie are in the order
of phrases; columns other than text and lang play no part.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rategauge.llm.arrays import ascii_lower, pieces, runs, strings, utf8
from rategauge.llm.automata import Automaton, Cut, ranked
from rategauge.llm.text import whole
from rategauge.plans.scratch import stored

#: Words that become one automaton.
SHARD_WORDS = 1 << 19
#: Bytes of text, or frequent n-grams, that one range stands for.
RANGE_BYTES, RANGE_GRAMS = 8 << 20, 200_000
#: N-grams sampled for each range, and texts to take them from.
SAMPLES, SAMPLE_TEXTS = 100, 4000
#: Parts of a lang that are ranked by themselves before the lang is.
LISTS = 16
UNKNOWN = "und"
SCALE = 1_000_000

_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _CUT.copy()
_GAP[[0x20, 0x09]] = True


def _words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of a batch, the row of each, and whether the next word is of the same piece."""
    raw, at = utf8(batch.column("text"))
    raw = ascii_lower(raw)
    starts, ends = runs(~_GAP[raw], at)
    row = np.searchsorted(at, starts, side="right") - 1
    piece = np.cumsum(_CUT[raw])[starts] if len(starts) else starts
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    return strings(raw, starts, ends), row, joined


def _sequences(lang: np.ndarray, word: np.ndarray, joined: np.ndarray, longest: int) -> list[np.ndarray]:
    """Symbols of the n-grams that start at each word: its lang, then words, -1 behind a piece's end."""
    places, on = [lang, word], np.ones(len(word), bool)
    for k in range(1, longest):
        on = on & np.append(joined[k - 1 :], np.zeros(k - 1, bool))[: len(word)]
        after = np.append(word[k:], np.full(k, -1))[: len(word)]
        places.append(np.where(on, after, -1))
    return places


def _stream(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Distinct symbols and sequences of about ``SHARD_WORDS`` starts at a time."""

    def flush():
        if not held:
            return
        symbols = pa.concat_arrays([h[0] for h in held] + [h[1] for h in held])
        symbols, place = ranked(symbols)
        n = sum(len(h[0]) for h in held)
        langs = np.cumsum([n, *(len(h[1]) for h in held)])
        lang = np.concatenate([place[start + h[2]] for start, h in zip(langs, held)])
        places = _sequences(lang, place[:n], np.concatenate([h[3] for h in held]), longest)
        for start in range(0, n, SHARD_WORDS):
            yield symbols, [p[start : start + SHARD_WORDS] for p in places]

    held, count = [], 0
    for batch in pieces(batches):
        words, row, joined = _words(batch)
        langs = pc.fill_null(batch.column("lang"), UNKNOWN).cast(pa.large_string())
        held.append((words, langs, row, joined))
        count += len(words)
        if count >= SHARD_WORDS:
            yield from flush()
            held, count = [], 0
    yield from flush()


def _even(found: list[Cut], parts: int) -> list[Cut]:
    """At most ``parts - 1`` cuts that part the distinct ones evenly."""
    ordered = sorted(set(found))
    return sorted({ordered[len(ordered) * k // parts] for k in range(1, parts)} if ordered else set())


def _cuts(source: DataFrame, longest: int) -> list[Cut]:
    """Where ranges begin: quantiles of a sample whose size follows the number of ranges."""
    size, rows = source.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(-(-(size or 0) // RANGE_BYTES), min(source.sparkSession.sparkContext.defaultParallelism, (size or 0) >> 20))
    if parts < 2:
        return []
    share = min(1.0, SAMPLE_TEXTS / rows)
    every = max(1, int(size * share / 7 / (SAMPLES * parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, places in _stream(batches, longest):
            names = symbols.to_pylist()
            chosen = zip(*(p[::every].tolist() for p in places))
            yield pa.record_batch([pa.array([[names[x] for x in s if x >= 0] for s in chosen], pa.list_(pa.string()))], names=["gram"])

    found = source.sample(share, seed=11).mapInArrow(run, "gram array<string>").collect()
    return _even([tuple(row.gram) for row in found], parts)


def ngram_counts(docs: DataFrame, longest: int, least: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, words, a, path)`` of n-grams of up to ``longest`` words that occur ``least`` times.

    ``path`` holds the number of words of the lang and the counts of the n-gram's proper prefixes.
    """
    source = docs.select(whole(text).alias("text"), F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"))
    cuts = _cuts(source, longest)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, places in _stream(batches, longest):
            packed = Automaton.build(symbols, places, longest + 1).slices(cuts)
            kept = [(k, blob) for k, blob in enumerate(packed) if blob is not None]
            yield pa.record_batch([pa.array([k for k, _ in kept], pa.int32()), pa.array([b for _, b in kept], pa.binary())], names=["part", "automaton"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_part: dict[int, list[Automaton]] = {}
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("automaton").to_pylist()):
                of_part.setdefault(part, []).append(Automaton.unpacked(blob))
        for part in sorted(of_part):
            cut = cuts[part - 1] if part else ()
            for level in Automaton.union(of_part.pop(part)).frequent(least, cut)[1:]:
                yield pa.record_batch(
                    [
                        pa.array([s[0] for s, _, _ in level], pa.string()),
                        pa.array([s[1:] for s, _, _ in level], pa.list_(pa.string())),
                        pa.array([a for _, a, _ in level], pa.int64()),
                        pa.array([path for _, _, path in level], pa.list_(pa.int64())),
                    ],
                    names=["lang", "words", "a", "path"],
                )

    dealt = source.mapInArrow(shards, "part int, automaton binary").repartitionById(len(cuts) + 1, "part")
    return dealt.mapInArrow(united, "lang string, words array<string>, a long, path array<long>")


def scored(grams: DataFrame, percent: int) -> DataFrame:
    """``(lang, words, a, l, r, n, score, in_first, in_rest)`` of the n-grams of two words or more.

    ``grams`` is a stored :func:`ngram_counts`. ``in_first`` and ``in_rest`` tell whether the phrase
    holds ``percent`` of the occurrences of itself without its last word, or without its first.
    """
    spark: SparkSession = grams.sparkSession
    rows = grams.count()
    parts = max(1, -(-rows // RANGE_GRAMS))
    cuts: list[Cut] = []
    if parts > 1:
        sample = grams.sample(min(1.0, SAMPLES * parts / rows), seed=11).select("lang", "words").collect()
        cuts = _even([(r.lang, *reversed(r.words)) for r in sample], parts)
    #: Prefixes of a cut, and the first of the ranges that need their count besides its own.
    heads: dict[Cut, set[int]] = {}
    for k, cut in enumerate(cuts):
        for d in range(2, len(cut)):
            heads.setdefault(cut[:d], set()).add(k + 1)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = [(lang, *reversed(w)) for lang, w in zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist())]
            own = [bisect.bisect_right(cuts, t) for t in turned]
            copies = [(i, part) for i, t in enumerate(turned) for part in heads.get(t, ()) if part != own[i]]
            take = pa.array([*range(len(own)), *(i for i, _ in copies)], pa.int64())
            columns = [c.take(take) for c in (pa.array([t[1:] for t in turned], pa.list_(pa.string())), *(batch.column(c) for c in ("lang", "a", "path")))]
            part = pa.array([*own, *(p for _, p in copies)], pa.int32())
            copy = pa.array([False] * len(own) + [True] * len(copies))
            yield pa.record_batch([part, copy, *columns], names=["part", "copy", "turned", "lang", "a", "path"])

    schema = "part int, copy boolean, turned array<string>, lang string, a long, path array<long>"
    table = grams.mapInArrow(dealt, schema).repartitionById(len(cuts) + 1, "part").sortWithinPartitions("part", "lang", "turned")

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple] = []
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("copy", "lang", "turned", "a", "path"))
            for copy, lang, turned, a, path in zip(*columns):
                k = len(turned) - 1
                del stack[k:]
                if not copy and k:
                    cuts_here = [(SCALE * a * a // (path[j] * stack[k - j][1]), j) for j in range(1, k + 1)]
                    score, j = min(cuts_here)
                    inside = [100 * a >= percent * whole_count for whole_count in (path[k], stack[k - 1][1])]
                    out.append((lang, turned[::-1], a, path[j], stack[k - j][1], path[0], score, *inside))
                stack.append((turned[-1], a))
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 9, _TYPES)], names=_NAMES)

    schema = "lang string, words array<string>, a long, l long, r long, n long, score long, in_first boolean, in_rest boolean"
    return table.mapInArrow(composed, schema)


_NAMES = ["lang", "words", "a", "l", "r", "n", "score", "in_first", "in_rest"]
_TYPES = [pa.string(), pa.list_(pa.string()), *[pa.int64()] * 5, pa.bool_(), pa.bool_()]


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    percent: int = 50,
    top: int | None = 2000,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each lang's best phrases of 2 to ``longest`` words.

    A phrase within a longer one that has ``percent`` of its occurrences is dropped. It is enough to
    look at phrases longer by one word: those between it and a still longer one occur as often at least.
    """
    grams = stored(ngram_counts(docs, longest, least, text, lang), "ngrams")
    found = stored(scored(grams, percent), "phrases")
    longer = found.where("size(words) > 2")
    size = F.size("words") - 1
    covered = longer.where("in_first").select("lang", F.slice("words", 1, size).alias("words")).unionByName(
        longer.where("in_rest").select("lang", F.slice("words", 2, size).alias("words"))
    )
    kept = found.join(covered.distinct(), ["lang", "words"], "left_anti")
    kept = kept.withColumn("phrase", F.array_join("words", " "))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # first within parts of a lang, so that no task sees more than LISTS lists of it
        part = F.pmod(F.xxhash64("phrase"), F.lit(LISTS)).alias("part")
        place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        kept = kept.select("*", part).withColumn("place", place).where(F.col("place") <= top)
    ranks = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranks = ranks.where(F.col("rank") <= top)
    return ranks.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
