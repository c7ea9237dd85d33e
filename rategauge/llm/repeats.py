"""Repeated windows of tokens: which windows of a text also start anywhere else.

A text is a sequence of tokens (bytes or words); a window is ``width`` of them in a row. Inside every
window the k-gram of smallest hash (the leftmost of equal ones) is its anchor; equal windows have
equal anchors at equal places, so only windows of one anchor hash need comparing. The windows that
share an anchor place are a segment, at most ``width - k + 1`` of them, and a segment's context is all
the text they cover. So one row per segment stands for about a hundredth of the positions (bytes):

- a context that occurs twice: all windows of its segments are repeated;
- else, if other contexts have the same anchor hash, one segment of each distinct context is compared
  with the others of its anchor. The anchor is the prefix by which suffixes are dealt to groups: a task
  takes whole groups, a bounded number of tokens at a time, sorts the windows of their contexts and looks
  how far neighbours agree. A window that agrees with a neighbour over its whole width lies below an
  internal node at least that deep and is repeated.
- an anchor with more than ``GROUP`` contexts is no group of a task's size. Its prefix is lengthened to
  the whole window, so that each group is one node, and its leaves are counted.

Hashes are of 64 bits; within a group windows are compared by content. Segments are counted per task
before the shuffle; a hot anchor is one row per context afterwards, and the joins have one row per key
on one side. What leaves a group are runs of places.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rategauge.llm.arrays import BYTE, PIECE, pieces, signed, utf8, word_bounds, word_hashes
from rategauge.plans.scratch import stored

#: Contexts of one anchor that a task compares, and tokens that it compares at a time.
GROUP, TOKENS = 4096, 1 << 20
#: Windows that are hashed at a time; more than a segment has.
CHUNK = 1 << 18
GAPS = frozenset(b" \t\n\v\f\r")

_A, _B = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
KEY = ("id", "th")


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A
    x += b
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def window_hashes(values: np.ndarray, *widths: int) -> list[np.ndarray]:
    """Hashes of all windows of each width (ascending), built by doubling; empty if too short."""
    out, have, width = [], values, 1
    for wanted in widths:
        while 2 * width <= wanted and len(have) > width:
            have = _joined(have[:-width], have[width:])
            width *= 2
        gap = wanted - width
        if 2 * width < wanted or len(have) <= gap:
            out.append(np.zeros(0, np.uint64))
        else:
            out.append(_joined(have[: len(have) - gap], have[gap:]) if gap else have)
    return out


def leftmost_least(hashes: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest hash among ``span`` in a row, for each start."""
    place, width = np.arange(len(hashes)), 1
    least = hashes
    while width < span:
        step = min(width, span - width)
        left, right = least[:-step], least[step:]
        take = left <= right
        least = np.where(take, left, right)
        place = np.where(take, place[:-step], place[step:])
        width += step
    return place


@dataclass(frozen=True)
class Tokens:
    """What a window is made of; ``kind`` is how a token is kept where windows are compared."""

    width: int
    k: int
    kind: type
    values: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    strings: Callable[[str], list[bytes] | bytes]
    glue: bytes
    count: Callable[[Column], Column]
    digest: Callable[[Column], Column]


def repeated(values: np.ndarray, hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of the windows at ``starts`` equal another one.

    Windows are put in the order of their hashes, so equal ones are neighbours; neighbours of one hash
    are compared token by token. Should two different windows share a hash, those of that hash are
    sorted by their tokens.
    """
    out = np.zeros(len(starts), bool)
    keys = hashes[starts]
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    left, right = starts[order[same]], starts[order[same + 1]]
    agree = np.ones(len(same), bool)
    for k in range(width):
        agree &= values[left + k] == values[right + k]
    out[order[same[agree]]] = out[order[same[agree] + 1]] = True
    for key in np.unique(keys[order[same[~agree]]]):
        mine = np.flatnonzero(keys == key)
        whole = [values[s : s + width].tobytes() for s in starts[mine]]
        count = Counter(whole)
        out[mine] = [count[w] > 1 for w in whole]
    return out


def _wide(values: np.ndarray) -> np.ndarray:
    """Tokens as 64 bits each, to be hashed; bytes are kept as bytes until then."""
    return values if values.dtype == np.uint64 else BYTE[values]


def word_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``hashed_words``, about ``PIECE`` bytes at a time, cut in front of a gap."""
    raw, at = utf8(column)
    found, starts, low = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while low < len(raw):
        high = min(len(raw), low + PIECE)
        while high < len(raw) and raw[high] not in GAPS:
            high += 1
        begin, end = word_bounds(raw[low:high], np.clip(at - low, 0, high - low))
        found.append(word_hashes(raw[low:high], begin, end))
        starts.append(begin + low)
        low = high
    return np.concatenate(found), np.searchsorted(np.concatenate(starts), at)


def word_strings(text: str) -> list[bytes]:
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    starts, ends = word_bounds(raw, np.array([0, len(raw)]))
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def segments(column: pa.Array, tokens: Tokens) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays ``row, start, end, anchor hash, context hash`` of some segments at a time, places within rows.

    However long a text is, ``CHUNK`` windows are hashed at a time. The segment at a chunk's end may go on, so
    the next chunk begins with it; no segment depends on where chunks end.
    """
    values, at = tokens.values(column)
    n, low = len(values) - tokens.width + 1, 0
    while low < n:
        high = min(n, low + CHUNK)
        grams, windows = window_hashes(_wide(values[low : high + tokens.width - 1]), tokens.k, tokens.width)
        row = np.repeat(np.arange(len(at) - 1), np.diff(np.clip(at, low, high)))
        whole = np.arange(low, high) + tokens.width <= at[row + 1]
        place = leftmost_least(grams, tokens.width - tokens.k + 1)
        first, edge = whole.copy(), whole.copy()
        first[1:] &= ~whole[:-1] | (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        edge[:-1] &= first[1:] | ~whole[1:]
        begin, end = np.flatnonzero(first), np.flatnonzero(edge)
        done = high
        if high < n and len(end) and end[-1] == high - low - 1:
            done = low + int(begin[-1])
            begin, end = begin[:-1], end[:-1]
        shape = ((end - begin).astype(np.uint64) << np.uint64(32)) + (place[begin] - begin).astype(np.uint64)
        context = _joined(_joined(windows[begin], windows[end]), shape)
        mine = row[begin]
        yield mine, begin + low - at[mine], end + low - at[mine], grams[place[begin]], context
        low = done


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(id, th, text)``: rows equal in id and text have one key and one result."""
    t = F.coalesce(text, F.lit(""))
    own = F.coalesce(F.col(id).cast("long"), F.lit(-(1 << 63)))
    return docs.select(own.alias("id"), F.xxhash64(t).alias("th"), t.alias("text"))


def segment_table(source: DataFrame, tokens: Tokens) -> DataFrame:
    """``(h, c, id, th, s, e)``, one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for row, begin, end, h, c in segments(batch.column("text"), tokens):
                take = pa.array(row)
                columns = [pa.array(signed(h)), pa.array(signed(c)), batch.column("id").take(take), batch.column("th").take(take)]
                yield pa.record_batch([*columns, pa.array(begin), pa.array(end)], names=["h", "c", "id", "th", "s", "e"])

    return source.mapInArrow(run, "h long, c long, id long, th long, s long, e long")


def counted(rows: DataFrame) -> DataFrame:
    """``(h, c, n, rep)``: how often each context occurs, and the least hash of its places."""
    return rows.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(_place()).alias("rep"))


def _place() -> Column:
    return F.xxhash64("id", "th", "s")


def _compared(laid: DataFrame, tokens: Tokens) -> DataFrame:
    """``(id, th, first, last)``: runs of repeated windows, from contexts dealt by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, TOKENS * np.dtype(tokens.kind).itemsize):
            blobs = table.column("context").to_pylist()
            values = np.frombuffer(b"".join(blobs), tokens.kind)
            sizes = np.array([len(b) for b in blobs]) // values.itemsize
            begin = np.cumsum(sizes) - sizes
            counts = sizes - tokens.width + 1
            _, hashes = window_hashes(_wide(values), tokens.k, tokens.width)
            row = np.repeat(np.arange(len(sizes)), counts)
            step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            hit = repeated(values, hashes, begin[row] + step, tokens.width)
            edge = np.flatnonzero(hit)
            if not len(edge):
                continue
            cut = (np.diff(edge) > 1) | (np.diff(row[edge]) > 0)
            first, last = edge[np.concatenate([[True], cut])], edge[np.concatenate([cut, [True]])]
            place = table.column("s").to_numpy()[row[first]]
            take = pa.array(row[first])
            columns = [table.column(c).combine_chunks().take(take) for c in KEY]
            yield pa.record_batch([*columns, pa.array(place + step[first]), pa.array(place + step[last])], names=[*KEY, "first", "last"])

    dealt = laid.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "id long, th long, first long, last long")


def _whole_groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows of whole groups, in the order of ``h``, about ``size`` bytes of contexts at a time."""
    held: list[pa.RecordBatch] = []
    weight, last = 0, None
    for batch in batches:
        h = batch.column("h").to_numpy()
        if not len(h):
            continue
        weights = np.cumsum([0, *map(len, batch.column("context").to_pylist())])
        start = 0
        for cut in [*(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)]:
            if h[start] != last and weight + weights[start] >= size and held:
                yield pa.Table.from_batches(held)
                held, weight = [], -int(weights[start])
            held.append(batch.slice(start, cut - start))
            last, start = h[start], cut
        weight += int(weights[-1])
    if held:
        yield pa.Table.from_batches(held)


def removed(source: DataFrame, rows: DataFrame, groups: DataFrame, tokens: Tokens) -> DataFrame:
    """``(id, th, n, n_removed, n_spans, kept_sha256)`` of every distinct key of ``source``."""
    contexts = groups.groupBy("h").agg(F.count("*").alias("k"), F.max("n").alias("most")).where("k > 1 OR most > 1")
    status = groups.join(contexts.select("h", "k"), "h").where("k > 1 OR n > 1")
    more = F.col("k") > 1, F.col("k") > GROUP
    status = status.select("h", "c", (F.col("n") > 1).alias("dup"), *(x.alias(y) for x, y in zip(more, ("open", "wide"))), "rep")
    status = stored(status, "status")
    lay = F.col("open") & (_place() == F.col("rep"))
    mark = F.struct("s", "e", "dup", lay.alias("lay"), (lay & F.col("wide")).alias("wide"), F.when(lay, F.col("h")).alias("h"))
    marks = rows.join(status, ["h", "c"]).select(*KEY, mark.alias("m"))
    per_doc = marks.where("m.dup OR m.lay").groupBy(*KEY).agg(F.collect_list("m").alias("marks"))
    per_doc = stored(per_doc, "marks")
    marked = stored(source.join(per_doc, list(KEY)), "marked")

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One context for each segment: all tokens that its windows cover."""
        for batch in pieces(batches):
            values, at = tokens.values(batch.column("text"))
            which, starts, found, anchors = [], [], [], []
            for r, ranges in enumerate(batch.column("starts").to_pylist()):
                for m in ranges:
                    which.append(r)
                    starts.append(m["s"])
                    anchors.append(m["h"])
                    found.append(values[at[r] + m["s"] : at[r] + m["e"] + tokens.width].tobytes())
            take = pa.array(which, pa.int64())
            columns = [pa.array(anchors, pa.int64()), batch.column("id").take(take), batch.column("th").take(take)]
            yield pa.record_batch([*columns, pa.array(starts, pa.int64()), pa.array(found, pa.binary())], names=["h", "id", "th", "s", "context"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each window of the segments, with its hash as the longer prefix."""
        for batch in pieces(batches):
            values, at = tokens.values(batch.column("text"))
            for r, ranges in enumerate(batch.column("starts").to_pylist()):
                for m in ranges:
                    places = np.arange(m["s"], m["e"] + 1)
                    covered = values[at[r] + m["s"] : at[r] + m["e"] + tokens.width]
                    _, hashes = window_hashes(_wide(covered), tokens.k, tokens.width)
                    keys = [pa.array(np.full(len(places), v, np.int64)) for v in (m["h"], batch.column("id")[r].as_py(), batch.column("th")[r].as_py())]
                    yield pa.record_batch([*keys, pa.array(signed(hashes)), pa.array(places)], names=["h", "id", "th", "g", "pos"])

    def opened(wide: bool) -> DataFrame:
        mine = F.filter("marks", lambda m: m["lay"] & (m["wide"] == wide))
        out = marked.withColumn("starts", mine).where("size(starts) > 0")
        return out.dropDuplicates(list(KEY)).select(*KEY, "text", "starts")

    small = opened(False).mapInArrow(laid, "h long, id long, th long, s long, context binary")
    leaves = opened(True).mapInArrow(windows, "h long, id long, th long, g long, pos long")
    nodes = leaves.groupBy("h", "g").count().where("count > 1").select("h", "g")
    deep = leaves.join(nodes, ["h", "g"]).select(*KEY, F.col("pos").alias("first"), F.col("pos").alias("last"))
    runs = _compared(small, tokens).unionByName(deep)
    hits = runs.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("hits"))
    hits = stored(hits, "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            gone, spans, kept = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "dups", "hits"))
            for text, dups, hits in zip(*columns):
                strings = tokens.strings(text)
                edge = np.zeros(len(strings) + 1, np.int32)
                for m in dups:
                    edge[m["s"]] += 1
                    edge[m["e"] + tokens.width] -= 1
                for m in hits or []:
                    edge[m["first"]] += 1
                    edge[m["last"] + tokens.width] -= 1
                out = np.cumsum(edge, dtype=np.int32, out=edge)[:-1] > 0
                gone.append(int(out.sum()))
                spans.append(int((out[1:] & ~out[:-1]).sum() + out[:1].sum()))
                if isinstance(strings, bytes):
                    rest = np.frombuffer(strings, np.uint8)[~out].tobytes()
                else:
                    rest = tokens.glue.join([strings[i] for i in np.flatnonzero(~out).tolist()])
                kept.append(hashlib.sha256(rest).hexdigest())
            yield pa.record_batch(
                [batch.column("id"), batch.column("th"), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())],
                names=["id", "th", "n_removed", "n_spans", "kept"],
            )

    ready = marked.join(hits, list(KEY), "left").select(
        "id", "th", "text", F.filter("marks", lambda m: m["dup"]).alias("dups"), "hits"
    )
    results = ready.mapInArrow(cut, "id long, th long, n_removed long, n_spans long, kept string")
    results = results.dropDuplicates(list(KEY))
    every = source.select("id", "th", tokens.count(F.col("text")).alias("n"), tokens.digest(F.col("text")).alias("all"))
    zero = F.lit(0).cast("long")
    return every.join(results, list(KEY), "left").select(
        F.when(F.col("id") > -(1 << 63), F.col("id")).alias("id"),
        "n",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept", "all").alias("kept_sha256"),
    )
