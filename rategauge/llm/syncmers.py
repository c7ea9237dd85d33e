"""Fingerprints of documents from closed syncmers, and how alike two of them are.

A k-mer of code points is a closed syncmer if the smallest hash of its inner s-mers is that of the
first or the last one. Whether it is depends on the k-mer alone, not on what stands around it, so an
edit changes only the syncmers it touches; the others stay anchors. A fingerprint holds all closed
syncmers of the text, in its order, none left out; any k - s + 1 k-mers in a row hold one. In two
fingerprints the n-th place of an anchor in one text is matched with its n-th in the other, and the
longest chain of matches that stand in the same order in both counts, against all anchors of both. So an
insert, a cut or many small edits move what follows and lose nothing, while anchors that match by chance
or in another order do not count.

Shown, a fingerprint is base64 of one record per anchor, little-endian: 8 bytes of hash and one byte of
distance from the anchor before (from the start for the first), which is k - s + 1 at most.

Texts shorter than k are one anchor. Each document needs the text that follows it in descending id,
so rows are dealt by ranges of ids (and of text digests where ids are equal or null) of about
``RANGE_BYTES`` each, with a copy of the first row of the next range: texts are shuffled once. One cut and
one head per range reach the driver, as in Spark's own sort by ranges.

Defined results: a null or empty text has an empty fingerprint, which is like another empty one (1)
and unlike any other (0); equal texts have equal fingerprints; rows with equal ids follow each other
by the digest of their text; null ids come last; rows equal in id and text are in one range; an empty
table gives an empty result; columns other than id and text play no part.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rategauge.llm.arrays import BASE, mix, pieces, powers
from rategauge.llm.text import whole
from rategauge.plans.scratch import stored

K, S = 24, 12
#: Bytes of text in a range of ids, and keys sampled for each to place the cuts.
RANGE_BYTES, SAMPLES = 16 << 20, 100
#: Fingerprints given out at a time.
OUT_BYTES = 4 << 20

_RECORD = np.dtype([("hash", "<u8"), ("gap", "u1")])


def _hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` code points."""
    spread = mix(codes.astype(np.uint64) + BASE)
    out = np.zeros(len(codes) - width + 1, np.uint64)
    for k, p in enumerate(powers(BASE, width)):
        out += spread[k : len(codes) - width + 1 + k] * p
    return mix(out)


def closed_syncmers(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every closed syncmer."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(codes) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(codes) < k:
        return _hashes(codes, len(codes)), np.zeros(1, np.int64)
    inner = _hashes(codes, s)
    span = k - s + 1
    least = inner
    width = 1
    while width < span:  # minimum of growing windows
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    first, last = inner[: len(inner) - span + 1], inner[span - 1 :]
    at = np.flatnonzero((first == least) | (last == least))
    # the k-mer's hash from its two halves (k = 2 s)
    return mix(inner[at] * BASE ^ inner[at + k - s]), at


@dataclass(frozen=True)
class Fingerprint:
    """Hashes and places of all anchors in the order of the text."""

    hashes: np.ndarray
    places: np.ndarray

    def shown(self) -> str:
        records = np.empty(len(self.hashes), _RECORD)
        records["hash"], records["gap"] = self.hashes, np.diff(self.places, prepend=0)
        return base64.b64encode(records.tobytes()).decode()


def fingerprint(text: str) -> Fingerprint:
    return Fingerprint(*closed_syncmers(text))


def read_fingerprint(shown: str) -> Fingerprint:
    """The fingerprint that is shown so."""
    records = np.frombuffer(base64.b64decode(shown), _RECORD)
    return Fingerprint(records["hash"].copy(), np.cumsum(records["gap"], dtype=np.int64))


def _tokens(hashes: np.ndarray) -> np.ndarray:
    """One value for each occurrence of each hash: the n-th of a hash gives the same in every text."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    if first.all():
        return hashes
    starts = np.flatnonzero(first)
    nth = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.append(starts, len(ordered))))
    out = np.empty_like(hashes)
    out[order] = np.where(nth > 0, mix(ordered + BASE * nth.astype(np.uint64)), ordered)
    return out


def chain(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two sequences without repeats."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    ends: list[int] = []
    for place in j[np.argsort(i)].tolist():
        k = bisect.bisect_left(ends, place)
        ends[k : k + 1] = [place]
    return len(ends)


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Anchors on the longest chain, as a share of the anchors of both."""
    x, y = a.hashes, b.hashes
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = chain(_tokens(x), _tokens(y))
    return both / (len(x) + len(y) - both)


Key = tuple[bool, int, str]


def _key(no: bool, down: int | None, digest: str) -> Key:
    """Sorts as the rows do: larger ids first, null ids last, then by the text's digest."""
    return no, down or 0, digest


def _keys(batch: pa.RecordBatch) -> Iterator[Key]:
    return map(_key, *(batch.column(c).to_pylist() for c in ("no", "down", "digest")))


def _even(sample: list[tuple[Key, int]], parts: int) -> list[Key]:
    """Cuts that part the sampled bytes evenly."""
    upto = np.cumsum([size for _, size in sample])
    if not len(upto):
        return []
    at = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)
    return sorted({sample[min(k, len(sample) - 1)][0] for k in at.tolist()})


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of what follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``."""
    source = docs.select(F.col(id).cast("long").alias("id"), whole(text).alias("text"))
    order = [F.col("id").isNull().alias("no"), F.bitwise_not("id").alias("down"), F.sha2("text", 256).alias("digest")]
    keys = stored(source.select(*order, F.octet_length("text").cast("long").alias("size")), "keys")
    rows, total = keys.agg(F.count("*"), F.sum("size")).first()
    parts = max(1, -(-(total or 0) // RANGE_BYTES))
    cuts: list[Key] = []
    if parts > 1:
        sample = keys.sample(min(1.0, SAMPLES * parts / rows), seed=9).collect()
        cuts = _even(sorted((_key(*r[:3]), r.size) for r in sample), parts)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = [bisect.bisect_right(cuts, key) for key in _keys(batch)]
            yield batch.append_column("part", pa.array(of, pa.int32()))

    names = ["no", "down", "digest"]
    placed = keys.select(*names).mapInArrow(ranges, "no boolean, down long, digest string, part int")
    firsts = sorted((r.part, _key(*r.head)) for r in placed.groupBy("part").agg(F.min(F.struct(*names)).alias("head")).collect())
    before = {head: firsts[k - 1][0] for k, (_, head) in enumerate(firsts)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[Key] = set()  # rows equal to a head: one copy of each task is enough
        for batch in pieces(batches):
            found = list(_keys(batch))
            of = pa.array([bisect.bisect_right(cuts, key) for key in found], pa.int32())
            yield batch.append_column("part", of).append_column("copy", pa.array([False] * len(of)))
            heads = {key: k for k, key in enumerate(found) if key in before and key not in given}
            given |= heads.keys()
            if heads:
                to = pa.array([before[key] for key in heads], pa.int32())
                some = batch.take(pa.array(list(heads.values())))
                yield some.append_column("part", to).append_column("copy", pa.array([True] * len(to)))

    schema = "no boolean, down long, digest string, id long, text string, part int, copy boolean"
    table = source.select(*order, "id", "text").mapInArrow(dealt, schema).select("part", "copy", *names, "id", "text")
    table = table.repartitionById(parts, "part").sortWithinPartitions("part", "copy", *names)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        out: list[tuple] = []
        size = 0  # of the fingerprints in ``out``

        def close(row, following):
            nonlocal size
            (_, own, t, mark), (_, _, u, other) = row, following
            new = edited(t, u)
            changed = fingerprint(new)
            digest = hashlib.sha256(new.encode()).hexdigest()
            out.append((own, len(t), digest, mark.shown(), changed.shown(), likeness(mark, changed), likeness(mark, other)))
            size += len(out[-1][3]) + len(out[-1][4])

        def rows():
            for batch in pieces(batches):
                columns = (batch.column(c).to_pylist() for c in ("part", "copy", "id", "text"))
                yield from zip(*columns)

        done = None
        for of, copy, own, t in rows():
            if held and held[0] == of and done != of:
                now = (of, own, t, fingerprint(t))
                close(held, now)
                held = now
                if copy:  # the first row of the next range, once
                    done = of
            elif done != of:
                held = (of, own, t, fingerprint(t))
            if size >= OUT_BYTES:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return table.mapInArrow(compared, schema).withColumnRenamed("id", id)


_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)
