"""SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary and its scores are read from a model file and used as they are; the best cut of a text
is the one with the highest sum of scores (ties: the cut whose last pieces are longer). As in the
library, one blank is put before the text, and a character no piece covers becomes its UTF-8 bytes.
U+2581 in a piece means a blank; in a text it is a character like others that no piece covers, so
decoding gives back every text exactly.

The search keeps a window of nodes no longer than the longest piece. When the backpointer paths of
all nodes that can still be extended meet in one boundary, the ids before it are final: they are
given out and the window moves on. Memory is bounded by the distance between such boundaries, not by
the text. A boundary between two characters that stand side by side in no piece is one that all
paths meet in; text is cut there beforehand, and the ids of short segments between such cuts are kept
in a table of bounded size, since words repeat. A segment no longer than the first window needs no
such care and is searched at once.

Defined results: a null or empty text has no ids and decodes to the empty text; rows that repeat are
encoded each; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rategauge.llm.arrays import pieces

MARK = "\u2581"

CACHE_SEGMENTS = 200_000
CACHE_LENGTH = 48
BYTE_SCORE = -1.0e6


def _tree(score: dict[str, tuple[float, int]]) -> list:
    nodes: dict[str, list] = {"": [{}, 0.0, -1]}
    for piece, (value, i) in score.items():
        for k in range(1, len(piece) + 1):
            if piece[:k] not in nodes:
                nodes[piece[:k]] = [{}, 0.0, -1]
        nodes[piece][1:] = value, i
    for prefix, node in nodes.items():
        if prefix:
            nodes[prefix[:-1]][0][prefix[-1]] = node
    return nodes[""]


class Vocabulary:
    """Pieces of a model file: what stands for what, and at which score."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, tuple[float, int]] = {}
        self.byte = [0] * 256
        self.surface: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                shown = piece.replace(MARK, " ")
                self.surface.append(shown.encode())
                self.score[shown] = (max(model.get_score(i), BYTE_SCORE), i)
        #: The pieces as a tree of characters; a node is (children, score, id or -1).
        self.root = _tree(self.score)
        self.longest = max(map(len, self.score), default=1)
        inner = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        #: No piece goes on with a blank after another character.
        self.blank_cuts = all(pair[0] == " " for pair in inner if pair[1] == " ")


def viterbi(text: str, vocabulary: Vocabulary) -> Iterator[list[int]]:
    """Ids of the best cut, given out as soon as all surviving paths agree on them."""
    root, byte, longest = vocabulary.root, vocabulary.byte, vocabulary.longest
    nowhere = float("-inf")
    base, size = 0, len(text)  # where the window starts in the text
    check = base + 2 * longest
    room = min(size, 4 * longest) + longest + 1
    best = [0.0] + [nowhere] * room  # score of the cut that ends at base + k
    back = [0] * (room + 1)  # where its last step came from
    step: list[int] = [0] * (room + 1)  # and that step's id; -1: the bytes of one character

    def path(k: int) -> list[int]:
        ids: list[int] = []
        while k > 0:
            if step[k] >= 0:
                ids.append(step[k])
            else:
                ids.extend(byte[b] for b in reversed(text[base + k - 1].encode()))
            k = back[k]
        return ids[::-1]

    for start in range(size):
        k = start - base
        score = best[k]
        node, end = root, k
        for char in text[start : start + longest]:
            node = node[0].get(char)
            if node is None:
                break
            end += 1
            if node[2] >= 0 and score + node[1] > best[end]:
                best[end], back[end], step[end] = score + node[1], k, node[2]
        if best[k + 1] == nowhere:  # only the characters that no piece covers
            best[k + 1] = score + BYTE_SCORE * len(text[start].encode())
            back[k + 1], step[k + 1] = k, -1
        if start >= check:
            alive = {e for e in range(k + 1, k + 1 + longest) if best[e] > nowhere}
            while len(alive) > 1:
                latest = max(alive)
                alive.discard(latest)
                alive.add(back[latest])
            meet = alive.pop()
            if meet > 0:
                yield path(meet)
                base += meet
                best = [b - best[meet] for b in best[meet:]]
                back = [max(e - meet, 0) for e in back[meet:]]
                step = step[meet:]
            grow = 2 * longest + 2 * longest + 1 + (start + 1 - base) - len(best)
            if grow > 0:
                best += [nowhere] * grow
                back += [0] * grow
                step += [0] * grow
            check = start + longest
    yield path(size - base)


def short_viterbi(text: str, vocabulary: Vocabulary) -> list[int]:
    """:func:`viterbi` of a text that fits its first window: nothing is given out before the end."""
    root, nowhere, size = vocabulary.root, float("-inf"), len(text)
    best = [0.0] + [nowhere] * size
    back = [0] * (size + 1)
    step = [-1] * (size + 1)
    for k in range(size):
        score, end = best[k], k
        children = root[0]
        while end < size and (node := children.get(text[end])):
            children, value, piece = node
            end += 1
            if piece >= 0 and score + value > best[end]:
                best[end], back[end], step[end] = score + value, k, piece
        if best[k + 1] == nowhere:
            best[k + 1] = score + BYTE_SCORE * len(text[k].encode())
            back[k + 1] = k
    ids: list[int] = []
    while size > 0:
        if step[size] >= 0:
            ids.append(step[size])
        else:
            ids.extend(vocabulary.byte[b] for b in reversed(text[size - 1].encode()))
        size = back[size]
    return ids[::-1]


class Segments(dict[str, bytes]):
    """Packed ids by segment, made when first asked for.

    Of short segments a bounded number is kept, in two generations: when the newer one is full, the
    older one is forgotten except for what was asked for again meanwhile. So frequent words stay.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            if len(segment) <= 2 * self.vocabulary.longest:
                ids = array("i", short_viterbi(segment, self.vocabulary)).tobytes()
            else:
                ids = b"".join([array("i", part).tobytes() for part in viterbi(segment, self.vocabulary)])
        if len(segment) <= CACHE_LENGTH:
            if len(self) >= CACHE_SEGMENTS // 2:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids


class Codec:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.surfaces = pa.array(self.vocabulary.surface, pa.large_binary())
        self.cache = Segments(self.vocabulary)
        # Blanks go with the word behind them: pieces of several blanks exist.
        pattern = " *[^ ]+| +" if self.vocabulary.blank_cuts else "(?s).+"
        self.segments = re.compile(pattern)

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.cache.__getitem__, self.segments.findall(" " + text)))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.vocabulary.surface.__getitem__, ids))[1:].decode()

    def restores(self, ids: pa.ListArray, texts: list[str]) -> list[bool]:
        """Whether each list of ids decodes to its text; all surfaces are looked up at once."""
        found = self.surfaces.take(ids.flatten())
        _, places, data = found.buffers()
        at = np.frombuffer(places, np.int64)[np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])].tolist()
        whole = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(whole[a + 1 : b]) == t.encode() if b > a else not t for a, b, t in zip(at, at[1:], texts)]


@cache
def shared_codec(path: str) -> Codec:
    """One codec for all tasks of a Python worker: it is made once, and its table of segments stays."""
    return Codec(path)


def encoded(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_ids, ids, round_trip)`` of every row. ``model`` is a path every executor can read.

    ``round_trip`` says whether the ids decode to the same text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            codec = shared_codec(model)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            packed = [codec.encode(t) for t in texts]
            counts = np.array([len(p) // 4 for p in packed], np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.frombuffer(b"".join(packed), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            same = codec.restores(ids, texts)
            yield pa.record_batch(
                [batch.column("id"), pa.array(counts), ids, pa.array(same, pa.bool_())],
                names=["id", "n_ids", "ids", "round_trip"],
            )

    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, n_ids long, ids array<int>, round_trip boolean")
    return out.withColumnRenamed("id", id)


def decoded(rows: DataFrame, model: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(id, text)`` from ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(model)
        for batch in batches:
            texts = [codec.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    source = rows.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id)
