"""Weighted acyclic automata over sequences of strings, as sorted arrays. No Spark in here.

An automaton accepts sequences of at most ``depth`` symbols. Its states are the prefixes of these, kept
level by level in the order of the sequences, so a state is a place in its level: ``parent`` is the
place of the state one symbol shorter, ``label`` the last symbol and ``weight`` how often the sequence
occurs. States that end a sequence need no arcs and are not kept apart.

Since levels are sorted, every range of sequences is a slice of each level. A slice that begins with
``cut`` may lack the states of the cut's own prefixes, which belong to an earlier slice; it carries
their weights as ``head``, so weights of all prefixes are known in every slice without another look-up.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Cut = tuple[str, ...]
_CODEC = "zstd"


def ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and the place of each of ``words`` among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


@dataclass
class Level:
    parent: np.ndarray
    label: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.label)


def _level(parent: np.ndarray, label: np.ndarray, weight: np.ndarray | None, size: int):
    """Equal arcs become one state whose weight is their sum; also where each arc went."""
    key, inverse, count = np.unique((parent + 1) * size + label, return_inverse=True, return_counts=True)
    if weight is not None:
        count = np.zeros(len(key), np.int64)
        np.add.at(count, inverse, weight)
    return Level(key // size - 1, key % size, count), inverse


@dataclass
class Automaton:
    words: pa.Array
    levels: list[Level]
    head: np.ndarray

    @classmethod
    def build(cls, words: pa.Array, places: list[np.ndarray], depth: int) -> Automaton:
        """From sequences: ``places[d]`` are the d-th symbols of those longer than d.

        ``places[d]`` names the symbol of every sequence, -1 where it has ended. Arcs of one level are
        numbered in sorted order, so each level's numbers serve the next as parents.
        """
        levels, parent, live = [], np.full(len(places[0]), -1, np.int64), np.arange(len(places[0]))
        for place in places[:depth]:
            on = place[live] >= 0
            live, parent = live[on], parent[on]
            level, parent = _level(parent, place[live], None, max(len(words), 1))
            levels.append(level)
        return cls(words, levels, np.zeros(0, np.int64))

    def children(self, d: int) -> np.ndarray:
        """Where the arcs of each state of level ``d`` begin in the next, and their end."""
        return np.searchsorted(self.levels[d + 1].parent, np.arange(len(self.levels[d]) + 1))

    def slices(self, cuts: list[Cut]) -> list[bytes | None]:
        """One automaton for each range between the cuts, packed; None where nothing is in it."""
        words = self.words.to_pylist()
        arcs = [self.children(d) for d in range(len(self.levels) - 1)]
        edges, heads = [[0] * len(self.levels)], [[]]
        for cut in cuts:
            edge, head = [], []
            place, exact, first, last = 0, True, 0, len(self.levels[0])
            for d, level in enumerate(self.levels):
                if d < len(cut):
                    place = first
                    if exact:
                        rank = bisect.bisect_left(words, cut[d])
                        place = first + int(np.searchsorted(level.label[first:last], rank))
                        exact = place < last and words[int(level.label[place])] == cut[d]
                    prefix = d < len(cut) - 1
                    if prefix:
                        head.append(int(level.weight[place]) if exact else 0)
                    edge.append(place + (prefix and exact))
                else:
                    place = first
                    edge.append(place)
                if d < len(arcs):
                    first = int(arcs[d][place])
                    last = int(arcs[d][place + 1]) if exact and d < len(cut) else first
            edges.append(edge)
            heads.append(head)
        edges.append([len(level) for level in self.levels])
        return [self._packed(low, high, head) for low, high, head in zip(edges, edges[1:], heads)]

    def _packed(self, low: list[int], high: list[int], head: list[int]) -> bytes | None:
        if low == high and not any(head):
            return None
        parts = [level.label[a:b] for level, a, b in zip(self.levels, low, high)]
        used, local = np.unique(np.concatenate(parts), return_inverse=True)
        names = self.words.take(pa.array(used)).cast(pa.large_binary())
        data = b"".join(names.to_pylist())
        lengths = pc.binary_length(names).to_numpy()
        sizes = np.diff([low, high], axis=0)[0]
        numbers = [np.array([len(head), len(self.levels), len(used), len(data), *sizes, *head], np.int64), lengths.astype(np.int32)]
        for d, (level, a, b) in enumerate(zip(self.levels, low, high)):
            parent = level.parent[a:b] - (low[d - 1] if d else 0)
            numbers.append(np.diff(parent, prepend=-1).astype(np.int32))
            numbers.append(level.weight[a:b])
        numbers.append(local.astype(np.int32))
        raw = b"".join([*(x.tobytes() for x in numbers), data])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, _CODEC, asbytes=True)

    @classmethod
    def unpacked(cls, blob: bytes) -> Automaton:
        raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), _CODEC, asbytes=True)
        at = 0

        def take(n: int, kind) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        n_head, n_levels, n_words, n_data = take(4, np.int64).tolist()
        sizes, head = take(n_levels, np.int64).tolist(), take(n_head, np.int64)
        offsets = np.concatenate([[0], np.cumsum(take(n_words, np.int32), dtype=np.int64)])
        arcs = [(np.cumsum(take(n, np.int32), dtype=np.int64) - 1, take(n, np.int64)) for n in sizes]
        labels = np.split(take(sum(sizes), np.int32).astype(np.int64), np.cumsum(sizes)[:-1])
        words = pa.LargeStringArray.from_buffers(n_words, pa.py_buffer(offsets), pa.py_buffer(raw[at : at + n_data]))
        return cls(words, [Level(p, label, w) for (p, w), label in zip(arcs, labels)], head)

    @classmethod
    def union(cls, automata: list[Automaton]) -> Automaton:
        """Sequences of all, weights summed. All are slices of one range."""
        words, place = ranked(pa.concat_arrays([a.words for a in automata]))
        offsets = np.cumsum([0, *(len(a.words) for a in automata)])
        levels: list[Level] = []
        parents = [np.zeros(0, np.int64)] * len(automata)
        for d in range(len(automata[0].levels)):
            mine = [a.levels[d] for a in automata]
            # a state whose parent lies before the range keeps -1: there is one such prefix only
            parent = [np.append(p, -1)[level.parent] for p, level in zip(parents, mine)]
            label = [place[o + level.label] for o, level in zip(offsets, mine)]
            weight = np.concatenate([level.weight for level in mine])
            level, inverse = _level(np.concatenate(parent), np.concatenate(label), weight, max(len(words), 1))
            levels.append(level)
            parents = np.split(inverse, np.cumsum([len(x) for x in mine])[:-1])
        return cls(words, levels, reduce(np.add, (a.head for a in automata)))

    def frequent(self, least: int, cut: Cut) -> list[list[tuple]]:
        """By level: ``(sequence, weight, weights of its proper prefixes)`` of the states of ``least`` or more.

        ``cut`` is where the range begins; the weights of its prefixes come from the head. A state's
        prefixes are as frequent as itself at least, so they are found in the list of the level before.
        """
        out: list[list[tuple]] = []
        known: dict[int, tuple] = {}
        for d, level in enumerate(self.levels):
            if 0 < d <= len(self.head):
                known[-1] = (cut[:d], int(self.head[d - 1]), tuple(self.head[: d - 1].tolist()))
            elif d == 0:
                known[-1] = ((), 0, ())
            chosen = np.flatnonzero(level.weight >= least) if d else np.arange(len(level))
            labels = self.words.take(pa.array(level.label[chosen])).to_pylist()
            now: dict[int, tuple] = {}
            for state, parent, label, weight in zip(chosen.tolist(), level.parent[chosen].tolist(), labels, level.weight[chosen].tolist()):
                sequence, above, path = known[parent]
                now[state] = (sequence + (label,), weight, path + (above,) if d else ())
            out.append(list(now.values()))
            known = now
        return out
