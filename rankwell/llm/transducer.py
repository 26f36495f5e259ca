"""Weighted acyclic automata that map phrases of up to three words to counts, as flat arrays."""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

Key = tuple[str, str, str]


@dataclass
class Level:
    """Phrases of one length in ascending order: the place of what they extend in the level before, their last word,
    and their count. A count of 0 stands for a phrase that others extend and that is not counted itself."""

    parent: np.ndarray
    word: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.word)


@dataclass
class Grams:
    """Sorted phrases of one, two and three words over sorted words (an Arrow array)."""

    words: pa.Array
    levels: tuple[Level, Level, Level]

    @property
    def size(self) -> int:
        return sum(map(len, self.levels))

    def spelled(self, level: int, place: int) -> Key:
        """The words of a phrase, empty ones behind."""
        out = [""] * 3
        for k in range(level, -1, -1):
            out[k] = self.words[int(self.levels[k].word[place])].as_py()
            place = int(self.levels[k].parent[place])
        return tuple(out)

    def sliced(self, cuts: Sequence[Key]) -> Iterator[tuple[int, Grams]]:
        """The phrases from each cut up to the next (before the first cut: slice 0); empty slices are left out."""
        sizes = [len(level) for level in self.levels]
        edges = [[0, *[bisect_left(range(n), cut, key=lambda i, k=k: self.spelled(k, i)) for cut in cuts], n] for k, n in enumerate(sizes)]
        for number in range(len(cuts) + 1):
            spans = [(edge[number], edge[number + 1]) for edge in edges]
            if any(a < b for a, b in spans):
                yield number, self._slice(spans)

    def _slice(self, spans: list[tuple[int, int]]) -> Grams:
        """The phrases of a span of each level, with what they extend (count 0)."""
        held, need = [None] * 3, (0, 0)
        for k in (2, 1, 0):
            level, (a, b) = self.levels[k], spans[k]
            low, high = (a, b) if need[0] >= need[1] else need if a >= b else (min(a, need[0]), max(b, need[1]))
            inside = np.arange(low, high)
            held[k] = (low, Level(level.parent[low:high], level.word[low:high], np.where((inside >= a) & (inside < b), level.count[low:high], 0)))
            need = (int(level.parent[low]), int(level.parent[high - 1]) + 1) if k and low < high else (0, 0)
        used, levels = np.unique(np.concatenate([h[1].word for h in held])), []
        for k, (_, level) in enumerate(held):
            levels.append(Level(level.parent - held[k - 1][0] if k else level.parent, np.searchsorted(used, level.word), level.count))
        return Grams(self.words.take(pa.array(used)), tuple(levels))

    def pruned(self, least: int) -> Grams:
        """Without what occurs less often, but for what longer phrases extend."""
        kept: list[Level] = []
        wanted = np.zeros(0, bool)
        for k in (2, 1, 0):
            level = self.levels[k]
            keep = level.count >= least
            if k < 2:
                keep[self.levels[k + 1].parent[wanted]] = True
                place = np.cumsum(keep) - 1
                kept[0].parent = place[kept[0].parent]
            kept.insert(0, Level(level.parent[keep], level.word[keep], np.where(level.count[keep] >= least, level.count[keep], 0)))
            wanted = keep
        used = np.unique(np.concatenate([level.word for level in kept]))
        for level in kept:
            level.word = np.searchsorted(used, level.word)
        return Grams(self.words.take(pa.array(used)), tuple(kept))

    def phrases(self, level: int) -> tuple[list[pa.Array], np.ndarray]:
        """The words of all phrases of a level, one array a place, and their counts."""
        columns, place = [], np.arange(len(self.levels[level]))
        for k in range(level, -1, -1):
            columns.insert(0, self.words.take(pa.array(self.levels[k].word[place])))
            place = self.levels[k].parent[place]
        return columns, self.levels[level].count


def union(parts: Sequence[Grams]) -> Grams:
    """The phrases of all parts with their counts added up."""
    spelled = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    order = pc.sort_indices(spelled.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = rank[spelled.indices.to_numpy(zero_copy_only=False)]
    at = np.cumsum([0, *[len(p.words) for p in parts]])
    levels, inverse, n = [], np.zeros(0, np.int64), max(1, len(order))
    for k in range(3):
        begin = np.cumsum([0, *[len(p.levels[k - 1]) for p in parts]])
        word = np.concatenate([number[at[i] + p.levels[k].word] for i, p in enumerate(parts)])
        parent = np.concatenate([inverse[begin[i] + p.levels[k].parent] if k else p.levels[k].parent for i, p in enumerate(parts)]).astype(np.int64)
        keys, inverse = np.unique(parent * n + word, return_inverse=True)
        count = np.bincount(inverse, np.concatenate([p.levels[k].count for p in parts]), len(keys)).astype(np.int64)
        levels.append(Level(keys // n, keys % n, count))
    return Grams(spelled.dictionary.take(pa.array(order)), tuple(levels))


@dataclass
class Transducer:
    """States with arcs (word, count of the phrase up to there, next state) in ascending order of words. State 0 is
    the last one, which has none; the highest is the first. States with the same arcs are one state."""

    words: pa.Array
    begin: np.ndarray
    word: np.ndarray
    count: np.ndarray
    target: np.ndarray

    @property
    def start(self) -> int:
        return len(self.begin) - 2

    def to_bytes(self) -> bytes:
        arrays = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in (np.diff(self.begin), self.word, self.count, self.target)]
        return zstandard.compress(pickle.dumps([self.words.to_pylist(), *arrays], protocol=5), 1)

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        words, sizes, *arrays = pickle.loads(zstandard.decompress(data))
        return Transducer(pa.array(words, pa.large_string()), np.append(0, np.cumsum(sizes.astype(np.int64))), *[a.astype(np.int64) for a in arrays])

    def arcs_of(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of the states in a row, and for each the place of its state."""
        sizes = self.begin[states + 1] - self.begin[states]
        of = np.repeat(np.arange(len(states)), sizes)
        return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.begin[states], sizes), of

    def grams(self) -> Grams:
        """All phrases, in order."""
        levels, states = [], np.array([self.start])
        for _ in range(3):
            arcs, of = self.arcs_of(states)
            levels.append(Level(of if levels else np.zeros(len(arcs), np.int64), self.word[arcs], self.count[arcs]))
            states = self.target[arcs]
        return Grams(self.words, tuple(levels))

    def compose(self, asked: Grams) -> list[np.ndarray]:
        """Counts of the asked phrases, level by level; 0 where a phrase is not there.

        Both sides walk together: a pair of places goes on where arcs of both have the same word.
        """
        known = pc.index_in(asked.words, self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        n = len(self.words) + 1
        owner = np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))
        keys = owner * n + self.word
        out, states = [], np.zeros(0, np.int64)
        for k, level in enumerate(asked.levels):
            state = states[level.parent] if k else np.full(len(level), self.start)
            word = known[level.word] if len(level) else level.word
            want = state * n + word
            arc = np.minimum(np.searchsorted(keys, want), max(0, len(keys) - 1))
            met = (state >= 0) & (word >= 0) & (keys[arc] == want) if len(keys) else np.zeros(len(level), bool)
            out.append(np.where(met, self.count[arc], 0) if len(keys) else np.zeros(len(level), np.int64))
            states = np.where(met, self.target[arc], -1) if len(keys) else np.full(len(level), -1)
        return out


def build(grams: Grams) -> Transducer:
    """The least automaton of sorted phrases, from their ends: places with the same arcs become one state."""
    begin, words, counts, targets = [np.zeros(1, np.int64)], [], [], []
    states, total = np.zeros(len(grams.levels[2]), np.int64), 0
    made = 1  # state 0 has no arcs
    sizes: list[np.ndarray] = [np.zeros(1, np.int64)]
    for k in (2, 1, 0):
        level = grams.levels[k]
        above = len(grams.levels[k - 1]) if k else 1
        size = np.bincount(level.parent, minlength=above) if k else np.array([len(level)])
        first = np.cumsum(size) - size
        same, keep = _classes(size, first, np.stack([level.word, level.count, states])) if k else (np.zeros(1, np.int64), np.array([0]))
        arcs = np.repeat(first[keep] - np.cumsum(size[keep]) + size[keep], size[keep]) + np.arange(size[keep].sum())
        words.append(level.word[arcs])
        counts.append(level.count[arcs])
        targets.append(states[arcs])
        sizes.append(size[keep])
        states = np.where(size > 0, same + made, 0)
        made += len(keep)
        total += len(arcs)
    begin = np.append(0, np.cumsum(np.concatenate(sizes)))
    return Transducer(grams.words, begin, np.concatenate(words), np.concatenate(counts), np.concatenate(targets))


def _classes(size: np.ndarray, first: np.ndarray, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place with arcs the number of its class, and a place of each class. Places are brought together by size and
    a hash of their arcs, and are of one class if all their arcs are equal."""
    held = np.flatnonzero(size)
    same = np.full(len(size), -1, np.int64)
    if not len(held):
        return same, held
    mixed = np.zeros(arcs.shape[1], np.uint64)
    for row in arcs:
        mixed = (mixed ^ row.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    inside = np.arange(arcs.shape[1]) - np.repeat(first[held], size[held])
    hashes = np.add.reduceat(mixed * (2 * inside.astype(np.uint64) + np.uint64(1)), first[held])
    order = held[np.lexsort((hashes, size[held]))]
    sizes = size[order]
    ends = np.cumsum(sizes)
    sorted_arcs = arcs[:, np.repeat(first[order] - ends + sizes, sizes) + np.arange(ends[-1])]
    place = np.arange(ends[-1])
    before = place - np.repeat(sizes, sizes)
    equal = (sorted_arcs == sorted_arcs[:, np.maximum(before, 0)]).all(axis=0)
    new = ~np.logical_and.reduceat(equal, ends - sizes)
    new[0] = True
    new[1:] |= sizes[1:] != sizes[:-1]
    same[order] = np.cumsum(new) - 1
    return same, order[new]
