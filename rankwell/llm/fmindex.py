"""A bidirectional FM-index over a delimited list of words, and the search for words that are one edit away."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Places between two stored rows of rank counts, and states whose ranks are taken at once.
STEP, CHUNK = 64, 1 << 15
END, DELIMITER = 0, 1
Part = tuple[np.ndarray, np.ndarray]


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in their order, by doubling the length that is compared. The last code is the least."""
    n, rank, length = len(codes), codes.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-length or None] = rank[length:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0))
        if new[order[-1]] == n - 1:
            return order
        rank, length = new, 2 * length


class Strand:
    """The text in one direction: its suffixes, the code before each of them, and ranks of those codes."""

    def __init__(self, codes: np.ndarray, kinds: int):
        self.suffixes = suffix_array(codes)
        before, n = codes[self.suffixes - 1], len(codes)
        self.first = np.append(0, np.cumsum(np.bincount(codes, minlength=kinds)))[:kinds]
        rows = n // STEP + 1
        padded = np.full(rows * STEP, kinds, np.uint16)
        padded[:n] = before
        self.before = padded.reshape(rows, STEP)
        counts = np.bincount(np.arange(n) // STEP * kinds + before, minlength=rows * kinds).reshape(rows, kinds)
        self.equal = (np.cumsum(counts, axis=0) - counts).astype(np.int64)
        self.less = np.cumsum(self.equal, axis=1) - self.equal

    def _ranks(self, code: np.ndarray, place: np.ndarray) -> Part:
        """How many codes ahead of a place equal the given one, and how many are less."""
        equal, less = np.empty(len(code), np.int64), np.empty(len(code), np.int64)
        for at in range(0, len(code), CHUNK):
            c, (row, inside) = code[at : at + CHUNK], np.divmod(place[at : at + CHUNK], STEP)
            held, ahead = self.before[row], np.arange(STEP) < inside[:, None]
            equal[at : at + CHUNK] = self.equal[row, c] + ((held == c[:, None]) & ahead).sum(1)
            less[at : at + CHUNK] = self.less[row, c] + ((held < c[:, None]) & ahead).sum(1)
        return equal, less

    def extend(self, states: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states (low, size, low of the other strand, query) after one more code; those with no suffix left are gone."""
        low, size, other, query = states
        (equal, less), (to_equal, to_less) = self._ranks(code, low), self._ranks(code, low + size)
        made = np.stack([self.first[code] + equal, to_equal - equal, other + to_less - less, query])
        return made[:, made[1] > 0]

    def codes_ahead(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and code of every extension that may be there: by the codes in small intervals, or all codes."""
        kinds = len(self.first)
        few = np.flatnonzero(states[1] <= kinds)
        sizes = states[1, few]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        state = np.repeat(few, sizes)
        met = self.before.ravel()[states[0, state] + inside].astype(np.int64)
        many = np.flatnonzero(states[1] > kinds)
        pairs = np.unique(np.concatenate([state * kinds + met, (many[:, None] * kinds + np.arange(kinds)).ravel()]))
        state, code = np.divmod(pairs, kinds)
        letters = code > DELIMITER
        return state[letters], code[letters]


class Index:
    """Distinct words in ascending order, as one text with a delimiter around each."""

    def __init__(self, words: Sequence[str]):
        self.words = list(words)
        points = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.alphabet = np.unique(points)
        codes = np.ones(len(points) + len(sizes) + 2, np.int64)
        ends = np.cumsum(sizes + 1)
        self.starts = ends - sizes - 1
        held = np.ones(len(codes), bool)
        held[np.append(self.starts, ends[-1:] if len(ends) else 0)] = held[-1] = False
        codes[held] = np.searchsorted(self.alphabet, points) + 2
        codes[-1] = END
        kinds = len(self.alphabet) + 2
        self.left = Strand(codes, kinds)
        self.right = Strand(np.append(codes[-2::-1], END), kinds)

    def coded(self, text: str) -> np.ndarray:
        """Codes of the letters of a text; letters that no word has count as END, which never extends."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        place = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == points, place + 2, END)

    def near(self, queries: Sequence[str], side: str) -> Part:
        """Query and word of every pair with exactly one edit between them, where the word begins with the first half
        of the query (side `p`), or ends with its second half and does not begin with the first (side `s`).

        The half is matched exactly, outwards to its delimiter, and the other half in the other direction with
        one error; both by intervals of suffix ranks, kept for both strands. All queries move together.
        """
        if not self.words or not len(queries):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        halves = [(self.coded(q[: len(q) // 2])[::-1], self.coded(q[len(q) // 2 :])) for q in queries]
        exact, across = [h[side != "p"] for h in halves], [h[side == "p"] for h in halves]
        there, back = (self.left, self.right) if side == "p" else (self.right, self.left)
        number, n = np.arange(len(queries)), len(self.left.suffixes)
        zero = np.zeros(len(queries), np.int64)
        states = _matched(there, np.stack([zero, zero + n, zero, number]), _flat(exact))
        states = _crossed(back, states[[2, 1, 0, 3]], _flat(across))
        low = states[2] if side == "p" else states[0]
        word = np.searchsorted(self.starts, self.left.suffixes[low])
        query, word = np.divmod(np.unique(states[3] * len(self.words) + word), len(self.words))
        if side == "s":
            new = np.array([not self.words[w].startswith(queries[q][: len(queries[q]) // 2]) for q, w in zip(query.tolist(), word.tolist(), strict=True)], bool)
            query, word = query[new], word[new]
        return query, word


def _flat(parts: list[np.ndarray]) -> Part:
    """All parts in a row, each with a delimiter behind it, and where each begins."""
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    return np.concatenate([x for p in parts for x in (p, [DELIMITER])]), np.append(np.cumsum(sizes) - sizes, sizes.sum())


def _matched(strand: Strand, states: np.ndarray, parts: Part) -> np.ndarray:
    """The states whose whole part follows exactly."""
    codes, begin = parts
    done, step = [states[:, :0]], 0
    while states.shape[1]:
        over = begin[states[3]] + step == begin[states[3] + 1]
        done.append(states[:, over])
        states = states[:, ~over]
        states = strand.extend(states, codes[begin[states[3]] + step])
        step += 1
    return np.concatenate(done, axis=1)


def _crossed(strand: Strand, exact: np.ndarray, parts: Part) -> np.ndarray:
    """The states after the whole part with one letter more, less or other than the part has."""
    codes, begin = parts
    done, edited, step = [exact[:, :0]], exact[:, :0], 0
    while exact.shape[1] or edited.shape[1]:
        want = codes[begin[exact[3]] + step]
        last = want == DELIMITER
        state, letter = strand.codes_ahead(exact)
        # one letter more: the part goes on from the same place
        edited = np.concatenate([edited, strand.extend(exact[:, state], letter)], axis=1)
        wanted = codes[begin[edited[3]] + step]
        final = wanted == DELIMITER
        done.append(strand.extend(edited[:, final], wanted[final]))
        other = (letter != want[state]) & ~last[state]
        edited = np.concatenate([strand.extend(edited[:, ~final], wanted[~final]), exact[:, ~last], strand.extend(exact[:, state[other]], letter[other])], axis=1)
        exact = strand.extend(exact[:, ~last], want[~last])
        step += 1
        if step % 8 == 0 and edited.shape[1]:
            # an edit in a run of equal letters is the same wherever it lies
            order = np.lexsort(edited)
            edited = edited[:, order[np.append(True, (np.diff(edited[:, order], axis=1) != 0).any(axis=0))]]
    return np.concatenate(done, axis=1)
