"""Simple-8b word-aligned coding of token ids, with numpy over whole batches.

A 64-bit word holds a 4-bit selector and up to 60 bits of payload. The selector says how many ids share the
word and how many bits each takes. Ids are cut into blocks of BLOCK ids; each block starts on a word, its word
offset is stored, so that blocks decode independently and all words of one selector decode as one array
operation. An id that needs more than 60 bits is an escape: zero in its word, and (position, id) in a list.
"""

from __future__ import annotations

import struct

import numpy as np

#: Selector table (fixed values of the coding): ids in a word, bits of each.
COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
BITS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BLOCK = 512
MAGIC = b"S8B1"
_LIMIT = np.uint64(1) << np.uint64(60)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs, 0 for zero; exact for the ids below 2**53, which are split before the logarithm."""
    high = (ids >> np.uint64(32)).astype(np.float64)
    low = (ids & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (uint64), word offset of each block (int64, one more than blocks), escape positions, escaped ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    at = np.flatnonzero(ids >= _LIMIT)
    escaped = ids[at]
    if len(at):
        ids = ids.copy()
        ids[at] = 0
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.empty(0, np.uint64), np.zeros(1, np.int64), at, escaped
    pad = int(COUNTS[-1])
    grid = np.zeros((blocks, BLOCK + pad), np.uint64)
    grid[:, :BLOCK].flat[:n] = ids  # zeros fill the last words; the reader knows how many ids a block has
    bits = _widths(grid.ravel()).reshape(grid.shape)
    selector = np.zeros((blocks, BLOCK), np.uint8)
    widest, span = bits, 1
    for k, (count, width) in enumerate(zip(COUNTS.tolist(), BITS.tolist(), strict=True)):
        while span < count:  # widest[i] is the largest width among ids i .. i + span - 1
            step = min(span, count - span)
            shifted = widest[:, step:]
            widest = np.maximum(widest[:, : shifted.shape[1]], shifted)
            span += step
        selector[widest[:, :BLOCK] <= width] = k
    jump = COUNTS[selector]
    lengths = np.full(blocks, BLOCK)
    lengths[-1] = n - (blocks - 1) * BLOCK
    starts = np.zeros((blocks, BLOCK), bool)
    row, here = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(row):  # all blocks advance together, one word a step
        starts[row, here] = True
        here = here + jump[row, here]
        live = here < lengths[row]
        row, here = row[live], here[live]
    block, column = np.nonzero(starts)
    chosen = selector[block, column]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat, begin = grid.ravel(), block * (BLOCK + pad) + column
    for k in np.unique(chosen):
        mine = np.flatnonzero(chosen == k)
        first, word, width = begin[mine], words[mine], np.uint64(BITS[k])
        for j in range(int(COUNTS[k])):
            word |= flat[first + j] << (width * np.uint64(j))
        words[mine] = word
    offsets = np.concatenate([[0], np.cumsum(starts.sum(1))]).astype(np.int64)
    return words, offsets, at, escaped


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, at: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """The ids that `pack` was given, as uint64."""
    out = np.zeros(n + int(COUNTS[-1]), np.uint64)
    if n:
        selector = (words >> np.uint64(60)).astype(np.int64)
        count = COUNTS[selector]
        total = np.concatenate([[0], np.cumsum(count)])
        block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        first = total[:-1] - total[offsets[:-1]][block] + block * BLOCK
        order = np.argsort(selector, kind="stable")
        edges = np.searchsorted(selector[order], np.arange(len(COUNTS) + 1))
        room = np.minimum(count, np.minimum((block + 1) * BLOCK, n) - first)
        for k in range(len(COUNTS)):
            mine = order[edges[k] : edges[k + 1]]
            if not len(mine):
                continue
            word, start, width = words[mine], first[mine], np.uint64(BITS[k])
            mask = (np.uint64(1) << width) - np.uint64(1)
            for j in range(int(COUNTS[k])):
                value = (word >> (width * np.uint64(j))) & mask
                fits = room[mine] > j
                out[start[fits] + j] = value[fits]
    out = out[:n]
    out[at] = escaped
    return out


def to_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment of the file: header, documents and their id counts, block offsets, escapes, words."""
    words, offsets, at, escaped = pack(ids)
    head = MAGIC + struct.pack("<5q", len(doc_ids), len(ids), len(offsets), len(at), len(words))
    parts = (doc_ids.astype("<i8"), lengths.astype("<i8"), offsets.astype("<i8"), at.astype("<i8"), escaped.astype("<u8"), words.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts)


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, their id counts and all ids of a segment."""
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    docs, n, n_offsets, n_escaped, n_words = struct.unpack_from("<5q", data, 4)
    at, arrays = 44, []
    for size, kind in ((docs, "<i8"), (docs, "<i8"), (n_offsets, "<i8"), (n_escaped, "<i8"), (n_escaped, "<u8"), (n_words, "<u8")):
        arrays.append(np.frombuffer(data, kind, size, at))
        at += 8 * size
    doc_ids, lengths, offsets, places, escaped, words = arrays
    return doc_ids, lengths, unpack(words, offsets, n, places, escaped)
