"""SimHash near-duplicates: fingerprints, a Gray-order hierarchical index for links, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm.common import materialize
from rankwell.llm.components import connected_components

WORD = rb"[^\x20\x09-\x0d]+"
SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: The 64 bits in six runs. Two fingerprints that differ in 4 bits or fewer agree on two whole runs at least.
RUNS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: Fingerprints of one node of the index that are compared with each other directly.
LEAF = 32
#: Fingerprints of one masked pattern that one task takes; larger groups are cut and each pair of parts is a task's work.
PART = 2_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text: a bit is set if more than half the shingle hashes have it."""
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, spaced = xxhash.xxh64_intdigest, b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, size: at + 1 + size))
    begins = [0, *(at + 1 for at in ends)]
    hashes = np.fromiter((digest(spaced[a:b], SEED) for a, b in zip(begins[:n], ends[-n:], strict=True)), np.uint64, n)
    return _majority(hashes)


#: Lower-cases A-Z and turns the separators into spaces, byte by byte; bytes.split() would also cut at other controls.
_LOWER = bytes(32 if b in b"\x20\x09\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for part in np.array_split(hashes.astype("<u8"), max(1, len(hashes) // 4096)):
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint16)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """Per row: id and `fp`, the fingerprint as a signed long. Null and empty texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).mapInArrow(run, "id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence; neighbours in that order share most of their bits."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _groups(codes: np.ndarray, others: np.ndarray | None = None) -> np.ndarray:
    """Links (pairs of positions) within `codes`, or between `codes` and `others`, that span every set of fingerprints
    joined by MAX_BITS bits or fewer here: a link is left out only if others already connect its ends.

    The codes are sorted by Gray rank. A node of the index is a run of that order; its pattern is the mask of the
    bits that all its codes share, and their value. Two nodes whose shared bits differ in more than MAX_BITS places
    are passed over whole; otherwise the larger one is opened, down to leaves, whose codes are compared.
    """
    n = len(codes)
    both = codes if others is None else np.concatenate([codes, others])
    order = np.argsort(gray_rank(codes), kind="stable")
    right = order if others is None else n + np.argsort(gray_rank(others), kind="stable")
    parent = list(range(len(both)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links: list[tuple[int, int]] = []
    a_tree, b_tree = _Tree(both[order]), None if others is None else _Tree(both[right])
    stack = [(0, n, 0, n if b_tree is None else len(right))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        same = b_tree is None and (a0, a1) == (b0, b1)
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            left, rest = order[a0:a1], right[b0:b1]
            apart = np.bitwise_count(both[left][:, None] ^ both[rest][None, :])
            for i, j in np.argwhere(apart <= MAX_BITS):
                x, y = root(int(left[i])), root(int(rest[j]))
                if x != y:
                    parent[x] = y
                    links.append((int(left[i]), int(rest[j])))
            continue
        if not same and a_tree.apart(a0, a1, b_tree or a_tree, b0, b1) > MAX_BITS:
            continue
        if same:
            mid = (a0 + a1) // 2
            stack += [(a0, mid, a0, mid), (mid, a1, mid, a1), (a0, mid, mid, a1)]
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            stack += [(a0, mid, b0, b1), (mid, a1, b0, b1)]
        else:
            mid = (b0 + b1) // 2
            stack += [(a0, a1, b0, mid), (a0, a1, mid, b1)]
    return np.array(links, np.int64).reshape(-1, 2)


class _Tree:
    """Shared masked patterns of runs of a sorted array, each computed once."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.seen: dict[tuple[int, int], tuple[int, int]] = {}

    def pattern(self, a: int, b: int) -> tuple[int, int]:
        """The bits set in every code of the run, and the bits clear in every one."""
        found = self.seen.get((a, b))
        if found is None:
            part = self.codes[a:b]
            found = self.seen[a, b] = (int(np.bitwise_and.reduce(part)), ~int(np.bitwise_or.reduce(part)) & 0xFFFFFFFFFFFFFFFF)
        return found

    def apart(self, a0: int, a1: int, other: _Tree, b0: int, b1: int) -> int:
        ones, zeros = self.pattern(a0, a1)
        their_ones, their_zeros = other.pattern(b0, b1)
        return ((ones & their_zeros) | (zeros & their_ones)).bit_count()


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column `fp`) that differ in MAX_BITS bits or fewer.

    The upper level of the index is dealt by Spark: for each pair of the six bit runs, fingerprints with the same
    masked pattern on both runs form a group, and every link lies in some group. Within a group the Gray-order
    index finds the links; it returns enough of them to connect what is connected there. A group of more than
    PART fingerprints (many near copies of one text) is cut into parts by a hash, and each pair of parts becomes
    a group of its own, so no task meets a whole large group.
    """
    def run_value(start: int, width: int):
        return F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << width) - 1))

    tables = [
        F.struct(F.lit(t).alias("t"), (F.shiftleft(run_value(*RUNS[i]), 11) + run_value(*RUNS[j])).alias("key"))
        for t, (i, j) in enumerate((i, j) for i in range(6) for j in range(i + 1, 6))
    ]
    keyed = fps.select("fp", F.explode(F.array(*tables)).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").count().filter("count > 1")
    large = sizes.filter(F.col("count") > PART).select("t", "key", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    large = materialize(large)
    few = large.count() <= 10_000
    side = F.broadcast(large) if few else large
    split = keyed.join(side, ["t", "key"]).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    pairs = split.select("fp", "t", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o"))
    pairs = pairs.select("fp", "t", "key", F.least("part", "o").alias("x"), F.greatest("part", "o").alias("y"), (F.col("part") <= F.col("o")).cast("int").alias("side"))
    small = keyed.join(side, ["t", "key"], "left_anti").select("fp", "t", "key", F.lit(-1).alias("x"), F.lit(-1).alias("y"), F.lit(1).alias("side"))

    def link(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for frame in rows:
            frame = frame if tail is None else pd.concat([tail, frame], ignore_index=True)
            key = frame[["t", "key", "x", "y"]].to_numpy()
            edges = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            last = int(edges[-1]) if len(edges) else 0
            yield _link_runs(frame.iloc[:last], edges[:-1] if len(edges) else edges)
            tail = frame.iloc[last:]
        if tail is not None:
            yield _link_runs(tail, np.empty(0, np.int64))

    dealt = small.unionByName(pairs).repartition("t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y")
    return dealt.mapInPandas(link, "a long, b long").distinct()


def _link_runs(frame: pd.DataFrame, edges: np.ndarray) -> pd.DataFrame:
    fp, side, diagonal = frame["fp"].to_numpy().view(np.uint64), frame["side"].to_numpy(), (frame["x"] == frame["y"]).to_numpy()
    begins = np.concatenate([[0], edges]).astype(np.int64)
    ends = np.concatenate([edges, [len(frame)]]).astype(np.int64)
    out = []
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        if b - a < 2:
            continue
        if b - a == 2:
            if int(np.bitwise_count(fp[a] ^ fp[a + 1])) <= MAX_BITS:
                out.append(fp[a:b][None, :])
            continue
        codes = fp[a:b]
        if diagonal[a]:
            out.append(codes[_groups(codes)])
        else:
            one, two = codes[side[a:b] == 1], codes[side[a:b] == 0]
            out.append(np.concatenate([one, two])[_groups(one, two)])
    found = np.concatenate(out) if out else np.empty((0, 2), np.uint64)
    return pd.DataFrame({"a": found[:, 0].copy().view(np.int64), "b": found[:, 1].copy().view(np.int64)})


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """Per row: id, `fp` (signed long) and `component`, the smallest id reachable over links of MAX_BITS bits.

    Null and empty texts share fingerprint zero and so form one component with whatever lies near zero. Repeated
    rows stay repeated; rows with a null id keep their fingerprint and do not name a component unless all its ids
    are null. Copies meet in their fingerprint, which is aggregated before anything is compared, so a group of any
    size costs one row. Other columns are ignored; an empty table gives an empty one.
    """
    fps = materialize(fingerprints(df, text_col, id_col, shingle))
    distinct = fps.groupBy("fp").agg(F.min("id").alias("least"))
    # few bytes, but much work: dealt over all cores, which the size of the rows would not ask for
    cores = max(2 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    links = materialize(fingerprint_links(distinct.select("fp").repartition(cores, "fp")))
    classes = connected_components(links)
    named = classes.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("least"))
    linked = classes.join(named, "root").select("fp", "least")
    alone = distinct.join(classes, "fp", "left_anti").select("fp", "least")
    names = linked.unionByName(alone).select(F.col("fp").alias("f"), F.col("least").alias("component"))
    return fps.join(names, F.col("fp") == F.col("f")).select(F.col("id").alias(id_col), "fp", "component")


def op10_simhash_gray(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Near-duplicate classes of whole documents: doc_id, fingerprint (16 hex digits), component_id."""
    made = near_duplicates(docs)
    return made.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
