"""Approximate nearest neighbours by collision counting over query-centred windows of sorted projections."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankwell.llm.common import materialize

#: Projections, each with its own sorted array.
PROJECTIONS = 64
#: Share of the projections in which a vector must collide with the query to be verified.
THRESHOLD = 0.7
#: Half width of the first window over unit vectors, and the factor by which windows grow (virtual rehashing): the
#: first up to half width WIDE, where only close neighbours collide, then the second, where every step adds many.
FIRST, GROWTH, WIDE, SLOW_GROWTH = 0.025, 2.2, 0.12, 1.08
#: Verified vectors of a block at which a query stops there: this share of the block, and SPARE times the neighbours wanted.
VERIFY, SPARE = 0.05, 20
#: Vectors of one index block; queries that meet it in one task, at most and, where blocks are few, at least.
BLOCK, QUERIES, FEW_QUERIES = 16_384, 8_192, 256
#: Base buckets of a sorted projection (a byte each), which windows merge, and queries that find where to start.
BUCKETS, PILOT = 256, 16
#: How many times longer than its shortest vector the longest of an index may be, beyond which short vectors crowd.
RANGE = 1.25
SEED = 11


@functools.lru_cache(8)
def projections(dim: int) -> np.ndarray:
    """PROJECTIONS unit directions, orthogonal as far as the dimension allows."""
    draw = np.random.default_rng([SEED, dim])
    turns = [np.linalg.qr(draw.normal(size=(dim, dim)))[0] for _ in range(-(-PROJECTIONS // dim))]
    return np.concatenate(turns, axis=1)[:, :PROJECTIONS]


class Index:
    """Sorted projections of vectors of like lengths, for largest inner products.

    Vectors are divided by the longest length among them and given one more component that makes them unit
    vectors; queries are made unit vectors with a zero there. The nearest of those are the largest inner products.
    """

    def __init__(self, vectors: np.ndarray, longest: float):
        self.vectors = vectors
        scaled = vectors / longest
        rest = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(1)))
        self.longest = longest
        placed = np.column_stack([scaled, rest]) @ projections(vectors.shape[1] + 1)
        order = np.argsort(placed, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(placed, order, axis=0).T)
        self.bucket = np.empty((placed.shape[1], len(placed)), np.uint8)  # of each vector in each sorted array
        np.put_along_axis(self.bucket, order.T, self._bucket(np.arange(len(placed)))[None, :], axis=1)

    def _bucket(self, places: np.ndarray) -> np.ndarray:
        return (places * BUCKETS // len(self.vectors)).astype(np.uint8)

    def search(self, queries: np.ndarray, own: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the positions and inner products of its verified vectors; `own` has the positions left out.

        The first few queries start from the narrowest windows; the others from a little less than those ended with.
        """
        pilot, ended = self._search(queries[:PILOT], own[:PILOT], k, FIRST)
        if len(queries) <= PILOT:
            return pilot
        rest, _ = self._search(queries[PILOT:], own[PILOT:], k, max(FIRST, float(np.median(ended)) / SLOW_GROWTH**3))
        return pilot + rest

    def _search(self, queries: np.ndarray, own: list[np.ndarray], k: int, half: float) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """All windows of a query widen together by whole buckets of the sorted arrays around its own place.

        A vector collides where its bucket lies inside the window; one that collides in THRESHOLD of the projections
        is verified once. A query ends when k verified vectors lie within the radius that its windows stand for,
        when VERIFY of the block and SPARE times k more have been verified, or when its windows hold the whole block.
        Also returned: the half width at which each query ended.
        """
        n, m = len(self.vectors), len(self.sorted)
        lengths = np.sqrt((queries * queries).sum(1))
        # one product a query, for a row of a larger product may differ in its last bits with the rows beside it
        centres = np.stack([np.append(q / length, 0.0) @ projections(len(q) + 1) for q, length in zip(queries, lengths, strict=True)])
        verified = [np.zeros(n, bool) for _ in own]
        for marks, rows in zip(verified, own, strict=True):
            marks[rows] = True
        found: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in queries]
        scores: list[list[np.ndarray]] = [[np.empty(0)] for _ in queries]
        total, ended = np.zeros(len(queries), np.int64), np.zeros(len(queries))
        need, most = int(np.ceil(THRESHOLD * m)), SPARE * k + int(VERIFY * n)
        active = np.arange(len(queries))
        offset, inside = np.empty((m, n), np.uint8), np.empty((m, n), bool)
        while len(active):
            low = np.stack([np.searchsorted(self.sorted[i], centres[active, i] - half) for i in range(m)], axis=1)
            high = np.stack([np.searchsorted(self.sorted[i], centres[active, i] + half, "right") for i in range(m)], axis=1)
            empty = low == high
            first = self._bucket(np.minimum(low, n - 1))
            width = self._bucket(np.maximum(high - 1, 0)) - first
            still = []
            for row, q in enumerate(active.tolist()):
                # buckets below the window wrap around and are far above its width
                np.add(self.bucket, -first[row][:, None], out=offset)
                np.less_equal(offset, width[row][:, None], out=inside)
                if empty[row].any():
                    inside[empty[row]] = False
                counts = np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)
                hit = np.flatnonzero((counts >= need) & ~verified[q])
                if len(hit):
                    verified[q][hit] = True
                    found[q].append(hit)
                    scores[q].append(self.vectors[hit] @ queries[q])
                    total[q] += len(hit)
                ended[q] = half
                if total[q] >= most or (high[row] - low[row]).min() == n:
                    continue
                if total[q] >= k:
                    best = np.partition(np.concatenate(scores[q]), -k)[-k]
                    # distance between unit vectors, against the spread of projections inside the windows
                    near = np.sqrt(max(0.0, 2 - 2 * best / (self.longest * lengths[q])))
                    if near <= half * np.sqrt(queries.shape[1] + 1) / GROWTH:
                        continue
                still.append(q)
            active = np.array(still, np.int64)
            half *= GROWTH if half < WIDE else SLOW_GROWTH
        return [(np.concatenate(f), np.concatenate(s)) for f, s in zip(found, scores, strict=True)], ended


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    """Lengths of vectors that are not zero, also where squares of their components are too small or large."""
    largest = np.abs(vectors).max(1)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(1))


def length_ranges(lengths: np.ndarray, least: int) -> list[np.ndarray]:
    """Positions of vectors by ranges of their length, longest first: RANGE wide, or of `least` vectors where few are."""
    order, at, ranges = np.argsort(-lengths, kind="stable"), 0, []
    while at < len(order):
        like = int(np.searchsorted(-lengths[order], -lengths[order[at]] / RANGE, "right"))
        stop = max(like, at + least)
        ranges.append(np.sort(order[at:stop]))
        at = stop
    return ranges


def search_ranges(vectors: np.ndarray, queries: np.ndarray, own: list[np.ndarray], k: int, exact: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and inner products of the verified vectors of each query, from one index for each range of lengths.

    Ranges of no more vectors than a query may verify anyway are verified whole, and so are all with `exact`. A query leaves a range out if none
    of its vectors is long enough to be among the k best found so far.
    """
    lengths, asked = lengths_of(vectors), lengths_of(queries)
    found = [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
    for rows in length_ranges(lengths, SPARE * k):
        longest = float(lengths[rows].max()) * (1 + 1e-9)
        open_ = [q for q, (_, scores) in enumerate(found) if len(scores) < k or np.partition(scores, -k)[-k] <= longest * asked[q] * (1 + 1e-9)]
        if not open_:
            continue
        left_out = [np.flatnonzero(np.isin(rows, own[q])) for q in open_]
        if exact or len(rows) <= SPARE * k:
            made = [(kept := np.delete(np.arange(len(rows)), out), (vectors[rows[kept]] * queries[q]).sum(1)) for q, out in zip(open_, left_out, strict=True)]
        else:
            made = Index(vectors[rows], longest).search(queries[open_], left_out, k)
        for q, (at, scores) in zip(open_, made, strict=True):
            found[q] = (np.append(found[q][0], rows[at]), np.append(found[q][1], scores))
    return found


def _search_block(k: int, counts: bool, exact: bool):
    names = ["query_id", "vec_id", "score", *["verified"] * counts]

    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "verified": []}).astype({"query_id": "int64", "vec_id": "int64", "verified": "int64"})[names]
        if vectors.empty or queries.empty:
            return empty
        vectors = vectors.sort_values("vec_id", kind="stable")
        ids = vectors["vec_id"].to_numpy()
        asked = queries["vec_id"].to_numpy()
        own = [np.flatnonzero(ids == query_id) for query_id in asked]
        out = []
        held, asked_for = (np.stack(rows["v"].to_numpy()).astype(np.float64) for rows in (vectors, queries))
        made = search_ranges(held, asked_for, own, k, exact)
        for query_id, query, (rows, scores) in zip(asked, asked_for, made, strict=True):
            # products of many rows at once may differ in their last bits, so what is near the k best is computed singly
            number, scale = len(rows), np.abs(scores).max(initial=0.0)
            if number > k:
                rows = rows[scores >= np.partition(scores, -k)[-k] - 1e-9 * scale]
            scores = (held[rows] * query).sum(1)
            best = np.lexsort([ids[rows], -scores])[:k]
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[rows[best]], "score": scores[best], "verified": np.where(np.arange(len(best)) == 0, number, 0)}))
        return pd.concat(out, ignore_index=True)[names] if out else empty

    return run


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, every component a finite number, not all zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(df: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", counts: bool = False, exact: bool = False) -> DataFrame:
    """The k largest inner products found for every query row, nearest first: query_id, rank, vec_id, score; with
    `counts` also how many vectors were verified for the query. With `exact` every candidate is verified whose length
    does not rule it out, so that none is missed.

    Every usable row is indexed; rows with the query's id are not its candidates. Repeated rows (same id, same
    vector) count once; rows with a null id or an unusable vector take no part; different vectors of one id are
    queries of one ranking, in which an id may come once for each of its vectors; vectors meet those of their own
    length only. Ties go to the smaller id. Other columns are ignored, an empty table gives an empty one. The
    blocks are dealt by a hash of the id, so copies of one vector spread over all of them; each task holds one
    block and one batch of queries, with one index for each range of lengths, and each query leaves k rows a block.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), queries.alias("asks"))
    rows = materialize(rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v")).dropDuplicates(["vec_id", "v"]))
    shape = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    n, asked = shape[0] or 0, shape[1] or 0
    blocks = max(1, -(-n // BLOCK))
    # a block is copied once for each batch of queries, so batches are large unless cores would stand idle
    spread = -(-4 * df.sparkSession.sparkContext.defaultParallelism // blocks)
    batches = max(1, -(-asked // QUERIES), min(spread, -(-asked // FEW_QUERIES)))
    number = lambda count: F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.select("vec_id", "v", "dim", number(blocks).alias("block"), every(batches).alias("batch"))
    right = rows.filter("asks").select("vec_id", "v", "dim", number(batches).alias("batch"), every(blocks).alias("block"))
    keys = ("dim", "block", "batch")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search_block(k, counts, exact), "query_id long, vec_id long, score double" + ", verified long" * counts)
    columns = ["query_id", "rank", "vec_id", "score"]
    if counts:
        found, columns = found.withColumn("verified", F.sum("verified").over(W.partitionBy("query_id"))), [*columns, "verified"]
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*columns)


def op2_collision_ann(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """The 20 nearest found of every row whose vec_id is divisible by 20: query_id, rank, vec_id, score."""
    return search(embeddings, F.col("vec_id") % 20 == 0)
