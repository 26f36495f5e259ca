"""Helpers that several operators share: the shared folder, durable intermediates, ordered buckets."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@functools.cache
def _local_dir() -> str:
    base = tempfile.mkdtemp(prefix="rankwell-")
    atexit.register(shutil.rmtree, base, True)
    return base


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one (spark.checkpoint.dir).

    Where that setting is absent a temporary folder stands in on one machine, as in tests; on a cluster, whose
    machines share no such folder, its absence is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _local_dir()
    return f"{base.rstrip('/')}/rankwell-{uuid.uuid4().hex}"


def materialize(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write df as a table in the shared folder and read it back: a cut in the lineage that outlives executors."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(doc_id: Column) -> Column:
    """True for the rows that no classifier here learns from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def least_by_hash(df: DataFrame, h: Column, most: int, rows: int | None = None) -> DataFrame:
    """The `most` rows with the least 64-bit hash; `rows` is how many there are at least (counted, if not given).

    Of many more rows only those below a threshold, about twice as many as wanted, are brought together and sorted;
    should these not suffice, all are.
    """
    rows = df.count() if rows is None else rows
    if rows > 4 * most:
        near = df.filter(h < F.lit((2 * most << 64) // rows - (1 << 63)))
        df = near if near.limit(most).count() == most else df
    return df.orderBy(h).limit(most)


def split_points(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most `parts` - 1 ascending integers that cut a numeric column into ranges of about equal rows.

    One aggregate over a single column; what reaches the driver is bounded by `parts`, not by the rows.
    """
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    points = df.agg(F.percentile_approx(column, F.array(*map(F.lit, shares)), 20 * parts).alias("p")).first()["p"]
    return sorted({int(p) for p in points or []})


def bucket_of(column: str | Column, points: list[int]) -> Column:
    """Index of the range a value falls in: how many split points lie below it. Null goes to range 0."""
    value = F.col(column) if isinstance(column, str) else column
    tree = _search(value, points, 0, len(points)) if points else F.lit(0)
    return F.when(value.isNull(), F.lit(0)).otherwise(tree).cast("int")


def _search(value: Column, points: list[int], low: int, high: int) -> Column:
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(value <= F.lit(points[mid]), _search(value, points, low, mid)).otherwise(_search(value, points, mid + 1, high))
