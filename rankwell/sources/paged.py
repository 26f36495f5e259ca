"""Tables stored in the order of an id, with the bounds of each file beside them, so that a page opens the files it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankwell.operators.incremental import page_below
from rankwell.operators.relational import walk_bounds

#: Rows of a file, about.
FILE_ROWS = 1_000_000


def write_by_id(df: DataFrame, id_col: str, path: str, file_rows: int = FILE_ROWS) -> None:
    """df in files of about `file_rows` rows by ranges of the id, sorted within, and one row a file of its least and
    greatest id and its rows. Rows with a null id are on no page; they are stored and left out of the bounds."""
    files = max(1, -(-df.count() // file_rows))
    df.repartitionByRange(files, id_col).sortWithinPartitions(id_col).write.parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows").select(id_col, F.col("_metadata.file_name").alias("file"))
    bounds = stored.filter(F.col(id_col).isNotNull()).groupBy("file").agg(F.min(id_col).alias("low"), F.max(id_col).alias("high"), F.count(F.lit(1)).alias("rows"))
    bounds.write.parquet(f"{path}/bounds")


def stored_below(spark: SparkSession, path: str, id_col: str, cursor: int | None, size: int) -> DataFrame:
    """The rows of the files that can hold the `size` greatest ids below the cursor (from the top, without one).

    Files are taken from the greatest id down until those wholly below the cursor hold enough rows; what is looked
    at is one row a file, and what reaches the driver are the names of the files that are opened.
    """
    bounds = spark.read.parquet(f"{path}/bounds")
    if cursor is not None:
        bounds = bounds.filter(F.col("low") < cursor)
    whole = F.lit(True) if cursor is None else F.col("high") < cursor
    # files that share a least id are taken or left together
    above = W.orderBy(F.desc("high")).rangeBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(whole, F.col("rows")).otherwise(0)).over(above), F.lit(0))
    names = [r["file"] for r in bounds.withColumn("before", before).filter(F.col("before") < size).select("file").collect()]
    rows = spark.read.parquet(f"{path}/rows")
    return spark.read.schema(rows.schema).parquet(*[f"{path}/rows/{n}" for n in names]) if names else rows.limit(0)


def stored_page(spark: SparkSession, path: str, id_col: str, cursor: int | None, size: int) -> DataFrame:
    """`page_below` of a table stored by `write_by_id`."""
    return page_below(stored_below(spark, path, id_col, cursor, size), id_col, cursor, size)


def stored_bounds(spark: SparkSession, path: str, id_col: str, cursor: int | None, size: int, high: int | None = None) -> DataFrame:
    """`walk_bounds` of a stored page."""
    return walk_bounds(stored_page(spark, path, id_col, cursor, size), id_col, high)
