"""Keyed upserts with write-once columns, schema conformity, and table helpers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.sources.schemas import TableSpec


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """df in the columns of the table, in their order; missing or unexpected columns are an error that names both."""
    missing, unexpected = sorted(set(spec.columns) - set(df.columns)), sorted(set(df.columns) - set(spec.columns))
    if missing or unexpected:
        raise ValueError(f"{spec.name}: missing columns {missing}, unexpected columns {unexpected}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])


def last_wins(df: DataFrame, keys: list[str] | tuple[str, ...], order: str) -> DataFrame:
    """The last row of every key by `order`, which must tell the rows of a key apart: differing rows that share the
    last place are an error, for nothing says which of them came last, however often each is there. Rows that are
    wholly equal may repeat. A null order comes before all others.

    One aggregate: where rows lie, each key becomes its last row, the greatest and the least hash of the rows on that
    place, and these are merged, so the rows of a frequent key never meet in one task.
    """
    row, place = F.struct(*[df[c] for c in df.columns]), F.col(order)
    mark = F.xxhash64(*[df[c] for c in df.columns])
    last = df.groupBy(*keys).agg(
        F.max_by(row, F.struct(place.alias("at"), mark.alias("mark"))).alias("__row"),
        F.max(F.struct(place.alias("at"), mark.alias("mark")))["mark"].alias("__greatest"), F.max(F.struct(place.alias("at"), F.bitwise_not(mark).alias("mark")))["mark"].alias("__least"),
    )
    tied = F.col("__greatest") != F.bitwise_not(F.col("__least"))
    checked = F.when(tied, F.raise_error(F.lit(f"{order} does not tell the rows of {', '.join(keys)} apart")).cast("boolean")).otherwise(F.lit(True))
    return last.filter(checked).select(*[F.col("__row")[c].alias(c) for c in df.columns])


@dataclass(frozen=True)
class Upsert:
    """The merged table, with `__change` telling inserted, updated, known (arrived again, with nothing to update) and
    kept rows until `table` drops it.
    """

    merged: DataFrame
    batch: DataFrame

    @property
    def table(self) -> DataFrame:
        return self.merged.drop("__change")

    def counts(self) -> dict[str, int]:
        """Rows received, and keys written, inserted and updated: every distinct key of the batch is written, and is
        updated unless it was inserted, also where the table has nothing to update."""
        change = F.col("__change")
        row = self.merged.agg(F.count_if(change == "insert").alias("inserted"), F.count_if(change.isin("update", "known")).alias("updated")).first()
        return {"received": self.batch.count(), "written": row["inserted"] + row["updated"], "inserted": row["inserted"], "updated": row["updated"]}


def upsert(target: DataFrame, batch: DataFrame, spec: TableSpec, order: str) -> Upsert:
    """Merge a batch into a table by key.

    Within the batch the last row of a key wins, by `order` (a column of the batch that need not belong to the
    table). A known key has its updatable columns replaced and keeps the write-once ones; a new key is inserted;
    a table with nothing to update keeps its old rows. An empty batch changes nothing. One exchange by key on
    either side: the aggregate of the batch and the join share it.
    """
    new = last_wins(batch, spec.keys, order)
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in spec.keys]
    joined = target.withColumn("__old", F.lit(True)).alias("t").join(new.withColumn("__new", F.lit(True)).alias("b"), on, "full")
    old, arrived = F.col("__old").isNotNull(), F.col("__new").isNotNull()

    def pick(column: str):
        before, after = F.col(f"t.{column}"), F.col(f"b.{column}")
        if column in spec.updatable:
            return F.when(arrived, after).otherwise(before).alias(column)
        return F.when(old, before).otherwise(after).alias(column)

    change = F.when(~old, "insert").when(arrived, "update" if spec.updatable else "known").otherwise("keep")
    return Upsert(joined.select(*[pick(c) for c in spec.columns], change.alias("__change")), batch)


def materialize(df: DataFrame, name: str, layer: str, location: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """A staging model becomes a view, a mart a Parquet table at `location`."""
    if layer == "staging":
        df.createOrReplaceTempView(name)
        return df
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{location}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{location}/{name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
