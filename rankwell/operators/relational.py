"""Joins, aggregations, windows and unions of the models, parameterised by columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwell.sources.scratch import scratch_dir

#: Rows up to which a decision table is broadcast.
SEED_ROWS = 10_000
#: Actions of a veto that bring a map into play.
PICKS = ("pick", "decider")
#: Accuracy of approximate quantiles: their place is off by one part in this many of the rows, at most.
ACCURACY = 10_000
#: Rows of a partition up to which one task counts through it.
LARGEST = 1_000_000


def attach(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str], take: Sequence[str] | Mapping[str, str], how: str = "left", narrow: bool = False) -> DataFrame:
    """left with some columns of right (renamed, if a mapping), joined by equality; right is narrowed first.

    With `narrow`, right is hashed in its partitions: left, however wide, is neither sorted nor is right broadcast, whose
    rows the planner underrates where they are unfolded from arrays.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    taken = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    side = right.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(pairs.values())], *[F.col(c).alias(n) for c, n in taken.items()])
    condition = [left[k] == side[f"__k{i}"] for i, k in enumerate(pairs)]
    side = side.hint("shuffle_hash") if narrow else side
    return left.join(side, condition, how).drop(*[f"__k{i}" for i in range(len(pairs))])


def attach_one(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str], take: Sequence[str] | Mapping[str, str], matches: str | None = None, narrow: bool = False) -> DataFrame:
    """`attach` to at most one row of right: the rows of left stay as many as they are.

    Right is aggregated by its key first, in the exchange that the join needs anyway. A key that meets several rows
    of right is an error; with `matches`, a column of that name tells how many were met (0 for none), and the least of
    them is taken. Repeated keys of right that nothing asks for do no harm; null keys meet nothing. `narrow` is that
    of `attach`.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    taken = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    keys, columns = list(dict.fromkeys(pairs.values())), [F.col(c).alias(n) for c, n in taken.items()]
    one = right.dropna(subset=keys).groupBy(*keys).agg(F.min(F.struct(*columns)).alias("__one"), F.count(F.lit(1)).alias("__met"))
    joined = attach(left, one, pairs, ["__one", "__met"], narrow=narrow)
    several = F.when(F.col("__met") > 1, F.raise_error(F.concat(F.lit(f"several rows for one {', '.join(keys)}: "), F.col("__met").cast("string"))).cast("long"))
    met = F.coalesce("__met", F.lit(0)).alias(matches) if matches else F.coalesce(several, F.col("__met")).alias("__met")
    rows = joined.select(*[c for c in left.columns if c not in taken.values()], *[F.col("__one")[n].alias(n) for n in taken.values()], met)
    return rows if matches else rows.filter(F.col("__met").isNull() | (F.col("__met") == 1)).drop("__met")


def attach_tier(df: DataFrame, seed: DataFrame, on: Mapping[str, str] | Sequence[str], take: Sequence[str] = ("tier_rank", "tier_label")) -> DataFrame:
    """Left join to a decision table, broadcast while it is small; its size is looked at first."""
    small = seed.limit(SEED_ROWS + 1).count() <= SEED_ROWS
    return attach(df, F.broadcast(seed) if small else seed, on, take)


def pick_per_map(veto: DataFrame, keys: Sequence[str], action: str = "action", team: str = "team", actions: Sequence[str] = PICKS) -> DataFrame:
    """One row per map with the least action and, independently, the least team, so that a join cannot fan out."""
    return veto.filter(F.col(action).isin(*actions)).groupBy(*keys).agg(F.min(action).alias(action), F.min(team).alias(team))


def count_filtered(df: DataFrame, keys: Sequence[str], **tests: Column) -> DataFrame:
    """Per group, how many rows pass each test."""
    return df.groupBy(*keys).agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def duplicates(df: DataFrame, keys: Sequence[str], count: str = "occurrences") -> DataFrame:
    """Key values that occur more than once, null keys as one value, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def unknown_tiers(tournaments: DataFrame, discipline: str = "discipline", tier: str = "tier_key", label: str = "tier_label") -> DataFrame:
    """Tiers that are present but not in the seed, with their count."""
    return tournaments.filter(F.col(tier).isNotNull() & F.col(label).isNull()).groupBy(discipline, tier).agg(F.count(F.lit(1)).alias("tournaments"))


def tier_profile(df: DataFrame, rank: str = "tier_rank", value: str = "prize_pool_usd", exact: bool = True) -> DataFrame:
    """Rows and median value per rank; `exact=False` takes the approximate median, of one pass over the rows.

    The exact one takes two: approximate quantiles close to the middle enclose the median, then only the values
    between them, some thousandths of the rows, are counted by value and sorted. Ranks without values have none.
    """
    rows = df.select(F.col(rank).alias("__rank"), F.col(value).cast("double").alias("__v"))
    count = F.count(F.lit(1)).alias("n")
    if not exact:
        return rows.groupBy("__rank").agg(count, F.percentile_approx("__v", 0.5, ACCURACY).alias("median_value")).withColumnRenamed("__rank", rank)
    near = F.percentile_approx("__v", F.array(F.lit(0.5 - 10 / ACCURACY), F.lit(0.5 + 10 / ACCURACY)), ACCURACY)
    bounds = rows.groupBy("__rank").agg(count, F.count("__v").alias("m"), near.alias("near"))
    few = bounds.limit(SEED_ROWS + 1).collect()
    if len(few) <= SEED_ROWS:
        bounds = F.broadcast(df.sparkSession.createDataFrame(few, bounds.schema))
    sides = bounds.select(F.col("__rank").alias("__r"), "m", F.col("near")[0].alias("low"), F.col("near")[1].alias("high"))
    inside = rows.join(sides, F.col("__rank").eqNullSafe(F.col("__r"))).filter(F.col("__v") <= F.col("high"))
    # all that lies below is one row a rank, without a value
    counted = inside.groupBy("__rank", "m", F.when(F.col("__v") >= F.col("low"), F.col("__v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(W.partitionBy("__rank").orderBy(F.asc_nulls_first("v")).rowsBetween(W.unboundedPreceding, 0))
    placed = counted.withColumn("upto", upto)
    at = lambda place: F.max(F.when((F.col("upto") >= place) & (F.col("upto") - F.col("c") < place), F.col("v")))
    middle = placed.groupBy(F.col("__rank").alias("__r")).agg(at(F.ceil(F.col("m") / 2)).alias("a"), at(F.floor(F.col("m") / 2) + 1).alias("b"))
    return bounds.join(middle, F.col("__rank").eqNullSafe(F.col("__r")), "left").select(F.col("__rank").alias(rank), "n", (F.col("a") * 0.5 + F.col("b") * 0.5).alias("median_value"))


def walk_bounds(df: DataFrame, id_col: str, high: int | None = None) -> DataFrame:
    """Least and greatest id, count, and whether known ids were reached, of a slice."""
    reached = F.lit(False) if high is None else F.coalesce(F.bool_or(F.col(id_col) <= high), F.lit(False))
    return df.agg(F.min(id_col).alias("lowest"), F.max(id_col).alias("highest"), F.count(F.lit(1)).alias("records"), reached.alias("reached_known"))


def score_before(df: DataFrame, partition: Sequence[str], order: Sequence[str], side: str, names: Mapping[object, str], largest: int | None = LARGEST) -> DataFrame:
    """Running counts of each side's wins before the current row; 0 on the first row.

    One window for all, while no partition has more than `largest` rows, which is counted first (None: it is known).
    Beyond that the rows are dealt by ranges of partition and order over blocks, counted within their block, and the
    sums of the blocks before are added, so that a large partition is counted in many tasks. Null partitions are one.
    """
    if largest is not None:
        top = df.groupBy(*partition).agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
        if top > largest:
            return _score_in_blocks(df, partition, order, side, names, largest)
    window = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumns({name: F.count(F.when(F.col(side) == value, 1)).over(window) for value, name in names.items()})


def _score_in_blocks(df: DataFrame, partition: Sequence[str], order: Sequence[str], side: str, names: Mapping[object, str], size: int) -> DataFrame:
    spark, columns = df.sparkSession, df.columns
    path = scratch_dir(spark, "blocks")
    ranges = max(2, -(-df.count() // size) * 2)
    # written once, so the number of a block holds for whatever is computed again
    df.repartitionByRange(ranges, *[F.col(c) for c in (*partition, *order)]).withColumn("__block", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__block", T.IntegerType())])).parquet(path)
    inside = W.partitionBy(*partition, "__block").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    counted = rows.withColumns({name: F.count(F.when(F.col(side) == value, 1)).over(inside) for value, name in names.items()})
    sums = rows.groupBy(*partition, "__block").agg(*[F.count_if(F.col(side) == value).alias(f"__{name}") for value, name in names.items()])
    # one row for each block of a partition
    ahead = W.partitionBy(*partition).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(*[F.col(c).alias(f"__p{i}") for i, c in enumerate(partition)], F.col("__block").alias("__b"), *[F.coalesce(F.sum(f"__{name}").over(ahead), F.lit(0)).alias(f"__{name}") for name in names.values()])
    same = F.col("__block") == F.col("__b")
    for i, c in enumerate(partition):
        same = same & F.col(c).eqNullSafe(F.col(f"__p{i}"))
    joined = counted.join(base, same)
    return joined.select(*columns, *[(F.col(name) + F.col(f"__{name}")).alias(name) for name in names.values()])


def reconcile(fact: DataFrame, recount: DataFrame, on: Sequence[str], differ: Mapping[str, str]) -> DataFrame:
    """Rows of the fact whose stated values differ from the recount; null on either side is no difference."""
    joined = fact.join(recount.hint("shuffle_hash"), list(on), "inner")
    test = F.lit(False)
    for stated, counted in differ.items():
        test = test | F.coalesce(F.col(stated) != F.col(counted), F.lit(False))
    return joined.filter(test)


def union_common_shape(frames: Sequence[tuple[DataFrame, Mapping[str, Column]]], shape: Mapping[str, str]) -> DataFrame:
    """UNION ALL of frames in one shape of typed columns; what a frame lacks is a typed null."""
    shaped = [df.select(*[columns.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in shape.items()]) for df, columns in frames]
    out = shaped[0]
    for more in shaped[1:]:
        out = out.unionByName(more)
    return out
