"""Mixing sources to target weights by pivotal dependent rounding in a reduction tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankwell.llm.common import materialize

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source is repeated this often at most.
REPEATS = 3
#: Documents, or residuals of the level below, that one node of the tree combines.
FAN_IN = 512
#: Sources up to which their table is broadcast; beyond, it is joined by key with the hot keys salted.
FEW = 50_000
SALTS = 64
SIZE_WORD = r"[^\x20\x09-\x0D]+"
SEED = 20_240


def size_of(text: Column) -> Column:
    """Number of words in a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SIZE_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Per source (`skey`): `source_size` and `target`, from rows (skey, size).

    The sources share the sum of all sizes by weight. A target stops at `repeats` times its source's size and the
    excess is shared by weight among the others, until none is above. The level that settles this is found by
    rounds of one aggregate each over the table of sources; a round settles every source above the present level.
    """
    totals = materialize(sizes.groupBy("skey").agg(F.sum("size").alias("source_size")))
    # rank by code point: ranges of names first, then the order within each range
    dealt = materialize(totals.repartitionByRange(8, "skey").withColumn("part", F.spark_partition_id()))
    parts = dealt.groupBy("part").count()
    before = parts.select("part", F.coalesce(F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = dealt.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.row_number().over(W.partitionBy("part").orderBy("skey")) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = materialize(ranked.select("skey", "source_size", weight.alias("weight")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, most = None, F.col("source_size") * float(repeats)
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > most
        row = table.agg(F.sum(F.when(above, most).otherwise(0.0)).alias("held"), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("free")).first()
        if not row["free"]:
            break
        new = (total - row["held"]) / row["free"]
        if level is not None and new <= level:
            break
        level = new
    return table.select("skey", "source_size", F.least(most, F.col("weight") * F.lit(level or 0.0)).alias("target"))


def _round(rows: pd.DataFrame) -> pd.DataFrame:
    """Pivotal rounding of the rows of one node: all but one of them come out with an integral copy number.

    The open row meets the next one; words move from one to the other, in a direction drawn so that neither copy
    probability changes on average, until one of them has no fraction left. The words taken in all stay the same.
    """
    rows = rows.sort_values(["size", "draw", "rid"], kind="stable")
    p, size = rows["p"].to_numpy(copy=True), rows["size"].to_numpy().astype(float)
    luck = np.random.default_rng([SEED, int(rows["draw"].iloc[0]) & 0xFFFFFFFF, len(rows)]).random(len(rows))
    held = -1
    for i in range(len(p)):
        if p[i] <= _TINY or p[i] >= 1 - _TINY:
            continue
        if held < 0:
            held = i
            continue
        up = min((1 - p[held]) * size[held], p[i] * size[i])  # words that may move from i to the held row
        down = min(p[held] * size[held], (1 - p[i]) * size[i])
        moved = up if luck[i] * (up + down) < down else -down
        p[held] += moved / size[held]
        p[i] -= moved / size[i]
        free = [k for k in (held, i) if _TINY < p[k] < 1 - _TINY]
        held = free[0] if free else -1
    rows["p"] = p
    rows["open"] = np.arange(len(p)) == held
    return rows


_TINY = 1e-9


def pivotal_copies(rows: DataFrame) -> DataFrame:
    """(rid, extra) from rows (rid, skey, size > 0, p between 0 and 1): `extra` is 0 or 1, near p in every source.

    Level by level: the documents of a source are dealt by a hash into nodes of about FAN_IN, each node leaves one
    open row at most, and the open rows of a source go to the nodes of the next level, until a source has one node.
    Its last open row is rounded to the nearer side. The draws depend on the ids and the seed alone, so a rerun or
    a task that is run again decides the same.
    """
    schema = "rid long, skey string, size long, p double, draw long, nodes long, node long, open boolean"
    largest = rows.groupBy("skey").count().withColumnRenamed("count", "n")
    largest = materialize(largest)
    width = largest.agg(F.max("n")).first()[0] or 0
    counted = _attach(rows, largest)
    state = counted.withColumn("nodes", F.ceil(F.col("n") / FAN_IN).cast("long")).drop("n")
    done: list[DataFrame] = []
    while True:
        node = F.pmod(F.xxhash64(F.lit(len(done)), "draw"), F.col("nodes"))
        grouped = state.withColumn("node", node).groupBy("skey", "node")
        made = materialize(grouped.applyInPandas(_round, schema))
        width = -(-width // FAN_IN)
        if width <= 1:
            done.append(made.select("rid", F.round("p").cast("int").alias("extra")))
            return _union(done)
        done.append(made.filter(~F.col("open")).select("rid", F.round("p").cast("int").alias("extra")))
        state = made.filter("open").withColumn("nodes", F.ceil(F.col("nodes") / FAN_IN).cast("long")).drop("open", "node")


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def _attach(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with the columns of their source, without dealing the rows by source while the sources are few."""
    if sources.count() <= FEW:
        return rows.join(F.broadcast(sources), "skey")
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int")).join(salted, ["skey", "salt"]).drop("salt")


def mix(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", keep: list[str] | None = None, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The columns `keep` (default: all) of df with `size`, `source_size`, `target` and `copies`, how often the mix
    takes the document (0 to `repeats`).

    A null source is a source of its own and sorts last. Documents without words get no copies: they add nothing.
    Repeated rows are drawn one by one. Columns of df that are called like the new ones are replaced; other columns
    stay. An empty table gives an empty one.
    """
    # the key column keeps null apart from every name and after all of them
    skey = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col)))
    kept = [c for c in keep or df.columns if c not in ("size", "source_size", "target", "copies")]
    seen = df.select(F.struct(*[df[c] for c in kept]).alias("row"), skey.alias("skey"), size_of(df[text_col]).alias("size"), F.xxhash64(df[id_col].cast("long")).alias("draw"))
    table = materialize(seen.withColumn("rid", F.monotonically_increasing_id()))
    targets = materialize(source_targets(table.select("skey", "size"), weights, repeats))
    planned = _attach(table, targets).withColumn("share", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    whole = F.floor(F.col("share") + _TINY)
    planned = planned.withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(0).cast("int")).withColumn("p", F.greatest(F.lit(0.0), F.col("share") - whole))
    open_rows = planned.filter((F.col("size") > 0) & (F.col("p") > _TINY)).select("rid", "skey", "size", "p", "draw")
    extra = pivotal_copies(open_rows).withColumnRenamed("rid", "r")
    full = planned.join(extra, F.col("rid") == F.col("r"), "left")
    copies = (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies")
    return full.select("row.*", "size", "source_size", "target", copies)


def op8_pivotal_mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    made = mix(docs, keep=["doc_id"])
    return made.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of docs."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__doc"), docs["doc_id"].alias("__id"), docs["source"].alias("__source"), docs["text"].alias("__text"))
    made = mix(packed, "__text", "__source", "__id", keep=["__doc"])
    return made.filter("copies > 0").select("__doc.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).drop("__copy")
