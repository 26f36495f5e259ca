"""The work queue: which pages to render next."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.functions.exprs import tier_rank_case
from rankwell.operators.upsert import table_exists
from rankwell.sources.schemas import PAGES

SETTLED = ("finished",)
RETRY_DAYS = 3


def designated_matches(links: DataFrame, tournaments: DataFrame, wiki: str, now: datetime) -> DataFrame:
    """Per linked match the best rank and the latest start of its tournaments; those that start later are left out
    before grouping, undated ones are kept."""
    mine = links.filter(F.col("wiki") == wiki).select(F.col("tournament_page_id").alias("page_id"), "match_title")
    started = tournaments.filter((F.col("wiki") == wiki) & (F.col("start_date").isNull() | (F.col("start_date") <= F.lit(now.date()))))
    joined = mine.join(started.select("page_id", "tier", "start_date"), "page_id")
    return joined.groupBy("match_title").agg(F.min(tier_rank_case(F.col("tier"))).alias("rank"), F.max("start_date").alias("latest_start"))


def missing_or_stale(designated: DataFrame, pages: DataFrame, wiki: str, now: datetime, settled: tuple[str, ...] = SETTLED, days: int = RETRY_DAYS) -> DataFrame:
    """Matches without a page, or with an unsettled one that was last seen more than `days` ago."""
    seen = pages.filter(F.col("wiki") == wiki).select(F.col("page_title").alias("match_title"), "status", "refreshed_at", F.lit(True).alias("known"))
    stale = ~F.col("status").isin(*settled) & (F.col("refreshed_at") < F.lit(now - timedelta(days=days)))
    return designated.join(seen, "match_title", "left").filter(F.col("known").isNull() | stale).drop("status", "refreshed_at", "known")


def priority_queue(links: DataFrame, tournaments: DataFrame, pages: DataFrame, wiki: str, max_rank: int, now: datetime, limit: int) -> DataFrame:
    """The next `limit` matches by rank, latest start (unknown last) and title; never a full sort."""
    wanted = missing_or_stale(designated_matches(links, tournaments, wiki, now).filter(F.col("rank") <= max_rank), pages, wiki, now)
    return wanted.orderBy("rank", F.desc_nulls_last("latest_start"), "match_title").limit(limit)


def queue_of_tables(spark: SparkSession, wiki: str, max_rank: int, now: datetime, limit: int, links: str = "links", tournaments: str = "tournaments", pages: str = "match_pages") -> DataFrame:
    """The queue from tables of the catalogue. Without links and tournaments there is nothing to ask for, which is an
    error and not an empty queue; without stored pages every linked match is missing."""
    if missing := [name for name in (links, tournaments) if not table_exists(spark, name)]:
        raise ValueError(f"the queue needs {' and '.join(missing)}: collect them first")
    stored = spark.table(pages) if table_exists(spark, pages) else spark.createDataFrame([], PAGES.schema)
    return priority_queue(spark.table(links), spark.table(tournaments), stored, wiki, max_rank, now, limit)
