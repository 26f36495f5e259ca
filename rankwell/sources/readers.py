"""Landed source records as raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwell.functions import coerce
from rankwell.functions.wikitext import strip_markup
from rankwell.operators.extract import slim_pages
from rankwell.sources.schemas import MATCHES, PAGES, TOURNAMENTS

MATCH_FIELDS = ("match_id", "duration", "start_time", "radiant_team_id", "radiant_name", "dire_team_id", "dire_name", "leagueid", "league_name", "series_id", "series_type", "radiant_score", "dire_score", "radiant_win", "version")


def _bodies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of whole files: one file is one row; a body that is not an array of objects, or not one alone, is an error.

    The parser stops behind the first value, so the body is parsed with its own digest behind it: a second array in the
    file, or what else follows the first, is not passed over.
    """
    digest = F.md5(F.col("value").cast("binary"))
    marked = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit(', "'), digest, F.lit('"]')))
    alone = F.try_variant_get(marked, "$[1]", "string") == digest
    bodies = spark.read.text(path, wholetext=True).select(F.when(alone, F.try_variant_get(marked, "$[0]", "array<variant>")).alias("body"))
    array = F.col("body")
    checked = F.when(array.isNull(), F.raise_error(F.lit("a match list must be a JSON array"))).otherwise(array)
    return bodies.select(F.explode(checked).alias("record"))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands before each closing brace: file, place, kind (first, next, last or none of these) and the record."""
    text = spark.read.option("lineSep", "}").text(path)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    rows = text.select(F.col("_metadata.file_path").alias("file"), at.alias("at"), F.regexp_replace("value", r"^[﻿\s]+", "").alias("piece"))
    body = F.concat(F.regexp_replace("piece", r"^[\[,]\s*", ""), F.lit("}"))
    record = F.try_parse_json(F.when(body.startswith("{"), body)).alias("record")
    rows = rows.select("file", "at", "piece", record)
    kind = F.when(F.rtrim("piece") == "]", "last").when(F.col("record").isNull(), None).when(F.col("piece").startswith("["), "first").when(F.col("piece").startswith(","), "next")
    return rows.select("file", "at", kind.alias("kind"), "record")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON arrays, read in parts of a file where that is sure to be right.

    Files are cut at closing braces, so Spark splits them like lines. A file is an array of flat objects if its pieces
    are one that opens it, others that go on, and one that ends it, in this order, and each holds one whole object;
    all other files (nested objects, braces in texts, what is no array) are read whole, one file a row.
    """
    pieces = _pieces(spark, path)
    ends = pieces.groupBy("file").agg(
        F.count_if(F.col("kind").isNull()).alias("odd"), F.count_if(F.col("kind") == "first").alias("firsts"), F.count_if(F.col("kind") == "last").alias("lasts"),
        F.min_by("kind", "at").alias("begins"), F.max_by("kind", "at").alias("ends"),
    )
    flat = (F.col("odd") == 0) & (F.col("firsts") == 1) & (F.col("lasts") == 1) & (F.col("begins") == "first") & (F.col("ends") == "last")
    whole = [r["file"] for r in ends.filter(~flat).select("file").collect()]
    rows = pieces.filter(F.col("kind") != "last")
    if whole:
        names = spark.createDataFrame([(f,) for f in whole], "file string")
        rows = rows.join(names, "file", "left_anti")
    rows = rows.select("record")
    return rows.unionByName(_bodies(spark, whole)) if whole else rows


def read_match_landing(spark: SparkSession, path: str, fields: tuple[str, ...] = MATCH_FIELDS, id_field: str = "match_id", multi_line: bool = True) -> DataFrame:
    """Landed match lists (JSON arrays of objects) as one VARIANT column per field, and the record itself.

    A large array of flat records is read by several tasks. A body that is not an array of objects is an error (a file
    without a byte has none and gives no records); a record whose id is no integer by the rules of coercion is dropped.
    """
    if multi_line:
        records = _records(spark, path)
    else:
        records = spark.read.text(path).select(F.try_parse_json("value").alias("record"))
    shaped = records.select("record", *[F.try_variant_get("record", f"$.{f}", "variant").alias(f) for f in fields])
    return shaped.filter(coerce.lossy_int(F.col(id_field)).isNotNull())


def stamp(df: DataFrame, now: datetime) -> DataFrame:
    """First and latest sight of every row, the same given instant."""
    return df.withColumns({"ingested_at": F.lit(now).cast("timestamp"), "refreshed_at": F.lit(now).cast("timestamp")})


def tag_feed(df: DataFrame, wiki: str) -> DataFrame:
    return df.withColumn("wiki", F.lit(wiki))


def normalize_matches(records: DataFrame, now: datetime) -> DataFrame:
    """Raw match rows from `read_match_landing`: 18 columns, renamed and coerced."""
    i, s, c = coerce.lossy_int, coerce.lossy_str_variant, F.col
    rows = records.select(
        i(c("match_id")).alias("match_id"), coerce.epoch_to_ts(i(c("start_time"))).alias("start_time"), i(c("duration"), "int").alias("duration_seconds"),
        i(c("radiant_team_id")).alias("radiant_team_id"), s(c("radiant_name")).alias("radiant_name"), i(c("dire_team_id")).alias("dire_team_id"), s(c("dire_name")).alias("dire_name"),
        i(c("radiant_score"), "int").alias("radiant_score"), i(c("dire_score"), "int").alias("dire_score"), coerce.lossy_bool(c("radiant_win")).alias("radiant_win"),
        i(c("leagueid")).alias("league_id"), s(c("league_name")).alias("league_name"), i(c("series_id")).alias("series_id"), i(c("series_type"), "int").alias("series_type"),
        i(c("version"), "int").alias("parse_version"), F.to_json("record").alias("payload"),
    )
    return stamp(rows, now).select(*MATCHES.columns)


def dealt(scan: DataFrame) -> DataFrame:
    """A scan with fewer parts than there are cores (a small table in one file), dealt over all cores; a larger one as
    it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


#: Rows of a task whose pages are read in Python, about.
PAGES_A_TASK = 20_000


def dealt_for_pages(rows: DataFrame) -> DataFrame:
    """Narrow rows that pages are made of, dealt over as many tasks as their number asks for: a compact file is split by
    its size, and a part of it may hold millions."""
    return rows.repartition(max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // PAGES_A_TASK)))


def merge_listing_with_content(listing: DataFrame, content: DataFrame, key: str) -> DataFrame:
    """Every listed page gives a row, with its content if that came back."""
    return listing.join(content, key, "left")


def flatten_links(pages: DataFrame, page_id: str, links: str, title: str = "match_title") -> DataFrame:
    """Distinct (page, linked title); null titles are skipped. A page's own repeats go before they are shuffled."""
    named = F.array_distinct(F.filter(links, lambda x: x.isNotNull()))
    return pages.select(F.col(page_id), F.explode(named).alias(title)).distinct()


def project_infobox(fields: Column) -> dict[str, Column]:
    """Typed columns from an infobox map."""
    value = lambda key: F.nullif(strip_markup(F.try_element_at(fields, F.lit(key))), F.lit(""))
    raw = lambda key: F.try_element_at(fields, F.lit(key))
    return {
        "name": value("name"), "series": value("series"), "organizer": value("organizer"), "tier": value("liquipediatier"), "tier_type": value("liquipediatiertype"),
        "game": value("game"), "setting": value("type"), "country": value("country"), "city": value("city"), "start_date": coerce.strict_iso_date(raw("sdate")), "end_date": coerce.strict_iso_date(raw("edate")),
        "prize_pool_usd": coerce.amount(raw("prizepoolusd")), "prize_pool_local": value("prizepool"), "local_currency": value("localcurrency"), "team_count": coerce.count_value(raw("team_number")),
    }


def normalize_tournaments(pages: DataFrame, now: datetime, fields: str = "fields") -> DataFrame:
    """Raw tournament rows from (wiki, pageid, title, revised_at, fields): 22 columns."""
    rows = pages.select(
        "wiki", F.col("pageid").cast("bigint").alias("page_id"), F.col("title").alias("page_title"), coerce.iso_timestamp(F.col("revised_at")).alias("revised_at"),
        coerce.keep_payload(F.coalesce(F.col(fields), F.create_map().cast("map<string,string>")), sort_keys=True).alias("infobox"), *[c.alias(n) for n, c in project_infobox(F.col(fields)).items()],
    )
    return stamp(rows, now).select(*TOURNAMENTS.columns)


def normalize_match_page(pages: DataFrame, now: datetime, document: str = "document", stored: bool = False) -> DataFrame:
    """Raw match page rows from (wiki, page_title, page_id, revision_id, html, document struct); a page that did not
    come back has a null document and the status `missing`. Of the page its match block is stored, without history and
    heavy attributes: enough to read it again; nothing of a page without a block. With `stored`, html is that already."""
    d, html = F.col(document), F.col("html")
    rows = pages.select(
        "wiki", "page_title", F.col("page_id").cast("bigint").alias("page_id"), F.col("revision_id").cast("bigint").alias("revision_id"),
        F.when(d.isNull(), "missing").otherwise(F.coalesce(d["status"], F.lit("unknown"))).alias("status"), coerce.epoch_to_ts(d["played_at_epoch"]).alias("played_at"), d["tournament_page"].alias("tournament_page"),
        F.get(d["teams"], F.lit(0))["page"].alias("team_1"), F.get(d["teams"], F.lit(1))["page"].alias("team_2"), F.get(d["score"], F.lit(0)).alias("score_1"), F.get(d["score"], F.lit(1)).alias("score_2"),
        F.when(d["maps"].isNull(), 0).otherwise(F.size(d["maps"])).alias("map_count"), F.coalesce(F.to_json(d), F.lit('{"status":"missing","teams":[],"veto":[],"maps":[]}')).alias("document"), (html if stored else slim_pages(html)).alias("html"),
    )
    return stamp(rows, now).select(*PAGES.columns)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
