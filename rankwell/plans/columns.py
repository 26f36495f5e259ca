"""Registered queries that compare whole rows of the widest models, and checks over rows spoiled on purpose."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankwell.functions import coerce
from rankwell.operators.extract import extract_match_pages, reparse_stored
from rankwell.plans import adapter, models
from rankwell.plans.marts import DIM, DOCUMENTS, WITH, models_of, sql_of
from rankwell.plans.queries import c, lit, load, match_html, order_pages, query
from rankwell.sources.schemas import tier_seed

BASE = "base AS (SELECT t.*, c_mktsegment, c_nationkey FROM t JOIN customer ON page_id = c_custkey), "


@query(sql_of("""SELECT tournament_key, 'wiki' AS source_name, dim.discipline, dim.page_id, dim.page_title, base.page_title AS tournament_name, CASE WHEN base.page_id % 4 <> 0 THEN c_mktsegment END AS series_name, 'Org ' || (base.page_id % 11) AS organizer,
nullif(trim(tier), '') AS tier_source, tier_rank, tier_label, dim.tier_key, CASE WHEN base.page_id % 3 <> 0 THEN lower(c_mktsegment) END AS tier_type, 'Game ' || (base.page_id % 3) AS game, CASE WHEN base.page_id % 2 = 0 THEN 'online' ELSE 'offline' END AS setting,
'Land ' || c_nationkey AS country, CASE WHEN base.page_id % 5 <> 0 THEN 'City ' || (base.page_id % 13) END AS city, start_date, end_date, has_date_conflict, duration_days, prize_pool_usd, CAST(base.page_id % 33 AS INTEGER) AS team_count,
TIMESTAMP '2024-01-01' + to_days(CAST(base.page_id % 100 AS INTEGER)) AS revised_at FROM dim JOIN base ON dim.page_id = base.page_id""", WITH + DIM + BASE))
def mart_dim_tournament_all(spark, d):
    """Every column of the dimension, with names, places and settings padded, blank or in drifting case."""
    k = c("page_id")
    padded = lambda value: F.concat(lit("  "), value, lit(" "))
    rows = adapter.raw_tournaments(spark, d).join(load(spark, d, "customer").select(c("c_custkey").alias("page_id"), "c_mktsegment", "c_nationkey"), "page_id")
    told = {
        "name": padded(c("page_title")), "series": F.when(k % 4 == 0, lit("   ")).otherwise(padded(c("c_mktsegment"))), "organizer": F.concat(lit("Org "), k % 11), "tier_type": F.when(k % 3 == 0, lit("")).otherwise(padded(c("c_mktsegment"))),
        "game": F.concat(lit(" Game "), k % 3), "setting": F.when(k % 2 == 0, lit(" OnLine")).otherwise("OFFLINE "), "country": padded(F.concat(lit("Land "), c("c_nationkey"))), "city": F.when(k % 5 != 0, F.concat(lit("City "), k % 13)),
        "team_count": (k % 33).cast("int"), "revised_at": F.timestamp_add("DAY", k % 100, lit("2024-01-01").cast("timestamp")),
    }
    return models.dim_tournament(models.stg_tournaments(rows.withColumns(told)), tier_seed(spark))


@query(sql_of("""SELECT map_key || '#P' || k AS player_map_key, map_key, series_key, discipline, tournament_key, tier_rank, played_at, map_number, map_name, CASE WHEN k <= 5 THEN 1 ELSE 2 END AS side, CASE WHEN k <= 5 THEN side_1_team ELSE side_2_team END AS team,
'P' || k AS player, 'p' || k AS player_name, 'Agent' || (k % 4) AS agent, s1 + s2 AS rounds_played, CASE WHEN k <= 5 THEN s1 > s2 ELSE s2 > s1 END AS won_map, CAST(100 + (pk + k) % 150 AS DOUBLE) AS acs, CAST((pk + k) % 25 AS INTEGER) AS kills, CAST((pk + 2 * k) % 20 AS INTEGER) AS deaths,
CAST(k AS INTEGER) AS assists, CAST((pk * k) % 101 AS DOUBLE) AS kast_pct, CAST(50 + (pk + k) % 90 AS DOUBLE) AS adr, k * 3.5::DOUBLE AS headshot_pct, CAST((pk + k) % 4 AS INTEGER) AS first_kills, CAST((pk + k) % 3 AS INTEGER) AS first_deaths,
CAST((pk + k) % 25 - (pk + 2 * k) % 20 AS INTEGER) AS kill_diff, CAST((pk + k) % 4 - (pk + k) % 3 AS INTEGER) AS first_kill_diff, round(((pk + k) % 25) / nullif((pk + 2 * k) % 20, 0), 9) AS kd_ratio, round(((pk + k) % 25) / nullif(s1 + s2, 0), 9) AS kills_per_round,
round(((pk + k) % 4) / nullif(s1 + s2, 0), 9) AS first_kills_per_round FROM f, range(1, 11) AS r(k)"""))
def mart_fct_player_map_all(spark, d):
    """Every column of the players' fact, quotients rounded to nine places."""
    made = models_of(spark, d, ["fct_player_map"], DOCUMENTS, True)["fct_player_map"]
    return made.withColumns({n: F.round(n, 9) for n in ("kd_ratio", "kills_per_round", "first_kills_per_round")})


@query(sql_of("""SELECT map_key, s1 AS side_1_rounds, s2 AS side_2_rounds, CAST(s1 - CASE WHEN s1 > 0 THEN 1 ELSE 0 END AS BIGINT) AS counted_1, CAST(s2 - CASE WHEN s1 > 0 THEN 0 ELSE 1 END AS BIGINT) AS counted_2 FROM f WHERE map_number % 3 = 0"""))
def mart_recount_spoiled(spark, d):
    """The recount where the first round of every third map is lost: exactly these maps are told."""
    m = models_of(spark, d, ["stg_rounds", "fct_map"], DOCUMENTS, True)
    lost = (c("round_number") == 1) & (c("map_number") % 3 == 0)
    return models.recount_mismatch(m["stg_rounds"].filter(~lost), m["fct_map"])


@query("SELECT o_orderkey AS page_id, o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0 AS differs FROM orders")
def reparse_spoiled_pages(spark, d):
    """Stored pages of which every third has another document than its page gives; pages without a block stand."""
    stored = extract_match_pages(order_pages(spark, d, match_html()), deal=False, slim="html")
    spoiled = F.when(c("page_id") % 3 == 0, c("document").withField("status", lit("spoiled"))).otherwise(c("document"))
    return reparse_stored(stored.withColumn("document", spoiled), deal=False).select("page_id", "differs")


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 0 AND event_id % 4 <> 1 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 4 <> 1 THEN event_id % 4 <> 0 END AS readable FROM events""")
def typed_props_spoiled(spark, d):
    """A field of records of which every fourth is cut short and every fourth is absent."""
    props = F.when(c("event_id") % 4 == 0, F.regexp_replace("props", r"\}\s*$", "")).when(c("event_id") % 4 != 1, c("props"))
    rows = load(spark, d, "events").select("event_id", props.alias("props"))
    k = coerce.lossy_int(F.try_variant_get(F.try_parse_json("props"), "$.k", "variant"))
    return rows.select("event_id", k.alias("k"), coerce.json_readable(c("props")).alias("readable"))
