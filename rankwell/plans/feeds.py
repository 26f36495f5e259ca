"""Registered queries of feeds and match pages: seeds, conformity, stamps, paging, the stream's trace, page details."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankwell.functions import coerce
from rankwell.operators import incremental as inc
from rankwell.operators import relational as r
from rankwell.operators.extract import extract_match_pages
from rankwell.operators.upsert import conform
from rankwell.plans.queries import c, lit, load, query
from rankwell.sources import readers
from rankwell.sources.schemas import SEED_DDL, TableSpec, read_seed
from rankwell.sources.scratch import scratch_dir
from rankwell.streaming import collect

NOW = datetime(2024, 1, 1)
PAGE_SIZE = 1000


@query("SELECT p_brand AS discipline, lower(p_type) AS tier_key, CASE WHEN p_size % 5 <> 0 THEN p_size END AS tier_rank, p_name AS tier_label FROM part")
def seed_from_csv(spark, d):
    path = scratch_dir(spark, "seed")
    rank = F.when(c("p_size") % 5 != 0, c("p_size")).alias("tier_rank")
    load(spark, d, "part").select(c("p_brand").alias("discipline"), F.lower("p_type").alias("tier_key"), rank, c("p_name").alias("tier_label")).write.csv(path, header=True)
    return read_seed(spark, path, SEED_DDL)


@query("SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS DOUBLE) AS s_acctbal FROM supplier")
def conformed_rows(spark, d):
    """Columns in another order and of other types, put into those of the table."""
    spec = TableSpec("supplier", "s_suppkey bigint, s_name string, s_nationkey string, s_acctbal double", ("s_suppkey",))
    return conform(load(spark, d, "supplier").select("s_acctbal", "s_nationkey", "s_name", "s_suppkey"), spec)


@query("""SELECT c_custkey, 'dota2' AS wiki, TIMESTAMP '2024-01-01' AS ingested_at, TIMESTAMP '2024-01-01' AS refreshed_at,
c_custkey AS payload_key, c_name AS payload_name FROM customer""")
def stamped_feed(spark, d):
    """Rows with their feed, both stamps, and the record as it came, which is read again here."""
    record = F.struct(c("c_custkey").alias("k"), c("c_name").alias("n"))
    rows = load(spark, d, "customer").select("c_custkey", coerce.keep_payload(record).alias("payload"))
    rows = readers.stamp(readers.tag_feed(rows, "dota2"), NOW)
    read = F.from_json("payload", "k bigint, n string")
    return rows.select("c_custkey", "wiki", "ingested_at", "refreshed_at", read["k"].alias("payload_key"), read["n"].alias("payload_name"))


@query(f"""WITH seen AS (SELECT l_orderkey, max(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, price, (SELECT count(*) FROM seen) > {PAGE_SIZE} AS more FROM seen ORDER BY l_orderkey DESC LIMIT {PAGE_SIZE}""")
def page_with_more(spark, d):
    """The first page from the top, whether more follow, and a next page that must descend below it."""
    seen = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("price"))
    page, more = inc.has_more(seen.orderBy(F.desc("l_orderkey")), PAGE_SIZE)
    lowest = page.agg(F.min("l_orderkey")).first()[0]
    bounds = r.walk_bounds(inc.page_below(seen, "l_orderkey", lowest, PAGE_SIZE), "l_orderkey").first()
    inc.guard_progress(inc.Walk(bounds["lowest"], bounds["highest"], bounds["records"], bounds["reached_known"]), lowest)
    return page.withColumn("more", lit(more))


@query("""WITH half AS (SELECT min(event_id) AS low, max(event_id) AS high, (min(event_id) + max(event_id)) // 2 AS middle FROM events),
n AS (SELECT count(*) AS all_rows, count(*) FILTER (WHERE event_id <= middle) AS first_rows FROM events, half)
SELECT 'state' AS kind, high AS high_watermark, low AS backfill_cursor, all_rows + first_rows AS records, CAST(NULL AS BIGINT) AS inserted, CAST(NULL AS BIGINT) AS updated, CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS BOOLEAN) AS gap FROM half, n
UNION ALL SELECT 'run', (SELECT max(event_id) FROM events, half WHERE event_id <= middle), low, first_rows, first_rows, 0, 'exhausted', false FROM half, n
UNION ALL SELECT 'run', high, low, all_rows, all_rows - first_rows, first_rows, 'caught_up', false FROM half, n""")
def stream_trace(spark, d):
    """State and runs of a stream that first gets the lower half of the events, then all of them."""
    base = scratch_dir(spark, "trace")
    events = load(spark, d, "events").select("event_id", "user_id", "value")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    feed = collect.Feed("driver", "all", "events", TableSpec("events", "event_id bigint, user_id bigint, value double", ("event_id",)), "event_id", "landed", f"{base}/feed")
    for part in (events.filter(c("event_id") <= (low + high) // 2), events):
        part.write.mode("append").json(f"{base}/landing")
        collect.stream_collect(spark, f"{base}/landing", feed.spec.schema, feed, lambda df: df, lambda: NOW).awaitTermination()
    state = collect.all_states(collect.states_of(spark, feed)).select(lit("state").alias("kind"), "high_watermark", "backfill_cursor", c("records_seen").alias("records"))
    runs = collect.run_history(collect.runs_of(spark, feed)).select(lit("run").alias("kind"), "high_watermark", "backfill_cursor", "records", "inserted", "updated", "stop_reason", c("gap_suspected").alias("gap"))
    return runs.unionByName(state, allowMissingColumns=True)


_RUN = "SELECT {0} AS run, CAST({1} AS BIGINT) AS records, CAST({2} AS BIGINT) AS inserted, CAST({3} AS BIGINT) AS updated, high AS high_watermark, {4} AS backfill_cursor, '{5}' AS stop_reason FROM n"
_AT = "(SELECT max(event_id) FROM e, n AS m WHERE i = {0} * m.p)"


@query("WITH e AS (SELECT event_id, row_number() OVER (ORDER BY event_id DESC) AS i FROM events), n AS (SELECT count(*) AS n, greatest(1, count(*) // 20) AS p, max(event_id) AS high, min(event_id) AS low FROM events) " + " UNION ALL ".join([
    _RUN.format(1, "2 * p", "2 * p", 0, _AT.format(2), "page_limit"), _RUN.format(2, "3 * p", "3 * p", 0, _AT.format(5), "page_limit"), _RUN.format(3, "p", 0, "p", _AT.format(5), "caught_up"),
    _RUN.format(4, "n - 5 * p", "n - 5 * p", 0, "low", "exhausted"), _RUN.format(5, 0, 0, 0, "low", "empty_page"),
]))
def bounded_runs(spark, d):
    """A catch-up and a backfill that stop at their page limits, and runs that end for each other reason."""
    events = load(spark, d, "events").select("event_id", "value")
    feed = collect.Feed("driver", "all", "events", TableSpec("events", "event_id bigint, value double", ("event_id",)), "event_id", "event_id", f"{scratch_dir(spark, 'bounded')}/feed")
    page = max(1, events.count() // 20)
    for mode, most in ((inc.CATCHUP, 2), (inc.BACKFILL, 3), (inc.CATCHUP, 9), (inc.BACKFILL, 100), (inc.BACKFILL, 1)):
        collect.run_feed(events, feed, mode, NOW, page, most)
    number = F.regexp_extract("run_id", r"(\d+)$", 1).cast("int") + 1
    return collect.runs_of(spark, feed).select(number.alias("run"), "records", "inserted", "updated", "high_watermark", "backfill_cursor", "stop_reason")


@query("""WITH n AS (SELECT count(*) AS n, (count(*) + 4) // 5 AS p FROM pages)
SELECT k AS run, CAST(least(2 * p * k, n) AS BIGINT) AS records_seen, CAST(least(2 * p * k, n) AS BIGINT) AS stored, k = 3 AS finished, CASE WHEN k = 3 THEN 'exhausted' ELSE 'page_limit' END AS stop_reason FROM n, (VALUES (1), (2), (3)) AS runs(k)""")
def token_scan_runs(spark, d):
    """A scan by url and id over several runs: what is seen and stored after each, and whether the token is cleared."""
    pages = load(spark, d, "pages").select("url", "page_id")
    feed = collect.Feed("driver", "all", "pages", TableSpec("pages", "url string, page_id bigint", ("url", "page_id")), "page_id", "page_id", f"{scratch_dir(spark, 'scan')}/feed")
    page, made = max(1, -(-pages.count() // 5)), []
    for run in (1, 2, 3):
        reason = collect.run_feed(pages, feed, collect.SCAN, NOW, page, 2, ["url", "page_id"])
        made.append((run, collect.load_state(spark, feed).records_seen, collect.current_table(spark, feed).count(), collect.load_token(spark, feed) is None, reason))
    return spark.createDataFrame(made, "run int, records_seen long, stored long, finished boolean, stop_reason string")


def _tag(classes: str, *inside: Column | str, tag: str = "div") -> Column:
    return F.concat(lit(f'<{tag} class="{classes}">'), *[lit(x) if isinstance(x, str) else x.cast("string") for x in inside], lit(f"</{tag}>"))


def _link(title: Column) -> Column:
    return F.concat(lit('<a title="'), title, lit('">'), title, lit("</a>"))


def _detailed_page() -> Column:
    """A page for every part, with a veto card, one map, two teams of one player and two rounds."""
    k, size = c("p_partkey"), c("p_size")
    side = F.when(k % 2 == 0, "atk").otherwise("def")
    b, p, o, t = "match-bm-lol-game-summary", "match-bm-players", "match-bm-rounds-overview-round", "match-bm-match-round-detail"
    veto = F.concat(lit('<div class="match-bm-map-veto-card match-bm-map-veto-card--'), F.when(size % 2 == 0, "ban").otherwise("pick"), lit('">'), _tag("match-bm-map-veto-card-map-info", _link(c("p_brand"))), _tag("match-bm-map-veto-card-map-name", c("p_type")), lit("</div>"))
    half = lambda n: F.concat(lit('<i class="match-bm-game-summary-team-halves-half x--'), side, lit('">'), n.cast("string"), lit("</i>"))
    summary = _tag(b, _tag(f"{b}-map", c("p_type")), _tag(f"{b}-score", "13 : ", k % 12), _tag(f"{b}-length", "40:05"), _tag(f"{b}-team", half(k % 13), half(size)), _tag(f"{b}-team", half(size % 7)))
    stats = _tag("match-bm-team-stats-list-row", *[_tag("match-bm-team-stats-list-cell", x, tag="b") for x in (size, "Thrifties", k % 10)])
    stat = lambda name, *shown: _tag(f"{p}-player-stat", _tag(f"{p}-player-stat-title", name), _tag(f"{p}-player-stat-data", *shown))
    player = lambda n: _tag(f"{p}-team", _tag(f"{p}-player", _tag(f"{p}-player-name", _link(F.concat(lit(f"P{n} "), c("p_name")))), _tag(f"{p}-player-icon", _link(c("p_brand"))), stat("KDA", size, " / ", k % 20, " / ", lit(n)), stat("FK / FD", k % 4, "/", k % 3), stat("HS%", k % 101, ".5%"), stat("ACS", size * 3)))
    icon = lambda mark: F.concat(lit(f'<i class="{o}-outcome-icon y--'), mark, lit('"></i>'))
    outcome = lambda won: _tag(f"{o}-outcome", F.when(won, icon(side)).otherwise(""))
    rounds = [_tag(o, _tag(f"{o}-title", n, tag="b"), outcome((k + int(n)) % 2 == 0), outcome((k + int(n)) % 2 != 0)) for n in ("1", "2")]
    told = _tag(t, _tag(f"{t}-header", "Round 2", tag="b"), _tag(f"{t}-body", _tag(f"{t}-body-result-desc", c("p_type"), tag="p"), lit("<span><b>First Kill</b>"), _link(c("p_name")), lit("</span><span><b>Clutch</b>no one</span>")))
    return _tag("match-bm", veto, F.concat(lit('<div data-toggle-area-content="1">'), summary, stats, player(1), player(2), *rounds, told, lit("</div>")))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'ban' ELSE 'pick' END AS veto_action, p_type AS veto_map, p_brand AS veto_team, p_type AS map_name, CAST(p_partkey % 12 AS INTEGER) AS score_2,
CASE WHEN p_partkey % 2 = 0 THEN 'atk' ELSE 'def' END AS half_side, CAST(p_partkey % 13 AS INTEGER) AS half_1, CAST(p_size AS INTEGER) AS half_2, CAST(p_size % 7 AS INTEGER) AS other_half, CAST(p_size AS VARCHAR) AS thrifties_1, CAST(p_partkey % 10 AS VARCHAR) AS thrifties_2,
n AS side, 'P' || n || ' ' || p_name AS player, p_brand AS agent, CAST(p_size AS INTEGER) AS kills, CAST(p_partkey % 20 AS INTEGER) AS deaths, n AS assists, CAST(p_partkey % 4 AS INTEGER) AS first_kills, CAST(p_partkey % 3 AS INTEGER) AS first_deaths, p_partkey % 101 + 0.5::DOUBLE AS headshot_pct, CAST(p_size * 3 AS DOUBLE) AS acs,
CASE WHEN p_partkey % 2 = 1 THEN 1 ELSE 2 END AS round_1_winner, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END AS round_2_winner, p_type AS outcome_2, p_name AS first_kill_2, CAST(NULL AS VARCHAR) AS clutch_2, CAST(NULL AS VARCHAR) AS outcome_1
FROM part, (VALUES (1), (2)) AS sides(n)""")
def match_page_details(spark, d):
    """Veto, halves, team stats, players and rounds of a page for every part, one row a player."""
    parts = readers.dealt_for_pages(load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    read = extract_match_pages(parts.select("p_partkey", _detailed_page().alias("html")), deal=False).select("p_partkey", c("document.veto")[0].alias("v"), c("document.maps")[0].alias("m"))
    one, two, half = c("m.rounds")[0], c("m.rounds")[1], c("m.halves")
    flat = read.select(
        "p_partkey", c("v.action").alias("veto_action"), c("v.map").alias("veto_map"), c("v.team").alias("veto_team"), c("m.map").alias("map_name"), c("m.score")[1].alias("score_2"),
        half[0][0]["side"].alias("half_side"), half[0][0]["rounds"].alias("half_1"), half[0][1]["rounds"].alias("half_2"), half[1][0]["rounds"].alias("other_half"),
        c("m.team_stats.thrifties")[0].alias("thrifties_1"), c("m.team_stats.thrifties")[1].alias("thrifties_2"), F.explode("m.players").alias("p"),
        one["winner"].alias("round_1_winner"), two["winner"].alias("round_2_winner"), two["outcome"].alias("outcome_2"), two["first_kill"].alias("first_kill_2"), two["clutch"].alias("clutch_2"), one["outcome"].alias("outcome_1"),
    )
    player = [c("p.side").alias("side"), c("p.name").alias("player"), *[c(f"p.{n}").alias(n) for n in ("agent", "kills", "deaths", "assists", "first_kills", "first_deaths", "headshot_pct", "acs")]]
    return flat.select("*", *player).drop("p")
