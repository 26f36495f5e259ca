"""Registered queries of the operators, over driver tables, with the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.functions import coerce, text
from rankwell.functions import exprs as x
from rankwell.functions.wikitext import strip_markup
from rankwell.operators import incremental as inc
from rankwell.operators import nested, priority, quality
from rankwell.operators import relational as r
from rankwell.operators.upsert import upsert
from rankwell.sources import paged, readers
from rankwell.sources.schemas import TableSpec
from rankwell.sources.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
c, lit = F.col, F.lit

PRIORITY_SEED = [("1-urgent", 1), ("2-high", 2), ("3-medium", 3), ("4-not specified", 4), ("5-low", None)]
SEED_SQL = "(VALUES ('1-urgent', 1), ('2-high', 2), ('3-medium', 3), ('4-not specified', 4), ('5-low', NULL)) AS seed(tier_key, tier_rank)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def priority_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRIORITY_SEED, "tier_key string, tier_rank int")


@query(f"SELECT tier_rank, count(*) AS n, median(o_totalprice) AS median_value FROM orders LEFT JOIN {SEED_SQL} ON lower(nullif(trim(o_orderpriority), '')) = tier_key GROUP BY tier_rank")
def tier_profile(spark, d):
    orders = load(spark, d, "orders").select("o_totalprice", x.fold_key(c("o_orderpriority")).alias("tier_key"))
    return r.tier_profile(r.attach_tier(orders, priority_seed(spark), ["tier_key"], ["tier_rank"]), "tier_rank", "o_totalprice")


@query("SELECT o_orderkey AS side_1_id, o_custkey AS side_2_id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS winning_side, CASE o_orderstatus WHEN 'F' THEN o_orderkey WHEN 'O' THEN o_custkey END AS winner_id FROM orders")
def neutral_sides_flag(spark, d):
    flag = F.when(c("o_orderstatus") == "F", True).when(c("o_orderstatus") == "O", False)
    df = x.neutral_sides(load(spark, d, "orders"), {"o_orderkey": "side_1_id", "o_custkey": "side_2_id"})
    return df.select("side_1_id", "side_2_id", x.side_from_flag(flag).alias("winning_side"), x.side_from_flag(flag, c("side_1_id"), c("side_2_id")).alias("winner_id"))


@query("""SELECT 'c:' || c_custkey AS k, nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END), '') AS kept, lower(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END), '')) AS folded FROM customer
UNION ALL SELECT 'p:' || p_partkey, nullif(trim(p_name), ''), lower(nullif(trim(p_brand), '')) FROM part""")
def blank_fold_key(spark, d):
    spoiled = F.when(c("c_custkey") % 3 == 0, "  ").otherwise(F.concat(lit(" "), c("c_mktsegment"), lit(" ")))
    one = load(spark, d, "customer").select(x.readable_key(lit("c"), "c_custkey").alias("k"), x.blank_to_null(spoiled).alias("kept"), x.fold_key(spoiled).alias("folded"))
    return one.unionByName(load(spark, d, "part").select(x.readable_key(lit("p"), "p_partkey").alias("k"), x.blank_to_null(c("p_name")).alias("kept"), x.fold_key(c("p_brand")).alias("folded")))


@query("""SELECT l_orderkey, a, b, CASE WHEN a > b THEN 1 WHEN b > a THEN 2 END AS winning_side, CASE WHEN a > b THEN 'A' WHEN b > a THEN 'R' END AS winner FROM
(SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'R') AS b FROM lineitem GROUP BY l_orderkey)""")
def winner_by_score(spark, d):
    df = r.count_filtered(load(spark, d, "lineitem"), ["l_orderkey"], a=c("l_returnflag") == "A", b=c("l_returnflag") == "R")
    return df.select("*", x.winner_by_score(c("a"), c("b")).alias("winning_side"), x.winner_by_score(c("a"), c("b"), lit("A"), lit("R")).alias("winner"))


@query("""SELECT o_orderkey, l_linenumber, CASE WHEN e >= s THEN e WHEN s IS NULL THEN e END AS end_day, coalesce(e < s, false) AS conflict, CASE WHEN e >= s THEN date_diff('day', s, e) + 1 END AS days FROM
(SELECT o_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS s, CAST(l_shipdate AS DATE) AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def date_conflict(spark, d):
    df = load(spark, d, "lineitem").join(load(spark, d, "orders"), c("l_orderkey") == c("o_orderkey"))
    df = df.select("o_orderkey", "l_linenumber", x.as_day(c("o_orderdate")).alias("s"), x.as_day(c("l_shipdate")).alias("e"))
    s, e = c("s"), c("e")
    return df.select("o_orderkey", "l_linenumber", x.consistent_end(s, e).alias("end_day"), x.has_date_conflict(s, e).alias("conflict"), x.duration_days(s, e).alias("days"))


@query("""SELECT l_orderkey, a + b AS played, a + b > 3 AS overtime, abs(a - b) AS gap, a - b AS diff FROM
(SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'O') AS a, count(*) FILTER (WHERE l_linestatus = 'F') AS b FROM lineitem GROUP BY l_orderkey)""")
def overtime_flags(spark, d):
    df = r.count_filtered(load(spark, d, "lineitem"), ["l_orderkey"], a=c("l_linestatus") == "O", b=c("l_linestatus") == "F")
    played, overtime = x.rounds_and_overtime(c("a"), c("b"), 3)
    return df.select("l_orderkey", played.alias("played"), overtime.alias("overtime"), x.score_gap(c("a"), c("b")).alias("gap"), (c("a") - c("b")).alias("diff"))


@query("""SELECT l_suppkey, round(a / nullif(b, 0), 9) AS ratio, round(a / nullif(z, 0), 9) AS none FROM
(SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'R') AS b, count(*) FILTER (WHERE l_returnflag = 'Z') AS z FROM lineitem GROUP BY l_suppkey)""")
def safe_ratios(spark, d):
    flag = c("l_returnflag")
    df = r.count_filtered(load(spark, d, "lineitem"), ["l_suppkey"], a=flag == "A", b=flag == "R", z=flag == "Z")
    return df.select("l_suppkey", F.round(x.safe_ratio(c("a"), c("b")), 9).alias("ratio"), F.round(x.safe_ratio(c("a"), c("z")), 9).alias("none"))


@query("""SELECT o_orderkey, CASE WHEN t = 'BUILDING' THEN 1 WHEN t = 'MACHINERY' THEN 2 END AS side, CASE WHEN t = 'BUILDING' THEN o_totalprice > 100000 WHEN t = 'MACHINERY' THEN 100000 > o_totalprice END AS won,
t = 'FURNITURE' AS is_decider, CASE WHEN t = 'BUILDING' THEN o_orderpriority END AS picked_by FROM (SELECT o_orderkey, o_totalprice, o_orderpriority, c_mktsegment AS t FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 4 <> 0)""")
def side_of_team(spark, d):
    df = r.attach(load(spark, d, "orders"), load(spark, d, "customer").filter(c("c_custkey") % 4 != 0), {"o_custkey": "c_custkey"}, {"c_mktsegment": "t"})
    df = df.withColumn("side", x.side_of_team(c("t"), lit("BUILDING"), lit("MACHINERY")))
    action = F.when(c("t") == "FURNITURE", "decider").when(c("t") == "BUILDING", "pick").when(c("t").isNotNull(), "ban")
    pick = x.pick_attributes(action, c("o_orderpriority"), lit("1-URGENT"), lit("2-HIGH"))
    return df.select("o_orderkey", "side", x.won_map(c("side"), c("o_totalprice"), lit(100000.0)).alias("won"), pick["is_decider"].alias("is_decider"), pick["picked_by"].alias("picked_by"))


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def as_day(spark, d):
    return load(spark, d, "events").groupBy(x.as_day(c("ts")).alias("day"), "event_type").agg(F.count(lit(1)).alias("n"))


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def attach_left(spark, d):
    df = r.attach(load(spark, d, "orders"), load(spark, d, "customer"), {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey"])
    return r.attach_tier(df, load(spark, d, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name"]).select("o_orderkey", "c_name", "n_name")


@query("SELECT o_orderkey, flag, status FROM orders LEFT JOIN (SELECT l_orderkey, min(l_returnflag) AS flag, min(l_linestatus) AS status FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_orderkey) ON o_orderkey = l_orderkey")
def attach_pick(spark, d):
    picks = r.pick_per_map(load(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", "l_linestatus", ("A", "R"))
    return r.attach(load(spark, d, "orders"), picks, {"o_orderkey": "l_orderkey"}, {"l_returnflag": "flag", "l_linestatus": "status"}).select("o_orderkey", "flag", "status")


@query("""SELECT event_id, day_clicks, day_clicks = value_side AS converted FROM (SELECT event_id, CAST(floor(value) AS BIGINT) % 3 AS value_side, user_id, CAST(ts AS DATE) AS day FROM events)
LEFT JOIN (SELECT user_id AS u, CAST(ts AS DATE) AS dd, count(*) AS day_clicks FROM events WHERE event_type = 'click' GROUP BY 1, 2) ON user_id = u AND day = dd""")
def opener_conversion(spark, d):
    events = load(spark, d, "events").withColumn("day", x.as_day(c("ts")))
    clicks = events.filter(c("event_type") == "click").groupBy("user_id", "day").agg(F.count(lit(1)).alias("day_clicks"))
    df = r.attach(events, clicks, ["user_id", "day"], ["day_clicks"])
    return df.select("event_id", "day_clicks", (c("day_clicks") == F.floor("value") % 3).alias("converted"))


@query("""SELECT o_orderkey, stated, counted FROM (SELECT o_orderkey, o_orderkey % 5 AS stated FROM orders) JOIN (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS counted FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE stated <> counted""")
def recount_mismatch(spark, d):
    stated = load(spark, d, "orders").select("o_orderkey", (c("o_orderkey") % 5).alias("stated"))
    counted = r.count_filtered(load(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], counted=c("l_returnflag") == "A")
    return r.reconcile(stated, counted, ["o_orderkey"], {"stated": "counted"}).select("o_orderkey", "stated", "counted")


@query("""SELECT event_id, user_id, count(*) FILTER (WHERE event_type = 'click') OVER w AS clicks_before, count(*) FILTER (WHERE event_type = 'purchase') OVER w AS purchases_before FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def score_before(spark, d):
    df = load(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return r.score_before(df, ["user_id"], ["ts", "event_id"], "event_type", {"click": "clicks_before", "purchase": "purchases_before"}).select("event_id", "user_id", "clicks_before", "purchases_before")


@query("""SELECT 'b' || event_id AS k, count(*) FILTER (WHERE event_type = 'click') OVER w AS clicks_before, count(*) FILTER (WHERE event_type = 'purchase') OVER w AS purchases_before FROM events
WINDOW w AS (PARTITION BY user_id % 3 = 0 ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def score_before_in_blocks(spark, d):
    """Two partitions hold all events, so each is counted in several blocks."""
    df = load(spark, d, "events").select("event_id", (c("user_id") % 3 == 0).alias("third"), "event_type", "ts")
    counted = r.score_before(df, ["third"], ["ts", "event_id"], "event_type", {"click": "clicks_before", "purchase": "purchases_before"}, largest=max(100, df.count() // 8))
    return counted.select(x.readable_key(lit("b"), "event_id", sep="").alias("k"), "clicks_before", "purchases_before")


@query("SELECT o_orderkey, coalesce(n, 0) AS lines, first_ship FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_shipdate) AS first_ship FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) ON o_orderkey = l_orderkey")
def guarded_attach(spark, d):
    """Every order once, however many lines meet it, with their number and the least of them."""
    lines = load(spark, d, "lineitem").filter(c("l_returnflag") != "N")
    return r.attach_one(load(spark, d, "orders").select("o_orderkey"), lines, {"o_orderkey": "l_orderkey"}, {"l_shipdate": "first_ship"}, matches="lines")


EVENTS = TableSpec("events", "user_id bigint, event_type string, value double, first_id bigint", ("user_id",), ("first_id",))


@query("""WITH a AS (SELECT * FROM events WHERE event_id % 3 < 2), b AS (SELECT * FROM events WHERE event_id % 3 > 0),
la AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, max(event_id) AS first_id FROM a GROUP BY 1),
lb AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, max(event_id) AS first_id FROM b GROUP BY 1)
SELECT coalesce(lb.user_id, la.user_id) AS user_id, CASE WHEN lb.user_id IS NULL THEN la.event_type ELSE lb.event_type END AS event_type, CASE WHEN lb.user_id IS NULL THEN la.value ELSE lb.value END AS value,
CASE WHEN la.user_id IS NULL THEN lb.first_id ELSE la.first_id END AS first_id FROM la FULL JOIN lb ON la.user_id = lb.user_id""")
def last_wins_upsert(spark, d):
    events = load(spark, d, "events").select("user_id", "event_type", "value", c("event_id").alias("first_id"), c("event_id").alias("seen"))
    one, two = events.filter(c("seen") % 3 < 2), events.filter(c("seen") % 3 > 0)
    empty = readers.empty(spark, EVENTS.schema)
    return upsert(upsert(empty, one, EVENTS, "seen").table, two, EVENTS, "seen").table


@query("""SELECT 'order:' || o_orderkey AS k, 'orders' AS source, CAST(o_orderdate AS DATE) AS day, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS kind FROM orders
UNION ALL SELECT 'event:' || event_id, 'events', CAST(ts AS DATE), value, event_type FROM events""")
def union_common_shape(spark, d):
    shape = {"k": "string", "source": "string", "day": "date", "amount": "double", "kind": "string"}
    one = {"k": x.readable_key(lit("order"), "o_orderkey"), "source": lit("orders"), "day": x.as_day(c("o_orderdate")), "amount": c("o_totalprice")}
    two = {"k": x.readable_key(lit("event"), "event_id"), "source": lit("events"), "day": x.as_day(c("ts")), "amount": c("value"), "kind": c("event_type")}
    return r.union_common_shape([(load(spark, d, "orders"), one), (load(spark, d, "events"), two)], shape)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, true AS readable, CAST(NULL AS BIGINT) AS missing FROM events")
def typed_props(spark, d):
    record = F.try_parse_json("props")
    field = lambda path: coerce.lossy_int(F.try_variant_get(record, path, "variant"))
    return load(spark, d, "events").select("event_id", field("$.k").alias("k"), coerce.json_readable(c("props")).alias("readable"), field("$.absent").alias("missing"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity FROM lineitem WHERE l_returnflag <> 'N'")
def unfold_nested(spark, d):
    rows = load(spark, d, "lineitem").withColumn("flag", F.when(c("l_returnflag") != "N", c("l_returnflag")))
    folded = nested.fold(rows, ["l_orderkey"], "lines", "l_linenumber", ["l_partkey", "flag", "l_quantity"])
    stored = folded.select("l_orderkey", F.to_json(F.struct("lines")).alias("document"))
    schema = readers.T.StructType.fromDDL("lines array<struct<l_linenumber: int, l_partkey: bigint, flag: string, l_quantity: double>>")
    parsed = nested.parse_document(stored, schema)
    out = nested.unfold(parsed, c("doc.lines"), "line", ["l_orderkey"]).select("l_orderkey", "line.l_linenumber", "line.l_partkey", c("line.flag").alias("l_returnflag"), "line.l_quantity")
    return out.filter(c("l_returnflag").isNotNull())


@query("""SELECT l_orderkey, CAST(coalesce(sum(q) FILTER (WHERE l_returnflag = 'A'), 0) AS BIGINT) AS a_rounds, CAST(coalesce(sum(q) FILTER (WHERE l_returnflag = 'R'), 0) AS BIGINT) AS r_rounds, arg_min(l_returnflag, {'n': l_linenumber, 'q': q, 'f': l_returnflag}) AS first_role,
CAST(arg_min(q, {'n': l_linenumber, 'q': q, 'f': l_returnflag}) AS INTEGER) AS side_1_first, CAST(list(q ORDER BY l_linenumber, q, l_returnflag)[2] AS INTEGER) AS side_2_first FROM (SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_quantity AS INTEGER) AS q FROM lineitem) GROUP BY l_orderkey""")
def rounds_by_role(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", c("l_quantity").cast("int").alias("rounds"), c("l_returnflag").alias("side"))
    folded = nested.fold(rows, ["l_orderkey"], "halves", "l_linenumber", ["rounds", "side"])
    stats = F.struct(F.transform("halves", lambda h: h["rounds"].cast("string")).alias("first"))
    return folded.select("l_orderkey", x.rounds_by_role(c("halves"), "A").alias("a_rounds"), x.rounds_by_role(c("halves"), "R").alias("r_rounds"), x.starting_side(F.array("halves")).alias("first_role"), *[v.alias(k) for k, v in x.team_stat_columns(stats, ["first"]).items()])


@query("""SELECT l_orderkey, l_linenumber, q * 60 + p AS seconds, q AS won, p AS played, CAST(NULL AS INTEGER) AS broken FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS q, CAST(l_partkey % 60 AS INTEGER) AS p FROM lineitem)""")
def clock_and_fraction(spark, d):
    q, p = c("l_quantity").cast("int").cast("string"), (c("l_partkey") % 60).cast("string")
    won, played = x.fraction_parts(F.concat(q, lit("/"), p))
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", x.clock_to_seconds(F.concat(q, lit(":"), p)).alias("seconds"), won.alias("won"), played.alias("played"), x.clock_to_seconds(q).alias("broken"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS DOUBLE) + 1000 END AS money, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS INTEGER) END AS teams,
CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 7 AS BIGINT) END AS epoch, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(epoch(o_orderdate) AS BIGINT) END AS revised FROM orders""")
def strict_dates_amounts(spark, d):
    k, day = c("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    date = F.when(k % 3 == 0, F.concat(F.substring(day, 1, 8), lit("??"))).otherwise(day)
    money = F.when(k % 4 == 0, "{{:x/prizepool}}").otherwise(F.concat(lit("$"), F.format_number(c("o_custkey") + 1000, 0)))
    teams = F.when(k % 5 == 0, "many").otherwise(F.concat(lit(" "), c("o_custkey").cast("string"), lit(" ")))
    instant = F.when(k % 3 == 0, "soon").otherwise(F.concat(day, lit("T00:00:00Z")))
    return load(spark, d, "orders").select(
        "o_orderkey", coerce.strict_iso_date(date).alias("day"), coerce.amount(money).alias("money"), coerce.count_value(teams).alias("teams"), F.unix_seconds(coerce.epoch_to_ts(k % 7)).alias("epoch"), F.unix_seconds(coerce.iso_timestamp(instant)).alias("revised")
    )


@query("SELECT conv_id || '#' || turn AS k, conv_id, turn, role, CASE WHEN role = 'user' THEN text END AS said FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL")
def veto_order(spark, d):
    rows = load(spark, d, "conversations").filter(c("conv_id").isNotNull() & c("turn").isNotNull())
    steps = rows.select("conv_id", "turn", "role", F.when(c("role") == "user", c("text")).alias("said"))
    folded = nested.fold(steps, ["conv_id"], "steps", "turn", ["role", "said"])
    out = nested.unfold(folded, c("steps"), "s", ["conv_id"])
    return out.select(x.readable_key("conv_id", c("s.turn"), sep="#").alias("k"), "conv_id", "s.turn", "s.role", "s.said")


@query("""SELECT match_title, CAST(rank AS INTEGER) AS rank, latest_start FROM (SELECT 'Match:' || o_orderkey AS match_title, min(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 3 ELSE 5 END) AS rank,
max(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END) AS latest_start, max(o_orderstatus) AS st, max(o_orderdate) AS seen FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_custkey % 11 = 0 OR CAST(o_orderdate AS DATE) <= DATE '1998-01-01' GROUP BY o_orderkey) WHERE rank <= 3 AND (st = 'P' OR (st <> 'F' AND seen < TIMESTAMP '1997-12-29')) ORDER BY rank, latest_start DESC NULLS LAST, match_title LIMIT 50""")
def priority_queue(spark, d):
    now, w = datetime(1998, 1, 1), lit("w").alias("wiki")
    segment = {"BUILDING": "s", "MACHINERY": "a-tier", "FURNITURE": "B-Tier"}
    tier = F.when(c("c_mktsegment") == "BUILDING", segment["BUILDING"])
    for name in ("MACHINERY", "FURNITURE"):
        tier = tier.when(c("c_mktsegment") == name, segment[name])
    orders = load(spark, d, "orders")
    both = orders.join(load(spark, d, "customer"), c("o_custkey") == c("c_custkey"))
    title = x.readable_key(lit("Match"), "o_orderkey").alias("match_title")
    tournaments = both.select(w, c("o_orderkey").alias("page_id"), tier.alias("tier"), F.when(c("c_custkey") % 11 != 0, x.as_day(c("o_orderdate"))).alias("start_date"))
    links = orders.select(w, c("o_orderkey").alias("tournament_page_id"), title)
    pages = orders.filter(c("o_orderstatus") != "P").select(w, title.alias("page_title"), F.when(c("o_orderstatus") == "F", "finished").otherwise("upcoming").alias("status"), c("o_orderdate").cast("timestamp").alias("refreshed_at"))
    return priority.priority_queue(links, tournaments, pages, "w", 3, now, 50)


def _middle(events: DataFrame) -> int:
    """The id in the middle between the lowest and the highest; 0 of an empty table."""
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    return 0 if low is None else (low + high) // 2


_MIDDLE_SQL = "(SELECT (min(event_id) + max(event_id)) // 2 FROM events)"


@query(f"SELECT event_id, event_type FROM events WHERE event_id < {_MIDDLE_SQL} ORDER BY event_id DESC LIMIT 100")
def page_below_middle(spark, d):
    events = load(spark, d, "events").select("event_id", "event_type")
    return inc.page_below(events, "event_id", _middle(events), 100)


@query(f"SELECT event_id, event_type FROM events WHERE event_id < {_MIDDLE_SQL} ORDER BY event_id DESC LIMIT 300")
def stored_page_below(spark, d):
    """A page of a table that is stored by id, in files of some hundred rows, of which it opens a handful."""
    events, path = load(spark, d, "events").select("event_id", "event_type"), scratch_dir(spark, "paged")
    paged.write_by_id(events, "event_id", path, max(100, events.count() // 50))
    return paged.stored_page(spark, path, "event_id", _middle(events), 300)


@query("""WITH b AS (SELECT max(event_id) - 250 AS high FROM events), n AS (SELECT count(*) AS n FROM events, b WHERE event_id > high),
s AS (SELECT event_id FROM events ORDER BY event_id DESC LIMIT (SELECT 100 * least(10, n // 100 + 1) FROM n))
SELECT min(event_id) AS lowest, max(event_id) AS highest, count(*) AS records, bool_or(event_id <= high) AS reached_known FROM s, b""")
def catchup_slice(spark, d):
    events = load(spark, d, "events").select("event_id")
    high = events.agg(F.max("event_id")).first()[0] - 250
    state = inc.State(high, 0, 0)
    return r.walk_bounds(inc.catchup_slice(events, "event_id", state, 100, 10), "event_id", high)


@query(f"SELECT event_id FROM events WHERE event_id < {_MIDDLE_SQL} ORDER BY event_id DESC LIMIT 300")
def backfill_slice_middle(spark, d):
    events = load(spark, d, "events").select("event_id")
    middle = _middle(events)
    return inc.backfill_slice(events, "event_id", inc.State(2 * middle, middle), 100, 3)


@query("""WITH w AS (SELECT user_id, min(event_id) AS lowest, max(event_id) AS highest, count(*) AS records FROM events GROUP BY 1),
t AS (SELECT *, CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id * 40 END AS high, CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id * 10 END AS low, user_id % 2 = 0 AS back FROM w), k AS (SELECT *, coalesce(lowest <= high, false) AS reached FROM t)
SELECT user_id, greatest(highest, high) AS new_high, CASE WHEN back OR reached THEN least(lowest, low) ELSE lowest END AS new_low, 7 + records AS new_seen,
CASE WHEN user_id % 13 = 0 THEN 'failed' WHEN reached THEN 'caught_up' WHEN user_id % 3 <> 0 THEN 'exhausted' ELSE 'page_limit' END AS stop_reason, NOT back AND high IS NOT NULL AND NOT reached AS gap FROM k""")
def state_advance(spark, d):
    u = c("user_id")
    walks = load(spark, d, "events").groupBy("user_id").agg(F.min("event_id").alias("lowest"), F.max("event_id").alias("highest"), F.count(lit(1)).alias("records"))
    df = walks.withColumns({"high_watermark": F.when(u % 4 != 0, u * 40), "backfill_cursor": F.when(u % 4 != 0, u * 10), "records_seen": lit(7), "mode": F.when(u % 2 == 0, inc.BACKFILL).otherwise(inc.CATCHUP), "more": u % 3 == 0, "failed": u % 13 == 0, "pages": lit(1)})
    df = df.withColumn("reached_known", F.coalesce(c("lowest") <= c("high_watermark"), lit(False)))
    return inc.advance_columns(df).select("user_id", "new_high", "new_low", "new_seen", "stop_reason", "gap")


def _violations(*rows: tuple[str, str, str, str]) -> str:
    one = "SELECT '{0}' AS \"check\", '{1}' AS \"table\", '{2}' AS severity, v AS violations, CASE WHEN v IS NULL THEN 'skipped' WHEN v > 0 THEN 'failed' ELSE 'passed' END AS status FROM ({3}) AS q(v)"
    return " UNION ALL ".join(one.format(*row) for row in rows)


def _dup(table: str, keys: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM (SELECT {keys} FROM {table} WHERE {where} GROUP BY {keys} HAVING count(*) > 1)"


DQ_SQL = _violations(
    ("discount_sane", "lineitem", "error", "SELECT count(*) FROM lineitem WHERE l_discount > 0.05"), ("ship_after_1995", "lineitem", "warn", "SELECT count(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-01'"), ("line_unique", "lineitem", "warn", _dup("lineitem", "l_orderkey, l_linenumber")),
    ("price_positive", "orders", "error", "SELECT count(*) FROM orders WHERE o_totalprice <= 0"), ("order_unique", "orders", "error", _dup("orders", "o_orderkey")), ("props_readable", "events", "error", "SELECT count(*) FROM events WHERE props IS NULL OR NOT json_valid(props)"), ("absent", "shipments", "error", "SELECT CAST(NULL AS BIGINT)"),
)


def _dq(spark, d):
    tables = {t: load(spark, d, t) for t in ("lineitem", "orders", "events")}
    checks = [
        quality.Check("discount_sane", "lineitem", rows_where=c("l_discount") > 0.05), quality.Check("ship_after_1995", "lineitem", quality.WARN, c("l_shipdate") < lit("1995-01-01").cast("timestamp_ntz")), quality.Check("line_unique", "lineitem", quality.WARN, unique=("l_orderkey", "l_linenumber")),
        quality.Check("price_positive", "orders", rows_where=c("o_totalprice") <= 0), quality.Check("order_unique", "orders", unique=("o_orderkey",)), quality.Check("props_readable", "events", rows_where=c("props").isNull() | ~coerce.json_readable(c("props"))), quality.Check("absent", "shipments", rows_where=lit(True)),
        quality.Check("price_positive", "orders", rows_where=c("o_totalprice") <= 0),
    ]
    return quality.run_checks(spark, tables, checks)


@query(DQ_SQL)
def dq_summary(spark, d):
    return _dq(spark, d)


@query(f"SELECT coalesce(bool_or(severity = 'error' AND status = 'failed'), false) AS blocked FROM ({DQ_SQL})")
def dq_blocking(spark, d):
    return quality.blocking(_dq(spark, d))


@query(_violations(
    ("p_name_not_null", "part", "error", "SELECT count(*) FROM part WHERE p_name IS NULL"), ("p_size_range", "part", "error", "SELECT count(*) FROM part WHERE p_size < 5 OR p_size > 40"), ("p_partkey_unique", "part", "error", _dup("part", "p_partkey")), ("p_type_accepted", "part", "error", "SELECT count(*) FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO')"),
    ("o_orderstatus_accepted", "orders", "error", "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"), ("o_totalprice_range", "orders", "error", "SELECT count(*) FROM orders WHERE o_totalprice < 1000"),
))
def dq_values_range(spark, d):
    checks = [
        quality.not_null("part", "p_name"), quality.accepted_range("part", "p_size", 5, 40), quality.unique("part", "p_partkey"), quality.accepted_values("part", "p_type", ["ECONOMY", "PROMO"]), quality.accepted_values("orders", "o_orderstatus", ["F", "O"]), quality.accepted_range("orders", "o_totalprice", 1000),
    ]
    return quality.run_checks(spark, {t: load(spark, d, t) for t in ("part", "orders")}, checks)


@query("SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(spark, d):
    return r.duplicates(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT 'orders' AS discipline, lower(trim(o_orderpriority)) AS tier_key, count(*) AS tournaments FROM orders WHERE lower(trim(o_orderpriority)) NOT IN ('1-urgent', '3-medium') GROUP BY 2")
def dq_unknown_vocab(spark, d):
    seed = priority_seed(spark).filter(c("tier_key").isin("1-urgent", "3-medium")).withColumn("tier_label", c("tier_key"))
    orders = load(spark, d, "orders").select(lit("orders").alias("discipline"), x.fold_key(c("o_orderpriority")).alias("tier_key"))
    return r.unknown_tiers(r.attach_tier(orders, seed, ["tier_key"], ["tier_label"]))


@query("SELECT CAST(epoch(TIMESTAMP '2024-06-01') AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT) AS age_seconds, CASE WHEN max(ts) < TIMESTAMP '2024-06-01' - INTERVAL 7 DAY THEN 'error' WHEN max(ts) < TIMESTAMP '2024-06-01' - INTERVAL 2 DAY THEN 'warn' ELSE 'passed' END AS status FROM events")
def dq_freshness(spark, d):
    from datetime import timezone

    return quality.freshness(load(spark, d, "events"), "ts", datetime(2024, 6, 1, tzinfo=timezone.utc), timedelta(days=2), timedelta(days=7))


@query("SELECT page_id, md5(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<!--.*', '', 'gs')) AS h FROM pages")
def strip_comments(spark, d):
    return load(spark, d, "pages").select("page_id", F.md5(text.strip_comments(c("html")).cast("binary")).alias("h"))


@query("""SELECT page_id, md5(regexp_replace(html, '\\s(?:class|href)="[^"]*"', '', 'g')) AS h FROM pages""")
def slim_html(spark, d):
    return load(spark, d, "pages").select("page_id", F.md5(text.slim_html(c("html"), ("class", "href")).cast("binary")).alias("h"))


@query("""SELECT doc_id, CAST(len(n) AS INTEGER) AS numbers, round(coalesce(list_sum(list_transform(n, lambda v: least(CAST(v AS DOUBLE), 1e6))), 0), 4) AS total, TRY_CAST(nullif(regexp_extract(text, '(\\d+)', 1), '') AS BIGINT) AS first FROM (SELECT doc_id, text, regexp_extract_all(text, '(\\d+(?:\\.\\d+)?)') AS n FROM documents)""")
def numbers_in_text(spark, d):
    found = text.numbers_in(c("text"))
    total = F.aggregate(found, lit(0.0), lambda a, v: a + F.least(v, lit(1e6)))
    return load(spark, d, "documents").select("doc_id", F.size(found).alias("numbers"), F.round(total, 4).alias("total"), text.first_int(c("text")).alias("first"))


@query("""SELECT doc_id, nullif(trim(regexp_replace(replace(replace('x' || chr(160) || text || ' a' || chr(8209) || 'b', chr(160), ' '), chr(8209), '-'), '\\s+', ' ', 'g')), '') AS cleaned FROM documents""")
def clean_text(spark, d):
    spoiled = F.concat(lit("x "), c("text"), lit(" a‑b"))
    return load(spark, d, "documents").select("doc_id", text.clean_text(spoiled).alias("cleaned"))


def _markup_sql(column: str) -> str:
    """The steps of `strip_markup` for a column, in the dialect of the checking engine."""
    for pattern, to in (("(?s)<!--.*?-->", ""), ("(?i)<br\\s*/?>", " "), ("\\[(?:https?:)?//[^\\s\\]]+\\s+([^\\]]*)\\]", "\\1"), ("\\[(?:https?:)?//[^\\s\\]]+\\]", ""), ("\\[\\[(?:[^\\]|]*\\|)?([^\\]|]*)\\]\\]", "\\1"), *[("\\{\\{[^{}]*\\}\\}", "")] * 6, ("</?[a-zA-Z][^>]*>", ""), ("''{2,5}", ""), ("\\s+", " ")):
        column = f"regexp_replace({column}, '{pattern}', '{to}', 'g')"
    return f"trim({column})"


_MARKED = "'[[Page|name]] ' || text || ' {{a|' || chr(10) || '{{b|' || text || '}}}} one<br/>two <i>[https://x.org' || chr(10) || 'label]</i> <!-- no' || chr(10) || text || ' -->{{c}}'"


@query(f"SELECT doc_id, {_markup_sql('w')} AS readable FROM (SELECT doc_id, {_MARKED} AS w FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))")
def strip_markup_text(spark, d):
    """Whole texts, with what marks they have, between markup, and once more inside a comment and inside templates."""
    text = F.coalesce("text", lit(""))
    wiki = F.concat(lit("'''[[Page|name]]''' "), text, lit(" {{a|\n{{b|"), text, lit("}}}} one<br/>two <i>[https://x.org\nlabel]</i> <!-- no\n"), text, lit(" -->{{c}}"))
    return load(spark, d, "documents").select("doc_id", strip_markup(wiki).alias("readable"))


def _wikitext() -> F.Column:
    return F.concat(lit("before <!-- {{Infobox league|name=no}} --> {{Infobox League|Name= [["), c("p_name"), lit("|"), c("p_brand"), lit("]]|liquipediatier="), c("p_type"), lit("|sdate=2024-01-0"), (c("p_partkey") % 9 + 1).cast("string"), lit("|edate=2024-??|prizepoolusd=$"), F.format_number(c("p_partkey") * 1000, 0), lit("|team_number= "), c("p_size").cast("string"), lit(" |format={{Abbr/Bo3|x=y}}|positional}} after"))


@query("""SELECT p_partkey AS page_id, p_brand AS name, p_type AS tier, CAST('2024-01-0' || (p_partkey % 9 + 1) AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, CAST(p_partkey * 1000 AS DOUBLE) AS prize_pool_usd, CAST(p_size AS INTEGER) AS team_count FROM part""")
def infobox_fields(spark, d):
    from rankwell.operators.extract import extract_infobox

    pages = readers.dealt_for_pages(load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")).select(lit("dota2").alias("wiki"), c("p_partkey").alias("pageid"), c("p_name").alias("title"), lit("2024-01-01T00:00:00Z").alias("revised_at"), extract_infobox(_wikitext(), "Infobox league").alias("fields"))
    return readers.normalize_tournaments(pages, datetime(2024, 1, 1)).select("page_id", "name", "tier", "start_date", "end_date", "prize_pool_usd", "team_count")


def match_html() -> F.Column:
    k, n = c("o_orderkey"), lambda e: e.cast("string")
    team = lambda name: F.concat(lit('<div class="match-bm-match-header-team"><span class="match-bm-match-header-team-long"><a title="'), name, lit('">'), name, lit("</a></span></div>"))
    body = F.concat(
        lit('<div class="match-bm"><div class="match-bm-match-header-date"><span data-timestamp="'), n(k + 1), lit('" data-finished="finished"></span></div>'), team(F.concat(lit("T"), n(c("o_custkey")))), team(F.concat(lit("T"), n(c("o_custkey") + 1))),
        lit('<div class="match-bm-match-header-result">'), n(k % 4), lit(" ‑ "), n(k % 3), lit('</div><div class="match-bm-map-veto-card match-bm-map-veto-card--ban"><span class="match-bm-map-veto-card-map-name">Bind</span></div>'),
        lit('<div class="match-bm-lol-game-summary"><div class="match-bm-lol-game-summary-map">Haven</div><div class="match-bm-lol-game-summary-score">13 : '), n(k % 12), lit('</div><div class="match-bm-lol-game-summary-length">40:05</div></div></div>'),
    )
    return F.when(k % 5 != 0, body).otherwise("<p>nothing</p>")


def order_pages(spark: SparkSession, d: str, html: F.Column) -> DataFrame:
    """A page for every order; what is dealt out are the numbers that it is made of."""
    return readers.dealt_for_pages(load(spark, d, "orders").select("o_orderkey", "o_custkey")).select(c("o_orderkey").alias("page_id"), html.alias("html"))


@query("""SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 5 = 0 THEN 'unparsed' ELSE 'finished' END AS status, CASE WHEN o_orderkey % 5 <> 0 THEN 'T' || o_custkey END AS team_1, CASE WHEN o_orderkey % 5 <> 0 THEN 'T' || (o_custkey + 1) END AS team_2,
CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 4 AS INTEGER) END AS score_1, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS score_2, CASE WHEN o_orderkey % 5 <> 0 THEN 1 ELSE 0 END AS map_count FROM orders
UNION ALL SELECT -page_id - 1, 'unparsed', NULL, NULL, NULL, NULL, 0 FROM pages""")
def match_page_documents(spark, d):
    from rankwell.operators.extract import extract_match_pages

    built = order_pages(spark, d, match_html())
    both = built.unionByName(load(spark, d, "pages").select((-c("page_id") - 1).alias("page_id"), "html"))
    pages = extract_match_pages(both.select(lit("valorant").alias("wiki"), c("page_id").cast("string").alias("page_title"), "page_id", lit(0).alias("revision_id"), "html"), deal=False)
    return readers.normalize_match_page(pages, datetime(2024, 1, 1)).select("page_id", "status", "team_1", "team_2", "score_1", "score_2", "map_count")


@query("SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM pages) AS pages, CAST(0 AS BIGINT) AS differing, (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) + (SELECT count(*) FROM pages) AS without_block")
def reparse_all_pages(spark, d):
    """Every order page and every row of pages, with a match block or without."""
    from rankwell.operators.extract import extract_match_pages, reparse_stored

    built = order_pages(spark, d, match_html())
    both = built.unionByName(load(spark, d, "pages").select((-c("page_id") - 1).alias("page_id"), "html"))
    stored = extract_match_pages(both, deal=False, slim="html")
    return reparse_stored(stored, deal=False).agg(F.count(lit(1)).alias("pages"), F.count_if("differs").alias("differing"), F.count_if(c("html").isNull()).alias("without_block"))


@query("""SELECT o_orderkey + 1 AS match_id, CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 3 ELSE CAST(o_orderkey % 4000 AS INTEGER) END AS duration_seconds, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS radiant_win,
CASE WHEN o_orderkey % 7 <> 0 THEN 'C' || o_custkey END AS radiant_name, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 9 AS BIGINT) END AS start_epoch, o_custkey AS league_id FROM orders WHERE o_orderkey % 10 <> 3""")
def landing_matches(spark, d):
    k = c("o_orderkey")
    raw = lambda e: F.to_json(F.struct(e.alias("v"))).substr(6, 1_000_000)
    value = lambda e: F.substring_index(raw(e), "}", 1)
    field = lambda name, e: F.concat(lit(f'"{name}":'), e)
    record = F.concat(
        lit("{"), field("match_id", F.when(k % 10 == 3, '"x"').otherwise((k + 1).cast("string"))), lit(","), field("duration", F.when(k % 6 == 0, '"unknown"').when(k % 6 == 1, "3.7").otherwise((k % 4000).cast("string"))), lit(","), field("start_time", (k % 9).cast("string")), lit(","),
        field("radiant_win", F.when(k % 4 == 0, '"yes"').when(k % 2 == 0, "true").otherwise("false")), lit(","), field("radiant_name", F.when(k % 7 == 0, '"  "').otherwise(value(F.concat(lit("C"), c("o_custkey").cast("string"))))), lit(","), field("leagueid", F.concat(lit('"'), c("o_custkey").cast("string"), lit('"'))), lit("}"),
    )
    path = scratch_dir(spark, "landing")
    load(spark, d, "orders").select(record.alias("value")).write.text(path)
    rows = readers.normalize_matches(readers.read_match_landing(spark, path, multi_line=False), datetime(2024, 1, 1))
    return rows.select("match_id", "duration_seconds", "radiant_win", "radiant_name", F.unix_seconds("start_time").alias("start_epoch"), "league_id")


@query("""SELECT o_orderkey + 1 AS match_id, CAST(o_orderkey % 100000 + 1 AS BIGINT) AS start_epoch, CAST(o_orderkey % 4000 AS INTEGER) AS duration_seconds, o_custkey AS radiant_team_id, CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'C} ' END || o_custkey AS radiant_name,
CASE WHEN o_orderkey % 7 > 0 THEN o_custkey + 1 END AS dire_team_id, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS dire_name, CAST(o_orderkey % 50 AS INTEGER) AS radiant_score, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey % 50 AS INTEGER) END AS dire_score,
CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS radiant_win, o_orderkey % 90 AS league_id, o_orderstatus AS league_name, o_orderkey % 300 AS series_id, CAST(o_orderkey % 3 AS INTEGER) AS series_type, CAST(o_custkey % 30 AS INTEGER) AS parse_version,
'2024-01-01' AS seen_first, '2024-01-01' AS seen_last, o_orderkey + 1 AS kept_id FROM orders""")
def landing_arrays(spark, d):
    """Every column of landed matches. Lists come as arrays: even orders in files of flat records, cut between records,
    odd ones with braces in texts, which are read whole; ids as texts, unreadable values, missing fields."""
    k, cust, path = c("o_orderkey"), c("o_custkey"), scratch_dir(spark, "arrays")
    text_of = lambda e: e.cast("string")
    record = F.to_json(F.struct(
        text_of(k + 1).alias("match_id"), (k % 4000).alias("duration"), (k % 100_000 + 1).alias("start_time"), text_of(cust).alias("radiant_team_id"), F.concat(F.when(k % 2 == 0, "C").otherwise("C} "), text_of(cust)).alias("radiant_name"),
        F.when(k % 7 > 0, text_of(cust + 1)).otherwise("none").alias("dire_team_id"), F.when(k % 5 > 0, c("o_orderpriority")).otherwise(" ").alias("dire_name"), (k % 90).alias("leagueid"), c("o_orderstatus").alias("league_name"), (k % 300).alias("series_id"), (k % 3).alias("series_type"),
        (k % 50).alias("radiant_score"), F.when(k % 3 > 0, cust % 50).alias("dire_score"), F.when(k % 4 == 0, lit("yes")).otherwise((k % 2 == 0).cast("string")).alias("radiant_win"), text_of(cust % 30).alias("version"),
    ))
    record = F.regexp_replace(record, '"(true|false)"', "$1")
    parts = load(spark, d, "orders").groupBy((k % 2).alias("odd"), F.floor(k / 5000).alias("file")).agg(F.collect_list(record).alias("records"))
    parts.select("odd", F.concat(lit("[\n"), F.array_join("records", ",\n "), lit("]\n")).alias("value")).write.option("maxRecordsPerFile", 1).partitionBy("odd").text(path)
    rows = readers.normalize_matches(readers.read_match_landing(spark, path), datetime(2024, 1, 1))
    day = lambda name: F.date_format(name, "yyyy-MM-dd")
    return rows.select(
        *[n for n in rows.columns if n not in ("start_time", "ingested_at", "refreshed_at", "payload")], F.unix_seconds("start_time").alias("start_epoch"), day("ingested_at").alias("seen_first"), day("refreshed_at").alias("seen_last"), F.get_json_object("payload", "$.match_id").cast("bigint").alias("kept_id")
    )


@query("""SELECT 'dota2' AS wiki, p_partkey AS page_id, p_name AS page_title, CAST(1706933106 AS BIGINT) AS revised_epoch, p_brand AS name, p_type AS series, 'O ' || p_partkey AS organizer, p_brand AS tier, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS tier_type, 'game' AS game, 'Offline' AS setting,
p_brand AS country, 'City ' || p_size AS city, CAST('2024-01-0' || (p_partkey % 9 + 1) AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, CAST(p_partkey * 10 AS DOUBLE) AS prize_pool_usd, p_partkey || ' EUR' AS prize_pool_local, 'eur' AS local_currency, CAST(p_size AS INTEGER) AS team_count, '2024-01-01' AS seen, p_brand AS kept_name FROM part""")
def infobox_columns(spark, d):
    """Every column of tournaments, from the infobox of a page for every part."""
    from rankwell.operators.extract import extract_infobox

    k = c("p_partkey").cast("string")
    fields = {
        "name": c("p_brand"), "series": F.concat(lit("[[x|"), c("p_type"), lit("]]")), "organizer": F.concat(lit("'''O''' "), k), "liquipediatier": c("p_brand"), "liquipediatiertype": F.when(c("p_partkey") % 3 > 0, c("p_type")).otherwise("{{none}}"), "game": lit("game"), "type": lit("Off<!-- - -->line"),
        "country": c("p_brand"), "city": F.concat(lit("City "), c("p_size").cast("string")), "sdate": F.concat(lit("2024-01-0"), (c("p_partkey") % 9 + 1).cast("string")), "edate": lit("2024-01-??"), "prizepoolusd": F.concat(lit("$"), F.format_number(c("p_partkey") * 10, 0)),
        "prizepool": F.concat(k, lit(" EUR")), "localcurrency": lit("eur"), "team_number": c("p_size").cast("string"),
    }
    wikitext = F.concat(lit("{{Infobox league"), *[F.concat(lit(f"\n|{name}="), value) for name, value in fields.items()], lit("\n}}"))
    pages = readers.dealt_for_pages(load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")).select(lit("dota2").alias("wiki"), c("p_partkey").alias("pageid"), c("p_name").alias("title"), lit("2024-02-03T04:05:06Z").alias("revised_at"), extract_infobox(wikitext, "Infobox league").alias("fields"))
    rows = readers.normalize_tournaments(pages, datetime(2024, 1, 1))
    kept = [n for n in rows.columns if n not in ("revised_at", "ingested_at", "refreshed_at", "infobox")]
    return rows.select(*kept, F.unix_seconds("revised_at").alias("revised_epoch"), F.date_format("refreshed_at", "yyyy-MM-dd").alias("seen"), F.get_json_object("infobox", "$.name").alias("kept_name"))


@query("""SELECT o_orderkey AS page_id, o_orderkey % 5 <> 0 AS has_block, false AS has_history, false AS has_style, o_orderkey % 5 <> 0 AS has_veto FROM orders UNION ALL SELECT -page_id - 1, false, false, false, false FROM pages""")
def stored_pages(spark, d):
    """What is stored of a page: its match block without history and heavy attributes, nothing where there is none."""
    from rankwell.operators.extract import extract_match_pages

    wrapped = F.concat(lit('<html><p style="x">above</p>'), F.regexp_replace(match_html(), "</div>$", '<div class="match-bm-match-additional">history</div><i style="y" src="z"></i></div>'), lit("<p>below</p></html>"))
    both = order_pages(spark, d, wrapped).unionByName(load(spark, d, "pages").select((-c("page_id") - 1).alias("page_id"), "html"))
    rows = readers.normalize_match_page(extract_match_pages(both.select(lit("valorant").alias("wiki"), c("page_id").cast("string").alias("page_title"), "page_id", lit(0).alias("revision_id"), "html"), deal=False, slim="html"), datetime(2024, 1, 1), stored=True)
    held = lambda what: F.coalesce(c("html").contains(what), lit(False))
    whole = held('<div class="match-bm">') & ~held("above") & ~held("below")
    return rows.select("page_id", whole.alias("has_block"), held("history").alias("has_history"), (held("style=") | held("src=")).alias("has_style"), held("veto-card--ban").alias("has_veto"))


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def listing_with_content(spark, d):
    return readers.merge_listing_with_content(load(spark, d, "documents").select("doc_id"), load(spark, d, "labels"), "doc_id").select("doc_id", "quality", "toxic")


@query("SELECT DISTINCT doc_id, w AS match_title FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> ''")
def flatten_links(spark, d):
    words = F.transform(F.split(F.lower("text"), " "), lambda w: F.nullif(w, lit("")))
    return readers.flatten_links(readers.dealt(load(spark, d, "documents").select("doc_id", "text")).select("doc_id", words.alias("links")), "doc_id", "links")


@query("SELECT url LIKE 'https://%' AS secure, count(*) AS n, count(nullif(url LIKE '%/en/%', false)) AS english, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages GROUP BY 1")
def like_and_counts(spark, d):
    pages = load(spark, d, "pages").withColumn("secure", ~(~c("url").like("https://%")))
    return pages.groupBy("secure").agg(F.count(lit(1)).alias("n"), F.count(F.when(c("url").like("%/en/%"), 1)).alias("english"), F.sum(F.char_length("html")).alias("chars"))


@query("SELECT page_id, url FROM pages WHERE url > 'http://m' OR (url = 'http://m' AND page_id > 5) ORDER BY url, page_id LIMIT 40")
def token_scan_slice(spark, d):
    return inc.token_slice(load(spark, d, "pages").select("page_id", "url"), ["url", "page_id"], ("http://m", 5), 40)


@query("SELECT 'run-' || user_id AS run_id, user_id, min(event_id) AS backfill_cursor, max(event_id) AS high_watermark, count(*) AS records FROM events GROUP BY user_id")
def run_history(spark, d):
    from rankwell.streaming.collect import run_history as trace

    runs = load(spark, d, "events").groupBy("user_id").agg(F.min("event_id").alias("backfill_cursor"), F.max("event_id").alias("high_watermark"), F.count(lit(1)).alias("records"), F.max("ts").alias("started_at"))
    return trace(runs.withColumn("run_id", x.readable_key(lit("run"), "user_id", sep="-"))).drop("started_at").select("run_id", "user_id", "backfill_cursor", "high_watermark", "records")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_collect(spark, d):
    from rankwell.streaming import collect

    base = scratch_dir(spark, "stream")
    load(spark, d, "events").select("event_id", "user_id", "event_type", "value").write.json(f"{base}/landing")
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    feed = collect.Feed("driver", "all", "events", TableSpec("events", schema, ("event_id",)), "event_id", "event_id", f"{base}/feed")
    collect.stream_collect(spark, f"{base}/landing", feed.spec.schema, feed, lambda df: df, lambda: datetime(2024, 1, 1)).awaitTermination()
    return collect.current_table(spark, feed)
