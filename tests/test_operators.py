"""Upsert, interval algebra, queue, quality checks, extraction and streaming on small frames."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rankwell.functions.wikitext import strip_markup
from rankwell.operators import extract, incremental as inc, priority, quality
from rankwell.operators import relational as r
from rankwell.operators.upsert import conform, last_wins, materialize, table_exists, upsert
from rankwell.plans import models
from rankwell.sources import bucketed, paged, readers
from rankwell.sources.schemas import RAW_TABLES, TableSpec, tier_seed
from rankwell.streaming import collect

TOY = TableSpec("toy", "match_id bigint, winner string, ingested_at long", ("match_id",), ("ingested_at",))
NOW = datetime(2026, 1, 10)


def test_conform_names_both_sides(spark):
    with pytest.raises(ValueError, match=r"missing columns \['ingested_at'\], unexpected columns \['other'\]"):
        conform(spark.createDataFrame([(1, "a", 2)], "match_id long, winner string, other int"), TOY)
    assert conform(spark.createDataFrame([(1, "a", 2)], "ingested_at int, winner string, match_id int"), TOY).columns == TOY.columns


def test_upsert_last_wins_write_once_and_counts(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], TOY.schema)
    batch = spark.createDataFrame([(2, "x", 20, 1), (2, "y", 21, 2), (3, "z", 20, 1)], "match_id long, winner string, ingested_at long, seq int")
    merged = upsert(target, batch, TOY, "seq")
    assert sorted(map(tuple, merged.table.collect())) == [(1, "a", 10), (2, "y", 10), (3, "z", 20)]
    assert merged.counts() == {"received": 3, "written": 2, "inserted": 1, "updated": 1}
    again = upsert(merged.table, batch, TOY, "seq")
    assert again.counts()["inserted"] == 0 and sorted(map(tuple, again.table.collect())) == sorted(map(tuple, merged.table.collect()))
    nothing = upsert(target, batch.limit(0), TOY, "seq")
    assert nothing.counts() == {"received": 0, "written": 0, "inserted": 0, "updated": 0} and nothing.table.count() == 2
    fixed = TableSpec("keys", "match_id bigint, ingested_at long", ("match_id",), ("ingested_at",))
    kept = upsert(target.drop("winner"), batch.drop("winner"), fixed, "seq")
    assert kept.counts()["updated"] == 1 and {tuple(x) for x in kept.table.collect()} == {(1, 10), (2, 10), (3, 20)}
    assert last_wins(batch, ["match_id"], "seq").filter("match_id = 2").first()["winner"] == "y"


@pytest.mark.parametrize(("before", "ids", "mode", "after"), [
    (inc.State(880, 800), (870, 950, True), inc.CATCHUP, (950, 800)), (inc.State(880, 800), (1900, 2000, False), inc.CATCHUP, (2000, 1900)), (inc.State(2000, 1900), (870, 1000, True), inc.CATCHUP, (2000, 870)),
    (inc.State(), (5, 9, False), inc.CATCHUP, (9, 5)), (inc.State(100, 50), (10, 49, False), inc.BACKFILL, (100, 10)), (inc.State(100, 50), (None, None, False), inc.CATCHUP, (100, 50)),
])
def test_state_after_a_walk(spark, before, ids, mode, after):
    walk = inc.Walk(ids[0], ids[1], 3, ids[2])
    done = inc.advance(before, walk, mode)
    assert (done.high_watermark, done.backfill_cursor) == after
    row = spark.createDataFrame([(before.high_watermark, before.backfill_cursor, 0, *ids, 3, mode, True, False, 1)], "high_watermark long, backfill_cursor long, records_seen long, lowest long, highest long, reached_known boolean, records long, mode string, more boolean, failed boolean, pages int")
    got = inc.advance_columns(row).first()
    assert (got["new_high"], got["new_low"]) == after


def test_catchup_agrees_with_the_page_loop(spark):
    ids = [3 * i for i in range(1, 60)]
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    for high, page, most in ((150, 7, 5), (100, 10, 20), (176, 4, 9), (0, 10, 3), (174, 1, 50)):
        pages, below = [], sorted(ids, reverse=True)
        while below and len(pages) < most:
            pages.append(below[:page])
            below = below[page:]
            if min(pages[-1]) <= high:
                break
        got = sorted((x.id for x in inc.catchup_slice(frame, "id", inc.State(high, 1), page, most).collect()), reverse=True)
        assert got == [i for p in pages for i in p], (high, page, most)


def test_guards_and_slices(spark):
    with pytest.raises(ValueError, match="descend"):
        inc.guard_progress(inc.Walk(10, 20, 2, False), 10)
    frame = spark.range(20)
    assert [x.id for x in inc.page_below(frame, "id", 5, 3).collect()] == [4, 3, 2]
    page, more = inc.has_more(frame.orderBy("id"), 19)
    assert page.count() == 19 and more
    assert [x.id for x in inc.token_slice(frame, ["id"], (17,), 5).collect()] == [18, 19]


def test_queue_order_retry_and_future(spark):
    day = NOW.date()
    tournaments = spark.createDataFrame([("w", 1, "C-Tier", day - timedelta(1)), ("w", 2, "S-Tier", day - timedelta(365)), ("w", 3, "S-Tier", day - timedelta(1)), ("w", 4, "S-Tier", day + timedelta(1)), ("w", 5, "s", None)], "wiki string, page_id long, tier string, start_date date")
    links = spark.createDataFrame([("w", i, f"Match:{i}") for i in range(1, 6)], "wiki string, tournament_page_id long, match_title string")
    pages = spark.createDataFrame([], "wiki string, page_title string, status string, refreshed_at timestamp")
    ask = lambda p, rank=5, k=9: [x.match_title for x in priority.priority_queue(links, tournaments, p, "w", rank, NOW, k).collect()]
    assert ask(pages) == ["Match:3", "Match:2", "Match:5", "Match:1"] and ask(pages, 2, 1) == ["Match:3"]
    seen = spark.createDataFrame([("w", "Match:3", "finished", NOW - timedelta(9)), ("w", "Match:2", "upcoming", NOW - timedelta(4)), ("w", "Match:1", "upcoming", NOW - timedelta(1))], pages.schema)
    assert ask(seen) == ["Match:2", "Match:5"]


def test_checks_in_one_scan(spark):
    frame = spark.createDataFrame([(1, None), (1, 5), (None, 50), (None, 5)], "k int, v int")
    checks = [quality.not_null("t", "v"), quality.accepted_range("t", "v", 0, 10), quality.unique("t", "k"), quality.unique_combination("t", ["k", "v"]), quality.accepted_values("t", "v", [5], quality.WARN), quality.not_null("absent", "v")]
    got = {x.check: (x.violations, x.status) for x in quality.run_checks(spark, {"t": frame}, checks).filter("table = 't'").collect()}
    assert got == {"v_not_null": (1, "failed"), "v_range": (1, "failed"), "k_unique": (1, "failed"), "k_v_unique": (0, "passed"), "v_accepted": (1, "failed")}
    results = quality.run_checks(spark, {"t": frame}, checks)
    assert results.filter("status = 'skipped'").count() == 1 and quality.blocking(results).first()["blocked"]
    assert not quality.blocking(results.filter("severity = 'warn'")).first()["blocked"]
    with pytest.raises(ValueError, match="bound"):
        quality.accepted_range("t", "v")


def test_key_checks_treat_null_keys_differently(spark):
    frame = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    count = lambda c: quality.run_checks(spark, {"t": frame}, [c]).first()["violations"]
    assert count(quality.unique("t", "k")) == 1 and count(quality.unique_combination("t", ["k"])) == 2
    assert sorted((x.k or 0, x.occurrences) for x in r.duplicates(frame, ["k"]).collect()) == [(0, 2), (1, 2)]


def test_raw_and_model_checks_are_complete():
    assert len(quality.raw_checks(NOW)) == 27
    # 76 tests of the models, less the two recounts, which are models.recount_mismatch and relational.unknown_tiers
    assert len(quality.model_checks()) == 74


def test_freshness(spark):
    frame = spark.createDataFrame([(NOW - timedelta(days=3),)], "t timestamp")
    from datetime import timezone

    at = NOW.replace(tzinfo=timezone.utc)
    level = lambda df: quality.freshness(df, "t", at, timedelta(days=2), timedelta(days=7)).first()["status"]
    assert level(frame) == "warn" and level(frame.limit(0)) == "error"


PAGE = """<html><body><div class="match-bm"><div class="match-bm-match-header-date"><span data-timestamp="1724482800" data-finished="finished"></span></div>
<div class="match-bm-match-header-tournament"><a title="VCT/2024/Champions">Champions</a></div>
<div class="match-bm-match-header-team"><span class="match-bm-match-header-team-long"><a title="Leviatán">Leviatán</a></span><span class="match-bm-match-header-team-short">LEV</span></div>
<div class="match-bm-match-header-team"><span class="match-bm-match-header-team-long"><a title="Team Heretics">Team Heretics</a></span><span class="match-bm-match-header-team-short">TH</span></div>
<div class="match-bm-match-header-result">1&nbsp;‑&nbsp;3</div>
<div class="match-bm-map-veto-card match-bm-map-veto-card--ban"><div class="match-bm-map-veto-card-map-info"><a title="Leviatán">x</a></div><div class="match-bm-map-veto-card-map-name">Bind</div></div>
<div class="match-bm-map-veto-card match-bm-map-veto-card--decider"><div class="match-bm-map-veto-card-map-name">Haven</div></div>
<div data-toggle-area-content="1"><p>Overall</p></div>
<div data-toggle-area-content="2"><div class="match-bm-lol-game-summary"><div class="match-bm-lol-game-summary-map">Icebox</div><div class="match-bm-lol-game-summary-score">7 ‑ 13</div><div class="match-bm-lol-game-summary-length">63:00</div>
<div class="match-bm-lol-game-summary-team"><i class="match-bm-game-summary-team-halves-half x--atk">5</i><i class="match-bm-game-summary-team-halves-half x--def">2</i></div><div class="match-bm-lol-game-summary-team"><i class="match-bm-game-summary-team-halves-half x--def">7</i></div></div>
<div class="match-bm-team-stats-list-row"><b class="match-bm-team-stats-list-cell">9</b><b class="match-bm-team-stats-list-cell">First Kills</b><b class="match-bm-team-stats-list-cell">11</b></div>
<div class="match-bm-players-team"><div class="match-bm-players-player"><div class="match-bm-players-player-name"><a title="KiNgg">kiNgg</a></div><div class="match-bm-players-player-icon"><a title="Viper"><img src="v.png"></a></div>
<div class="match-bm-players-player-stat"><i class="match-bm-players-player-stat-title">KDA</i><i class="match-bm-players-player-stat-data">15/14/5</i></div><div class="match-bm-players-player-stat"><i class="match-bm-players-player-stat-title">HS%</i><i class="match-bm-players-player-stat-data">34.2%</i></div>
<div class="match-bm-players-player-stat"><i class="match-bm-players-player-stat-title">FK / FD</i><i class="match-bm-players-player-stat-data">3/2</i></div></div></div>
<div class="match-bm-rounds-overview-round"><b class="match-bm-rounds-overview-round-title">1</b><div class="match-bm-rounds-overview-round-outcome"><i class="match-bm-rounds-overview-round-outcome-icon y--atk"></i></div><div class="match-bm-rounds-overview-round-outcome"></div></div>
<div class="match-bm-rounds-overview-round"><b class="match-bm-rounds-overview-round-title">2</b><div class="match-bm-rounds-overview-round-outcome"></div><div class="match-bm-rounds-overview-round-outcome"></div></div>
<div class="match-bm-match-round-detail"><b class="match-bm-match-round-detail-header">Round 1</b><div class="match-bm-match-round-detail-body"><p class="match-bm-match-round-detail-body-result-desc">Spike detonated</p><span><b>First Kill</b><a title="MiniBoo">m</a></span><span><b>Clutch</b><a title="C0M">c</a></span></div></div>
</div><div class="match-bm-match-additional">history</div></div></body></html>"""


def document(spark, *pages):
    """The documents of pages, without what is null in them."""
    def full(x):
        return {k: full(v) for k, v in x.items() if v is not None} if isinstance(x, dict) else [full(v) for v in x] if isinstance(x, list) else x

    made = extract.extract_match_pages(spark.createDataFrame(list(enumerate(pages)), "n int, html string"))
    return [full(r.document.asDict(True)) for r in made.orderBy("n").collect()]


def test_match_document(spark):
    slim = extract.slim_page(PAGE)
    d, again, none = document(spark, PAGE, slim, "<p>nothing</p>")
    assert (d["status"], d["played_at_epoch"], d["tournament_page"], d["score"]) == ("finished", 1724482800, "VCT/2024/Champions", [1, 3])
    assert d["teams"][0] == {"page": "Leviatán", "name": "Leviatán", "short": "LEV"}
    assert d["veto"] == [{"order": 1, "action": "ban", "map": "Bind", "team": "Leviatán"}, {"order": 2, "action": "decider", "map": "Haven"}]
    (m,) = d["maps"]
    assert (m["number"], m["map"], m["score"], m["length"]) == (1, "Icebox", [7, 13], "63:00")
    assert m["halves"] == [[{"side": "atk", "rounds": 5}, {"side": "def", "rounds": 2}], [{"side": "def", "rounds": 7}]] and m["team_stats"] == {"first_kills": ["9", "11"]}
    assert m["players"] == [{"side": 1, "page": "KiNgg", "name": "kiNgg", "agent": "Viper", "kills": 15, "deaths": 14, "assists": 5, "headshot_pct": 34.2, "first_kills": 3, "first_deaths": 2}]
    assert m["rounds"] == [{"number": 1, "winner": 1, "winner_side": "atk", "outcome": "Spike detonated", "first_kill": "MiniBoo", "clutch": "C0M"}]
    assert again == d and "history" not in slim
    assert none == {"status": "unparsed", "teams": [], "veto": [], "maps": []} and extract.slim_page("<p>nothing</p>") is None


def test_markup_around_what_is_read(spark):
    """Other class names before the action, titles on what is no link, blocks without a link ahead of one that has it."""
    page = """<div class=match-bm><div class="match-bm-match-header-tournament">soon</div><div class="match-bm-match-header-tournament"><a title="Cup">The Cup</a></div>
    <div class="match-bm-match-header-team"><a title="Icon">i</a><b class="match-bm-match-header-team-long">Plain</b></div><div class="match-bm-match-header-team"><a title="Only link">o</a></div>
    <div class="is--active match-bm-map-veto-card match-bm-map-veto-card--ban"><div class="match-bm-map-veto-card-map-info">by</div><div class="match-bm-map-veto-card-map-info"><a title="">?</a></div></div>
    <div class="match-bm-lol-game-summary"><div class="match-bm-lol-game-summary-score">13</div></div>
    <div class="match-bm-rounds-overview-round"><i class="match-bm-rounds-overview-round-title">3</i><i class="match-bm-rounds-overview-round-outcome"></i><i class="match-bm-rounds-overview-round-outcome"><u class="a--b match-bm-rounds-overview-round-outcome-icon x--def"></u></i></div>
    <div class="match-bm-match-round-detail"><i class="match-bm-match-round-detail-header">3</i><div class="match-bm-match-round-detail-body"><span><b>First Kill</b><img title="Jett"><a>x</a><a title="Player One">p</a></span></div></div></div>"""
    (d,) = document(spark, page)
    assert (d["tournament_page"], d["tournament_name"], d["status"], d["veto"]) == ("Cup", "The Cup", "unknown", [{"order": 1, "action": "ban"}])
    assert d["teams"] == [{"name": "Plain"}, {"page": "Only link", "name": "Only link"}] and "score" not in d["maps"][0]
    assert d["maps"][0]["rounds"] == [{"number": 3, "winner": 2, "winner_side": "def", "first_kill": "Player One"}]


@pytest.mark.parametrize(("text", "fields"), [
    ("text {{Infobox league|name=PGL Major|country=Denmark}} more", {"name": "PGL Major", "country": "Denmark"}), ("{{infobox LEAGUE|sDate=2024-03-17}}", {"sdate": "2024-03-17"}), ("{{Other|a=1}}", None), ("{{Infobox league|name=X", None),
    ("{{Infobox league|format={{Abbr/Bo3|a=b}}|name=X}}", {"format": "{{Abbr/Bo3|a=b}}", "name": "X"}), ("{{Infobox league|venue=[[Royal Arena|arena]]|city=C}}", {"venue": "[[Royal Arena|arena]]", "city": "C"}),
    ("{{Infobox league|web=http://x.fr/?a=1&b=2|positional|a=1|a=2}}", {"web": "http://x.fr/?a=1&b=2", "a": "2"}),
])
def test_infobox(text, fields):
    assert extract.infobox_of(text, "Infobox league") == fields


def test_pages_stored_without_a_block_keep_their_document(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>nothing</p>"), (3, None)], "page_id int, html string")
    stored = extract.extract_match_pages(pages).withColumn("html", extract.slim_pages(F.col("html")))
    got = {r.page_id: (r.differs, r.document and r.document.status) for r in extract.reparse_stored(stored).collect()}
    assert got[2] == (False, "unparsed") and got[3] == (False, None) and not got[1][0]
    changed = stored.filter("page_id = 1").withColumn("html", F.lit("<p>nothing</p>"))
    assert extract.reparse_stored(changed).first().differs


def test_only_what_is_wanted_is_made():
    """A wanted model asks for the raw tables that it rests on, and no other model is made."""
    assert models.sources_of("fct_veto") == {"match_pages", "tournaments", "seed"}
    assert models.sources_of("fct_match") == {"matches", "match_pages", "tournaments", "seed"}
    assert models.sources_of("dim_tournament") == {"tournaments", "seed"} and models.sources_of() == set()


def test_models_of_one_match(spark):
    pages = spark.createDataFrame([("valorant", "Match:1", 1, 1, PAGE), ("valorant", "Match:2", 2, 1, None)], "wiki string, page_title string, page_id int, revision_id int, html string")
    raw = readers.normalize_match_page(extract.extract_match_pages(pages), NOW).cache()
    assert {x.page_title: (x.status, x.map_count) for x in raw.collect()} == {"Match:1": ("finished", 1), "Match:2": ("missing", 0)}
    series = models.stg_series(raw)
    maps = models.stg_maps(series)
    row = maps.first()
    assert (row.map_key, row.duration_seconds, row.side_1_atk_rounds, row.side_2_atk_rounds, row.side_1_starting_side, row.side_1_first_kills) == ("wiki:valorant:Match:1#1", 3780, 5, 0, "atk", 9)
    dim = models.dim_tournament(models.stg_tournaments(readers.empty(spark, RAW_TABLES["tournaments"].schema)), tier_seed(spark))
    facts = models.fct_series(series, dim)
    assert facts.select("side_1_maps", "side_2_maps", "winning_side", "winner_team").first() == (1, 3, 2, "Team Heretics")
    fact = models.fct_map(maps, facts, models.stg_veto(series))
    assert fact.select("rounds_played", "winning_side", "is_decider").first() == (20, 2, None)
    rounds = models.fct_round(models.stg_rounds(maps), models.stg_players(maps), fact).first()
    assert (rounds.side_1_score_before, rounds.side_2_score_before, rounds.first_kill_side, rounds.first_kill_converted, rounds.was_clutch) == (0, 0, None, None, True)
    assert models.fct_veto(models.stg_veto(series), facts).count() == 2
    assert models.recount_mismatch(models.stg_rounds(maps), fact).count() == 1


def test_landed_matches(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"match_id": 8997682537, "duration": 1975, "start_time": 1789324066, "radiant_win": true, "radiant_name": "YBN Club", "radiant_score": 42, "dire_score": 15}, {"match_id": "x"}, {"match_id": 2, "duration": "inconnu", "radiant_win": "oui"}]')
    rows = {x.match_id: x for x in readers.normalize_matches(readers.read_match_landing(spark, str(tmp_path / "a.json")), NOW).collect()}
    assert set(rows) == {8997682537, 2} and rows[2].duration_seconds is None and rows[2].radiant_win is None
    one = rows[8997682537]
    assert (one.duration_seconds, one.start_time, one.radiant_win, one.radiant_score) == (1975, datetime(2026, 9, 13, 18, 27, 46), True, 42)
    (tmp_path / "b.json").write_text('{"error": 1}')
    with pytest.raises(Exception, match="must be a JSON array"):
        readers.read_match_landing(spark, str(tmp_path / "b.json")).count()


def test_stream_is_idempotent_and_keeps_state(spark, tmp_path):
    spec = TableSpec("matches", "match_id bigint, winner string", ("match_id",))
    feed = collect.Feed("s", "d", "matches", spec, "match_id", "match_id", str(tmp_path / "feed"))
    land = lambda rows, name: spark.createDataFrame(rows, spec.schema).coalesce(1).write.mode("append").json(str(tmp_path / "landing"))
    run = lambda: collect.stream_collect(spark, str(tmp_path / "landing"), spec.schema, feed, lambda df: df, lambda: NOW).awaitTermination()
    land([(10, "a"), (11, "b")], 1)
    run()
    assert collect.load_state(spark, feed) == inc.State(11, 10, 2)
    land([(11, "c"), (12, "d")], 2)
    run()
    run()
    assert sorted(map(tuple, collect.current_table(spark, feed).collect())) == [(10, "a"), (11, "c"), (12, "d")]
    assert collect.load_state(spark, feed) == inc.State(12, 10, 4)
    runs = collect.run_history(collect.runs_of(spark, feed)).collect()
    assert sorted((x.inserted, x.updated, x.stop_reason) for x in runs) == [(1, 1, "caught_up"), (2, 0, "exhausted")]


def test_tables_and_views(spark, tmp_path):
    frame = spark.range(3)
    materialize(frame, "some_view", "staging")
    assert table_exists(spark, "some_view") and not table_exists(spark, "no_such_table")
    assert materialize(frame, "some_mart", "mart", str(tmp_path)).count() == 3
    assert tier_seed(spark).count() == 36 and tier_seed(spark).filter("tier_rank is null").count() == 1


def test_running_score_and_profile(spark):
    rounds = spark.createDataFrame([("m", n, s) for n, s in ((1, 1), (2, 2), (3, 1))], "map_key string, n int, side int")
    got = r.score_before(rounds, ["map_key"], ["n"], "side", {1: "a", 2: "b"}).orderBy("n").select("a", "b").collect()
    assert [tuple(x) for x in got] == [(0, 0), (1, 0), (1, 1)]
    exact = r.tier_profile(spark.createDataFrame([(1, 1.0), (1, 4.0), (None, 2.0)], "tier_rank int, prize_pool_usd double"))
    assert sorted((x.tier_rank or 0, x.n, x.median_value) for x in exact.collect()) == [(0, 1, 2.0), (1, 2, 2.5)]


def test_the_record_that_landed_last_wins(spark, tmp_path):
    spec = TableSpec("m", "k bigint, v string", ("k",))
    feed = collect.Feed("s", "d", "m", spec, "k", "landed", str(tmp_path / "feed"))
    (tmp_path / "landing").mkdir()
    for n in range(3):
        (tmp_path / "landing" / f"{n}.json").write_text("\n".join(f'{{"k": {k}, "v": "{n}-{i}"}}' for i in range(4) for k in (1, 2, 3)) + "\n")
        os.utime(tmp_path / "landing" / f"{n}.json", (1000 + n, 1000 + n))
    collect.stream_collect(spark, str(tmp_path / "landing"), spec.schema, feed, lambda df: df, lambda: NOW).awaitTermination()
    assert sorted(map(tuple, collect.current_table(spark, feed).collect())) == [(k, "2-3") for k in (1, 2, 3)]


def test_ties_for_the_last_place_are_refused(spark):
    frame = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (1, 4, "x"), (2, 1, "b")], "k int, at int, v string")
    assert sorted(map(tuple, last_wins(frame, ["k"], "at").collect())) == [(1, 5, "a"), (2, 1, "b")]
    with pytest.raises(Exception, match="does not tell the rows of k apart"):
        last_wins(frame.union(spark.createDataFrame([(1, 5, "c")], frame.schema)), ["k"], "at").collect()


def test_known_keys_of_a_table_without_updates_count_as_updated(spark):
    spec = TableSpec("links", "a int, b int", ("a", "b"))
    made = upsert(spark.createDataFrame([(1, 1), (1, 2)], spec.schema), spark.createDataFrame([(1, 2), (1, 2), (1, 3)], spec.schema), spec, "a")
    assert made.counts() == {"received": 3, "written": 2, "inserted": 1, "updated": 1} and made.table.count() == 3


def test_landed_ids_follow_the_rules_of_coercion(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"match_id": "12"}, {"match_id": 13.0}, {"match_id": true}, {"match_id": null}, {"match_id": "x1"}, {}, {"match_id": 14}]')
    got = readers.normalize_matches(readers.read_match_landing(spark, str(tmp_path / "a.json")), NOW).collect()
    assert sorted(x.match_id for x in got) == [12, 13, 14]


@pytest.mark.parametrize("piece", ["<div>", "<b><i>", "</p>", "<a title='"])
def test_deep_and_broken_pages_are_read(spark, piece):
    page = f"<div class='match-bm'>{20_000 * piece}<div class='match-bm-match-header-result-text'>Live</div></div>"
    assert document(spark, page)[0]["status"] in ("live", "unknown") and extract.slim_page(page).startswith("<div")


def test_templates_go_at_any_depth(spark):
    deep = "a " + 40 * "{{x|" + "y" + 40 * "}}" + " b {{q}}c"
    assert spark.createDataFrame([(deep,), ("}} {{ open",), (None,)], "t string").select(strip_markup(F.col("t"))).collect() == [("a b c",), ("}} {{ open",), (None,)]


def test_a_table_of_many_batches(spark, tmp_path):
    """Batches against a dictionary: over splitting buckets, with a batch run again, write-once columns and a failed run."""
    spec = TableSpec("m", "k bigint, born string, v string", ("k",), ("born",))
    feed = collect.Feed("s", "d", "m", spec, "k", "at", str(tmp_path / "feed"), bucket_rows=2)
    frame = lambda n, keys: spark.createDataFrame([(k, f"b{n}", None if k == 2 and n == 5 else f"v{n}", n) for k in keys], "k bigint, born string, v string, at int")
    expected, counts = {}, []
    for n, keys in enumerate([(1, 2), (2, 3), (4,), (1, 4), (), (2, 5), (6, 1), (7,)]):
        before = dict(expected)
        for k in keys:
            expected[k] = (before[k][0] if k in before else f"b{n}", None if k == 2 and n == 5 else f"v{n}")
        counts.append((sum(k not in before for k in keys), sum(k in before for k in keys)))
        for _ in range(2 if n in (2, 5, 6) else 1):
            collect.collect(frame(n, keys), n, feed, NOW)
        assert {x.k: (x.born, x.v) for x in collect.current_table(spark, feed).collect()} == expected
    with pytest.raises(ValueError, match="unexpected columns"):
        collect.collect(frame(8, (9,)).withColumn("more", F.lit(1)), 8, feed, NOW)
    runs = collect.runs_of(spark, feed).collect()
    assert sorted((x.inserted, x.updated) for x in runs if x.stop_reason != "failed") == sorted(counts)
    assert [x.high_watermark for x in runs if x.stop_reason == "failed"] == [7] and collect.load_state(spark, feed).high_watermark == 7
    manifest = feed.table(spark).manifest()
    assert manifest.buckets == 4 and manifest.rows == 7 and sorted(p.name for p in (tmp_path / "feed/table/manifest").glob("*.json")) == ["6.json", "7.json"]
    assert not list((tmp_path / "feed/table/staged").iterdir()) and len(list((tmp_path / "feed/table/data").iterdir())) <= 6
    assert feed.table(spark).rows(feed.table(spark).manifest(7)).count() == 6


def test_a_batch_reads_its_buckets_alone(spark, tmp_path):
    """While the table grows tenfold, batches of ten keys read and write about as much as before."""
    spec = TableSpec("m", "k bigint, v string", ("k",))
    table = bucketed.BucketedTable(spark, spec, str(tmp_path / "t"), bucket_rows=100)
    keys = lambda low, high: spark.range(low, high).select(F.col("id").alias("k"), F.lit("x" * 50).alias("v"), F.lit(1).alias("at"))
    reads, rows = [], bucketed.BucketedTable.rows

    def counted(self, manifest=None, buckets=None):
        if buckets is not None:
            reads.append((len(manifest.held), sum(n for b, (_, n) in manifest.held.items() if b in buckets)))
        return rows(self, manifest, buckets)

    for number, high in enumerate((2000, 20_000)):
        table.merge(keys(0, high), 10 * number, "at", {})
        table.merge(keys(high // 2, high // 2 + 5).union(keys(10**6 + high, 10**6 + high + 5)).withColumn("v", F.lit("new")), 10 * number + 1, "at", {"n": number})
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(bucketed.BucketedTable, "rows", counted)
        for number, low in enumerate((5000, 7000)):
            assert table.merge(keys(low, low + 10), 30 + number, "at", {}) == {"received": 10, "written": 10, "inserted": 0, "updated": 10}
    assert all(buckets >= 190 and read <= 12 * 200 for buckets, read in reads) and len(reads) == 2
    assert table.rows().count() == 20_010 and {r.v for r in table.rows().filter("k >= 10000 and k < 10005 or k >= 1000000").collect()} == {"new"}
    assert table.manifest(12).saved == {"n": 1} or table.manifest(31).batch == 30


def test_buckets_split_one_at_a_time(spark):
    keys = spark.range(2000)
    for old, new in ((1, 2), (3, 4), (5, 9), (8, 9)):
        moved = {r.a for r in keys.select(bucketed.bucket_of(["id"], old).alias("a"), bucketed.bucket_of(["id"], new).alias("b")).filter("a != b").distinct().collect()}
        assert moved <= bucketed.split_by(old, new)
    assert {r[0] for r in keys.select(bucketed.bucket_of(["id"], 7)).distinct().collect()} == set(range(7))


def test_bounded_runs_and_why_they_stop(spark, tmp_path):
    spec = TableSpec("m", "k bigint, v string", ("k",))
    feed = collect.Feed("s", "d", "m", spec, "k", "k", str(tmp_path / "feed"))
    source = spark.range(1, 101).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    run = lambda mode, most, rows=source, **more: collect.run_feed(rows, feed, mode, NOW, 10, most, **more)
    assert run(inc.CATCHUP, 2) == "page_limit" and collect.load_state(spark, feed) == inc.State(100, 81, 20)
    assert run(inc.BACKFILL, 3) == "page_limit" and collect.load_state(spark, feed) == inc.State(100, 51, 50)
    newer = source.union(spark.range(101, 116).select(F.col("id").alias("k"), F.lit("n").alias("v")))
    assert run(inc.CATCHUP, 5, newer) == "caught_up" and collect.load_state(spark, feed) == inc.State(115, 51, 70)
    assert run(inc.BACKFILL, 9) == "exhausted" and collect.load_state(spark, feed) == inc.State(115, 1, 120)
    assert run(inc.BACKFILL, 9) == "empty_page" and run(inc.CATCHUP, 2, source.limit(0)) == "empty_page"
    far = spark.range(500, 600).select(F.col("id").alias("k"), F.lit("f").alias("v"))
    assert run(inc.CATCHUP, 2, far) == "page_limit"
    with pytest.raises(ValueError, match="does not descend"):
        run(inc.BACKFILL, 1, slice_of=lambda state: far.filter("k >= 580"))
    runs = {(x.stop_reason, x.gap_suspected) for x in collect.runs_of(spark, feed).collect()}
    assert {a for a, _ in runs} == {"page_limit", "caught_up", "exhausted", "empty_page", "failed"} and ("page_limit", True) in runs
    assert collect.current_table(spark, feed).count() == 115 + 20 and collect.states_of(spark, feed).first()["high_watermark"] == 599


def test_a_scan_goes_on_from_its_token(spark, tmp_path):
    spec = TableSpec("links", "title string, page bigint", ("title", "page"))
    feed = collect.Feed("s", "d", "links", spec, "page", "page", str(tmp_path / "feed"))
    source = spark.range(25).select(F.format_string("t%s", F.col("id") % 4).alias("title"), F.col("id").alias("page"))
    seen = []
    for turn in range(2):
        for reason in ("page_limit", "page_limit", "exhausted"):
            assert collect.run_feed(source, feed, collect.SCAN, NOW, 5, 2, ["title", "page"]) == reason
            seen.append(collect.current_table(spark, feed).count())
            assert (collect.load_token(spark, feed) is None) == (reason == "exhausted")
    assert seen == [10, 20, 25, 25, 25, 25] and collect.load_state(spark, feed) == inc.State(None, None, 50)


def test_last_wins_refuses_every_tie(spark):
    """Also where each of the differing rows is there more than once, and among null orders."""
    schema = "k int, v string, o int"
    for body in ([(1, "a", 5), (1, "a", 5), (1, "b", 5), (1, "b", 5)], [(1, "a", None), (1, "b", None)]):
        with pytest.raises(Exception, match="o does not tell the rows of k apart"):
            last_wins(spark.createDataFrame(body, schema).repartition(3), ["k"], "o").collect()
    body = [(1, "a", 4), (1, "b", 4), (1, "c", 5), (1, "c", 5), (None, "n", None), (None, "n", None), (2, "x", None), (2, "y", 1)]
    assert sorted(map(tuple, last_wins(spark.createDataFrame(body, schema), ["k"], "o").collect()), key=str) == sorted([(1, "c", 5), (None, "n", None), (2, "y", 1)], key=str)


def test_last_wins_of_a_frequent_key(spark):
    rows = spark.range(0, 400_000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("o"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    last = last_wins(rows, ["k"], "o")
    assert [tuple(x) for x in last.collect()] == [("hot", 399_999, "v399999")]
    assert "Window" not in last._jdf.queryExecution().executedPlan().toString()


def test_score_of_a_large_partition_in_blocks(spark):
    frame = spark.range(3000).select((F.col("id") % 7 == 0).alias("p"), F.xxhash64("id").alias("o"), (F.col("id") % 3).alias("side"), F.lit("kept").alias("more")).withColumn("p", F.when(F.col("o") % 11 != 0, F.col("p")))
    names = {1: "one", 2: "two"}
    whole, blocks = (r.score_before(frame, ["p"], ["o"], "side", names, largest=n) for n in (None, 200))
    assert blocks.columns == whole.columns and sorted(map(str, blocks.collect())) == sorted(map(str, whole.collect()))
    assert r.score_before(frame.limit(0), ["p"], ["o"], "side", names).count() == 0


def test_attach_to_one_row(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (2, "z"), (2, "y"), (None, "n"), (None, "m"), (7, "p"), (7, "q")], "id int, w string")
    told = r.attach_one(left, right, {"k": "id"}, {"w": "w"}, matches="met")
    assert sorted(map(tuple, told.collect()), key=str) == sorted([(1, "a", "x", 1), (2, "b", "y", 2), (None, "c", None, 0), (9, "d", None, 0)], key=str)
    with pytest.raises(Exception, match="several rows for one id: 2"):
        r.attach_one(left, right, {"k": "id"}, ["w"]).collect()
    once = r.attach_one(left.filter("v != 'b'"), right, {"k": "id"}, ["w"])
    assert once.columns == ["k", "v", "w"] and once.count() == 3


def test_series_of_a_repeated_title_are_refused(spark):
    series = spark.createDataFrame([("s", "dota2", "T")], "series_key string, discipline string, tournament_page string")
    rest = "source_name string, page_title string, played_at timestamp, side_1_team string, side_2_team string, side_1_maps int, side_2_maps int, map_count int"
    for field in rest.split(", "):
        name, kind = field.split()
        series = series.withColumn(name, F.lit(None).cast(kind))
    tournaments = spark.createDataFrame([("k1", "dota2", "T", 1), ("k2", "dota2", "T", 2)], "tournament_key string, discipline string, page_title string, tier_rank int")
    assert models.fct_series(series, tournaments.limit(1)).count() == 1
    with pytest.raises(Exception, match="several rows for one discipline, page_title"):
        models.fct_series(series, tournaments).collect()


def test_all_checks_of_a_table_read_it_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", NOW), (1, "a", NOW), (2, None, None), (None, None, None)], "k int, v string, at timestamp").write.parquet(path)
    checks = [quality.unique("t", "k"), quality.unique_combination("t", ["k", "v"]), quality.unique_combination("t", ["at"]), quality.not_null("t", "v"), quality.Check("k_unique", "t", rows_where=F.col("k") > 1), quality.Check("none", "t", rows_where=F.lit(None).cast("boolean"))]
    made = quality.run_checks(spark, {"t": spark.read.parquet(path)}, checks)
    assert sorted((x.check, x.violations) for x in made.collect()) == [("at_unique", 2), ("k_unique", 1), ("k_unique", 1), ("k_v_unique", 1), ("none", 0), ("v_not_null", 2)]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert [x.violations for x in quality.run_checks(spark, {"t": spark.read.parquet(path).limit(0)}, checks).collect()] == [0] * 6


def test_a_page_opens_a_handful_of_files(spark, tmp_path):
    path = str(tmp_path / "by_id")
    frame = spark.range(0, 40_000, 1, 8).select((F.xxhash64("id") % 100_000).alias("k"), "id").dropDuplicates(["k"])
    paged.write_by_id(frame.union(spark.createDataFrame([(None, -1)], "k long, id long")), "k", path, 40)
    assert len(list((tmp_path / "by_id" / "rows").glob("part-*"))) > 600
    for cursor, size in ((None, 100), (5000, 100), (-99_990, 100), (10**9, 1), (-(10**9), 5)):
        page = paged.stored_page(spark, path, "k", cursor, size)
        assert page.collect() == inc.page_below(frame, "k", cursor, size).collect()
        assert len(page.inputFiles()) <= 8 or cursor == -(10**9)


def test_large_arrays_are_read_in_parts(spark, tmp_path):
    """Flat arrays in several tasks, in any layout; nested records and braces in texts whole; what is no array raises."""
    flat = [{"match_id": i, "duration": i % 90, "radiant_name": f"n{i}", "league_name": "[x], {" * (i % 2)} for i in range(5000)]
    (tmp_path / "flat.json").write_text("\n" + json.dumps(flat, indent=1) + "\n")
    (tmp_path / "dense.json").write_text(json.dumps(flat[:10]).replace("{\"", "{ \""))
    (tmp_path / "nested.json").write_text(json.dumps([{"match_id": 9000 + i, "radiant_name": "}, {", "more": {"a": [1, {}]}} for i in range(5)]))
    (tmp_path / "none.json").write_text(" [ ] ")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        rows = readers.read_match_landing(spark, str(tmp_path))
        ids = sorted(r.match_id for r in readers.normalize_matches(rows, NOW).collect())
        assert ids == sorted([*range(5000), *range(10), *range(9000, 9005)])
        one = readers._pieces(spark, str(tmp_path / "flat.json"))
        assert one.rdd.getNumPartitions() > 5
        names = {r.match_id: r.radiant_name for r in readers.normalize_matches(rows, NOW).collect()}
        assert names[17] == "n17" and names[9002] == "}, {"
        for bad in ('{"match_id": 1}', '[{"match_id": 1}', '{"match_id": 1}]', '[{"match_id": 1}{"match_id": 2}]', ',{"match_id": 1}[{"match_id": 2}]', " "):
            (tmp_path / "bad.json").write_text(bad)
            with pytest.raises(Exception, match="must be a JSON array"):
                readers.read_match_landing(spark, str(tmp_path / "bad.json")).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_series_gather_no_documents(spark):
    """Scores are aggregates beside the documents: the plan of fct_series has no list of maps in it."""
    from rankwell.plans.queries import QUERIES

    plan = QUERIES["mart_fct_series"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "from_json" not in plan


def test_a_queue_without_its_inputs_is_refused(spark):
    with pytest.raises(ValueError, match="the queue needs no_links and no_tournaments"):
        priority.queue_of_tables(spark, "w", 5, NOW, 9, "no_links", "no_tournaments", "no_pages")
    spark.createDataFrame([("w", 1, "Match:1"), ("v", 1, "Match:2")], "wiki string, tournament_page_id long, match_title string").createOrReplaceTempView("some_links")
    spark.createDataFrame([("w", 1, "S-Tier", None)], "wiki string, page_id long, tier string, start_date date").createOrReplaceTempView("some_tournaments")
    assert [x.match_title for x in priority.queue_of_tables(spark, "w", 5, NOW, 9, "some_links", "some_tournaments", "no_pages").collect()] == ["Match:1"]
