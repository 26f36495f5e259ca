"""Whole jobs: landed files with more than one array, markup within texts, plans that move no documents."""

import json

import duckdb
import pytest

from rankwell.plans.queries import QUERIES, SQL
from rankwell.sources import readers

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_a_second_array_in_a_file_is_not_passed_over(spark, tmp_path):
    one = json.dumps([{"match_id": 1, "radiant_name": "a} b"}])
    (tmp_path / "one.json").write_text(one)
    assert readers.read_match_landing(spark, str(tmp_path / "one.json")).count() == 1
    for behind in (one, " x", "]", ", 0]"):
        (tmp_path / "more.json").write_text(one + "\n" + behind)
        with pytest.raises(Exception, match="must be a JSON array"):
            readers.read_match_landing(spark, str(tmp_path / "more.json")).count()


def test_every_landed_list_has_a_file_of_its_own(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["landing_arrays"](spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()


def _maps(spark):
    from rankwell.plans import models

    made = models.DOCUMENT_DDL
    maps = made[made.index("maps array<") :]
    document = {"maps": [{
        "number": 1, "map": "Bind", "score": [2, 1],
        "rounds": [{"number": n, "winner": w, "winner_side": "atk", "outcome": None, "first_kill": k, "clutch": None} for n, w, k in ((3, 1, "A"), (1, 1, "B"), (2, 2, "C"), (4, None, None))],
        "players": [{"side": s, "page": p} for s, p in ((1, "A"), (2, "B"), (1, "B"), (2, None))],
    }]}
    assert "players" in maps
    pages = spark.createDataFrame([("w", "Match:1", "finished", json.dumps(document))], "wiki string, page_title string, status string, document string")
    rest = "played_at timestamp, tournament_page string, team_1 string, team_2 string, score_1 int, score_2 int, map_count int, refreshed_at timestamp"
    pages = pages.selectExpr("*", *[f"cast(null as {field.split()[1]}) as {field.split()[0]}" for field in rest.split(", ")])
    return models.stg_maps(models.stg_series(pages))


def test_facts_of_whole_maps_are_those_of_their_rows(spark):
    """Also for rounds out of order, without a winner or an opener, and for a player who is listed twice."""
    from rankwell.plans import models

    maps = _maps(spark)
    facts = maps.selectExpr("map_key", "'t' as tournament_key", "1 as tier_rank")
    for whole, rows in ((models.rounds_of_maps(maps, facts), models.fct_round(models.stg_rounds(maps), models.stg_players(maps), facts)), (models.players_of_maps(maps, facts), models.fct_player_map(models.stg_players(maps), facts))):
        assert sorted(whole.columns) == sorted(rows.columns) and {f.name: f.dataType for f in whole.schema} == {f.name: f.dataType for f in rows.schema}
        assert sorted(map(str, whole.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
    scored = {(x.round_number, x.first_kill_side): (x.side_1_score_before, x.side_2_score_before) for x in models.rounds_of_maps(maps, facts).collect()}
    assert scored == {(1, 1): (0, 0), (1, 2): (0, 0), (2, None): (1, 0), (3, 1): (1, 1), (4, None): (2, 1)}


def test_no_exchange_moves_players_or_rounds_one_by_one(spark):
    """Documents are folded as the values they are built from, and neither players nor rounds are broadcast."""
    from rankwell.plans import adapter

    plan = adapter.raw_match_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and not [line for line in plan.splitlines() if "collect_list" in line and "Spike" in line]
    for name in ("mart_fct_round", "mart_fct_player_map"):
        lines = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
        unfolded = [i for i, line in enumerate(lines) if "Generate" in line and ("rounds" in line or "players" in line)]
        # what unfolds players or rounds lies under no exchange
        assert unfolded and not [i for i in unfolded for j in range(i) if "Exchange" in lines[j] and depth(lines[j]) < depth(lines[i]) and all(depth(x) > depth(lines[j]) for x in lines[j + 1 : i + 1])], name


def test_markup_inside_of_texts(spark, tmp_path):
    """Marks that a text holds itself are read by the query and by its SQL alike."""
    texts = ["plain  text", "a [[b|c]] ''d'' {e}", "<b>x</b> <!-- y", "{{t|{{u}}}} [http://z w]", "it''''''s | }} {{", None, "no\n<br />break [x] ]]"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.readable for r in QUERIES["strip_markup_text"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == dict(con.sql(SQL["strip_markup_text"]).fetchall())
    # a brace of its own keeps the template around it, as in the SQL
    assert got[1].startswith("name a c d {e} {{a| {{b|a c d {e}}}}} one two") and got[0] == "name plain text one two label"


def test_plain_markup_is_read_as_the_parser_reads_it():
    from rankwell.operators import extract

    class Parsed(extract.Page):
        def _plain(self, source):
            return False

    block = '<div class="match-bm x"><a title="T 1">T<br>1</a><p>open<span data-timestamp="">s</div>tail</q>'
    for source in (block, f"<html>{block}</html>", "", "text alone", f"{block}<p", block + "a > b", block.replace("T 1", "T\n1"), block + '<i id="1" id="2"></i>', f"<script>{block}</script>", block + "&amp;", block.upper()):
        plain, parsed = extract.Page(source), Parsed(source)
        told = lambda page: [(e.tag, e.attributes, e.begin, e.end, e.text_from, e.text_to) if isinstance(e, extract.Element) else e for e in page.items]
        assert told(plain) == told(parsed), source
    assert extract.Page("x")._plain(block) and not extract.Page("x")._plain(block + "<!-- c -->")
    assert extract.block_items("<div class='match&#45;bm'>x</div>")["text"] == "x" and extract.block_items("<p>&amp;</p>") == {"text": None, "items": None}


def test_pages_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(readers, "PAGES_A_TASK", 100)
    assert readers.dealt_for_pages(spark.range(5000).coalesce(1)).rdd.getNumPartitions() == 50
