"""Staging models and marts, each a DataFrame function."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.functions import exprs as x
from rankwell.operators import nested
from rankwell.operators import relational as r
from rankwell.sources.schemas import DOCUMENT_DDL, SUMMARY_DDL, struct

#: Names of the two feeds in keys and in source_name.
PAGES_FEED, MATCH_FEED = "wiki", "matchlist"
SIDES = {"radiant_team_id": "side_1_team_id", "radiant_name": "side_1_team_name", "dire_team_id": "side_2_team_id", "dire_name": "side_2_team_name", "radiant_score": "side_1_score", "dire_score": "side_2_score", "start_time": "started_at"}


def stg_matches(matches: DataFrame) -> DataFrame:
    df = x.neutral_sides(matches, SIDES)
    won = F.col("radiant_win")
    return df.select(
        "match_id", F.lit(MATCH_FEED).alias("source_name"), F.lit("dota2").alias("discipline"), "started_at", "duration_seconds", "side_1_team_id", "side_1_team_name", "side_2_team_id", "side_2_team_name", "side_1_score", "side_2_score",
        x.side_from_flag(won).alias("winning_side"), x.side_from_flag(won, F.col("side_1_team_id"), F.col("side_2_team_id")).alias("winner_team_id"), "league_id", x.blank_to_null(F.col("league_name")).alias("league_name"), "series_id", "refreshed_at",
    )


def stg_tournaments(tournaments: DataFrame) -> DataFrame:
    b = lambda old, new: x.blank_to_null(F.col(old)).alias(new)
    f = lambda old, new: x.fold_key(F.col(old)).alias(new)
    return tournaments.select(
        "wiki", "page_id", "page_title", F.lit(PAGES_FEED).alias("source_name"), F.col("wiki").alias("discipline"), b("name", "tournament_name"), b("series", "series_name"), b("organizer", "organizer"), b("tier", "tier_source"), f("tier", "tier_key"), f("tier_type", "tier_type"),
        b("game", "game"), f("setting", "setting"), b("country", "country"), b("city", "city"), "start_date", "end_date", "prize_pool_usd", "local_currency", "team_count", "revised_at", "refreshed_at",
    )


def stg_series(pages: DataFrame, document: str = DOCUMENT_DDL) -> DataFrame:
    """Finished series; the document is parsed here, once for every model below. Models without players and rounds do
    with less of it (SUMMARY_DDL)."""
    done = nested.parse_document(pages.filter(F.col("status") == "finished"), struct(document))
    return done.select(
        x.readable_key(F.lit(PAGES_FEED), "wiki", "page_title").alias("series_key"), F.lit(PAGES_FEED).alias("source_name"), F.col("wiki").alias("discipline"), "page_title", "played_at", "tournament_page",
        x.blank_to_null(F.col("team_1")).alias("side_1_team"), x.blank_to_null(F.col("team_2")).alias("side_2_team"), F.col("score_1").alias("side_1_maps"), F.col("score_2").alias("side_2_maps"), "map_count", "doc", "refreshed_at",
    )


def stg_maps(series: DataFrame) -> DataFrame:
    rows = nested.unfold(series, F.col("doc.maps"), "m", _SERIES)
    return _map_columns(rows, [F.col(f"m.{name}") for name in ("players", "rounds") if name in rows.schema["m"].dataType.fieldNames()])


_SERIES = ["series_key", "discipline", "played_at", "tournament_page", "side_1_team", "side_2_team"]


def _map_columns(rows: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    m = lambda name: F.col(f"m.{name}")
    roles = {f"side_{s}_{role}_rounds": x.rounds_by_role(x.at(m("halves"), s - 1), role) for s in (1, 2) for role in ("atk", "def")}
    plants = {}
    for s in (1, 2):
        plants[f"side_{s}_post_plant_won"], plants[f"side_{s}_post_plant_played"] = x.fraction_parts(x.at(m("team_stats")["post_plant"], s - 1))
    return rows.select(
        x.readable_key("series_key", m("number"), sep="#").alias("map_key"), *_SERIES, m("number").alias("map_number"), m("map").alias("map_name"), x.at(m("score"), 0).alias("side_1_rounds"), x.at(m("score"), 1).alias("side_2_rounds"),
        x.clock_to_seconds(m("length")).alias("duration_seconds"), x.starting_side(m("halves")).alias("side_1_starting_side"), *[c.alias(n) for n, c in (roles | x.team_stat_columns(m("team_stats")) | plants).items()], *more,
    )


_MAP = ["map_key", "series_key", "discipline", "played_at", "map_number", "map_name"]


def stg_players(maps: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    sides = ["side_1_team", "side_2_team", "side_1_rounds", "side_2_rounds"]
    rows = nested.unfold(maps, F.col("players"), "p", [*_MAP, *sides, *more])
    p = lambda name: F.col(f"p.{name}")
    one, two = F.col("side_1_rounds"), F.col("side_2_rounds")
    return rows.select(
        *_MAP, p("side").alias("side"), F.when(p("side") == 1, F.col("side_1_team")).when(p("side") == 2, F.col("side_2_team")).alias("team"), p("page").alias("player"), p("name").alias("player_name"), p("agent").alias("agent"),
        (one + two).alias("rounds_played"), x.won_map(p("side"), one, two).alias("won_map"), p("acs").alias("acs"), p("kills").alias("kills"), p("deaths").alias("deaths"), p("assists").alias("assists"), p("kast").alias("kast_pct"), p("adr").alias("adr"),
        p("headshot_pct").alias("headshot_pct"), p("first_kills").alias("first_kills"), p("first_deaths").alias("first_deaths"), *more,
    ).filter(F.col("player").isNotNull())


def stg_rounds(maps: DataFrame) -> DataFrame:
    return _round_columns(nested.unfold(maps, F.col("rounds"), "r", _MAP))


def _round_columns(rows: DataFrame, more: Sequence[Column | str] = ()) -> DataFrame:
    c = lambda name: F.col(f"r.{name}")
    return rows.select(
        x.readable_key("map_key", c("number"), sep="#").alias("round_key"), *_MAP, c("number").alias("round_number"), c("winner").alias("winning_side"), c("winner_side").alias("winning_role"), c("outcome").alias("outcome"), c("first_kill").alias("first_kill_player"), c("clutch").alias("clutch_player"), *more,
    )


def stg_veto(series: DataFrame) -> DataFrame:
    rows = nested.unfold(series, F.col("doc.veto"), "v", ["series_key", "discipline", "played_at"])
    return rows.select("series_key", "discipline", "played_at", F.col("v.order").alias("veto_order"), F.col("v.action").alias("action"), F.col("v.map").alias("map_name"), F.col("v.team").alias("team"))


def dim_tournament(tournaments: DataFrame, seed: DataFrame) -> DataFrame:
    df = r.attach_tier(tournaments, seed, ["discipline", "tier_key"])
    start, end = F.col("start_date"), F.col("end_date")
    return df.select(
        x.readable_key("source_name", "discipline", "page_id").alias("tournament_key"), "source_name", "discipline", "page_id", "page_title", "tournament_name", "series_name", "organizer", "tier_source", "tier_rank", "tier_label", "tier_key", "tier_type", "game", "setting", "country", "city", "start_date",
        x.consistent_end(start, end).alias("end_date"), x.has_date_conflict(start, end).alias("has_date_conflict"), x.duration_days(start, end).alias("duration_days"), "prize_pool_usd", "team_count", "revised_at",
    )


TOURNAMENT = ["tournament_key", "tier_rank"]


def _with_tournament(df: DataFrame, tournaments: DataFrame) -> DataFrame:
    # a page title that stands for two tournaments would multiply their series
    return r.attach_one(df, tournaments, {"discipline": "discipline", "tournament_page": "page_title"}, TOURNAMENT, narrow=True)


def fct_series(series: DataFrame, tournaments: DataFrame) -> DataFrame:
    df = _with_tournament(series, tournaments)
    one, two = F.col("side_1_maps"), F.col("side_2_maps")
    return df.select(
        "series_key", "source_name", "discipline", "page_title", "played_at", x.as_day(F.col("played_at")).alias("played_on"), "tournament_key", "tier_rank", "tournament_page", "side_1_team", "side_2_team", "side_1_maps", "side_2_maps", "map_count",
        x.winner_by_score(one, two).alias("winning_side"), x.winner_by_score(one, two, F.col("side_1_team"), F.col("side_2_team")).alias("winner_team"),
    )


def fct_map(maps: DataFrame, series: DataFrame, veto: DataFrame) -> DataFrame:
    df = r.attach(maps.drop("players", "rounds"), series, ["series_key"], ["tournament_key", "tier_rank"], narrow=True)
    picks = r.pick_per_map(veto, ["series_key", "map_name"])
    return _map_facts(r.attach(df, picks, ["series_key", "map_name"], {"action": "__action", "team": "__team"}, narrow=True))


def maps_of_series(series: DataFrame, tournaments: DataFrame) -> DataFrame:
    """`fct_map` from the series that hold their maps and vetoes: the pick of a map is read within the row, and a map
    moves once, to its tournament."""
    rows = nested.unfold(series, F.col("doc.maps"), "m", [*_SERIES, F.col("doc.veto").alias("__veto")])
    picks = F.filter("__veto", lambda v: v["action"].isin(*r.PICKS) & (v["map"] == F.col("m.map")))
    maps = _map_columns(rows.withColumn("__picks", picks), [F.array_min("__picks.action").alias("__action"), F.array_min("__picks.team").alias("__team")])
    return _map_facts(_with_tournament(maps, tournaments))


def _map_facts(df: DataFrame) -> DataFrame:
    """The columns of `fct_map` of maps with their tournament and pick."""
    one, two, a, b = F.col("side_1_rounds"), F.col("side_2_rounds"), F.col("side_1_team"), F.col("side_2_team")
    played, overtime = x.rounds_and_overtime(one, two)
    rest = [c for c in df.columns if c.startswith("side_") and c not in ("side_1_team", "side_2_team", "side_1_rounds", "side_2_rounds")]
    return df.select(
        "map_key", "series_key", "discipline", "tournament_key", "tier_rank", "played_at", "map_number", "map_name", "duration_seconds", "side_1_team", "side_2_team", "side_1_rounds", "side_2_rounds", played.alias("rounds_played"), overtime.alias("went_to_overtime"),
        x.winner_by_score(one, two).alias("winning_side"), x.winner_by_score(one, two, a, b).alias("winner_team"), *[c.alias(n) for n, c in x.pick_attributes(F.col("__action"), F.col("__team"), a, b).items()], *rest,
    )


MATCH_SHAPE = {"match_key": "string", "source_name": "string", "discipline": "string", "series_key": "string", "tournament_key": "string", "started_at": "timestamp", "duration_seconds": "int", "side_1_team": "string", "side_2_team": "string", "side_1_score": "int", "side_2_score": "int", "winning_side": "int", "source_tournament_name": "string"}


def fct_match(matches: DataFrame, maps: DataFrame) -> DataFrame:
    c = F.col
    listed = {n: c(n) for n in ("source_name", "discipline", "started_at", "duration_seconds", "side_1_score", "side_2_score", "winning_side")}
    listed |= {"match_key": x.readable_key("source_name", "discipline", "match_id"), "series_key": x.readable_key(F.lit(f"{MATCH_FEED}:dota2:serie"), "series_id"), "side_1_team": c("side_1_team_name"), "side_2_team": c("side_2_team_name"), "source_tournament_name": c("league_name")}
    played = {n: c(n) for n in ("discipline", "series_key", "tournament_key", "duration_seconds", "side_1_team", "side_2_team", "winning_side")}
    played |= {"match_key": c("map_key"), "source_name": F.lit(PAGES_FEED), "started_at": c("played_at"), "side_1_score": c("side_1_rounds"), "side_2_score": c("side_2_rounds")}
    df = r.union_common_shape([(matches, listed), (maps, played)], MATCH_SHAPE)
    return df.withColumns({"started_on": x.as_day(c("started_at")), "score_gap": x.score_gap(c("side_1_score"), c("side_2_score"))})


def fct_player_map(players: DataFrame, maps: DataFrame | None = None) -> DataFrame:
    """Without `maps`, players that already have the tournament of their map."""
    df = players if maps is None else r.attach(players, maps, ["map_key"], TOURNAMENT, narrow=True)
    c = F.col
    more = {
        "player_map_key": x.readable_key("map_key", "player", sep="#"), "kill_diff": c("kills") - c("deaths"), "first_kill_diff": c("first_kills") - c("first_deaths"), "kd_ratio": x.safe_ratio(c("kills"), c("deaths")),
        "kills_per_round": x.safe_ratio(c("kills"), c("rounds_played")), "first_kills_per_round": x.safe_ratio(c("first_kills"), c("rounds_played")),
    }
    return df.withColumns(more)


def players_of_maps(maps: DataFrame, facts: DataFrame) -> DataFrame:
    """`fct_player_map` from the maps that hold the players: one row a map, not one a player, meets its fact."""
    return fct_player_map(stg_players(r.attach(maps.drop("rounds"), facts, ["map_key"], TOURNAMENT, narrow=True), TOURNAMENT))


def _converted(df: DataFrame) -> DataFrame:
    return df.withColumns({"first_kill_converted": F.col("first_kill_side") == F.col("winning_side"), "was_clutch": F.col("clutch_player").isNotNull()})


def fct_round(rounds: DataFrame, players: DataFrame, maps: DataFrame) -> DataFrame:
    """The running score is taken before the joins, whose keys are unique; all three share the exchange by map, whose
    rounds are some dozens."""
    df = r.score_before(rounds, ["map_key"], ["round_number"], "winning_side", {1: "side_1_score_before", 2: "side_2_score_before"}, largest=None)
    df = r.attach(df, maps, ["map_key"], TOURNAMENT, narrow=True)
    df = r.attach(df, players, {"map_key": "map_key", "first_kill_player": "player"}, {"side": "first_kill_side"}, narrow=True)
    return _converted(df)


def rounds_of_maps(maps: DataFrame, facts: DataFrame) -> DataFrame:
    """`fct_round` from the maps that hold rounds and players. A map_key is one row of `maps`, so the running score and
    the side of who opened are read within the row, and one row a map, not one a round, meets its fact."""
    slim = maps.select(*_MAP, F.sort_array("rounds").alias("rounds"), F.col("players.page").alias("__pages"), F.col("players.side").alias("__sides"))
    joined = r.attach(slim, facts, ["map_key"], TOURNAMENT, narrow=True)
    rows = joined.select(*_MAP, *TOURNAMENT, "__pages", "__sides", F.col("rounds.winner").alias("__won"), F.posexplode("rounds").alias("__at", "r"))
    ahead, who = F.slice("__won", F.lit(1), F.col("__at")), F.col("r.first_kill")
    before = lambda side: (F.size(ahead) - F.size(F.array_remove(ahead, side))).cast("bigint")
    # a player who is listed twice in a map gives two rows, as a join would; else the first place is the only one
    twice = F.size("__pages") != F.size(F.array_distinct("__pages"))
    both = F.filter(F.arrays_zip(F.col("__pages").alias("page"), F.col("__sides").alias("side")), lambda p: p["page"] == who)["side"]
    opened = F.when(twice, both).otherwise(F.array(F.try_element_at("__sides", F.nullif(F.array_position("__pages", who).cast("int"), F.lit(0)))))
    told = _round_columns(rows, [*TOURNAMENT, before(1).alias("side_1_score_before"), before(2).alias("side_2_score_before"), opened.alias("__opened")])
    return _converted(told.select(*[c for c in told.columns if c != "__opened"], F.explode_outer("__opened").alias("first_kill_side")))


def fct_veto(veto: DataFrame, series: DataFrame) -> DataFrame:
    df = r.attach(veto, series, ["series_key"], ["tournament_key", "tier_rank", "side_1_team", "side_2_team"], narrow=True)
    side = x.side_of_team(F.col("team"), F.col("side_1_team"), F.col("side_2_team")).alias("side")
    return df.select(x.readable_key("series_key", "veto_order", sep="#").alias("veto_key"), "series_key", "discipline", "tournament_key", "tier_rank", "played_at", "veto_order", "action", "map_name", "team", side)


#: Each model: how it is made, and from which models and raw tables.
MODELS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "stg_matches": (stg_matches, ("matches",)),
    "stg_tournaments": (stg_tournaments, ("tournaments",)),
    "stg_series": (stg_series, ("match_pages",)),
    "stg_maps": (stg_maps, ("stg_series",)),
    "stg_players": (stg_players, ("stg_maps",)),
    "stg_rounds": (stg_rounds, ("stg_maps",)),
    "stg_veto": (stg_veto, ("stg_series",)),
    "dim_tournament": (dim_tournament, ("stg_tournaments", "seed")),
    "fct_series": (fct_series, ("stg_series", "dim_tournament")),
    "fct_map": (maps_of_series, ("stg_series", "dim_tournament")),
    "fct_match": (fct_match, ("stg_matches", "fct_map")),
    "fct_player_map": (players_of_maps, ("stg_maps", "fct_map")),
    "fct_round": (rounds_of_maps, ("stg_maps", "fct_map")),
    "fct_veto": (fct_veto, ("stg_veto", "fct_series")),
}


def sources_of(*models: str) -> set[str]:
    """The raw tables (and the seed) that models rest on."""
    return set().union(*(sources_of(*MODELS[name][1]) if name in MODELS else {name} for name in models))


def build_marts(raw: Mapping[str, DataFrame], seed: DataFrame, save=None, want: Sequence[str] = tuple(MODELS), document: str = DOCUMENT_DDL) -> dict[str, DataFrame]:
    """The models that are wanted (default: all), in order. `save(name, df)` may write a model and return the written
    one; the parsed documents (stg_series) are what is worth writing, as four models read them. A model that no wanted
    one rests on is not made, and `raw` need not hold its tables. Models without players and rounds do with less of
    the documents (SUMMARY_DDL)."""
    made: dict[str, DataFrame] = {**raw, "seed": seed}

    def get(name: str) -> DataFrame:
        if name not in made:
            make, needs = MODELS[name]
            more = {"document": document} if name == "stg_series" else {}
            df = make(*map(get, needs), **more)
            made[name] = save(name, df) if save else df
        return made[name]

    return {name: get(name) for name in want}


def recount_mismatch(rounds: DataFrame, maps: DataFrame) -> DataFrame:
    """Maps whose stated score is not what their rounds add up to, by side."""
    won = r.count_filtered(rounds, ["map_key"], counted_1=F.col("winning_side") == 1, counted_2=F.col("winning_side") == 2)
    stated = maps.select("map_key", "side_1_rounds", "side_2_rounds")
    return r.reconcile(stated, won, ["map_key"], {"side_1_rounds": "counted_1", "side_2_rounds": "counted_2"})
