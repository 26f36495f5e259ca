"""Declared schemas of raw tables, of the match document, and the tier seed."""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@functools.cache
def struct(ddl: str) -> T.StructType:
    """A schema from its declaration; Spark reads it, so a session must be there by then."""
    return T.StructType.fromDDL(ddl)


@dataclass(frozen=True)
class TableSpec:
    """A keyed raw table: its columns, its key, and the columns that keep their first value."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    write_once: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return struct(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def updatable(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys and c not in self.write_once]


_STAMPS = "ingested_at timestamp, refreshed_at timestamp"

MATCHES = TableSpec(
    "matches",
    f"match_id bigint, start_time timestamp, duration_seconds int, radiant_team_id bigint, radiant_name string, dire_team_id bigint, dire_name string, radiant_score int, dire_score int, radiant_win boolean, league_id bigint, league_name string, series_id bigint, series_type int, parse_version int, payload string, {_STAMPS}",
    ("match_id",), ("ingested_at",),
)
TOURNAMENTS = TableSpec(
    "tournaments",
    f"wiki string, page_id bigint, page_title string, name string, series string, organizer string, tier string, tier_type string, game string, setting string, country string, city string, start_date date, end_date date, prize_pool_usd double, prize_pool_local string, local_currency string, team_count int, revised_at timestamp, infobox string, {_STAMPS}",
    ("wiki", "page_id"), ("ingested_at",),
)
LINKS = TableSpec("links", f"wiki string, tournament_page_id bigint, match_title string, {_STAMPS}", ("wiki", "tournament_page_id", "match_title"), ("ingested_at",))
PAGES = TableSpec(
    "match_pages",
    f"wiki string, page_title string, page_id bigint, revision_id bigint, status string, played_at timestamp, tournament_page string, team_1 string, team_2 string, score_1 int, score_2 int, map_count int, document string, html string, {_STAMPS}",
    ("wiki", "page_title"), ("ingested_at",),
)
RAW_TABLES = {t.name: t for t in (MATCHES, TOURNAMENTS, LINKS, PAGES)}

STATE = TableSpec("ingestion_state", "source string, discipline string, resource string, high_watermark bigint, backfill_cursor bigint, records_seen bigint, last_run_at timestamp", ("source", "discipline", "resource"))
RUNS = TableSpec("ingestion_runs", "run_id string, source string, discipline string, resource string, mode string, started_at timestamp, finished_at timestamp, pages bigint, records bigint, inserted bigint, updated bigint, stop_reason string, high_watermark bigint, backfill_cursor bigint, gap_suspected boolean", ("run_id",))

#: A match document, one per series.
DOCUMENT_DDL = ("""
    status string, played_at_epoch bigint, tournament_page string, tournament_name string,
    teams array<struct<page: string, name: string, short: string>>, score array<int>,
    veto array<struct<order: int, action: string, map: string, team: string>>,
    maps array<struct<number: int, map: string, score: array<int>, length: string,
        halves: array<array<struct<side: string, rounds: int>>>,
        team_stats: struct<first_kills: array<string>, clutches: array<string>, thrifties: array<string>, flawless: array<string>, post_plant: array<string>>,
        players: array<struct<side: int, page: string, name: string, agent: string, acs: double, kills: int, deaths: int, assists: int, kast: double, adr: double, headshot_pct: double, first_kills: int, first_deaths: int>>,
        rounds: array<struct<number: int, winner: int, winner_side: string, outcome: string, first_kill: string, clutch: string>>>>
""".replace("\n", " "))

#: The same without players and rounds.
SUMMARY_DDL = re.sub(r",\s*players: array<struct<.*?>>,\s*rounds: array<struct<.*?>>", "", DOCUMENT_DDL)

SEED_DDL = "discipline string, tier_key string, tier_rank int, tier_label string"

#: The tier spellings of each discipline, their rank and label; one spelling has no rank.
TIER_SEED = """discipline,tier_key,tier_rank,tier_label
counterstrike,s-tier,1,Premier
counterstrike,a-tier,2,Majeur
counterstrike,b-tier,3,Intermediaire
counterstrike,c-tier,4,Mineur
counterstrike,d-tier,5,Amateur
counterstrike,s,1,Premier
counterstrike,a,2,Majeur
counterstrike,b,3,Intermediaire
counterstrike,c,4,Mineur
counterstrike,d,5,Amateur
counterstrike,1,1,Premier
counterstrike,2,2,Majeur
counterstrike,3,3,Intermediaire
counterstrike,4,4,Mineur
counterstrike,5,5,Amateur
dota2,1,1,Premier
dota2,2,2,Majeur
dota2,3,3,Intermediaire
dota2,4,4,Mineur
dota2,5,5,Amateur
valorant,s-tier,1,Premier
valorant,a-tier,2,Majeur
valorant,b-tier,3,Intermediaire
valorant,c-tier,4,Mineur
valorant,d-tier,5,Amateur
valorant,s,1,Premier
valorant,a,2,Majeur
valorant,b,3,Intermediaire
valorant,c,4,Mineur
valorant,d,5,Amateur
valorant,1,1,Premier
valorant,2,2,Majeur
valorant,3,3,Intermediaire
valorant,4,4,Mineur
valorant,5,5,Amateur
valorant,showmatch,,Hors classement
"""


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str = SEED_DDL) -> DataFrame:
    """A CSV seed with a header and a declared schema; an empty field is null."""
    return spark.read.csv(path, schema=schema, header=True)


def tier_seed(spark: SparkSession) -> DataFrame:
    """The tier seed, 36 rows by its own definition."""
    rows = [line.split(",") for line in TIER_SEED.strip().splitlines()[1:]]
    return spark.createDataFrame([(d, k, int(r) if r else None, n) for d, k, r, n in rows], SEED_DDL)
