"""Column expressions of the models: keys, sides, winners, conflicts, ratios, nested access.

All follow three-valued logic: where no branch is stated, the result is null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def neutral_sides(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Renames of a discipline's own side vocabulary to side_1 / side_2."""
    return df.withColumnsRenamed(dict(mapping))


def blank_to_null(value: Column) -> Column:
    """Trimmed of spaces; null if nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def fold_key(value: Column) -> Column:
    """A key whose case drifts: trimmed, lower case, blank as null."""
    return F.lower(blank_to_null(value))


def readable_key(*parts: Column | str, sep: str = ":") -> Column:
    """A natural key; null if any part is null."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    out = [columns[0].cast("string")]
    for column in columns[1:]:
        out += [F.lit(sep), column.cast("string")]
    return F.concat(*out)


def side_from_flag(flag: Column, if_true: Column | int = 1, if_false: Column | int = 2) -> Column:
    """1 for true, 2 for false (or what is given), null for null."""
    lift = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(flag, lift(if_true)).when(~flag, lift(if_false))


def winner_by_score(score_1: Column, score_2: Column, value_1: Column | int = 1, value_2: Column | int = 2) -> Column:
    """What belongs to the larger score; null for a tie or a missing score."""
    return side_from_flag(F.nullif(F.signum(score_1 - score_2), F.lit(0.0)) > 0, value_1, value_2)


def side_of_team(team: Column, team_1: Column, team_2: Column) -> Column:
    """1 or 2 by equality with a side's team, else null."""
    return F.when(team == team_1, 1).when(team == team_2, 2)


def consistent_end(start: Column, end: Column) -> Column:
    """The end if it is not before the start or if there is no start."""
    return F.when(end >= start, end).when(start.isNull(), end)


def has_date_conflict(start: Column, end: Column) -> Column:
    return F.coalesce(end < start, F.lit(False))


def duration_days(start: Column, end: Column) -> Column:
    """Days from start to end, both counted; null if inconsistent or open."""
    return F.when(end >= start, (F.date_diff(end, start) + 1).cast("bigint"))


def rounds_and_overtime(score_1: Column, score_2: Column, regular: int = 24) -> tuple[Column, Column]:
    """Rounds played, and whether more than the regular number were."""
    return score_1 + score_2, score_1 + score_2 > regular


def pick_attributes(action: Column, team: Column, team_1: Column, team_2: Column) -> dict[str, Column]:
    """Whether a map was the decider, who picked it, and from which side; null without a veto row."""
    picked = action == "pick"
    return {"is_decider": action == "decider", "picked_by": F.when(picked, team), "picking_side": F.when(picked, side_of_team(team, team_1, team_2))}


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def score_gap(score_1: Column, score_2: Column) -> Column:
    return F.abs(score_1 - score_2)


def as_day(instant: Column) -> Column:
    """Calendar day of an instant; the session's time zone is UTC."""
    return instant.cast("date")


def won_map(side: Column, score_1: Column, score_2: Column) -> Column:
    return F.when(side == 1, score_1 > score_2).when(side == 2, score_2 > score_1)


def tier_rank_case(tier: Column, spellings: Sequence[Sequence[str]] | None = None) -> Column:
    """Rank 1 to 4 by spelling; anything else, null too, ranks one lower."""
    groups = spellings or [(f"{letter}-tier", letter, str(rank)) for rank, letter in enumerate("sabc", 1)]
    folded = F.lower(tier)
    ranked = reduce(lambda chain, item: chain.when(folded.isin(*item[1]), item[0]), list(enumerate(groups, 1))[1:], F.when(folded.isin(*groups[0]), 1))
    return ranked.otherwise(len(groups) + 1)


def at(array: Column, index: int) -> Column:
    """Element by position from 0; null beyond the end."""
    return F.get(array, F.lit(index))


def rounds_by_role(halves: Column, role: str, side: str = "side", rounds: str = "rounds") -> Column:
    """Rounds of the halves played in a role; 0 if there are none."""
    mine = F.filter(halves, lambda half: half[side] == role)
    return F.coalesce(F.aggregate(mine, F.lit(0).cast("bigint"), lambda total, half: total + F.coalesce(half[rounds], F.lit(0))), F.lit(0).cast("bigint"))


def clock_to_seconds(clock: Column) -> Column:
    """"63:00" as seconds; minutes may pass 60; malformed is null."""
    part = lambda n: F.split_part(clock, F.lit(":"), F.lit(n)).try_cast("int")
    return part(1) * 60 + part(2)


def fraction_parts(text: Column) -> tuple[Column, Column]:
    """"5/8" as 5 and 8; malformed is null."""
    part = lambda n: F.split_part(text, F.lit("/"), F.lit(n)).try_cast("int")
    return part(1), part(2)


def team_stat_columns(stats: Column, names: Sequence[str] = ("first_kills", "clutches", "thrifties", "flawless")) -> dict[str, Column]:
    """One integer column for each side and statistic."""
    return {f"side_{side}_{name}": at(stats[name], side - 1).try_cast("int") for side in (1, 2) for name in names}


def starting_side(halves: Column) -> Column:
    """Role of the first side in its first half."""
    return at(at(halves, 0), 0)["side"]
