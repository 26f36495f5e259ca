"""Incremental collection as an interval algebra on a descending id, over tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CATCHUP, BACKFILL = "catchup", "backfill"


@dataclass(frozen=True)
class State:
    """Progress of a feed: the ids [backfill_cursor, high_watermark] are known without a gap."""

    high_watermark: int | None = None
    backfill_cursor: int | None = None
    records_seen: int = 0


@dataclass(frozen=True)
class Walk:
    """What one run covered."""

    lowest: int | None
    highest: int | None
    records: int
    reached_known: bool


def page_below(df: DataFrame, id_col: str, cursor: int | None, size: int) -> DataFrame:
    """The `size` greatest ids strictly below the cursor, descending; without a cursor, from the top."""
    below = df if cursor is None else df.filter(F.col(id_col) < cursor)
    return below.orderBy(F.desc(id_col)).limit(size)


def guard_progress(walk: Walk, cursor: int | None) -> None:
    """A page that does not go below the cursor would be asked for forever."""
    if cursor is not None and walk.lowest is not None and walk.lowest >= cursor:
        raise ValueError(f"the page does not descend: lowest id {walk.lowest}, cursor {cursor}")


def has_more(df: DataFrame, size: int) -> tuple[DataFrame, bool]:
    """The first `size` rows of an ordered frame and whether more follow."""
    return df.limit(size), df.limit(size + 1).count() > size


def catchup_pages(df: DataFrame, id_col: str, state: State, page: int, max_pages: int) -> int:
    """Pages that a catch-up reads: up to the first one whose lowest id is known, that one included.

    With n ids above the high watermark that is page n // page + 1, as each page is compared with the state before
    the run: one count instead of a walk.
    """
    if state.high_watermark is None:
        return max_pages
    above = df.agg(F.count_if(F.col(id_col) > state.high_watermark)).first()[0]
    return min(max_pages, above // page + 1)


def catchup_slice(df: DataFrame, id_col: str, state: State, page: int, max_pages: int) -> DataFrame:
    """The rows of a catch-up from the top."""
    return page_below(df, id_col, None, page * catchup_pages(df, id_col, state, page, max_pages))


def backfill_slice(df: DataFrame, id_col: str, state: State, page: int, max_pages: int) -> DataFrame:
    """The rows of a backfill, strictly below the cursor."""
    return page_below(df, id_col, state.backfill_cursor, page * max_pages)


def token_slice(df: DataFrame, order: list[str], after: tuple | None, size: int) -> DataFrame:
    """The next rows of a scan without a useful id order, after the given values of its ordering columns."""
    if after is not None:
        test: Column = F.lit(False)
        for i in reversed(range(len(order))):
            ahead, same = F.col(order[i]) > F.lit(after[i]), F.col(order[i]) == F.lit(after[i])
            test = ahead | (same & test)
        df = df.filter(test)
    return df.orderBy(*order).limit(size)


def advance(before: State, walk: Walk, mode: str) -> State:
    """State after a run. A walk that joins the known ids, and any backfill, extends the interval downwards; a
    catch-up that does not join makes an island, whose low end replaces the old one. An empty walk changes nothing."""
    if walk.lowest is None or walk.highest is None:
        return before
    joins = mode == BACKFILL or walk.reached_known
    low = walk.lowest if before.backfill_cursor is None or not joins else min(walk.lowest, before.backfill_cursor)
    high = walk.highest if before.high_watermark is None else max(walk.highest, before.high_watermark)
    return State(high, low, before.records_seen + walk.records)


def advance_columns(df: DataFrame, mode: str = "mode") -> DataFrame:
    """`advance` for a table of states and walks: columns high_watermark, backfill_cursor, records_seen, lowest,
    highest, records, reached_known, and the mode."""
    empty = F.col("lowest").isNull() | F.col("highest").isNull()
    joins = (F.col(mode) == BACKFILL) | F.col("reached_known")
    low = F.when(joins, F.least("lowest", "backfill_cursor")).otherwise(F.col("lowest"))
    return df.withColumns({
        "new_high": F.when(empty, F.col("high_watermark")).otherwise(F.greatest("highest", "high_watermark")),
        "new_low": F.when(empty, F.col("backfill_cursor")).otherwise(low),
        "new_seen": F.when(empty, F.col("records_seen")).otherwise(F.col("records_seen") + F.col("records")),
        "stop_reason": stop_reason(F.col("records"), F.col("more"), F.col("reached_known"), F.col("failed")),
        "gap": gap_suspected(F.col(mode), F.col("pages"), F.col("high_watermark"), F.col("reached_known")),
    })


def stop_reason(records: Column, more: Column, caught_up: Column, failed: Column) -> Column:
    """Why a run stopped. An empty page that promises more is not the end of the feed."""
    return F.when(failed, "failed").when((records == 0) & ~more, "empty_page").when(caught_up, "caught_up").when(~more, "exhausted").otherwise("page_limit")


def gap_suspected(mode: Column, pages: Column, known_high: Column, caught_up: Column) -> Column:
    """A catch-up of a known feed that read pages and did not reach what it knew."""
    return (mode == CATCHUP) & (pages >= 1) & known_high.isNotNull() & ~caught_up


def token_advance(before_seen: Column, next_token: Column, records: Column) -> dict[str, Column]:
    """State of a token scan: the token to go on from (null once finished), no high watermark."""
    return {"high_watermark": F.lit(None).cast("string"), "backfill_cursor": next_token, "records_seen": before_seen + records}
