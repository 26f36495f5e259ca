"""Collection: records into a keyed table, its state and its run log, batch by batch or in bounded runs."""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rankwell.operators import incremental as inc
from rankwell.operators.incremental import BACKFILL, CATCHUP, State, Walk, advance
from rankwell.operators.relational import walk_bounds
from rankwell.operators.upsert import conform, last_wins
from rankwell.sources.bucketed import BUCKET_ROWS, BucketedTable
from rankwell.sources.schemas import RUNS, STATE, TableSpec

#: A run over records without a useful order of ids, which goes on from a token.
SCAN = "scan"


@dataclass(frozen=True)
class Feed:
    """A feed and where it is kept: the table with its state, and the run log beside it."""

    source: str
    discipline: str
    resource: str
    spec: TableSpec
    id_col: str
    order: str
    location: str
    bucket_rows: int = BUCKET_ROWS

    def table(self, spark: SparkSession) -> BucketedTable:
        return BucketedTable(spark, self.spec, f"{self.location}/table", self.bucket_rows)

    @property
    def key(self) -> tuple[str, str, str]:
        return self.source, self.discipline, self.resource


@dataclass(frozen=True)
class Slice:
    """What a run reads: the rows, what they cover, whether more follow, and the token to go on from (of a scan)."""

    rows: DataFrame
    walk: Walk
    more: bool
    pages: int
    token: str | None = None


def current_table(spark: SparkSession, feed: Feed, before: int | None = None) -> DataFrame:
    """The table after the newest batch (older than batch `before`, if given), empty at the start."""
    table = feed.table(spark)
    return table.rows(table.manifest(before))


def load_state(spark: SparkSession, feed: Feed, before: int | None = None) -> State:
    saved = feed.table(spark).manifest(before).saved
    return State(saved.get("high_watermark"), saved.get("backfill_cursor"), saved.get("records_seen", 0))


def load_token(spark: SparkSession, feed: Feed, before: int | None = None) -> str | None:
    """The token that a scan goes on from; null before the first and after the last page."""
    return feed.table(spark).manifest(before).saved.get("token")


def states_of(spark: SparkSession, feed: Feed) -> DataFrame:
    """The newest state as a row of the state table; none before the first batch."""
    saved = feed.table(spark).manifest().saved
    row = (*feed.key, saved.get("high_watermark"), saved.get("backfill_cursor"), saved["records_seen"], datetime.fromisoformat(saved["last_run_at"])) if saved else None
    return spark.createDataFrame([row] if row else [], STATE.schema)


def all_states(states: DataFrame) -> DataFrame:
    return states.orderBy("source", "resource", "discipline")


def run_history(runs: DataFrame) -> DataFrame:
    """The trace of runs, the latest first."""
    return runs.orderBy(F.desc("started_at"), "run_id")


def collect(batch: DataFrame, number: int, feed: Feed, now: datetime) -> None:
    """One batch of new records as one unit: the buckets of the table that it touches, and the state, in one version;
    then the run row.

    A batch that is run again starts from the version before it, so a crash costs at most this batch and leaves
    nothing twice. A run that fails leaves a row of its own and raises its error.
    """
    state = load_state(batch.sparkSession, feed, number)

    def read() -> Slice:
        bounds = walk_bounds(batch, feed.id_col, state.high_watermark).first()
        return Slice(batch, Walk(bounds["lowest"], bounds["highest"], bounds["records"], bounds["reached_known"]), False, 1)

    _run(batch.sparkSession, feed, number, CATCHUP, now, state, read)


def run_feed(source: DataFrame, feed: Feed, mode: str, now: datetime, page: int, max_pages: int, scan_order: Sequence[str] = (), slice_of: Callable[[State], DataFrame] | None = None) -> str:
    """One bounded run over a source of records: at most `max_pages` pages of `page` rows. Returns why it stopped.

    A catch-up reads from the top until it meets what is known; a backfill goes on strictly below the cursor; a scan
    goes through all records by `scan_order` (which tells records apart) from the stored token on, over as many runs
    as it takes, and clears the token at the end. `slice_of` stands in for a source that pages by itself: rows that do
    not lie below the cursor of a backfill are an error, since they would be asked for forever.
    """
    spark = source.sparkSession
    table = feed.table(spark)
    last = table.manifest()
    state, token = load_state(spark, feed), last.saved.get("token")

    def sliced() -> Slice:
        size = page * max_pages
        if mode == SCAN:
            after = None if token is None else tuple(json.loads(base64.b64decode(token)))
            rows = inc.token_slice(source, list(scan_order), after, size + 1)
        elif slice_of is not None:
            rows = slice_of(state)
        elif mode == BACKFILL:
            rows = inc.page_below(source, feed.id_col, state.backfill_cursor, size + 1)
        else:
            size = page * inc.catchup_pages(source, feed.id_col, state, page, max_pages)
            rows = inc.page_below(source, feed.id_col, None, size + 1)
        # one row more than is taken tells whether more follow
        ends = [F.asc(c) for c in scan_order] if mode == SCAN else [F.desc(feed.id_col)]
        found = rows.count()
        taken = found if slice_of is not None else min(found, size)
        kept = rows if slice_of is not None else rows.orderBy(*ends).limit(taken)
        bounds = walk_bounds(kept, feed.id_col, state.high_watermark).first()
        walk = Walk(bounds["lowest"], bounds["highest"], bounds["records"], bounds["reached_known"] and mode == CATCHUP)
        if mode == BACKFILL:
            inc.guard_progress(Walk(walk.lowest, walk.highest, walk.records, False), state.backfill_cursor)
            if slice_of is not None and state.backfill_cursor is not None and walk.highest is not None and walk.highest >= state.backfill_cursor:
                raise ValueError(f"the page does not descend: highest id {walk.highest}, cursor {state.backfill_cursor}")
        more = found > taken
        onward = None
        if mode == SCAN and more:
            at = kept.agg(F.max(F.struct(*scan_order)).alias("at")).first()["at"]
            onward = base64.b64encode(json.dumps(list(at)).encode()).decode()
        return Slice(kept, walk, more, -(-walk.records // page), onward)

    return _run(spark, feed, last.batch + 1, mode, now, state, sliced)


def _run(spark: SparkSession, feed: Feed, number: int, mode: str, now: datetime, state: State, read: Callable[[], Slice]) -> str:
    def log(name: str, *values) -> None:
        spark.createDataFrame([(f"{feed.resource}-{name}", *feed.key, mode, now, now, *values)], RUNS.schema).coalesce(1).write.mode("overwrite").parquet(f"{feed.location}/runs/run={name}")

    try:
        part = read()
        walk = part.walk
        after = State(None, None, state.records_seen + walk.records) if mode == SCAN else advance(state, walk, mode)
        rows = last_wins(part.rows, feed.spec.keys, feed.order)
        extra = {feed.order, "landed"} - set(feed.spec.columns)
        if feed.order in feed.spec.columns:
            rows, order = conform(rows.drop(*extra), feed.spec), feed.order
        else:
            # one row a key by now, so any order serves the merge
            rows, order = conform(rows.drop(*extra), feed.spec).withColumn("__order", F.lit(0)), "__order"
        saved = {"high_watermark": after.high_watermark, "backfill_cursor": after.backfill_cursor, "records_seen": after.records_seen, "token": part.token, "last_run_at": now.isoformat()}
        counts = feed.table(spark).merge(rows, number, order, saved)
    except Exception:
        log(f"{number}-{uuid.uuid4().hex}", 0, 0, 0, 0, "failed", state.high_watermark, state.backfill_cursor, False)
        raise
    reached = walk.reached_known and mode == CATCHUP
    reason = "empty_page" if not walk.records and not part.more else "caught_up" if reached else "page_limit" if part.more else "exhausted"
    gap = mode == CATCHUP and bool(walk.records) and state.high_watermark is not None and not reached
    log(str(number), part.pages, walk.records, counts["inserted"], counts["updated"], reason, after.high_watermark, after.backfill_cursor, gap)
    return reason


def runs_of(spark: SparkSession, feed: Feed) -> DataFrame:
    """The rows of all runs, failed ones too."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{feed.location}/runs")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], RUNS.schema)
    return spark.read.schema(RUNS.schema).parquet(f"{feed.location}/runs").select(*RUNS.columns)


def stream_collect(spark: SparkSession, landing: str, schema: T.StructType, feed: Feed, shape: Callable[[DataFrame], DataFrame], now: Callable[[], datetime], files_per_batch: int = 1000) -> StreamingQuery:
    """Collect all landed JSON files that are not collected yet and stop; the checkpoint takes the cursor's place.

    `shape` also gets `landed`, the order of arrival: the time and name of the file, then the place in it. A feed
    whose records carry no order of their own names it as its order, and the record that landed last wins.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(landing)
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("__at"), F.col("_metadata.file_path").alias("__file"))

    def each(df: DataFrame, number: int) -> None:
        landed = F.struct(F.col("__at"), F.col("__file"), F.monotonically_increasing_id().alias("__place")).alias("landed")
        collect(shape(df.select(*[c for c in df.columns if c not in ("__at", "__file")], landed)), number, feed, now())

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{feed.location}/checkpoint").trigger(availableNow=True).start()
