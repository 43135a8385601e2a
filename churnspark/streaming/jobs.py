"""Structured Streaming jobs over activity events (event_id, ts, msno and the activity metrics).

All of them stop when the input is used up (``availableNow``) and keep their state in a checkpoint folder, so the next
start goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from churnspark import contract as C
from churnspark.functions.columns import ratio
from churnspark.functions.dates import date_to_ymd
from churnspark.operators.features import log_features
from churnspark.operators.monitor import tier_psi
from churnspark.operators.policy import assign_action
from churnspark.sources.staging import stage

USER_PARTS = 64
SLICE_FILES = 8
KEPT_VERSIONS = "spark.sql.streaming.maxBatchesToRetainInMemory"
PROGRESS = "batch bigint, watermark string, read_rows bigint, state_rows bigint, dropped_rows bigint"
DAY_SUMS = [f"{m}_sum_d" for m in C.LOG_METRICS]


def read_events(spark: SparkSession, path: str, schema, pattern: str | None = None, max_files: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_table_events(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A table as a stream, whether it is one Parquet file or a folder of parts."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getFileStatus(where).isDirectory():
        return read_events(spark, path, schema, max_files=max_files)
    return read_events(spark, path.rsplit("/", 1)[0], schema, path.rsplit("/", 1)[1], max_files)


def distinct_events(events: DataFrame, id: str = "event_id", ts: str = "ts", delay: str = "2 days") -> DataFrame:
    """Drops replayed events; ids are remembered for the watermark delay."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([id])


def daily_windows(events: DataFrame, ts: str = "ts", delay: str | None = "2 days") -> DataFrame:
    """Activity per user and day, the same columns as the batch ``log_daily``.

    Pass ``delay=None`` when the events already carry a watermark. Works on batch tables too.
    """
    rows = events.withWatermark(ts, delay) if delay and events.isStreaming else events
    return rows.groupBy(F.window(ts, "1 day"), C.KEY).agg(
        F.count(F.lit(1)).alias("row_cnt_d"),
        *[F.sum(F.col(m).cast("double")).alias(f"{m}_sum_d") for m in C.LOG_METRICS],
    ).select(C.KEY, date_to_ymd(F.col("window.start")).alias("date"), "row_cnt_d", *DAY_SUMS)


def sessions(events: DataFrame, ts: str = "ts", gap: str = "30 minutes", delay: str = "2 days") -> DataFrame:
    """Sessions per user on a stream, one state row per user and open session. Safe for very active users are
    ``run_sessions`` with ``joined_sessions`` and, for tables, ``features.sessions``."""
    rows = events.withWatermark(ts, delay) if events.isStreaming else events
    return rows.groupBy(C.KEY, F.session_window(ts, gap)).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("total_secs").cast("double")).alias("total_secs")
    ).select(C.KEY, F.col("session_window.start").alias("session_start"),
             F.col("session_window.end").alias("session_end"), "n_events", "total_secs")


def session_runs(events: DataFrame, ts: str = "ts", gap: str = "30 minutes", delay: str | None = "2 days",
                 slice_seconds: int = 86_400) -> DataFrame:
    """Runs: sessions cut at the borders of time slices. The state is one list of runs per user and slice, so a user who is
    never silent is not one ever-growing state row, and a closed slice leaves the state."""
    rows = events.withWatermark(ts, delay) if delay and events.isStreaming else events
    slice_of = F.floor(F.unix_seconds(ts) / slice_seconds).cast("bigint").alias("slice")
    return rows.groupBy(C.KEY, slice_of, F.session_window(ts, gap)).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("total_secs").cast("double")).alias("total_secs")
    ).select(C.KEY, "slice", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
             "n_events", "total_secs")


@contextmanager
def _one_version_in_memory(spark: SparkSession) -> Iterator[None]:
    """A stream started inside keeps the latest version of its state in memory instead of the latest two, unless the session
    says how many. A stream takes the session's settings when it starts."""
    if spark.conf.get(KEPT_VERSIONS, None):
        yield
        return
    spark.conf.set(KEPT_VERSIONS, "1")
    try:
        yield
    finally:
        spark.conf.unset(KEPT_VERSIONS)


def run_sessions(events: DataFrame, path: str, checkpoint: str, gap: str = "30 minutes", delay: str | None = "2 days",
                 slice_seconds: int = 86_400) -> StreamingQuery:
    """Append mode: a run is written, to the folder of its slice, when the watermark has passed its end. A micro-batch adds at
    most ``SLICE_FILES`` files to a slice, however many parts the state has. The open runs, those of one micro-batch at
    least, lie in the executors' memory; a session with RocksDB as its state store keeps them on disk."""
    runs = session_runs(events, gap=gap, delay=delay, slice_seconds=slice_seconds)
    few = runs.repartition("slice", F.pmod(F.xxhash64(C.KEY), F.lit(SLICE_FILES)))
    with _one_version_in_memory(events.sparkSession):
        return (
            few.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).partitionBy("slice").trigger(availableNow=True).start()
        )


def watermark_of(query: StreamingQuery) -> str | None:
    """The watermark (UTC, ISO) that the query's last micro-batches worked with."""
    return max((p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p.get("eventTime", {})), default=None)


def progress_of(query: StreamingQuery) -> DataFrame:
    """A row per micro-batch of this start of the query (the latest ``spark.sql.streaming.numRecentProgressUpdates`` of them):
    batch, watermark, rows read, rows in the state, and the rows the stateful operators dropped behind the watermark.

    An aggregation drops rows after its map-side sums, so events of one key that meet in a task are dropped as one row; a
    de-duplication drops single events. Append it to a table to keep a count over restarts.
    """
    rows = []
    for p in query.recentProgress:  # a few figures per micro-batch
        state = p["stateOperators"]
        rows.append((p["batchId"], p.get("eventTime", {}).get("watermark"), p["numInputRows"],
                     sum(o["numRowsTotal"] for o in state), sum(o["numRowsDroppedByWatermark"] for o in state)))
    return SparkSession.getActiveSession().createDataFrame(rows, PROGRESS)


def joined_sessions(runs: DataFrame, watermark: str | None = None, gap_seconds: int = 1800, slice_seconds: int = 86_400) -> DataFrame:
    """The sessions that the runs form across slices. With a watermark only those that are final: they end before the end of
    the last slice of which every run has been written. A user has at most slice / gap runs in a slice to be put in order."""
    ends = W.partitionBy(C.KEY).orderBy("session_start", "session_end")
    before = F.max("session_end").over(ends.rowsBetween(W.unboundedPreceding, -1))
    numbered = runs.withColumn("_new", F.coalesce((F.col("session_start") > before).cast("int"), F.lit(1)))
    out = numbered.withColumn("_nth", F.sum("_new").over(ends.rowsBetween(W.unboundedPreceding, 0))).groupBy(C.KEY, "_nth").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.sum("n_events").alias("n_events"), F.sum("total_secs").alias("total_secs")).drop("_nth")
    if watermark is None:
        return out
    seen = F.unix_micros(F.to_timestamp(F.lit(watermark))) - gap_seconds * 1_000_000
    closed = F.floor(seen / (slice_seconds * 1_000_000)) * slice_seconds * 1_000_000
    return out.where(F.unix_micros("session_end") <= closed)


def _read_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upsert(batch: DataFrame, path: str, keys: Sequence[str], part: str) -> None:
    """Replace the rows of the batch's keys in a table that is partitioned by ``part``, rewriting only the parts it touches.

    ``batch`` is a written table with one row per key. The new content of the touched parts is written to a side folder
    first and then moved in by one dynamic partition overwrite, so a replayed batch writes the same rows again. The
    overwrite itself is as safe as the file system's renames: on an object store a failure in its middle is mended by the
    replay, not hidden from readers.
    """
    old = _read_or_none(batch.sparkSession, path, batch.schema)
    merged = batch
    if old is not None:
        touched = batch.select(part).distinct()  # as many rows as parts in the batch
        kept = old.join(F.broadcast(touched), part, "left_semi").join(batch.select(*keys), list(keys), "left_anti")
        merged = stage(kept.unionByName(batch), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").partitionBy(part).parquet(path)


def upsert_days(batch: DataFrame, path: str) -> None:
    """Replace the (user, day) rows that the batch updates, rewriting only the days it touches."""
    upsert(stage(batch, "daily-update"), path, [C.KEY, "date"], "date")


def upsert_users(features: DataFrame, path: str, parts: int = USER_PARTS) -> None:
    """Replace the feature rows of the users in ``features``: the table has one row per user, in ``parts`` hash parts."""
    part = F.pmod(F.xxhash64(C.KEY), F.lit(parts)).cast("int")
    upsert(stage(features.withColumn("user_part", part), "feature-update"), path, [C.KEY], "user_part")


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``upsert_users`` keeps."""
    return spark.read.parquet(path).drop("user_part")


def run_daily(events: DataFrame, path: str, checkpoint: str, delay: str | None = "2 days",
              then: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Live daily table: update mode, every batch upserts the days it changed.

    ``then`` receives the updated (user, day) rows of the batch, e.g. to refresh the features of those users. The batch is
    written once; both steps read what was written.
    """
    def write(batch: DataFrame, _: int) -> None:
        days = stage(batch, "daily-update")
        upsert(days, path, [C.KEY, "date"], "date")
        if then is not None:
            then(days)

    return (
        daily_windows(events, delay=delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(availableNow=True).start()
    )


def run_closed_days(events: DataFrame, path: str, checkpoint: str, delay: str = "2 days") -> StreamingQuery:
    """Append mode: a day is written once, when the watermark has passed it."""
    return (
        daily_windows(events, delay=delay).writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def late_rows(batch_daily: DataFrame, stream_daily: DataFrame) -> DataFrame:
    """Days where the stream holds fewer rows than the batch job: events that arrived after the watermark."""
    s = stream_daily.select(C.KEY, "date", F.col("row_cnt_d").alias("_s"))
    return batch_daily.join(s, [C.KEY, "date"], "left").select(
        C.KEY, "date", (F.col("row_cnt_d") - F.coalesce("_s", F.lit(0))).alias("n_late")
    ).where("n_late > 0")


def refresh_features(daily: DataFrame, touched: DataFrame) -> DataFrame:
    """Stage-two features of the users in a batch, recomputed from their daily rows."""
    users = touched.select(C.KEY).distinct()
    return log_features(daily.join(users, C.KEY, "left_semi"))


# ---- features kept as additive state -----------------------------------------------------------------------------------

# Users of a part of the state table, about; a table that outgrows it is dealt out anew to twice as many parts.
PART_ROWS = 1_000_000
MAXIMA = ("total_secs", "num_unq")


def day_changes(days: DataFrame, old: DataFrame | None) -> DataFrame:
    """What the updated (user, day) rows change, per user: additions to counts and sums, extremes, and whether a day shrank."""
    was = {c: F.col(f"_old_{c}") for c in ("row_cnt_d", *DAY_SUMS)}
    if old is None:
        both = days.withColumns({f"_old_{c}": F.lit(None).cast("double") for c in was})
    else:
        both = days.join(old.select(C.KEY, "date", *[F.col(c).alias(f"_old_{c}") for c in was]), [C.KEY, "date"], "left")
    more = {c: F.col(c) - F.coalesce(was[c], F.lit(0)) for c in was}
    shrank = [F.coalesce(F.col(f"{m}_sum_d") < was[f"{m}_sum_d"], F.lit(False)) for m in MAXIMA]
    return both.groupBy(C.KEY).agg(
        F.sum(more["row_cnt_d"]).cast("bigint").alias("row_cnt"), F.count_if(was["row_cnt_d"].isNull()).alias("days"),
        F.min("date").cast("bigint").alias("first"), F.max("date").cast("bigint").alias("last"),
        *[F.sum(more[f"{m}_sum_d"]).alias(f"{m}_sum") for m in C.LOG_METRICS],
        *[F.max(f"{m}_sum_d").alias(f"{m}_max") for m in MAXIMA], F.bool_or(shrank[0] | shrank[1]).alias("shrank"))


def features_of_state(state: DataFrame) -> DataFrame:
    """The 18 engagement features, from one row of sums per user."""
    plays = sum((F.col(f"{b}_sum") for b in C.PLAY_BUCKETS[1:]), F.col(f"{C.PLAY_BUCKETS[0]}_sum"))
    by_day = [e for m in MAXIMA for e in (F.col(f"{m}_sum"), (F.col(f"{m}_sum") / F.col("days")).alias(f"{m}_mean_per_active_day"),
                                          F.col(f"{m}_max").alias(f"{m}_max_per_day"))]
    return state.select(
        C.KEY, F.col("row_cnt").alias("log_row_cnt"), F.col("first").alias("log_first_date"), F.col("last").alias("log_last_date"),
        F.col("days").alias("log_active_days"), (F.col("last") - F.col("first")).alias("log_span_days_approx"), *by_day,
        *[f"{b}_sum" for b in C.PLAY_BUCKETS], ratio(F.col("num_100_sum"), plays).alias("listen_full_share"),
        ratio(plays, F.col("num_unq_sum")).alias("listens_per_unique_track"))


def _written(spark: SparkSession, folder: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def _parts_of(spark: SparkSession, path: str) -> int | None:
    """Parts of the newest complete version of the state table, whose folders are called parts=<n>."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    names = [f.getPath().getName() for f in files.listStatus(root)]
    return max([int(n.removeprefix("parts=")) for n in names if n.startswith("parts=") and _written(spark, f"{path}/{n}")], default=None)


def user_part(parts: int) -> Column:
    return F.pmod(F.xxhash64(C.KEY), F.lit(parts)).cast("int")


def read_state(spark: SparkSession, path: str, users: DataFrame | None = None) -> DataFrame | None:
    """The state table; with ``users`` only the parts they lie in are read."""
    parts = _parts_of(spark, path)
    if parts is None:
        return None
    state = spark.read.parquet(f"{path}/parts={parts}")
    if users is None:
        return state
    touched = [r[0] for r in users.select(user_part(parts)).distinct().collect()]  # at most one number per part
    return state.where(F.col("user_part").isin(touched))


def merge_state(changes: DataFrame, path: str, batch: int, daily: str, part_rows: int = PART_ROWS) -> None:
    """Adds a batch's changes to its users' rows, rewriting the parts they lie in. A row that holds this batch already stays
    as it is, so a replay changes nothing. Users with a day that shrank are summed up anew from their daily rows."""
    if changes.isEmpty():
        return
    spark = changes.sparkSession
    parts = _parts_of(spark, path)
    mode = "dynamic" if parts else "static"  # a new table is written whole, which marks it as complete
    shrunk = changes.where("shrank").select(C.KEY)
    columns = [c for c in changes.columns if c not in (C.KEY, "shrank")]
    again = day_changes(spark.read.parquet(daily).join(shrunk, C.KEY, "left_semi"), None).select(C.KEY, *[F.col(c).alias(f"_r_{c}") for c in columns])
    fresh = changes.join(again, C.KEY, "left")
    old = read_state(spark, path, changes)
    if old is None:
        parts = max(1, -(-changes.count() // part_rows))
        old = changes.select(C.KEY, *columns).withColumns({"batch": F.lit(-1).cast("bigint"), "user_part": F.lit(0)}).limit(0)
    old = old.select(C.KEY, "batch", *[F.col(c).alias(f"_o_{c}") for c in columns])
    both = old.join(fresh, C.KEY, "full")
    join = {"first": F.least, "last": F.greatest, **{f"{m}_max": F.greatest for m in MAXIMA}}
    keep = F.coalesce(F.col("batch") >= batch, F.lit(False)) | (F.col("days").isNull())

    def merged(c: str) -> Column:
        mine, theirs = F.col(f"_o_{c}"), F.col(c)
        added = join[c](mine, theirs) if c in join else F.coalesce(mine, F.lit(0)) + theirs
        return F.when(keep, mine).when(F.col("shrank"), F.col(f"_r_{c}")).otherwise(added).alias(c)

    stamp = F.when(keep, F.col("batch")).otherwise(F.lit(batch)).cast("bigint").alias("batch")
    rows = stage(both.select(C.KEY, stamp, *[merged(c) for c in columns]).withColumn("user_part", user_part(parts)), "state-update")
    write = {"partitionOverwriteMode": mode, "compression": "zstd"}
    rows.write.mode("overwrite").options(**write).partitionBy("user_part").parquet(f"{path}/parts={parts}")
    users = spark.read.parquet(f"{path}/parts={parts}")
    if users.count() > 2 * parts * part_rows:
        more = stage(users.drop("user_part").withColumn("user_part", user_part(2 * parts)), "state-parts")
        more.write.mode("overwrite").option("compression", "zstd").partitionBy("user_part").parquet(f"{path}/parts={2 * parts}")


def run_features(events: DataFrame, path: str, checkpoint: str, delay: str | None = "2 days", part_rows: int = PART_ROWS) -> StreamingQuery:
    """Daily rows and, from them, the features of every user as running state. A batch reads the days it changes and the
    parts of its users, nothing else. Its changes are written before anything is updated, so a batch that failed half way is
    repeated with the changes it had at first."""
    def write(batch: DataFrame, number: int) -> None:
        spark, pending = batch.sparkSession, f"{path}/pending/batch={number}"
        days = stage(batch, "daily-update")
        old = _read_or_none(spark, f"{path}/daily", days.schema)
        if not _written(spark, pending):
            dates = [r[0] for r in days.select("date").distinct().collect()]  # the days of one batch
            known = None if old is None else old.where(F.col("date").isin(dates))
            day_changes(days, known).write.mode("overwrite").parquet(pending)
        upsert(days, f"{path}/daily", [C.KEY, "date"], "date")
        merge_state(spark.read.parquet(pending), f"{path}/users", number, f"{path}/daily", part_rows)

    return (
        daily_windows(events, delay=delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(availableNow=True).start()
    )


def tier_windows(scored: DataFrame, ts: str = "ts", size: str = "1 day", delay: str | None = "2 days", policy: dict = C.POLICY,
                 score: str = "y_proba", min_rows: int = C.PSI_MIN_ROWS) -> DataFrame:
    """Tier counts and their drift per window of event time: window_start, window_end, n, n_<tier>, psi, status.

    The state holds one row of counts per open window, whatever the traffic; batch tables give the same rows.
    """
    rows = scored.withWatermark(ts, delay) if delay and scored.isStreaming else scored
    out = tier_psi(rows, policy, score, [F.window(ts, size)], min_rows)
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *[c for c in out.columns if c != "window"])


def run_tier_windows(scored: DataFrame, path: str, checkpoint: str, ts: str = "ts", size: str = "1 day", delay: str = "2 days",
                     policy: dict = C.POLICY, min_rows: int = C.PSI_MIN_ROWS) -> StreamingQuery:
    """Append mode: a window's drift is written once, when the watermark has passed its end, however the stream was cut."""
    return (
        tier_windows(scored, ts, size, delay, policy, min_rows=min_rows).writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def run_scoring(rows: DataFrame, predict: Callable[[DataFrame], DataFrame], path: str, psi_path: str, checkpoint: str,
                policy: dict = C.POLICY) -> StreamingQuery:
    """Score a stream (``predict`` adds ``y_proba``), assign tiers, and log the tier drift of every micro-batch."""
    def write(batch: DataFrame, number: int) -> None:
        # One folder per micro-batch: a replay overwrites its own output.
        scored = stage(batch, "scored")
        scored.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={number}")
        tier_psi(scored, policy).write.mode("overwrite").parquet(f"{psi_path}/batch={number}")

    return (
        assign_action(predict(rows), policy).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(availableNow=True).start()
    )
