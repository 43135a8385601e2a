"""Registered queries: Structured Streaming jobs run to the end of their input, results read back from their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnspark import contract as C
from churnspark.plans.adapters import Tables
from churnspark.plans.queries_build import DAILY_DOUBLES
from churnspark.plans.registry import LOG_DOUBLES, oracle, query, r6, replaced
from churnspark.plans.queries_ml import DAY, GROUP, _saturated, _share_sql
from churnspark.plans.queries_score import action_sql
from churnspark.operators import features, models
from churnspark.sources.staging import stage_path
from churnspark.streaming import jobs

PLAYS = {"num_25": "view", "num_50": "click", "num_75": "signup", "num_985": "error", "num_100": "purchase"}


def activity(events: DataFrame) -> DataFrame:
    """Activity columns over the events table, batch or stream."""
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("msno"), F.col("value").alias("total_secs"),
        (1 + F.col("event_id") % 3).cast("int").alias("num_unq"),
        *[(F.col("event_type") == v).cast("int").alias(c) for c, v in PLAYS.items()],
    )


def _stream(t: Tables) -> DataFrame:
    return activity(jobs.read_table_events(t.spark, f"{t.sf_dir}/events.parquet", t.raw("events").schema))


@query("log_daily_stream", oracle(f"SELECT {replaced(DAILY_DOUBLES)} FROM log_daily", "log_daily"))
def log_daily_stream(t: Tables) -> DataFrame:
    root = stage_path(t.spark, "stream")
    jobs.run_daily(jobs.distinct_events(_stream(t)), f"{root}/daily", f"{root}/state", delay=None).awaitTermination()
    return t.spark.read.parquet(f"{root}/daily")


@query("log_daily_closed", oracle(
    f"""SELECT {replaced(DAILY_DOUBLES)} FROM log_daily WHERE strptime(CAST(date AS VARCHAR), '%Y%m%d') + INTERVAL 1 DAY <=
    (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 2 DAY""", "log_daily"))
def log_daily_closed(t: Tables) -> DataFrame:
    root = stage_path(t.spark, "stream")
    jobs.run_closed_days(_stream(t), f"{root}/closed", f"{root}/state").awaitTermination()
    return t.spark.read.parquet(f"{root}/closed")


@query("log_features_stream", oracle(f"SELECT {replaced(LOG_DOUBLES)} FROM log_features", "log_features"))
def log_features_stream(t: Tables) -> DataFrame:
    """The features of the users touched by each micro-batch, refreshed from the live daily table."""
    root = stage_path(t.spark, "stream")

    def refresh(batch: DataFrame) -> None:
        jobs.upsert_users(jobs.refresh_features(t.spark.read.parquet(f"{root}/daily"), batch), f"{root}/features")

    jobs.run_daily(_stream(t), f"{root}/daily", f"{root}/state", then=refresh).awaitTermination()
    return jobs.read_users(t.spark, f"{root}/features")


# Events of a file of a third, about: a third is read by as many tasks as it has files.
CUT_FILE_ROWS = 250_000


def _in_cuts(t: Tables, folder: str, order: tuple[int, ...]) -> tuple[StructType, int]:
    """Writes the thirds of the events, by time, to the folder in this order; returns the schema and the number of files that
    each third has: read so many at a time, a micro-batch is a third. A third of few events is filled up with empty files."""
    rows = activity(t.raw("events"))
    micros = F.unix_micros("ts")
    first, last, n = rows.agg(F.min(micros), F.max(micros), F.count(F.lit(1))).first()
    third = F.nullif((F.lit(last).cast("bigint") - F.lit(first).cast("bigint")) / 3, F.lit(0.0))
    cut = F.least(F.lit(2), F.floor((micros - F.lit(first).cast("bigint")) / third)).cast("int")
    files = max(1, -(-n // (3 * CUT_FILE_ROWS)))
    for i, k in enumerate(order, 1):
        rows.where(cut == k).repartition(files, "event_id").coalesce(files).write.mode("append").parquet(folder)
        for _ in range(i * files - len(t.spark.read.schema(rows.schema).parquet(folder).inputFiles())):
            rows.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return rows.schema, files


@query("log_features_state", oracle(f"SELECT {replaced(LOG_DOUBLES)} FROM log_features", "log_features"))
def log_features_state(t: Tables) -> DataFrame:
    """Features as running state over three micro-batches, cut in time order, and a replay of the last one."""
    root = stage_path(t.spark, "stream")
    schema, files = _in_cuts(t, f"{root}/in", (0, 1, 2, 2))
    events = jobs.distinct_events(jobs.read_events(t.spark, f"{root}/in", schema, max_files=files))
    jobs.run_features(events, f"{root}/features", f"{root}/state", delay=None, part_rows=500).awaitTermination()
    return jobs.features_of_state(jobs.read_state(t.spark, f"{root}/features/users"))


@query("session_features", oracle(
    f"""SELECT msno, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 1800000000 AS end_us, count(*) AS n_events, {r6('sum(value)', 'total_secs')} FROM (
    SELECT user_id AS msno, ts, value, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events))
    GROUP BY msno, s"""))
def session_features(t: Tables) -> DataFrame:
    out = features.sessions(activity(t.raw("events")))
    return out.select("msno", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"),
                      "n_events", "total_secs")


@query("session_features_stream", oracle(
    f"""SELECT * FROM (SELECT msno, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 1800000000 AS end_us, count(*) AS n_events, {r6('sum(value)', 'total_secs')} FROM (
    SELECT user_id AS msno, ts, value, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events))
    GROUP BY msno, s) WHERE end_us <= (SELECT (epoch_us(date_trunc('millisecond', max(ts))) - 172800000000 - 1800000000) // 86400000000 * 86400000000 FROM events)"""))
def session_features_stream(t: Tables) -> DataFrame:
    """Final sessions after three micro-batches: runs by user and day in the state, joined across days."""
    root = stage_path(t.spark, "stream")
    schema, files = _in_cuts(t, f"{root}/in", (0, 1, 2))
    run = jobs.run_sessions(jobs.read_events(t.spark, f"{root}/in", schema, max_files=files), f"{root}/runs", f"{root}/state")
    run.awaitTermination()
    out = jobs.joined_sessions(t.spark.read.parquet(f"{root}/runs"), jobs.watermark_of(run))
    return out.select("msno", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"),
                      "n_events", "total_secs")


def _score_stream(t: Tables) -> str:
    """Fit on the earlier batch rows, score the stream with the model; the folder with scores and drift logs."""
    root = stage_path(t.spark, "stream")
    known = t.scored.where(f"cycle < {DAY}").select("segment", F.col("y_true").alias(C.LABEL))
    model = models.fit(known, _saturated(), GROUP)
    rows = jobs.read_table_events(t.spark, f"{t.sf_dir}/events.parquet", t.raw("events").schema)
    events = rows.select(F.col("event_id").alias("id"), F.col("event_type").alias("segment"))

    def predict(df: DataFrame) -> DataFrame:
        return models.score(model, df, ["id"], GROUP).withColumn("y_proba", F.round("y_proba", 4))

    jobs.run_scoring(events, predict, f"{root}/scored", f"{root}/psi", f"{root}/state").awaitTermination()
    return root


@query("score_stream", oracle(
    f"""SELECT id, CAST(round(p, 4) AS DOUBLE) AS y_proba, {action_sql('round(p, 4)')} AS action FROM scored JOIN {_share_sql(f'cycle < {DAY}')} USING (segment)""", "scored"))
def score_stream(t: Tables) -> DataFrame:
    return t.spark.read.parquet(f"{_score_stream(t)}/scored").drop("batch")


_TIER_SHARES = (("contact_now", 1478), ("nudge", 8522), ("monitor", 183205))


@query("score_stream_psi", oracle(
    "SELECT n, " + ", ".join(f"n_{a}" for a, _ in _TIER_SHARES) + f""", {r6('CASE WHEN n >= 1000 THEN psi END', 'psi')}, CASE WHEN n < 1000 THEN NULL WHEN psi < 0.1 THEN 'stable'
    WHEN psi < 0.25 THEN 'moderate_shift' ELSE 'significant_shift' END AS status FROM (SELECT *, """
    + " + ".join(f"(greatest(n_{a} / CAST(n AS DOUBLE), 1e-6) - {c / 193205!r}) * ln(greatest(n_{a} / CAST(n AS DOUBLE), 1e-6) / {c / 193205!r})" for a, c in _TIER_SHARES)
    + " AS psi FROM (SELECT count(*) AS n, " + ", ".join(f"count(*) FILTER (action = '{a}') AS n_{a}" for a, _ in _TIER_SHARES)
    + f" FROM (SELECT {action_sql('round(p, 4)')} AS action FROM scored JOIN {_share_sql(f'cycle < {DAY}')} USING (segment))))", "scored"))
def score_stream_psi(t: Tables) -> DataFrame:
    """The drift log of the micro-batches (one, as the table is read at once)."""
    return t.spark.read.parquet(f"{_score_stream(t)}/psi").drop("batch")


def _psi_sql(min_rows: int) -> str:
    terms = " + ".join(f"(greatest(n_{a} / CAST(n AS DOUBLE), 1e-6) - {c / 193205!r}) * ln(greatest(n_{a} / CAST(n AS DOUBLE), 1e-6) / {c / 193205!r})"
                       for a, c in _TIER_SHARES)
    return f"CASE WHEN n >= {min_rows} THEN {terms} END"


@query("tier_windows_stream", oracle(
    f"""SELECT epoch_us(day) AS start_us, n, {", ".join(f"n_{a}" for a, _ in _TIER_SHARES)}, {r6('psi', 'psi')},
    CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift' WHEN psi IS NOT NULL THEN 'significant_shift' END AS status
    FROM (SELECT *, {_psi_sql(100)} AS psi FROM (SELECT day, count(*) AS n, {", ".join(f"count(*) FILTER (action = '{a}') AS n_{a}" for a, _ in _TIER_SHARES)}
      FROM (SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS day, {action_sql('p')} AS action
        FROM (SELECT ts, CASE WHEN value >= 200 THEN 1.0 ELSE floor(value * 5) / 1000 END AS p FROM events)) GROUP BY day))
    WHERE day + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 2 DAY"""))
def tier_windows_stream(t: Tables) -> DataFrame:
    """Drift of the closed days after three micro-batches that cut through days."""
    root = stage_path(t.spark, "stream")
    schema, files = _in_cuts(t, f"{root}/in", (0, 1, 2))
    events = jobs.read_events(t.spark, f"{root}/in", schema, max_files=files)
    secs = F.col("total_secs")
    scored = events.select("ts", F.when(secs >= 200, 1.0).otherwise(F.floor(secs * 5) / 1000).alias("y_proba"))
    jobs.run_tier_windows(scored, f"{root}/windows", f"{root}/state", min_rows=100).awaitTermination()
    out = t.spark.read.parquet(f"{root}/windows")
    return out.select(F.unix_micros("window_start").alias("start_us"), *[c for c in out.columns if not c.startswith("window_")])
