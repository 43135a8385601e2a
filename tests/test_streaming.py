"""Streams against the batch job: live and closed days, replays, late events, restarts, scoring, sessions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnspark.operators import features
from churnspark.streaming import jobs

SCHEMA = ("event_id bigint, ts timestamp, msno string, total_secs double, num_unq int, num_25 int, num_50 int, "
          "num_75 int, num_985 int, num_100 int")
START = dt.datetime(2024, 1, 1)


def events(spark, first, n, step_hours=3):
    rows = [(first + i, START + dt.timedelta(hours=step_hours * (first + i)), f"u{(first + i) % 3}", float(first + i), 1, 1, 0, 0, 0, 1)
            for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def drop(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def daily_of(df):
    return features.log_daily(df.withColumn("date", F.date_format("ts", "yyyyMMdd").cast("int")))


def rows(df):
    return sorted(tuple(r) for r in df.select("msno", "date", "row_cnt_d", "total_secs_sum_d", "num_100_sum_d").collect())


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "in")


def live(spark, folder, tmp_path):
    stream = jobs.distinct_events(jobs.read_events(spark, folder, SCHEMA, max_files=1))
    jobs.run_daily(stream, str(tmp_path / "daily"), str(tmp_path / "state"), delay=None).awaitTermination()
    return spark.read.parquet(str(tmp_path / "daily"))


def test_live_days_equal_the_batch_job_across_restarts_and_replays(spark, folder, tmp_path):
    a, b = events(spark, 0, 40), events(spark, 40, 40)
    drop(a, folder)
    assert rows(live(spark, folder, tmp_path)) == rows(daily_of(a))
    drop(b, folder)
    assert rows(live(spark, folder, tmp_path)) == rows(daily_of(a.unionByName(b)))
    drop(b, folder)  # the same file once more
    assert rows(live(spark, folder, tmp_path)) == rows(daily_of(a.unionByName(b)))
    # nothing new: nothing changes
    assert rows(live(spark, folder, tmp_path)) == rows(daily_of(a.unionByName(b)))


def test_closed_days_and_late_events(spark, folder, tmp_path):
    old, new = events(spark, 0, 80), events(spark, 80, 8)
    late = events(spark, 2, 1).withColumn("event_id", F.lit(9999).cast("bigint"))
    out, state = str(tmp_path / "closed"), str(tmp_path / "state")
    for part in (old, new, late):
        drop(part, folder)
        jobs.run_closed_days(jobs.read_events(spark, folder, SCHEMA), out, state).awaitTermination()
    got = spark.read.parquet(out)
    last = START + dt.timedelta(hours=3 * 87) - dt.timedelta(days=2)
    closed = daily_of(old.unionByName(new)).where(F.to_date(F.col("date").cast("string"), "yyyyMMdd") < F.lit(last.date()))
    assert rows(got) == rows(closed)
    everything = daily_of(old.unionByName(new).unionByName(late)).where(F.col("date") <= got.agg(F.max("date")).first()[0])
    assert [r.n_late for r in jobs.late_rows(everything, got).collect()] == [1]


def test_upsert_keeps_other_days_and_users(spark, tmp_path):
    path = str(tmp_path / "daily")
    first = daily_of(events(spark, 0, 24))
    jobs.upsert_days(first, path)
    change = first.where("msno = 'u1' AND date = 20240102").withColumn("total_secs_sum_d", F.lit(-1.0))
    for _ in range(2):  # replayed batch
        jobs.upsert_days(change, path)
    got = spark.read.parquet(path)
    assert got.count() == first.count()
    assert got.where("total_secs_sum_d = -1").count() == 1


def test_feature_refresh_touches_only_changed_users(spark):
    daily = daily_of(events(spark, 0, 24))
    touched = daily.where("msno = 'u2'").limit(1)
    got = jobs.refresh_features(daily, touched)
    assert [r.msno for r in got.collect()] == ["u2"]
    assert got.collect() == features.log_features(daily).where("msno = 'u2'").collect()


def test_streaming_scores_equal_batch(spark, folder, tmp_path):
    drop(events(spark, 0, 1200, 1), folder)

    def predict(df):
        return df.select("event_id", (F.col("total_secs") % 100 / 100).alias("y_proba"))

    out, psi = str(tmp_path / "scored"), str(tmp_path / "psi")
    stream = jobs.read_events(spark, folder, SCHEMA)
    jobs.run_scoring(stream, predict, out, psi, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 1200 and got.where("action = 'contact_now'").count() == 12 * 32
    assert spark.read.parquet(psi).first().status == "significant_shift"


def test_sessions(spark):
    minutes = [0, 10, 39, 70, 200]
    df = spark.createDataFrame([(i, START + dt.timedelta(minutes=m), "u", 1.0) for i, m in enumerate(minutes)],
                               "event_id int, ts timestamp, msno string, total_secs double")
    got = sorted((r.n_events, r.session_start) for r in jobs.sessions(df).collect())
    assert [n for n, _ in got] == [1, 1, 3]


def test_sessions_stream_equals_batch(spark, folder, tmp_path):
    drop(events(spark, 0, 30), folder)
    query = jobs.sessions(jobs.read_events(spark, folder, SCHEMA), gap="4 hours", delay="0 seconds").writeStream.outputMode(
        "append").format("parquet").option("path", str(tmp_path / "s")).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start()
    query.awaitTermination()
    want = jobs.sessions(events(spark, 0, 30), gap="4 hours").where(F.col("session_end") <= events(spark, 0, 30).agg(F.max("ts")).first()[0])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "s")).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("slice_seconds", [600, 3600, 86_400])
def test_sliced_sessions_equal_session_windows(spark, slice_seconds):
    df = spark.range(3000).select(
        F.concat(F.lit("u"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5)).alias("msno"),
        F.timestamp_seconds(1_704_067_200 + F.pmod(F.xxhash64("id"), F.lit(400_000))).alias("ts"), F.lit(1.0).alias("total_secs"))
    want = sorted(map(tuple, jobs.sessions(df, gap="10 minutes").collect()))
    got = sorted(map(tuple, features.sessions(df, gap_seconds=600, slice_seconds=slice_seconds).collect()))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]


def test_refreshed_features_have_one_row_per_user(spark, folder, tmp_path):
    """A folder table, several micro-batches and a replay: the stream's features are the batch job's."""
    parts = [events(spark, 0, 40), events(spark, 40, 40), events(spark, 80, 40), events(spark, 40, 40)]
    for part in parts:
        drop(part, folder)
    daily, out, batches = str(tmp_path / "daily"), str(tmp_path / "features"), []

    def refresh(batch):
        batches.append(batch.count())
        jobs.upsert_users(jobs.refresh_features(spark.read.parquet(daily), batch), out)

    stream = jobs.distinct_events(jobs.read_table_events(spark, folder, SCHEMA, max_files=1))
    jobs.run_daily(stream, daily, str(tmp_path / "state"), delay=None, then=refresh).awaitTermination()
    assert len(batches) >= 3
    got = jobs.read_users(spark, out)
    want = features.log_features(daily_of(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_table_streams_as_file_and_as_folder(spark, tmp_path):
    import shutil

    drop(events(spark, 0, 30), str(tmp_path / "folder"))
    part = next((tmp_path / "folder").glob("part-*.parquet"))
    (tmp_path / "single").mkdir()
    shutil.copy(part, tmp_path / "single" / "events.parquet")
    for path in (tmp_path / "folder", tmp_path / "single" / "events.parquet"):
        stream = jobs.read_table_events(spark, str(path), SCHEMA)
        name = f"t_{abs(hash(str(path)))}"
        stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        assert spark.table(name).count() == 30


def kept(spark, path):
    out = jobs.features_of_state(jobs.read_state(spark, f"{path}/users"))
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in out.collect())


def wanted(df):
    out = features.log_features(daily_of(df))
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in out.collect())


def test_state_equals_the_batch_job_over_batches_and_replays(spark, folder, tmp_path):
    """Batches share days; values below zero make days shrink; the table outgrows its parts."""
    more = events(spark, 30, 30).withColumn("msno", F.concat(F.lit("v"), F.col("event_id") % 7))
    less = events(spark, 60, 20).withColumn("total_secs", -F.col("total_secs"))
    seen, path = None, str(tmp_path / "features")
    for df in (events(spark, 0, 30), more, events(spark, 52, 8), less, less):
        drop(df, folder)
        seen = df if seen is None else seen.unionByName(df)
        stream = jobs.distinct_events(jobs.read_events(spark, folder, SCHEMA, max_files=1))
        jobs.run_features(stream, path, str(tmp_path / "state"), delay=None, part_rows=2).awaitTermination()
        assert kept(spark, path) == wanted(seen.dropDuplicates(["event_id"]))
    assert jobs._parts_of(spark, f"{path}/users") >= 4


def test_a_batch_repeated_after_a_failure_changes_nothing(spark, tmp_path):
    path, daily = str(tmp_path / "users"), str(tmp_path / "daily")
    days = daily_of(events(spark, 0, 30))
    days.write.partitionBy("date").parquet(daily)
    changes = jobs.day_changes(days, None)
    for _ in range(2):
        jobs.merge_state(changes, path, 0, daily)
        assert sorted(map(str, jobs.features_of_state(jobs.read_state(spark, path)).collect())) == sorted(map(str, features.log_features(days).collect()))


def test_only_parts_of_touched_users_are_read(spark, tmp_path):
    path, daily = str(tmp_path / "users"), str(tmp_path / "daily")
    days = daily_of(events(spark, 0, 60).withColumn("msno", F.concat(F.lit("u"), F.col("event_id"))))
    days.write.partitionBy("date").parquet(daily)
    jobs.merge_state(jobs.day_changes(days, None), path, 0, daily, part_rows=4)
    parts = jobs._parts_of(spark, path)
    one = spark.createDataFrame([("u7",)], "msno string")
    some = jobs.read_state(spark, path, one)
    assert parts == 15 and "PartitionFilters: [isnotnull(user_part" in some._jdf.queryExecution().toString()
    own = one.select(jobs.user_part(parts)).first()[0]
    assert {r[0] for r in some.select("user_part").collect()} == {own}


def test_rows_behind_the_watermark_are_counted(spark, folder, tmp_path):
    out, state = str(tmp_path / "closed"), str(tmp_path / "state")
    on_time = events(spark, 0, 88)  # eleven days, three users
    late = events(spark, 0, 24).where("event_id IN (2, 11, 21, 22)").withColumn("event_id", F.col("event_id") + 9000)
    counted = None
    for part in (on_time, late, events(spark, 88, 8)):
        drop(part, folder)
        run = jobs.run_closed_days(jobs.read_events(spark, folder, SCHEMA), out, state)
        run.awaitTermination()
        log = jobs.progress_of(run)
        counted = log if counted is None else counted.unionByName(log)
    got = spark.read.parquet(out)
    closed = F.col("date") <= got.agg(F.max("date")).first()[0]
    batch = daily_of(on_time.unionByName(late).unionByName(events(spark, 88, 8))).where(closed)
    missing = jobs.late_rows(batch, got)
    total = counted.agg(F.sum("dropped_rows").alias("dropped"), F.sum("read_rows").alias("read")).first()
    assert missing.where("n_late > 1").count() == 0  # each late event is the only one of its user and day
    assert total.dropped == missing.agg(F.sum("n_late")).first()[0] == late.count()
    assert total.read == 88 + late.count() + 8


def test_streamed_sessions_join_across_slices(spark, folder, tmp_path):
    busy = [(i, START + dt.timedelta(minutes=20 * i), "busy", 1.0) for i in range(300)]  # four days without a break
    calm = [(1000 + i, START + dt.timedelta(hours=5 * i, minutes=i % 7 * 9), "calm", 2.0) for i in range(40)]
    night = [(2000 + i, START + dt.timedelta(days=1 + i // 2, minutes=-10 + 25 * (i % 2)), "night", 3.0) for i in range(8)]
    push = [(3000, START + dt.timedelta(days=9), "push", 4.0)]
    everything = sorted(busy + calm + night, key=lambda r: r[1]) + push
    df = spark.createDataFrame([(*r, 1, 1, 0, 0, 0, 1) for r in everything], SCHEMA)
    out, state, got, ends = str(tmp_path / "runs"), str(tmp_path / "state"), [], []
    for cut in range(4):
        part = sorted(r[0] for r in everything[cut * 90:(cut + 1) * 90])
        drop(df.where(F.col("event_id").isin(part)), folder)
        run = jobs.run_sessions(jobs.read_events(spark, folder, SCHEMA, max_files=1), out, state)
        run.awaitTermination()
        runs = spark.read.schema("msno string, slice bigint, session_start timestamp, session_end timestamp, n_events bigint, total_secs double").parquet(out)
        got.append(sorted(map(tuple, jobs.joined_sessions(runs, jobs.watermark_of(run)).collect())))
        ends.append(runs.where("msno = 'busy'").count())
    want = features.sessions(df)
    batch = sorted(map(tuple, want.select("msno", "session_start", "session_end", "n_events", "total_secs").where("msno != 'push'").collect()))
    assert got[-1] == [r for r in batch if r[2] <= START + dt.timedelta(days=6)]
    assert {"busy", "night"} <= {r[0] for r in got[-1]} and ends[-1] == 5  # one run a day, one session
    for earlier, later in zip(got, got[1:]):
        assert set(earlier) <= set(later)  # what was final stays as it is


def test_tier_windows_do_not_depend_on_the_cuts(spark, tmp_path):
    rows = events(spark, 0, 80).select("ts", F.when(F.col("event_id") % 11 > 0, F.col("event_id") % 10 / 10).alias("y_proba"))
    whole = {r.window_start: tuple(r) for r in jobs.tier_windows(rows, min_rows=4).collect()}
    last = START + dt.timedelta(hours=3 * 79) - dt.timedelta(days=2)
    wanted = sorted(v for v in whole.values() if v[1] <= last)
    assert wanted and len(wanted) < len(whole)
    for name, cuts in (("two", (0, 37, 80)), ("five", (0, 3, 20, 21, 66, 80))):
        folder = str(tmp_path / name)
        for a, b in zip(cuts, cuts[1:]):
            drop(rows.where(F.col("ts").between(START + dt.timedelta(hours=3 * a), START + dt.timedelta(hours=3 * b - 1))), folder)
        stream = jobs.read_events(spark, folder, rows.schema, max_files=1)
        jobs.run_tier_windows(stream, str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-state"), min_rows=4).awaitTermination()
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / f"{name}-out")).collect())) == wanted
    assert all(r[2] == 8 for r in wanted)


@pytest.mark.parametrize("n, files", [(40, 1), (400, 14)])
def test_a_third_of_the_events_is_one_micro_batch_of_many_files(spark, tmp_path, monkeypatch, n, files):
    from churnspark.plans import queries_stream
    from churnspark.plans.adapters import Tables

    monkeypatch.setattr(queries_stream, "CUT_FILE_ROWS", 10 if files > 1 else 250_000)
    days = F.when(F.col("id") == 0, 0).when(F.col("id") < n // 4, 15).otherwise(29)  # one event in the first third
    spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds(1_704_067_200 + days * 86_400 + F.col("id")).alias("ts"),
                          (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
                          F.lit(1.0).alias("value")).write.parquet(str(tmp_path / "events.parquet"))
    t, folder = Tables(spark, str(tmp_path)), str(tmp_path / "in")
    schema, each = queries_stream._in_cuts(t, folder, (0, 1, 2))
    assert each == files and len(list((tmp_path / "in").glob("part-*.parquet"))) == 3 * files
    sizes = []
    jobs.read_events(spark, folder, schema, max_files=each).writeStream.foreachBatch(lambda b, _: sizes.append(b.count())).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sizes == [1, n // 4 - 1, n - n // 4]
    got = queries_stream.session_features_stream(t).collect()
    assert sum(r.n_events for r in got) == n // 4  # all but those after the watermark


def test_sessions_keep_one_version_of_their_state_and_write_few_files(spark, folder, tmp_path):
    users = spark.range(3000).select(F.col("id").alias("event_id"), F.timestamp_seconds(1_704_067_200 + F.col("id")).alias("ts"),
                                     F.col("id").cast("string").alias("msno"), F.lit(1.0).alias("total_secs"))
    push = users.limit(1).withColumn("ts", F.timestamp_seconds(F.lit(1_705_067_200)))
    drop(users, folder)
    drop(push, folder)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        run = jobs.run_sessions(jobs.read_events(spark, folder, users.schema, max_files=1), str(tmp_path / "runs"), str(tmp_path / "state"))
        run.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 3000
    assert 1 < len(list((tmp_path / "runs").glob("slice=*/*.parquet"))) <= jobs.SLICE_FILES
    first, last = (p["stateOperators"][0] for p in (run.recentProgress[0], run.lastProgress))
    assert first["numRowsTotal"] == 3000 and last["numRowsTotal"] <= 1 and last["memoryUsedBytes"] < first["memoryUsedBytes"] / 2
    assert spark.conf.get(jobs.KEPT_VERSIONS, None) is None
