"""Per-user billing and engagement features.

Every aggregate here combines on the map side, so a user who owns a large share of the rows sends one partial row per
task (and per day) into the shuffle. All take ``as_of``: rows on or after that day are filtered before grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.functions.dates import ymd_to_date, ymd_to_days
from churnspark.sources.io import require_columns


def before(df: DataFrame, date: str, as_of: int | None) -> DataFrame:
    return df if as_of is None else df.where(F.col(date) < as_of)


def txn_features(transactions: DataFrame, as_of: int | None = None, real_days: bool = False,
                 one_shuffle: bool = False) -> DataFrame:
    """16 billing features per user. A column the table lacks yields typed NULLs; only the key is required.

    ``txn_tenure_days_approx`` is the difference of the YYYYMMDD integers; ``real_days`` adds the calendar days.
    The count of distinct payment methods costs a second shuffle, of partial rows per (user, method). With
    ``one_shuffle`` each user's methods are collected as a set in the one aggregation, whatever the codes: better where
    users have few methods.
    """
    require_columns(transactions, [C.KEY], "transactions")
    have = set(transactions.columns)
    rows = before(transactions, "transaction_date", as_of) if "transaction_date" in have else transactions

    def given(column: str, expr: Column, kind: str, name: str) -> Column:
        return (expr if column in have else F.lit(None)).cast(kind).alias(name)

    aggregates = [F.count(F.lit(1)).alias("txn_cnt")]
    for flag, name in (("is_cancel", "cancel"), ("is_auto_renew", "auto_renew")):
        aggregates += [
            given(flag, F.sum(F.col(flag).cast("bigint")), "bigint", f"{name}_cnt"),
            given(flag, F.avg(F.col(flag).cast("double")), "double", f"{name}_rate"),
        ]
    for price, name in (("plan_list_price", "plan_list_price"), ("actual_amount_paid", "actual_paid")):
        amount = F.col(price).cast("double")
        for how, fn in (("mean", F.avg), ("max", F.max), ("min", F.min)):
            aggregates.append(given(price, fn(amount), "double", f"{name}_{how}"))
    methods = F.col("payment_method_id")
    n_methods = F.size(F.collect_set(methods)) if one_shuffle else F.count_distinct(methods)
    first, last = F.min("transaction_date"), F.max("transaction_date")
    aggregates += [
        given("payment_method_id", n_methods, "bigint", "payment_method_nunique"),
        given("transaction_date", first, "bigint", "txn_first_date"),
        given("transaction_date", last, "bigint", "txn_last_date"),
        given("transaction_date", last - first, "bigint", "txn_tenure_days_approx"),
        given("membership_expire_date", F.max("membership_expire_date"), "bigint", "membership_expire_date_max"),
    ]
    out = rows.groupBy(C.KEY).agg(*aggregates)
    if real_days:
        out = out.withColumn(
            "txn_tenure_days", F.datediff(ymd_to_date(F.col("txn_last_date")), ymd_to_date(F.col("txn_first_date")))
        )
    return out


def log_daily(logs: DataFrame, as_of: int | None = None, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Activity per user and day: the row count and the sums of the seven metrics."""
    require_columns(logs, [C.KEY, "date", *C.LOG_METRICS], "user_logs")
    return before(logs, "date", as_of).groupBy(C.KEY, "date", *extra_keys).agg(
        F.count(F.lit(1)).alias("row_cnt_d"),
        *[F.sum(F.col(m).cast("double")).alias(f"{m}_sum_d") for m in C.LOG_METRICS],
    )


def log_features(daily: DataFrame, real_days: bool = False) -> DataFrame:
    """18 engagement features per user from the daily table (one row per user and day)."""
    sums = [
        F.sum("row_cnt_d").alias("log_row_cnt"),
        F.min("date").cast("bigint").alias("log_first_date"),
        F.max("date").cast("bigint").alias("log_last_date"),
        F.count(F.lit(1)).alias("log_active_days"),
        (F.max("date") - F.min("date")).cast("bigint").alias("log_span_days_approx"),
    ]
    for m in ("total_secs", "num_unq"):
        day = f"{m}_sum_d"
        sums += [F.sum(day).alias(f"{m}_sum"), F.avg(day).alias(f"{m}_mean_per_active_day"),
                 F.max(day).alias(f"{m}_max_per_day")]
    sums += [F.sum(f"{b}_sum_d").alias(f"{b}_sum") for b in C.PLAY_BUCKETS]
    plays = sum((F.col(f"{b}_sum") for b in C.PLAY_BUCKETS[1:]), F.col(f"{C.PLAY_BUCKETS[0]}_sum"))
    out = daily.groupBy(C.KEY).agg(*sums).withColumns({
        "listen_full_share": X.ratio(F.col("num_100_sum"), plays),
        "listens_per_unique_track": X.ratio(plays, F.col("num_unq_sum")),
    })
    if real_days:
        out = out.withColumn(
            "log_span_days", F.datediff(ymd_to_date(F.col("log_last_date")), ymd_to_date(F.col("log_first_date")))
        )
    return out


def recency_trend(daily: DataFrame, as_of: int, windows: Sequence[int] = (7, 30, 90),
                  half_life: float = 30.0) -> DataFrame:
    """Recency, windowed activity, trend and decayed activity per user, strictly before the cutoff day."""
    age = ymd_to_days(F.lit(as_of)) - ymd_to_days(F.col("date"))
    rows = daily.where(F.col("date") < as_of).withColumn("_age", age)
    secs = F.col("total_secs_sum_d")
    aggregates = [F.min("_age").alias("days_since_last")]
    for w in windows:
        recent = F.col("_age") <= w
        aggregates += [
            F.count_if(recent).alias(f"active_days_{w}d"),
            F.sum(F.when(recent, secs).otherwise(0.0)).alias(f"total_secs_{w}d"),
        ]
    aggregates.append(F.sum(secs * F.exp(-F.col("_age") * 0.6931471805599453 / half_life)).alias("total_secs_decayed"))
    out = rows.groupBy(C.KEY).agg(*aggregates)
    for short, long in zip(windows, windows[1:]):
        per_day_short = F.col(f"total_secs_{short}d") / short
        per_day_long = F.col(f"total_secs_{long}d") / long
        out = out.withColumn(f"trend_{short}_{long}", X.ratio(per_day_short, per_day_long))
    return out


def sessions(events: DataFrame, ts: str = "ts", gap_seconds: int = 1800, slice_seconds: int = 86_400) -> DataFrame:
    """Sessions per user: start, end (last event plus the gap), events, listening time.

    Built in two steps so that a user with very many events is not one task: runs of events inside each (user, slice of
    time), then joining across slices. Only the first and the last run of a slice can continue in a neighbour, so the
    second step sees at most two rows per user and slice.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = gap_seconds * 1_000_000
    rows = events.select(C.KEY, micros.alias("_t"), F.floor(micros / (slice_seconds * 1_000_000)).alias("_slice"),
                         F.col("total_secs").cast("double").alias("total_secs"))

    def numbered(df: DataFrame, keys: list[str], start: str, previous_end: str) -> DataFrame:
        """``_run``: how many breaks longer than the gap come up to this row."""
        in_order = Window.partitionBy(*keys).orderBy(start)
        new = F.coalesce(F.col(start) - F.lag(previous_end).over(in_order) > gap, F.lit(True)).cast("int")
        upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(upto)).drop("_new")

    keys = [C.KEY, "_slice"]
    runs = numbered(rows, keys, "_t", "_t").groupBy(*keys, "_run").agg(
        F.min("_t").alias("_start"), F.max("_t").alias("_end"), F.count(F.lit(1)).alias("n_events"),
        F.sum("total_secs").alias("total_secs"),
    ).withColumn("_runs", F.max("_run").over(Window.partitionBy(*keys)))
    at_edge = (F.col("_run") == 1) | (F.col("_run") == F.col("_runs"))
    joined = numbered(runs.where(at_edge).drop("_run"), [C.KEY], "_start", "_end").groupBy(C.KEY, "_run").agg(
        F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("n_events").alias("n_events"),
        F.sum("total_secs").alias("total_secs"),
    )
    columns = [C.KEY, "_start", "_end", "n_events", "total_secs"]
    return joined.select(*columns).unionByName(runs.where(~at_edge).select(*columns)).select(
        C.KEY, F.timestamp_micros("_start").alias("session_start"),
        F.timestamp_micros(F.col("_end") + gap).alias("session_end"), "n_events", "total_secs",
    )
