"""Distinct counts: exact ones over rolling windows, and ones that merge, with a sketch per key (and day) instead of the values.

A sketch keeps up to 2^lg hashes of 64 bits. While a key has no more distinct values the count is exact; beyond that it is an
estimate with a relative standard error of about 2^(-lg / 2). Sketches of parts merge to the sketch of the whole, in any order
and however often a part is repeated, so late or replayed rows change nothing, and windows of days need the raw rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.dates import ymd_to_days

LG = 12


def sketches(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], lg: int = LG) -> DataFrame:
    """``<column>_sketch`` of every key, at most 8 * 2^lg bytes. Map-side sums: a hot key sends one sketch per task. NULL is no value."""
    return rows.groupBy(*keys).agg(*[F.theta_sketch_agg(c, lg).alias(f"{c}_sketch") for c in columns])


def merged(sketched: DataFrame, keys: Sequence[str], columns: Sequence[str], lg: int = LG) -> DataFrame:
    """The sketches of coarser keys."""
    return sketched.groupBy(*keys).agg(*[F.theta_union_agg(f"{c}_sketch", lg).alias(f"{c}_sketch") for c in columns])


def counted(sketched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_nunique`` in place of the sketches."""
    def count(c: str) -> Column:
        return F.coalesce(F.theta_sketch_estimate(f"{c}_sketch"), F.lit(0)).cast("bigint")

    return sketched.withColumns({f"{c}_nunique": count(c) for c in columns}).drop(*[f"{c}_sketch" for c in columns])


def rolling_distinct(daily: DataFrame, columns: Sequence[str], days: int = 7, date: str = "date", lg: int = LG) -> DataFrame:
    """(date, <column>_nunique over the ``days`` days that end with it), for every date (YYYYMMDD) that has a row.

    ``daily`` has sketches per date, or finer. They are merged by date first; then each date's sketch goes to the windows
    it lies in, ``days`` small rows per date.
    """
    per_day = merged(daily, [date], columns, lg).withColumn("_day", ymd_to_days(F.col(date)))
    spread = per_day.withColumn("_at", F.explode(F.sequence(F.col("_day"), F.col("_day") + days - 1)))
    own = F.max(F.when(F.col("_at") == F.col("_day"), F.col(date))).alias(date)
    joined = spread.groupBy("_at").agg(own, *[F.theta_union_agg(f"{c}_sketch", lg).alias(f"{c}_sketch") for c in columns])
    return counted(joined.where(F.col(date).isNotNull()).drop("_at"), columns)


def rolling_exact(rows: DataFrame, key: str, days: int = 7, date: str = "date") -> DataFrame:
    """(date, <key>_nunique over the ``days`` days that end with it), exact, for every date (YYYYMMDD) that has a row.

    An active day of a key counts in the windows that end from it on to the day before the key's next active day, ``days`` at
    most, so a key is in each window once and the windows are plain sums: a row per task and day is shuffled for them. A NULL
    key is no value; a NULL date lies in no window and counts 0.
    """
    active = rows.select(key, date).distinct().withColumn("_day", ymd_to_days(F.col(date)))
    following = F.lead("_day").over(Window.partitionBy(key).orderBy(F.col("_day").asc_nulls_first()))
    last = F.least(F.col("_day") + days, following) - 1  # least() skips the NULL of a key's last day
    spread = active.withColumn("_last", last).withColumn("_at", F.explode_outer(F.sequence(F.col("_day"), F.col("_last"))))
    own = F.max(F.when(F.col("_at") == F.col("_day"), F.col(date))).alias(date)
    counts = spread.groupBy("_at").agg(own, F.count(F.when(F.col("_at").isNotNull(), F.col(key))).alias(f"{key}_nunique"))
    return counts.where(F.col(date).isNotNull() | F.col("_at").isNull()).drop("_at")
