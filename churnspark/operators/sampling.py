"""Deterministic samples and splits: a row's place depends on the hash of its id, never on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_fraction
from churnspark.functions.dates import ymd_to_date
from churnspark.operators.rank import best_rows, match, quota_cutoff, within_cutoff


def sample_fraction(df: DataFrame, fraction: float, id: str, seed: int = 42) -> DataFrame:
    return df.where(hash_fraction(F.col(id), seed) < fraction)


def _hashed(df: DataFrame, id: str, seed: int) -> DataFrame:
    """``_score`` ranks the smallest hash first."""
    return df.withColumn("_score", 1 - hash_fraction(F.col(id), seed))


def sample_n(df: DataFrame, n: int, id: str, seed: int = 42) -> DataFrame:
    """Uniform sample of n rows: the n smallest id hashes."""
    return best_rows(_hashed(df, id, seed), n, "_score", id).drop("_score")


def stratified_sample(df: DataFrame, n: int, by: str, id: str, seed: int = 42) -> DataFrame:
    """About n rows with the class mix of the table, at least one per class, then trimmed to n."""
    total = df.agg(F.count(F.lit(1))).scalar()
    quota = F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("_all") / total))
    scored = _hashed(df, id, seed)
    chosen = within_cutoff(scored, quota_cutoff(scored, "_score", id, quota, [by]), "_score", id, [by])
    return sample_n(chosen.drop("_score"), n, id, seed)


def stratified_split(df: DataFrame, test_size: float, by: str, id: str, seed: int = 42) -> DataFrame:
    """Adds ``split``: 'valid' for round(test_size * class size) rows of each class, 'train' for the others.

    The boundary row of each class is found by counting, then each row is compared with it; nothing is sorted.
    """
    scored = _hashed(df, id, seed)
    quota = F.floor(F.lit(test_size) * F.col("_all") + 0.5)
    cutoffs = quota_cutoff(scored, "_score", id, quota, [by])
    joined = match(scored, cutoffs, [by], "left")
    inside = (F.col("_score") > F.col("cut_score")) | (
        (F.col("_score") == F.col("cut_score")) & (F.col(id) <= F.col("cut_id"))
    )
    return joined.withColumn("split", F.when(inside, "valid").otherwise("train")).drop(
        "_score", "cut_score", "cut_id"
    )


# ---- time splits ---------------------------------------------------------------------------------------------------


def _day_counts(df: DataFrame, time: str) -> DataFrame:
    """Rows per day: a table as long as the calendar, whatever the input size."""
    return (
        df.select(F.unix_date(ymd_to_date(F.col(time))).alias("day"))
        .where("day IS NOT NULL").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    )


def _quantile_day(days: DataFrame, q: float) -> Column:
    return F.floor(F.percentile("day", F.lit(q), F.col("n")))


def time_split(df: DataFrame, time: str, cutoff: str | None, quantile: float = 0.8, undated: str = "train") -> DataFrame:
    """Adds ``split``, ``split_method`` and ``cutoff_date``: train up to the cutoff, valid after it.

    Falls back to the quantile of the dates when no row is later than the fixed cutoff. Rows without a valid date go to
    train or are dropped. The cutoff is one small aggregate over rows per day.
    """
    if undated not in ("train", "drop"):
        raise ValueError("undated must be 'train' or 'drop'")
    days = _day_counts(df, time)
    fixed = F.unix_date(F.lit(cutoff).cast("date"))
    by_quantile = _quantile_day(days, quantile)
    usable = F.lit(False) if cutoff is None else F.max("day") > fixed
    chosen = days.agg(
        F.struct(
            F.when(usable, fixed).otherwise(by_quantile).cast("int").alias("day"),
            F.when(usable, "fixed_date").otherwise(f"quantile_{quantile}").alias("method"),
        )
    ).scalar()
    day = F.unix_date(ymd_to_date(F.col(time)))
    out = df.withColumn("_cut", chosen).withColumns({
        "split": F.when(day > F.col("_cut.day"), "valid").otherwise("train"),
        "split_method": F.col("_cut.method"),
        "cutoff_date": F.date_from_unix_date(F.col("_cut.day")),
    }).drop("_cut")
    return out if undated == "train" else out.where(day.isNotNull())


def auto_cutoff(df: DataFrame, time: str, quantile: float = 0.8, min_valid_rows: int = 1) -> DataFrame:
    """Cutoff at the quantile, clamped to [0.5, 0.95] and lowered by 0.05 until enough rows come after it.

    All candidate quantiles are evaluated together over the rows-per-day table. Falls back to the median.
    """
    start = round(min(max(quantile, 0.5), 0.95) * 100)
    tried = [q / 100 for q in range(start, 49, -5)]
    days = _day_counts(df, time)
    grid = tried + [0.5]
    cuts = days.agg(F.percentile("day", F.array(*[F.lit(q) for q in grid]), F.col("n"))).scalar()
    later = [F.sum(F.when(F.col("day") > F.col("_cuts")[i], F.col("n")).otherwise(0)) for i in range(len(grid))]
    found = days.withColumn("_cuts", cuts).agg(
        F.any_value("_cuts").alias("cuts"), F.array(*later).alias("later"), F.sum("n").alias("n_dated")
    )
    pick = F.lit(len(grid) - 1)
    for i in reversed(range(len(tried))):
        pick = F.when(F.col("later")[i] >= min_valid_rows, i).otherwise(pick)
    return found.withColumn("_i", pick).select(
        F.element_at(F.array(*[F.lit(q) for q in grid]), F.col("_i") + 1).alias("quantile"),
        F.date_from_unix_date(F.floor(F.element_at("cuts", F.col("_i") + 1)).cast("int")).alias("cutoff_date"),
        F.element_at("later", F.col("_i") + 1).alias("valid_rows"),
        "n_dated",
    )
