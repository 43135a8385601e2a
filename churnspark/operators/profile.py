"""Table profiles. One pass over the data each; results have one row per column, value or key class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions import columns as X
from churnspark.operators.select import exact_quantiles
from churnspark.sources.staging import stage

QUARTILES = (0.25, 0.5, 0.75)


def label_summary(df: DataFrame, label: str = "is_churn") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label).cast("bigint")).alias("positives"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value, NULL included. The table is read once; the counts are written and summed up."""
    counts = stage(df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return (
        df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("value").asc()).limit(n)
    )


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) with the columns as doubles."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.inline(pairs))


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, n_missing, n_rows, pct_missing) for every column, from one aggregation."""
    kinds = dict(df.dtypes)
    names = list(columns or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(X.is_missing(F.col(c), kinds[c])).alias(c) for c in names],
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_missing")) for c in names])
    return one.select("_rows", F.inline(pairs)).select(
        "feature", "n_missing", F.col("_rows").alias("n_rows"),
        X.ratio0(F.col("n_missing") * 100.0, F.col("_rows")).alias("pct_missing"),
    )


def missing_profile(df: DataFrame, top: int = 15) -> DataFrame:
    return missing_rates(df).orderBy(F.col("pct_missing").desc(), F.col("feature")).limit(top)


def describe_numeric(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per column; NULL and NaN are left out.

    Exact quartiles are selected by counting bins of values, without ordering them; ``exact=False`` takes approximate ones
    from the same aggregation as the other figures.
    """
    def figures(c: str):
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        found = [
            F.lit(c).alias("feature"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        ]
        return F.struct(*found, *([] if exact else [F.percentile_approx(x, list(QUARTILES)).alias("quantiles")]))

    found = df.agg(F.array(*[figures(c) for c in columns]).alias("_f")).select(F.inline("_f"))
    if exact:
        found = found.join(exact_quantiles(long_form(df, columns), "value", QUARTILES, ["feature"]), "feature", "left")
    return found.select(
        "feature", "count", "mean", "std", "min",
        F.col("quantiles")[0].alias("p25"), F.col("quantiles")[1].alias("p50"), F.col("quantiles")[2].alias("p75"),
        "max",
    )


def key_audit(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows, distinct keys, keys that repeat, and keys whose labels disagree."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min(label).alias("low"), F.max(label).alias("high")
    )
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.count(key).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
        F.count_if(F.col("low") != F.col("high")).alias("n_conflicting_keys"),
    )


def range_audit(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    x = F.col(column)
    return df.agg(
        F.count_if(x < low).alias("n_below"), F.count_if(x > high).alias("n_above"),
        F.count_if(x.isNull()).alias("n_null"), F.count(F.lit(1)).alias("n_rows"),
    )


def table_overview(df: DataFrame, key: str, date: str, values: dict[str, Sequence]) -> DataFrame:
    """Rows, distinct keys, first and last date, and the count of each listed value, over the whole table.

    Grouped by key first, so counting distinct keys is a plain count of partial rows.
    """
    counts = {f"{c}_{v}": F.count_if(F.col(c) == v) for c, vs in values.items() for v in vs}
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min(date).alias("first"), F.max(date).alias("last"),
        *[e.alias(n) for n, e in counts.items()],
    )
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.count(key).alias("n_keys"),
        F.min("first").alias("first_date"), F.max("last").alias("last_date"),
        *[F.sum(n).alias(n) for n in counts],
    )
