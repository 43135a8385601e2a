"""Keyed joins: spine, model table, subsets."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.operators.clean import clean_members, zero_fill
from churnspark.operators.rank import best_rows
from churnspark.functions.columns import hash_fraction
from churnspark.sources.io import require_columns


def duplicate_keys(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    key = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique_key(df: DataFrame, key: Sequence[str] | str, what: str = "table") -> DataFrame:
    """Raise now if a key value occurs twice (one aggregation over the key column)."""
    if duplicate_keys(df, key).limit(1).count():
        raise ValueError(f"{what} has duplicate values of {key}")
    return df


def warn_duplicate_key(df: DataFrame, key: Sequence[str] | str, what: str = "table") -> DataFrame:
    if duplicate_keys(df, key).limit(1).count():
        warnings.warn(f"{what} has duplicate values of {key}", stacklevel=2)
    return df


def one_row_per_key(df: DataFrame, key: str, what: str = "table") -> DataFrame:
    """The same rows, failing the job when a key occurs twice.

    The check runs inside the plan: the shuffle and sort by key it needs are the ones a following join on the key uses.
    """
    failure = F.raise_error(F.concat(F.lit(f"{what} has a duplicate {key}: "), F.col(key).cast("string")))
    counted = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return counted.where(F.when(F.col("_n") > 1, failure.cast("boolean")).otherwise(F.lit(True))).drop("_n")


def build_spine(labels: DataFrame, members: DataFrame, validate: bool = True) -> DataFrame:
    """One row per label row with the cleaned member profile. Members must be unique; NULL keys match nothing."""
    require_columns(labels, [C.KEY, C.LABEL], "labels")
    profile = clean_members(members.where(F.col(C.KEY).isNotNull()))
    if validate:
        profile = one_row_per_key(profile, C.KEY, "members")
    return labels.join(profile, C.KEY, "left")


def build_model_table(spine: DataFrame, txn: DataFrame, logs: DataFrame, validate: bool = False,
                      fill_dates: bool = True) -> DataFrame:
    """spine ⟕ billing features ⟕ engagement features, zero-filled.

    Feature tables made by this package have one row per key by construction; pass ``validate=True`` for others.
    """
    require_columns(spine, [C.KEY, C.LABEL], "spine")
    if validate:
        txn, logs = one_row_per_key(txn, C.KEY, "txn_features"), one_row_per_key(logs, C.KEY, "log_features")
    joined = spine.join(txn, C.KEY, "left").join(logs, C.KEY, "left")
    if "gender" in joined.columns:
        joined = joined.withColumn("gender", F.coalesce("gender", F.lit(C.UNKNOWN)))
    return zero_fill(joined, dates=fill_dates)


def distinct_keys(df: DataFrame, key: str = C.KEY) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def subset_by_keys(df: DataFrame, keys: DataFrame, key: str = C.KEY, limit: int | None = None,
                   id: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Rows whose key is in the list. With ``limit``, the rows with the smallest hashes of ``id`` (unique per row)."""
    kept = df.join(distinct_keys(keys, key), key, "left_semi")
    if limit is None:
        return kept
    unique = F.concat_ws("#", *[F.col(c).cast("string") for c in (id or df.columns)])
    scored = kept.withColumn("_id", unique).withColumn("_score", 1 - hash_fraction(F.col("_id"), seed))
    return best_rows(scored, limit, "_score", "_id").drop("_id", "_score")
