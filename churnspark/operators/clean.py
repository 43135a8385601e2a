"""Cleaning and contract alignment of wide tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.functions.dates import ymd_to_date
from churnspark.sources.io import require_columns


def clean_members(members: DataFrame) -> DataFrame:
    """Member profile: impossible ages to NULL, missing gender to 'unknown', start date parsed.

    Columns that the table lacks are simply not cleaned; only the key is required.
    """
    require_columns(members, [C.KEY], "members")
    out = {}
    if "bd" in members.columns:
        out["bd"] = X.in_range_or_null(X.to_double(F.col("bd")), C.AGE_MIN, C.AGE_MAX)
    if "gender" in members.columns:
        out["gender"] = F.coalesce("gender", F.lit(C.UNKNOWN))
    if "registration_init_time" in members.columns:
        out["registration_init_time"] = X.to_double(F.col("registration_init_time")).cast("bigint")
        out["registration_init_date"] = ymd_to_date(F.col("registration_init_time"))
    return members.withColumns(out)


def zero_fill(df: DataFrame, exclude: Sequence[str] = (C.KEY, C.LABEL, "bd"), dates: bool = True) -> DataFrame:
    """0 for NULL and NaN in every numeric column but ``exclude``; ``dates=False`` leaves YYYYMMDD columns alone."""
    skip = set(exclude)
    if not dates:
        skip |= {c for c in df.columns if c.endswith("_date") or c in ("membership_expire_date_max",
                                                                       "registration_init_time")}
    names = X.numeric_columns(df, tuple(skip))
    return df.fillna(0, subset=names) if names else df


def align_features(df: DataFrame, features: Sequence[str] = tuple(C.FEATURES), key: Sequence[str] = (C.KEY,),
                   types: dict[str, str] | None = None) -> DataFrame:
    """Scoring contract: absent features come as NULL, other columns go, the order is fixed."""
    kinds = C.FEATURE_TYPES if types is None else types
    columns = [
        F.col(f) if f in df.columns else F.lit(None).cast(kinds.get(f, "double")).alias(f) for f in features
    ]
    return df.select(*[k for k in key if k in df.columns], *columns)


def feature_columns(df: DataFrame, exclude: Sequence[str] = (C.KEY, C.LABEL, C.TIME)) -> list[str]:
    """Model features of a table: everything but ids, label, split time and date/time columns."""
    return [
        f.name for f in df.schema
        if f.name not in exclude
        and not isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    ]


def missing_count(df: DataFrame, features: Sequence[str]) -> Column:
    kinds = dict(df.dtypes)
    total = F.lit(0)
    for f in features:
        total = total + X.is_missing(F.col(f), kinds[f]).cast("int")
    return total


def missing_guardrail(df: DataFrame, features: Sequence[str] = tuple(C.FEATURES)) -> DataFrame:
    """Adds ``n_missing`` and ``mostly_missing`` (more than half of the features)."""
    return df.withColumn("n_missing", missing_count(df, features)).withColumn(
        "mostly_missing", F.col("n_missing") > len(features) // 2
    )
