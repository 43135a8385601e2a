"""Raw tables to model table in one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnspark import contract as C
from churnspark.operators.features import log_daily, log_features, txn_features
from churnspark.operators.table import build_model_table, build_spine
from churnspark.sources.io import csv_to_parquet, read_table, write_parquet
from churnspark.sources.layout import BUCKET_BYTES, store_together

STORED = ("train", "members", "txn_features", "log_features")


def model_table(train: DataFrame, members: DataFrame, transactions: DataFrame, user_logs: DataFrame,
                as_of: int | None = None, validate: bool = True) -> DataFrame:
    """Spine ⟕ billing ⟕ engagement features. ``as_of`` (YYYYMMDD) keeps later activity out of the features."""
    spine = build_spine(train, members, validate)
    return build_model_table(
        spine, txn_features(transactions, as_of), log_features(log_daily(user_logs, as_of))
    )


def store_features(prefix: str, train: DataFrame, members: DataFrame, transactions: DataFrame, user_logs: DataFrame,
                   as_of: int | None = None, root: str | None = None, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Labels, members and both feature tables stored by user as ``<prefix>_<name>`` (under ``root``, else in the warehouse).

    One of them is refreshed by ``layout.store_by_key(rows, "<prefix>_<name>", like="<prefix>_train")``.
    """
    made = dict(zip(STORED, (train, members, txn_features(transactions, as_of), log_features(log_daily(user_logs, as_of)))))
    paths = {f"{prefix}_{name}": f"{root}/{name}" for name in STORED} if root else None
    return store_together({f"{prefix}_{name}": df for name, df in made.items()}, paths=paths, bucket_bytes=bucket_bytes)


def stored_model_table(spark: SparkSession, prefix: str, validate: bool = True) -> DataFrame:
    """The model table from stored tables; on their layout no join and no check moves a row."""
    train, members, txn, logs = (spark.table(f"{prefix}_{name}") for name in STORED)
    return build_model_table(build_spine(train, members, validate), txn, logs)


def convert_raw(spark: SparkSession, csv_root: str, parquet_root: str) -> None:
    """All raw CSV files to Parquet."""
    for name, schema in C.RAW_SCHEMAS.items():
        csv_to_parquet(spark, f"{csv_root}/{name}.csv", f"{parquet_root}/{name}.parquet", schema)


def run(spark: SparkSession, root: str, out: str, as_of: int | None = None) -> None:
    """Feature build from ``root`` (Parquet preferred, else CSV) to the table ``out``."""
    raw = {name: read_table(spark, name, root, schema) for name, schema in C.RAW_SCHEMAS.items()}
    write_parquet(model_table(raw["train"], raw["members"], raw["transactions"], raw["user_logs"], as_of), out)
