"""Tables stored by key: bucketed and sorted files, on which joins and groupings by the key move no rows.

The number of buckets is a power of two that follows the bytes of the table, so tables of one set that grow apart still
line up (Spark reads the finer one in coarser buckets with ``spark.sql.bucketing.coalesceBucketsInJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.sources.staging import stage

BUCKET_BYTES = 256 << 20
# Buckets for each core at most, as long as they stay below BUCKET_BYTES: more would be tasks and files that cost more than their rows.
CORE_BUCKETS = 8


def stored_bytes(written: DataFrame) -> int:
    """Bytes of a written table, as the file listing gives them."""
    return int(str(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The smallest power of two of buckets that hold at most ``bucket_bytes`` each, on average."""
    return 1 << (max(1, -(-size // bucket_bytes)) - 1).bit_length()


def buckets_on(spark: SparkSession, size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """``buckets_for``, but not above ``CORE_BUCKETS`` for each core while a bucket then holds at most ``BUCKET_BYTES``: smaller
    buckets grow with the table before their number does."""
    enough = 1 << (CORE_BUCKETS * spark.sparkContext.defaultParallelism - 1).bit_length()
    return min(buckets_for(size, bucket_bytes), max(enough, buckets_for(size)))


def buckets_of(spark: SparkSession, table: str) -> int:
    """Buckets of a stored table; an error when it is not stored by key."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    if found is None:
        raise ValueError(f"{table} is not stored by key")
    return int(found["data_type"])


def _store(written: DataFrame, table: str, key: str, buckets: int, path: str | None) -> DataFrame:
    # One shuffle on the buckets' own hash: a task holds one bucket and writes one file.
    writer = written.repartition(buckets, F.col(key)).write.mode("overwrite").option("compression", "zstd")
    writer = writer.bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return written.sparkSession.table(table)


def store_by_key(df: DataFrame, table: str, key: str = C.KEY, path: str | None = None, bucket_bytes: int = BUCKET_BYTES,
                 like: str | None = None) -> DataFrame:
    """Stores ``df`` as the table ``table``, replacing what it held. ``like`` names a stored table whose buckets are taken over.

    A NULL key is a key like others. All rows of a key lie in one file, so this is for tables with few rows per key, such as
    features, not for raw activity.
    """
    written = stage(df, "unbucketed")
    buckets = buckets_of(df.sparkSession, like) if like else buckets_on(df.sparkSession, stored_bytes(written), bucket_bytes)
    return _store(written, table, key, buckets, path)


def store_together(tables: dict[str, DataFrame], key: str = C.KEY, paths: dict[str, str] | None = None,
                   bucket_bytes: int = BUCKET_BYTES) -> int:
    """Stores several tables in equally many buckets, as many as the largest needs; returns their number."""
    written = {name: stage(df, "unbucketed") for name, df in tables.items()}
    spark = next(iter(written.values())).sparkSession
    buckets = buckets_on(spark, max(map(stored_bytes, written.values())), bucket_bytes)
    for name, df in written.items():
        _store(df, name, key, buckets, (paths or {}).get(name))
    return buckets
