"""Small shared steps: reading tables, document keys, batch sizes, written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from churnspark.sources.staging import stage

# Rows handed to Python at a time. Texts may be long, so a batch is kept small; nothing depends on the number.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of a Python task: at most ``rows`` texts are in one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def parts(spark: SparkSession) -> int:
    """Number of hash ranges a step deals its codes into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, key, text): id as long (null: the largest), and a code of the text that tells rows with one id apart."""
    return docs.select(
        doc_order(id_col).alias("doc"), text_key(text_col).alias("key"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def doc_order(id_col: str = "doc_id") -> Column:
    """The id as a long; null sorts after every other id."""
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(2**63 - 1))


def text_key(text_col: str = "text") -> Column:
    return F.xxhash64(F.col(f"`{text_col}`").cast("string"))


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: survives lost executors and cuts the lineage."""
    return stage(df, name)


# Equal rows are written out in runs of this many, each run by whichever task it is dealt to.
RUN = 4096


def expanded(units: DataFrame, n: str, nth: str, by: list[str]) -> DataFrame:
    """Every unit ``n`` times, numbered by ``nth`` from 0. A unit of very many rows is written out by many tasks; ``by`` names
    columns that tell units apart."""
    runs = units.filter(F.col(n) > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(RUN).cast("long"))).alias("_begin"))
    dealt = runs.repartition(parts(units.sparkSession), *by, "_begin")
    end = F.least(F.col(n), F.col("_begin") + RUN) - 1
    return dealt.select("*", F.explode(F.sequence("_begin", end)).alias(nth)).drop("_begin")


def computed(df: DataFrame, inputs: list[Column], fn: Callable[..., list[list]], made: str,
             keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) and the ``made`` columns, computed by ``fn`` from lists of the input values.

    Runs batch by batch in Arrow; kept columns are handed through untouched. A kept column that is called like a made one
    is replaced.
    """
    made_schema = StructType.fromDDL(made)
    new = [f.name for f in made_schema]
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    n, types = len(keep), [to_arrow_type(f.dataType) for f in made_schema]
    source = df.select(*[F.col(f"`{c}`") for c in keep], *[c.alias(fresh("in")) for c in inputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(*[b.column(i).to_pylist() for i in range(n, b.num_columns)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], *[pa.array(v, t) for v, t in zip(out, types)]], names=[*keep, *new])

    return source.mapInArrow(run, StructType([*source.schema.fields[:n], *made_schema.fields]))
