"""Scans and sinks: CSV, Parquet, JSON record batches, run logs, probability files, policy documents."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Header CSV with ``""`` escapes; broken rows are left out, the same ones whatever columns are read later
    (``csv_quality`` counts them). Without a schema Spark infers the types, and no row is broken."""
    if schema is None:
        return _csv_reader(spark).option("inferSchema", True).csv(path)
    rows, names = _checked_csv(spark, path, schema)
    return rows.where(~F.col(_BROKEN)).select(*names)


_BROKEN = "_broken_line"


def _csv_reader(spark: SparkSession):
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")


def _checked_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, list[str]]:
    """Typed columns and whether the line is broken: another number of columns, or a value that its type cannot hold.

    Values are read as text and cast here, so the verdict needs every column and cannot depend on a projection.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted] + [T.StructField(_BROKEN, T.StringType())])
    raw = _csv_reader(spark).option("columnNameOfCorruptRecord", _BROKEN).option("columnPruning", False).schema(text).csv(path)
    broken = F.col(_BROKEN).isNotNull()
    for f in wanted:
        broken = broken | (F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted]
    return raw.select(*typed, broken.alias(_BROKEN)), [f"`{f.name}`" for f in wanted]


def csv_quality(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One row: lines and broken lines of a CSV source."""
    rows, _ = _checked_csv(spark, path, schema)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(_BROKEN).alias("n_broken"))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """One output per stage, overwritten, zstd."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path, partitionBy=list(partition_by) or None)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header and ``""`` escapes, one part per task."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def csv_to_parquet(spark: SparkSession, csv: str, parquet: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Convert a CSV folder or file to Parquet; splits are streamed through the tasks."""
    write_parquet(read_csv(spark, csv, schema), parquet)
    return spark.read.parquet(parquet)


def read_table(
    spark: SparkSession, name: str, root: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """``root/name.parquet`` (a file or a folder of parts) when it exists, else ``root/name.csv``."""
    try:
        return spark.read.parquet(f"{root}/{name}.parquet")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return read_csv(spark, f"{root}/{name}.csv", schema)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    """Raise if any column is missing; reads no data."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


# ---- JSON record batches -------------------------------------------------------------------------------------------

def parse_json_records(df: DataFrame, column: str, fields: dict[str, str], key: Sequence[str] = ()) -> DataFrame:
    """One row per record of a JSON body that is a bare array or ``{"records": [...]}``.

    ``fields`` maps the wanted keys to Spark types. JSON booleans become 1/0, null and absent keys become NULL, strings stay
    strings whatever they look like, and a record that is not an object or holds a non-scalar field comes back with
    ``_error`` set instead of stopping the job.
    """
    body = F.try_parse_json(F.col(column))
    items = F.coalesce(F.try_variant_get(body, "$", "array<variant>"), F.try_variant_get(body, "$.records", "array<variant>"))
    records = df.select(*key, F.posexplode_outer(items).alias("record_index", "_item"))
    parsed = records.withColumn("_kind", F.schema_of_variant("_item")).withColumn(
        "_rec", F.try_variant_get("_item", "$", "map<string,variant>"))
    nested = F.exists(F.map_values("_rec"), lambda v: F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)"))
    error = (
        F.when(F.col("_item").isNull(), "expected an array of records or an object with records")
        .when(~F.col("_kind").startswith("OBJECT"), "record is not an object")
        .when(nested, "field must be a number, string, boolean or null")
    )
    return parsed.select(
        *key, "record_index",
        *[_json_scalar(F.try_element_at("_rec", F.lit(name))).try_cast(kind).alias(name) for name, kind in fields.items()],
        error.alias("_error"),
    )


def _json_scalar(value: Column) -> Column:
    """Text of a scalar; a JSON boolean as 1/0."""
    flag = F.try_variant_get(value, "$", "boolean").cast("int").cast("string")
    return F.when(F.schema_of_variant(value) == "BOOLEAN", flag).otherwise(F.try_variant_get(value, "$", "string"))


def read_json_records(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """JSON batch files, one body per file."""
    return parse_json_records(spark.read.text(path, wholetext=True), "value", fields)


# ---- run logs ------------------------------------------------------------------------------------------------------

RUN_SCHEMA = (
    "run_id string, model_name string, run_number bigint, status string, started_at_utc string, "
    "finished_at_utc string, duration_sec double, dataset map<string,string>, params map<string,string>, "
    "metrics map<string,string>, artifacts map<string,string>, notes string"
)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines run log. Blank and broken lines are skipped (``run_log_quality`` counts the broken ones); a line of another
    shape keeps the keys it has."""
    return spark.read.schema(RUN_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def run_log_quality(spark: SparkSession, path: str) -> DataFrame:
    """One row: n_lines (blank ones left out) and n_broken, the lines that ``read_run_log`` skips."""
    lines = spark.read.schema(f"{RUN_SCHEMA}, _broken string").option("columnNameOfCorruptRecord", "_broken").json(path)
    # Every column is asked for, because Spark judges a line by the columns that are read.
    whole = F.to_json(F.struct(*[c for c in lines.columns if c != "_broken"]))
    return lines.select("_broken", whole.alias("_run")).agg(F.count("_run").alias("n_lines"), F.count("_broken").alias("n_broken"))


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").json(path)


# ---- small documents -----------------------------------------------------------------------------------------------

PROBABILITY_COLUMNS = ("proba", "y_proba", "prob", "p")


def probability_column(df: DataFrame) -> str:
    """First of the accepted probability column names that the table has."""
    for name in PROBABILITY_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError(f"expected one of the columns {PROBABILITY_COLUMNS}")


def load_policy(path: str) -> dict:
    """Policy document (a few tiers) from a driver-side JSON file."""
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def policy_tiers(spark: SparkSession, policy: dict) -> DataFrame:
    """The policy's tiers as a table, best tier first."""
    rows = [
        (i, t["action"], float(t["min_score"]), t.get("channel"), float(t["cost_per_contact"]),
         float(t["assumed_save_rate"]))
        for i, t in enumerate(policy["tiers"])
    ]
    return spark.createDataFrame(
        rows,
        "tier int, action string, min_score double, channel string, cost_per_contact double, assumed_save_rate double",
    )
