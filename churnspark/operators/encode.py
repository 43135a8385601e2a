"""Encoders fitted on training rows. A fit is one aggregation whose result has one row per column or category."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions import columns as X
from churnspark.operators.profile import long_form
from churnspark.operators.rank import rank_by
from churnspark.operators.select import exact_quantiles
from churnspark.sources.staging import stage

NA = "__NA__"


@dataclass(frozen=True)
class Encoding:
    """Fitted values: medians, most frequent strings, and the dictionary (feature, value, slot) of one-hot slots."""

    medians: dict[str, float]
    modes: dict[str, str]
    slots: DataFrame | None = None


def long_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs))


def fit_encoding(train: DataFrame, numeric: Sequence[str], strings: Sequence[str]) -> Encoding:
    """Exact medians, modes (smallest value on ties) and the categories seen in training, numbered in value order.

    The categories stay a table, so a column may have any number of them.
    """
    medians: dict[str, float] = {}
    if numeric:
        rows = exact_quantiles(long_form(train, numeric), "value", [0.5], ["feature"]).collect()
        medians = {r["feature"]: r["quantiles"][0] for r in rows}
    modes: dict[str, str] = {}
    slots = None
    if strings:
        counts = long_strings(train, strings).where("value IS NOT NULL").groupBy("feature", "value").agg(
            F.count(F.lit(1)).alias("n")
        )
        counts = stage(counts, "categories")
        best = F.min_by("value", F.struct((-F.col("n")).alias("a"), F.col("value").alias("b")))
        modes = {r["feature"]: r["mode"] for r in counts.groupBy("feature").agg(best.alias("mode")).collect()}
        numbered = rank_by(counts.select("feature", "value"), [F.col("value").asc()], ["feature"], out="slot")
        slots = stage(numbered.withColumn("slot", (F.col("slot") - 1).cast("int")), "slots")
    return Encoding(medians, modes, slots)


def apply_encoding(df: DataFrame, encoding: Encoding, keep: Sequence[str] = ()) -> DataFrame:
    """Imputed numerics with ``<c>_missing`` indicators; one-hot strings as a sparse vector of length ``<c>_size`` with a
    one at ``<c>_slot`` (no slot for an unseen value)."""
    kinds = dict(df.dtypes)
    out = [F.col(c) for c in keep]
    for c, median in encoding.medians.items():
        missing = X.is_missing(F.col(c), kinds[c])
        out += [F.when(missing, median).otherwise(F.col(c).cast("double")).alias(c),
                missing.cast("int").alias(f"{c}_missing")]
    for c, mode in encoding.modes.items():
        own = encoding.slots.where(F.col("feature") == c)
        size = own.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
        df = df.join(own.select(F.col("value").alias(f"_v_{c}"), F.col("slot").alias(f"_slot_{c}")),
                     F.coalesce(F.col(c).cast("string"), F.lit(mode)) == F.col(f"_v_{c}"), "left")
        out += [F.col(f"_slot_{c}").alias(f"{c}_slot"), size.alias(f"{c}_size")]
    return df.select(*out)


def ordinal_dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, code): training values numbered 1..K in value order; missing is the value ``__NA__``."""
    values = long_strings(train, columns).select("feature", F.coalesce("value", F.lit(NA)).alias("value")).distinct()
    return rank_by(values, [F.col("value").asc()], ["feature"], out="code")


def ordinal_encode(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replaces each column by ``<c>_code``; values not seen in training get 0."""
    out = df
    for c in columns:
        codes = dictionary.where(F.col("feature") == c).select(
            F.col("value").alias("_v"), F.col("code").alias(f"{c}_code")
        )
        out = out.withColumn("_v", F.coalesce(F.col(c).cast("string"), F.lit(NA))).join(codes, "_v", "left").drop("_v")
        out = out.withColumn(f"{c}_code", F.coalesce(f"{c}_code", F.lit(0).cast("bigint")))
    return out


def encoding_bounds(encoded: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, low, high, n_codes, within): every code must lie in 0..K."""
    sizes = dictionary.groupBy("feature").agg(F.max("code").alias("n_codes"))
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.min(f"{c}_code").alias("low"), F.max(f"{c}_code").alias("high"))
        for c in columns
    ])
    return encoded.agg(pairs.alias("_p")).select(F.inline("_p")).join(sizes, "feature").withColumn(
        "within", (F.col("low") >= 0) & (F.col("high") <= F.col("n_codes"))
    )


def clean_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL, NaN and infinities become 0 in the given columns."""
    return df.withColumns({c: X.finite_or_zero(F.col(c).cast("double")) for c in columns})


# ---- scaling and weights -------------------------------------------------------------------------------------------


def fit_standardize(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a deviation under 1e-6 counts as 1."""
    row = train.agg(*[e for c in columns for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] if (row[f"s_{c}"] or 0) >= 1e-6 else 1.0) for c in columns}


def standardize(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - mean) / std for c, (mean, std) in fitted.items()})


def class_weights(df: DataFrame, label: str = "is_churn") -> DataFrame:
    """One row: class counts, neg/pos ratio and the 'balanced' weight of each class."""
    y = F.col(label)
    counts = df.agg(F.count_if(y == 0).alias("n_neg"), F.count_if(y == 1).alias("n_pos"))
    neg, pos = F.col("n_neg").cast("double"), F.col("n_pos").cast("double")
    return counts.withColumns({
        "scale_pos_weight": X.ratio(neg, pos),
        "weight_neg": X.ratio(neg + pos, 2 * neg), "weight_pos": X.ratio(neg + pos, 2 * pos),
    })


def with_balanced_weight(df: DataFrame, label: str = "is_churn", out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(F.struct("weight_neg", "weight_pos")).scalar()
    return df.withColumn("_w", w).withColumn(
        out, F.when(F.col(label) == 1, F.col("_w.weight_pos")).otherwise(F.col("_w.weight_neg"))
    ).drop("_w")
