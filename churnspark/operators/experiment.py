"""Holdout experiments: design, assignment, readout, contact fairness."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.operators.policy import action_of
from churnspark.operators.rank import best_rows


def sample_size(baseline: Column, mde: float, alpha: float = 0.05, power: float = 0.8) -> Column:
    """Users per arm for a two-sided two-proportion z-test; NULL when the inputs make no sense."""
    if not (mde > 0 and 0 < alpha < 1 and 0 < power < 1):
        return F.lit(None).cast("bigint")
    z_alpha, z_beta = NormalDist().inv_cdf(1 - alpha / 2), NormalDist().inv_cdf(power)
    p1, p2 = baseline, baseline - mde
    pooled = (p1 + p2) / 2
    size = z_alpha * F.sqrt(2 * pooled * (1 - pooled)) + z_beta * F.sqrt(p1 * (1 - p1) + p2 * (1 - p2))
    valid = (p1 > 0) & (p1 < 1) & (p2 > 0) & (p2 < 1)
    return F.when(valid, F.ceil(size * size / (mde * mde))).cast("bigint")


def sample_size_by(df: DataFrame, by: str, mde: float, label: str = "y_true", alpha: float = 0.05,
                   power: float = 0.8) -> DataFrame:
    rates = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("baseline")
    )
    return rates.withColumn("n_per_arm", sample_size(F.col("baseline"), mde, alpha, power))


def assign_holdout(df: DataFrame, k: int, policy: dict = C.POLICY, share: float = 0.5, seed: int = 42,
                   score: str = "y_proba", id: str = "id") -> DataFrame:
    """The top k with their tier and a randomised arm; half of every tier is held out.

    The arm is the hash of the id with the tier in the seed: stable on re-runs and independent between tiers.
    """
    top = best_rows(df, k, score, id).withColumn("tier", action_of(F.col(score), policy))
    draw = X.hash_fraction(F.concat(F.col(id).cast("string"), F.lit("|"), F.col("tier")), seed)
    return top.withColumn("arm", F.when(draw < share, "holdout").otherwise("treatment"))


def experiment_readout(df: DataFrame, policy: dict = C.POLICY, label: str = "churned", arm: str = "arm",
                       tier: str = "tier") -> DataFrame:
    """Per tier and pooled ('all'): churn per arm, difference, z-test, incremental saves and net value."""
    treated = F.col(arm) == "treatment"
    y = F.col(label).cast("bigint")
    cost = F.lit(0.0)
    for t in policy["tiers"]:
        cost = F.when(F.col(tier) == t["action"], float(t["cost_per_contact"])).otherwise(cost)
    sums = df.rollup(tier).agg(
        F.grouping(tier).alias("_g"),
        F.count_if(treated).alias("n_treatment"), F.count_if(~treated).alias("n_holdout"),
        F.sum(F.when(treated, y).otherwise(0)).alias("churned_treatment"),
        F.sum(F.when(~treated, y).otherwise(0)).alias("churned_holdout"),
        F.sum(F.when(treated, cost).otherwise(0.0)).alias("spend"),
    )
    n1, n0 = F.col("n_treatment").cast("double"), F.col("n_holdout").cast("double")
    p1, p0 = X.ratio(F.col("churned_treatment").cast("double"), n1), X.ratio(F.col("churned_holdout").cast("double"), n0)
    pooled = X.ratio((F.col("churned_treatment") + F.col("churned_holdout")).cast("double"), n1 + n0)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.when(n1 > 0, n1) + 1 / F.when(n0 > 0, n0)))
    out = sums.select(
        F.when(F.col("_g") == 1, "all").otherwise(F.col(tier)).alias("tier"), "n_treatment", "n_holdout",
        p1.alias("churn_treatment"), p0.alias("churn_holdout"), (p0 - p1).alias("reduction"),
        X.ratio(p0 - p1, error).alias("z"), ((p0 - p1) * n1).alias("incremental_saves"), "spend",
    )
    return out.withColumn("p_value", 2 * (1 - X.normal_cdf(F.abs(F.col("z"))))).withColumn(
        "incremental_net", F.col("incremental_saves") * float(policy["value_per_save"]) - F.col("spend")
    )


def age_band(age: Column) -> Column:
    return (
        F.when(age.isNull(), "unknown").when(age < 25, "10-24").when(age < 35, "25-34").when(age < 50, "35-49")
        .otherwise("50+")
    )


def contact_rate_by_group(df: DataFrame, contacted: Column, groups: dict[str, Column]) -> DataFrame:
    """Contact rate for every combination, every single attribute and overall; 'all' marks a rolled-up attribute."""
    named = df.select(*[e.alias(n) for n, e in groups.items()], contacted.cast("int").alias("_c"))
    cubed = named.cube(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_c").alias("contacted"),
        *[F.grouping(n).alias(f"_g_{n}") for n in groups],
    )
    return cubed.select(
        *[F.when(F.col(f"_g_{n}") == 1, "all").otherwise(F.col(n)).alias(n) for n in groups],
        "n", "contacted", X.ratio(F.col("contacted").cast("double"), F.col("n")).alias("contact_rate"),
    )
