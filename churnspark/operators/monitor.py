"""Drift, data quality, label feedback and check reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.operators.metrics import topk_metrics
from churnspark.operators.policy import action_of
from churnspark.operators.profile import long_form, missing_rates
from churnspark.operators.rank import clean_score
from churnspark.operators.select import exact_quantiles, largest_gap

FLOOR = 1e-6


def psi_term(expected: Column, observed: Column) -> Column:
    e, o = F.greatest(expected, F.lit(FLOOR)), F.greatest(observed, F.lit(FLOOR))
    return (o - e) * F.ln(o / e)


def psi_status(psi: Column) -> Column:
    return (
        F.when(psi < C.PSI_STABLE, "stable").when(psi < C.PSI_SHIFT, "moderate_shift")
        .when(psi.isNotNull(), "significant_shift")
    )


def tier_psi(df: DataFrame, policy: dict = C.POLICY, score: str = "y_proba", by: Sequence[str] = (),
             min_rows: int = C.PSI_MIN_ROWS) -> DataFrame:
    """Population stability of the tier mix against the policy's baseline counts; NULL below ``min_rows`` rows."""
    counts = policy["validation_summary"]["tier_counts"]
    total = sum(counts.values())
    action = action_of(F.col(score), policy)
    mix = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(action == a).alias(f"n_{a}") for a in counts]
    )
    psi = sum(
        (psi_term(F.lit(c / total), X.ratio(F.col(f"n_{a}").cast("double"), F.col("n"))) for a, c in counts.items()),
        F.lit(0.0),
    )
    return mix.withColumn("psi", F.when(F.col("n") >= min_rows, psi)).withColumn("status", psi_status(F.col("psi")))


def mostly_missing_count(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and mostly-missing rows of a table that went through ``missing_guardrail``."""
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("mostly_missing").alias("n_mostly_missing")
    )


# ---- feature drift -------------------------------------------------------------------------------------------------


def baseline_edges(baseline: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner quantile edges per feature, distinct and ascending: at most features x (bins - 1) numbers."""
    qs = [i / bins for i in range(1, bins)]
    rows = exact_quantiles(long_form(baseline, features), "value", qs, ["feature"]).collect()
    return {r["feature"]: sorted(set(r["quantiles"])) for r in rows}


def feature_psi(baseline: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10,
                edges: dict[str, list[float]] | None = None) -> DataFrame:
    """PSI per feature over the baseline's quantile bins; missing values form their own bin. One pass per table."""
    cuts = edges or baseline_edges(baseline, features, bins)

    def binned(df: DataFrame, is_baseline: int) -> DataFrame:
        pairs = []
        for f in features:
            x = F.col(f).cast("double")
            bucket = F.when(x.isNull() | F.isnan(x), -1).otherwise(X.sorted_bucket(x, cuts.get(f, [])))
            pairs.append(F.struct(F.lit(f).alias("feature"), bucket.alias("bin")))
        return df.select(F.inline(F.array(*pairs)), F.lit(is_baseline).alias("e"), F.lit(1 - is_baseline).alias("o"))

    both = binned(baseline, 1).unionByName(binned(current, 0)).groupBy("feature", "bin").agg(
        F.sum("e").alias("e"), F.sum("o").alias("o")
    )
    whole = Window.partitionBy("feature")
    share = [X.ratio(F.col(c).cast("double"), F.sum(c).over(whole)) for c in ("e", "o")]
    terms = both.select("feature", psi_term(*share).alias("term"))
    psi = terms.groupBy("feature").agg(F.sum("term").alias("psi"))
    return psi.withColumns({"alert": F.col("psi") > 0.20, "retrain": F.col("psi") > 0.25})


def drift_decision(psi: DataFrame, features: int = 3) -> DataFrame:
    """Retrain when three or more features moved past the retrain line."""
    return psi.agg(
        F.count_if("alert").alias("n_alert"), F.count_if("retrain").alias("n_retrain"),
    ).withColumn("retrain", F.col("n_retrain") >= features)


def feature_ks(baseline: DataFrame, current: DataFrame, features: Sequence[str], alpha: float = 0.01) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov per feature: the largest gap of the two running shares, asymptotic p-value.

    A feature without values on one side has no statistic: ks, p_value and drifted are NULL.
    """
    both = long_form(baseline, features).withColumns({"a": F.lit(1), "b": F.lit(0)}).unionByName(
        long_form(current, features).withColumns({"a": F.lit(0), "b": F.lit(1)}))
    gaps = largest_gap(both, "value", "a", "b", ["feature"])
    stats = gaps.select("feature", F.col("all_a").alias("n_baseline"), F.col("all_b").alias("n_current"), F.col("gap").alias("ks"))
    named = baseline.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, features))).alias("feature"))
    every = named.join(stats, "feature", "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_baseline", "n_current")})
    return with_ks_p_value(every).withColumn("drifted", F.col("p_value") < alpha)


def with_ks_p_value(stats: DataFrame) -> DataFrame:
    n, m = F.col("n_baseline").cast("double"), F.col("n_current").cast("double")
    x = F.col("ks") * F.sqrt(n * m / (n + m))
    series = sum(
        ((2.0 if j % 2 else -2.0) * F.exp(-2.0 * j * j * x * x) for j in range(1, 21)), F.lit(0.0)
    )
    # Below 0.3 the twenty terms do not settle, and the p-value is 1 to five digits anyway.
    return stats.withColumn("p_value", F.when(x < 0.3, 1.0).otherwise(X.clamp(series, 0.0, 1.0)))


def null_rate_drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str], factor: float = 2.0,
                    gate: float = 5.0) -> DataFrame:
    """Missing percentage per column in both tables; alert above ``factor`` x baseline, block above the gate."""
    b = missing_rates(baseline, columns).select("feature", F.col("pct_missing").alias("baseline_pct"))
    c = missing_rates(current, columns).select("feature", F.col("pct_missing").alias("current_pct"))
    return b.join(F.broadcast(c), "feature").withColumns({
        "alert": F.col("current_pct") > factor * F.col("baseline_pct"),
        "blocked": F.col("current_pct") > gate,
    })


# ---- per-cycle monitors --------------------------------------------------------------------------------------------


def _trailing(cycle: str, n: int) -> Window:
    """The n cycles before this one. The input has one row per cycle."""
    return Window.orderBy(cycle).rowsBetween(-n, -1)


def volume_anomaly(df: DataFrame, cycle: str, window: int = 3, tolerance: float = 0.2) -> DataFrame:
    """Rows per cycle against the mean of the cycles before it."""
    counts = df.groupBy(cycle).agg(F.count(F.lit(1)).alias("n"))
    out = counts.withColumn("expected", F.avg(F.col("n").cast("double")).over(_trailing(cycle, window)))
    out = out.withColumn("deviation", X.ratio(F.col("n") - F.col("expected"), F.col("expected")))
    return out.withColumn("alert", F.coalesce(F.abs(F.col("deviation")) > tolerance, F.lit(False)))


def score_shift(df: DataFrame, cycle: str, threshold: float = 0.5, score: str = "y_proba",
                baseline: tuple[float, float, float] | None = None) -> DataFrame:
    """Per-cycle mean score and predicted rate against a baseline (mean, std, rate), by default the first cycle's.

    Missing scores count as rows only.
    """
    value = clean_score(F.col(score))
    stats = df.groupBy(cycle).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_score"), F.stddev_pop(value).alias("std_score"),
        F.avg((value >= threshold).cast("double")).alias("predicted_rate"),
    )
    if baseline is None:
        first = Window.orderBy(cycle).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        mean, std, rate = (F.first(c).over(first) for c in ("mean_score", "std_score", "predicted_rate"))
    else:
        mean, std, rate = (F.lit(float(x)) for x in baseline)
    return stats.withColumns({
        "mean_shift_sigma": X.ratio(F.abs(F.col("mean_score") - mean), std),
        "rate_ratio": X.ratio(F.col("predicted_rate"), rate),
    }).withColumns({
        "mean_alert": F.coalesce(F.col("mean_shift_sigma") > 2, F.lit(False)),
        "rate_alert": F.coalesce((F.col("rate_ratio") >= 2) | (F.col("rate_ratio") <= 0.5), F.lit(False)),
    })


def delayed_labels(predictions: DataFrame, labels: DataFrame, id: str, cycle: str, delay_days: int = 30,
                   label: str = "y_true") -> DataFrame:
    """Predictions with the labels that arrived ``delay_days`` after their cycle (both DATE columns)."""
    shifted = labels.select(id, F.date_sub(cycle, delay_days).alias(cycle), label)
    return predictions.join(shifted, [id, cycle], "inner")


def precision_decay(df: DataFrame, k: int, cycle: str, score: str = "y_proba", label: str = "y_true", id: str = "id",
                    min_lift: float = 1.5) -> DataFrame:
    """Precision in each cycle's top K against 1.5 x the cycle's base rate; retrain after two low cycles in a row."""
    tops = topk_metrics(df, [k], score, label, id, [cycle])
    low = F.col("lift") < min_lift
    return tops.select(cycle, "n_targeted", "tp", "precision", "lift").withColumn("low", low).withColumn(
        "retrain", F.col("low") & F.coalesce(F.lag("low").over(Window.orderBy(cycle)), F.lit(False))
    )


# ---- gates and check reports ---------------------------------------------------------------------------------------


def check_rows(one: DataFrame, checks: dict[str, tuple[Column, Column, Column]], severity: str = "error") -> DataFrame:
    """Turns a one-row table into check rows: name -> (passed, computed, expected)."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("check"), F.coalesce(ok, F.lit(False)).alias("passed"),
                 got.cast("double").alias("computed"), want.cast("double").alias("expected"))
        for n, (ok, got, want) in checks.items()
    ])
    return one.select(F.inline(pairs)).withColumn("severity", F.lit(severity))


def promotion_gates(candidate: DataFrame, champion_auc: float, champion_ap: float, auc_drop: float = 0.01,
                    ap_drop: float = 0.02, max_null_pct: float = 5.0, min_roi: float = 15_000) -> DataFrame:
    """One-row candidate (roc_auc, average_precision, max_null_pct, best_roi) to pass/fail rows."""
    auc, ap = F.col("roc_auc"), F.col("average_precision")
    return check_rows(candidate, {
        "roc_auc": (auc >= champion_auc - auc_drop, auc, F.lit(champion_auc - auc_drop)),
        "average_precision": (ap >= champion_ap - ap_drop, ap, F.lit(champion_ap - ap_drop)),
        "null_rate": (F.col("max_null_pct") <= max_null_pct, F.col("max_null_pct"), F.lit(max_null_pct)),
        "roi": (F.col("best_roi") >= min_roi, F.col("best_roi"), F.lit(min_roi)),
    })


def economics_checks(compared: DataFrame, recorded: dict[str, float], tolerance: float = 1.0) -> DataFrame:
    """Net values of ``policy_compare`` against recorded ones, to within a dollar."""
    want = F.create_map(*[F.lit(x) for pair in recorded.items() for x in pair])
    rows = compared.withColumn("_want", F.try_element_at(want, F.col("policy"))).where("_want IS NOT NULL")
    return rows.select(
        F.concat(F.lit("net_"), F.col("policy")).alias("check"),
        (F.abs(F.col("net") - F.col("_want")) < tolerance).alias("passed"),
        F.col("net").alias("computed"), F.col("_want").alias("expected"), F.lit("error").alias("severity"),
    )


def lift_checks(metrics: DataFrame, documented: dict[str, float], tolerance: float = 0.05) -> DataFrame:
    """Rows (metric, value, base_rate): value / base rate to one decimal against the documented lift."""
    want = F.create_map(*[F.lit(x) for pair in documented.items() for x in pair])
    lift = X.ratio(F.col("value"), F.col("base_rate"))
    rows = metrics.withColumn("_lift", lift).withColumn("_want", F.try_element_at(want, F.col("metric")))
    return rows.where("_want IS NOT NULL").select(
        F.concat(F.lit("lift_"), F.col("metric")).alias("check"),
        F.coalesce(F.abs(X.half_up(F.col("_lift"), 1) - F.col("_want")) < tolerance, F.lit(False)).alias("passed"),
        F.col("_lift").alias("computed"), F.col("_want").alias("expected"), F.lit("error").alias("severity"),
    )


def calibration_checks(calibration: DataFrame) -> DataFrame:
    return calibration.select(
        F.concat(F.lit("calibration_"), F.col("action")).alias("check"), F.col("within_range").alias("passed"),
        F.col("observed_rate").alias("computed"), F.col("min_score").alias("expected"), F.lit("info").alias("severity"),
    )


def score_parity(scored: DataFrame, reference: DataFrame, id: str = "id", tolerance: float = 0.001) -> DataFrame:
    """Reference scores (id, expected) against the scores produced now; a missing score fails."""
    got = scored.select(id, F.col("y_proba").alias("got"))
    return reference.join(got, id, "left").select(
        id, "expected", "got", F.coalesce(F.abs(F.col("got") - F.col("expected")) <= tolerance, F.lit(False)).alias("passed")
    )


def eval_report(checks: Sequence[DataFrame]) -> DataFrame:
    """All check rows with their result: pass, fail or info."""
    rows = checks[0]
    for more in checks[1:]:
        rows = rows.unionByName(more)
    return rows.withColumn(
        "result", F.when(F.col("passed"), "pass").when(F.col("severity") == "info", "info").otherwise("fail")
    )
