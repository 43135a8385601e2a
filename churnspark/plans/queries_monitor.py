"""Registered queries: drift, data quality, label feedback, check reports, experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions.dates import ymd_to_date
from churnspark.operators import clean, experiment, metrics, monitor, policy
from churnspark.plans.adapters import Tables
from churnspark.plans.queries_score import (
    AP, AUC, GROUPS, RANKED, TIERS, _CARD, _NET, _card, _sweep_sql, action_sql, scored_table,
)
from churnspark.plans.registry import hash_sql, oracle, query, r6

K = 1000
_COUNTS = C.POLICY["validation_summary"]["tier_counts"]
_TOTAL = sum(_COUNTS.values())


def _cycles(t: Tables) -> DataFrame:
    return t.scored.withColumn("y_proba", F.col("y_proba").cast("double"))


# ---- drift ---------------------------------------------------------------------------------------------------------

_PSI = " + ".join(
    f"(greatest(n_{a} / CAST(n AS DOUBLE), 1e-6) - {c}e0 / {_TOTAL}) * ln(greatest(n_{a} / CAST(n AS DOUBLE), 1e-6) / ({c}e0 / {_TOTAL}))"
    for a, c in _COUNTS.items())


@query("tier_psi", oracle(
    f"""SELECT *, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate_shift' WHEN psi IS NOT NULL THEN 'significant_shift' END AS status
    FROM (SELECT *, CASE WHEN n >= 1000 THEN {r6(_PSI, 'x')[:-5]} END AS psi FROM (SELECT segment, count(*) AS n, """
    + ", ".join(f"count(*) FILTER (a = '{a}') AS n_{a}" for a in _COUNTS)
    + f" FROM (SELECT segment, {action_sql()} AS a FROM scored) GROUP BY segment))", "scored"))
def tier_psi(t: Tables) -> DataFrame:
    return monitor.tier_psi(_cycles(t), by=["segment"])


_FEATURES = ["total_secs", "num_unq"]
_SIDES = ("base AS (SELECT * FROM user_logs WHERE date < 20240116)", "cur AS (SELECT * FROM user_logs WHERE date >= 20240116)")


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.user_logs.select("date", *_FEATURES)
    return rows.where("date < 20240116"), rows.where("date >= 20240116")


_EDGES = "edges AS (" + " UNION ".join(
    f"SELECT '{f}' AS feature, quantile_cont(CAST({f} AS DOUBLE), {q / 10}) AS e FROM base" for f in _FEATURES for q in range(1, 10)) + ")"


def _bins(side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, (SELECT count(*) FROM edges WHERE feature = '{f}' AND e <= CAST({f} AS DOUBLE)) AS bin FROM {side}"
        for f in _FEATURES)


_FPSI = f"""SELECT feature, sum((greatest(o, 1e-6) - greatest(e, 1e-6)) * ln(greatest(o, 1e-6) / greatest(e, 1e-6))) AS psi FROM (
  SELECT feature, coalesce(e, 0) / sum(e) OVER (PARTITION BY feature) AS e, coalesce(o, 0) / sum(o) OVER (PARTITION BY feature) AS o FROM
  (SELECT feature, bin, CAST(count(*) AS DOUBLE) AS e FROM ({_bins('base')}) GROUP BY 1, 2) FULL JOIN
  (SELECT feature, bin, CAST(count(*) AS DOUBLE) AS o FROM ({_bins('cur')}) GROUP BY 1, 2) USING (feature, bin)) GROUP BY feature"""


@query("feature_psi", oracle(f"SELECT feature, {r6('psi', 'psi')}, psi > 0.2 AS alert, psi > 0.25 AS retrain FROM ({_FPSI})",
                             "user_logs", ctes=(*_SIDES, _EDGES)))
def feature_psi(t: Tables) -> DataFrame:
    return monitor.feature_psi(*_sides(t), _FEATURES)


@query("drift_decision", oracle(
    f"""SELECT count(*) FILTER (psi > 0.2) AS n_alert, count(*) FILTER (psi > 0.25) AS n_retrain, count(*) FILTER (psi > 0.25) >= 3 AS retrain
    FROM ({_FPSI})""", "user_logs", ctes=(*_SIDES, _EDGES)))
def drift_decision(t: Tables) -> DataFrame:
    return monitor.drift_decision(monitor.feature_psi(*_sides(t), _FEATURES))


_KS_X = "ks * sqrt(CAST(n_baseline AS DOUBLE) * n_current / (CAST(n_baseline AS DOUBLE) + n_current))"
_KS_SERIES = " + ".join(f"{2 if j % 2 else -2} * exp(-2e0 * {j * j} * x * x)" for j in range(1, 21))


@query("feature_ks", oracle(
    f"""SELECT feature, n_baseline, n_current, {r6('ks', 'ks')}, {r6('p', 'p_value')}, p < 0.01 AS drifted FROM (SELECT *, CASE WHEN x < 0.3 THEN 1 ELSE
      least(greatest({_KS_SERIES}, 0), 1) END AS p FROM (SELECT *, {_KS_X} AS x FROM (
      SELECT feature, CAST(max(na) AS BIGINT) AS n_baseline, CAST(max(nb) AS BIGINT) AS n_current, max(abs(ca / CAST(na AS DOUBLE) - cb / CAST(nb AS DOUBLE))) AS ks FROM (
        SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb FROM (
          SELECT feature, v, sum(a) AS a, sum(b) AS b FROM ({' UNION ALL '.join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, CAST(date < 20240116 AS INT) AS a, CAST(date >= 20240116 AS INT) AS b FROM user_logs" for f in _FEATURES)}) GROUP BY feature, v)
        WINDOW w AS (PARTITION BY feature ORDER BY v)) GROUP BY feature)))""", "user_logs"))
def feature_ks(t: Tables) -> DataFrame:
    return monitor.feature_ks(*_sides(t), _FEATURES)


_NULLS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, (count(*) FILTER (city < 12 AND {c} IS NULL)) * 100.0e0 / count(*) FILTER (city < 12) AS b,
    (count(*) FILTER (city >= 12 AND {c} IS NULL)) * 100.0e0 / count(*) FILTER (city >= 12) AS c FROM members_clean""" for c in ("bd", "gender2", "city"))


@query("null_rate_drift", oracle(
    f"""SELECT replace(feature, 'gender2', 'gender') AS feature, {r6('b', 'baseline_pct')}, {r6('c', 'current_pct')}, c > 2 * b AS alert, c > 5 AS blocked
    FROM ({_NULLS.replace('members_clean', 'mm')})""", "members_clean",
    ctes=("mm AS (SELECT c.*, m.gender AS gender2 FROM members_clean c JOIN members m USING (msno))",)))
def null_rate_drift(t: Tables) -> DataFrame:
    rows = clean.clean_members(t.members.withColumn("g", F.col("gender"))).withColumn("gender", F.col("g"))
    return monitor.null_rate_drift(rows.where("city < 12"), rows.where("city >= 12"), ["bd", "gender", "city"])


@query("missing_by_batch", oracle(
    """SELECT city, count(*) AS n, CAST(sum(CASE WHEN b + g > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_mostly_missing FROM (
    SELECT city, CASE WHEN c.bd IS NULL THEN 1 ELSE 0 END AS b, CASE WHEN m.gender IS NULL THEN 1 ELSE 0 END AS g
    FROM members_clean c JOIN (SELECT msno, gender FROM members) m USING (msno)) GROUP BY city""", "members_clean"))
def missing_by_batch(t: Tables) -> DataFrame:
    rows = clean.clean_members(t.members.withColumn("g", F.col("gender"))).withColumn("gender", F.col("g"))
    flagged = clean.missing_guardrail(rows, ["bd", "gender"])
    return monitor.mostly_missing_count(flagged, ["city"])


# ---- per-cycle monitors --------------------------------------------------------------------------------------------


@query("volume_anomaly", oracle(
    f"""SELECT cycle, n, {r6('e', 'expected')}, {r6('(n - e) / e', 'deviation')}, coalesce(abs((n - e) / e) > 0.2, FALSE) AS alert FROM (
    SELECT cycle, n, avg(CAST(n AS DOUBLE)) OVER (ORDER BY cycle ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS e
    FROM (SELECT cycle, count(*) AS n FROM scored GROUP BY cycle))""", "scored"))
def volume_anomaly(t: Tables) -> DataFrame:
    return monitor.volume_anomaly(t.scored, "cycle")


@query("score_shift", oracle(
    f"""SELECT cycle, n, {r6('m', 'mean_score')}, {r6('s', 'std_score')}, {r6('r', 'predicted_rate')}, {r6('abs(m - m0) / s0', 'mean_shift_sigma')},
    {r6('CASE WHEN r0 > 0 THEN r / r0 END', 'rate_ratio')}, abs(m - m0) / s0 > 2 AS mean_alert, coalesce(r / r0 >= 2 OR r / r0 <= 0.5, FALSE) AS rate_alert
    FROM (SELECT *, first(m) OVER w AS m0, first(s) OVER w AS s0, first(r) OVER w AS r0 FROM (SELECT cycle, count(*) AS n, avg(y_proba) AS m,
    stddev_pop(y_proba) AS s, avg(CAST(y_proba >= 0.5e0 AS DOUBLE)) AS r FROM scored GROUP BY cycle) WINDOW w AS (ORDER BY cycle))""", "scored"))
def score_shift(t: Tables) -> DataFrame:
    return monitor.score_shift(_cycles(t), "cycle")


_TOPS = """tops AS (SELECT cycle, count(*) FILTER (r <= 20) AS n_targeted, CAST(sum(y_true) FILTER (r <= 20) AS BIGINT) AS tp,
  avg(CAST(y_true AS DOUBLE)) AS base FROM (SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY y_proba DESC, id) AS r FROM scored) GROUP BY cycle)"""


@query("precision_decay", oracle(
    f"""SELECT cycle, n_targeted, tp, {r6('p', 'precision')}, {r6('l', 'lift')}, l < 1.5 AS low,
    l < 1.5 AND coalesce(lag(l < 1.5) OVER (ORDER BY cycle), FALSE) AS retrain FROM (SELECT *, tp / CAST(n_targeted AS DOUBLE) AS p,
    CASE WHEN base > 0 THEN (tp / CAST(n_targeted AS DOUBLE)) / base ELSE 0 END AS l FROM tops)""", "scored", ctes=(_TOPS,)))
def precision_decay(t: Tables) -> DataFrame:
    predictions = _cycles(t).select("id", ymd_to_date(F.col("cycle")).alias("cycle"), "y_proba")
    arrived = t.scored.select("id", F.date_add(ymd_to_date(F.col("cycle")), 30).alias("cycle"), "y_true")
    joined = monitor.delayed_labels(predictions, arrived, "id", "cycle")
    out = monitor.precision_decay(joined, 20, "cycle")
    return out.withColumn("cycle", F.date_format("cycle", "yyyyMMdd").cast("int"))


# ---- gates and reports ---------------------------------------------------------------------------------------------


def _candidate(t: Tables) -> DataFrame:
    rows = scored_table(t)
    best = metrics.threshold_sweep(rows).agg(F.max("roi")).scalar()
    nulls = monitor.missing_rates(rows).agg(F.max("pct_missing")).scalar()
    return metrics.ranking_metrics(rows).select("roc_auc", "average_precision", best.alias("best_roi"), nulls.alias("max_null_pct"))


@query("promotion_gates", oracle(
    f"""SELECT check_name AS "check", passed, {r6('computed', 'computed')}, {r6('expected', 'expected')}, 'error' AS severity FROM (
    SELECT 'roc_auc' AS check_name, v >= 0.956e0 AS passed, v AS computed, 0.966e0 - 0.01e0 AS expected FROM (SELECT {AUC} AS v FROM cum)
    UNION ALL SELECT 'average_precision', v >= 0.5392e0 - 0.02e0, v, 0.5392e0 - 0.02e0 FROM (SELECT {AP} AS v FROM cum)
    UNION ALL SELECT 'null_rate', v <= 5, v, 5 FROM (SELECT (count(*) - count(y_proba)) * 100e0 / count(*) AS v FROM scored) UNION ALL SELECT 'roi', max(roi) >= 15000, max(roi), 15000 FROM sweep)""",
    "scored", ctes=(GROUPS, *_sweep_sql())))
def promotion_gates(t: Tables) -> DataFrame:
    return monitor.promotion_gates(_candidate(t), 0.966, 0.5392)


_ECON = f"""econ AS (SELECT 'net_' || policy AS "check", abs(net - want) < 1 AS passed, net AS computed, want AS expected, 'error' AS severity FROM (
  SELECT 'threshold_only' AS policy, churners * 0.2e0 * 120 - n * 5e0 AS net, 17666e0 AS want FROM tiers WHERE tier = 0
  UNION ALL SELECT 'top_k_single_channel', sum(churners) * 0.2e0 * 120 - sum(n) * 5e0, -6776e0 FROM tiers WHERE tier < 2
  UNION ALL SELECT 'tiered', sum({_NET}), 24306e0 FROM tiers WHERE tier < 2))"""
_LIFT = f"""lifts AS (SELECT 'lift_' || m AS "check", abs(floor(v / base * 10 + 0.5) / 10 - want) < 0.05 AS passed, v / base AS computed, want AS expected, 'error' AS severity
  FROM (SELECT 'pr_auc' AS m, {AP} AS v, 43.4e0 AS want FROM cum
  UNION ALL SELECT 'precision_at_5000', sum(y_true) / CAST(count(*) AS DOUBLE), 21.6e0 FROM ranked WHERE rank <= 5000
  UNION ALL SELECT 'precision_at_10000', sum(y_true) / CAST(count(*) AS DOUBLE), 14.5e0 FROM ranked WHERE rank <= 10000),
  (SELECT avg(CAST(y_true AS DOUBLE)) AS base FROM scored))"""
_CALIB = """calib AS (SELECT 'calibration_' || action AS "check", churners / CAST(n AS DOUBLE) >= lo AND (tier = 0 OR churners / CAST(n AS DOUBLE) < hi) AS passed,
  churners / CAST(n AS DOUBLE) AS computed, lo AS expected, 'info' AS severity FROM tiers)"""
_CHECK_COLUMNS = f"\"check\", passed, {r6('computed', 'computed')}, {r6('expected', 'expected')}, severity"


def _recorded() -> dict[str, float]:
    net = C.POLICY["validation_summary"]["net_per_cycle"]
    return {"threshold_only": net["threshold_only"], "top_k_single_channel": net["top_10k_single_channel"], "tiered": net["tiered"]}


def _economics(t: Tables) -> DataFrame:
    return monitor.economics_checks(policy.policy_compare(policy.tier_counts(scored_table(t))), _recorded())


def _lifts(t: Tables) -> DataFrame:
    rows = scored_table(t)
    base = rows.agg(F.avg(F.col("y_true").cast("double"))).scalar()
    ap = metrics.ranking_metrics(rows).select(F.lit("pr_auc").alias("metric"), F.col("average_precision").alias("value"))
    tops = metrics.topk_metrics(rows, [5000, 10000]).select(
        F.concat(F.lit("precision_at_"), F.col("k").cast("string")).alias("metric"), F.col("precision").alias("value"))
    return monitor.lift_checks(ap.unionByName(tops).withColumn("base_rate", base), C.DOCUMENTED_LIFT)


@query("eval_economics", oracle(f"SELECT {_CHECK_COLUMNS} FROM econ", "scored", ctes=(*TIERS, _ECON)))
def eval_economics(t: Tables) -> DataFrame:
    return _economics(t)


@query("eval_lift", oracle(f"SELECT {_CHECK_COLUMNS} FROM lifts", "scored", ctes=(RANKED, GROUPS, _LIFT)))
def eval_lift(t: Tables) -> DataFrame:
    return _lifts(t)


@query("eval_report", oracle(
    f"""SELECT {_CHECK_COLUMNS}, CASE WHEN passed THEN 'pass' WHEN severity = 'info' THEN 'info' ELSE 'fail' END AS result
    FROM (SELECT * FROM econ UNION ALL SELECT * FROM lifts UNION ALL SELECT * FROM calib)""", "scored",
    ctes=(*TIERS, RANKED, GROUPS, _ECON, _LIFT, _CALIB)))
def eval_report(t: Tables) -> DataFrame:
    calibration = policy.tier_calibration(policy.tier_counts(scored_table(t)))
    return monitor.eval_report([_economics(t), _lifts(t), monitor.calibration_checks(calibration)])


@query("score_parity", oracle(
    f"""SELECT r.id, {r6('r.e', 'expected')}, {r6('s.y_proba', 'got')}, coalesce(abs(s.y_proba - r.e) <= 0.001, FALSE) AS passed FROM
    (SELECT id, y_proba + CASE WHEN id % 7 = 0 THEN 0.002e0 ELSE 0.0004e0 END AS e FROM scored) r
    LEFT JOIN (SELECT * FROM scored WHERE id % 50 <> 1) s USING (id)""", "scored"))
def score_parity(t: Tables) -> DataFrame:
    rows = scored_table(t)
    shift = F.when(F.col("id") % 7 == 0, 0.002).otherwise(0.0004)
    return monitor.score_parity(rows.where("id % 50 <> 1"), rows.select("id", (F.col("y_proba") + shift).alias("expected")))


# ---- experiments ---------------------------------------------------------------------------------------------------


@query("sample_size", oracle(
    f"""SELECT segment, n, {r6('p1', 'baseline')}, CASE WHEN p1 > 0 AND p1 < 1 AND p1 - 0.03e0 > 0 THEN CAST(ceil(
      pow(1.9599639845400536e0 * sqrt(2 * ((p1 + p1 - 0.03e0) / 2) * (1 - (p1 + p1 - 0.03e0) / 2))
      + 0.8416212335729143e0 * sqrt(p1 * (1 - p1) + (p1 - 0.03e0) * (1 - (p1 - 0.03e0))), 2) / (0.03e0 * 0.03e0)) AS BIGINT) END AS n_per_arm
    FROM (SELECT segment, count(*) AS n, avg(CAST(y_true AS DOUBLE)) AS p1 FROM scored GROUP BY segment)""", "scored"))
def sample_size(t: Tables) -> DataFrame:
    return experiment.sample_size_by(t.scored, "segment", 0.03)


_ARMS = (RANKED, f"arms AS (SELECT *, CASE WHEN {hash_sql('concat(id, chr(124), tier)')} < 0.5 THEN 'holdout' ELSE 'treatment' END AS arm FROM "
                 f"(SELECT id, y_true, y_proba, {action_sql()} AS tier FROM ranked WHERE rank <= 3000))")


@query("assign_holdout", oracle(f"SELECT id, y_true, {r6('y_proba', 'y_proba')}, tier, arm FROM arms", "scored", ctes=_ARMS))
def assign_holdout(t: Tables) -> DataFrame:
    return experiment.assign_holdout(scored_table(t), 3000)


_Z = "abs(z)"
_TAIL = (f"exp(-{_Z} * {_Z} / 2) * 0.3989422804014327e0 * (u * (0.319381530e0 + u * (-0.356563782e0 + u * (1.781477937e0 + "
         f"u * (-1.821255978e0 + u * 1.330274429e0)))))")


@query("experiment_readout", oracle(
    f"""SELECT tier, n_treatment, n_holdout, {r6('p1', 'churn_treatment')}, {r6('p0', 'churn_holdout')}, {r6('p0 - p1', 'reduction')}, {r6('z', 'z')},
    {r6('(p0 - p1) * n_treatment', 'incremental_saves')}, {r6('spend', 'spend')}, {r6(f'2 * {_TAIL}', 'p_value')},
    {r6('(p0 - p1) * n_treatment * 120 - spend', 'incremental_net')} FROM (SELECT *, 1 / (1 + 0.2316419e0 * abs(z)) AS u FROM (
      SELECT *, CASE WHEN pp * (1 - pp) > 0 THEN (p0 - p1) / sqrt(pp * (1 - pp) * (1e0 / n_treatment + 1e0 / n_holdout)) END AS z FROM (
        SELECT coalesce(tier, 'all') AS tier, count(*) FILTER (arm = 'treatment') AS n_treatment, count(*) FILTER (arm = 'holdout') AS n_holdout,
        avg(CAST(y_true AS DOUBLE)) FILTER (arm = 'treatment') AS p1, avg(CAST(y_true AS DOUBLE)) FILTER (arm = 'holdout') AS p0,
        avg(CAST(y_true AS DOUBLE)) AS pp, sum(CASE WHEN arm = 'holdout' THEN 0e0 WHEN tier = 'contact_now' THEN 5e0 WHEN tier = 'nudge' THEN 0.5e0 ELSE 0e0 END) AS spend
        FROM arms GROUP BY ROLLUP (tier))))""", "scored", ctes=_ARMS))
def experiment_readout(t: Tables) -> DataFrame:
    return experiment.experiment_readout(experiment.assign_holdout(scored_table(t), 3000), label="y_true")


@query("contact_rate_by_group", oracle(
    f"""SELECT CASE WHEN grouping(band) = 1 THEN 'all' ELSE band END AS age_band, CASE WHEN grouping(gender) = 1 THEN 'all' ELSE gender END AS gender,
    count(*) AS n, CAST(sum(c) AS BIGINT) AS contacted, {r6('sum(c) / CAST(count(*) AS DOUBLE)', 'contact_rate')} FROM (
      SELECT CASE WHEN bd IS NULL THEN 'unknown' WHEN bd < 25 THEN '10-24' WHEN bd < 35 THEN '25-34' WHEN bd < 50 THEN '35-49' ELSE '50+' END AS band, gender,
      CAST(floor(p * 10000 + 0.5) / 10000 >= 0.2058e0 AS INT) AS c FROM explained JOIN (SELECT msno, bd, gender FROM model_table) USING (msno))
    GROUP BY CUBE (band, gender)""", "model_table", ctes=_CARD))
def contact_rate_by_group(t: Tables) -> DataFrame:
    rows = _card(t, False)
    return experiment.contact_rate_by_group(
        rows, F.col("y_proba") >= 0.2058, {"age_band": experiment.age_band(F.col("bd")), "gender": F.col("gender")})
