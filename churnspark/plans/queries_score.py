"""Registered queries: metrics, ranking, policy, economics, scorecard, ensembles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import scorecard as S
from churnspark.operators import metrics, models, policy
from churnspark.operators.rank import global_rank
from churnspark.plans.adapters import Tables
from churnspark.plans.registry import oracle, query, r6
from churnspark.sources.io import probability_column

KS = (500, 1000, 2000)
K = 1000
RANKED = "ranked AS (SELECT *, row_number() OVER (ORDER BY y_proba DESC, id) AS rank FROM scored)"


def scored_table(t: Tables) -> DataFrame:
    return t.scored.select("id", "y_true", F.col("y_proba").cast("double").alias("y_proba"))


# ---- confusion, sweep ----------------------------------------------------------------------------------------------

_CONFUSION = """SELECT count(*) FILTER (s >= 0.31e0 AND y_true = 1) AS tp, count(*) FILTER (s >= 0.31e0 AND y_true = 0) AS fp,
  count(*) FILTER (s < 0.31e0 AND y_true = 1) AS fn, count(*) FILTER (s < 0.31e0 AND y_true = 0) AS tn
  FROM (SELECT y_true, coalesce(y_proba, -1) AS s FROM scored)"""


@query("confusion_at", oracle(_CONFUSION, "scored"))
def confusion_at(t: Tables) -> DataFrame:
    return metrics.confusion_at(scored_table(t), 0.31)


@query("binary_metrics", oracle(
    f"""SELECT tp, fp, fn, tn, {r6('(tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE)', 'accuracy')},
    {r6('CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END', 'precision')},
    {r6('CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END', 'recall')},
    {r6('CASE WHEN tp > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END', 'f1')} FROM ({_CONFUSION})""", "scored"))
def binary_metrics(t: Tables) -> DataFrame:
    return metrics.binary_metrics(scored_table(t), 0.31)


def _sweep_sql(v: float = 120.0, c: float = 5.0, s: float = 0.2) -> tuple[str, ...]:
    return ("""counts AS (SELECT CAST(i AS DOUBLE)/100 AS threshold,
        count(*) FILTER (y_proba >= CAST(i AS DOUBLE)/100 AND y_true = 1) AS tp,
        count(*) FILTER (y_proba >= CAST(i AS DOUBLE)/100 AND y_true = 0) AS fp,
        count(*) FILTER (coalesce(y_proba, -1) < CAST(i AS DOUBLE)/100 AND y_true = 1) AS fn,
        count(*) FILTER (y_proba >= CAST(i AS DOUBLE)/100) AS n_targeted
        FROM scored, range(1, 100) g(i) GROUP BY i)""",
        """pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
        CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall FROM counts)""",
        f"""sweep AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END
        AS f1, tp * {s!r}e0 * {v!r}e0 - n_targeted * {c!r}e0 AS roi FROM pr)""")


_SWEEP_COLUMNS = ", ".join(["tp", "fp", "fn", "n_targeted"] + [r6(c, c) for c in ("threshold", "precision", "recall", "f1")])


@query("threshold_sweep", oracle(f"SELECT {_SWEEP_COLUMNS}, {r6('roi', 'roi')} FROM sweep", "scored", ctes=_sweep_sql()))
def threshold_sweep(t: Tables) -> DataFrame:
    return metrics.threshold_sweep(scored_table(t))


@query("best_threshold", oracle(
    f"""SELECT 'roi_max' AS selected_by, {_SWEEP_COLUMNS}, {r6('roi', 'roi')} FROM (SELECT * FROM sweep ORDER BY roi DESC, threshold LIMIT 1)
    UNION ALL SELECT 'closest_to_capacity', {_SWEEP_COLUMNS}, {r6('roi', 'roi')} FROM
    (SELECT * FROM sweep ORDER BY abs(n_targeted - 1000), threshold LIMIT 1)""", "scored", ctes=_sweep_sql()))
def best_threshold(t: Tables) -> DataFrame:
    return metrics.best_threshold(metrics.threshold_sweep(scored_table(t)), K)


@query("best_f1_threshold", oracle(
    f"""SELECT tp, fp, fn, {r6('threshold', 'threshold')}, {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')}
    FROM (SELECT * FROM sweep WHERE threshold BETWEEN 0.05e0 AND 0.95e0 ORDER BY f1 DESC, threshold LIMIT 1)""",
    "scored", ctes=_sweep_sql()))
def best_f1_threshold(t: Tables) -> DataFrame:
    return metrics.best_f1_threshold(scored_table(t))


@query("sweep_by_scenario", oracle(
    f"""SELECT s.scenario, {_SWEEP_COLUMNS}, {r6('v', 'value_per_save')}, {r6('c', 'cost_per_contact')}, {r6('s', 'save_rate')},
    {r6('tp * s * v - n_targeted * c', 'roi')} FROM pr2, (VALUES ('offer', 60.0e0, 10.0e0, 0.2e0), ('outreach', 80.0e0, 0.5e0, 0.12e0)) s(scenario, v, c, s)""",
    "scored", ctes=(*_sweep_sql()[:2], """pr2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN
      2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)""")))
def sweep_by_scenario(t: Tables) -> DataFrame:
    return metrics.sweep_by_scenario(metrics.threshold_sweep(scored_table(t)))


# ---- ranking quality -----------------------------------------------------------------------------------------------

GROUPS = """groups AS (SELECT y_proba, count(*) AS n, sum(y_true) AS pos FROM scored GROUP BY y_proba),
  cum AS (SELECT *, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos, sum(n) OVER () AS all_n, sum(pos) OVER () AS all_pos
    FROM groups WINDOW w AS (ORDER BY y_proba DESC))"""
AUC = "sum((n - pos) * (cum_pos - pos / 2.0e0)) / (CAST(max(all_pos) AS DOUBLE) * CAST(max(all_n) - max(all_pos) AS DOUBLE))"
AP = "sum(pos * CAST(cum_pos AS DOUBLE) / CAST(cum_n AS DOUBLE)) / max(all_pos)"


@query("roc_auc", oracle(f"SELECT {r6(AUC, 'roc_auc')} FROM cum", "scored", ctes=(GROUPS,)))
def roc_auc(t: Tables) -> DataFrame:
    return metrics.ranking_metrics(scored_table(t)).select("roc_auc")


@query("average_precision", oracle(
    f"SELECT CAST(max(all_n) AS BIGINT) AS n, CAST(max(all_pos) AS BIGINT) AS positives, {r6(AP, 'average_precision')} FROM cum",
    "scored", ctes=(GROUPS,)))
def average_precision(t: Tables) -> DataFrame:
    return metrics.ranking_metrics(scored_table(t)).select("n", "positives", "average_precision")


@query("score_summary", oracle(
    f"SELECT {r6('min(y_proba)', 'proba_min')}, " + ", ".join(
        r6(f"quantile_cont(y_proba, {q})", f"proba_{n}")
        for n, q in (("p01", .01), ("p05", .05), ("p50", .5), ("p95", .95), ("p99", .99)))
    + f", {r6('max(y_proba)', 'proba_max')}, {r6('avg(y_proba)', 'proba_mean')} FROM scored", "scored"))
def score_summary(t: Tables) -> DataFrame:
    return metrics.score_summary(scored_table(t))


@query("score_histogram", oracle(
    f"""SELECT CAST(b AS INT) AS bin, {r6('(b + 0.5e0) / 20', 'center')}, count(id) AS n FROM range(20) g(b)
    LEFT JOIN scored ON y_proba IS NOT NULL AND least(floor(y_proba * 20), 19) = b GROUP BY b
    UNION ALL SELECT -1, NULL, count(*) FROM scored WHERE y_proba IS NULL HAVING count(*) > 0""", "scored"))
def score_histogram(t: Tables) -> DataFrame:
    return metrics.score_histogram(scored_table(t))


@query("global_rank", oracle(f"SELECT id, y_true, {r6('y_proba', 'y_proba')}, rank FROM ranked", "scored", ctes=(RANKED,)))
def global_rank_(t: Tables) -> DataFrame:
    return global_rank(scored_table(t))


@query("rank_by_segment", oracle(
    """SELECT id, segment, row_number() OVER (PARTITION BY segment ORDER BY y_proba DESC, id) AS rank FROM scored""", "scored"))
def rank_by_segment(t: Tables) -> DataFrame:
    rows = t.scored.select("id", "segment", F.col("y_proba").cast("double").alias("y_proba"))
    return global_rank(rows, by=["segment"]).select("id", "segment", "rank")


@query("topk_target", oracle(
    f"""SELECT id, y_true, {r6('y_proba', 'y_proba')}, rank, CAST(rank <= 1000 AS INT) AS churn_label, 'top_k(1000)' AS policy_used,
    CAST(NULL AS DOUBLE) AS threshold_used FROM ranked""", "scored", ctes=(RANKED,)))
def topk_target(t: Tables) -> DataFrame:
    return policy.apply_top_k(scored_table(t), K)


@query("top_table", oracle(
    f"SELECT id, y_true, {r6('y_proba', 'y_proba')}, rank FROM ranked WHERE rank <= 100 ORDER BY rank", "scored", ctes=(RANKED,)))
def top_table(t: Tables) -> DataFrame:
    return policy.table_of_top(scored_table(t), 100)


_TOPK = """SELECT k, count(*) AS n_targeted, CAST(sum(y_true) AS BIGINT) AS tp, min(y_proba) AS cutoff
  FROM ranked, (VALUES (500), (1000), (2000)) g(k) WHERE rank <= k GROUP BY k"""


@query("topk_metrics", oracle(
    f"""SELECT k, n_targeted, tp, {r6('tp / CAST(n_targeted AS DOUBLE)', 'precision')}, {r6('tp / CAST(p AS DOUBLE)', 'recall')},
    {r6('(tp / CAST(n_targeted AS DOUBLE)) / (p / CAST(n AS DOUBLE))', 'lift')}, {r6('cutoff', 'cutoff_score')}
    FROM ({_TOPK}), (SELECT sum(y_true) AS p, count(*) AS n FROM scored)""", "scored", ctes=(RANKED,)))
def topk_metrics(t: Tables) -> DataFrame:
    return metrics.topk_metrics(scored_table(t), KS)


@query("equiv_threshold", oracle(
    f"""SELECT CAST(1000 AS INT) AS k, count(*) AS n_targeted, {r6('min(y_proba)', 'equiv_threshold')},
    CAST(NULL AS DOUBLE) AS recorded_threshold FROM ranked WHERE rank <= 1000""", "scored", ctes=(RANKED,)))
def equiv_threshold(t: Tables) -> DataFrame:
    return metrics.equiv_threshold(scored_table(t), K)


_CURVE_KS = (50, 126, 148, 500, 1000, 2000)
CURVE = ("""curve AS (SELECT DISTINCT * FROM (SELECT CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS tp, CAST(NULL AS DOUBLE) AS threshold UNION ALL
  SELECT count(*), CAST(sum(y_true) AS BIGINT), min(y_proba) FROM ranked, (SELECT unnest([50,126,148,500,1000,2000]) AS kk UNION
  SELECT count(*) FROM scored) WHERE rank <= kk GROUP BY kk))""",)


def _curve(t: Tables) -> DataFrame:
    return metrics.operating_curve(scored_table(t), _CURVE_KS)


@query("operating_curve", oracle(f"SELECT k, tp, {r6('threshold', 'threshold')} FROM curve", "scored", ctes=(RANKED, *CURVE)))
def operating_curve(t: Tables) -> DataFrame:
    return _curve(t)


@query("evaluate", oracle(
    f"""SELECT CAST(max(all_n) AS BIGINT) AS valid_rows, CAST(max(all_pos) AS BIGINT) AS positives,
    {r6('max(all_pos) / CAST(max(all_n) AS DOUBLE)', 'valid_churn_rate')}, {r6(AUC, 'roc_auc')}, {r6(AP, 'average_precision')},
    (SELECT {r6('tp / CAST(tp + fp AS DOUBLE)', 'x')} FROM pr WHERE threshold = 0.5e0) AS precision,
    (SELECT {r6('tp / CAST(tp + fn AS DOUBLE)', 'x')} FROM pr WHERE threshold = 0.5e0) AS recall,
    (SELECT {r6('2 * precision * recall / (precision + recall)', 'x')} FROM pr WHERE threshold = 0.5e0) AS f1,
    (SELECT {r6('(tp + (SELECT count(*) FROM scored) - tp - fp - fn) / CAST((SELECT count(*) FROM scored) AS DOUBLE)', 'x')} FROM pr WHERE threshold = 0.5e0) AS accuracy,
    (SELECT {r6('sum(y_true) / 1000e0', 'x')} FROM ranked WHERE rank <= 1000) AS precision_at_1000,
    (SELECT {r6('sum(y_true) / CAST((SELECT sum(y_true) FROM scored) AS DOUBLE)', 'x')} FROM ranked WHERE rank <= 1000) AS recall_at_1000,
    {r6('0.5', 'threshold')}, 'fixed_date' AS split_method, '2001-05-31' AS cutoff_date FROM cum""", "scored", ctes=(RANKED, GROUPS, *_sweep_sql()[:2])))
def evaluate(t: Tables) -> DataFrame:
    return metrics.evaluate(scored_table(t), 0.5, KS, split=("fixed_date", "2001-05-31")).withColumns({
        "precision_at_1000": F.col("precision_at_k")[K], "recall_at_1000": F.col("recall_at_k")[K],
    }).drop("precision_at_k", "recall_at_k")


@query("majority_baseline", oracle(
    f"""SELECT msno, is_churn AS y_true, {r6('r', 'y_proba')}, CAST(r >= 0.5 AS INT) AS y_pred FROM train,
    (SELECT avg(CAST(is_churn AS DOUBLE)) AS r FROM train WHERE msno % 5 <> 0) WHERE msno % 5 = 0""", "train"))
def majority_baseline(t: Tables) -> DataFrame:
    return metrics.majority_baseline(t.train.where("msno % 5 <> 0"), t.train.where("msno % 5 = 0"))


# ---- policy and economics ------------------------------------------------------------------------------------------


def action_sql(score: str = "y_proba") -> str:
    return f"CASE WHEN {score} >= 0.68e0 THEN 'contact_now' WHEN {score} >= 0.2058e0 THEN 'nudge' ELSE 'monitor' END"


TIERS = (f"""tiers AS (SELECT * FROM (VALUES (0, 'contact_now', 0.68e0, 1.0e0, 5.0e0, 0.2e0), (1, 'nudge', 0.2058e0, 0.68e0, 0.5e0, 0.12e0),
  (2, 'monitor', 0.0e0, 0.2058e0, 0.0e0, 0.0e0)) v(tier, action, lo, hi, cost, save)
  JOIN (SELECT {action_sql()} AS action, count(*) AS n, CAST(sum(y_true) AS BIGINT) AS churners FROM scored GROUP BY 1) USING (action))""",)


@query("apply_threshold", oracle(
    f"""SELECT id, y_true, {r6('y_proba', 'y_proba')}, CAST(coalesce(y_proba, -1) >= 0.68e0 AS INT) AS churn_label,
    CASE WHEN y_proba >= 0.68e0 THEN 'target' ELSE 'no_target' END AS action, {r6('0.68', 'threshold_used')},
    'threshold' AS policy_used FROM scored""", "scored"))
def apply_threshold(t: Tables) -> DataFrame:
    return policy.apply_threshold(scored_table(t))


@query("assign_action", oracle(f"SELECT id, y_true, {r6('y_proba', 'y_proba')}, {action_sql()} AS action FROM scored", "scored"))
def assign_action(t: Tables) -> DataFrame:
    return policy.assign_action(scored_table(t))


@query("tier_calibration", oracle(
    f"""SELECT tier, action, n, churners, {r6('lo', 'min_score')}, {r6('hi', 'max_score')}, {r6('churners / CAST(n AS DOUBLE)', 'observed_rate')},
    churners / CAST(n AS DOUBLE) >= lo AND (tier = 0 OR churners / CAST(n AS DOUBLE) < hi) AS within_range FROM tiers""",
    "scored", ctes=TIERS))
def tier_calibration(t: Tables) -> DataFrame:
    return policy.tier_calibration(policy.tier_counts(scored_table(t)))


_NET = "churners * save * 120e0 - n * cost"


@query("tier_economics", oracle(
    f"""SELECT tier, action, n, churners, {r6('n * cost', 'spend')}, {r6('churners * save', 'expected_saves')}, {r6(_NET, 'net')},
    {r6(f'sum({_NET}) OVER ()', 'total_net')},
    {r6(f'CASE WHEN max(CASE WHEN tier = 0 THEN {_NET} END) OVER () > 0 THEN sum({_NET}) OVER () / max(CASE WHEN tier = 0 THEN {_NET} END) OVER () - 1 END', 'uplift_vs_first_tier')}
    FROM tiers""", "scored", ctes=TIERS))
def tier_economics(t: Tables) -> DataFrame:
    return policy.tier_economics(policy.tier_counts(scored_table(t)))


@query("policy_compare", oracle(
    f"""SELECT policy, {r6('contacts * 1000000e0 / base', 'contacts')}, {r6('churners * 1000000e0 / base', 'churners')},
    {r6('spend * (1000000e0 / base)', 'spend')}, {r6('net * (1000000e0 / base)', 'net')}, net = max(net) OVER () AND net > 0 AS is_best FROM (
      SELECT 'threshold_only' AS policy, n AS contacts, churners, n * 5e0 AS spend, churners * 0.2e0 * 120e0 - n * 5e0 AS net
        FROM tiers WHERE tier = 0
      UNION ALL SELECT 'top_k_single_channel', count(*), sum(y_true), count(*) * 5e0, sum(y_true) * 0.2e0 * 120e0 - count(*) * 5e0 FROM ranked WHERE rank <= 1000
      UNION ALL SELECT 'tiered', sum(n), sum(churners), sum(n * cost), sum({_NET}) FROM tiers WHERE tier < 2),
    (SELECT count(*) AS base FROM scored)""", "scored", ctes=(*TIERS, RANKED)))
def policy_compare(t: Tables) -> DataFrame:
    rows = scored_table(t)
    return policy.policy_compare(policy.tier_counts(rows), subscribers=1_000_000, capacity=metrics.topk_metrics(rows, [K]))


@query("contact_plan", oracle(
    f"""SELECT tier, action, {r6('n / CAST(sum(n) OVER () AS DOUBLE) * 1000000', 'customers')},
    {r6('n / CAST(sum(n) OVER () AS DOUBLE)', 'share')}, {r6('churners * 1000000e0 / sum(n) OVER ()', 'churners')} FROM tiers""",
    "scored", ctes=TIERS))
def contact_plan(t: Tables) -> DataFrame:
    return policy.contact_plan(policy.tier_counts(scored_table(t)))


_POINTS = ("""asked AS (SELECT DISTINCT k FROM (SELECT CAST(floor(exp(ln(50e0) + (ln(5000e0) - ln(50e0)) * i / 29) + 0.5) AS BIGINT) AS k
    FROM range(30) g(i) UNION ALL SELECT unnest([148, 1000])))""",
           """segments AS (SELECT k AS a_k, tp AS a_tp, lead(k) OVER (ORDER BY k) AS b_k, lead(tp) OVER (ORDER BY k) AS b_tp FROM curve)""",
           """points AS (SELECT CAST(q.k AS DOUBLE) AS k, coalesce(CASE WHEN q.k = s.a_k OR s.b_k IS NULL THEN s.a_tp ELSE
    s.a_tp + (q.k - s.a_k) / CAST(s.b_k - s.a_k AS DOUBLE) * (s.b_tp - s.a_tp) END, 0) AS tp
    FROM asked q JOIN segments s ON q.k >= s.a_k AND (s.b_k IS NULL OR q.k < s.b_k))""")


def _points(t: Tables) -> DataFrame:
    return policy.tp_at_k(_curve(t), policy.k_grid(t.spark, 50, 5000, 30, (148, 1000)))


@query("tp_at_k", oracle(f"SELECT {r6('k', 'k')}, {r6('tp', 'tp')} FROM points", "scored", ctes=(RANKED, *CURVE, *_POINTS)))
def tp_at_k(t: Tables) -> DataFrame:
    return _points(t)


_SCENARIOS = ({"value_per_save": 120.0, "cost_per_contact": 5.0, "save_rate": 0.2, "subscribers": 1_000_000},
              {"value_per_save": 5.0, "cost_per_contact": 0.01, "save_rate": 0.9, "subscribers": 10})


@query("scenario_grid", oracle(
    "SELECT " + ", ".join(r6(e, n) for n, e in {
        "k": "k", "tp": "tp", "value_per_save": "v", "cost_per_contact": "c", "save_rate": "s", "subscribers": "subs",
        "precision": "tp / k", "recall": "tp / p", "value_saved": "tp * s * v", "spend": "k * c",
        "net": "tp * s * v - k * c", "random_net": "k * (p / n) * s * v - k * c", "lift": "(tp / k) / (p / n)",
        "return_on_spend": "(tp * s * v) / (k * c)", "net_roi": "(tp * s * v - k * c) / (k * c)",
        "break_even_save_rate": "CASE WHEN tp > 0 THEN (k * c) / (tp * v) END", "break_even_cost": "(tp * s * v) / k",
        "revenue_at_risk": "p * v * subs / n", "net_scaled": "(tp * s * v - k * c) * subs / n"}.items())
    + """ FROM points, (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(y_true) AS DOUBLE) AS p FROM scored),
    (VALUES (120e0, 5e0, 0.2e0, 1000000e0), (5e0, 0.01e0, 0.9e0, 10e0)) z(v, c, s, subs)""",
    "scored", ctes=(RANKED, *CURVE, *_POINTS)))
def scenario_grid(t: Tables) -> DataFrame:
    base = scored_table(t).agg(F.count(F.lit(1)).alias("n"), F.sum("y_true").alias("positives"))
    return policy.scenario_grid(_points(t), base, _SCENARIOS)


@query("expected_roi", oracle(
    f"""SELECT scenario, CAST(1000 AS INT) AS k, n AS n_targeted, {r6('tp / CAST(n AS DOUBLE)', 'precision')}, {r6('v', 'value_per_save')},
    {r6('c', 'cost_per_contact')}, {r6('s', 'save_rate')}, {r6('tp', 'expected_churners')}, {r6('tp * s', 'expected_saves')},
    {r6('tp * s * v', 'benefit')}, {r6('n * c', 'cost')}, {r6('tp * s * v - n * c', 'net')}, {r6('(tp * s * v - n * c) / n', 'net_per_target')}
    FROM (SELECT count(*) AS n, sum(y_true) AS tp FROM ranked WHERE rank <= 1000),
    (VALUES ('offer', 60.0e0, 10.0e0, 0.2e0), ('outreach', 80.0e0, 0.5e0, 0.12e0)) z(scenario, v, c, s)""", "scored", ctes=(RANKED,)))
def expected_roi(t: Tables) -> DataFrame:
    at = metrics.topk_metrics(scored_table(t), [K]).select("k", "n_targeted", "precision")
    table = F.array(*[F.struct(F.lit(n).alias("scenario"), *[F.lit(v).alias(k) for k, v in s.items()])
                      for n, s in C.SCENARIOS.items()])
    return policy.expected_roi(at.select("*", F.inline(table)))


@query("sensitivity", oracle(
    f"""SELECT {r6('k', 'k')}, {r6('tp', 'tp')}, {r6('base', 'base')}, driver, {r6('lo', 'low')}, {r6('hi', 'high')}, {r6('abs(hi - lo)', 'swing')},
    top - abs(hi - lo) < 1e-6 * greatest(1, top) AS is_leader,
    CAST(1 + (SELECT count(*) FROM bars b WHERE b.k = z.k AND
      abs(b.hi - b.lo) - abs(z.hi - z.lo) >= 1e-6 * greatest(1, top)) AS INT) AS rank FROM (SELECT *, max(abs(hi - lo)) OVER (PARTITION BY k) AS top FROM bars) z""",
    "scored", ctes=(RANKED, *CURVE, *_POINTS, """priced AS (SELECT k, tp, tp * 0.2e0 * 120e0 - k * 5e0 AS base FROM points)""",
                    """bars AS (SELECT k, tp, base, 'save_rate' AS driver, tp * 0.1e0 * 120e0 - k * 5e0 - base AS lo, tp * 0.30000000000000004e0 * 120e0 - k * 5e0 - base AS hi FROM priced
    UNION ALL SELECT k, tp, base, 'value_per_save', tp * 0.2e0 * 60e0 - k * 5e0 - base, tp * 0.2e0 * 180e0 - k * 5e0 - base FROM priced
    UNION ALL SELECT k, tp, base, 'cost_per_contact', tp * 0.2e0 * 120e0 - k * 7.5e0 - base, tp * 0.2e0 * 120e0 - k * 2.5e0 - base FROM priced)""")))
def sensitivity(t: Tables) -> DataFrame:
    return policy.sensitivity(_points(t))


@query("batch_summary", oracle(
    f"""SELECT (SELECT count(*) FROM scored) AS n, (SELECT count(*) FROM scored WHERE y_proba >= 0.68e0) AS n_above_threshold,
    count(*) AS n_top_k, {r6('sum(y_proba * 0.2e0)', 'expected_saves')}, {r6('sum(y_proba * 0.2e0) * 120 - count(*) * 5', 'expected_net')},
    {r6('min(y_proba)', 'cutoff')} FROM ranked WHERE rank <= 1000""", "scored", ctes=(RANKED,)))
def batch_summary(t: Tables) -> DataFrame:
    return policy.batch_summary(scored_table(t), K)


# ---- scorecard -----------------------------------------------------------------------------------------------------

CARD_DAY = 20010715


def _day_sql(c: str) -> str:
    return (f"CASE WHEN {c} BETWEEN 19000101 AND 21001231 THEN CAST(date_diff('day', DATE '1970-01-01', "
            f"make_date({c} // 10000, ({c} // 100) % 100, {c} % 100)) AS DOUBLE) END")


def _pct_sql(x: str) -> str:
    return f"(CAST(CAST(floor(({x}) * 100 + 0.5) AS BIGINT) AS VARCHAR) || '%')"


def _n_sql(x: str, word: str) -> str:
    return f"(CAST(CAST({x} AS BIGINT) AS VARCHAR) || ' {word}' || CASE WHEN {x} = 1 THEN '' ELSE 's' END)"


def _cl(x: str, lo: float, hi: float) -> str:
    return f"least(greatest({x}, {lo}), {hi})"


_CUT = "11518e0"  # day number of CARD_DAY
_CARD = (
    f"""inputs AS (SELECT msno, auto_renew_rate AS ar, cancel_rate AS cr, {_day_sql('membership_expire_date_max')} - {_CUT} AS gap,
      {_CUT} - ({_day_sql('log_last_date')}) AS since, CAST(txn_cnt AS DOUBLE) AS t, CAST(log_active_days AS DOUBLE) AS d,
      plan_list_price_mean AS lp, actual_paid_mean AS ap, listen_full_share AS fs, total_secs_mean_per_active_day AS secs
      FROM model_table)""",
    f"""points AS (SELECT *, 2.4e0 * (1 - {_cl('ar', 0, 1)}) AS l0, 1.6e0 * {_cl('cr', 0, 1)} AS l1,
      CASE WHEN gap < 0 THEN 1.2e0 + 0.03e0 * least(-gap, 30) WHEN gap > 45 THEN -1.2e0 WHEN gap IS NOT NULL THEN 0.3e0 - 0.015e0 * gap END AS l2,
      CASE WHEN since IS NOT NULL THEN 0.045e0 * {_cl('since - 7', 0, 60)} END AS l3,
      -0.06e0 * {_cl('t', 0, 20)} + CASE WHEN t <= 2 THEN 0.7e0 ELSE 0 END AS l4,
      -0.0015e0 * {_cl('d', 0, 400)} + CASE WHEN d < 15 THEN 0.6e0 ELSE 0 END AS l5,
      CASE WHEN lp > 0 AND ap < 0.75e0 * lp THEN 0.6e0 END AS l6, 1.2e0 * (0.7e0 - {_cl('fs', 0, 1)}) AS l7,
      0.3e0 - 0.00008e0 * {_cl('secs', 0, 10000)} AS l8 FROM inputs)""",
    """card AS (SELECT *, -3e0 + l0 + l1 + coalesce(l2, 0) + coalesce(l3, 0) + l4 + l5 + coalesce(l6, 0) + l7 + l8 AS z FROM points)""",
    """explained AS (SELECT *, 1 / (1 + exp(-z)) AS p, CASE WHEN abs(z + 3) < 1e-9 THEN (1 / (1 + exp(-z))) * (1 - 1 / (1 + exp(-z)))
      ELSE (1 / (1 + exp(-z)) - 1 / (1 + exp(3e0))) / (z + 3) END AS slope FROM card)""",
)
# The reason texts.
_TEXTS = {
    "auto_renew_rate": (0, f"'Auto-renew on ' || {_pct_sql(_cl('ar', 0, 1))} || ' of payments'"),
    "cancel_rate": (1, f"'Cancelled ' || {_pct_sql(_cl('cr', 0, 1))} || ' of transactions'"),
    "membership_expire_date_max": (2, f"CASE WHEN gap < 0 THEN 'Membership lapsed ' || {_n_sql('-gap', 'day')} || ' ago' "
                                      f"WHEN gap = 0 THEN 'Membership expires today' ELSE 'Membership runs ' || {_n_sql('gap', 'more day')} END"),
    "log_last_date": (3, f"'Last listened ' || {_n_sql('greatest(since, 0)', 'day')} || ' ago'"),
    "txn_cnt": (4, f"{_n_sql('t', 'transaction')} || ' on record'"),
    "log_active_days": (5, _n_sql("d", "active listening day")),
    "actual_paid_mean": (6, f"'Paying ' || {_pct_sql('1 - ap / lp')} || ' below list price'"),
    "listen_full_share": (7, f"{_pct_sql(_cl('fs', 0, 1))} || ' of plays heard to the end'"),
    "total_secs_mean_per_active_day": (8, "CAST(CAST(floor(greatest(secs, 0) / 3600 * 10 + 0.5) AS BIGINT) // 10 AS VARCHAR) || '.' || "
                                          "CAST(CAST(floor(greatest(secs, 0) / 3600 * 10 + 0.5) AS BIGINT) % 10 AS VARCHAR) || ' h listening per active day'"),
}
_TERMS = "terms AS (" + " UNION ALL ".join(
    f"SELECT msno, p, slope, {i} AS place, '{f}' AS id, {text} AS text, l{i} AS contribution, l{i} * slope AS impact FROM explained WHERE l{i} IS NOT NULL"
    for f, (i, text) in _TEXTS.items()) + ")"
_REASONS = """reasons AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY abs(impact) DESC, place) - 1 AS pos
  FROM terms WHERE abs(impact) >= 0.002e0))"""


def _card(t: Tables, keep_terms: bool = True) -> DataFrame:
    return S.with_scorecard(t.model_table, CARD_DAY, keep_terms)


@query("scorecard", oracle(
    f"SELECT msno, {r6('z', 'logit')}, {r6('floor(p * 10000 + 0.5) / 10000', 'y_proba')} FROM explained", "model_table", ctes=_CARD))
def scorecard(t: Tables) -> DataFrame:
    return _card(t, False).select("msno", "logit", "y_proba")


@query("scorecard_reasons", oracle(
    f"SELECT msno, CAST(pos AS INT) AS pos, id, text, {r6('impact', 'impact')} FROM reasons WHERE pos < 5", "model_table",
    ctes=(*_CARD, _TERMS, _REASONS)))
def scorecard_reasons(t: Tables) -> DataFrame:
    rows = _card(t).withColumn("reasons", S.reasons(5))
    return S.rows_of(rows, ["msno"], "reasons")


def contributions(t: Tables) -> DataFrame:
    return _card(t).select("msno", "logit", F.transform("terms", lambda x: F.struct(
        x["id"].alias("feature"), x["logit"].alias("contribution"))).alias("contributions"))


@query("contrib_points", oracle(
    f"SELECT msno, id AS feature, {r6('contribution', 'contribution')}, {r6('impact', 'impact')} FROM terms", "model_table",
    ctes=(*_CARD, _TERMS)))
def contrib_points(t: Tables) -> DataFrame:
    pts = S.contribution_points(F.col("contributions"), F.lit(S.BASE_LOGIT), 1 / (1 + F.exp(-F.col("logit"))))
    return S.rows_of(contributions(t), ["msno"], pts).drop("pos")


@query("contrib_topn", oracle(
    f"""SELECT msno, CAST(pos AS INT) AS pos, id AS feature, {r6('contribution', 'contribution')} FROM (SELECT *,
    row_number() OVER (PARTITION BY msno ORDER BY abs(contribution) DESC, place) - 1 AS pos FROM terms) WHERE pos < 5""",
    "model_table", ctes=(*_CARD, _TERMS)))
def contrib_topn(t: Tables) -> DataFrame:
    return S.rows_of(contributions(t), ["msno"], S.top_contributions(F.col("contributions"), 5))


@query("global_importance", oracle(
    f"SELECT id AS feature, {r6('avg(abs(contribution))', 'mean_abs_contribution')} FROM terms GROUP BY id", "model_table",
    ctes=(*_CARD, _TERMS)))
def global_importance(t: Tables) -> DataFrame:
    return models.global_importance(contributions(t))


@query("campaign_export", oracle(
    f"""SELECT msno, row_number() OVER (ORDER BY floor(p * 10000 + 0.5) / 10000 DESC, msno) AS rank,
    {r6('floor(p * 10000 + 0.5) / 10000', 'churn_probability')}, CAST(floor(p * 10000 + 0.5) / 10000 >= 0.68e0 AS INT) AS label_at_threshold,
    CAST(row_number() OVER (ORDER BY floor(p * 10000 + 0.5) / 10000 DESC, msno) <= 1000 AS INT) AS in_top_k,
    {action_sql('floor(p * 10000 + 0.5) / 10000')} AS risk_band,
    CASE {action_sql('floor(p * 10000 + 0.5) / 10000')} WHEN 'contact_now' THEN 'personal outreach with retention incentive'
      WHEN 'nudge' THEN 'low-cost email or in-app nudge' ELSE 'none; re-score next cycle' END AS suggested_action,
    coalesce((SELECT string_agg(text || ' (' || CASE WHEN impact >= 0 THEN '+' ELSE '−' END || CASE WHEN floor(abs(impact) * 100 + 0.5) = 0
      THEN '<1 pt' ELSE CAST(CAST(floor(abs(impact) * 100 + 0.5) AS BIGINT) AS VARCHAR) || ' pts' END || ')', '; ' ORDER BY pos)
      FROM reasons r WHERE r.msno = e.msno AND pos < 3), '') AS top_reasons, {r6('auto_renew_rate', 'auto_renew_rate')}, txn_cnt, gender
    FROM explained e JOIN (SELECT msno, auto_renew_rate, txn_cnt, gender FROM model_table) USING (msno)""", "model_table",
    ctes=(*_CARD, _TERMS, _REASONS)))
def campaign_export(t: Tables) -> DataFrame:
    rows = t.model_table.select("msno", *[c for c in t.model_table.columns if c != "msno"])
    out = policy.decide_batch(rows, K, id="msno", cutoff_day=CARD_DAY)
    return out.select("msno", "rank", "churn_probability", "label_at_threshold", "in_top_k", "risk_band", "suggested_action", "top_reasons",
                      "auto_renew_rate", "txn_cnt", "gender")


# ---- ensembles -----------------------------------------------------------------------------------------------------


def _joined(t: Tables) -> DataFrame:
    parts = {}
    for name in ("a", "b", "c"):
        rows = t.adapt(f"model_{name}")
        parts[name] = rows.withColumn("y_proba", F.col(probability_column(rows)).cast("double"))
    return models.join_scores(parts)


_JOINED = """joined AS (SELECT a.id, a.y_true, CAST(a.y_proba AS DOUBLE) AS a, CAST(prob AS DOUBLE) AS b, CAST(p AS DOUBLE) AS c FROM model_a a
  JOIN model_b USING (id) JOIN model_c USING (id))"""


@query("softvote", oracle(
    f"""SELECT id, y_true, {r6("0e0 + CAST('0.4' AS DOUBLE) * a + CAST('0.4' AS DOUBLE) * b + CAST('0.2' AS DOUBLE) * c", 'y_proba')} FROM joined""",
    "model_a", "model_b", "model_c", ctes=(_JOINED,)))
def softvote(t: Tables) -> DataFrame:
    return models.soft_vote(_joined(t), ["a", "b", "c"], "manual", {"a": 2.0, "b": 2.0, "c": 1.0})


_AP_BY = """SELECT m, greatest(sum(pos * CAST(cum_pos AS DOUBLE) / CAST(cum_n AS DOUBLE)) / max(all_pos), 1e-6) AS ap FROM (
  SELECT *, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos, sum(pos) OVER (PARTITION BY m) AS all_pos FROM (
    SELECT m, s, count(*) AS n, sum(y_true) AS pos FROM long GROUP BY m, s) WINDOW w AS (PARTITION BY m ORDER BY s DESC)) GROUP BY m"""


@query("softvote_by_ap", oracle(
    f"""SELECT id, y_true, {r6('(wa * a + wb * b + wc * c) / (wa + wb + wc)', 'y_proba')} FROM joined,
    (SELECT max(CASE WHEN m = 'a' THEN ap END) AS wa, max(CASE WHEN m = 'b' THEN ap END) AS wb, max(CASE WHEN m = 'c' THEN ap END) AS wc FROM ap)""",
    "model_a", "model_b", "model_c", ctes=(_JOINED, """long AS (SELECT 'a' AS m, a AS s, y_true FROM joined UNION ALL SELECT 'b', b, y_true FROM joined
      UNION ALL SELECT 'c', c, y_true FROM joined)""", f"ap AS ({_AP_BY})")))
def softvote_by_ap(t: Tables) -> DataFrame:
    return models.soft_vote(_joined(t), ["a", "b", "c"], "prauc_proportional")


def _grid_sql(names: list[str], steps: int = 20) -> str:
    """All tuples of twentieths that sum to one, in lexicographic order, the last weight being the rest."""
    free = names[:-1]
    rest = f"{steps} - " + " - ".join(f"i_{m}" for m in free)
    every = ", ".join(f"range({steps + 1}) g_{m}(i_{m})" for m in free)
    weights = ", ".join(f"CAST(i_{m} AS DOUBLE) / {steps} AS w_{m}" for m in free) + f", CAST({rest} AS DOUBLE) / {steps} AS w_{names[-1]}"
    return (f"grid AS (SELECT CAST(row_number() OVER (ORDER BY {', '.join(f'i_{m}' for m in free)}) - 1 AS INT) AS grid_row, {weights} "
            f"FROM {every} WHERE {rest} >= 0)")


def _search_sql(names: list[str]) -> str:
    score = " + ".join(f"w_{m} * {m}" for m in names)
    return oracle(
        "SELECT grid_row, " + ", ".join(r6(f"w_{m}", f"w_{m}") for m in names) + f", {r6('ap', 'average_precision')} "
        "FROM grid JOIN ap ON grid_row = m", "model_a", "model_b", "model_c",
        ctes=(_JOINED, _grid_sql(names), f"long AS (SELECT grid_row AS m, {score} AS s, y_true FROM joined, grid)", f"ap AS ({_AP_BY})"))


@query("weight_search", _search_sql(["a", "b"]))
def weight_search(t: Tables) -> DataFrame:
    return models.weight_search(_joined(t), ["a", "b"])


@query("weight_search_three", _search_sql(["a", "b", "c"]))
def weight_search_three(t: Tables) -> DataFrame:
    return models.weight_search(_joined(t), ["a", "b", "c"])


def _winner_sql(names: list[str]) -> str:
    score = " + ".join(f"w_{m} * {m}" for m in names)
    return oracle(
        "SELECT grid_row, " + ", ".join(r6(f"w_{m}", f"w_{m}") for m in names) + f", {r6('ap', 'average_precision')} "
        "FROM grid JOIN ap ON grid_row = m ORDER BY round(ap, 12) DESC, grid_row LIMIT 1", "model_a", "model_b", "model_c",
        ctes=(_JOINED, _grid_sql(names), f"long AS (SELECT grid_row AS m, {score} AS s, y_true FROM joined, grid)", f"ap AS ({_AP_BY})"))


@query("weight_search_winner", _winner_sql(["a", "b", "c"]))
def weight_search_winner(t: Tables) -> DataFrame:
    return models.winning_weights(_joined(t), ["a", "b", "c"])
