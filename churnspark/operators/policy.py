"""Decision policy and campaign economics over scored tables.

Row-level work is one projection or one grouped count; everything priced afterwards is a table of a few tiers, points or
scenarios.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.functions.scorecard import reason_text, reasons, with_scorecard
from churnspark.operators.metrics import net_value
from churnspark.operators.rank import best_rows, clean_score, global_rank, reaches, top_k


def action_of(score: Column, policy: dict = C.POLICY) -> Column:
    """Action of the first tier whose minimum the score reaches; the last tier otherwise, and for a missing score."""
    tiers, score = policy["tiers"], clean_score(score)
    out = F.when(score >= float(tiers[0]["min_score"]), tiers[0]["action"])
    for tier in tiers[1:]:
        out = out.when(score >= float(tier["min_score"]), tier["action"])
    return out.otherwise(tiers[-1]["action"])


def tier_attribute(action: Column, name: str, policy: dict = C.POLICY) -> Column:
    """Cost, save rate, channel ... of an action."""
    out = None
    for tier in policy["tiers"]:
        value = F.lit(tier[name])
        out = F.when(action == tier["action"], value) if out is None else out.when(action == tier["action"], value)
    return out


def assign_action(df: DataFrame, policy: dict = C.POLICY, score: str = "y_proba") -> DataFrame:
    return df.withColumn("action", action_of(F.col(score), policy))


def apply_threshold(df: DataFrame, threshold: float = C.DEFAULT_THRESHOLD, score: str = "y_proba") -> DataFrame:
    hit = reaches(F.col(score), threshold)
    return df.withColumns({
        "churn_label": hit.cast("int"), "action": F.when(hit, "target").otherwise("no_target"),
        "threshold_used": F.lit(threshold), "policy_used": F.lit("threshold"),
    })


def apply_top_k(df: DataFrame, k: int, score: str = "y_proba", id: str = "id") -> DataFrame:
    """Ranks the whole batch and labels the top min(k, n)."""
    if k <= 0:
        raise ValueError("k must be > 0")
    return global_rank(df, score, id).withColumns({
        "churn_label": (F.col("rank") <= k).cast("int"), "policy_used": F.lit(f"top_k({k})"),
        "threshold_used": F.lit(C.OPS_CUTOFF if k == C.OPS_K else None).cast("double"),
    })


# ---- tiers ---------------------------------------------------------------------------------------------------------


def tier_counts(df: DataFrame, policy: dict = C.POLICY, score: str = "y_proba", label: str = "y_true") -> DataFrame:
    """(tier, action, n, churners) for every tier of the policy, empty tiers included."""
    counted = df.groupBy(action_of(F.col(score), policy).alias("action")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("churners")
    )
    return _all_tiers(df.sparkSession, policy).join(F.broadcast(counted), "action", "left").select(
        "tier", "action", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("churners", F.lit(0)).alias("churners"),
        "min_score", "max_score", "cost_per_contact", "assumed_save_rate",
    )


def _all_tiers(spark, policy: dict) -> DataFrame:
    tiers = policy["tiers"]
    table = F.array(*[
        F.struct(
            F.lit(i).alias("tier"), F.lit(t["action"]).alias("action"), F.lit(float(t["min_score"])).alias("min_score"),
            F.lit(1.0 if i == 0 else float(tiers[i - 1]["min_score"])).alias("max_score"),
            F.lit(float(t["cost_per_contact"])).alias("cost_per_contact"),
            F.lit(float(t["assumed_save_rate"])).alias("assumed_save_rate"),
        )
        for i, t in enumerate(tiers)
    ])
    return spark.range(1).select(F.inline(table))


def policy_counts(spark, policy: dict = C.POLICY) -> DataFrame:
    """The tier counts recorded in the policy document, in the shape of ``tier_counts``."""
    summary = policy["validation_summary"]
    recorded = F.array(*[
        F.struct(F.lit(a).alias("action"), F.lit(int(n)).cast("bigint").alias("n"),
                 F.lit(int(summary["tier_churners"][a])).cast("bigint").alias("churners"))
        for a, n in summary["tier_counts"].items()
    ])
    rows = spark.range(1).select(F.inline(recorded))
    return _all_tiers(spark, policy).join(F.broadcast(rows), "action")


def tier_calibration(counts: DataFrame) -> DataFrame:
    """Observed churn rate per tier against the tier's score range (information only, not a pass/fail gate)."""
    rate = X.ratio(F.col("churners").cast("double"), F.col("n"))
    inside = (rate >= F.col("min_score")) & ((F.col("tier") == 0) | (rate < F.col("max_score")))
    return counts.select(
        "tier", "action", "n", "churners", "min_score", "max_score", rate.alias("observed_rate"),
        F.coalesce(inside, F.lit(False)).alias("within_range"),
    )


def tier_economics(counts: DataFrame, value_per_save: float = C.VALUE_PER_SAVE) -> DataFrame:
    """Spend, expected saves and net value per tier, the total, and the uplift over the first tier alone."""
    tp, n = F.col("churners"), F.col("n")
    whole = Window.partitionBy(F.lit(0))
    priced = counts.select(
        "tier", "action", "n", "churners",
        (n * F.col("cost_per_contact")).alias("spend"), (tp * F.col("assumed_save_rate")).alias("expected_saves"),
        net_value(tp, n, value_per_save, F.col("cost_per_contact"), F.col("assumed_save_rate")).alias("net"),
    )
    first = F.max(F.when(F.col("tier") == 0, F.col("net"))).over(whole)
    return priced.withColumn("total_net", F.sum("net").over(whole)).withColumn(
        "uplift_vs_first_tier", X.ratio(F.col("total_net"), first) - 1
    )


def policy_compare(counts: DataFrame, value_per_save: float = C.VALUE_PER_SAVE,
                   subscribers: float | None = None, capacity: DataFrame | None = None) -> DataFrame:
    """Threshold only (first tier), fixed capacity through one channel, and tiered: contacts, churners, spend, net.

    ``capacity`` is one row (n_targeted, tp) of the top K, as ``metrics.topk_metrics`` gives it; without it the capacity is
    what the paid tiers contact. ``subscribers`` scales the figures from the counted base to another base size.
    """
    first = F.col("tier") == 0
    contacted = F.col("cost_per_contact") > 0
    c0, s0 = (F.max(F.when(first, F.col(c))) for c in ("cost_per_contact", "assumed_save_rate"))

    def total(when: Column, x: str) -> Column:
        return F.sum(F.when(when, F.col(x)).otherwise(0))

    one = counts.agg(
        total(first, "n").alias("n1"), total(first, "churners").alias("t1"),
        total(contacted, "n").alias("nk"), total(contacted, "churners").alias("tk"), F.sum("n").alias("base"),
        F.sum(F.col("n") * F.col("cost_per_contact")).alias("spend3"),
        F.sum(F.col("churners") * F.col("assumed_save_rate") * value_per_save).alias("gain3"),
        c0.alias("c0"), s0.alias("s0"),
    )
    top = F.struct("nk", "tk")
    if capacity is not None:
        top = capacity.agg(F.struct(F.max("n_targeted").alias("nk"), F.max("tp").alias("tk"))).scalar()
    one = one.withColumn("top", top)
    n1, t1, nk, tk, c, s = (F.col(x) for x in ("n1", "t1", "nk", "tk", "c0", "s0"))
    n_top, t_top = F.col("top.nk"), F.col("top.tk")

    def row(name: str, n: Column, t: Column, spend: Column, net: Column) -> Column:
        return F.struct(F.lit(name).alias("policy"), n.alias("contacts"), t.alias("churners"),
                        spend.cast("double").alias("spend"), net.cast("double").alias("net"))

    rows = one.select("base", F.inline(F.array(
        row("threshold_only", n1, t1, n1 * c, net_value(t1, n1, value_per_save, c, s)),
        row("top_k_single_channel", n_top, t_top, n_top * c, net_value(t_top, n_top, value_per_save, c, s)),
        row("tiered", nk, tk, F.col("spend3"), F.col("gain3") - F.col("spend3")),
    )))
    best = F.max("net").over(Window.partitionBy(F.lit(0)))
    scale = F.lit(1.0) if subscribers is None else F.lit(float(subscribers)) / F.col("base")
    return rows.withColumn("is_best", (F.col("net") == best) & (best > 0)).select(
        "policy", *[(F.col(x) * scale).alias(x) for x in ("contacts", "churners", "spend", "net")], "is_best"
    )


def contact_plan(counts: DataFrame, subscribers: float = 1_000_000) -> DataFrame:
    """Customers, share and churners per band, scaled to a subscriber base."""
    base = F.sum("n").over(Window.partitionBy(F.lit(0)))
    share = X.ratio(F.col("n").cast("double"), base)
    return counts.select(
        "tier", "action", (share * subscribers).alias("customers"), share.alias("share"),
        X.ratio(F.col("churners") * float(subscribers), base).alias("churners"),
    )


# ---- operating curve and scenarios ---------------------------------------------------------------------------------


def k_grid(spark, low: int = 100, high: int = 50_000, steps: int = 120, fixed: Sequence[int] = ()) -> DataFrame:
    """Log-spaced contact volumes and the fixed points, distinct."""
    a, b = F.ln(F.lit(float(low))), F.ln(F.lit(float(high)))
    spaced = spark.range(0, steps, 1, 1).select(
        X.half_up_int(F.exp(a + (b - a) * F.col("id") / (steps - 1))).alias("k")
    )
    points = spark.range(1).select(F.explode(F.array(*[F.lit(int(k)).cast("bigint") for k in fixed])).alias("k")) \
        if fixed else spaced.limit(0)
    return spaced.unionByName(points).distinct()


def tp_at_k(curve: DataFrame, ks: DataFrame) -> DataFrame:
    """True positives at each K, linear between curve points, flat after the last one, 0 for K <= 0.

    Curve and Ks are short (points of a chart); they are merged in K order and each K looks at its neighbours.
    """
    merged = curve.select(F.col("k").cast("double").alias("k"), F.col("tp").cast("double").alias("tp")).unionByName(
        ks.select(F.col("k").cast("double").alias("k"), F.lit(None).cast("double").alias("tp"))
    )
    point = F.when(F.col("tp").isNotNull(), F.struct("k", "tp"))
    before = Window.orderBy("k", F.col("tp").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.orderBy("k", F.col("tp").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    rows = merged.select(
        "k", F.col("tp").isNull().alias("_asked"),
        F.last(point, True).over(before).alias("a"), F.first(point, True).over(after).alias("b"),
    ).where("_asked")
    share = (F.col("k") - F.col("a.k")) / F.when(F.col("b.k") > F.col("a.k"), F.col("b.k") - F.col("a.k"))
    value = (
        F.when(F.col("k") <= 0, 0.0).when(F.col("b").isNull(), F.col("a.tp"))
        .when(F.col("b.k") == F.col("a.k"), F.col("a.tp"))
        .otherwise(F.col("a.tp") + share * (F.col("b.tp") - F.col("a.tp")))
    )
    return rows.select("k", value.alias("tp"))


def clamp_scenario(scenario: dict[str, float], bounds: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Scenario parameters forced into the caller's ranges (a slider's, for instance); K and subscribers rounded."""
    out = {}
    for name, value in scenario.items():
        low, high = bounds.get(name, (value, value))
        value = min(high, max(low, value))
        out[name] = float(int(value + 0.5)) if name in ("k", "subscribers") else float(value)
    return out


def scenario_grid(points: DataFrame, base: DataFrame, scenarios: Sequence[dict[str, float]]) -> DataFrame:
    """Economics of every (k, tp) point under every scenario.

    ``base`` is one row (n, positives) of the scored table. Scenarios count as given. Undefined ratios are NULL.
    """
    table = F.array(*[
        F.struct(*[F.lit(float(s[c])).alias(c) for c in ("value_per_save", "cost_per_contact", "save_rate", "subscribers")])
        for s in scenarios
    ])
    total = base.agg(F.struct(F.max("n").cast("double").alias("n"), F.max("positives").cast("double").alias("p"))).scalar()
    rows = points.withColumn("_b", total).select("k", "tp", "_b.n", "_b.p", F.inline(table))
    k, tp, n, p = (F.col(x) for x in ("k", "tp", "n", "p"))
    v, c, s = (F.col(x) for x in ("value_per_save", "cost_per_contact", "save_rate"))
    rate = X.ratio(p, n)
    out = rows.withColumns({
        "precision": X.ratio0(tp, k), "recall": X.ratio0(tp, p),
        "value_saved": tp * s * v, "spend": k * c,
        "net": net_value(tp, k, v, c, s), "random_net": net_value(k * rate, k, v, c, s),
    })
    out = out.withColumns({
        "lift": X.ratio(F.col("precision"), rate),
        "return_on_spend": X.ratio(F.col("value_saved"), F.col("spend")),
        "net_roi": X.ratio(F.col("net"), F.col("spend")),
        "break_even_save_rate": X.ratio(F.col("spend"), tp * v),
        "break_even_cost": X.ratio(F.col("value_saved"), k),
        "revenue_at_risk": p * v * F.col("subscribers") / n,
        "net_scaled": F.col("net") * F.col("subscribers") / n,
    })
    return out.drop("n", "p")


def expected_roi(df: DataFrame) -> DataFrame:
    """Expected churners, saves, benefit, cost and net from (n_targeted, precision, economics) rows."""
    n = F.col("n_targeted")
    out = df.withColumn("expected_churners", n * F.col("precision"))
    out = out.withColumn("expected_saves", F.col("expected_churners") * F.col("save_rate"))
    out = out.withColumn("benefit", F.col("expected_saves") * F.col("value_per_save"))
    out = out.withColumn("cost", n * F.col("cost_per_contact"))
    out = out.withColumn("net", F.col("benefit") - F.col("cost"))
    return out.withColumn("net_per_target", X.ratio0(F.col("net"), n))


def sensitivity(points: DataFrame, value: float = C.VALUE_PER_SAVE, cost: float = C.COST_PER_CONTACT,
                save: float = C.SAVE_RATE, change: float = 0.5) -> DataFrame:
    """Net value change for -/+ 50 % of each driver at every (k, tp) point, ranked by swing; ties share a rank."""
    k, tp = F.col("k"), F.col("tp")

    def net(v: float, c: float, s: float) -> Column:
        return net_value(tp, k, v, c, s)

    lo, hi = 1 - change, 1 + change
    base = net(value, cost, save)
    bars = F.array(*[
        F.struct(F.lit(name).alias("driver"), (low - base).alias("low"), (high - base).alias("high"))
        for name, low, high in (
            ("save_rate", net(value, cost, save * lo), net(value, cost, save * hi)),
            ("value_per_save", net(value * lo, cost, save), net(value * hi, cost, save)),
            ("cost_per_contact", net(value, cost * hi, save), net(value, cost * lo, save)),
        )
    ])
    rows = points.select("k", "tp", base.alias("base"), F.inline(bars))
    rows = rows.withColumn("swing", F.abs(F.col("high") - F.col("low")))
    drivers = Window.partitionBy("k")
    tolerance = 1e-6 * F.greatest(F.lit(1.0), F.max("swing").over(drivers))
    rows = rows.withColumns({"_all": F.collect_list("swing").over(drivers), "_tol": tolerance})
    larger = F.filter("_all", lambda x: x - F.col("swing") >= F.col("_tol"))
    out = rows.withColumn("rank", F.size(larger) + 1)
    return out.withColumn("is_leader", F.col("rank") == 1).drop("_all", "_tol")


# ---- batch results -------------------------------------------------------------------------------------------------


def batch_summary(df: DataFrame, k: int, threshold: float = C.DEFAULT_THRESHOLD, value: float = C.VALUE_PER_SAVE,
                  cost: float = C.COST_PER_CONTACT, save: float = C.SAVE_RATE, score: str = "y_proba",
                  id: str = "id") -> DataFrame:
    """Rows, rows at or above the threshold, rows in the top K, expected saves and net, cutoff score."""
    df = df.select(id, clean_score(F.col(score)).alias(score))
    top = best_rows(df, k, score, id).agg(F.struct(
        F.count(F.lit(1)).alias("n_top_k"), F.sum(F.col(score) * save).alias("expected_saves"),
        F.min(score).alias("cutoff"),
    )).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(score) >= threshold).alias("n_above_threshold")
    ).withColumn("_t", top).select(
        "n", "n_above_threshold", "_t.n_top_k", "_t.expected_saves",
        (F.col("_t.expected_saves") * value - F.col("_t.n_top_k") * cost).alias("expected_net"), "_t.cutoff",
    )


def campaign_table(df: DataFrame, k: int, policy: dict = C.POLICY, score: str = "y_proba", id: str = "id") -> DataFrame:
    """Export columns: rank, score, label at the default threshold, top-K flag, band and channel, input columns."""
    ranked = global_rank(df, score, id)
    action = action_of(F.col(score), policy)
    inputs = [c for c in df.columns if c not in (id, score)]
    return ranked.select(
        id, "rank", F.col(score).alias("churn_probability"),
        reaches(F.col(score), C.DEFAULT_THRESHOLD).cast("int").alias("label_at_threshold"),
        (F.col("rank") <= k).cast("int").alias("in_top_k"), action.alias("risk_band"),
        tier_attribute(action, "channel", policy).alias("suggested_action"), *inputs,
    )


def decide_batch(features: DataFrame, k: int, policy: dict = C.POLICY, id: str = C.KEY, n_reasons: int = 3,
                 cutoff_day: int | None = None) -> DataFrame:
    """Score a feature table with the scorecard: the campaign table with reasons and the input columns.

    Only id and score are put in order; texts and inputs meet the ranks by id.
    """
    card = {} if cutoff_day is None else {"cutoff_day": cutoff_day}
    scored = with_scorecard(features, keep_terms=True, **card)
    ranked = campaign_table(scored.select(id, "y_proba"), k, policy, "y_proba", id)
    texts = scored.select(F.col(id).alias("_id"), reason_text(reasons(n_reasons)).alias("top_reasons"),
                          *[c for c in features.columns if c != id])
    return ranked.join(texts, F.col(id) == F.col("_id")).drop("_id")


def table_of_top(df: DataFrame, limit: int = 100, score: str = "y_proba", id: str = "id") -> DataFrame:
    """The first rows of the ranked table."""
    return top_k(df, limit, score, id).orderBy("rank")
