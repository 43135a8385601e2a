"""Golden numbers: tiers, economics, drift, experiment size, scorecard reasons, run records."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.functions import scorecard as S
from churnspark.operators import experiment, metrics, models, monitor, policy, runs
from churnspark.plans import catalog
from churnspark.sources import io


def scores(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, y_proba double")


def test_tier_boundaries(spark):
    rows = policy.assign_action(scores(spark, [0.95, 0.68, 0.30, 0.2058, 0.01, -1.0])).orderBy("id").collect()
    assert [r.action for r in rows] == ["contact_now", "contact_now", "nudge", "nudge", "monitor", "monitor"]


def mix(spark, contact, nudge, monitor_n):
    score = F.when(F.col("id") < contact, 0.9).when(F.col("id") < contact + nudge, 0.4).otherwise(0.1)
    return spark.range(contact + nudge + monitor_n).select("id", score.alias("y_proba"))


def test_tier_psi(spark):
    same = monitor.tier_psi(mix(spark, 1478, 8522, 183205)).first()
    assert same.psi == pytest.approx(0, abs=1e-12) and same.status == "stable"
    assert monitor.tier_psi(mix(spark, 300, 300, 400)).first().status == "significant_shift"
    small = monitor.tier_psi(mix(spark, 300, 300, 399)).first()
    assert small.psi is None and small.status is None
    none_contacted = monitor.tier_psi(mix(spark, 0, 0, 2000)).first()
    assert math.isfinite(none_contacted.psi)


def test_recorded_economics(spark):
    counts = policy.policy_counts(spark)
    got = {r.policy: r for r in policy.policy_compare(counts).collect()}
    assert got["threshold_only"].net == pytest.approx(17666, abs=1)
    assert got["top_k_single_channel"].net == pytest.approx(-6776, abs=1)
    assert got["tiered"].net == pytest.approx(24306, abs=1) and got["tiered"].is_best
    tiers = {r.action: r for r in policy.tier_economics(counts).collect()}
    assert tiers["nudge"].net == pytest.approx(6639.8, abs=1)
    assert tiers["nudge"].uplift_vs_first_tier == pytest.approx(0.376, abs=0.001)
    recorded = C.POLICY["validation_summary"]["net_per_cycle"]
    checks = monitor.economics_checks(policy.policy_compare(counts), {
        "threshold_only": recorded["threshold_only"], "tiered": recorded["tiered"],
        "top_k_single_channel": recorded["top_10k_single_channel"]})
    assert all(r.passed for r in checks.collect()) and checks.count() == 3
    observed = {r.action: r.within_range for r in policy.tier_calibration(counts).collect()}
    assert observed == {"contact_now": True, "nudge": False, "monitor": True}


def curve(spark):
    return spark.createDataFrame(C.HOLDOUT_CURVE, "k bigint, tp bigint")


def test_interpolated_curve(spark):
    ks = spark.createDataFrame([(k,) for k in (-5, 0, 631, 1478, 3239, 10000, 193205, 400000)], "k bigint")
    got = {int(r.k): r.tp for r in policy.tp_at_k(curve(spark), ks).collect()}
    assert got == {-5: 0, 0: 0, 631: 496, 1478: 1044, 3239: 1194.5, 10000: 1801, 193205: 2402, 400000: 2402}


def test_scenario_golden_numbers(spark):
    points = policy.tp_at_k(curve(spark), spark.createDataFrame([(1478,), (10000,)], "k bigint"))
    base = spark.createDataFrame([(193205, 2402)], "n bigint, positives bigint")
    grid = policy.scenario_grid(points, base, [
        {"value_per_save": 120.0, "cost_per_contact": 5.0, "save_rate": 0.2, "subscribers": 1_000_000}])
    got = {int(r.k): r for r in grid.collect()}
    a, b = got[1478], got[10000]
    expected = {"precision": (0.706, 5e-4), "recall": (0.435, 5e-4), "value_saved": (25056, 1), "spend": (7390, 0.01),
                "net": (17666, 1), "return_on_spend": (3.39, 0.01), "net_roi": (2.39, 0.01), "break_even_save_rate": (0.059, 5e-4),
                "break_even_cost": (16.95, 0.01), "random_net": (-6950, 2), "net_scaled": (91436, 50), "revenue_at_risk": (1_490_000, 5000)}
    for name, (value, tolerance) in expected.items():
        assert a[name] == pytest.approx(value, abs=tolerance), name
    assert b.net == pytest.approx(-6776, abs=1) and b.lift == pytest.approx(14.5, abs=0.05)
    bounds = {"k": (100, 50_000), "save_rate": (0.01, 0.6), "cost_per_contact": (0.1, 50.0)}
    clamped = policy.clamp_scenario({"k": 7.6, "save_rate": 0.9, "cost_per_contact": 0.0, "value_per_save": 900.0}, bounds)
    assert clamped == {"k": 100.0, "save_rate": 0.6, "cost_per_contact": 0.1, "value_per_save": 900.0}


def test_sensitivity_ties(spark):
    points = spark.createDataFrame([(1478.0, 1044.0)], "k double, tp double")
    got = {r.driver: r for r in policy.sensitivity(points).collect()}
    assert got["save_rate"].rank == got["value_per_save"].rank == 1 and got["cost_per_contact"].rank == 3
    assert got["save_rate"].is_leader and not got["cost_per_contact"].is_leader
    assert got["cost_per_contact"].low < 0 < got["cost_per_contact"].high


def test_lift_checks(spark):
    rate = C.HOLDOUT["valid_churn_rate"]
    rows = spark.createDataFrame([(m, C.HOLDOUT[m], rate) for m in C.DOCUMENTED_LIFT], "metric string, value double, base_rate double")
    assert all(r.passed for r in monitor.lift_checks(rows, C.DOCUMENTED_LIFT).collect())


def test_k_grid(spark):
    ks = [r.k for r in policy.k_grid(spark, 100, 50_000, 120, (1262, 1478)).orderBy("k").collect()]
    assert ks[0] == 100 and ks[-1] == 50_000 and {1262, 1478} <= set(ks) and len(ks) == len(set(ks))


def test_sample_size(spark):
    def size(p, mde, alpha=0.05, power=0.8):
        return spark.range(1).select(experiment.sample_size(F.lit(p), mde, alpha, power)).first()[0]

    assert size(0.18, 0.03) == 2402
    assert size(0.18, 0) is None and size(0.02, 0.03) is None and size(0.18, 0.03, alpha=0) is None


def test_capacity_cutoff_is_attached(spark):
    df = scores(spark, [i / 100 for i in range(100)])
    assert metrics.equiv_threshold(df, 10, capacity=10).first().recorded_threshold == C.OPS_CUTOFF
    row = metrics.equiv_threshold(df, 500).first()
    assert (row.n_targeted, row.equiv_threshold, row.recorded_threshold) == (100, 0.0, None)


# ---- scorecard -----------------------------------------------------------------------------------------------------


def test_empty_record_uses_defaults(spark):
    empty = spark.createDataFrame([("u",)], "msno string").select("*", *[
        F.lit(None).cast("double").alias(f) for f in C.FEATURES])
    row = S.with_scorecard(empty, keep_terms=True).withColumn("r", S.reasons()).first()
    z = -3 + 2.4 * 0.5 - 0.06 * 3 - 0.0015 * 30
    assert row.logit == pytest.approx(z) and row.y_proba == round(1 / (1 + math.exp(-z)), 4)
    assert row.r == [] and {t.id for t in row.terms} == {"auto_renew_rate", "cancel_rate", "txn_cnt", "log_active_days"}


def test_reasons(spark):
    given = {"auto_renew_rate": 0.0, "cancel_rate": 1.0, "membership_expire_date_max": 20170220.0, "log_last_date": 20170101.0,
             "txn_cnt": 1.0, "log_active_days": 10.0, "plan_list_price_mean": 100.0, "actual_paid_mean": 50.0}
    df = spark.createDataFrame([("u",)], "msno string").select("*", *[
        F.lit(given.get(f)).cast("double").alias(f) for f in C.FEATURES])
    row = S.with_scorecard(df, keep_terms=True).withColumn("r", S.reasons(20)).withColumn("t", S.reason_text(S.reasons(2))).first()
    p0 = 1 / (1 + math.exp(3))
    assert sum(x.impact for x in row.r) == pytest.approx(1 / (1 + math.exp(-row.logit)) - p0)
    assert [x.id for x in row.r][:2] == ["auto_renew_rate", "log_last_date"]
    texts = {x.id: x.text for x in row.r}
    assert texts["membership_expire_date_max"] == "Membership lapsed 8 days ago"
    assert texts["txn_cnt"] == "1 transaction on record" and texts["actual_paid_mean"] == "Paying 50% below list price"
    assert row.t.startswith("Auto-renew on 0% of payments (+") and row.t.count("; ") == 1


def test_contribution_points_add_up(spark):
    df = spark.range(1).select(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(v).alias("contribution"))
                                         for f, v in (("a", 1.0), ("b", -2.5), ("c", 0.25))]).alias("c"))
    p = 1 / (1 + math.exp(-(-1.0 + 1.0 - 2.5 + 0.25)))
    points = df.select(S.contribution_points(F.col("c"), F.lit(-1.0), F.lit(p)).alias("x")).first().x
    assert sum(x.impact for x in points) == pytest.approx(p - 1 / (1 + math.exp(1.0)))
    top = df.select(S.top_contributions(F.col("c"), 2).alias("x")).first().x
    assert [x.feature for x in top] == ["b", "a"]


# ---- drift and experiments -----------------------------------------------------------------------------------------


def test_feature_drift_on_shifted_and_equal_data(spark):
    base = spark.range(3000).select((F.col("id") % 100).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    moved = base.withColumn("x", F.col("x") + 60)
    psi = {r.feature: r for r in monitor.feature_psi(base, moved, ["x", "y"]).collect()}
    assert psi["x"].retrain and psi["y"].psi == pytest.approx(0, abs=1e-9) and not psi["y"].alert
    ks = {r.feature: r for r in monitor.feature_ks(base, moved, ["x", "y"]).collect()}
    assert ks["x"].ks == pytest.approx(0.6) and ks["x"].drifted and ks["y"].ks == 0 and ks["y"].p_value == 1


def test_missing_values_are_a_bin(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    holes = base.select(F.when(F.col("x") % 2 == 0, F.col("x")).alias("x"))
    assert monitor.feature_psi(base, holes, ["x"]).first().retrain


def test_readout_finds_the_planted_effect(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "treatment").otherwise("holdout").alias("arm"), F.lit("contact_now").alias("tier"),
        ((F.col("id") / 2).cast("int") % 100 < F.when(F.col("id") % 2 == 0, 15).otherwise(25)).cast("int").alias("churned"))
    rows = {r.tier: r for r in experiment.experiment_readout(df).collect()}
    assert rows["all"].reduction == pytest.approx(0.10) and rows["all"].p_value < 0.05
    assert rows["all"].incremental_saves == pytest.approx(200) and rows["contact_now"].spend == 10000
    assert rows["all"].incremental_net == pytest.approx(200 * 120 - 10000)


def test_holdout_is_stable_and_even(spark):
    df = mix(spark, 2000, 2000, 2000)
    a = experiment.assign_holdout(df, 4000)
    share = {r.tier: r.h for r in a.groupBy("tier").agg(F.avg((F.col("arm") == "holdout").cast("int")).alias("h")).collect()}
    assert set(share) == {"contact_now", "nudge"} and all(abs(h - 0.5) < 0.05 for h in share.values())
    again = {r.id: r.arm for r in experiment.assign_holdout(df.repartition(5), 4000).collect()}
    assert again == {r.id: r.arm for r in a.collect()}


def test_precision_decay_needs_two_low_cycles(spark):
    rows = []
    for cycle, hit in enumerate([True, False, False, True]):
        rows += [(cycle * 100 + i, cycle, 1.0 - i / 100, int(i < 10 if hit else i >= 90)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, cycle int, y_proba double, y_true int")
    got = [r.retrain for r in monitor.precision_decay(df, 10, "cycle").orderBy("cycle").collect()]
    assert got == [False, False, True, False]


# ---- ensembles and run records -------------------------------------------------------------------------------------


def test_models_must_score_the_same_ids(spark):
    a = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.4)], "id int, y_true int, y_proba double")
    with pytest.raises(Exception, match="different ids"):
        models.join_scores({"a": a, "b": a.where("id = 1")}).collect()
    joined = models.join_scores({"a": a, "b": a})
    assert [r.y_proba for r in models.soft_vote(joined, ["a", "b"]).orderBy("id").collect()] == [0.5, 0.4]
    with pytest.raises(ValueError):
        models.soft_vote(joined, ["a", "b"], "manual", {"a": 0.0, "b": 0.0})
    with pytest.raises(ValueError):
        models.weight_grid([])
    assert models.weight_grid(["a"]) == [{"a": 1.0}] and len(models.weight_grid(["a", "b", "c", "d"])) == 1771
    assert all(abs(sum(w.values()) - 1) < 1e-12 for w in models.weight_grid(["a", "b", "c", "d"]))
    assert len(models.weight_grid(["a", "b", "c"])) == 231 and len(models.weight_grid(["a", "b"])) == 21


def test_grid_search_prefers_the_better_model(spark):
    df = spark.range(200).select("id", (F.col("id") % 4 == 0).cast("int").alias("y_true"))
    good = df.withColumn("y_proba", F.col("y_true") * 0.5 + F.col("id") % 7 / 100)
    bad = df.withColumn("y_proba", (F.col("id") * 31 % 100) / 100)
    joined = models.join_scores({"good": good, "bad": bad})
    best = models.best_weights(models.weight_search(joined, ["good", "bad"])).first()
    assert best.average_precision == pytest.approx(1.0) and best.w_good >= 0.5
    voted = models.soft_vote(joined, ["good", "bad"], "grid_search")
    assert metrics.ranking_metrics(voted).first().average_precision == pytest.approx(1.0)


def voters(spark, kind, n=600):
    rng = np.random.Generator(np.random.PCG64(len(kind)))
    y = (rng.random(n) < 0.2).astype(int)
    a, b, c = (np.clip(y * w + rng.random(n), 0, None) for w in (0.5, 0.1, 0.3))
    if kind == "ties":
        a, b, c = (np.round(x, 1) for x in (a, b, c))
    if kind == "same":
        a, b, c = np.full(n, 0.5), np.full(n, 0.25), np.full(n, 0.5)
    if kind == "near_zero":
        a, b, c = (x * 1e-9 for x in (a, b, c))
    if kind == "negative":
        a, b, c = a - 0.7, b - 0.7, c - 0.7
    if kind == "no_churn":
        y[:] = 0
    if kind == "all_churn":
        y[:] = 1
    cells = [[int(t), *map(float, v)] for t, *v in zip(y, a, b, c)]
    if kind == "missing":
        for i, row in enumerate(cells):
            row[1 + i % 3] = None if i % 7 == 0 else float("nan") if i % 11 == 0 else row[1 + i % 3]
    return spark.createDataFrame(cells, "y_true int, a double, b double, c double")


@pytest.mark.parametrize("kind", ["plain", "ties", "same", "near_zero", "negative", "no_churn", "all_churn", "missing"])
def test_bounds_hold_and_the_winner_stays(spark, kind):
    joined, names = voters(spark, kind), ["a", "b", "c"]
    grid = models.weight_grid(names, 0.2)
    searched = models.weight_search(joined, names, 0.2)
    exact = {r.grid_row: r.average_precision for r in searched.collect()}
    vectors = models._vectors(joined, names, "y_true")
    for bits in (0, 3, 10):
        scores = models._grid_scores(vectors, names, grid, range(len(grid)))
        bounds = models.average_precision_bounds(scores, bits, ["grid_row"]).collect()
        assert {r.grid_row for r in bounds} == set(exact)
        for r in bounds:
            if exact[r.grid_row] is None:
                assert r.lower is None and r.upper is None
            else:
                assert r.lower - 1e-9 <= exact[r.grid_row] <= r.upper + 1e-9
    best = models.best_weights(searched).first()
    assert models.winning_weights(joined, names, 0.2).first() == best
    assert best.grid_row in models.candidate_rows(vectors, names, grid, range(len(grid)), 0)


def test_bounds_leave_few_rows_to_evaluate(spark):
    joined, names = voters(spark, "plain", 20000), ["a", "b", "c"]
    grid = models.weight_grid(names)
    vectors = models._vectors(joined, names, "y_true")
    coarse = models.candidate_rows(vectors, names, grid, range(len(grid)), 4)
    fine = models.candidate_rows(vectors, names, grid, coarse, 8)
    assert set(fine) <= set(coarse) and len(fine) * 10 <= len(grid)
    # A bin per grid row takes the place of a score: far fewer rows meet in the shuffle than there are scores.
    bins = models._grid_scores(vectors, names, grid, range(len(grid))).groupBy(
        "grid_row", F.shiftright(X.order_code(F.col("score")), 48)).count().count()
    assert bins * 10 <= len(grid) * vectors.count()


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    ok = runs.run_record(spark, "gbt", 1, lambda: {"pr_auc": 0.5, "roc_auc": 0.9, "note": "x"}, params={"depth": 3})
    failed = runs.run_record(spark, "gbt", 2, lambda: 1 / 0)
    for r in (ok, failed):
        io.append_runs(r, path)
    (tmp_path / "runs" / "extra.json").write_text('\nnot json\n{"run_name": "search", "metrics": {"pr_auc": 0.99}}\n')
    assert io.run_log_quality(spark, path).collect() == [(4, 1)]  # two runs, one line of another shape, one broken
    log = io.read_run_log(spark, path).where("run_id IS NOT NULL OR metrics IS NOT NULL")
    by_id = {r.run_id: r for r in log.collect() if r.run_id}
    assert by_id["gbt-0002"].status == "failed" and "ZeroDivisionError" in by_id["gbt-0002"].artifacts["error"]
    board = runs.leaderboard(log).collect()
    assert [(r.model_name, r.run_id, r.pr_auc) for r in board] == [("gbt", "gbt-0001", 0.5)]
    assert {r.key for r in runs.numeric_metrics(ok).collect()} == {"pr_auc", "roc_auc"}
    new = spark.createDataFrame([("gbt", "2026-01-02"), ("new", "2026-01-01"), ("gbt", "2026-01-01")], "model_name string, started_at_utc string")
    numbered = runs.number_runs(new, log.where("run_id IS NOT NULL")).collect()
    assert sorted(r.run_id for r in numbered) == ["gbt-0003", "gbt-0004", "new-0001"]


def test_leaderboard_ties_keep_the_first_run(spark):
    rows = [("m-1", "m", 1, "success", {"pr_auc": "0.5", "roc_auc": "0.8"}), ("m-2", "m", 2, "success", {"pr_auc": "0.5", "roc_auc": "0.8"}),
            ("m-3", "m", 3, None, {"pr_auc": "0.9"}), ("m-4", "m", 4, "success", {"f1": "1.0"})]
    df = spark.createDataFrame(rows, "run_id string, model_name string, run_number bigint, status string, metrics map<string,string>")
    assert runs.leaderboard(df).first().run_id == "m-1"


def test_catalog_reads_the_given_tables(spark):
    """Every registered query scans the table folder it is given."""
    assert len(catalog.CATALOG) > 100
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        catalog.CATALOG["model_table"].run(spark, "/nowhere").count()
