"""Global ranks, running totals, quantiles and top-K against brute force, with hot ties and missing scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.operators import metrics, rank, select


@pytest.fixture(scope="module")
def scored(spark):
    # A third of the rows share the score 0.9, some scores are NULL or NaN, ids are shuffled.
    rows = spark.range(6000).select(
        ((F.col("id") * 7919) % 6000).alias("id"),
        F.when(F.col("id") % 3 == 0, 0.9).when(F.col("id") % 50 == 1, F.lit(None)).when(F.col("id") % 50 == 2, float("nan"))
        .otherwise(F.col("id") * 37 % 1000 / 1000.0).alias("y_proba"),
        (F.col("id") % 11 == 0).cast("int").alias("y_true"),
        F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").otherwise("c").alias("seg"),
    )
    return rows.cache()


def brute(scored):
    pdf = scored.toPandas()
    pdf["key"] = pdf.y_proba.fillna(-1)
    return pdf.sort_values(["key", "id"], ascending=[False, True]).reset_index(drop=True)


def test_global_rank_is_the_sorted_order(scored):
    want = brute(scored)
    got = rank.global_rank(scored).toPandas().sort_values("rank")
    assert got["rank"].tolist() == list(range(1, len(want) + 1))
    assert got["id"].tolist() == want["id"].tolist()


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_rank_does_not_depend_on_partitioning(scored, parts):
    a = {r.id: r["rank"] for r in rank.global_rank(scored.repartition(parts)).collect()}
    b = {r.id: r["rank"] for r in rank.global_rank(scored).collect()}
    assert a == b


def test_rank_restarts_per_group(scored):
    want = brute(scored)
    want["rank"] = want.groupby("seg").cumcount() + 1
    got = rank.global_rank(scored, by=["seg"]).toPandas().merge(want[["id", "rank"]], on="id")
    assert (got.rank_x == got.rank_y).all()


def test_top_k_cuts_inside_a_hot_tie(scored):
    want = brute(scored)
    for k in (1, 500, 2100, 5999, 6000, 9000):
        got = rank.top_k(scored, k).orderBy("rank").toPandas()
        assert got["id"].tolist() == want["id"].tolist()[:k]
    with pytest.raises(ValueError):
        rank.top_k(scored, 0)


def test_top_k_per_group(scored):
    want = brute(scored).groupby("seg").head(700)
    got = rank.top_k(scored, 700, by=["seg"]).toPandas()
    assert set(got.id) == set(want.id)


def test_scores_outside_the_unit_interval(spark):
    rows = spark.range(1000).select("id", (F.col("id") * 13 % 1000 - 500).cast("double").alias("y_proba"))
    want = sorted((-(i * 13 % 1000 - 500), i) for i in range(1000))[:30]
    got = rank.top_k(rows, 30).orderBy("rank").toPandas()
    assert got.id.tolist() == [i for _, i in want]


def test_running_totals(scored):
    clean = scored.where("y_proba IS NOT NULL AND NOT isnan(y_proba)")
    want = clean.toPandas().groupby("y_proba").agg(n=("y_true", "size"), pos=("y_true", "sum")).sort_index(ascending=False)
    got = rank.score_groups(clean).toPandas().sort_values("score", ascending=False)
    assert got.cum_n.tolist() == want.n.cumsum().tolist()
    assert got.cum_pos.tolist() == want.pos.cumsum().tolist()
    assert set(got.all_n) == {int(want.n.sum())}


def test_exact_quantiles(scored):
    values = scored.toPandas().y_proba.dropna().to_numpy()
    qs = [0.0, 0.01, 0.33, 0.5, 0.999, 1.0]
    got = select.exact_quantiles(scored, "y_proba", qs).first()["quantiles"]
    assert np.allclose(got, np.quantile(values, qs), atol=1e-12)


def auc_ap(y, p):
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > neg).mean() + 0.5 * (a == neg).mean() for a in pos])
    ap = last = 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = (hit & (y == 1)).sum() / (y == 1).sum()
        ap += (recall - last) * (hit & (y == 1)).sum() / hit.sum()
        last = recall
    return auc, ap


def test_auc_and_average_precision(scored):
    clean = scored.where("y_proba IS NOT NULL AND NOT isnan(y_proba)")
    pdf = clean.toPandas()
    got = metrics.ranking_metrics(clean).first()
    auc, ap = auc_ap(pdf.y_true.to_numpy(), pdf.y_proba.to_numpy())
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)
    assert got.average_precision == pytest.approx(ap, abs=1e-12)
    by_seg = {r.seg: r for r in metrics.ranking_metrics(clean, by=["seg"]).collect()}
    for seg, part in pdf.groupby("seg"):
        auc, ap = auc_ap(part.y_true.to_numpy(), part.y_proba.to_numpy())
        assert by_seg[seg].roc_auc == pytest.approx(auc, abs=1e-12)
        assert by_seg[seg].average_precision == pytest.approx(ap, abs=1e-12)


def test_step_average_precision_differs_from_trapezoid(spark):
    rows = spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(
        zip([1, 0, 1, 1, 0, 0, 1, 0], [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]))], "id int, y_true int, y_proba double")
    got = metrics.ranking_metrics(rows).first()
    auc, ap = auc_ap(np.array([1, 0, 1, 1, 0, 0, 1, 0]), np.array([0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]))
    assert (got.roc_auc, got.average_precision) == (pytest.approx(auc), pytest.approx(ap))


def test_undefined_metrics_are_null(spark):
    rows = spark.createDataFrame([(1, 0, 0.4), (2, 0, 0.6)], "id int, y_true int, y_proba double")
    got = metrics.ranking_metrics(rows).first()
    assert got.roc_auc is None and got.average_precision is None


def test_sweep_matches_direct_comparison(spark):
    # Scores on and next to every threshold.
    values = [v for i in range(0, 101) for v in (i / 100, np.nextafter(i / 100, 0), np.nextafter(i / 100, 1))]
    values += [-0.5, 1.7]
    rows = spark.createDataFrame([(i, i % 2, float(v)) for i, v in enumerate(values)], "id int, y_true int, y_proba double")
    got = {r.threshold: r for r in metrics.threshold_sweep(rows).collect()}
    y, p = np.arange(len(values)) % 2, np.array(values)
    assert len(got) == 99
    for t in np.round(np.arange(0.01, 1.0, 0.01), 2):
        hit = p >= t
        assert got[t].tp == (hit & (y == 1)).sum() and got[t].fp == (hit & (y == 0)).sum()
        assert got[t].fn == (~hit & (y == 1)).sum() and got[t].n_targeted == hit.sum()


def test_ties_take_the_lowest_threshold(spark):
    rows = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1)], "id int, y_true int, y_proba double")
    best = {r.selected_by: r for r in metrics.best_threshold(metrics.threshold_sweep(rows), 1).collect()}
    assert best["roi_max"].threshold == 0.11
    assert metrics.best_f1_threshold(rows).first().threshold == 0.11


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_task_sort_over_rows(spark, scored):
    """Windows without partitioning only ever see one row per part."""
    text = plan(rank.global_rank(scored.select("id", "y_proba")))
    before_window = text[text.index("Window"):] if "Window" in text else ""
    assert "_rows" in before_window and "SinglePartition" in text
    assert "y_proba" not in before_window.split("Exchange SinglePartition")[1].split("HashAggregate")[0]
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_null_groups_are_groups(spark):
    rows = spark.range(300).select("id", (F.col("id") % 100 / 100.0).alias("y_proba"), (F.col("id") % 2).alias("y_true"),
                                   F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    got = rank.top_k(rows, 10, by=["g"]).groupBy("g").agg(F.count("*").alias("n"), F.max("rank").alias("m")).collect()
    assert {r.g: (r.n, r.m) for r in got} == {None: (10, 10), 1: (10, 10), 2: (10, 10)}
    assert metrics.ranking_metrics(rows, by=["g"]).count() == 3
    assert metrics.evaluate(rows, 0.5, [10], by=["g"]).count() == 3


def test_release_deletes_what_was_staged(spark):
    from churnspark.sources import staging

    written = staging.stage(spark.range(3), "x")
    assert written.count() == 3
    staging.release(spark)
    with pytest.raises(Exception):
        written.count()


def test_a_hot_tie_spreads_over_the_parts(spark):
    """A third of the rows share one score; no part of the order grows with it."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 0.9).otherwise(F.rand(1)).alias("y_proba"))
        parts = rank.ordered(rows, F.col("y_proba").desc(), F.col("id").asc()).groupBy("_part").count().toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(parts) == 8 and parts["count"].max() < 2 * 60_000 / 8


# ---- missing scores ------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(i, i % 3 == 0, None if i % 7 == 0 else float("nan") if i % 11 == 0 else (i * 37 % 101) / 100) for i in range(400)]
    return spark.createDataFrame([(i, int(y), p) for i, y, p in rows], "id long, y_true int, y_proba double")


def test_confusion_equals_the_sweep_row(gaps):
    sweep = {round(r.threshold * 100): r for r in metrics.threshold_sweep(gaps).collect()}
    for k in (1, 31, 50, 99):
        r = metrics.confusion_at(gaps, k / 100).first()
        assert (r.tp, r.fp, r.fn) == (sweep[k].tp, sweep[k].fp, sweep[k].fn)


def test_missing_scores_are_no_risk(spark, gaps):
    from churnspark.operators import models, monitor, policy

    missing = gaps.where("y_proba IS NULL OR isnan(y_proba)")
    n = missing.count()
    assert policy.assign_action(missing).where("action <> 'monitor'").isEmpty()
    assert policy.apply_threshold(missing, 0.0).where("churn_label = 1").isEmpty()
    assert policy.batch_summary(gaps, 400, 0.0).first().n_above_threshold == 400 - n
    s = metrics.score_summary(gaps).first()
    assert s.proba_max <= 1 and s.proba_mean == s.proba_mean
    for table in (metrics.score_histogram(gaps), models.reliability_table(gaps)):
        assert table.where("bin = -1").first().n == n and table.agg(F.sum("n")).first()[0] == 400
    shift = monitor.score_shift(gaps.withColumn("cycle", F.col("id") % 2), "cycle").collect()
    assert all(r.mean_score == r.mean_score and r.predicted_rate < 0.7 for r in shift)
    out = models.calibrate(gaps, models.fit_calibration(gaps))
    assert out.where("calibrated IS NULL").count() == n
    ks = monitor.feature_ks(gaps.select(F.lit(None).cast("double").alias("x"), F.col("id").cast("double").alias("z"), F.lit(None).cast("double").alias("w")),
                            gaps.select(F.lit(1.0).alias("x"), F.col("id").cast("double").alias("z"), F.lit(None).cast("double").alias("w")), ["x", "z", "w"])
    got = {r.feature: r for r in ks.collect()}
    assert got["x"].ks is None and got["x"].drifted is None and got["w"].n_baseline == 0 and got["z"].ks == 0


def test_curve_points_are_those_of_a_full_order(gaps):
    rows = sorted(gaps.collect(), key=lambda r: (-(r.y_proba if r.y_proba is not None and r.y_proba == r.y_proba else -1), r.id))
    for r in metrics.operating_curve(gaps, [1, 17, 200, 399, 1000]).collect():
        assert r.tp == sum(x.y_true for x in rows[: r.k])


def test_a_scope_leaves_nothing_behind(spark, gaps):
    import os

    from churnspark.sources import staging

    root = staging._session_dir(spark)
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with staging.scope(spark):
        assert metrics.evaluate(gaps, 0.5, [10]).count() == 1
        assert set(os.listdir(root)) - before
    assert set(os.listdir(root)) == before
