"""Training, contributions, calibration."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.operators import calibration, metrics, models

FEATURES = ["txn_cnt", "cancel_rate", "gender", "log_active_days"]


@pytest.fixture(scope="module")
def table(spark):
    noise = F.xxhash64("id") % 100 / 100.0
    rows = spark.range(1500).select(
        F.col("id").alias("msno"), (F.col("id") % 20).alias("txn_cnt"),
        F.when(F.col("id") % 9 != 0, F.abs(noise)).alias("cancel_rate"),
        F.when(F.col("id") % 3 == 0, "male").when(F.col("id") % 3 == 1, "female").otherwise("unknown").alias("gender"),
        (F.col("id") * 7 % 90).alias("log_active_days"),
    )
    churn = (F.col("txn_cnt") < 6) & (F.coalesce("cancel_rate", F.lit(0.0)) > 0.3)
    return rows.withColumn("is_churn", churn.cast("int")).cache()


@pytest.fixture(scope="module")
def parts(table):
    return table.where("msno % 5 <> 0"), table.where("msno % 5 = 0")


def quality(model, valid):
    scored = models.score(model, valid, ["msno", "is_churn"], FEATURES)
    return metrics.ranking_metrics(scored, "y_proba", "is_churn").first()


def test_models_beat_the_constant_baseline(spark, parts, tmp_path):
    train, valid = parts
    base = metrics.majority_baseline(train, valid)
    assert metrics.ranking_metrics(base).first().roc_auc == 0.5
    logreg = models.fit(train, models.logistic_regression(maxIter=20), FEATURES, scale=True)
    tree = models.fit(train, models.decision_tree(minInstancesPerNode=10), FEATURES)
    forest = models.fit(train, models.random_forest(numTrees=10, maxDepth=5, minInstancesPerNode=5), FEATURES)
    for model in (logreg, tree, forest):
        assert quality(model, valid).roc_auc > 0.85
    path = str(tmp_path / "model")
    tree.save(path)
    again = models.score(PipelineModel.load(path), valid, ["msno"], FEATURES).collect()
    assert again == models.score(tree, valid, ["msno"], FEATURES).collect()
    top = models.model_importance(tree, train, 3, FEATURES).collect()
    assert {top[0].feature, top[1].feature} == {"txn_cnt", "cancel_rate"}


def additive(rows):
    for r in rows:
        z = r.base_value + sum(c.contribution for c in r.contributions)
        assert 1 / (1 + np.exp(-z)) == pytest.approx(r.y_proba, abs=1e-6)


def test_contributions_reproduce_the_score(parts):
    train, valid = parts
    logreg = models.fit(train, models.logistic_regression(maxIter=20), FEATURES, scale=True)
    additive(models.linear_contributions(logreg, valid, ["msno"], FEATURES).collect())
    marked = train.withColumn("held", F.col("msno") % 7 == 0)
    boosted = models.fit(marked, models.boosted_trees(maxIter=5, maxBins=64, minInstancesPerNode=5,
                                                      validationIndicatorCol="held"), FEATURES)
    rows = models.tree_contributions(boosted, valid, ["msno"], FEATURES)
    additive(rows.collect())
    ranked = models.global_importance(rows, top=2).collect()
    assert {r.feature for r in ranked} == {"txn_cnt", "cancel_rate"}


def conditional(tree, x, known, node=0):
    """Expected score of a tree when only some slots are known."""
    if tree["left"][node] < 0:
        return tree["value"][node]
    left, right = tree["left"][node], tree["right"][node]
    if tree["feature"][node] in known:
        value = x[tree["feature"][node]]
        goes = value in tree["cut"][node] if tree["categorical"][node] else value <= tree["cut"][node][0]
        return conditional(tree, x, known, left if goes else right)
    return sum(tree["share"][n] * conditional(tree, x, known, n) for n in (left, right))


def enumerated(trees, x):
    """Shapley values by all subsets."""
    d = len(x)
    out = np.zeros(d)
    for j in range(d):
        rest = [i for i in range(d) if i != j]
        for k in range(d):
            weight = factorial(k) * factorial(d - 1 - k) / factorial(d)
            for known in combinations(rest, k):
                out[j] += weight * sum(conditional(t, x, {*known, j}) - conditional(t, x, set(known)) for t in trees)
    return out


@pytest.mark.parametrize("most", [models.SLICE_NODES, 20])
def test_tree_contributions_are_shapley_values(spark, parts, monkeypatch, most):
    """Two numbers and their indicators are four slots: every subset can be tried."""
    monkeypatch.setattr(models, "SLICE_NODES", most)
    train, valid = parts
    names = ["txn_cnt", "cancel_rate"]
    boosted = models.fit(train, models.boosted_trees(maxIter=4, maxDepth=4, maxBins=64, minInstancesPerNode=5, featureSubsetStrategy="all"), names)
    nodes, slices = models._tree_slices(boosted.stages[-1], spark)
    assert (len(slices) > 1) == (most == 20) and [a for a, _ in slices][1:] == [b for _, b in slices][:-1]
    trees = models._trees(nodes, 0, 4, boosted.stages[-1].treeWeights)
    rows = models.tree_contributions(boosted, valid, ["msno"], names).orderBy("msno").limit(40).collect()
    x = {r.msno: np.array(r.v) for r in boosted.transform(models.as_model_input(valid, names)).select("msno", vector_to_array("features").alias("v")).collect()}
    additive(rows)
    for r in rows:
        assert r.base_value == pytest.approx(sum(conditional(t, x[r.msno], set()) for t in trees), abs=1e-9)
        assert [c.contribution for c in r.contributions] == pytest.approx(enumerated(trees, x[r.msno]).tolist(), abs=1e-9)


def test_search_ranks_by_average_precision(parts):
    train, valid = parts
    got = models.model_search(train, valid, [
        ("stump", models.decision_tree(maxDepth=1, minInstancesPerNode=1)),
        ("tree", models.decision_tree(maxDepth=5, minInstancesPerNode=1))], features=FEATURES).collect()
    assert [r.trial for r in got] == ["tree", "stump"]


def test_isotonic_calibration_on_grouped_scores(spark):
    df = spark.range(2000).select("id", (F.col("id") % 100 / 100.0).alias("y_proba"),
                                  ((F.col("id") * 37 % 100) < (F.col("id") % 100) / 4).cast("int").alias("y_true"))
    out = calibration.calibrate(df, calibration.fit_calibration(df)).orderBy("y_proba").toPandas()
    assert (np.diff(out.calibrated) >= -1e-12).all()
    assert out.calibrated.mean() == pytest.approx(out.y_true.mean(), abs=1e-9)


def pooled(points):
    """Blocks (low, high, mean) of (x, weight, rate) in order, one after another."""
    out = []
    for x, w, r in points:
        out.append([x, x, w, w * r])
        while len(out) > 1 and out[-2][3] / out[-2][2] >= out[-1][3] / out[-1][2]:
            low, _, w0, t0 = out[-2]
            out[-2:] = [[low, out[-1][1], w0 + out[-1][2], t0 + out[-1][3]]]
    return [(a, b, t / w) for a, b, w, t in out]


@pytest.mark.parametrize("shape", ["noisy", "falling", "rising", "low_end"])
def test_isotonic_rounds_reach_the_one_solution(spark, shape):
    """Groups of eight: pools grow across many groups, and one low point at the end pulls all before it."""
    rng = np.random.Generator(np.random.PCG64(6))
    n = 300
    rate = {"noisy": np.clip(np.arange(n) / n + rng.normal(0, .3, n), 0, 1), "falling": 1 - np.arange(n) / n, "rising": np.arange(n) / n,
            "low_end": np.where(np.arange(n) < n - 1, .5 + np.arange(n) / n / 9, 0)}[shape]
    weight = rng.integers(1, 5, n).astype(float)
    points = list(zip((np.arange(n) / n).tolist(), weight.tolist(), rate.tolist()))
    want = pooled(points)
    got = calibration.fit_isotonic(spark.createDataFrame(points, "score double, weight double, rate double"), group=8).orderBy("block").collect()
    assert [(r.low, r.high) for r in got] == [(a, b) for a, b, _ in want]
    assert [r.value for r in got] == pytest.approx([v for _, _, v in want])


def test_calibration_between_and_beyond_the_blocks(spark):
    fitted = spark.createDataFrame([(0, 0.2, 0.3, 0.1), (1, 0.5, 0.5, 0.4), (2, 0.6, 0.9, 0.8)], "block long, low double, high double, value double")
    x = [0.0, 0.2, 0.25, 0.3, 0.4, 0.5, 0.55, 0.6, 0.7, 0.9, 1.0, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id int, y_proba double")
    got = [r.calibrated for r in calibration.calibrate(df, fitted).orderBy("id").collect()]
    assert got[:11] == pytest.approx([0.1, 0.1, 0.1, 0.1, 0.25, 0.4, 0.6, 0.8, 0.8, 0.8, 0.8]) and got[11:] == [None, None]
    assert calibration.calibrate(df, fitted.limit(0)).where("calibrated IS NOT NULL").count() == 0


def test_calibration_of_a_million_scores(spark):
    """Every score is distinct; nothing but counts comes to the driver."""
    df = spark.range(1_000_000).select((F.col("id") / 1e6).alias("y_proba"), (F.abs(F.xxhash64("id")) % 1000 < F.col("id") / 1000).cast("int").alias("y_true"))
    fitted = calibration.fit_calibration(df)
    check = fitted.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("value") - (F.col("low") + F.col("high")) / 2)).alias("far")).first()
    assert 100 < check.n < 100_000 and check.far < 0.2
    out = calibration.calibrate(df, fitted)
    assert out.where("calibrated IS NULL").count() == 0


def test_contract_order():
    assert len(C.FEATURES) == len(set(C.FEATURES)) == 38
    assert C.FEATURES[:3] == ["city", "bd", "gender"] and C.FEATURES[-1] == "listens_per_unique_track"


def test_halving_spends_its_budget_and_equals_fits_on_the_samples(spark, parts):
    assert models.halving_rungs(9, 3.0) == [(9, 1 / 9), (3, 1 / 3), (1, 1.0)]
    assert models.halving_rungs(1, 0.5) == [(1, 0.5)]
    for n, budget in ((2, 0.7), (10, 2.0), (40, 8.0)):
        rungs = models.halving_rungs(n, budget)
        assert sum(k * s for k, s in rungs) <= budget + 1e-9 and [s for _, s in rungs] == sorted(s for _, s in rungs)
    train, valid = parts
    trials = [("a flat", models.decision_tree(maxDepth=0)), ("b gender", models.decision_tree(maxDepth=3), ["gender"]),
              ("c deep", models.decision_tree(maxDepth=6, minInstancesPerNode=5)), ("d stump", models.decision_tree(maxDepth=1))]
    rows = models.halving_search(train, valid, trials, 3.0, keep=2, features=FEATURES).collect()
    assert [(r.rung, r.share) for r in rows] == [(0, 0.25)] * 4 + [(1, 0.5)] * 2 + [(2, 1.0)]
    assert [r.trial for r in rows if r.rung == 2 and r.kept] == ["c deep"]
    estimators = {t[0]: (t[1], t[2] if len(t) > 2 else FEATURES) for t in trials}
    for rung, share in ((0, 0.25), (1, 0.5)):
        found = [r for r in rows if r.rung == rung]
        best = sorted(found, key=lambda r: (-r.average_precision, r.trial))
        assert {r.trial for r in found if r.kept} == {r.trial for r in best[:len(found) // 2]}
        sample = train.where(X.hash_fraction(F.col("msno"), 42) < share)
        for r in found:
            estimator, mine = estimators[r.trial]
            scored = models.score(models.fit(sample, estimator, mine), valid, ["msno", "is_churn"], mine)
            assert metrics.ranking_metrics(scored, "y_proba", "is_churn").first().average_precision == pytest.approx(r.average_precision)
    for bad in ((trials, 0), ([], 1.0), ([trials[0], trials[0]], 1.0)):
        with pytest.raises(ValueError):
            models.halving_search(train, valid, *bad, features=FEATURES)


@pytest.mark.parametrize("make", [
    lambda: models.boosted_trees(maxIter=5, featureSubsetStrategy="all", minInstancesPerNode=1),
    lambda: models.logistic_regression(tol=1e-12, maxIter=300), lambda: models.decision_tree(minInstancesPerNode=1),
    lambda: models.random_forest(numTrees=3, minInstancesPerNode=1, bootstrap=False, featureSubsetStrategy="all")])
def test_equal_rows_are_fitted_as_one(spark, table, monkeypatch, make):
    """Fits on strings alone go over the different rows, with the scores of fits on all of them; others keep every row."""
    rows = table.select("msno", "gender", F.when(F.col("txn_cnt") % 7 < 6, (F.col("txn_cnt") % 7).cast("string")).alias("kind"), "is_churn")
    seen, merged = [], models._merged
    monkeypatch.setattr(models, "_merged", lambda *a: seen.append(merged(*a)) or seen[-1])

    def scores(*how):
        fitted = models.fit(rows, make(), ["gender", "kind"], *how)
        return [r.y_proba for r in models.score(fitted, rows, ["msno"], ["gender", "kind"]).orderBy("msno").collect()]

    short = scores()
    assert len(seen) == 1 and seen[0][0].count() <= 3 * 7 * 2
    monkeypatch.setattr(models, "counts_as_rows", lambda _: False)
    assert scores() == pytest.approx(short, abs=1e-6) and len(seen) == 1


def test_rows_are_merged_only_where_weights_are_numbers_of_rows(spark, table):
    assert not any(map(models.counts_as_rows, [models.random_forest(minInstancesPerNode=1), models.decision_tree(), models.boosted_trees(),
                                               models.boosted_trees(minInstancesPerNode=1, subsamplingRate=0.5)]))
    one = table.select(F.lit("x").alias("gender"), F.lit(1).alias("is_churn"))  # a single different row
    model = models.fit(one, models.boosted_trees(maxIter=2, minInstancesPerNode=1), ["gender"])
    assert models.score(model, one, ["is_churn"], ["gender"]).where("y_proba > 0.5").count() == 1500


def test_a_forest_grows_in_portions_that_fit(spark, parts, monkeypatch, tmp_path):
    """Counts and node numbers kept at once follow FOREST_CELLS, not rows x trees; all trees vote, also from the saved model."""
    assert models.forest_portions(1000, 600) == [600] and models.forest_portions(0, 3) == [3]
    assert models.forest_portions(4_500_000, 600) == [54, 55, 54, 55, 54, 55, 54, 55, 54, 55, 55] and models.forest_portions(1 << 40, 3) == [1, 1, 1]
    train, valid = parts
    monkeypatch.setattr(models, "FOREST_CELLS", 4 * train.count())
    model = models.fit(train, models.random_forest(numTrees=10, maxDepth=5, minInstancesPerNode=5), FEATURES)
    grown = [m for m in model.stages if hasattr(m, "getNumTrees")]
    assert [m.getNumTrees for m in grown] == [3, 3, 4]
    assert models.model_importance(model, train, 20, FEATURES).first().feature in ("txn_cnt", "cancel_rate")
    assert quality(model, valid).average_precision > 0.9
    model.write().save(f"{tmp_path}/forest")
    for m in (model, PipelineModel.load(f"{tmp_path}/forest")):
        out = m.transform(models.as_model_input(valid, FEATURES)).select("features", "probability", "prediction").limit(20).collect()
        for r in out:
            votes = sum(p.predictRaw(r.features).toArray() for p in grown)
            assert r.probability.toArray() == pytest.approx(votes / 10) and r.prediction == votes.argmax()


def test_a_search_prepares_features_once(parts, monkeypatch):
    """Every trial is fitted on the same prepared rows, and scores as a fit of its own does."""
    train, valid = parts
    calls, prepared = [], models._prepared
    monkeypatch.setattr(models, "_prepared", lambda *a: calls.append(a) or prepared(*a))
    trials = [("tree", models.decision_tree(maxDepth=4, minInstancesPerNode=1)), ("linear", models.logistic_regression()),
              ("stump", models.decision_tree(maxDepth=1, minInstancesPerNode=1))]
    got = {r.trial: r.average_precision for r in models.model_search(train, valid, trials, features=FEATURES).collect()}
    assert len(calls) == 1
    for name, estimator in trials:
        assert quality(models.fit(train, estimator, FEATURES), valid).average_precision == pytest.approx(got[name])
