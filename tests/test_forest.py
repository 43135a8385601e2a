"""Forests too large for Spark's own growing: the same trees, without a pass over the rows for every level."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnspark.operators import forest, models

FEATURES = ["txn_cnt", "cancel_rate", "gender"]


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(2400).select(
        F.col("id").alias("msno"), (F.col("id") * 13 % 101).alias("txn_cnt"),
        F.when(F.col("id") % 9 != 0, F.abs(F.xxhash64("id") % 1000) / 1000.0).alias("cancel_rate"),
        F.when(F.col("id") % 3 == 0, "male").when(F.col("id") % 3 == 1, "female").otherwise("unknown").alias("gender"))
    churn = ((F.col("txn_cnt") < 30) & (F.coalesce("cancel_rate", F.lit(0.0)) > 0.3)) | ((F.col("gender") == "male") & (F.col("msno") * 7 % 11 < 4))
    return rows.withColumn("is_churn", F.coalesce(churn, F.lit(False)).cast("int")).cache()


def scores(model, table):
    return {r.msno: r.y_proba for r in models.score(model, table, ["msno"], FEATURES).collect()}


def transformed(model, table):
    out = model.transform(models.as_model_input(table, FEATURES)).select("msno", vector_to_array("probability")[1].alias("p"))
    return {r.msno: r.p for r in out.collect()}


def test_a_large_forest_has_the_trees_of_sparks_forest(table, monkeypatch):
    """Without chance both forests are the same: bins, gains, least rows, merged leaves, importances."""
    estimator = models.random_forest(numTrees=2, maxDepth=7, minInstancesPerNode=8, bootstrap=False, featureSubsetStrategy="all")
    whole = models.fit(table, estimator, FEATURES)
    monkeypatch.setattr(models, "FOREST_CELLS", table.count())
    large = models.fit(table, estimator, FEATURES)
    assert [m.getNumTrees for m in large.stages[-3:-1]] == [1, 1] and large.stages[-2].totalNumNodes == whole.stages[-1].trees[0].numNodes > 30
    expected = scores(whole, table)
    assert len(set(expected.values())) > 15
    assert scores(large, table) == pytest.approx(expected, abs=1e-12) and transformed(large, table) == pytest.approx(expected, abs=1e-12)
    one, two = ({r.feature: r.importance for r in models.model_importance(m, table, 20, FEATURES).collect()} for m in (whole, large))
    assert two == pytest.approx(one, abs=1e-9)


def test_deeper_trees_need_no_more_jobs(spark, table, monkeypatch):
    """The rows are not read again for each level of a large forest's trees."""
    monkeypatch.setattr(models, "FOREST_CELLS", 3 * table.count())

    def jobs(depth):
        before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
        models.fit(table, models.random_forest(numTrees=6, maxDepth=depth, minInstancesPerNode=4), FEATURES)
        return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - before

    assert jobs(8) == jobs(1)


def test_portions_of_sparks_own_trees_vote_alike(table, monkeypatch):
    """What only Spark's forest does (here another impurity) grows in portions; its splits by category are scored as it scores them."""
    monkeypatch.setattr(models, "FOREST_CELLS", 3 * table.count())
    model = models.fit(table, models.random_forest(numTrees=6, maxDepth=5, minInstancesPerNode=5, impurity="entropy"), FEATURES)
    assert any("in {" in m.toDebugString for m in model.stages if hasattr(m, "getNumTrees"))
    assert scores(model, table) == pytest.approx(transformed(model, table), abs=1e-12)


def test_rows_are_resampled_for_every_tree():
    """Trees differ, and a node's rows are as many as were drawn for it, also where few of many rows are copied side by side."""
    n, lines = 4000, 5
    rng = np.random.Generator(np.random.PCG64(3))
    y = (rng.random(n) < 0.3).astype(np.uint8)
    codes = np.stack([2 * rng.integers(0, 16, n).astype(np.uint8) + y for _ in range(lines)])
    rules = forest.Rules(8, 3, tuple(range(lines)), tuple(np.arange(15) + 0.5 for _ in range(lines)), (1.0, 2.0), 12, 20, 0.0, 0.0, True, 1.0, 42)
    grown = []
    for near in (1 << 18, 100):
        forest.NEAR, near = near, forest.NEAR
        with np.errstate(invalid="ignore"):
            grown.append([forest.grow_tree(codes, rules, tree) for tree in (0, 1)])
        forest.NEAR = near
    for first, second in zip(*grown):
        assert first["feature"] == second["feature"] and first["bin"] == second["bin"]
    one, other = grown[0]
    assert one["feature"] != other["feature"]
    assert abs(one["counts"][0].sum() - n) < 5 * n ** 0.5
    for i, left in enumerate(one["left"]):
        if left >= 0:
            assert (one["counts"][left] + one["counts"][one["right"][i]]).tolist() == one["counts"][i].tolist()
            assert min(one["counts"][left].sum(), one["counts"][one["right"][i]].sum()) >= 20
