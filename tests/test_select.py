"""Exact selection by refining bins: codes of doubles, quantiles, two-sample gaps, and the work they do."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.functions.columns import order_code
from churnspark.operators import monitor, profile, select

ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
       float("inf"), float("-inf"), 0.1, 1 / 3, 2.0 ** 53, 2.0 ** 53 - 1, 1e300, -1e-300, 4503599627370497.5, 123456789.0]


def code(x):
    bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -bits if x < 0 else bits


def test_codes_are_the_bits_of_the_double(spark):
    rng = np.random.Generator(np.random.PCG64(4))
    values = ODD + [2.0 ** k for k in range(-1074, 1024)] + [float(np.nextafter(2.0 ** k, 0)) for k in range(-1021, 1024)]
    values += [v for v in rng.integers(-2**63, 2**63, 3000).view(np.float64).tolist() if v == v]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", order_code(F.col("x")).alias("c")).collect()
    assert [r.c for r in rows] == [code(v) for v in values]


def samples(seed=1, n=3000):
    rng = np.random.Generator(np.random.PCG64(seed))
    return {
        "dense": rng.random(n), "ties": np.round(rng.random(n), 1), "near_zero": rng.random(n) * 1e-9, "wide": rng.normal(size=n) * 10.0 ** rng.integers(-30, 30, n),
        "whole": rng.integers(-50, 50, n).astype(float), "same": np.full(n, 7.25), "hot": np.where(rng.random(n) < .6, 3.0, rng.random(n)),
        "close": 1.0 + np.arange(n) * 2.0 ** -52, "two": np.array([1.0, 2.0] * (n // 2)),
    }


def long(spark, columns, side=None):
    rows = [(name, float(v)) for name, values in columns.items() for v in values]
    df = spark.createDataFrame(rows, "feature string, value double")
    return df if side is None else df.withColumns({"a": F.lit(side), "b": F.lit(1 - side)})


def test_quantiles_as_numpy(spark):
    columns, qs = samples(), [0.0, 0.001, 0.25, 0.5, 0.6181, 0.99, 1.0]
    rows = long(spark, columns).unionByName(spark.createDataFrame([("dense", None), ("none", None), ("dense", float("nan"))], "feature string, value double"))
    got = {r.feature: r.quantiles for r in select.exact_quantiles(rows, "value", qs, ["feature"]).collect()}
    assert set(got) == set(columns)
    for name, values in columns.items():
        ordered, last = np.sort(values), len(values) - 1
        want = [ordered[int(np.floor(q * last))] + (ordered[int(np.ceil(q * last))] - ordered[int(np.floor(q * last))]) * (q * last - np.floor(q * last)) for q in qs]
        assert got[name] == want, name
    assert select.exact_quantiles(rows.where("value IS NULL"), "value", [0.5]).collect() == []
    assert select.exact_quantiles(rows.where("feature = 'two'"), "value", [0.5]).first()["quantiles"] == [1.5]


@pytest.mark.parametrize("shift", [0.0, 0.03])
def test_gap_as_sorting(spark, shift):
    one, two = samples(1), {k: v + shift for k, v in samples(2, 1000).items()}
    both = long(spark, one, 1).unionByName(long(spark, two, 0))
    got = {r.feature: r for r in select.largest_gap(both, "value", "a", "b", ["feature"]).collect()}
    for name in one:
        grid = np.unique(np.concatenate([one[name], two[name]]))
        a, b = (np.searchsorted(np.sort(x), grid, side="right") / len(x) for x in (one[name], two[name]))
        assert (got[name].all_a, got[name].all_b) == (3000, 1000)
        assert got[name].gap == pytest.approx(np.abs(a - b).max(), abs=1e-12), name


def test_gap_without_a_second_sample(spark):
    only = long(spark, {"x": [1.0, 2.0]}, 1)
    assert select.largest_gap(only, "value", "a", "b", ["feature"]).first().gap is None


class Work:
    """Physical plans and shuffled rows of everything that runs inside."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.store = self.spark._jsparkSession.sharedState().statusStore()
        self.before = self.store.executionsCount()
        return self

    def __exit__(self, *_):
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = self.store.executionsList(int(self.before), 1000)
        self.plans = [found.apply(i).physicalPlanDescription() for i in range(found.size())]


def test_nothing_is_ordered_but_bins(spark):
    n = 200_000
    df = spark.range(n).select(F.lit("x").alias("feature"), (F.abs(F.xxhash64("id")) / 2.0 ** 63).alias("value"))
    with Work(spark) as work:
        got = select.exact_quantiles(df, "value", [0.25, 0.5], ["feature"]).first()["quantiles"]
    assert got == pytest.approx([0.25, 0.5], abs=0.01)
    assert work.plans and not any("rangepartitioning" in p for p in work.plans)


def test_describe_and_drift_on_selected_values(spark):
    columns = samples()
    n = len(columns["dense"])
    rows = spark.createDataFrame([tuple(float(columns[c][i]) for c in columns) for i in range(n)], ", ".join(f"{c} double" for c in columns))
    got = {r.feature: r for r in profile.describe_numeric(rows, list(columns)).collect()}
    for c, values in columns.items():
        assert (got[c].p25, got[c].p50, got[c].p75) == pytest.approx(tuple(np.quantile(values, (.25, .5, .75))), rel=1e-12)
    ks = {r.feature: r.ks for r in monitor.feature_ks(rows, rows, list(columns)).collect()}
    assert set(ks.values()) == {0.0}
