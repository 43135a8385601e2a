"""Registered queries: pyspark.ml training, scoring, contributions, calibration, backtests.

Iterative fits have no SQL equivalent; where one exists, the result on top of the fit is checked in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.functions import scorecard as S
from churnspark.operators import calibration, metrics, models, policy, sampling
from churnspark.plans.adapters import Tables
from churnspark.plans.queries_score import CARD_DAY, K, _CARD, action_sql, scored_table
from churnspark.plans.registry import hash_sql, oracle, query, r6
from churnspark.sources.staging import stage

CUTOFF = "2001-05-31"


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Time split of the model table, written once: every fit below reads it several times."""
    rows = stage(sampling.time_split(t.model_table, C.TIME, CUTOFF).drop("split_method", "cutoff_date"), "split")
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'valid'").drop("split")


def _scored(model, valid: DataFrame) -> DataFrame:
    out = models.score(model, valid, [C.KEY, C.TIME, C.LABEL])
    return out.withColumnRenamed(C.LABEL, "y_true")


@query("ml_logreg")
def ml_logreg(t: Tables) -> DataFrame:
    train, valid = _split(t)
    return _scored(models.fit(train, models.logistic_regression(), scale=True), valid)


@query("ml_tree")
def ml_tree(t: Tables) -> DataFrame:
    train, valid = _split(t)
    return _scored(models.fit(train, models.decision_tree()), valid)


@query("ml_forest")
def ml_forest(t: Tables) -> DataFrame:
    train, valid = _split(t)
    return _scored(models.fit(train, models.random_forest()), valid)


def _boosted(t: Tables):
    train, valid = _split(t)
    # A hash-chosen tenth of the training rows stops the boosting early.
    marked = sampling.stratified_split(train, 0.1, C.LABEL, C.KEY).withColumn("held", F.col("split") == "valid").drop("split")
    return models.fit(marked, models.boosted_trees(validationIndicatorCol="held")), valid


@query("ml_gbt")
def ml_gbt(t: Tables) -> DataFrame:
    model, valid = _boosted(t)
    return _scored(model, valid)


@query("contrib_tree")
def contrib_tree(t: Tables) -> DataFrame:
    model, valid = _boosted(t)
    rows = models.tree_contributions(model, valid).withColumn("top", S.top_contributions(F.col("contributions"), 5))
    return S.rows_of(rows, [C.KEY, "y_proba", "base_value"], "top")


@query("contrib_linear")
def contrib_linear(t: Tables) -> DataFrame:
    train, valid = _split(t)
    rows = models.linear_contributions(models.fit(train, models.logistic_regression(), scale=True), valid)
    return S.rows_of(rows.withColumn("top", S.top_contributions(F.col("contributions"), 5)), [C.KEY, "y_proba", "base_value"], "top")


@query("model_importance")
def model_importance(t: Tables) -> DataFrame:
    train, _ = _split(t)
    return models.model_importance(models.fit(train, models.decision_tree()), train, 20)


@query("model_search")
def model_search(t: Tables) -> DataFrame:
    train, valid = _split(t)
    grid = [(d, n) for d in (3, 5, 7) for n in (100, 500)]
    trials = [(f"tree depth {d}, leaf {n}", models.decision_tree(maxDepth=d, minInstancesPerNode=n)) for d, n in grid]
    trials.append(("logistic regression", models.logistic_regression()))
    return models.model_search(train, valid, trials)


@query("scorecard_batch", oracle(
    f"""SELECT msno, txn_last_date, is_churn AS y_true, {r6('floor(p * 10000 + 0.5) / 10000', 'y_proba')},
    {action_sql('floor(p * 10000 + 0.5) / 10000')} AS action FROM explained JOIN (SELECT msno, txn_last_date, is_churn FROM model_table) USING (msno)
    WHERE txn_last_date > 20010531""", "model_table", ctes=_CARD))
def scorecard_batch(t: Tables) -> DataFrame:
    rows = S.with_scorecard(t.model_table, CARD_DAY).where("txn_last_date > 20010531")
    return policy.assign_action(rows.select(C.KEY, C.TIME, F.col(C.LABEL).alias("y_true"), "y_proba"))


# Isotonic regression in closed form: the largest, over starts at or before a point, of the smallest mean up to an end at
# or after it; between fitted points, linear.
_ISOTONIC = (
    "pts AS (SELECT y_proba AS x, count(*) AS n, sum(y_true) AS s FROM scored WHERE cycle < 20240116 AND y_proba IS NOT NULL GROUP BY 1)",
    """o AS (SELECT x, n, s, row_number() OVER (ORDER BY x) AS k, sum(n) OVER (ORDER BY x) AS cn, sum(s) OVER (ORDER BY x) AS cs FROM pts)""",
    """m AS (SELECT a.k AS i, b.k AS k, min((b.cs - a.cs + a.s) / CAST(b.cn - a.cn + a.n AS DOUBLE)) OVER (PARTITION BY a.k ORDER BY b.k DESC) AS v
      FROM o a JOIN o b ON b.k >= a.k)""",
    "fitted AS (SELECT o.x, max(m.v) AS g FROM m JOIN o ON o.k = m.k GROUP BY o.x)",
    "later AS (SELECT id, y_true, y_proba FROM scored WHERE cycle >= 20240116)",
)


@query("calibrate", oracle(
    f"""SELECT id, y_true, {r6('y_proba', 'y_proba')}, {r6("""CASE WHEN lo.x IS NULL THEN hi.g WHEN hi.x IS NULL OR hi.x = lo.x THEN lo.g
      ELSE lo.g + (hi.g - lo.g) * (y_proba - lo.x) / (hi.x - lo.x) END""", 'calibrated')}
    FROM later ASOF LEFT JOIN fitted lo ON y_proba >= lo.x ASOF LEFT JOIN fitted hi ON y_proba <= hi.x""", "scored", ctes=_ISOTONIC))
def calibrate(t: Tables) -> DataFrame:
    """Fit on the earlier window, apply to the later one."""
    rows = t.scored.withColumn("y_proba", F.col("y_proba").cast("double"))
    fitted = calibration.fit_calibration(rows.where("cycle < 20240116"))
    return calibration.calibrate(rows.where("cycle >= 20240116").select("id", "y_true", "y_proba"), fitted)


@query("reliability_table", oracle(
    f"""SELECT CASE WHEN y_proba IS NULL THEN -1 ELSE CAST(least(floor(y_proba * 10), 9) AS INT) END AS bin, count(*) AS n, {r6('avg(y_proba)', 'mean_score')},
    {r6('avg(CAST(y_true AS DOUBLE))', 'observed_rate')} FROM scored GROUP BY 1""", "scored"))
def reliability_table(t: Tables) -> DataFrame:
    return models.reliability_table(scored_table(t))


# ---- fits with a closed form -----------------------------------------------------------------------------------------
# With one string feature every value has a slot of its own, and an unregularised fit gives each value its (weighted) share
# of positives. The whole path is the one of any model: preparation, fit, a PipelineModel, its transform.

GROUP = ["segment"]
DAY = 20240116


def _grouped(t: Tables) -> DataFrame:
    return t.scored.select("id", "segment", "cycle", F.col("y_true").alias(C.LABEL))


def _share_sql(where: str) -> str:
    """Balanced share of positives by segment among the training rows."""
    return f"""(SELECT segment, (pos / CAST(P AS DOUBLE)) / (pos / CAST(P AS DOUBLE) + (n - pos) / CAST(A - P AS DOUBLE)) AS p FROM
      (SELECT segment, count(*) AS n, sum(y_true) AS pos FROM scored WHERE {where} GROUP BY segment),
      (SELECT count(*) AS A, sum(y_true) AS P FROM scored WHERE {where}))"""


def _group_oracle(digits: int) -> str:
    return oracle(f"SELECT id, y_true, CAST(round(p, {digits}) AS DOUBLE) AS y_proba FROM scored JOIN {_share_sql(f'cycle < {DAY}')} USING (segment) "
                  f"WHERE cycle >= {DAY}", "scored")


def _saturated():
    """Logistic regression that runs until nothing moves."""
    return models.logistic_regression(tol=1e-12, maxIter=500)


def _group_scores(t: Tables, estimator, digits: int = 6) -> DataFrame:
    rows = _grouped(t)
    model = models.fit(rows.where(f"cycle < {DAY}"), estimator, GROUP)
    out = models.score(model, rows.where(f"cycle >= {DAY}"), ["id", C.LABEL], GROUP)
    return out.select("id", F.col(C.LABEL).alias("y_true"), F.round("y_proba", digits).alias("y_proba"))


@query("ml_logreg_groups", _group_oracle(4))
def ml_logreg_groups(t: Tables) -> DataFrame:
    return _group_scores(t, _saturated(), 4)


# Trees merge leaves of one class, so the class of a group is what they fix, not its share.
_CLASSES = oracle(f"SELECT id, y_true, CAST(p > 0.5 AS INT) AS predicted FROM scored JOIN {_share_sql(f'cycle < {DAY}')} USING (segment) "
                  f"WHERE cycle >= {DAY}", "scored")


def _group_classes(t: Tables, estimator) -> DataFrame:
    return _group_scores(t, estimator).select("id", "y_true", (F.col("y_proba") > 0.5).cast("int").alias("predicted"))


@query("ml_tree_groups", _CLASSES)
def ml_tree_groups(t: Tables) -> DataFrame:
    return _group_classes(t, models.decision_tree(minInstancesPerNode=1))


@query("ml_forest_groups", _CLASSES)
def ml_forest_groups(t: Tables) -> DataFrame:
    """Without resampling every tree is the same."""
    return _group_classes(t, models.random_forest(numTrees=5, minInstancesPerNode=1, bootstrap=False, featureSubsetStrategy="all"))


_BOOSTED = (
    f"share AS (SELECT segment, avg(CAST(y_true AS DOUBLE)) AS p FROM scored WHERE cycle < {DAY} GROUP BY segment)",
    f"""steps AS (WITH RECURSIVE s AS (SELECT segment, p, 1 AS m, 2 * p - 1 AS f FROM share UNION ALL
          SELECT segment, p, m + 1, f + {models.CHAMPION["stepSize"]!r} * (p * 4 / (1 + exp(2 * f)) - (1 - p) * 4 / (1 + exp(-2 * f)))
          FROM s WHERE m < {models.CHAMPION["maxIter"]}) SELECT * FROM s)""")


@query("ml_gbt_groups", oracle(
    f"""SELECT id, y_true, CAST(round(1 / (1 + exp(-2 * f)), 5) AS DOUBLE) AS y_proba FROM scored JOIN steps USING (segment)
    WHERE cycle >= {DAY} AND m = {models.CHAMPION["maxIter"]}""", "scored", ctes=_BOOSTED))
def ml_gbt_groups(t: Tables) -> DataFrame:
    """Boosting with a leaf for every group: each step moves a group by its mean residual."""
    return _group_scores(t, models.boosted_trees(featureSubsetStrategy="all", minInstancesPerNode=1), 5)


@query("contrib_groups", oracle(
    f"""SELECT id, CAST(round(p, 4) AS DOUBLE) AS y_proba, TRUE AS adds_up, CAST(5 AS BIGINT) AS n_slots
    FROM scored JOIN {_share_sql(f'cycle < {DAY}')} USING (segment) WHERE cycle >= {DAY}""", "scored"))
def contrib_groups(t: Tables) -> DataFrame:
    """Contributions and base value add up to the log-odds of the score, row by row."""
    rows = _grouped(t)
    model = models.fit(rows.where(f"cycle < {DAY}"), _saturated(), GROUP)
    out = models.linear_contributions(model, rows.where(f"cycle >= {DAY}"), ["id"], GROUP)
    total = F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c["contribution"])
    return out.select("id", F.round("y_proba", 4).alias("y_proba"), (F.abs(1 / (1 + F.exp(-total)) - F.col("y_proba")) < 1e-9).alias("adds_up"),
                      F.size("contributions").cast("bigint").alias("n_slots"))


@query("contrib_tree_groups", oracle(
    f"""SELECT id, CAST(round(1 / (1 + exp(-2 * f)), 5) AS DOUBLE) AS y_proba, TRUE AS adds_up, CAST(5 AS BIGINT) AS n_slots
    FROM scored JOIN steps USING (segment) WHERE cycle >= {DAY} AND m = 20""", "scored", ctes=_BOOSTED))
def contrib_tree_groups(t: Tables) -> DataFrame:
    """Shapley values of boosted trees and the expected score add up to the log-odds of the score, row by row."""
    rows = _grouped(t)
    model = models.fit(rows.where(f"cycle < {DAY}"), models.boosted_trees(maxIter=20, featureSubsetStrategy="all", minInstancesPerNode=1), GROUP)
    out = models.tree_contributions(model, rows.where(f"cycle >= {DAY}"), ["id"], GROUP)
    total = F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c["contribution"])
    return out.select("id", F.round("y_proba", 5).alias("y_proba"), (F.abs(1 / (1 + F.exp(-total)) - F.col("y_proba")) < 1e-9).alias("adds_up"),
                      F.size("contributions").cast("bigint").alias("n_slots"))


@query("batch_score", oracle(
    f"""SELECT id, segment, cycle, y_true, CAST(round(p, 4) AS DOUBLE) AS y_proba, {action_sql('round(p, 4)')} AS action FROM scored
    JOIN {_share_sql(f'cycle < {DAY}')} USING (segment) WHERE cycle >= {DAY}""", "scored"))
def batch_score(t: Tables) -> DataFrame:
    """Fit, score the later rows with their inputs beside the score, assign actions."""
    rows = _grouped(t)
    model = models.fit(rows.where(f"cycle < {DAY}"), _saturated(), GROUP)
    out = models.score(model, rows.where(f"cycle >= {DAY}"), ["id", "segment", "cycle", C.LABEL], GROUP)
    return policy.assign_action(out.withColumnRenamed(C.LABEL, "y_true").withColumn("y_proba", F.round("y_proba", 4)))


_WINDOWS = ((20240110, 20240115), (20240115, 20240120), (20240120, 99999999))


def _backtest_sql(a: int, b: int) -> str:
    rows = f"(SELECT id, y_true, round(p, 4) AS p FROM scored JOIN {_share_sql(f'cycle <= {a}')} USING (segment) WHERE cycle > {a} AND cycle <= {b})"
    return f"""SELECT CAST({a} AS INT) AS cutoff, CAST(count(*) AS BIGINT) AS valid_rows, CAST(sum(y_true) AS BIGINT) AS positives,
        {r6('avg(p)', 'mean_score')}, (SELECT {r6('sum(y_true) / 50e0', 'x')} FROM (SELECT y_true FROM {rows} ORDER BY p DESC, id LIMIT 50)) AS precision_at_50
        FROM {rows}"""


@query("rolling_backtest", oracle(" UNION ALL ".join(_backtest_sql(a, b) for a, b in _WINDOWS), "scored"))
def rolling_backtest(t: Tables) -> DataFrame:
    """A model for each cutoff, from the rows up to it."""
    rows = _grouped(t).withColumn("y_true", F.col(C.LABEL))
    means = []

    def predict(train: DataFrame, valid: DataFrame) -> DataFrame:
        out = models.score(models.fit(train, _saturated(), GROUP), valid, ["id", "y_true"], GROUP)
        out = out.withColumn("y_proba", F.round("y_proba", 4))
        means.append(out.agg(F.avg("y_proba").alias("mean_score")))
        return out

    out = models.rolling_backtest(rows, [a for a, _ in _WINDOWS], "cycle", predict, ks=[50], id="id")
    mean = None
    for (a, _), one in zip(_WINDOWS, means):
        one = one.withColumn("cutoff", F.lit(a))
        mean = one if mean is None else mean.unionByName(one)
    return out.join(mean, "cutoff").select("cutoff", "valid_rows", "positives", "mean_score", F.col("precision_at_k")[50].alias("precision_at_50"))


def _halving_sql(share: float) -> str:
    return f"(SELECT count(*) FROM scored WHERE cycle < {DAY} AND {hash_sql('id')} < {share!r})"


@query("model_search_budget", oracle(
    f"""SELECT CAST(0 AS INT) AS rung, 'constant' AS trial, 0.25e0 AS share, {r6('(SELECT avg(CAST(y_true AS DOUBLE)) FROM scored WHERE cycle >= ' + str(DAY) + ')', 'base_rate')},
      {_halving_sql(0.25)} AS n_rows, FALSE AS kept
    UNION ALL SELECT 0, 'segment', 0.25e0, NULL, {_halving_sql(0.25)}, TRUE
    UNION ALL SELECT 1, 'segment', 0.5e0, NULL, {_halving_sql(0.5)}, TRUE""", "scored"))
def model_search_budget(t: Tables) -> DataFrame:
    """Successive halving within one reading of the training rows. The trial without splits scores the share of positives."""
    rows = _grouped(t)
    train, valid = rows.where(f"cycle < {DAY}"), rows.where(f"cycle >= {DAY}")
    trials = [("constant", models.decision_tree(maxDepth=0)), ("segment", _saturated())]
    found = models.halving_search(train, valid, trials, 1.0, id="id", keep=2, features=GROUP)
    place = stage(train.select(X.hash_fraction(F.col("id"), 42).alias("p")), "places")
    sizes = place.agg(*[F.count_if(F.col("p") < s).alias(str(s)) for s in (0.25, 0.5)])
    n_rows = F.when(F.col("share") == 0.25, F.col("`0.25`")).otherwise(F.col("`0.5`"))
    base = F.when(F.col("trial") == "constant", F.col("average_precision"))
    return found.crossJoin(F.broadcast(sizes)).select("rung", "trial", "share", base.alias("base_rate"), n_rows.alias("n_rows"), "kept")


@query("evaluate_logreg")
def evaluate_logreg(t: Tables) -> DataFrame:
    train, valid = _split(t)
    scored = _scored(models.fit(train, models.logistic_regression(), scale=True), valid)
    return metrics.evaluate(stage(scored, "scored"), 0.5, [K], id=C.KEY).drop("precision_at_k", "recall_at_k")
