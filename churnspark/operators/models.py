"""Training and scoring with pyspark.ml, ensembles of scores, contributions, calibration, backtests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations
from math import factorial

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.functions.scorecard import rows_of
from churnspark.operators import forest
from churnspark.operators.calibration import calibrate, fit_calibration  # noqa: F401  also found here
from churnspark.operators.encode import with_balanced_weight
from churnspark.operators.metrics import evaluate, metrics_of_groups, ranking_metrics
from churnspark.operators.rank import clean_score, running_totals
from churnspark.sources.staging import stage, stage_path


# The parameters of the champion model.
CHAMPION = {"maxIter": 146, "stepSize": 0.03583753342568752, "maxBins": 1023, "minInstancesPerNode": 28,
            "featureSubsetStrategy": "0.784575377162775"}


def string_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [f for f in features if kinds[f] == "string"]


def as_model_input(df: DataFrame, features: Sequence[str] = tuple(C.FEATURES)) -> DataFrame:
    """Numeric features as doubles, as pyspark.ml expects them, each with a ``<f>_missing`` indicator."""
    kinds, strings = dict(df.dtypes), string_features(df, features)
    numeric = [f for f in features if f not in strings]
    marked = df.withColumns({f"{f}_missing": X.is_missing(F.col(f), kinds[f]).cast("double") for f in numeric})
    return marked.withColumns({f: F.col(f).cast("double") for f in numeric})


def feature_stages(numeric: Sequence[str], strings: Sequence[str], scale: bool = False) -> list:
    """Median imputation with indicators, most frequent strings, one slot per training category, assembly.

    An unseen string has no slot. ``scale`` divides the numeric features by their deviation, not the rest.
    """
    stages = []
    if numeric:
        stages = [Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"{f}_imp" for f in numeric]),
                  VectorAssembler(inputCols=[f"{f}_imp" for f in numeric], outputCol="numeric_raw" if scale else "numeric", handleInvalid="keep")]
        if scale:
            stages.append(StandardScaler(inputCol="numeric_raw", outputCol="numeric", withMean=False, withStd=True))
    for f in strings:
        # Index 0 is the most frequent value; a missing one takes it, an unseen one is past the last slot.
        stages += [StringIndexer(inputCol=f, outputCol=f"{f}_idx", handleInvalid="keep", stringOrderType="frequencyDesc"),
                   SQLTransformer(statement=f"SELECT *, CASE WHEN `{f}` IS NULL THEN 0D ELSE `{f}_idx` END AS `{f}_at` FROM __THIS__"),
                   OneHotEncoder(inputCol=f"{f}_at", outputCol=f"{f}_hot", dropLast=True, handleInvalid="keep")]
    inputs = (["numeric"] if numeric else []) + [f"{f}_missing" for f in numeric] + [f"{f}_hot" for f in strings]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


def logistic_regression(**params) -> Estimator:
    return LogisticRegression(**({"maxIter": 100, "labelCol": C.LABEL, "weightCol": "weight"} | params))


def decision_tree(**params) -> Estimator:
    defaults = {"maxDepth": 5, "minInstancesPerNode": 500, "labelCol": C.LABEL, "weightCol": "weight", "seed": 42}
    return DecisionTreeClassifier(**(defaults | params))


def random_forest(**params) -> Estimator:
    defaults = {"numTrees": 600, "maxDepth": 30, "minInstancesPerNode": 500, "labelCol": C.LABEL,
                "weightCol": "weight", "seed": 42, "cacheNodeIds": True, "checkpointInterval": 10}
    return RandomForestClassifier(**(defaults | params))


def boosted_trees(**params) -> Estimator:
    """Gradient boosting; pass ``validationIndicatorCol`` for early stopping on marked rows.

    Trees grow level by level here; ten levels hold about as many leaves as the reference model's 1,212.
    """
    return GBTClassifier(**({"maxDepth": 10, "labelCol": C.LABEL, "seed": 42} | CHAMPION | params))


def evenly(df: DataFrame) -> DataFrame:
    """The rows in equal parts, one for each core: every pass of a fit is one round of equal tasks, whatever files they came in."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def counts_as_rows(estimator: Estimator) -> bool:
    """Whether a row of weight n is to the estimator what n equal rows are. Resampling draws rows, and the least number of rows
    of a node counts them unweighted."""
    if isinstance(estimator, LogisticRegression):
        return True
    if isinstance(estimator, RandomForestClassifier) and estimator.getBootstrap():
        return False
    trees = isinstance(estimator, (DecisionTreeClassifier, RandomForestClassifier, GBTClassifier))
    return trees and estimator.getMinInstancesPerNode() == 1 and (isinstance(estimator, DecisionTreeClassifier) or estimator.getSubsamplingRate() == 1)


def _merged(rows: DataFrame, estimator: Estimator) -> tuple[DataFrame, Estimator]:
    """Equal rows as one whose weight is their number, or their sum of weights."""
    weighted = estimator.hasParam("weightCol") and estimator.isDefined("weightCol")
    name = estimator.getOrDefault("weightCol") if weighted else "_n"
    each = F.col(name) * F.col("_rows") if weighted else F.col("_rows").cast("double")
    merged = stage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_rows")).withColumn(name, each).drop("_rows"), "merged")
    if merged.limit(2).count() < 2:  # trees take no more bins than rows, and need two
        return rows, estimator
    return merged, estimator.copy({estimator.weightCol: name})


# Spark's forest keeps a row count and a node number in memory for every row and tree (8 bytes, 12 while a level is written). This
# many pairs grow at once, about 3 GB over all executors. A larger forest grows tree by tree (``forest``) and is kept in models of
# as many trees, or, where only Spark's own will do, grows in these portions one after another.
FOREST_CELLS = 1 << 28


class ForestVotes(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The votes of forests that grew in portions, added up: the columns of the one forest of all their trees."""

    parts = Param(Params._dummy(), "parts", "number of portions", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, parts: int = 1):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = [f"rawPrediction_{i}" for i in range(self.getOrDefault("parts"))]
        votes = vector_to_array(columns[0])
        for c in columns[1:]:
            votes = F.zip_with(votes, vector_to_array(c), lambda a, b: a + b)
        total = F.aggregate("_votes", F.lit(0.0), lambda a, b: a + b)
        out = dataset.withColumn("_votes", votes).withColumns({
            "rawPrediction": array_to_vector("_votes"), "probability": array_to_vector(F.transform("_votes", lambda v: v / total)),
            "prediction": (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")})
        return out.drop("_votes", *columns, *[c.replace("rawPrediction", "probability") for c in columns])


def forest_portions(rows: int, trees: int) -> list[int]:
    """Trees of every portion: as equal as can be, and at most ``FOREST_CELLS`` cells each (a tree at least)."""
    n = -(-trees // max(1, min(trees, FOREST_CELLS // max(1, rows))))
    return [trees * (i + 1) // n - trees * i // n for i in range(n)]


def _grown(ready: DataFrame, estimator: Estimator) -> list[Transformer]:
    """The fitted estimator; a forest too large to grow at once, as models of its portions and the sum of their votes."""
    sizes = forest_portions(ready.count(), estimator.getNumTrees()) if isinstance(estimator, RandomForestClassifier) else [0]
    if len(sizes) == 1:
        return [estimator.fit(ready)]
    nodes, strategy = forest.grown_nodes(ready, estimator), estimator.getFeatureSubsetStrategy()
    portions = [estimator.copy({
        estimator.numTrees: size, estimator.seed: estimator.getSeed() + i, estimator.rawPredictionCol: f"rawPrediction_{i}",
        estimator.probabilityCol: f"probability_{i}", estimator.predictionCol: "",
        estimator.featureSubsetStrategy: "sqrt" if strategy == "auto" else strategy}) for i, size in enumerate(sizes)]  # not all for one tree
    grown = [own.fit(ready) for own in portions] if nodes is None else forest.as_models(nodes, portions, ready)
    return [*grown, ForestVotes(parts=len(sizes))]


def _prepared(train: DataFrame, columns: Sequence[str], features: Sequence[str], scale: bool = False) -> tuple[DataFrame, PipelineModel]:
    """The training rows, written once, and the fitted feature stages."""
    rows = stage(evenly(as_model_input(train.select(*columns), features)), "train")
    strings = string_features(rows, features)
    return rows, Pipeline(stages=feature_stages([f for f in features if f not in strings], strings, scale)).fit(rows)


def fit(train: DataFrame, estimator: Estimator, features: Sequence[str] = tuple(C.FEATURES),
        scale: bool = False) -> PipelineModel:
    """Fit features and model together. The prepared table is written once, so iterations do not rebuild it.

    When all features are strings, many rows are equal: iterations then go over the different ones, weighted by their numbers.
    """
    columns = [*features, C.LABEL]
    if estimator.hasParam("validationIndicatorCol") and estimator.isDefined("validationIndicatorCol"):
        columns.append(estimator.getOrDefault("validationIndicatorCol"))
    rows, prepared = _prepared(train, columns, features, scale)
    weighted = with_balanced_weight(rows, C.LABEL)
    if len(string_features(rows, features)) == len(features) and counts_as_rows(estimator):
        weighted, estimator = _merged(weighted, estimator)
    return PipelineModel([*prepared.stages, *_grown(prepared.transform(weighted), estimator)])


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (C.KEY,),
          features: Sequence[str] = tuple(C.FEATURES)) -> DataFrame:
    """keep..., y_proba: the positive-class probability of every row."""
    if isinstance(model.stages[-1], ForestVotes):  # many trees: all rows go down one tree before the next
        grown = [m for m in model.stages if isinstance(m, RandomForestClassificationModel)]
        prepared = PipelineModel([m for m in model.stages[:-1] if m not in grown])
        voted = forest.scored(grown, prepared.transform(as_model_input(df, features)), keep)
        if voted is not None:
            return voted
    return model.transform(as_model_input(df, features)).select(
        *keep, vector_to_array("probability")[1].alias("y_proba")
    )


# ---- importance and contributions ----------------------------------------------------------------------------------


def slot_names(model: PipelineModel) -> list[str]:
    """Names of the vector slots: numeric features, their indicators, string=value."""
    names = []
    for stage_ in model.stages:
        if isinstance(stage_, ImputerModel):
            names = [*stage_.getInputCols(), *[f"{f}_missing" for f in stage_.getInputCols()]]
    sizes = {s.getInputCol(): s.categorySizes[0] for s in model.stages if isinstance(s, OneHotEncoderModel)}
    for stage_ in model.stages:
        if isinstance(stage_, StringIndexerModel):
            f = stage_.getInputCol()
            names += [f"{f}={v}" for v in stage_.labels[: sizes[f"{f}_at"]]]
    return names


def model_importance(model: PipelineModel, df: DataFrame, top: int = 20,
                     features: Sequence[str] = tuple(C.FEATURES)) -> DataFrame:
    """Ranked importances of a tree model: at most as many rows as there are vector slots."""
    grown = [m for m in model.stages if hasattr(m, "featureImportances")]  # several where a forest grew in portions
    values = np.average([m.featureImportances.toArray() for m in grown], axis=0, weights=[getattr(m, "getNumTrees", 1) for m in grown])
    rows = [(n, float(v)) for n, v in zip(slot_names(model), values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), F.col("feature")).limit(top)


def linear_contributions(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (C.KEY,),
                         features: Sequence[str] = tuple(C.FEATURES)) -> DataFrame:
    """Exact contributions of a linear model: weight x value per slot; base value = intercept; the sum is the log-odds."""
    out = model.transform(as_model_input(df, features))
    names = slot_names(model)
    last = model.stages[-1]
    weights = F.array(*[F.lit(float(w)) for w in last.coefficients.toArray()])
    labels = F.array(*[F.lit(n) for n in names])
    pairs = F.zip_with(labels, F.zip_with(weights, vector_to_array("features"), lambda w, x: w * x),
                       lambda n, c: F.struct(n.alias("feature"), c.alias("contribution")))
    return out.select(*keep, vector_to_array("probability")[1].alias("y_proba"),
                      F.lit(float(last.intercept)).alias("base_value"), pairs.alias("contributions"))


# Nodes of the trees that go to a task at once (about 100 bytes each); a larger model passes in several slices.
SLICE_NODES = 200_000


def _tree_slices(model: GBTClassificationModel, spark) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Nodes of a boosted model's trees, read from its saved form, and ranges of trees of at most ``SLICE_NODES`` nodes."""
    path = stage_path(spark, "gbt")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    sizes = {r["treeID"]: r["count"] for r in nodes.groupBy("treeID").count().collect()}  # one row for each tree
    slices, begin, size = [], 0, 0
    for tree in range(model.getNumTrees):
        if size and size + sizes[tree] > SLICE_NODES:
            slices.append((begin, tree))
            begin, size = tree, 0
        size += sizes[tree]
    return nodes, [*slices, (begin, model.getNumTrees)]


def _trees(nodes: DataFrame, begin: int, end: int, weights: Sequence[float]) -> list[dict]:
    """Arrays of the trees begin..end-1: the leaves' values in log-odds, the splits, the share of rows that goes on."""
    rows = nodes.where(F.col("treeID").between(begin, end - 1)).toPandas()
    trees = []
    for tree in range(begin, end):
        part = rows[rows.treeID == tree].sort_values("id")
        left, right = (part[c].to_numpy(int) for c in ("leftChild", "rightChild"))
        count = part["impurityStats"].str[0].to_numpy(float)  # the sum of weights: a merged row stands for several
        share = np.ones(len(part))  # of the parent's training rows
        inner = np.flatnonzero(left >= 0)
        share[left[inner]], share[right[inner]] = count[left[inner]] / count[inner], count[right[inner]] / count[inner]
        split = part["split"].tolist()
        trees.append({
            "value": 2 * weights[tree] * part["prediction"].to_numpy(float), "left": left, "right": right, "share": share,
            "feature": [s["featureIndex"] for s in split], "cut": [s["leftCategoriesOrThreshold"] for s in split],
            "categorical": [s["numCategories"] != -1 for s in split],
        })
    return trees


def _leaf_paths(tree: dict) -> list[tuple[int, list[tuple[int, bool]]]]:
    """Every leaf with the splits above it and whether the way to it goes left."""
    found, open_ = [], [(0, [])]
    while open_:
        node, path = open_.pop()
        if tree["left"][node] < 0:
            found.append((node, path))
        else:
            open_ += [(tree["left"][node], [*path, (node, True)]), (tree["right"][node], [*path, (node, False)])]
    return found


def _expected(tree: dict) -> float:
    """Mean of the leaves by their share of the training rows."""
    reach = np.ones(len(tree["left"]))
    total = 0.0
    for leaf, path in _leaf_paths(tree):
        reach[leaf] = np.prod([tree["share"][tree["left" if went else "right"][n]] for n, went in path])
        total += reach[leaf] * tree["value"][leaf]
    return float(total)


def _shapley_of_patterns(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1. ``zero[j]``: share of rows that take the way of feature j when it is unknown;
    ``one[p, j]``: whether a row of pattern p takes it. A set of known features reaches the leaf with the product of its
    ones and the others' zeros; the weights k! (d-1-k)! / d! run over the sets without j by their size k.
    """
    patterns, d = one.shape
    weight = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)])
    out = np.empty((patterns, d))
    for j in range(d):
        sums = np.zeros((patterns, d))  # by size of the known set
        sums[:, 0] = 1
        for i in range(d):
            if i != j:
                sums[:, 1:] = sums[:, 1:] * zero[i] + sums[:, :-1] * one[:, i:i + 1]
                sums[:, 0] *= zero[i]
        out[:, j] = (one[:, j] - zero[j]) * (sums @ weight)
    return out


def _add_shapley(total: np.ndarray, x: np.ndarray, tree: dict) -> None:
    """Adds a tree's Shapley values of a batch. Per leaf, rows with the same pattern of splits met are worked off once."""
    inner = np.flatnonzero(tree["left"] >= 0)
    goes_left = {}
    for n in inner:
        value = x[:, tree["feature"][n]]
        goes_left[n] = np.isin(value, tree["cut"][n]) if tree["categorical"][n] else value <= tree["cut"][n][0]
    for leaf, path in _leaf_paths(tree):
        if not path:
            continue
        features = sorted({tree["feature"][n] for n, _ in path})
        zero, met = np.ones(len(features)), np.ones((len(features), len(x)), bool)
        for n, went in path:
            j = features.index(tree["feature"][n])
            zero[j] *= tree["share"][tree["left" if went else "right"][n]]
            met[j] &= goes_left[n] if went else ~goes_left[n]
        codes = np.zeros(len(x), np.int64)
        for row in met:
            codes = codes * 2 + row
        _, at, pattern = np.unique(codes, return_index=True, return_inverse=True)
        values = tree["value"][leaf] * _shapley_of_patterns(zero, met[:, at].T.astype(float))
        total[:, features] += values[pattern]


def tree_contributions(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (C.KEY,),
                       features: Sequence[str] = tuple(C.FEATURES)) -> DataFrame:
    """Shapley values of a boosted-tree model in log-odds, per vector slot: the mean change of the expected score when the
    slot's value becomes known, over all orders; unknown splits follow the training rows' shares. With ``base_value``, the
    expected score, they sum to the model's log-odds. Rows stay in place; the trees go to the tasks in slices of bounded size.
    """
    spark, last = df.sparkSession, model.stages[-1]
    out = model.transform(as_model_input(df, features))
    names = slot_names(model)
    nodes, slices = _tree_slices(last, spark)
    rows = out.select(*keep, vector_to_array("probability")[1].alias("y_proba"), vector_to_array("features").alias("_x"),
                      F.array_repeat(F.lit(0.0), len(names)).alias("_c"))
    schema, base = rows.schema, 0.0
    for begin, end in slices:
        found = _trees(nodes, begin, end, last.treeWeights)
        base += sum(_expected(t) for t in found)
        rows = rows.mapInPandas(_attributed(spark.sparkContext.broadcast(found), len(names)), schema)
    labels = F.array(*[F.lit(n) for n in names])
    pairs = F.zip_with(labels, "_c", lambda n, c: F.struct(n.alias("feature"), c.alias("contribution")))
    return rows.select(*keep, "y_proba", F.lit(base).alias("base_value"), pairs.alias("contributions"))


def _attributed(trees, width: int):
    def attribute(batches):
        for batch in batches:
            x = np.array(batch["_x"].tolist(), dtype=float).reshape(len(batch), width)
            total = np.array(batch["_c"].tolist(), dtype=float).reshape(len(batch), width)
            for tree in trees.value:
                _add_shapley(total, x, tree)
            yield batch.assign(_c=list(total))

    return attribute


def global_importance(contributions: DataFrame, column: str = "contributions", top: int | None = None) -> DataFrame:
    """Mean absolute contribution per feature, ranked."""
    out = rows_of(contributions, [], column).groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution")
    ).orderBy(F.col("mean_abs_contribution").desc(), F.col("feature"))
    return out if top is None else out.limit(top)


# ---- ensembles -----------------------------------------------------------------------------------------------------


def join_scores(scores: dict[str, DataFrame], id: str = "id", label: str | None = "y_true") -> DataFrame:
    """One column per model by id, in one shuffle; an id that is missing or repeated in a model fails the job."""
    names = list(scores)
    rows = None
    for i, name in enumerate(names):
        part = scores[name].select(
            id, F.lit(i).alias("_model"), F.col("y_proba").cast("double").alias("_p"),
            *([F.col(label) if i == 0 else F.lit(None).alias(label)] if label else []))
        rows = part if rows is None else rows.unionByName(part)
    wide = rows.groupBy(id).agg(
        *([F.max(label).alias(label)] if label else []),
        *[F.max(F.when(F.col("_model") == i, F.col("_p"))).alias(name) for i, name in enumerate(names)],
        *[F.count_if(F.col("_model") == i).alias(f"_n{i}") for i in range(len(names))],
    )
    once = F.lit(True)
    for i in range(len(names)):
        once = once & (F.col(f"_n{i}") == 1)
    failure = F.raise_error(F.concat(F.lit("models score different ids: "), F.col(id).cast("string"))).cast("boolean")
    return wide.where(F.when(~once, failure).otherwise(F.lit(True))).drop(*[f"_n{i}" for i in range(len(names))])


def weighted_score(weights: dict[str, float]) -> Column:
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("weights must sum to a positive number")
    return sum((F.lit(w / total) * F.col(m) for m, w in weights.items()), F.lit(0.0))


def ap_weights(joined: DataFrame, models: Sequence[str], label: str = "y_true") -> dict[str, float]:
    """Average precision per model, floored at 1e-6, from one pass over all models."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("y_proba")) for m in models])
    rows = ranking_metrics(joined.select(label, F.inline(pairs)), "y_proba", label, ["model"]).collect()
    return {r["model"]: max(r["average_precision"] or 0.0, 1e-6) for r in rows}


def weight_grid(models: Sequence[str], step: float = 0.05) -> list[dict[str, float]]:
    """All weights that sum to 1 in whole steps of 1 / round(1 / step), in search order, for any number of models."""
    if not models or not 0 < step <= 1:
        raise ValueError("grid search takes models and a step in (0, 1]")
    parts = max(1, round(1 / step))
    # Dividers among parts + models - 1 places: the gaps between them are the shares.
    width = parts + len(models) - 1
    out = []
    for cut in combinations(range(width), len(models) - 1):
        places = (-1, *cut, width)
        shares = [b - a - 1 for a, b in zip(places, places[1:])]
        out.append({m: k / parts for m, k in zip(models, shares)})
    return out


def _vectors(joined: DataFrame, models: Sequence[str], label: str) -> DataFrame:
    """Equal score vectors merged: models..., n, pos."""
    return joined.groupBy(*models).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))


def _grid_scores(vectors: DataFrame, models: Sequence[str], grid: list[dict[str, float]], only: Sequence[int]) -> DataFrame:
    """grid_row, score, n, pos: every vector under the weights of the grid rows ``only``."""
    # Weights are looked up by grid row in constant arrays, which keeps the generated code small.
    row = F.col("grid_row")
    factors = {m: F.array(*[F.lit(w[m]) for w in grid]) for m in models}
    # A fixed number of partitions: adaptive merging looks at the size before each row becomes a whole grid of rows.
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = vectors.repartition(parts, *models).select("*", F.explode(F.array(*[F.lit(i) for i in only])).alias("grid_row"))
    score = sum((F.get(factors[m], row) * F.col(m) for m in models[1:]), F.get(factors[models[0]], row) * F.col(models[0]))
    return every.select("grid_row", clean_score(score).alias("score"), "n", "pos")


def _searched(vectors: DataFrame, models: Sequence[str], grid: list[dict[str, float]], only: Sequence[int]) -> DataFrame:
    """grid_row, w_<model>..., average_precision of the grid rows ``only``, exactly: one ordered pass."""
    rows = _grid_scores(vectors, models, grid, only).groupBy("grid_row", "score").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos")
    )
    groups = running_totals(rows, [F.col("score").desc_nulls_last()], ["n", "pos"], ["grid_row"])
    weights = {m: F.array(*[F.lit(w[m]) for w in grid]) for m in models}
    return metrics_of_groups(groups, ["grid_row"]).select(
        "grid_row", *[F.get(weights[m], F.col("grid_row")).alias(f"w_{m}") for m in models], "average_precision"
    )


def weight_search(joined: DataFrame, models: Sequence[str], step: float = 0.05, label: str = "y_true") -> DataFrame:
    """Average precision of every weight combination (at most 231 at the default step and three models).

    Equal score vectors are merged before the grid is applied, and the grid is one ordered pass with the combination
    as group. ``winning_weights`` finds the best row without evaluating the others.
    """
    grid = weight_grid(models, step)
    return _searched(_vectors(joined, models, label), models, grid, range(len(grid)))


def best_weights(searched: DataFrame) -> DataFrame:
    """The first best row of the search; figures that agree to twelve places are equal."""
    row = F.struct(*searched.columns)
    order = F.struct(F.round("average_precision", 12).alias("value"), (-F.col("grid_row")).alias("first"))
    return searched.agg(F.max_by(row, order).alias("r")).select("r.*")


def average_precision_bounds(scores: DataFrame, bits: int, by: Sequence[str]) -> DataFrame:
    """by..., lower, upper: what the average precision can be, from rows counted by the leading bits of the score.

    ``scores`` has by..., score, n, pos; a bin is an octave cut into 2^bits parts, so the shuffle carries a row per bin and
    task. Within a bin the precision at a positive is highest if all positives come first as one tie, and lowest if all
    negatives come first and each positive stands alone. The sum of the latter's reciprocals is bounded by an integral.
    """
    by = list(by)
    code = F.coalesce(F.shiftright(X.order_code(F.col("score") + F.lit(0.0)), 52 - bits), F.lit(-(2**63)))
    bins = scores.groupBy(*by, code.alias("_bin")).agg(
        F.sum("n").cast("double").alias("n"), F.sum("pos").cast("double").alias("pos"), F.min("score").alias("low"), F.max("score").alias("high"))
    before = Window.partitionBy(*by).orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumns({"n0": F.coalesce(F.sum("n").over(before), F.lit(0.0)), "pos0": F.coalesce(F.sum("pos").over(before), F.lit(0.0))})
    n, pos, n0, pos0 = (F.col(c) for c in ("n", "pos", "n0", "pos0"))
    tied = pos * X.ratio0(pos0 + pos, n0 + n)
    worse = n0 + n - pos  # rows ahead of the bin's positives at worst
    lower = pos - (worse - pos0) * F.log((worse + pos + 0.5) / (worse + 0.5))
    one_value = F.col("low").eqNullSafe(F.col("high"))
    return bins.groupBy(*by).agg(
        X.ratio(F.sum(F.when(one_value, tied).otherwise(lower)), F.sum("pos")).alias("lower"),
        X.ratio(F.sum(F.when(one_value, tied).otherwise(pos * X.ratio0(pos0 + pos, n0 + pos))), F.sum("pos")).alias("upper"),
    )


def candidate_rows(vectors: DataFrame, models: Sequence[str], grid: list[dict[str, float]], only: Sequence[int], bits: int) -> list[int]:
    """The grid rows of ``only`` whose upper bound reaches the best lower bound; the best row is always among them."""
    bounds = average_precision_bounds(_grid_scores(vectors, models, grid, only), bits, ["grid_row"])
    most = F.max("lower").over(Window.partitionBy(F.lit(0)))
    # Bounds are sums of doubles: a margin keeps rows that differ by rounding only.
    kept = bounds.select("grid_row", (F.col("upper") + 1e-9 >= most).alias("open")).where(F.coalesce("open", F.lit(True)))
    return sorted(r.grid_row for r in kept.select("grid_row").collect())  # at most the rows of the grid


def winning_weights(joined: DataFrame, models: Sequence[str], step: float = 0.05, label: str = "y_true",
                    levels: Sequence[int] = (4, 8)) -> DataFrame:
    """The row ``best_weights(weight_search(...))`` returns, found by bounds.

    Rows counted in ever finer score bins bound every combination's average precision; only combinations that may still be
    the best are looked at again, and only the last ones' scores are put in order. Stages the distinct score vectors.
    """
    grid = weight_grid(models, step)
    vectors = stage(_vectors(joined, models, label), "vectors")
    left = list(range(len(grid)))
    for bits in levels:
        if len(left) > 1:
            left = candidate_rows(vectors, models, grid, left, bits)
    return best_weights(_searched(vectors, models, grid, left or [0]))


def _searched_weights(joined: DataFrame, models: Sequence[str], step: float, label: str) -> dict[str, float]:
    best = winning_weights(joined, models, step, label).first()
    return {m: best[f"w_{m}"] for m in models}


def soft_vote(joined: DataFrame, models: Sequence[str], mode: str = "equal", manual: dict[str, float] | None = None,
              step: float = 0.05, label: str = "y_true", id: str = "id") -> DataFrame:
    """Weighted mean of the models' scores. Modes: the same weight for all, given weights (1 where none is given), the
    models' average precision, or the best weights of the grid."""
    modes = {  # fixed values: the names of the modes
        "equal": lambda: dict.fromkeys(models, 1.0),
        "manual": lambda: {m: float((manual or {}).get(m, 1.0)) for m in models},
        "prauc_proportional": lambda: ap_weights(joined, models, label),
        "grid_search": lambda: _searched_weights(joined, models, step, label),
    }
    if mode not in modes:
        raise ValueError(f"no weights are defined for {mode!r}; there are {', '.join(modes)}")
    weights = modes[mode]()
    keep = [c for c in (id, label) if c in joined.columns]
    return joined.select(*keep, weighted_score({m: weights[m] for m in models}).alias("y_proba"))


# ---- search, calibration, backtest ---------------------------------------------------------------------------------


def model_search(train: DataFrame, valid: DataFrame, trials: Sequence[tuple[str, Estimator]], parallelism: int = 2,
                 features: Sequence[str] = tuple(C.FEATURES)) -> DataFrame:
    """Fit every trial and rank by average precision on the validation rows; the budget is the number of trials."""
    spark = train.sparkSession
    # Features are prepared once, for all trials.
    rows, prepared = _prepared(train, [*features, C.LABEL], features)
    ready = prepared.transform(with_balanced_weight(rows, C.LABEL))
    held = stage(valid.select(*features, C.LABEL), "search-valid")

    def run(trial: tuple[str, Estimator]) -> tuple:
        name, estimator = trial
        scored = score(PipelineModel([*prepared.stages, *_grown(ready, estimator)]), held, [C.LABEL], features)
        got = ranking_metrics(scored, "y_proba", C.LABEL).first()
        return name, got["average_precision"], got["roc_auc"]

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(run, trials))
    return spark.createDataFrame(rows, "trial string, average_precision double, roc_auc double").orderBy(
        F.col("average_precision").desc_nulls_last(), "trial"
    )


def halving_rungs(n: int, budget: float, keep: int = 3) -> list[tuple[int, float]]:
    """(trials, share of the training rows) of every rung: each keeps one trial in ``keep`` and spends an equal part of the budget."""
    counts = [n]
    while counts[-1] > 1:
        counts.append(-(-counts[-1] // keep))
    return [(k, min(1.0, budget / (len(counts) * k))) for k in counts]


def halving_search(train: DataFrame, valid: DataFrame, trials: Sequence[tuple], budget: float, id: str = C.KEY, keep: int = 3,
                   parallelism: int = 2, features: Sequence[str] = tuple(C.FEATURES), seed: int = 42) -> DataFrame:
    """Successive halving: many trials on few rows, the best of them on more. ``budget`` bounds the rows that all fits read,
    in training tables (2.0 = as much as two fits on everything).

    A trial is (name, estimator) or (name, estimator, features of its own). A rung's sample is a share
    of the rows by the hash of ``id``, so samples are nested and survive any repartitioning. Returns a row per trial and rung: rung, trial, share,
    average_precision, roc_auc, kept; the winner is the trial kept on the last rung. Ties go to the smaller name.
    """
    spark = train.sparkSession
    if budget <= 0 or not trials:
        raise ValueError("a search needs trials and a budget above 0")
    own = {t[0]: (t[1], tuple(t[2]) if len(t) > 2 else tuple(features)) for t in trials}
    if len(own) < len(trials):
        raise ValueError("names of trials must differ")
    used = sorted({f for _, fs in own.values() for f in fs})
    ready = stage(train.select(*used, C.LABEL, X.hash_fraction(F.col(id), seed).alias("_place")), "search-train")
    held = stage(valid.select(*used, C.LABEL), "search-valid")
    alive, rows = sorted(own), []
    rungs = halving_rungs(len(alive), budget, keep)
    for rung, (_, share) in enumerate(rungs):
        sample = ready.where(F.col("_place") < share)

        def run(name: str) -> tuple:
            estimator, mine = own[name]
            scored = score(fit(sample, estimator, mine), held, [C.LABEL], mine)
            got = ranking_metrics(scored, "y_proba", C.LABEL).first()
            return name, got["average_precision"], got["roc_auc"]

        with ThreadPoolExecutor(parallelism) as pool:
            found = sorted(pool.map(run, alive), key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))
        alive = [r[0] for r in found[:rungs[rung + 1][0] if rung + 1 < len(rungs) else 1]]
        rows += [(rung, name, share, ap, auc, name in alive) for name, ap, auc in found]
    return spark.createDataFrame(rows, "rung int, trial string, share double, average_precision double, roc_auc double, kept boolean")


def reliability_table(df: DataFrame, score_col: str = "y_proba", label: str = "y_true", bins: int = 10) -> DataFrame:
    """Mean score and observed rate per equal-width score bin; missing scores are bin -1, without a mean."""
    value = clean_score(F.col(score_col))
    b = F.when(value.isNull(), -1).otherwise(X.clamp(F.floor(value * bins), 0, bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def rolling_backtest(df: DataFrame, cutoffs: Sequence[int], time: str, predict: Callable[[DataFrame, DataFrame], DataFrame],
                     threshold: float = 0.5, ks: Sequence[int] = C.TOP_KS, id: str = C.KEY) -> DataFrame:
    """For each cutoff (YYYYMMDD): train on rows up to it, score the rows up to the next one, evaluate.

    ``predict(train, valid)`` returns (id, y_true, y_proba) of the valid rows. All windows are evaluated in one pass.
    """
    scored = None
    for i, cutoff in enumerate(cutoffs):
        after = df.where(F.col(time) > cutoff)
        valid = after if i + 1 == len(cutoffs) else after.where(F.col(time) <= cutoffs[i + 1])
        part = predict(df.where(F.col(time) <= cutoff), valid).withColumn("cutoff", F.lit(cutoff))
        scored = part if scored is None else scored.unionByName(part)
    return evaluate(stage(scored, "backtest"), threshold, ks, id=id, by=["cutoff"])
