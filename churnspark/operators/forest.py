"""Random forests whose trees grow side by side: a task holds all rows in bins and grows whole trees.

Spark's own forest counts every level of every tree over all parts of the rows and merges the parts' counts, so deep trees cost
rows x levels slow steps and nodes x parts counts to move. Here a row is a byte for each feature that varies. The binned rows are
written once, read by every task, and nothing moves while trees grow. The rules are Spark's: bins, resampling, features of a node,
gain, least numbers, leaves of one class merged. The trees become models in Spark's saved form.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from churnspark.sources.staging import stage, stage_path

# Bytes of binned rows that a task may hold. Larger tables are left to Spark's own forest.
TASK_BYTES = 1 << 29
# A task's trees: this many tasks a core, so that none waits long for the last, and each reads the binned rows once.
TASKS_A_CORE = 3
# Rows in a record of binned rows; an Arrow batch of 10,000 records stays small.
RECORD = 64
# Rows counted at once, so that what is counted stays in the processor's cache.
CHUNK = 1 << 15
# Rows of a node that are few among more rows than this are copied, so that they lie side by side.
NEAR = 1 << 18
# Rows that go down the trees together.
VOTERS = 1 << 17

_NODES = pa.schema([
    ("tree", pa.int32()), ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("weight_0", pa.float64()),
    ("weight_1", pa.float64()), ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("featureIndex", pa.int32()), ("threshold", pa.float64())])
_NODES_DDL = ("tree int, id int, prediction double, impurity double, weight_0 double, weight_1 double, rawCount bigint, gain double, "
              "leftChild int, rightChild int, featureIndex int, threshold double")


@dataclass(frozen=True)
class Rules:
    """What the growing of a tree depends on besides the rows."""

    slots: int  # features, the constant ones included: a node draws from all of them
    drawn: int  # features a node may split by
    varying: tuple[int, ...]  # features with more than one bin, in the order of the binned rows
    thresholds: tuple[np.ndarray, ...]  # of the varying features
    weights: tuple[float, float]  # of a row of either class
    depth: int
    least_rows: int
    least_weight: float
    least_gain: float
    replaced: bool
    rate: float
    seed: int


def drawn_features(strategy: str, slots: int, trees: int) -> int:
    """Features a node may split by, as Spark counts them."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {"all": slots, "sqrt": ceil(sqrt(slots)), "log2": max(1, ceil(log2(slots))), "onethird": ceil(slots / 3)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), slots) if strategy.isdigit() else ceil(float(strategy) * slots)


def split_points(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds that cut the weighted values into equal parts, half-way between two values, as Spark places them."""
    found, place = np.unique(values, return_inverse=True)
    if len(found) - 1 <= most:
        return (found[:-1] + found[1:]) / 2
    sums = np.bincount(place, weights=weights)
    stride = sums.sum() / (most + 1)
    cuts, so_far, target = [], sums[0], stride
    for i in range(1, len(found)):
        before, so_far = so_far, so_far + sums[i]
        if abs(before - target) < abs(so_far - target):
            cuts.append((found[i - 1] + found[i]) / 2)
            target += stride
    return np.array(cuts)


# ---- one tree --------------------------------------------------------------------------------------------------------


def _counts(codes: np.ndarray, rows: np.ndarray, features: Sequence[int], width: int) -> np.ndarray:
    """Rows by feature, bin and class; a code is twice the bin and the class."""
    out = np.zeros((len(features), width), dtype=np.int64)
    for at in range(0, len(rows), CHUNK):
        some = rows[at:at + CHUNK].astype(np.int64)
        for k, f in enumerate(features):
            out[k] += np.bincount(codes[f].take(some), minlength=width)
    return out.reshape(len(features), -1, 2)


def _part(line: np.ndarray, rows: np.ndarray, most: int) -> None:
    """Puts the rows whose code is at most ``most`` first, all else in their order."""
    left, right = [], []
    for at in range(0, len(rows), CHUNK):
        some = rows[at:at + CHUNK]
        goes_left = line.take(some) <= most
        left.append(some.take(np.flatnonzero(goes_left)))
        right.append(some.take(np.flatnonzero(~goes_left)))
    np.concatenate(left + right, out=rows)


def _impurity(negative, positive):
    """Weight and Gini impurity of nodes; without weight, no number."""
    total = negative + positive
    return total, 1 - (negative / total) ** 2 - (positive / total) ** 2


def _best_split(counts: np.ndarray, total: np.ndarray, rules: Rules) -> tuple[float, int, int, np.ndarray] | None:
    """Gain, feature's place, bin and left counts of the best split that is allowed; the first of equals."""
    left = counts.cumsum(axis=1)[:, :-1]
    l0, l1 = left[..., 0], left[..., 1]
    r0, r1 = total[0] - l0, total[1] - l1
    w0, w1 = rules.weights
    whole, before = _impurity(total[0] * w0, total[1] * w1)
    nl, il = _impurity(l0 * w0, l1 * w1)
    nr, ir = _impurity(r0 * w0, r1 * w1)
    gain = before - nl / whole * il - nr / whole * ir
    allowed = (np.minimum(l0 + l1, r0 + r1) >= rules.least_rows) & (gain > 0) & (gain >= rules.least_gain)
    if rules.least_weight > 0:
        allowed &= np.minimum(nl, nr) >= rules.least_weight
    gain = np.where(allowed, gain, -1.0)
    f, b = divmod(int(gain.argmax()), gain.shape[1])
    return (float(gain[f, b]), f, b, left[f, b]) if allowed[f, b] else None


def grow_tree(codes: np.ndarray, rules: Rules, tree: int) -> dict[str, list]:
    """Nodes of one tree, parents first. ``codes``: a line for each varying feature."""
    rng = np.random.Generator(np.random.PCG64([rules.seed & (1 << 64) - 1, tree]))
    n = codes.shape[1]
    if rules.replaced:
        rows = np.repeat(np.arange(n, dtype=np.int32), rng.poisson(rules.rate, n).astype(np.uint8))
    else:
        rows = np.arange(n, dtype=np.int32) if rules.rate == 1 else np.flatnonzero(rng.random(n) < rules.rate).astype(np.int32)
    place = {f: i for i, f in enumerate(rules.varying)}
    width = 2 * (1 + max(len(t) for t in rules.thresholds))
    nodes: dict[str, list] = {k: [] for k in ("counts", "gain", "left", "right", "feature", "bin")}

    def add(counts: np.ndarray) -> int:
        for name, value in zip(nodes, (counts, -1.0, -1, -1, -1, -1)):
            nodes[name].append(value)
        return len(nodes["gain"]) - 1

    def grow(codes: np.ndarray, rows: np.ndarray, root: int, top: int) -> None:
        open_nodes = [(root, 0, len(rows), top)]
        while open_nodes:
            node, begin, end, depth = open_nodes.pop()
            total = nodes["counts"][node]
            if depth == rules.depth or total.min() == 0 or end - begin < 2 * rules.least_rows:
                continue
            mine = rows[begin:end]
            if codes.shape[1] > NEAR and len(mine) <= codes.shape[1] // 16:
                some = mine.astype(np.int64)
                grow(np.stack([line.take(some) for line in codes]), np.arange(len(mine), dtype=np.int32), node, depth)
                continue
            drawn = range(rules.slots) if rules.drawn >= rules.slots else rng.choice(rules.slots, rules.drawn, replace=False).tolist()
            features = [place[f] for f in drawn if f in place]
            found = _best_split(_counts(codes, mine, features, width), total, rules) if features else None
            if not found:
                continue
            gain, f, b, left_counts = found
            _part(codes[features[f]], mine, 2 * b + 1)
            middle, children = begin + int(left_counts.sum()), (add(left_counts), add(total - left_counts))
            for name, value in zip(("gain", "left", "right", "feature", "bin"), (gain, *children, features[f], b)):
                nodes[name][node] = value
            open_nodes += [(children[1], middle, end, depth + 1), (children[0], begin, middle, depth + 1)]

    grow(codes, rows, add(_counts(codes, rows, [0], width)[0].sum(axis=0)), 0)
    return nodes


def tree_table(nodes: dict[str, list], rules: Rules, tree: int) -> pa.RecordBatch:
    """The nodes of a tree as rows. Two leaves of one class become one, from the bottom up."""
    counts = np.array(nodes["counts"])
    weighted = counts * np.array(rules.weights)
    with np.errstate(invalid="ignore"):
        impurity = np.nan_to_num(_impurity(weighted[:, 0], weighted[:, 1])[1])
    prediction = (weighted[:, 1] > weighted[:, 0]).astype(float)
    left, right = list(nodes["left"]), list(nodes["right"])
    for i in reversed(range(len(left))):
        a, b = left[i], right[i]
        if a >= 0 and left[a] < 0 and left[b] < 0 and prediction[a] == prediction[b]:
            left[i] = right[i] = -1
    kept, number = [], {-1: -1, 0: 0}
    for i in range(len(left)):
        if i in number:
            kept.append(i)
            if left[i] >= 0:
                number[left[i]] = number[right[i]] = 0
    number |= {i: k for k, i in enumerate(kept)}
    inner = [left[i] >= 0 for i in kept]
    columns = [
        [tree] * len(kept), range(len(kept)), prediction[kept], impurity[kept], weighted[kept, 0], weighted[kept, 1], counts[kept].sum(axis=1),
        [nodes["gain"][i] if s else -1.0 for i, s in zip(kept, inner)], [number[left[i]] for i in kept], [number[right[i]] for i in kept],
        [rules.varying[nodes["feature"][i]] if s else -1 for i, s in zip(kept, inner)],
        [float(rules.thresholds[nodes["feature"][i]][nodes["bin"][i]]) if s else None for i, s in zip(kept, inner)]]
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, _NODES)], schema=_NODES)


# ---- all trees -------------------------------------------------------------------------------------------------------


def _binning(rules: Rules):
    """Batches of feature arrays and labels to records: a byte per varying feature and row, twice the bin and the class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
            codes = np.empty((len(rules.varying), len(label)), dtype=np.uint8)
            for line, f, cuts in zip(codes, rules.varying, rules.thresholds):
                line[:] = 2 * np.searchsorted(cuts, x[:, f]) + label
            begins = range(0, len(label), RECORD)
            data = [codes[:, b:b + RECORD].tobytes() for b in begins]
            yield pa.record_batch([pa.array([part] * len(data), pa.int32()), pa.array([at + b for b in begins], pa.int64()),
                                   pa.array(data, pa.binary())], names=["part", "place", "codes"])
            at += len(label)
    return run


def _growing(rules: Rules, begins: dict[int, int], rows: int, trees: int, tasks: int):
    """All records, in any order, to the trees of the task: every ``tasks``-th one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, mine = np.empty((len(rules.varying), rows), dtype=np.uint8), set()
        for batch in batches:
            mine |= set(batch.column(0).unique().to_pylist())
            for part, place, data in zip(*(c.to_pylist() for c in batch.columns[1:])):
                some = np.frombuffer(data, dtype=np.uint8).reshape(len(rules.varying), -1)
                at = begins[part] + place
                codes[:, at:at + some.shape[1]] = some
        np.seterr(invalid="ignore")  # a split that leaves nothing on a side has no gain
        for tree in (t for task in sorted(mine) for t in range(task, trees, tasks)):
            yield tree_table(grow_tree(codes, rules, tree), rules, tree)
    return run


def _rules(ready: DataFrame, estimator: RandomForestClassifier) -> tuple[Rules, int] | None:
    """Rules and number of rows; None for what only Spark's own forest does: other impurities, more classes, nominal features, weights
    that differ within a class, more bins than a byte holds, more rows than a task does."""
    bins = estimator.getMaxBins()
    if estimator.getImpurity() != "gini" or bins > 128 or not estimator.isDefined("weightCol"):
        return None
    label, weight, features = estimator.getLabelCol(), estimator.getWeightCol(), estimator.getFeaturesCol()
    kinds = ready.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if "nominal" in kinds:
        return None
    classes = {r[0]: r for r in ready.groupBy(F.col(label).cast("double")).agg(
        F.count(F.lit(1)), F.min(weight).cast("double"), F.max(weight).cast("double"), F.count(weight)).collect()}
    if set(classes) != {0.0, 1.0} or any(r[4] < r[1] or r[2] != r[3] or not r[2] > 0 for r in classes.values()):
        return None
    rows, weights = sum(r[1] for r in classes.values()), (classes[0.0][2], classes[1.0][2])
    # As Spark does, thresholds are placed by a share of the rows of at least this size; every row is then put into a bin.
    share = max(bins ** 2, 10_000) / rows
    some = ready if share >= 1 else ready.sample(False, share, estimator.getSeed())
    seen = some.select(vector_to_array(features).alias("x"), F.col(weight).cast("double").alias("w")).toArrow()
    x = seen.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(seen.num_rows, -1)
    w = seen.column("w").to_numpy()
    if not np.isfinite(x).all():
        return None
    either = {a["idx"] for a in kinds.get("binary", ())}  # has two bins, whether or not those rows hold both values
    cuts = [np.array([0.5]) if f in either else split_points(x[:, f], w, min(bins, rows) - 1) for f in range(x.shape[1])]
    varying = tuple(f for f, c in enumerate(cuts) if len(c))
    trees, slots = estimator.getNumTrees(), x.shape[1]
    if not varying or len(varying) * rows > TASK_BYTES:
        return None
    total = sum(r[1] * r[2] for r in classes.values())
    return Rules(slots, drawn_features(estimator.getFeatureSubsetStrategy(), slots, trees), varying, tuple(cuts[f] for f in varying), weights,
                 estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getMinWeightFractionPerNode() * total,
                 estimator.getMinInfoGain(), estimator.getBootstrap(), estimator.getSubsamplingRate(), estimator.getSeed()), rows


def grown_nodes(ready: DataFrame, estimator: RandomForestClassifier) -> DataFrame | None:
    """The nodes of all trees, written once; None where only Spark's own forest will do."""
    found = _rules(ready, estimator)
    if found is None:
        return None
    rules, rows = found
    trees = estimator.getNumTrees()
    columns = ready.select(vector_to_array(estimator.getFeaturesCol()), F.col(estimator.getLabelCol()).cast("double"))
    binned = stage(columns.mapInArrow(_binning(rules), "part int, place bigint, codes binary"), "binned")
    lines = len(rules.varying)
    sizes = binned.groupBy("part").agg(F.sum(F.length("codes")).alias("n")).orderBy("part").collect()
    begins, so_far = {}, 0
    for r in sizes:
        begins[r.part], so_far = so_far, so_far + r.n // lines
    tasks = min(trees, TASKS_A_CORE * ready.sparkSession.sparkContext.defaultParallelism)
    each = binned.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).select("task", "part", "place", "codes")
    nodes = each.repartitionById(tasks, "task").mapInArrow(_growing(rules, begins, rows, trees, tasks), _NODES_DDL)
    return stage(nodes, "nodes")


def as_models(nodes: DataFrame, portions: Sequence[RandomForestClassifier], ready: DataFrame) -> list[RandomForestClassificationModel]:
    """The trees, in their order, as the models that the estimators of the portions fit: the saved form of a fit to one row of either
    class, with these trees instead."""
    spark, own = nodes.sparkSession, portions[0]
    columns = ready.select(own.getFeaturesCol(), own.getLabelCol(), own.getWeightCol())
    few = [columns.where(F.col(own.getLabelCol()) == c).first() for c in (0, 1)]
    frame = stage_path(spark, "frame")
    own.copy({own.numTrees: 1}).fit(spark.createDataFrame(few, columns.schema).coalesce(1)).save(frame)
    kind = json.loads(spark.read.text(f"{frame}/metadata").first()[0])
    of_tree = spark.read.parquet(f"{frame}/treesMetadata").first()
    split = F.struct("featureIndex", F.array_compact(F.array("threshold")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    node = F.struct("id", "prediction", "impurity", F.array("weight_0", "weight_1").alias("impurityStats"), "rawCount", "gain",
                    "leftChild", "rightChild", split.alias("split"))
    grown, begin = [], 0
    for own in portions:
        path, trees = stage_path(spark, "forest"), own.getNumTrees()
        params = kind["paramMap"] | {p.name: own.getOrDefault(p) for p in (
            own.numTrees, own.seed, own.featureSubsetStrategy, own.rawPredictionCol, own.probabilityCol, own.predictionCol)}
        text = json.dumps(kind | {"paramMap": params, "numTrees": trees})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.range(trees).select(F.col("id").cast("int").alias("_1"), F.lit(of_tree[1]).alias("_2"), F.lit(1.0).alias("_3")).coalesce(1).write.parquet(
            f"{path}/treesMetadata")
        mine = nodes.where(F.col("tree").between(begin, begin + trees - 1))
        mine.select((F.col("tree") - begin).alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")
        grown.append(RandomForestClassificationModel.load(path))
        begin += trees
    return grown


# ---- votes -----------------------------------------------------------------------------------------------------------


def saved_trees(models: Sequence[RandomForestClassificationModel], spark: SparkSession) -> list[dict[str, np.ndarray]] | None:
    """Every tree's nodes as arrays; None if one splits by more than two categories."""
    trees = []
    for model in models:
        path = stage_path(spark, "votes")
        model.save(path)
        stats, cut = F.col("nodeData.impurityStats"), F.col("nodeData.split.leftCategoriesOrThreshold")
        table = spark.read.parquet(f"{path}/data").select(
            "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex", "nodeData.split.numCategories",
            F.get(cut, 0).alias("cut"), stats[0].alias("w0"), stats[1].alias("w1")).toArrow()
        c = {name: table.column(name).to_numpy() for name in table.column_names}
        inner = c["leftChild"] >= 0
        if (c["numCategories"][inner] > 2).any():
            return None
        by_category, weight = inner & (c["numCategories"] == 2), c["w0"] + c["w1"]
        swapped = by_category & (c["cut"] == 1)  # the left category is the larger one
        votes = np.divide([c["w0"], c["w1"]], weight, out=np.zeros((2, len(weight))), where=weight > 0)
        whole = {"left": np.where(swapped, c["rightChild"], c["leftChild"]), "right": np.where(swapped, c["leftChild"], c["rightChild"]),
                 "feature": c["featureIndex"], "cut": np.where(by_category, 0.5, c["cut"]), "no": votes[0], "yes": votes[1]}
        order = np.lexsort((c["id"], c["treeID"]))
        ends = np.cumsum(np.bincount(c["treeID"]))
        trees += [{k: v[order[b:e]] for k, v in whole.items()} for b, e in zip([0, *ends[:-1]], ends)]
    return trees


def add_votes(votes: np.ndarray, columns: dict[int, np.ndarray], tree: dict[str, np.ndarray]) -> None:
    """Adds a tree's votes for both classes to those of the rows, which go down the tree together."""
    left, right, feature, cut, no, yes = (tree[k].tolist() for k in ("left", "right", "feature", "cut", "no", "yes"))
    waiting = [(0, np.arange(votes.shape[1]))]
    while waiting:
        node, rows = waiting.pop()
        if left[node] < 0:
            votes[0][rows] += no[node]
            votes[1][rows] += yes[node]
            continue
        goes_left = columns[feature[node]].take(rows) <= cut[node]
        for child, some in ((right[node], np.flatnonzero(~goes_left)), (left[node], np.flatnonzero(goes_left))):
            if len(some):
                waiting.append((child, rows.take(some)))


def _voting(trees, used: Sequence[int]):
    """Batches with feature arrays as their last column to batches with the share of votes for the second class instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _gathered(batches):
            x = some.column(some.num_columns - 1).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
            columns = {f: np.ascontiguousarray(x[:, f]) for f in used}
            votes = np.zeros((2, some.num_rows))
            for tree in trees.value:
                add_votes(votes, columns, tree)
            share = pa.array(votes[1] / votes.sum(axis=0), pa.float64())
            yield from some.set_column(some.num_columns - 1, "y_proba", share).to_batches()
    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    kept, n = [], 0
    for batch in batches:
        kept, n = [*kept, batch], n + batch.num_rows
        if n >= VOTERS:
            yield pa.Table.from_batches(kept)
            kept, n = [], 0
    if n:
        yield pa.Table.from_batches(kept)


def scored(models: Sequence[RandomForestClassificationModel], ready: DataFrame, keep: Sequence[str]) -> DataFrame | None:
    """keep..., y_proba: the share of the votes of all the models' trees; None where only Spark's own models will do."""
    spark = ready.sparkSession
    trees = saved_trees(models, spark)
    if trees is None:
        return None
    used = sorted({f for t in trees for f in t["feature"].tolist() if f >= 0})
    rows = ready.select(*keep, vector_to_array(models[0].getFeaturesCol()).alias("_x"))
    schema = StructType([*rows.schema.fields[:-1], StructField("y_proba", DoubleType())])
    return rows.mapInArrow(_voting(spark.sparkContext.broadcast(trees), used), schema)
