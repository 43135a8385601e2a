"""Ranking and classification metrics over a scored table (id, y_true, y_proba)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import contract as C
from churnspark.functions import columns as X
from churnspark.operators.rank import clean_score, match, quota_points, reaches, score_groups, top_k
from churnspark.operators.select import exact_quantiles

STEPS = 100


def with_precision_recall(df: DataFrame) -> DataFrame:
    """Adds precision, recall, F1 to a table with tp, fp, fn; 0 where undefined."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    return df.withColumns({
        "precision": X.ratio0(tp, tp + fp),
        "recall": X.ratio0(tp, tp + fn),
    }).withColumn(
        "f1", X.ratio0(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def confusion_at(df: DataFrame, threshold: float, score: str = "y_proba", label: str = "y_true",
                 by: Sequence[str] = ()) -> DataFrame:
    hit, true = reaches(F.col(score), threshold), F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & true).alias("fn"), F.count_if(~hit & ~true).alias("tn"),
    )


def binary_metrics(df: DataFrame, threshold: float, score: str = "y_proba", label: str = "y_true",
                   by: Sequence[str] = ()) -> DataFrame:
    return with_accuracy(with_precision_recall(confusion_at(df, threshold, score, label, by)))


def with_accuracy(df: DataFrame) -> DataFrame:
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return df.withColumn("accuracy", X.ratio0((F.col("tp") + F.col("tn")).cast("double"), n))


def threshold_sweep(df: DataFrame, score: str = "y_proba", label: str = "y_true",
                    value_per_save: float = C.VALUE_PER_SAVE, cost_per_contact: float = C.COST_PER_CONTACT,
                    save_rate: float = C.SAVE_RATE, first: int = 1, last: int = 99) -> DataFrame:
    """One row per threshold 0.01 ... 0.99: tp, fp, fn, n_targeted, precision, recall, f1 and net value.

    Each row falls into one of 100 buckets, counted with map-side combine; the sweep is a running total over buckets.
    """
    spark = df.sparkSession
    counted = df.groupBy(X.step_bucket(F.col(score).cast("double"), STEPS).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )
    grid = spark.range(0, STEPS, 1, 1).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("n"),
                                              F.lit(0).cast("bigint").alias("pos"))
    full = counted.unionByName(grid).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    at_least = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(0))
    rows = full.select(
        "bucket", F.sum("pos").over(at_least).alias("tp"), F.sum("n").over(at_least).alias("n_targeted"),
        F.sum("pos").over(everything).alias("_all"),
    ).where(F.col("bucket").between(first, last))
    counts = rows.select(
        (F.col("bucket") / float(STEPS)).alias("threshold"), "tp",
        (F.col("n_targeted") - F.col("tp")).alias("fp"), (F.col("_all") - F.col("tp")).alias("fn"), "n_targeted",
    )
    return with_precision_recall(counts).withColumn(
        "roi", net_value(F.col("tp"), F.col("n_targeted"), value_per_save, cost_per_contact, save_rate)
    )


def net_value(tp: Column, n: Column, value: float | Column, cost: float | Column, save: float | Column) -> Column:
    """Saved value less contact cost: TP * S * V - N * C."""
    return tp * save * value - n * cost


def sweep_by_scenario(sweep: DataFrame, scenarios: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The sweep repriced under each named scenario (a few rows per threshold)."""
    table = F.array(*[
        F.struct(
            F.lit(name).alias("scenario"), F.lit(s["value_per_save"]).alias("value_per_save"),
            F.lit(s["cost_per_contact"]).alias("cost_per_contact"), F.lit(s["save_rate"]).alias("save_rate"),
        )
        for name, s in (scenarios or C.SCENARIOS).items()
    ])
    rows = sweep.drop("roi").select("*", F.inline(table))
    return rows.withColumn("roi", net_value(F.col("tp"), F.col("n_targeted"), F.col("value_per_save"),
                                            F.col("cost_per_contact"), F.col("save_rate")))


def best_threshold(sweep: DataFrame, ops_k: int = C.OPS_K) -> DataFrame:
    """The net-value-best row (lowest threshold on ties) and the row whose volume is closest to ``ops_k``."""
    row = F.struct(*[F.col(c) for c in sweep.columns])
    low = -F.col("threshold")
    best = F.max_by(row, F.struct("roi", low.alias("low"))).alias("best")
    near = F.min_by(row, F.struct(F.abs(F.col("n_targeted") - ops_k).alias("gap"), "threshold")).alias("near")
    both = sweep.agg(best, near)
    pair = F.array(
        F.struct(F.lit("roi_max").alias("selected_by"), F.col("best").alias("r")),
        F.struct(F.lit("closest_to_capacity").alias("selected_by"), F.col("near").alias("r")),
    )
    return both.select(F.inline(pair)).select("selected_by", "r.*")


def best_f1_threshold(df: DataFrame, score: str = "y_proba", label: str = "y_true") -> DataFrame:
    """Threshold with the best F1 on 0.05 ... 0.95 (first one on ties)."""
    sweep = threshold_sweep(df, score, label, first=5, last=95)
    best = sweep.agg(F.max_by(F.struct("threshold", "tp", "fp", "fn", "precision", "recall", "f1"),
                              F.struct("f1", (-F.col("threshold")).alias("low"))).alias("r"))
    return best.select("r.*")


# ---- ranking quality -----------------------------------------------------------------------------------------------


def ranking_metrics(df: DataFrame, score: str = "y_proba", label: str = "y_true",
                    by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC (ties averaged) and step average precision, per ``by`` value, from one ordered pass.

    Both are NULL without positives; ROC-AUC also without negatives.
    """
    groups = score_groups(df, score, label, by)
    return metrics_of_groups(groups, by)


def metrics_of_groups(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    cum_pos, cum_n = F.col("cum_pos").cast("double"), F.col("cum_n").cast("double")
    sums = groups.groupBy(*by).agg(
        F.max("all_n").alias("n"), F.max("all_pos").alias("positives"),
        F.sum((n - pos) * (cum_pos - pos / 2)).alias("_pairs"),
        F.sum(pos * cum_pos / cum_n).alias("_steps"),
    )
    p, q = F.col("positives").cast("double"), (F.col("n") - F.col("positives")).cast("double")
    return sums.select(
        *by, "n", "positives",
        X.ratio(F.col("_pairs"), p * q).alias("roc_auc"),
        X.ratio(F.col("_steps"), p).alias("average_precision"),
    )


def topk_metrics(df: DataFrame, ks: Sequence[int] = C.TOP_KS, score: str = "y_proba", label: str = "y_true",
                 id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """TP, precision, recall, lift and cutoff score in the top min(K, n), one row per K (and ``by`` value)."""
    wanted = F.array(*[F.lit(int(k)) for k in sorted(ks)])
    if not by:
        return _topk_of_points(quota_points(df, ks, score, label, id), wanted)
    ranked = top_k(df.select(*by, id, score, label), max(ks), score, id, by)
    # A row counts for every K at or above its rank; the list of Ks is short.
    hits = ranked.select(*by, score, label, F.explode(F.filter(wanted, lambda k: k >= F.col("rank"))).alias("k"))
    counted = hits.groupBy(*by, "k").agg(
        F.count(F.lit(1)).alias("n_targeted"), F.sum(F.col(label).cast("bigint")).alias("tp"),
        F.min(score).alias("cutoff_score"),
    )
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("positives")
    )
    return _topk_rates(match(counted, totals, by), by)


def _topk_of_points(points: DataFrame, wanted: Column) -> DataFrame:
    """Top-K rows from the points of ``quota_points``; the last point holds all rows and stands for larger Ks."""
    whole = Window.partitionBy(F.lit(0))  # one row per K
    n = F.max("k").over(whole)
    rows = points.select("k", "tp", "threshold", n.alias("n"), F.max("tp").over(whole).alias("positives"))
    asked = F.filter(wanted, lambda w: F.least(w.cast("bigint"), F.col("n")) == F.col("k"))
    return _topk_rates(rows.select(
        F.explode(asked).alias("_asked"), F.col("k").alias("n_targeted"), "tp", F.col("threshold").alias("cutoff_score"), "n", "positives",
    ).withColumnRenamed("_asked", "k"), ())


def _topk_rates(joined: DataFrame, by: Sequence[str]) -> DataFrame:
    base = X.ratio0(F.col("positives").cast("double"), F.col("n"))
    return joined.select(
        *by, "k", "n_targeted", "tp",
        X.ratio0(F.col("tp").cast("double"), F.col("n_targeted")).alias("precision"),
        X.ratio0(F.col("tp").cast("double"), F.col("positives")).alias("recall"),
        X.ratio0(X.ratio0(F.col("tp").cast("double"), F.col("n_targeted")), base).alias("lift"),
        "cutoff_score",
    )


def equiv_threshold(df: DataFrame, k: int, score: str = "y_proba", id: str = "id",
                    capacity: int = C.OPS_K, recorded: float = C.OPS_CUTOFF) -> DataFrame:
    """Score at rank min(k, n); the recorded cutoff is attached when k is the configured capacity."""
    return top_k(df.select(id, score), k, score, id).agg(
        F.lit(k).alias("k"), F.count(F.lit(1)).alias("n_targeted"), F.min(score).alias("equiv_threshold"),
        F.lit(recorded if k == capacity else None).cast("double").alias("recorded_threshold"),
    )


def operating_curve(df: DataFrame, ks: Sequence[int], score: str = "y_proba", label: str = "y_true",
                    id: str = "id") -> DataFrame:
    """(k, tp, threshold) at each K up to n, the point (0, 0), and the whole base as last point."""
    points = quota_points(df, ks, score, label, id)
    zero = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("tp"), F.lit(None).cast("double").alias("threshold")
    )
    return zero.unionByName(points)


# ---- score distribution --------------------------------------------------------------------------------------------


def score_summary(df: DataFrame, score: str = "y_proba") -> DataFrame:
    df = df.select(clean_score(F.col(score)).alias(score))
    quantiles = exact_quantiles(df, score, (0.01, 0.05, 0.5, 0.95, 0.99))
    names = ("p01", "p05", "p50", "p95", "p99")
    basic = df.agg(F.struct(
        F.min(score).alias("lo"), F.max(score).alias("hi"), F.avg(score).alias("mean")
    )).scalar()
    return quantiles.withColumn("_b", basic).select(
        F.col("_b.lo").alias("proba_min"),
        *[F.col("quantiles")[i].alias(f"proba_{n}") for i, n in enumerate(names)],
        F.col("_b.hi").alias("proba_max"), F.col("_b.mean").alias("proba_mean"),
    )


def score_histogram(df: DataFrame, score: str = "y_proba", bins: int = 20) -> DataFrame:
    """Rows per equal-width bin of [0, 1]; empty bins come with 0, missing scores (if any) as bin -1 without a center."""
    spark, value = df.sparkSession, clean_score(F.col(score))
    grid = spark.range(0, bins, 1, 1).select(F.col("id").cast("int").alias("bin"), F.lit(0).cast("bigint").alias("n"))
    counted = df.groupBy(
        F.when(value.isNull(), -1).otherwise(X.clamp(F.floor(value * bins), 0, bins - 1)).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    return grid.unionByName(counted).groupBy("bin").agg(F.sum("n").alias("n")).select(
        "bin", F.when(F.col("bin") >= 0, (F.col("bin") + 0.5) / bins).alias("center"), "n"
    )


def confusion_of_groups(groups: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts from score groups instead of rows."""
    hit = F.coalesce(F.col("score") >= threshold, F.lit(False))
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")

    def total(when: Column, x: Column) -> Column:
        return F.sum(F.when(when, x).otherwise(0))

    return groups.groupBy(*by).agg(total(hit, pos).alias("tp"), total(hit, neg).alias("fp"),
                                   total(~hit, pos).alias("fn"), total(~hit, neg).alias("tn"))


def evaluate(df: DataFrame, threshold: float = 0.5, ks: Sequence[int] = C.TOP_KS, score: str = "y_proba",
             label: str = "y_true", id: str = "id", by: Sequence[str] = (), split: tuple[str, str] | None = None) -> DataFrame:
    """Evaluation bundle per ``by`` value: rows, rate, AUC, AP, F1 at the threshold, and maps of P@K and R@K.

    ``split`` (method, cutoff date) of the validation rows is recorded beside the figures. AUC, AP and the confusion counts all come from the one written table of score groups.
    """
    by = list(by) or ["_all"]
    rows = df.select(*[c for c in by if c in df.columns], id, score, label)
    rows = rows.withColumn("_all", F.lit(0)) if by == ["_all"] else rows
    groups = score_groups(rows, score, label, by)
    at = with_accuracy(with_precision_recall(confusion_of_groups(groups, threshold, by)))
    tops = topk_metrics(rows, ks, score, label, id).withColumn("_all", F.lit(0)) if by == ["_all"] else \
        topk_metrics(rows, ks, score, label, id, by)
    tops = tops.groupBy(*by).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "precision")))).alias("precision_at_k"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "recall")))).alias("recall_at_k"))
    quality = metrics_of_groups(groups, by).select(
        *by, F.col("n").alias("valid_rows"), "positives",
        X.ratio(F.col("positives").cast("double"), F.col("n")).alias("valid_churn_rate"), "roc_auc", "average_precision",
    )
    bundle = match(match(quality, at.select(*by, "precision", "recall", "f1", "accuracy"), by), tops, by)
    if split:
        bundle = bundle.withColumns({"split_method": F.lit(split[0]), "cutoff_date": F.lit(split[1])})
    return bundle.withColumn("threshold", F.lit(threshold)).drop("_all")


def majority_baseline(train: DataFrame, valid: DataFrame, label: str = "is_churn", id: str = C.KEY) -> DataFrame:
    """Scores of the constant baseline: the majority class and the training rate for every validation row."""
    rate = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    return valid.select(id, F.col(label).alias("y_true"), rate.alias("y_proba")).withColumn(
        "y_pred", (F.col("y_proba") >= 0.5).cast("int")
    )
