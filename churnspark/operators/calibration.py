"""Isotonic calibration of scores, fitted and applied without the driver.

Pool-adjacent-violators in rounds: the blocks (at first one per distinct score) are numbered in score order and dealt into
groups of ``GROUP`` neighbours, each group pools its violators, and the next round's groups are shifted by half. Pooling
neighbours that violate the order is a step of the one right solution in whatever order it is done, and when neither cut
finds a pair to pool, no two neighbours are out of order. A round costs a range shuffle of the blocks left.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.operators.rank import clean_score, ordered, with_position
from churnspark.sources.staging import stage

GROUP = 100_000
BLOCK = "low double, high double, weight double, total double"


def _pooled(frame: pd.DataFrame) -> pd.DataFrame:
    """Blocks of one group, ascending: neighbours whose means do not rise are one."""
    out: list[list[float]] = []
    rows = frame.sort_values("low")
    for low, high, weight, total in zip(rows["low"], rows["high"], rows["weight"], rows["total"]):
        block = [low, high, weight, total]
        while out and out[-1][3] * block[2] >= block[3] * out[-1][2]:
            left = out.pop()
            block = [left[0], block[1], left[2] + block[2], left[3] + block[3]]
        out.append(block)
    return pd.DataFrame(out, columns=["low", "high", "weight", "total"])


def fit_isotonic(points: DataFrame, group: int = GROUP) -> DataFrame:
    """(block, low, high, value): the steps of the non-decreasing fit to ``points`` (score, weight, rate), one per score."""
    score = F.col("score").cast("double")
    blocks = stage(points.select(score.alias("low"), score.alias("high"), F.col("weight").cast("double").alias("weight"),
                                 (F.col("weight") * F.col("rate")).cast("double").alias("total")), "points")
    count, idle, shift = blocks.count(), 0, 0
    while idle < 2:
        numbered = with_position(blocks, F.col("low").asc())
        dealt = numbered.groupBy(F.floor((F.col("_row") + shift) / group).alias("_group"))
        blocks = stage(dealt.applyInPandas(_pooled, BLOCK), "blocks")
        left = blocks.count()
        # One group has seen all; otherwise both cuts must find nothing.
        idle = 2 if count + shift <= group else idle + 1 if left == count else 0
        count, shift = left, group // 2 - shift
    numbered = with_position(blocks, F.col("low").asc())
    return numbered.select(F.col("_row").alias("block"), "low", "high", (F.col("total") / F.col("weight")).alias("value"))


def fit_calibration(df: DataFrame, score_col: str = "y_proba", label: str = "y_true", group: int = GROUP) -> DataFrame:
    """Isotonic regression of the label on the score, on one weighted row per distinct score; missing scores are left out."""
    df = df.withColumn(score_col, clean_score(F.col(score_col))).where(F.col(score_col).isNotNull())
    points = df.groupBy(F.col(score_col).cast("double").alias("score")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.avg(F.col(label).cast("double")).alias("rate"))
    return stage(fit_isotonic(points, group), "calibration")


def last_before(keys: DataFrame, table: DataFrame, low: str) -> DataFrame:
    """Every key (column ``key``, distinct) with the ``row`` of ``table`` that has the greatest ``low`` at or below it; NULL
    if there is none. Both go through one range shuffle; what a part does not know comes from the parts before it."""
    marks = table.select(F.col(low).cast("double").alias("key"), F.lit(0).alias("kind"), F.struct(*table.columns).alias("row"))
    asked = keys.select(F.col("key").cast("double").alias("key"), F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["row"].dataType).alias("row"))
    lined = ordered(marks.unionByName(asked), F.col("key").asc(), F.col("kind").asc(), name="asof")
    newest = F.max_by("row", F.when(F.col("row").isNotNull(), F.col("_place")))
    parts = lined.groupBy("_part").agg(newest.alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_carried"))  # one row per part
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    seen = lined.withColumn("_seen", F.last("row", ignorenulls=True).over(inside)).where("kind = 1")
    return seen.join(F.broadcast(carried), "_part").select("key", F.coalesce("_seen", "_carried").alias("row"))


def calibrate(df: DataFrame, fitted: DataFrame, score_col: str = "y_proba") -> DataFrame:
    """Adds ``calibrated``: interpolated between the fitted blocks, flat beyond them, NULL for a missing score.

    Distinct scores are looked up and joined back, so rows with equal scores cost one lookup.
    """
    value = clean_score(F.col(score_col)).cast("double")
    after = fitted.select((F.col("block") - 1).alias("block"), F.col("low").alias("next_low"), F.col("value").alias("next_value"))
    steps = stage(fitted.join(after, "block", "left"), "steps")
    found = last_before(df.select(value.alias("key")).where(F.col("key").isNotNull()).distinct(), steps, "low")
    first = F.broadcast(steps.where("block = 0").select(F.col("value").alias("_first")))  # one row at most
    r, x = F.col("row"), F.col("key")
    slope = (r["next_value"] - r["value"]) / (r["next_low"] - r["high"])
    inside = F.when((x <= r["high"]) | r["next_low"].isNull(), r["value"]).otherwise(r["value"] + slope * (x - r["high"]))
    known = stage(found.join(first, how="left").select(x.alias("_key"), F.coalesce(inside, "_first").alias("calibrated")), "calibrated")
    return df.drop("calibrated").join(known, value == F.col("_key"), "left").drop("_key")
