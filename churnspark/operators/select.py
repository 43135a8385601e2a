"""Selection instead of sorting: exact quantiles and exact two-sample gaps by refining bins.

A double is seen as the 64-bit number its sign, exponent and mantissa form, which orders like the double itself. A pass
counts rows by the leading bits of that number, 16 more bits in each pass, and only inside the bins that may still hold the
answer; a bin of one value is never split. So at most four passes over a narrow written table shuffle one row per bin and
task, whatever the number of distinct values, and nothing is put in order but bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.columns import order_code, ratio
from churnspark.sources.staging import stage

STEP = 16  # bits a pass adds: at most 65,536 bins within a bin of the pass before
PASSES = 64 // STEP


def _prefix(level: int) -> Column:
    """The leading ``STEP`` x level bits of the code."""
    return F.shiftright("_code", 64 - STEP * level)


def _coded(df: DataFrame, column: str, by: Sequence[str], *more: str) -> DataFrame:
    """The values that count, written once: by..., _value, _code, more. Missing values are left out; -0 is 0."""
    value = F.col(column).cast("double") + F.lit(0.0)
    rows = df.select(*by, value.alias("_value"), *more).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    return stage(rows.withColumn("_code", order_code(F.col("_value"))), "coded")


def _counted(rows: DataFrame, by: Sequence[str], level: int, open_bins: DataFrame | None, counts: Sequence[Column]) -> DataFrame:
    """One row per bin of this level inside the open bins (by..., _bin, and what they carry): _next, _low, _high, counts."""
    carried: list[str] = []
    if open_bins is not None:
        carried = [c for c in open_bins.columns if c not in by]
        # One row per open bin; written, so that Spark knows how small it is.
        rows = rows.withColumn("_bin", _prefix(level - 1)).join(open_bins, [*by, "_bin"])
    return rows.groupBy(*by, *carried, _prefix(level).alias("_next")).agg(
        F.min("_value").alias("_low"), F.max("_value").alias("_high"), *counts)


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per ``by`` with an array column ``quantiles`` in ``qs`` order.

    ``by`` values are few (features, tiers, cycles); a value of NULL is no value. Stages a narrow table.
    """
    by = list(by)
    group = by or ["_one"]
    rows = _coded(df.withColumn("_one", F.lit(0)) if not by else df, column, group)
    places = [F.lit(float(q)) * (F.col("_all") - 1) for q in qs]
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in places]))).cast("array<bigint>")
    found, open_bins = None, None
    for level in range(1, PASSES + 1):
        bins = _counted(rows, group, level, open_bins, [F.count(F.lit(1)).alias("_n")])
        if level == 1:
            inside = Window.partitionBy(*group)
            bins = bins.withColumns({"_base": F.lit(0).cast("bigint"), "_all": F.sum("_n").over(inside)}).withColumn("_ranks", wanted)
            carry = []
        else:
            carry = ["_bin"]
        upto = F.col("_base") + F.sum("_n").over(Window.partitionBy(*group, *carry).orderBy("_next"))
        bins = bins.withColumn("_upto", upto)
        hit = F.filter("_ranks", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_n")))
        hits = stage(bins.select(*group, "_next", "_low", "_high", "_all", (F.col("_upto") - F.col("_n")).alias("_base"),
                                 hit.alias("_ranks")).where(F.size("_ranks") > 0), "quantile-bins")
        done = hits.where(F.col("_low") == F.col("_high")).select(*group, "_all", F.explode("_ranks").alias("_rank"), F.col("_low").alias("_value"))
        found = done if found is None else found.unionByName(done)
        open_bins = hits.where(F.col("_low") < F.col("_high"))
        if level == PASSES or open_bins.isEmpty():
            break
        open_bins = open_bins.withColumnRenamed("_next", "_bin").drop("_low", "_high")
    at = found.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"), F.max("_all").alias("_all"))
    out = []
    for p in places:
        low, high = F.get(F.map_values(F.map_filter("_at", lambda k, _: k == F.floor(p))), F.lit(0)), \
            F.get(F.map_values(F.map_filter("_at", lambda k, _: k == F.ceil(p))), F.lit(0))
        out.append(low + (high - low) * (p - F.floor(p)))
    return at.select(*by, F.array(*out).alias("quantiles"))


def largest_gap(both: DataFrame, column: str, first: str, second: str, by: Sequence[str]) -> DataFrame:
    """by..., all_a, all_b, gap: the largest distance between the running shares of two samples, exactly.

    ``first`` and ``second`` are 0/1 columns that say whose a row is. The shares at the borders of the bins are known; within
    a bin the distance is at most what one share may gain before the other moves. Only bins whose bound is above the
    largest distance at any border are split, and each split raises that distance or lowers the bounds.
    """
    by = list(by)
    rows = _coded(both, column, by, first, second)
    counts = [F.sum(first).alias("_a"), F.sum(second).alias("_b")]
    best, open_bins = None, None
    for level in range(1, PASSES + 1):
        bins = _counted(rows, by, level, open_bins, counts)
        if level == 1:
            whole = Window.partitionBy(*by)
            bins = bins.withColumns({"all_a": F.sum("_a").over(whole), "all_b": F.sum("_b").over(whole),
                                     "_a0": F.lit(0).cast("bigint"), "_b0": F.lit(0).cast("bigint")})
        inside = Window.partitionBy(*by, *([] if level == 1 else ["_bin"])).orderBy("_next")
        bins = bins.withColumns({"_a1": F.col("_a0") + F.sum("_a").over(inside), "_b1": F.col("_b0") + F.sum("_b").over(inside)})
        bins = bins.withColumns({"_a0": F.col("_a1") - F.col("_a"), "_b0": F.col("_b1") - F.col("_b")})
        a0, a1, b0, b1 = (ratio(F.col(f"_{x}{k}").cast("double"), F.col(f"all_{x}")) for x in "ab" for k in (0, 1))
        bins = stage(bins.select(*by, "_next", "_low", "_high", "all_a", "all_b", "_a0", "_b0", F.abs(a1 - b1).alias("_gap"),
                                 F.greatest(a1 - b0, b1 - a0).alias("_bound")), "gap-bins")
        here = bins.groupBy(*by).agg(F.max("_gap").alias("gap"), F.max("all_a").alias("all_a"), F.max("all_b").alias("all_b"))
        if best is not None:
            here = best.unionByName(here).groupBy(*by).agg(*[F.max(c).alias(c) for c in ("gap", "all_a", "all_b")])
        best = stage(here, "gaps")
        undecided = bins.where(F.col("_low") < F.col("_high")).join(best.select(*by, "gap"), by).where(F.col("_bound") > F.col("gap"))
        open_bins = stage(undecided.select(*by, F.col("_next").alias("_bin"), "all_a", "all_b", "_a0", "_b0"), "gap-open")
        if open_bins.isEmpty():
            break
    return best.select(*by, "all_a", "all_b", "gap")
