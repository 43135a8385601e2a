"""Global order at scale: ranks, prefix sums and top-K without a single-task sort.

Ordered work goes through one range shuffle, after which each written part holds a contiguous slice of the order and
every row carries its position in the part. Ranks and running totals are then "offset of the part + place in the part";
the offsets table has one row per part (at most ``spark.sql.shuffle.partitions``), so it is safe to broadcast. The order
always ends in a unique id or runs over already grouped values, so one hot value spreads over many parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.sources.staging import stage

BINS = 10_000
_PART_BITS = 33


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL with NULL; the keys come from the left side."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def clean_score(score: Column) -> Column:
    """NaN counts as missing; missing scores rank last, reach no threshold and belong to no bin."""
    return F.when(~F.isnan(score.cast("double")), score)


def reaches(score: Column, threshold: float | Column) -> Column:
    """Whether a score is at or above the threshold; a missing one never is."""
    return F.coalesce(clean_score(score) >= threshold, F.lit(False))


def ordered(df: DataFrame, *order: Column, name: str = "ordered") -> DataFrame:
    """Write ``df`` in global order. ``_part`` numbers the parts in that order, ``_place`` the rows of a part from 0."""
    position = F.monotonically_increasing_id()
    written = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_position", position), name
    )
    return written.select(
        "*",
        F.shiftright("_position", _PART_BITS).alias("_part"),
        F.col("_position").bitwiseAND(F.lit((1 << _PART_BITS) - 1)).alias("_place"),
    ).drop("_position")


def with_position(df: DataFrame, *order: Column, out: str = "_row") -> DataFrame:
    """Number the rows 0..n-1 in global order. The order must be total (end it in a unique id)."""
    rows = ordered(df, *order, name="positions")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def rank_by(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Rank 1..n in the given total order, restarting for each value of ``by``.

    A ``by`` value may hold any share of the rows: the table is ordered as a whole and the rank is the distance to the
    first row of the value.
    """
    if not by:
        rows = with_position(df, *order, out="_row")
        return rows.withColumn(out, F.col("_row") + 1).drop("_row")
    rows = with_position(df, *[F.col(c).asc_nulls_first() for c in by], *order, out="_row")
    first = stage(rows.groupBy(*by).agg(F.min("_row").alias("_first")), "first-rows")
    return match(rows, first, by).withColumn(out, F.col("_row") - F.col("_first") + 1).drop("_row", "_first")


def global_rank(
    df: DataFrame, score: str = "y_proba", id: str = "id", by: Sequence[str] = (), out: str = "rank"
) -> DataFrame:
    """Rank by score descending, id ascending; missing scores last."""
    return rank_by(df, [clean_score(F.col(score).cast("double")).desc_nulls_last(), F.col(id).asc()], by, out)


# ---- running totals over grouped values ----------------------------------------------------------------------------


def running_totals(
    grouped: DataFrame, order: Sequence[Column], sums: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Inclusive running totals ``cum_<c>`` and per-``by`` totals ``all_<c>`` of the columns ``sums``.

    ``grouped`` must have one row per (by, ordered value). ``by`` stands for features, weights or cycles: its values
    are few, while the values inside one of them may be any number.
    """
    by = list(by)
    rows = ordered(grouped, *[F.col(c) for c in by], *order, name="totals")
    parts = rows.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_part_{c}") for c in sums])
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by, "_part",
        *[F.coalesce(F.sum(f"_part_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_part_{c}").over(whole).alias(f"all_{c}") for c in sums],
    )
    # Without ``by`` there is one row per part; with it, one more per value of ``by``.
    offsets = stage(offsets, "offsets") if by else F.broadcast(offsets)
    # _place follows the part's order, so it also orders the rows of one ``by`` value inside the part.
    inside = Window.partitionBy("_part", *by).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *[F.sum(c).over(inside).alias(f"_inside_{c}") for c in sums])
    return match(summed, offsets, [*by, "_part"]).select(
        *grouped.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(f"cum_{c}") for c in sums],
        *[f"all_{c}" for c in sums],
    )


def score_groups(
    df: DataFrame, score: str = "y_proba", label: str = "y_true", by: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score, best first, with counts, positives and their running totals."""
    grouped = (
        df.groupBy(*by, clean_score(F.col(score).cast("double")).alias("score"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))
    )
    return running_totals(grouped, [F.col("score").desc_nulls_last()], ["n", "pos"], by)


# ---- top-K ---------------------------------------------------------------------------------------------------------


def _bin(score: Column) -> Column:
    """Monotone bin of a score; -1 for a missing one. Only speed depends on how evenly it splits."""
    scaled = F.floor(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)) * BINS).cast("int")
    return F.coalesce(scaled, F.lit(-1))


def quota_cutoff(df: DataFrame, score: str, id: str, quota: Column, by: Sequence[str] = ()) -> DataFrame:
    """The row that fills the quota: per ``by`` value (tiers, cycles ...) its score and id in the order score
    descending, id ascending. No row comes back for a ``by`` value with fewer rows than its quota.

    Counting by bin finds the bin where the quota is reached, and only the rows of that bin are put in order.
    ``quota`` may use the ``by`` columns and ``_all``, the number of rows of the ``by`` value.
    """
    by = list(by) or ["_one"]
    value = clean_score(F.col(score).cast("double"))
    base = df if by != ["_one"] else df.withColumn("_one", F.lit(0))
    # Counted, matched and ordered below: the narrow rows are written once instead of evaluating ``df`` for each.
    rows = stage(base.select(*by, value.alias("_score"), F.col(id).alias("_id"), _bin(value).alias("_bin")), "narrow")
    whole = Window.partitionBy(*by)
    bins = (
        rows.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(whole.orderBy(F.col("_bin").desc())))
        .withColumn("_all", F.sum("_n").over(whole))
        .withColumn("_quota", quota.cast("bigint"))
        .where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
        .select(*by, "_bin", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left"))
    )
    bins = F.broadcast(bins) if by == ["_one"] else stage(bins, "bins")
    near = match(rows, bins, [*by, "_bin"])
    ranked = rank_by(near, [F.col("_score").desc_nulls_last(), F.col("_id").asc()], by, "_rank")
    found = ranked.where(F.col("_rank") == F.col("_left"))
    cutoffs = found.select(*by, F.col("_score").alias("cut_score"), F.col("_id").alias("cut_id"))
    return F.broadcast(cutoffs) if by == ["_one"] else stage(cutoffs, "cutoffs")


def quota_points(df: DataFrame, ks: Sequence[int], score: str = "y_proba", label: str = "y_true", id: str = "id") -> DataFrame:
    """(k, tp, threshold): positives and lowest score among the k best rows, for every k up to the number of rows and for
    all rows. Rows are counted by score bin; only rows of bins in which a k falls are put in order.
    """
    value = clean_score(F.col(score).cast("double"))
    rows = stage(df.select(value.alias("_score"), F.col(id).alias("_id"), F.col(label).cast("bigint").alias("_pos"),
                           _bin(value).alias("_bin")), "narrow")
    down = Window.orderBy(F.col("_bin").desc())
    bins = rows.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n"), F.sum("_pos").alias("_pos"), F.min("_score").alias("_low"))
    bins = bins.select("_bin", "_n", "_low", F.sum("_n").over(down).alias("_upto"), F.sum("_pos").over(down).alias("_found"),
                       F.col("_pos").alias("_own"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_all"))
    wanted = F.array_union(F.array(*[F.lit(int(k)).cast("bigint") for k in sorted(set(ks)) if k > 0]), F.array("_all"))
    inside = F.filter(wanted, lambda k: (k <= F.col("_upto")) & (k > F.col("_upto") - F.col("_n")))
    hits = stage(bins.select("*", F.explode(inside).alias("k")), "quota-bins")  # one row for each k
    full = hits.where(F.col("k") == F.col("_upto")).select("k", F.col("_found").alias("tp"), F.col("_low").alias("threshold"))
    cut = hits.where(F.col("k") < F.col("_upto")).select(
        F.col("_bin").alias("_b"), "k", (F.col("k") - F.col("_upto") + F.col("_n")).alias("_left"),
        (F.col("_found") - F.col("_own")).alias("_before"))
    near = rows.join(F.broadcast(cut.select(F.col("_b").alias("_bin")).distinct()), "_bin")
    ranked = rank_by(near, [F.col("_score").desc_nulls_last(), F.col("_id").asc()], ["_bin"], "_rank")
    part = ranked.join(F.broadcast(cut), (F.col("_bin") == F.col("_b")) & (F.col("_rank") <= F.col("_left")))
    points = part.groupBy("k").agg((F.max("_before") + F.sum("_pos")).alias("tp"), F.min("_score").alias("threshold"))
    return full.unionByName(points)


def within_cutoff(df: DataFrame, cutoffs: DataFrame, score: str, id: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows at or before their ``by`` value's cutoff row; a value without a cutoff row keeps all its rows."""
    by = list(by) or ["_one"]
    base = df if by != ["_one"] else df.withColumn("_one", F.lit(0))
    value = clean_score(F.col(score).cast("double"))
    cut, cut_id = F.col("cut_score"), F.col("cut_id")
    before = (
        (F.coalesce(value, F.lit(float("-inf"))) > F.coalesce(cut, F.lit(float("-inf"))))
        | (value.eqNullSafe(cut) & (F.col(id) <= cut_id))
    )
    joined = match(base, cutoffs, by, "left")
    kept = joined.where(cut_id.isNull() | before)
    return kept.drop("cut_score", "cut_id", "_one")


def best_rows(df: DataFrame, k: int, score: str = "y_proba", id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """The k best rows (per ``by`` value), unordered: every row is compared with the cutoff row, none is sorted."""
    if k <= 0:
        raise ValueError("k must be > 0")
    return within_cutoff(df, quota_cutoff(df, score, id, F.lit(k), by), score, id, by)


def top_k(df: DataFrame, k: int, score: str = "y_proba", id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """The k best rows (per ``by`` value) with their ``rank``; only rows that make the cut are sorted."""
    return global_rank(best_rows(df, k, score, id, by), score, id, by)
