"""Rule-of-thumb churn scorecard and reasons, as column expressions.

A score starts from a base log-odds and adds one term per known signal. Terms travel as
``ARRAY<STRUCT<id, text, logit, provided>>`` so reasons are higher-order functions over the row, without any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import clamp, half_up, half_up_int, logit, sigmoid
from churnspark.functions.dates import ymd_to_days

# Base log-odds, smallest reported impact, cutoff day, valid date range.
BASE_LOGIT = -3.0
MIN_IMPACT = 0.002
CUTOFF_DAY = 20170228
FIRST_DAY, LAST_DAY = 19000101, 21001231

# Term weights and defaults.
W = {
    "auto_renew": 2.4, "auto_renew_default": 0.5,
    "cancel": 1.6, "cancel_default": 0.0,
    "lapsed": 1.2, "lapsed_day": 0.03, "lapsed_cap": 30, "far_days": 45, "far": -1.2, "near": 0.3, "near_day": 0.015,
    "silent_day": 0.045, "silent_free": 7, "silent_cap": 60,
    "txn": -0.06, "txn_cap": 20, "txn_few": 2, "txn_few_add": 0.7, "txn_default": 3,
    "active": -0.0015, "active_cap": 400, "active_few": 15, "active_few_add": 0.6, "active_default": 30,
    "discount_below": 0.75, "discount": 0.6,
    "full": 1.2, "full_center": 0.7,
    "secs": 0.3, "secs_unit": 0.00008, "secs_cap": 10000,
}


def _number(name: str) -> Column:
    x = F.col(name).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def _percent(x: Column) -> Column:
    return F.concat(half_up_int(x * 100).cast("string"), F.lit("%"))


def _plain(x: Column) -> Column:
    whole = x.cast("bigint")
    return F.when(x == whole, whole.cast("string")).otherwise(x.cast("string"))


def _count(x: Column, word: str) -> Column:
    return F.concat(_plain(x), F.lit(f" {word}"), F.when(x == 1, "").otherwise("s"))


def _one_decimal(x: Column) -> Column:
    tenths = half_up_int(x * 10)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def _term(name: str, text: Column, points: Column, provided: Column) -> Column:
    return F.struct(F.lit(name).alias("id"), text.alias("text"), points.alias("logit"), provided.alias("provided"))


def inputs(cutoff_day: int = CUTOFF_DAY) -> dict[str, Column]:
    """Cleaned signals, as helper columns: terms read each of them several times."""
    cutoff = ymd_to_days(F.lit(cutoff_day))

    def day(name: str) -> Column:
        value = _number(name)
        return F.when(value.between(FIRST_DAY, LAST_DAY), ymd_to_days(value))

    numbers = {
        "_auto": "auto_renew_rate", "_cancel": "cancel_rate", "_txn": "txn_cnt", "_active": "log_active_days",
        "_listed": "plan_list_price_mean", "_paid": "actual_paid_mean", "_full": "listen_full_share",
        "_secs": "total_secs_mean_per_active_day",
    }
    return {name: _number(column) for name, column in numbers.items()} | {
        "_gap": (day("membership_expire_date_max") - cutoff).cast("double"),
        "_since": (cutoff - day("log_last_date")).cast("double"),
    }


def terms() -> Column:
    """Array of the terms that apply to a row, in fixed order, over the ``inputs`` columns."""
    auto, cancel, txn, active, listed, paid, full, secs, gap, since = (F.col(c) for c in (
        "_auto", "_cancel", "_txn", "_active", "_listed", "_paid", "_full", "_secs", "_gap", "_since"))
    a = clamp(F.coalesce(auto, F.lit(W["auto_renew_default"])), 0, 1)
    c = clamp(F.coalesce(cancel, F.lit(W["cancel_default"])), 0, 1)
    t = F.coalesce(txn, F.lit(float(W["txn_default"])))
    d = F.coalesce(active, F.lit(float(W["active_default"])))
    f = clamp(full, 0, 1)

    gap_points = (
        F.when(gap < 0, W["lapsed"] + W["lapsed_day"] * F.least(-gap, F.lit(float(W["lapsed_cap"]))))
        .when(gap > W["far_days"], W["far"]).otherwise(W["near"] - W["near_day"] * gap)
    )
    gap_text = (
        F.when(gap < 0, F.concat(F.lit("Membership lapsed "), _count(-gap, "day"), F.lit(" ago")))
        .when(gap == 0, "Membership expires today")
        .otherwise(F.concat(F.lit("Membership runs "), _count(gap, "more day")))
    )
    yes = F.lit(True)
    every = F.array(
        _term("auto_renew_rate", F.concat(F.lit("Auto-renew on "), _percent(a), F.lit(" of payments")),
              W["auto_renew"] * (1 - a), auto.isNotNull()),
        _term("cancel_rate", F.concat(F.lit("Cancelled "), _percent(c), F.lit(" of transactions")),
              W["cancel"] * c, cancel.isNotNull()),
        F.when(gap.isNotNull(), _term("membership_expire_date_max", gap_text, gap_points, yes)),
        F.when(since.isNotNull(), _term(
            "log_last_date", F.concat(F.lit("Last listened "), _count(F.greatest(since, F.lit(0.0)), "day"), F.lit(" ago")),
            W["silent_day"] * clamp(since - W["silent_free"], 0.0, float(W["silent_cap"])), yes)),
        _term("txn_cnt", F.concat(_count(t, "transaction"), F.lit(" on record")),
              W["txn"] * clamp(t, 0.0, float(W["txn_cap"])) + F.when(t <= W["txn_few"], W["txn_few_add"]).otherwise(0.0),
              txn.isNotNull()),
        _term("log_active_days", _count(d, "active listening day"),
              W["active"] * clamp(d, 0.0, float(W["active_cap"]))
              + F.when(d < W["active_few"], W["active_few_add"]).otherwise(0.0),
              active.isNotNull()),
        F.when((listed > 0) & (paid < W["discount_below"] * listed), _term(
            "actual_paid_mean", F.concat(F.lit("Paying "), _percent(1 - paid / F.when(listed > 0, listed)),
                                         F.lit(" below list price")), F.lit(W["discount"]), yes)),
        F.when(full.isNotNull(), _term(
            "listen_full_share", F.concat(_percent(f), F.lit(" of plays heard to the end")),
            W["full"] * (W["full_center"] - f), yes)),
        F.when(secs.isNotNull(), _term(
            "total_secs_mean_per_active_day",
            F.concat(_one_decimal(F.greatest(secs, F.lit(0.0)) / 3600), F.lit(" h listening per active day")),
            W["secs"] - W["secs_unit"] * clamp(secs, 0.0, float(W["secs_cap"])), yes)),
    )
    return F.filter(every, lambda x: x.isNotNull())


def total_logit(term_column: Column) -> Column:
    return F.aggregate(term_column, F.lit(BASE_LOGIT), lambda z, x: z + x["logit"])


def with_scorecard(df: DataFrame, cutoff_day: int = CUTOFF_DAY, keep_terms: bool = False) -> DataFrame:
    """Adds ``logit`` and ``y_proba`` (four decimals); ``keep_terms`` leaves the ``terms`` array for the reasons."""
    helpers = inputs(cutoff_day)
    out = df.withColumns(helpers).withColumn("terms", terms()).drop(*helpers)
    out = out.withColumn("logit", total_logit(F.col("terms")))
    out = out.withColumn("y_proba", half_up(sigmoid(F.col("logit")), 4))
    return out if keep_terms else out.drop("terms")


def impact_slope(z: Column, base: float | Column, p: Column, p0: Column) -> Column:
    """Average slope of the sigmoid between the base and this log-odds, so impacts add up to p - p0."""
    return F.when(F.abs(z - base) < 1e-9, p * (1 - p)).otherwise((p - p0) / (z - base))


def reasons(limit: int = 5) -> Column:
    """Top reasons from ``terms`` and ``logit``: known inputs only, |impact| >= 0.002, largest first."""
    z = F.col("logit")
    slope = impact_slope(z, F.lit(BASE_LOGIT), sigmoid(z), sigmoid(F.lit(BASE_LOGIT)))
    known = F.filter("terms", lambda x: x["provided"])

    def pick(value: Column) -> Column:
        # Natural struct order: size of the impact, then the order of the terms.
        sized = F.transform(known, lambda x, i: F.struct(
            (-F.abs(x["logit"] * value)).alias("size"), i.alias("place"), x["id"].alias("id"),
            x["text"].alias("text"), (x["logit"] * value).alias("impact")))
        large = F.filter(sized, lambda x: x["size"] <= -MIN_IMPACT)
        return F.transform(F.slice(F.array_sort(large), 1, limit), lambda x: F.struct(
            x["id"].alias("id"), x["text"].alias("text"), x["impact"].alias("impact")))

    return _with_value(slope, pick)


def _with_value(value: Column, then) -> Column:
    """``then(value)`` with the value computed once per row instead of once per array element."""
    return F.get(F.transform(F.array(value), then), 0)


def points_text(impact: Column) -> Column:
    """'+12 pts', '−<1 pt'."""
    points = half_up_int(F.abs(impact) * 100)
    return F.concat(F.when(impact >= 0, "+").otherwise("−"),
                    F.when(points == 0, "<1 pt").otherwise(F.concat(points.cast("string"), F.lit(" pts"))))


def reason_text(reason_column: Column) -> Column:
    return F.concat_ws("; ", F.transform(
        reason_column, lambda x: F.concat(x["text"], F.lit(" ("), points_text(x["impact"]), F.lit(")"))))


def contribution_points(contributions: Column, base: Column, probability: Column) -> Column:
    """Log-odds contributions ``ARRAY<STRUCT<feature, contribution>>`` as probability points (adds ``impact``)."""
    p = clamp(probability, 1e-6, 1 - 1e-6)
    slope = impact_slope(logit(p), base, p, sigmoid(base))
    return _with_value(slope, lambda value: F.transform(contributions, lambda x: F.struct(
        x["feature"].alias("feature"), x["contribution"].alias("contribution"),
        (x["contribution"] * value).alias("impact"))))


def rows_of(df: DataFrame, keep: list[str], items: str | Column) -> DataFrame:
    """keep..., pos and the fields of each array element.

    The outer form keeps Spark from testing the array's size in a pushed-down filter, which would compute the whole
    array expression a second time.
    """
    out = df.select(*keep, F.posexplode_outer(items).alias("pos", "_item")).where("pos IS NOT NULL")
    return out.select(*keep, "pos", "_item.*")


def top_contributions(contributions: Column, n: int = 5) -> Column:
    """The n contributions with the largest absolute value, original order on ties."""
    sized = F.transform(contributions, lambda x, i: F.struct(
        (-F.abs(x["contribution"])).alias("size"), i.alias("place"), x["feature"].alias("feature"),
        x["contribution"].alias("contribution")))
    return F.transform(F.slice(F.array_sort(sized), 1, n), lambda x: F.struct(
        x["feature"].alias("feature"), x["contribution"].alias("contribution")))
