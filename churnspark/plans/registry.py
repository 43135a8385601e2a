"""Registered queries: name, Spark callable, and the SQL an independent engine can check it with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.plans.adapters import Tables, adapter_cte

DIGITS = 6
# Averages of money land on exact decimal ties: the mean of 32 amounts in cents can end in 5 at the seventh place (0.01 / 32 =
# 0.0003125). One engine rounds the decimal text half up, the other the binary product; a small shift breaks the tie.
SHIFT = 1.2345e-8


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(Tables) -> DataFrame``. Doubles are rounded to six places for comparison."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return rounded(fn(Tables(spark, sf_dir)))

        CATALOG[name] = Query(run, sql)
        return fn

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places; NaN is NULL, the one missing value."""
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{n}`")), F.round(F.col(f"`{n}`") + SHIFT, DIGITS)).alias(n) if t == "double" else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


def r6(expr: str, name: str) -> str:
    """Rounded SQL column."""
    return f"round(CAST({expr} AS DOUBLE) + {SHIFT!r}, {DIGITS}) AS {name}"


# ---- shared oracle CTEs --------------------------------------------------------------------------------------------

TXN_FEATURES = """txn_features AS (SELECT msno, count(*) AS txn_cnt,
  CAST(sum(is_cancel) AS BIGINT) AS cancel_cnt, avg(CAST(is_cancel AS DOUBLE)) AS cancel_rate,
  CAST(sum(is_auto_renew) AS BIGINT) AS auto_renew_cnt, avg(CAST(is_auto_renew AS DOUBLE)) AS auto_renew_rate,
  avg(plan_list_price) AS plan_list_price_mean, max(plan_list_price) AS plan_list_price_max,
  min(plan_list_price) AS plan_list_price_min, avg(actual_amount_paid) AS actual_paid_mean,
  max(actual_amount_paid) AS actual_paid_max, min(actual_amount_paid) AS actual_paid_min,
  count(DISTINCT payment_method_id) AS payment_method_nunique,
  CAST(min(transaction_date) AS BIGINT) AS txn_first_date, CAST(max(transaction_date) AS BIGINT) AS txn_last_date,
  CAST(max(transaction_date) - min(transaction_date) AS BIGINT) AS txn_tenure_days_approx,
  CAST(max(membership_expire_date) AS BIGINT) AS membership_expire_date_max
  FROM transactions GROUP BY msno)"""

_METRICS = ["total_secs", "num_unq", "num_25", "num_50", "num_75", "num_985", "num_100"]
LOG_DAILY = "log_daily AS (SELECT msno, date, count(*) AS row_cnt_d, " + ", ".join(
    f"sum(CAST({m} AS DOUBLE)) AS {m}_sum_d" for m in _METRICS) + " FROM user_logs GROUP BY msno, date)"
_PLAYS = " + ".join(f"sum({b}_sum_d)" for b in _METRICS[2:])
LOG_FEATURES = f"""log_features AS (SELECT msno, CAST(sum(row_cnt_d) AS BIGINT) AS log_row_cnt,
  CAST(min(date) AS BIGINT) AS log_first_date, CAST(max(date) AS BIGINT) AS log_last_date, count(*) AS log_active_days,
  CAST(max(date) - min(date) AS BIGINT) AS log_span_days_approx,
  sum(total_secs_sum_d) AS total_secs_sum, avg(total_secs_sum_d) AS total_secs_mean_per_active_day,
  max(total_secs_sum_d) AS total_secs_max_per_day, sum(num_unq_sum_d) AS num_unq_sum,
  avg(num_unq_sum_d) AS num_unq_mean_per_active_day, max(num_unq_sum_d) AS num_unq_max_per_day,
  {", ".join(f"sum({b}_sum_d) AS {b}_sum" for b in _METRICS[2:])},
  CASE WHEN ({_PLAYS}) > 0 THEN sum(num_100_sum_d) / ({_PLAYS}) END AS listen_full_share,
  CASE WHEN sum(num_unq_sum_d) > 0 THEN ({_PLAYS}) / sum(num_unq_sum_d) END AS listens_per_unique_track
  FROM log_daily GROUP BY msno)"""
MEMBERS_CLEAN = """members_clean AS (SELECT msno, city, CASE WHEN bd BETWEEN 10 AND 100 THEN CAST(bd AS DOUBLE) END AS bd,
  coalesce(gender, 'unknown') AS gender, registered_via,
  CAST(registration_init_time AS BIGINT) AS registration_init_time,
  TRY_CAST(substr(CAST(registration_init_time AS VARCHAR),1,4) || '-' ||
    substr(CAST(registration_init_time AS VARCHAR),5,2) || '-' ||
    substr(CAST(registration_init_time AS VARCHAR),7,2) AS DATE) AS registration_init_date FROM members)"""

TXN_DOUBLES = ["cancel_rate", "auto_renew_rate", "plan_list_price_mean", "plan_list_price_max", "plan_list_price_min",
               "actual_paid_mean", "actual_paid_max", "actual_paid_min"]
LOG_DOUBLES = ["total_secs_sum", "total_secs_mean_per_active_day", "total_secs_max_per_day", "num_unq_sum",
               "num_unq_mean_per_active_day", "num_unq_max_per_day", "num_25_sum", "num_50_sum", "num_75_sum",
               "num_985_sum", "num_100_sum", "listen_full_share", "listens_per_unique_track"]
TXN_LONGS = ["txn_cnt", "cancel_cnt", "auto_renew_cnt", "payment_method_nunique", "txn_first_date", "txn_last_date",
             "txn_tenure_days_approx", "membership_expire_date_max"]
LOG_LONGS = ["log_row_cnt", "log_first_date", "log_last_date", "log_active_days", "log_span_days_approx"]


def _zero(columns: list[str]) -> str:
    return ", ".join(f"coalesce({c}, 0) AS {c}" for c in columns)


MODEL_TABLE = f"""model_table AS (SELECT t.msno, t.is_churn, coalesce(m.city, 0) AS city, m.bd,
  coalesce(m.gender, 'unknown') AS gender, coalesce(m.registered_via, 0) AS registered_via,
  coalesce(m.registration_init_time, 0) AS registration_init_time,
  {_zero(TXN_LONGS + TXN_DOUBLES + LOG_LONGS + LOG_DOUBLES)}
  FROM train t LEFT JOIN members_clean m USING (msno) LEFT JOIN txn_features x USING (msno)
  LEFT JOIN log_features l USING (msno))"""

_LAYERS = {
    "txn_features": (("transactions",), (TXN_FEATURES,)),
    "log_daily": (("user_logs",), (LOG_DAILY,)),
    "log_features": (("user_logs",), (LOG_DAILY, LOG_FEATURES)),
    "members_clean": (("members",), (MEMBERS_CLEAN,)),
    "model_table": (("train", "members", "transactions", "user_logs"),
                    (MEMBERS_CLEAN, TXN_FEATURES, LOG_DAILY, LOG_FEATURES, MODEL_TABLE)),
}


def oracle(body: str, *needs: str, ctes: tuple[str, ...] = ()) -> str:
    """WITH <adapters and layers>, <ctes> <body>."""
    parts = []
    for need in needs:
        if need in _LAYERS:
            adapters, layers = _LAYERS[need]
            parts += [adapter_cte(*adapters), *layers]
        else:
            parts.append(adapter_cte(need))
    parts += list(ctes)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def replaced(columns: list[str]) -> str:
    """SELECT list: all columns, the doubles rounded."""
    return "* REPLACE (" + ", ".join(r6(c, c) for c in columns) + ")"


def hash_sql(key: str, seed: int | str = 42) -> str:
    return (f"(CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '#{seed}'), 1, 13) AS BIGINT) AS DOUBLE)"
            f" / 4503599627370496)")
