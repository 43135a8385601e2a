"""The subscription tables seen through the star-schema test tables.

Each adapter is one SQL text that runs unchanged in Spark and in DuckDB, so query and oracle start from the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_YMD = "CAST(year({0})*10000 + month({0})*100 + day({0}) AS INT)"

ADAPTERS = {
    # 10 % of users missing, a third without gender, impossible ages and dates.
    "members": """SELECT c_custkey AS msno, c_nationkey AS city, CAST(floor(c_acctbal/80) AS INT) AS bd,
        CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender,
        CAST(c_custkey % 5 AS INT) AS registered_via,
        CAST(20100100 + (c_custkey % 12)*100 + (c_custkey % 33) AS INT) AS registration_init_time
        FROM {customer} WHERE c_custkey % 10 <> 7""",
    "transactions": f"""SELECT o_custkey AS msno, CAST(substr(o_orderpriority,1,1) AS INT) AS payment_method_id,
        o_totalprice AS plan_list_price,
        CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice/2 ELSE o_totalprice END AS actual_amount_paid,
        CASE WHEN o_orderstatus='O' THEN 1 ELSE 0 END AS is_auto_renew,
        CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS is_cancel,
        {_YMD.format('o_orderdate')} AS transaction_date,
        {_YMD.format('(o_orderdate + INTERVAL 30 DAY)')} AS membership_expire_date
        FROM {{orders}} WHERE o_custkey % 11 <> 3""",
    "user_logs": f"""SELECT user_id AS msno, {_YMD.format('ts')} AS date, value AS total_secs,
        CAST(1 + event_id % 3 AS INT) AS num_unq,
        CASE WHEN event_type='view' THEN 1 ELSE 0 END AS num_25,
        CASE WHEN event_type='click' THEN 1 ELSE 0 END AS num_50,
        CASE WHEN event_type='signup' THEN 1 ELSE 0 END AS num_75,
        CASE WHEN event_type='error' THEN 1 ELSE 0 END AS num_985,
        CASE WHEN event_type='purchase' THEN 1 ELSE 0 END AS num_100
        FROM {{events}}""",
    "train": "SELECT c_custkey AS msno, CASE WHEN c_custkey % 16 = 5 THEN 1 ELSE 0 END AS is_churn FROM {customer}",
    # Heavy ties, clamped at 1.0, a weak signal, some scores missing; cycle is the day.
    "scored": f"""SELECT event_id AS id,
        CASE WHEN event_type='purchase' AND value >= 60 THEN 1 WHEN event_id % 40 = 0 THEN 1 ELSE 0 END AS y_true,
        CASE WHEN event_id % 113 = 7 THEN NULL WHEN value >= 200 THEN 1.0 ELSE floor(value*5)/1000 END AS y_proba,
        {_YMD.format('ts')} AS cycle, event_type AS segment
        FROM {{events}}""",
    # Three models' scores for the same ids.
    "model_a": """SELECT event_id AS id, CASE WHEN event_type='purchase' AND value >= 60 THEN 1
        WHEN event_id % 40 = 0 THEN 1 ELSE 0 END AS y_true,
        CASE WHEN value >= 200 THEN 1.0 ELSE floor(value*5)/1000 END AS y_proba FROM {events}""",
    "model_b": """SELECT event_id AS id, CASE WHEN event_type='purchase' THEN 0.75
        ELSE CAST((event_id * 7919) % 400 AS DOUBLE)/1000 END AS prob FROM {events}""",
    "model_c": "SELECT event_id AS id, CAST((event_id * 104729) % 500 AS DOUBLE)/500 AS p FROM {events}",
    "runs": """SELECT concat(o_orderpriority, '-', CAST(o_orderkey AS STRING)) AS run_id,
        o_orderpriority AS model_name, o_orderkey AS run_number,
        CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' END AS status,
        CASE WHEN o_orderkey % 7 <> 0 THEN floor(o_totalprice/5000)/100 END AS pr_auc,
        CAST(o_orderkey % 97 AS DOUBLE)/100 AS roc_auc, CAST(o_custkey AS STRING) AS depth
        FROM {orders}""",
}


class Tables:
    """The driver's tables and the adapters over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def adapt(self, name: str) -> DataFrame:
        text = ADAPTERS[name]
        used = {t: self.raw(t) for t in ("customer", "orders", "events") if "{" + t + "}" in text}
        rows = self.spark.sql(text, **used)
        if name == "scored":  # every other missing score is NaN here: NULL and NaN are one missing value
            nan = F.col("y_proba").isNull() & (F.col("id") % 2 == 0)
            rows = rows.withColumn("y_proba", F.when(nan, float("nan")).otherwise(F.col("y_proba").cast("double")))
        return rows

    def __getattr__(self, name: str) -> DataFrame:
        if name in ADAPTERS:
            return self.adapt(name)
        raise AttributeError(name)

    @cached_property
    def model_table(self) -> DataFrame:
        from churnspark.plans.feature_build import model_table

        return model_table(self.train, self.members, self.transactions, self.user_logs).drop("registration_init_date")


def adapter_cte(*names: str) -> str:
    """Adapter definitions as DuckDB CTEs."""
    return ", ".join(
        f"{n} AS ({ADAPTERS[n].format(customer='customer', orders='orders', events='events')})" for n in names
    )
