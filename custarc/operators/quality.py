"""Checks on finished tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

# Key columns each table is meant to be unique on.
GRAIN = {
    "dim_date": ["date_id"],
    "dim_user": ["user_sk"],
    "dim_subscription": ["subscription_sk"],
    "fact_transaction": ["transaction_sk"],
    "fact_support": ["ticket_sk"],
    "fact_product_usage": ["event_sk"],
    "mart_acquisition": ["signup_date", "lead_source", "gender", "activated_bucket"],
    "mart_engagement": ["user_sk", "event_date", "feature_name"],
    "mart_support": ["created_date", "ticket_type", "priority", "channel"],
    "mart_retention": [
        "current_month", "months_since_start", "plan_name", "billing_cycle", "churn_reason",
    ],
    "mart_revenue": [
        "transaction_month", "plan_name", "billing_cycle", "transaction_type",
        "payment_method", "failure_code",
    ],
}

# Keys that a setting replaces.
OTHER_KEY = {"current_month": "cohort_month"}


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows (n)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def repeated_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, key, n): every key that occurs more than once in its table, as JSON."""
    found = []
    for name, df in tables.items():
        keys = [k if k in df.columns else OTHER_KEY[k] for k in GRAIN[name]]
        key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
        found.append(grain_check(df, keys).select(F.lit(name).alias("table"), key.alias("key"), "n"))
    return reduce(DataFrame.unionByName, found)


def order_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row (files_out_of_order, rows_out_of_order, rows) for a stored table: files whose keys begin
    before those of the file before end, and rows smaller than the row before in their file, NULLs first."""
    placed = df.select(F.struct(*keys).alias("key"), "_metadata.file_path", "_metadata.row_index")
    in_file = Window.partitionBy("file_path").orderBy("row_index")
    rows = placed.withColumn("back", (F.col("key") < F.lag("key").over(in_file)).cast("int"))
    files = rows.groupBy("file_path").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.sum("back").alias("back"), F.count("*").alias("rows")
    )
    # One row per file from here on.
    by_low = Window.orderBy("low", "high")
    return files.withColumn("overlaps", (F.col("low") < F.lag("high").over(by_low)).cast("int")).agg(
        F.coalesce(F.sum("overlaps"), F.lit(0)).alias("files_out_of_order"),
        F.coalesce(F.sum("back"), F.lit(0)).alias("rows_out_of_order"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df``, and the number of its rows, known as ``rows`` once an action has read all of it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def load_report(
    tables: Mapping[str, DataFrame], schema: str = "raw", known: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per table (schema, table, rows), ordered by schema and table. Tables whose number of
    rows is ``known`` are not read."""
    counts = [
        (df.sparkSession.range(1).select(F.lit((known or {})[name]).cast("long").alias("rows")) if name in (known or {})
         else df.agg(F.count("*").alias("rows"))).select(F.lit(schema).alias("schema"), F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("schema", "table")
