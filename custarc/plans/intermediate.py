"""Staged tables with missing values filled from a second table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custarc.functions.text import fill_empty, infer_cycle, infer_plan
from custarc.operators.identity import repair_identity
from custarc.operators.joins import lookup_left


def int_product_usage(usage: DataFrame, users: DataFrame, emails: DataFrame | None = None) -> DataFrame:
    return repair_identity(usage, users, emails).select(
        "event_id",
        "user_id",
        "user_email",
        "properties",
        "feature_name",
        "event_timestamp",
        "session_id",
        "session_duration",
        "device",
        "browser",
        "os",
        "country",
    )


def int_subscription(subscriptions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Missing plan and cycle are read from the description of the subscription's payment.

    The description is reduced to the two words before the join, so the long text is not
    shuffled; without a payment the fallback is the one of a missing description.
    """
    description = F.col("description")
    hints = transactions.select(
        F.col("transaction_id").alias("_txn"),
        infer_plan(description).alias("_plan"),
        infer_cycle(description).alias("_cycle"),
    )
    joined = lookup_left(subscriptions, hints, "transaction_id", "_txn", ["subscription_id", "valid_from"])
    nothing = F.lit(None).cast("string")
    plan = F.coalesce("_plan", infer_plan(nothing))
    cycle = F.coalesce("_cycle", infer_cycle(nothing))
    return joined.select(
        "subscription_id",
        "transaction_id",
        "customer_id",
        "customer_email",
        fill_empty(F.col("plan_name"), plan).alias("plan_name"),
        fill_empty(F.col("billing_cycle"), cycle).alias("billing_cycle"),
        "status",
        "current_period_start",
        "current_period_end",
        "created_at",
        "canceled_at",
        "churn_reason",
        "valid_from",
        "valid_to",
        "is_current",
    )
