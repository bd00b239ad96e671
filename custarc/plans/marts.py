"""Acquisition, engagement and support marts.

Exact distinct counts are left to Spark: it first groups by (keys, distinct column) and then
by the keys, so no task sees a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.functions.measures import activation_bucket, is_activated
from custarc.functions.temporal import days_between
from custarc.operators.joins import lookup_left
from custarc.operators.spine import full_date
from custarc.settings import Settings

FEATURE_PREFIX = "Feature"


def known_users(df: DataFrame) -> DataFrame:
    return df.where(F.col("user_sk").isNotNull())


def first_event(usage: DataFrame) -> DataFrame:
    """Per known user, the first feature event; NULL for a user with other events only."""
    is_feature = F.col("feature_name").startswith(FEATURE_PREFIX)
    return (
        known_users(usage)
        .groupBy("user_sk")
        .agg(F.min(F.when(is_feature, F.col("event_timestamp"))).alias("first_event_ts"))
    )


def users_with_activation(users: DataFrame, usage: DataFrame, s: Settings = Settings()) -> DataFrame:
    """dim_user with signup_date, days_to_first_action, activated_bucket and is_activated."""
    # Users without a feature event get NULL from the join anyway: filter before grouping.
    first = first_event(usage.where(F.col("feature_name").startswith(FEATURE_PREFIX)))
    joined = lookup_left(
        users.select("user_id", "user_sk", "lead_source", "gender", "signup_date_id"),
        first.withColumnRenamed("user_sk", "_user"),
        "user_sk",
        "_user",
        ["user_id"],
    )
    signup = full_date(F.col("signup_date_id"), s)
    days = F.col("days_to_first_action")
    return (
        joined.withColumn("signup_date", signup)
        .withColumn(
            "days_to_first_action", days_between(F.col("signup_date"), F.to_date("first_event_ts"))
        )
        .withColumns({"activated_bucket": activation_bucket(days), "is_activated": is_activated(days)})
    )


def mart_acquisition(users: DataFrame, usage: DataFrame, s: Settings = Settings()) -> DataFrame:
    """signup_date x lead_source x gender x activated_bucket, from dim_user and
    fact_product_usage. The bucket decides is_activated, so one distinct count serves both."""
    days = F.col("days_to_first_action")
    n_users = F.count_distinct("user_id")
    return (
        users_with_activation(users, usage, s)
        .groupBy("signup_date", "lead_source", "gender", "activated_bucket")
        .agg(
            n_users.alias("sum_new_signups"),
            (n_users * F.max("is_activated")).alias("sum_activated_users"),
            F.coalesce(F.sum(days), F.lit(0)).alias("sum_days_to_first_action"),
            F.count(F.when(days.isNotNull(), F.col("user_id"))).alias("count_users_with_first_action"),
        )
    )


def mart_engagement(usage: DataFrame, s: Settings = Settings()) -> DataFrame:
    """user_sk x event_date x feature_name, from fact_product_usage or its weighted form, whose rows
    count as often as their ``copies`` say."""
    copies = F.col("copies") if "copies" in usage.columns else F.lit(1).cast("long")
    return (
        known_users(usage)
        .groupBy(
            "user_sk", full_date(F.col("event_timestamp_id"), s).alias("event_date"), "feature_name"
        )
        .agg(
            F.sum(F.when(F.col("event_id").isNotNull(), copies).otherwise(0)).alias("total_events"),
            F.count_distinct("session_id").alias("distinct_sessions"),
            F.sum(F.coalesce("session_duration", F.lit(0)) * copies).alias("sum_session_duration"),
        )
    )


def mart_support(tickets: DataFrame, s: Settings = Settings()) -> DataFrame:
    """created_date x ticket_type x priority x channel x raw satisfaction_rating, from
    fact_support. A missing rating and a rating of 0 are separate rows, both shown as 0."""
    ticket = F.col("ticket_id")

    def tickets_where(condition: Column) -> Column:
        return F.count(F.when(condition, ticket))

    def total(col: str) -> Column:
        return F.coalesce(F.sum(col), F.lit(0))

    status = F.col("status")
    return (
        tickets.withColumn("created_date", full_date(F.col("created_at_id"), s))
        .groupBy("created_date", "ticket_type", "priority", "channel", "satisfaction_rating")
        .agg(
            F.count(ticket).alias("ticket_count"),
            F.count_distinct("user_sk").alias("users_with_ticket"),
            tickets_where(status.isin("Solved", "Closed")).alias("solved_count"),
            tickets_where(status == "Open").alias("open_count"),
            tickets_where(status == "Pending").alias("pending_count"),
            total("first_reply_time").alias("sum_first_reply_time"),
            tickets_where(F.col("first_reply_time").isNotNull()).alias("count_tickets_with_reply"),
            total("full_resolution_time").alias("sum_resolution_time"),
            tickets_where(F.col("full_resolution_time").isNotNull()).alias("count_tickets_resolved"),
            total("satisfaction_rating").alias("sum_satisfaction_rating"),
            tickets_where(F.col("satisfaction_rating").isNotNull()).alias("count_tickets_rated"),
        )
        .withColumn("satisfaction_rating", F.coalesce("satisfaction_rating", F.lit(0)))
    )
