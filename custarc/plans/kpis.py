"""Headline figures over the marts, or over the facts where a mart's distinct counts do not add up. Ratios are rounded to six decimals; a ratio without a
denominator is NULL. Use the revenue and retention marts in 'corrected' MRR mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.functions.temporal import month_start
from custarc.operators.expansion import distinct_by_month
from custarc.operators.spine import full_date
from custarc.plans.marts import known_users
from custarc.settings import Settings


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), 6)


def kpi_acquisition(mart: DataFrame, by: Sequence[str] = ("lead_source",)) -> DataFrame:
    """New signups, activation rate and mean days to the first feature event."""
    new, activated = F.sum("sum_new_signups"), F.sum("sum_activated_users")
    days, started = F.sum("sum_days_to_first_action"), F.sum("count_users_with_first_action")
    return mart.groupBy(*by).agg(
        new.alias("new_signups"),
        _ratio(activated, new).alias("activation_rate"),
        _ratio(days, started).alias("days_to_first_action"),
    )


def kpi_top_lead_source(mart: DataFrame, k: int = 1) -> DataFrame:
    """The k lead sources with the most signups."""
    return (
        mart.groupBy("lead_source")
        .agg(F.sum("sum_new_signups").alias("new_signups"))
        .orderBy(F.desc("new_signups"), F.asc_nulls_last("lead_source"))
        .limit(k)
    )


def daily_active_users(mart: DataFrame) -> DataFrame:
    return mart.groupBy("event_date").agg(F.count_distinct("user_sk").alias("dau"))


def kpi_engagement(usage: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per month: mean daily and monthly active users, their ratio, and per-session means, from
    fact_product_usage. A session belongs to one user; it counts once per month, whatever number
    of days and features it spans. Events without a session count for no session."""
    day = full_date(F.col("event_timestamp_id"), s).alias("event_date")
    # One row per user, day and session, then fewer columns step by step: every level
    # aggregates map side, and no count needs its rows expanded.
    finest = (
        known_users(usage)
        .select("user_sk", "session_id", "event_id", day, F.coalesce("session_duration", F.lit(0)).alias("_d"))
        .groupBy(month_start(F.col("event_date")).alias("month"), "event_date", "user_sk", "session_id")
        .agg(F.count("event_id").alias("_events"), F.sum("_d").alias("_duration"))
    )
    per_session = finest.groupBy("month", "user_sk", "session_id").agg(
        F.sum("_events").alias("_events"), F.sum("_duration").alias("_duration")
    )
    per_user = per_session.groupBy("month", "user_sk").agg(
        F.count("session_id").alias("_sessions"), F.sum("_events").alias("_events"), F.sum("_duration").alias("_duration")
    )
    totals = per_user.groupBy("month").agg(
        F.count("*").alias("mau"), *[F.sum(n).alias(n) for n in ("_sessions", "_events", "_duration")]
    )
    per_day = finest.select("month", "event_date", "user_sk").distinct().groupBy("month", "event_date").count()
    days = per_day.groupBy(F.col("month").alias("_m")).agg(
        F.count("event_date").alias("_days"),
        F.sum(F.when(F.col("event_date").isNotNull(), F.col("count")).otherwise(F.lit(0))).alias("_user_days"),
    )
    dau = F.try_divide(F.col("_user_days").cast("double"), F.col("_days").cast("double"))
    return totals.join(days, F.col("month").eqNullSafe(F.col("_m"))).select(
        "month",
        F.round(dau, 6).alias("dau"),
        "mau",
        _ratio(dau, F.col("mau")).alias("stickiness"),
        _ratio(F.col("_duration"), F.col("_sessions")).alias("avg_session_duration"),
        _ratio(F.col("_events"), F.col("_sessions")).alias("avg_events_per_session"),
    )


def kpi_retention(mart: DataFrame) -> DataFrame:
    """Per month: retention, churn and revenue churn, and the lifespan in months they imply."""
    kept, gone = F.sum("cohort_size"), F.sum("churned_users")
    lost = F.sum(F.col("cancellation_mrr") + F.col("contraction_mrr"))
    base = F.sum(F.col("new_mrr") + F.col("renewal_mrr"))
    return mart.groupBy("current_month").agg(
        _ratio(kept, kept + gone).alias("retention_rate"),
        _ratio(gone, kept + gone).alias("user_churn_rate"),
        _ratio(lost, base).alias("revenue_churn"),
        _ratio(kept + gone, gone).alias("customer_lifespan"),
    )


def kpi_revenue(mart: DataFrame, months: DataFrame) -> DataFrame:
    """Per month number: MRR, MRR per user with a succeeded payment, refund and payment failure
    rates, from the mart and the rows of transaction_months it was made of. A user counts once
    per month number, whatever number of plans and payment methods they use."""
    mrr = F.sum(
        F.col("new_mrr")
        + F.col("expansion_mrr")
        + F.col("renewal_mrr")
        - F.col("contraction_mrr")
        - F.col("cancellation_mrr")
    )
    failed = F.sum("failed_count")
    succeeded = months.where("status = 'Succeeded'")
    paying = distinct_by_month(succeeded, "user_sk", "transaction_date", [], "_m", "_paying")
    figures = mart.groupBy("transaction_month").agg(
        mrr.alias("_mrr"),
        _ratio(F.sum("refund_count"), F.sum("transaction_count")).alias("refund_rate"),
        _ratio(failed, failed + F.sum("success_count")).alias("payment_failure_rate"),
    )
    return figures.join(paying, F.col("transaction_month").eqNullSafe(F.col("_m")), "left").select(
        "transaction_month",
        F.round("_mrr", 6).alias("mrr"),
        _ratio(F.col("_mrr"), F.col("_paying")).alias("arpu"),
        "refund_rate",
        "payment_failure_rate",
    )


def kpi_plan_mix(months: DataFrame) -> DataFrame:
    """Payments per plan and each plan's share, from the rows of transaction_months; a payment
    counts once per plan, not once per month it covers."""
    payments = months.where("transaction_id IS NOT NULL").select("plan_name", "transaction_id").distinct()
    per_plan = payments.groupBy("plan_name").agg(F.count("*").alias("transactions"))
    total = per_plan.agg(F.sum("transactions")).scalar()
    return per_plan.select(
        "plan_name", "transactions", _ratio(F.col("transactions"), total).alias("share")
    )


def kpi_support(mart: DataFrame, by: Sequence[str] = ("channel",)) -> DataFrame:
    """Satisfaction, ticket volume, mean reply and resolution times, resolved rate."""
    tickets = F.sum("ticket_count")
    return mart.groupBy(*by).agg(
        _ratio(F.sum("sum_satisfaction_rating"), F.sum("count_tickets_rated")).alias("csat"),
        tickets.alias("total_tickets"),
        _ratio(F.sum("sum_first_reply_time"), F.sum("count_tickets_with_reply")).alias(
            "first_reply_time"
        ),
        _ratio(F.sum("sum_resolution_time"), F.sum("count_tickets_resolved")).alias(
            "full_resolution_time"
        ),
        _ratio(F.sum("solved_count"), tickets).alias("resolved_rate"),
    )
