"""Cleaned versions of the five raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custarc.functions.properties import rounded_int, with_json_fields
from custarc.functions.temporal import to_date_lenient, to_float_lenient, to_ts_lenient
from custarc.functions.text import (
    clean_currency,
    clean_email,
    digits_only,
    flag,
    handle_issue,
    null_if_in,
    repair_transaction_type,
)
from custarc.settings import Settings


def stg_user(users: DataFrame) -> DataFrame:
    c = F.col
    return users.select(
        "user_id",
        handle_issue(c("first_name")).alias("first_name"),
        handle_issue(c("last_name")).alias("last_name"),
        handle_issue(c("gender"), "Others").alias("gender"),
        clean_email(c("email")).alias("email"),
        "country",
        to_date_lenient(c("signup_date")).alias("signup_date"),
        handle_issue(c("lead_source"), "Others").alias("lead_source"),
        digits_only(c("phone")).alias("phone"),
        to_ts_lenient(c("created_date")).alias("created_at"),
    )


def stg_subscription(subscriptions: DataFrame) -> DataFrame:
    c = F.col
    return subscriptions.select(
        "subscription_id",
        "transaction_id",
        "customer_id",
        clean_email(c("customer_email")).alias("customer_email"),
        handle_issue(c("plan_name")).alias("plan_name"),
        handle_issue(c("billing_cycle")).alias("billing_cycle"),
        handle_issue(c("status")).alias("status"),
        to_ts_lenient(c("current_period_start")).alias("current_period_start"),
        to_ts_lenient(c("current_period_end")).alias("current_period_end"),
        to_ts_lenient(c("created")).alias("created_at"),
        to_ts_lenient(c("canceled_at")).alias("canceled_at"),
        "churn_reason",
        to_ts_lenient(c("valid_from")).alias("valid_from"),
        to_ts_lenient(c("valid_to")).alias("valid_to"),
        flag(c("is_current")).alias("is_current"),
    )


def stg_transaction(transactions: DataFrame, s: Settings = Settings()) -> DataFrame:
    c = F.col
    return transactions.select(
        "transaction_id",
        "customer_id",
        clean_email(c("cust_email")).alias("cust_email"),
        repair_transaction_type(
            c("transaction_type"), c("description"), c("transaction_id"), s.renewal_first
        ).alias("transaction_type"),
        c("quantity").cast("int").alias("quantity"),
        c("price").cast("double").alias("price"),
        c("discount").cast("double").alias("discount"),
        clean_currency(c("currency")).alias("currency"),
        handle_issue(c("status")).alias("status"),
        "payment_method",
        "failure_code",
        to_date_lenient(c("transaction_date")).alias("transaction_date"),
        "created_at",
        flag(c("refunded")).alias("refunded"),
        F.coalesce(c("refund_amount").cast("double"), F.lit(0.0)).alias("refund_amount"),
        "description",
    )


def stg_support_ticket(support_tickets: DataFrame) -> DataFrame:
    c = F.col
    return support_tickets.select(
        "ticket_id",
        clean_email(c("requester_email")).alias("requester_email"),
        "requester_name",
        "ticket_type",
        "subject",
        "description",
        "priority",
        "status",
        "channel",
        to_ts_lenient(c("created_at")).alias("created_at"),
        to_ts_lenient(c("first_response_at")).alias("first_response_at"),
        to_ts_lenient(c("updated_at")).alias("updated_at"),
        to_ts_lenient(c("solved_at")).alias("solved_at"),
        to_float_lenient(c("first_reply_time")).alias("first_reply_time"),
        to_float_lenient(c("full_resolution_time")).alias("full_resolution_time"),
        c("satisfaction_rating").cast("int").alias("satisfaction_rating"),
    )


def stg_product_usage(product_usage: DataFrame) -> DataFrame:
    c = F.col
    texts = ("device", "os", "browser", "country")
    return with_json_fields(product_usage, "properties", (*texts, "session_duration")).select(
        "event_id",
        null_if_in(c("user_id")).alias("user_id"),
        "feature_name",
        to_ts_lenient(c("event_timestamp")).alias("event_timestamp"),
        clean_email(c("user_email")).alias("user_email"),
        "session_id",
        "properties",
        *texts,
        rounded_int(c("session_duration")).alias("session_duration"),
    )
