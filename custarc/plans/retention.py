"""Retention and churn mart.

The detail rows of this mart are subscription versions x months x payments, and every group's
MRR is reported once per detail row. Neither needs the detail rows: versions and payments are
counted first, each remaining row carries the number of rows it stands for, and a group's MRR
is multiplied by its number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custarc.functions.measures import MRR_COLUMNS, mrr_movements, net_price, retention_event_type
from custarc.functions.temporal import month_start, months_crossed
from custarc.functions.text import default_label
from custarc.operators.expansion import at_least_once, each_month
from custarc.operators.joins import left_join_when
from custarc.operators.ladder import YearOr, hour_number, month_number, months_by_entity, previous_value
from custarc.settings import Settings

# Tie order of the look back, after time and price.
TIES = ("transaction_type", "status", "plan_name", "billing_cycle", "churn_reason")


def succeeded(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("status") == "Succeeded")


def annual(df: DataFrame) -> DataFrame:
    return df.where(F.col("billing_cycle") == "Annual")


def _versions(subscriptions: DataFrame, s: Settings) -> DataFrame:
    """Distinct subscription versions with their copies and their key's month counts."""
    end = F.coalesce(F.to_date("canceled_at"), F.lit(s.horizon))
    crossed = months_crossed(F.col("valid_from"), end)
    is_annual = F.col("billing_cycle") == "Annual"
    months = F.when(is_annual & (crossed > 0), F.least(F.lit(s.max_months), crossed)).otherwise(0)
    counted = (
        subscriptions.select(
            "subscription_sk",
            "subscription_id",
            "plan_name",
            "billing_cycle",
            "status",
            default_label(F.col("churn_reason")).alias("churn_reason"),
            "valid_from",
            months.alias("_months"),
        )
        .groupBy(
            "subscription_sk", "subscription_id", "plan_name", "billing_cycle", "status",
            "churn_reason", "valid_from", "_months",
        )
        .agg(F.count("*").alias("_versions"))
    )
    # A key has few distinct versions left, so a window over it is small.
    of_key = Window.partitionBy("subscription_sk")
    reached = [
        F.sum(F.when(F.col("_months") > m, F.col("_versions")).otherwise(F.lit(0))).over(of_key)
        for m in range(s.max_months)
    ]
    return counted.withColumn("_reached", F.array(*reached)).drop("_months")


def subscription_spans(
    subscriptions: DataFrame, transactions: DataFrame, s: Settings = Settings()
) -> DataFrame:
    """The rows of ``subscription_months`` before they are repeated: element m of ``months``, times
    ``weight``, is the number of rows whose valid_from is m months later."""
    payments = (
        succeeded(transactions)
        .where(F.col("subscription_sk").isNotNull())
        .select(
            "subscription_sk",
            "transaction_type",
            net_price(F.col("price"), F.col("discount")).alias("price"),
        )
        .groupBy("subscription_sk", "transaction_type", "price")
        .agg(F.count("*").alias("_payments"))
    )
    open_version = F.col("status") != "Canceled"
    joined = left_join_when(_versions(subscriptions, s), payments, ["subscription_sk"], open_version)
    none = F.array(F.lit(0).cast("long"))
    return joined.select(
        "subscription_id",
        "plan_name",
        "billing_cycle",
        "status",
        "churn_reason",
        "transaction_type",
        "price",
        "valid_from",
        at_least_once(F.when(open_version, F.col("_reached")).otherwise(none)).alias("months"),
        (F.col("_versions") * F.coalesce("_payments", F.lit(1))).alias("weight"),
    )


def subscription_months(
    subscriptions: DataFrame, transactions: DataFrame, s: Settings = Settings()
) -> DataFrame:
    """Weighted detail rows from dim_subscription and fact_transaction: every version, shifted
    to each month its key is expanded to, with each succeeded payment of its key. A canceled
    version is neither expanded nor joined to payments. ``weight`` counts equal rows."""
    return each_month(subscription_spans(subscriptions, transactions, s), "months", "valid_from", "weight")


_year_or_hour = YearOr(hour_number)


def months_by_subscription(spans: DataFrame) -> DataFrame:
    """``subscription_months`` from spans, distributed by the SPREAD columns."""
    return months_by_entity(spans, "subscription_id", "valid_from", "months", "weight", _year_or_hour)


def with_old_price(
    rows: DataFrame, months: str | None = None, once: str | None = None, once_by: Sequence[str] = ()
) -> DataFrame:
    """Adds old_price, the subscription's price before this row, and months_since_start, the
    rank of the row's month number within the subscription, and cohort_month, the month of its
    first row, to the rows of subscription_months, or with months="months" of subscription_spans.
    ``copies`` counts equal rows. ``once`` names a column that is 1 for one row of a subscription per
    month and ``once_by``, else 0."""
    by_hour = F.when(F.col("subscription_id").isNull(), hour_number("valid_from"))
    return previous_value(
        rows,
        entity="subscription_id",
        at="valid_from",
        value="price",
        ties=TIES,
        weight="weight",
        out="old_price",
        period=_year_or_hour if months else by_hour.otherwise(month_number("valid_from")),
        counted_before=True,
        month_rank="months_since_start",
        first_month="cohort_month",
        months=months,
        once=once,
        once_by=once_by,
    )


def retention_movements() -> list[Column]:
    kind = retention_event_type(F.col("transaction_type"), F.col("status"))
    price, old = F.col("price"), F.col("old_price")
    return mrr_movements(kind, price, old, F.col("copies"), old)


def mart_retention(
    subscriptions: DataFrame, transactions: DataFrame, s: Settings = Settings()
) -> DataFrame:
    """current_month (with cohort='first_month': cohort_month) x months_since_start x plan_name x
    billing_cycle x churn_reason."""
    kinds = ["plan_name", "billing_cycle", "churn_reason"]
    # A row's month, or its months since start, lie in one month of the subscription, so subscriptions are
    # counted by the rows that are the first of theirs with such a month, kind and status.
    spans = subscription_spans(subscriptions, transactions, s)
    state = with_old_price(spans, "months", "_first", [*kinds, "status"])
    month = "current_month"
    if s.cohort == "first_month":
        month = "cohort_month"
        since = months_crossed(F.col("cohort_month"), F.to_date("valid_from")).cast("long")
        state = state.withColumn("months_since_start", since)
    keys = [month, "months_since_start", *kinds]

    def subscriptions_with(status: str) -> Column:
        return F.sum(F.when(F.col("_known") & (F.col("status") == status), F.col("_first")).otherwise(0))

    grouped = (
        state.withColumn("current_month", month_start(F.col("valid_from")))
        .groupBy(*keys)
        .agg(
            subscriptions_with("Active").alias("cohort_size"),
            subscriptions_with("Canceled").alias("churned_users"),
            F.sum("copies").alias("_rows"),
            *retention_movements(),
        )
    )
    return grouped.select(*keys, "cohort_size", "churned_users", *reported_mrr(keys, s))


def reported_mrr(keys: list[str], s: Settings) -> list[Column]:
    """MRR columns of a grouped table that also has the number of detail rows in _rows."""
    if s.mrr_mode == "corrected":
        return [F.coalesce(c, F.lit(0.0)).alias(c) for c in MRR_COLUMNS]
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return [
        F.coalesce(F.when(whole, F.col(c) * F.col("_rows")), F.lit(0.0)).alias(c)
        for c in MRR_COLUMNS
    ]
