"""Money, activation and event-type rules used by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW = "subscription_payment_new"
UPGRADE = "subscription_payment_upgrade"
DOWNGRADE = "subscription_payment_downgrade"
RENEWAL = "subscription_payment_renewal"
CANCELLATION = "subscription_cancellation"


def net_price(price: Column, discount: Column) -> Column:
    """Price after discount, for one unit."""
    return price * (1 - discount)


def line_total(price: Column, quantity: Column, discount: Column) -> Column:
    """Price after discount for all units, to the cent. Cents are rounded as a binary number,
    so that 16423.5 goes up whatever decimals the product prints with."""
    return F.round(price * quantity * (1 - discount) * 100) / 100


def activation_bucket(days: Column) -> Column:
    """Bucket of the days from signup to the first feature event; a negative number of days
    counts as 'Day 1-3'."""
    return (
        F.when(days.isNull(), "Never Activated")
        .when(days == 0, "Day 0")
        .when(days <= 3, "Day 1-3")
        .when(days <= 7, "Day 4-7")
        .otherwise("After Day 7")
    )


def is_activated(days: Column) -> Column:
    return F.when(days <= 7, F.lit(1)).otherwise(F.lit(0))


def revenue_event_type(kind: Column, canceled_at: Column, months: Column) -> Column:
    """Cancellations first, then the later months of an annual payment count as renewals."""
    return (
        F.when(canceled_at.isNotNull(), CANCELLATION).when(months > 0, RENEWAL).otherwise(kind)
    )


def retention_event_type(kind: Column, status: Column) -> Column:
    return F.when(status == "Canceled", CANCELLATION).otherwise(kind)


def mrr_movements(
    kind: Column, price: Column, old_price: Column, copies: Column, cancellation: Column
) -> list[Column]:
    """The five MRR movement sums over rows that each stand for ``copies`` equal rows."""

    def total(when_kind: str, amount: Column) -> Column:
        return F.sum(F.when(kind == when_kind, amount * copies).otherwise(F.lit(0.0)))

    return [
        total(NEW, price).alias("new_mrr"),
        total(UPGRADE, price - old_price).alias("expansion_mrr"),
        total(DOWNGRADE, old_price - price).alias("contraction_mrr"),
        total(CANCELLATION, cancellation).alias("cancellation_mrr"),
        total(RENEWAL, price).alias("renewal_mrr"),
    ]


MRR_COLUMNS = ("new_mrr", "expansion_mrr", "contraction_mrr", "cancellation_mrr", "renewal_mrr")
