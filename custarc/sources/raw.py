"""The five raw tables the models start from."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns per source; everything not in TYPED arrives as text and is parsed in staging.
COLUMNS = {
    "users": [
        "user_id", "first_name", "last_name", "gender", "email", "country", "signup_date",
        "lead_source", "phone", "created_date",
    ],
    "subscriptions": [
        "subscription_id", "transaction_id", "customer_id", "customer_email", "plan_name",
        "billing_cycle", "status", "current_period_start", "current_period_end", "created",
        "canceled_at", "churn_reason", "valid_from", "valid_to", "is_current",
    ],
    "transactions": [
        "transaction_id", "customer_id", "cust_email", "transaction_type", "quantity", "price",
        "discount", "currency", "status", "payment_method", "failure_code", "transaction_date",
        "created_at", "refunded", "refund_amount", "description",
    ],
    "support_tickets": [
        "ticket_id", "requester_email", "requester_name", "ticket_type", "subject",
        "description", "priority", "status", "channel", "created_at", "first_response_at",
        "updated_at", "solved_at", "first_reply_time", "full_resolution_time",
        "satisfaction_rating",
    ],
    "product_usage": [
        "event_id", "user_id", "feature_name", "event_timestamp", "user_email", "session_id",
        "properties",
    ],
}
TYPED = {
    "is_current": "boolean",
    "quantity": "int",
    "price": "double",
    "discount": "double",
    "refunded": "boolean",
    "refund_amount": "double",
    "satisfaction_rating": "double",
}


def _typed(column: str) -> Column:
    kind = TYPED.get(column, "string")
    if kind != "int":
        return F.col(column).try_cast(kind).alias(column)
    # Tools that have no missing integers write 4 as '4.0'; a fraction is no integer.
    number = F.col(column).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int")).alias(column)


def conform(df: DataFrame, source: str) -> DataFrame:
    """Select a source's columns by name, with numbers and flags in their declared types."""
    missing = [c for c in COLUMNS[source] if c not in df.columns]
    if missing:
        raise ValueError(f"{source}: missing column(s) {', '.join(missing)}")
    return df.select(*[_typed(c) for c in COLUMNS[source]])


@dataclass(frozen=True)
class Sources:
    users: DataFrame
    subscriptions: DataFrame
    transactions: DataFrame
    support_tickets: DataFrame
    product_usage: DataFrame

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame]) -> Sources:
        """From a name -> table mapping such as ``load_raw`` returns."""
        names = [f.name for f in fields(cls)]
        missing = [n for n in names if n not in tables]
        if missing:
            raise ValueError(f"missing source table(s): {', '.join(missing)}")
        return cls(**{n: conform(tables[n], n) for n in names})
