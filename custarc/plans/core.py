"""Star schema: three dimensions and three facts.

Facts hold one row per source row and matching user; a duplicated e-mail repeats them, as no
step removes duplicate users.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.functions.keys import packed_key, surrogate_key, unpacked_key
from custarc.functions.measures import line_total
from custarc.operators.asof import as_of
from custarc.operators.identity import each_copy, weighted_usage
from custarc.operators.joins import lookup_left, with_user_sk
from custarc.operators.people import People
from custarc.operators.spine import calendar, date_id, date_spine, with_date_ids
from custarc.settings import Settings


def _loaded_at(s: Settings) -> Column:
    ts = F.current_timestamp() if s.run_ts is None else F.lit(s.run_ts).cast("timestamp")
    return ts.alias("loaded_at")


def dim_date(spark: SparkSession, s: Settings = Settings()) -> DataFrame:
    return calendar(date_spine(spark, s.spine_start, s.spine_end), s.weekend_days)


def dim_user(users: DataFrame, s: Settings = Settings()) -> DataFrame:
    return users.select(
        surrogate_key(F.col("user_id")).alias("user_sk"),
        "user_id",
        "email",
        "first_name",
        "last_name",
        "gender",
        "country",
        "lead_source",
        date_id(F.col("signup_date"), s).alias("signup_date_id"),
        _loaded_at(s),
    )


def dim_person(people: People, s: Settings = Settings()) -> DataFrame:
    """dim_user of people. A person without an id is keyed by the e-mail."""
    users = dim_user(people.users, s)
    return users.withColumn("user_sk", F.when(F.col("user_id").isNull(), surrogate_key(F.col("email"))).otherwise(F.col("user_sk")))


def person_keys(people: People) -> tuple[DataFrame, DataFrame]:
    """((user_id, email, user_sk), (email, user_id, user_sk)): every id and every e-mail that occurs, once,
    with the key of its person."""
    key = people.users.select(
        "person", surrogate_key(F.coalesce("user_id", "email")).alias("user_sk")
    )
    ids = people.ids.join(key, "person").select("user_id", "email", "user_sk")
    return ids, people.emails.join(key, "person").select("email", "user_id", "user_sk")


def dim_subscription(subscriptions: DataFrame, users: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Subscription versions; ``subscriptions`` is int_subscription, ``users`` dim_user."""
    joined = with_user_sk(subscriptions, "customer_email", users, ["subscription_id", "valid_from"])
    ids = ("current_period_start", "current_period_end", "canceled_at")
    return with_date_ids(joined, {c: f"{c}_id" for c in ids}, s).select(
        surrogate_key(F.col("subscription_id"), F.col("valid_from")).alias("subscription_sk"),
        "subscription_id",
        "user_sk",
        "plan_name",
        "billing_cycle",
        "status",
        "current_period_start",
        "current_period_start_id",
        "current_period_end",
        "current_period_end_id",
        "canceled_at",
        "canceled_at_id",
        "churn_reason",
        "valid_from",
        "valid_to",
        "is_current",
        _loaded_at(s),
    )


def with_subscription_sk(transactions: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Subscription version of the same user whose period starts on the payment day; a
    payment is repeated for every such version."""
    versions = subscriptions.select(
        "subscription_sk",
        F.col("user_sk").alias("_user"),
        F.to_date("current_period_start").alias("_start"),
    )
    return lookup_left(
        transactions, versions, "user_sk", "_user", ["transaction_id"], also=[("transaction_date", "_start")]
    )


def with_version_as_of(
    df: DataFrame, subscriptions: DataFrame, day: str, row_id: Sequence[str], columns: Sequence[str] = ("subscription_sk",)
) -> DataFrame:
    """``columns`` of the version of the row's user_sk that was valid on ``day``: the user's latest that
    started by then, nothing if that one has ended by then. A row meets at most one version."""
    # Surrogate keys are carried as bytes.
    keys = [c for c in columns if c.endswith("_sk")]
    versions = subscriptions.select(
        "user_sk",
        F.to_date("valid_from").alias("_start"),
        # Of versions that start on one day the latest, and the one that holds longest, is taken.
        F.col("valid_from").alias("_from"),
        F.coalesce(F.to_date("valid_to"), F.lit("9999-12-31").cast("date")).alias("_until"),
        *[packed_key(F.col(c)).alias(c) if c in keys else c for c in columns],
    )
    joined = as_of(
        df, versions, ("user_sk", "user_sk"), (day, "_start"), ["_until", *columns], row_id, period=F.year, ties=["_from"]
    )
    valid = F.col("_until") > F.col(day)
    found = {c: F.when(valid, unpacked_key(F.col(c)) if c in keys else F.col(c)) for c in columns}
    return joined.withColumns(found).drop("_until")


def fact_transaction(
    transactions: DataFrame, subscriptions: DataFrame, users: DataFrame, s: Settings = Settings()
) -> DataFrame:
    """Payments; inputs are stg_transaction, dim_subscription and dim_user."""
    with_user = with_user_sk(transactions, "cust_email", users, ["transaction_id"])
    if s.subscription_match == "as_of":
        joined = with_version_as_of(with_user, subscriptions, "transaction_date", ["transaction_id"])
    else:
        joined = with_subscription_sk(with_user, subscriptions)
    c = F.col
    return joined.select(
        surrogate_key(c("transaction_id")).alias("transaction_sk"),
        "transaction_id",
        "subscription_sk",
        "user_sk",
        "transaction_type",
        "quantity",
        "price",
        "discount",
        line_total(c("price"), c("quantity"), c("discount")).alias("total_amount"),
        "currency",
        "status",
        "payment_method",
        "failure_code",
        date_id(c("transaction_date"), s).alias("transaction_date_id"),
        "refunded",
        "refund_amount",
        "description",
        _loaded_at(s),
    )


def fact_support(tickets: DataFrame, users: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Support tickets; inputs are stg_support_ticket and dim_user."""
    joined = with_user_sk(tickets, "requester_email", users, ["ticket_id"])
    moments = ("created_at", "first_response_at", "solved_at", "updated_at")
    with_ids = with_date_ids(joined, {m: f"{m}_id" for m in moments}, s)
    return with_ids.select(
        surrogate_key(F.col("ticket_id")).alias("ticket_sk"),
        "ticket_id",
        "user_sk",
        "ticket_type",
        "subject",
        "description",
        "priority",
        "status",
        "channel",
        *[c for m in moments for c in (m, f"{m}_id")],
        "first_reply_time",
        "full_resolution_time",
        "satisfaction_rating",
        _loaded_at(s),
    )


def _usage_fact(joined: DataFrame, s: Settings, *more: str) -> DataFrame:
    return joined.select(
        surrogate_key(F.col("event_id")).alias("event_sk"),
        "event_id",
        "user_sk",
        "feature_name",
        "event_timestamp",
        date_id(F.col("event_timestamp"), s).alias("event_timestamp_id"),
        "session_id",
        "session_duration",
        "device",
        "browser",
        "os",
        "country",
        *more,
        _loaded_at(s),
    )


def fact_product_usage_weighted(
    usage: DataFrame, users: DataFrame, s: Settings = Settings(), emails: DataFrame | None = None
) -> DataFrame:
    """Usage events straight from stg_product_usage and dim_user, repairing identities on the
    way with two shuffles of the events. Equal rows of one event and one row of dim_user are one row
    with their number in ``copies``."""
    return _usage_fact(weighted_usage(usage, users, emails), s, "copies")


def fact_product_usage(usage: DataFrame, users: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The same with every copy a row."""
    return each_copy(fact_product_usage_weighted(usage, users, s))


def fact_product_usage_of_repaired(
    usage: DataFrame, users: DataFrame, s: Settings = Settings()
) -> DataFrame:
    """The same rows from int_product_usage, for callers that keep the repaired table."""
    return _usage_fact(with_user_sk(usage, "user_email", users, ["event_id"]), s)
