"""Revenue health mart.

As in the retention mart, rows carry counts instead of being repeated: copies of a
subscription version are counted before the join, and the months an annual payment is
expanded to are joined as one array of counts per payment key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.functions.keys import NULL_PART, packed_key, unpacked_key
from custarc.functions.measures import mrr_movements, net_price, revenue_event_type
from custarc.functions.temporal import months_crossed
from custarc.functions.text import default_label, infer_cycle, infer_plan
from custarc.operators.expansion import at_least_once, distinct_by_month, each_month, month_counts
from custarc.operators.joins import left_join_few, left_join_when, lookup_left_packed
from custarc.operators.ladder import day_number, previous_value
from custarc.operators.spine import full_date
from custarc.plans.retention import annual, reported_mrr, succeeded
from custarc.settings import Settings

KEYS = [
    "transaction_month",
    "plan_name",
    "billing_cycle",
    "transaction_type",
    "payment_method",
    "failure_code",
]
# Tie order of the look back, after time and price.
TIES = ("transaction_type", "plan_name", "billing_cycle", "payment_method", "failure_code")


def subscription_events(df: DataFrame) -> DataFrame:
    return df.where(F.col("transaction_type").startswith("subscription"))


def _version_counts(subscriptions: DataFrame) -> DataFrame:
    """Equal versions counted; ``_version`` is the packed subscription_sk."""
    cols = ["subscription_id", "plan_name", "billing_cycle", "canceled_at"]
    version = packed_key(F.col("subscription_sk")).alias("_version")
    return subscriptions.select(version, *cols).groupBy("_version", *cols).agg(F.count("*").alias("_versions"))


def _payment_key() -> Column:
    """What transaction_sk is the hash of; a third of its length in a shuffle."""
    return F.coalesce("transaction_id", F.lit(NULL_PART)).alias("_payment")


def _months(s: Settings) -> Column:
    return months_crossed(F.col("_day"), F.lit(s.horizon))


def _is_expanded(s: Settings) -> Column:
    """Payments of a canceled subscription are dated at the cancellation and never expanded."""
    return F.col("canceled_at").isNull() & (_months(s) > 0)


def _annual_months(txn: DataFrame, s: Settings) -> DataFrame:
    """Per payment key, how many of its rows are expanded to each month offset; ``txn`` are payments with their
    versions."""
    counts = month_counts(_months(s), F.col("_versions"), s.max_months)
    return annual(txn).where(_is_expanded(s)).groupBy(_payment_key()).agg(F.array(*counts).alias("_reached"))


def _own_copies(s: Settings) -> Column:
    """How many rows a payment with its version adds to those of its key that are expanded."""
    is_annual = F.col("billing_cycle") == "Annual"
    return F.when(is_annual & _is_expanded(s), F.col("_versions")).otherwise(F.lit(0)).cast("long")


def _shared_months(txn: DataFrame, s: Settings) -> DataFrame:
    """The same for the keys that several rows have; of the others, the only row says it."""
    counts = month_counts(_months(s), _own_copies(s), s.max_months)
    of_key = txn.groupBy(_payment_key()).agg(F.array(*counts).alias("_reached"), F.count("*").alias("_rows"))
    return of_key.where("_rows > 1").drop("_rows")


Cut = Callable[[DataFrame, str], DataFrame]


def _uncut(df: DataFrame, name: str) -> DataFrame:
    return df


def transaction_spans(
    transactions: DataFrame, subscriptions: DataFrame, s: Settings = Settings(), cut: Cut = _uncut
) -> DataFrame:
    """The rows of ``transaction_months`` before they are repeated: element m of ``months``, times
    ``weight``, is the number of rows whose transaction_date is m months later. A payment's later months
    are a row of their own, as their transaction type differs.

    ``cut(df, name)`` may store the payments with their versions, which are read several times, and then with
    their months. Stored, only rows that may share their payment key with another are shuffled by it.
    """
    versions = _version_counts(subscriptions)
    # The user's key is packed until the rows leave here.
    columns = [
        "transaction_id",
        "subscription_sk",
        packed_key(F.col("user_sk")).alias("user_sk"),
        "transaction_type",
        "payment_method",
        default_label(F.col("failure_code")).alias("failure_code"),
        "status",
        net_price(F.col("price"), F.col("discount")).alias("price"),
        "refunded",
        "refund_amount",
        full_date(F.col("transaction_date_id"), s).alias("_day"),
        infer_plan(F.col("description")).alias("_plan"),
        infer_cycle(F.col("description")).alias("_cycle"),
    ]
    # Payments without a version, which may be most, are not shuffled for it.
    has_version = F.col("subscription_sk").isNotNull()
    txn = (
        lookup_left_packed(
            transactions.where(has_version).select(*columns), versions, "subscription_sk", "_version", ["transaction_id"]
        )
        .drop("subscription_sk")
        .unionByName(
            transactions.where(~has_version).select(*columns).drop("subscription_sk"), allowMissingColumns=True
        )
    )
    txn = cut(txn, "paid_versions")
    rows = txn.select(
        "transaction_id",
        "subscription_id",
        "user_sk",
        "transaction_type",
        "payment_method",
        "failure_code",
        "status",
        "price",
        "refunded",
        "refund_amount",
        "_day",
        "canceled_at",
        F.coalesce("plan_name", "_plan").alias("plan_name"),
        F.coalesce("billing_cycle", "_cycle").alias("billing_cycle"),
        F.coalesce("_versions", F.lit(1)).cast("long").alias("weight"),
        _months(s).alias("_crossed"),
        _own_copies(s).alias("_own"),
        _payment_key(),
    )
    still_open = F.col("canceled_at").isNull()
    if cut is _uncut:
        joined = left_join_when(rows, _annual_months(txn, s), ["_payment"], still_open)
    else:
        joined = left_join_few(rows, _shared_months(txn, s), "_payment", still_open)
        own = [F.when(F.col("_crossed") > m, F.col("_own")).otherwise(F.lit(0)) for m in range(s.max_months)]
        joined = joined.withColumn("_reached", F.coalesce("_reached", F.array(*own)))
    reached = at_least_once(F.col("_reached"))
    paid_months = cut(joined.withColumn("_reached", reached).drop("_payment", "_crossed", "_own"), "paid_months")
    reached = F.col("_reached")

    def part(month: int, months: Column) -> Column:
        kind = revenue_event_type(F.col("transaction_type"), F.col("canceled_at"), F.lit(month))
        return F.struct(kind.alias("kind"), months.alias("months"))

    first = part(0, F.slice(reached, 1, 1))
    later = part(1, F.concat(F.array(F.lit(0).cast("long")), F.slice(reached, F.lit(2), F.size(reached))))
    parts = F.when(F.get(reached, F.lit(1)) > 0, F.array(first, later)).otherwise(F.array(first))
    start = F.coalesce(F.col("canceled_at"), F.col("_day").cast("timestamp_ntz"))
    return paid_months.select("*", F.inline(parts).alias("_kind", "months")).select(
        "transaction_id",
        "subscription_id",
        start.alias("transaction_date"),
        unpacked_key(F.col("user_sk")).alias("user_sk"),
        F.col("_kind").alias("transaction_type"),
        "payment_method",
        "status",
        "price",
        "refunded",
        "refund_amount",
        "plan_name",
        "billing_cycle",
        "failure_code",
        "months",
        "weight",
    )


def transaction_months(
    transactions: DataFrame, subscriptions: DataFrame, s: Settings = Settings(), cut: Cut = _uncut
) -> DataFrame:
    """Weighted detail rows from fact_transaction and dim_subscription: every payment, repeated
    for the months it covers when it is an open annual one. ``weight`` counts equal rows."""
    return months_of(transaction_spans(transactions, subscriptions, s, cut))


def months_of(spans: DataFrame) -> DataFrame:
    """transaction_months from transaction_spans."""
    return each_month(spans, "months", "transaction_date", "weight")


def _year_or_day(at: Column, known: Column) -> Column:
    return F.when(known, F.year(at)).otherwise(day_number(at))


def with_old_price(rows: DataFrame, months: str | None = None) -> DataFrame:
    """Succeeded subscription payments with old_price, the subscription's price before this
    row; payments without a subscription look back over each other. The rows are those of
    transaction_months, or with months="months" of transaction_spans."""
    return previous_value(
        subscription_events(succeeded(rows)),
        entity="subscription_id",
        at="transaction_date",
        value="price",
        ties=TIES,
        weight="weight",
        out="old_price",
        period=_year_or_day if months else day_number("transaction_date"),
        months=months,
    )


def revenue_movements(rows: DataFrame, months: str | None = None) -> DataFrame:
    """MRR movements per mart key."""
    price = F.col("price")
    moves = mrr_movements(
        F.col("transaction_type"), price, F.col("old_price"), F.col("copies"), price
    )
    return (
        with_old_price(rows, months)
        .withColumn("transaction_month", F.month("transaction_date").cast("long"))
        .groupBy(*KEYS)
        .agg(*moves)
    )


def mart_revenue(
    transactions: DataFrame,
    subscriptions: DataFrame,
    s: Settings = Settings(),
    cut: Cut = _uncut,
) -> DataFrame:
    """transaction_month x plan_name x billing_cycle x transaction_type x payment_method x
    failure_code. The payments are read several times, so pass a ``cut`` that stores them once."""
    return mart_of(transaction_spans(transactions, subscriptions, s, cut), s)


def mart_of(spans: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The mart from the result of transaction_spans."""
    weight, txn = F.col("weight"), F.col("transaction_id")
    months = months_of(spans)
    of_users = spans.withColumn("user_sk", packed_key(F.col("user_sk")))

    def rows_where(condition: Column) -> Column:
        counted = F.when(condition & txn.isNotNull(), weight).otherwise(F.lit(0))
        return F.sum(counted)

    refunded = F.col("refunded") == 1
    sums = (
        months.withColumn("transaction_month", F.month("transaction_date").cast("long"))
        .groupBy(*KEYS)
        .agg(
            F.sum("weight").alias("_rows"),
            F.sum(F.when(refunded, F.col("refund_amount") * weight).otherwise(F.lit(0.0))).alias(
                "total_refund_amount"
            ),
            rows_where(refunded).alias("refund_count"),
            rows_where(F.col("status") == "Succeeded").alias("success_count"),
            rows_where(F.col("status") == "Failed").alias("failed_count"),
        )
    )
    # Each count and sum has its own cheapest grouping; they meet as rows of one small table.
    month, others = KEYS[0], KEYS[1:]
    parts = sums
    for part in (
        distinct_by_month(spans, "transaction_id", "transaction_date", others, month, "transaction_count", "months"),
        distinct_by_month(of_users, "user_sk", "transaction_date", others, month, "paying_users", "months"),
        revenue_movements(spans, "months"),
    ):
        parts = parts.unionByName(part, allowMissingColumns=True)
    figures = [c for c in parts.columns if c not in KEYS]
    joined = parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in figures])
    return joined.select(
        *KEYS,
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("transaction_count", "paying_users")],
        *reported_mrr(KEYS, s),
        "total_refund_amount",
        "refund_count",
        "success_count",
        "failed_count",
    )
