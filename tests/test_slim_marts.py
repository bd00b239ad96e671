"""What the retention and revenue queries store and shuffle, on small tables."""

import random
import re
from collections import Counter
from datetime import datetime

import pytest

from checks.queries import STORED, VERSION, SETTINGS, models
from custarc.operators.expansion import each_month
from custarc.plans import retention, revenue

SF = "/root/testdata/sf0.001"
VERSION_ROW = (
    "subscription_sk string, subscription_id string, user_sk string, plan_name string, billing_cycle string, "
    "status string, churn_reason string, valid_from timestamp_ntz, canceled_at timestamp_ntz"
)
PAYMENT_ROW = (
    "transaction_id string, subscription_sk string, user_sk string, transaction_type string, price double, "
    "discount double, status string, payment_method string, failure_code string, transaction_date_id int, "
    "refunded int, refund_amount double, description string"
)


@pytest.fixture(scope="module", params=range(2))
def rows(request):
    """Versions and payments with repeated rows, null keys and payments that share an id."""
    rng = random.Random(request.param)
    day = lambda: datetime(2000, rng.randrange(1, 13), rng.randrange(1, 28))
    versions = [
        (f"k{rng.randrange(12)}", rng.choice([None, "s1", "s2"]), "u", rng.choice([None, "Basic"]),
         rng.choice(["Annual", "Monthly", None]), rng.choice(["Active", "Canceled", None]), None, day(),
         rng.choice([None, None, day()]))
        for _ in range(40)
    ]
    payments = [
        (rng.choice([None, *(f"t{i}" for i in range(25))]), rng.choice([None, None, *(f"k{i}" for i in range(15))]),
         "u", rng.choice(["subscription_payment_new", "refund"]), float(rng.randrange(3)), 0.0,
         rng.choice(["Succeeded", "Failed"]), "card", None, rng.choice([None, 20000000 + rng.randrange(1, 13) * 100 + 5]),
         0, 0.0, "Basic")
        for _ in range(80)
    ]
    return versions + versions[:10], payments + payments[:10]


@pytest.fixture
def frames(spark, rows):
    return spark.createDataFrame(rows[0], VERSION_ROW), spark.createDataFrame(rows[1], PAYMENT_ROW)


def later(at, m):
    return at and at.replace(year=at.year + (at.month - 1 + m) // 12, month=(at.month - 1 + m) % 12 + 1)


def crossed(start, end):
    return (end.year - start.year) * 12 + end.month - start.month


def test_payment_months_against_rows_written_out(rows, frames):
    versions, payments = rows
    of_key = {}
    for v in versions:
        of_key.setdefault(v[0], []).append(v)
    days = [p[9] and datetime.strptime(str(p[9]), "%Y%m%d") for p in payments]
    reached = {}
    for p, at in zip(payments, days):
        for v in of_key.get(p[1], []):
            if at and v[4] == "Annual" and v[8] is None:
                for m in range(min(SETTINGS.max_months, crossed(at, SETTINGS.horizon))):
                    reached.setdefault(p[0], Counter())[m] += 1
    expected = Counter()
    for p, at in zip(payments, days):
        for v in of_key.get(p[1], [None]):
            canceled = v and v[8]
            months = {0: 1} if canceled else reached.get(p[0], {0: 1})
            for m, n in months.items():
                kind = "subscription_cancellation" if canceled else "subscription_payment_renewal" if m else p[3]
                expected[(p[0], v and v[1], later(canceled or at, m), kind)] += n
    subs, txns = frames
    found = Counter()
    for r in revenue.transaction_months(txns, subs, SETTINGS).collect():
        found[(r.transaction_id, r.subscription_id, r.transaction_date, r.transaction_type)] += r.weight
    assert found == expected


def test_subscription_versions_against_rows_written_out(rows, frames):
    versions, payments = rows
    paid = {}
    for p in payments:
        if p[6] == "Succeeded" and p[1]:
            paid.setdefault(p[1], []).append(p[4])
    reached = {}
    for v in versions:
        n = crossed(v[7], v[8] or SETTINGS.horizon) if v[4] == "Annual" else 0
        for m in range(min(SETTINGS.max_months, n)):
            reached.setdefault(v[0], Counter())[m] += 1
    expected = Counter()
    for v in versions:
        still_open = v[5] is not None and v[5] != "Canceled"
        for price in paid.get(v[0], [None]) if still_open else [None]:
            for m, n in (reached.get(v[0], {0: 1}) if still_open else {0: 1}).items():
                expected[(v[1], v[5], later(v[7], m), price)] += n
    subs, txns = frames
    found = Counter()
    for r in each_month(retention.subscription_spans(subs, txns, SETTINGS), "months", "valid_from", "weight").collect():
        found[(r.subscription_id, r.status, r.valid_from, r.price)] += r.weight
    assert found == expected


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payments_without_a_version_are_not_shuffled_for_it(no_broadcast, frames):
    lines = plan(revenue.transaction_spans(frames[1], frames[0], SETTINGS)).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    union = next(i for i, line in enumerate(lines) if re.search(r"\bUnion", line))
    level = depth(lines[union + 1])
    last = next(i for i in range(union + 1, len(lines)) if depth(lines[i]) == level and "+-" in lines[i])
    end = next((i for i in range(last + 1, len(lines)) if depth(lines[i]) <= level), len(lines))
    below = lines[last:end]
    assert "isnull(subscription_sk" in " ".join(below) and "Exchange" not in " ".join(below)


@pytest.mark.parametrize("name", ["mart_retention", "mart_revenue"])
def test_queries_store_only_what_they_read(spark, name):
    m = models(spark, SF, STORED[name])
    assert m.dim_subscription.columns == list(VERSION)
    stored = " ".join(m.fact_transaction.inputFiles())
    assert ("orders.parquet" in stored) == (name == "mart_retention")
    assert name == "mart_retention" or not {"currency", "total_amount"} & set(m.fact_transaction.columns)
    whole = models(spark, SF)
    same = whole.dim_subscription.select(*VERSION)
    assert m.dim_subscription.exceptAll(same).count() == same.exceptAll(m.dim_subscription).count() == 0
