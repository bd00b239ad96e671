import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import SETTINGS, models
from custarc.operators.asof import as_of
from custarc.operators.ladder import day_number, month_number
from custarc.plans.core import with_version_as_of
from custarc.plans.retention import mart_retention
from custarc.settings import Settings
from test_scale import conf, plan  # noqa: F401

SF = "/root/testdata/sf0.001"
START = datetime(2000, 1, 1)


def moments(r, keys, n):
    at = [START + timedelta(hours=r.randrange(3000)) for _ in range(40)] + [None]
    return [(k, r.choice(keys), r.choice(at)) for k in range(n)]


@pytest.mark.parametrize("period", [month_number, day_number])
def test_as_brute_force(spark, period):
    r = random.Random(1)
    keys = ["a", "a", "a", "b", "c", None]
    left, right = moments(r, keys, 300), [(*x[1:], r.choice([None, "x", "y"]), x[0] % 4) for x in moments(r, [*keys, "d"], 60)]
    found = as_of(
        spark.createDataFrame(left, "id int, k string, at timestamp_ntz"),
        spark.createDataFrame(right, "rk string, start timestamp_ntz, v string, n int"),
        ("k", "rk"), ("at", "start"), ["v", "n"], ["id"], period,
    )
    assert found.columns == ["id", "k", "at", "v", "n"]

    def match(k, at):
        fits = [(s, v or "", n, v) for rk, s, v, n in right if k is not None and rk == k and at and s and s <= at]
        best = max(fits, key=lambda x: x[:3], default=None)
        return (best[3], best[2]) if best else (None, None)

    assert Counter(tuple(x) for x in found.collect()) == Counter((i, k, at, *match(k, at)) for i, k, at in left)


def test_no_range_join_and_a_hot_user_is_spread(spark, conf):  # noqa: F811
    """A third of the rows belong to one user: windows see that user's distinct moments only, and the
    join back is split."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
        adaptive__coalescePartitions__minPartitionSize="1KB",
        shuffle__partitions="20",
    )
    n = F.col("id")
    left = spark.range(0, 90000, 1, 8).select(
        n.alias("id"),
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), n % 5000)).alias("user_sk"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.when(n % 3 == 0, F.lit(7)).otherwise((n % 50).cast("int"))).alias("day"),
    )
    right = spark.range(5000).select(
        F.when(n == 0, "hot").otherwise(F.concat(F.lit("u"), n)).alias("user_sk"),
        F.lit("2000-01-03").cast("timestamp_ntz").alias("valid_from"),
        F.when(n % 2 == 1, "2000-01-20").cast("timestamp_ntz").alias("valid_to"),
        n.cast("string").alias("subscription_sk"),
    )
    out = with_version_as_of(left, right, "day", ["id"])
    counts = out.groupBy((F.col("user_sk") == "hot").alias("hot")).agg(F.count("*").alias("n"), F.count("subscription_sk").alias("found"))
    assert {r.hot: r.n for r in counts.collect()} == {True: 30000, False: 60000}
    assert {r.hot: r.found for r in counts.collect()}[True] == 30000
    ended = out.where("day >= '2000-01-20' AND int(subscription_sk) % 2 = 1").count()
    assert ended == 0
    rows = out.collect()
    text = plan(out)
    assert len(rows) == 90000 and "skew=true" in text
    assert "NestedLoop" not in text and "Cartesian" not in text
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert joins and not any("<" in line for line in joins)


def test_a_payment_meets_one_version(spark):
    m = models(spark, SF)
    as_of_day = replace(m, settings=replace(SETTINGS, subscription_match="as_of"))
    assert m.fact_transaction.count() >= as_of_day.fact_transaction.count()
    per_user = m.stg_transaction.join(m.dim_user, m.stg_transaction.cust_email == m.dim_user.email, "left")
    assert as_of_day.fact_transaction.count() == per_user.count()


def test_cohorts_of_a_hot_subscription(spark):
    """One subscription with most rows over three years: its cohort is its first month."""
    n = F.col("id")
    subs = spark.range(3000).select(
        F.concat(F.lit("k"), n).alias("subscription_sk"),
        F.when(n < 2000, "hot").otherwise(F.concat(F.lit("s"), n)).alias("subscription_id"),
        F.lit("Basic").alias("plan_name"), F.lit("Monthly").alias("billing_cycle"), F.lit("Active").alias("status"),
        F.lit(None).cast("string").alias("churn_reason"),
        F.timestamp_seconds(F.lit(1704067200) + (n % 1095) * 86400).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("canceled_at"),
    )
    paid = subs.select("subscription_sk", F.lit("Succeeded").alias("status"), F.lit("subscription_payment_new").alias("transaction_type"),
                       F.lit(1.0).alias("price"), F.lit(0.0).alias("discount"))
    mart = mart_retention(subs, paid, Settings(cohort="first_month", mrr_mode="corrected"))
    rows = {(str(r.cohort_month), r.months_since_start): r for r in mart.collect()}
    hot_months = {m for (cohort, m), r in rows.items() if cohort == "2024-01-01" and m > 0}
    assert hot_months == set(range(1, 36))
    assert all(rows["2024-01-01", m].cohort_size == 1 for m in hot_months)
    assert sum(r.new_mrr for r in rows.values()) == 3000


def test_switches_are_checked():
    for name in ("mrr_mode", "subscription_match", "cohort", "users"):
        with pytest.raises(ValueError, match=name):
            Settings(**{name: "other"})


def test_moments_are_shuffled_by_period_once(spark):
    """The window and the carried values read one shuffle."""
    left = spark.range(200).selectExpr("id", "concat('k', id % 7) AS k", "date_add(DATE '2024-01-01', cast(id % 90 AS int)) AS d")
    right = spark.range(50).selectExpr("concat('k', id % 7) AS rk", "date_add(DATE '2024-01-01', cast(id % 60 AS int)) AS s", "id AS v")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = as_of(left, right, ("k", "rk"), ("d", "s"), ["v"], ["id"])
        assert out.count() == 200
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    by_period = [line for line in text.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(by_period) == 2 and sum("ReusedExchange" in line for line in by_period) == 1
