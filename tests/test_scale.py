"""How plans behave on large or lopsided inputs, shown on small ones."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.queries import QUERIES, SETTINGS, models
from custarc.operators.joins import lookup_left, with_user_sk
from custarc.plans.retention import mart_retention
from custarc.plans.retention import with_old_price as retention_old_price
from custarc.plans.revenue import mart_revenue, transaction_months, with_old_price
from custarc.sinks.tables import cut_into

SF = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    m = models(spark, SF)
    cut = cut_into(str(tmp_path_factory.mktemp("core")))
    return cut(m.dim_subscription, "dim_subscription"), cut(m.fact_transaction, "fact_transaction")


@pytest.mark.parametrize(
    "name",
    ["dim_subscription", "fact_transaction", "fact_support", "fact_product_usage",
     "mart_acquisition", "expand_months", "kpi_plan_mix"],
)
def test_no_cross_join_and_no_forced_broadcast(spark, conf, name):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](models(spark, SF)))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|BroadcastExchange", text)


def test_rows_without_a_key_are_scattered(spark, conf):
    """No partition gets more than its share although nine of ten rows have no e-mail."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="8")
    left = spark.range(20000).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("email"),
    )
    right = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    out = lookup_left(left, right, "email", "k", ["event_id"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20000 and max(sizes) < 2 * 20000 / 8


def test_a_hot_email_is_split(spark, conf):
    """A third of the rows with one e-mail: adaptive execution splits that partition."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
        adaptive__coalescePartitions__minPartitionSize="1KB",
        shuffle__partitions="20",
    )
    events = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("ev_"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot@x").otherwise(F.concat(F.lit("u"), F.col("id") % 5000)).alias("mail"),
    )
    users = spark.range(5000).select(
        F.when(F.col("id") == 0, "hot@x").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("email"),
        F.md5(F.col("id").cast("string")).alias("user_sk"),
    )
    out = with_user_sk(events, "mail", users, ["event_id"])
    rows = out.collect()
    assert len(rows) == 60000
    assert sum(r.mail == "hot@x" and r.user_sk is not None for r in rows) == 20000
    assert "skew=true" in plan(out)


def test_look_back_task_size(spark, stored):
    """Payments without a subscription form one partition of a plain window; here no task holds
    more than one of their days."""
    subs, txns = stored
    months = transaction_months(txns, subs, SETTINGS)
    state = with_old_price(months)
    alone = state.where(F.col("subscription_id").isNull()).agg(F.sum("copies")).first()[0]
    per_task = state.groupBy("_known", "_entity", "_period").agg(F.sum("copies").alias("n"))
    widest = per_task.where("NOT _known").agg(F.max("n")).first()[0]
    assert alone > 100 and widest < alone / 5
    state.collect()
    assert "ReusedExchange" in plan(state)


def test_marts_read_only_their_columns(stored):
    subs, txns = stored
    text = plan(mart_revenue(txns, subs, SETTINGS)) + plan(mart_retention(subs, txns, SETTINGS))
    schemas = " ".join(re.findall(r"ReadSchema: \S+", text))
    assert "subscription_sk" in schemas
    assert not re.search(r"currency|loaded_at|current_period_end|total_amount", schemas)
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", text))
    assert "EqualTo(status,Succeeded)" in pushed and "EqualTo(billing_cycle,Annual)" in pushed


def test_look_back_over_rows_without_a_subscription_is_spread(spark, conf):
    """Nine of ten rows have no subscription and fall into one month."""
    conf(adaptive__enabled="false", shuffle__partitions="16")
    n = F.col("id")
    months = spark.range(60000).select(
        F.when(n % 10 == 0, F.concat(F.lit("s"), (n / 10).cast("string"))).alias("subscription_id"),
        F.timestamp_seconds(F.lit(1704067200) + (n * 7919) % 2592000).cast("timestamp_ntz").alias("valid_from"),
        (n % 97).cast("double").alias("price"),
        *[F.lit("x").alias(c) for c in ("transaction_type", "status", "plan_name", "billing_cycle", "churn_reason")],
        F.lit(1).cast("long").alias("weight"),
    )
    found = retention_old_price(months)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60000 and max(sizes) < 2 * 60000 / 16
    at = F.struct("valid_from", "price")
    expected = (
        months.where("subscription_id IS NULL")
        .select(at.alias("at"), F.lag("price").over(Window.orderBy("valid_from", "price")).alias("old"))
    )
    got = found.where("subscription_id IS NULL").select(at.alias("at"), F.col("old_price").alias("old"))
    assert got.exceptAll(expected).count() == 0
