"""Look back over rows that stand for many months, and counts of distinct values per month."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES, SETTINGS, models
from custarc.operators.expansion import distinct_by_month, each_month
from custarc.operators.ladder import SPREAD, YearOr, day_number, hour_number, months_by_entity, previous_value
from custarc.plans import retention, revenue
from custarc.sinks.tables import cut_into

SF = "/root/testdata/sf0.001"
ROW = ("e", "at", "v", "t")


def year_or_hour(at, known):
    return F.when(known, F.year(at)).otherwise(hour_number(at))


def year_or_day(at, known):
    return F.when(known, F.year(at)).otherwise(day_number(at))


@pytest.fixture(scope="module", params=range(2))
def spans(spark, request):
    """Rows with 1 to 14 months, some of them without rows, null keys and moments, and equal rows."""
    rng = random.Random(request.param)
    rows = []
    for _ in range(400):
        at = None if rng.random() < 0.05 else datetime(2023, 1, 1) + timedelta(hours=12 * rng.randrange(2000))
        months = None if rng.random() < 0.03 else [rng.choice([0, 1, 1, 2]) for _ in range(rng.randrange(1, 15))]
        value = None if rng.random() < 0.1 else rng.randrange(4) * 0.25
        rows.append((rng.choice([None, "", "a", "b", "c"]), at, value, rng.choice([None, "x", "y"]), months, rng.randrange(1, 3)))
    rows += rows[:50]
    return spark.createDataFrame(rows, "e string, at timestamp_ntz, v double, t string, m array<bigint>, w bigint")


def bag(df, weight, *cols):
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*cols).agg(F.sum(weight)).collect()}


def brute(spans):
    """(rows with the value before, rank of months, first months) of the rows written out one by one."""
    of_entity = {}
    for r in each_month(spans, "m", "at", "w").collect():
        of_entity.setdefault(r.e, []).extend([(r["at"], r.v, r.t)] * r.w)
    last = lambda x: (x is None, x if x is not None else 0)
    moment = lambda x: (x is None, x or datetime.min)
    text = lambda x: (x is None, x or "")
    found, ranks, firsts = Counter(), {}, {}
    for e, rows in of_entity.items():
        rows.sort(key=lambda r: (moment(r[0]), last(r[1]), text(r[2])))
        for before, row in zip([None, *rows], rows):
            found[(e, *row, before and before[1])] += 1
        numbers = sorted({13 if r[0] is None else r[0].month for r in rows})
        ranks.update({(e, n): i for i, n in enumerate(numbers)})
        moments = [r[0] for r in rows if r[0]]
        firsts[e] = min(moments).date().replace(day=1) if moments else None
    return found, ranks, firsts


@pytest.mark.parametrize("counted_before", [True, False])
@pytest.mark.parametrize("period", [year_or_hour, year_or_day])
def test_look_back_over_months_against_brute_force(spans, period, counted_before):
    out = previous_value(
        spans, "e", "at", "v", ["t"], "w", "old", period, counted_before, "rank", "first", months="m"
    )
    found, ranks, firsts = brute(spans)
    rows = out.collect()
    got = Counter()
    for r in rows:
        got[(r.e, r["at"], r.v, r.t, r.old)] += r.copies
    assert got == found
    assert {(r.e, 13 if r["at"] is None else r["at"].month): r["rank"] for r in rows} == ranks
    assert {r.e: r["first"] for r in rows} == firsts


def test_months_by_entity_are_the_months(spans):
    here = months_by_entity(spans, "e", "at", "m", "w", year_or_hour)
    assert bag(here, "w", *ROW) == bag(each_month(spans, "m", "at", "w"), "w", *ROW)
    assert bag(here, "w", *ROW) == {k[3:]: n for k, n in bag(here, "w", *SPREAD, *ROW).items()}


@pytest.mark.parametrize("longest", [14, 30])
def test_years_from_numbers_against_brute_force(spark, spans, longest):
    """Years that follow from bits of the months give the rows and marks that moments give, also for
    arrays without rows, without elements, or longer than the bits."""
    more = spans.limit(60).withColumn("m", F.expr(f"slice(concat(m, m, m), 1, {longest})"))
    odd = spans.limit(30).withColumn("m", F.expr("transform(m, (n, i) -> if(i % 5 = 0, 0L, n))"))
    rows = more.unionByName(odd).unionByName(spans).unionByName(spans.limit(5).withColumn("m", F.expr("array(0L, 0L)")))
    rows = rows.where("m IS NULL OR size(m) > 0").localCheckpoint()
    got = previous_value(
        rows, "e", "at", "v", ["t"], "w", "old", YearOr(hour_number), True, "rank", "first", "m", "once", ["t"]
    ).collect()
    found, ranks, firsts = brute(rows)
    state, marks, months = Counter(), Counter(), set()
    for r in got:
        state[(r.e, r["at"], r.v, r.t, r.old)] += r.copies
        assert r.once in (0, 1) and (r.once == 0 or r.copies == 1)
        if r.e is not None:
            month = (r.e, r["at"] and (r["at"].year, r["at"].month), r.t)
            months.add(month)
            marks[month] += r.once
    assert state == found
    assert {(r.e, 13 if r["at"] is None else r["at"].month): r["rank"] for r in got} == ranks
    assert {r.e: r["first"] for r in got} == firsts
    assert months and marks == dict.fromkeys(months, 1)


def test_subscriptions_are_counted_without_grouping_by_them(spark):
    """The rows of a subscription are the larger part of the mart's work; they are grouped by its keys only,
    and no year of theirs is worked out month by month."""
    m = models(spark, SF)
    df = retention.mart_retention(m.dim_subscription, m.fact_transaction, SETTINGS)
    aggregates = [l for l in final_plan(df).splitlines() if "Aggregate(keys=" in l]
    by_months = [l for l in aggregates if "months_since_start" in l]
    assert by_months and not any("_entity" in l for l in by_months)


def test_distinct_by_month(spans):
    months = each_month(spans, "m", "at", "w")
    number = F.month("at").cast("long").alias("n")
    plain = months.where("e IS NOT NULL").groupBy(number, "t").agg(F.count_distinct("e").alias("c"))
    got = distinct_by_month(months, "e", "at", ["t"], "n", "c")
    assert got.columns == ["n", "t", "c"]
    assert bag(got, "c", "n", "t") == bag(plain, "c", "n", "t")
    assert distinct_by_month(months.where("false"), "e", "at", [], "n", "c").count() == 0


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    m = models(spark, SF)
    cut = cut_into(str(tmp_path_factory.mktemp("core")))
    return cut(m.dim_subscription, "dim_subscription"), cut(m.fact_transaction, "fact_transaction")


@pytest.mark.parametrize("name", ["retention", "revenue"])
def test_months_are_repeated_behind_one_shuffle(spark, stored, name):
    """A year of months is one or two shuffled rows, and the rows are shuffled by period once."""
    subs, txns = stored
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if name == "retention":
            rows = retention.subscription_spans(subs, txns, SETTINGS)
            state = retention.with_old_price(rows, "months")
        else:
            rows = revenue.transaction_spans(txns, subs, SETTINGS)
            state = revenue.with_old_price(rows, "months")
        text = final_plan(state)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    by_period = [l for l in text.splitlines() if "REPARTITION_BY_COL" in l]
    assert len(by_period) == 2 and sum("ReusedExchange" in l for l in by_period) == 1
    # What repeats the months lies above the shuffle.
    repeats = [i for i, l in enumerate(text.splitlines()) if re.search(r"Generate explode\(sequence\(_from", l)]
    assert repeats and repeats[0] < next(i for i, l in enumerate(text.splitlines()) if "REPARTITION_BY_COL" in l)


@pytest.mark.parametrize("name", ["retention_event_type", "retention_lag_price", "lag_price", "cohort_month_rank"])
def test_rows_are_grouped_where_they_are(spark, name):
    """Nothing is shuffled after the months were repeated."""
    text = final_plan(QUERIES[name](models(spark, SF)))
    above = text[: re.search(r"Generate explode\(sequence\(_from", text).start()]
    assert "Exchange" not in above


def test_partitions_stay_small_for_rows_repeated_behind_the_shuffle(spark):
    """Adaptive execution doesn't join the partitions of the look back by their size before the months
    are repeated, and no sort of it compares the text of an entity before its hash."""
    day = datetime(2020, 1, 1)
    rows = [(f"s{k % 50}", day + timedelta(days=k), float(k), "t", [1, 1, 1], 1) for k in range(400)]
    df = spark.createDataFrame(rows, "e string, at timestamp_ntz, v double, t string, m array<long>, w long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        back = previous_value(df, "e", "at", "v", ["t"], "w", "old", year_or_day, counted_before=True, months="m")
        assert back.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
        text = final_plan(back)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    first = re.findall(r"\bSort \[(_[a-z_]+)#", text)
    # The window over an entity's periods is the one that has no period to hash.
    assert sorted(set(first)) == ["_hash", "_hash_r", "_known"] and first.count("_known") == 1
