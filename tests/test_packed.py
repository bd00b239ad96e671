"""Surrogate keys as bytes in shuffles and scratch files, and payments that stay out of the shuffle by payment."""

import hashlib
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import SETTINGS
from custarc.functions.keys import packed_key, unpacked_key
from custarc.operators.asof import as_of
from custarc.operators.expansion import distinct_by_month, each_month
from custarc.operators.joins import left_join_few, left_join_when, lookup_left, lookup_left_packed
from custarc.plans import revenue
from custarc.plans.core import with_version_as_of
from custarc.sinks.tables import cut_into, write_table
from test_slim_marts import frames, no_broadcast, plan, rows  # noqa: F401

md5 = lambda text: hashlib.md5(str(text).encode()).hexdigest()
ODD = [
    None, "", "k1", "\0", "\0" * 17, "é" * 16, md5(1), md5(2), md5(1).upper(), md5(1)[:-1], md5(1) + "0", md5(1) + "\n",
    "g" * 32, "0" * 32, b"abcdefghijklmnop".hex(), "abcdefghijklmnop", "abcdefghijklmnop" + "\0" * 17,
]


def test_packed_keys_differ_and_come_back(spark):
    df = spark.createDataFrame([(k,) for k in ODD], "k string").withColumn("p", packed_key(F.col("k")))
    found = df.select("k", "p", unpacked_key(F.col("p")).alias("back")).collect()
    assert [r.back for r in found] == [r.k for r in found] == ODD
    assert len({r.p and bytes(r.p) for r in found}) == len(ODD)
    assert all(len(r.p) == 16 for r in found if r.k in (md5(1), md5(2), "0" * 32))
    texts = sorted(k for k in ODD if k and len(k) != 32)
    assert [bytes(r.p) for r in sorted((r for r in found if r.k in texts), key=lambda r: r.k.encode())] == sorted(
        bytes(r.p) for r in found if r.k in texts
    )


def test_packed_lookup_is_the_text_lookup(spark):
    left = spark.createDataFrame([(i, k, i % 2) for i, k in enumerate(ODD * 2)], "id int, k string, x int")
    right = spark.createDataFrame([(k, i % 2, i) for i, k in enumerate([*ODD, md5(1), "k1"])], "rk string, y int, v int")
    bytes_right = right.withColumn("rk", packed_key(F.col("rk")))
    for also in ((), [("x", "y")]):
        expected = lookup_left(left, right, "k", "rk", ["id"], also)
        found = lookup_left_packed(left, bytes_right, "k", "rk", ["id"], also)
        assert found.columns == expected.columns
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))


def test_scratch_files_hold_packed_keys(spark, tmp_path):
    df = spark.createDataFrame([(k, 1, k) for k in ODD], "user_sk string, n int, subscription_sk string")
    stored = write_table(df, str(tmp_path), "t")
    assert stored.schema == df.schema and Counter(stored.collect()) == Counter(df.collect())
    kinds = dict(spark.read.parquet(str(tmp_path / "t")).dtypes)
    assert kinds == {"user_sk": "binary", "n": "int", "subscription_sk": "binary"}


def test_as_of_ties_decide_before_values(spark):
    right = spark.createDataFrame([("a", 1, 1, "z"), ("a", 1, 2, "b"), ("a", 1, 2, "a"), ("a", 1, None, "y")], "rk string, s int, t int, v string")
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 0)], "id int, k string, at int")
    period = lambda c: F.col(c)
    found = as_of(left, right, ("k", "rk"), ("at", "s"), ["v"], ["id"], period, ["t"])
    assert {r.id: r.v for r in found.collect()} == {1: "b", 2: None}


@pytest.mark.parametrize("seed", range(2))
def test_versions_as_of_over_years(spark, seed):
    """Users with many versions in a year, years without any, and moments before the first."""
    r = random.Random(seed)
    user = lambda: r.choice([md5(1), md5(1), md5(2), "plain", None])
    day = lambda: datetime(1999, 1, 1) + timedelta(days=r.randrange(2500))
    until = lambda at: r.choice([None, at and at + timedelta(days=r.randrange(900))])
    versions = [(user(), at, until(at), md5(i)) for i in range(80) for at in [r.choice([day(), None, datetime(2001, 5, 5)])]]
    paid = [(i, user(), r.choice([day().date(), date(2001, 5, 5), None])) for i in range(300)]
    subs = spark.createDataFrame(versions, "user_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz, subscription_sk string")
    found = with_version_as_of(spark.createDataFrame(paid, "id int, user_sk string, day date"), subs, "day", ["id"])

    def match(u, at):
        fits = [(f, t.date() if t else date.max, k) for v, f, t, k in versions if u and at and v == u and f and f.date() <= at]
        best = max(fits, default=None)
        return best[2] if best and best[1] > at else None

    assert found.columns == ["id", "user_sk", "day", "subscription_sk"]
    assert Counter(map(tuple, found.collect())) == Counter((i, u, at, match(u, at)) for i, u, at in paid)


def shuffled(df):
    """Rows written by each shuffle of a frame that was run."""
    found = {}

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found[node.id()] = node.metrics().get("shuffleRecordsWritten").get().value()
        inner = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else None
        for child in [inner] if inner else [node.children().apply(i) for i in range(node.children().size())]:
            visit(child)

    visit(df._jdf.queryExecution().executedPlan())
    return list(found.values())


def test_few_matches_shuffle_few_rows(spark, no_broadcast):  # noqa: F811
    left = spark.range(20000).select(F.concat(F.lit("t"), F.col("id")).alias("k"), (F.col("id") % 3).alias("x"))
    right = spark.createDataFrame([(f"t{i}", i) for i in (1, 2, 3, 4, 4, 30000)], "k string, v int")
    open_ = F.when(F.col("x") > 0, True)
    out = left_join_few(left, right, "k", open_)
    expected = left_join_when(left, right, ["k"], open_)
    assert out.columns == expected.columns == ["k", "x", "v"]
    assert Counter(out.collect()) == Counter(expected.collect())
    assert out.count() == 20001 and max(shuffled(out)) < 100 < 20000 <= max(shuffled(expected))


def test_payments_of_one_key_share_their_months_when_stored(spark, frames, tmp_path):  # noqa: F811
    subs, txns = frames
    stored = revenue.transaction_months(txns, subs, SETTINGS, cut_into(str(tmp_path)))
    plain = revenue.transaction_months(txns, subs, SETTINGS)
    names = sorted(set(plain.columns) - {"weight"})
    bag = lambda df: {tuple(r)[:-1]: r.n for r in df.groupBy(*names).agg(F.sum("weight").alias("n")).collect()}
    assert bag(stored) == bag(plain)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["paid_months", "paid_versions"]


def test_distinct_values_from_months_not_written_out(spark):
    """Keys with separators, empty texts and NULLs; rows without a moment, and more months than an integer holds."""
    r = random.Random(3)
    odd = [None, "", "|", "~", "~1", "=", "a|b", "a", "b|~0"]
    at = lambda: r.choice([None, datetime(2000, r.randrange(1, 13), 28), datetime(2001, 1, 31)])
    data = [
        (r.choice([None, *"uvwxyz"]), at(), r.choice(odd), r.choice(odd), [r.choice([0, 0, 1, 2]) for _ in range(r.choice([1, 3, 12, 20]))])
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, "of string, at timestamp_ntz, k string, l string, months array<bigint>")
    expected = {}
    for of, day, k, l, months in data:
        for m in (m for m, n in enumerate(months) if n and of):
            expected.setdefault((day and (day.month - 1 + m) % 12 + 1, k, l), set()).add(of)
    found = distinct_by_month(df, "of", "at", ["k", "l"], "month", "n", "months")
    assert found.columns == ["month", "k", "l", "n"]
    assert {tuple(x)[:3]: x.n for x in found.collect()} == {key: len(values) for key, values in expected.items()}
    written = each_month(df.withColumn("w", F.lit(1)), "months", "at", "w")
    again = distinct_by_month(written, "of", "at", ["k", "l"], "month", "n")
    assert Counter(again.collect()) == Counter(found.collect())


def test_a_looked_up_key_is_shuffled_once(spark, no_broadcast):  # noqa: F811
    left = spark.createDataFrame([(1, "a@x", "p"), (2, None, "q")], "id int, mail string, v string")
    right = spark.createDataFrame([("a@x", "k")], "rk string, user_sk string")
    text = plan(lookup_left(left, right, "mail", "rk", ["id"]).drop("mail"))
    exchange = next(i for i, line in enumerate(text.splitlines()) if "Exchange hashpartitioning(_left_key" in line)
    below = text.splitlines()[exchange + 1]
    assert "Project [id" in below and "AS _left_key" in below and ", mail#" not in below.split("coalesce")[0]
