import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from custarc.operators.expansion import expand_months
from custarc.operators.identity import repair_identity
from custarc.operators.joins import left_join_when, lookup_left
from custarc.operators.ladder import day_number, month_number, previous_value
from custarc.operators.quality import grain_check
from custarc.operators.spine import calendar, date_id, date_spine, full_date, month_spine
from custarc.settings import Settings


def bag(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_calendar(spark):
    cal = calendar(date_spine(spark, date(2025, 1, 1), date(2026, 1, 1)))
    assert cal.count() == 365
    rows = {r.full_date: r for r in cal.collect()}
    sunday, monday = rows[date(2025, 1, 5)], rows[date(2025, 1, 6)]
    assert (sunday.day_of_week, sunday.is_weekend) == (0, False)
    assert (monday.day_of_week, monday.is_weekend, monday.date_id) == (1, True, 20250106)
    assert (rows[date(2025, 12, 29)].week, rows[date(2025, 12, 29)].quarter) == (1, 4)
    sat_sun = calendar(date_spine(spark, date(2025, 1, 1), date(2025, 1, 8)), (0, 6))
    assert {r.full_date.day for r in sat_sun.where("is_weekend").collect()} == {4, 5}
    assert [r[0] for r in month_spine(spark, 3).orderBy(F.col("months_since_start")).collect()] == [0, 1, 2]


def test_date_ids_equal_a_calendar_join(spark):
    s = Settings()
    cal = calendar(date_spine(spark, s.spine_start, s.spine_end))
    days = [date(2024, 12, 31) + timedelta(n) for n in range(0, 368)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    joined = df.join(cal, F.col("d") == F.col("full_date"), "left").select("d", "date_id")
    direct = df.select("d", date_id(F.col("d"), s).alias("date_id"))
    assert bag(joined, "d", "date_id") == bag(direct, "d", "date_id")
    back = direct.select("d", full_date(F.col("date_id"), s).alias("f"))
    assert all(r.f == (r.d if r.d and r.d.year == 2025 else None) for r in back.collect())


def test_lookup_left(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None), (5, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("b", 20), (None, 99)], "rk string, v int")
    out = lookup_left(left, right, "k", "rk", ["id"])
    assert out.columns == ["id", "k", "v"]
    expected = [(1, "a", 10), (1, "a", 11), (2, "b", 20), (3, None, None), (4, None, None), (5, "z", None)]
    assert bag(out, "id", "k", "v") == Counter(expected)


def test_stand_in_keys_match_nothing(spark):
    left = spark.createDataFrame([(1, None)], "id int, k string")
    every_slot = spark.range(1 << 14).select(F.concat(F.lit("\0"), F.col("id").cast("string")).alias("rk"))
    out = lookup_left(left, every_slot.withColumn("v", F.lit(1)), "k", "rk", ["id"])
    assert [tuple(r) for r in out.collect()] == [(1, None, None)]


def test_left_join_when_keeps_failing_rows(spark):
    left = spark.createDataFrame([("a", "Active"), ("a", "Canceled"), ("a", None)], "k string, s string")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    out = left_join_when(left, right, ["k"], F.col("s") != "Canceled")
    assert bag(out, "s", "v") == Counter([("Active", 1), ("Active", 2), ("Canceled", None), (None, None)])


def test_repair_identity(spark):
    usage = spark.createDataFrame(
        [
            ("e1", None, "a@x"),  # id by e-mail, one row per owner
            ("e2", "u3", None),  # e-mail by id
            ("e3", "ano_1", None),  # anonymous
            ("e4", "u9", "q@x"),  # unknown
            ("e5", "u1", "a@x"),  # nothing missing, still repeated per owner
            ("e6", None, None),
        ],
        "event_id string, user_id string, user_email string",
    )
    users = spark.createDataFrame(
        [("u1", "a@x"), ("u2", "a@x"), ("u3", "c@x"), ("ano_1", "d@x"), ("u4", None)],
        "user_id string, email string",
    )
    out = bag(repair_identity(usage, users), "event_id", "user_id", "user_email")
    assert out == Counter(
        [
            ("e1", "u1", "a@x"), ("e1", "u2", "a@x"), ("e2", "u3", "c@x"), ("e3", "ano_1", None),
            ("e4", "u9", "q@x"), ("e5", "u1", "a@x"), ("e5", "u1", "a@x"), ("e6", None, None),
        ]
    )


def test_expand_months(spark):
    rows = [(1, "2025-01-31", "2025-03-01"), (2, "2025-01-01", "2030-01-01"), (3, "2025-05-02", "2025-05-30"),
            (4, "2025-05-02", "2025-01-01"), (5, "2025-05-02", None)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    out = expand_months(df, F.to_date("a"), F.to_date("b"), 12)
    assert bag(out, "id", "months_since_start") == Counter([(1, 0), (1, 1)] + [(2, m) for m in range(12)])


def brute_lag(rows):
    """rows of (entity, at, value, tie, weight) -> bag of (entity, at, value, tie, old)."""
    groups = defaultdict(list)
    for e, at, v, t, w in rows:
        groups[e] += [(at, v, t)] * w
    last = lambda x: (x is None, x if x is not None else 0)
    out = Counter()
    for e, members in groups.items():
        members.sort(key=lambda m: (
            (m[0] is None, m[0] or datetime.min), last(m[1]), (m[2] is None, m[2] or "")
        ))
        for i, (at, v, t) in enumerate(members):
            out[(e, at, v, t, members[i - 1][1] if i else None)] += 1
    return out


def brute_rank(rows):
    months = defaultdict(set)
    for e, at, *_ in rows:
        months[e].add(13 if at is None else at.month)
    return {(e, m): sorted(ms).index(m) for e, ms in months.items() for m in ms}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("counted_before", [False, True])
def test_previous_value_against_brute_force(spark, seed, counted_before):
    rng = random.Random(seed)
    rows = []
    for _ in range(900):
        hot = rng.random() < 0.4
        entity = None if hot else rng.choice(["", "a", "b", "c", "d"])
        at = None if rng.random() < 0.05 else datetime(2024, 1, 1) + timedelta(
            hours=12 * rng.randrange(0, 900 if rng.random() < 0.5 else 4)
        )
        value = None if rng.random() < 0.1 else rng.randrange(4) * 0.25
        rows.append((entity, at, value, rng.choice([None, "x", "y"]), rng.randrange(1, 4)))
    df = spark.createDataFrame(rows, "e string, at timestamp_ntz, v double, t string, w long")
    out = previous_value(
        df, "e", "at", "v", ["t"], "w", "old",
        period=month_number("at") if counted_before else day_number("at"),
        counted_before=counted_before, month_rank="rank",
    )
    got, ranks = Counter(), {}
    for r in out.collect():
        got[(r.e, r.at, r.v, r.t, r.old)] += r.copies
        ranks[(r.e, 13 if r.at is None else r.at.month)] = r["rank"]
    assert got == brute_lag(rows)
    assert ranks == brute_rank(rows)


def test_grain_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b")], "k int, v string")
    assert bag(grain_check(df, ["k"]), "k", "n") == Counter([(1, 2), (None, 2)])
