from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from custarc.functions import measures, properties, temporal, text
from custarc.functions.keys import surrogate_key


def test_capitalize_words(values):
    inputs = ["  HELLO   wORLD o'neil-x ", "", None, "a\tb\nC"]
    assert values(text.capitalize_words, inputs) == [" Hello World O'neil-x ", "", None, "A B C"]


def test_handle_issue(values):
    inputs = [None, "N/A", "nan", " null ", "  mary   ANN ", "None", "x"]
    assert values(text.handle_issue, inputs) == ["", "", "", "Null", "Mary Ann", "", "X"]
    assert values(lambda c: text.handle_issue(c, "Others"), [None, "male"]) == ["Others", "Male"]


def test_clean_email(values):
    inputs = [" User1_at_Mail.com ", "A_AT_b", None, "X@Y.z"]
    assert values(text.clean_email, inputs) == ["user1@mail.com", "a_at_b", None, "x@y.z"]


def test_small_text_rules(values):
    assert values(text.digits_only, ["+1 (555) 7-7", None, "abc"]) == ["155577", None, ""]
    assert values(text.null_if_in, ["user_unknown", "", "null", "NULL", "u1", None]) == [
        None, None, None, "NULL", "u1", None,
    ]
    assert values(text.clean_currency, ["usd", "US Dollar", "5$", " usd", " eur ", None]) == [
        "USD", "USD", "USD", "usd", "eur", None,
    ]
    assert values(text.flag, [True, False, None], "boolean") == [1, 0, 0]
    assert values(text.default_label, ["x", None]) == ["x", "N/A"]


@pytest.mark.parametrize(
    "kind, description, txn, expected, renewal_first",
    [
        ("N/A", "Ultimate Annual renewal", "t", "subscription_payment_new", "subscription_payment_renewal"),
        (None, "Premium Monthly downgrade", "t", "subscription_payment_downgrade", None),
        (None, "upgrade to new", "t", "subscription_payment_upgrade", None),
        (None, None, "re_24", "refund", None),
        (None, "misc", "txn_4", None, None),
        (None, None, None, None, None),
        (" Subscription_Payment_Renewal ", "new", "t", "subscription_payment_renewal", None),
    ],
)
def test_repair_transaction_type(spark, kind, description, txn, expected, renewal_first):
    df = spark.createDataFrame([(kind, description, txn)], "k string, d string, t string")
    row = df.select(
        text.repair_transaction_type(df.k, df.d, df.t).alias("a"),
        text.repair_transaction_type(df.k, df.d, df.t, renewal_first=True).alias("b"),
    ).first()
    assert row.a == expected
    assert row.b == (renewal_first or expected)


def test_plan_and_cycle_from_description(values):
    inputs = ["Basic Monthly new", "x Premium", "Standard Annual", "misc", None]
    assert values(text.infer_plan, inputs) == ["Basic", "Premium", "Standard", "Ultimate", "Ultimate"]
    assert values(text.infer_cycle, inputs) == ["Monthly", "Annual", "Annual", "Annual", "Annual"]
    filled = lambda c: text.fill_empty(c, F.lit("z"))
    assert values(filled, ["", "a", None]) == ["z", "a", None]


def test_lenient_dates(values):
    inputs = ["2025/01/05", "2025-01", "2025", "2025-02-30", "01/05/2025", "n/a", None, "2025-1-5", "2025-01-05 abc"]
    expected = [date(2025, 1, 5), None, None, None, None, None, None, date(2025, 1, 5), None]
    assert values(temporal.to_date_lenient, inputs) == expected
    stamps = ["2025-01-05T10:00:00Z", "2025-01-05 10:00:01.5", "2025-01-05", "2025-01-05T"]
    assert values(temporal.to_ts_lenient, stamps) == [
        datetime(2025, 1, 5, 10), datetime(2025, 1, 5, 10, 0, 1, 500000), datetime(2025, 1, 5), None,
    ]
    assert values(temporal.to_float_lenient, ["1.5", "n/a", None]) == [1.5, None, None]


def test_month_arithmetic(spark):
    rows = [
        ("2025-01-31 00:00:00", "2025-02-01 00:00:00", 1),
        ("2025-05-01 00:00:00", "2025-02-28 00:00:00", -3),
        ("2025-12-31 23:00:00", "2025-12-31 00:00:00", 0),
    ]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    out = df.select("n", temporal.months_crossed(F.to_date("a"), F.to_date("b")).alias("m")).collect()
    assert [r.n for r in out] == [r.m for r in out]
    ts = F.lit("2025-01-31 10:00:00").cast("timestamp_ntz")
    r = spark.range(1).select(
        temporal.add_months_ts(ts, F.lit(1)).alias("a"), temporal.add_months_ts(ts, F.lit(0)).alias("b"),
        temporal.month_start(ts).alias("c"), temporal.date_key(ts).alias("d"),
    ).first()
    assert tuple(r) == (datetime(2025, 2, 28, 10), datetime(2025, 1, 31, 10), date(2025, 1, 1), 20250131)


def test_properties(spark, values):
    number = lambda c: properties.json_int(c, "$.d")
    inputs = ['{"d":"12.6"}', '{"d":30.4}', '{"d":"abc"}', "{}", '{"d":"12.5"}', '{"d":null}', "{bad", None]
    assert values(number, inputs) == [13, 30, None, None, 13, None, None, None]
    assert values(lambda c: properties.json_text(c, "$.d"), [r'{"d":"a \"b\""}']) == ["a b"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, p string")
    both = properties.with_json_fields(df, "p", ["d", "e"]).withColumn(
        "same", F.col("d").eqNullSafe(properties.json_text(F.col("p"), "$.d"))
    )
    assert [r.same for r in both.collect()] == [True] * len(inputs)
    assert both.where("e IS NOT NULL").isEmpty()


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key(df.x, df.y).alias("k")).collect()]
    assert keys[0] == "6231b1e7ffe3b9d15edc44e40e6f694c"
    assert keys[0] != keys[1]


def test_measures(spark, values):
    days = [None, -2, 0, 3, 7, 8]
    assert values(measures.activation_bucket, days, "int") == [
        "Never Activated", "Day 1-3", "Day 0", "Day 1-3", "Day 4-7", "After Day 7",
    ]
    assert values(measures.is_activated, days, "int") == [0, 1, 1, 1, 1, 0]
    df = spark.createDataFrame([(10.0, 2, 0.25)], "p double, q int, d double")
    r = df.select(measures.net_price(df.p, df.d), measures.line_total(df.p, df.q, df.d)).first()
    assert tuple(r) == (7.5, 15.0)
    kinds = spark.createDataFrame(
        [("t", None, 0, "Active"), ("t", None, 3, "Canceled"), ("t", date(2025, 1, 1), 3, None)],
        "k string, c date, m int, s string",
    )
    out = kinds.select(
        measures.revenue_event_type(kinds.k, kinds.c, kinds.m).alias("a"),
        measures.retention_event_type(kinds.k, kinds.s).alias("b"),
    ).collect()
    assert [r.a for r in out] == ["t", measures.RENEWAL, measures.CANCELLATION]
    assert [r.b for r in out] == ["t", measures.CANCELLATION, "t"]


def test_line_totals_round_as_binary_numbers(spark):
    cases = [(109.49, 2, 0.25, 164.24), (10.0, 1, 0.0, 10.0), (0.05, 3, 0.1, 0.14), (-2.345, 1, 0.0, None)]
    df = spark.createDataFrame([c[:3] for c in cases], "p double, q int, d double")
    found = [r[0] for r in df.select(measures.line_total(df.p, df.q, df.d)).collect()]
    for (p, q, d, expected), got in zip(cases, found):
        cents = p * q * (1 - d) * 100
        assert got == (int(abs(cents) + 0.5) / 100 * (1 if cents > 0 else -1))
        assert expected is None or got == expected


def test_dates_of_one_separator_and_whole_times(values):
    inputs = ["2025-01/05", "2025/01/05", "2025-01-05 10", "2025-01-05 10:30", "2025-01-05T10:30:15.5"]
    found = values(temporal.to_ts_lenient, inputs)
    assert found == [None, datetime(2025, 1, 5), None, datetime(2025, 1, 5, 10, 30), datetime(2025, 1, 5, 10, 30, 15, 500000)]
