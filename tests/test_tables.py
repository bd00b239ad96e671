"""Replacing tables, key order of files, counts taken on the way, scratch folders."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.queries import SETTINGS, models
from custarc.operators.quality import counted, load_report, order_check, repeated_keys
from custarc.plans import build as plans
from custarc.plans.build import KEY_ORDER, TABLES, build, check_tables, in_key_order
from custarc.sinks.tables import current_version, read_table, replace_table, table_path
from custarc.sources.raw import Sources, conform
from test_scale import conf, plan  # noqa: F401

SF = "/root/testdata/sf0.001"


def versions(location, name):
    return sorted(os.listdir(f"{location}/{name}/_versions"))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    place = str(tmp_path)
    replace_table(spark.range(10), place, "t")
    reading = read_table(spark, place, "t")
    broken = spark.range(0, 100, 1, 4).withColumn("id", F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, place, "t")
    assert read_table(spark, place, "t").count() == 10
    assert len(versions(place, "t")) == 2  # the died job's folder is still there
    replace_table(spark.range(20), place, "t")
    assert read_table(spark, place, "t").count() == 20
    assert reading.count() == 10  # who reads the old table goes on
    assert len(versions(place, "t")) == 2  # of the died job nothing is left
    replace_table(spark.range(30), place, "t")
    assert len(versions(place, "t")) == 2 and read_table(spark, place, "t").count() == 30


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    place = str(tmp_path)
    replace_table(spark.range(10), place, "t")
    replace_table(read_table(spark, place, "t").where("id < 4"), place, "t")
    assert read_table(spark, place, "t").count() == 4
    spark.range(3).write.parquet(table_path(place, "plain"))
    assert current_version(spark, place, "plain") is None and read_table(spark, place, "plain").count() == 3


def test_files_in_key_order(spark, conf, tmp_path):  # noqa: F811
    """A key with half of all rows is cut, and the files follow each other."""
    conf(shuffle__partitions="16", adaptive__coalescePartitions__enabled="false")
    n = F.col("id")
    subs = spark.range(0, 40000, 1, 8).select(
        F.when(n % 2 == 0, "hot").otherwise(F.md5(n.cast("string"))).alias("subscription_sk"),
        F.when(n % 4 < 3, F.lit("2000-01-01")).cast("timestamp_ntz").alias("valid_from"),
        n.cast("string").alias("user_sk"),
    )
    table = replace_table(in_key_order(subs), str(tmp_path), "dim_subscription")
    assert [tuple(r) for r in order_check(table, KEY_ORDER).collect()] == [(0, 0, 40000)]
    sizes = [r["count"] for r in table.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40000 / 16
    unordered = replace_table(subs, str(tmp_path), "unordered")
    files, rows, _ = order_check(unordered, KEY_ORDER).first()
    assert files > 0 and rows > 0


@pytest.fixture(scope="module")
def sources(spark):
    m = models(spark, SF)
    return Sources(**{n: conform(getattr(m.sources, n), n) for n in ("users", "subscriptions", "transactions", "support_tickets", "product_usage")})


@pytest.mark.parametrize("users", ["reference", "one_per_email"])
def test_rows_are_counted_while_building(spark, sources, tmp_path, users):
    counts = {}
    tables = build(spark, sources, str(tmp_path / "wh"), replace(SETTINGS, users=users), counts)
    raw = {n: getattr(sources, n) for n in ("users", "subscriptions", "transactions", "support_tickets", "product_usage")}
    assert {n: counts[n] for n in raw} == {n: df.count() for n, df in raw.items()}
    assert {n: counts[n] for n in TABLES} == {n: tables[n].count() for n in TABLES}
    report = load_report({**raw, "other": spark.range(3)}, known=counts)
    assert {r.table: r.rows for r in report.collect()} == {**{n: counts[n] for n in raw}, "other": 3}
    assert "parquet" not in plan(load_report(raw, known=counts))  # nothing is read again
    assert spark.table("int_product_usage").count() > 0  # views outlive the scratch folder
    repeated = check_tables(spark, tables, str(tmp_path / "wh"))
    stored = read_table(spark, str(tmp_path / "wh"), "repeated_keys")
    assert {r.table for r in stored.collect()} == set(repeated)
    assert ("dim_user" in repeated) is False


def test_counts_of_empty_sources(spark, sources, tmp_path):
    empty = Sources(**{n: getattr(sources, n).where("false") for n in ("users", "subscriptions", "transactions", "support_tickets", "product_usage")})
    counts = {}
    build(spark, empty, str(tmp_path / "wh"), SETTINGS, counts)
    assert all(counts[n] == 0 for n in ("users", "transactions", "fact_transaction", "mart_revenue"))


def test_scratch_folders_are_deleted(spark, sources, tmp_path, monkeypatch):
    place = str(tmp_path / "scratch")
    monkeypatch.setattr(plans, "scratch_folder", lambda spark: place)
    build(spark, sources, str(tmp_path / "wh"), SETTINGS)
    assert not os.path.exists(place)


def test_counted_needs_no_action_of_its_own(spark):
    df, rows = counted(spark.range(7), "seven")
    df.where("id > 3").write.format("noop").mode("overwrite").save()
    assert rows.get["rows"] == 7


def test_repeated_keys_are_json(spark):
    user = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "user_sk string")
    assert {(r.table, r.key, r.n) for r in repeated_keys({"dim_user": user}).collect()} == {
        ("dim_user", '{"user_sk":"a"}', 2), ("dim_user", '{"user_sk":null}', 2)
    }
