import csv
import logging
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import SETTINGS, models
from custarc.operators.quality import GRAIN, grain_check, load_report
from custarc.plans.build import TABLES, ExportError, build, run
from custarc.sinks.export import EXPORTED, export_mart, export_marts, to_export_shape
from custarc.sinks.tables import read_table, scratch_folder
from custarc.sources.files import load_raw, save_raw
from custarc.sources.raw import COLUMNS, Sources, conform

SF = "/root/testdata/sf0.001"


def test_load_raw(spark, tmp_path, caplog):
    (tmp_path / "Users.csv").write_text("user_id,email\nu1,\nu2,b@x\n")
    (tmp_path / "Other.csv").write_text("a,b\n1,2.5\n")
    with caplog.at_level(logging.WARNING):
        tables = load_raw(spark, str(tmp_path))
    assert "no *.parquet file" in caplog.text
    assert sorted(tables) == ["other", "users"]
    assert tables["other"].dtypes == [("a", "int"), ("b", "double")]
    assert [tuple(r) for r in tables["users"].collect()] == [("u1", None), ("u2", "b@x")]

    spark.range(5).write.parquet(str(tmp_path / "USERS.parquet"))
    tables = load_raw(spark, str(tmp_path))
    assert tables["users"].count() == 5, "Parquet wins over CSV"
    report = [tuple(r) for r in load_report(tables).collect()]
    assert report == [("raw", "other", 1), ("raw", "users", 5)]
    save_raw(spark, tables)
    assert spark.table("raw.users").count() == 5


def test_conform_checks_and_types(spark):
    with pytest.raises(ValueError, match="missing column"):
        conform(spark.range(1), "users")
    with pytest.raises(ValueError, match="missing source"):
        Sources.of({})
    row = {c: "x" for c in COLUMNS["transactions"]} | {"price": "1.5", "refunded": "True", "quantity": "2"}
    out = conform(spark.createDataFrame([row]), "transactions").first()
    assert (out.price, out.refunded, out.quantity, out.discount) == (1.5, True, 2, None)


def test_numbers_written_with_a_point(spark):
    rows = [{c: v for c in COLUMNS["transactions"]} for v in ("4.0", "4", "", "x", "4.5")]
    found = conform(spark.createDataFrame(rows), "transactions").select("quantity").collect()
    assert [r.quantity for r in found] == [4, 4, None, None, None]
    rows = [{c: v for c in COLUMNS["support_tickets"]} for v in ("4.0", "4", "", "x", "4.5")]
    found = conform(spark.createDataFrame(rows), "support_tickets").select("satisfaction_rating").collect()
    assert [r.satisfaction_rating for r in found] == [4.0, 4.0, None, None, 4.5]


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_quotes_line_breaks_and_separators(spark, tmp_path, sep):
    rows = [["1", 'say "hi"; {"a": 1, "b": "x|y"}', "two\nlines"], ["2", "", "plain\tend"]]
    with open(tmp_path / "t.csv", "w", newline="") as f:
        csv.writer(f, delimiter=sep).writerows([["id", "first", "second"], *rows])
    out = load_raw(spark, str(tmp_path), ("csv",))["t"]
    assert out.columns == ["id", "first", "second"]
    assert [(str(r.id), r.first or "", r.second) for r in out.collect()] == [tuple(r) for r in rows]


def test_export_shape_and_chunks(spark, tmp_path, caplog):
    df = spark.createDataFrame(
        [(date(2025, 1, 2), datetime(2025, 1, 2, 3, 4, 5), float("nan"), 1, "a")] * 7,
        "d date, t timestamp_ntz, x double, n int, s string",
    ).coalesce(1)
    assert tuple(to_export_shape(df).first()) == ("2025-01-02 00:00:00", "2025-01-02 03:04:05", None, 1, "a")
    out = tmp_path / "out"
    assert export_mart(df, str(out), chunk_rows=3)
    files = sorted(out.glob("*.csv"))
    lines = [f.read_text().splitlines() for f in files]
    assert [len(x) - 1 for x in lines] == [3, 3, 1]
    assert all(x[0] == "d,t,x,n,s" for x in lines)
    with caplog.at_level(logging.WARNING):
        assert not export_mart(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_build_and_export(spark, tmp_path):
    m = models(spark, SF)
    names = list(COLUMNS)
    raw = tmp_path / "raw"
    for n in names:
        getattr(m.sources, n).write.parquet(str(raw / f"{n}.parquet"))
    tables = build(spark, Sources.of(load_raw(spark, str(raw))), str(tmp_path / "wh"), SETTINGS)
    assert sorted(tables) == sorted(TABLES)
    for n in TABLES:
        assert read_table(spark, str(tmp_path / "wh"), n).count() == tables[n].count() > 0
    assert spark.table("stg_user").count() == tables["dim_user"].count()
    for n in ("dim_date", "dim_user", "mart_engagement", "mart_retention", "mart_revenue"):
        assert grain_check(tables[n], GRAIN[n]).isEmpty(), n
    known = tables["fact_product_usage"].where("user_sk IS NOT NULL").count()
    assert tables["mart_engagement"].selectExpr("sum(total_events)").first()[0] == known

    result = export_marts(
        spark, str(tmp_path / "wh"), str(tmp_path / "csv"), [*EXPORTED[:2], "mart_nothing"]
    )
    assert result == {EXPORTED[0]: "exported", EXPORTED[1]: "exported", "mart_nothing": "missing"}


def as_csv(df, path):
    """Written by Python's csv module, whole numbers with a point as tools without missing
    integers do."""
    rows = df.collect()
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for r in rows:
            out.writerow(["" if v is None else float(v) if type(v) is int else v for v in r])


def test_run_gives_the_same_from_csv_as_from_parquet(spark, tmp_path, caplog):
    sources = models(spark, SF).sources
    for kind in ("parquet", "csv"):
        (tmp_path / kind).mkdir()
    for name in COLUMNS:
        df = conform(getattr(sources, name), name)
        if name == "support_tickets":
            df = df.withColumn("description", F.concat(F.lit('a "quoted" line,\n'), F.coalesce("description", F.lit(""))))
        df.write.parquet(str(tmp_path / "parquet" / f"{name}.parquet"))
        as_csv(df, tmp_path / "csv" / f"{name}.csv")
    built = {}
    for kind in ("parquet", "csv"):
        with caplog.at_level(logging.INFO):
            built[kind] = run(spark, str(tmp_path / kind), str(tmp_path / f"{kind}_wh"), str(tmp_path / f"{kind}_out"), SETTINGS)
    assert "raw.users: " in caplog.text and "dim_subscription: " in caplog.text
    for name in ("fact_support", "fact_product_usage", *EXPORTED):
        a, b = (built[kind][name].drop("loaded_at") for kind in ("parquet", "csv"))
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, name
        assert name not in EXPORTED or (tmp_path / "csv_out" / name).exists()


def test_run_reports_failures(spark, tmp_path, monkeypatch):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no table"):
        run(spark, str(tmp_path / "none"), str(tmp_path / "wh"))
    sources = models(spark, SF).sources
    for name in COLUMNS:
        conform(getattr(sources, name), name).write.parquet(str(tmp_path / "raw" / f"{name}.parquet"))
    (tmp_path / "out").write_text("a file where the folder should be")
    with pytest.raises(ExportError, match="mart_acquisition") as error:
        run(spark, str(tmp_path / "raw"), str(tmp_path / "wh"), str(tmp_path / "out"), SETTINGS)
    assert set(error.value.result.values()) == {"failed"}


def test_order_inside_files_of_dim_subscription(spark, tmp_path):
    sources = models(spark, SF).sources
    tables = build(spark, sources, str(tmp_path / "wh"), SETTINGS)
    stored = tables["dim_subscription"].select("subscription_sk", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"))
    files = {}
    for r in stored.orderBy("at").collect():
        files.setdefault(r.f, []).append(r.subscription_sk)
    assert files and all(keys == sorted(keys) for keys in files.values())


def test_scratch_folder_follows_the_session(spark):
    assert scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
