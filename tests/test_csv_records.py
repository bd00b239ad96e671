"""CSV files read by many tasks, against Spark's reader, which takes one per file."""

import csv
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from custarc.sources.csv_records import ends_open, read_records, records
from custarc.sources.files import load_raw
from test_scale import conf  # noqa: F401

VALUES = ["", "plain", "two words", 'say "hi"', '""', '"', "a,b", "line\nbreak", 'quote"\n"break', "\n", " \n\n ", "é,\n\"ü\"", "x" * 70,
          "half 5\" inch", "long\n" * 30, "end\"", "12", "4.5"]


def text_of(rows, newline, sep=","):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline, delimiter=sep)
    writer.writerows(rows)
    return out.getvalue()


def one_task(spark, path, **options):
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True, **options).csv(path)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, newline, split", [(1, "\n", 64), (2, "\r\n", 64), (3, "\n", 17), (4, "\r\n", 300), (5, "\n", 5)])
def test_as_one_task(spark, conf, tmp_path, seed, newline, split):  # noqa: F811
    """Splits of a few bytes end in the middle of quotes, doubled quotes and CR LF."""
    r = random.Random(seed)
    rows = [["id", "a b", "text"]] + [[k, r.choice(VALUES), r.choice(VALUES).replace("\n", newline)] for k in range(60)]
    path = tmp_path / "t.csv"
    path.write_bytes(text_of(rows, newline).encode())
    expected = bag(one_task(spark, str(path)))
    conf(files__maxPartitionBytes=str(split))
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
    found = read_records(spark, str(path), ",", False)
    assert found.columns == ["id", "a b", "text"]
    assert bag(found) == expected and sum(expected.values()) == 60


def test_a_record_over_many_splits_and_stray_quotes(spark, conf, tmp_path):  # noqa: F811
    text = 'k,v\n1,"' + "many\nlines, \"\"quoted\"\"\n" * 200 + '"\n2,5" pipe\n\n3,a"b"c\n4,"x"y\n5,"last\n'
    path = tmp_path / "t.csv"
    path.write_text(text)
    expected = bag(one_task(spark, str(path)).where("k < '5'"))
    conf(files__maxPartitionBytes="50")
    assert bag(read_records(spark, str(path), ",", False).where("k < '5'")) == expected and len(expected) == 4
    assert records(spark, str(path), ",").count() == 6  # the unclosed one is a record


def test_a_folder_of_files_and_inferred_types(spark, conf, tmp_path):  # noqa: F811
    folder = tmp_path / "in" / "numbers.csv"
    folder.mkdir(parents=True)
    for part in range(3):
        rows = [["n", "x", "when", "note"]] + [[part * 100 + k, k / 2, "2024-01-05", "a\nb"] for k in range(40)]
        (folder / f"part-{part}.csv").write_text(text_of(rows, "\n", ";"))
    expected = one_task(spark, str(folder), sep=";", inferSchema=True)
    conf(files__maxPartitionBytes="100")
    found = load_raw(spark, str(tmp_path / "in"), ("csv",))["numbers"]
    assert found.dtypes == expected.dtypes and found.dtypes[0] == ("n", "int")
    assert bag(found) == bag(expected) and found.count() == 120
    assert found.rdd.getNumPartitions() > 3


def test_options_that_change_records_use_sparks_reader(spark, conf, tmp_path):  # noqa: F811
    (tmp_path / "t.csv").write_text("a,b\n" + "1,'x,\ny'\n" * 50)
    conf(files__maxPartitionBytes="40")
    found = load_raw(spark, str(tmp_path), ("csv",), quote="'")["t"]
    assert found.count() == 50 and found.select(F.max("b")).first()[0] == "x,\ny"


def test_ends_open():
    for line, closed in [
        ("a,b", False), ('"a', True), ('a"', False), ('""', False), ('"a""', True),
        ('x,"a",y', False), ('"a",5"', False), ('a,"', True), ('"', True), ('"a"x,"b', True),
    ]:
        assert ends_open(line, False, ",") is closed, line
    assert ends_open('still "" open', True, ",") is True
    assert ends_open('done","again', True, ",") is True
    assert ends_open('done",again', True, ",") is False
    assert ends_open('done"', True, ",") is False
