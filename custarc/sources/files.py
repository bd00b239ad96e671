"""Loading a folder of raw files."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.sources.csv_records import read_records
from custarc.sources.raw import COLUMNS

log = logging.getLogger(__name__)


# What may separate the columns of a CSV file.
DELIMITERS = (",", ";", "\t", "|")


def _matching(spark: SparkSession, folder: str, suffix: str) -> dict[str, tuple[str, int]]:
    """Lower-cased stem -> (path, bytes of the largest file) of the files, or folders of part files,
    named *.suffix."""
    root = folder.rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    # Only paths are read. A table is the first level below the folder, one row per table here.
    name = F.regexp_extract("path", rf"/([^/]+\.{suffix})(?:/|$)", 1)
    found = listed.select(name.alias("name"), "length").where("name != ''").groupBy("name").agg(F.max("length").alias("length"))
    return {
        r["name"][: -len(suffix) - 1].lower(): (f"{root}/{r['name']}", r["length"])
        for r in sorted(found.collect(), key=lambda r: r["name"])
    }


def delimiter_of(spark: SparkSession, path: str) -> str:
    """The separator that occurs most often in the first line, a comma if none does."""
    first = spark.read.text(path).first()
    header = first[0] if first else ""
    return max(DELIMITERS, key=header.count)


# Options that leave the records of a file as ``records`` finds them.
_PARALLEL = {"sep", "mode", "nullValue", "emptyValue", "nanValue", "dateFormat", "timestampFormat"}


def _read_csv(spark: SparkSession, name: str, path: str, size: int, **options: str) -> DataFrame:
    """Quotes are doubled inside quotes, and a quoted value may span lines. Spark reads such a file
    in one task; one that is larger than a split is put together from its splits instead, unless
    options say otherwise. ``multiLine=False`` splits files that have no line breaks in values."""
    # Known sources stay text, to be cast by name; an unknown table has its types inferred,
    # which costs one more pass over that file.
    infer = name not in COLUMNS
    defaults = {"header": True, "inferSchema": infer, "quote": '"', "escape": '"', "multiLine": True}
    if "sep" not in options:
        defaults["sep"] = delimiter_of(spark, path)
    # As a number of bytes, whatever unit it is set in.
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if size > split and _PARALLEL >= options.keys() and len(sep := options.get("sep", defaults.get("sep"))) == 1:
        return read_records(spark, path, sep, infer, **{k: v for k, v in options.items() if k != "sep"})
    return spark.read.options(**{**defaults, **options}).csv(path)


def _read_parquet(spark: SparkSession, name: str, path: str, size: int, **options: str) -> DataFrame:
    return spark.read.options(**options).parquet(path)


_READERS: dict[str, Callable[..., DataFrame]] = {"csv": _read_csv, "parquet": _read_parquet}


def load_raw(
    spark: SparkSession,
    folder: str,
    formats: tuple[str, ...] = ("csv", "parquet"),
    **options: str,
) -> dict[str, DataFrame]:
    """One lazy table per file, named by its lower-cased stem. Later formats win on equal
    names, so Parquet replaces CSV; a format without files is skipped with a warning.
    ``options`` are those of Spark's CSV reader, such as ``sep``."""
    tables: dict[str, DataFrame] = {}
    for fmt in formats:
        found = _matching(spark, folder, fmt)
        if not found:
            log.warning("no *.%s file in %s", fmt, folder)
        for name, (path, size) in found.items():
            tables[name] = _READERS[fmt](spark, name, path, size, **(options if fmt == "csv" else {}))
    return tables


def save_raw(spark: SparkSession, tables: dict[str, DataFrame], schema: str = "raw") -> None:
    """Create or replace each table as ``schema.name`` in the session catalog."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{schema}.{name}")
