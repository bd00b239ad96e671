"""Exporting marts as CSV files."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.sinks.tables import read_table, table_path

log = logging.getLogger(__name__)

# Rows per file of a whole export; a spreadsheet takes 3,000 at a time.
FILE_ROWS = 1_000_000
EXPORTED = ("mart_engagement", "mart_acquisition", "mart_support", "mart_retention", "mart_revenue")


def _shaped(name: str, dtype: str) -> Column:
    col = F.col(f"`{name}`")
    if dtype in ("float", "double"):
        return F.when(~F.isnan(col), col).alias(name)
    if dtype == "date":
        return F.concat(col.cast("string"), F.lit(" 00:00:00")).alias(name)
    if dtype.startswith("timestamp"):
        return F.left(col.cast("string"), F.lit(19)).alias(name)
    return col


def to_export_shape(df: DataFrame) -> DataFrame:
    """NaN to NULL, dates and timestamps to 'yyyy-MM-dd HH:mm:ss' text."""
    return df.select(*[_shaped(name, dtype) for name, dtype in df.dtypes])


def export_mart(df: DataFrame, path: str, chunk_rows: int = 3000) -> bool:
    """Write CSV files of at most ``chunk_rows`` rows, each with a header, straight from the
    executors. An empty table is skipped with a warning."""
    if df.isEmpty():
        log.warning("nothing to export to %s", path)
        return False
    to_export_shape(df).write.mode("overwrite").options(
        header=True, maxRecordsPerFile=chunk_rows
    ).csv(path)
    return True


def export_marts(
    spark: SparkSession,
    location: str,
    out: str,
    names: Iterable[str] = EXPORTED,
    chunk_rows: int = FILE_ROWS,
) -> dict[str, str]:
    """Export each table stored under ``location``; a missing or failing one does not stop
    the rest. Returns name -> 'exported', 'empty', 'missing' or 'failed'."""
    result = {}
    for name in names:
        path = table_path(location, name)
        try:
            done = export_mart(read_table(spark, location, name), table_path(out, name), chunk_rows)
            result[name] = "exported" if done else "empty"
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            result[name] = "missing" if missing else "failed"
            log.warning("%s is %s, not exported", path, result[name], exc_info=not missing)
        except Exception:
            log.exception("exporting %s failed", name)
            result[name] = "failed"
    return result
