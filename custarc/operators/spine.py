"""Calendar and month spines, and date-id lookups against the calendar.

The calendar is one row per day of [start, end), so looking a date up in it is the same as a
range test plus arithmetic on the date. The lookups below use that form: they need no join,
however many date columns a table has.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.functions.temporal import date_key, day_of_week, is_weekend
from custarc.settings import Settings


def _days(start: Column, last: Column) -> Column:
    return F.explode(F.sequence(start, last, F.make_dt_interval(F.lit(1))))


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start to the day before end: (date_day)."""
    return spark.range(1).select(_days(F.lit(start), F.date_sub(F.lit(end), 1)).alias("date_day"))


def date_spine_of(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day between the smallest ``first`` and the largest ``last`` of a table."""
    bounds = df.agg(F.to_date(F.min(first)).alias("lo"), F.to_date(F.max(last)).alias("hi"))
    return bounds.where("lo <= hi").select(_days(F.col("lo"), F.col("hi")).alias("date_day"))


def month_spine(spark: SparkSession, n: int = 12) -> DataFrame:
    """The integers 0..n-1: (months_since_start)."""
    return spark.range(n).select(F.col("id").alias("months_since_start"))


def calendar(days: DataFrame, weekend_days: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Calendar attributes of a table of days (date_day)."""
    d = F.col("date_day")
    return days.select(
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"),
        F.weekofyear(d).cast("long").alias("week"),
        F.dayofmonth(d).cast("long").alias("day_of_month"),
        day_of_week(d).cast("long").alias("day_of_week"),
        is_weekend(d, weekend_days).alias("is_weekend"),
    )


def date_id(col: Column, s: Settings) -> Column:
    """Calendar id of a date or timestamp; NULL outside the calendar."""
    day = F.to_date(col)
    return F.when((day >= F.lit(s.spine_start)) & (day < F.lit(s.spine_end)), date_key(day))


def full_date(id_col: Column, s: Settings) -> Column:
    """Calendar day of a date id; NULL when the id is not in the calendar."""
    day = F.try_make_timestamp_ntz(
        F.floor(id_col / 10000).cast("int"),
        (F.floor(id_col / 100) % 100).cast("int"),
        (id_col % 100).cast("int"),
        F.lit(0),
        F.lit(0),
        F.lit(0),
    ).cast("date")
    return F.when((day >= F.lit(s.spine_start)) & (day < F.lit(s.spine_end)), day)


def with_date_ids(df: DataFrame, columns: dict[str, str], s: Settings) -> DataFrame:
    """Add one calendar id per (date column -> id column)."""
    return df.withColumns({out: date_id(F.col(src), s) for src, out in columns.items()})


def with_full_date(df: DataFrame, id_col: str, out: str, s: Settings) -> DataFrame:
    return df.withColumn(out, full_date(F.col(id_col), s))
