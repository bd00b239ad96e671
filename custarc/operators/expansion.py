"""Turning a period into one row per month without a cross join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.functions.temporal import add_months_ts, month_bit, months_crossed
from custarc.operators.ladder import months_seen


def expand_months(df: DataFrame, start: Column, end: Column, max_n: int = 12) -> DataFrame:
    """One row per month 0 .. min(max_n, months crossed) - 1 in months_since_start.

    A period that crosses no month boundary, or has a NULL end, gives no row.
    """
    # The filter comes first: ``least`` skips a NULL argument.
    last = F.least(F.lit(max_n), F.col("_n")) - 1
    return (
        df.withColumn("_n", months_crossed(start, end))
        .where("_n > 0")
        .withColumn("months_since_start", F.explode(F.sequence(F.lit(0), last)))
        .drop("_n")
    )


def month_counts(months: Column, copies: Column, max_n: int) -> list[Column]:
    """Per month offset, an aggregate counting the copies that reach it.

    The array of these sums stands for all expanded rows of a key: joining it multiplies
    nothing, and ``each_month`` unrolls it to at most ``max_n`` weighted rows.
    """
    return [F.sum(F.when(months > m, copies).otherwise(F.lit(0))) for m in range(max_n)]


def at_least_once(counts: Column) -> Column:
    """The counts of a row that is expanded; a row without months has offset 0, once."""
    return F.when(counts[0] > 0, counts).otherwise(F.array(F.lit(1).cast("long")))


def each_month(df: DataFrame, months: str, at: str, weight: str) -> DataFrame:
    """One row per month offset that has a count, ``at`` moved by it, ``weight`` times the count."""
    exploded = df.select("*", F.posexplode(months).alias("_month", "_in_month")).drop(months)
    moved = {at: add_months_ts(F.col(at), F.col("_month")), weight: F.col(weight) * F.col("_in_month")}
    return exploded.where("_in_month > 0").withColumns(moved).drop("_month", "_in_month")


def _as_text(keys: Sequence[str]) -> Column:
    """Text columns as one text that differs where any of them does; ``_from_text`` reads them back."""
    escaped = [F.replace(F.replace(F.col(k), F.lit("~"), F.lit("~0")), F.lit("|"), F.lit("~1")) for k in keys]
    return F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), e), F.lit("")) for e in escaped])


def _from_text(text: Column, keys: Sequence[str]) -> list[Column]:
    parts = [F.split_part(text, F.lit("|"), F.lit(i + 1)) for i in range(len(keys))]
    plain = [F.replace(F.replace(F.substring(p, 2, 2**31 - 1), F.lit("~1"), F.lit("|")), F.lit("~0"), F.lit("~")) for p in parts]
    return [F.when(p != "", v).alias(k) for p, v, k in zip(parts, plain, keys)]


def distinct_by_month(
    df: DataFrame, of: str, at: str, keys: Sequence[str], month: str, out: str, months: str | None = None
) -> DataFrame:
    """Distinct non-null values of ``of`` per month number of ``at`` and the text columns ``keys``, where there are any.
    With ``months`` a row stands for those of ``at`` plus m months where element m of that array is above 0.

    The months of a value are one integer, so a value that occurs in many months is shuffled once; the keys
    are shuffled as one text.
    """
    known, bit = df.where(F.col(of).isNotNull()), month_bit(F.col(at))
    if months:
        known, bit = known.where(F.array_max(months) > 0), F.when(F.col(at).isNotNull(), months_seen(at, months))
    per_value = known.select(of, _as_text(keys).alias("_keys"), F.coalesce(bit, F.lit(1)).alias("_bits"))
    seen = per_value.groupBy(of, "_keys").agg(F.bit_or("_bits").alias("_seen"))
    counts = [F.sum(F.shiftright("_seen", m).bitwiseAND(1)) for m in range(13)]
    per_month = seen.groupBy("_keys").agg(F.array(*counts).alias("_n"))
    number = F.nullif(F.col("_m"), F.lit(0)).cast("long").alias(month)
    each = per_month.select("_keys", F.posexplode("_n").alias("_m", out)).where(F.col(out) > 0)
    return each.select(number, *_from_text(F.col("_keys"), keys), out)
