"""As-of lookups: for each left row the latest right row of its key that started before it.

The usual plan for this is a range join, or one window over all rows of a key. Here neither is
needed: a left row reads the starts of its key and period only, and the last one before them.

1. Left rows are reduced to their distinct (key, period) pairs, map side first, and put together with the
   right rows by key and period. Of right rows with one start one is kept.
2. One row per (key, period) holds the starts in there as an array; its latest is handed to the key's
   periods after it by a window over them.
3. These rows are joined to the left rows by key and period, a join whose large left side adaptive
   execution can split. A left row takes the latest start of the array that is not after it.

A task holds the right rows of one key and period, or the periods of one key. Left rows compare
themselves with all distinct starts of their key and period, so periods should have few.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custarc.functions.keys import packed_key
from custarc.operators.joins import lookup_left_packed
from custarc.operators.ladder import month_number


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: tuple[str, str],
    at: tuple[str, str],
    values: Sequence[str],
    row_id: Sequence[str],
    period: Callable[[str], Column] = month_number,
    ties: Sequence[str] = (),
) -> DataFrame:
    """``left`` with the ``values`` of the right row of equal key and the latest start not after the
    left row's moment; NULL without one. ``key`` and ``at`` name the (left, right) columns; both moments
    must have one type.

    Of several right rows with one key and start the one with the largest ``ties`` and then ``values``, compared
    in their order with NULL as the least, is taken. Rows with a NULL key or moment match nothing. ``period`` is
    an integer that never falls as moments grow; ``row_id`` names left columns that scatter rows without a key.
    """
    starts = right.select(
        packed_key(F.col(key[1])).alias("_key"), F.col(at[1]).alias("_at"), F.struct(*ties, *values).alias("_value")
    ).where("_at IS NOT NULL")
    asked = left.select(packed_key(F.col(key[0])).alias("_key"), period(at[0]).alias("_period")).distinct()
    moments = (
        starts.withColumn("_period", period("_at"))
        .unionByName(asked, allowMissingColumns=True)
        # Said here, or only one of the readers would say it below the shuffle, and they would not share it.
        .where("_key IS NOT NULL AND _period IS NOT NULL")
        .repartition("_key", "_period")
        .groupBy("_key", "_period", "_at")
        .agg(F.max("_value").alias("_value"))
    )
    start = F.when(F.col("_at").isNotNull(), F.struct("_at", *[F.col("_value").getField(v).alias(v) for v in values]))
    periods = moments.groupBy("_key", "_period").agg(
        F.collect_list(start).alias("_starts"), F.max(F.col("_at").isNull()).alias("_asked")
    )
    before = Window.partitionBy("_key").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        periods.select("_key", "_period", F.array_max("_starts").alias("_latest"))
        .select(
            F.col("_key").alias("_key_r"),
            F.col("_period").alias("_period_r"),
            F.last("_latest", ignorenulls=True).over(before).alias("_carry"),
        )
        .where("_carry IS NOT NULL")
    )
    same = (F.col("_key") == F.col("_key_r")) & (F.col("_period") == F.col("_period_r"))
    carry = F.col("_carry")
    all_starts = F.when(carry.isNull(), F.col("_starts")).otherwise(F.array_append("_starts", carry))
    # Cast, the period is a key of its own: these rows get their own shuffle, without which adaptive execution
    # would not split the left side.
    found = (
        periods.where("_asked")
        .join(carried, same, "left")
        .select("_key", F.col("_period").cast("long").alias("_found_period"), all_starts.alias("_starts"))
        .where(F.size("_starts") > 0)
    )
    rows = left.withColumn("_period", period(at[0]).cast("long"))
    joined = lookup_left_packed(rows, found, key[0], "_key", row_id, also=[("_period", "_found_period")])
    latest = F.array_max(F.filter("_starts", lambda s: s["_at"] <= F.col(at[0])))
    return (
        joined.withColumn("_found", latest)
        .withColumns({v: F.col("_found").getField(v) for v in values})
        .drop("_found", "_starts", "_period")
    )
