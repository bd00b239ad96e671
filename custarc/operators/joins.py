"""Left lookups that stay balanced when many rows have no key.

Rows with a NULL key match nothing, yet a plain left join sends them all to the same task.
Here they get a scattered stand-in key instead. A large group with a real key is split by
adaptive execution, which can cut the left side of a left join at any point; no lookup in
this package asks for a broadcast, so Spark broadcasts only what it has measured as small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.functions.keys import packed_key, unpacked_key

_SLOTS = 1 << 14
_FILTER_BITS = 24


def _stand_in(row_id: Sequence[str]) -> Column:
    slot = F.pmod(F.xxhash64(*row_id), F.lit(_SLOTS))
    return F.concat(F.lit("\0"), slot.cast("string"))


def _scattered(key: Column, row_id: Sequence[str]) -> Column:
    return F.coalesce(key, _stand_in(row_id))


def lookup_left(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    row_id: Sequence[str],
    also: Sequence[tuple[str, str]] = (),
    when: Column | None = None,
) -> DataFrame:
    """Left join on a text key; the right key columns are dropped.

    ``row_id`` names left columns that scatter the rows without a key, ``also`` further equal
    (left, right) pairs, ``when`` a condition on the left row: rows failing it are kept
    unmatched. Column names other than the right keys must not occur on both sides.
    """
    renamed = {right_key: "_right_key"} | {r: f"_right_{i}" for i, (_, r) in enumerate(also)}
    # The flag is all that is shuffled of a key that nobody reads behind the join.
    match = (F.col("_left_key") == F.col("_right_key")) & F.col("_has_key")
    for i, (l, _) in enumerate(also):
        match = match & (F.col(l) == F.col(f"_right_{i}"))
    if when is not None:
        match = match & when
    return (
        left.withColumns({"_left_key": _scattered(F.col(left_key), row_id), "_has_key": F.col(left_key).isNotNull()})
        .join(right.withColumnsRenamed(renamed), match, "left")
        .drop("_left_key", "_has_key", *renamed.values())
    )


def lookup_left_packed(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    row_id: Sequence[str],
    also: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """``lookup_left`` on a surrogate key. ``right_key`` holds packed keys; the left one is text, and packed
    for the shuffle only, where it takes the place of the text."""
    renamed = {right_key: "_right_key"} | {r: f"_right_{i}" for i, (_, r) in enumerate(also)}
    # A stand-in is shorter than any packed key.
    match = F.col("_left_key") == F.col("_right_key")
    for i, (l, _) in enumerate(also):
        match = match & (F.col(l) == F.col(f"_right_{i}"))
    key = F.coalesce(packed_key(F.col(left_key)), _stand_in(row_id).cast("binary"))
    joined = (
        left.withColumn("_left_key", key)
        .drop(left_key)
        .join(right.withColumnsRenamed(renamed), match, "left")
        .drop(*renamed.values())
    )
    text = F.when(F.octet_length("_left_key") >= 16, unpacked_key(F.col("_left_key"))).alias(left_key)
    others = [c for c in joined.columns if c not in left.columns and c != "_left_key"]
    return joined.select(*[text if c == left_key else F.col(c) for c in left.columns], *others)


def with_user_sk(
    df: DataFrame, email_col: str, dim_user: DataFrame, row_id: Sequence[str]
) -> DataFrame:
    """User key by e-mail; a row is repeated for every user that has its e-mail."""
    return lookup_left(df, dim_user.select("email", "user_sk"), email_col, "email", row_id)


def left_join_when(
    left: DataFrame, right: DataFrame, keys: Sequence[str], condition: Column
) -> DataFrame:
    """Left join on equal ``keys`` and a condition on the left row; left rows that fail the
    condition (or for which it is NULL) stay, unmatched."""
    renamed = {k: f"_right_{k}" for k in keys}
    match = condition
    for k in keys:
        match = match & (F.col(k) == F.col(renamed[k]))
    return left.join(right.withColumnsRenamed(renamed), match, "left").drop(*renamed.values())


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << _FILTER_BITS)).cast("int")


def _bit_filter(keys: DataFrame, key: str) -> Column:
    """2^24 bits, 64 to a long: those of the keys' hashes are set. The value of a subquery, 2 MB for any number of keys."""
    at = _bit(F.col(key))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63))
    found = keys.select(F.shiftright(at, 6).cast("long").alias("_word"), one.alias("_bits"))
    none = keys.sparkSession.range(1 << (_FILTER_BITS - 6)).select(F.col("id"), F.lit(0).cast("long"))
    words = found.union(none).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return words.select(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).getField("_bits")).scalar()


def left_join_few(left: DataFrame, right: DataFrame, key: str, condition: Column) -> DataFrame:
    """``left_join_when`` on one non-null text key where few left rows find a match: rows that a bit filter of the
    right keys excludes are not shuffled. ``right`` is read twice."""
    word = F.get(_bit_filter(right, key), F.shiftright(_bit(F.col(key)), 6))
    is_set = F.call_function("shiftright", word, _bit(F.col(key)).bitwiseAND(63)).bitwiseAND(1) == 1
    may = is_set & F.coalesce(condition, F.lit(False))
    matched = left_join_when(left.where(may), right, [key], condition)
    return matched.unionByName(left.where(~may), allowMissingColumns=True)
