"""What the corpus operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.sinks.tables import scratch_folder, write_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Space, tab, line feed, vertical tab, form feed and carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: what follows starts
    from files that outlive any executor."""
    return write_table(df, scratch_folder(df.sparkSession), name)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def row_hashes(key: str, text: str) -> list[Column]:
    """h1, h2: 128 bits over key and text that name a row, up to copies equal in both, which every
    operator treats alike. Missing keys and texts hash like values of their own."""
    row = [F.col(key), F.col(text)]
    return [F.xxhash64(*row).alias("h1"), F.xxhash64(F.lit(1), *row).alias("h2")]


def whole_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, h1, h2): each row packed as a struct, so that no other column can clash with an
    operator's own."""
    return docs.select(F.struct("*").alias("row"), *row_hashes(key, text))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def bit_filter(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of 2^bits slots a column of 64-bit hashes falls into, one bit per slot: what reaches
    the driver is 2^bits / 8 bytes at most, however many hashes there are. A value whose slot is
    clear is not among the hashes; one whose slot is set must be looked up."""
    slot = F.col(column).bitwiseAND((1 << bits) - 1)
    words = (
        hashes.select(slot.alias("slot"))
        .selectExpr("shiftright(slot, 6) AS word", "shiftleft(1L, cast(slot & 63 AS int)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bit"))
        .toPandas()
    )
    found = np.zeros(1 << (bits - 6), np.uint64)
    found[words["word"].to_numpy(np.int64)] = words["bit"].to_numpy(np.int64).view(np.uint64)
    return found


def passes(found: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which 64-bit values (uint64) have their slot set in a bit_filter."""
    slot = values & np.uint64(len(found) * 64 - 1)
    return (found[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
