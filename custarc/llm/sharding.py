"""Contiguous shards of nearly equal bytes, cut from global prefix sums.

Documents are put in order by range partitioning (id, then a hash of the text). Each partition's
total is summed on its own; the running sum over those totals - one row per partition - places
every partition, a running sum inside the partition places every document, and a document goes
to the shard in which its first byte falls.

Null text has no bytes, so its size is the fixed overhead. Documents equal in id and text are
numbered first, and that number takes part in the order, so any number of copies can be spread.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custarc.llm.common import stored

ORDER = ["doc_id", "hash", "size", "text_crc32", "copy"]


def byte_size(text: Column, overhead: int) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead


def _narrow(docs: DataFrame, text: str, key: str, overhead: int) -> DataFrame:
    """One small row per document; equal ones get a running number."""
    value = F.coalesce(F.col(text), F.lit(""))
    small = docs.select(
        F.col(key).alias("doc_id"),
        byte_size(F.col(text), overhead).alias("size"),
        F.crc32(F.encode(value, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
    )
    # Counted before they are numbered: copies meet as one row with a count.
    equal = small.groupBy("doc_id", "size", "text_crc32", "hash").agg(F.count("*").alias("copies"))
    return equal.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def assign_shards(
    docs: DataFrame, shards: int = 24, overhead: int = 8, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(doc_id, size, text_crc32, hash, start, shard, slot): one row per document."""
    spark = docs.sparkSession
    small = stored(_narrow(docs, text, key, overhead), "sizes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        small.repartitionByRange(parts, *ORDER).withColumn("part", F.spark_partition_id()), "ranges"
    )
    # One row per partition, so the single window that follows has a bounded input.
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_start"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("part_row"),
        F.sum("bytes").over(W.partitionBy()).alias("all_bytes"),
    )
    inside = W.partitionBy("part").orderBy(*ORDER)
    earlier = inside.rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        placed.withColumns(
            {
                "in_part": F.coalesce(F.sum("size").over(earlier), F.lit(0)),
                "row_in_part": F.row_number().over(inside) - 1,
            }
        )
        .join(F.broadcast(offsets), "part")  # one row per partition
        .withColumns(
            {"start": F.col("part_start") + F.col("in_part"), "rank": F.col("part_row") + F.col("row_in_part")}
        )
        # Whole numbers throughout: a decimal quotient is rounded before it can be cut.
        .withColumn("shard", F.expr(f"int(cast(start AS decimal(38,0)) * {int(shards)} div all_bytes)"))
    )
    cut = stored(ranked.select(*ORDER, "start", "rank", "shard"), "shards")
    first = cut.groupBy("shard").agg(F.min("rank").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "hash", "start", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 24, text: str = "text", key: str = "doc_id") -> None:
    """Write ``docs`` as Parquet, one folder shard=k per shard, in slot order within files.

    Documents equal in key and text are interchangeable, so each takes one of their places.
    """
    places = assign_shards(docs, shards, text=text, key=key)
    same = ["doc_id", "hash"]
    number = lambda df, *order: df.withColumn("n", F.row_number().over(W.partitionBy(*same).orderBy(*order)))
    rows = number(
        docs.select(F.struct("*").alias("row"), F.col(key).alias("doc_id"), F.xxhash64(text).alias("hash")), "hash"
    )
    at = number(places.select(*same, "shard", "slot"), "shard", "slot")
    on = rows.doc_id.eqNullSafe(at.doc_id) & (rows.hash == at.hash) & (rows.n == at.n)
    out = rows.join(at, on).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns], at.shard.alias("shard"), at.slot.alias("slot")
    )
    # By range and not by shard: a shard may be far larger than what one task should write.
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
