"""Documents that share passages with benchmark items, found by winnowing.

Of every ``SPAN - GRAM + 1`` consecutive word GRAMs the one with the smallest hash is a
fingerprint, so any ``SPAN`` words that two texts share hold a fingerprint of both. Fingerprints of
documents meet those of the benchmark by join; each hit is extended word by word to both sides, and
counts if it reaches ``SPAN`` words. An item shorter than SPAN words is one window of its own
length: all runs of that length in the documents are its fingerprints.

Before the join, fingerprints of documents pass a bit filter of the benchmark's: 2^FILTER_BITS bits,
whatever the size of the benchmark. It only saves shuffling; every hit is compared word by word.

A null or empty text has no words; such a document is clean and such an item has no window. Items
of equal id count once; an item without id is listed as an empty id. Copies of documents are judged
one by one. Without a benchmark every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custarc.llm.common import bit_filter, passes, row_hashes, stored, unpacked, whole_rows
from custarc.llm.words import ALNUM, as_bytes, hashed, lists, ngrams, small_batches

SPAN, GRAM = 13, 8
FILTER_BITS = 24
_CANDIDATES = "gram array<int>, hash array<long>, at array<int>, lead array<int>, context array<string>"


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest gram (the last one of equals) of every window."""
    if len(grams) < window:
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, window)
    starts = np.arange(len(view))
    return np.unique(starts + window - 1 - view[:, ::-1].argmin(axis=1))


def _of_text(words: list[bytes], hashes: np.ndarray, grams: list[tuple[int, int]], found: np.ndarray | None):
    """Fingerprints (gram, hash, at, lead, context) of a text for each (gram, window): the words
    around a fingerprint, of which the first ``lead`` stand before it."""
    out = []
    for gram, window in grams:
        values = ngrams(hashes, gram)
        at = winnow(values, window)
        if found is not None and len(at):
            at = at[passes(found, values[at])]
        side = window - 1
        for p in at.tolist():
            first = max(0, p - side)
            context = b" ".join(words[first : p + gram + side]).decode("utf-8", "replace")
            out.append((gram, values[p], p, p - first, context))
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch], grams_of, found, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_batches(whole):
            counts, rows = [], []
            for _, words, hashes in hashed(as_bytes(batch["text"]), ALNUM):
                counts.append(len(words))
                rows.append(_of_text(words, hashes, grams_of(len(words)), found))
            parts = [[np.array([r[k] for r in row], t) for row in rows] for k, t in ((0, np.int32), (1, np.uint64), (2, np.int32), (3, np.int32))]
            columns = [batch[n] for n in batch.schema.names if n != "text"]
            columns += [pa.array(counts, pa.int64()), lists(parts[0], pa.int32()), lists(parts[1], pa.int64())]
            columns += [lists(parts[2], pa.int32()), lists(parts[3], pa.int32())]
            columns.append(pa.array([[r[4] for r in row] for row in rows], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, names=schema)


def _with_fingerprints(df: DataFrame, grams_of, found=None) -> DataFrame:
    keys = [f for f in df.schema.fields if f.name != "text"]
    names = [*[f.name for f in keys], "n_words", "gram", "hash", "at", "lead", "context"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keys], "n_words long", _CANDIDATES])
    return df.mapInArrow(lambda batches: _fingerprints(batches, grams_of, found and found.value, names), schema)


def _item_grams(n_words: int) -> list[tuple[int, int]]:
    if n_words >= SPAN:
        return [(GRAM, SPAN - GRAM + 1)]
    return [(n_words, 1)] if n_words else []


def _exploded(df: DataFrame, *keys: str) -> DataFrame:
    zipped = F.arrays_zip("gram", "hash", "at", "lead", "context")
    return df.select(*keys, "n_words", F.explode(zipped).alias("f")).select(*keys, "n_words", "f.*")


@F.pandas_udf(T.StructType([T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType())]))
def _extension(
    ours: pd.Series, our_lead: pd.Series, theirs: pd.Series, their_lead: pd.Series, gram: pd.Series
) -> pd.DataFrame:
    """How many words agree on either side of a shared gram; -1 where the gram itself differs."""
    out = []
    for a, i, b, j, n in zip(ours, our_lead, theirs, their_lead, gram):
        a, b = a.split(" "), b.split(" ")
        if a[i : i + n] != b[j : j + n]:
            out.append((-1, -1))
            continue
        left = 0
        while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
            left += 1
        right = 0
        while i + n + right < len(a) and j + n + right < len(b) and a[i + n + right] == b[j + n + right]:
            right += 1
        out.append((left, right))
    return pd.DataFrame(out, columns=["left", "right"])


def judge(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
    item_text: str = "text", item_key: str = "item_id",
) -> DataFrame:
    """(doc_id, h1, h2, n_words, n_hit, items, contaminated): one row per document; ``items`` lists
    the ids of the items with a window in it as sorted strings. Contaminated means that hit words
    are at least a twentieth of all words."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    theirs = stored(_exploded(_with_fingerprints(items, _item_grams), "item"), "item_fingerprints")
    # At most one length per row, and fewer than SPAN of them.
    shorts = sorted(r[0] for r in theirs.where(F.col("n_words") < SPAN).select("gram").distinct().collect())
    found = spark.sparkContext.broadcast(bit_filter(theirs, "hash", FILTER_BITS))

    def grams_of(n_words: int) -> list[tuple[int, int]]:
        return [(GRAM, SPAN - GRAM + 1), *[(n, 1) for n in shorts]]

    plain = docs.select(F.col(key).alias("doc_id"), *row_hashes(key, text), F.col(text).alias("text"))
    judged = _with_fingerprints(plain, grams_of, found).withColumn("uid", F.monotonically_increasing_id())
    ours = stored(judged, "document_fingerprints")
    # Items that agree around a fingerprint are compared once.
    window = F.when(F.col("n_words") < SPAN, F.col("n_words")).otherwise(F.lit(SPAN)).alias("window")
    alike = theirs.groupBy("gram", "hash", window, F.col("lead").alias("item_lead"), F.col("context").alias("item_context")).agg(
        F.collect_set("item").alias("items")
    )
    extended = (
        _exploded(ours, "uid")
        .drop("n_words")
        .join(alike, ["gram", "hash"])
        .withColumn("e", _extension("context", "lead", "item_context", "item_lead", "gram"))
        .where((F.col("e.left") >= 0) & (F.col("e.left") + F.col("gram") + F.col("e.right") >= F.col("window")))
    )
    spans = extended.groupBy("uid").agg(
        F.collect_set(
            F.struct((F.col("at") - F.col("e.left")).alias("from"), (F.col("at") + F.col("gram") + F.col("e.right") - 1).alias("to"))
        ).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["from"], s["to"])))))
    hits = spans.select("uid", covered.cast("long").alias("n_hit"), "items")
    joined = ours.select("uid", "doc_id", "h1", "h2", "n_words").join(hits, "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "h1", "h2", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = judge(docs, benchmark, text, key).where("contaminated").select("h1", "h2").distinct()
    return unpacked(whole_rows(docs, key, text).join(bad, ["h1", "h2"], "left_anti"), docs.columns)
