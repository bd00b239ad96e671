"""Documents packed into training sequences of several permitted lengths.

Variable-capacity best fit: pieces are taken from the longest to the shortest; each goes into the open
bin that it fills best. Where none has room, a bin of the size with the least cost per token is
opened. At the end every bin shrinks to the smallest permitted length that holds its contents. All
permitted lengths are optimised together: this is done once for every largest size that may be opened,
and the plan of least total cost is kept.

Documents are dealt into groups of about GROUP tokens by a hash, and each group is packed by one task.
So a task holds a bounded number of tokens, and at most a few bins per group stay half empty.

Lengths are numbers of words (runs without ASCII blanks); another length column can be given. A
document longer than the largest size is cut into pieces of that size. Null, empty and blank texts
have one piece of length 0 and no bin. Rows equal in id and text are packed one by one and dealt apart;
ties in length go by id hash, piece and copy. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custarc.llm.common import row_hashes, stored

SIZES = (512, 1024, 2048, 4096)
OVERHEAD = 32  # what a sequence costs beside its tokens
GROUP = 1 << 22
BINS = 1 << 32  # bin numbers per group


def default_costs(sizes: tuple[int, ...]) -> dict[int, float]:
    return {s: float(s + OVERHEAD) for s in sizes}


def best_fit(lengths: list[int], costs: dict[int, float], largest: int) -> tuple[list[int], list[int]]:
    """Bins of lengths given in falling order, and the sizes of the bins after shrinking. Sizes up to
    ``largest`` are opened, larger ones only for a length that needs them."""
    sizes = sorted(costs)
    opened = {}
    for k, need in enumerate(sizes):
        fitting = [s for s in sizes[k:] if s <= largest] or [need]
        opened[need] = min(fitting, key=lambda s: (costs[s] / s, s))
    rooms: list[int] = []  # the different rooms of open bins, sorted
    bins_with: dict[int, list[int]] = {}
    fill, chosen = [], []
    for length in lengths:
        k = bisect_left(rooms, length)
        if k < len(rooms):
            room = rooms[k]
            b = bins_with[room].pop()
            if not bins_with[room]:
                del bins_with[room], rooms[k]
        else:
            room = opened[sizes[bisect_left(sizes, length)]]
            b = len(fill)
            fill.append(0)
        chosen.append(b)
        fill[b] += length
        left = room - length
        if left:
            if left in bins_with:
                bins_with[left].append(b)
            else:
                bins_with[left] = [b]
                insort(rooms, left)
    return chosen, [sizes[bisect_left(sizes, f)] for f in fill]


def least_cost(lengths: list[int], costs: dict[int, float]) -> tuple[list[int], list[int]]:
    plans = [best_fit(lengths, costs, largest) for largest in sorted(costs)]
    return min(plans, key=lambda plan: sum(costs[s] for s in plan[1]))


def _pack(table: pa.Table, costs: dict[int, float]) -> pa.Table:
    """Add bin, size and the place inside the bin to one group of pieces."""
    table = table.sort_by([("n_tokens", "descending"), ("h1", "ascending"), ("h2", "ascending"), ("piece", "ascending"), ("copy", "ascending")])
    lengths = table["n_tokens"].to_pylist()
    chosen, sizes = least_cost(lengths, costs)
    used = [0] * len(sizes)
    at = []
    for b, n in zip(chosen, lengths):
        at.append(used[b])
        used[b] += n
    group = table["group"][0].as_py()
    bins = np.array(chosen, np.int64)
    return (
        table.select(["doc_id", "piece", "start", "n_tokens"])
        .append_column("bin_id", pa.array(bins + group * BINS))
        .append_column("capacity", pa.array(np.array(sizes, np.int32)[bins]))
        .append_column("at", pa.array(at, pa.int64()))
    )


_WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0))


def sequences(docs: DataFrame, packed: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(bin_id, capacity, n_tokens, words, bounds): the training sequences that ``pack`` planned for the
    words of ``docs``. ``words`` holds the words of a sequence in order, at most ``capacity`` of them;
    ``bounds`` its pieces in order as (at, doc_id, start), ``at`` being their first place, so that attention
    can be kept inside a document.

    Pieces of one document id, number and length take each other's places. Lengths other than numbers
    of words can't be used.
    """
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD), F.lit(0))
    most = F.lit(int(packed.agg(F.max("n_tokens")).first()[0] or 1))
    texts = docs.select(F.col(key).alias("doc_id"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.size("w") - 1, most)
    cut = texts.select("doc_id", "w", F.posexplode(starts).alias("piece", "from")).select(
        "doc_id", F.col("piece").cast("long").alias("piece"), F.slice("w", F.col("from") + 1, most).alias("words")
    )
    one = ["doc_id", "piece", "n_tokens"]
    # Equal pieces are counted first; a window then sees the different ones of a key only.
    parts = cut.withColumn("n_tokens", F.size("words").cast("long")).groupBy(*one, "words").agg(F.count("*").alias("n"))
    before = W.partitionBy(*one).orderBy(F.xxhash64("words"), "words").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = parts.withColumn("copy", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("n"))))
    # Places are numbered inside their packing group, and the groups of a key one after the other.
    places = packed.where("n_tokens > 0").withColumn("group", F.shiftright("bin_id", 32))
    counts = places.groupBy(*one, "group").agg(F.count("*").alias("n"))
    of_key = W.partitionBy(*one).orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(x).alias(f"o_{x}") for x in (*one, "group")], F.coalesce(F.sum("n").over(of_key), F.lit(0)).alias("offset")
    )
    same = F.lit(True)
    for x in (*one, "group"):
        same = same & F.col(x).eqNullSafe(F.col(f"o_{x}"))
    inside = F.row_number().over(W.partitionBy(*one, "group").orderBy("bin_id", "at"))
    numbered = places.withColumn("number", inside).join(offsets, same).select(
        *[F.col(x).alias(f"p_{x}") for x in one], (F.col("offset") + F.col("number")).alias("p_copy"), "bin_id", "capacity", "at", "start"
    )
    on = F.col("copy") == F.col("p_copy")
    for x in one:
        on = on & F.col(x).eqNullSafe(F.col(f"p_{x}"))
    # A sequence holds at most its capacity, so its pieces are few.
    whole = parts.join(numbered, on).groupBy("bin_id", "capacity").agg(
        F.sort_array(F.collect_list(F.struct("at", "doc_id", "start", "words"))).alias("pieces")
    )
    return whole.select(
        "bin_id",
        "capacity",
        F.aggregate("pieces", F.lit(0), lambda n, p: n + F.size(p.words)).alias("n_tokens"),
        F.flatten(F.transform("pieces", lambda p: p.words)).alias("words"),
        F.transform("pieces", lambda p: F.struct(p["at"].alias("at"), p["doc_id"].alias("doc_id"), p["start"].alias("start"))).alias("bounds"),
    )


def pack(
    docs: DataFrame, costs: dict[int, float] | None = None, text: str = "text", key: str = "doc_id",
    length: Column | None = None, group: int = GROUP,
) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bin_id, capacity, at): one row per piece of a document.
    ``start`` is its first token in the document, ``at`` its first place in the bin."""
    costs = costs or default_costs(SIZES)
    most = max(costs)
    total = F.coalesce(length if length is not None else word_count(F.col(text)), F.lit(0)).cast("long")
    # Rows equal in id and text are counted, then numbered: copies spread over all groups.
    rows = docs.select(F.col(key).alias("doc_id"), *row_hashes(key, text), total.alias("total"))
    equal = rows.groupBy("doc_id", "h1", "h2", "total").agg(F.count("*").alias("copies"))
    small = stored(equal.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies"), "lengths")
    tokens = small.agg(F.sum("total")).first()[0] or 0
    groups = max(1, math.ceil(tokens / group))
    pieces = (
        small.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("total") / most) - 1, F.lit(0)))))
        .withColumn("start", F.col("piece") * most)
        .withColumn("n_tokens", F.least(F.col("total") - F.col("start"), F.lit(most)))
        .withColumn("group", F.pmod(F.xxhash64("h1", "h2", "piece", "copy"), F.lit(groups)))
    )
    id_type = small.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece long, start long, n_tokens long, bin_id long, capacity int, at long"
    packed = pieces.where("n_tokens > 0").groupBy("group").applyInArrow(lambda t: _pack(t, costs), schema)
    empty = pieces.where("n_tokens <= 0").select(
        "doc_id", "piece", "start", "n_tokens", *[F.lit(None).cast(t).alias(n) for n, t in (("bin_id", "long"), ("capacity", "int"), ("at", "long"))]
    )
    return packed.unionByName(empty)
