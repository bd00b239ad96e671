"""Nearest neighbours by inner product through a few stable random projections.

Vectors get one more component that makes all of them equally long, sqrt(M^2 - |x|^2) with M the
longest length, and 0 for a query: then the largest inner product is the smallest distance. Each
vector is projected on PROJECTIONS Gaussian directions. The projected squared distance of a pair is
its squared distance times a chi-square variable with that many degrees of freedom.

One kd-tree over the projections deals the rows into cells. Its upper splits are fitted on at most SAMPLE
rows; every row is dealt by them, and a cell of more than BLOCK rows falls into several blocks. Each
block has a tree of its own, whose leaves a query takes by growing projected distance, verifying their
vectors with the exact inner product. It stops where the projected distance is so far beyond the k-th
best distance found that a closer vector would have shown up before with probability CONFIDENCE.

A query first searches the FIRST blocks nearest to it. Their k-th best distance then goes through the
same test with the bounds of all other blocks, and the query travels only to those that pass, in one
more round. So a query is sent to as many blocks as the data's structure asks for; vectors without any
structure, where all distances are alike, have no block that could be left out.

Vectors of different lengths have no inner product, so each length is searched on its own. Rows with a
null id, and null, empty or zero vectors or vectors with null or non-finite components take no part. Rows
equal in id and vector count once, as candidates and as queries: a second entry of one id and score in a
list would say nothing and push out another row. An id with several vectors keeps them all, and a query
never finds its own id. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custarc.llm.common import stored

PROJECTIONS = 12
CONFIDENCE = 0.95
LEAF = 128
BLOCK = 16384  # rows searched by one tree
QUERIES = 16384  # queries that meet a block in one task
STEP = 2048  # of which so many are searched at a time
FIRST = 2
SAMPLE = 1 << 17  # rows that the cells are fitted on
SEED = 20


def chi_square_quantile(p: float, degrees: int) -> float:
    """The value that a chi-square variable stays below with probability p."""

    def below(x: float) -> float:
        # Series of the regularised lower incomplete gamma function.
        a, half = degrees / 2, x / 2
        term = total = 1 / a
        k = a
        while term > total * 1e-14:
            k += 1
            term *= half / k
            total += term
        return total * math.exp(a * math.log(half) - half - math.lgamma(a))

    low, high = 1e-9, 10.0 * degrees + 100
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def directions(dimension: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimension + 1, PROJECTIONS))


def leaves_of(points: np.ndarray) -> list[np.ndarray]:
    """Leaves of a kd-tree: row numbers, split at the median of the widest dimension."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        part = points[rows]
        wide = np.argmax(part.max(axis=0) - part.min(axis=0))
        order = np.argpartition(part[:, wide], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def cells_of(points: np.ndarray, count: int) -> list[tuple[int, float]]:
    """Splits (dimension, value) of a kd-tree with ``count`` (a power of two) cells, as a heap: the
    children of entry k are 2 k + 1 and 2 k + 2, smaller values go left."""
    splits: list[tuple[int, float]] = []
    level = [points]
    while len(splits) < count - 1:
        below = []
        for part in level:
            wide = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(part) else 0
            middle = float(np.median(part[:, wide])) if len(part) else 0.0
            splits.append((wide, middle))
            left = part[:, wide] < middle
            below += [part[left], part[~left]]
        level = below
    return splits


def cell_numbers(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    if not splits:
        return at
    wide, middle = np.array([w for w, _ in splits]), np.array([m for _, m in splits])
    rows = np.arange(len(points))
    for _ in range((len(splits) + 1).bit_length() - 1):
        at = 2 * at + 1 + (points[rows, wide[at]] >= middle[at])
    return at - len(splits)


def away_from(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances between points and boxes."""
    away = np.zeros((len(at), len(low)))
    for d in range(at.shape[1]):
        gap = np.maximum(low[:, d] - at[:, d, None], at[:, d, None] - high[:, d])
        away += np.maximum(gap, 0) ** 2
    return away


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The projections of rows."""
    lift = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, lift]) @ directions(vectors.shape[1])


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, longest: float, k: int, known: np.ndarray | None = None
):
    """For each query its k best rows of a block as (ids, scores), -inf where there are fewer. ``known``
    are scores that k rows elsewhere reach; what scores less is not looked for."""
    axes = directions(vectors.shape[1])
    points = lifted(vectors, longest)
    leaves = leaves_of(points)
    low = np.stack([points[r].min(axis=0) for r in leaves])
    high = np.stack([points[r].max(axis=0) for r in leaves])
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    best = np.full((len(queries), k), -np.inf)
    for part in range(0, len(queries), STEP):
        these = slice(part, part + STEP)
        away = away_from(queries[these] @ axes[:-1], low, high)
        floor = np.full(len(away), -np.inf) if known is None else known[these]
        _search(ids, vectors, query_ids[these], queries[these], longest, leaves, away, floor, best_id[these], best[these])
    return best_id, best


def _search(ids, vectors, query_ids, queries, longest, leaves, away, floor, best_id, best) -> None:
    order = np.argsort(away, axis=1, kind="stable")
    k = best.shape[1]
    width = max(len(r) for r in leaves)
    limit = chi_square_quantile(CONFIDENCE, PROJECTIONS)
    own_length = (queries**2).sum(axis=1)
    active = np.arange(len(away))
    for step in range(len(leaves)):
        leaf = order[active, step]
        # Squared distance of the k-th best so far; infinite while there are fewer than k.
        reach = np.maximum(own_length[active] + longest**2 - 2 * np.maximum(best[active, -1], floor[active]), 0)
        going = away[active, leaf] <= limit * reach
        active, leaf = active[going], leaf[going]
        if not len(active):
            break
        score = np.full((len(active), width), -np.inf)
        found = np.full((len(active), width), np.iinfo(np.int64).max)
        for one in np.unique(leaf):
            asking = np.flatnonzero(leaf == one)
            rows = leaves[one]
            score[asking, : len(rows)] = queries[active[asking]] @ vectors[rows].T
            found[asking, : len(rows)] = ids[rows]
        score[found == query_ids[active][:, None]] = -np.inf
        better = (score >= best[active, -1][:, None]).any(axis=1)
        asking = active[better]
        score = np.concatenate([best[asking], score[better]], axis=1)
        found = np.concatenate([best_id[asking], found[better]], axis=1)
        top = np.lexsort((found, -score), axis=1)[:, :k]
        best[asking] = np.take_along_axis(score, top, axis=1)
        best_id[asking] = np.take_along_axis(found, top, axis=1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector, d) of the rows that take part, vectors in double precision, d their length."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        .where("vec_id is not null and vector is not null and size(vector) > 0")
        .where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
        .dropDuplicates()
        .withColumn("d", F.size("vector"))
    )


def _stacked(column: pa.Array) -> np.ndarray:
    """A column of vectors of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(
    vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product with each row for which
    ``is_query`` (a condition on vec_id) holds; fewer only if there are fewer."""
    rows = stored(usable(vectors, key, vector), "vectors")
    size = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    lengths = rows.groupBy("d").agg(F.count("*").alias("n"), F.sqrt(F.max(size)).alias("longest")).collect()  # one row per length
    out = None
    for one in sorted(lengths):
        found = _of_one_length(rows.where(F.col("d") == one["d"]), is_query, k, one["n"], one["longest"])
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    return out


def _of_one_length(rows: DataFrame, is_query, k: int, n: int, longest: float) -> DataFrame:
    count = 1 << max(0, math.ceil(math.log2(n / BLOCK)))
    splits: list[tuple[int, float]] = []
    if count > 1:
        # The rows with the smallest hashes, so that every row has the same chance.
        chosen = rows if n <= SAMPLE else rows.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 20)) < int(SAMPLE / n * (1 << 20)))
        points = chosen.select("vector").mapInArrow(lambda b: _projected(b, longest), "at array<double>").toArrow()
        splits = cells_of(_stacked(points["at"].combine_chunks()), count)
    celled = rows.select("vec_id", "vector").mapInArrow(lambda b: _celled(b, longest, splits), "vec_id long, vector array<double>, at array<double>, cell long")
    celled = stored(celled, "cells")
    # A cell may hold far more rows than the others, such as copies of one vector.
    sizes = celled.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"))
    block = F.concat_ws("-", "cell", F.pmod(F.xxhash64("vec_id", "vector"), "parts"))
    data = stored(celled.join(sizes, "cell").select(block.alias("block"), "vec_id", "vector", "at"), "blocks")
    box = [f(F.col("at")[d]).alias(f"{x}{d}") for x, f in (("low", F.min), ("high", F.max)) for d in range(PROJECTIONS)]
    bounds = data.groupBy("block").agg(*box).orderBy("block").toPandas()  # PROJECTIONS ranges per BLOCK rows
    low, high = (bounds[[f"{x}{d}" for d in range(PROJECTIONS)]].to_numpy() for x in ("low", "high"))
    names = bounds["block"].tolist()
    shared = rows.sparkSession.sparkContext.broadcast((names, low, high))
    asked = rows.where(is_query).select("vec_id", "vector").withColumn("asked", F.monotonically_increasing_id())
    asked = stored(asked, "queries")
    none = F.lit(None)
    sent = asked.withColumns({"known": none.cast("double"), "nearest": none.cast("array<string>")})
    first = _round(data, sent, shared, longest, k)
    reached = first.groupBy("asked").agg(F.count("*").alias("found"), F.min("score").alias("least"))
    # The k-th best score so far, once there are k.
    known = asked.join(reached, "asked", "left").select("vec_id", "vector", "asked", F.when(F.col("found") >= k, F.col("least")).alias("known"))
    second = _round(data, known.withColumn("nearest", F.array().cast("array<string>")), shared, longest, k) if len(names) > FIRST else first.limit(0)
    ranked = first.unionByName(second).withColumn(
        "rank", F.row_number().over(W.partitionBy("asked").orderBy(F.desc("score"), "vec_id"))
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _projected(batches: Iterator[pa.RecordBatch], longest: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(lifted(_stacked(batch["vector"]), longest)))], ["at"])


def _celled(batches: Iterator[pa.RecordBatch], longest: float, splits: list[tuple[int, float]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            points = lifted(_stacked(batch["vector"]), longest)
            columns = [batch["vec_id"], batch["vector"], pa.array(list(points)), pa.array(cell_numbers(points, splits))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "at", "cell"])


def _visits(batches: Iterator[pa.RecordBatch], shared, longest: float) -> Iterator[pa.RecordBatch]:
    """The blocks that queries visit: the nearest at first, later the others that pass the test."""
    names, low, high = shared.value
    limit = chi_square_quantile(CONFIDENCE, PROJECTIONS)
    for whole in batches:
        for start in range(0, whole.num_rows, STEP):
            batch = whole.slice(start, STEP)
            queries = _stacked(batch["vector"])
            away = away_from(queries @ directions(queries.shape[1])[:-1], low, high)
            nearest_first = np.argsort(away, axis=1, kind="stable")[:, :FIRST]
            going = np.zeros(away.shape, bool)
            np.put_along_axis(going, nearest_first, True, axis=1)
            if batch["nearest"].null_count < batch.num_rows:  # the second round
                known = batch["known"].to_numpy(zero_copy_only=False)
                score = np.where(np.isnan(known), -np.inf, known)
                reach = np.maximum((queries**2).sum(axis=1) + longest**2 - 2 * score, 0)
                going = ~going & (away <= limit * reach[:, None])
            row, block = np.nonzero(going)
            taken = batch.select(["asked", "vec_id", "vector", "known"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(names, object)[block], pa.string()), *taken.columns], ["block", *taken.schema.names]
            )


def _round(data: DataFrame, asking: DataFrame, shared, longest: float, k: int) -> DataFrame:
    """(asked, query_id, vec_id, score): the best of every block that a query visits."""
    visits = stored(
        asking.mapInArrow(lambda b: _visits(b, shared, longest), "block string, asked long, vec_id long, vector array<double>, known double"),
        "visits",
    )
    # The rows of a block meet its queries in as many tasks as these need.
    groups = visits.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("groups"))
    queries = visits.join(groups, "block").withColumn("group", F.pmod(F.xxhash64("asked"), "groups").cast("int"))
    ours = data.join(groups, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), "vec_id", "vector"
    )

    def best(_, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        columns = ["asked", "query_id", "vec_id", "score"]
        if ours.empty or theirs.empty:
            return pd.DataFrame(columns=columns).astype({"asked": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"})
        known = theirs["known"].to_numpy(dtype=float)
        found, score = search(
            ours["vec_id"].to_numpy(), np.stack(ours["vector"]), theirs["vec_id"].to_numpy(), np.stack(theirs["vector"]), longest, k,
            np.where(np.isnan(known), -np.inf, known),
        )
        kept = score > -np.inf
        row = np.nonzero(kept)[0]
        return pd.DataFrame(
            dict(zip(columns, (theirs["asked"].to_numpy()[row], theirs["vec_id"].to_numpy()[row], found[kept], score[kept])))
        )

    found = ours.groupBy("block", "group").cogroup(queries.groupBy("block", "group")).applyInPandas(
        best, "asked long, query_id long, vec_id long, score double"
    )
    # Of all blocks' best only the k best can count.
    top = found.withColumn("place", F.row_number().over(W.partitionBy("asked").orderBy(F.desc("score"), "vec_id")))
    return stored(top.where(F.col("place") <= k).drop("place"), "found")
