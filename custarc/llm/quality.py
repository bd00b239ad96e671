"""Graded quality by ordinal regression on hashed text.

A cumulative-link model: a text has one score s, the sum of the weights of its features, and ordered
thresholds cut the scale into grades, P(grade <= k) = logistic(threshold[k] - s). All grades share
the weights. From it come the expected grade and the probability of reaching a grade.

Features are, for every distinct word: the word without edge punctuation in lower case, its first
four and five letters, and its shape at the edges, all divided by the square root of the number of
distinct words; and for the text its length and its shares of repeated words, of symbols and of
capitals, in steps. They are hashed into 2^BITS weights.

The model is fitted on at most SAMPLE rated texts per grade (those with the smallest hash of their
id), weighted so that the grades count as in all ratings. The driver sees the feature numbers of that
sample only; scoring covers every text.

Null text is empty and is scored like any other. A text rated several times has its lowest grade; a
null grade or id is no rating; of several texts with one id, the smallest is fitted. Without rated
texts of at least two grades there is no model: fit() returns None, score() gives NULL for every
text, and keep_good() keeps all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custarc.llm.common import unpacked
from custarc.llm.words import lists, small_batches

BITS = 18
SAMPLE = 1500
MIN_TEXTS = 3
DAMPING = 3e-4  # keeps Adam from moving rare features as fast as common ones
OF_TEXT = 4  # features of a text as a whole
WHOLE = 2.0  # their value; a word's is divided by the square root of the number of words
STEPS = 400
STRETCH = 1 << 19  # features multiplied at a time
PENALTY = 1e-4
CACHED_WORDS = 100_000

_EDGES = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)


def _slot(kind: str, value: str) -> int:
    return xxhash.xxh32_intdigest(f"{kind} {value}") & ((1 << BITS) - 1)


def word_features(word: str) -> tuple[int, ...]:
    """The four features of a word, then whether it carries symbols and whether it is in capitals."""
    before, core, after = _EDGES.match(word).groups()
    low = core.lower()
    capitals = len(core) > 2 and core.isupper()
    case = "X" if capitals else "x" if core else ""
    shape = f"{before[:3]}{case}{after[:3]}"
    slots = _slot("w", low), _slot("4", low[:4]), _slot("5", low[:5]), _slot("s", shape)
    return *slots, int(not core or len(before) + len(after) > 1), int(capitals)


def text_features(n_words: int, n_distinct: int, symbols: int, capitals: int) -> list[int]:
    """Length of a text and its shares of repeated words, symbols and capitals, each in steps."""
    shares = (1 - n_distinct / max(1, n_words), symbols / max(1, n_distinct), capitals / max(1, n_distinct))
    return [_slot("n", str(n_words.bit_length()))] + [_slot(f"t{k}", str(int(x * 10))) for k, x in enumerate(shares)]


class _Known(dict):
    """What a function gives for a word; a full cache starts anew."""

    def __init__(self, fn):
        super().__init__()
        self.fn = fn

    def __missing__(self, word):
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = self.fn(word)
        return value


def features(text: str | None, known) -> np.ndarray:
    """Feature numbers of a text: OF_TEXT of the whole text, then those of its distinct words."""
    words = (text or "").split()
    found = [known[w] for w in set(words)]
    whole = text_features(len(words), len(found), sum(f[4] for f in found), sum(f[5] for f in found))
    return np.array(whole + [slot for f in found for slot in f[:4]], np.int32)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def reach(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return _logistic(scores[:, None] - self.thresholds[None, :])

    def scores(self, texts: Iterator[str | None]) -> np.ndarray:
        weights = self.weights.tolist()  # four single weights are faster from a list

        def of_word(word: str) -> tuple[float, int, int]:
            a, b, c, d, symbols, capitals = word_features(word)
            return weights[a] + weights[b] + weights[c] + weights[d], symbols, capitals

        known = _Known(of_word)
        out = []
        for text in texts:
            words = (text or "").split()
            found = [known[w] for w in sorted(set(words))]
            total, symbols, capitals = map(sum, zip(*found)) if found else (0.0, 0, 0)
            whole = sum(weights[f] for f in text_features(len(words), len(found), symbols, capitals))
            out.append(total / max(1, len(found)) ** 0.5 + WHOLE * whole)
        return np.array(out, np.float64)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_arrays(flat: np.ndarray, lengths: np.ndarray, grades: np.ndarray, weight: np.ndarray, n_grades: int) -> Model:
    """Maximum likelihood with a small L2 penalty by Adam steps over the whole sample. ``flat`` holds
    the feature numbers of all texts, ``lengths`` how many of them each text has."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    # Four features per distinct word behind those of the text.
    of_words = 1 / np.sqrt(np.maximum(1, (lengths - OF_TEXT) / 4))
    value = np.repeat(of_words, lengths).astype(np.float32)
    value[(starts[:-1, None] + np.arange(OF_TEXT)).ravel()] = WHOLE
    # A feature of one or two texts would only learn these texts by heart.
    texts = np.zeros(1 << BITS, np.int32)
    for a, b in zip(starts[:-1], starts[1:]):
        texts[np.unique(flat[a:b])] += 1
    known = texts >= MIN_TEXTS
    kept = known[flat]
    kept[(starts[:-1, None] + np.arange(OF_TEXT)).ravel()] = True  # no text is left without features
    flat, value, lengths = flat[kept], value[kept], np.add.reduceat(kept.astype(np.int64), starts[:-1])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    share = weight / weight.sum()
    below = np.array([share[grades < k].sum() for k in range(1, n_grades)])
    below = np.clip(below, 1e-3, 1 - 1e-3)
    cut = np.log(below / (1 - below))
    # Parameters: the first threshold, then logarithms of the gaps, which keeps them in order.
    gaps = np.concatenate([cut[:1], np.log(np.maximum(np.diff(cut), 0.05))])
    w = np.zeros(1 << BITS)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(gaps), np.zeros_like(gaps)]
    # A stretch of texts at a time, so that the products of a step stay small.
    cuts = [0, *(np.flatnonzero(np.diff(starts[1:] // STRETCH)) + 1), len(lengths)]
    parts = [(a, b, slice(starts[a], starts[b])) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
    for step in range(1, STEPS + 1):
        theta = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
        s = np.concatenate([np.add.reduceat(w[flat[x]] * value[x], starts[a:b] - starts[a]) for a, b, x in parts])
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = _logistic(edges[grades + 1] - s), _logistic(edges[grades] - s)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        d_s = share * (du - dl) / p  # derivative of the loss by the score
        d_theta = np.zeros(n_grades + 1)
        np.add.at(d_theta, grades + 1, -share * du / p)
        np.add.at(d_theta, grades, share * dl / p)
        d_theta = d_theta[1:n_grades]
        tails = np.cumsum(d_theta[::-1])[::-1]
        d_gaps = np.concatenate([tails[:1], tails[1:] * np.exp(gaps[1:])])
        d_w = PENALTY * w
        for a, b, x in parts:
            d_w += np.bincount(flat[x], np.repeat(d_s[a:b], lengths[a:b]) * value[x], len(w)) * known
        for x, d, k in ((w, d_w, 0), (gaps, d_gaps, 2)):
            moments[k] = 0.9 * moments[k] + 0.1 * d
            moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * d * d
            x -= 0.05 * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 1] / (1 - 0.99**step)) + DAMPING)
    theta = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
    return Model(w.astype(np.float32), theta)


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Known(word_features)
    for whole in batches:
        for batch in small_batches(whole):
            found = [features(t, known) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["grade"], lists(found, pa.int32())], names=["grade", "slots"])


def rated_sample(
    docs: DataFrame, ratings: DataFrame, text: str = "text", key: str = "doc_id", grade: str = "grade", per_grade: int = SAMPLE
) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, grade, text) of the sample, and the number of ratings of each grade."""
    rated = (
        ratings.select(F.col(key).alias("doc_id"), F.col(grade).cast("int").alias("grade"))
        .where("doc_id is not null and grade is not null")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )
    counts = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}  # one row per grade
    chosen = None
    for g in sorted(counts):
        part = rated.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_grade)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        chosen = rated
    plain = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # At most per_grade rows per grade.
    sample = plain.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    return sample, counts


def fit(docs: DataFrame, ratings: DataFrame, **options) -> Model | None:
    """Fit grades 0, 1, ... of ``ratings`` (doc_id, grade) to the texts of ``docs``."""
    sample, counts = rated_sample(docs, ratings, **options)
    ordered = sample.orderBy("doc_id").select("text", "grade")
    rows = ordered.mapInArrow(_features_of, "grade int, slots array<int>").toArrow().combine_chunks()
    grades = rows["grade"].to_numpy()
    if len(set(grades.tolist())) < 2:
        return None
    sampled = np.bincount(grades)
    weight = np.array([counts[g] / sampled[g] for g in grades.tolist()])
    slots = rows["slots"].combine_chunks()
    lengths = np.diff(slots.offsets.to_numpy()).astype(np.int64)
    return fit_arrays(slots.flatten().to_numpy(), lengths, grades, weight, max(counts) + 1)


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """(row, expected_grade, p_top): each document as struct ``row``, its expected grade and the
    probability of the highest grade; both NULL without a model."""
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(F.struct("*").alias("row"), none.alias("expected_grade"), none.alias("p_top"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("expected", T.DoubleType()), T.StructField("top", T.DoubleType())])

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            reach = shared.value.reach(shared.value.scores(texts))
            yield pd.DataFrame({"expected": reach.sum(axis=1), "top": reach[:, -1]})

    rows = docs.select(F.struct("*").alias("row"))
    judged = rows.withColumn("judged", judge(F.coalesce(F.col("row").getField(text), F.lit(""))))
    return judged.select("row", F.col("judged.expected").alias("expected_grade"), F.col("judged.top").alias("p_top"))


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxic flags: 0 toxic, 1 poor, 2 good."""
    return labels.select(
        "doc_id",
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"),
    )


def keep_good(docs: DataFrame, ratings: DataFrame, least: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` that have the highest grade with probability ``least`` or more."""
    model = fit(docs, ratings, text=text)
    if model is None:
        return docs
    return unpacked(score(docs, model, text).where(F.col("p_top") >= least), docs.columns)
