import random

import numpy as np

from custarc.llm import quality
from custarc.llm.quality import fit, fit_arrays, grades_of_labels, keep_good, score


def corpus(n, seed=1):
    r = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(r.randint(20, 150))]
        kind = r.choice(["good", "good", "poor", "toxic"])
        if kind == "poor":
            words = [w + "***" for w in words]
        if kind == "toxic":
            for _ in range(1 + len(words) // 15):
                words[r.randrange(len(words))] = r.choice(["rascal", "villain", "scoundrel"])
        docs.append((k, " ".join(words)))
        labels.append((k, 0 if kind == "poor" else 1, int(kind == "toxic")))
    return docs, labels


def test_held_out_accuracy(spark, documents):
    docs, labels = corpus(900)
    rated = spark.createDataFrame(labels[:600] + [(None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    model = fit(documents(docs), grades_of_labels(rated))
    assert model.thresholds[0] < model.thresholds[1]
    found = {r.row.doc_id: r for r in score(documents(docs), model).collect()}
    right = [(found[k].p_top >= 0.5) == (q == 1 and t == 0) for k, q, t in labels[600:]]
    assert np.mean(right) > 0.95
    grade = lambda q, t: 0 if t else 1 + q
    means = [np.mean([found[k].expected_grade for k, q, t in labels[600:] if grade(q, t) == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]


def test_the_sample_is_bounded_and_weighted(spark, documents):
    docs, labels = corpus(300)
    ratings = grades_of_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    sample, counts = quality.rated_sample(documents(docs + docs), ratings, per_grade=20)
    assert sample.count() == 60 and sum(counts.values()) == 300


def test_gradient_finds_a_separating_order():
    slots = [np.concatenate([np.arange(4), [10 + g] * 8]) for g in (0, 1, 2) for _ in range(20)]
    grades = np.repeat([0, 1, 2], 20)
    lengths = np.array([len(x) for x in slots])
    model = fit_arrays(np.concatenate(slots).astype(np.int32), lengths, grades, np.ones(60), 3)
    w = model.weights
    assert w[10] < w[11] < w[12]


def test_no_model_keeps_all(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    for labels in ([], [(1, 1, 0)], [(7, 0, 0), (8, 1, 0)]):
        ratings = grades_of_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        assert keep_good(docs, ratings).count() == 2
        assert [(r.expected_grade, r.p_top) for r in score(docs, quality.fit(docs, ratings)).collect()] == [(None, None)] * 2


def test_query_without_labels(spark, tmp_path):
    """Nothing is known, so nothing is judged and everything stays selected."""
    from custarc.llm.queries import op3_quality_classifier

    spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = op3_quality_classifier(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.expected_grade, r.p_top, r.selected) for r in rows} == {(1, None, None, True), (2, None, None, True)}


def test_gradient_against_finite_differences():
    """The fitted model is where the penalised likelihood, written plainly, is flat in every threshold
    and in the weights that occur most."""
    r = np.random.default_rng(2)
    grades = np.repeat([0, 1, 2], 60)
    own = [np.concatenate([[1, 2, 3, 4], r.integers(10 + 4 * g, 24 + 4 * g, 16)]) for g in grades]
    lengths = np.array([len(x) for x in own])
    model = fit_arrays(np.concatenate(own).astype(np.int32), lengths, grades, np.ones(180), 3)
    value = np.concatenate([np.full(4, quality.WHOLE), np.full(16, 1 / np.sqrt(4))])

    def loss(w, theta):
        total = quality.PENALTY / 2 * (w**2).sum()
        for x, g in zip(own, grades):
            s = (w[x] * value).sum()
            reach = [1.0, *(1 / (1 + np.exp(t - s)) for t in theta), 0.0]
            total -= np.log(reach[g] - reach[g + 1]) / 180
        return total

    w, theta = model.weights.astype(float), model.thresholds
    assert theta[0] < theta[1]

    def slope(at, k, h=1e-4):
        low, high = at.copy(), at.copy()
        low[k] -= h
        high[k] += h
        return (loss(w, high) - loss(w, low)) / (2 * h) if at is theta else (loss(high, theta) - loss(low, theta)) / (2 * h)

    assert max(abs(slope(theta, k)) for k in range(2)) < 0.01
    common = np.argsort(-np.bincount(np.concatenate(own), minlength=40))[:12]
    assert max(abs(slope(w, k)) for k in common) < 0.01
    start = loss(np.zeros_like(w), np.array([-0.69, 0.69]))
    assert loss(w, theta) < 0.7 * start


def test_odd_texts_are_scored(spark, documents):
    docs, labels = corpus(200)
    ratings = grades_of_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    odd = documents(docs + [(None, None), (900, ""), (901, "w" * 100000), (902, "w " * 50000), (902, "w " * 50000)])
    assert score(odd, fit(odd, ratings)).where("p_top between 0 and 1").count() == 205
    assert keep_good(odd, ratings).columns == odd.columns
    assert keep_good(documents([]), ratings).count() == 0
