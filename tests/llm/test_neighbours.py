import random

import numpy as np
import pytest
from brute import nearest as plain
from pyspark.sql import functions as F

from custarc.llm import neighbours
from custarc.llm.neighbours import chi_square_quantile, nearest


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("block, group", [(8192, 2048), (100, 9)])
def test_recall_against_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERIES", group)
    r = np.random.default_rng(block)
    centres = r.standard_normal((12, 24))
    rows = [(k, [float(np.float32(x)) for x in centres[k % 12] * (1 + k % 3) + r.standard_normal(24)]) for k in range(800)]
    found = nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=10).collect()
    truth = plain(rows, lambda q: q % 20 == 0, 10)
    got = {}
    for x in sorted(found, key=lambda x: x["rank"]):
        got.setdefault(x.query_id, []).append(x.vec_id)
        assert x.score == pytest.approx(np.dot(rows[x.query_id][1], rows[x.vec_id][1]), abs=1e-9)
    assert set(got) == set(truth) and all(len(v) == 10 for v in got.values())
    assert np.mean([len(set(got[q]) & set(truth[q])) / 10 for q in truth]) >= 0.9


def test_ties_and_rows_that_take_no_part(spark):
    r = random.Random(1)
    same = [1.0, 0.0, 0.0]
    rows = [(k, same) for k in range(300)] + [(300, [0.5, 0.0, 0.0]), (20, same)]
    odd = [(400, None), (420, []), (440, [0.0, 0.0, 0.0]), (460, [1.0, None, 0.0]), (480, [float("nan"), 1.0, 0.0]), (500, [float("inf"), 0.0, 0.0]), (None, same)]
    rows += odd
    r.shuffle(rows)
    found = nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=5).collect()
    assert {x.query_id for x in found} == {*range(0, 301, 20)}
    for q in range(0, 301, 20):
        own = sorted((x["rank"], x.vec_id) for x in found if x.query_id == q)
        assert own == list(enumerate([k for k in range(7) if k != q][:5], 1))


def test_each_length_is_searched(spark):
    """Vectors of 2 and of 3 components: queries of either find rows of their own length."""
    r = np.random.default_rng(5)
    rows = [(k, [float(np.float32(x)) for x in r.standard_normal(3 if k < 40 else 2)]) for k in range(61)] + [(80, [1.0])]
    found = nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=5).collect()
    assert {x.query_id for x in found} == {0, 20, 40, 60}
    for q in (0, 20, 40, 60):
        same = [(i, v) for i, v in rows if len(v) == len(rows[q][1])]
        own = [x.vec_id for x in sorted(found, key=lambda x: x["rank"]) if x.query_id == q]
        assert own == plain(same, lambda i: i == q, 5)[q]


def test_structured_vectors_visit_few_blocks(spark, monkeypatch):
    """Clusters far apart, several blocks and one vector with a third of all rows: few blocks are
    visited, and recall holds."""
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "QUERIES", 16)
    r = np.random.default_rng(9)
    centres = r.standard_normal((16, 16)) * 30
    centres *= 100 / np.linalg.norm(centres, axis=1)[:, None]
    rows = [(k, [float(x) for x in centres[k % 16] + r.standard_normal(16)]) for k in range(1000)]
    rows += [(1000 + k, [float(x) for x in centres[0]]) for k in range(500)]
    visits = []
    plain_stored = neighbours.stored
    monkeypatch.setattr(neighbours, "stored", lambda df, name: visits.append(out) or out if (out := plain_stored(df, name)) is not None and name == "visits" else out)
    found = nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=10).collect()
    truth = plain(rows, lambda q: q % 20 == 0, 10)
    got = {q: {x.vec_id for x in found if x.query_id == q} for q in truth}
    scores = {(x.query_id, x.vec_id): x.score for x in found}
    # Equal vectors tie up to rounding, so a found row counts if it scores like the true one.
    vector = dict(rows)
    good = sum(scores[q, i] >= np.dot(vector[q], vector[truth[q][-1]]) - 1e-6 for q in truth for i in got[q])
    assert good / sum(map(len, truth.values())) >= 0.9 and all(len(v) == 10 for v in got.values())
    blocks = -(-1500 // 64)
    assert sum(v.count() for v in visits) < 0.5 * len(truth) * blocks


def test_cells():
    r = np.random.default_rng(3)
    points = r.standard_normal((5000, neighbours.PROJECTIONS))
    numbers = neighbours.cell_numbers(points, neighbours.cells_of(points, 16))
    sizes = np.bincount(numbers, minlength=16)
    assert len(sizes) == 16 and sizes.min() > 250 and sizes.max() < 400
    assert neighbours.cell_numbers(points, []).max() == 0
    same = np.zeros((50, neighbours.PROJECTIONS))
    assert len(set(neighbours.cell_numbers(same, neighbours.cells_of(same, 4)))) == 1


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])]
    found = nearest(table(spark, rows), F.col("vec_id") == 0, k=20).collect()
    assert [(x["rank"], x.vec_id, x.score) for x in sorted(found, key=lambda x: x["rank"])] == [(1, 1, 0.0), (2, 2, -1.0)]


def test_empty_table(spark):
    assert nearest(table(spark, []), F.col("vec_id") == 0).collect() == []


def test_quantile():
    assert chi_square_quantile(0.95, 1) == pytest.approx(3.8415, abs=1e-3)
    assert chi_square_quantile(0.9, 12) == pytest.approx(18.549, abs=1e-2)
