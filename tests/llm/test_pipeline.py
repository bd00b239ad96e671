"""The queries on the smallest test tables, each stage against a plain version."""

import duckdb
import pytest
from brute import base_spans, contamination, line_dedup, near_duplicates, sha, shingles

import corpus_pipeline
from custarc.llm.common import stored
from custarc.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()


def test_line_dedup(spark, docs):
    found = QUERIES["op1_line_dedup"](spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted((i, n, d, sha(t)) for i, n, d, t in line_dedup(docs, 10))


def test_near_duplicates(spark, docs):
    found = QUERIES["op4_ngram_jaccard"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(near_duplicates(docs))
    sets = {i: shingles(t) for i, t in docs}
    least, holders = {}, {}
    for i, own in sorted(sets.items()):
        least.setdefault(own, i)
        for shingle in own:
            holders.setdefault(shingle, set()).add(own)
    for r in found:
        own = sets[r.doc_id]
        others = {o for shingle in own for o in holders[shingle]} - {own}
        links = sum(100 * len(own & o) >= 80 * len(own | o) for o in others)
        assert (r.class_id, r.n_links) == (least[own] if own else r.doc_id, links)


def test_decontamination(spark, docs):
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    found = QUERIES["op6_decontamination"](spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(
        (i, n, h, len(x), sha(",".join(x)), c) for i, n, h, x, c in contamination(docs, items)
    )


def test_pii(spark, docs):
    found = {r.doc_id: r for r in QUERIES["op10_pii"](spark, SF).collect()}
    for i, text in docs:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text))
        assert found[i].base_sha256 == sha(base) and found[i].spans.startswith(base)


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    before = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {
        1: lambda rows: [(i, t) for i, _, _, t in line_dedup(rows, 10)],
        2: lambda rows: [(i, t) for (i, t), (_, n, c) in zip(rows, near_duplicates(rows)) if not n or c == i],
        3: lambda rows: [(i, t) for (i, t), x in zip(rows, contamination(rows, items)) if not x[-1]],
    }
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = stored(stage(spark, docs, SF), f"stage{k}")
        assert docs.columns == columns
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if k in expected:
            assert sorted(after) == sorted(expected[k](before))
        assert set(i for i, _ in after) <= set(i for i, _ in before)
        before = after
    assert docs.where("n_chars != length(text)").count() == 0
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in before}
    assert sum(r.n_tokens for r in packed) == sum(len(t.split()) for _, t in before)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
