import random
import tracemalloc

import pyarrow as pa
import pytest
from brute import near_duplicates as plain
from brute import shingles

from custarc.llm import jaccard
from custarc.llm.components import connected
from custarc.llm.jaccard import keep_one, near_duplicates


def rows_of(seed, prose):
    r = random.Random(seed)
    rows = [(k, prose(k, r.randint(1, 60))) for k in range(40)]
    passage = prose("passage", 60)
    base = prose("base", 80).split()
    for k in range(100, 220):
        words = list(base)
        for _ in range(r.randint(0, 9)):
            words[r.randrange(len(words))] = f"edit{r.randrange(4000)}"
        rows.append((k, " ".join(words)))
    rows += [(k, passage + " " + prose(k, r.randint(0, 25))) for k in range(300, 360)]
    rows += [(400 + k, rows[k % 9][1].upper() if k % 2 else rows[k % 9][1]) for k in range(40)]
    rows += [(None, passage), (500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "One\ttwo"), (505, "one"), (7, passage), (7, passage)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, ordered", [(1, 1 << 17), (2, 20)])
def test_as_brute_force(documents, prose, monkeypatch, seed, ordered):
    monkeypatch.setattr(jaccard, "ORDERED", ordered)
    rows = rows_of(seed, prose)
    found = near_duplicates(documents(rows)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(x.doc_id, x.n_shingles, x.component_id) for x in found], key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("tile, room", [(256, 1 << 20), (7, 1 << 20), (256, 400)])
def test_links_between_different_texts(documents, prose, monkeypatch, tile, room):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", room)
    rows = rows_of(4, prose)
    sets = {s for _, t in rows if (s := shingles(t))}
    links = {s: sum(100 * len(s & o) >= 80 * len(s | o) for o in sets) - 1 for s in sets}
    found = near_duplicates(documents(rows)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(x.doc_id, x.n_shingles, x.n_links) for x in found], key=key) == sorted(
        [(i, len(s), links.get(s, 0)) for i, s in ((i, shingles(t)) for i, t in rows)], key=key
    )
    assert max(links.values()) > 20
    least = {}
    for i, t in rows:
        if (s := shingles(t)) and i is not None:
            least[s] = min(i, least.get(s, i))
    assert all(x.class_doc_id == (least[s] if (s := shingles(t)) else i) for x, (i, t) in zip(
        sorted(found, key=lambda x: str(x.doc_id)), sorted(rows, key=lambda x: str(x[0]))) if i not in (7, None))


def test_copies_of_a_long_text_leave_room_for_frequent_shingles(documents, prose, monkeypatch):
    """More shingles than can be ranked, all equally frequent through copies: the rest of the room goes
    to part of them, and shingles of many different texts come first."""
    monkeypatch.setattr(jaccard, "ORDERED", 200)
    long, passage = prose("long", 3000), prose("passage", 30)
    rows = [(k, long) for k in range(200)] + [(1000 + k, prose(k, 20) + " " + passage) for k in range(90)]
    docs = documents(rows)
    ranked = jaccard.frequent_shingles(docs.coalesce(1), 5)
    assert 26 <= ranked.shape[1] < 40  # those of the passage; the copies are one set
    ranked = jaccard.frequent_shingles(docs.repartition(40), 5)
    assert 26 <= ranked.shape[1] <= 200
    found = near_duplicates(docs).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(x.doc_id, x.n_shingles, x.component_id) for x in found], key=key) == sorted(plain(rows), key=key)


def test_one_of_each_group_stays(documents, prose):
    rows = rows_of(3, prose)
    out = keep_one(documents(rows))
    assert out.columns == documents([]).columns
    kept = sorted(r.doc_id for r in out.collect() if r.text and r.text.split())
    assert kept == sorted({c for _, n, c in plain(rows) if n})
    assert {500, 501, 502} <= {r.doc_id for r in out.collect()}


def test_rows_equal_in_all_leave_one(documents):
    assert keep_one(documents([(1, "a b c d e f")] * 5)).count() == 1


def test_rows_without_words_and_groups_without_ids(documents, prose):
    words = prose("no id", 60).split()
    near = [(None, " ".join(words)), (None, " ".join([*words, "more"])), (None, " ".join([*words, "else"]))]
    blank = [(None, None)] * 3 + [(None, " \n")] * 2 + [(4, "")] * 2 + [(4, None)]
    out = keep_one(documents(near + blank)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.doc_id, r.text) for r in out if not (r.text or "").split()], key=key) == sorted(blank, key=key)
    assert len(out) == len(blank) + 1


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == []
    assert keep_one(documents([])).collect() == []


def test_components_of_long_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 70)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    found = connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(found) == len({r.node for r in found})
    expected = {k: 0 for k in range(71)} | {k: 100 for k in range(100, 160)} | {200: 200, 300: 200}
    assert {r.node: r.component for r in found} == expected


def test_counting_shingles_holds_a_few_texts_at_a_time():
    """The texts of a batch are taken apart a slice at a time; the counts are those of distinct sets."""
    texts = [f"w{k} " + "a b c d e f " * 150 for k in range(4096)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    (found,) = jaccard._counts(iter([batch]), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(found["n"].to_pylist()) == [4096] * 6
    assert peak < sum(map(len, texts)) / 2
