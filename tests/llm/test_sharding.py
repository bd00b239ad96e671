import random
import zlib

from custarc.llm import sharding
from custarc.llm.sharding import assign_shards, write_shards


def rows_of():
    r = random.Random(2)
    rows = [(k, "é" * r.randint(0, 200)) for k in range(300)]
    return rows + [(7, "same")] * 150 + [(None, "x"), (None, None), (5, None), (5, ""), (400, "long" * 3000)]


def test_contiguous_and_even(documents):
    rows = rows_of()
    found = assign_shards(documents(rows), shards=24).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == sorted(
        (str(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows
    )
    total, largest = sum(size(t) for _, t in rows), max(size(t) for _, t in rows)
    at, shards = 0, {}
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at and r.shard == at * 24 // total
        at += r["size"]
        shards.setdefault(r.shard, []).append(r)
    for members in shards.values():
        assert [r.slot for r in members] == list(range(len(members)))
        assert abs(sum(r["size"] for r in members) - total / 24) <= largest
    ids = [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None]
    assert ids == sorted(ids)


def test_cuts_are_exact_in_large_tables(documents, monkeypatch):
    # Texts that name their own size: 30 GB in 24 rows, with a short document before and after each cut.
    monkeypatch.setattr(sharding, "byte_size", lambda text, overhead: text.cast("long"))
    part = 30_000_000_000 // 24
    sizes = [n for _ in range(24) for n in (part - 500, 500)]
    found = assign_shards(documents([(k, str(n)) for k, n in enumerate(sizes)]), shards=24).collect()
    assert sum(r["size"] for r in found) == 24 * part and len(found) == 48
    assert all(r.shard == r.start * 24 // (24 * part) for r in found)
    assert {r.shard for r in found} == set(range(24))


def test_written_shards_hold_every_row(spark, documents, tmp_path):
    docs = documents(rows_of())
    write_shards(docs, str(tmp_path / "out"), shards=5)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == docs.count()
    assert out.drop("shard", "slot").exceptAll(docs).count() == 0
    assert out.select("shard", "slot").distinct().count() == docs.count()


def test_empty_table(documents):
    assert assign_shards(documents([])).collect() == []
