import hashlib
import heapq
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from custarc.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, record string, n int"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def rows_of():
    r = random.Random(3)
    tricky = "é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n\0" * 60
    rows = [(k, f"http://www.h{k % 5}.example.org/{r.randint(0, 9)}?q={k}#top", "ab c\n" * r.randint(0, 400)) for k in range(80)]
    rows += [(100 + k, r.choice(("http://same.example/", None, "")), tricky) for k in range(40)]
    rows += [(200, "http://e.example/x\r\ny", "z" * 999)] * 3 + [(201, "u", "z" * 1000)] * 3 + [(199, "u", "z" * 1000)]
    rows += [(300, "a", "k" * 2000), (300, "b", "k" * 2000), (None, "c", "k" * 2000), (None, "d", "n" * 3000), (None, "d", "n" * 3000)]
    rows += [(400, "http://[bad", None), (401, None, ""), (402, "x", "long " * 100_000)]
    r.shuffle(rows)
    return rows


def plain(rows, least=1000):
    out, groups = [], {}
    for key, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((key, url))
    for payload, own in groups.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""), reverse=True)
        for place, (key, _) in enumerate(own):
            again = place > 0 and len(payload) >= least
            kind = "revisit" if again else "response"
            out.append((key, len(payload), hashlib.sha1(payload).hexdigest(), kind, own[0][0] if again else None))
    return Counter(out)


@pytest.mark.parametrize("archive", [1 << 25, 5000])
def test_round_trip(spark, monkeypatch, archive):
    monkeypatch.setattr(warc, "ARCHIVE", archive)
    rows = rows_of()
    got = warc.round_trip(pages_of(spark, rows))
    assert got.count() == len(rows)
    assert Counter((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()) == plain(rows)


def test_archives_and_index(spark, monkeypatch, tmp_path):
    """Records are found at their places, and the index is in order from file to file."""
    monkeypatch.setattr(warc, "ARCHIVE", 20_000)
    rows = rows_of()
    folder = str(tmp_path / "archives")
    at = F.timestamp_seconds(F.col("page_id") % 7)
    warc.write_archives(pages_of(spark, rows), folder, at=at, compression="none")
    assert len(list((tmp_path / "archives").glob("part-*"))) > 3
    index = warc.read_archives(spark, folder)
    entries = sorted(index.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")}).collect(), key=lambda e: (e.file, e.row))
    order = [(e.url_key, e["at"], e.record) for e in entries]
    assert order == sorted(order) and len(set(order)) == len(rows)
    assert {e.url_key.split(")")[0] for e in entries} >= {"org,example,h3", "example,same", ""}
    html = {k: h or "" for k, _, h in rows if k is not None}
    for e in entries[::7]:
        with open(e.archive.removeprefix("file:"), "rb") as f:
            f.seek(e.offset)
            text = f.read(e.length)
        (_, _, headers, _, payload), = warc.read_records(text)
        assert headers["warc-record-id"] == e.record
        if e.type == "response" and e.key is not None:
            assert payload.decode() == html[int(e.key)]
        if e.type == "revisit":
            assert payload == b"" and headers["warc-profile"] == warc.REVISIT


def test_cut_or_changed_archives_are_refused(spark, tmp_path):
    folder = tmp_path / "archives"
    warc.write_archives(pages_of(spark, [(1, "u", "text " * 10)]), str(folder), compression="none")
    content = next(folder.glob("part-*")).read_bytes()
    assert len(list(warc.read_records(content))) == 1
    with pytest.raises(ValueError, match="cut record"):
        list(warc.read_records(content[:-6]))
    with pytest.raises(ValueError, match="digest"):
        [warc._entry("x", *r) for r in warc.read_records(content.replace(b"text ", b"tex7 "))]


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 16])
def test_tree_of_losers(count):
    r = random.Random(count)
    runs = [sorted([("f", f"k{r.randint(0, 9)}", "t", f"r{r.random()}")] * r.randint(1, 3) for _ in range(r.randint(0, 30))) for _ in range(count)]
    runs = [[e for same in run for e in same] for run in runs]
    key = lambda e: e[1:4]
    assert [key(e) for e in warc.merged(runs)] == [key(e) for e in heapq.merge(*runs, key=key)]


def test_empty_table(spark):
    assert warc.round_trip(pages_of(spark, [])).collect() == []
