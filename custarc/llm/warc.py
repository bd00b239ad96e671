"""Web archives: pages written as WARC records, read back, and indexed as capture histories.

Writing. Each page becomes a record. Of the pages with one payload of at least ``least`` bytes the one
with the largest key is a ``response``, the others are ``revisit`` records that refer to it and hold no
payload; smaller payloads are always written. Spark's text writer puts the records into gzipped files of
about ARCHIVE bytes of text: a record is a line of that writer, whose line separator is the end of a WARC
record. Only revisits and small pages are copied as such; a payload is shuffled once, to even out the files.

Reading. A task reads whole archives as a stream of records by their Content-Length, checks each payload
against its digest, and returns the index entries of an archive as a run sorted by URL key and time. The
stored runs are cut into ranges of (URL key, time, record), the same ranges for all; in each range the
pieces of the k runs are merged by a tree of losers. So the stored index, file after file, holds every
URL's captures together and in the order of time, however many captures a URL has.

Rows. Null payload is empty, null key is smaller than any and is read back as null, null time is the
epoch, null URL gives a record without one; line breaks in URLs are percent-encoded. Rows equal in
everything are captures of their own: one of them is the response. Ties of the largest key go to the
largest URL and time. Other columns are left out; an empty table gives no archive and no entries.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custarc.llm.common import stored
from custarc.sinks.tables import scratch_folder

ARCHIVE = 32 << 20  # bytes of payloads in a file
RANGE = 200_000  # index entries merged by a task
BREAK = "\r\n"
# Fixed values of the format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
SAME = ["digest", "key", "url", "at"]
c = F.col

INDEX = T.StructType(
    [
        T.StructField(name, T.LongType() if name in ("offset", "length", "payload_bytes") else T.StringType())
        for name in "archive url_key at record offset length type url key payload_digest payload_bytes refers".split()
    ]
)


def _captures(pages: DataFrame, key: str, url: str, payload: str, at: Column | None) -> DataFrame:
    """(key, url, at, payload, bytes, digest), all texts."""
    html = F.coalesce(payload, F.lit(""))
    epoch = F.timestamp_seconds(F.lit(0))
    time = F.date_format(epoch if at is None else F.coalesce(at, epoch), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    # Numbers are kept as numbers here, as the largest key counts.
    return pages.select(
        c(key).alias("key"),
        c(url).alias("url"),
        time.alias("at"),
        html.alias("payload"),
        F.octet_length(html).cast("long").alias("bytes"),
        F.sha1(F.encode(html, "UTF-8")).alias("digest"),
    )


def _id(kind: str, copy: Column) -> Column:
    """A record id made from what is recorded."""
    told = [F.coalesce(c(x).cast("string"), F.lit("\0")) for x in SAME]
    digits = F.md5(F.concat_ws("\n", F.lit(kind), *told, copy.cast("string")))
    parts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing if there is no value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))


def _on_one_line(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(kind: str, more: Column, payload: Column) -> Column:
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        c("bytes").cast("string"),
        F.lit(BREAK * 2),
    )
    size = F.octet_length(http) + F.octet_length(payload)
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}WARC-Type: {kind}{BREAK}"),
        _header("WARC-Record-ID", c("record")),
        _header("WARC-Date", c("at")),
        _header("WARC-Target-URI", _on_one_line(c("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), c("digest"))),
        _header("Capture-Key", _on_one_line(c("key").cast("string"))),
        more,
        _header("Content-Type", F.lit(HTTP_TYPE)),
        _header("Content-Length", size.cast("string")),
        F.lit(BREAK),
        http,
        payload,
    )


def _same_row(left: DataFrame, right: DataFrame):
    on = left["digest"] == right["r_digest"]
    for x in SAME[1:]:
        on = on & left[x].eqNullSafe(right[f"r_{x}"])
    return on


def _prefixed(df: DataFrame) -> DataFrame:
    return df.select(*[c(x).alias(f"r_{x}") for x in SAME])


def records(pages: DataFrame, key: str, url: str, payload: str, at: Column | None, least: int) -> tuple[DataFrame, int]:
    """((record, value): the id and the text of every record, the bytes of all payloads)."""
    captures = _captures(pages, key, url, payload, at)
    heads = stored(captures.select(*SAME, "bytes"), "heads")
    total = heads.agg(F.sum("bytes")).first()[0] or 0
    rows = stored(heads.where(c("bytes") >= least).groupBy(*SAME, "bytes").agg(F.count("*").alias("n")), "large")
    groups = rows.groupBy("digest").agg(F.sum("n").alias("all"), F.max(F.struct("key", "url", "at", "n")).alias("first"))
    groups = groups.where("all > 1").select(c("digest").alias("of"), "first")
    is_first = F.lit(True)
    for x in SAME[1:]:
        is_first = is_first & c(x).eqNullSafe(c(f"first.{x}"))
    repeated = stored(rows.join(groups, c("digest") == c("of")).withColumn("is_first", is_first), "repeated")

    # The payload of a first row that occurs once is taken from the table; all other rows of a group are left out.
    left_out = _prefixed(repeated.where("NOT is_first OR n > 1"))
    large = captures.where(c("bytes") >= least)
    taken = [large.join(left_out, _same_row(large, left_out), "left_anti")]
    several = _prefixed(repeated.where("is_first AND n > 1"))
    if several.limit(1).count():
        taken.append(large.join(several, _same_row(large, several), "left_semi").dropDuplicates(["digest"]))
    one = F.lit(1)
    small = captures.where(c("bytes") < least).groupBy(*captures.columns).agg(F.count("*").alias("n"))
    small = small.withColumn("copy", F.explode(F.sequence(F.lit(1), c("n").cast("int")))).drop("n")
    whole = small
    for more in taken:
        whole = whole.unionByName(more.withColumn("copy", one))
    responses = whole.withColumn("record", _id("response", c("copy"))).select(
        "record", _record("response", F.lit(""), c("payload")).alias("value")
    )

    copies = (c("n") - c("is_first").cast("long")).cast("int")
    again = repeated.withColumn("copies", copies).where("copies > 0")
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(1), c("copies"))))
    again = again.withColumn("record", _id("revisit", c("copy")))
    source = again.select(
        "record", *SAME, "bytes", c("first.key").alias("f_key"), c("first.url").alias("f_url"), c("first.at").alias("f_at")
    )
    target = source.select(
        "digest", c("f_key").alias("key"), c("f_url").alias("url"), c("f_at").alias("at"), F.struct("*").alias("own")
    ).withColumn("target", _id("response", one))
    refers = F.concat(
        _header("WARC-Profile", F.lit(REVISIT)),
        _header("WARC-Refers-To", c("target")),
        _header("WARC-Refers-To-Target-URI", _on_one_line(c("f_url"))),
        _header("WARC-Refers-To-Date", c("f_at")),
    )
    revisits = target.select("own.*", "target").select("record", _record("revisit", refers, F.lit("")).alias("value"))
    return responses.union(revisits), total


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    at: Column | None = None,
    least: int = 1000,
    compression: str = "gzip",
) -> None:
    """Write ``pages`` as WARC files into ``folder``."""
    every, total = records(pages, key, url, payload, at, least)
    files = max(1, math.ceil(total / ARCHIVE))
    # By record id, so files get equal shares of whatever rows there are.
    even = every.repartition(files, "record").select("value")
    even.write.option("lineSep", BREAK * 2).option("compression", compression).text(folder)


def url_key(url: str | None) -> str:
    """The URL as a sort key: host parts from the last to the first, then path and query."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").split(".")
    except ValueError:
        return url
    if host and host[0] == "www":
        host = host[1:]
    return ",".join(reversed(host)) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _headers(file) -> dict[str, str]:
    found = {}
    while line := file.readline().decode().removesuffix(BREAK):
        name, _, value = line.partition(": ")
        found[name.lower()] = value
    return found


def read_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], dict[str, str], bytes]]:
    """(offset, length, headers, HTTP headers, payload) of each record; offsets are those of the text."""
    raw = io.BytesIO(content)
    file = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    at = 0
    while version := file.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = _headers(file)
        size = int(headers["content-length"])
        block = file.read(size)
        if len(block) < size or file.read(4) != b"\r\n\r\n":
            raise ValueError(f"cut record at {at}")
        http, payload = {}, block
        if headers.get("content-type") == HTTP_TYPE:
            inner = io.BytesIO(block)
            inner.readline()
            http, payload = _headers(inner), inner.read()
        end = file.tell()
        yield at, end - at, headers, http, payload
        at = end


def _entry(archive: str, offset: int, length: int, headers: dict, http: dict, payload: bytes) -> tuple:
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"{archive} at {offset}: the payload is not what its digest says")
    url = headers.get("warc-target-uri")
    return (
        archive, url_key(url), headers["warc-date"], headers["warc-record-id"], offset, length, kind, url,
        headers.get("capture-key"), digest, int(http["content-length"]), headers.get("warc-refers-to"),
    )


def _order(entry: tuple) -> tuple:
    return entry[1:4]  # URL key, time, record


def _as_batch(entries: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*entries)) or [[] for _ in INDEX]
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.string() for f in INDEX]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], INDEX.fieldNames())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted entries of each archive."""
    for batch in batches:
        for k in range(batch.num_rows):
            archive, content = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
            yield _as_batch(sorted((_entry(archive, *r) for r in read_records(content)), key=_order))


def merged(runs: list[list[tuple]]) -> Iterator[tuple]:
    """The entries of sorted runs in order, by a tree of losers: an inner node holds the run that lost
    there, node 0 the winner, and the next entry of the winner plays its way up only."""
    count = len(runs)
    feeds = [iter(r) for r in runs]

    def head(run: int):
        entry = next(feeds[run], None)
        return ((1,), None) if entry is None else ((0, _order(entry), run), entry)

    heads = [head(run) for run in range(count)]
    tree = [-1] * max(count, 1)

    def play(winner: int) -> None:
        node = (winner + count) // 2
        while node:
            if tree[node] < 0:  # the first to arrive, while the tree is built
                tree[node] = winner
                return
            if heads[tree[node]][0] < heads[winner][0]:
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner

    for run in range(count):
        play(run)
    while count and heads[tree[0]][1] is not None:
        run = tree[0]
        yield heads[run][1]
        heads[run] = head(run)
        play(run)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range of all runs, merged."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for entry in zip(*(batch.column(k).to_pylist() for k in range(len(INDEX)))):
            runs.setdefault(entry[0], []).append(entry)
    for run in runs.values():
        # A run's piece arrives in order unless it was fetched in several blocks.
        if any(_order(b) < _order(a) for a, b in zip(run, run[1:])):
            run.sort(key=_order)
    out: list[tuple] = []
    for entry in merged(list(runs.values())):
        out.append(entry)
        if len(out) == 10_000:
            yield _as_batch(out)
            out = []
    yield _as_batch(out)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The index of the archives in a folder, in the order of URL key, time and record: one entry per
    record with its place (archive, offset and length in the archive's text), type, URL, key, payload
    digest and bytes, and for revisits the record that is referred to."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    runs = stored(files.mapInArrow(_runs, INDEX), "runs")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(runs.count() / RANGE))
    return stored(runs.repartitionByRange(tasks, "url_key", "at", "record").mapInArrow(_merge, INDEX), "index")


def capture_report(index: DataFrame, key: T.DataType) -> DataFrame:
    """(key, url, payload_bytes, payload_digest, record_type, refers_to) per capture; ``refers_to`` is the
    key of the response that a revisit refers to."""
    responses = index.where("type = 'response'").select(c("record").alias("target"), c("key").alias("refers_to"))
    # Responses refer to nothing and need not meet in the join.
    own = index.where("type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("string"))
    again = index.where("type = 'revisit'").join(responses, c("refers") == c("target"), "left").drop("target")
    return own.unionByName(again).select(
        c("key").cast(key).alias("key"),
        "url",
        "payload_bytes",
        "payload_digest",
        c("type").alias("record_type"),
        c("refers_to").cast(key).alias("refers_to"),
    )


def round_trip(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", at: Column | None = None, least: int = 1000
) -> DataFrame:
    """``pages`` written to archives in the scratch folder and read back as a capture report."""
    spark = pages.sparkSession
    folder = f"{scratch_folder(spark)}/archives"
    write_archives(pages, folder, key, url, payload, at, least)
    return capture_report(read_archives(spark, folder), pages.schema[key].dataType)
