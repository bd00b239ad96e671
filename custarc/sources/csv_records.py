"""CSV files with line breaks inside quotes, read by many tasks.

Spark splits text files at line ends, but a line end may lie inside a quoted value, and a split can't
tell by itself. So the file is read twice.

1. Every split reports where its last line ends, inside quotes or not, for both ways it may begin:
   two bits. These are put together over the splits of a file, a row per split: what a split begins
   with follows from the last split that ends the same either way and the number of those since then
   that turn one into the other.
2. Knowing how it begins, every split puts its lines together into records. What is cut off at its ends
   are fragments, at most two per split, which are joined in the order of the splits.

A record is then parsed by Spark's CSV reader. A task holds a split's lines one by one and a record.
Quotes count only where a value begins with one, and are doubled inside quotes. Files that separate
lines by CR alone are not read this way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'


def ends_open(line: str, is_open: bool, sep: str) -> bool:
    """Whether the end of a line lies inside quotes, given whether its beginning does."""
    if QUOTE not in line:
        return is_open
    at, end = 0, len(line)
    while True:
        if not is_open:
            if at < end and line[at] == QUOTE:
                at, is_open = at + 1, True
            else:
                at = line.find(sep, at) + len(sep)
                if at < len(sep):
                    return False
                continue
        close = line.find(QUOTE, at)
        while close >= 0 and line[close + 1 : close + 2] == QUOTE:
            close = line.find(QUOTE, close + 2)
        if close < 0:
            return True
        # What stands between the closing quote and the separator belongs to the value.
        is_open, at = False, line.find(sep, close + 1) + len(sep)
        if at < len(sep):
            return False


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        for value, path, start in zip(*(batch.column(k).to_pylist() for k in range(3))):
            yield (path, start), value


def _ends(sep: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}
        for split, line in _lines(batches):
            if split not in found:
                found[split] = [False, True, line.endswith("\r")]
            ends = found[split]
            ends[:2] = ends_open(line, ends[0], sep), ends_open(line, ends[1], sep)
        rows = [(*split, *ends) for split, ends in found.items()]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("path", "start", "if_closed", "if_open", "crlf"), r)) for r in rows],
            pa.schema([("path", pa.string()), ("start", pa.int64()), *[(n, pa.bool_()) for n in ("if_closed", "if_open", "crlf")]]),
        )

    return run


def beginnings(ends: DataFrame) -> DataFrame:
    """(path, start, begins_open, crlf) of the splits: whether each begins inside quotes, and whether
    its file's first line ends with CR LF."""
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("if_closed") & ~F.col("if_open")
    told = ends.withColumn("turns", F.sum(turns.cast("int")).over(order))
    settled = F.when(F.col("if_closed") == F.col("if_open"), F.struct(F.col("if_closed").alias("open"), "turns"))
    last = F.last(settled, ignorenulls=True).over(before)
    seen = told.withColumns({"last": last, "turned": F.coalesce(F.max("turns").over(before), F.lit(0))})
    since = F.col("turned") - F.coalesce("last.turns", F.lit(0))
    open_then = F.coalesce(F.col("last.open"), F.lit(False)).cast("int")
    return seen.select(
        "path", "start", ((open_then + since) % 2 == 1).alias("begins_open"), F.first("crlf").over(order).alias("crlf")
    )


_PIECES = "path string, start long, place int, kind string, text string"


def _pieces(sep: str, inside: set[tuple[str, int]], crlf: set[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held, split, is_open, cut, place = [], None, False, False, 0

        def add(kind: str) -> None:
            nonlocal place
            text = "\n".join(held)
            held.clear()
            if kind != "record" or text.strip():  # blank lines are no records
                out.append((*split, place, kind, text))
                place += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], ["path", "start", "place", "kind", "text"])

        for at, line in _lines(batches):
            if at != split:
                if held:
                    add("through" if cut else "tail")
                split, place = at, 0
                is_open = cut = at in inside
            held.append(line[:-1] if at[0] in crlf and line.endswith("\r") else line)
            is_open = ends_open(line, is_open, sep)
            if not is_open:
                add("head" if cut else "record")
                cut = False
            if len(out) >= 4096:
                yield batch_of()
        if held:
            add("through" if cut else "tail")
        yield batch_of()

    return run


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(path, is_first, text): the records of a file, or of all files of a folder; ``is_first`` marks the
    first of each file."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    ends = lines.mapInArrow(_ends(sep), "path string, start long, if_closed boolean, if_open boolean, crlf boolean")
    # One row per split that begins inside quotes, and per file with CR LF.
    told = beginnings(ends).where("begins_open OR (crlf AND start = 0)").collect()
    inside = {(r.path, r.start) for r in told if r.begins_open}
    crlf = {r.path for r in told if r.crlf}
    pieces = lines.mapInArrow(_pieces(sep, inside, crlf), _PIECES)
    first = (F.col("start") == 0) & (F.col("place") == 0)
    whole = pieces.where("kind = 'record'").select("path", first.alias("is_first"), "text")
    # Fragments are in the order of their splits; each record begins with a tail.
    order = Window.partitionBy("path").orderBy("start", "place")
    cut = pieces.where("kind <> 'record'").withColumn("number", F.sum((F.col("kind") == "tail").cast("int")).over(order))
    joined = cut.groupBy("path", "number").agg(
        F.max(first).alias("is_first"), F.sort_array(F.collect_list(F.struct("start", "place", "text"))).alias("parts")
    )
    joined = joined.select("path", "is_first", F.array_join(F.transform("parts", lambda p: p.text), "\n").alias("text"))
    return whole.union(joined)


def _parsed(texts: DataFrame, options: dict, schema: T.StructType | None) -> DataFrame:
    """A column of records through Spark's CSV reader."""
    spark = texts.sparkSession
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    strings = getattr(texts._jdf, "as")(spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(strings), spark)


def read_records(spark: SparkSession, path: str, sep: str, infer: bool, **options: str) -> DataFrame:
    """A CSV file with a header, or a folder of such files, as a table."""
    found = records(spark, path, sep)
    header = found.where("is_first").orderBy("path").limit(1).select("text")
    options = {**options, "sep": sep, "quote": QUOTE, "escape": QUOTE, "header": False, "inferSchema": False}
    names = _parsed(header, {**options, "header": True}, None).columns
    texts = found.where("NOT is_first").select("text")
    types = [T.StringType()] * len(names)
    if infer:
        inferred = [f.dataType for f in _parsed(texts, {**options, "inferSchema": True}, None).schema]
        types = (inferred + types)[: len(names)]
    return _parsed(texts, options, T.StructType([T.StructField(n, t) for n, t in zip(names, types)]))
