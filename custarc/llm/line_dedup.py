"""Lines repeated across documents, found with levelled sorted runs of line hashes.

A run is a stored table (h1, h2, n) sorted by hash: n documents of one or more batches hold a
line with that key. A new batch merge-anti-joins the lines that a run already proves frequent,
and adds the rest as its own run. When a level has ``fanout`` runs they are merged into one run
of the next level, so a line is rewritten once per level and not once per batch.

Null or empty text is one empty line. Blank lines have no key and always stay. Copies of a
document count as documents of their own; a line repeated in one document counts once. An empty
table gives empty runs and an empty result. Other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.llm.common import BLANKS, ascii_lower, hash128, row_hashes, stored, whole_rows
from custarc.sinks.tables import scratch_folder, write_table

KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _key_hashes(lines: Column) -> Column:
    """Hashes of each line's key; null for a blank line. Keys are made in a step of their own,
    as a function of a line computes again whatever it names twice."""

    def hashes(key: Column) -> Column:
        h1, h2 = hash128(key)
        return F.when(F.length(key) >= 1, F.struct(h1.alias("h1"), h2.alias("h2")))

    return F.transform(F.transform(lines, line_key), hashes)


def line_counts(docs: DataFrame, text: str = "text", by: list[Column] | None = None) -> DataFrame:
    """(h1, h2, n): in how many documents each line occurs; also per value of ``by``."""
    extra = by or []
    names = [f"b{i}" for i in range(len(extra))]
    keys = F.array_distinct(F.filter(_key_hashes(lines_of(F.col(text))), lambda k: k.isNotNull()))
    return (
        docs.select(*[b.alias(n) for b, n in zip(extra, names)], F.explode(keys).alias("k"))
        .select(*names, "k.h1", "k.h2")
        .groupBy(*names, *KEY)
        .agg(F.count("*").alias("n"))
    )


class LineRuns:
    """The runs, under a folder that every executor shares.

    ``runs`` lists (level, path) of the stored runs; handing it to a new object goes on where
    another one stopped.
    """

    def __init__(
        self,
        spark: SparkSession,
        min_docs: int,
        fanout: int = 4,
        folder: str | None = None,
        runs: list[tuple[int, str]] | None = None,
    ):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder = folder or scratch_folder(spark)
        self.runs: list[tuple[int, str]] = list(runs or [])
        self._made = len(self.runs)

    def _read(self, paths: list[str]) -> DataFrame:
        schema = "h1 long, h2 long, n long"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, level: int) -> None:
        self._made += 1
        name = f"L{level}-{self._made}"
        write_table(df.sortWithinPartitions(*KEY), self.folder, name)
        self.runs.append((level, f"{self.folder}/{name}"))

    def add(self, counts: DataFrame) -> None:
        """Take in the line counts of one batch."""
        settled = self._read([p for _, p in self.runs]).where(F.col("n") >= self.min_docs).select(*KEY)
        fresh = counts.join(settled.hint("merge"), KEY, "left_anti") if self.runs else counts
        self._write(fresh.select(*KEY, "n"), 0)
        self._compact()

    def _compact(self) -> None:
        for level in range(len(self.runs)):
            full = [p for at, p in self.runs if at == level]
            if len(full) < self.fanout:
                continue
            self.runs = [(at, p) for at, p in self.runs if at != level]
            self._write(self._merged(full), level + 1)

    def _merged(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy(*KEY).agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        """Hashes of the lines found in at least ``min_docs`` documents so far."""
        paths = [p for _, p in self.runs]
        found = self._merged(paths) if len(paths) > 1 else self._read(paths)
        return found.where(F.col("n") >= self.min_docs).select(*KEY)


def collect_lines(docs: DataFrame, min_docs: int, text: str = "text", batches: int = 4, fanout: int = 4) -> LineRuns:
    """Feed a whole table through the runs in ``batches`` parts; the texts are read once."""
    part = F.pmod(F.xxhash64(F.lit(2), F.col(text)), F.lit(batches))
    counts = stored(line_counts(docs, text, [part]), "line_counts")
    runs = LineRuns(docs.sparkSession, min_docs, fanout)
    for k in range(batches):
        runs.add(counts.where(F.col("b0") == k).select(*KEY, "n"))
    return runs


def mark_lines(docs: DataFrame, frequent: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, n_lines, n_dropped, kept): each document as struct ``row``, and its text without
    the frequent lines. Only hashes and positions of lines are shuffled, and each text once."""
    rows = whole_rows(docs, key, text)
    lines = lines_of(F.col(text))
    at = (
        docs.select(
            *row_hashes(key, text),
            F.posexplode(_key_hashes(lines)).alias("at", "k"),
        )
        .where("k is not null")
        .select("h1", "h2", "at", F.col("k.h1").alias("k1"), F.col("k.h2").alias("k2"))
    )
    repeated = frequent.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    hits = (
        at.join(repeated, ["k1", "k2"], "left_semi")
        .groupBy("h1", "h2")
        .agg(F.collect_set("at").alias("drop"))
    )
    joined = rows.join(hits, ["h1", "h2"], "left").select("row", "drop")
    text_lines = lines_of(F.col("row").getField(text))
    marked = joined.select("row", text_lines.alias("lines"), F.coalesce("drop", F.array().cast("array<int>")).alias("drop"))
    # array_except hashes the positions, so a long document costs time in proportion to its lines.
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    return marked.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("drop").cast("long").alias("n_dropped"),
        F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n").alias("kept"),
    )


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with every line removed that at least ``min_docs`` documents hold; null stays null."""
    marked = mark_lines(docs, collect_lines(docs, min_docs, text).frequent(), text, key)

    def column(name: str) -> Column:
        old = F.col("row").getField(name)
        return F.when(old.isNotNull(), F.col("kept")).alias(name) if name == text else old.alias(name)

    return marked.select(*map(column, docs.columns))
