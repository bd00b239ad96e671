"""Spelling variants of words: neighbours one edit apart, found along a trie.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The trie of
all words is a table of edges, and states (spelled, node, wanted, rest) walk down it, a level at a time:

* A word's own prefix needs no search. From depth ``len / 2`` on it leaves its path in two ways: the next
  code point is replaced by a smaller one (an edge beside its own; ``wanted`` is null), or it is left out.
* From then on, the one edit spent, ``rest`` must match edge by edge.
* A state goes on only if the code point after the next is among the edges that follow; one whose rest
  ends where a word ends has found a neighbour.

Words are spelled forwards and backwards, as two tries. A neighbour that shares less than the first half
of a word shares the last half, so edits are only made in the second half of a spelling, where the trie is
thin. It is enough to replace by smaller code points and to leave out: the other word of a pair finds the
rest. A run of one code point is shortened at its end only.

Words of more than DEEP code points would need as many levels. They meet through their variants with one
code point left out, which are hashed in one pass (sums of powers); two words of equal length with the
same variant at the same place differ there, and a variant that is a word is one deletion away. Each such
pair is then compared.

Null texts have no words, a null id counts as empty text, rows are counted each on its own however equal,
other columns are ignored, and a table without words has no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.llm.common import ascii_lower, stored

DEEP = 48
END = "$"  # behind every spelled word; no letter
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that they can be divided by
c = F.col


def counted_words(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): the words of at least ``shortest`` code points and ``least`` occurrences. If ``every``
    divides crc32("id:run"), that number modulo the run's length is the place of a code point to drop."""
    runs = F.regexp_extract_all(c("text"), F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    told = docs.select(F.coalesce(c(key).cast("string"), F.lit("")).alias("id"), c(text).alias("text"))
    run = told.select("id", F.explode(runs).alias("run")).select("id", ascii_lower(c("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    word = F.when(c("h") % every == 0, shorter).otherwise(c("run"))
    words = run.withColumn("h", h).withColumn("at", at).select(word.alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(c("n") >= least)


def _char(text: Column, at) -> Column:
    """The code point at a place counted from 0; empty beyond the end."""
    return F.substring(text, at + 1, F.lit(1))


def spellings(words: DataFrame) -> DataFrame:
    """(spelled, size, start): direction, letters and END; edits start at that depth."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    forward = words.select(F.concat(F.lit(">"), "word", F.lit(END)).alias("spelled"), size.alias("size"), half.alias("start"))
    back = words.select(
        F.concat(F.lit("<"), F.reverse("word"), F.lit(END)).alias("spelled"), size.alias("size"), (size - half).alias("start")
    )
    return forward.union(back)


def edges(spelled: DataFrame, depth: int) -> DataFrame:
    """(from, edge, follow): the edges that leave the nodes of a depth, and the edges behind each."""
    own = spelled.where(c("size") >= depth).select(
        F.left("spelled", F.lit(depth + 1)).alias("from"),
        _char(c("spelled"), F.lit(depth + 1)).alias("edge"),
        _char(c("spelled"), F.lit(depth + 2)).alias("then"),
    )
    return own.groupBy("from", "edge").agg(F.array_join(F.collect_set("then"), "").alias("follow"))


def leaving(spelled: DataFrame, depth: int) -> DataFrame:
    """(spelled, node, own, rest): the states that leave their word's path at a depth; ``own`` is the
    code point that a smaller one replaces, null where it is left out."""
    at = spelled.where((c("start") <= depth) & (c("size") > depth)).select(
        "spelled",
        F.left("spelled", F.lit(depth + 1)).alias("node"),
        _char(c("spelled"), F.lit(depth + 1)).alias("own"),
        F.expr(f"substring(spelled, {depth + 3})").alias("rest"),
    )
    left_out = at.where(c("own") != F.left("rest", F.lit(1))).withColumn("own", F.lit(None).cast("string"))
    return at.union(left_out)


def step(states: DataFrame, spelled: DataFrame, depth: int) -> DataFrame:
    """The states of the next depth; those that have found a neighbour have no rest."""
    taken, rest = F.left("rest", F.lit(1)), F.expr("substring(rest, 2)")
    replaced = c("own").isNotNull()
    rest = F.when(replaced, c("rest")).otherwise(rest)
    fits = F.when(replaced, (c("edge") < c("own")) & (c("edge") != END)).otherwise(c("edge") == taken)
    # The end of a word taken, nothing is left; else what comes next must follow the edge.
    follows = (rest == "") | (F.instr(c("follow"), F.left(rest, F.lit(1))) > 0)
    node = F.when(c("edge") == END, c("node")).otherwise(F.concat("node", "edge"))
    joined = states.join(edges(spelled, depth), c("node") == c("from")).where(fits & follows)
    return joined.select(
        "spelled", node.alias("node"), F.lit(None).cast("string").alias("own"), F.when(rest == END, "").otherwise(rest).alias("rest")
    )


def _word_of(spelling: Column) -> Column:
    letters = F.regexp_replace(spelling, r"^[<>]|\$$", "")
    return F.when(F.left(spelling, F.lit(1)) == "<", F.reverse(letters)).otherwise(letters)


def trie_pairs(words: DataFrame) -> DataFrame:
    """(word, near): each pair of near words of up to DEEP code points at least once."""
    spelled = stored(spellings(words.where(F.length("word") <= DEEP)), "spellings")
    sizes = spelled.agg(F.min("start").alias("low"), F.max("size").alias("high")).first()
    if sizes["low"] is None:
        return words.select("word", c("word").alias("near")).limit(0)
    found, going = [], None
    for depth in range(sizes["low"], sizes["high"] + 1):
        states = leaving(spelled, depth)
        level = stored(step(states if going is None else states.union(going), spelled, depth), f"level_{depth}")
        going = level.where("rest <> ''")
        found.append(level.where("rest = ''").select("spelled", "node"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.select(_word_of(c("spelled")).alias("word"), _word_of(c("node")).alias("near"))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, place, h1, h2): hashes of a word (place -1) and of it without each of its code points."""
    with np.errstate(over="ignore"):
        factors = [np.uint64(f) for f in _FACTORS]
        inverse = [np.uint64(pow(f, -1, 1 << 64)) for f in _FACTORS]
        for batch in batches:
            for word in batch.column(0).to_pylist():
                codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
                hashes = []
                for factor, back in zip(factors, inverse):
                    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(codes) - 1, factor)]))
                    before = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers)])
                    without = before[:-1] + (before[-1] - before[1:]) * back
                    hashes.append(np.concatenate([before[-1:], without]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([word] * (len(codes) + 1)), pa.array(np.arange(-1, len(codes))), *map(pa.array, hashes)],
                    ["word", "place", "h1", "h2"],
                )


def long_pairs(words: DataFrame) -> DataFrame:
    """(word, near): each pair of near words of which one has more than DEEP code points."""
    long = words.where(F.length("word") >= DEEP).select("word")
    hashed = stored(long.mapInArrow(_variants, "word string, place long, h1 long, h2 long"), "variants")
    hashed = hashed.withColumn("size", F.length("word"))
    other = hashed.select(c("word").alias("near"), *[c(x).alias(f"o_{x}") for x in ("place", "h1", "h2", "size")])
    same = (c("h1") == c("o_h1")) & (c("h2") == c("o_h2"))
    replaced = hashed.join(other, same & (c("size") == c("o_size")) & (c("place") == c("o_place"))).where(
        "place >= 0 AND word > near"
    )
    left_out = hashed.where("place >= 0").join(other.where("o_place = -1"), same & (c("size") == c("o_size") + 1))
    pairs = replaced.union(left_out)
    differ = F.when(
        c("size") == c("o_size"), F.expr("substring(word, place + 2) = substring(near, place + 2)")
    ).otherwise(F.expr("substring(word, place + 2) = substring(near, place + 1)"))
    equal = F.expr("left(word, int(place)) = left(near, int(place))") & differ
    return pairs.where(equal & (c("size") > DEEP)).select("word", "near")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of near words, both ways."""
    pairs = trie_pairs(words).union(long_pairs(words))
    return pairs.union(pairs.select("near", "word")).distinct()


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of a table (word, n).

    A word's form is its most frequent near word (ties: the smallest), if that is at least ``times`` as
    frequent; its root is where the forms lead. Frequencies grow by ``times`` with each form, so a way
    has at most log(n) of them, and each round doubles the part of it that has been walked.
    """
    near = neighbours(words).join(words.select(c("word").alias("near"), c("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-c("near_n")).alias("less"), "near")).alias("best")
    )
    fits = -c("best.less") >= times * c("n")
    told = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.when(fits, c("best.near")).alias("form"),
            F.when(fits, -c("best.less")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        ),
        "forms",
    )
    ways = told.where("form is not null").select("word", c("form").alias("root"))
    while True:
        on = ways.select(c("word").alias("at"), c("root").alias("beyond"))
        ways = stored(
            ways.join(on, c("root") == c("at"), "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), c("beyond").isNotNull().alias("moved")
            ),
            "roots",
        )
        moved = ways.where("moved").limit(1).count()
        ways = ways.drop("moved")
        if not moved:
            break
    return told.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))
