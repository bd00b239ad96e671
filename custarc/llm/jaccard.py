"""Documents linked by the Jaccard similarity of their word shingles.

The overlaps of all documents are the product of the document by shingle incidence matrix with its
transpose. Only the part of it that can reach the threshold is formed, shingle block by shingle
block:

* Documents with equal shingle sets are one class, a row of the matrix.
* Shingles have one global order, the ones that most documents share last. Two sets of similarity
  t or more share a shingle among the first ``n - ceil(t n) + 1`` of either, so only these entries
  are multiplied.
* At first each entry meets the leader of its block only (the class with the most copies), where
  sizes and positions leave room for the overlap; the exact overlap decides. That is linear, and it
  joins nearly all near copies.
* Before that, sketches of the sets discard pairs: a bit is set where a set has a shingle in that
  range of hashes, and each bit that only one set has is a shingle that the other lacks.
* Blocks whose members are all joined by then need nothing more. In the others, members not yet
  joined meet if their sizes and positions leave room for the overlap that the threshold asks for;
  overlap counts are summed over the blocks, and pairs whose sum plus what is left to come stays
  below that bound are discarded. The rest are compared exactly.
* No link leaves its component, so links are counted inside components. Two classes have one; a
  larger component is dealt into parts, and each pair of parts is a tile in which the overlaps of
  all its sets are summed shingle by shingle. A tile returns counts, never pairs.

The global order only decides how much work there is, never the result. It ranks the ORDERED most
frequent shingles; the others go by their hash. All documents are counted, in stretches of four million
words; copies in one stretch count once, and a shingle that a stretch holds once only adds nothing.

Shingles are ``size`` consecutive words, A-Z lower-cased, words split at ASCII blanks; a text with
fewer words is one shingle; null and blank texts have none and link with nothing, not even with
each other. Copies of a document are rows of their own with one component. A missing id never
names a component, unless no member has an id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custarc.llm.common import BLANKS, bit_filter, passes, row_hashes, stored, unpacked, whole_rows
from custarc.llm.components import connected
from custarc.llm.words import SPACED, as_bytes, hashed, lists, ngrams, small_batches

ORDERED = 1 << 17
STRETCH = 4_000_000  # words whose shingles are counted at a time
GRADE = 1 << 55  # above any value of monotonically_increasing_id in 4 million partitions
BAND = 1.05  # sizes in one band differ by less than this factor
PERCENT = 100
CACHED_SETS = 256
TILE = 256  # classes in a part of a component whose links are counted
TILE_SHINGLES = 1 << 20  # and their shingles
SKETCH = 1024  # bits of a set's sketch, one per range of hashes
_RANGE = np.uint64(2**64 // SKETCH)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a sequence of words."""
    return np.unique(ngrams(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def _repeated(sets: list[np.ndarray]) -> pa.RecordBatch:
    """Shingles found in several of the sets, with their numbers. The sets are emptied, and their shingles
    sorted in place, as they are most of what a worker holds."""
    found = np.concatenate(sets)
    sets.clear()
    found.sort()
    same = found[1:] == found[:-1]
    # A shingle begins where it differs from the one before and equals the one behind.
    begins = np.flatnonzero(same & ~np.concatenate([[False], same[:-1]]))
    ends = np.flatnonzero(same & ~np.concatenate([same[1:], [False]])) + 2
    return pa.RecordBatch.from_arrays(
        [pa.array(found[begins].view(np.int64)), pa.array((ends - begins).astype(np.int64))], names=["token", "n"]
    )


def _counts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Shingles found in several different sets of a stretch of a partition, with their numbers."""
    sets, seen, held = [], set(), 0
    for whole in batches:
        for batch in small_batches(whole):
            for _, _, words in hashed(as_bytes(batch["text"]), SPACED):
                found = shingle_set(words, size)
                # Copies are one set, as they are one class.
                digest = xxhash.xxh3_128_digest(found.tobytes())
                if digest not in seen:
                    seen.add(digest)
                    sets.append(found)
                held += len(words)
                if held > STRETCH:
                    yield _repeated(sets)
                    seen, held = set(), 0
    if sets:
        yield _repeated(sets)


def frequent_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Two rows: at most ORDERED shingles with the highest counts by hash, and their ranks."""
    counted = docs.select("text").mapInArrow(lambda b: _counts(b, size), "token long, n long")
    total = stored(counted.groupBy("token").agg(F.sum("n").alias("n")), "shingle_counts")
    # How many shingles there are of each order of magnitude says which counts can be taken.
    grade = F.floor(F.log2("n") * 8)
    room, most, part = ORDERED, None, None
    for g, n in sorted(map(tuple, total.groupBy(grade).count().collect()), reverse=True):
        if n > room:
            part = g
            break
        room, most = room - n, g
    top = total.where(grade >= most if most is not None else F.lit(False))
    if part is not None and room:
        # What room is left goes to the most frequent of the next order of magnitude.
        top = top.union(total.where(grade == part).orderBy(F.desc("n"), "token").limit(room))
    top = top.toPandas()
    token = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    return np.stack([token[order], top["n"].to_numpy(np.uint64)[order]])


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, percent: int, frequent) -> Iterator[pa.RecordBatch]:
    token, rank = frequent.value
    for whole in batches:
        for batch in small_batches(whole):
            n, s1, s2, cold, prefix, bits = [], [], [], [], [], []
            for _, _, words in hashed(as_bytes(batch["text"]), SPACED):
                found = shingle_set(words, size)
                digest = xxhash.xxh128_intdigest(found.tobytes()) if len(found) else 0
                n.append(len(found))
                s1.append(digest >> 64)
                s2.append(digest & (2**64 - 1))
                length = len(found) - -(-len(found) * percent // PERCENT) + 1 if len(found) else 0
                place = np.searchsorted(token, found)
                place[place == len(token)] = 0
                is_hot = token[place] == found if len(token) else np.zeros(len(found), bool)
                front = found[~is_hot]
                cold.append(min(length, len(front)))
                if len(front) < length:
                    hot = found[is_hot]
                    hot = hot[np.argsort(rank[place[is_hot]], kind="stable")]
                    front = np.concatenate([front, hot])
                prefix.append(front[:length])
                ranges = np.zeros(SKETCH, bool)
                ranges[found // _RANGE] = True
                bits.append(np.packbits(ranges).view(np.uint64))
            columns = [batch[c] for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            columns += [pa.array(n, pa.int32()), pa.array(np.array(s1, np.uint64).view(np.int64)), pa.array(np.array(s2, np.uint64).view(np.int64))]
            columns += [pa.array(cold, pa.int32()), lists(prefix, pa.int64()), lists(bits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n", "s1", "s2", "cold", "prefix", "bits"])


def _texts(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """The rows whose hash passes the filter."""
    for batch in batches:
        keep = passes(wanted.value, batch["h1"].to_numpy(zero_copy_only=False).view(np.uint64))
        yield batch.filter(pa.array(keep))


class _Sets(dict):
    """Shingle sets of the texts last seen; a full cache starts anew."""

    def of(self, key: int, text: str, size: int) -> np.ndarray:
        if key not in self:
            if len(self) >= CACHED_SETS:
                self.clear()
            ((_, _, words),) = hashed([text.encode()], SPACED)
            self[key] = shingle_set(words, size)
        return self[key]


def _linked(size: int, percent: int):
    """A function of (a, text of a, b, text of b): whether their shingle sets reach the similarity."""

    @F.pandas_udf(T.BooleanType())
    def linked(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        sets = _Sets()
        for rows in batches:
            out = []
            for a, text_a, b, text_b in zip(*rows):
                one, other = sets.of(a, text_a, size), sets.of(b, text_b, size)
                common = len(np.intersect1d(one, other, assume_unique=True))
                out.append(PERCENT * common >= percent * (len(one) + len(other) - common))
            yield pd.Series(out, dtype=bool)

    return linked


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may reach the similarity, going by sizes and sketches."""
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def most_common(one: str, other: str):
        missing = F.zip_with(f"bits_{one}", f"bits_{other}", lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
        return F.col(f"n_{one}") - F.aggregate(missing, F.lit(0), lambda a, x: a + x)

    common = F.least(most_common("a", "b"), most_common("b", "a"), "n_a", "n_b")
    return pairs.where(common * (PERCENT + percent) >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _texts_of(names: DataFrame, plain: DataFrame) -> DataFrame | None:
    """(h1, h2, text) of at least the rows that ``names`` lists by h1; None if it lists none."""
    needed = names.select("h1").distinct()
    count = needed.count()
    if not count:
        return None
    bits = min(30, max(16, math.ceil(math.log2(count * 64))))
    wanted = plain.sparkSession.sparkContext.broadcast(bit_filter(needed, "h1", bits))
    found = plain.select("h1", "h2", "text").mapInArrow(lambda b: _texts(b, wanted), "h1 long, h2 long, text string")
    # Copies equal in id and text are found more than once.
    return found.groupBy("h1", "h2").agg(F.min("text").alias("text"))


def _verified(pairs: DataFrame, rows: DataFrame, plain: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the similarity. Their texts are read again,
    as a text takes less than half the room of its set; a bit filter finds them without a shuffle
    of all texts."""
    names = rows.select("cid", "h1", "h2")
    for side in ("a", "b"):
        pairs = pairs.join(names.toDF(side, f"h1_{side}", f"h2_{side}"), side)
    pairs = stored(pairs, "pairs_to_verify")
    texts = _texts_of(pairs.select(F.explode(F.array("h1_a", "h1_b")).alias("h1")), plain)
    if texts is None:
        return pairs.select("a", "b")
    for side in ("a", "b"):
        pairs = pairs.join(texts.toDF(f"h1_{side}", f"h2_{side}", f"text_{side}"), [f"h1_{side}", f"h2_{side}"])
    return pairs.where(_linked(size, percent)("a", "text_a", "b", "text_b")).select("a", "b")


def _entries(rows: DataFrame) -> DataFrame:
    """(token, cid, n, at, frequent) of the prefixes."""
    return rows.select("cid", "n", "cold", F.posexplode("prefix").alias("at", "token")).select(
        "token", "cid", "n", "at", (F.col("at") >= F.col("cold")).alias("frequent")
    )


def _shared(rows: DataFrame) -> DataFrame:
    """Entries whose shingle stands in several prefixes, with the leader of their block."""
    entries = _entries(rows)
    # Shingles beyond the frequent ones have small blocks: one shuffle is enough.
    block = W.partitionBy("token")
    leader = F.min(F.struct("cid", "n", "at"))
    cold = entries.where("NOT frequent").drop("frequent").select(
        "*", F.count("*").over(block).alias("members"), leader.over(block).alias("leader")
    )
    # A frequent one may have a block of any size: count it map side, then join back.
    often = entries.where("frequent").drop("frequent")
    blocks = often.groupBy("token").agg(F.count("*").alias("members"), leader.alias("leader"))
    hot = often.join(blocks.where("members > 1"), "token")
    return cold.where("members > 1").unionByName(hot).drop("members")


def _open_pairs(shared: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes not joined so far whose summed overlap can still reach the threshold."""
    t = percent / PERCENT
    entries = shared.drop("leader").join(joined, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    still = entries.groupBy("token").agg(
        F.min("label").alias("l1"), F.max("label").alias("l2"), F.min("n").alias("least")
    )
    # An entry at position i leaves n - i shingles, so its partner has at most this size.
    most = F.floor((F.col("n") - F.col("at")) * F.lit((PERCENT + percent) / percent) + 1e-6) - F.col("n")
    live = (
        entries.join(still.where("l1 != l2").select("token", "least"), "token")
        .withColumn("most", most)
        .where("most >= least")
        .drop("least")
    )
    band = F.floor(F.log("n") / math.log(BAND)).cast("int")
    short = live.select("token", *[F.col(c).alias(f"{c}_b") for c in ("cid", "n", "at", "most", "label")], band.alias("band"))
    low = F.floor(F.log(F.greatest(F.ceil(F.col("n") * t - 1e-6), F.lit(1))) / math.log(BAND)).cast("int")
    high = F.floor(F.log(F.greatest(F.least("n", "most"), F.lit(1))) / math.log(BAND)).cast("int")
    long = (
        live.where(F.col("most") >= F.col("n") * t - 1e-6)
        .select("token", *[F.col(c).alias(f"{c}_a") for c in ("cid", "n", "at", "most", "label")], low.alias("low"), high.alias("high"))
        .where("high >= low")
        .withColumn("band", F.explode(F.sequence("low", "high")))
    )
    met = long.join(short, ["token", "band"]).where(
        "label_a != label_b AND (n_b < n_a OR (n_b = n_a AND cid_b < cid_a)) AND n_b <= most_a AND n_a <= most_b"
    )
    # Both prefixes list common shingles in one order, so whatever was not summed stands behind the last.
    pairs = met.groupBy("cid_a", "cid_b", "n_a", "n_b").agg(
        F.count("*").alias("common"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b")
    )
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) - 1
    enough = (F.col("common") + left) * (PERCENT + percent) >= percent * (F.col("n_a") + F.col("n_b"))
    return pairs.where(enough).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"))


def _links_in_tile(size: int, percent: int):
    """A function that counts the links of each class of a tile with the tile's other classes; in a
    tile of two parts only with those of the other part."""

    def count(tile: pa.Table) -> pa.Table:
        part = tile["part"].to_numpy()
        two = tile["low"][0] != tile["high"][0]
        sets = [shingle_set(words, size) for _, _, words in hashed(as_bytes(tile["text"]), SPACED)]
        n = np.array([len(s) for s in sets])
        _, token, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        holder = np.repeat(np.arange(len(sets)), n)[np.argsort(token, kind="stable")]
        begin, ends = np.cumsum(holders) - holders, np.cumsum(n)
        links = np.zeros(len(sets), np.int64)
        for a in range(len(sets)):
            own = token[ends[a] - n[a] : ends[a]]
            many = holders[own]
            at = np.arange(many.sum()) + np.repeat(begin[own] - (np.cumsum(many) - many), many)
            common = np.bincount(holder[at], minlength=len(sets))
            linked = PERCENT * common >= percent * (n[a] + n - common)
            linked[a] = False
            links[a] = np.count_nonzero(linked & (part != part[a]) if two else linked)
        return pa.table({"cid": tile["cid"], "n_links": links})

    return count


def _link_counts(named: DataFrame, plain: DataFrame, size: int, percent: int) -> DataFrame:
    """(cid, n_links): with how many other classes each class of a component of several is linked."""
    sizes = named.groupBy("component").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("classes") / TILE, F.col("shingles") / TILE_SHINGLES))
    inside = named.join(sizes.where("classes > 1").select("component", "classes", parts.alias("parts")), "component")
    pairs = inside.where("classes = 2").select("cid", F.lit(1).cast("long").alias("n_links"))
    many = stored(
        inside.where("classes > 2").select(
            "component", "parts", "cid", "h1", "h2", F.pmod(F.xxhash64("cid"), "parts").alias("part")
        ),
        "classes_to_count",
    )
    texts = _texts_of(many, plain)
    if texts is None:
        return pairs
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    tiles = many.join(texts, ["h1", "h2"]).select("component", "part", "cid", "text", other.alias("other")).select(
        "component", "part", "cid", "text", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    counted = tiles.groupBy("component", "low", "high").applyInArrow(_links_in_tile(size, percent), "cid long, n_links long")
    return pairs.union(counted.groupBy("cid").agg(F.sum("n_links").alias("n_links")))


def near_duplicates(
    docs: DataFrame, percent: int = 80, size: int = 5, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(doc_id, h1, h2, uid, n_shingles, class_id, class_doc_id, component_id, component, n_links): one row
    per document. Documents with equal shingle sets are one class, ``class_doc_id`` its smallest id.
    ``component`` names a component even if no member has an id; rows without words have none. ``n_links``
    is the number of other classes that its class is linked with."""
    found, named, plain = _in_components(docs, percent, size, text, key)
    links = stored(_link_counts(named, plain, size, percent), "class_links").withColumnRenamed("cid", "class_id")
    return found.join(links, "class_id", "left").select(*found.columns, F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _in_components(docs: DataFrame, percent: int, size: int, text: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What near_duplicates returns without the links; the classes with their components; the texts."""
    context = docs.sparkSession.sparkContext
    plain = docs.select(F.col(key).alias("doc_id"), *row_hashes(key, text), F.col(text).alias("text"))
    frequent = context.broadcast(frequent_shingles(plain, size))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    rows = stored(
        plain.mapInArrow(
            lambda b: _prefixes(b, size, percent, frequent),
            f"doc_id {id_type}, h1 long, h2 long, n int, s1 long, s2 long, cold int, prefix array<long>, bits array<long>",
        ).withColumn("uid", F.monotonically_increasing_id()),
        "shingle_prefixes",
    )
    grade = 15 - F.least(F.floor(F.log2(F.count("*"))), F.lit(15))
    classes = stored(
        rows.where("n > 0").groupBy("s1", "s2").agg(
            F.min(F.struct("uid", "h1", "h2", "n")).alias("first"), F.min("doc_id").alias("least_id"), grade.alias("grade")
        ).select("s1", "s2", "first.*", "least_id", (F.col("first.uid") + F.col("grade") * F.lit(GRADE)).alias("cid")),
        "shingle_classes",
    )
    members = rows.join(classes.select("uid", "cid"), "uid").select("cid", "h1", "h2", "n", "cold", "prefix", "bits")
    shared = stored(_shared(members.select("cid", "n", "cold", "prefix")), "shared_shingles")
    sketches = stored(
        members.select("cid", "h1", "h2", "n", "bits").join(shared.select("cid").distinct(), "cid", "left_semi"),
        "sketches",
    )
    # A leader is met where sizes and positions leave room; any other pair stays open.
    room = F.least(F.col("n") - F.col("at"), F.col("leader.n") - F.col("leader.at"))
    led = (
        shared.where("cid != leader.cid")
        .where(room * (PERCENT + percent) >= percent * (F.col("n") + F.col("leader.n")))
        .select(F.col("leader.cid").alias("a"), F.col("cid").alias("b"))
        .distinct()
    )
    led = stored(_possible(led, sketches, percent), "leader_pairs")
    first = stored(_verified(led, sketches, plain, size, percent), "leader_links")
    # Classes that hang together through any leaders are not compared again.
    joined = stored(connected(first), "leader_components").select(F.col("node").alias("cid"), F.col("component").alias("label"))
    rest = stored(_possible(_open_pairs(shared, joined, percent), sketches, percent), "open_pairs")
    second = _verified(rest, sketches, plain, size, percent)
    component = connected(first.union(second))
    named = stored(
        classes.join(component, classes.cid == component.node, "left").withColumn(
            "component", F.coalesce("component", "cid")
        ),
        "components",
    )
    names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(names, "component").select(
        "s1", "s2", F.col("cid").alias("class_id"), F.col("least_id").alias("class_doc_id"), "component", "component_id"
    )
    found = rows.select("doc_id", "h1", "h2", "uid", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left")
    found = found.select(
        "doc_id", "h1", "h2", "uid", F.col("n").cast("long").alias("n_shingles"), "class_id",
        F.when(F.col("n") > 0, F.col("class_doc_id")).otherwise(F.col("doc_id")).alias("class_doc_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "component",
    )
    return found, named, plain


def keep_one(docs: DataFrame, percent: int = 80, size: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: the one with its smallest id. Rows without
    words all stay; of rows with words that are equal in id and text, one stays."""
    found, _, _ = _in_components(docs, percent, size, text, key)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    node = F.when(F.col("component_id").isNull(), F.col("component"))
    kept = found.where("component is not null").groupBy("component_id", node).agg(
        F.min(F.struct(first.alias("first"), "h1", "h2")).alias("k")
    ).select("k.h1", "k.h2")
    # Equal rows without words are groups of their own, so they are not merged.
    blank = F.length(F.translate(F.coalesce(F.col(text), F.lit("")), BLANKS, "")) == 0
    alone = docs.where(blank)
    one_each = whole_rows(docs.where(~blank), key, text).groupBy("h1", "h2").agg(F.min("row").alias("row"))
    return unpacked(one_each.join(kept, ["h1", "h2"], "left_semi"), docs.columns).union(alone)
