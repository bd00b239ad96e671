"""The cheapest repair of a conversation's turn structure, by branch and bound.

After a repair the role initials of a conversation read ``(s?(ua)+)?``: nothing, or user and assistant
in turn, perhaps after one system row. Rows are kept (0), given the role user or assistant (3), deleted
(4), and rows with empty text are inserted (3). A row's first fault counts: ``blank`` (no visible
character), ``duplicate`` (role and text seen earlier in the conversation), ``truncated`` (the last
visible character ends no sentence). Blank and duplicate rows must go; a truncated row that stays costs
3 more. Of the cheapest repairs the one with the ASCII-least audit (the edits' initials) is taken.

Search. A node is (rows read, state), a state what the grammar has seen: 0 nothing, 1 a system row, 2 a
user row, 3 an assistant row. A depth-first search on an explicit stack tries the cheapest looking edit
first. A prefix goes if its cost and the suffix's lower bound exceed the incumbent (cost, audit), or if
its node has been reached by a better (cost, audit): two prefixes of one node read the same rows, so
neither audit is the beginning of the other and the lesser stays less whatever follows.

Any length. Rows are put in order by range partitioning and numbered; a conversation of more than STRETCH
rows falls into stretches, each searched for every state it may begin and end in. Stretches are folded
FAN at a time, by cost and by the rank of their audits, level by level, and the chosen way is unfolded
the same way down. So no task holds more than a stretch, or FAN folded stretches, of a conversation.

Order and nulls. Rows are ordered by turn, nulls first, then by role and a hash of the text. Null role
and text count as one space, which is blank and no legal initial. Rows equal in all four columns become
one row with a count: all but the first are duplicates. A null conversation id is a conversation of its
own. Other columns are left out; an empty table has no repair.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custarc.llm.common import BLANKS, hash128, stored

STRETCH = 128
FAN = 64
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
END = 9  # the state after the last row of a conversation and its closing inserts
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state: initial: state
WANTED = "uuau"  # by state: the role that a renamed or inserted row gets
LATER = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))  # states that can be reached
LEGAL = frozenset(("su", "ua", "au"))
c = F.col

# Steps of a repair: D delete, I and J insert user and assistant, K keep, R and S rename to user and
# assistant. Where two repairs part they are in one state, so steps compare as their audits do.
AUDIT = ("JS", "IR")


def _row_bound(code: str) -> int:
    """The least that a row costs. Codes: x a row that must go; else s, u, a or o (another initial),
    as a capital if the text is truncated."""
    if code == "x":
        return DELETE
    cut = TRUNCATED if code.isupper() else 0
    return min(DELETE, (RENAME if code in "oO" else 0) + cut)


def suffix_bounds(codes: str) -> list[int]:
    """For each row a lower bound of what it and the rows after it cost: every row's least, and an
    edit for each of a set of disjoint neighbours that can't both be kept side by side."""
    bounds = [0] * (len(codes) + 1)
    after, beyond = "", 0  # the next row that may stay, and the bound behind it
    for k in range(len(codes) - 1, -1, -1):
        code = codes[k]
        bounds[k] = bounds[k + 1] + _row_bound(code)
        if code == "x":
            beyond += DELETE
            continue
        if after and not {code, after} & set("oO") and code.lower() + after.lower() not in LEGAL:
            edit = min(DELETE - TRUNCATED if x.isupper() else RENAME for x in (code, after))
            bounds[k] = max(bounds[k], beyond + _row_bound(code) + _row_bound(after) + edit)
        after, beyond = code, bounds[k + 1]
    return bounds


@functools.lru_cache(maxsize=20_000)
def search(codes: str, start: int, last: bool) -> dict[int, tuple[int, str]]:
    """{state: (cost, steps)} of the best way from ``start`` through all rows to each state it can
    end in; to END, closing inserts included, if these are the conversation's last rows."""
    bounds, rows = suffix_bounds(codes), len(codes)
    best: dict[tuple[int, int], tuple[int, str]] = {}
    found: dict[int, tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        row, state, cost, steps = stack.pop()
        known = best.get((row, state))
        if known is not None and known <= (cost, steps):
            continue
        least = cost + bounds[row]
        rivals = [found.get(t) for t in ((END,) if last else LATER[state])]
        if all(r is not None and (r[0] < least or r[0] == least and r[1][: len(steps)] < steps) for r in rivals):
            continue
        best[row, state] = cost, steps
        done = row == rows
        if done and (not last or state in (0, 3)):
            goal = END if last else state
            if goal not in found or (cost, steps) < found[goal]:
                found[goal] = cost, steps
            continue
        wanted = WANTED[state]
        into = NEXT[state][wanted]
        children = [(row, into, cost + INSERT, steps + ("I" if wanted == "u" else "J"))]
        if not done:
            code = codes[row]
            children.append((row + 1, state, cost + DELETE, steps + "D"))
            if code != "x":
                paid = cost + (TRUNCATED if code.isupper() else 0)
                kept = NEXT[state].get(code.lower())
                if kept is not None:
                    children.append((row + 1, kept, paid, steps + "K"))
                children.append((row + 1, into, paid + RENAME, steps + ("R" if wanted == "u" else "S")))
        children.sort(key=lambda x: (x[2] + bounds[x[0]], x[3]), reverse=True)
        stack += children
    return found


def illegal_pairs(initials: list[str]) -> int:
    return sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))


def _ranked(ways: dict[tuple[int, int], tuple[int, object]]) -> Iterator[tuple[int, int, int, int, object]]:
    """(s, t, cost, rank, way): the rank orders the ways from s by what they do."""
    for start in {s for s, _ in ways}:
        ends = sorted((t for s, t in ways if s == start), key=lambda t: ways[start, t][1])
        for rank, t in enumerate(ends):
            yield start, t, ways[start, t][0], rank, ways[start, t][1]


def fold(nodes: list[tuple]) -> dict[tuple[int, int], tuple[int, list[int], list[int]]]:
    """{(s, t): (cost, ranks, states)} through consecutive nodes, each a list of (s, t, cost, rank)."""
    ways: dict[tuple[int, int], tuple[int, list[int], list[int]]] | None = None
    for node in nodes:
        if ways is None:
            ways = {(s, t): (cost, [rank], [s, t]) for s, t, cost, rank in node}
            continue
        longer: dict[tuple[int, int], tuple[int, list[int], list[int]]] = {}
        for (first, mid), (cost, ranks, states) in ways.items():
            for s, t, more, rank in node:
                if s == mid:
                    way = (cost + more, [*ranks, rank], [*states, t])
                    if (first, t) not in longer or way[:2] < longer[first, t][:2]:
                        longer[first, t] = way
        ways = longer
    return ways or {}


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["cid", "part", "s", "t", "cost", "rank", "illegal", "head", "tail", "start", "steps"]
    for batch in batches:
        out: list[tuple] = []
        for x in batch.to_pylist():
            last = x["part"] == x["parts"] - 1
            starts = (0,) if x["part"] == 0 else (0, 1, 2, 3)
            ways = {(s, t): way for s in starts for t, way in search(x["codes"], s, last).items()}
            seen = x["initials"]
            edge = (illegal_pairs(seen), seen[0], seen[-1], x["start"])
            out += [(x["cid"], x["part"], s, t, cost, rank, *edge, steps) for s, t, cost, rank, steps in _ranked(ways)]
        columns = list(zip(*out)) or [[] for _ in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, pa.string() if n in ("head", "tail", "steps") else pa.int64()) for n, v in zip(names, columns)], names
        )


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["cid", "part", "s", "t", "cost", "rank", "illegal", "head", "tail", "path"]
    kinds = {"head": pa.string(), "tail": pa.string(), "path": pa.list_(pa.int64())}
    for batch in batches:
        out: list[tuple] = []
        for x in batch.to_pylist():
            nodes: dict[int, list[dict]] = {}
            for way in x["ways"]:  # in order of their part
                nodes.setdefault(way["part"], []).append(way)
            ends = [(n[0]["illegal"], n[0]["head"], n[0]["tail"]) for n in nodes.values()]
            illegal = sum(e[0] for e in ends) + sum(a[2] + b[1] not in LEGAL for a, b in zip(ends, ends[1:]))
            ways = fold([[(w["s"], w["t"], w["cost"], w["rank"]) for w in n] for n in nodes.values()])
            ranked = _ranked({k: (cost, (ranks, states)) for k, (cost, ranks, states) in ways.items()})
            out += [
                (x["cid"], x["part"], s, t, cost, rank, illegal, ends[0][1], ends[-1][2], way[1])
                for s, t, cost, rank, way in ranked
            ]
        columns = list(zip(*out)) or [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(n, pa.int64())) for n, v in zip(names, columns)], names)


_WAYS = "cid long, part long, s long, t long, cost long, rank long, illegal long, head string, tail string"


def visible_end(text: Column) -> Column:
    """The last visible character; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n, fault, at) of a table (conv, turn, role, text): equal rows once with
    their number, and ``at`` numbering all rows of the table in the order of conversations and turns."""
    spark = rows.sparkSession
    spaced = rows.withColumns({x: F.coalesce(x, F.lit(" ")) for x in ("role", "text")})
    equal = spaced.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n"))
    equal = equal.withColumns(dict(zip(("h1", "h2"), hash128(c("text")))))
    turn = F.struct(c("turn").isNotNull().alias("given"), "turn")
    said = ["conv", "role", "h1", "h2"]
    first = equal.groupBy(*said).agg(F.min(turn).alias("first")).select(*[c(x).alias(f"f_{x}") for x in said], "first")
    on = c("conv").eqNullSafe(c("f_conv"))
    for x in said[1:]:
        on = on & (c(x) == c(f"f_{x}"))
    last = visible_end(c("text"))
    fault = (
        F.when(last == "", "blank")
        .when(~turn.eqNullSafe(c("first")), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    order = [c("conv").asc_nulls_first(), c("turn").asc_nulls_first(), c("role"), c("h1"), c("h2")]
    judged = stored(
        equal.join(first, on, "left").select("conv", "turn", "role", "text", "n", "h1", "h2", fault.alias("fault")), "turns"
    )
    placed = stored(
        judged.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
        .drop("h1", "h2")
        .withColumn("k", F.monotonically_increasing_id()),
        "ordered_turns",
    )
    part = F.shiftright("k", 33)
    counts = placed.groupBy(part.alias("task")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("task", F.coalesce(before, F.lit(0)).alias("offset"))  # one row per task
    numbered = placed.withColumn("task", part).join(F.broadcast(offsets), "task")
    at = (c("offset") + c("k").bitwiseAND((1 << 33) - 1)).alias("at")
    return numbered.select("conv", "turn", "role", "text", "n", "fault", at)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repair of a table (conv, turn, role, text).

    Returns (conversations, edits): one row (conv, cid, cost, illegal) per conversation, ``illegal``
    counting neighbouring rows that may not meet, and one row (conv, cid, at, turn, role, text, n, fault,
    steps) per distinct row, in the order of ``at``; ``steps`` are the inserts before the row, its own
    edit, and after the last row the closing inserts. All ``n - 1`` copies of a row are deleted.
    """
    turns = ordered_rows(rows)
    initial = F.left("role", F.lit(1))
    sort = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = (
        F.when(c("fault").isin("blank", "duplicate"), "x").when(c("fault") == "truncated", F.upper(sort)).otherwise(sort)
    )
    met = F.struct("at", code.alias("code"), initial.alias("initial"), (c("n") - 1).alias("more"))
    pieces = turns.groupBy("conv", F.expr(f"at div {STRETCH}").alias("stretch")).agg(
        F.sort_array(F.collect_list(met)).alias("rows")
    )
    pieces = stored(
        pieces.select(
            "conv",
            "stretch",
            c("rows")[0]["at"].alias("start"),
            F.array_join(F.transform("rows", lambda x: x.code), "").alias("codes"),
            F.transform("rows", lambda x: x.initial).alias("initials"),
            # Copies beyond the first: each must go, and each may not stand beside the one before it.
            F.aggregate("rows", F.lit(0).cast("long"), lambda n, x: n + x.more).alias("more"),
        ),
        "stretches",
    )
    whole = pieces.groupBy("conv").agg(
        F.min("stretch").alias("first"), F.count("*").alias("parts"), F.min("start").alias("cid"), F.sum("more").alias("more")
    )
    whole = stored(whole.withColumnRenamed("conv", "of"), "whole")
    parts = pieces.drop("more").join(whole.drop("more"), c("conv").eqNullSafe(c("of"))).withColumn("part", c("stretch") - c("first"))
    ways = stored(
        parts.select("cid", "part", "parts", "start", "codes", "initials").mapInArrow(
            _searched, f"{_WAYS}, start long, steps string"
        ),
        "ways",
    )
    single, chosen, top = _unfold(ways, whole)
    steps = single.unionByName(chosen)
    tokens = F.regexp_extract_all("steps", F.lit(r"[IJ]*[DKRS](?:[IJ]+$)?"), F.lit(0))
    at_steps = steps.select("cid", "start", F.posexplode(tokens).alias("i", "steps")).select(
        "cid", (c("start") + c("i")).alias("at"), "steps"
    )
    edits = turns.join(at_steps, "at").select("conv", "cid", "at", "turn", "role", "text", "n", "fault", "steps")
    found = whole.join(top, "cid").select(
        c("of").alias("conv"),
        "cid",
        (c("cost") + c("more") * DELETE).alias("cost"),
        (c("illegal") + c("more")).alias("illegal"),
    )
    return found, stored(edits, "edits")


def _unfold(ways: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(steps of conversations in one piece, steps chosen for those in several, (cid, cost, illegal))."""
    sizes = whole.select("cid", "parts")
    sized = ways.join(sizes, "cid")
    alone = sized.where("parts = 1")
    single = alone.select("cid", "start", "steps")
    top = alone.select("cid", "cost", "illegal")
    several = sized.where("parts > 1")
    most = whole.agg(F.max("parts")).first()[0] or 1
    level, levels = several.drop("parts", "start", "steps"), []
    while most > 1:
        struct = F.struct("part", "s", "t", "cost", "rank", "illegal", "head", "tail")
        grouped = level.groupBy("cid", F.expr(f"part div {FAN}").alias("up")).agg(F.sort_array(F.collect_list(struct)).alias("ways"))
        folded = grouped.select("cid", c("up").alias("part"), "ways").mapInArrow(_folded, f"{_WAYS}, path array<long>")
        levels.append(stored(folded, "folded"))
        level = levels[-1].drop("path")
        most = -(-most // FAN)
    empty = ways.where("false").select("cid", "start", "steps")
    if not levels:
        return single, empty, top
    top = top.unionByName(levels[-1].select("cid", "cost", "illegal"))
    chosen = levels[-1].select("cid", "part", "s", "t")
    for one in reversed(levels):
        taken = one.select("cid", "part", "s", "t", "path").join(chosen, ["cid", "part", "s", "t"])
        inner = F.slice("path", F.lit(1), F.size("path") - 1)
        chosen = taken.select("cid", "part", "path", F.posexplode(inner).alias("i", "s")).select(
            "cid", (c("part") * FAN + c("i")).alias("part"), "s", c("path")[c("i") + 1].alias("t")
        )
        chosen = stored(chosen, "chosen")
    return single, several.join(chosen, ["cid", "part", "s", "t"]).select("cid", "start", "steps"), top


def audit_of(steps: Column, n: Column) -> Column:
    """The audit of a row and its copies."""
    own = F.regexp_extract(steps, r"^[IJ]*[DKRS]", 0)
    rest = F.substring(steps, F.length(own) + 1, F.length(steps))
    return F.translate(F.concat(own, F.repeat(F.lit("D"), (n - 1).cast("int")), rest), *AUDIT)


def said_of(steps: Column, role: Column, text: Column) -> Column:
    """What a row becomes, its inserts included: an array of (role, text)."""

    def row(x: Column) -> Column:
        return F.struct(
            F.when(x == "K", role).when(x.isin("I", "R"), "user").otherwise("assistant").alias("role"),
            F.when(x.isin("I", "J"), "").otherwise(text).alias("text"),
        )

    return F.transform(F.filter(F.split(steps, ""), lambda x: x.isin("I", "J", "K", "R", "S")), row)


def repaired_rows(edits: DataFrame) -> DataFrame:
    """(conv, cid, at, i, role, text): the rows of the repaired conversations, in the order of (at, i)."""
    said = said_of(c("steps"), c("role"), c("text"))
    return edits.select("conv", "cid", "at", F.posexplode(said).alias("i", "row")).select(
        "conv", "cid", "at", "i", "row.role", "row.text"
    )


def audits(edits: DataFrame) -> DataFrame:
    """(cid, audit, repaired): all edits of a conversation, and its repaired ``role:text`` rows joined
    by line breaks, each as one value, which Spark holds up to 2 GB."""
    said = said_of(c("steps"), c("role"), c("text"))
    rows = edits.select(
        "cid",
        "at",
        audit_of(c("steps"), c("n")).alias("audit"),
        F.transform(said, lambda x: F.concat(x.role, F.lit(":"), x.text)).alias("said"),
    ).withColumn("said", F.when(F.size("said") > 0, F.array_join("said", "\n")))

    def joined(df: DataFrame, *keys) -> DataFrame:
        parts = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "audit", "said"))).alias("p"))
        return parts.withColumns(
            {
                "audit": F.array_join(F.transform("p", lambda x: x.audit), ""),
                # Null where nothing is left, so that no empty line stands for it.
                "said": F.when(
                    F.exists("p", lambda x: x.said.isNotNull()), F.array_join(F.transform("p", lambda x: x.said), "\n")
                ),
            }
        ).drop("p")

    stretches = joined(rows, "cid", F.expr("at div 1024").alias("stretch")).withColumnRenamed("stretch", "at")
    return joined(stretches, "cid").select("cid", "audit", F.coalesce("said", F.lit("")).alias("repaired"))


def faults(edits: DataFrame) -> DataFrame:
    """(cid, gaps, blank, duplicate, truncated) per conversation."""
    copies = F.when(c("fault") == "duplicate", c("n")).when(c("fault") != "blank", c("n") - 1).otherwise(0)
    turns = edits.groupBy("cid", "turn").agg(
        F.sum(F.when(c("fault") == "blank", c("n")).otherwise(0)).alias("blank"),
        F.sum(copies).alias("duplicate"),
        F.sum(F.when(c("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
    )
    counted = [F.sum(x).cast("long").alias(x) for x in ("blank", "duplicate", "truncated")]
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("cid").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *counted)


def damage(rows: DataFrame) -> DataFrame:
    """A table (conv, turn, role, text) with faults put in by crc32("conv:turn") % 20, nulls being one
    space: 0 drops a row, 1 empties its text, 2 takes away the ends of its sentences, 3 repeats it, 4
    makes it a user's."""
    spaced = [F.coalesce(c(x).cast("string"), F.lit(" ")) for x in ("conv", "turn", "role", "text")]
    what = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])) % 20
    told = rows.select("conv", "turn", spaced[2].alias("role"), spaced[3].alias("text"), what.alias("what"))
    text = F.when(c("what") == 1, "").when(c("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(c("text"))
    role = F.when(c("what") == 4, "user").otherwise(c("role"))
    times = F.explode(F.when(c("what") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return told.where("what <> 0").select("conv", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")
