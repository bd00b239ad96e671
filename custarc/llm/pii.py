"""Personal data in texts: regular expressions propose spans, validators confirm them, words
nearby move the score.

Base kinds (email, ip, card, phone) follow fixed rules: leftmost non-overlapping matches per kind;
a match that its validator rejects is dropped. They stay whatever their score. The method adds
bank account numbers (iban, mod 97) and national numbers (ssn), which must reach ``THRESHOLD``.

Positions are code points, end exclusive. Null text is empty. Every text is searched whole; all
patterns are loops over one character class or have a bounded number of repeats, so a very long
run of letters or digits costs time in proportion to its length. A text with spans is cut into blocks
once, and a span and what stands near it are taken from its blocks, so a text with very many spans
costs time in proportion to them and not to spans times length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.llm.common import ascii_lower, let

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
THRESHOLD = 0.6
NEAR = 48  # code points on either side that may hold a context word
# Base score of a validated span, and the words that raise it when they are near.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo"),
    "ip": ("ip", "server", "host", "login", "address"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "national id", "tax id"),
}
BOOST = 0.3

WIDE, BLOCK = 1 << 14, 1 << 9  # code points of the blocks that a text is cut into, in two steps
LINK = "\x01"  # stands for a separator between two characters that belong together
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORDCH = "A-Za-z0-9._%+-"


def _linked(text: Column, separators: str, around: str) -> Column:
    """Separators with a character of ``around`` on both sides become LINK; nothing moves."""
    return F.regexp_replace(F.translate(text, LINK, "\x02"), f"(?<=[{around}])[{separators}](?=[{around}])", LINK)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(
        F.filter(numbers, lambda d: d.isNotNull()),
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether the check digits of a compact account number are right."""
    turned = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))
    values = F.transform(F.split(turned, ""), lambda ch: F.conv(ch, 36, 10).try_cast("int"))
    left = F.aggregate(
        F.filter(values, lambda v: v.isNotNull()),
        F.lit(0),
        lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97,
    )
    return F.length(account).between(15, 34) & (left == 1)


def _between(value: Column, low: int, high: int) -> Column:
    return F.length(_digits(value)).between(low, high)


# kind -> (cheap test that a match is possible, text to search, pattern, validator of a match).
# \G lets a match start right behind the last one; elsewhere it starts at the head of a run.
RULES = {
    "email": (
        lambda t: F.contains(t, F.lit("@")),
        lambda t: _linked(t, ".", "A-Za-z0-9-"),
        rf"(?:\G|(?<![{LINK}{_WORDCH}]))[{LINK}{_WORDCH}]++@[A-Za-z0-9-]++(?={LINK})[A-Za-z0-9{LINK}-]++",
        lambda m: F.lit(True),
    ),
    "ip": (
        lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]")),
        lambda t: t,
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: F.rlike(m, F.lit(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")),
    ),
    "card": (
        lambda t: F.rlike(t, F.lit("[0-9][0-9 -]{11}")),
        lambda t: _linked(t, " -", "0-9"),
        rf"[0-9][0-9{LINK}]++",
        lambda m: _between(m, 13, 19) & luhn(_digits(m)),
    ),
    "phone": (
        lambda t: F.contains(t, F.lit("+")),
        lambda t: t,
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda m: _between(m, 9, 15),
    ),
    "iban": (
        lambda t: F.rlike(t, F.lit("[A-Z]{2}[0-9]{2}")),
        lambda t: t,
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda m: mod97(F.replace(m, F.lit(" "), F.lit(""))),
    ),
    "ssn": (
        lambda t: F.rlike(t, F.lit("[0-9]-[0-9]{2}-[0-9]")),
        lambda t: t,
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True),
    ),
}


def _sums_before(lengths: Column) -> Column:
    """For each entry of an array, the sum of all entries before it; in blocks, so that a text
    with very many matches doesn't cost their square."""
    block = 128
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(lengths) - 1, F.lit(0)), F.lit(block)),
        lambda at: F.slice(lengths, at + 1, F.lit(block)),
    )

    def running(xs: Column) -> Column:
        return F.aggregate(
            xs, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        )

    def placed(inner: Column) -> Column:
        totals = running(F.transform(inner, lambda b: F.element_at(b, -1)))
        return let(
            totals,
            lambda start: F.flatten(
                F.transform(
                    inner, lambda b, k: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: x + start[k])
                )
            ),
        )

    return let(F.transform(blocks, running), placed)


def _found(text: Column, kind: str) -> Column:
    """Validated matches of a kind as (start, end), in order."""
    possible, prepared, pattern, valid = RULES[kind]
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def located(searched: Column) -> Column:
        matches = F.regexp_extract_all(searched, F.lit(pattern), F.lit(0))
        gaps = F.transform(F.split(searched, pattern, -1), F.length)

        def spans(m: Column) -> Column:
            steps = F.zip_with(gaps, m, lambda g, x: g + F.coalesce(F.length(x), F.lit(0)))
            # Sum of all gaps and matches before a match, plus the gap in front of it.
            return let(
                gaps,
                lambda g: let(
                    _sums_before(steps),
                    lambda before: F.transform(
                        F.filter(
                            F.transform(
                                m,
                                lambda x, i: F.struct(
                                    (before[i] + g[i]).alias("start"),
                                    (before[i] + g[i] + F.length(x)).alias("end"),
                                    valid(x).alias("valid"),
                                ),
                            ),
                            lambda s: s.valid,
                        ),
                        lambda s: F.struct(s.start.alias("start"), s.end.alias("end")),
                    ),
                ),
            )

        return let(matches, lambda m: F.when(F.size(m) > 0, spans(m)).otherwise(empty))

    return F.when(possible(text), let(prepared(text), located)).otherwise(empty)


def blocks_of(text: Column) -> Column:
    """The text in blocks of BLOCK code points; the last one is shorter and may be followed by empty ones."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(WIDE))
    wide = F.transform(starts, lambda at: F.substring(text, at + 1, F.lit(WIDE)))
    inner = F.sequence(F.lit(1), F.lit(WIDE - BLOCK + 1), F.lit(BLOCK))
    return F.flatten(F.transform(wide, lambda w: F.transform(inner, lambda at: F.substring(w, at, F.lit(BLOCK)))))


def taken(blocks: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start`` on, counted from 0, of a text in blocks."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.least(F.floor((start + length) / BLOCK).cast("int"), F.size(blocks) - 1)
    near = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.substring(near, (start % BLOCK).cast("int") + 1, F.greatest(length, F.lit(0)))


def _scored(blocks: Column, spans: Column, kind: str) -> Column:
    """Spans (kind, start, end, text, score), the extra kinds cut at THRESHOLD."""

    def span(s: Column) -> Column:
        low = F.greatest(s.start - NEAR, F.lit(0))
        near = ascii_lower(
            F.concat_ws(
                " ", taken(blocks, low, s.start - low), taken(blocks, s.end, F.lit(NEAR))
            )
        )
        named = F.rlike(near, F.lit(r"(?:^|[^a-z])(?:" + "|".join(CONTEXT[kind]) + r")"))
        return F.struct(
            F.lit(kind).alias("kind"),
            s.start.alias("start"),
            s.end.alias("end"),
            taken(blocks, s.start, s.end - s.start).alias("text"),
            (F.lit(PRIOR[kind]) + F.when(named, F.lit(BOOST)).otherwise(F.lit(0.0))).alias("score"),
        )

    scored = F.transform(spans, span)
    return scored if kind in BASE else F.filter(scored, lambda s: s.score >= THRESHOLD)


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, spans): each document as struct ``row`` and its spans by kind, then start."""
    value = F.coalesce(F.col("row").getField(text), F.lit(""))
    # One projection per step: a step's result is computed once, however often it is used.
    found = docs.select(F.struct("*").alias("row")).select(
        "row", *[_found(value, kind).alias(kind) for kind in KINDS]
    )
    some = F.lit(False)
    for kind in KINDS:
        some = some | (F.size(kind) > 0)
    found = found.withColumn("blocks", F.when(some, blocks_of(value)))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,text:string,score:double>>")
    return found.select(
        "row",
        F.flatten(
            F.array(*[F.when(F.size(kind) > 0, _scored(F.col("blocks"), F.col(kind), kind)).otherwise(none) for kind in KINDS])
        ).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets. Of overlapping spans the first
    one (then the longest) names the place, and its mark covers them all."""
    value = F.coalesce(F.col("row").getField(text), F.lit(""))
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s.start.alias("start"), (-s.end).alias("back"), s.kind.alias("kind")))
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        end = -s.back
        text_between = taken(F.col("blocks"), acc.at, s.start - acc.at)
        return F.when(
            s.start >= acc.at,
            F.struct(end.alias("at"), F.concat(acc.out, text_between, F.lit("["), F.upper(s.kind), F.lit("]")).alias("out")),
        ).otherwise(F.struct(F.greatest(end, acc.at).alias("at"), acc.out.alias("out")))

    clean = F.aggregate(
        ordered, start, step, lambda acc: F.concat(acc.out, taken(F.col("blocks"), acc.at, F.length(value) - acc.at))
    )
    marked = find_spans(docs, text).withColumn("blocks", F.when(F.size("spans") > 0, blocks_of(value)))
    return marked.select(
        *[
            (F.when(F.size("spans") > 0, clean).otherwise(F.col("row").getField(n)) if n == text else F.col("row").getField(n)).alias(n)
            for n in docs.columns
        ]
    )
