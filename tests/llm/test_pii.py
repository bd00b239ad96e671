import random

import pytest
from brute import base_spans
from pyspark.sql import functions as F

from custarc.llm.pii import BASE, blocks_of, find_spans, luhn, mod97, redact, taken

TEXTS = [
    "", None, "mail a.b@c.de, x@y, a@b..c and a@b.c.d. a@b.com_x@y.org", "a@b.c@d.e _.%+-@a-b.c-d", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 x4111111111111111x 4111  1111 1111 1111", "card 5500005555555559, 4111111111111112 1 2 3 4 5 6 7 8 9 0 1 2 3",
    "+1 (212) 555-1234 +12 +49.30.123456 ++49 (0) 30 12 34 56 7 +123456789012345678", "é日本 a@b.co 😀 10.0.0.1 😀 +44 20 7946 0958",
    "7" * 30000, "a" * 30000 + "@" + "b." * 5000 + "c", "1 " * 20000, "1." * 9000, "+" * 9000, " -" * 9000, "a@b.c " * 700, "1.1.1.1 " * 700,
]


def spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "kind int, text string")
    return {r.row.kind: r.spans for r in find_spans(df).collect()}


def test_base_as_brute_force(spark):
    r = random.Random(1)
    pieces = ["a", "@", ".", "-", " ", "1", "23", "+", "(", ")", "_", "9.9", "a@b.c", "4111111111111111", "\n", "é", "\x01", "+12 34"]
    texts = TEXTS + ["".join(r.choices(pieces, k=r.randint(1, 60))) for _ in range(500)]
    found = spans(spark, texts)
    for k, text in enumerate(texts):
        got = [(s.kind, s.start, s.end) for s in found[k] if s.kind in BASE]
        assert got == base_spans(text), text
        assert all(s.text == text[s.start : s.end] for s in found[k])


def test_account_and_national_numbers(spark):
    found = spans(spark, ["IBAN DE89 3704 0044 0532 0130 00.", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 01", "ssn 536-90-4399", "part 536-90-4399"])
    kinds = [[s.kind for s in found[k] if s.kind not in BASE] for k in range(5)]
    assert kinds == [["iban"], ["iban"], [], ["ssn"], []]


def test_words_nearby_raise_the_score(spark):
    found = spans(spark, ["call +1 212 555 1234", "see +1 212 555 1234"])
    assert found[0][0].score > found[1][0].score


@pytest.mark.parametrize("check, good, bad", [(luhn, ["4111111111111111", "0"], ["4111111111111112", "1"]), (mod97, ["GB82WEST12345698765432"], ["GB83WEST12345698765432", "GB82"])])
def test_checksums(spark, check, good, bad):
    df = spark.createDataFrame([(x,) for x in good + bad], "x string")
    assert [r[0] for r in df.select(check(F.col("x"))).collect()] == [True] * len(good) + [False] * len(bad)


def test_redaction(spark, documents):
    docs = documents([(1, "x a@b.co y 1.2.3.4"), (2, None), (3, "4111 1111 1111 1111 +4111111111111111"), (4, "clean")])
    out = redact(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == {1: "x [EMAIL] y [IP]", 2: None, 3: "[CARD] +[CARD]", 4: "clean"}


def test_blocks(spark):
    """What is taken from blocks is what stands in the text, also across blocks and past the end."""
    text = "".join(chr(97 + k % 26) for k in range(40_000)) + "é😀" * 300
    df = spark.createDataFrame([(text, a, n) for a in (0, 1, 511, 512, 16_383, 16_384, 39_999, 40_500) for n in (0, 1, 2, 600, 40_000)], "t string, a int, n int")
    for r in df.select("a", "n", taken(blocks_of(F.col("t")), F.col("a"), F.col("n")).alias("x")).collect():
        assert r.x == text[r.a : r.a + r.n]
    assert spark.range(1).select(taken(blocks_of(F.lit("")), F.lit(0), F.lit(5))).first()[0] == ""


def test_redaction_of_many_spans(documents):
    text = "😀 ".join(f"u{k}@mail.com" for k in range(3000))
    assert redact(documents([(1, text)])).first().text == "😀 ".join(["[EMAIL]"] * 3000)


def test_empty_table(documents):
    assert find_spans(documents([])).collect() == []
