import random
import re
import zlib
from collections import Counter

import pytest
from brute import low

from custarc.llm import spelling


def words_of(docs, shortest=7, least=2, every=31):
    found = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= least}


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def plain(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if v != w and is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 10 * n else None
        out[w] = [n, form, form and words[form], len(near)]
    for w, row in out.items():
        root = w
        while out[root][1]:
            root = out[root][1]
        row.append(root)
    return out


def found(words):
    return {r.word: [r.n, r.form, r.form_n, r.n_near, r.root] for r in words.collect()}


def vocabulary(r, lengths, letters="abé"):
    out = set()
    while len(out) < 60:
        word = "".join(r.choice(letters) for _ in range(r.choice(lengths)))
        out.add(word)
        for _ in range(3):
            k, x = r.randrange(len(word)), r.choice(letters)
            out.add(r.choice((word[:k] + word[k + 1 :], word[:k] + x + word[k:], word[:k] + x + word[k + 1 :])))
    return {w: r.choice((1, 2, 3, 30, 400, 5000)) for w in out}


@pytest.mark.parametrize("deep, lengths", [(48, (7, 8, 9, 10)), (8, (7, 8, 9, 10)), (12, (11, 12, 13, 14)), (12, (7, 300))])
def test_as_all_pairs(spark, monkeypatch, deep, lengths):
    monkeypatch.setattr(spelling, "DEEP", deep)
    words = vocabulary(random.Random(deep + lengths[0]), lengths)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.variants(table)) == plain(words)


def test_a_run_of_one_letter_and_long_chains(spark):
    words = {"aaaaaaa": 1, "aaaaaaaa": 10, "aaaaaaaaa": 100, "aaaaaaaaab": 1000, "aaaaaaaabb": 10_000, "aaaaaaabbb": 100_000}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = found(spelling.variants(table))
    assert got == plain(words) and got["aaaaaaa"][4] == "aaaaaaabbb"


def test_counted_words(documents):
    r = random.Random(5)
    letters = "abcdefghiABCÀÿ×ŒЖ ._1"
    docs = [(k, "".join(r.choice(letters) for _ in range(2000))) for k in range(40)]
    docs += [(None, "Straßenbahn " * 3), (7, None), (8, ""), (9, "short"), (3, "Repeated repeated")] * 2
    docs += [(50, "x" * 100_000)] * 2
    got = {r.word: r.n for r in spelling.counted_words(documents(docs), least=1).collect()}
    assert got == words_of(docs, least=1)
    assert any(zlib.crc32(f"{i}:{low(w)}".encode()) % 31 == 0 for i, t in docs for w in re.findall("[A-Za-zÀ-ÿ]{7,}", t or ""))


def test_no_words(spark, documents):
    words = spelling.counted_words(documents([(1, None), (2, "a b")]))
    assert spelling.variants(words).collect() == []
