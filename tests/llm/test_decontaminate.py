import random

import numpy as np
from brute import contamination as plain

from custarc.llm.decontaminate import drop_contaminated, judge, winnow


def cases(prose):
    r = random.Random(4)
    items = [(k, prose(f"item{k}", r.randint(10, 40))) for k in range(12)]
    items += [("0".rjust(1), items[3][1]), (None, items[4][1]), (50, "tiny item"), (51, "w"), (52, ""), (53, None), (54, items[5][1] + " tail")]
    docs = []
    for k in range(80):
        words = prose(k, r.randint(0, 200)).split()
        for _ in range(r.randint(0, 3)):
            source = items[r.randrange(12)][1].split()
            n = r.randint(5, len(source))
            at, to = r.randint(0, len(source) - n), r.randint(0, len(words))
            words[to:to] = source[at : at + n]
        docs.append((k, (" ", ". ", "-")[k % 3].join(words).title() if k % 2 else " ".join(words)))
    docs += [(None, items[1][1]), (None, None), (3, ""), (3, items[2][1]), (3, items[2][1]), (60, "Tiny, ITEM!"), (61, "a w b"), (62, items[5][1] * 300)]
    return docs, items


def test_as_brute_force(spark, documents, prose):
    docs, items = cases(prose)
    benchmark = spark.createDataFrame([(None if i is None else str(i), t) for i, t in items], "item_id string, text string")
    found = judge(documents(docs), benchmark).collect()
    key = lambda r: tuple(map(str, r))
    got = [(x.doc_id, x.n_words, x.n_hit, list(x["items"]), x.contaminated) for x in found]
    assert sorted(got, key=key) == sorted(plain(docs, items), key=key)
    kept = drop_contaminated(documents(docs), benchmark)
    assert kept.columns == documents([]).columns
    assert kept.count() == sum(not c for *_, c in plain(docs, items))


def test_every_span_shares_a_fingerprint():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 60, 400).astype(np.uint64)
    for at in range(0, 380, 7):
        whole, part = winnow(a, 6), winnow(a[at : at + 6], 6) + at
        assert np.isin(part, whole).all()


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert judge(documents([]), none).collect() == []
    assert [r.contaminated for r in judge(documents([(1, "a b")]), none).collect()] == [False]
