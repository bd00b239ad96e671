import random

import pytest
from brute import line_dedup as plain

from custarc.llm.line_dedup import LineRuns, collect_lines, drop_repeated_lines, line_counts, mark_lines


def rows_of(seed):
    r = random.Random(seed)
    lines = ["A b", " a B\t", "c", "", "  ", "\x0bd\x0c", "é", "É", "x" * 3000, "a\r", " c"]
    return [(k % 17, "\n".join(r.choices(lines, k=r.randint(1, 9)))) for k in range(60)] + [
        (None, None), (None, "c\nc"), (5, ""), (5, ""), (5, None), (99, "c\n" * 2000)
    ]


@pytest.mark.parametrize("min_docs", [1, 3, 30])
def test_as_brute_force(documents, min_docs):
    rows = rows_of(min_docs)
    docs = documents(rows)
    found = mark_lines(docs, collect_lines(docs, min_docs, batches=3, fanout=2).frequent()).collect()
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted([(x.row.doc_id, x.n_lines, x.n_dropped, x.kept) for x in found], key=key) == sorted(
        plain(rows, min_docs), key=key
    )


def test_runs_are_levelled_and_can_be_taken_up_again(spark, documents):
    batches = [documents([(k, f"same\nonly {k}")]) for k in range(5)]
    runs = LineRuns(spark, min_docs=3, fanout=2)
    for batch in batches[:4]:
        runs.add(line_counts(batch))
    assert [level for level, _ in runs.runs] == [2]
    again = LineRuns(spark, 3, 2, runs.folder, runs.runs)
    again.add(line_counts(batches[4]))
    assert sorted(level for level, _ in again.runs) == [0, 2]
    assert again.frequent().count() == 1
    # The line was already proven frequent, so the last batch adds its own line only.
    assert spark.read.parquet(again.runs[-1][1]).count() == 1


def test_documents_keep_their_columns(documents):
    docs = documents([(k, "menu\n" + "abc"[k] if k < 3 else None) for k in range(4)])
    out = drop_repeated_lines(docs, min_docs=3)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(0, "a"), (1, "b"), (2, "c"), (3, None)]


def test_empty_table(documents):
    assert drop_repeated_lines(documents([])).count() == 0
