import random

import pytest

from custarc.llm.packing import best_fit, default_costs, least_cost, pack, sequences

COSTS = default_costs((8, 16, 32))


def check(rows, total):
    bins = {}
    for r in rows:
        if r.n_tokens:
            bins.setdefault((r.bin_id, r.capacity), []).append((r["at"], r.n_tokens))
        else:
            assert r.bin_id is None
    for (_, size), parts in bins.items():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= size and all(end > s for s in COSTS if s < size)
    assert sum(r.n_tokens for r in rows) == total
    assert len({b for b, _ in bins}) == len(bins)


@pytest.mark.parametrize("group", [50, 1 << 20])
def test_every_token_has_one_place(documents, group):
    r = random.Random(group)
    rows = [(k % 11, " ".join("w" * r.randint(0, 70))) for k in range(80)]
    rows += [(3, "a b c")] * 9 + [(None, "a"), (None, None), (4, ""), (4, " \n"), (1, " ".join("v" * 500))]
    found = pack(documents(rows), COSTS, group=group).collect()
    assert {len(x) for x in found} == {7}
    check(found, sum(len((t or "").split()) for _, t in rows))
    pieces = sorted((x.start, x.n_tokens) for x in found if x.doc_id == 1 and x.n_tokens and x.start + x.n_tokens > 70)
    assert pieces[-1][0] + pieces[-1][1] == 500
    assert sum(1 for x in found if x.doc_id == 3 and x.n_tokens == 3) >= 9


def test_least_cost_is_near_the_lower_bound():
    r = random.Random(1)
    lengths = sorted((r.randint(1, 32) for _ in range(3000)), reverse=True)
    chosen, sizes = least_cost(lengths, COSTS)
    cost = sum(COSTS[s] for s in sizes)
    assert cost <= min(sum(COSTS[s] for s in best_fit(lengths, COSTS, m)[1]) for m in COSTS)
    assert cost <= 1.05 * sum(lengths) * min(COSTS[s] / s for s in COSTS)


def plans(lengths, sizes):
    """Every way to put the lengths into bins of the given sizes."""
    if not lengths:
        yield []
        return
    first, rest = lengths[0], lengths[1:]
    for plan in plans(rest, sizes):
        for k, own in enumerate(plan):
            if sum(own) + first <= max(sizes):
                yield [*plan[:k], [first, *own], *plan[k + 1 :]]
        yield [[first], *plan]


def test_small_inputs_against_the_optimum():
    """Best fit is a heuristic: never below the exhaustive optimum, mostly at it, never far above."""
    r = random.Random(4)
    costs = {4: 5.0, 8: 8.0, 12: 11.0}
    at_optimum = 0
    for _ in range(120):
        lengths = sorted((r.randint(1, 12) for _ in range(r.randint(1, 6))), reverse=True)
        _, sizes = least_cost(lengths, costs)
        ours = sum(costs[s] for s in sizes)
        best = min(sum(min(costs[s] for s in costs if s >= sum(own)) for own in plan) for plan in plans(lengths, costs))
        assert best <= ours <= 1.5 * best
        at_optimum += ours == best
    assert at_optimum >= 80


@pytest.mark.parametrize("group", [50, 1 << 20])
def test_sequences_hold_every_word_once(documents, group):
    r = random.Random(group)
    rows = [(k % 11, " ".join(f"w{k}.{i}" for i in range(r.randint(0, 70)))) for k in range(60)]
    rows += [(3, "a b c")] * 9 + [(3, "d e f")] * 4 + [(None, "n1 n2")] * 3 + [(None, None), (4, " \n"), (1, "\t".join(f"v{i}" for i in range(500)))]
    docs = documents(rows)
    found = sequences(docs, pack(docs, COSTS, group=group)).collect()
    held = sorted(w for x in found for w in x.words)
    assert held == sorted(w for _, t in rows for w in (t or "").split())
    texts = [(i, (t or "").split()) for i, t in rows]
    for x in found:
        assert x.n_tokens == len(x.words) <= x.capacity and len({b["at"] for b in x.bounds}) == len(x.bounds)
        ends = [b["at"] for b in x.bounds[1:]] + [len(x.words)]
        for bound, end in zip(x.bounds, ends):
            piece = x.words[bound["at"] : end]
            assert any(i == bound.doc_id and t[bound.start : bound.start + len(piece)] == piece for i, t in texts)
    assert len({x.bin_id for x in found}) == len(found)


def test_a_costly_large_size_is_not_opened():
    _, sizes = least_cost([4] * 10, {8: 8.0, 32: 100.0})
    assert set(sizes) == {8}


def test_empty_table(documents):
    assert pack(documents([]), COSTS).collect() == []
