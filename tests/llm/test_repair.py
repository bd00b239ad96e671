import random
import zlib
from itertools import product

import pytest
import xxhash

from custarc.llm import repair
from brute import BLANKS


def _long(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def ordered(rows):
    """The rows (conv, turn, role, text) of one conversation in the operator's order."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for _, t, r, x in rows]
    return sorted(rows, key=lambda v: (v[0] is not None, v[0] or 0, v[1], _long(xxhash.xxh64_intdigest(v[2].encode(), 42))))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.strip(BLANKS)[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    return out


NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows, faults):
    """(cost, audit, repaired rows) over all edits, a row at a time, all prefixes kept that can win."""
    names = {"u": "user", "a": "assistant"}

    def with_inserts(ways):
        ways = dict(ways)
        for _ in range(2):
            for state, (cost, audit, said) in list(ways.items()):
                for x in "ua":
                    if x in NEXT[state]:
                        new = (cost + 3, audit + "I", said + ((names[x], ""),))
                        if NEXT[state][x] not in ways or new[:2] < ways[NEXT[state][x]][:2]:
                            ways[NEXT[state][x]] = new
        return ways

    ways = {0: (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, said) in with_inserts(ways).items():
            moves = [(state, 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role[:1] in NEXT[state]:
                    moves.append((NEXT[state][role[:1]], extra, "K", ((role, text),)))
                moves += [(NEXT[state][x], 3 + extra, "R", ((names[x], text),)) for x in "ua" if x in NEXT[state]]
            for t, paid, done, more in moves:
                new = (cost + paid, audit + done, said + more)
                if t not in after or new[:2] < after[t][:2]:
                    after[t] = new
        ways = after
    ends = with_inserts(ways)
    return min(ends[s] for s in (0, 3) if s in ends)


def plain(rows):
    rows = ordered(rows)
    faults = faults_of(rows)
    cost, audit, said = cheapest(rows, faults)
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{x: faults.count(x) for x in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "cost": cost,
        "audit": audit,
        "repaired": "\n".join(f"{r}:{x}" for r, x in said),
    }


def random_rows(r, conv, n):
    roles = ["user", "assistant"] * 5 + ["system", "tool", "", None, "useless"]
    rows, turn = [], 0
    for k in range(n):
        turn += r.choice((1, 1, 1, 2, 0))
        role = roles[k % 2] if r.random() < 0.6 else r.choice(roles)
        text = r.choice(("Yes.", "No!", "cut", "", " \n", None, f"Some {k}?", f"words {k}", f"More {k}.\t"))
        rows.append((conv, None if r.random() < 0.05 else turn, role, text))
        if r.random() < 0.1:
            rows.append(rows[-1])
    return rows


def table_of(spark, rows):
    return spark.createDataFrame(
        [(*row, 1, "x") for row in rows], "conv long, turn long, role string, text string, at int, cid string"
    )


def report(rows):
    found, edits = repair.repair(rows)
    whole = found.join(repair.faults(edits), "cid").join(repair.audits(edits), "cid")
    return {r.conv: r.asDict() for r in whole.collect()}, edits


@pytest.mark.parametrize("stretch, fan", [(128, 64), (2, 2), (3, 4)])
def test_agrees_with_all_edits(spark, monkeypatch, stretch, fan):
    monkeypatch.setattr(repair, "STRETCH", stretch)
    monkeypatch.setattr(repair, "FAN", fan)
    r = random.Random(stretch)
    lengths = [r.randint(1, 9) for _ in range(60)] + [40, 150]
    rows = [x for k, n in enumerate(lengths) for x in random_rows(r, k, n)]
    rows += [(None, 1, "user", "Hm."), (None, 2, "user", "Hm.")] + [(900, None, "user", "a")] * 7 + [(901, 1, None, None)]
    r.shuffle(rows)
    found, edits = report(table_of(spark, rows))
    convs = {conv for conv, *_ in rows}
    assert set(found) == convs
    for conv in convs:
        want = plain([x for x in rows if x[0] == conv])
        assert {k: found[conv][k] for k in want} == want, conv
    said = sorted(repair.repaired_rows(edits).collect(), key=lambda x: (x.at, x.i))
    assert "\n".join(f"{x.role}:{x.text}" for x in said if x.conv == 61) == found[61]["repaired"]


def test_search_is_exhaustive():
    """Every sequence of up to five row kinds, against all repairs."""
    kinds = {"x": ("user", "blank"), "s": ("system", ""), "u": ("user", ""), "A": ("assistant", "truncated"), "o": ("tool", "")}
    for n in range(1, 6):
        for codes in product(kinds, repeat=n):
            rows = [(k, kinds[x][0], "t") for k, x in enumerate(codes)]
            cost, steps = repair.search("".join(codes), 0, True)[repair.END]
            assert (cost, steps.translate(str.maketrans(*repair.AUDIT))) == cheapest(rows, [kinds[x][1] for x in codes])[:2]


def test_bounds_never_exceed_the_cost():
    r = random.Random(4)
    for _ in range(300):
        codes = "".join(r.choice("xsuaoSUAO") for _ in range(r.randint(1, 12)))
        bounds = repair.suffix_bounds(codes)
        for k in range(len(codes)):
            assert bounds[k] <= min(cost for s in range(4) for cost, _ in repair.search(codes[k:], s, False).values())


def test_damage(spark):
    rows = [(k // 5, None if k == 7 else k % 5, None if k == 9 else "assistant", None if k == 8 else "A. b! c") for k in range(100)]
    got = sorted(map(str, (tuple(x) for x in repair.damage(table_of(spark, rows)).collect())))
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else text.replace(".", "").replace("!", "") if kind == 2 else text)
        want += [row] * (kind > 0) + [row] * (kind == 3)
    assert got == sorted(map(str, want))


def test_empty_table(spark):
    found, edits = report(table_of(spark, []))
    assert found == {} and edits.count() == 0
