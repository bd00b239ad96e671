"""Plain versions of the operators, row by row in one process."""

import hashlib
import re
from collections import Counter, defaultdict

BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def line_dedup(docs, min_docs):
    """{id: (n_lines, n_dropped, kept text)}"""
    lines = [(i, (t or "").split("\n")) for i, t in docs]
    seen = Counter(k for _, ls in lines for k in {low(x.strip(BLANKS)) for x in ls})
    out = []
    for i, ls in lines:
        kept = [x for x in ls if not (k := low(x.strip(BLANKS))) or seen[k] < min_docs]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def near_duplicates(docs, percent=80, size=5):
    """[(id, n_shingles, component)] by comparing every pair that shares a shingle."""
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for a, found in enumerate(sets):
        common = Counter(b for s in found for b in holders[s])
        for b, n in common.items():
            if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                root[find(a)] = find(b)
        for s in found:
            holders[s].append(a)
    least = {}
    for k, (i, _) in enumerate(docs):
        r = find(k)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return [(i, len(sets[k]), least[find(k)] if sets[k] else i) for k, (i, _) in enumerate(docs)]


def contamination(docs, items, span=13):
    """[(id, n_words, n_hit, items, contaminated)]"""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t or ""))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - span + 1) if w else 0):
            windows[tuple(w[k : k + span])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (which := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= which
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text):
    """[(kind, start, end)] of the base kinds."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(kind, m.start(), m.end()) for kind, r, valid in rules for m in re.finditer(r, text or "") if valid(m[0])]


def nearest(vectors, is_query, k):
    """{query id: [vector id]} of usable (id, list) rows, by falling inner product."""
    return {
        q: [i for _, i in sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q)[:k]]
        for q, x in vectors
        if is_query(q)
    }
