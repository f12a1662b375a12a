"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d))
    return {d: (min(g)[1], len(g), min(g)[1] == d, sha(k)) for k, g in groups.items() for _, d in g}


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def luhn(s):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(s))) % 10 == 0


def personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def joined(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def near(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = words(lower(t or ""))
        sets[d] = frozenset([tuple(w)]) if 0 < len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def substrings(rows, n=13):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, t in rows:
        w = words(t)
        gone = {i + j for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] < d for j in range(n)}
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def lines(rows):
    holders = defaultdict(set)
    key = lambda x: lower(x.strip(WHITE))
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(d)
    out = {}
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) < d)]
        out[d] = (len(every), len(every) - len(kept), sha("\n".join(kept)))
    return out


def distance(item, text):
    """The least edit distance of item to any passage of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def counts(found):
    return Counter(k for _, k, _ in found)
