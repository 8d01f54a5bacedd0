"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, width):
    words = WORD.findall(lowered(text or ""))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near(rows, width, part, whole):
    """{id: (set size, smallest id reachable)} for rows of unique ids."""
    sets = {d: shingles(t, width) for d, t in rows}
    having = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        common = collections.Counter(e for x in s for e in having[x] if e < d)
        for e, k in common.items():
            if whole * k >= part * (len(s) + len(sets[e]) - k):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def without_repeats(rows, length=50):
    """(id, bytes, removed, runs, hash of the rest) of every row."""
    least = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1) if d is not None else ():
            s = raw[i : i + length]
            least[s] = min(least.get(s, d), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1) if d is not None else ():
            if least[raw[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def secrets(text):
    """(start, rank, kind, end) of the base kinds, by start."""
    text, found = text or "", []
    names = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def mix(rows, weights=(1, 2, 3), most=3):
    """{source: (size, target)} and [(id, size, taken)] for rows (id, source, size)."""
    sizes = collections.Counter()
    for _, source, size in rows:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(most * sizes[s] for s in stopped)
        level = left / sum(weight[s] for s in free) if free else 0.0
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            break
        stopped |= over
    target = {s: float(most * sizes[s]) if s in stopped else weight[s] * level for s in order}
    out = []
    for source in order:
        mine = [(int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16), d, n) for d, s, n in rows if s == source]
        mine.sort(key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2]))
        budget, before = int(target[source]), 0
        epochs = budget // sizes[source] if sizes[source] else 0
        for _, d, n in mine:
            rest = budget - epochs * sizes[source] - before
            out.append((d, n, epochs * n + max(0, min(n, rest))))
            before += n
    return {s: (sizes[s], target[s]) for s in order}, sorted(out, key=repr)
