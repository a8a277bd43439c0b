"""The operators' results by plain loops over all rows of a small table."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    c = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if c[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


_KEYS = "(" + "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token")) \
    + "|[aA][pP][iI]_?[kK][eE][yY])"
BASE = (
    ("assign", re.compile(_KEYS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def secrets(text):
    spans, counts = [], []
    for k, (kind, pattern, ok) in enumerate(BASE):
        own = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if ok(m)]
        counts.append(len(own))
        spans += own
    return (*counts, hashlib.sha256(",".join(s for _, _, s in sorted(spans)).encode()).hexdigest())


def simhash(texts, ids):
    prints = []
    for t in texts:
        w = WORD.findall(low(t))
        grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return list(zip(ids, (f"{p:016x}" for p in prints), components(prints, ids)))


def components(prints, ids):
    a = np.array(prints, np.uint64)
    least = list(range(len(a)))
    changed = True
    while changed:
        changed = False
        for i in range(len(a)):
            near = np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4)
            m = min(least[j] for j in near)
            for j in near:
                if least[j] != m:
                    least[j], changed = m, True
    own = {}
    for i, root in enumerate(least):
        if ids[i] is not None:
            own[root] = min(own.get(root, ids[i]), ids[i])
    return [own.get(root) for root in least]


def repeats(texts, size=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + size] for t in raw for i in range(len(t) - size + 1))
    out = []
    for t in raw:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                hit[i : i + size] = True
        runs = int(hit[:1].sum() + (hit[1:] & ~hit[:-1]).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~hit])
        out.append((len(t), int(hit.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


_ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts, items, span=10):
    windows = {}
    for item, text in items:
        w = _ITEM_WORD.findall(low(text))
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for text in texts:
        w = _ITEM_WORD.findall(low(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((len(w), len(hit), len(names), names, bool(hit)))
    return out


def clusters(rows, k=16, rounds=3, size=64):
    kept = [(i, [int(Fraction(x) * 64 // 1) for x in v]) for i, v in rows]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), list(v)) for i, v in rows if i is not None)
    centroids = [[int(Fraction(x) * 64 // 1) for x in v] for _, v in named[:k]]
    if not centroids:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for n in range(len(centroids)):
            members = [v for (_, v), (_, m) in zip(kept, own) if m == n]
            if members:
                centroids[n] = [sum(c) // len(members) for c in zip(*members)]
    own = assign()
    fit = lambda x: x if x is not None and x < 1 << 63 else None
    totals = []
    for n in range(len(centroids)):
        d = [fit(x) for x, m in own if m == n]
        totals.append(None if None in d else sum(d))
    every = None if None in totals else sum(totals)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, fit(d), fit(totals[n]), fit(every), names[n]) for (i, _), (d, n) in zip(kept, own)), key=repr)


def repairs(rows):
    """Rows (conv_id, turn, role, text); a dynamic program over states that carries whole strings."""
    space = lambda x: " " if x is None else str(x)
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = space(role), space(text)
        draw = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if draw == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in own:
            if not WORD.search(text):
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
                faults.append("truncated")
            else:
                faults.append("")
            seen.add((role, text))
        turns_ = {t for t, _, _ in own if t is not None}
        gaps = max(turns_) - min(turns_) + 1 - len(turns_) if turns_ else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, edits, lines = _cheapest(own, faults)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def _cheapest(own, faults):
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    # Forward, keeping every cheapest prefix per state: equal costs are told apart at the end.
    best = {"": {(0, "", ())}}
    for (_, role, text), fault in zip(own, faults):
        best = _spread(best, moves)
        following = {}
        for state, options in best.items():
            for c, e, lines in options:
                following.setdefault(state, set()).add((c + 4, e + "D", lines))
                if fault in ("blank", "duplicate"):
                    continue
                extra = 3 if fault == "truncated" else 0
                to = moves.get((state, role[:1]))
                if to:
                    following.setdefault(to, set()).add((c + extra, e + "K", (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    to = moves.get((state, new[0]))
                    if to:
                        following.setdefault(to, set()).add((c + 3 + extra, e + "R", (*lines, f"{new}:{text}")))
        best = _cut(following)
    best = _cut(_spread(best, moves))
    return min(x for state in ("", "a") for x in best.get(state, ()))


def _spread(best, moves):
    best = {s: set(o) for s, o in best.items()}
    for _ in range(3):
        for state, options in [(s, set(o)) for s, o in best.items()]:
            for c, e, lines in options:
                for role in ("user", "assistant"):
                    to = moves.get((state, role[0]))
                    if to:
                        best.setdefault(to, set()).add((c + 3, e + "I", (*lines, f"{role}:")))
    return _cut(best)


def _cut(best):
    """Of each state, the cheapest; of these, the first string: the states' suffixes are alike."""
    out = {}
    for state, options in best.items():
        least = min(c for c, _, _ in options)
        out[state] = {min(o for o in options if o[0] == least)}
    return out


def passages(texts, ids, size=50):
    first = {}
    split = [WORD.findall(t or "") for t in texts]
    for w, i in zip(split, ids):
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for w, i in zip(split, ids):
        hit = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                hit |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in hit)
        out.append((i, len(w), len(hit), hashlib.sha256(kept.encode()).hexdigest()))
    return out
