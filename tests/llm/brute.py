"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars and repeated characters by length."""
    text = text or ""
    w = words(text)
    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup, dup_chars = dup + 1, dup_chars + sum(map(len, words(line)))
            seen.add(line)
    covered = {}
    for n in (5, 10, 20):
        places = defaultdict(list)
        for i in range(len(w) - n + 1):
            places[tuple(w[i : i + n])].append(i)
        covered[n] = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(n)}
    chars = {n: sum(len(w[i]) for i in at) for n, at in covered.items()}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(w), sum(map(len, w)), symbols, dup, len(covered[5]), dup_chars, chars[5], chars[10], chars[20])


def kept(text):
    n, chars, _, _, repeat, dup_chars, c5, c10, c20 = quality(text)
    if n < 10 or 100 * repeat > 20 * n:
        return False
    return dup_chars <= 0.30 * chars and c5 <= 0.25 * chars and c10 <= 0.20 * chars and c20 <= 0.15 * chars


def drop_lines(rows, documents=10):
    """Kept text, lines and dropped lines of each ``(id, text)``."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(i)
    often = {k for k, ids in held.items() if k and len(ids) >= documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in often]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def shingles(text, n=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(rows, percent):
    """``id, n_shingles, component`` of each ``(id, text)``."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    shared = Counter((a, b) for at in holders.values() for k, a in enumerate(at) for b in at[k + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            up[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def apportion(weights, seats):
    """Seats by highest quotients, one after the other; the earlier claim wins a tie."""
    got = [0] * len(weights)
    for _ in range(seats):
        k = max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[k] += 1
    return got


def targets(sizes, weights):
    """Fill to three times the size, the excess reshared by weight until none is above."""
    total, most = sum(sizes), [3.0 * s for s in sizes]
    full = set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        left = total - sum(most[i] for i in full)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        above = [i for i in open_ if share[i] > most[i]]
        if not above:
            return [most[i] if i in full else share[i] for i in range(len(sizes))]
        full |= set(above)
