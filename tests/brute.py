"""Plain renderings of the definitions, for small fixtures only."""

import numpy as np


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b):
            new.append(row[j] + 1 if c == d else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def partial_ratio(a, b):
    if not a or not b:
        return float(a == b)

    def best(s, t):
        m = len(s)
        windows = {t[i : i + m] for i in range(len(t) - m + 1)}
        windows |= {t[:k] for k in range(1, m)} | {t[-k:] for k in range(1, m)}
        return max(2 * lcs(s, w) / (m + len(w)) for w in windows)

    if len(a) == len(b):
        return max(best(a, b), best(b, a))
    return best(a, b) if len(a) < len(b) else best(b, a)


def token_set_ratio(a, b):
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    shared = ta & tb
    x, y = " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta))
    if shared and (not x or not y):
        return 1.0
    n = len(" ".join(sorted(shared)))
    p, q = n + (n > 0) + len(x), n + (n > 0) + len(y)
    best = 1 - (len(x) + len(y) - 2 * lcs(x, y)) / (p + q)
    if n:
        best = max(best, 1 - (1 + len(x)) / (n + p), 1 - (1 + len(y)) / (n + q))
    return best


def score(a, b):
    a, b = a.lower(), b.lower()
    return max(partial_ratio(a, b), token_set_ratio(a, b))


def cosine(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    n = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / n) if n else 0.0


def leaves_below(classes, top):
    """Ids of the flagged leaves at or below a class; classes are (id, parent, leaf)."""
    parent = {c[0]: c[1] for c in classes}
    flagged = {c[0] for c in classes if c[2]}

    def climbs(leaf):
        at = parent[leaf]
        while at is not None and at not in flagged:
            if at == top:
                return True
            at = parent.get(at)
        return False

    return {leaf for leaf in flagged if leaf == top or climbs(leaf)}
