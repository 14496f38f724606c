"""Fuzzy name score: the better of a best-window ratio and a token-set ratio.

Definitions (``lcs`` is the longest common subsequence length):

* ``ratio(a, b) = 2 * lcs / (|a| + |b|)``;
* ``partial_ratio``: best ratio of the shorter text against every equally long
  window of the longer one and against its shorter prefixes and suffixes;
* ``token_set_ratio``: compares the sorted tokens two texts do not share, giving
  credit for the shared ones; 1 when one token set contains the other;
* ``fuzzy_score``: the maximum of both, on lower-cased text.

The arithmetic is vectorised over pairs: ``lcs`` is the published bit-parallel
recurrence with one NumPy lane per (pattern, window).
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LANES = 1 << 15
# Entries of a pattern table (patterns x letters) built at a time.
TABLE = 1 << 23
# Buckets of letter counts: lower-case letters and digits get one each.
BUCKETS = 97
# Names of a group that is ruled out at once.
GROUP = 16
ONE_SPACE = {c: " " for c in range(0x3001) if chr(c).isspace()}


class Encoded:
    """Texts as one flat array of letter codes from 1, each text followed by a 0."""

    def __init__(self, texts: list[str], alphabet: np.ndarray):
        self.size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.start = np.cumsum(self.size + 1) - (self.size + 1)
        raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
        self.flat = np.searchsorted(alphabet, raw) + 1
        self.flat[self.start + self.size] = 0
        self.codes = len(alphabet) + 2


def encode(*groups: list[str]) -> list[Encoded]:
    letters = "".join(sorted(set().union(*(set(t) for g in groups for t in g))))
    alphabet = np.frombuffer(letters.encode("utf-32-le"), dtype=np.uint32)
    return [Encoded(g, alphabet) for g in groups]


class Patterns:
    """Letter positions of equally long patterns, one pattern per lane.

    ``feed`` advances the lcs state of some lanes by one letter of their text: a zero
    bit of the state is one matched pattern letter.
    """

    def __init__(self, texts: Encoded, rows: np.ndarray, length: int, reverse: bool = False):
        present = np.zeros(len(texts.size), dtype=bool)
        present[rows] = True
        distinct = np.flatnonzero(present)
        lane = np.cumsum(present)[rows] - 1
        table = np.zeros((-(-length // 64), len(distinct), texts.codes), dtype=np.uint64)
        each = np.arange(len(distinct))
        for j in range(length):
            bit = length - 1 - j if reverse else j
            code = texts.flat[texts.start[distinct] + j]
            table[bit // 64, each, code] |= np.uint64(1 << (bit % 64))
        self.words = [w.ravel() for w in table]
        self.base = lane * texts.codes

    def fresh(self, lanes: int) -> list[np.ndarray]:
        return [np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64) for _ in self.words]

    def feed(self, state: list[np.ndarray], base: np.ndarray, code: np.ndarray) -> None:
        cell, carry = base + code, None
        for w, table in enumerate(self.words):
            v = state[w]
            hit = v & table.take(cell)
            total = v + hit
            if len(self.words) > 1:
                over = total < v
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            state[w] = total | (v - hit)


def matched(state: list[np.ndarray]) -> np.ndarray:
    return sum(np.bitwise_count(~v).astype(np.int64) for v in state)


def _chunks(rows: np.ndarray, codes: int):
    step = max(256, min(LANES, TABLE // codes))
    return (rows[a : a + step] for a in range(0, len(rows), step))


def _partial_oriented(short, long, si, li, best):
    """Raise ``best`` to the partial ratio of short[si] in long[li], |short| <= |long|."""
    m = short.size[si]
    order = np.lexsort((long.size[li], m))
    sizes = m[order]
    for size in np.unique(sizes):
        group = order[np.searchsorted(sizes, size) : np.searchsorted(sizes, size, "right")]
        if size == 0:
            best[group] = np.maximum(best[group], long.size[li[group]] == 0)
            continue
        for idx in _chunks(group, short.codes):
            best[idx] = _partial_group(short, long, si[idx], li[idx], best[idx], int(size))


def _partial_group(short, long, si, li, best, m):
    """Partial ratios for patterns of one length, wherever they exceed ``best``."""
    n, start, text = long.size[li], long.start[li], long.flat
    ahead, behind = Patterns(short, si, m), Patterns(short, si, m, reverse=True)
    left, right = ahead.fresh(len(si)), ahead.fresh(len(si))
    best, low = best.copy(), best.min()
    for k in range(m):
        ahead.feed(left, ahead.base, text[start + k])
        behind.feed(right, behind.base, text[start + n - 1 - k])
        # A window of k + 1 letters holds at most that many matches.
        if 2 * (k + 1) / (m + k + 1) > low:
            np.maximum(best, 2.0 * matched(left) / (m + k + 1), out=best)
            np.maximum(best, 2.0 * matched(right) / (m + k + 1), out=best)
    first, last = matched(left), matched(right)
    for k in range(m, int(n.max())):
        ahead.feed(left, ahead.base, text[start + np.minimum(k, n)])
    # Shifting a window by one changes its matches by at most one, so windows that
    # cannot reach the next better count are stepped over, from either end.
    goal = np.floor(best * m).astype(np.int64)
    for _ in range(2):
        goal += goal / m <= best
    at = np.maximum(1, goal - first)
    end = n - m - np.maximum(1, goal - last)
    open_ = np.flatnonzero((at <= end) & (matched(left) >= goal))
    while len(open_):
        base, place = ahead.base[open_], start[open_] + at[open_]
        state = ahead.fresh(len(open_))
        for k in range(m):
            ahead.feed(state, base, text[place + k])
        got = matched(state)
        best[open_] = np.maximum(best[open_], got / m)
        goal[open_] = np.maximum(goal[open_], got + 1)
        at[open_] += np.maximum(1, goal[open_] - got)
        end[open_] = n[open_] - m - np.maximum(1, goal[open_] - last[open_])
        open_ = open_[at[open_] <= end[open_]]
    return best


def partial_ratios(left, right, ia, ib, floor=None) -> np.ndarray:
    """Partial ratio of left[ia], right[ib]; exact wherever it exceeds ``floor``."""
    best = np.zeros(len(ia)) if floor is None else floor.astype(float)
    m, n = left.size[ia], right.size[ib]
    for rows, flip in ((np.flatnonzero(m <= n), False), (np.flatnonzero(m >= n), True)):
        part = best[rows]
        if flip:
            _partial_oriented(right, left, ib[rows], ia[rows], part)
        else:
            _partial_oriented(left, right, ia[rows], ib[rows], part)
        best[rows] = part
    return best


def lcs_lengths(left, right, ia, ib) -> np.ndarray:
    out = np.zeros(len(ia), dtype=np.int64)
    m, n = left.size[ia], right.size[ib]
    for rows, flip in ((np.flatnonzero(m <= n), False), (np.flatnonzero(m > n), True)):
        s, t, si, ti = (right, left, ib, ia) if flip else (left, right, ia, ib)
        order = rows[np.lexsort((t.size[ti[rows]], s.size[si[rows]]))]
        sizes = s.size[si[order]]
        for size in np.unique(sizes[sizes > 0]):
            group = order[np.searchsorted(sizes, size) : np.searchsorted(sizes, size, "right")]
            for idx in _chunks(group, s.codes):
                patterns = Patterns(s, si[idx], int(size))
                state = patterns.fresh(len(idx))
                start, length = t.start[ti[idx]], t.size[ti[idx]]
                for k in range(int(length.max())):
                    patterns.feed(state, patterns.base, t.flat[start + np.minimum(k, length)])
                out[idx] = matched(state)
    return out


class NameBlock:
    """A block of names prepared once, to be matched against many batches of names.

    Its tokens are numbered in text order; a name is a sorted stretch of token numbers, and
    a token has a stretch of the names that hold it. Names of like length and letters form
    groups with the most letters of each kind that a member has.
    """

    def __init__(self, names: list[str]):
        self.names = names
        tokens = [sorted(set(n.split())) for n in names]
        self.sorted = [" ".join(t) for t in tokens]
        self.codes = {t: c for c, t in enumerate(sorted(set().union(*tokens)))}
        self.texts = list(self.codes)
        self.flat = np.array([self.codes[t] for own in tokens for t in own], np.int64)
        self.count = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.count) - self.count
        self.length = np.array([len(t) for t in self.texts], np.int64)
        owner, order = np.repeat(np.arange(len(names)), self.count), np.argsort(self.flat, kind="stable")
        self.holders = owner[order]
        self.held_from = np.searchsorted(self.flat[order], np.arange(len(self.texts) + 1))
        self.touched = 0  # pairs looked at one by one
        plain = [n.translate(ONE_SPACE) for n in names]
        self.size = np.fromiter(map(len, plain), np.int64, len(plain))
        points = np.frombuffer("".join(plain).encode("utf-32-le"), np.uint32)
        cell = np.repeat(np.arange(len(plain)) * BUCKETS, self.size) + points % BUCKETS
        counts = np.bincount(cell, minlength=len(plain) * BUCKETS).reshape(-1, BUCKETS)
        self.letters = np.minimum(counts, np.iinfo(np.uint16).max).astype(np.uint16)
        self.text_size = np.fromiter(map(len, self.sorted), np.int64, len(names))

    @cached_property
    def groups(self) -> tuple[np.ndarray, ...]:
        """Members by group, where groups start,
        and each group's most letters, least length and least token text.

        The block is halved again and again by the letter whose number differs most.
        """
        traits, open_, done = self.letters.astype(np.float32), [np.arange(len(self.names))], []
        while open_:
            rows = open_.pop()
            if len(rows) <= GROUP:
                done.append(rows)
                continue
            own = traits[rows]
            order = np.argsort(own[:, own.var(axis=0).argmax()], kind="stable")
            half = len(rows) // 2
            open_ += [rows[order[:half]], rows[order[half:]]]
        order = np.concatenate(done)
        first = np.cumsum([0, *map(len, done[:-1])])
        return order, first, *[
            f.reduceat(x[order], first, axis=0)
            for f, x in ((np.maximum, self.letters), (np.minimum, self.size), (np.minimum, self.text_size))
        ]


def stretches(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start..start+count of all stretches, one after the other."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - start, count)


def _tokens_of(block: NameBlock, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of ``block[rows]``: which of the rows, its number, its place in the name."""
    count = block.count[rows]
    at = stretches(block.start[rows], count)
    return np.repeat(np.arange(len(rows)), count), block.flat[at], at - np.repeat(block.start[rows], count)


def _held(block: NameBlock, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether ``block[rows]`` hold these tokens, given by the block's numbers or -1."""
    wide = len(block.texts) + 1
    keys = np.repeat(np.arange(len(block.count)), block.count) * wide + block.flat
    wanted = rows * wide + codes
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return (codes >= 0) & (keys[at] == wanted) if len(keys) else np.zeros(len(rows), bool)


def _translated(source: NameBlock, target: NameBlock) -> np.ndarray:
    """Numbers of the source's tokens in the target, -1 where it has none."""
    return np.array([target.codes.get(t, -1) for t in source.texts], np.int64)


def _rest(block: NameBlock, rows: np.ndarray, pair: np.ndarray, place: np.ndarray, shared: np.ndarray):
    """Texts of what is left of ``block[rows]`` without the shared tokens: all texts of the
    block, then one for each different rest, and the text of each row."""
    taken = np.zeros((len(rows), 1 + int(block.count.max(initial=0)) // 63), np.int64)
    np.bitwise_or.at(taken, (pair[shared], place[shared] // 63), np.int64(1) << (place[shared] % 63))
    some = np.flatnonzero(taken.any(axis=1))
    different, of = np.unique(np.column_stack([rows[some], taken[some]]), axis=0, return_inverse=True)
    texts = list(block.sorted)
    for row, *bits in different.tolist():
        own = block.flat[block.start[row] : block.start[row] + block.count[row]].tolist()
        texts.append(" ".join(block.texts[c] for k, c in enumerate(own) if not bits[k // 63] >> (k % 63) & 1))
    out = rows.copy()
    out[some] = len(block.sorted) + of.ravel()
    return texts, out


def token_set_ratios(left: NameBlock, right: NameBlock, ia, ib) -> np.ndarray:
    """Token-set ratio of left[ia], right[ib]."""
    pa, ca, ka = _tokens_of(left, ia)
    pb, cb, kb = _tokens_of(right, ib)
    both_a = _held(right, ib[pa], _translated(left, right)[ca])
    both_b = _held(left, ia[pb], _translated(right, left)[cb])
    shared = np.bincount(pa[both_a], minlength=len(ia))
    letters = np.bincount(pa[both_a], left.length[ca[both_a]], minlength=len(ia)).astype(np.int64)
    n = np.where(shared > 0, letters + shared - 1, 0)
    xs, rx = _rest(left, ia, pa, ka, both_a)
    ys, ry = _rest(right, ib, pb, kb, both_b)
    ex, ey = encode(xs, ys)
    common = lcs_lengths(ex, ey, rx, ry)
    lx, ly = ex.size[rx], ey.size[ry]
    gap = (n > 0).astype(np.int64)
    p, q = n + gap + lx, n + gap + ly
    with np.errstate(divide="ignore", invalid="ignore"):
        value = 1 - (lx + ly - 2 * common) / (p + q)
        value = np.where(n > 0, np.maximum(value, 1 - (1 + lx) / (n + p)), value)
        value = np.where(n > 0, np.maximum(value, 1 - (1 + ly) / (n + q)), value)
    one_empty = (lx == 0) | (ly == 0)
    return np.where(one_empty, (n > 0).astype(float), value)


def _possible(probe: NameBlock, block: NameBlock, threshold: float):
    """Pairs that may reach the threshold, and by which of the two ratios.

    With ``c`` letters in common (as multisets), no window ratio exceeds
    ``2c / (m + c)`` for a shorter length ``m``, and without a shared token the
    token-set ratio is at most ``2c`` over the two token-text lengths. Both bounds rise
    with ``c`` and fall with the lengths, so a group's most letters and least lengths
    bound all its members; only members of groups that pass are bounded one by one. Pairs
    with a shared token are found by the tokens' holders.
    """
    order, first, letters, sizes, texts = block.groups
    need = threshold - 1e-9

    def passes(c, m, n, p, q):
        return 2.0 * c >= need * (np.minimum(m, n) + c), 2.0 * c >= need * (p + q)

    most = np.zeros((len(probe.names), len(first)), dtype=np.int32)
    for k in np.flatnonzero(probe.letters.any(axis=0) & letters.any(axis=0)):
        most += np.minimum.outer(probe.letters[:, k], letters[:, k])
    windows, tokens = passes(most, probe.size[:, None], sizes[None, :], probe.text_size[:, None], texts[None, :])
    i, g = np.nonzero(windows | tokens)
    members = np.diff(np.append(first, len(order)))[g]
    ia, ib = np.repeat(i, members), order[stretches(first[g], members)]
    by_window, by_token = np.zeros(len(ia), bool), np.zeros(len(ia), bool)
    for at in range(0, len(ia), LANES):
        x, y = ia[at : at + LANES], ib[at : at + LANES]
        c = np.minimum(probe.letters[x], block.letters[y]).sum(axis=1, dtype=np.int64)
        bounds = passes(c, probe.size[x], block.size[y], probe.text_size[x], block.text_size[y])
        by_window[at : at + LANES], by_token[at : at + LANES] = bounds
    keep = by_window | by_token
    block.touched += len(ia)
    ia, ib, by_window, by_token = ia[keep], ib[keep], by_window[keep], by_token[keep]

    holders, starts = block.holders, block.held_from
    row, code, _ = _tokens_of(probe, np.arange(len(probe.count)))
    code = _translated(probe, block)[code]
    row, code = row[code >= 0], code[code >= 0]
    count = starts[code + 1] - starts[code]
    wide = len(block.count)
    found = np.unique(np.repeat(row, count) * wide + holders[stretches(starts[code], count)])
    block.touched += len(found)
    keys = ia * wide + ib
    every = np.union1d(keys, found)
    window, token = np.zeros(len(every), bool), np.zeros(len(every), bool)
    window[np.searchsorted(every, keys)] = by_window
    token[np.searchsorted(every, keys)] = by_token
    token[np.searchsorted(every, found)] = True
    return every // max(1, wide), every % max(1, wide), token, window


def match_names(names: list[str], block: NameBlock, threshold: float):
    """Indices and scores of every (name, block name) pair scoring at least ``threshold``."""
    probe = NameBlock(names)
    ia, ib, by_token, by_window = _possible(probe, block, threshold)
    # Scores below the threshold need not be exact.
    score = np.full(len(ia), np.nextafter(threshold, -1.0))
    score[by_token] = np.maximum(
        score[by_token], token_set_ratios(probe, block, ia[by_token], ib[by_token])
    )
    score[by_window] = partial_ratios(
        *encode(names, block.names), ia[by_window], ib[by_window], floor=score[by_window]
    )
    hit = score >= threshold
    return ia[hit], ib[hit], score[hit]


def _pairwise(kind: str):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known = (a.notna() & b.notna()).to_numpy()
        left, ia = np.unique(a[known].to_numpy(dtype=object), return_inverse=True)
        right, ib = np.unique(b[known].to_numpy(dtype=object), return_inverse=True)
        out = np.full(len(a), np.nan)
        if known.any():
            if kind == "partial":
                out[known] = partial_ratios(*encode(list(left), list(right)), ia, ib)
            else:
                tok = token_set_ratios(NameBlock(list(left)), NameBlock(list(right)), ia, ib)
                if kind == "score":
                    tok = partial_ratios(*encode(list(left), list(right)), ia, ib, floor=tok)
                out[known] = tok
        return pd.Series(out).replace({np.nan: None})

    return F.pandas_udf(run, "double")


def partial_ratio(a: Column, b: Column) -> Column:
    return _pairwise("partial")(a, b)


def token_set_ratio(a: Column, b: Column) -> Column:
    return _pairwise("tokens")(a, b)


def fuzzy_score(a: Column, b: Column) -> Column:
    return _pairwise("score")(F.lower(a), F.lower(b))
