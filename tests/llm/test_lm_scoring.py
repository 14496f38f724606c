import math
from collections import Counter

import numpy as np
import pytest

from classmap.llm import lm_scoring
from tests.llm.tables import awkward, frame


def brute(rows, target, size, smoothing):
    tokens = lambda t: (t or "").encode().lower().split()
    seen = Counter(w for _, t in rows for w in tokens(t) if len(w) <= 64)
    words = [w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:size]]
    known = set(words)
    chain = lambda t: ["<s>", *(w if w in known else "<unk>" for w in tokens(t))]
    pairs = lambda table: Counter(p for _, t in table for p in zip(chain(t), chain(t)[1:], strict=False))
    all_words = ["<unk>", *words, "<s>"]
    b, t = pairs(rows), pairs(target)
    total = max(1, sum(t.values()))

    def model(counts):
        scale = total / max(1, sum(counts.values()))
        single = {w: 1.0 for w in all_words}
        before = Counter()
        for (v, w), n in counts.items():
            single[w] += n * scale
            before[v] += n * scale
        every = sum(single.values())
        return lambda v, w: -math.log((counts[v, w] * scale + smoothing * single[w] / every) / (before[v] + smoothing))

    both = model(t), model(b)
    out = []
    for i, text in rows:
        own = chain(text)
        n = len(own) - 1
        means = [sum(m(v, w) for v, w in zip(own, own[1:], strict=False)) / n for m in both] if n else [None, None]
        out.append((i, n, *means, means[0] - means[1] if n else None))
    return out


@pytest.mark.parametrize("size", [5, 2048])
def test_matches_brute_force(spark, size):
    rows = awkward()
    target = [r for r in rows if r[0] is not None and r[0] < 12]
    found = lm_scoring.cross_entropy_difference(frame(spark, rows).repartition(4), frame(spark, target), vocabulary_size=size).collect()
    want = brute(rows, target, size, lm_scoring.SMOOTHING)
    key = lambda r: repr((r[0], r[1], r[2] and round(r[2], 3)))
    got = sorted(map(tuple, found), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:2] == b[:2]
        assert (a[2] is None) == (b[2] is None)
        if a[2] is not None:
            np.testing.assert_allclose(a[2:], b[2:], atol=2e-5)


def test_target_like_texts_score_lower(spark):
    good = [(i, "the cat sat on the mat and the dog ran") for i in range(20)]
    bad = [(100 + i, "buy now cheap buy now cheap deal") for i in range(20)]
    found = lm_scoring.cross_entropy_difference(frame(spark, good + bad), frame(spark, good)).collect()
    assert max(r["score"] for r in found if r["doc_id"] < 100) < min(r["score"] for r in found if r["doc_id"] >= 100)


def test_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, awkward())
    assert lm_scoring.cross_entropy_difference(none, some).count() == 0
    assert lm_scoring.cross_entropy_difference(some, none).count() == some.count()
    assert lm_scoring.cross_entropy_difference(none, none).count() == 0
