"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

import os
import random

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Names that the operators use inside; as extra columns they must do no harm.
CLASHING = "digest body salt keep_id n print root node t k a b mark key at batch size end shard row place held_out score positive codes label_id _kept_id _marks _value _group _range drops".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows, extra=True):
    """Documents from ``(doc_id, text)``, with clashing extra columns."""
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    return df


def awkward(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, copies, near copies, ties and repeated rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    base = [" ".join(word() for _ in range(rng.randint(3, 60))) for _ in range(25)]
    rows: list[tuple[int | None, str | None]] = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.upper() if t.isascii() else t) for i, t in enumerate(base[:6])]
    rows += [(200 + i, t.replace(" ", "\n", 1)) for i, t in enumerate(base[:8])]
    rows += [(300, None), (301, ""), (302, " \t\n\x0b"), (303, " "), (304, "\n\n")]
    rows += [(None, base[0]), (None, None), (None, "only without an id"), (5, base[5]), (5, base[5]), (6, "other text under id six")]
    rows += [(400, "x" * 200_000), (401, " ".join(base) * 40), (402, "<|endoftext|> $$$ ### \U0001f600")]
    line = "This passage of many words is in a great many documents"
    rows += [(500 + i, f"{line}\nown {i}\n  {line.upper()} \n{base[i]}") for i in range(9)]
    return rows
