import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from classmap.llm import conversations
from classmap.llm.queries import QUERIES, damaged
from tests.llm.tables import CLASHING, SF_DIR

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = re.compile(r"[ \t\n\x0b\x0c\r]*")
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        yield conv, [] if kind == 0 else [row] * (2 if kind == 3 else 1)


def cheapest(rows, faults):
    """Least ``(cost, audit, repaired)`` over all edits, by whole audits."""

    @lru_cache(None)
    def best(i, initials, inserted):
        state = initials
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            role, text = rows[i]
            ways.append((4, "D", best(i + 1, state, 0)))
            if faults[i] in ("", "truncated"):
                more = 3 * (faults[i] == "truncated")
                if role[:1] and fits(state, role[:1]):
                    ways.append((more, "K", best(i + 1, role[:1], 0), f"{role}:{text}"))
                for r in "ua":
                    if fits(state, r):
                        ways.append((more + 3, "R", best(i + 1, r, 0), f"{NAMES[r]}:{text}"))
        if inserted < 3:
            for r in "ua":
                if fits(state, r):
                    ways.append((3, "I", best(i, r, inserted + 1), f"{NAMES[r]}:"))
        done = []
        for w in ways:
            if len(w) > 2 and isinstance(w[2], tuple) and w[1]:
                rest = w[2]
                if rest is not None:
                    done.append((w[0] + rest[0], w[1] + rest[1], (w[3:] + rest[2])))
            elif not w[1]:
                done.append(w)
        return min(done) if done else (10**9, "~", ())

    def fits(state, r):
        return r in {"": "su", "s": "u", "u": "a", "a": "u"}[state]

    return best(0, "", 0)


def brute(table):
    """By conversation: counts, cost, audit and digest of rows ``(turn, role, text)``."""
    out = {}
    for conv, rows in table.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        faults, seen = [], set()
        for _, role, text in rows:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            faults.append(
                "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            )
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        roles = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
        cost, audit, repaired = cheapest([r[1:] for r in rows], faults)
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return out


def random_rows(seed=2, conversations=150):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "Is it?", "cut", "  ", "", None, "Yes. ", "Long " * 20 + ".", "é.", "ends\n"]
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randint(0, 9)):
            at = None if rng.random() < 0.05 and not any(r[0] == conv and r[1] is None for r in rows) else turn * rng.choice([1, 1, 2])
            if any(r[0] == conv and r[1] == at for r in rows):
                continue
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            rows.append((conv, at, role, rng.choice(texts)))
    return rows


def test_damaged_rows_against_brute_force(spark):
    rows = random_rows()
    table = {}
    for conv, kept in damage(rows):
        table.setdefault(conv, []).extend(r[1:] for r in kept)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in CLASHING]).repartition(3)
    found = conversations.repair_digests(damaged(df), present=F.col("present")).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute(table)
    assert len(found) == len(table)


def test_repaired_rows_follow_the_digest(spark):
    rows = [r for r in random_rows(5) if r[2] is not None and r[3] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    told = {r["conv_id"]: r for r in conversations.repair_digests(df).collect()}
    texts = {}
    for r in sorted(conversations.repair(df).collect(), key=lambda r: r["place"]):
        assert r["place"] == len(texts.setdefault(r["conv_id"], []))
        texts[r["conv_id"]].append((r["role"], r["text"]))
    for conv, r in told.items():
        own = texts.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in own))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == r["repaired_sha256"]


@pytest.mark.parametrize("shared", [0, 3, conversations.SHARED_ROWS])
def test_long_conversations(monkeypatch, shared):
    monkeypatch.setattr(conversations, "SHARED_ROWS", shared)
    rng, automaton = random.Random(7), conversations.SuffixAutomaton()
    for _ in range(60):
        signs = [rng.choice([0, 3, 4, 7, 8, 11, 12, 13]) for _ in range(rng.randint(0, 12))]
        reader = conversations.Reader(automaton)
        for s in reversed(signs):
            reader.feed(s)
        rows = [((conversations.INITIALS + "?")[s >> 2], str(i)) for i, s in enumerate(signs)]
        faults = [("", "blank", "duplicate", "truncated")[s & 3] for s in signs]
        assert reader.result() == cheapest(rows, faults)[:2]
    assert shared or len(automaton.best) == 1


def test_equal_suffixes_share_nodes():
    automaton = conversations.SuffixAutomaton()
    for _ in range(50):
        reader = conversations.Reader(automaton)
        for sign in (8, 4, 8, 4):
            reader.feed(sign)
        assert reader.result() == (0, "KKKK")
    assert len(automaton.best) == 5


def test_repeated_rows_and_one_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(9_000)]
    rows += [(2, 5, "user", "Hello.")] * 4
    found = {r["conv_id"]: r for r in conversations.repair_digests(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert (found[1]["cost"], found[1]["audit"]) == (0, "K" * 9_000)
    assert (found[2]["cost"], found[2]["audit"], found[2]["duplicate"]) == (15, "KDDDI", 3)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(df).count() == conversations.repair_digests(df).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    table = {}
    for conv, kept in damage(rows):
        table.setdefault(conv, []).extend(r[1:] for r in kept)
    found = QUERIES["op12_conversation_repair"](spark, SF_DIR).collect()
    assert {r["conv_id"]: tuple(r[1:]) for r in found} == brute(table)
