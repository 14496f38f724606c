"""Repair of conversations at the least cost, by a suffix-shared automaton.

A conversation is a word of signatures, one per row: the class of its role and its
fault. Rows are read from the end, so equal suffixes meet in the same node of a minimal
acyclic automaton, whatever conversation they belong to. A node knows, for every state of
the grammar ``(s?(ua)+)?``, the least cost of the rows from there on and the first edit of
the best way: an edit is worked out once per node and state, not once per row.

At one row the possible edits have different letters, so the least audit among the
cheapest is found by its first letter alone; the audit is read off along the nodes.

Two passes run over rows grouped by conversation and sorted by Spark. The first one sees
signatures only. The second one streams the texts past the finished audits. A task holds
one byte per row of the conversation at hand and never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import SPACE

# Costs of the edits, and of keeping a cut text.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ABSENT_TEXT = " "
# Classes of roles by their initial; all others are one more class.
INITIALS = "sua"
SOUND, BLANK, DUPLICATE, CUT = range(4)
# Leading characters of a text that order rows of the same turn and role.
HEAD = 32
# Nodes held by a task before it starts anew, and rows whose suffixes are shared.
MOST_NODES, SHARED_ROWS = 1 << 20, 1 << 12

# States of the grammar: at the start, after s, after u, after a.
START, SYSTEM, USER, ANSWER = range(4)
# State -> the role that may come next besides a first s, and the state after it.
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ANSWER), ANSWER: ("u", USER)}
NAMES = {"u": "user", "a": "assistant"}
FAR = 1 << 60
# Cost to go and first edit of each state where no rows are left.
ENDED = ((0, ""), (2 * INSERT, "I"), (INSERT, "I"), (0, ""))


def after(state: int, role: str) -> int | None:
    """State behind a row of this role class, None if it may not stand here."""
    if state == START and role == "s":
        return SYSTEM
    want, then = NEXT[state]
    return then if role == want else None


def back(rest: tuple, role: str, fault: int) -> tuple:
    """Cost to go and first edit of each state before a row, from those behind it."""
    best = []
    more = TRUNCATED if fault == CUT else 0
    for state in range(4):
        ways = [(DELETE + rest[state][0], "D")]
        if fault in (SOUND, CUT):
            then = after(state, role)
            if then is not None:
                ways.append((more + rest[then][0], "K"))
            ways.append((more + REROLE + rest[NEXT[state][1]][0], "R"))
        best.append(min(ways))
    for _ in range(3):  # insertions lead to other states before the same row
        best = [min(best[q], (INSERT + best[NEXT[q][1]][0], "I")) for q in range(4)]
    return tuple(best)


class SuffixAutomaton:
    """Nodes by (signature, node behind); node 0 is the end of every conversation."""

    def __init__(self) -> None:
        self.known: dict[int, int] = {}
        self.behind, self.signs, self.best = [0], [0], [ENDED]

    def node(self, behind: int, sign: int) -> int:
        key = behind << 4 | sign
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.best)
            self.behind.append(behind)
            self.signs.append(sign)
            self.best.append(back(self.best[behind], *signature(sign)))
        return at


def signature(sign: int) -> tuple[str, int]:
    """Role class and fault; rows that must go are all alike."""
    return (INITIALS + "?")[sign >> 2], sign & 3


def step(state: int, edit: str, role: str) -> int:
    return state if edit == "D" else after(state, role) if edit == "K" else NEXT[state][1]


class Reader:
    """One conversation, fed its signatures from the end."""

    def __init__(self, shared: SuffixAutomaton) -> None:
        self.shared, self.node, self.rows = shared, 0, 0
        # Past the shared rows: the signature and the four first edits of each row.
        self.best, self.own = None, bytearray()

    def feed(self, sign: int) -> None:
        self.rows += 1
        if self.rows <= SHARED_ROWS:
            self.node = self.shared.node(self.node, sign)
            return
        self.best = back(self.best or self.shared.best[self.node], *signature(sign))
        self.own.append(sign)
        self.own.extend(ord(e) for _, e in self.best)

    def result(self) -> tuple[int, str]:
        """Cost and audit."""
        cost = (self.best or self.shared.best[self.node])[START][0]
        state, audit = START, bytearray()
        for at in range(len(self.own) - 5, -1, -5):
            while True:
                edit = chr(self.own[at + 1 + state])
                audit.append(ord(edit))
                state = step(state, edit, signature(self.own[at])[0])
                if edit != "I":
                    break
        node = self.node
        while True:
            edit = self.shared.best[node][state][1]
            if not edit:
                return cost, audit.decode()
            audit.append(ord(edit))
            state = step(state, edit, signature(self.shared.signs[node])[0])
            if edit != "I":
                node = self.shared.behind[node]


PLAN = "gaps bigint, `blank` bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _runs(batch: pa.RecordBatch, column: str) -> list[tuple[int, int]]:
    """Stretches of rows with the same number."""
    ids = batch.column(column).to_numpy(zero_copy_only=False)
    cut = (np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist()
    return list(zip([0, *cut], [*cut, len(ids)], strict=True))


def _plans(batches: Iterator[pa.RecordBatch], legal: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """Counts, cost and audit of each conversation; rows come from the last to the first."""
    shared = SuffixAutomaton()
    now, who, reader, counts, turns, initial = None, None, Reader(shared), [0] * 5, None, None

    def closed() -> tuple:
        first, last, different = turns or (0, 0, 1)
        cost, audit = reader.result()
        return (who, last - first + 1 - different, *counts[1:4], counts[4], cost, audit)

    for batch in batches:
        done = []
        signs, places, initials, marks = (batch.column(c).to_pylist() for c in ("sign", "turn", "initial", "present"))
        keys = batch.column("_key").to_numpy(zero_copy_only=False)
        names = batch.column("conv_id")
        for a, b in _runs(batch, "_key"):
            if now is None or keys[a] != now:
                if now is not None:
                    done.append(closed())
                if len(shared.best) > MOST_NODES:
                    shared = SuffixAutomaton()
                now, who = keys[a], names[a].as_py()
                reader, counts, turns, initial = Reader(shared), [0] * 5, None, None
            for i in range(a, b):
                if not marks[i]:
                    continue
                fault, turn = signs[i] & 3, places[i]
                counts[fault] += 1
                if turn is not None:
                    if turns is None:
                        turns = (turn, turn, 1)
                    elif turn != turns[0]:
                        turns = (turn, turns[1], turns[2] + 1)
                if initial is not None and initials[i] + initial not in legal:
                    counts[4] += 1
                initial = initials[i]
                # What must go is one signature, whatever its role and fault.
                reader.feed(12 | BLANK if fault in (BLANK, DUPLICATE) else signs[i])
        if done:
            yield _plan_batch(done, names.type)
    if now is not None:
        yield _plan_batch([closed()], names.type)


def _plan_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:7]], pa.array(columns[7], pa.string())]
    return pa.record_batch(arrays, ["conv_id", *COUNTS, "audit"])


def marked(
    rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """The rows as ``conv_id, turn, role, text, present`` and what orders and tells them."""
    spoken = [F.coalesce(col(c).cast("string"), F.lit(ABSENT_TEXT)) for c in (role, text)]
    plain = rows.select(
        col(conv_id).alias("conv_id"), col(turn).cast("bigint").alias("turn"), spoken[0].alias("role"),
        spoken[1].alias("text"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    )
    return plain.select(
        "*", F.left("text", F.lit(HEAD)).alias("head"),
        F.xxhash64("role", "text").alias("m1"), F.xxhash64(F.lit("again"), "text", "role").alias("m2"),
        # One number per conversation to group by; equal numbers are told apart by the id.
        F.xxhash64("conv_id").alias("_key"),
    )


# Rows of a conversation in order.
ORDER = ("turn", "role", "head", "m1", "m2")


def repair_plans(rows: DataFrame) -> DataFrame:
    """``conv_id``, the counts, the cost and the audit of each conversation of :func:`marked` rows."""
    first = F.left("role", F.lit(1))
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(SOUND)
    place = F.instr(F.lit(INITIALS), first)
    kind = F.when((first == "") | (place == 0), len(INITIALS)).otherwise(place - 1)
    thin = rows.select("_key", "conv_id", *ORDER, "present", first.alias("initial"), kind.alias("kind"), fault.alias("fault"))
    same = Window.partitionBy("present", "conv_id", "m1", "m2").orderBy(F.col("turn").asc_nulls_first())
    again = (F.col("nth") > 1) & (F.col("fault") != BLANK)
    sign = F.col("kind") * 4 + F.when(again, DUPLICATE).otherwise(F.col("fault"))
    thin = thin.withColumn("nth", F.row_number().over(same)).withColumn("sign", sign)
    dealt = thin.repartition("conv_id").sortWithinPartitions(
        "_key", "conv_id", F.col("turn").desc_nulls_last(), *[F.col(c).desc() for c in (*ORDER[1:], "nth")]
    )
    legal = frozenset(("su", "ua", "au"))
    kept = dealt.select("_key", "conv_id", "turn", "initial", "present", "sign")
    name = rows.schema["conv_id"].dataType.simpleString()
    return kept.mapInArrow(lambda b: _plans(_numbered(b), legal), f"conv_id {name}, {PLAN}")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_key`` becomes a running number of the conversation in the task."""
    number, before = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, names = batch.column("_key").to_numpy(zero_copy_only=False), batch.column("conv_id")
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        # Neighbours of one number are one conversation unless their ids differ.
        codes = names.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
        new[0] = before is None or (keys[0], names[0].as_py()) != before
        numbers = number + np.cumsum(new)
        number, before = int(numbers[-1]), (keys[-1], names[-1].as_py())
        at = batch.schema.get_field_index("_key")
        yield batch.set_column(at, "_key", pa.array(numbers, pa.int64()))


def _edited(batches: Iterator[pa.RecordBatch], digests: bool) -> Iterator[pa.RecordBatch]:
    """Follow the audits along the rows: digests per conversation, or the repaired rows."""
    now, who, plan, audit, at, state, place, hasher = None, None, None, "", 0, START, 0, None

    def put(role: str, text: str, edit: str) -> None:
        nonlocal place
        if digests:
            hasher.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        else:
            out.append((who, place, role, text, edit))
        place += 1

    def inserted() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role, state = NEXT[state]
            put(NAMES[role], "", "I")
            at += 1

    def finish() -> None:
        inserted()
        if digests:
            out.append((who, *(plan[c] for c in COUNTS), audit, hasher.hexdigest()))

    def flush(kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        if digests:
            heads = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
            kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
        else:
            heads, kinds = ["conv_id", "place", "role", "text", "edit"], [kind, pa.int64(), *[pa.string()] * 3]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], heads)

    out, kind = [], None
    for batch in batches:
        kind = batch.column("conv_id").type
        keys, names = batch.column("_key").to_pylist(), batch.column("conv_id")
        roles, texts, plans = (batch.column(c).to_pylist() for c in ("role", "text", "plan"))
        for i, key in enumerate(keys):
            if key != now:
                if now is not None:
                    finish()
                now, who, plan = key, names[i].as_py(), plans[i]
                audit, at, state, place, hasher = plan["audit"], 0, START, 0, hashlib.sha256()
                continue
            inserted()
            edit = audit[at]
            at += 1
            if edit == "K":
                put(roles[i], texts[i], edit)
                state = after(state, roles[i][:1])
            elif edit == "R":
                role, state = NEXT[state]
                put(NAMES[role], texts[i], edit)
        if out:
            yield flush(kind)
            out = []
    if now is not None:
        finish()
    if out:
        yield flush(kind)


def _applied(rows: DataFrame, digests: bool) -> DataFrame:
    name = rows.schema["conv_id"].dataType.simpleString()
    absent = F.lit(None)
    heads = repair_plans(rows).select(
        F.xxhash64("conv_id").alias("_key"), "conv_id", F.struct(*COUNTS, "audit").alias("plan"),
        absent.cast("bigint").alias("turn"), *[absent.cast("string").alias(c) for c in ("role", "text", "head")],
        *[absent.cast("bigint").alias(c) for c in ("m1", "m2")], F.lit(0).alias("kind"),
    )
    body = rows.where("present").select(
        "_key", "conv_id", absent.cast(heads.schema["plan"].dataType).alias("plan"), "turn", "role", "text", "head",
        "m1", "m2", F.lit(1).alias("kind"),
    )
    dealt = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(
        "_key", "conv_id", "kind", F.col("turn").asc_nulls_first(), *ORDER[1:]
    )
    schema = f"conv_id {name}, " + (f"{PLAN}, repaired_sha256 string" if digests else "place bigint, role string, text string, edit string")
    kept = dealt.select("_key", "conv_id", "plan", "role", "text")
    return kept.mapInArrow(lambda b: _edited(_numbered(b), digests), schema)


def repair_digests(rows: DataFrame, **columns) -> DataFrame:
    """Per conversation ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``; see :func:`repair`. The digest is over ``role:text`` of the repaired
    rows, parted by line ends."""
    return _applied(marked(rows, **columns), True)


def repair(rows: DataFrame, **columns) -> DataFrame:
    """The repaired rows: ``conv_id, place`` (from 0)``, role, text, edit``.

    Rows of a conversation are ordered by turn (nulls first); equal turns by role, the
    first 32 characters of the text and a digest, so repeated rows stand side by side. A
    null role or text is one space, a null id a conversation of its own; other columns
    are ignored. Columns are named by ``conv_id``, ``turn``, ``role``, ``text``; rows for
    which ``present`` is not true only name their conversation.

    A row is blank (nothing but white space), else a duplicate (role and text seen
    earlier), else truncated (the last character besides white space is none of ``.!?``).
    Edits: K keeps a row, R gives it the role user or assistant, D deletes it (blank and
    duplicate rows must go), I inserts a row without text; the roles' initials end up as
    ``(s?(ua)+)?``. Of the cheapest edits those with the least letters are taken. A
    conversation without rows gives none here and zeros in the digests; an empty table
    gives an empty one.
    """
    return _applied(marked(rows, **columns), False)
