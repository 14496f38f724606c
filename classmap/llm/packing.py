"""Cost-balanced packing of tokenised documents into training sequences.

Each task packs its own documents in blocks of bounded size, so nothing is shuffled and
whole token lists never leave the task that made them. Within a block the documents are
taken in descending length and each goes to the sequence with the lowest estimated cost
that has room left; what does not fit is cut off and goes to the next one. A piece costs
``linear * n + quadratic * n * n``: the attention of a piece is among its own tokens.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from classmap.functions.names import col
from classmap.llm.common import give_back, text_or_empty
from classmap.llm.tokens import encoder as text_encoder
from classmap.llm.tokens import with_end

CAPACITY = 2048
END_ID = 1
# Attention of a piece costs as much as its linear part at this length.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
# Tokens packed together; bounds a task's memory unless one document is longer.
BLOCK_TOKENS = 1 << 21
ENCODE_BYTES = 1 << 20
# Words remembered by a worker, and during a task whose worker serves other stages as well.
HELD_WORDS, LEAN_WORDS = 400_000, 50_000
SEQUENCES_PER_TASK = 1 << 40

PIECES = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, sequence_tokens bigint"
)


def balanced(
    lengths: Sequence[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces ``(document, start, length, sequence, offset)`` and the sequences' sizes.

    There are as many full sequences as the tokens fill; the rest goes to sequences of
    falling powers of two, which need no padding. So every sequence ends up full.
    """
    full, rest = divmod(sum(lengths), capacity)
    room = [capacity] * full + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
    used, heap, pieces = [0] * len(room), [(0.0, s) for s in range(len(room))], []
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start = 0
        while start < lengths[doc]:
            cost, s = heap[0]
            n = min(lengths[doc] - start, room[s] - used[s])
            pieces.append((doc, start, n, s, used[s]))
            start, used[s] = start + n, used[s] + n
            if used[s] < room[s]:
                heapq.heapreplace(heap, (cost + linear * n + quadratic * n * n, s))
            else:
                heapq.heappop(heap)
    return pieces, used


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    block_tokens: int = BLOCK_TOKENS,
    with_ids: bool = False,
    lean: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, sequence_tokens`` and, with ``with_ids``, the piece's ``ids``.

    A document is the ids of its whole text and ``end_id``; a null or empty text is that
    one id. Every id of every row lies in exactly one piece, whatever the row's id; rows
    that repeat an id are separate documents. Sequences hold ``capacity`` tokens or a
    power of two below it, so none needs padding. ``ids_crc32`` is over the ids as
    little-endian 32-bit numbers. Sequence ids are the task's number in the plan and a
    counter, the same when a lost task is run again. Other columns are ignored. An empty
    table gives no pieces. ``lean`` remembers fewer encoded words and none between tasks,
    which takes more time and leaves a worker's memory to other stages; the rows are the
    same.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), text_or_empty(col(text)).alias("text"))
    schema = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()) + ", ids array<bigint>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_path, LEAN_WORDS if lean else HELD_WORDS)
        task = TaskContext.get().partitionId()
        sequences, names, tokens, waiting = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal sequences, names, tokens, waiting
            pieces, used = balanced([len(t) for t in tokens], capacity, linear, quadratic)
            cut = [tokens[d][a : a + n] for d, a, n, _, _ in pieces]
            of = pa.concat_arrays(names).take(pa.array([p[0] for p in pieces], pa.int64()))
            base = task * SEQUENCES_PER_TASK + sequences
            columns = [
                of,
                *[pa.array([p[i] for p in pieces], pa.int64()) for i in (1, 2)],
                pa.array([zlib.crc32(c.tobytes()) for c in cut], pa.int64()),
                pa.array([len(tokens[p[0]]) for p in pieces], pa.int64()),
                pa.array([base + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
                pa.array([used[p[3]] for p in pieces], pa.int64()),
            ]
            heads = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]
            if with_ids:
                columns.append(pa.array([c.astype(np.int64) for c in cut], pa.list_(pa.int64())))
                heads.append("ids")
            sequences += len(used)
            names, tokens, waiting = [], [], 0
            return pa.record_batch(columns, heads)

        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                # Texts of about ENCODE_BYTES at a time, at least one.
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), ENCODE_BYTES)))
                part = batch.slice(at, n)
                ids, lengths = with_end(*encoder.encode_column(part.column("text")), end_id)
                tokens += np.split(ids, np.cumsum(lengths)[:-1])
                waiting += len(ids)
                names.append(part.column("doc_id"))
                at += n
                if waiting >= block_tokens:
                    yield flush()
        if tokens:
            yield flush()
        if lean:
            encoder.forget()
        give_back()

    return rows.mapInArrow(run, schema)
