"""Token files: ids in Simple-8b words, and back.

A 64-bit word holds a selector in its upper four bits and, below, as many ids of one width
as 60 bits take. Selector 0 is the escape: its 60 bits count the ids that follow as whole
words because they need more than 60 bits. Words hold exactly as many ids as their
selector says, and no word spans two documents, so documents can be read apart.

A file is ``magic``, the words of its blocks (little-endian), an Arrow IPC stream of its
documents, one of its blocks, the two streams' lengths and ``magic`` again. A document has
its id, its number of ids and of words. A block is a stretch of documents: it has the
number of its first document, of the words and of the ids before it, and its different
ids, the most frequent first; its words hold places in that list, which are small where
ids are not. So blocks are decoded each by itself, selector by selector for all words at
once.

Documents are dealt out by ranges of ascending ids. Each range's task codes them and writes
its files under names of its own attempt, and the stored index names the files that count.
Paths may be of any store that Arrow opens.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import text_or_empty
from classmap.llm.tokens import encoder as text_encoder
from classmap.llm.tokens import with_end
from classmap.plans.settle import new_path, settle

MAGIC = b"S8BTOKEN"
END_ID = 2
# Ids in a word and their width in bits, by selector; selector 0 is the escape.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])
WIDTHS = np.array([0, *[60 // n for n in COUNTS[1:15]], 0])
# By bit length, the most ids in a word; by number of ids left, the largest number a word may hold.
ROOM = np.array([max([n for n in COUNTS[1:15] if 60 // n >= max(1, bits)], default=0) for bits in range(66)], np.uint8)
WHOLE = np.array([max([n for n in COUNTS[1:15] if n <= left], default=0) for left in range(61)], np.uint8)
PAYLOAD = np.uint64((1 << 60) - 1)
# A file is closed once it holds so many bytes of words, at the end of a document.
FILE_BYTES = 128 << 20
# Text of a block, at least one document.
ENCODE_BYTES = 4 << 20
# Words an encoder remembers here.
HELD_WORDS = 500_000
# Largest id that is counted in a table.
COUNTED = 1 << 22
# So many documents are followed one by one.
FEW_DOCUMENTS = 64


def pack_ids(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of documents that lie one after the other in ``ids``, and each one's number of words."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    # The most ids of this one's size that a word takes; 0 needs an escape.
    largest = int(ids.max()) if n else 0
    if largest < COUNTED:
        fits = ROOM[np.frexp(np.arange(largest + 1.0))[1]][ids.astype(np.int64)]
    else:
        fits = ROOM[np.frexp(ids.astype(np.float64))[1]]
    # The most ids from here on that share a word: all of them must take that number.
    step = np.minimum(fits, 1)
    window, size = fits, 1  # the least of the next ``size`` ids
    for count in COUNTS[13:0:-1].tolist():
        while size < count and len(window) > 1:
            window = np.minimum(window[:-1], fits[size:])
            size += 1
        if size < count or window.max() < count:
            break
        head = step[: len(window)]
        np.copyto(head, np.uint8(count), where=window >= count)
    ends = np.cumsum(lengths)
    tail = np.concatenate([np.arange(max(e - 60, e - n_own), e) for e, n_own in zip(ends.tolist(), lengths.tolist(), strict=True)])
    left = np.repeat(ends, np.minimum(lengths, 60)) - tail
    step[tail] = np.minimum(step[tail], WHOLE[left])
    starts = word_starts(np.maximum(step, 1), ends - lengths, ends)
    took = step[starts] if n else np.zeros(0, np.int64)
    selectors = np.zeros(61, np.uint64)
    selectors[COUNTS[1:15]] = np.arange(1, 15)
    words = np.zeros(len(starts), np.uint64)
    for count in np.unique(took[took > 0]).tolist():
        rows = np.flatnonzero(took == count)
        width = 60 // count
        word = np.full(len(rows), selectors[count] << np.uint64(60), np.uint64)
        for k in range(count):
            word |= ids[starts[rows] + k] << np.uint64(k * width)
        words[rows] = word
    own = np.bincount(np.searchsorted(np.cumsum(lengths), starts, "right"), minlength=len(lengths))
    if (took == 0).any():
        words, own = _with_escapes(ids, words, starts, took, lengths)
    return words, own


def word_starts(step: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words start: each where the one before it ends, ``step`` further on. Documents,
    from ``at`` to ``ends``, are followed side by side until few long ones are left."""
    found = []
    while len(at := at[live := at < ends]) > FEW_DOCUMENTS:
        ends = ends[live]
        found.append(at)
        at = at + step[at]
    for a, e in zip(at.tolist(), ends[live].tolist(), strict=True):
        jumps, own, place = step[a:e].tolist(), [], 0
        while place < e - a:
            own.append(a + place)
            place += jumps[place]
        found.append(np.array(own, np.int64))
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _with_escapes(ids, words, starts, took, lengths):
    """Put an escape with its count before each run of ids that need a whole word."""
    whole = took == 0
    document = np.searchsorted(np.cumsum(lengths), starts, "right")
    first = whole & ~np.concatenate(([False], whole[:-1] & (document[1:] == document[:-1])))
    run = np.cumsum(first)[whole] - 1
    words = words.copy()
    words[whole] = ids[starts[whole]]
    at = np.flatnonzero(first)
    out = np.insert(words, at, np.bincount(run, minlength=len(at)).astype(np.uint64))
    own = np.bincount(document, minlength=len(lengths)) + np.bincount(document[at], minlength=len(lengths))
    return out, own


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, the most frequent first, and each id's place among them."""
    if len(ids) and int(ids.max()) < COUNTED:
        counts = np.bincount(ids)
        different = np.flatnonzero(counts)
        order = np.argsort(-counts[different], kind="stable")
        place = np.zeros(len(counts), np.uint32)
        place[different[order]] = np.arange(len(order))
        return different[order].astype(np.uint64), place[ids]
    different, at, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.zeros(len(order), np.uint32)
    place[order] = np.arange(len(order))
    return different[order].astype(np.uint64), place[at]


def unpack_ids(words: np.ndarray) -> np.ndarray:
    """Ids of whole documents' words, or of whole blocks."""
    words = words.astype(np.uint64, copy=False)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    plain = np.ones(len(words), bool)
    counts = COUNTS[selectors]
    escapes = np.flatnonzero(selectors == 0)
    at = 0
    while at < len(escapes):  # whole words behind an escape may look like anything
        e = int(escapes[at])
        end = e + 1 + int(words[e] & PAYLOAD)
        plain[e:end] = False
        counts[e], counts[e + 1 : end] = 0, 1
        at = int(np.searchsorted(escapes, end))
    places = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for selector in np.unique(selectors[plain]).tolist():
        rows = np.flatnonzero(plain & (selectors == selector))
        width = np.uint64(WIDTHS[selector])
        mask, body, at = np.uint64((1 << int(width)) - 1), words[rows], places[rows]
        for k in range(int(COUNTS[selector])):
            out[at + k] = body >> np.uint64(k * int(width)) & mask
    raw = np.flatnonzero(~plain & (counts == 1))
    out[places[raw]] = words[raw]
    return out


def coded(
    batches: Iterator[pa.RecordBatch], tokenizer_path: str, end_id: int
) -> Iterator[tuple[pa.Array, np.ndarray, list[bytes], np.ndarray]]:
    """Names of documents, their numbers of ids, their words and the different ids, for
    stretches of rows."""
    encoder = text_encoder(tokenizer_path, HELD_WORDS)
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        before, at = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), 0
        while at < batch.num_rows:
            # Texts of about ENCODE_BYTES at a time, at least one.
            n = max(1, int(np.searchsorted(before, before[at] + ENCODE_BYTES)) - 1 - at)
            part = batch.slice(at, n)
            ids, lengths = with_end(*encoder.encode_column(part.column("text")), end_id)
            different, places = ranked(ids)
            words, own = pack_ids(places, lengths)
            raw, ends = words.astype("<u8").tobytes(), np.cumsum(own).tolist()
            yield part.column("doc_id"), lengths, [raw[8 * a : 8 * b] for a, b in zip([0, *ends], ends, strict=False)], different
            at += n


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, of a plain path or an URI as Hadoop writes it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _stream(table: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_batch(table)
    return sink.getvalue()


class FileWriter:
    """One file; documents are appended in order."""

    def __init__(self, folder: str, name: str):
        store, inside = _store(folder)
        store.create_dir(inside, recursive=True)
        self.path = f"{folder}/{name}"
        self.out = store.open_output_stream(f"{inside}/{name}")
        self.out.write(MAGIC)
        self.names: list[pa.Array] = []
        self.tokens: list[np.ndarray] = []
        self.words: list[np.ndarray] = []
        self.different: list[np.ndarray] = []
        self.bytes = 0

    def add(self, names: pa.Array, n_tokens: np.ndarray, words: list[bytes], different: np.ndarray) -> None:
        """Append a block."""
        raw = b"".join(words)
        self.out.write(raw)
        self.bytes += len(raw)
        self.names.append(names)
        self.tokens.append(n_tokens)
        self.words.append(np.array([len(w) // 8 for w in words], np.int64))
        self.different.append(different)

    def close(self) -> tuple:
        """Path, documents and ids of the finished file."""
        tokens, words = np.concatenate(self.tokens), np.concatenate(self.words)
        documents = pa.record_batch([pa.concat_arrays(self.names), pa.array(tokens), pa.array(words)], ["doc_id", "n_tokens", "n_words"])
        first = np.cumsum([0, *map(len, self.tokens[:-1])])
        before = [np.concatenate(([0], np.cumsum(x)))[first] for x in (words, tokens)]
        ends = pa.array(np.cumsum([0, *map(len, self.different)]), pa.int32())
        different = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(self.different)))
        blocks = pa.record_batch(
            [pa.array(first), *map(pa.array, before), different], ["document", "words_before", "ids_before", "ids"]
        )
        tail = [_stream(documents), _stream(blocks)]
        for part in (*tail, np.array([len(t) for t in tail], "<u8").tobytes(), MAGIC):
            self.out.write(part)
        self.out.close()
        return self.path, len(tokens), int(tokens.sum())


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the files and return their stored index: ``path, place`` (order of the files)``,
    documents, ids`` and ``start``, the number of ids in all files before.

    Documents stand in ascending order of their ids, null ids first; rows that repeat an id
    are documents of their own, in the order of a hash of their texts. Each document is the
    ids of its whole text (null: empty) and ``end_id``; other columns are ignored. An empty
    table gives an empty index. A task that is run again writes new files, and those it
    left behind are in no index.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), text_or_empty(col(text)).alias("text"))
    # The row number deals many copies under one id out over several ranges.
    rows = rows.select("*", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row"))
    keys = [F.col("doc_id").asc_nulls_first(), "mark", "row"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, writer, number = TaskContext.get().partitionId(), None, 0

        def closed() -> pa.RecordBatch:
            nonlocal number
            path, documents, ids = writer.close()
            number += 1
            return pa.record_batch(
                [pa.array([path]), pa.array([task * (1 << 32) + number]), pa.array([documents]), pa.array([ids])],
                ["path", "place", "documents", "ids"],
            )

        for names, tokens, words, different in coded(batches, tokenizer_path, end_id):
            at = 0
            while at < len(words):
                if writer is None:
                    writer = FileWriter(folder, f"{task:06d}-{number:04d}-{uuid.uuid4().hex}.s8b")
                room, end = file_bytes - writer.bytes, at
                while end < len(words) and (room > 0 or end == at):
                    room -= len(words[end])
                    end += 1
                writer.add(names.slice(at, end - at), tokens[at:end], words[at:end], different)
                at = end
                if writer.bytes >= file_bytes:
                    yield closed()
                    writer = None
        if writer is not None:
            yield closed()

    schema = "path string, place bigint, documents bigint, ids bigint"
    files = settle(dealt.select("doc_id", "text").mapInArrow(run, schema), "token-files")
    # One row per file.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_blocks(path: str) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """Blocks of a file: rows of its document table, the ids before them, and all their ids."""
    store, inside = _store(path)
    with store.open_input_file(inside) as file:
        end = file.size()
        file.seek(end - 24)
        tail = file.read(24)
        file.seek(0)
        if tail[16:] != MAGIC or file.read(8) != MAGIC:
            raise ValueError(f"{path} is not a token file")
        size, blocks_size = np.frombuffer(tail[:16], "<u8").tolist()
        file.seek(end - 24 - blocks_size - size)
        documents = pa.ipc.open_stream(file.read(size)).read_next_batch()
        blocks = pa.ipc.open_stream(file.read(blocks_size)).read_next_batch()
        first = [*blocks.column("document").to_pylist(), documents.num_rows]
        starts = [*blocks.column("words_before").to_pylist(), (end - 24 - blocks_size - size - 8) // 8]
        for i, before in enumerate(blocks.column("ids_before").to_pylist()):
            file.seek(8 + 8 * starts[i])
            words = np.frombuffer(file.read(8 * (starts[i + 1] - starts[i])), "<u8")
            different = blocks.column("ids")[i].values.to_numpy()
            yield documents.slice(first[i], first[i + 1] - first[i]), before, different[unpack_ids(words)]


def read_token_files(index: DataFrame, id_type: str, *, with_ids: bool = False) -> DataFrame:
    """Per document of the files in an index: ``doc_id, start`` (ids of all documents
    before it)``, n_tokens, ids_crc32`` (over little-endian 32-bit ids) and, with
    ``with_ids``, its ``ids``. One task reads one file."""
    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                for documents, before, ids in read_blocks(path):
                    lengths = documents.column("n_tokens").to_numpy()
                    raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths) * 4
                    crcs = [zlib.crc32(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                    columns = [
                        documents.column("doc_id"), pa.array(start + before + np.cumsum(lengths) - lengths),
                        documents.column("n_tokens"), pa.array(crcs, pa.int64()),
                    ]
                    heads = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                        heads.append("ids")
                    yield pa.record_batch(columns, heads)

    spread = index.repartitionByRange(max(1, index.count()), "place")
    return spread.select("path", "start").mapInArrow(run, schema)


def token_documents(
    docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
    folder: str | None = None, with_ids: bool = False, **limits,
) -> DataFrame:
    """Write token files below ``folder`` (default: the shared folder) and read them back."""
    where = folder or new_path(docs.sparkSession, "tokens")
    index = write_token_files(docs, where, tokenizer_path, doc_id=doc_id, text=text, end_id=end_id, **limits)
    kind = docs.select(col(doc_id)).schema[0].dataType.simpleString()
    return read_token_files(index, kind, with_ids=with_ids)
