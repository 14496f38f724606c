"""Language-model scoring by cross-entropy difference.

Two bigram models, one of a target corpus and one of all documents, share a vocabulary,
their order and their smoothing, and the background's counts are scaled to the target's
number of tokens, so that both are smoothed alike. A document's score is the mean over
its tokens of the target's loss minus the background's: the lower, the more it reads like
the target.

All counts are over whole tables and added up by Spark. Every word counts as itself. Rows
are taken in chunks: a chunk sends the hashes of its different pairs and words with their
counts, once, to buckets of hashes; a bucket adds up what all chunks sent and sends the
sums back to each, where they meet the chunk's rows. With ``vocabulary_size`` only the
most frequent words are told apart, and the two finished tables of losses, which it
bounds, are sent to the tasks.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import byte_texts, give_back
from classmap.plans.settle import settle

# Longest word of a vocabulary of given size.
WORD_BYTES = 64
SMOOTHING = 2.0
SEED = 42
# Mixes the numbers of two words to that of a pair.
MIX = np.uint64(0x9E3779B97F4A7C15)
HALF = np.uint64(32)
# Text of a chunk, whose different pairs are counted and sent once; a row counts as so much more.
CHUNK_BYTES = 24 << 20
SLICE_BYTES = 8 << 20
ROW_BYTES = 64
# Words and rows of a piece of a chunk's rows.
PIECE_WORDS = 1 << 17
PIECE_ROWS = 1 << 16
# Text for each bucket of hashes, whose counts from all chunks one task adds up.
BUCKET_BYTES = 16 << 20
# Columns of what chunks and buckets send to each other, besides the rows' ids.
PARTS = {
    "chunk": pa.int64(), "stamp": pa.int64(), "bucket": pa.int32(), "part": pa.int32(),
    "blobs": pa.list_(pa.binary()), "totals": pa.list_(pa.int64()),
}
# Different words a task holds before it passes its counts on.
HELD_WORDS = 1 << 18
UNKNOWN = 0


def count_words(texts: DataFrame) -> DataFrame:
    """``word, n`` over all rows of the one text column; longer words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = [w for w in held if len(w) <= WORD_BYTES]
            out = pa.record_batch([pa.array(words, pa.binary()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for t in byte_texts(batch.column(0)):
                held.update(t.lower().split())
                if len(held) > HELD_WORDS:
                    yield flush()
        yield flush()

    return texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(texts: DataFrame, size: int) -> list[bytes]:
    """The most frequent words; of equally frequent ones the smaller."""
    top = count_words(texts).orderBy(F.desc("n"), "word").limit(size)
    return [bytes(r["word"]) for r in top.select("word").collect()]


def token_pairs(text: bytes, ids: dict[bytes, int]) -> np.ndarray:
    """Cells (previous word, word) of the tokens; a start mark precedes the first."""
    width = len(ids) + 2
    words = text.lower().split()
    own = np.fromiter((ids.get(w, UNKNOWN) for w in words), np.int64, len(words))
    before = np.concatenate(([width - 1], own[:-1])) if len(own) else own
    return before * width + own


def count_pairs(texts: DataFrame, words: list[bytes]) -> DataFrame:
    """``cell, n`` over all rows; a task adds up its own rows first."""
    ids = texts.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(words)})
    cells = (len(words) + 2) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(cells, np.int64)
        for batch in batches:
            for t in byte_texts(batch.column(0)):
                found, n = np.unique(token_pairs(t, ids.value), return_counts=True)
                sums[found] += n
        found = np.flatnonzero(sums)
        for at in range(0, len(found), 1 << 16):
            part = found[at : at + (1 << 16)]
            yield pa.record_batch([pa.array(part), pa.array(sums[part])], ["cell", "n"])

    return texts.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def count_table(pairs: DataFrame, width: int) -> np.ndarray:
    """Counts as a square matrix. Each row of it is packed by a task; the driver gets as
    many rows as the vocabulary has words."""
    rows = pairs.groupBy(F.floor(F.col("cell") / width).alias("before")).agg(
        F.collect_list(F.struct(F.pmod("cell", F.lit(width)).alias("own"), "n")).alias("found")
    )
    out = np.zeros((width, width))
    for r in rows.select("before", "found.own", "found.n").toArrow().to_batches(256):
        for before, own, n in zip(*(r.column(i) for i in range(3)), strict=True):
            out[before.as_py(), own.values.to_numpy()] = n.values.to_numpy()
    return out


def losses(counts: np.ndarray, tokens: float, smoothing: float = SMOOTHING) -> np.ndarray:
    """-log P(word | previous word), counts scaled to ``tokens`` in all.

    A row is smoothed towards the words' overall shares, these by one more of each word.
    """
    scaled = counts * (tokens / max(1.0, counts.sum()))
    single = scaled.sum(axis=0) + 1
    share = single / single.sum()
    rows = scaled.sum(axis=1, keepdims=True)
    return -np.log((scaled + smoothing * share) / (rows + smoothing)).astype(np.float32)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in few bytes: all their lowest bytes, then all the next ones."""
    values = np.ascontiguousarray(values, "<u8")
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB", len(values), width) + (pa.Codec("zstd").compress(planes, asbytes=True) if planes.size else b"")


def unpack(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", data)
    out = np.zeros((n, 8), np.uint8)
    if n and width:
        planes = pa.Codec("zstd").decompress(data[9:], n * width)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit hashes, as their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).view(np.uint64), dtype=np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many words each text has, the hashes of the different words, and the places of
    all words among these, in order."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, text = split.flatten(), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    counts = np.bincount(text.filter(real).to_numpy(), minlength=len(texts))
    found = words.filter(real).dictionary_encode()
    different = found.dictionary.cast(pa.binary())
    return counts, np.fromiter((word_hash(w.as_py()) for w in different), np.uint64, len(different)), found.indices.to_numpy()


def chunk_words(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many words each text has, the sorted hashes of all different words and the start
    mark, and the places of all words among these, in order."""
    found = [word_hashes(c) for c in columns]
    counts = np.concatenate([f[0] for f in found])
    words, _ = distinct(np.concatenate([[np.uint64(word_hash(b""))], *(f[1] for f in found)]))
    place = np.concatenate([np.searchsorted(words, f[1]).astype(np.int32)[f[2]] for f in found])
    return counts, words, place


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order and how often each occurs; sorts the array it is given."""
    keys.sort()
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[at], np.diff(at, append=len(keys))


def by_frequency(n: np.ndarray) -> np.ndarray:
    """The places of words that occur so often, the most frequent first."""
    return np.argsort(-n, kind="stable").astype(np.int32)


def pair_hashes(words: np.ndarray, before: np.ndarray, place: np.ndarray) -> np.ndarray:
    out = words[before]
    out *= MIX
    out += words[place]
    return out


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, SEED)


def places_before(counts: np.ndarray, words: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of what stands before each word; the start mark, the empty word, before a text's first."""
    out = np.empty_like(place)
    out[1:] = place[:-1]
    out[(np.cumsum(counts) - counts)[counts > 0]] = np.searchsorted(words, np.uint64(word_hash(b"")))
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Rows that follow each other, up to ``CHUNK_BYTES`` of text or one row at a time, in
    slices of up to ``SLICE_BYTES``, which bound what cutting them into words takes."""
    held: list[pa.RecordBatch] = []
    room = CHUNK_BYTES
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes + ROW_BYTES, dtype=np.int64), 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = int(np.searchsorted(ends, done + min(room, SLICE_BYTES), "right"))
            if to <= at and held and ends[at] - done > room:
                yield held
                held, room = [], CHUNK_BYTES
                continue
            to = max(to, at + 1)
            held.append(batch.slice(at, to - at))
            room -= int(ends[to - 1]) - done
            at = to
    if held:
        yield held


def _parts(id_type: pa.DataType, ids: pa.Array | None = None, **columns: list) -> pa.RecordBatch:
    """Rows of ``PARTS``: one with ``ids`` or any number without; columns left out are null."""
    n = len(columns["bucket"])
    lists = pa.nulls(n, pa.list_(id_type)) if ids is None else pa.ListArray.from_arrays([0, len(ids)], ids)
    return pa.record_batch([lists, *(pa.array(columns.get(name, [None] * n), kind) for name, kind in PARTS.items())], ["ids", *PARTS])


def _chunk_parts(rows: DataFrame, schema: str, buckets: int, *, scored: bool) -> DataFrame:
    """The different pairs and words of each chunk of rows with their counts, one part per
    bucket of their hashes. Where the rows are to be scored, also these, as the ranks of
    their words by frequency in the chunk; such pieces travel with any bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, held in enumerate(_chunks(batches)):
            counts, words, place = chunk_words([b.column("text") for b in held])
            ids = pa.concat_arrays([b.column("doc_id") for b in held])
            own_n = np.bincount(place, minlength=len(words))
            chunk = stamp = None
            if scored:
                chunk, stamp = (task << 32) + number, zlib.crc32(place, zlib.crc32(counts))
                ends, at = np.cumsum(counts), np.arange(len(counts))
                order = by_frequency(own_n)
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                cuts = np.flatnonzero(np.diff(ends // PIECE_WORDS + at // PIECE_ROWS, prepend=-1)).tolist()
                for part, (a, b) in enumerate(pairwise([*cuts, len(counts)])):
                    blobs = [pack(counts[a:b]), pack(rank[place[ends[a] - counts[a] : ends[b - 1]]])]
                    where = {"chunk": [chunk], "stamp": [stamp], "bucket": [(task + number + part) % buckets], "part": [part]}
                    yield _parts(ids.type, ids[a:b], **where, blobs=[blobs], totals=[[len(cuts)]])
            before = places_before(counts, words, place)
            before_n = np.bincount(before, minlength=len(words))
            pairs, n = distinct(pair_hashes(words, before, place))
            # By their upper bits: buckets follow each other as the sorted hashes do.
            p, w = ([slice(*x) for x in pairwise(np.searchsorted((keys >> HALF) * np.uint64(buckets) >> HALF, np.arange(buckets + 1)))] for keys in (pairs, words))
            blobs = [
                [pack_keys(pairs[p[i]]), pack(n[p[i]]), pack_keys(words[w[i]]), pack(own_n[w[i]]), pack(before_n[w[i]])]
                for i in range(buckets)
            ]
            del held, place, before, pairs, n
            yield _parts(ids.type, chunk=[chunk] * buckets, stamp=[stamp] * buckets, bucket=list(range(buckets)), blobs=blobs)
            del blobs
            give_back()

    return rows.mapInArrow(run, schema)


def _add_up(keys: list[np.ndarray], counts: list[list[np.ndarray]], target: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The place of each array's keys among all different ones; and of each of ``counts``
    the sums by place, over the target's arrays and over the others."""
    lengths = [len(k) for k in keys]
    different, place = np.unique(np.concatenate(keys), return_inverse=True)
    of = np.repeat(target, lengths)
    sums = [
        np.bincount(place, np.concatenate(n) * which, len(different)).astype(np.int64)
        for n in counts
        for which in (of, ~of)
    ]
    return np.split(place, np.cumsum(lengths)[:-1]), sums


def _in_utc(table: pa.Table) -> pa.Table:
    """Time stamps come in the session's zone; grouped functions must return them in UTC."""

    def utc(kind: pa.DataType) -> pa.DataType:
        if pa.types.is_list(kind):
            return pa.list_(utc(kind.value_type))
        return pa.timestamp(kind.unit, "UTC") if pa.types.is_timestamp(kind) and kind.tz else kind

    return table.cast(pa.schema([pa.field(f.name, utc(f.type)) for f in table.schema]))


def _bucket_sums(rows: pa.Table) -> pa.Table:
    """Sends the sums over all chunks of a bucket's pairs and words back to each chunk to
    be scored, in its own order; pieces of rows go on as they came."""
    counted = rows.filter(pc.is_null(rows["part"]))
    target = pc.is_null(counted["chunk"]).to_numpy()
    pairs, n, words, own_n, before_n = zip(*counted["blobs"].to_pylist(), strict=True)
    pair_places, pair_sums = _add_up([unpack_keys(x) for x in pairs], [[unpack(x) for x in n]], target)
    word_counts = [[unpack(x) for x in c] for c in (own_n, before_n)]
    word_places, word_sums = _add_up([unpack_keys(x) for x in words], word_counts, target)
    own_t, own_b = word_sums[:2]
    totals = [int(np.count_nonzero(own_t + own_b)), int(own_t.sum()), int(own_b.sum())]
    sent = np.flatnonzero(~target).tolist()
    blobs = [
        [words[i], own_n[i], *(pack(x[pair_places[i]]) for x in pair_sums), *(pack(x[word_places[i]]) for x in word_sums)] for i in sent
    ]
    back = {c: counted[c].filter(pc.is_valid(counted["chunk"])).to_pylist() for c in ("chunk", "stamp", "bucket")}
    out = _parts(rows.schema.field("ids").type.value_type, **back, blobs=blobs, totals=[totals] * len(sent))
    give_back()
    passed = rows.filter(pc.is_valid(rows["part"])).select(out.schema.names)
    return _in_utc(pa.concat_tables([passed, pa.Table.from_batches([out]).cast(passed.schema)]))


def _chunk_scores(rows: pa.Table, buckets: int, smoothing: float) -> pa.Table:
    """The scores of a chunk's rows, from the sums that its buckets sent back."""
    sums = rows.filter(pc.is_null(rows["part"])).sort_by("bucket")
    pieces = rows.filter(pc.is_valid(rows["part"])).sort_by("part")
    whole = sums["bucket"].to_pylist() == list(range(buckets)) and pieces["totals"].to_pylist() == [[len(pieces)]] * max(1, len(pieces))
    if not whole or len(pc.unique(rows["stamp"])) > 1:
        raise RuntimeError("a repeated task read its rows in another order; store the documents first")
    n_words, *tokens = (sum(x) for x in zip(*sums["totals"].to_pylist(), strict=True))
    found = list(zip(*sums["blobs"].to_pylist(), strict=True))
    words = np.concatenate([unpack_keys(x) for x in found[0]])
    here, pair_t, pair_b, own_t, own_b, before_t, before_b = (np.concatenate([unpack(x) for x in c]) for c in found[1:])
    counts, places = zip(*([unpack(x) for x in blobs] for blobs in pieces["blobs"].to_pylist()), strict=True)
    order = by_frequency(here)
    places = [order[x] for x in places]
    befores = [places_before(n, words, x) for n, x in zip(counts, places, strict=True)]
    known, _ = distinct(np.concatenate([pair_hashes(words, *x) for x in zip(befores, places, strict=True)]))
    wanted, models = float(max(1, tokens[0])), []
    for all_tokens, pair_n, own_n, before_n in ((tokens[0], pair_t, own_t, before_t), (tokens[1], pair_b, own_b, before_b)):
        scale = wanted / max(1, all_tokens)
        share = (own_n * scale + 1) / (scale * all_tokens + n_words + 2)
        models.append((scale, pair_n, share, before_n * scale + smoothing))
    losses: tuple[list[np.ndarray], ...] = [], []
    for n, before, place in zip(counts, befores, places, strict=True):
        text = np.repeat(np.arange(len(n)), n)
        some, at = np.unique(pair_hashes(words, before, place), return_inverse=True)
        at = np.searchsorted(known, some)[at]
        for out, (scale, pair_n, share, rest) in zip(losses, models, strict=True):
            loss = -np.log((pair_n[at] * scale + smoothing * share[place]) / rest[before])
            out.append(np.bincount(text, loss, len(n)) / np.maximum(n, 1))
    counts, losses = np.concatenate(counts), [np.concatenate(x) for x in losses]
    ids = pa.concat_arrays([x.flatten() for x in pieces["ids"].chunks])
    without = counts == 0
    give_back()
    out = pa.table(
        [ids, pa.array(counts), *(pa.array(x, mask=without) for x in (*losses, losses[0] - losses[1]))],
        ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
    )
    return _in_utc(out)


def _all_words(rows: DataFrame, target: DataFrame, smoothing: float) -> DataFrame:
    spark, id_type = rows.sparkSession, rows.schema["doc_id"].dataType.simpleString()
    # Stored, as it is read twice and may stand at the end of a join.
    target = settle(target.select(F.lit(None).cast(id_type).alias("doc_id"), "text"), "target")
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    text_bytes = sum(table.agg(size).first()[0] for table in (rows, target))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), text_bytes // BUCKET_BYTES + 1)
    schema = f"ids array<{id_type}>, chunk bigint, stamp bigint, bucket int, part int, blobs array<binary>, totals array<bigint>"
    parts = _chunk_parts(rows, schema, buckets, scored=True).unionByName(_chunk_parts(target, schema, buckets, scored=False))
    back = parts.groupBy("bucket").applyInArrow(_bucket_sums, schema)
    return back.groupBy("chunk").applyInArrow(
        lambda chunk: _chunk_scores(chunk, buckets, smoothing),
        f"doc_id {id_type}, n_tokens bigint, target_loss double, background_loss double, score double",
    )


def cross_entropy_difference(
    docs: DataFrame,
    target: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary_size: int | None = None,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, target_loss, background_loss, score``.

    Tokens are lower-cased (A-Z) words between white space, all told apart by a 64-bit hash;
    with ``vocabulary_size`` all but so many words are one unknown word. The background is all of
    ``docs``, the target all of ``target``'s texts. Losses are means per token in nats
    and ``score`` is the target's minus the background's; a null text or one without
    words has no tokens and null losses and score. With an empty target its model is
    uniform but for the smoothing. Rows that repeat an id are scored each for itself;
    other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    if vocabulary_size is None:
        return _all_words(rows, target.select(col(text).alias("text")), smoothing)
    words = vocabulary(rows.select("text"), vocabulary_size)
    width = len(words) + 2
    background = count_table(count_pairs(rows.select("text"), words), width)
    wanted = count_table(count_pairs(target.select(col(text).alias("text")), words), width)
    tokens = max(1.0, float(wanted.sum()))
    tables = losses(wanted, tokens, smoothing), losses(background, tokens, smoothing)
    model = docs.sparkSession.sparkContext.broadcast(({w: i + 1 for i, w in enumerate(words)}, *tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, *both = model.value
        flat = [t.ravel() for t in both]
        for batch in batches:
            found: list[tuple] = []
            for t in byte_texts(batch.column("text")):
                cells = token_pairs(t, ids)
                n = len(cells)
                means = [float(x[cells].sum(dtype=np.float64) / n) for x in flat] if n else [None, None]
                found.append((n, *means, means[0] - means[1] if n else None))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.int64()),
                    *(pa.array([f[i] for f in found], pa.float64()) for i in (1, 2, 3)),
                ],
                ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {id_type}, n_tokens bigint, target_loss double, background_loss double, score double"
    )
