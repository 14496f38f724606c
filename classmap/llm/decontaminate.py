"""Benchmark decontamination by size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity to it, which no MinHash
can see. So the items are partitioned by size, and for each size class every document is
cut into overlapping windows of that class's size: a passage as long as an item of the
class lies whole within some window, whose similarity to the item is then large. Windows
and items meet when one of their minima (one permutation, split into bins) is equal; what
meets is verified by the exact share of the item's shingles that the whole document
holds. Only the sketches of one block of items are sent to the tasks at a time, and a
block is bounded in bytes; more items mean more passes over the documents, not larger
ones.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col
from classmap.llm.common import byte_texts, give_back, text_or_empty

SHINGLE_WORDS = 5
THRESHOLD = 0.8
SEED = 42
# Bins of a window's sketch for each shingle of the size class, and at least this many.
BINS_PER_SHINGLE, LEAST_BINS = 4, 1024
# Text of the items sent to the tasks at a time.
BLOCK_BYTES = 4 << 20


def shingles(text: bytes, words: int = SHINGLE_WORDS) -> tuple[bytes, list[int], list[int]]:
    """The normalised text and where its shingles start and end; a text with fewer words
    is one shingle, one without words has none."""
    split = text.lower().split()
    if not split:
        return b"", [], []
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(words, len(split)) - 1
    return b" ".join(split), starts[: len(split) - last].tolist(), ends[last:].tolist()


def hashes(joined: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64)


class ItemIndex:
    """Sketches of a block of items by size class, and their shingles for the check."""

    def __init__(self, items: list[tuple[object, bytes]], words: int, threshold: float):
        self.words, self.threshold = words, threshold
        self.names: list[object] = []
        self.texts: list[set[bytes]] = []
        self.classes: dict[int, tuple[int, dict[int, list[int]]]] = {}
        for name, text in items:
            joined, starts, ends = shingles(text, words)
            if not starts:
                continue
            own = {joined[a:b] for a, b in zip(starts, ends, strict=True)}
            size = 1 << (len(own) - 1).bit_length()
            bins, table = self.classes.setdefault(size, (max(LEAST_BINS, BINS_PER_SHINGLE * size), defaultdict(list)))
            for least in self.sketch(np.unique(hashes(joined, starts, ends)), bins):
                table[least].append(len(self.names))
            self.names.append(name)
            self.texts.append(own)
        self.keys = {s: np.array(sorted(t), np.uint64) for s, (_, t) in self.classes.items()}

    @staticmethod
    def sketch(values: np.ndarray, bins: int) -> list[int]:
        """The smallest hash of each bin that has any."""
        order = np.sort(values)
        _, first = np.unique(order % np.uint64(bins), return_index=True)
        return order[first].tolist()

    def candidates(self, values: np.ndarray) -> set[int]:
        """Items that share a minimum with a window of the document's shingle hashes."""
        found: set[int] = set()
        for size, (bins, table) in self.classes.items():
            # A minimum of a window is its bin's smallest hash. Hashes that are no item's
            # minimum need no window: look only at where an item's minimum occurs.
            keys = self.keys[size]
            place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
            for at in np.flatnonzero(keys[place] == values).tolist():
                value = values[at]
                # Windows of two blocks of `size` that hold this position.
                block = at // size
                for a in {max(0, block - 1) * size, block * size}:
                    window = values[a : a + 2 * size]
                    if not np.any((window % np.uint64(bins) == value % np.uint64(bins)) & (window < value)):
                        found.update(table[int(value)])
                        break
        return found

    def matches(self, text: bytes) -> list[tuple[int, float]]:
        """Items of which the document holds at least the threshold's share of shingles."""
        joined, starts, ends = shingles(text, self.words)
        if not starts:
            return []
        near = self.candidates(hashes(joined, starts, ends))
        if not near:
            return []
        wanted = set().union(*(self.texts[i] for i in near))
        held = {s for a, b in zip(starts, ends, strict=True) if (s := joined[a:b]) in wanted}
        shares = [(i, len(self.texts[i] & held) / len(self.texts[i])) for i in sorted(near)]
        return [(i, x) for i, x in shares if x >= self.threshold]


def item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """Items in blocks of bounded text, fetched one partition at a time."""
    rows = items.select(col(item_id).alias("item_id"), F.encode(text_or_empty(col(text)), "UTF-8").alias("text"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        block.append((row["item_id"], bytes(row["text"])))
        held += len(block[-1][1])
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, containment`` for every document that holds an item.

    Containment is the share of the item's distinct shingles (``words`` lower-cased words
    in a row) that occur anywhere in the whole document; pairs at ``threshold`` or more
    are returned. An item with fewer words is one shingle, which only a document of just
    these words holds. Null and empty texts hold nothing and are held by nothing. Rows
    that repeat an id or a text give their own pairs; other columns are ignored. Without
    documents or items the result is empty.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    id_type, item_type = (x.dataType.simpleString() for x in (rows.schema["doc_id"], items.schema[item_id]))
    schema = f"doc_id {id_type}, item_id {item_type}, containment double"
    out = None
    for block in item_blocks(items, item_id, item_text, block_bytes):
        found = rows.mapInArrow(_pairs(docs.sparkSession.sparkContext.broadcast(ItemIndex(block, words, threshold))), schema)
        out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _pairs(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        for batch in batches:
            hits = [(row, i, x) for row, t in enumerate(byte_texts(batch.column("text"))) for i, x in at.matches(t)]
            if hits:
                docs = batch.column("doc_id").take(pa.array([h[0] for h in hits]))
                names, shares = pa.array([at.names[h[1]] for h in hits]), pa.array([h[2] for h in hits], pa.float64())
                yield pa.record_batch([docs, names, shares], ["doc_id", "item_id", "containment"])

    return run


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold none of the items; the rule
    is that of ``contained_items``."""
    place = docs.columns.index(text)
    for block in item_blocks(items, item_id, item_text, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, words, threshold))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            at = index.value
            for batch in batches:
                yield batch.filter(pa.array([not at.matches(t) for t in byte_texts(batch.column(place))], pa.bool_()))
            give_back()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
