"""Token ids of whole texts by a file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Callable, Iterable
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

T = TypeVar("T")
# Different words that an encoder remembers, seen lately and as many from before; some 200
# bytes each.
HELD_WORDS = 250_000
# Marks that may end a word; one is a piece of its own after a letter.
TAIL = ".,;:!?"


def kept_in_worker(key: str, make: Callable[[], T]) -> T:
    """One object per Python worker, kept for the tasks that follow in it."""
    held = sys.modules.setdefault("_classmap_worker", types.ModuleType("_classmap_worker"))
    if key not in held.__dict__:
        held.__dict__[key] = make()
    return held.__dict__[key]


def encoder(path: str, held_words: int | None = None) -> Encoder:
    return kept_in_worker(f"encoder {path} {held_words}", lambda: Encoder(path, held_words))


class Encoder:
    """Ids as ``tokenizers`` gives them for the whole text, without special tokens added.

    A byte-level tokenizer without a normaliser splits a text before every white space
    that stands alone, so the ids of a text are those of its words put together. Each
    different word is encoded once and remembered. Texts with white space at an end or
    side by side, texts that hold an added token, and other kinds of tokenizers are
    encoded whole.
    """

    def __init__(self, path: str, held_words: int | None = None):
        self.held_words = held_words or HELD_WORDS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        kind = parts["pre_tokenizer"] or {}
        self.added = [t["content"] for t in parts["added_tokens"]]
        self.by_word = (
            parts["normalizer"] is None
            and parts["model"]["type"] == "BPE"
            and kind.get("type") == "ByteLevel"
            and kind.get("use_regex", False)
            and not kind.get("add_prefix_space", True)
            and not any(c.isspace() for content in self.added for c in content)
        )
        # Ids of words. One after a space stands for itself with the space; one at the start
        # of a line has the line end before it.
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        self.tails: dict[str, bytes] = {}
        if self.by_word:
            self.line_end = int(np.frombuffer(self._whole(["\n"])[0], "<u4")[0])
            spaced = [i for t, i in self.tokenizer.get_vocab().items() if t.startswith("Ġ")]
            self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.spaced[spaced] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encoded(self, words: list[str], head: str, starts: Callable[[np.ndarray], np.ndarray]) -> Iterable[bytes]:
        """Ids of words that begin with ``head``, all at once where their starts can be told."""
        (raw,) = self._whole(["".join(words)])
        at = (np.flatnonzero(starts(np.frombuffer(raw, "<u4"))) * 4).tolist()
        if len(at) == len(words):
            return [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=True)]
        return self._whole(words)

    def _learn(self, words: set[str]) -> None:
        known, older = self.known, self.older
        fresh, ended, rest = [], {}, []
        for w in words:
            if w in older:
                known[w] = older[w]
            elif w.isalpha():
                fresh.append(w)
            elif w[-1:] in TAIL and (core := w[:-1]).isalpha():
                # A word that ends in one of the marks is its letters' ids and the mark's.
                ended[w] = core
            else:
                rest.append(w)
        cores = set(ended.values()).difference(known, fresh)
        known.update({w: older[w] for w in cores if w in older})
        fresh += cores.difference(known)
        for w in rest:
            # Words with other white space at an end, or of nothing else, are no words.
            if not w or w[-1].isspace() or w[w[0] == "\n"].isspace():
                known[w] = None
            else:
                fresh.append(w)
        spaced = [w for w in fresh if w[0] != "\n"]
        if spaced:
            found = self._encoded([" " + w for w in spaced], " ", lambda ids: self.spaced[ids])
            known.update(zip(spaced, found, strict=True))
        lines = [w for w in fresh if w[0] == "\n"]
        if lines:
            known.update(zip(lines, self._encoded(lines, "\n", lambda ids: ids == self.line_end), strict=True))
        for mark in TAIL:
            if mark not in self.tails:
                (self.tails[mark],) = self._whole([mark])
        tails = self.tails
        known.update({w: known[core] + tails[w[-1]] for w, core in ended.items()})

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, their number per text, and which texts must be encoded whole."""
        lines = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        split = pc.split_pattern(lines, " ")
        coded = split.flatten().dictionary_encode()
        different = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        words, codes = pc.binary_join(different, " ")[0].as_py().split(" "), coded.indices.to_numpy()
        found = list(map(self.known.get, words))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        if gaps:
            self._learn({words[i] for i in gaps})
            for i in gaps:
                found[i] = self.known[words[i]]
        bad = np.zeros(len(found), bool)
        for i in gaps:
            if found[i] is None:
                bad[i], found[i] = True, b""
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        own = size[codes]
        first = split.offsets.to_numpy()[:-1].astype(np.int64)
        lengths, starts = np.add.reduceat(own, first), (np.cumsum(size) - size)[codes]
        whole = np.logical_or.reduceat(bad[codes], first)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        # The line end before a text's first word is not the text's.
        extra = (lengths > 0) & ~bad[codes[first]]
        own[first] -= extra
        starts[first] += extra
        lengths -= extra
        # Places of the ids in the words' list.
        total = int(own.sum())
        kind = np.int32 if max(total, int(size.sum())) < 1 << 31 else np.int64
        shift = (starts - (np.cumsum(own) - own)).astype(kind)
        places = np.repeat(shift, own)
        places += np.arange(total, dtype=kind)
        ids = np.frombuffer(b"".join(found), "<u4")[places]
        return ids, lengths, whole

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """32-bit ids of all texts, one after the other, and their number per text."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        if self.by_word:
            ids, lengths, whole = self._by_words(texts)
        else:
            ids, lengths, whole = np.zeros(0, "<u4"), np.zeros(len(texts), np.int64), np.ones(len(texts), bool)
        if whole.any():
            at = np.flatnonzero(whole)
            made = self._whole([texts[i].as_py() for i in at.tolist()])
            parts = np.split(ids, np.cumsum(lengths)[:-1])
            for i, raw in zip(at.tolist(), made, strict=True):
                parts[i] = np.frombuffer(raw, "<u4")
            ids, lengths = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        if len(self.known) > self.held_words:
            self.known, self.older = {}, self.known
        return ids, lengths

    def forget(self) -> None:
        """Drop the words, where a worker's memory is needed for other stages."""
        self.known, self.older = {}, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """32-bit ids of each text."""
        ids, lengths = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(lengths)[:-1]) if texts else []


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put an id behind each document."""
    return np.insert(ids, np.cumsum(lengths), np.array(end_id, ids.dtype)), lengths + 1
