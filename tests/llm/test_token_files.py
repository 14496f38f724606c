import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from classmap.llm import token_files
from classmap.llm.queries import QUERIES
from classmap.plans import settle
from tests.llm.tables import SF_DIR, awkward, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    """Start, number and checksum of each document's ids, in order of ids."""
    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), min_size=1, max_size=90), min_size=1, max_size=6))
def test_round_trip(documents):
    lengths = np.array([len(d) for d in documents])
    words, own = token_files.pack_ids(np.array([i for d in documents for i in d], np.uint64), lengths)
    assert own.sum() == len(words)
    ends = np.concatenate(([0], np.cumsum(own)))
    for d, a, b in zip(documents, ends[:-1], ends[1:], strict=True):
        assert token_files.unpack_ids(words[a:b]).tolist() == d
    assert token_files.unpack_ids(words).tolist() == [i for d in documents for i in d]


def test_frequent_ids_have_small_places(monkeypatch):
    ids = np.array([9, 5, 9, 50_000, 9, 5], np.uint32)
    for limit in (token_files.COUNTED, 0):
        monkeypatch.setattr(token_files, "COUNTED", limit)
        different, places = token_files.ranked(ids)
        assert different.tolist() == [9, 5, 50_000] and places.tolist() == [0, 1, 0, 2, 0, 1]


def test_words_are_as_full_as_they_can_be():
    words, _ = token_files.pack_ids(np.zeros(60, np.uint64), np.array([60]))
    assert len(words) == 1 and int(words[0]) >> 60 == 1
    words, _ = token_files.pack_ids(np.array([50_000] * 7, np.uint64), np.array([7]))
    assert [int(w) >> 60 for w in words] == [12, 12, 14]  # three of 20 bits, three more, one
    words, _ = token_files.pack_ids(np.array([1 << 60, 1 << 63, 5], np.uint64), np.array([3]))
    assert words.tolist() == [2, 1 << 60, 1 << 63, 14 << 60 | 5]


@pytest.mark.parametrize("file_bytes", [token_files.FILE_BYTES, 5_000])
def test_files_against_brute_force(spark, monkeypatch, file_bytes):
    monkeypatch.setattr(token_files, "ENCODE_BYTES", 2_000)
    rows = [r for r in awkward() if r[0] != 6 and r[0] is not None] + [(None, "no id"), (7_000, "a <|endoftext|> b"), (7_001, "<|endoftext|>")]
    rows = [*dict(rows).items(), (5, dict(rows)[5])]
    found = token_files.token_documents(frame(spark, rows).repartition(3), PATH, file_bytes=file_bytes, with_ids=True).collect()
    assert sorted((r[:4] for r in found), key=lambda r: r[1]) == brute(rows)
    for r in found:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["n_tokens"]


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "one"), (1, "another text"), (1, "one"), (None, None), (None, "")]
    found = token_files.token_documents(frame(spark, rows), PATH).collect()
    assert sorted((r[0] or 0, r[2], r[3]) for r in found) == sorted((r[0] or 0, r[2], r[3]) for r in brute(rows))
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_only_indexed_files_count(spark, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    index = settle.settle(token_files.write_token_files(frame(spark, [(1, "one"), (2, "two")]), folder, PATH))
    token_files.write_token_files(frame(spark, [(3, "three")]), folder, PATH)  # as a lost attempt would
    assert sorted(r[0] for r in token_files.read_token_files(index, "bigint").collect()) == [1, 2]


def test_empty_table(spark):
    assert token_files.token_documents(frame(spark, []), PATH).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_simple8b_token_files"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[1]) == brute(rows)


def test_words_of_many_documents_start_as_followed_one_by_one():
    rng = np.random.default_rng(3)
    lengths = np.concatenate(([0, 5000, 1], rng.integers(0, 40, 300), [0]))
    ends = np.cumsum(lengths)
    step = rng.integers(1, 9, int(ends[-1])).astype(np.uint8)
    for a, e in zip((ends - lengths).tolist(), ends.tolist(), strict=True):  # no word spans two documents
        step[a:e] = np.minimum(step[a:e], e - np.arange(a, e))
    want, at = [], 0
    while at < len(step):
        want.append(at)
        at += int(step[at])
    assert token_files.word_starts(step, ends - lengths, ends).tolist() == want
