import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from classmap.llm import packing, tokens
from tests.llm.tables import awkward, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


def token_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("block", [packing.BLOCK_TOKENS, 3000])
def test_every_id_lies_in_one_piece(spark, block):
    rows = [(i, t) for i, (_, t) in enumerate(awkward())]  # ids of their own, to tell rows apart
    found = packing.pack(frame(spark, rows).repartition(3), PATH, block_tokens=block, with_ids=True).collect()
    texts = dict(rows)
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        whole = token_ids(texts[doc])
        joined = []
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == len(joined) and r["doc_tokens"] == len(whole) and r["length"] == len(r["ids"]) > 0
            joined += r["ids"]
        assert joined == whole
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == own[0]["sequence_tokens"] <= 2048
        assert at & (at - 1) == 0  # full or a power of two: nothing to pad


def test_words_one_by_one_give_the_ids_of_the_text():
    rng, pieces = random.Random(3), ["a", "Word", "word", "don't", "won't.", "été", "1,5", "x1", "...", ".,", "a.,", "-", "é!", "<|endoftext|>", "\u00a0", "\t", "ª?", "二."]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", " ", "\n", " \n", "\n\n", "  "]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    plain, encoder = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        assert [e.tolist() for e in encoder.encode(part)] == [plain.encode(t, add_special_tokens=False).ids for t in part]


def test_forgotten_words_are_learnt_again(monkeypatch):
    monkeypatch.setattr(tokens, "HELD_WORDS", 5)
    plain, encoder = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    for text in ["one two three. four, five six", "one. two seven", "nine ten one", "two. one three", ""] * 3:
        assert encoder.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_lowest_cost_sequence_comes_first():
    pieces, used = packing.balanced([3, 8, 5, 6, 2], capacity=8)
    assert used == [8, 8, 8]
    assert [p[0] for p in pieces][:3] == [1, 3, 2]  # longest first, each to an empty sequence
    assert {p[3] for p in pieces[:3]} == {0, 1, 2}
    assert pieces[3][3] == pieces[2][3]  # the one of 5 is cheaper than that of 6
    assert packing.balanced([])[0] == []


def test_costs_are_balanced():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 300, 3000).tolist()
    pieces, used = packing.balanced(lengths)
    cost = np.zeros(len(used))
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 2048
    full = cost[np.array(used) == 2048]
    assert full.std() / full.mean() < 0.02


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("lean", [False, True])
def test_words_are_kept_between_tasks_unless_lean(spark, monkeypatch, lean):
    """The task's function, run twice here: the second time nothing is encoded anew."""
    rows = [(i, f"some words and number{i} of text") for i in range(50)]
    docs = frame(spark, rows, extra=False)
    batch = docs.select("doc_id", "text").toArrow().combine_chunks().to_batches()[0]
    learnt = []
    plain = tokens.Encoder._learn
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, words: (learnt.append(len(words)), plain(self, words))[1])
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": classmethod(lambda c: c), "partitionId": classmethod(lambda c: 3)}))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = packing.pack(docs, PATH, lean=lean)
    first, second = ([b.to_pylist() for b in run(iter([batch]))] for _ in range(2))
    assert first == second and sum(map(len, first)) >= len(rows)
    assert len(learnt) == (2 if lean else 1)
    held = tokens.encoder(PATH, packing.LEAN_WORDS if lean else packing.HELD_WORDS)
    assert bool(held.known or held.older) != lean


def test_lean_packing_gives_the_same_rows(spark):
    docs = frame(spark, awkward(), extra=False).coalesce(1)
    both = [sorted(map(repr, packing.pack(docs, PATH, lean=lean).collect())) for lean in (False, True)]
    assert both[0] == both[1]
