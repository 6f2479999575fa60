"""Segment-tree BPE and prefix token counts against the tokenizers library."""

import hashlib
import random
import time

import pytest
from tokenizers import Tokenizer

from airtally.llm import bpe, tokencounts

ALPHABET = " \n\t\r\x0b\x1c\x1f\x85\xa0 　'stremvdll.,!?#aAbéÉß日本語123٣½🎉é<|endoftext|>"


def odd_texts(many):
    pick = random.Random(5)
    made = ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 50))) for _ in range(many)]
    return [*made, "it's we'll they've I'm he'd 'l 'r", "<|endoftext|>", "a<|endoftext|> b", "  a  b   \n\n c  ", "", "a" * 700, "ab" * 500, "!" * 300, " " * 90]


@pytest.fixture(scope="module")
def library(byte_bpe):
    return Tokenizer.from_file(byte_bpe)


def test_ids_and_round_trip(library, byte_bpe):
    own = bpe.coder(byte_bpe)
    for text in odd_texts(600):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_count_at_every_prefix(library, byte_bpe):
    own = tokencounts.counter(byte_bpe)
    for text in odd_texts(150):
        table = own.table(text)
        for n in range(len(text) + 1):
            assert table[n] == len(library.encode(text[:n], add_special_tokens=False).ids), (text, n)
        assert own.total(text) == table[-1]


def test_longest_prefix_within_a_budget(library, byte_bpe):
    own = tokencounts.counter(byte_bpe)
    for text in odd_texts(40):
        sizes = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        for budget in (0, 1, 5, 17):
            assert own.within(text, budget) == max(n for n, size in enumerate(sizes) if size <= budget)


def test_digests_of_edge_rows(documents, edges, library, byte_bpe):
    got = {r["doc_id"]: r for r in bpe.digests(documents(edges, ("ids", "n_tokens")), byte_bpe).collect()}
    assert len(got) == len(edges)
    for key, text in enumerate(edges):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[key]["n_tokens"] == len(ids)
        assert got[key]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_encode_documents(documents, byte_bpe, library):
    rows = bpe.encode_documents(documents([(None, "one two"), (3, None), (3, "one two")]), byte_bpe).collect()
    assert sorted((r["doc_id"] is None, len(r["ids"]), r["decoded"]) for r in rows) == [(False, 0, ""), (False, 2, "one two"), (True, 2, "one two")]


def test_counts_and_cuts_of_edge_rows(documents, edges, library, byte_bpe):
    docs = documents(edges, ("budget", "n_bytes"))
    counts = {r["doc_id"]: r for r in tokencounts.count_tokens(docs, byte_bpe).collect()}
    cuts = {(r["doc_id"], r["budget"]): r for r in tokencounts.budget_cuts(docs, byte_bpe, [3, 1000]).collect()}
    for key, text in enumerate(edges):
        text = text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (counts[key]["n_bytes"], counts[key]["n_tokens"]) == (len(text.encode()), n)
        for budget in (3, 1000):
            cut = cuts[key, budget]
            assert cut["n_tokens"] == len(library.encode(text[: cut["n_chars"]], add_special_tokens=False).ids) <= budget
            if n <= budget:
                assert cut["n_chars"] == len(text)


def test_empty_table(documents, byte_bpe):
    assert bpe.digests(documents([]), byte_bpe).collect() == []
    assert tokencounts.count_tokens(documents([]), byte_bpe).collect() == []


@pytest.mark.parametrize("text", ["x" * 100_000, " " * 50_000 + "a", "-=" * 30_000, "ab" * 7 + "c" * 33, "0123456789" * 3000])
def test_long_pieces(byte_bpe, text):
    """One piece of very many characters: the library's ids, in seconds."""
    began = time.perf_counter()
    assert bpe.SegmentTreeBPE(byte_bpe).encode(text) == Tokenizer.from_file(byte_bpe).encode(text, add_special_tokens=False).ids
    assert time.perf_counter() - began < 20


def test_one_by_one_and_together_are_the_same(byte_bpe, monkeypatch):
    pieces = [" tokenization", "aaaa", "ééé", "x", "hello", "日本語日本語", "mississippi" * 9] * 1
    coder = bpe.SegmentTreeBPE(byte_bpe)
    alone = coder.encode_pieces(pieces)
    monkeypatch.setattr(bpe, "FEW", 0)
    assert coder.encode_pieces(pieces) == alone


def test_what_is_remembered_rotates(byte_bpe, monkeypatch):
    """With room for a few pieces only, halves are dropped all the time and ids stay the library's."""
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    coder, library = bpe.SegmentTreeBPE(byte_bpe), Tokenizer.from_file(byte_bpe)
    for text in odd_texts(60) * 2:
        assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert len(coder.known) < 2000
