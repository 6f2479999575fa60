"""Packed pieces against the library's ids: each id once, sequences without gaps, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from airtally.llm import packing


@pytest.fixture(scope="module")
def library(word_bpe):
    return Tokenizer.from_file(word_bpe)


def check(rows, texts, library, length):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for key, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(pieces[key], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    return [sum(r["length"] for r in rows) for rows in sequences.values()]


def test_words_have_the_library_s_ids(library, word_bpe):
    pick = random.Random(2)
    alphabet = " \n\t\r\x0b\x1c\x85\xa0　'sStremvdll.,!?#aAbéÉß日Σσς123٣½🎉é̈<|endoftext|>"
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 60))) for _ in range(800)]
    texts += ["<|startoftext|> a <|endoftext|>b", "ΟΔΥΣΣΕΥΣ ΟΔΟΣ", "we'll don't 's", ""]
    for text, ids in zip(texts, packing.word_tokenizer(word_bpe).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_worker_remembers_few_words_and_no_long_ones(library, word_bpe, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    tokenizer = packing.WordTokenizer(word_bpe)
    for k in range(20):
        texts = [f"often there {k}once{n} " + f"x{k}y{n}" * 400 for n in range(10)]
        for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(tokenizer.known) <= 100 + 22 and max(map(len, tokenizer.known)) <= packing.REMEMBERED_LENGTH
        assert {"often", "there"} <= set(tokenizer.known)
    assert "0once0" not in tokenizer.known


def test_the_library_gets_letters_and_signs_once(library, word_bpe):
    """Words are looked up in lower case and without the signs after them, where that gives the library's ids; the rest whole."""

    class Spy:
        def __init__(self):
            self.words = []

        def encode_batch_fast(self, texts, **options):
            self.words += [w for t in texts for w in t.split() if w != "\x01"]
            return library.encode_batch_fast(texts, **options)

    tokenizer = packing.WordTokenizer(word_bpe)
    tokenizer.tokenizer = spy = Spy()
    texts = ["And, and AND! And!! È, è È! it's IT'S and... über, ÜBER!,", "AND, \nÈ,  and! Über and, é"]
    texts += ["<|endoftext|>, <|ENDOFTEXT|>, and<|endoftext|>, İ, I\u0307, H\u0331, e\u0301, \u0301 and\x01, \x01 ' 's, we'll, a'\t's x\x00, 日本, ﬁ, Σς, ß! 1, a1, ,a"]
    for part in (texts[:1], texts[1:], texts):
        for text, ids in zip(part, tokenizer.encode(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert len(spy.words) == len(set(spy.words))
    assert {"and", "è", "über", "it's", "IT'S"} <= set(spy.words) and not {"And,", "AND", "and!", "È,", "ÜBER!,"} & set(spy.words)


def test_words_of_any_kind_in_one_slice(library, word_bpe):
    pick = random.Random(4)
    letters, rest = "abIKHSéÉßÿ×ªıſ", ".,!*'<|>\x010\u0301\u0331\u0307日\t"
    words = ["".join(pick.choice(letters if pick.random() < 0.7 else rest) for _ in range(pick.randint(1, 6))) for _ in range(4000)]
    tokenizer = packing.WordTokenizer(word_bpe)
    texts = [" ".join(words[k : k + 9]) for k in range(0, 4000, 9)]
    for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_edge_rows(documents, edges, library, word_bpe):
    rows = packing.pack(documents(edges, ("start", "part", "ids")).repartition(3), word_bpe, 2).collect()
    sizes = check(rows, dict(enumerate(edges)), library, 4096)
    assert sum(size < 4096 - 31 for size in sizes) <= 1  # what is left is merged over the tasks


def test_many_tasks_leave_one_remainder(documents, library, word_bpe, monkeypatch):
    monkeypatch.setattr(packing, "MERGED", 4)
    pick = random.Random(3)
    texts = {k: " ".join("abcdefgh"[pick.randrange(8)] for _ in range(pick.randrange(300))) for k in range(400)}
    docs = documents(list(texts.items())).repartition(23)
    rows = packing.pack(docs, word_bpe, 2, length=128, windows=4, least=8).collect()
    sizes = check(rows, texts, library, 128)
    assert sum(size < 128 - 7 for size in sizes) <= 1
    assert len({r["sequence_id"] for r in rows}) == len(sizes)


def test_repeated_and_null_ids(documents, word_bpe):
    rows = packing.pack(documents([(None, "a b"), (1, "a b"), (1, "a b")]), word_bpe, 2).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 3), (1, 3), (1, 3)]


def test_empty_table(documents, word_bpe):
    assert packing.pack(documents([]), word_bpe, 2).collect() == []


def test_best_fit_and_fullest():
    packer = packing.Packer(10, 2, 3)

    def piece(n):
        return packing.Piece(n, 0, bytes(4 * n), n)

    assert list(packer.place(piece(6))) == [] and list(packer.place(piece(7))) == []
    assert list(packer.place(piece(2))) == [] and packer.room == [4, 1]  # into the fuller one
    done = list(packer.place(piece(5)))  # the fullest has one id of room: padding
    assert [sum(map(len, s)) for s in done] == [9] and packer.room == [4, 5]
    done = list(packer.place(piece(9)))  # the fullest takes four, the rest goes on
    assert [sum(map(len, s)) for s in done] == [10, 10] and packer.room == []
