"""Span hashes, extensions and fingerprints against plain string work."""

import hashlib
import random

from airtally.llm import fingerprints as fp


def text(pick, n, letters="ab é日"):
    return "".join(pick.choice(letters) for _ in range(n))


def test_equal_spans_have_equal_hashes():
    pick = random.Random(1)
    a, b = text(pick, 120), text(pick, 120)
    x, y = fp.PrefixHashes(a), fp.PrefixHashes(b)
    for _ in range(3000):
        i, j, n = pick.randrange(110), pick.randrange(110), pick.randrange(1, 9)
        assert (x.span(i, i + n) == y.span(j, j + n)) == (a[i : i + n] == b[j : j + n])


def test_longest_common_extension():
    pick = random.Random(2)
    a, b = text(pick, 200, "ab"), text(pick, 180, "ab")
    x, y = fp.PrefixHashes(a), fp.PrefixHashes(b)
    for _ in range(500):
        i, j = pick.randrange(201), pick.randrange(181)
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert fp.common_extension(x, i, y, j) == n


def expected(texts):
    """By id: characters, edited text."""
    ids = sorted(texts, key=lambda k: (k is not None, k or 0))
    out = {}
    for k, key in enumerate(ids):
        own, following = texts[key] or "", texts[ids[(k + 1) % len(ids)]] or ""
        cut = len(own) // 4
        out[key] = len(own), own[: len(own) - cut] + following[:cut]
    return out


def test_edited_texts(documents, edges):
    pick = random.Random(4)
    words = ["".join(pick.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(400)]
    texts = dict(enumerate([*edges, *(" ".join(pick.choices(words, k=pick.randrange(20, 200))) for _ in range(60))]))
    texts[None] = "a row without an id"
    rows = fp.edited_fingerprints(documents(list(texts.items()), ("fingerprint", "part")).repartition(4)).collect()
    assert len(rows) == len(texts)
    of_text = {}
    for r in rows:
        n, edited = expected(texts)[r["doc_id"]]
        own = texts[r["doc_id"]] or ""
        assert r["n_chars"] == n
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["edited_fingerprint"] == fp.fingerprint(fp.PrefixHashes(edited))
        assert of_text.setdefault(own, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        assert (r["near_edited"] == 1) == (own == edited)
        same = next((k for k, (x, y) in enumerate(zip(own, edited, strict=False)) if x != y), min(len(own), len(edited)))
        assert r["same_prefix"] == same
        if n > 200 and len(set(own)) > 5 and r["doc_id"] >= len(edges):
            assert r["near_edited"] > 0.4 > r["near_next"]
    assert len(set(of_text.values())) == len(of_text)


def test_one_row_and_none(documents):
    assert fp.edited_fingerprints(documents([])).collect() == []
    (row,) = fp.edited_fingerprints(documents(["abcdefgh"])).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert row["near_next"] == 1


def test_repeated_rows(documents):
    rows = fp.edited_fingerprints(documents([(1, "same text"), (1, "same text"), (2, "another")])).collect()
    assert len(rows) == 3 and len({r["fingerprint"] for r in rows}) == 2
