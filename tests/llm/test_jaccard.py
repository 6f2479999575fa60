"""The n-gram join against all pairs, its keys against the guarantee they give, and components."""

import random

import numpy as np
import pytest

from airtally.llm import jaccard
from airtally.llm.components import components


def shingles(text, width):
    words = [w.lower() for w in (text or "").encode().split()]
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute_force(texts, width, percent):
    """By id: set size and the smallest id reached by links."""
    sets = {k: shingles(t, width) for k, t in texts.items()}
    least = {k: k for k in sets}

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_a_worker_remembers_few_words_and_no_long_ones():
    words = jaccard.Words()
    for k in range(jaccard.WORDS + 10):
        words[b"%d" % k]
    assert words[b"a" * 10_000] == jaccard.Words()[b"a" * 10_000]
    assert len(words) <= jaccard.WORDS and max(map(len, words)) <= jaccard.WORD_BYTES


def near_copies(pick, many=150):
    words = ["".join(pick.choice("abcdefg") for _ in range(4)) for _ in range(300)]
    hot = " ".join(pick.choices(words, k=25))
    texts = []
    for _ in range(many):
        if texts and pick.random() < 0.6:
            line = pick.choice(texts).split(" ")
            for _ in range(pick.randrange(4)):
                line[pick.randrange(len(line))] = pick.choice(words)
            texts.append(" ".join(line))
        else:
            texts.append(" ".join(pick.choices(words, k=pick.randrange(2, 120))) + (f" {hot}" if pick.random() < 0.5 else ""))
    return dict(enumerate(texts))


@pytest.mark.parametrize(("seed", "width", "percent", "least"), [(1, 3, 90, 16), (2, 5, 80, 16), (3, 2, 80, 2), (4, 3, 90, 2)])
def test_equals_all_pairs(documents, monkeypatch, seed, width, percent, least):
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", least)
    texts = near_copies(random.Random(seed))
    docs = documents(list(texts.items()), ("sid", "n", "key")).repartition(3)
    rows = jaccard.link_documents(docs, width, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_force(texts, width, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_sets_at_the_threshold_share_a_key(percent):
    random_ = np.random.default_rng(percent)
    universe = np.unique(random_.integers(0, 1 << 63, 6000).astype(np.uint64))
    frequent = np.sort(random_.choice(universe, len(universe) * 3 // 4, replace=False))
    for _ in range(1500):
        n = int(random_.integers(2, 160))
        x = random_.choice(universe if random_.random() < 0.5 else frequent, n, replace=False)
        y = x[random_.random(n) > random_.choice([0.02, 0.1, 0.2])]
        y = np.union1d(y, random_.choice(universe, int(random_.integers(0, 1 + n // 8))))
        x = np.sort(x)
        shared = len(np.intersect1d(x, y))
        if len(y) < 2 or len(x) == len(y) == shared or 100 * shared < percent * (len(x) + len(y) - shared):
            continue
        assert len(np.intersect1d(jaccard.keys(x, frequent, percent), jaccard.keys(y, frequent, percent)))


@pytest.mark.parametrize(("percent", "most"), [(80, 6), (90, 1)])
def test_few_shared_tokens_hardly_give_keys(percent, most):
    """Long sets that share a twelfth of their tokens share less than so many keys a pair; by single tokens it was a share of 300."""
    random_ = np.random.default_rng(percent)
    none = np.zeros(0, dtype=np.uint64)
    passage = random_.integers(0, 1 << 64, 300, dtype=np.uint64)
    sets = [np.unique(np.r_[passage, random_.integers(0, 1 << 64, int(random_.integers(3000, 4000)), dtype=np.uint64)]) for _ in range(40)]
    _, n = np.unique(np.concatenate([jaccard.keys(h, none, percent) for h in sets]), return_counts=True)
    assert (n * (n - 1) // 2).sum() < most * 40 * 39 // 2


def test_sets_in_few_groups_share_a_key():
    """Tokens of one range of hashes are one group; such sets meet by single tokens."""
    random_ = np.random.default_rng(6)
    for _ in range(200):
        x = np.unique(random_.integers(0, 1 << 40, int(random_.integers(20, 400)), dtype=np.uint64))
        y = np.delete(x, random_.choice(len(x), len(x) // 20, replace=False))
        none = np.zeros(0, dtype=np.uint64)
        assert len(np.intersect1d(jaccard.keys(x, none, 90), jaccard.keys(y, none, 90)))


def test_parities_never_overstate_a_difference():
    random_ = np.random.default_rng(4)
    found = all_ = 0
    for _ in range(400):
        x = np.unique(random_.integers(0, 1 << 63, int(random_.integers(1, 900))).astype(np.uint64))
        y = np.union1d(x[random_.random(len(x)) > 0.1], random_.integers(0, 1 << 63, int(random_.integers(0, 90))).astype(np.uint64))
        least = jaccard.least_difference(jaccard.parity(x), jaccard.parity(y))
        assert least <= len(np.setxor1d(x, y))
        found, all_ = found + least, all_ + len(np.setxor1d(x, y))
    assert found > 0.8 * all_


def test_edge_rows(documents, edges):
    rows = jaccard.link_documents(documents([*edges, "WORD", (None, "word")], ("component_id",)), 3, 90).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got.pop(None) == (1, None)
    assert got == brute_force(dict(enumerate([*edges, "WORD"])), 3, 90)


def test_rows_of_one_id_are_one_document(documents):
    docs = documents([(4, "a b c d e"), (4, "v w x y z"), (2, "v w x y z"), (9, "a b c d e"), (7, "none of these")])
    rows = jaccard.link_documents(docs, 3, 90).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(2, 2), (4, 2), (4, 2), (7, 7), (9, 2)]


def test_one_of_each_stays(documents):
    docs = documents([(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (5, ""), (6, None), (None, "a b c d e"), (8, "other words")], ("_kept",))
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 5, 6, 8]


def test_texts_under_one_id_are_kept_apart(documents):
    """Unlinked texts of one id all stay; one that links to a text of a smaller id goes; of repeated rows one stays."""
    long = " ".join(f"w{k}" for k in range(60))
    docs = documents([(1, long), (1, "quite other words than those above"), (1, long), (2, long + " end"), (2, "a third text of some words"), (3, None), (3, "")], ("own",))
    kept = sorted((r["doc_id"], r["text"] or "") for r in jaccard.keep_one_of_each(docs).collect())
    assert kept == [(1, "quite other words than those above"), (1, long), (2, "a third text of some words"), (3, "")]


def test_empty_table(documents):
    assert jaccard.link_documents(documents([])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    pick = random.Random(seed)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)]
    edges += [(pick.randrange(200, 300), pick.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    least = {}

    def root(k):
        while least.setdefault(k, k) != k:
            k = least[k]
        return k

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            least[y] = x
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in rows} == {k: root(k) for k in least}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
