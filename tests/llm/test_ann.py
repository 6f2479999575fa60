"""Graph search against brute force, and rows that take no part."""

import numpy as np
import pytest

from airtally.llm import ann


def brute_force(ids, x, queries, k):
    out = {}
    for q in queries:
        mine = x[ids.index(q)]
        ranked = sorted((float(np.sqrt(((v - mine) ** 2).sum())), i) for i, v in zip(ids, x, strict=True) if i != q)
        out[q] = ranked[:k]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")


def test_recall_over_shards(spark):
    random = np.random.default_rng(1)
    centers = random.normal(size=(8, 24))
    x = (centers[random.integers(0, 8, 3000)] + random.normal(size=(3000, 24)) * 0.6).astype(np.float32).astype(float)
    ids = list(range(3000))
    vectors = frame(spark, ids, x)
    found = ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), shard_rows=800).collect()
    exact = brute_force(ids, x, range(0, 3000, 50), 10)
    got = {}
    for r in found:
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    assert set(got) == set(exact)
    hits = 0
    for q, rows in got.items():
        assert sorted(rows) == list(range(1, 11))
        ranked = [rows[k] for k in range(1, 11)]
        assert ranked == sorted(ranked)
        for score, v in ranked:
            assert v != q and score == pytest.approx(float(np.sqrt(((x[v] - x[q]) ** 2).sum())), abs=1e-12)
        hits += len({v for _, v in ranked} & {v for _, v in exact[q]})
    assert hits / (10 * len(exact)) > 0.95


def test_copies_and_ties(spark):
    x = np.array([[1.0, 0.0]] * 30 + [[0.0, 1.0]] * 5)
    vectors = frame(spark, list(range(35)), x)
    rows = ann.nearest(vectors, vectors.where("vec_id in (3, 32)"), shard_rows=8).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}
    assert [got[3, k] for k in range(1, 11)] == [(v, 0.0) for v in (0, 1, 2, 4, 5, 6, 7, 8, 9, 10)]
    assert [got[32, k][0] for k in range(1, 11)] == [30, 31, 33, 34, 0, 1, 2, 3, 4, 5]


def test_few_and_unusable_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 2.0]), (8, [1.0, 2.0, 3.0]), (9, [])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, shard int")
    found = ann.nearest(vectors, vectors).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == [(0, 1, 1, 1.0), (1, 1, 0, 1.0)]


def test_repeated_ids_and_empty_tables(spark):
    vectors = frame(spark, [1, 1, 2], [[1.0, 0.0], [2.0, 0.0], [3.0, 0.0]])
    found = ann.nearest(vectors, vectors.where("vec_id = 2")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(2, 1, 1, 1.0)]
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).collect() == []


def each_id_once(ids, x, q, k):
    """The k nearest ids of the query's only vector, each where it is nearest."""
    mine, near = x[ids.index(q)], {}
    for i, v in zip(ids, x, strict=True):
        if i != q:
            near[i] = min(near.get(i, np.inf), float(np.sqrt(((v - mine) ** 2).sum())))
    return sorted((score, i) for i, score in near.items())[:k]


def found_of(spark, ids, x, queries, **how):
    vectors = frame(spark, ids, x)
    rows = sorted(ann.nearest(vectors, vectors.where(f"vec_id in ({','.join(map(str, queries))})"), **how).collect(), key=lambda r: r["rank"])
    return {q: [(r["score"], r["vec_id"]) for r in rows if r["query_id"] == q] for q in queries}


def test_doubled_rows(spark):
    x = np.repeat(np.random.default_rng(5).normal(size=(60, 6)).astype(np.float32).astype(float), 2, axis=0)
    ids = [k // 2 for k in range(120)]
    got = found_of(spark, ids, x, (0, 7))
    for q in (0, 7):
        assert [i for _, i in got[q]] == [i for _, i in each_id_once(ids, x, q, 10)]


@pytest.mark.parametrize("shard_rows", [4096, 100])
def test_an_id_of_many_rows_takes_one_place(spark, shard_rows):
    random = np.random.default_rng(6)
    near = 5 + random.normal(size=(300, 6)) * 0.01  # all of id 1000, nearer to id 0 than any other
    x = np.concatenate([np.full((1, 6), 5.0), near, near, np.full((100, 6), 5.1), 7 + random.normal(size=(40, 6))])
    x = x.astype(np.float32).astype(float)
    ids = [0, *[1000] * 600, *[1001] * 100, *range(1, 41)]
    got = found_of(spark, ids, x, (0,), shard_rows=shard_rows)
    assert [i for _, i in got[0]] == [i for _, i in each_id_once(ids, x, 0, 10)]


def test_an_id_of_many_vectors_is_in_many_shards(spark):
    rows = ann.usable(frame(spark, [1] * 64, np.arange(1.0, 65)[:, None]), "vec_id", "embedding")
    assert ann.build_index(rows, 4).count() == 4


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e6])
@pytest.mark.parametrize("scale", [1e-20, 1.0, 1e20])
def test_recall_does_not_depend_on_offset_or_scale(offset, scale):
    """One shard's graph in double vectors; the offset is in units of the spread."""
    random = np.random.default_rng(7)
    centers = random.normal(size=(12, 32))
    x = (centers[random.integers(0, 12, 1500)] + random.normal(size=(1500, 32)) * 0.5 + offset) * scale
    graph = ann.Graph(x).build()
    queries = x[::25] + random.normal(size=(60, 32)) * 0.01 * scale
    found, _ = graph.search(graph.own(queries), 64)
    hits = 0
    for query, nodes in zip(queries, found, strict=True):
        exact = np.argsort(((x - query) ** 2).sum(axis=1), kind="stable")[:10]
        nodes = nodes[nodes >= 0]
        ranked = nodes[np.argsort(((x[nodes] - query) ** 2).sum(axis=1), kind="stable")[:10]]
        hits += len(set(ranked.tolist()) & set(exact.tolist()))
    assert hits >= 0.95 * 600


def test_far_and_huge_vectors(spark):
    """Some vectors of 1e30 among small ones; extra columns of clashing names."""
    random = np.random.default_rng(8)
    x = random.normal(size=(300, 8))
    x[::50] *= 1e30
    x = x.astype(np.float32).astype(float)
    vectors = frame(spark, list(range(300)), x).selectExpr("*", "1 query_id", "'s' shard", "2.5 score", "embedding v")
    found = ann.nearest(vectors, vectors.where("vec_id % 25 = 0")).collect()
    exact = brute_force(list(range(300)), x, range(0, 300, 25), 10)
    got = {q: {r["vec_id"] for r in found if r["query_id"] == q} for q in exact}
    assert all(len(got[q]) == 10 for q in exact)
    assert sum(len(got[q] & {v for _, v in exact[q]}) for q in exact) >= 0.95 * 10 * len(exact)
