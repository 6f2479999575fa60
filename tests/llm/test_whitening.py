"""Whitening against exact and plain arithmetic, weights, and rows that take no part."""

import math
from collections import Counter

import numpy as np
import pytest

from airtally.llm import whitening
from airtally.llm.queries import QUERIES


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, component int")


def brute_force(rows, components=8, weighted=True):
    """From pairs of id and vector: dict of (id, component) to (n, deviation, whitened or None, explained), in plain whole numbers."""
    x = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows]
    fit = [v for _, v in x] if weighted else [list(v) for v in {tuple(v) for _, v in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for i, v in x:
        apart = [n * c - s for c, s in zip(v, sums, strict=True)]
        for k in range(len(values)):
            white = float(np.array([a / n for a in apart]) @ axes[:, k] / math.sqrt(values[k]))
            out[i, k + 1] = (n, sum(a * a for a in apart), white, float(values[k] / np.trace(cov)))
    return out


def compare(found, wanted):
    got = {(r["vec_id"], r["component"]): r for r in found}
    assert set(got) == set(wanted)
    signs = {}
    for (i, k), (n, deviation, white, explained) in wanted.items():
        row = got[i, k]
        assert (row["n"], row["deviation"]) == (n, deviation)
        assert row["explained"] == pytest.approx(explained, rel=1e-9)
        if abs(white) > 0.1:
            signs.setdefault(k, np.sign(white) * np.sign(row["whitened"]))
        assert row["whitened"] == pytest.approx(white * signs.get(k, np.sign(white * row["whitened"]) or 1), abs=1e-8)
        assert 0 <= row["identity_error"] < 1e-9


@pytest.mark.parametrize("offset", [0.0, 3000.0])
@pytest.mark.parametrize("weighted", [True, False])
def test_copies_weigh_as_often_as_they_stand(spark, weighted, offset):
    chance = np.random.default_rng(2)
    own = (chance.normal(size=(60, 12)) * np.linspace(0.5, 3, 12) + offset).astype(np.float32)
    rows = [(i, own[j].tolist()) for i, j in enumerate([*range(60), *[3] * 40, *[5] * 7])]
    found = whitening.whiten(frame(spark, rows), weighted=weighted).collect()
    compare(found, brute_force(rows, weighted=weighted))


def test_fewer_dimensions_than_components(spark):
    chance = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(chance.normal(size=(50, 3)).astype(np.float32))]
    compare(whitening.whiten(frame(spark, rows)).collect(), brute_force(rows))


def test_unusable_rows_take_no_part(spark):
    chance = np.random.default_rng(5)
    good = [(i, v.tolist()) for i, v in enumerate(chance.normal(size=(20, 4)).astype(np.float32))]
    bad = [
        (90, None), (91, []), (92, [1.0, None, 1.0, 1.0]), (93, [float("nan"), 1.0, 1.0, 1.0]), (94, [1.0, float("inf"), 1.0, 1.0]),
        (95, [1.0, 2.0]), (96, [1e30, 1.0, 1.0, 1.0]), (97, [-float("inf")] * 4),
    ]
    compare(whitening.whiten(frame(spark, good + bad)).collect(), brute_force(good))
    # Repeated rows and ids come back as often as they stand.
    again = whitening.whiten(frame(spark, good + [good[3], good[3], (None, good[4][1])])).collect()
    assert Counter(r["vec_id"] for r in again if r["component"] == 1) == Counter([*range(20), 3, 3, None])


def test_no_spread_gives_no_rows(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        found = whitening.whiten(frame(spark, rows))
        assert found.count() == 0 and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = [(i, [float(i), 2.0, float(-i)]) for i in range(9)]  # one direction only
    assert {r["component"] for r in whitening.whiten(frame(spark, flat)).collect()} == {1}


def test_deviations_beyond_64_bits():
    x = np.array([[2**50, 1], [-(2**50), 5], [3, 3]], dtype=np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    assert whitening._deviations(x, 3, sums) == [None, None, 36 + 0]
    small = np.array([[100001, 99999], [100003, 100001]], dtype=np.int64)
    assert whitening._deviations(small, 2, [200004, 200000]) == [8, 8]


def test_query_against_plain_arithmetic(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r["vec_id"], list(r["embedding"])) for r in table if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    compare(QUERIES["op13_whitened"](spark, folder).collect(), brute_force(rows))
