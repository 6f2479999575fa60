"""The rule ensemble: statistics, rules as columns against numpy, held-out accuracy, edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airtally.llm import quality


def made(many, seed):
    """Good texts, and bad ones of three kinds."""
    pick = random.Random(seed)
    words = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randrange(2, 9))) for _ in range(500)]
    out = []
    for k in range(many):
        text = " ".join(pick.choices(words, k=pick.randrange(20, 200))) + "."
        label = k % 4 != 0
        if not label:
            text = [text.upper(), text.replace(" ", "### "), " ".join([words[k % 9]] * 80)][k // 4 % 3]
        out.append((k, text, int(label)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.createDataFrame(made(800, 1), "doc_id long, text string, quality int")
    return quality.fit(rows.drop("quality"), rows.drop("text"))


def test_held_out_accuracy(spark, model):
    rows = made(300, 2)
    scored = quality.score(spark.createDataFrame(rows, "doc_id long, text string, quality int"), model).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in scored]) > 0.97
    assert 0 < len(model.rules) < 150


def test_column_equals_numpy(spark, model):
    rows = spark.createDataFrame(made(60, 3), "doc_id long, text string, quality int")
    counted = quality.score(rows, model).select("score", quality.statistics(F.col("text")).alias("s")).select("score", "s.*")
    frame = counted.toPandas()
    assert np.allclose(frame["score"], model.predict(frame[list(quality.NAMES)].to_numpy(dtype=float)), atol=1e-12)


def test_a_condition_on_the_score_computes_it_once(spark, model):
    rows = spark.createDataFrame(made(60, 3), "doc_id long, text string, quality int")
    plan = quality.score(rows, model).where("score >= 0.5").drop("score")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4, plan


def test_statistics_of_a_text(documents):
    row = documents(["AB c1, #\nAB c1, #"]).select(quality.statistics(F.col("text")).alias("s")).select("s.*")
    own = row.first().asDict()
    assert own["length"] == 17 and own["share_upper"] == 4 / 17 and own["share_digits"] == 2 / 17
    assert own["share_marks"] == 2 / 17 and own["share_symbols"] == 2 / 17 and own["share_spaces"] == 5 / 17
    assert own["new_words"] == 0.5 and own["new_lines"] == 0.5 and own["line_words"] == 3


def test_edge_rows(documents, edges, model):
    docs = documents([*edges, (None, "no id")], ("score", "s"))
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(edges) + 1 and set(scored[0].asDict()) == set(docs.columns)
    assert all(0 <= r["score"] <= 1 for r in scored)
    by_text = {}
    for r in scored:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]


def test_no_labels_one_label_and_empty(spark, documents):
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, None), (None, 0), (77, 0)], "doc_id long, quality int")
    docs = documents(["a b", "c d", "e f"])
    one = quality.fit(docs, labels)
    assert not one.rules and one.predict(np.zeros((1, 11)))[0] == pytest.approx(0.75)
    none = quality.fit(docs, labels.limit(0))
    assert [r["score"] for r in quality.score(docs, none).collect()] == [0.5] * 3
    assert quality.score(documents([]), one).collect() == []


def test_lasso_leaves_out_what_says_nothing():
    random_ = np.random.default_rng(0)
    x = random_.random((2000, 6))
    y = (random_.random(2000) < 1 / (1 + np.exp(-6 * (x[:, 2] - 0.5)))).astype(float)
    weights, _ = quality.lasso(x, y, share=0.2)
    assert weights[2] > 1 and np.abs(np.delete(weights, 2)).max() < 0.2
