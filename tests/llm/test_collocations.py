"""Phrases against plain counting, tries that burst and spill, edge rows, and the query's SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from airtally.llm import collocations
from airtally.llm.queries import ORACLES, QUERIES


def counted(rows):
    """Counts of phrases and words by language, from pairs of a language and a text."""
    f, n = {}, Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    return f, n


def brute_force(rows, least=10, top=2000, inside=50):
    f, n = counted(rows)
    out = []
    for lang, counts in f.items():
        found = []
        triples = [(p, c) for p, c in counts.items() if len(p) == 3 and c >= least]
        longest = Counter()
        for p, c in triples:
            for part in (p[:2], p[1:]):
                longest[part] = max(longest[part], c)
        for p, a in counts.items():
            if len(p) < 2 or a < least or (len(p) == 2 and longest[p] and 100 * longest[p] >= inside * a):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def texts(n, seed):
    chance = random.Random(seed)
    vocabulary = [chance.choice("abcdeäß日") * chance.randint(1, 3) + str(chance.randint(0, 9)) for _ in range(60)] + ["The", "OF", "ÄÖ"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(chance.randint(0, 80)):
            words += ["New", "York", "City"] if chance.random() < 0.05 else [chance.choice(vocabulary[: chance.choice((3, 20, 63))])]
        text = "".join(w + chance.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!"]) for w in words)
        out.append((chance.choice(["en", "en", "de", None, "und"]), text))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, words int")


@pytest.mark.parametrize("limits", [{}, {"entries": 500, "burst": 8}, {"words": 20, "burst": 2, "entries": 50}])
def test_phrases_equal_plain_counting(spark, rows, limits, monkeypatch):
    monkeypatch.setattr(collocations, "STRETCH", 50)
    data = texts(400, 3)
    found = collocations.phrases(frame(spark, data), least=5, top=40, **limits)
    assert rows(found, *COLUMNS) == sorted(brute_force(data, least=5, top=40), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("size", [2, 3])
@pytest.mark.parametrize("limits", [(10**9, 10**6, 10**9), (200, 10**6, 4), (10**9, 30, 4)])
def test_runs_of_a_task_add_up(limits, size, monkeypatch):
    """Whatever is spilled and burst, all runs together hold every phrase's count once, and each run is in the order of ids."""
    monkeypatch.setattr(collocations, "STRETCH", 7)
    data = [(lang or "und", t) for lang, t in texts(60, 5)]
    tries = collocations.Tries(size, None, *limits)
    batches = [b for lang, t in data for b in tries.add(lang, t.encode())] + list(tries.flush())
    got, totals = {}, Counter()
    for batch in batches:
        seen = set()
        for r in batch.to_pylist():
            if r["words"] == 0:
                totals[r["lang"]] += r["f"]
                continue
            phrase = tuple(w for w in (r["w1"], r["w2"], r["w3"]) if w is not None)
            assert len(phrase) == r["words"] and phrase not in seen
            seen.add(phrase)
            got.setdefault(r["lang"], Counter())[phrase] += r["f"]
    f, n = counted(data)
    sizes = (1, 2) if size == 2 else (3,)
    assert got == {lang: Counter({p: c for p, c in counts.items() if len(p) in sizes}) for lang, counts in f.items()}
    assert totals == (n if size == 2 else {})
    assert (len(batches) > 15) == (min(limits) < 10**6)


def test_a_task_sends_each_of_a_million_phrases_once():
    """With the limits as they are, and phrases by the million, nothing has to be spilled and sent again."""
    row = np.random.default_rng(6).integers(0, 1200, 2_500_000)
    pairs, times = np.unique(1200 * row[:-1] + row[1:], return_counts=True)
    tries = collocations.Tries(2)
    batches = list(tries.add("en", " ".join(map(str, row.tolist())).encode())) + list(tries.flush())
    sent = [b for b in batches if b.column("words")[0].as_py() == 2]
    got = np.concatenate([1200 * b.column("w1").cast("int64").to_numpy() + b.column("w2").cast("int64").to_numpy() for b in sent])
    order = np.argsort(got)
    assert len(pairs) > 10**6 and np.array_equal(got[order], pairs)
    assert np.array_equal(np.concatenate([b.column("f").to_numpy() for b in sent])[order], times)
    assert max(b.num_rows for b in sent) <= collocations.ROWS


def test_the_map_has_a_bit_of_every_pair(spark):
    """The hash in Spark is the hash in tasks; with the map, exactly the phrases of pairs that are in it are counted."""
    data = [(lang or "und", t) for lang, t in texts(60, 8)]
    f, _ = counted(data)
    pairs = [(lang, *p) for lang, counts in f.items() for p, c in counts.items() if len(p) == 2 and c >= 4]
    marks = collocations.pair_map(spark, spark.createDataFrame(pairs, "lang string, w1 string, w2 string"))
    assert 0 < int(np.bitwise_count(marks).sum()) <= len(pairs)
    tries, got, known = collocations.Tries(3, marks), Counter(), set(pairs)
    for lang, t in data:
        list(tries.add(lang, t.encode()))
    for batch in tries.flush():
        for r in batch.to_pylist():
            got[r["lang"], r["w1"], r["w2"], r["w3"]] += r["f"]
    wanted = Counter({(lang, *p): c for lang, counts in f.items() for p, c in counts.items() if len(p) == 3 and (lang, *p[:2]) in known and (lang, *p[1:]) in known})
    assert got == wanted and wanted


def test_large_counts_are_exact(spark):
    a, left, right = 987_654_321_987_654, 998_877_665_544_332, 987_654_321_987_655
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations._score("a", "l", "r").alias("s")).first()
    assert row["s"] == 1_000_000 * a * a // (left * right)


def test_overlaps_ties_and_cuts(spark, rows):
    data = [("en", "a a a a"), ("en", "b c. b c, d e; d e")]
    wanted = brute_force(data, least=2)
    assert rows(collocations.phrases(frame(spark, data), least=2), *COLUMNS) == sorted(wanted, key=str)
    assert [(r[1], r[2]) for r in wanted] == [(1, "b c"), (2, "d e"), (3, "a a a")]


def test_edge_rows(spark, rows):
    long = "one two three " * 30000
    data = [(None, None), ("en", ""), ("en", " \t\n.,"), (None, "x y"), ("und", "X Y"), ("en", long), ("en", "z\x00z \x1f z\x00z \x1f"), ("", "p q"), ("", "p q")]
    found = rows(collocations.phrases(frame(spark, data), least=2), *COLUMNS)
    assert found == sorted(brute_force(data, least=2), key=lambda r: [(v is not None, str(v)) for v in r])
    assert ("und", 1, "x y", 2, 2, 2, 4, 1000000) in found and ("", 1, "p q", 2, 2, 2, 4, 1000000) in found
    assert collocations.phrases(frame(spark, data).limit(0)).count() == 0
    assert collocations.phrases(frame(spark, data), least=10**6).count() == 0


def test_query_equals_sql_and_plain_counting(spark, rows):
    folder = "/root/testdata/sf0.001"
    ours = rows(QUERIES["op12_phrases"](spark, folder), *COLUMNS)
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        theirs = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op12_phrases']})").fetchall()
    order = lambda r: [(v is not None, str(v)) for v in r]
    assert ours == sorted(theirs, key=order)
    data = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert ours == sorted(brute_force(data), key=order)
