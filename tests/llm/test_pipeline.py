"""The pipeline against its stages done in plain Python, and what the contract registers."""

import pytest
from pyspark.sql import functions as F
from test_jaccard import brute_force as linked
from test_lines import WORD
from test_lines import brute_force as without_copies
from test_packing import check
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from airtally.llm import langid, lines, quality

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_equals_plain_python(spark, word_bpe):
    rows = sorted(spark.read.parquet(f"{SF_DIR}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    net = langid.fit(spark.createDataFrame(rows, SCHEMA))
    found = net.predict([r["text"] for r in rows])
    rows = [r for r, (lang, score) in zip(rows, found, strict=True) if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE]

    docs = spark.createDataFrame(rows, SCHEMA)
    model = quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    frame = docs.select("doc_id", quality.statistics(F.col("text")).alias("s")).select("doc_id", "s.*").toPandas()
    good = set(frame["doc_id"][model.predict(frame[list(quality.NAMES)].to_numpy(dtype=float)) >= 0.5])
    rows = [r for r in rows if r["doc_id"] in good]

    left = without_copies([r["text"] for r in rows], lines.MIN_WORDS)
    texts = {r["doc_id"]: t for r, t in zip(rows, left, strict=True) if t == r["text"] or WORD.search(t)}
    reached = linked(texts, 5, 80)
    texts = {k: t for k, t in texts.items() if reached[k][1] == k}

    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0 < len(texts) < len(spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    check(pieces, texts, Tokenizer.from_file(word_bpe), 4096)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


@pytest.mark.parametrize("texts", [[], [None, "", "12 34"]])
def test_nothing_is_left(spark, documents, texts):
    docs = documents(texts)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0, name


def test_columns_of_any_name_pass(spark):
    """Extra columns named as the stages' own working columns come back as they were, and repeated ids keep unlinked texts."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    names = ["quality", "_quality", "deleted", "_deleted", "own", "uid", "ranges", "_kept", "score", "component_id", "sid", "key", "words"]
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert out.where(" or ".join(f"`{n}` <> concat('{n}', doc_id)" for n in names)).count() == 0, name


def test_registered():
    names = contract.queries()
    assert [n for n in range(1, 14) if any(k.startswith(f"op{n}_") for k in names)] == list(range(1, 14))
    assert "pipeline" in names
    assert {k for k in contract.oracle_sql() if k.startswith("op")} == {"op4_ngram_jaccard", "op9_repeated_lines", "op12_phrases"}
