"""Documents made ready for training: language, quality, repeated lines, near copies, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.llm import jaccard, langid, lines, packing, quality
from airtally.llm.common import table
from airtally.llm.queries import END_ID, SEQUENCE, vocabulary
from airtally.session import work_folder

#: Below this probability of the best language a text is in none that is known.
LEAST_LANGUAGE = 0.4
#: Shorter runs of lines than line dedup's bound go too, if their words in all places are this many.
HOT_WORDS = 300


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those in no language that the network is sure of, go."""
    return langid.keep_known(docs, langid.fit(docs), LEAST_LANGUAGE)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules score below one half go."""
    own = _free(docs, "quality")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), score_col=own)
    return scored.where(F.col(own) >= 0.5).drop(own)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated lines go, of short ones if they are hot, and documents of which nothing is left; n_chars is counted anew."""
    own = _free(docs, "deleted")
    kept = lines.drop_repeated_lines(docs, deleted_col=own, hot_words=HOT_WORDS)
    kept = kept.where((F.col(own) == 0) | F.col("text").rlike(lines.WORD)).drop(own)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8, the one of the smallest id stays; unlinked texts under one id all do."""
    return jaccard.keep_one_of_each(docs, width=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of training sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), END_ID, SEQUENCE)


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("packing", pack),
]

#: The stages rest on trained models and on a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
