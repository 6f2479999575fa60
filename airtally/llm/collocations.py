"""Phrases whose words stand together more than chance has it, counted in burst tries.

Each task keeps a trie of word ids for each language, laid flat: its paths are one
ascending array of numbers, so a subtree is a stretch of it. New phrases gather
in a container, which bursts once it is large: its paths are sorted, counted and
merged into the trie. Where the tries of a task hold too many entries, subtrees
of first words are spilled whole, as runs in the order of ids, the least first,
as they repeat least, until half is free. Runs of all tasks meet in partitions
by prefix, where equal phrases are merged.

Pairs and words are counted first. A triple is counted only if both its pairs may
be frequent, as no triple is more frequent than its pairs: a map of bits of a
fixed size, one for the hash of each frequent pair, tells. A pair that shares its
bit with another costs some rows that are dropped after the merge, no more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airtally.llm.common import sliced, stored

#: Entries, and distinct words, that the tries of one task hold at most, beside their containers.
ENTRIES = 2_000_000
WORDS = 400_000
#: Containers of a task that hold more phrases, equal ones each, burst.
BURST = 1_000_000
#: Rows of a batch that leaves a task.
ROWS = 1 << 18
#: Words counted at once.
STRETCH = 50_000
#: Bits of the map of frequent pairs, whatever the input.
MAP_BITS = 1 << 26

# One byte for all that parts pieces, one for all that parts words; A-Z in lower case.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
_END = b"."  # stands for the end of a piece, its id is 0
_BITS = 21  # of an id, three of which are one number
_LOW = (1 << _BITS) - 1
_SEED = 42  # of Spark's xxhash64
COUNTS = "lang string, words int, w1 string, w2 string, w3 string, f long"


class _Ids(dict):
    """Ids of words, given as they come, and if asked for the words' hashes by id."""

    def __init__(self, hashed: bool):
        self[_END] = 0
        self.hashed = hashed
        self.hashes = np.zeros(1024, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        new = self[word] = len(self)
        if not self.hashed:
            return new
        if new == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        self.hashes[new] = xxhash.xxh64_intdigest(word, _SEED)
        return new


class Tries:
    """Burst tries of a task, one a language, of phrases of two words or of three; ids of words are the task's own.

    With a map, only phrases all of whose pairs have their bit in it are counted.
    """

    def __init__(self, size: int, pairs: np.ndarray | None = None, entries: int = ENTRIES, words: int = WORDS, burst: int = BURST):
        if words + STRETCH > _LOW:
            raise ValueError(f"ids of {words} words don't fit in {_BITS} bits")
        self.size, self.pairs = size, pairs
        self.entries, self.most_words, self.burst = entries, words, burst
        self._clear()

    def _clear(self) -> None:
        self.ids = _Ids(self.pairs is not None)
        self.fresh: dict[str, list[np.ndarray]] = {}  # containers: paths as they come
        self.paths: dict[str, np.ndarray] = {}  # tries: paths ascending
        self.counts: dict[str, np.ndarray] = {}  # and how often each was met
        self.singles: dict[str, np.ndarray] = {}  # counts of words by id
        self.waiting = 0  # paths in containers

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """Count the phrases of a text; what has to be spilled meanwhile comes out."""
        words = text.translate(_BYTES).replace(_END, b" . ").split()
        words += (_END, _END)
        for at in range(0, len(words) - 2, STRETCH):
            self._count(lang, words[at : at + STRETCH + 2])
            if len(self.ids) > self.most_words:
                yield from self.flush()
            elif self.waiting > self.burst:
                self._burst()
                yield from self._relieve()

    def _count(self, lang: str, words: list[bytes]) -> None:
        row = np.array(list(map(self.ids.__getitem__, words)), dtype=np.int64)
        first, second = row[:-2], row[1:-1]
        whole = (first > 0) & (second > 0)
        if self.size == 2:
            self._count_singles(lang, first)
            packed = (first[whole] << 2 * _BITS) | (second[whole] << _BITS)
        else:
            if self.pairs is not None:
                hashed = self.ids.hashes[row]
                whole &= self._known(lang, hashed[:-2], hashed[1:-1]) & self._known(lang, hashed[1:-1], hashed[2:])
            whole &= row[2:] > 0
            packed = (first[whole] << 2 * _BITS) | (second[whole] << _BITS) | row[2:][whole]
        if len(packed):
            self.fresh.setdefault(lang, []).append(packed)
            self.waiting += len(packed)

    def _known(self, lang: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the map has the bits of pairs; the same hash as pair_bit has it in Spark."""
        own = np.uint64(xxhash.xxh64_intdigest(lang.encode(), _SEED))
        at = ((left << np.uint64(7)) ^ (left >> np.uint64(57)) ^ right ^ own) & np.uint64(MAP_BITS - 1)
        return (self.pairs[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def _count_singles(self, lang: str, row: np.ndarray) -> None:
        counts = self.singles.get(lang)
        if counts is None or len(counts) < len(self.ids):
            larger = np.zeros(2 * len(self.ids), dtype=np.int64)
            if counts is not None:
                larger[: len(counts)] = counts
            counts = self.singles[lang] = larger
        counts += np.bincount(row, minlength=len(counts))
        counts[0] = 0

    def _burst(self) -> None:
        """Sort and count what the containers hold, and merge it into the tries."""
        for lang, parts in self.fresh.items():
            paths, counts = np.unique(np.concatenate(parts), return_counts=True)
            if lang in self.paths:
                paths, counts = _merged(np.concatenate([self.paths[lang], paths]), np.concatenate([self.counts[lang], counts]))
            self.paths[lang], self.counts[lang] = paths, counts
        self.fresh, self.waiting = {}, 0

    def _relieve(self) -> Iterator[pa.RecordBatch]:
        """Spill the least subtrees until half of the entries are free, if there are too many."""
        held = sum(map(len, self.paths.values()))
        if held <= self.entries:
            return
        sizes = {lang: np.diff(_stretches(paths >> 2 * _BITS), append=len(paths)) for lang, paths in self.paths.items()}
        every = np.concatenate(list(sizes.values()))
        least_first = np.argsort(every, kind="stable")
        many = np.searchsorted(np.cumsum(every[least_first]), held - self.entries // 2) + 1
        spilled = np.zeros(len(every), dtype=bool)
        spilled[least_first[:many]] = True
        for lang, own in sizes.items():
            gone, spilled = np.repeat(spilled[: len(own)], own), spilled[len(own) :]
            paths, counts = self.paths[lang], self.counts[lang]
            yield from self._run(lang, paths[gone], counts[gone])
            self.paths[lang], self.counts[lang] = paths[~gone], counts[~gone]

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Everything that is held, counts of words, and how many of them each language has had."""
        self._burst()
        for lang, paths in self.paths.items():
            yield from self._run(lang, paths, self.counts[lang])
        names = pa.array(list(self.ids), pa.string()) if self.singles else None
        for lang, counts in self.singles.items():
            seen = np.flatnonzero(counts)
            none = pa.nulls(len(seen), pa.string())
            if len(seen):
                yield _batch(lang, 1, names.take(pa.array(seen)), none, none, counts[seen])
                none = pa.nulls(1, pa.string())
                yield _batch(lang, 0, none, none, none, counts.sum(keepdims=True))
        self._clear()

    def _run(self, lang: str, paths: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Subtrees as one run in the order of ids, some rows at a time."""
        names = pa.array(list(self.ids), pa.string()) if len(paths) else None
        for at in range(0, len(paths), ROWS):
            part = paths[at : at + ROWS]
            w1, w2 = (names.take(pa.array(x)) for x in (part >> 2 * _BITS, part >> _BITS & _LOW))
            w3 = names.take(pa.array(part & _LOW)) if self.size > 2 else pa.nulls(len(part), pa.string())
            yield _batch(lang, self.size, w1, w2, w3, counts[at : at + ROWS])


def _stretches(ascending: np.ndarray) -> np.ndarray:
    """Where each stretch of equal numbers starts."""
    return np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]])) if len(ascending) else np.zeros(0, dtype=np.int64)


def _merged(paths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths, ascending, with the sums of their counts."""
    order = np.argsort(paths, kind="stable")
    paths, counts = paths[order], counts[order]
    starts = _stretches(paths)
    return paths[starts], np.add.reduceat(counts, starts)


def _batch(lang: str, words: int, w1, w2, w3, f) -> pa.RecordBatch:
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(f), dtype=np.int64)))
    size = pa.array(np.full(len(f), words, dtype=np.int32))
    return pa.RecordBatch.from_arrays([langs, size, w1, w2, w3, pa.array(f, pa.int64())], names=["lang", "words", "w1", "w2", "w3", "f"])


def counted(texts: DataFrame, size: int, pairs: np.ndarray | None = None, **limits: int) -> DataFrame:
    """Counts of the phrases of `size` words of texts (lang, text as bytes): lang, words, w1, w2, w3, f.

    With size 2, rows of words 1 are single words, and rows of words 0 all words of a language.
    """
    sent = texts.sparkSession.sparkContext.broadcast(pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = Tries(size, sent.value, **limits)
        for batch in batches:
            for part in sliced([batch]):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(text)
                for lang, own in by_lang.items():
                    yield from tries.add(lang, _END.join(own))
        yield from tries.flush()

    key = ["lang", "w1", "w2", "w3"][: size + 1]  # all that phrases of these sizes need to be shuffled by
    rows = texts.mapInArrow(count, COUNTS).select(*key, "f").repartition("lang", "w1", "w2")
    merged = rows.groupBy(*key).agg(F.sum("f").alias("f"))
    words = sum(F.col(w).isNotNull().cast("int") for w in key[1:])
    return merged.select("lang", words.alias("words"), *(F.col(w) if w in key else F.lit(None).cast("string").alias(w) for w in ("w1", "w2", "w3")), "f")


def pair_bit(lang: str, w1: str, w2: str) -> Column:
    """Which bit of the map a pair has."""
    left, right, own = F.xxhash64(w1), F.xxhash64(w2), F.xxhash64(lang)
    mixed = F.shiftleft(left, 7).bitwiseXOR(F.shiftrightunsigned(left, 57)).bitwiseXOR(right).bitwiseXOR(own)
    return mixed.bitwiseAND(F.lit(MAP_BITS - 1).cast("long"))


def pair_map(spark: SparkSession, pairs: DataFrame) -> np.ndarray:
    """The map of frequent pairs, as numbers of 64 bits: at most MAP_BITS / 64 rows come to the driver."""
    cells = pairs.select(pair_bit("lang", "w1", "w2").alias("at")).select(
        F.shiftright("at", 6).alias("cell"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")
    )
    rows = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(MAP_BITS >> 6, dtype=np.uint64)
    out[rows["cell"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole decimals of 38 digits, which hold it up to counts of 10**15."""
    big = [F.col(c).cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (big[0] * big[0]), big[1] * big[2])


def _named(df: DataFrame, *names: str) -> DataFrame:
    return df.toDF(*names)


def phrases(
    docs: DataFrame,
    least: int = 10,
    top: int = 2000,
    inside: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    **limits: int,
) -> DataFrame:
    """The top phrases of two and three words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z and cut into pieces at . , ; : ! ? and line ends,
    pieces into words at spaces and tabs. a is how often a phrase stands within
    a piece, overlaps included, at least `least`; l and r the counts of its parts at
    the cut of the lowest score (of equal ones the first); n all words of the
    language. Pairs go that stand inside a triple of `inside` percent of their own
    count and more. Ranks go by score, a, then the phrase's bytes.

    A null language is `und`; null and empty texts have no words. Repeated rows count
    each time. No documents, or no phrase often enough, give no rows; other
    columns are not read. limits: what a task's tries hold (entries, words, burst).
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")
    ).where(F.length("text") > 0)
    short = stored(counted(texts, 2, **limits).where((F.col("f") >= least) | (F.col("words") == 0)), "phrases", "words")
    total = short.where("words = 0").select("lang", F.col("f").alias("n"))
    word = short.where("words = 1").select("lang", "w1", "f")
    pair = short.where("words = 2").select("lang", "w1", "w2", F.col("f").alias("a"))
    triple = counted(texts, 3, pair_map(docs.sparkSession, pair), **limits).where(F.col("f") >= least)
    triple = stored(triple.select("lang", "w1", "w2", "w3", F.col("f").alias("a")), "triples")

    covered = triple.select(
        "lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a"
    )
    covered = covered.groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    free = pair.join(covered, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    two = (
        free.join(_named(word, "lang", "w1", "l"), ["lang", "w1"])
        .join(_named(word, "lang", "w2", "r"), ["lang", "w2"])
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    )
    three = (
        triple.join(_named(word, "lang", "w1", "l1"), ["lang", "w1"])
        .join(_named(word, "lang", "w3", "r2"), ["lang", "w3"])
        .join(_named(pair, "lang", "w1", "w2", "l2"), ["lang", "w1", "w2"])
        .join(_named(pair, "lang", "w2", "w3", "r1"), ["lang", "w2", "w3"])
        .withColumn("s1", _score("a", "l1", "r1"))
        .withColumn("s2", _score("a", "l2", "r2"))
        .withColumn("early", F.col("s1") <= F.col("s2"))
    )
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(F.col("early"), F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(F.col("early"), F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
