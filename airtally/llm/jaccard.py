"""Exact Jaccard self-join of n-gram sets by token-combination prefixes.

A document's tokens are the 64-bit hashes of its distinct word n-grams. Tokens
found in more than a fixed share of all tokens are the frequent class, and come
last in the one order that all documents use; there can't be more of them than
that share's inverse, which bounds what every task gets.

Two sets at the threshold differ in a known number of tokens at most. The one
order of tokens is cut into more groups than that, ranges of hashes, and a set's
tokens of one group are one combination. As each token that differs spoils one
group only, a prefix of one group more than that has a combination of both. So a
set indexes the combinations of its first groups that have tokens, one more than
tokens may differ. Groups of frequent tokens follow those of the others, so that
a passage of many documents comes last; and as a key stands for several tokens,
documents that share a few n-grams hardly ever share one, however many they are.
A set whose tokens fill too few groups indexes single tokens of its prefix as
well. Number of groups and keys go by the power of two below the set's size; a
document whose partners may lie above the next power is indexed there too.

Sets of equal tokens are one set. Of each key's sets, all meet the smallest
first; what links is joined to components, and only sets of one key that are
then in different components are paired. So groups of near copies never give
all their pairs, and still no link between different components is lost. Pairs
pass an exact bound by parities of hash buckets before they are verified on the
whole sets.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm.common import per_slice, sliced, stored
from airtally.llm.components import components

#: A token is frequent from this share of all tokens on, and from this count on.
FREQUENT_SHARE = 2.0**-20
FREQUENT_LEAST = 16
#: Tokens after which a task reports those that it has met often, and starts anew.
BLOCK = 4_000_000
#: Bits of the map of sets that wait for verification. Its size is fixed; if it
#: fills up, more sets than needed are sent, and an exact join drops them.
MAP_BITS = 1 << 26
#: Buckets of the parities that are compared while sets of one key are joined.
SHORT_BITS = 1024
REMEMBERED = 500_000
#: Words that a worker remembers the hashes of, and bytes of the longest one; tasks to come keep them too.
WORDS = 1 << 17
WORD_BYTES = 64

P1, P2, P3 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


class Words(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= WORD_BYTES:
            if len(self) >= WORDS:
                self.clear()
            self[word] = h
        return h


@cache
def word_hashes() -> Words:
    return Words()


def tokens(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's word n-grams.

    Words are parted by ASCII white space, A-Z lower-cased. Fewer words than the
    width are one n-gram; a null text or one without words has none.
    """
    words = text.encode().lower().split() if text else []  # of bytes, both know ASCII only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(word_hashes().__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = mix((out + h[k : len(h) - width + 1 + k]) * P1)
    return np.unique(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def set_id(h: np.ndarray) -> int:
    """One number for a set; equal sets have the same."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).view(np.int64))


def least_overlap(n: int, percent: int) -> int:
    """What a set of n tokens shares with any set at the threshold, at least."""
    return -(-n * percent // 100)


def most_differing(n: int, m: int, percent: int) -> int:
    """How many tokens are in one of two sets of n and m only, at most, if they are at the threshold."""
    return (100 - percent) * (n + m) // (100 + percent)


def keys(h: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The index keys of one set: combinations of its tokens in the first groups that it has tokens of.

    A set takes one group more than it and a partner may differ in. Of two at the
    threshold, the one that reaches less far so has a group that the other has
    too, with the same tokens. If neither finds groups enough, both index single
    tokens of their prefixes. Sets in which no token may differ have no keys, as
    equal sets are one already.
    """
    n = len(h)
    if n < 2:
        return np.zeros(0, dtype=np.uint64)
    at = np.minimum(np.searchsorted(frequent, h), max(len(frequent) - 1, 0))
    common = frequent[at] == h if len(frequent) else np.zeros(n, dtype=bool)
    parts = np.concatenate([h[~common], h[common]])  # in the order of all documents
    high, late = parts >> np.uint64(32), np.arange(n) >= n - np.count_nonzero(common)
    own = n.bit_length() - 1
    top = (n * 100 // percent).bit_length() - 1
    out = []
    for band in range(own, top + 1):
        largest = (2 << band) - 1
        differing = most_differing(n, min(n * 100 // percent, largest), percent)
        if not differing:
            continue
        salt = np.uint64((band + 1) * int(P3) & 0xFFFFFFFFFFFFFFFF)
        # Some more groups than can differ in the largest sets here, as some have no tokens.
        groups = most_differing(largest, largest, percent) * 9 // 8 + 2
        group = (high * np.uint64(groups) >> np.uint64(32)) + late * np.uint64(groups)  # ranges of hashes
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        out.append(mix((np.add.reduceat(parts, starts)[: differing + 1] ^ salt) * P1))
        if len(starts) <= differing:
            out.append(mix((h[: n - least_overlap(n, percent) + 1] ^ salt) * P2))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.uint64)


def parity(h: np.ndarray) -> bytes:
    """Two to four bits a token: of each hash bucket, whether its number of tokens is odd.

    Where two sets differ in a bucket, at least one token is in one of them
    only. The number of buckets is a power of two, so that two sizes can meet.
    """
    many = max(64, 2 << len(h).bit_length())
    odd = np.bincount((h & np.uint64(many - 1)).astype(np.int64), minlength=many) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def short_parity(h: np.ndarray) -> np.ndarray:
    """The same of a fixed number of buckets, as 64-bit numbers: what a join can compare by itself."""
    odd = np.bincount((h & np.uint64(SHORT_BITS - 1)).astype(np.int64), minlength=SHORT_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def least_difference(x: bytes, y: bytes) -> int:
    """How many tokens are in one of two sets only, at least."""
    a, b = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def packed(h: np.ndarray) -> bytes:
    """The first 48 bits of each token, in order: what the tasks that verify pairs get."""
    return (h >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0]


SETS = "kind int, doc_id long, sid long, n long, parity binary, bits array<long>"


def _sets(rows: DataFrame, width: int, share: float) -> DataFrame:
    """kind 0: a row's set; kind 1: a token (in sid) that a task met n times, often enough to be frequent."""

    def run(batches):
        held: list[np.ndarray] = []
        size = 0

        def often() -> pa.RecordBatch | None:
            nonlocal held, size
            if not held:
                return None
            token, n = np.unique(np.concatenate(held), return_counts=True)
            # A token over the share of all tokens is over it in some block.
            keep = n >= max(2, size * share)
            held, size = [], 0
            none = pa.nulls(int(keep.sum()), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(int(keep.sum()), dtype=np.int32)), none, pa.array(signed(token[keep])), pa.array(n[keep]),
                 pa.nulls(int(keep.sum()), pa.binary()), pa.nulls(int(keep.sum()), pa.list_(pa.int64()))], NAMES,
            )

        for part in sliced(batches):
            sets = [tokens(t, width) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(sets), dtype=np.int32)),
                    part.column(0),
                    pa.array([set_id(h) if len(h) else None for h in sets], pa.int64()),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([parity(h) for h in sets], pa.binary()),
                    pa.array([short_parity(h) for h in sets], pa.list_(pa.int64())),
                ],
                NAMES,
            )
            held += sets
            size += sum(map(len, sets))
            if size >= BLOCK and (out := often()) is not None:
                yield out
        if (out := often()) is not None:
            yield out

    return rows.mapInArrow(run, SETS)


NAMES = [x.split(" ")[0] for x in SETS.split(", ")]


def _index(rows: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(key, sid) of every row's set."""
    sent = rows.sparkSession.sparkContext.broadcast(frequent)

    def make():
        met: set[int] = set()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out, ids = [], []
            for text in batch.column(1).to_pylist():
                h = tokens(text, width)
                sid = set_id(h) if len(h) > 1 else None
                if sid is None or sid in met:  # this task has sent its keys
                    continue
                if len(met) > REMEMBERED:
                    met.clear()
                met.add(sid)
                own = keys(h, sent.value, percent)
                out.append(own)
                ids.append(np.full(len(own), sid, dtype=np.int64))
            if not out:
                return None
            columns = [signed(np.concatenate(out)), np.concatenate(ids)]
            return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "sid"])

        return step

    return per_slice(rows, make, "key long, sid long")


def _may_link(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and parities allow the threshold."""
    sizes = sets.select("sid", "n", "parity")
    a = sizes.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("parity").alias("parity_a"))
    b = sizes.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("parity").alias("parity_b"))
    sized = pairs.join(a, "a").join(b, "b")
    sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            both = zip(batch.column("parity_a").to_pylist(), batch.column("parity_b").to_pylist(), strict=True)
            least = np.array([least_difference(x, y) for x, y in both], dtype=np.int64)
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            # At the threshold, all but this share of both sizes is common.
            return batch.select(["a", "b"]).filter(pa.array((100 + percent) * least <= (100 - percent) * n))

        return step

    return per_slice(sized.select("a", "b", "n_a", "n_b", "parity_a", "parity_b"), make, "a long, b long", 4096)


def _spots(doc_id: np.ndarray) -> np.ndarray:
    return (mix(doc_id.view(np.uint64)) % np.uint64(MAP_BITS)).astype(np.int64)


def _verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) that are at the threshold, on their whole sets.

    A set is read from the document of the smallest id that has it. Which
    documents these are, every task learns from a map of a fixed size.
    """
    asked = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(sets.select("sid", "doc_id"), "sid")

    def spot(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = _spots(batch.column(1).to_numpy())
        words, place = np.unique(at >> 6, return_inverse=True)
        bits = np.zeros(len(words), dtype=np.uint64)
        np.bitwise_or.at(bits, place, np.uint64(1) << (at & 63).astype(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits.view(np.int64))], ["word", "bits"])

    cells = per_slice(asked, lambda: spot, "word long, bits long", 65536).groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    if not len(cells):
        return pairs
    marks = np.zeros(MAP_BITS >> 6, dtype=np.uint64)
    marks[cells["word"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    sent = rows.sparkSession.sparkContext.broadcast(marks)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            ids, out = [], []
            at = _spots(batch.column(0).to_numpy())
            marked = sent.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1
            for text in batch.column(1).filter(pa.array(marked)).to_pylist():  # only these are read
                h = tokens(text, width)
                if len(h) > 1:
                    ids.append(set_id(h))
                    out.append(packed(h))
            if not ids:
                return None
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["sid", "set"])

        return step

    # Both sides read one shuffle of the sets.
    found = per_slice(rows, make, "sid long, set binary")
    met = pairs.join(found.alias("x"), F.col("a") == F.col("x.sid")).join(found.alias("y"), F.col("b") == F.col("y.sid"))

    def check():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                shared = len(np.intersect1d(unpacked(x), unpacked(y), assume_unique=True))
                keep.append(100 * shared >= percent * ((len(x) + len(y)) // 6 - shared))
            return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return step

    both = met.select("a", "b", F.col("x.set").alias("set_a"), F.col("y.set").alias("set_b"))
    return per_slice(both, check, "a long, b long").distinct()


def link_documents(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id: the smallest id that links lead to, its own included.

    Two documents link when 100 * shared n-grams >= percent * all n-grams of
    both. Null and empty texts, and those without a word, have no n-grams and no
    links. A row without an id has no component (null) and links nothing. Rows
    of one id are one document: its texts' links are all its own. An empty table
    gives no rows; only the two named columns are read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    both = stored(_sets(rows, width, FREQUENT_SHARE), "sets", "kind")
    of_rows = both.where("kind = 0").select("doc_id", "sid", "n", "parity", "bits")
    total = of_rows.agg(F.sum("n")).first()[0] or 0
    # Counts are of some blocks only, so at most all; hence at most 1 / share tokens are collected.
    often = both.where("kind = 1").groupBy("sid").agg(F.sum("n").alias("n"))
    often = often.where(F.col("n") >= max(FREQUENT_LEAST, total * FREQUENT_SHARE)).select("sid").toPandas()["sid"]
    frequent = np.sort(often.to_numpy(dtype=np.int64).view(np.uint64))

    usable = rows.where(F.col("doc_id").isNotNull())
    ids = of_rows.where(F.col("doc_id").isNotNull() & F.col("sid").isNotNull())
    sets = stored(ids.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("bits").alias("bits")), "distinct")
    index = stored(_index(usable, width, percent, frequent), "index")

    shared = index.groupBy("key").agg(F.min("sid").alias("b"), F.max("sid").alias("top")).where("b < top").select("key", "b")
    index = stored(index.join(stored(shared, "shared"), "key"), "met")  # only keys that sets share
    star = index.where("sid > b").select(F.col("sid").alias("a"), "b").distinct()
    links = stored(_verified(stored(_may_link(star, sets, percent), "pairs"), sets, usable, width, percent), "links")

    # Rows of one id join their sets.
    own = ids.groupBy("doc_id").agg(F.min("sid").alias("b"), F.max("sid").alias("top")).where("b < top").select("doc_id", "b")
    same = stored(ids.join(own, "doc_id").where("sid > b").select(F.col("sid").alias("a"), "b").distinct(), "same")
    links = links.unionByName(same)

    label = components(links)
    labelled = index.join(label.withColumnRenamed("node", "sid"), "sid", "left").select(
        "key", "sid", F.coalesce("component", "sid").alias("component")
    )
    labelled = stored(labelled, "labelled")
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    left = labelled.join(stored(open_keys, "open"), "key", "left_semi").join(sets.select("sid", "n", "bits"), "sid")
    left = stored(left, "left")
    x = left.select("key", F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"), F.col("bits").alias("bits_a"))
    y = left.select("key", F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"), F.col("bits").alias("bits_b"))
    near = (F.col("a") > F.col("b")) & (F.col("c_a") != F.col("c_b"))
    near = near & (100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))
    # Two sets differ in as many tokens as parities at least. The join itself drops pairs that differ in too many,
    # so that a group of documents that are like but not like enough doesn't come out of it as all its pairs.
    differing = F.zip_with("bits_a", "bits_b", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    least = F.aggregate(differing, F.lit(0), lambda total, bits: total + bits)
    near = near & ((100 + percent) * least <= (100 - percent) * (F.col("n_a") + F.col("n_b")))
    met = x.withColumnRenamed("key", "key_a").join(y, (F.col("key_a") == F.col("key")) & near).select("a", "b").distinct()
    late = stored(_verified(stored(_may_link(met, sets, percent), "late-pairs"), sets, usable, width, percent), "late")
    label = components(links.unionByName(late))

    named = sets.join(label.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "doc_id", F.coalesce("component", "sid").alias("component")
    )
    named = stored(named, "named")
    least = stored(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    by_set = stored(named.join(least, "component").select("sid", "component_id"), "by-set")
    out = of_rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("sid")).alias("sid"))
    found = out.where(F.col("sid").isNotNull()).join(by_set, "sid")
    alone = out.where(F.col("sid").isNull()).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return found.select(columns).unionByName(alone.select(columns))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, without those that link to one of a smaller id, however many links away.

    Rows without an id stay. Rows that repeat an id are documents of their own if
    their texts differ (a hash of id and text tells them apart): of those that link, one
    stays, and no text is lost that links to nothing. Of rows that repeat both, one
    stays. Columns of the documents may have any name.
    """
    taken = {c.lower() for c in docs.columns}
    own = "own"
    while own in taken:
        own = "_" + own
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.where(F.col(f"`{id_col}`").isNotNull()).withColumn(own, F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(text, F.lit(""))))
    linked = link_documents(keyed, width, percent, own, text_col).select(F.col("doc_id").alias("own"), "component_id").distinct()
    ids = keyed.select(F.col(own).alias("own"), F.col(f"`{id_col}`").alias("id"))
    first = linked.join(ids, "own").groupBy("component_id").agg(F.min_by("own", F.struct("id", "own")).alias(own)).select(own)
    kept = keyed.join(first, own, "left_semi").dropDuplicates([own]).drop(own)
    return kept.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
