"""Document fingerprints from prefix arrays of polynomial hashes.

prefix[i] is the sum of (code point + 1) * base**k over the first i characters,
modulo a prime, for two primes. The hash of any span is a difference of two
entries times an inverse power, so spans of one or two texts are compared at
once, and binary search over their lengths finds the longest common extension
of two places. A fingerprint is a text's length, the hash of all of it and of
some prefixes, and a sketch of the hashes of its windows: they are dealt into
bins, and each bin keeps a byte of its smallest. Texts that share spans share
bins.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airtally.llm.common import per_slice

#: Two primes below 2**31 and a base for each.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)

#: Characters in a window, bins of a sketch (a power of two).
WINDOW = 12
BINS = 128
#: Prefixes that a fingerprint has a hash of, at most (a power of two).
PREFIXES = 16
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """base**k and its inverse modulo a prime, for k below the longest length asked for."""

    def __init__(self, base: int, prime: int):
        self.prime = np.uint64(prime)
        self.base, self.inverse = base, pow(base, -1, prime)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, m, int(self.prime))) % self.prime])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, m, int(self.prime))) % self.prime])


POWERS = tuple(Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True))


class PrefixHashes:
    """The prefix arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.prefix = []
        for p in POWERS:
            p.reach(self.n + 1)
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            # Terms are below 2**31, so sums of up to 2**33 of them fit.
            np.cumsum(codes * p.up[: self.n] % p.prime, out=sums[1:])
            self.prefix.append(sums % p.prime)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The hash of text[start:end]; equal spans have equal hashes wherever they stand."""
        return tuple(
            (int(s[end]) + int(p.prime) - int(s[start])) * int(p.down[start]) % int(p.prime)
            for s, p in zip(self.prefix, POWERS, strict=True)
        )

    def windows(self, width: int) -> np.ndarray:
        """The hash, by the first prime, of each window; a shorter text is one window."""
        s, p = self.prefix[0], POWERS[0]
        width = min(width, self.n)
        many = self.n - width + 1 if self.n else 0
        return (s[width : width + many] + p.prime - s[:many]) * p.down[:many] % p.prime


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """The length of the longest span that starts at a's place i and at b's place j."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def fingerprint(hashes: PrefixHashes) -> str:
    """Length, hash of the whole, hashes of up to PREFIXES prefixes and the sketch, in hexadecimal.

    Prefixes end at the multiples of a power of two, so that those of two texts
    of different lengths meet. An empty bin of the sketch is 00.
    """
    mixed = hashes.windows(WINDOW) * SPREAD
    bins = (mixed >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    values = mixed & np.uint64((1 << 56) - 1)
    least = np.full(BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, bins, values)
    byte = (least * SPREAD >> np.uint64(40)) % np.uint64(255) + np.uint64(1)
    sketch = np.where(least == np.iinfo(np.uint64).max, 0, byte).astype(np.uint8)
    whole = "".join(f"{h:08x}" for h in hashes.span(0, hashes.n))
    step = _step(hashes.n)
    prefixes = "".join(f"{x ^ y:08x}" for x, y in (hashes.span(0, end) for end in range(step, hashes.n + 1, step)))
    return f"{hashes.n:x}:{whole}:{prefixes}:{sketch.tobytes().hex()}"


def _step(n: int) -> int:
    return 1 << max(0, (max(n, 1) - 1).bit_length() - PREFIXES.bit_length() + 1)


def likeness(a: str, b: str) -> float:
    """0 to 1 from two fingerprints; 1 only for equal texts.

    Either the shared windows, twice, by all windows of both, as the sketches
    say (bins empty in both say nothing, and bytes equal by chance are taken
    off), or the longest common prefix, twice, by both lengths, as binary search
    over the prefixes' hashes finds it; the larger one.
    """
    if a == b:
        return 1.0
    (n, _, p, x), (m, _, q, y) = a.split(":"), b.split(":")
    n, m = int(n, 16), int(m, 16)
    step = max(_step(n), _step(m))
    every_p, every_q = 8 * step // _step(n), 8 * step // _step(m)
    low, high = 0, min(n, m) // step
    while low < high:
        k = (low + high + 1) // 2
        if p[k * every_p - 8 : k * every_p] == q[k * every_q - 8 : k * every_q]:
            low = k
        else:
            high = k - 1
    prefix = 2 * low * step / max(n + m, 1)
    x, y = (np.frombuffer(bytes.fromhex(f), dtype=np.uint8) for f in (x, y))
    some = (x > 0) | (y > 0)
    share = float((x[some] == y[some]).mean()) if some.any() else 0.0
    jaccard = max(0.0, (share - 1 / 255) / (1 - 1 / 255))
    return min(max(prefix, 2 * jaccard / (1 + jaccard)), 0.999)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text, n_chars, fingerprint. A null text counts as empty and comes back as ''."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([fingerprint(PrefixHashes(t)) for t in texts], pa.string()),
                ],
                ["doc_id", "text", "n_chars", "fingerprint"],
            )

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return per_slice(rows, make, "doc_id long, text string, n_chars long, fingerprint string")


def with_next(rows: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each row with the text and the fingerprint of the row that follows by doc_id; the first follows the last.

    Ids are cut into ranges by the first id of each of a number of partitions,
    the only thing the driver sees. A range's first row is also sent to the
    range before it, where it ends that one's order. Null ids come first; rows
    of one id follow in the order of their texts' hashes.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = (
        ids.where(F.col("doc_id").isNotNull())
        .repartitionByRange(parts, "doc_id")
        .groupBy(F.spark_partition_id())
        .agg(F.min("doc_id").alias("first"))
        .collect()
    )
    bounds = np.array(sorted(r["first"] for r in firsts) or [0], dtype=np.int64)
    nulls = bool(ids.where(F.col("doc_id").isNull()).take(1))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = batch.column("doc_id").to_pylist()
            known = np.array([k if k is not None else bounds[0] for k in keys], dtype=np.int64)
            part = np.maximum(np.searchsorted(bounds, known, side="right") - 1, 0)
            absent = np.array([k is None for k in keys], dtype=bool)
            first = absent | ((known == bounds[part]) & ~((part == 0) & nulls))
            own = batch.append_column("part", pa.array(part)).append_column("ends", pa.array(np.zeros(len(keys), bool)))
            at = np.flatnonzero(first)
            sent = own.take(pa.array(at))
            sent = sent.set_column(4, "part", pa.array((part[at] - 1) % len(bounds)))
            sent = sent.set_column(5, "ends", pa.array(np.ones(len(at), bool)))
            return pa.Table.from_batches([own, sent]).combine_chunks().to_batches()[0]

        return step

    dealt = per_slice(
        rows, make, "doc_id long, text string, n_chars long, fingerprint string, part long, ends boolean"
    )
    order = Window.partitionBy("part").orderBy("ends", "doc_id", F.xxhash64("text"), "n_chars")
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_fingerprint", F.lead("fingerprint").over(order))
        .where(~F.col("ends"))
        .drop("ends", "part")
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they are.

    The edited text has the last quarter of the characters (rounded down)
    replaced by as many of the next document's first ones, or all of those.
    Also returned: same_prefix, the longest common extension of both from their
    starts. Null texts are empty; an empty text equals its edited text. The only
    document of a table is its own next one. Repeated rows are documents of
    their own. Only the two named columns are read; an empty table gives no rows.
    """
    paired = with_next(fingerprints(docs, id_col, text_col), docs, id_col)
    rows = paired.select(
        "doc_id", "text", "n_chars", "fingerprint",
        F.expr("substring(next_text, 1, int(n_chars div 4))").alias("patch"), "next_fingerprint",
    )

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            names = ["text", "n_chars", "fingerprint", "patch", "next_fingerprint"]
            out: list[list] = [[], [], [], [], []]
            for text, n, own, patch, following in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                edited = text[: n - n // 4] + patch
                hashes = PrefixHashes(edited)
                other = fingerprint(hashes)
                values = (
                    hashlib.sha256(edited.encode()).hexdigest(),
                    other,
                    likeness(own, other),
                    likeness(own, following),
                    common_extension(PrefixHashes(text), 0, hashes, 0) if own != other else n,
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            sha, other, near, after, same = (pa.array(c, k) for c, k in zip(out, kinds, strict=True))
            columns = [batch.column("doc_id"), batch.column("n_chars"), sha, batch.column("fingerprint"), other, near, after, same]
            return pa.RecordBatch.from_arrays(columns, OUT.replace(" long", "").replace(" string", "").replace(" double", "").split(", "))

        return step

    return per_slice(rows, make, OUT)


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, same_prefix long"
)
