"""Language identification by a convolutional network over bytes.

A text is cut into windows of a fixed number of bytes. Bytes become small
vectors, filters of several widths slide over them, each filter keeps its
largest response, and a softmax over these gives the languages. The network is
trained in numpy on windows of a bounded sample of labelled documents; every
window of every text is then put through it, many at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm.common import per_slice

WINDOW = 256
WIDTHS = (2, 3, 4)
#: Batch of windows that go through the network at once; fits a core's cache.
AT_ONCE = 64
LETTER = regex.compile(r"\p{L}")


def cut(data: bytes, window: int = WINDOW) -> np.ndarray:
    """A text's bytes as rows of one window each.

    A short text is filled up with zeros; the last window of a longer one is
    moved back to end with the text.
    """
    n = len(data)
    if n <= window:
        out = np.zeros((1, window), dtype=np.uint8)
        out[0, :n] = np.frombuffer(data, dtype=np.uint8)
        return out
    flat = np.frombuffer(data, dtype=np.uint8)
    whole = flat[: n // window * window].reshape(-1, window)
    return whole if n % window == 0 else np.concatenate([whole, flat[None, n - window :]])


@dataclass
class ByteCNN:
    """Weights: a vector to each byte, filters of each width, and the softmax's."""

    languages: list[str]
    vectors: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    weight: np.ndarray
    bias: np.ndarray

    def responses(self, windows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """For each width: the spans' vectors, the largest response of each filter, and where it was."""
        many, length = windows.shape
        size = self.vectors.shape[1]
        flat = np.ascontiguousarray(self.vectors[windows].reshape(many, length * size))
        spans, most, where = [], [], []
        for width, f, offset in zip(WIDTHS, self.filters, self.offsets, strict=True):
            view = np.lib.stride_tricks.sliding_window_view(flat, width * size, axis=1)[:, ::size]
            span = np.ascontiguousarray(view).reshape(-1, width * size)
            response = (span @ f).reshape(many, length - width + 1, -1)
            at = response.argmax(axis=1) if where is not None else None
            spans.append(span)
            where.append(at)
            most.append(np.maximum(np.take_along_axis(response, at[:, None], 1)[:, 0] + offset, 0))
        return spans, most, where

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """Log-probabilities of the languages for each window."""
        out = np.empty((len(windows), len(self.languages)), dtype=np.float32)
        size = self.vectors.shape[1]
        for a in range(0, len(windows), AT_ONCE):
            part = windows[a : a + AT_ONCE]
            many, length = part.shape
            flat = np.ascontiguousarray(self.vectors[part].reshape(many, length * size))
            most = []
            for width, f, offset in zip(WIDTHS, self.filters, self.offsets, strict=True):
                view = np.lib.stride_tricks.sliding_window_view(flat, width * size, axis=1)[:, ::size]
                response = np.ascontiguousarray(view).reshape(-1, width * size) @ f
                most.append(np.maximum(response.reshape(many, length - width + 1, -1).max(axis=1) + offset, 0))
            out[a : a + AT_ONCE] = log_softmax(np.concatenate(most, axis=1) @ self.weight + self.bias)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of each text and its probability; und and 0 for a text without a letter."""
        kept = [k for k, t in enumerate(texts) if t and LETTER.search(t)]
        rows = [cut(texts[k].encode()) for k in kept]
        out = [("und", 0.0)] * len(texts)
        if not rows:
            return out
        logits = self.logits(np.concatenate(rows))
        starts = np.cumsum([0, *map(len, rows)])
        means = np.add.reduceat(logits, starts[:-1], axis=0) / np.diff(starts)[:, None]
        chances = np.exp(log_softmax(means))
        best = chances.argmax(axis=1)
        for k, b, p in zip(kept, best, chances, strict=True):
            out[k] = self.languages[b], float(min(1.0, p[b]))
        return out


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def train(
    windows: np.ndarray,
    labels: list[str],
    size: int = 6,
    filters: int = 12,
    epochs: int = 5,
    batch: int = 64,
    rate: float = 0.004,
    seed: int = 7,
) -> ByteCNN:
    """Adam on the cross-entropy of single windows; the same rows give the same network."""
    languages = sorted(set(labels))
    target = np.searchsorted(languages, labels)
    random = np.random.default_rng(seed)
    parts = [random.normal(0, 0.5, (256, size))]
    parts += [random.normal(0, (2 / (w * size)) ** 0.5, (w * size, filters)) for w in WIDTHS]
    parts += [np.zeros(filters) for _ in WIDTHS]
    parts += [random.normal(0, 0.1, (filters * len(WIDTHS), len(languages))), np.zeros(len(languages))]
    parts = [p.astype(np.float32) for p in parts]
    k = len(WIDTHS)
    net = ByteCNN(languages, parts[0], parts[1 : 1 + k], parts[1 + k : 1 + 2 * k], parts[-2], parts[-1])
    first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    if len(languages) < 2:
        return net
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for a in range(0, len(order), batch):
            pick = order[a : a + batch]
            for p, g, m, v in zip(parts, gradients(net, windows[pick], target[pick]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)
            step += 1
    return net


def gradients(net: ByteCNN, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Of vectors, filters, offsets, weight and bias, in the order of the parts above."""
    many, length = windows.shape
    size = net.vectors.shape[1]
    spans, most, where = net.responses(windows)
    joined = np.concatenate(most, axis=1)
    error = np.exp(log_softmax(joined @ net.weight + net.bias))
    error[np.arange(many), target] -= 1
    error /= many
    back = (error @ net.weight.T) * (joined > 0)
    of_vectors, of_filters, of_offsets = np.zeros_like(net.vectors), [], []
    at = 0
    for width, f, span, place in zip(WIDTHS, net.filters, spans, where, strict=True):
        wide = f.shape[1]
        up = back[:, at : at + wide]  # a filter learns only from where it responded most
        at += wide
        rows = np.arange(many)[:, None] * (length - width + 1) + place
        of_filters.append(np.einsum("nf,nfs->sf", up, span[rows]))
        of_offsets.append(up.sum(axis=0))
        down = np.einsum("nf,sf->nfs", up, f).reshape(many, wide, width, size)
        seen = windows[np.arange(many)[:, None, None], place[:, :, None] + np.arange(width)]
        np.add.at(of_vectors, seen.ravel(), down.reshape(-1, size))
    return [of_vectors, *of_filters, *of_offsets, joined.T @ error, error.sum(axis=0)]


def fit(
    labelled: DataFrame, rows: int = 6000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> ByteCNN:
    """Train on one window from each of at most `rows` documents, those of the smallest hashed ids.

    The window's place follows from the hash as well. Rows without text or
    language teach nothing. No usable row at all gives a network that knows no
    language and predicts und.
    """
    text, order = F.col(text_col).cast("string"), F.xxhash64(F.col(id_col).cast("string"))
    place = F.lit(1) + F.pmod(order, F.greatest(F.length(text) - WINDOW, F.lit(1))).cast("int")
    taught = labelled.where(F.col(lang_col).isNotNull())
    usable = taught.where(F.length(text) > 0).select(
        order.alias("order"), F.substring(text, place, F.lit(WINDOW)).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    # Tasks send only rows under a hash that little more than the wanted number can be under; if too few are, more are asked for.
    share = 1.2 * rows / max(1, taught.count())
    while True:
        below = usable if share >= 1 else usable.where(F.col("order") < int(-(2**63) + share * 2**64))
        sample = below.orderBy("order", "lang", "text").limit(rows).collect()
        if share >= 1 or len(sample) >= rows:
            break
        share *= 4
    sample = [r for r in sample if r["text"] and LETTER.search(r["text"])]
    if not sample:
        none = np.zeros((0, 0), dtype=np.float32)
        return ByteCNN([], none, [], [], none, none)
    windows = np.concatenate([cut(r["text"].encode()[:WINDOW]) for r in sample])
    return train(windows, [r["lang"] for r in sample])


def identify(docs: DataFrame, net: ByteCNN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score (the probability, 0 to 1).

    A null or empty text and one without a letter are und with score 0, as is
    everything if the network knows no language. All windows of a text count
    alike. Repeated rows come back as often as they came; other columns are not
    read.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            found = net.predict(texts) if net.languages else [("und", 0.0)] * len(texts)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return per_slice(rows, make, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, net: ByteCNN, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, whose text is in a language that the network knows.

    Rejected: und, and texts whose best language has a probability below
    `least`. Column names of the documents may be anything.
    """
    schema = docs.schema
    place = docs.columns.index(text_col)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = net.predict(batch.column(place).to_pylist()) if net.languages else [("und", 0.0)] * batch.num_rows
            return batch.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

        return step

    return per_slice(docs, make, schema)
