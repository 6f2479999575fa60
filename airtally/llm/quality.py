"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on the statistics of a bounded sample of labelled
documents. Every path from a root to a node is a rule: a conjunction of
comparisons. Logistic regression with an L1 penalty gives most rules the weight
0; those that are left are compiled into one Spark column expression, so
scoring a corpus is a projection of its scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that are counted.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
MARKS = ".,;:!?"
SYMBOLS = "#$%&*|~^@_=+<>{}[]()/\\"
SPACES = " \n\t\r"

NAMES = (
    "length", "share_upper", "share_digits", "share_marks", "share_symbols", "share_spaces",
    "word_length", "new_words", "variety", "new_lines", "line_words",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it.

    Columns that build on each other are not enough for that: a condition on the
    last one is moved below the first, with all between written out in it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _among(text: Column, chars: str) -> Column:
    """How many of the text's characters are among chars."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def statistics(text: Column) -> Column:
    """A struct of the statistics named above. A null text counts as empty."""

    def counts(t: Column) -> Column:
        return F.struct(
            F.length(t).cast("double").alias("n"),
            *[_among(t, c).alias(k) for k, c in (("upper", UPPER), ("digits", DIGITS), ("marks", MARKS), ("symbols", SYMBOLS), ("spaces", SPACES))],
            F.split(F.translate(t, "\n\t\r", "   "), " ").alias("words"),
            F.split(t, "\n").alias("lines"),
        )

    def sizes(c: Column) -> Column:
        return F.struct(
            F.greatest(c["n"], F.lit(1.0)).alias("chars"),
            F.size(c["words"]).cast("double").alias("words"),
            F.size(F.array_distinct(c["words"])).cast("double").alias("distinct_words"),
            F.size(c["lines"]).cast("double").alias("lines"),
            F.size(F.array_distinct(c["lines"])).cast("double").alias("distinct_lines"),
            c.alias("of"),
        )

    def shares(d: Column) -> Column:
        values = (
            d["of"]["n"],
            *[d["of"][k] / d["chars"] for k in ("upper", "digits", "marks", "symbols", "spaces")],
            d["chars"] / d["words"],
            d["distinct_words"] / d["words"],
            # Does not fall with the length of a text as the share itself does.
            F.log1p(d["distinct_words"]) / F.log1p(d["words"]),
            d["distinct_lines"] / d["lines"],
            d["words"] / d["lines"],
        )
        return F.struct(*[v.alias(k) for k, v in zip(NAMES, values, strict=True)])

    whole = F.coalesce(text.cast("string"), F.lit(""))
    return _let(whole, lambda t: _let(counts(t), lambda c: _let(sizes(c), shares)))


Rule = tuple[tuple[int, bool, float], ...]  # of (statistic, whether above, threshold)


@dataclass
class RuleEnsemble:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def column(self, values: list[Column]) -> Column:
        """The probability of label 1 as an expression over the statistics, in the order of NAMES."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for k, above, threshold in rule:
                holds = holds & (values[k] > threshold if above else values[k] <= threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total += weight * holds(rule, x)
        return 1 / (1 + np.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for k, above, threshold in rule:
        out &= x[:, k] > threshold if above else x[:, k] <= threshold
    return out


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 64, rate: float = 0.3) -> list[Rule]:
    """The distinct paths of boosted trees; splits are at quantiles of the statistics."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    place = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)])
    margin = np.zeros(len(y))
    rules: dict[Rule, None] = {}

    def split(rows: np.ndarray, path: Rule) -> None:
        g, h = gradient[rows], hessian[rows]
        best = (1e-6, -1, -1)
        if len(path) < depth and len(rows) >= 20:
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                gs = np.cumsum(np.bincount(place[k, rows], g, len(c) + 1))[:-1]
                hs = np.cumsum(np.bincount(place[k, rows], h, len(c) + 1))[:-1]
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), k, at)
        if path:
            rules.setdefault(path)
        _, k, at = best
        if k < 0:
            margin[rows] -= rate * g.sum() / (h.sum() + 1)
            return
        below = place[k, rows] <= at
        for above, part in ((False, rows[below]), (True, rows[~below])):
            split(part, (*path, (k, above, float(cuts[k][at]))))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        split(np.arange(len(y)), ())
    return list(rules)


def lasso(x: np.ndarray, y: np.ndarray, share: float = 0.01, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated proximal gradient; penalty: a share of the least one that leaves no weight."""
    n = len(y)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / spread
    penalty = share * np.abs(z.T @ (y - y.mean())).max() / n if z.shape[1] else 0.0
    top = np.linalg.norm(z, 2) ** 2 / n / 4 + 0.25 if z.shape[1] else 0.25
    start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    w, b, v, c, t = np.zeros(z.shape[1]), start, np.zeros(z.shape[1]), start, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        new_w = v - z.T @ error / n / top
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - penalty / top, 0)
        new_b = c - error.mean() / top
        new_t = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w / spread, float(b - (w * mean / spread).sum())


def train(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """Without both labels there is nothing to tell apart: the score is their smoothed share."""
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleEnsemble([], [], float(np.log(share / (1 - share))))
    seen, rules = set(), []
    for rule in grow(x, y):
        column = holds(rule, x)
        key = column.tobytes()
        if 0 < column.sum() < len(x) and key not in seen:
            seen.add(key)
            rules.append(rule)
    weights, bias = lasso(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y) if rules else (np.zeros(0), 0.0)
    kept = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]
    return RuleEnsemble([r for r, _ in kept], [w for _, w in kept], bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> RuleEnsemble:
    """Learn from at most `rows` labelled documents, those of the smallest hashed ids.

    The labels' table is cut to that bound before it is broadcast to the scan of
    the documents, and only statistics are collected. Labels other than 0 and 1,
    null ids and labels without a document teach nothing.
    """
    picked = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("_key"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(picked), F.col("_key") == F.col("_id"))
    counted = joined.select("_id", "_label", statistics(F.col("text")).alias("s")).select("_id", "_label", "s.*")
    sample = counted.orderBy(F.xxhash64("_id"), "_id", "_label", *NAMES).limit(rows).select("_label", *NAMES).toPandas()
    return train(sample[list(NAMES)].to_numpy(dtype=float), sample["_label"].to_numpy(dtype=float))


def score(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The documents with the probability of label 1 (0 to 1) in score_col, which replaces a column of that name.

    Empty and null texts have the statistics of an empty text. Only the text is
    an input. Repeated rows get equal scores.
    """
    found = _let(statistics(F.col(f"`{text_col}`")), lambda s: model.column([s[k] for k in NAMES]))
    return docs.withColumn(score_col, found)
