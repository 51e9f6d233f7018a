"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text (``FEATURES``) are computed in Spark tasks. The trees
are fitted in numpy on a bounded sample of labelled documents: features are
binned once, and every tree level picks each node's best split from gradient
histograms. A model is three arrays per tree in heap order (feature,
threshold, leaf value), so scoring walks all rows of a batch down one level at
a time in numpy.

Defined cases: null and empty texts have zero statistics and get a score like
any other. Null labels and ids do not train. Of several rows with one id, the
label and the text that compare largest train. Without labels the score is
0.5; with labels of one class it is near that class. Repeated rows stay; other
columns are kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_text, words_of
from .doc_stats import CLASSES, base_counts, class_counts

#: Labelled documents that a model is fitted on: those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000

FEATURES = ("log_words", "word_length", "longest_word", "symbols", "dup_lines", "repeat_words", "distinct_words",
            "top_word", "line_words", "upper_words", "digit_words", "short_words", "bang_words", *CLASSES)


def features_of(text: str | None) -> list[float]:
    """The statistics of one text; shares are of its words, lines or characters."""
    words = words_of(text)
    base = base_counts(text or "", words)
    n = max(1, len(words))
    tally = Counter(words)
    lines = max(1, sum(1 for x in (text or "").split("\n") if x.strip()))
    classes = class_counts((text or "").encode("utf-8", "surrogatepass"))
    return [
        float(np.log1p(len(words))), base["word_chars"] / n, float(max(map(len, words), default=0)),
        base["n_symbols"] / n, base["n_dup_lines"] / lines, base["n_repeat_words"] / n, len(tally) / n,
        max(tally.values(), default=0) / n, n / lines, sum(w.isupper() for w in words) / n,
        sum(w.isdigit() for w in words) / n, sum(len(w) <= 2 for w in words) / n,
        sum(w.endswith((b"!", b"?")) for w in words) / n, *(classes / max(1, classes.sum())).tolist()]


@dataclass
class Trees:
    """Trees of equal depth in heap order: node i has children 2i+1 and 2i+2; a row goes
    right if its feature is above the threshold."""
    base: float
    feature: np.ndarray                                   # (trees, inner nodes)
    threshold: np.ndarray
    leaf: np.ndarray                                      # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:          # all rows are on the same level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
              bins: int = 64, l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Boost logistic loss; ``x`` is (rows, features), ``y`` 0 or 1."""
    n, width = x.shape
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = min(max((y.sum() + 0.5) / (n + 1), 0.001), 0.999)
    model = Trees(float(np.log(share / (1 - share))), np.zeros((trees, inner), np.int64),
                  np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    if not n:
        return model
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    margin = np.full(n, model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            local = node - first
            at = (local[:, None] * width + np.arange(width)) * bins + binned
            size = count * width * bins
            hist = [np.bincount(at.ravel(), np.repeat(w, width), size).reshape(count, width, bins)
                    for w in (g, h, np.ones(n))]
            gl, hl, nl = (np.cumsum(a, axis=2) for a in hist)
            gt, ht, nt = gl[:, :, -1:], hl[:, :, -1:], nl[:, :, -1:]
            gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
            gain[(nl < min_rows) | (nt - nl < min_rows)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k, b in enumerate(best.tolist()):
                f, cut = divmod(b, bins)
                if gain[k, f, cut] > 1e-9 and cut < len(edges[f]):
                    model.feature[t, first + k], model.threshold[t, first + k] = f, edges[f][cut]
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.threshold[t, node])
        leaf = node - inner
        model.leaf[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        margin += model.leaf[t, leaf]
    return model


def _statistics(text: Column) -> Column:
    def make():
        return lambda texts: {"x": [features_of(t) for t in texts]}
    return per_text(text, make, "x array<float>")["x"]


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", usable: Column | None = None, rows: int = TRAIN_ROWS, **how) -> Trees:
    """Fit on at most ``rows`` labelled documents; ``usable`` (over ``labels``) limits the labels."""
    marked = labels.filter(usable) if usable is not None else labels
    marked = (marked.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    sample = marked.orderBy(F.xxhash64("id"), "id").limit(rows)
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most ``rows`` rows of two numbers are broadcast, and as many feature rows come back
    found = (keyed.join(F.broadcast(sample), "id").select("id", "y", _statistics(F.col("text")).alias("x"))
             .groupBy("id").agg(F.max(F.struct("y", "x")).alias("m")).select("id", "m.y", "m.x")
             .orderBy("id").toPandas())
    x = np.array(found["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit_trees(x, found["y"].to_numpy(np.float64), **how)


def score_quality(docs: DataFrame, model: Trees, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``out``."""
    def make():
        return lambda texts: {"s": model.score(np.array([features_of(t) for t in texts], np.float32).astype(np.float64))}
    return docs.withColumn(out, per_text(F.col(text_col), make, "s double")["s"])
