"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are fitted with numpy on a bounded sample of labelled rows (``SAMPLE_ROWS``),
on binned columns, level by level, and flattened into complete-tree arrays.
Scoring computes the statistics and walks all trees for a whole Arrow batch at
once inside the tasks, in one pass over the documents, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import held_out, table, text_of, training_sample

#: Most labelled rows (about) that a model is fitted on.
SAMPLE_ROWS = 20_000
REJECT_BELOW = 0.3

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "upper", "lower", "digit", "space", "punctuation", "symbol", "non_ascii",
    "distinct_bytes", "byte_entropy", "word_length", "long_words", "one_letter_words", "distinct_words", "top_word",
    "distinct_pairs", "distinct_lines", "words_a_line", "ends_marked", "capital_words", "no_letter_words", "compressed",
)
_SORT = np.zeros(256, dtype=np.int64)  # kind of each byte: 0 control, 1 upper, 2 lower, 3 digit, 4 space, 5.. below
_SORT[65:91], _SORT[97:123], _SORT[48:58], _SORT[[32, 9, 10, 11, 12, 13]] = 1, 2, 3, 4
_SORT[[ord(c) for c in ".,;:!?'\"-()"]] = 5
_SORT[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_SORT[128:] = 7


def statistics(text: str) -> list[float]:
    """The statistics of one whole text; an empty one has zeros throughout."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = len(raw)
    kinds = np.bincount(_SORT, weights=counts, minlength=8) / n
    share = counts[counts > 0] / n
    words, lines = raw.split(), raw.split(b"\n")
    k = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), float(np.log1p(len(lines))),
        *kinds[1:8].tolist(), float(len(share)), float(-(share * np.log2(share)).sum()),
        float(lengths.mean()), float((lengths > 12).mean()), float((lengths == 1).mean()),
        len(seen) / k, (max(seen.values()) if seen else 0) / k, pairs / max(1, len(words) - 1),
        len(set(lines)) / len(lines), len(words) / len(lines),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
        sum(w[:1].isupper() for w in seen) / max(1, len(seen)),
        sum(not w.isalpha() and w.isascii() and not any(c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in w)
            for w in seen) / max(1, len(seen)),
        len(zlib.compress(raw, 1)) / n,
    ]


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth in flat arrays: inner node i has children 2i+1 and 2i+2."""
    feature: np.ndarray    # (trees, 2^depth - 1)
    threshold: np.ndarray  # (trees, 2^depth - 1); a row goes right if its value is greater
    value: np.ndarray      # (trees, 2^depth)
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        if not len(x) or not len(self.feature):
            return np.full(len(x), self.base)
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return self.base + self.value[tree, node - inner].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
              l2: float = 1.0, least_rows: int = 10) -> Trees:
    """Boost trees on the logistic loss, each level from per-node gradient histograms.

    Without rows, or with a single class, the model is a constant.
    """
    inner, leaves = (1 << depth) - 1, 1 << depth
    p = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    out_f, out_t, out_v = [], [], []
    score = np.full(len(y), base)
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-score))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            best = np.full(width, 1e-6)
            cut = np.full(width, -1)
            pick = np.zeros(width, np.int64)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                cell = local * (len(e) + 1) + binned[:, j]
                shape = (width, len(e) + 1)
                g, h, c = (np.bincount(cell, weights=v, minlength=width * shape[1]).reshape(shape).cumsum(axis=1)
                           for v in (grad, hess, np.ones(len(y))))
                gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g**2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt**2 / (ht + l2)
                gain[(c < least_rows) | (ct - c < least_rows)] = 0
                gain = gain[:, :-1]
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better], cut[better], pick[better] = top[better], at[better], j
            for i in range(width):
                if cut[i] >= 0:
                    feature[first + i], threshold[first + i] = pick[i], edges[pick[i]][cut[i]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, weights=grad, minlength=leaves) / (np.bincount(leaf, weights=hess, minlength=leaves) + l2)
        score = score + value[leaf]
        out_f.append(feature), out_t.append(threshold), out_v.append(value)
    return Trees(np.array(out_f), np.array(out_t), np.array(out_v), base)


def fit_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", rows: int = SAMPLE_ROWS,
                folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Fit on the statistics of a bounded sample of labelled documents outside the held-out fold."""
    sample = training_sample(docs, labels, label, rows=rows, folds=folds, id_col=id_col, text_col=text_col) \
        .select(F.col("_id").cast("string").alias("_id"), "_text", "_label")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": [statistics(t) for t in b["_text"]], "y": b["_label"].astype("int32"), "id": b["_id"]})

    got = sample.mapInPandas(measure, "x array<double>, y int, id string").toPandas() \
        .sort_values(["id", "y"], kind="stable")
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(STATISTICS))
    return fit_trees(x, got["y"].to_numpy(dtype=float))


def with_quality(docs: DataFrame, model: Trees, *, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score (0..1, higher: label 1 likelier) of each whole text."""
    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(STATISTICS))
            yield pd.Series(model.probability(x))

    return docs.withColumn(into, score(text_of(text_col)))


def score_quality(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, threshold: float = REJECT_BELOW,
                  folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted for every document.

    Null texts score as empty ones; an empty text gets the score that the trees
    give to statistics of zero.  Null ids are scored and not held out.
    Repeated rows get equal scores.  Without labels every score is the prior,
    0.5.  Labels, ids and other columns are no inputs; columns that clash in
    name with the results are ignored.  An empty table gives no rows.
    """
    model = fit_quality(docs, labels, rows=rows, folds=folds, id_col=id_col, text_col=text_col)
    scored = with_quality(docs.select(F.col(id_col), F.col(text_col).alias("_text")), model, text_col="_text")
    return scored.select(F.col(id_col), held_out(id_col, folds).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_boosted_tree_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
