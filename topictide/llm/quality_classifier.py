"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Class means and second moments are sums that Spark gathers over all labelled rows; the driver sees two small matrices, shrinks the
covariances towards the pooled variances and factors them once. A score is the logistic of the difference of the two
log densities, each a Mahalanobis distance taken with the cached Cholesky factor.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.llm.common import held_out, small_batches

FEATURES = (
    "log_words", "log_word_length", "upper_share", "symbol_share", "pipe_share", "exclamation_share", "digit_share",
    "full_stops_per_word", "commas_per_word", "adjacent_repeats", "log_distinct", "lines_per_word", "byte_entropy",
)
THRESHOLD = 0.3
SHRINKAGE = 0.1


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; ratios of an empty text are 0."""
    text = text or ""
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256).astype(float)
    words = text.split()
    n, size = max(len(words), 1), max(counts.sum(), 1.0)
    letters = max(counts[65:91].sum() + counts[97:123].sum() + counts[192:].sum(), 1.0)
    solid = max(size - counts[[32, 9, 10, 13]].sum(), 1.0)
    p = counts[counts > 0] / size
    root = lambda x: float(np.sqrt(x))
    return [
        float(np.log1p(len(words))),
        float(np.log(max(solid / n, 1.0))),
        root(counts[65:91].sum() / letters),
        root(counts[[35, 36, 37, 38, 42, 60, 62, 64, 94, 126]].sum() / size),
        root(counts[124] / size),
        root(counts[33] / size),
        root(counts[48:58].sum() / size),
        root(counts[46] / n),
        root(counts[44] / n),
        root(sum(map(operator.eq, words, words[1:])) / n),
        float(np.log(max(len(set(words)), 1) / n)),
        root(counts[10] / n),
        float(-(p * np.log(p)).sum()),
    ]


@dataclass(frozen=True)
class QuadraticDiscriminant:
    """Means, inverse Cholesky factors, log determinants and priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """P(class 1) of every row."""
        log_density = []
        for c in (0, 1):
            z = (x - self.means[c]) @ self.factors[c].T
            log_density.append(self.log_priors[c] - 0.5 * (self.log_dets[c] + (z * z).sum(axis=1)))
        return 1 / (1 + np.exp(np.clip(log_density[0] - log_density[1], -500, 500)))

    def score(self, text: Column) -> Column:
        """The score of a text column, 0 to 1."""
        scores = self.scores
        small_batches()

        @F.pandas_udf("double")
        def quality_score(texts: pd.Series) -> pd.Series:
            if not len(texts):
                return pd.Series([], dtype="float64")
            return pd.Series(scores(np.array([statistics(t) for t in texts])))

        return F.round(quality_score(text), 6)


def features(text: Column) -> Column:
    small_batches()

    @F.pandas_udf("array<double>")
    def text_statistics(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return text_statistics(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: tuple[int, int] | None = (5, 0),
    shrinkage: float = SHRINKAGE,
) -> QuadraticDiscriminant:
    """Fit on the labelled documents outside the held-out ``fold`` (modulus, remainder of crc32(id)).

    Several labels of one id: the largest counts. Null ids and labels are left out; a document without text counts as empty. A
    class without any row takes the pooled moments, and without labels at all every score is 0.5.
    """
    k = len(FEATURES)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label"))
    rows = docs if fold is None else docs.where(~held_out(id_col, *fold))
    rows = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), features(F.col(text_col)).alias("x"))
    x = [F.col("x")[i] for i in range(k)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(k)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i + 1)]
    found = {r["label"]: r for r in rows.join(known, "id").groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()}

    n, s, p = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
    for c, r in found.items():
        n[c] = r["n"]
        s[c] = [r[f"s{i}"] for i in range(k)]
        for i in range(k):
            for j in range(i + 1):
                p[c, i, j] = p[c, j, i] = r[f"p{i}_{j}"]
    total = max(n.sum(), 1)
    overall = s.sum(0) / total
    pooled = p.sum(0) / total - np.outer(overall, overall)
    spread = np.diag(np.maximum(np.diag(pooled), 1e-6))
    means, factors, log_dets = np.zeros((2, k)), np.zeros((2, k, k)), np.zeros(2)
    for c in (0, 1):
        means[c] = s[c] / n[c] if n[c] else overall
        own = p[c] / n[c] - np.outer(means[c], means[c]) if n[c] else pooled
        lower = np.linalg.cholesky((1 - shrinkage) * own + shrinkage * spread)
        factors[c] = np.linalg.inv(lower)
        log_dets[c] = 2 * np.log(np.diag(lower)).sum()
    return QuadraticDiscriminant(means, factors, log_dets, np.log((n + 1) / (n.sum() + 2)))


def score_quality(
    docs: DataFrame,
    model: QuadraticDiscriminant,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, score, predicted), one row per row of ``docs``: repeated rows and null ids too, null texts as empty ones;
    other columns are not read and an empty table gives an empty result."""
    scored = docs.select(F.col(id_col).alias("id"), model.score(F.col(text_col)).alias("score"))
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
