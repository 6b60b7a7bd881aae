"""Regularised quadratic discriminant over document statistics.

Every text becomes a vector of transformed statistics. Each class has a mean and a covariance, shrunk towards the
pooled covariance and towards a multiple of the identity; its Cholesky factor is computed once and cached in the model.
The score is the logistic of the difference of the two classes' log densities (Mahalanobis terms, log determinants and
priors). Means and covariances come from sums that Spark adds up over all labelled training rows: the driver receives
two rows whose width is the number of feature pairs.

Defined results: a null or empty text has all counts zero and is scored like any other; repeated rows are scored once
each, and repeated labels of a document vote (a tie is quality 1); a null id is scored, never trained on and not held
out; rows of labels with null quality are ignored; an empty table gives an empty table; other columns are ignored. If
training rows lack one of the classes, every score is the share of quality 1 among them (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stage_table
from .text_stats import text_stats

NAMES = ["size", "word_length", "symbols", "copied_lines", "repeats", "distinct", "function_words", "figures", "capitals", "stops", "exclaims"]


def features() -> list[Column]:
    """In the order of ``NAMES``: shares of the counts, with roots and logarithms against their skew."""
    words, characters = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars"))
    root = lambda count, of: F.sqrt(F.col(count) / of)
    values = [
        F.log1p(F.col("n_words").cast("double")), F.log1p(F.col("word_chars") / words), root("n_symbols", characters), root("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))),
        root("n_repeat_words", words), F.col("n_distinct_words") / words, root("n_function_words", words), root("n_digits", characters),
        root("n_upper", F.greatest(F.col("n_letters"), F.lit(1))), root("n_stops", words), root("n_exclaims", words),
    ]
    return [v.cast("double").alias(n) for n, v in zip(NAMES, values, strict=True)]


def fold(id_col: str = "doc_id", folds: int = 3) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


class Discriminant:
    """Class means, cached Cholesky factors, log determinants and priors."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled_share: float, identity_share: float) -> None:
        """moments: for each class the number of rows, the sum of their vectors and of their outer products."""
        self.total = sum(n for n, _, _ in moments.values())
        self.share = moments[1][0] / self.total if 1 in moments and self.total else (0.0 if self.total else 0.5)
        self.ready = all(k in moments and moments[k][0] > 1 for k in (0, 1))
        if not self.ready:
            return
        means = {k: s / n for k, (n, s, _) in moments.items()}
        scatter = {k: o - n * np.outer(means[k], means[k]) for k, (n, _, o) in moments.items()}
        pooled = sum(scatter.values()) / self.total
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
        d = scale.size
        self.scale, self.parts = scale, []
        for k in (0, 1):
            own = (1 - pooled_share) * scatter[k] / moments[k][0] + pooled_share * pooled
            own = own / np.outer(scale, scale)
            own = (1 - identity_share) * own + identity_share * np.eye(d) * max(np.trace(own) / d, 1e-6)
            factor = np.linalg.cholesky(own)
            inverse = np.linalg.inv(factor)
            self.parts.append((means[k] / scale, inverse, 2 * np.log(np.diag(factor)).sum(), np.log(moments[k][0] / self.total)))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(x), self.share)
        density = [prior - 0.5 * (((x / self.scale - mean) @ inverse.T) ** 2).sum(axis=1) - 0.5 * logdet for mean, inverse, logdet, prior in self.parts]
        # Divided by the dimension, so that far documents keep their order instead of all rounding to 0 or 1.
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / x.shape[1], -700, 700)))


def moments_of(rows: DataFrame, label: str) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    d = len(NAMES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(c).alias(f"s_{c}") for c in NAMES] + [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p_{i}_{j}") for i, j in pairs]
    out = {}
    for r in rows.groupBy(label).agg(F.count("*").alias("n"), *sums).collect():  # a row for each class
        outer = np.zeros((d, d))
        for i, j in pairs:
            outer[i, j] = outer[j, i] = r[f"p_{i}_{j}"]
        out[int(r[label])] = (float(r["n"]), np.array([r[f"s_{c}"] for c in NAMES]), outer)
    return out


def score_quality(docs: DataFrame, labels: DataFrame, pooled_share: float = 0.2, identity_share: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted. Labels of held-out rows (fold 1 of 3) are never read."""
    stats = text_stats(docs, id_col, text_col).select("doc_id", *features())
    stats = stage_table(stats, "features")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.filter("quality is not null and doc_id is not null").filter(fold() != 1)
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    model = Discriminant(moments_of(stats.join(known, "doc_id"), "quality"), pooled_share, identity_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in NAMES])
            score = model.score(x)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold() == 1, F.lit(False)).alias("held_out")
    return stats.select("doc_id", held, *NAMES).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
