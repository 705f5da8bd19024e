"""Text quality by a regularised quadratic discriminant over transformed statistics of whole texts.

Shares go through the arcsine root and sizes through the logarithm, which brings both near a normal form. Each label has
its mean and its covariance. A label's covariance is shrunk to the pooled one, and that to its diagonal, the more the fewer
rows there are; the Cholesky factors are worked out once, when the classifier is fitted, and travel with it to the tasks.
A score is the logistic function of the difference of the two log-densities (Mahalanobis distance and log-determinant).

Statistics of all texts are worked out in one pass and written down. Only they are read again, to fit and to score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import stored, table, text_of

# So many bytes of a text are split at once.
SLICE = 1 << 20
STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_spread", "upper", "digits", "space", "sentence_marks", "symbols",
    "beyond_ascii", "entropy", "distinct_words", "commonest_word", "same_word_twice", "log_line_length", "distinct_lines",
)

_KIND = np.zeros(256, np.int8)  # 0: control and the rest
_SPACE, _UPPER, _LOWER, _DIGIT, _MARK, _SYMBOL, _LEAD, _INNER = range(1, 9)
_KIND[list(b" \t\n\v\f\r")] = _SPACE
_KIND[33:127] = _SYMBOL
_KIND[list(b".,;:!?'\"()-")] = _MARK
_KIND[48:58], _KIND[65:91], _KIND[97:123] = _DIGIT, _UPPER, _LOWER
_KIND[128:192], _KIND[192:] = _INNER, _LEAD


def _slices(data: bytes, at: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(data):
        end = data.find(at, start + SLICE)
        end = len(data) if end < 0 else end + 1
        yield data[start:end]
        start = end


def _root(part: float, whole: float) -> float:
    return float(np.arcsin(np.sqrt(part / whole))) if whole else 0.0


def statistics(data: bytes) -> list[float]:
    """The transformed statistics of a text in UTF-8, all zero for an empty one."""
    if not data:
        return [0.0] * len(STATISTICS)
    bytes_ = np.zeros(256, np.int64)
    words: Counter[bytes] = Counter()
    lines: Counter[bytes] = Counter()
    for some in _slices(data, b" "):
        bytes_ += np.bincount(np.frombuffer(some, np.uint8), minlength=256)
        words.update(some.split())
    for some in _slices(data, b"\n"):
        lines.update(some.splitlines())
    kinds = np.bincount(_KIND, bytes_, 9)
    chars = kinds.sum() - kinds[_INNER]
    letters = kinds[_UPPER] + kinds[_LOWER] + kinds[_LEAD]
    seen = bytes_[bytes_ > 0] / len(data)
    times = np.fromiter(words.values(), float, len(words))
    sizes = np.fromiter(map(len, words), float, len(words))
    n = times.sum()
    mean = times @ sizes / n if n else 0.0
    spread = np.sqrt(times @ (sizes - mean) ** 2 / n) if n else 0.0
    n_lines = sum(lines.values())
    return [
        float(np.log1p(chars)),
        float(np.log1p(n)),
        float(np.log1p(mean)),
        float(np.log1p(spread)),
        _root(kinds[_UPPER], letters),
        _root(kinds[_DIGIT], chars),
        _root(kinds[_SPACE], chars),
        _root(kinds[_MARK], chars),
        _root(kinds[_SYMBOL], chars),
        _root(kinds[_LEAD], chars),
        float(-(seen * np.log(seen)).sum()),
        _root(len(words), n),
        _root(times.max(initial=0), n),
        _root(times @ (times - 1), n * (n - 1)),
        float(np.log1p(chars / max(n_lines, 1))),
        _root(len(lines), n_lines),
    ]


def _measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([statistics(t) for t in texts])


def measured(text: str = "text") -> Column:
    """The statistics of a text column; a null text is empty."""
    return F.pandas_udf(_measured, "array<double>")(text_of(text).cast("binary"))


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample that is fitted, and how strongly covariances are shrunk."""

    per_label: int = 10_000
    to_pooled: float = 2.0
    to_diagonal: float = 0.5
    floor: float = 1e-2


class Discriminant:
    """Two normal densities over standardised statistics, with their Cholesky factors ready."""

    def __init__(self, values: np.ndarray, labels: np.ndarray, settings: Settings = Settings()):
        self.share = float((labels.sum() + 1) / (len(labels) + 2))
        self.densities: list[tuple[np.ndarray, np.ndarray, float]] = []
        if len(set(labels.tolist())) < 2:
            return  # nothing to tell apart: every score is the share of label 1
        d = values.shape[1]
        self.centre, self.scale = values.mean(axis=0), np.maximum(values.std(axis=0), 1e-9)
        z = (values - self.centre) / self.scale
        groups = [z[labels == k] for k in (0, 1)]
        means = [g.mean(axis=0) for g in groups]
        scatter = [(g - m).T @ (g - m) for g, m in zip(groups, means)]
        pooled = (scatter[0] + scatter[1]) / len(z)
        pooled = _shrunk(pooled, np.diag(np.diag(pooled)), len(z), settings.to_diagonal * d)
        for g, mean, s in zip(groups, means, scatter):
            covariance = _shrunk(s / len(g), pooled, len(g), settings.to_pooled * d) + settings.floor * np.eye(d)
            factor = np.linalg.cholesky(covariance)
            # The inverse of a triangular factor is cached too: a distance is then one product.
            self.densities.append((mean, np.linalg.inv(factor).T, float(np.log(np.diag(factor)).sum())))

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Between 0 and 1, one for each row of statistics."""
        if not self.densities:
            return np.full(len(values), self.share)
        z = (values - self.centre) / self.scale
        logs = [-0.5 * np.square((z - mean) @ inverse).sum(axis=1) - size for mean, inverse, size in self.densities]
        odds = logs[1] - logs[0] + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _shrunk(own: np.ndarray, target: np.ndarray, rows: int, strength: float) -> np.ndarray:
    weight = rows / (rows + strength)
    return weight * own + (1 - weight) * target


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Whether a document's label is kept from training; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def fit(texts: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Discriminant:
    """A discriminant from `texts` (doc_id, values) and `labels` (doc_id, quality).

    Of each label the `per_label` ids with the smallest hashes are taken, and at most that many of their rows, so neither
    repeated labels nor repeated documents make the sample grow. Ids and labels that are null, and other labels, are left out.
    """
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    found = []
    for label in (0, 1):
        ids = named.filter(F.col("doc_id").isNotNull() & (F.col("quality") == label)).distinct()
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.per_label)
        rows = texts.join(F.broadcast(ids), "doc_id").select("quality", "values", F.xxhash64("doc_id", "values").alias("h"))
        found.append(rows.orderBy("h", "values").limit(settings.per_label).toPandas())
    sample = pd.concat(found, ignore_index=True)
    values = np.array(sample["values"].tolist(), float).reshape(-1, len(STATISTICS))
    return Discriminant(values, sample["quality"].to_numpy(int), settings)


def score(texts: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score of every row of `texts` (doc_id, values)."""

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series(model.scores(np.array(values.tolist(), float).reshape(-1, len(STATISTICS))))

    return texts.select("doc_id", F.pandas_udf(scored, "double")("values").alias("score"))


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) for every row of `docs` (doc_id, text).

    Fitted on `labels` (doc_id, quality: 0 or 1). Only texts are looked at to score; a null text is empty, and empty texts
    have the score of their statistics, all zero. Where the labelled documents do not have both labels, every score is
    the share of label 1 among them (with one of each added). Repeated rows are scored each; no documents give no rows.
    """
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), measured().alias("values")), "quality-values")
    return score(texts, fit(texts, labels, settings))


def op11_quality_classifier(spark, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels of documents that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    scored = quality_scores(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
