"""Language identification by a byte convolutional network, trained here in numpy.

Bytes are embedded, filters of several widths run over a window of fixed length, each filter keeps its largest response
in the window, and a softmax over these gives the language. A text is cut into windows that overlap by the widest
filter, so no run of bytes is missed; its prediction is the mean of its windows' log-probabilities, weighted by length.

Training takes a bounded sample on the driver: at most about `docs_per_lang` documents a language, fewer where there are so
many languages that the whole would go beyond `docs`, a few crops of each. Every language is learned. Everything else is applied to all rows, in batches of windows inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import row_struct, table

PAD = 256
UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """The network, its training, and the bounds of the sample it is fitted on."""

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embedding: int = 8
    docs_per_lang: int = 400
    docs: int = 80_000
    crops: int = 3
    steps: int = 700
    batch: int = 64
    rate: float = 4e-3
    seed: int = 3

    @property
    def stride(self) -> int:
        return self.window - max(self.widths) + 1


class Network:
    """Embedding, convolutions, maxima and softmax. Parameters are float32 arrays, so that it travels to the tasks."""

    def __init__(self, labels: list[str], settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.labels, self.settings = labels, settings
        draw = lambda *shape: rng.standard_normal(shape).astype(np.float32)
        d, f = settings.embedding, settings.filters
        self.parameters = {"bytes": draw(257, d) * 0.5}
        for w in settings.widths:
            self.parameters[f"conv{w}"] = draw(w * d, f) / np.float32(np.sqrt(w * d))
            self.parameters[f"bias{w}"] = np.zeros(f, np.float32)
        features = f * len(settings.widths)
        self.parameters["out"] = draw(features, len(labels)) / np.float32(np.sqrt(features))
        self.parameters["out_bias"] = np.zeros(len(labels), np.float32)

    def _features(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, dict]:
        """The largest responses of all filters, at least zero; with `where`, what training needs about them."""
        p, d = self.parameters, self.settings.embedding
        embedded = p["bytes"][windows]
        found, kept = [], {}
        for w in self.settings.widths:
            patches = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1).transpose(0, 1, 3, 2)
            n, places = patches.shape[:2]
            responses = (patches.reshape(n * places, w * d) @ p[f"conv{w}"]).reshape(n, places, -1)
            if where:
                kept[w] = responses.argmax(axis=1)
            found.append(np.maximum(responses.max(axis=1) + p[f"bias{w}"], 0))
        return np.concatenate(found, axis=1), kept

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        features, _ = self._features(windows)
        return _log_softmax(features @ self.parameters["out"] + self.parameters["out_bias"])

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, s = self.parameters, self.settings
        features, where = self._features(windows, True)
        error = np.exp(_log_softmax(features @ p["out"] + p["out_bias"]))
        error[np.arange(len(labels)), labels] -= 1
        error /= len(labels)
        grads = {"out": features.T @ error, "out_bias": error.sum(axis=0), "bytes": np.zeros_like(p["bytes"])}
        back = (error @ p["out"].T) * (features > 0)
        rows = np.arange(len(windows))[:, None]
        for i, w in enumerate(s.widths):
            g = back[:, i * s.filters : (i + 1) * s.filters]
            spans = windows[rows[:, :, None], where[w][:, :, None] + np.arange(w)]  # the bytes that gave the maxima
            patches = p["bytes"][spans].reshape(len(windows), s.filters, -1)
            grads[f"conv{w}"] = np.einsum("nfk,nf->kf", patches, g)
            grads[f"bias{w}"] = g.sum(axis=0)
            down = (g[:, :, None] * p[f"conv{w}"].T[None]).reshape(len(windows), s.filters, w, s.embedding)
            np.add.at(grads["bytes"], spans, down)
        return grads

    def train(self, windows: np.ndarray, labels: np.ndarray) -> None:
        """Adam over shuffled batches; a window is seen in another shorter part each time, as texts may be short."""
        s, rng = self.settings, np.random.default_rng(self.settings.seed + 1)
        first = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        second = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        order = np.zeros(0, int)
        for step in range(1, s.steps + 1):
            if len(order) < s.batch:
                order = np.concatenate([order, rng.permutation(len(labels))])
            some, order = order[: s.batch], order[s.batch :]
            size = int(rng.integers(16, windows.shape[1] + 1))
            grads = self.gradients(windows[some][:, :size], labels[some])
            rate = s.rate * (1 - step / (s.steps + 1))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                self.parameters[k] = (self.parameters[k] - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of whole texts; a row per text, uniform for an empty one."""
        s = self.settings
        sums = np.zeros((len(texts), len(self.labels)))
        total = np.zeros(len(texts))
        for windows, owner, size in _windows(texts, s.window, s.stride):
            logs = self.log_probabilities(windows)
            np.add.at(sums, owner, logs * size[:, None])
            np.add.at(total, owner, size)
        return np.exp(_log_softmax(sums / np.maximum(total, 1)[:, None]))


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _windows(
    texts: list[bytes], window: int, stride: int, most: int = 128
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All windows of the texts in batches: bytes (padded), the text each belongs to, and its length."""
    held, owner, size = [], [], []
    for i, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        for at in range(0, max(1, len(data) - (window - stride)), stride):
            part = data[at : at + window]
            if not len(part):
                continue
            row = np.full(window, PAD, np.int16)
            row[: len(part)] = part
            held.append(row)
            owner.append(i)
            size.append(len(part))
            if len(held) == most:
                yield np.stack(held), np.array(owner), np.array(size, float)
                held, owner, size = [], [], []
    if held:
        yield np.stack(held), np.array(owner), np.array(size, float)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a document is kept from training; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Network:
    """A network fitted on a bounded sample of `labelled` (doc_id, text, lang).

    Rows without lang, text, or a letter in it are left out before anything is counted. Every other lang is learned.
    Of each the rows with the smallest hashes of id and text are taken, copies once, so null or repeated ids make no
    difference. Without any rows there are no labels, and every text is undetermined.
    """
    rows = labelled.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    found = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min("h").alias("first"))
    counts = found.orderBy("lang").collect()  # a row a language
    if not counts:
        return Network([], settings)
    # Each language is thinned by a hash to about its bound before anything is collected.
    most = max(1, min(settings.docs_per_lang, settings.docs // len(counts)))
    rate = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], max(1, row["n"]))])
    first = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], row["first"])])
    one = F.col("h") == F.element_at(first, F.col("lang"))  # so that no language is left out by chance
    chosen = rows.filter((F.pmod("h", F.element_at(rate, F.col("lang"))) < most) | one)
    starts = F.greatest(F.lit(1), F.length("text") - settings.window)
    crops = [
        F.substr("text", (F.pmod(F.xxhash64("h", F.lit(i)), starts) + 1).cast("int"), F.lit(settings.window))
        for i in range(settings.crops)
    ]
    once = chosen.groupBy("lang", "h").agg(F.min(F.array(*crops)).alias("crops"))
    sample = once.orderBy("h", "lang").limit((2 * most + 1) * len(counts)).toPandas()
    sample = sample.sort_values(["lang", "h"])
    labels = sorted(sample["lang"].unique())
    network = Network(labels, settings)
    if labels:
        texts = [c.encode()[: settings.window] for crop in sample["crops"] for c in crop]
        windows = np.concatenate([w for w, _, _ in _windows([t or b" " for t in texts], settings.window, settings.window)])
        at = {lang: i for i, lang in enumerate(labels)}
        network.train(windows, np.repeat([at[x] for x in sample["lang"]], settings.crops))
    return network


def language(network: Network, text: str = "text") -> Column:
    """A struct (lang, score) for a text column: a learned label, or `und` with score 0 for a null text, one without a
    letter, or a network without labels."""
    undetermined = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    if not network.labels:
        return undetermined

    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = [any(map(str.isalpha, t)) for t in texts]
            probabilities = network.predict([t.encode() if k else b"" for t, k in zip(texts, known)])
            best = probabilities.argmax(axis=1)
            names = [network.labels[i] if k else UNDETERMINED for i, k in zip(best, known)]
            yield pd.DataFrame({"lang": names, "score": np.where(known, probabilities[np.arange(len(best)), best], 0.0)})

    return F.pandas_udf(label, "lang string, score double")(F.coalesce(F.col(text).cast("string"), F.lit("")))


def predict(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, lang_pred, score for every row of `docs` (doc_id, text).

    Only the text decides. Repeated rows and null ids make no difference; other columns are not looked at.
    """
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), language(network).alias("told"))
    return told.select("doc_id", F.col("told.lang").alias("lang_pred"), F.col("told.score").alias("score"))


def accepted(docs: DataFrame, settings: Settings = Settings(), least: float = 0.3) -> DataFrame:
    """The rows of `docs` (doc_id, text, lang) whose language a network fitted on them tells with that score at least."""
    network = fit(docs.filter(~held_out()), settings)
    told = docs.select(row_struct(docs).alias("row"), language(network).alias("told"))
    return told.filter((F.col("told.lang") != UNDETERMINED) & (F.col("told.score") >= least)).select("row.*")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score; the network learns from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    network = fit(docs.filter(~held_out()))
    told = predict(docs, network)
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
