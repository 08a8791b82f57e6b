"""Language identification (operator 3): sparse multinomial logistic
regression on TF-IDF character n-grams, trained with
follow-the-regularised-leader (FTRL-proximal, McMahan et al. 2013) under
elastic-net penalties, then calibrated by a temperature.

Document frequencies are counted over every training text.  The weights are
fitted on a sample of about ``sample_rows`` distinct texts, as many of each
label as of the others where there are so many, at least ``least``; one part of
the sample, never fitted on, sets the temperature.  Probabilities are set to
the table's shares of the labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivernet.llm.common import fold, ship

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = regex.compile(r"\p{L}")
#: Odd multipliers that mix the characters of an n-gram.
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def ngram_counts(text: str, bits: int, orders: tuple[int, ...]) -> np.ndarray:
    """Counts of hashed character n-grams of the lower-cased letters, one
    blank standing for each stretch of other characters."""
    codes = np.frombuffer((" " + _NOT_LETTERS.sub(" ", text.lower()) + " ")
                          .encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = []
    for n in orders:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, dtype=np.uint32)
            for k in range(n):
                h = (h ^ codes[k:len(codes) - n + 1 + k]) * _MIX[k % 3]
                h ^= h >> np.uint32(15)
            found.append(h & np.uint32((1 << bits) - 1))
    return np.bincount(np.concatenate(found) if found else np.zeros(0, np.uint32), minlength=1 << bits)


def features(text: str, idf: np.ndarray, bits: int, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of a TF-IDF vector of length one."""
    counts = ngram_counts(text, bits, orders)
    at = np.flatnonzero(counts)
    value = counts[at] * idf[at]
    norm = np.sqrt(value @ value)
    return at, (value / norm if norm > 0 else value).astype(np.float32)


@dataclass
class Ftrl:
    """FTRL-proximal for softmax regression on sparse rows."""

    size: int
    classes: int
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.z = np.zeros((self.size, self.classes))
        self.n = np.zeros((self.size, self.classes))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(value @ w)
        p[label] -= 1
        g = np.outer(value, p)
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, on a fine geometric grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.02, 5, 111)
    rows = np.arange(len(labels))
    loss = [-np.log(np.maximum(softmax(logits / t)[rows, labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


@dataclass
class LanguageModel:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bits: int
    orders: tuple[int, ...]
    prior: np.ndarray  # log of each class's share of the table over that of the sample

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language and its probability; ``und`` and 0 for a
        text without a letter, or if nothing was learned.  Ties go to the
        language that sorts first."""
        if not self.classes or not _LETTER.search(text):
            return "und", 0.0
        at, value = features(text, self.idf, self.bits, self.orders)
        p = softmax(value @ self.weights[at] / self.temperature + self.prior)
        best = int(p.argmax())
        return self.classes[best], min(1.0, float(p[best]))


def document_frequency(train: DataFrame, bits: int, orders: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed n-gram, and documents, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                df += ngram_counts(text, bits, orders) > 0
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()),
                                          pa.array(np.append(df[at], n), pa.int64())], ["feature", "n"])

    # at most 2**bits + 1 rows, however large the table
    rows = (train.select("text").mapInArrow(run, "feature bigint, n bigint")
            .groupBy("feature").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros((1 << bits) + 1, dtype=np.int64)
    out[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return out[:-1], int(out[-1])


def share_out(sizes: list[int], rows: int, least: int) -> int:
    """The largest number such that taking so many of each size, or all, takes
    at most ``rows``; ``least`` if that is larger."""
    left, each = rows, 0
    for k, n in enumerate(sorted(sizes)):
        each = left // (len(sizes) - k)
        if n > each:
            break
        left -= n
        each = n
    return max(each, least)


def train_language_model(train: DataFrame, sample_rows: int = 10_000, bits: int = 15,
                         orders: tuple[int, ...] = (2, 3), epochs: int = 3, least: int = 20) -> LanguageModel:
    """Fit on columns doc_id, text, label (label not null, text not null)."""
    df, n = document_frequency(train, bits, orders)
    idf = np.log((1 + n) / (1 + df)) + 1
    # a hash of label and text: a text that is repeated stands in the sample once
    hashed = train.withColumn("order", F.xxhash64("label", "text"))
    # one row for each label
    sizes = (hashed.groupBy("label").agg(F.count("*").alias("n"), F.approx_count_distinct("order").alias("texts"))
             .orderBy("label").collect())
    if not sizes:
        return LanguageModel([], idf, np.zeros((1 << bits, 0)), 1.0, bits, orders, np.zeros(0))
    each = share_out([r["texts"] for r in sizes], sample_rows, least)
    parts = 1 << 30
    # a third more than wanted, since the numbers of texts are estimates; few are taken whole
    limits = [(r["label"], int(min(1.0, (1.33 * each + 100) / max(r["texts"], 1)) * parts)) for r in sizes]
    limit = F.broadcast(train.sparkSession.createDataFrame(limits, "of string, below bigint"))
    picked = (hashed.join(limit, F.col("label") == F.col("of"), "inner")
              .where(F.pmod("order", F.lit(parts)) < F.col("below")).dropDuplicates(["label", "order"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t, idf, bits, orders) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"),
                 pa.array([a.astype(np.int32).tobytes() for a, _ in rows], pa.binary()),
                 pa.array([v.tobytes() for _, v in rows], pa.binary())], ["order", "label", "at", "value"])

    sample = (picked.select("order", "label", "text")
              .mapInArrow(run, "order bigint, label string, at binary, value binary")
              .toPandas().sort_values(["order", "label"], kind="stable"))
    rank = sample.groupby("label").cumcount().to_numpy()
    sample, rank = sample[rank < each], rank[rank < each]
    classes = [r["label"] for r in sizes]
    labels = np.array([classes.index(x) for x in sample["label"]], dtype=np.int64)
    rows = [(np.frombuffer(a, np.int32), np.frombuffer(v, np.float32))
            for a, v in zip(sample["at"], sample["value"], strict=True)]
    held = rank % 5 == 4
    model = Ftrl(1 << bits, len(classes))
    for _ in range(epochs):
        for i in np.flatnonzero(~held):
            model.learn(*rows[i], int(labels[i]))
    weights = model.weights()
    logits = np.array([v @ weights[a] for a, v in (rows[i] for i in np.flatnonzero(held))])
    # the sample takes labels alike; the probability is that of the table's shares
    share = np.array([r["n"] for r in sizes]) / sum(r["n"] for r in sizes)
    prior = np.log(share * len(labels) / np.bincount(labels, minlength=len(classes)))
    return LanguageModel(classes, idf, weights, temperature(logits, labels[held]), bits, orders, prior)


def identify_language(docs: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id",
                      text_col: str = "text", label_col: str = "lang", **training: int) -> DataFrame:
    """Train on the rows of ``docs`` where ``learn_from`` holds, then predict all.

    One row per row of ``docs``: doc_id, held_out, lang_pred, score.
    ``learn_from`` defaults to crc32(doc_id as text) mod 3 <> 1.  A text that
    is null, empty or without a letter is ``und`` with score 0 and is not
    learned from; so is every text of a table without labelled rows.  Repeated
    rows are predicted alike; other columns are not read.
    """
    ship(docs.sparkSession)
    learn = F.coalesce(learn_from if learn_from is not None else fold(docs[id_col], 3) != 1, F.lit(False))
    named = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                        docs[label_col].cast("string").alias("label"), (~learn).alias("held_out"))
    train = named.where(~F.col("held_out") & F.col("label").isNotNull()
                        & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "label")
    shared = docs.sparkSession.sparkContext.broadcast(train_language_model(train, **training))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    kind = named.schema["doc_id"].dataType.simpleString()
    return named.select("doc_id", "text", "held_out").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
