"""Toxicity of texts by their nearest labelled examples (operator 9).

Terms are words and their beginnings.  The examples are a bounded sample of
the labelled rows; the terms that separate their classes
best form the vocabulary; document frequencies are counted over all texts.
Each text is compared with the examples by exact TF-IDF cosine: the index is
inverted by term with the largest weight of each block of examples, blocks
are visited by falling upper bound, and a block whose bound is under the k-th
best cosine so far is skipped (block-max index, Ding and Suel 2011).  The
neighbours vote with their cosine; a logistic curve fitted on examples that
are held out of the index turns the vote into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivernet.llm.common import cut, fold, lean, ship

_WORD = re.compile(r"[^\W\d_]+")
#: Words whose terms a worker keeps; beyond it the store is emptied.
KEPT_WORDS = 500_000


def word_terms(word: str) -> set[str]:
    """The word itself and its beginnings of 4 to 7 letters, each marked as such."""
    return {"=" + word} | {"^" + word[:n] for n in range(4, min(8, len(word)))}


class Vectors:
    """Term counts of texts over a fixed vocabulary."""

    def __init__(self, vocabulary: list[str]) -> None:
        self.at = {t: i for i, t in enumerate(vocabulary)}
        self.words: dict[str, tuple[int, ...]] = {}

    def counts(self, text: str) -> Counter[int]:
        out: Counter[int] = Counter()
        words = self.words
        for word in _WORD.findall(text.lower()):
            got = words.get(word)
            if got is None:
                if len(words) >= KEPT_WORDS:
                    words.clear()
                got = words[word] = tuple(sorted(self.at[t] for t in word_terms(word) if t in self.at))
            if got:
                out.update(got)
        return out


def unit(counts: Counter[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and TF-IDF weights of length one; empty if no term occurs."""
    at = np.array(sorted(counts), dtype=np.int64)
    value = np.array([1 + np.log(counts[i]) for i in at.tolist()]) * idf[at]
    norm = np.sqrt(value @ value)
    return at, value / norm if norm > 0 else value


@dataclass
class BlockMaxIndex:
    """Inverted lists of examples in blocks, with each term's largest weight."""

    rows: list[tuple[np.ndarray, np.ndarray]]
    terms: int
    block: int = 64
    largest: np.ndarray = field(init=False)
    lists: list[dict[int, tuple[np.ndarray, np.ndarray]]] = field(init=False)

    def __post_init__(self) -> None:
        n = -(-len(self.rows) // self.block)
        self.largest = np.zeros((self.terms, n))
        self.lists = []
        for b in range(n):
            lists: dict[int, list[tuple[int, float]]] = {}
            for k, (at, value) in enumerate(self.rows[b * self.block:(b + 1) * self.block]):
                for t, v in zip(at.tolist(), value.tolist(), strict=True):
                    lists.setdefault(t, []).append((k, v))
            self.lists.append({t: (np.array([k for k, _ in x]), np.array([v for _, v in x])) for t, x in lists.items()})
            for t, (_, v) in self.lists[-1].items():
                self.largest[t, b] = v.max()

    def nearest(self, at: np.ndarray, value: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k rows of largest cosine above zero, exactly; ties by row number."""
        best: list[tuple[float, int]] = []
        if not len(at) or not self.lists:
            return best
        bound = value @ self.largest[at]
        query = list(zip(at.tolist(), value.tolist(), strict=True))
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(best) == k and bound[b] < -best[-1][0] - 1e-12:
                break
            score = np.zeros(self.block)
            for t, v in query:
                if t in self.lists[b]:
                    where, weight = self.lists[b][t]
                    score[where] += v * weight
            found = np.flatnonzero(score > 0)
            best = sorted(best + [(-float(score[i]), b * self.block + i) for i in found.tolist()])[:k]
        return [(-s, i) for s, i in best]


@dataclass
class ToxicityModel:
    vocabulary: list[str]
    idf: np.ndarray
    rows: list[tuple[np.ndarray, np.ndarray]]
    labels: np.ndarray
    ids: list[int]
    k: int = 15
    rest: float = 0.0       # toxic share of examples in which no term occurs
    slope: float = 1.0
    shift: float = 0.0

    def open(self) -> None:
        self.vectors, self.index = Vectors(self.vocabulary), BlockMaxIndex(self.rows, len(self.vocabulary))

    def vote(self, counts: Counter[int]) -> tuple[float, list[int]]:
        """Share of the cosine that toxic neighbours hold, and the neighbours' ids."""
        near = self.index.nearest(*unit(counts, self.idf), self.k)
        if not near:
            return self.rest, []
        weight = np.array([s for s, _ in near])
        toxic = self.labels[[i for _, i in near]]
        # half a neighbour at the share of the rest keeps single weak matches low
        return float((weight @ toxic + 0.5 * self.rest) / (weight.sum() + 0.5)), [self.ids[i] for _, i in near]

    def score(self, text: str) -> tuple[float, list[int]]:
        vote, evidence = self.vote(self.vectors.counts(text))
        return self.calibrated(vote), evidence

    def calibrated(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * vote + self.shift))))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, with Platt's smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (p - target) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """The sample, and the number of labelled ids of each class: about ``per_class`` labelled texts of each class by a hash of the id.

    The ids of the sample, of at most twice that number each, are broadcast;
    texts repeated with one label count once."""
    known = (labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .withColumn("order", F.xxhash64("doc_id")))
    sizes = {int(r["toxic"]): r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = 1 << 30
    picked = None
    for label in (0, 1):
        limit = int(min(1.0, 1.2 * per_class / max(sizes.get(label, 0), 1)) * parts) + 1
        some = (known.where((F.col("toxic") == label) & (F.pmod("order", F.lit(parts)) < limit))
                .orderBy("order").limit(per_class))
        picked = some if picked is None else picked.unionAll(some)
    return cut(docs.join(F.broadcast(picked), "doc_id", "inner").withColumn("digest", F.sha2("text", 256))
               .dropDuplicates(["digest", "toxic"]).select("doc_id", "text", "toxic", "order"), "toxic-sample"), sizes


def choose_terms(sample: DataFrame, size: int, least: int = 5, share: float = 0.02,
                 ratio: float = 10.0) -> list[str]:
    """Terms by falling chi-square between the classes of the sample: those at
    least ``ratio`` times as frequent in one class as in the other whose
    chi-square is at least ``share`` of the largest (weaker ones are words of
    single groups of near copies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                n[label].update({t for w in set(_WORD.findall(text.lower())) for t in word_terms(w)})
                n[label][""] += 1
        terms = sorted(set(n[0]) | set(n[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([n[0][t] for t in terms], pa.int64()),
             pa.array([n[1][t] for t in terms], pa.int64())], ["term", "clean", "toxic"])

    seen = (sample.select("text", F.col("toxic").cast("int").alias("toxic"))
            .mapInArrow(lean(run), "term string, clean bigint, toxic bigint")
            .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    total = seen.where("term = ''").first()
    if total is None or not total["clean"] or not total["toxic"]:
        return []
    n0, n1 = float(total["clean"]), float(total["toxic"])
    a, b = F.col("toxic"), F.col("clean")
    chi = ((n0 + n1) * F.pow(a * (n0 - b) - b * (n1 - a), 2)
           / ((a + b) * (n0 + n1 - a - b) * n0 * n1))
    odds = F.abs(F.log((a + 0.5) / n1) - F.log((b + 0.5) / n0))
    best = (seen.where((F.col("term") != "") & (a + b >= least) & (a + b < n0 + n1) & (odds >= math.log(ratio)))
            .withColumn("chi", chi).orderBy(F.desc("chi"), "term").limit(size).collect())
    return [r["term"] for r in best if r["chi"] >= share * best[0]["chi"]]


def term_frequency(docs: DataFrame, vocabulary: list[str]) -> tuple[np.ndarray, int]:
    """Number of texts that hold each term, and of texts, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, n = Vectors(vocabulary), np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n[list(vectors.counts(text))] += 1
                n[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(n)), pa.int64()), pa.array(n, pa.int64())], ["term", "n"])

    rows = (docs.select("text").mapInArrow(lean(run), "term bigint, n bigint")
            .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    out[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return out[:-1], int(out[-1])


def train_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 2500, terms: int = 1024,
                   k: int = 15) -> ToxicityModel | None:
    """None if either class has no labelled text."""
    sample, sizes = labelled_sample(docs, labels, per_class)
    vocabulary = choose_terms(sample, terms)
    if not vocabulary:
        return None
    df, n = term_frequency(docs, vocabulary)
    idf = np.log((1 + n) / (1 + df)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(vocabulary)
        for batch in batches:
            got = [vectors.counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), batch.column("order"),
                 pa.array([list(c) for c in got], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in got], pa.list_(pa.int32()))],
                ["doc_id", "toxic", "order", "at", "n"])

    # at most 2 * per_class rows of at most ``terms`` terms
    rows = (sample.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "order", "text")
            .mapInArrow(lean(run), f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, toxic int, order bigint, "
                             "at array<int>, n array<int>").orderBy("order", "doc_id").collect())
    counts = [Counter(dict(zip(r["at"], r["n"], strict=True))) for r in rows]
    labels_of = np.array([r["toxic"] for r in rows])
    held = np.arange(len(rows)) % 5 == 4
    void = np.array([not c for c in counts])
    rest = float((labels_of[void & ~held].sum() + 0.05) / ((void & ~held).sum() + 1.0))
    kept = [i for i in range(len(rows)) if not held[i] and counts[i]]
    vectors = [unit(counts[i], idf) for i in kept]
    # alike examples side by side, so that a block's largest weights are close to its rows
    side = sorted(range(len(kept)), key=lambda j: (int(vectors[j][0][vectors[j][1].argmax()]), j))
    model = ToxicityModel(vocabulary, idf, [vectors[j] for j in side], labels_of[[kept[j] for j in side]],
                          [rows[kept[j]]["doc_id"] for j in side], k, rest)
    model.open()
    tried = np.flatnonzero(held)
    if labels_of[tried].min(initial=1) == 0 and labels_of[tried].max(initial=0) == 1:
        votes = np.array([model.vote(counts[i])[0] for i in tried])
        model.slope, model.shift = logistic(votes, labels_of[tried].astype(float))
        # the sample takes classes alike; the probability is that of the table's shares
        toxic = labels_of[tried].mean()
        model.shift += math.log(sizes[1] / sizes[0] * (1 - toxic) / toxic)
    else:
        model.slope, model.shift = 8.0, -4.0
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", carry: tuple[str, ...] = (),
                   **training: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence
    (ids of the nearest examples, nearest first), and the columns named in
    ``carry`` under names that begin with ``carry_``.

    Labels are learned from rows of ``labels`` where ``learn_from`` holds, by
    default crc32(doc_id as text) mod 5 <> 0; a null label is no label, and of
    several labels of one id the highest counts.  Null and empty texts are
    scored as texts in which no term occurs.  Without labels of both classes
    every score is 0.  Repeated rows are scored alike; other columns are not read.
    """
    ship(docs.sparkSession)
    learn = F.coalesce(learn_from if learn_from is not None else fold(labels[id_col], 5) != 0, F.lit(False))
    known = labels.where(learn).select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("toxic"))
    source = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                         *(docs[c].alias(f"carry_{c}") for c in carry))
    carried = [f"carry_{c}" for c in carry]
    model = docs.sparkSession.sparkContext.broadcast(train_toxicity(source, known, **training))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = model.value
        if trained is not None:
            trained.open()
        for batch in batches:
            rows = batch.column("text").to_pylist()
            got = [trained.score(t) if trained is not None else (0.0, []) for t in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([g[1] for g in got], pa.list_(batch.column("doc_id").type)),
                 *(batch.column(c) for c in carried)], ["doc_id", "score", "evidence", *carried])

    kind = source.schema["doc_id"].dataType.simpleString()
    more = "".join(f", {c} {source.schema[c].dataType.simpleString()}" for c in carried)
    scored = source.mapInArrow(lean(run), f"doc_id {kind}, score double, evidence array<{kind}>{more}")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", *carried)
