"""Language-model scores of whole texts (operator 10).

A log-bilinear model (Mnih and Hinton 2007) predicts the class of the next
token from the vectors of the tokens before it.  The most frequent tokens are
classes of their own; the others share classes by their last two bytes, and
inside a class a token has its add-one unigram share.  The model is trained
with noise-contrastive estimation (Mnih and Teh 2012) on every training token:
one task warms it up on a sample, then each task continues on its own part
and the parameters are averaged by number of tokens.  Scores are normalised:
batched matrix products give the whole softmax of each distinct context.

Token counts cover all training texts.  The counts of at most ``store``
most frequent tokens go to every task (a fixed bound); rarer tokens are joined to
the count table by the token itself.
"""

from __future__ import annotations

import copy
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivernet.llm.common import chunks, cut, fold, ship

#: Stands for the end of a text; no word holds a line end.
END = b"\n"
_FLUSH = 400_000
#: Classes up to which a table of class pairs is made for each place (4 MB at 1024 classes).
_TABLE = 2048


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space with A-Z lowered, and the end."""
    out = text.encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


def token_table(train: DataFrame) -> DataFrame:
    """Columns word, c over every training text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                               pa.array(list(seen.values()), pa.int64())], ["word", "c"])
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(tokens(text))
                if len(seen) > _FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    return cut(train.select("text").mapInArrow(run, "word binary, c bigint")
               .groupBy("word").agg(F.sum("c").alias("c")), "token-table")


@dataclass
class Lexicon:
    """What every task knows of the tokens."""

    at: dict[bytes, int]     # the most frequent tokens by falling count
    log_count: np.ndarray    # log10(count + 1) of each
    words: int               # so many of them are classes of their own
    tails: int               # classes of the others
    log_share: np.ndarray    # log10 of the add-one total of each of these classes
    frequency: np.ndarray    # tokens of each class
    n: int
    v: int

    def tail(self, word: bytes) -> int:
        return self.words + zlib.crc32(word[-2:]) % self.tails

    def __post_init__(self) -> None:
        self.group = np.array([i if i < self.words else self.tail(w) for w, i in self.at.items()] or [0], dtype=np.int32)

    def classes(self, words: list[bytes], index: np.ndarray) -> np.ndarray:
        out = self.group[np.maximum(index, 0)]
        for i in np.flatnonzero(index < 0).tolist():
            out[i] = self.tail(words[i])
        return out


def lexicon(table: DataFrame, words: int, tails: int, store: int) -> Lexicon:
    # the least count of which no more than ``store`` tokens have it or more
    least, room = 1 << 62, store
    for c, n in sorted(((r["c"], r["n"]) for r in table.groupBy("c").agg(F.count("*").alias("n")).collect()), reverse=True):
        if n > room:
            break
        least, room = c, room - n
    rows = table.where(F.col("c") >= least).toPandas()  # at most ``store`` rows
    rows = rows.sort_values(["c", "word"], ascending=[False, True], kind="stable") if len(rows) else rows
    top = [bytes(w) for w in rows["word"]]
    counts = rows["c"].to_numpy(dtype=np.int64)
    own = set(top[:words])
    tail = F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(tails))
    sums = (table.groupBy(tail.alias("tail")).agg(F.sum("c").alias("n"), F.count("*").alias("v"))).collect()
    n_tail, v_tail = np.zeros(tails, dtype=np.int64), np.zeros(tails, dtype=np.int64)
    for r in sums:
        n_tail[r["tail"]], v_tail[r["tail"]] = r["n"], r["v"]
    n, v = int(n_tail.sum()), int(v_tail.sum())
    for w, c in zip(top[:words], counts[:words].tolist(), strict=True):
        n_tail[zlib.crc32(w[-2:]) % tails] -= c
        v_tail[zlib.crc32(w[-2:]) % tails] -= 1
    return Lexicon({w: i for i, w in enumerate(top)}, np.log10(counts + 1.0), len(own), tails,
                   np.log10(n_tail + v_tail + 1.0), np.append(counts[:len(own)], n_tail), n, v)


class LogBilinear:
    """Vectors of classes as context and as prediction, a weight vector for
    each place of the context, and a bias for each class."""

    def __init__(self, frequency: np.ndarray, size: int = 24, context: int = 2, seed: int = 7) -> None:
        rnd = np.random.default_rng(seed)
        m = len(frequency)
        self.noise = (frequency + 1.0) / (frequency + 1.0).sum()
        self.log_noise = np.log(self.noise).astype(np.float32)
        self.p = {"given": rnd.normal(0, 0.1, (m, size)).astype(np.float32),
                  "place": np.ones((context, size), np.float32) / context,
                  "next": rnd.normal(0, 0.1, (m, size)).astype(np.float32),
                  "bias": self.log_noise.copy()}
        self.sums = {k: np.full_like(v, 1e-2) for k, v in self.p.items()}

    def _step(self, name: str, rows: np.ndarray | None, grad: np.ndarray, rate: float) -> None:
        """Adagrad; gradients of a repeated row are summed first."""
        if rows is not None:
            small = len(self.noise) <= 1 << 16
            order = np.argsort(rows.astype(np.uint16) if small else rows, kind="stable")
            rows = rows[order]
            first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            grad, rows = np.add.reduceat(grad[order], first, axis=0), rows[first]
        at = slice(None) if rows is None else rows
        self.sums[name][at] += grad * grad
        self.p[name][at] -= rate * grad / np.sqrt(self.sums[name][at])

    def learn(self, context: np.ndarray, target: np.ndarray, rnd: np.random.Generator, noise: int = 64,
              rate: float = 0.1) -> None:
        """One step of noise-contrastive estimation; the batch shares its noise."""
        p, b = self.p, len(target)
        drawn = rnd.choice(len(self.noise), noise, p=self.noise)
        log_k = np.float32(np.log(noise))
        given = p["given"][context]                                   # b, places, size
        q = np.einsum("bks,ks->bs", given, p["place"])
        ahead, beside = p["next"][target], p["next"][drawn]
        right = np.einsum("bs,bs->b", q, ahead) + (p["bias"][target] - self.log_noise[target] - log_k)
        wrong = q @ -beside.T                                         # its sign turned
        wrong -= p["bias"][drawn] - self.log_noise[drawn] - log_k
        g_right = -1 / (1 + np.exp(np.clip(right, -30, 30)))
        g_wrong = np.clip(wrong, -30, 30, out=wrong)                  # in place: 1 / (1 + exp(-wrong))
        np.exp(g_wrong, out=g_wrong)
        g_wrong += 1
        np.reciprocal(g_wrong, out=g_wrong)
        g_q = g_right[:, None] * ahead + g_wrong @ beside
        g_next = np.concatenate([g_right[:, None] * q, g_wrong.T @ q]) / np.float32(b)
        g_bias = np.concatenate([g_right, g_wrong.sum(0)]) / np.float32(b)
        g_place = np.einsum("bs,bks->ks", g_q, given) / np.float32(b)
        g_given = g_q[:, None, :] * (p["place"] / np.float32(b))
        rows = np.concatenate([target, drawn])
        self._step("next", rows, g_next, rate)
        self._step("bias", rows, g_bias, rate)
        self._step("given", context.ravel(), g_given.reshape(-1, g_given.shape[-1]), rate)
        self._step("place", None, g_place, rate)

    def log10_probabilities(self, context: np.ndarray, target: np.ndarray, block: int = 64) -> np.ndarray:
        """log10 p(target | context), each distinct context normalised once."""
        base = len(self.noise)
        key = np.zeros(len(target), dtype=np.int64)
        for k in range(context.shape[1]):
            key = key * base + context[:, k]
        order = np.argsort(key, kind="stable")
        new = np.append(True, key[order][1:] != key[order][:-1])
        group = np.cumsum(new) - 1
        starts = np.append(np.flatnonzero(new), len(target))
        contexts = context[order[new]]
        log_total = self._log_totals(contexts, block)
        own, wanted = np.empty(len(target)), target[order]
        for a in range(0, len(contexts), 32 * block):  # short rows: more of them at once
            lo, hi = starts[a], starts[min(a + 32 * block, len(contexts))]
            q = np.einsum("bks,ks->bs", self.p["given"][contexts[a:a + 32 * block]], self.p["place"])
            own[lo:hi] = np.einsum("bs,bs->b", q[group[lo:hi] - a], self.p["next"][wanted[lo:hi]])
        own += self.p["bias"][wanted]
        out = np.empty(len(target))
        out[order] = (own - log_total[group]) / np.log(10)
        return out

    def _log_totals(self, contexts: np.ndarray, block: int) -> np.ndarray:
        """log of the sum over all classes of exp(logit) of each context.

        A logit is a sum over the places, so its exp is a product: of rows of
        one table for each place, up to ``_TABLE`` classes.  Contexts whose
        product leaves the range of floats, and all where there are more
        classes, are summed from their logits."""
        out, rest = np.empty(len(contexts)), np.arange(len(contexts))
        ahead = np.ascontiguousarray(self.p["next"].T)
        if len(self.noise) <= _TABLE:
            tables, tops = [], np.zeros(len(contexts), np.float32)
            for k, weights in enumerate(self.p["place"]):
                logits = (self.p["given"] * weights) @ ahead
                if not k:
                    logits += self.p["bias"]
                top = logits.max(1)
                logits -= top[:, None]
                tops += top[contexts[:, k]]
                tables.append(np.exp(logits, out=logits))
            ones, held = np.ones(len(self.noise), np.float32), np.empty((2, block, len(self.noise)), np.float32)
            total = np.empty(len(contexts), np.float32)
            for a in range(0, len(contexts), block):
                at = contexts[a:a + block]
                product, more = held[:, :len(at)]
                np.take(tables[0], at[:, 0], axis=0, out=product, mode="clip")
                for k in range(1, len(tables)):
                    np.take(tables[k], at[:, k], axis=0, out=more, mode="clip")
                    product *= more
                np.matmul(product, ones, out=total[a:a + block])
            near = total > 1e-30
            out[near] = tops[near] + np.log(total[near].astype(np.float64))
            rest = np.flatnonzero(~near)
        for a in range(0, len(rest), block):
            at = rest[a:a + block]
            logits = (self.p["given"][contexts[at]] * self.p["place"]).sum(1) @ ahead
            logits += self.p["bias"]
            top = logits.max(1)
            logits -= top[:, None]
            out[at] = top + np.log(np.exp(logits, out=logits).sum(1).astype(np.float64))
        return out


def contexts(classes: np.ndarray, lengths: list[int], end: int, places: int) -> np.ndarray:
    """The classes before each token, nearest first; before a text stand ends."""
    out = np.empty((len(classes), places), dtype=np.int32)
    starts = np.cumsum([0, *lengths[:-1]])
    place = np.arange(len(classes)) - np.repeat(starts, lengths)
    for k in range(places):
        out[k + 1:, k] = classes[:-k - 1]
        out[place <= k, k] = end
    return out


def encoded(rows: list[str], lex: Lexicon) -> Iterator[tuple[int, list[list[bytes]], list[bytes], np.ndarray, np.ndarray]]:
    """Runs of texts: first row, tokens by text, all tokens, their place in the store, their classes."""
    for first, part in chunks(rows):
        own = [tokens(t) for t in part]
        flat = [w for text in own for w in text]
        get = lex.at.get
        index = np.array([get(w, -1) for w in flat], dtype=np.int32)
        yield first, own, flat, index, lex.classes(flat, index)


def end_class(lex: Lexicon) -> int:
    i = lex.at.get(END, -1)
    return int(lex.group[i]) if i >= 0 else lex.tail(END)


def _pack(model: LogBilinear) -> list[bytes]:
    return [model.p[k].astype(np.float32).tobytes() for k in sorted(model.p)]


def _train(data: DataFrame, lex: Lexicon, start: LogBilinear, batch_size: int, rate: float) -> DataFrame:
    """One row for each task: its tokens and its parameters after one pass."""
    shared = data.sparkSession.sparkContext.broadcast((lex, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, model = shared.value
        model = copy.deepcopy(model)  # a worker keeps the shared one for its next task
        rnd, end, seen = np.random.default_rng(11), end_class(lex), 0
        for batch in batches:
            for _, own, _, _, classes in encoded(batch.column("text").to_pylist(), lex):
                context = contexts(classes, [len(t) for t in own], end, len(model.p["place"]))
                order = rnd.permutation(len(classes))
                for a in range(0, len(order), batch_size):
                    at = order[a:a + batch_size]
                    model.learn(context[at], classes[at], rnd, rate=rate)
                seen += len(classes)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen], pa.int64())] + [pa.array([x], pa.binary()) for x in _pack(model)],
                ["tokens", *sorted(model.p)])

    schema = "tokens bigint, " + ", ".join(f"{k} binary" for k in sorted(start.p))
    return data.select("text").mapInArrow(run, schema)


def averaged(rows: DataFrame, model: LogBilinear) -> LogBilinear:
    """Parameters averaged by tokens; the averages of blocks of tasks are made
    in parallel, and the driver adds one row for each block."""
    shapes = {k: v.shape for k, v in model.p.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, {k: np.zeros(s) for k, s in shapes.items()}
        for batch in batches:
            for row in batch.to_pylist():
                total += row["tokens"]
                for k, s in shapes.items():
                    sums[k] += np.frombuffer(row[k], np.float32).reshape(s) * row["tokens"]
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([total], pa.int64())]
                + [pa.array([(sums[k] / total).astype(np.float32).tobytes()], pa.binary()) for k in sorted(shapes)],
                ["tokens", *sorted(shapes)])

    done = cut(rows, "lm-parts")
    parts = done.coalesce(8).mapInArrow(run, done.schema).collect()
    total = sum(r["tokens"] for r in parts)
    if total:
        for k, s in shapes.items():
            model.p[k] = sum(np.frombuffer(r[k], np.float32).reshape(s).astype(np.float64) * (r["tokens"] / total)
                             for r in parts).astype(np.float32)
    return model


def train_model(train: DataFrame, lex: Lexicon, warm_tokens: int, batch_size: int = 2048, context: int = 3) -> LogBilinear:
    model = LogBilinear(lex.frequency, context=context)
    if not lex.n:
        return model
    parts = 1 << 30
    share = int(min(1.0, warm_tokens / lex.n) * parts)
    # all tasks filter, by id and text (null ids are not one id); one task reads what they wrote
    picked = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) <= share)
    warm = cut(picked.select("text"), "lm-warm").coalesce(1)
    model = averaged(_train(warm, lex, model, 512, 0.1), model)
    return averaged(_train(train, lex, model, batch_size, 0.05), model)


def score_texts(docs: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                words: int = 960, tails: int = 64, store: int = 400_000, warm_tokens: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    ``learn_from`` defaults to crc32(doc_id as text) mod 7 <> 2.  A null or
    empty text has one token, its end.  Without training texts nothing is
    known and the base score is 0.  Repeated rows are scored each; other
    columns are not read.  Scores do not depend on the order of rows, but the
    model does on how the texts are cut into tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    learn = F.coalesce(learn_from if learn_from is not None else fold(docs[id_col], 7) != 2, F.lit(False))
    source = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                         (~learn).alias("held_out"))
    train = source.where(~F.col("held_out")).select("doc_id", "text")
    table = token_table(train)
    lex = lexicon(table, words, tails, store)
    shared = spark.sparkContext.broadcast((lex, train_model(train, lex, warm_tokens)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, model = shared.value
        end, places = end_class(lex), len(model.p["place"])
        context = TaskContext.get()
        row, part = 0, context.partitionId() if context else 0
        for batch in batches:
            for first, own, flat, index, classes in encoded(batch.column("text").to_pylist(), lex):
                lengths = [len(t) for t in own]
                log_p = model.log10_probabilities(contexts(classes, lengths, end, places), classes)
                log_c = np.where(index >= 0, lex.log_count[np.maximum(index, 0)], 0.0) if len(lex.log_count) \
                    else np.zeros(len(index))
                inside = classes >= lex.words
                log_p += np.where(inside, log_c - lex.log_share[np.maximum(classes - lex.words, 0)], 0.0)
                at = np.cumsum([0, *lengths[:-1]])
                rare: list[list[bytes]] = []
                for a, n in zip(at.tolist(), lengths, strict=True):
                    rare.append([flat[a + i] for i in np.flatnonzero(index[a:a + n] < 0).tolist()])
                k = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * k, pa.int32()), pa.array(range(row, row + k), pa.int64()),
                     batch.column("doc_id").slice(first, k), batch.column("held_out").slice(first, k),
                     pa.array(lengths, pa.int64()), pa.array(np.add.reduceat((index >= 0).astype(np.int64), at)),
                     pa.array(np.add.reduceat(log_c, at)), pa.array(np.add.reduceat(log_p, at)),
                     pa.array(rare, pa.list_(pa.binary()))],
                    ["part", "row", "doc_id", "held_out", "n_tokens", "n_stored", "log_c", "log_p", "rare"])
                row += k

    kind = source.schema["doc_id"].dataType.simpleString()
    scored = cut(source.mapInArrow(run, f"part int, row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, "
                                        "n_stored bigint, log_c double, log_p double, rare array<binary>"), "lm-scored")
    asked = scored.select("part", "row", F.explode("rare").alias("asked"))
    found = (asked.join(table, F.col("asked") == F.col("word"), "inner")
             .groupBy("part", "row").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("c") + 1)).alias("log_rare")))
    n_rare, log_rare = F.coalesce("n_rare", F.lit(0)), F.coalesce("log_rare", F.lit(0.0))
    return (scored.drop("rare").join(found, ["part", "row"], "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_stored") + n_rare).alias("n_known"),
                    F.lit(lex.n).cast("long").alias("train_tokens"),
                    (F.col("log_c") + log_rare - F.col("n_tokens") * F.log10(F.lit(float(lex.n + lex.v + 1)))
                     ).alias("base_score"),
                    (F.col("log_p") + log_rare).alias("score")))
