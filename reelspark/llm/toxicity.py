"""Toxicity: a convolutional classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.llm.common import alnum_words, free_name, query, table, written

#: Rows of the hashed embedding table, for words and again for their beginnings.
ROWS = 1 << 17
STEM = 4
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 16
#: Documents of the fit that must have an embedding row's words; rows of fewer stay zero, so that rare words say nothing.
LEAST_DOCS = 4
#: Labelled rows that the fit takes at most, of each label, and words of a row it takes (longer rows are left to others).
FIT_ROWS = {1: 2500, 0: 5000}
FIT_WORDS = 3000
#: Passes over the training rows, and steps of a small batch that a small table takes at least.
EPOCHS, STEPS = 10, 1500
#: Words that are scored at once; a longer text is scored in parts whose maxima are joined.
PART = 30_000
#: Languages that get a threshold of their own, at most, and toxic rows needed for one.
LANGUAGES = 256
LEAST_TOXIC = 20
#: Labelled rows are counted by logit, in cells of 1 / CELLS, up to FAR from 0 either way.
CELLS, FAR = 256, 64


class WordIds(dict):
    """Embedding rows of a word: its own and its beginning's, by crc32, in one number. Kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        own = zlib.crc32(word) % ROWS
        stem = ROWS + zlib.crc32(word[:STEM]) % ROWS
        self[word] = ids = own << 32 | stem
        return ids


def word_ids(text: str | None, memo: WordIds) -> np.ndarray:
    words = alnum_words(text)
    return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))


def _pool_input(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts with `pad` empty places (-1) behind each, their starts, and a mask of real words."""
    gap = np.full(pad, -1)
    ids = np.concatenate([x for t in texts for x in (t, gap)]) if texts else gap[:0]
    starts = np.cumsum([0, *[len(t) + pad for t in texts]])[:-1]
    return ids, starts, ids >= 0


@dataclass
class Cnn:
    """Embeddings, a filter bank for each width, and the weights of the pooled filters."""

    table: np.ndarray
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def __getstate__(self) -> dict:
        """Without the rows of the table that are zero, which are most."""
        used = np.flatnonzero(self.table.any(1))
        return {**self.__dict__, "table": (used.astype("i4"), self.table[used])}

    def __setstate__(self, state: dict) -> None:
        used, rows = state.pop("table")
        self.__dict__.update(state, table=np.zeros((2 * ROWS, DIM), "f4"))
        self.table[used] = rows

    @classmethod
    def new(cls, seed: int = 7) -> Cnn:
        rng = np.random.default_rng(seed)
        banks = [rng.normal(0, 0.3, (w * DIM, FILTERS)).astype("f4") for w in WIDTHS]
        return cls(
            rng.normal(0, 0.1, (2 * ROWS, DIM)).astype("f4"), banks, [np.zeros(FILTERS, "f4") for _ in WIDTHS],
            rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype("f4"))

    def embed(self, ids: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Embeddings, and empty places behind the end for the widest filter."""
        x = np.zeros((len(ids) + WIDTHS[-1] - 1, DIM), "f4")
        there = ids[real]
        x[:len(ids)][real] = self.table[there >> 32] + self.table[there & 0xFFFFFFFF]
        return x

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """Largest output of each filter over each text, 0 for a text without words."""
        out = np.zeros((len(texts), FILTERS * len(WIDTHS)), "f4")
        batch: list[tuple[int, np.ndarray]] = []
        held = 0

        def flush() -> None:
            if batch:
                np.maximum.at(out, [k for k, _ in batch], self._maxima([p for _, p in batch]))
                batch.clear()

        for k, ids in enumerate(texts):
            for at in range(0, len(ids), PART):
                part = ids[at:at + PART + WIDTHS[-1] - 1]
                if held + len(part) > 2 * PART:
                    flush()
                    held = 0
                batch.append((k, part))
                held += len(part)
        flush()
        return out

    def _maxima(self, texts: list[np.ndarray]) -> np.ndarray:
        ids, starts, real = _pool_input(texts, WIDTHS[-1])
        x = self.embed(ids, real)
        outs = []
        for w, bank, bias in zip(WIDTHS, self.banks, self.biases):
            z = sum(x[j:j + len(ids)] @ bank[j * DIM:(j + 1) * DIM] for j in range(w)) + bias
            np.maximum(z, 0, out=z)
            z[~real] = 0
            outs.append(np.maximum.reduceat(z, starts, axis=0))
        return np.hstack(outs)

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.pooled(texts).astype("f8") @ self.weights.astype("f8") + self.bias

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(texts) + self.shift, -40, 40)))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS,
            rate: float = 0.1, size: int = 32, seed: int = 11) -> None:
        """Minimise weighted log loss by Adagrad in small batches; only the winning window of a filter has a gradient."""
        rng = np.random.default_rng(seed)
        seen = np.zeros(len(self.table), np.int64)
        for t in texts:
            seen[np.unique(np.concatenate([t >> 32, t & 0xFFFFFFFF]))] += 1
        known = seen >= LEAST_DOCS
        self.table[~known] = 0
        state = {k: np.full_like(v, 0.1) for k, v in self._parts().items()}
        for _ in range(max(epochs, STEPS * size // max(1, len(texts)))):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), size):
                some = order[at:at + size]
                self._step([texts[k] for k in some], labels[some], weight[some], rate, state, known)

    def _parts(self) -> dict:
        return {"table": self.table, "weights": self.weights,
                **{("bank", i): b for i, b in enumerate(self.banks)}, **{("bias", i): b for i, b in enumerate(self.biases)},
                "bias": np.array([self.bias])}

    def _step(self, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rate: float, state: dict,
              known: np.ndarray) -> None:
        ids, starts, real = _pool_input(texts, WIDTHS[-1])
        ends = starts + [max(1, len(t)) for t in texts]
        x = self.embed(ids, real)
        pooled, wins = [], []
        for w, bank, bias in zip(WIDTHS, self.banks, self.biases):
            z = sum(x[j:j + len(ids)] @ bank[j * DIM:(j + 1) * DIM] for j in range(w)) + bias
            z[~real] = 0
            top = np.stack([z[a:b].argmax(0) + a for a, b in zip(starts, ends)])
            wins.append(top)
            pooled.append(np.maximum(np.take_along_axis(z, top.reshape(-1, FILTERS), 0), 0))
        h = np.hstack(pooled)
        p = 1 / (1 + np.exp(-np.clip(h @ self.weights + self.bias, -30, 30)))
        error = ((p - labels) * weight / len(texts)).astype("f4")

        def move(name, values: np.ndarray, gradient: np.ndarray) -> None:
            state[name] += gradient * gradient
            values -= rate * gradient / np.sqrt(state[name])

        grad_h = error[:, None] * self.weights * (h > 0)
        rows, grads = [], []
        banks = []
        for i, (w, bank) in enumerate(zip(WIDTHS, self.banks)):
            g = grad_h[:, i * FILTERS:(i + 1) * FILTERS].reshape(-1)
            places = wins[i].reshape(-1)
            which = np.tile(np.arange(FILTERS), len(texts))
            seen = np.hstack([x[places + j] for j in range(w)])
            grad_bank = np.zeros_like(bank)
            np.add.at(grad_bank.T, which, seen * g[:, None])
            back = bank.T[which] * g[:, None]
            for j in range(w):
                spots = np.minimum(places + j, len(ids) - 1)
                there = real[spots] & (places + j < len(ids)) & (g != 0)
                for part in (ids[spots[there]] >> 32, ids[spots[there]] & 0xFFFFFFFF):
                    learns = known[part]
                    rows.append(part[learns])
                    grads.append(back[there, j * DIM:(j + 1) * DIM][learns])
            banks.append((i, grad_bank + 1e-5 * bank, g.reshape(-1, FILTERS).sum(0)))
        move("weights", self.weights, h.T @ error + 1e-4 * self.weights)
        bias = np.array([self.bias])
        move("bias", bias, np.array([error.sum()]))
        self.bias = float(bias[0])
        for i, grad_bank, grad_bias in banks:
            move(("bank", i), self.banks[i], grad_bank)
            move(("bias", i), self.biases[i], grad_bias)
        touched, at = np.unique(np.concatenate(rows), return_inverse=True)
        total = np.zeros((len(touched), DIM), "f4")
        np.add.at(total, at, np.concatenate(grads))
        state["table"][touched] += total * total
        self.table[touched] -= rate * total / np.sqrt(state["table"][touched])

    def calibrate(self, z: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> None:
        """Scale and shift the logit to probabilities by `clean` and `toxic` rows counted at each logit, and set the
        threshold of all rows where it separates the labels best."""
        if clean.sum() and toxic.sum():
            # smoothed targets and a weak pull towards a scale of 1 keep separable rows from driving the scale away
            z2, weight = np.concatenate([z, z]), np.concatenate([clean, toxic]).astype("f8")
            y = np.repeat([1 / (clean.sum() + 2), 1 - 1 / (toxic.sum() + 2)], len(z))

            def loss(v: np.ndarray) -> float:
                u = v[0] * z2 + v[1]
                return float((weight * (np.logaddexp(0, u) - y * u)).sum() + (v[0] - 1) ** 2 / 2)

            v = np.array([1.0, 0.0])
            for _ in range(100):  # Newton's method on two numbers, steps halved until they help
                p = 1 / (1 + np.exp(-np.clip(v[0] * z2 + v[1], -30, 30)))
                g = np.array([((p - y) * weight * z2).sum() + v[0] - 1, ((p - y) * weight).sum()])
                c = weight * p * (1 - p)
                step = np.linalg.solve(np.array([[(c * z2 * z2).sum() + 1, (c * z2).sum()], [(c * z2).sum(), c.sum() + 1e-6]]), g)
                while abs(step).max() > 1e-9 and loss(v - step) > loss(v):
                    step = step / 2
                v = v - step
                if abs(step).max() < 1e-9:
                    break
            if v[0] > 0:
                self.scale, self.shift = float(v[0]), float(v[1])
        self.threshold = self.threshold_at(z, clean, toxic)

    def threshold_at(self, z: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
        """The score that separates counted rows best."""
        if not clean.sum() or not toxic.sum():
            return self.threshold
        there = [np.flatnonzero(clean), np.flatnonzero(toxic)]
        at, y = np.concatenate([z[k] for k in there]), np.repeat([0, 1], [len(k) for k in there])
        cut = _best_threshold(at, y, np.concatenate([clean[there[0]], toxic[there[1]]]).astype("f8"), 0.0)
        if cut <= at.min():
            cut = at.min() - 0.5 / CELLS  # the lowest cell as a whole
        return float(1 / (1 + np.exp(-np.clip(self.scale * cut + self.shift, -40, 40))))


def _best_threshold(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray, otherwise: float) -> float:
    """Middle of the gap between two scores where F1 is best."""
    if len(set(labels)) < 2:
        return otherwise
    order = np.argsort(-scores, kind="stable")
    s, y, w = scores[order], labels[order], weight[order]
    hit, found = np.cumsum(y * w), np.cumsum(w)
    f1 = 2 * hit / (found + (labels * weight).sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores go together
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fitted(docs: DataFrame, labels: DataFrame) -> Cnn:
    """A classifier fitted on labelled documents whose crc32 remainder is not 0.

    At most FIT_ROWS rows of each label are taken, in the order of a hash of doc_id, and of these rows those of at most
    FIT_WORDS words, which bounds the one task that trains. Of these, rows of remainders above 1 train, with even weight on
    both labels. All labelled rows of remainder 1, of any length, calibrate. Rows without id or label count as unlabelled; of contradictory
    labels the larger holds. Without rows of both labels the classifier stays near an even score."""
    learn = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0))
    learn = learn.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    some = [learn.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in FIT_ROWS.items()]

    @F.pandas_udf("array<bigint>")
    def ids(texts: pd.Series) -> pd.Series:
        memo = WordIds()
        return pd.Series([word_ids(t, memo) for t in texts], index=texts.index)

    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(some[0].union(some[1])), "doc_id")
    rows = rows.filter(remainder(F.col("doc_id")) > 1).select("doc_id", "toxic", ids("text").alias("ids"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in zip(*(b[c].to_pylist() for c in ("doc_id", "toxic")), _arrays(b["ids"]))),
                     key=lambda r: r[:2])
        y = np.array([r[1] for r in got], int)
        taken = {k: max(1, int((y == k).sum())) for k in (0, 1)}
        even = np.where(y == 1, 0.5 / taken[1], 0.5 / taken[0]) * len(y)  # calibration brings the true shares back
        model = Cnn.new()
        if len(set(y)) == 2:
            model.fit([r[2] for r in got], y, even)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    # the bounded sample trains in one task, so that the driver holds the finished model alone
    done = rows.filter(F.size("ids") <= FIT_WORDS).repartition(1).mapInArrow(train, "model binary").first()
    model = pickle.loads(bytes(done["model"])) if done else Cnn.new()
    check = learn.filter(remainder(F.col("doc_id")) == 1)
    return calibrated(model, docs.select("doc_id", "text", "lang").join(check, "doc_id"))


def calibrated(model: Cnn, rows: DataFrame) -> Cnn:
    """The model with scale, shift and thresholds from all `rows` (text, lang, toxic), counted by language and logit."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("int")
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = WordIds()
        for texts in batches:
            parts = [
                shared.value.logits([word_ids(t, memo) for t in texts.iloc[k:k + 500]]) for k in range(0, len(texts), 500)]
            z = np.concatenate(parts) if parts else np.zeros(0)
            yield pd.Series(np.rint(np.clip(z, -FAR, FAR) * CELLS).astype("i4"))

    counts = written(rows.select(F.coalesce("lang", F.lit("")).alias("lang"), "toxic", cell("text").alias("cell")).groupBy(
        "lang", "cell").agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")))
    # no more rows than cells, whatever the input
    total = counts.groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).orderBy("cell").toPandas()
    model.calibrate(total["cell"].to_numpy() / CELLS, total["clean"].to_numpy("i8"), total["toxic"].to_numpy("i8"))
    basis = (model.scale, model.shift, model.threshold)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        at = Cnn(*[np.zeros(0)] * 4, scale=basis[0], shift=basis[1], threshold=basis[2])
        group = group.sort_values("cell")
        t = at.threshold_at(group["cell"].to_numpy() / CELLS, group["clean"].to_numpy(), group["toxic"].to_numpy())
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "threshold": [t]})

    named = counts.groupBy("lang").agg(F.sum("toxic").alias("n")).filter(F.col("n") >= LEAST_TOXIC)
    named = named.orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    own = counts.join(F.broadcast(named), "lang", "left_semi").groupBy("lang").applyInPandas(one, "lang string, threshold double")
    model.thresholds = {r["lang"]: r["threshold"] for r in own.collect()}
    return model


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [flat[a:b].copy() for a, b in zip(at, at[1:])]


def scored(docs: DataFrame, model: Cnn, out: str = "score") -> DataFrame:
    """All rows and columns of `docs` and `out`, the probability of label 1 from the text alone. Null and empty texts have
    the score of no words; whole texts are read; repeated rows are scored each. A column named `out` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = WordIds()
        for texts in batches:
            parts = [
                shared.value.scores([word_ids(t, memo) for t in texts.iloc[k:k + 500]]) for k in range(0, len(texts), 500)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(out, score(F.col("text")))


def threshold_of(model: Cnn, lang: Column) -> Column:
    """The threshold of a language, or that of all; at most LANGUAGES have their own."""
    known = sorted(model.thresholds.items())[:LANGUAGES]
    out = F.lit(model.threshold)
    if not known:
        return out
    by_lang = F.create_map(*[F.lit(x) for pair in known for x in pair])
    return F.coalesce(F.try_element_at(by_lang, F.coalesce(lang, F.lit(""))), out)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs` whose score is below their language's threshold, with all their columns, whatever their names.

    Null and empty texts have the score of no words; whole texts are scored, repeated rows each; a null language has the
    common threshold. An empty table gives no rows."""
    model, name = fitted(docs, labels), free_name(docs, "_score")
    return scored(docs, model, name).filter(F.col(name) < threshold_of(model, F.col("lang"))).drop(name)


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    threshold = threshold_of(model, F.col("lang"))
    return scored(docs, model).select(
        "doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), threshold.alias("threshold"),
        (F.col("score") >= threshold).alias("rejected"))
