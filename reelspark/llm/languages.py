"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through
time. It labels every position; a document's probabilities are pooled over its letters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reelspark.llm.common import query, table

#: Bytes of a window, in which both directions start without memory, and state numbers of a direction.
SPAN, HIDDEN = 128, 12
#: Documents of a language and documents in all that the fit takes at most (by rank in their language), and evenly placed
#: windows of each.
FIT_LANG, FIT_ROWS, FIT_WINDOWS = 300, 8192, 8
#: Windows of a training batch, batches at most, and the mean loss of the last twenty at which training ends.
BATCH, STEPS, ENOUGH = 128, 500, 0.004
#: Numbers that a batch of windows may hold for each position's labels.
CELLS = 1 << 18
UNKNOWN = "und"

#: Bytes of letters: those of ASCII and of all other characters.
LETTER = np.array([chr(c).isalpha() if c < 128 else True for c in range(256)])


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of concatenated texts of these sizes: their text, start and length. A text is cut evenly, into as few windows
    of at most SPAN bytes as it needs; every byte is in one."""
    counts = -(-sizes // SPAN)
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    size, count = sizes[text], counts[text]
    low, high = nth * size // np.maximum(count, 1), (nth + 1) * size // np.maximum(count, 1)
    return text, np.repeat(np.cumsum(sizes) - sizes, counts) + low, high - low


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    x *= 2
    np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1
    return x


@dataclass
class BiGru:
    """Weights of both directions along the first axis: `table` (byte to gate inputs), `turn` (state to gate inputs), `bias`
    of the candidate, and `out`, `base` of the labels. Gates are stacked as update, reset, candidate; states are columns."""

    langs: list[str]
    table: np.ndarray
    turn: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: np.ndarray

    @classmethod
    def new(cls, langs: list[str], hidden: int = HIDDEN, seed: int = 5) -> BiGru:
        rng = np.random.default_rng(seed)
        c = len(langs)
        return cls(
            langs, rng.normal(0, 0.3, (2, 3 * hidden, 256)).astype("f4"),
            rng.normal(0, 1 / np.sqrt(hidden), (2, 3 * hidden, hidden)).astype("f4"), np.zeros((2, hidden, 1), "f4"),
            rng.normal(0, 0.3, (2, c, hidden)).astype("f4"), np.zeros((c, 1), "f4"))

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.turn, self.bias, self.out, self.base]

    # windows come longest first, as two byte matrices [SPAN, windows]: read forwards and backwards, both from place 0

    def states(self, both: np.ndarray, live: np.ndarray, keep: list | None = None) -> Iterator[np.ndarray]:
        """States [2, HIDDEN, live windows] after each byte; `keep` gets what backpropagation needs."""
        h3 = self.turn.shape[1] // 3
        h = np.zeros((2, h3, both.shape[2]), "f4")
        # rows of both directions' tables in one, so that a byte's gate inputs lie together
        rows = np.ascontiguousarray(self.table.transpose(0, 2, 1)).reshape(512, -1)
        both = both + np.array([0, 256])[:, None, None]
        for t in range(both.shape[1]):
            k = live[t]
            h = h[:, :, :k]
            x = np.ascontiguousarray(rows[both[:, t, :k]].transpose(0, 2, 1))
            g = self.turn @ h
            gates = x[:, :2 * h3]
            gates += g[:, :2 * h3]
            _sigmoid(gates)
            z, r = gates[:, :h3], gates[:, h3:]
            m = g[:, 2 * h3:]
            m += self.bias
            n = x[:, 2 * h3:]
            n += r * m
            _tanh(n)
            after = h - n
            after *= z
            after += n
            if keep is not None:
                keep.append((h, z, r, m, n))
            h = after
            yield h

    def position_sums(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each window the sum over its letters of the label probabilities [windows, languages]."""
        c = len(self.langs)
        out = np.zeros((len(start), c), "f4")
        order = np.argsort(-size, kind="stable")
        some = max(16, CELLS // (SPAN * c))
        for at in range(0, len(order), some):
            which = order[at:at + some]
            both, live = _matrices(data, start[which], size[which])
            logits = np.zeros((2, both.shape[1], c, len(which)), "f4")
            for t, h in enumerate(self.states(both, live)):
                logits[:, t, :, :live[t]] = self.out @ h
            # the backward reading's place t is place size - 1 - t of the window
            back = size[which][None, :] - 1 - np.arange(both.shape[1])[:, None]
            z = logits[0] + np.take_along_axis(logits[1], np.maximum(back, 0)[:, None, :], 0) + self.base
            z -= z.max(1, keepdims=True)
            np.exp(z, out=z)
            z /= z.sum(1, keepdims=True)
            z *= (LETTER[both[0]] & (back >= 0))[:, None, :]
            out[which] = z.sum(0).T
        return out

    def gradients(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the letters of all windows, and its gradients, backwards through time."""
        order = np.argsort(-size, kind="stable")
        start, size, label = start[order], size[order], label[order]
        both, live = _matrices(data, start, size)
        span, count = both.shape[1:]
        hidden = self.turn.shape[2]
        keep: list = []
        states = np.zeros((2, span, hidden, count), "f4")
        for t, h in enumerate(self.states(both, live, keep)):
            states[:, t, :, :live[t]] = h
        back = size[None, :] - 1 - np.arange(span)[:, None]
        at = np.maximum(back, 0)[:, None, :]
        aligned = np.take_along_axis(states[1], at, 0)
        z = self.out[0] @ states[0] + self.out[1] @ aligned + self.base
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        seen = (LETTER[both[0]] & (back >= 0)).astype("f4")
        total = max(1.0, float(seen.sum()))
        columns = np.arange(count)
        loss = -float((np.log(z[:, label, columns] + 1e-12) * seen).sum()) / total
        z[:, label, columns] -= 1
        z *= seen[:, None, :] / total
        d_out = np.stack([np.einsum("tcb,thb->ch", z, s) for s in (states[0], aligned)])
        d_base = z.sum((0, 2))[:, None]
        d_states = np.stack([self.out[0].T @ z, self.out[1].T @ z])
        # from the window's places back to those of the backward reading
        d_states[1] = np.take_along_axis(d_states[1], at, 0) * (back >= 0)[:, None, :]
        d_turn, d_bias = np.zeros_like(self.turn), np.zeros_like(self.bias)
        d_in = np.zeros((2, span, 3 * hidden, count), "f4")
        turned = self.turn.transpose(0, 2, 1)
        dh = np.zeros((2, hidden, 0), "f4")
        for t in range(span - 1, -1, -1):
            h, zt, r, m, n = keep[t]
            now = d_states[:, t, :, :live[t]].copy()
            now[:, :, :dh.shape[2]] += dh
            d_n = now * (1 - zt) * (1 - n * n)
            d_z = now * (h - n) * zt * (1 - zt)
            d_r = d_n * m * r * (1 - r)
            d_m = d_n * r
            d_in[:, t, :, :live[t]] = np.concatenate([d_z, d_r, d_n], 1)
            d_g = np.concatenate([d_z, d_r, d_m], 1)
            d_turn += d_g @ h.transpose(0, 2, 1)
            d_bias += d_m.sum(2, keepdims=True)
            dh = now * zt + turned @ d_g
        d_table = np.zeros_like(self.table)
        for d in (0, 1):
            # only the first live[t] windows of a place have gradients; the rest are zero
            flat, names = d_in[d].transpose(1, 0, 2).reshape(3 * hidden, -1), both[d].reshape(-1)
            by = np.argsort(names, kind="stable")
            found, first = np.unique(names[by], return_index=True)
            d_table[d][:, found] = np.add.reduceat(flat[:, by], first, axis=1)
        return loss, [d_table, d_turn, d_bias, d_out, d_base]

    def fit(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, label: np.ndarray, steps: int = STEPS,
            rate: float = 0.01, seed: int = 13) -> list[float]:
        """Adam on batches that draw all languages alike; deterministic. Returns the losses."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(label == c) for c in range(len(self.langs))]
        of = [x for x in of if len(x)]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parts()]
        losses: list[float] = []
        for step in range(1, steps + 1):
            some = np.array([(x := of[c])[rng.integers(len(x))] for c in rng.integers(len(of), size=BATCH)])
            loss, grads = self.gradients(data, start[some], size[some], label[some])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for p, g, (m, v) in zip(self.parts(), grads, moments):
                g = g / max(1.0, norm)
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-8)
            if step >= 20 and np.mean(losses[-20:]) < ENOUGH:
                break
        return losses

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and pooled probability of each text; UNKNOWN and 0 without a letter."""
        raw = [text_bytes(t) for t in texts]
        sizes = np.array([len(x) for x in raw], np.int64)
        text, start, size = windows(sizes)
        sums = np.zeros((len(raw), len(self.langs)))
        if len(start) and self.langs:
            np.add.at(sums, text, self.position_sums(np.concatenate(raw), start, size))
        names, scores = [], []
        for t, row in zip(texts, sums):
            known = t is not None and row.sum() > 0 and any(map(str.isalpha, t))
            best = int(row.argmax()) if known else -1
            names.append(self.langs[best] if known else UNKNOWN)
            scores.append(float(min(1.0, row[best] / row.sum())) if known else 0.0)
        return names, scores


def _matrices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of windows (longest first) read forwards and backwards [2, places, windows], and the windows that have a place."""
    place = np.arange(size[0])[:, None]
    live = (size[None, :] > place).sum(1)
    ahead = np.minimum(place, size - 1)
    return np.stack([data[start + ahead], data[start + size - 1 - ahead]]), live


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def fitted(docs: DataFrame) -> BiGru:
    """A network fitted on text and lang of documents whose crc32 remainder is not 2.

    At most FIT_LANG documents of a language and FIT_ROWS in all, those of low rank by a hash of doc_id first, so that rare
    languages stay in; of each at most FIT_WINDOWS windows, spread evenly over its whole text. This bounds the one task
    that trains. Rows without id, lang or letters teach nothing. Without any the network knows no language."""
    usable = docs.filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (remainder(F.col("doc_id")) != 2) & F.col("text").rlike(r"\p{L}"))
    narrow = usable.select("doc_id", "lang", F.xxhash64("text").alias("hash"))
    keyed = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "hash")
    some = narrow.withColumn("rank", F.row_number().over(keyed)).filter(F.col("rank") <= FIT_LANG)
    some = some.orderBy("rank", "lang").limit(FIT_ROWS).select("doc_id", "lang", "hash").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                raw = text_bytes(text)
                _, start, size = windows(np.array([len(raw)]))
                for k in np.unique(np.linspace(0, len(start) - 1, FIT_WINDOWS).astype(int)):
                    langs.append(lang)
                    parts.append(raw[start[k]:start[k] + size[k]].tobytes())
            yield pa.RecordBatch.from_pydict({"lang": langs, "part": pa.array(parts, pa.binary())})

    rows = usable.select("doc_id", "lang", "text").withColumn("hash", F.xxhash64("text")).join(
        F.broadcast(some), ["doc_id", "lang", "hash"]).select("lang", "text")
    parts = rows.mapInArrow(cut, "lang string, part binary")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in zip(b["lang"].to_pylist(), b["part"].to_pylist())))
        langs = sorted({lang for lang, _ in got})
        model = BiGru.new(langs)
        if len(langs) > 1:
            size = np.array([len(p) for _, p in got])
            label = np.array([langs.index(lang) for lang, _ in got])
            data = np.frombuffer(b"".join(p for _, p in got), np.uint8)
            model.fit(data, np.cumsum(size) - size, size, label)
        yield pa.RecordBatch.from_pydict({"langs": [langs], **{
            name: [p.astype("f4").tobytes()] for name, p in zip(PARTS, model.parts())}})

    done = parts.repartition(1).mapInArrow(train, "langs array<string>, " + ", ".join(f"{p} binary" for p in PARTS)).first()
    model = BiGru.new(list(done["langs"]) if done else [])
    for p, name in zip(model.parts(), PARTS):
        if done and p.size:
            p[:] = np.frombuffer(bytes(done[name]), "f4").reshape(p.shape)
    return model


PARTS = ("bytes", "turn", "bias", "out", "base")


def identified(docs: DataFrame, model: BiGru, name: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of `docs`, the language of the text and its pooled probability. Null and empty texts and those
    without a letter are UNKNOWN with 0. Whole texts are read, in windows; repeated rows are labelled each; columns of the
    two names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<name: string, score: double>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores, held, size = [], [], [], 0
            for k, text in enumerate(texts):  # about 2 MB of text at once, or one text
                held.append(text)
                size += len(text or "")
                if size > 1 << 21 or k == len(texts) - 1:
                    a, b = shared.value.label(held)
                    names += a
                    scores += b
                    held, size = [], 0
            yield pd.DataFrame({"name": pd.Series(names, dtype=object), "score": pd.Series(scores, dtype="f8")})

    both = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (name, score)])
    rows = docs.select(both.alias("row"), label(F.col("text")).alias("found"))
    return rows.select("row.*", F.col("found.name").alias(name), F.col("found.score").alias(score))


@query("op12_languages")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identified(docs.select("doc_id", "text"), fitted(docs)).select(
        "doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score")
