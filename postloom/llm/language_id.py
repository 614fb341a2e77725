"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in segments of SEGMENT bytes, once forwards and once backwards, and gives each byte
the probabilities of the learned languages and of none; a document's are their mean over all its bytes. What it
learns as no language are shuffled bytes and random letters, so that junk has no probable language. It is trained in
numpy, by backpropagation through time, on SEGMENTS_EACH segments, spread over the whole text, of each of at most
PER_LANGUAGE documents of every language: a bounded sample, chosen by a hash of id and text. Gates are piecewise linear, which training and prediction share.

Every byte of every text is read in the executors, a few thousand segments at a time.

Defined cases: `und` with score 0 if a text is null, empty or has no letter. A null id counts as empty text in
the bucket that decides whether a row may be learned from; of repeated rows one is learned from. More than MOST_LANGUAGES different
values of lang are an error: none is left out. Without any row to learn from, every text is `und`. Repeated rows get the
same answer, an empty table gives an empty result, and other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, give_back_memory, small_batches, unused

SEGMENT = 64
HIDDEN = 8
#: Segments that go through the network together.
BATCH = 2048
#: The sample that is learned from: documents of a language, and segments of a document.
PER_LANGUAGE = 400
SEGMENTS_EACH = 8
EPOCHS = 8
#: Values of lang that the network has outputs for.
MOST_LANGUAGES = 256
UNKNOWN = "und"


class ByteGRU:
    """Arrays are (direction, unit, sequence); x is (time, sequence) bytes."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.inp = rng.normal(0, 0.3, (2, 3 * hidden, 256)).astype(np.float32)
        self.rec = rng.normal(0, 0.5 / np.sqrt(hidden), (2, 3 * hidden, hidden)).astype(np.float32)
        self.out = rng.normal(0, 0.3, (classes, 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((classes, 1), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.inp, self.rec, self.out, self.bias]

    def hidden(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (time, 2 * hidden, sequence): of the forward pass up to each byte, of the backward one from it."""
        steps, width = x.shape
        n = self.h
        states = np.empty((steps, 2, n, width), np.float32)
        h = np.zeros((2, n, width), np.float32)
        a = np.empty((2, 3 * n, width), np.float32)
        for t in range(steps):
            np.take(self.inp[0], x[t], axis=1, out=a[0], mode="clip")
            np.take(self.inp[1], x[steps - 1 - t], axis=1, out=a[1], mode="clip")
            u = np.matmul(self.rec, h)
            gates = a[:, : 2 * n]
            gates += u[:, : 2 * n]
            gates *= 0.25
            gates += 0.5
            raw = gates.copy() if trace is not None else None
            np.clip(gates, 0, 1, out=gates)
            z, r, un = gates[:, :n], gates[:, n:], u[:, 2 * n :]
            m = a[:, 2 * n :]
            if trace is not None:
                trace.append((raw, z.copy(), r.copy(), un.copy(), (pre := m + r * un), h))
                m = np.clip(pre, -1, 1)
            else:
                un *= r
                m += un
                np.clip(m, -1, 1, out=m)
            new = h - m
            new *= z
            new += m
            h = new
            states[t, 0], states[steps - 1 - t, 1] = h[0], h[1]
        return states.reshape(steps, 2 * n, width)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(time, class, sequence)"""
        p = np.matmul(self.out, self.hidden(x))
        p += self.bias
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over the positions of mask, and its gradients by backpropagation through time."""
        steps, width = x.shape
        n, trace = self.h, []
        states = self.hidden(x, trace)
        p = np.matmul(self.out, states) + self.bias
        p -= p.max(1, keepdims=True)
        p = np.exp(p)
        p /= p.sum(1, keepdims=True)
        count = mask.sum()
        seqs = np.arange(width)
        loss = -(np.log(p[:, y, seqs] + 1e-9) * mask).sum() / count
        p[:, y, seqs] -= 1
        p *= mask[:, None] / np.float32(count)
        d_out = np.einsum("tcb,thb->ch", p, states, optimize=True)
        d_bias = p.sum((0, 2))[:, None]
        d_states = np.matmul(self.out.T, p).reshape(steps, 2, n, width)
        d_rec = np.zeros_like(self.rec)
        d_in = np.empty((steps, 2, 3 * n, width), np.float32)
        back = np.zeros((2, n, width), np.float32)
        for t in reversed(range(steps)):
            raw, z, r, un, pre, h = trace[t]
            dh = back + np.stack([d_states[t, 0], d_states[steps - 1 - t, 1]])
            m = np.clip(pre, -1, 1)
            d_pre = dh * (1 - z) * (np.abs(pre) < 1)
            open_ = 0.25 * ((raw > 0) & (raw < 1))
            d_gates = np.concatenate([dh * (h - m), d_pre * un], 1) * open_
            d_in[t] = np.concatenate([d_gates, d_pre], 1)
            d_u = np.concatenate([d_gates, d_pre * r], 1)
            d_rec += np.matmul(d_u, h.transpose(0, 2, 1))
            back = dh * z + np.matmul(self.rec.transpose(0, 2, 1), d_u)
        d_inp = np.empty_like(self.inp)
        for side, read in ((0, x), (1, x[::-1])):
            flat = d_in[:, side].transpose(1, 0, 2).reshape(3 * n, -1)
            at = read.reshape(-1)
            for k in range(3 * n):
                d_inp[side, k] = np.bincount(at, flat[k], 256)
        return float(loss), [d_inp, d_rec, d_out.astype(np.float32), d_bias.astype(np.float32)]


def train(segments: list[bytes], labels: np.ndarray, classes: int, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.02, seed: int = 1) -> ByteGRU:
    """Adam over shuffled segments."""
    model, rng = ByteGRU(classes, seed=seed), np.random.default_rng(seed)
    x = np.zeros((len(segments), SEGMENT), np.uint8)
    for i, s in enumerate(segments):
        x[i, : len(s)] = np.frombuffer(s, np.uint8)
    length = np.array([len(s) for s in segments])
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    step, total = 0, epochs * -(-len(segments) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(segments))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            mask = (np.arange(SEGMENT)[:, None] < length[own]).astype(np.float32)
            _, grads = model.gradients(x[own].T.astype(np.intp), mask, labels[own])
            step += 1
            pace = rate * (1 - step / (total + 1))
            for p, g, a, b in zip(model.parameters(), grads, first, second):
                norm = np.sqrt((g * g).sum())
                g = g / max(1.0, norm)
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return model


def pooled(model: ByteGRU, texts: pa.Array) -> np.ndarray:
    """(text, class): mean probabilities over the bytes of each text; zeros if it has none."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    length = np.diff(offsets)
    pieces = -(-length // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), pieces)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = offsets[:-1][owner] + place * SEGMENT
    size = np.minimum(SEGMENT, length[owner] - place * SEGMENT)
    sums = np.zeros((len(texts), len(model.bias)))
    steps = np.arange(SEGMENT)[:, None]
    for at in range(0, len(owner), BATCH):
        s, n, o = start[at : at + BATCH], size[at : at + BATCH], owner[at : at + BATCH]
        mask = steps < n
        x = np.where(mask, data[np.minimum(s + steps, len(data) - 1)], 0).astype(np.intp)
        p = model.probabilities(x)
        p *= mask[:, None]
        for c, own in enumerate(p.sum(0)):
            sums[:, c] += np.bincount(o, own, len(texts))
    return sums / np.maximum(length, 1)[:, None]


def _segments(each: int):
    schema = pa.schema([("lang", pa.string()), ("segment", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                n = min(each, -(-len(text) // SEGMENT))
                for k in range(n):  # spread over the whole text
                    at = k * max(0, len(text) - SEGMENT) // max(1, n - 1)
                    langs.append(lang)
                    found.append(text[at : at + SEGMENT])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], schema=schema)

    return run


def _junk(segments: list[bytes], many: int, seed: int = 5) -> list[bytes]:
    """No language: segments with their bytes shuffled, and runs of letters and digits at random."""
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=", np.uint8)
    found = []
    for k in range(many):
        own = np.frombuffer(segments[rng.integers(len(segments))], np.uint8)
        found.append((rng.permutation(own) if k % 2 else rng.choice(letters, SEGMENT)).tobytes())
    return found


def _predict(model: ByteGRU | None, langs: list[str]):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                known = batch.column("letters").to_numpy(zero_copy_only=False)
                if model is None:
                    known = np.zeros(len(known), bool)
                    best, score = known.astype(int), known.astype(float)
                else:
                    p = pooled(model, batch.column("text"))[:, : len(langs)]
                    best, score = p.argmax(1), np.where(known, np.clip(p.max(1), 0, 1), 0)
                names = [langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names), pa.array(score)], schema=schema)
        give_back_memory()

    return run


def bucket_of(id_col: str, buckets: int) -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % buckets


def _draw(id_col: str, text_col: str, seed: int) -> Column:
    """A random number of a row, 63 bits, by its id and text."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), 1)


def learn(docs: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[ByteGRU | None, list[str]]:
    """A network and the languages it knows, from the learnable rows that name a language."""
    own = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    own = own.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), _draw(id_col, text_col, 17).alias("draw"))
    stats = own.groupBy("lang").agg(F.count_distinct("draw").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if not stats:
        return None, []
    if len(stats) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values: that isn't a language code")
    langs = sorted(r.lang for r in stats)
    # draws are uniform: those below a share of their range are a few times as many rows as are wanted
    near = F.lit(False)
    for r in stats:
        near = near | ((F.col("lang") == r.lang) & (F.col("draw") <= min((1 << 63) - 1, (per_language * 4 << 63) // r.n)))
    first = Window.partitionBy("lang").orderBy("draw")
    light = own.where(near).select("lang", "draw").distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language)
    upto = light.groupBy("lang").agg(F.max("draw").alias("upto")).collect()
    chosen = F.lit(False)
    for r in upto:
        chosen = chosen | ((F.col("lang") == r.lang) & (F.col("draw") <= r.upto))
    # of repeated rows one is learned from
    picked = own.where(chosen).groupBy("lang", "draw").agg(F.min("text").alias("text")).select("lang", F.encode("text", "UTF-8").alias("text"))
    rows = picked.mapInArrow(_segments(SEGMENTS_EACH), "lang string, segment binary").collect()
    rows = sorted((r.lang, bytes(r.segment)) for r in rows)
    if not rows:
        return None, []
    number = {x: i for i, x in enumerate(langs)}
    labels = [number[x] for x, _ in rows]
    junk = _junk([s for _, s in rows], len(rows) // len(langs) + 1)
    model = train([s for _, s in rows] + junk, np.array(labels + [len(langs)] * len(junk)), len(langs) + 1)
    return model, langs


def identify(docs: DataFrame, model: ByteGRU | None, langs: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(_predict(model, langs), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: ByteGRU | None, langs: list[str], text_col: str = "text") -> DataFrame:
    """The rows of docs that have a letter and whose bytes look more like some language than like none.

    One rule at all sizes: the mean probability of the class of no language, learned from shuffled bytes and random
    letters, must not exceed that of every language.
    """
    names = docs.columns
    (letters,) = unused(names, "own_letters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                known = batch.column(letters).to_numpy(zero_copy_only=False)
                if model is None:
                    known = np.zeros(batch.num_rows, bool)
                elif batch.num_rows:
                    known = known & (pooled(model, batch.column(text_col)).argmax(1) < len(langs))
                yield batch.select(names).filter(pa.array(known))
        give_back_memory()

    rows = docs.withColumn(letters, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    spark = docs.sparkSession
    with small_batches(spark):  # each text once, in batches bounded by bytes; written, as the setting counts where a plan runs
        return Scratch(spark, "language").table(rows.mapInArrow(run, docs.schema), "kept")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = bucket_of("doc_id", 3) == 1
    model, langs = learn(docs, ~held)
    with small_batches(spark):
        found = Scratch(spark, "language").table(identify(docs, model, langs), "found")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
