"""Toxicity by compression distance.

Two zstandard dictionaries are trained apart, one on toxic and one on ordinary text. A window of a text, cut between
words, is compressed with either: the difference of the two lengths is how much better the toxic dictionary
explains it. Literals stay raw, so that lengths differ by matches alone. Of the KINDS of pairs, one reads short
windows and matches short strings, the other longer ones.

Most of a toxic document is ordinary text, so the trainer reads in rounds. First it reads the whole texts of
both kinds. Then, of each document, it reads the windows that the dictionaries of the other half of the
documents find most toxic: of toxic documents for the toxic dictionary, of ordinary ones, which so are the
likeliest false alarms, for the ordinary dictionary. What both need for the language itself, a larger dictionary
trained on ordinary text, follows either one.

PAIRS pairs of each kind, which deal the documents into halves in ways of their own, are averaged. A part of the labelled documents
is kept from all dictionaries. Their windows give, for each kind, the figures that a logistic calibration is fitted
on: the largest difference of a window, the sum by length, the sum by its root and the sum of the clear differences by the root. Its
threshold, at score 0.5, is where FLAGGED of those ordinary documents lie above.

What is learned comes from a bounded sample of labelled rows: at most PER_LABEL documents of either label,
chosen by a hash of the id, of each document longer than PIECES pieces of PIECE bytes as many pieces spread over the
whole of it, and one of each group of near copies. Every window of every text is scored.

Defined cases: null and empty texts have no windows and get the calibrated score of no difference. Without
labelled rows of both kinds every score is 0. Ids labelled both 0 and 1 aren't learned from; of rows that share an
id one is. Repeated rows get the same score; other columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import give_back_memory
from postloom.llm.language_id import bucket_of

#: Of each kind: bytes of a window, of the shortest match, and of a dictionary's own part.
KINDS = ((32, 4, 4096), (64, 6, 8192))
#: The compressor starts no match in its last bytes, so that a window goes on for as many.
TAIL = 8
#: Bytes of the dictionary that both of a pair go on with.
SHARED_BYTES = 65536
PAIRS, ROUNDS = 2, 3
#: Of a document's windows, the part that the trainer reads after the first round; one at least.
MOST_TOXIC = 0.05
#: Bytes of the pieces of whole texts that the trainer reads in the first round.
READ = 256
#: Part of the labelled documents that calibrates, and of the ordinary ones among them that lie beyond the threshold.
CALIBRATED, FLAGGED = 0.25, 0.03
#: The sample that is learned from.
PER_LABEL = 1500
PIECES, PIECE = 64, 1024
#: Differences up to this many bytes can be chance.
CLEAR = 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _lower(text: bytes) -> bytes:
    return bytes(_LOWER[np.frombuffer(text, np.uint8)])


class Distance:
    """Compressors of a pair of dictionaries; made where they are used."""

    def __init__(self, ordinary: bytes, toxic: bytes, shortest: int):
        import zstandard as zs

        self.zs = zs
        p = zs.ZstdCompressionParameters(
            compression_level=1, strategy=zs.STRATEGY_FAST, target_length=1, min_match=shortest, hash_log=16, chain_log=16, window_log=17,
            write_checksum=0, write_content_size=0, write_dict_id=0, format=zs.FORMAT_ZSTD1_MAGICLESS,
        )
        self.by = []
        for data in (ordinary, toxic):
            d = zs.ZstdCompressionDict(data, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            self.by.append(zs.ZstdCompressor(dict_data=d, compression_params=p))

    def __call__(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each window: its length with the ordinary dictionary less that with the toxic one."""
        segments = np.stack([starts, sizes], 1).astype(np.uint64).tobytes()
        lengths = []
        for z in self.by:
            out = z.multi_compress_to_buffer(self.zs.BufferWithSegments(data, segments), threads=0)
            lengths.append(np.fromiter((len(x) for x in out), np.int64, len(starts)))
        return lengths[0] - lengths[1]


def windows(texts: list[bytes], window: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case, and the start, size and text of each window, which begin at gaps between words."""
    data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    begin = end - size
    count = np.maximum(0, -(-size // window) - 1)
    owner = np.repeat(np.arange(len(texts)), count)
    wish = begin[owner] + window * (1 + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    gaps = np.append(np.flatnonzero(data <= 32), len(data))
    at = gaps[np.searchsorted(gaps, wish)]
    start = np.unique(np.concatenate([begin[size > 0], at[at < end[owner]]]))
    owner = np.searchsorted(end, start, "right")
    return data.tobytes() + b" " * TAIL, start, np.diff(np.append(start, len(data))) + TAIL, owner


def differences(distances: list[Distance], cut: tuple) -> np.ndarray:
    """Of each window, the mean over the pairs of dictionaries."""
    data, start, size, _ = cut
    return sum(f(data, start, size) for f in distances) / len(distances)


def figures(kinds: list[list[Distance]], texts: list[bytes]) -> np.ndarray:
    """(text, figure), four of each kind"""
    return np.hstack([_figures(distances, window, texts) for distances, (window, _, _) in zip(kinds, KINDS)])


def _figures(distances: list[Distance], window: int, texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), 4))
    cut = windows(texts, window)
    if len(cut[1]):
        d, owner = differences(distances, cut), cut[3]
        total = np.bincount(owner, d, len(texts))
        length = np.maximum(np.array([len(t) for t in texts]), window)
        np.maximum.at(out[:, 0], owner, d)
        out[:, 1] = 100 * total / length
        out[:, 2] = total / np.sqrt(length)
        out[:, 3] = np.bincount(owner, np.maximum(d - CLEAR, 0), len(texts)) / np.sqrt(length)
    return out


class Model:
    def __init__(self, dictionaries: list[list[tuple[bytes, bytes]]], mean: np.ndarray | None = None, scale: np.ndarray | None = None, weight: np.ndarray | None = None):
        self.dictionaries, self.mean, self.scale, self.weight = dictionaries, mean, scale, weight

    def distances(self) -> list[list[Distance]]:
        return [[Distance(*pair, shortest) for pair in pairs] for pairs, (_, shortest, _) in zip(self.dictionaries, KINDS)]

    def score(self, found: np.ndarray) -> np.ndarray:
        x = np.clip((found - self.mean) / self.scale, -6, 6)
        return 1 / (1 + np.exp(-np.clip(x @ self.weight[1:] + self.weight[0], -30, 30)))


def _unlike(texts: list[bytes]) -> list[bytes]:
    """One text of each group that shares the smallest hash of its five-word runs, by either of two hashes."""
    seen: set = set()
    out = []
    for t in texts:
        words = t.split()
        runs = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        marks = {min(hashlib.blake2b(r, digest_size=8, salt=s).digest() for r in runs) for s in (b"1", b"2")}
        if seen.isdisjoint(marks):
            out.append(t)
        seen |= marks
    return out


def _trained(samples: list[bytes], size: int, k: int, d: int, rng: np.random.Generator) -> bytes:
    """A dictionary from samples in lower case, in random order."""
    import zstandard as zs

    samples = [samples[i] for i in rng.permutation(len(samples))]
    try:
        return zs.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zs.ZstdError:  # too little text to train on; the text itself then
        return b" ".join(dict.fromkeys(samples))[-size:]


def _read(texts: list[bytes]) -> list[bytes]:
    return [_lower(t[i : i + READ]) for t in texts for i in range(0, len(t), READ)]


def _most_toxic(distance: Distance, cut: tuple, rng: np.random.Generator) -> list[bytes]:
    """Of each document, the windows that a pair finds most toxic, ties in random order."""
    data, start, size, owner = cut
    if not len(start):
        return []
    d = differences([distance], cut)
    order = np.lexsort((rng.random(len(d)), -d, owner))
    count = np.bincount(owner)
    rank = np.arange(len(order)) - (np.cumsum(count) - count)[owner[order]]
    chosen = order[rank < np.maximum(1, np.ceil(MOST_TOXIC * count[owner[order]]))]
    return [data[start[i] : start[i] + size[i] - TAIL] for i in chosen]


def train_pair(toxic: list[bytes], ordinary: list[bytes], kind: tuple[int, int, int], rng: np.random.Generator) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary. Two halves of the documents choose windows for each other."""
    window, shortest, size = kind
    halves = [[[texts[i] for i in order[h::2]] for h in (0, 1)] for texts in (toxic, ordinary) for order in (rng.permutation(len(texts)),)]
    shared = _trained(_read(ordinary), SHARED_BYTES, 64, 8, rng)
    cuts = [[windows(half, window) for half in own] for own in halves]
    read = [[_read(half) for half in own] for own in halves]

    def pair(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
        as_much = [ordinary[i] for i in rng.permutation(len(ordinary))[: max(1000, len(toxic))]]
        return _trained(as_much, size, 16, 6, rng) + shared, _trained(toxic, size, 16, 6, rng) + shared

    for _ in range(ROUNDS):
        pairs = [Distance(*pair(read[0][h], read[1][h]), shortest) for h in (0, 1)]
        read = [[_most_toxic(pairs[1 - h], own[h], rng) for h in (0, 1)] for own in cuts]
    return pair(read[0][0] + read[0][1], read[1][0] + read[1][1])


def fit(toxic: list[bytes], ordinary: list[bytes], seed: int = 3) -> Model | None:
    toxic, ordinary = _unlike(toxic), _unlike(ordinary)
    if not toxic or not ordinary:
        return None
    rng = np.random.default_rng(seed)
    kept = [max(1, round((1 - CALIBRATED) * len(texts))) for texts in (toxic, ordinary)]
    order = [rng.permutation(len(texts)) for texts in (toxic, ordinary)]
    learned = [[texts[i] for i in own[:n]] for texts, own, n in zip((toxic, ordinary), order, kept)]
    unseen = [[texts[i] for i in own[n:]] or texts for texts, own, n in zip((toxic, ordinary), order, kept)]
    dictionaries = [[train_pair(*learned, kind, rng) for _ in range(PAIRS)] for kind in KINDS]
    found = figures(Model(dictionaries).distances(), [*unseen[0], *unseen[1]])
    y = np.array([1.0] * len(unseen[0]) + [0.0] * len(unseen[1]))
    mean, scale = found.mean(0), found.std(0) + 1e-9
    x = np.hstack([np.ones((len(y), 1)), np.clip((found - mean) / scale, -6, 6)])
    weight = np.zeros(x.shape[1])
    for _ in range(50):  # Newton's method; a small penalty keeps it finite where labels are separable
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(weight)), x.T @ (p - y) + weight)
        weight -= step
        if np.abs(step).max() < 1e-6:
            break
    weight[0] -= np.quantile(x[y == 0] @ weight, 1 - FLAGGED)
    return Model(dictionaries, mean, scale, weight)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text in batch.column("text").to_pylist():
            if len(text) > PIECES * PIECE:  # pieces spread over the whole text
                text = b"\n".join(text[at : at + PIECE] for at in (k * (len(text) - PIECE) // (PIECES - 1) for k in range(PIECES)))
            texts.append(text)
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("_id", "toxic", "draw")), pa.array(texts, pa.binary())], names=["_id", "toxic", "draw", "text"])


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, per_label: int = PER_LABEL, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    own = labels.where(learnable & F.col("toxic").cast("int").isin(0, 1) & F.col(id_col).isNotNull())
    own = own.groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col("toxic").cast("int")).alias("toxic"), F.max(F.col("toxic").cast("int")).alias("most")).where("toxic = most")
    drawn = own.select("_id", "toxic", F.xxhash64("_id", F.lit(29)).alias("draw"))
    sample = [r for t in (0, 1) for r in drawn.where(F.col("toxic") == t).orderBy("draw", "_id").limit(per_label).collect()]
    if not sample:
        return None
    picked = docs.sparkSession.createDataFrame(sample, drawn.schema)
    text = F.encode(F.col(text_col).cast("string"), "UTF-8")
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), text.alias("text"))
    met = texts.join(F.broadcast(picked), "_id").select("_id", "toxic", "draw", "text").mapInArrow(_sampled, "_id long, toxic int, draw long, text binary")
    rows = met.groupBy("_id", "toxic", "draw").agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect()  # one row of each id
    rows = sorted((r.draw, bytes(r.text), r.toxic) for r in rows)
    return fit([t for _, t, y in rows if y == 1], [t for _, t, y in rows if y == 0])


def _scored(model: Model | None):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = model.distances() if model else []
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("text").to_pylist()
                score = model.score(figures(distances, texts)) if model else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], schema=schema)
        give_back_memory()

    return run


def toxicity(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("text"))
    scored = rows.mapInArrow(_scored(model), "doc_id long, score double")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = bucket_of("doc_id", 5) == 0
    return toxicity(docs, learn(docs, labels, ~held)).select("doc_id", held.alias("held_out"), "score", "predicted")
