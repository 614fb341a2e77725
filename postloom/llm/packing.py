"""Best-fit packing of tokenised documents into sequences, improved by a grouping genetic algorithm.

1. Every text becomes token ids and a closing id; documents longer than a sequence are cut into full
   sequences, of which the first may be shorter. A piece gets a number that stays with it.
2. Full pieces are sequences of their own. The others fall into blocks of about BLOCK pieces by a hash, each
   packed on its own: first by best fit, then by a grouping genetic algorithm on several islands. Crossover
   injects whole well-filled sequences of one parent into the other, removes the sequences that hold pieces
   twice, and best-fits the pieces so displaced. Between epochs, the best packing of each island also goes to
   the next one of its block.
3. The best packing of a block's islands gives sequence and offset.

A block is the largest thing that a task holds, and blocks only grow in number.

The ids are those of the byte-level BPE of `byte_bpe_50k.json`; they are computed from the same vocabulary in
rank form, which is several times as fast, and compared with it in the tests. Texts that hold an added token, such
as `<|endoftext|>`, or a run of white space that the fast encoder can't take, go through that tokenizer itself.

Defined cases: null and empty texts give one piece of one id. Repeated rows are packed as documents of their
own. Other columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import random
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, give_back_memory, small_batches, whole_text

LENGTH = 2048
END = 0
BLOCK = 4096
#: Islands of a block, in a ring: an epoch's elite also goes to the next one. Blocks whose best fit meets the bound
#: of full sequences stop at once, so that only hard blocks pay for these.
ISLANDS = 4
EPOCHS = 3
GENERATIONS = 8
POPULATION = 6
#: Runs of white space from which the fast encoder isn't trusted; it fails somewhere beyond 500,000.
LONG_RUN = 50_000

_PIECE = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECE_DDL = "doc_id long, uid long, piece int, start long, length long, ids_crc32 long"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(vocabulary: str | None = None):
    import public_tokenizers
    import tiktoken

    # Functions travel by value, so only an imported module outlives a task; a worker then builds it once.
    made, path = vars(tiktoken).setdefault("_postloom_encoders", {}), vocabulary or vocabulary_path()
    if path not in made:
        lines = Path(path).read_bytes().splitlines()
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}
        made[path] = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made[path]


class WholeEncoder:
    """Ids as the tokenizer gives them: by the fast encoder, or by the tokenizer itself where they could differ."""

    def __init__(self, vocabulary: str | None = None):
        self.fast = encoder(vocabulary).encode_ordinary
        self.path = str(Path(vocabulary).with_suffix(".json")) if vocabulary else vocabulary_path("byte_bpe_50k.json")
        self.added = [t["content"] for t in json.loads(Path(self.path).read_bytes())["added_tokens"]]
        self.slow = None

    def __call__(self, text: str) -> list[int]:
        if any(t in text for t in self.added) or len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in re.finditer(r"\s+", text)):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast(text)


def whole_encoder(vocabulary: str | None = None) -> WholeEncoder:
    import tiktoken

    made = vars(tiktoken).setdefault("_postloom_whole_encoders", {})  # as for encoder()
    if vocabulary not in made:
        made[vocabulary] = WholeEncoder(vocabulary)
    return made[vocabulary]


def _pieces(vocabulary: str | None, length: int, with_ids: bool):
    schema = _PIECE.append(pa.field("ids", pa.binary())) if with_ids else _PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, uid = whole_encoder(vocabulary), TaskContext.get().partitionId() << 40
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    ids = np.array(encode(text) + [END], "<u4")
                    n = -(-len(ids) // length)
                    ends = range(len(ids) - (n - 1) * length, len(ids) + 1, length)
                    for k, end in enumerate(ends):
                        start = max(0, end - length) if k else 0
                        own = ids[start:end].tobytes()
                        rows.append((doc_id, uid, k, start, end - start, zlib.crc32(own), own)[: len(schema)])
                        uid += 1
                cols = list(zip(*rows)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)
        give_back_memory()

    return run


class Bins:
    """Open bins by room left: best fit finds the fullest bin that still takes a piece."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room, self.mask = capacity, [[] for _ in range(capacity + 1)], 0

    def add(self, items: list[int], room: int) -> None:
        self.by_room[room].append(items)
        self.mask |= 1 << room

    def put(self, item: int, length: int) -> None:
        fits = self.mask >> length
        if not fits:
            self.add([item], self.capacity - length)
            return
        room = length + (fits & -fits).bit_length() - 1
        own = self.by_room[room].pop()
        if not self.by_room[room]:
            self.mask ^= 1 << room
        own.append(item)
        self.add(own, room - length)

    def all(self) -> list[tuple[list[int], int]]:
        return [(items, room) for room, bins in enumerate(self.by_room) for items in bins]


Packing = list[tuple[list[int], int]]


def best_fit(order: list[int], lengths: list[int], capacity: int, started: Packing = ()) -> Packing:
    bins = Bins(capacity)
    for items, room in started:
        bins.add(list(items), room)
    for i in order:
        bins.put(i, lengths[i])
    return bins.all()


def fitness(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones next to emptier ones."""
    return -len(packing), sum(((capacity - room) / capacity) ** 2 for _, room in packing)


def crossover(one: Packing, other: Packing, lengths: list[int], capacity: int, rng: random.Random) -> Packing:
    """Whole well-filled bins of one in the other; what they displace is best-fitted."""
    ranked = sorted(one, key=lambda b: b[1])
    injected = [b for b in ranked[: max(1, len(ranked) // 2)] if rng.random() < 0.5]
    held = {i for items, _ in injected for i in items}
    kept, displaced = [], []
    for items, room in other:
        if held.isdisjoint(items):
            kept.append((items, room))
        else:
            displaced.extend(i for i in items if i not in held)
    # the emptiest bins are opened too, so that their pieces find better places
    kept.sort(key=lambda b: b[1])
    loose = max(1, len(kept) // 20)
    displaced.extend(i for items, _ in kept[-loose:] for i in items)
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, capacity, [*injected, *kept[:-loose]])


def evolve(lengths: list[int], capacity: int, elites: list[Packing], generations: int, population: int, seed: int) -> Packing:
    rng = random.Random(seed)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    least = -(-sum(lengths) // capacity)
    people = list(elites) or [best_fit(order, lengths, capacity)]
    while len(people) < population and len(people[0]) > least:
        # decreasing within noise: near to best-fit decreasing, but each different
        noisy = sorted(order, key=lambda i: -lengths[i] * rng.uniform(0.8, 1.2))
        people.append(best_fit(noisy, lengths, capacity))
    scored = sorted(((fitness(p, capacity), k, p) for k, p in enumerate(people)), reverse=True)
    born = len(scored)
    for _ in range(generations):
        if len(scored[0][2]) <= least:
            break
        a, b = scored[0][2], rng.choice(scored[1:] or scored)[2]
        for one, other in ((a, b), (b, a)):
            child = crossover(one, other, lengths, capacity, rng)
            born += 1
            scored.append((fitness(child, capacity), born, child))
        scored = sorted(scored, reverse=True)[:population]
    return scored[0][2]


def _to_bytes(packing: Packing, n: int) -> bytes:
    number = np.zeros(n, "<i4")
    for k, (items, _) in enumerate(packing):
        number[items] = k
    return number.tobytes()


def _from_bytes(data: bytes, lengths: list[int], capacity: int) -> Packing:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(np.frombuffer(data, "<i4").tolist()):
        bins.setdefault(k, []).append(i)
    return [(items, capacity - sum(lengths[i] for i in items)) for items in bins.values()]


def _island(capacity: int, generations: int, population: int, epoch: int):
    schema = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("bins", pa.int32()), ("best", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                lengths = r["lengths"]
                elites = [_from_bytes(e, lengths, capacity) for e in r["elites"]]
                seed = (r["block"] * 1009 + r["island"]) * 101 + epoch
                best = evolve(lengths, capacity, elites, generations, population, seed)
                out.append((r["block"], r["island"], len(best), _to_bytes(best, len(lengths))))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)
        give_back_memory()

    return run


def pack(
    docs: DataFrame, length: int = LENGTH, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS, population: int = POPULATION,
    with_ids: bool = False, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and its ids on demand."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    with small_batches(spark):
        pieces = scratch.table(texts.mapInArrow(_pieces(vocabulary, length, with_ids), _PIECE_DDL + ", ids binary" * with_ids), "pieces")
    todo, closed, round_ = pieces.where(F.col("length") < length).select("uid", "length"), [], 0
    while True:
        blocks = max(1, -(-todo.count() // block))
        placed = _evolved(todo, blocks, length, islands, epochs, generations, population, round_, scratch)
        if blocks == 1:
            closed.append(placed)
            break
        # the emptiest sequences of all blocks are opened and packed together: at last one block is left
        closed.append(placed.where("not open"))
        todo, round_ = placed.where("open").join(todo, "uid").select("uid", "length"), round_ + 1
        todo = scratch.table(todo, f"open-{round_}")
    won = closed[0]
    for more in closed[1:]:
        won = won.unionByName(more)
    rows = pieces.join(won, "uid", "left")
    full = F.col("length") == length
    return rows.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.when(full, -1 - F.col("uid")).otherwise(F.col("sequence_id")).alias("sequence_id"), F.when(full, F.lit(0)).otherwise(F.col("offset")).cast("long").alias("offset"), *["ids"] * with_ids,
    )


def _evolved(todo: DataFrame, blocks: int, length: int, islands: int, epochs: int, generations: int, population: int, round_: int, scratch: Scratch) -> DataFrame:
    """The pieces' sequences and offsets, and whether their sequence is among those that may be opened again."""
    spark = todo.sparkSession
    groups = todo.groupBy(F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(blocks)).alias("block")).agg(F.sort_array(F.collect_list(F.struct("uid", F.col("length").cast("int").alias("length")))).alias("own"))
    groups = scratch.table(groups.select("block", F.col("own.uid").alias("uids"), F.col("own.length").alias("lengths")), f"blocks-{round_}")
    tasks = max(1, min(blocks * islands, spark.sparkContext.defaultParallelism * 8)) if blocks * islands < 4096 else blocks * islands // 16
    state = None
    for epoch in range(epochs):
        rows = groups.select("block", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
        if state is None:
            rows = rows.withColumn("elites", F.array().cast("array<binary>"))
        else:  # an island goes on from its own best and that of the island before it
            moved = state.select("block", F.explode(F.array_distinct(F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(islands))))).alias("island"), "best")
            rows = rows.join(moved.groupBy("block", "island").agg(F.sort_array(F.collect_list("best")).alias("elites")), ["block", "island"])
        evolved = rows.repartition(tasks, "block", "island").mapInArrow(_island(length, generations, population, epoch), "block long, island int, bins int, best binary")
        state = scratch.table(evolved, f"epoch-{round_}-{epoch}")
    best = state.groupBy("block").agg(F.min(F.struct("bins", "island")).alias("b")).select("block", F.col("b.island").alias("island"))
    won = state.join(best, ["block", "island"]).join(groups, "block").mapInArrow(_places(length, round_), "uid long, sequence_id long, offset long, open boolean")
    return scratch.table(won, f"placed-{round_}")


def _places(capacity: int, round_: int):
    """A sequence may be opened if it has room and no more than half of its block's sequences are emptier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                number = np.frombuffer(r["best"], "<i4").astype(np.int64)
                lengths = np.array(r["lengths"], np.int64)
                order = np.argsort(number, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.concatenate([[True], np.diff(number[order]) > 0])
                offset = before - np.maximum.accumulate(np.where(first, before, 0))
                room = capacity - np.bincount(number, lengths).astype(np.int64)
                emptiest = np.argsort(-room, kind="stable")[: -(-len(room) // 2)]
                opened = np.zeros(len(room), bool)
                opened[emptiest] = room[emptiest] > 0
                place = (round_ << 58) + (r["block"] << 30) + number[order]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(r["uids"], np.int64)[order]), pa.array(place), pa.array(offset), pa.array(opened[number[order]])], names=["uid", "sequence_id", "offset", "open"])

    return run


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
