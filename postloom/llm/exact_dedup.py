"""Exact dedup by an extendible-hash index on shared files.

1. Each task combines the copies among its own rows: it keeps one entry for each text, found by hash and
   confirmed by comparing bytes, and writes the entries next to its rows' memberships. A text that a third
   of all rows share leaves one entry a task.
2. A directory of hash prefixes is grown from counts of the entries: while a bucket holds more bytes than
   a task should take, it splits in two, and the directory doubles when the bucket is as deep as it.
3. Owner tasks get contiguous runs of buckets, that is ranges of the hash. They read their entries in hash
   order, chain the different texts of one hash, compare bytes along the chain, and write index files.
4. Memberships and index meet on the entry's number, of which no task made more than it had rows.

The driver holds prefix counts and the directory, at most 2 ** MAX_DEPTH slots. Chains are read as a
stream: a task holds the different texts of one hash, and no more.

Defined cases: null counts as the empty text. Of rows that repeat both text and doc_id just one stays, and
null doc_ids stay only if the group has no other. Other columns of the input aren't read, whatever their names. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, by_ids, give_back_memory, rows_at_once, split_bytes, unused, whole_text

#: The deepest directory: a million slots, 16 MB.
MAX_DEPTH = 20
FIRST_DEPTH = 10
#: Bytes of entries that a task holds while it combines copies; then they are written and forgotten.
COMBINE_BYTES = 32 << 20

_PAGE = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.string()), ("entry", pa.int64()), ("h", pa.int64()), ("text", pa.binary()), ("n", pa.int64()), ("top", pa.int64()), ("top_row", pa.int64())]
)
_PAGE_DDL = "row long, doc_id long, sha string, entry long, h long, text binary, n long, top long, top_row long"
_INDEX = pa.schema([("entry", pa.int64()), ("bucket", pa.int32()), ("h", pa.int64()), ("chain", pa.int32()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])
_INDEX_DDL = "entry long, bucket int, h long, chain int, keep_id long, keep_row long, group_size long"


class Directory:
    """An extendible-hash directory over prefixes of the hash, grown from weights of finer prefixes."""

    def __init__(self, capacity: int):
        self.capacity, self.depth = capacity, 0
        self.slots: list[list] = [[0, 0]]  # a bucket: its depth, its prefix; slots may share one

    def grow(self, weights: dict[int, int], bits: int) -> list[int]:
        """Splits overfull buckets, given weights of the prefixes of that many bits; prefixes still overfull."""
        overfull = []
        # each prefix goes to the bucket that its slot names
        own_of: dict[int, list] = {}
        for p, w in weights.items():
            own_of.setdefault(id(self.slots[p >> (bits - self.depth)]), []).append((p, w))
        todo = [(b, own_of.get(id(b), [])) for b in self.buckets()]
        while todo:
            bucket, own = todo.pop()
            if sum(w for _, w in own) <= self.capacity:
                continue
            if bucket[0] == bits:
                overfull.append(bucket[1])
                continue
            if bucket[0] == self.depth:  # the directory doubles
                self.slots = [b for b in self.slots for _ in (0, 1)]
                self.depth += 1
            deep = bucket[0] + 1
            low, high = [deep, bucket[1] << 1], [deep, bucket[1] << 1 | 1]
            first, half = bucket[1] << (self.depth - bucket[0]), 1 << (self.depth - deep)
            self.slots[first : first + 2 * half] = [low] * half + [high] * half
            bit = bits - deep
            todo += [(low, [x for x in own if not x[0] >> bit & 1]), (high, [x for x in own if x[0] >> bit & 1])]
        return overfull

    def buckets(self) -> list[list]:
        return list({id(b): b for b in self.slots}.values())


def _combine(texts_at_once: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = (TaskContext.get().partitionId() << 40) - 1
        held: dict[int, list[list]] = {}
        size = 0

        def entries() -> pa.RecordBatch:
            flat = [(h, e) for h, chain in held.items() for e in chain]
            none = [None] * len(flat)
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip([none, none, none, [e[0] for _, e in flat], [h for h, _ in flat], [e[1] for _, e in flat], [e[2] for _, e in flat], [e[3] for _, e in flat], [e[4] for _, e in flat]], _PAGE)], schema=_PAGE
            )

        for batch in batches:
            ids, texts, hashes = (batch.column(k).to_pylist() for k in ("doc_id", "text", "h"))
            rows, mine = [], []
            for doc_id, text, h in zip(ids, texts, hashes):
                row += 1
                chain = held.setdefault(h, [])
                e = next((e for e in chain if e[1] == text), None)
                if e is None:
                    chain.append(e := [row, text, 0, None, row])
                    size += len(text) + 200
                e[2] += 1
                if doc_id is not None and (e[3] is None or doc_id > e[3]):
                    e[3:] = doc_id, row
                rows.append(row)
                mine.append(e[0])
            void = pa.nulls(len(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), batch.column("doc_id"), batch.column("sha"), pa.array(mine, pa.int64()), *(void.cast(_PAGE.field(k).type) for k in ("h", "text", "n", "top", "top_row"))], schema=_PAGE
            )
            if size > texts_at_once:
                yield entries()
                held, size = {}, 0
        yield entries()
        held = {}
        give_back_memory()

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in the order of their hash: one group for each different text of a hash."""
    done: list[tuple] = []
    at, chain = None, []

    def close() -> None:
        for k, (bucket, _, own, n, top, top_row) in enumerate(chain):
            done.extend((e, bucket, at, k, top, top_row, n) for e in own)

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done)) or [[]] * len(_INDEX)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _INDEX)], schema=_INDEX)

    for batch in batches:
        for e, bucket, h, text, n, top, top_row in zip(*(batch.column(k).to_pylist() for k in ("entry", "bucket", "h", "text", "n", "top", "top_row"))):
            if h != at:
                close()
                at, chain = h, []
            group = next((g for g in chain if g[1] == text), None)
            if group is None:
                chain.append([bucket, text, [e], n, top, top_row])
                continue
            group[2].append(e)
            group[3] += n
            if top is not None and (group[4] is None or top > group[4]):
                group[4:] = top, top_row
        if len(done) > 10_000:
            yield flush()
            done = []
    close()
    yield flush()
    give_back_memory()


def exact_dedup(docs: DataFrame, bucket_bytes: int | None = None, hash_bits: int = 64, id_col: str = "doc_id", text_col: str = "text", combine_bytes: int = COMBINE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and the bucket of its text.

    hash_bits below 64 makes different texts collide, for tests of the chains.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    text = whole_text(text_col)
    h = F.shiftleft(F.xxhash64(text), 64 - hash_bits) if hash_bits < 64 else F.xxhash64(text)
    stamped = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(text, "UTF-8").alias("text"), h.alias("h"), F.sha2(F.encode(text, "UTF-8"), 256).alias("sha"))
    with rows_at_once(spark, 1000):
        pages = scratch.table(stamped.mapInArrow(_combine(combine_bytes), _PAGE_DDL), "pages")
    entries = pages.where("text is not null").select("entry", "h", "text", "n", "top", "top_row")

    def weights(bits: int, only: list[int] | None = None) -> dict[int, int]:
        found = entries.select(F.shiftrightunsigned("h", 64 - bits).alias("p"), F.octet_length("text").alias("b"))
        if only is not None:
            found = found.join(F.broadcast(spark.createDataFrame([(p,) for p in only], "q long")), F.shiftrightunsigned("p", bits - FIRST_DEPTH) == F.col("q"), "left_semi")
        return dict(found.groupBy("p").agg(F.sum(F.col("b") + 200)).collect())

    coarse = weights(FIRST_DEPTH)
    total = sum(coarse.values())
    capacity = max(bucket_bytes or split_bytes(spark), total >> (MAX_DEPTH - 4))
    directory = Directory(capacity)
    if overfull := directory.grow(coarse, FIRST_DEPTH):
        directory.grow(weights(MAX_DEPTH, overfull) | {p << (MAX_DEPTH - FIRST_DEPTH): w for p, w in coarse.items() if p not in set(overfull)}, MAX_DEPTH)

    # Owners take runs of buckets, each about as many bytes as a bucket may hold; a bucket starts at a prefix.
    shift = 64 - directory.depth
    number = {id(b): i for i, b in enumerate(directory.buckets())}
    slots = spark.createDataFrame([(i, number[id(b)]) for i, b in enumerate(directory.slots)], "slot long, bucket int")
    slot = F.shiftrightunsigned("h", shift) if shift < 64 else F.lit(0)
    owned = entries.withColumn("slot", slot.cast("long")).join(F.broadcast(slots), "slot").drop("slot")
    owners = max(1, min(len(number), -(-total // capacity) * 2))
    owned = owned.repartitionById(owners, F.floor(F.col("bucket").cast("long") * owners / len(number)).cast("int"))
    with rows_at_once(spark, 1000):
        index = scratch.table(owned.sortWithinPartitions("h", "entry").mapInArrow(_resolve, _INDEX_DDL), "index")
    members = pages.where("row is not null").select("row", "doc_id", "sha", "entry")
    return members.join(index, "entry").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"), "bucket"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps."""
    decided = Scratch(docs.sparkSession, "exact-dedup").table(exact_dedup(docs, id_col=id_col, text_col=text_col), "decided")
    by_id = decided.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("kept").alias("stays"))
    plain = by_ids(docs, by_id.where("n > 1 or not stays").select("doc_id"), id_col, "left_anti")
    repeated = by_id.where("n > 1").select("doc_id")
    if not repeated.take(1):
        return plain
    # ids of several rows: which of them stays is told by the text
    keepers = decided.where("kept").join(repeated, decided["doc_id"].eqNullSafe(repeated["doc_id"]), "left_semi").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    (own,) = unused(docs.columns, "own_sha")
    rows = by_ids(docs, repeated, id_col, "left_semi").withColumn(own, F.sha2(F.encode(whole_text(text_col), "UTF-8"), 256))
    rows = rows.join(keepers, rows[id_col].eqNullSafe(keepers["_id"]) & (rows[own] == keepers["_sha"]), "left_semi")
    return plain.unionByName(rows.dropDuplicates([id_col, own]).drop(own))


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("bucket")


SQL = """
with t as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from t group by text)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256
from t join g using (text)"""
