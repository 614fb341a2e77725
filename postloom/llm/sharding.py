"""Sharding by histogram sort.

Rows are ordered by a 64-bit key of their text and cut into shards of nearly equal bytes. The splitters
come from counting: each round sums the exact bytes in cells of the key space, in parallel over all
partitions, and refines only the cells that a splitter still falls into. When every splitter meets the
tolerance, or its cell holds one key, the rows move once, to the task of their shard and sub-range.

Equal texts have equal keys and so share a shard; a group larger than a shard makes that shard larger.
A shard is written by several tasks: rows spread over sub-ranges by a second hash, so that a hot text
doesn't meet in one task, and slots are offsets of sub-ranges plus positions in them.

The driver holds at most 2 ** STEP_BITS counts for each splitter.

Defined cases: a null text counts as no bytes and lies with the empty texts; repeated rows get slots of
their own; an empty table gives an empty result; the input's columns size, shard and slot are replaced, all others stay.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from postloom.llm.common import Scratch, split_bytes, whole_text

STEP_BITS = 10
#: Columns of the result; the input's own of these names are replaced.
RESULT = {"size", "shard", "slot"}
#: Most sub-ranges of all shards; bounds the table of offsets.
MOST_PARTS = 100_000


def splitters(keyed: DataFrame, key: str, weight: str, parts: int, tolerance: float = 0.001) -> list[int]:
    """Lower bounds of the parts 1, 2, ... in the order of the signed 64-bit column `key`.

    The weights of the parts differ from their share by at most `tolerance` of a part, or else by what a
    single key weighs. keyed is scanned once a round, at most 64 / STEP_BITS rounds.
    """
    flipped = F.col(key).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order from here on
    width = STEP_BITS
    cells = {int(r[0]): r[1] for r in keyed.groupBy(F.shiftrightunsigned(flipped, 64 - width)).agg(F.sum(weight)).collect()}
    total = sum(cells.values())
    if not total:
        return [0] * (parts - 1)
    slack = tolerance * total / parts
    at = {}  # for each splitter: the cell that it falls into, its bits, the weight below it and in it
    order = sorted(cells)
    sums = list(accumulate(cells[c] for c in order))
    for k in range(1, parts):
        i = min(bisect_left(sums, total * k / parts), len(order) - 1)
        at[k] = (order[i], width, sums[i] - cells[order[i]], cells[order[i]])

    def open_(k: int) -> bool:
        _, bits, under, own = at[k]
        goal = total * k / parts
        return bits < 64 and min(abs(goal - under), abs(under + own - goal)) > slack

    while pending := [k for k in at if open_(k)]:
        bits = at[pending[0]][1]
        step = min(STEP_BITS, 64 - bits)
        parents = sorted({at[k][0] for k in pending})
        signed = [c - (1 << bits) if bits == 64 and c >= 1 << 63 else c for c in parents]
        inside = keyed.where(F.shiftrightunsigned(flipped, 64 - bits).isin(signed))
        fine = F.shiftrightunsigned(flipped, 64 - bits - step) if bits + step < 64 else flipped
        counts: dict[int, dict[int, int]] = {}
        for cell, n in inside.groupBy(fine).agg(F.sum(weight)).collect():
            cell = int(cell) % (1 << 64)
            counts.setdefault(cell >> step, {})[cell] = n
        for k in pending:
            cell, _, run, _ = at[k]
            for c in sorted(counts[cell]):
                if run + counts[cell][c] >= total * k / parts:
                    break
                run += counts[cell][c]
            at[k] = (c, bits + step, run, counts[cell][c])
    found = []
    for k in range(1, parts):
        cell, bits, under, own = at[k]
        goal = total * k / parts
        edge = cell if goal - under <= under + own - goal else cell + 1
        found.append((edge << (64 - bits)) - (1 << 63))
    return list(accumulate(found, max))


def part_of(key: Column, bounds: list[int]) -> Column:
    """The part that a key lies in: how many bounds it reaches."""
    part = F.lit(0)
    for b in bounds:
        part = part + (F.lit(True) if b < -(1 << 63) else F.lit(False) if b >= 1 << 63 else key >= F.lit(b)).cast("int")
    return part


def shard_by_bytes(docs: DataFrame, shards: int = 24, tolerance: float = 0.001, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with size, shard and slot: shards of nearly equal bytes that keep equal texts together."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")
    key = F.xxhash64(whole_text(text_col))
    scratch = Scratch(spark, "shards")
    # rows of one text spread by all that else tells them apart
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != text_col and isinstance(f.dataType, AtomicType)]
    salt = F.xxhash64(*plain, F.lit(0))
    keyed = scratch.table(docs.select(key.alias("k"), size.alias("size"), salt.alias("salt")), "keys")
    bounds = splitters(keyed, "k", "size", shards, tolerance)
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    spread = max(1, min(MOST_PARTS // shards, -(-total // (shards * split_bytes(spark)))))
    sub = F.pmod(F.col("salt"), F.lit(spread)).cast("int")
    counts = keyed.groupBy(part_of(F.col("k"), bounds).alias("shard"), sub.alias("sub")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # the columns of docs travel as one, so that no name can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"), size.alias("size"), salt.alias("salt"), F.col(id_col).alias("id"))
    rows = rows.select("row", "key", "size", "id", part_of(F.col("key"), bounds).alias("shard"), F.pmod("salt", F.lit(spread)).cast("int").alias("sub"))
    rows = rows.withColumn("part", F.col("shard").cast("int") * spread + F.col("sub"))  # a task for each, none for two
    dealt = rows.repartitionById(shards * spread, F.col("part"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("key", "id")) - 1
    placed = dealt.withColumn("place", place).join(F.broadcast(offsets), ["shard", "sub"])
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in RESULT]
    return placed.select(*kept, "size", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"))


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    rows = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", "size", F.crc32(F.encode(whole_text(), "UTF-8")).cast("long").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
