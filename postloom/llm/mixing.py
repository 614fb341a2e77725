"""Mixing sources to target weights.

Targets share the words of the corpus by weight; none exceeds LIMIT times its source, and what it can't take
goes to the others by their weights. A source's documents fall into blocks by a hash. The mix takes every
block as often as the target holds the whole source, then blocks in permuted order for the rest, and of the
last block the documents that come nearest the target: whole cells of it, then single documents of one cell.

Which shard gets a block: a splitting tree halves the shards, and a multivariate hypergeometric draw deals
each source's exact number of blocks between the halves. Every shard walks its own path down the tree, with
random numbers of the node, in parallel; it so knows which run of each source's permuted blocks is its own.
Rows are then shuffled within their shard by a hash.

The driver holds a line for each source. Blocks are BLOCKS_EACH a source at most, whatever its size.

Defined cases: a null text has no words, and documents without words are never taken. The null source comes
last. Repeated rows are taken together. A source without words has target 0. Columns of the input keep their names
and values; own columns get longer names where they clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, n_words, unused, whole_text

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCKS_EACH = 4096
ROWS_A_BLOCK = 64
#: Rows that a task picks from, one by one, of the block that a target ends in.
FILL = 4096
#: Rows of sources or blocks that are broadcast at most; beyond it the joins shuffle.
BROADCAST_ROWS = 500_000


def targets(sizes: Sequence[int], weights: Sequence[float], limit: float = LIMIT) -> list[float]:
    """Shares of sum(sizes) by weight, none above limit times its size."""
    size, weight = np.array(sizes, float), np.array(weights, float)
    found, open_ = np.zeros(len(size)), np.ones(len(size), bool)
    while open_.any():
        left = size.sum() - found[~open_].sum()
        share = np.where(open_, left * weight / weight[open_].sum(), 0)
        over = open_ & (share > limit * size)
        if not over.any():
            found[open_] = share[open_]
            break
        found[over] = limit * size[over]
        open_ &= ~over
    return found.tolist()


def node_split(quota: np.ndarray, left: int, path: Sequence[int], seed: int) -> np.ndarray:
    """How many blocks of each source go to the left half, which takes that many in all."""
    return np.random.default_rng([seed, *path]).multivariate_hypergeometric(quota, left, method="marginals")


def shard_quota(shard: int, shards: int, quota: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each source: the first of its permuted blocks in that shard, and how many follow."""
    low, high, begin, path = 0, shards, np.zeros_like(quota), [1]
    while high - low > 1:
        mid = (low + high) // 2
        total = int(quota.sum())
        left = node_split(quota, total * (mid - low) // (high - low), path, seed)
        if shard < mid:
            quota, high, path = left, mid, [*path, 0]
        else:
            quota, begin, low, path = quota - left, begin + left, mid, [*path, 1]
    return begin, quota


def _walk(names: list[str], quota: list[int], shards: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                begin, own = shard_quota(int(shard), shards, np.array(quota, np.int64), seed)
                some = own > 0
                # plain lists: a string column that pandas holds in chunks isn't taken back
                yield pd.DataFrame({"src": pd.Series([x for x, n in zip(names, some) if n], dtype=object), "begin": begin[some], "number": own[some], "shard": int(shard)})

    return run


def _fill(frame: pd.DataFrame) -> pd.DataFrame:
    """Of the block that a target ends in: documents, larger ones first, that come nearest what is left."""
    frame = frame.sort_values(["size", "draw"], ascending=[False, True])
    left, picked = float(frame["left"].iloc[0]), []
    for size in frame["size"].tolist():
        picked.append(0 < size <= left)
        left -= size * picked[-1]
    frame["picked"] = picked
    small = frame.index[~frame["picked"] & (frame["size"] > 0) & (frame["size"] < 2 * left)]
    frame.loc[small[-1:], "picked"] = True
    return frame.loc[frame["picked"], ["src", "block", "draw", "picked"]].astype({"src": object})


def _source_key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


class Mix:
    """The plan of a mix: `documents` has a row for each input row, `rows()` the rows of the mix."""

    def __init__(self, docs: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT, shards: int = 16, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
        spark = docs.sparkSession
        self.scratch = Scratch(spark, "mixing")
        self.docs = docs
        order = F.xxhash64(F.col(id_col), whole_text(text_col), F.lit(seed))
        counted = docs.select(F.col(id_col).alias("doc_id"), _source_key(source_col).alias("src"), n_words(whole_text(text_col)).alias("size"), order.alias("draw"))
        light = self.scratch.table(counted, "light")
        stats = light.groupBy("src").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        stats = sorted(stats, key=lambda r: (r.src == "null", r.src))  # "=" before every name, so in the order of names
        goals = targets([r.size for r in stats], [weights[i % len(weights)] for i in range(len(stats))], limit)
        plan = []
        for r, goal in zip(stats, goals):
            passes = min(limit, int(goal // r.size)) if r.size else 0
            plan.append((r.src, r.size, goal, min(BLOCKS_EACH, -(-r.n // ROWS_A_BLOCK)), passes, goal - passes * r.size))
        few = len(plan) * BLOCKS_EACH <= BROADCAST_ROWS * 8
        hint = F.broadcast if few else lambda x: x
        self.plan = spark.createDataFrame(plan, "src string, source_size long, target double, blocks int, passes int, rest double")
        self._hint = hint
        block = F.pmod(F.col("draw"), F.col("blocks")).cast("int")
        self.light = light.join(hint(self.plan), "src").withColumn("block", block)
        by_block = self.light.groupBy("src", "block").agg(F.sum("size").alias("size"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
        permuted = Window.partitionBy("src").orderBy(F.xxhash64("src", "block", F.lit(seed)), "block")
        upto = F.sum("size").over(permuted.rowsBetween(Window.unboundedPreceding, 0))
        by_block = by_block.withColumns({"upto": upto, "place": F.row_number().over(permuted)})
        # whole blocks of the last pass, and the one that the target ends in
        whole, edge = F.col("upto") <= F.col("rest"), (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest"))
        by_block = by_block.withColumns({"whole": whole, "edge": edge, "left": F.when(edge, F.col("rest") - (F.col("upto") - F.col("size")))})
        by_block = self.scratch.table(by_block, "blocks")
        edges = by_block.where("edge").select("src", "block", "left")
        inside = self.light.join(hint(edges), ["src", "block"]).groupBy("src", "block", "draw").agg(F.sum("size").alias("size"), F.first("left").alias("left"))
        last = self.scratch.table(self._filled(inside), "last")
        # every taking of a block, numbered within its source: pass by pass, in permuted order
        times = F.col("passes") + (F.col("whole") | F.col("edge")).cast("int")
        takes = by_block.where(times > 0).select("src", "block", "place", F.explode(F.sequence(F.lit(1), times)).alias("pass"))
        takes = takes.withColumn("number", F.row_number().over(Window.partitionBy("src").orderBy("pass", "place")) - 1)
        takes = self.scratch.table(takes, "takes")
        quota = {r[0]: r[1] for r in takes.groupBy("src").count().collect()}
        names = [p[0] for p in plan if p[0] in quota]
        walk = spark.range(0, shards, 1, max(1, min(shards, 64))).mapInPandas(_walk(names, [quota[x] for x in names], shards, seed), "src string, begin long, number long, shard int")
        dealt = walk.select("src", "shard", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("number") - 1)).alias("number"))
        placed = takes.join(dealt, ["src", "number"]).groupBy("src", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("takes"))
        chosen = by_block.select("src", "block", "passes", "whole", "edge").join(placed, ["src", "block"])
        self.blocks = self.scratch.table(chosen, "chosen").withColumnsRenamed({"passes": "full"})
        self._fits = hint(self.blocks) if few and self.blocks.count() <= BROADCAST_ROWS else self.blocks
        self._last = hint(last) if last.count() <= BROADCAST_ROWS else last
        self._keys = {"src": _source_key(source_col), "draw": order, "size": n_words(whole_text(text_col))}

    def _filled(self, inside: DataFrame) -> DataFrame:
        """(src, block, draw, picked) of what is taken of the block that a target ends in.

        While a source has more than FILL rows left, they are dealt into cells; whole cells are taken, and the cell
        that the target ends in goes on to the next level. A task so never fills from more than FILL rows.
        """
        done = []
        for level in range(8):
            inside = self.scratch.table(inside, f"inside-{level}")
            counts = inside.groupBy("src").agg(F.count("*").alias("n"))
            if not counts.where(F.col("n") > FILL).take(1):
                break
            cells = F.when(F.col("n") > FILL, F.least(F.lit(BLOCKS_EACH), F.ceil(F.col("n") / ROWS_A_BLOCK))).otherwise(1)
            dealt = inside.join(counts, "src").withColumn("cell", F.pmod(F.xxhash64("draw", F.lit(level)), cells).cast("int"))
            order = Window.partitionBy("src").orderBy("cell")
            by_cell = dealt.groupBy("src", "cell").agg(F.sum("size").alias("own"))
            by_cell = by_cell.withColumn("before", F.sum("own").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("own"))
            dealt = dealt.join(by_cell, ["src", "cell"])
            many, rest = F.col("n") > FILL, F.col("left") - F.col("before")
            done.append(dealt.where(many & (F.col("own") <= rest) & (F.col("size") > 0)).select("src", "block", "draw", F.lit(True).alias("picked")))
            # the first cell that doesn't fit; none if all do
            inside = dealt.where((rest > 0) & (F.col("own") > rest) | ~many).select("src", "block", "draw", "size", F.when(many, rest).otherwise(F.col("left")).alias("left"))
        found = inside.groupBy("src", "block").applyInPandas(_fill, "src string, block int, draw long, picked boolean")
        for rows in done:
            found = found.union(rows)
        return found

    def _takes(self, rows: DataFrame) -> DataFrame:
        """rows (with src, block, draw, size) and the takings of each."""
        found = rows.join(self._fits, ["src", "block"], "left").join(self._last, ["src", "block", "draw"], "left")
        own = F.when(~F.col("edge") | F.coalesce("picked", F.lit(False)), F.col("takes")).otherwise(F.slice("takes", 1, F.col("full")))
        return found.withColumn("takes", F.when((F.col("size") > 0) & F.col("takes").isNotNull(), own).otherwise(F.array().cast("array<struct<pass:int,shard:int>>")))

    @property
    def documents(self) -> DataFrame:
        """doc_id, size, source_size, target, taken and takes (pass and shard of each) of every input row."""
        rows = self._takes(self.light)
        return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("takes")).cast("long").alias("taken"), "takes")

    def rows(self) -> DataFrame:
        """The rows of docs as often as the mix takes them, with columns shard, pass and order (own_columns)."""
        names = {c: f"_own_{i}" for i, c in enumerate(self.docs.columns)}
        keyed = self.docs.withColumns({f"_mix_{k}": v for k, v in self._keys.items()}).withColumnsRenamed(names)
        keyed = keyed.withColumnsRenamed({f"_mix_{k}": k for k in self._keys})
        keyed = keyed.join(self._hint(self.plan.select("src", "blocks")), "src").withColumn("block", F.pmod(F.col("draw"), F.col("blocks")).cast("int"))
        taken = self._takes(keyed).select(*names.values(), "draw", F.explode("takes").alias("take"))
        kept = [F.col(n).alias(c) for c, n in names.items()]
        shard, turn, order = self.own_columns
        own = [F.col("take.shard").alias(shard), F.col("take.pass").alias(turn)]
        return taken.select(*kept, *own, F.xxhash64("draw", "take.pass", "take.shard").alias(order))

    @property
    def own_columns(self) -> list[str]:
        """Names of the columns shard, pass and order that rows() adds, longer where the input has such names."""
        return unused(self.docs.columns, "shard", "pass", "order")

    def shuffled(self, parts: int = 16) -> DataFrame:
        """rows() in the order of their shards and shuffled within, a shard dealt over so many tasks."""
        shard, _, order = self.own_columns
        return self.rows().repartition(shard, F.pmod(order, F.lit(parts))).sortWithinPartitions(shard, order)

    def write(self, path: str) -> None:
        """One folder a shard, its rows in shuffled order; a shard's tasks follow from the session's shuffle partitions."""
        shard, _, order = self.own_columns
        self.shuffled(8).drop(order).write.partitionBy(shard).parquet(path)


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = Mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).documents
    shards = F.array_join(F.transform("takes", lambda t: F.concat_ws(":", t["pass"], t["shard"])), ",")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", shards.alias("shards"))
