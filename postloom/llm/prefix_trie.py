"""A prefix trie of conversations by partition refinement.

1. Every turn is reduced to a key (a digest of role and text) and its length, and gets its place in its
   conversation from range-sorted partitions. Where conversations are rebuilt with a shared head, the head's turns go before their own.
2. All conversations start in one class. A round splits the active classes by the key of their next turn, by
   partial aggregates. A class of one retires: the rest of its conversation is emitted as a unary chain, by a join.
   A class whose members have at most LOCAL turns left is refined to the end by one task, in the same way.
   Larger classes stay active. Members without a next turn end at their class's node.
3. Sums are folded back round by round, from the deepest active classes up to the root.

A class with a third of all conversations is split by aggregates and joins, never gathered. Rounds are as many as the depth to
which a class keeps more than LOCAL turns; a round reads only the turns of its depths. Ids of the members that end at one
active node are hashed as a stream: sorted ranges are joined to text of at most CHUNK ids, these are hashed in order.

Defined cases: a null role or text is empty. Turns come by number, null first, ties by the digest of role and
text; each of the rows that repeat a turn counts. Rows without a conv_id belong to no conversation and are left out. Other
columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, give_back_memory
from postloom.operators.ordering import numbered

#: Turns and members of a class that one task refines to the end.
LOCAL = 20_000
#: Ids of a piece of text that is hashed.
CHUNK = 50_000
#: Classes that are broadcast at most; beyond it the join shuffles.
BROADCAST_CLASSES = 100_000
#: Depths that are stored together.
BAND = 16

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODE = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [("ends_sha256", pa.string())])
_EMPTY = hashlib.sha256().hexdigest()


def digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def refine(depth: int, parent: int | None, chars: int, members: dict[int, list[tuple]]) -> list[list]:
    """The nodes of one class's subtree, its top first: members' remaining turns are (key, chars), by rising id."""
    nodes: list[list] = []
    own: list[int] = []  # saved by the node itself
    above: list[int] = []
    todo = [(sorted(members), 0, parent, chars, -1)]
    while todo:
        ids, d, parent, chars, up = todo.pop()
        at = len(nodes)
        ends = [i for i in ids if len(members[i]) == d]
        nodes.append([ids[0], depth + d, parent, len(ids), 0, 0, 0, digest(ends)])
        own.append((len(ids) - 1) * chars)
        above.append(up)
        if len(ids) == 1:  # retires: its tail is a chain
            first, left = ids[0], len(members[ids[0]]) - d
            for k in range(1, left + 1):
                nodes.append([first, depth + d + k, first, 1, 0, 0, 0, digest([first]) if k == left else _EMPTY])
                own.append(0)
                above.append(len(nodes) - 2)
            continue
        split: dict[tuple, list[int]] = {}
        for i in ids:
            if len(members[i]) > d:
                split.setdefault(members[i][d], []).append(i)
        todo += [(part, d + 1, ids[0], key[1], at) for key, part in split.items()]
    for at in range(len(nodes) - 1, -1, -1):  # fold back: children stand after their parents
        node = nodes[at]
        node[5] = node[5] or 1
        node[6] += own[at]
        if above[at] >= 0:
            up = nodes[above[at]]
            up[4] += 1
            up[5] += node[5]
            up[6] += node[6]
    return nodes


def _refine_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by class, conversation and place: one class after the other."""
    done: list[list] = []
    at, top, members = None, (), {}

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(list(zip(*done)) or [[]] * len(_NODE), _NODE)], schema=_NODE)

    for batch in batches:
        for cls, depth, parent, chars, conv, key, own in zip(*(batch.column(k).to_pylist() for k in ("cls", "depth", "parent", "cls_chars", "conv", "key", "chars"))):
            if cls != at:
                if members:
                    done += refine(*top, members)
                at, top, members = cls, (depth, parent, chars), {}
                if len(done) > 20_000:
                    yield flush()
                    done = []
            turns = members.setdefault(conv, [])
            if key is not None:
                turns.append((key, own))
    if members:
        done += refine(*top, members)
    yield flush()
    give_back_memory()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids sorted by node and id: each run of a node's ids as text, at most CHUNK of them."""
    at, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["conv_id", "depth", "first", "ids"])

    for batch in batches:
        for node, depth, conv in zip(*(batch.column(k).to_pylist() for k in ("cls", "depth", "conv"))):
            if (node, depth) != at or len(ids) == CHUNK:
                if ids:
                    yield piece()
                at, ids = (node, depth), []
            ids.append(conv)
    if ids:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, sha = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([sha.hexdigest()])], ["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        for node, depth, ids in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "depth", "ids"))):
            if (node, depth) != at:
                if sha:
                    yield row()
                at, sha = (node, depth), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
    if sha:
        yield row()


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv, place (from 0), key and chars of every turn of a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.sha2(F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256)
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", key.alias("key"), F.char_length(text).cast("long").alias("chars"))
    return _placed(rows, [F.asc_nulls_first("turn"), F.col("key")]).select("conv", "place", F.substring("key", 1, 32).alias("key"), "chars")


def _placed(rows: DataFrame, order: list) -> DataFrame:
    """rows with their place in their conversation, from 0; a long conversation lies in many range partitions."""
    placed = numbered(rows, [F.col("conv"), *order]).withColumnRenamed("place", "at")
    starts = placed.groupBy("conv").agg(F.min("at").alias("start"))
    return placed.join(starts, "conv").withColumn("place", F.col("at") - F.col("start")).drop("at", "start")


def rebuilt(turns: DataFrame, sizes: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Each conversation c begins with the first h turns of conversation c - c % every, h = crc32(c) % most, then has its own after its first h.

    The turns, and the sizes of all conversations, also those that end up without a turn.
    """
    head = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % most
    plan = sizes.select("conv", "n", head.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(bases, "base", "left").withColumn("p", F.least("h", F.coalesce("base_n", F.lit(0))))
    heads = turns.where((F.col("place") < most - 1) & (F.col("conv") % every == 0)).select(F.col("conv").alias("base"), "place", "key", "chars")
    first = plan.select("conv", "base", "p").join(heads, "base").where("place < p").select("conv", "place", "key", "chars")
    own = turns.join(plan.select("conv", "h", "p"), "conv").where("place >= h").select("conv", (F.col("place") - F.col("h") + F.col("p")).alias("place"), "key", "chars")
    return first.unionByName(own), plan.select("conv", (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("p")).alias("n"))


def prefix_trie(turns: DataFrame, sizes: DataFrame, local: int = LOCAL) -> DataFrame:
    """The nodes of the trie: turns has conv, place (from 0), key, chars; sizes has conv and n of every conversation."""
    spark = turns.sparkSession
    scratch = Scratch(spark, "prefix-trie")
    turns = turns.withColumn("band", F.floor(F.col("place") / BAND).cast("int"))
    turns.write.partitionBy("band").parquet(scratch.path("turns"))
    turns = spark.read.schema(turns.schema).parquet(scratch.path("turns"))
    sizes = scratch.table(sizes, "sizes")

    root = sizes.agg(F.min("conv").alias("cls"), F.count("*").alias("n_convs"), F.sum("n").alias("rest")).first()
    if not root["n_convs"]:
        return spark.createDataFrame([], NODE)
    found = []  # nodes with all their columns
    folds = []  # per depth: the active classes
    ends = []
    tops = []  # per depth: parent, n_leaves, saved of what isn't active
    depth = 0
    whole = root["n_convs"] + root["rest"] <= local
    classes = spark.createDataFrame([(root["cls"], None, root["n_convs"], 0)], "cls long, parent long, n_convs long, chars long")
    members = sizes.select(F.lit(root["cls"]).alias("cls"), "conv", "n")

    def finish(members: DataFrame, classes: DataFrame, depth: int) -> DataFrame:
        """Refines the classes in tasks: all nodes below and with them."""
        mine = members.join(turns.where(F.col("place") >= depth).select("conv", "place", "key", "chars"), "conv", "left")
        mine = mine.join(classes.select("cls", "parent", F.col("chars").alias("cls_chars")), "cls").withColumn("depth", F.lit(depth).cast("long"))
        mine = mine.repartition("cls").sortWithinPartitions("cls", "conv", "place").select("cls", "depth", "parent", "cls_chars", "conv", "key", "chars")
        return scratch.table(mine.mapInArrow(_refine_classes, NODE), f"refined-{depth}")

    if whole:
        return finish(members.drop("n"), classes, 0)
    while True:
        folds.append(classes.withColumn("depth", F.lit(depth).cast("long")))
        now = turns.where((F.col("place") == depth) & (F.col("band") == depth // BAND)).select("conv", "key", "chars")
        stepped = scratch.table(members.join(now, "conv", "left"), f"stepped-{depth}")
        ends.append(stepped.where("key is null").select("cls", F.lit(depth).cast("long").alias("depth"), "conv"))
        split = stepped.where("key is not null").groupBy("cls", "key").agg(F.min("conv").alias("next"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.sum(F.col("n") - depth - 1).alias("rest"))
        split = scratch.table(split, f"split-{depth}")
        depth += 1
        # classes of one: their nodes and the chains below
        single = split.where("n_convs = 1").select(F.col("next").alias("conv"), "cls", "rest")
        chain = turns.where((F.col("place") >= depth - 1)).select("conv", F.col("place").alias("place")).join(single, "conv")
        last = F.col("place") == F.col("rest") + depth - 1
        found.append(
            chain.select(
                F.col("conv").alias("conv_id"), (F.col("place") + 1).alias("depth"), F.when(F.col("place") == depth - 1, F.col("cls")).otherwise(F.col("conv")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
                F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(_EMPTY).alias("ends_sha256"),
            )
        )
        # the others: small ones to tasks, large ones to the next round
        more = split.where("n_convs > 1")
        (number,) = more.agg(F.count("*")).first()
        if not number:
            tops.append(single.select("cls", F.lit(1).alias("n_leaves"), F.lit(0).alias("saved")))
            break
        named = more.select("cls", "key", "next", (F.col("n_convs") + F.col("rest") <= local).alias("small"))
        named = F.broadcast(named) if number <= BROADCAST_CLASSES else named
        dealt = scratch.table(stepped.where("key is not null").join(named, ["cls", "key"]).select(F.col("next").alias("cls"), "conv", "n", "small"), f"dealt-{depth}")
        kinds = more.select(F.col("next").alias("cls"), F.col("cls").alias("parent"), "n_convs", "chars", (F.col("n_convs") + F.col("rest") <= local).alias("small"))
        refined = finish(dealt.where("small").select("cls", "conv"), kinds.where("small"), depth)
        found.append(refined)
        own = refined.where((F.col("depth") == depth)).select(F.col("parent_conv_id").alias("cls"), "n_leaves", F.col("saved_tokens").alias("saved"))
        tops.append(single.select("cls", F.lit(1).alias("n_leaves"), F.lit(0).alias("saved")).unionByName(own))
        classes, members = kinds.where("not small").drop("small"), dealt.where("not small").drop("small")
        if not classes.take(1):
            break

    # fold back, from the deepest active classes to the root
    below, nodes = None, []
    for d in range(len(folds) - 1, -1, -1):
        children = tops[d] if below is None else tops[d].unionByName(below)
        sums = children.groupBy("cls").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        total = folds[d].join(sums, "cls", "left").select(
            "cls", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            (F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("chars")).cast("long").alias("saved"),
        )
        total = scratch.table(total, f"folded-{d}")
        nodes.append(total)
        below = total.where("parent is not null").select(F.col("parent").alias("cls"), "n_leaves", "saved")
    active = _union(nodes).select(F.col("cls").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = _union(ends).repartitionByRange(parts, "cls", "depth", "conv").sortWithinPartitions("cls", "depth", "conv").mapInArrow(_pieces, "conv_id long, depth long, first long, ids string")
    hashes = scratch.table(pieces, "pieces").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").mapInArrow(_hash_pieces, "conv_id long, depth long, ends_sha256 string")
    active = active.join(hashes, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    return _union([active, *found])


def _union(parts: list[DataFrame]) -> DataFrame:
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    return done


def conversation_trie(conversations: DataFrame, every: int | None = None, local: int = LOCAL) -> DataFrame:
    """The trie of conversations as they are, or rebuilt with the heads of every so many."""
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    turns = scratch.table(turns_of(conversations), "placed")
    sizes = scratch.table(turns.groupBy("conv").agg(F.count("*").alias("n")), "counted")
    if every:
        turns, sizes = rebuilt(turns, sizes, every)
    return prefix_trie(turns, sizes, local)


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), every=100)


# crc32 isn't among DuckDB's functions: bit by bit over the digits of conv_id.
SQL = """
with recursive
src as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || text)) - 1 as place, role, text from src),
c as (select conv_id, count(*) as n, cast(conv_id as varchar) as s from t group by conv_id),
crc as (
  select conv_id, s, 1 as i, 4294967295::bigint as v from c
  union all
  select conv_id, s, i + 1, list_reduce([xor(v, ascii(s[i])::bigint), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) from crc where i <= length(s)),
h as (select conv_id, xor(v, 4294967295) % 6 as h, conv_id - conv_id % 100 as base from crc where i = length(s) + 1),
p as (select h.conv_id, h.h, h.base, least(h.h, coalesce(b.n, 0)) as p from h left join c b on b.conv_id = h.base),
r as (
  select p.conv_id, t.place, t.role, t.text from p join t on t.conv_id = p.base where t.place < p.p
  union all
  select p.conv_id, t.place - p.h + p.p, t.role, t.text from p join t on t.conv_id = p.conv_id where t.place >= p.h),
l as (select p.conv_id, count(r.place) as n from p left join r using (conv_id) group by p.conv_id),
pre as (
  select conv_id, 0::bigint as depth, '' as k, 0::bigint as chars from p
  union all
  select pre.conv_id, pre.depth + 1, sha256(pre.k || length(r.role) || ':' || r.role || r.text), length(r.text) from pre join r on r.conv_id = pre.conv_id and r.place = pre.depth),
m as (select *, min(conv_id) over (partition by depth, k) as node from pre),
up as (select a.conv_id, a.depth, b.node as parent from m a join m b on b.conv_id = a.conv_id and b.depth = a.depth - 1),
nodes as (select node, m.depth, min(parent) as parent, count(*) as n_convs, max(chars) as chars, coalesce(string_agg(cast(m.conv_id as varchar), ',' order by m.conv_id) filter (where l.n = m.depth), '') as ends
  from m join l on l.conv_id = m.conv_id left join up on up.conv_id = m.conv_id and up.depth = m.depth group by node, m.depth),
kids as (select parent as node, depth - 1 as depth, count(*) as n_children from nodes where parent is not null group by all),
full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (node, depth)),
sub as (
  select node as top, depth as top_depth, node, depth from full_nodes
  union all
  select top, top_depth, f.node, f.depth from sub join full_nodes f on f.parent = sub.node and f.depth = sub.depth + 1),
sums as (select top, top_depth, count(*) filter (where n_children = 0) as n_leaves, sum((n_convs - 1) * chars) as saved from sub join full_nodes using (node, depth) group by all)
select node as conv_id, depth, parent as parent_conv_id, n_convs, n_children, n_leaves, cast(saved as bigint) as saved_tokens, sha256(ends) as ends_sha256
from full_nodes join sums on top = node and top_depth = depth"""
