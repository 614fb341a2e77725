"""Near-duplicate groups by bottom-k sketches.

1. One pass over the texts keeps, for each, the k smallest hashes of its shingle set and a digest of the
   whole set. Texts with equal sets form a class; from here on a class stands for all its copies.
2. Inverted lists of the retained values: a value that only one class retains can link nothing, and of the
   others a class is listed under the rarest only. Two sets with the similarity asked for share at least t
   of k retained values (but for odds of MISS), so that the first k - t + 1 of either meet. A passage that
   thousands of documents share is among the frequent values, and lists them only if most of a sketch is such.
3. The member of a list with the fewest values of its own is its pivot; near copies so share few pivots. The
   members of a pivot's lists form its group, and all pairs that share a list are in a group together. Groups
   are cut into blocks; in a first round a task takes one block and the pivot, so that every member moves once.
4. The sketches in a task estimate who has a partner at all; only those members' full sets are fetched.
5. With the full sets, everyone is verified against the pivot first. What is linked with it needs no more
   comparisons among itself; the others are compared with the rest, as far as sizes and the shingles that
   nobody else in the group has allow a link. Tasks return the links of a spanning forest, never all pairs.
6. Members that their block didn't join to the pivot, of groups of several blocks, visit the other blocks in a
   second round: a group of m members, u of them apart, moves u * m / BLOCK rows more. Near copies of one text
   leave few apart, so that their group costs as much as its members.
7. Components grow by large and small stars over the links, each round a written table, until only stars are left.

No list is expanded into all its pairs, a task holds two blocks at most, and components stay on the executors.
Shingles are compared by 63-bit hashes: two of a corpus of 10^12 different ones collide with odds of about 1e-7 each.

Defined cases: texts without words (or null) have no shingles and link with nothing. A text with fewer words
than a shingle has one shingle, of all its words. Rows that share a doc_id are one document and link. Null
doc_ids are grouped like others but no component is named by one; a component of nothing else has id null.
Other columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import BROADCAST_IDS, Scratch, by_ids, give_back_memory, rows_at_once, small_batches, unused
from postloom.llm.shingles import Shingler

#: Odds that the sketches of a linked pair share too few values.
MISS = 1e-9

_SKETCH = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("sketch", pa.list_(pa.int64()))])
_SKETCH_DDL = "doc_id long, rid long, n long, sig binary, sketch array<long>"
#: Members of a group that a block holds.
BLOCK = 512
#: Memberships that are broadcast at most, about 50 MB as a hash table; beyond it the joins shuffle.
BROADCAST_MEMBERS = 500_000
_SETS = pa.schema([("c", pa.int64()), ("set", pa.binary())])
_SETS_DDL = "c long, set binary"


def least_shared(k: int, similarity: float, miss: float = MISS) -> int:
    """The most t for which fewer than t of k draws, each with that chance, come with odds of at most miss."""
    below = 0.0
    for t in range(k + 1):
        below += math.comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if below > miss:
            return t
    return k


def _sketches(words: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            n, sigs, parts = [], [], []
            for s in shingler.sets(batch.column("text")):
                n.append(len(s))
                sigs.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                parts.append(s[:k].view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            values = pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rid"), pa.array(n, pa.int64()), pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), values)], schema=_SKETCH
            )
        give_back_memory()

    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            ids, sets, size = [], [], 0
            for c, s in zip(batch.column("rid").to_pylist(), shingler.sets(batch.column("text"))):
                ids.append(c)
                sets.append(s.tobytes())
                size += 8 * len(s)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], schema=_SETS)
                    ids, sets, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], schema=_SETS)
        give_back_memory()

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (p, bi, bj), which come one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in ("p", "bi", "bj")])
        cuts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [batch.num_rows]])
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            part = batch.slice(low, high - low)
            if held and any(held[-1].column(k)[0] != part.column(k)[0] for k in ("p", "bi", "bj")):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def shared_counts(values: np.ndarray, owner: np.ndarray, members: int) -> np.ndarray:
    """How many values each two members share, given who has each value."""
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
    counts = np.zeros((members, members), np.int32)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if high - low > 1:
            own = owner[low:high]
            counts[own[:, None], own[None, :]] += 1
    np.fill_diagonal(counts, 0)
    return counts


def _hopeful(k: int, percent: int, least: int, across: bool):
    """Members of a group that have a partner by the sketches, in the other block if across; the pivot stays with them."""
    schema = pa.schema([("p", pa.int64()), ("bi", pa.int32()), ("bj", pa.int32()), ("c", pa.int64()), ("block", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.Table] = []
        for group in _runs(batches):
            sketch = group.column("sketch").combine_chunks()
            n = group.column("n").to_numpy()
            lengths = np.diff(sketch.offsets.to_numpy())
            flat = sketch.flatten().to_numpy()
            common = shared_counts(flat, np.repeat(np.arange(len(n)), lengths), len(n))
            small, large = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
            exact = common * 100 >= percent * (n[:, None] + n[None, :] - common)
            fits = np.where(large <= k, exact, common >= np.where(small * 100 <= percent * k, -(-small * percent // 100), least))
            block = group.column("block").to_numpy()
            fits &= (small * 100 >= large * percent) & (common > 0)
            if across:
                fits &= (block[:, None] >= 0) & (block[None, :] >= 0) & (block[:, None] != block[None, :])
            stays = fits.any(1)
            stays |= (block < 0) & stays.any()
            if stays.sum() > 1:
                done.append(group.select(schema.names).filter(pa.array(stays)))
            if len(done) > 500:
                yield from pa.concat_tables(done).cast(schema).combine_chunks().to_batches()
                done = []
        if done:
            yield from pa.concat_tables(done).cast(schema).combine_chunks().to_batches()
        give_back_memory()

    return run


def spanning_links(sets: list[np.ndarray], block: np.ndarray, percent: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links between members of a group that join all who are connected, and who is connected with member 0.
    It is compared with all first.

    Members of two different blocks are compared, or of one if there is but one; block -1 is the pivot's.
    """
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    _, inverse, times = np.unique(flat, return_inverse=True, return_counts=True)
    # what others have too: no intersection can be larger
    known = n - np.bincount(owner[times[inverse] == 1], minlength=len(sets))
    label, links = np.arange(len(sets)), []
    one_block = len(set(block[block >= 0].tolist())) < 2
    begin = np.cumsum(n) - n

    def compare(x: int, among: np.ndarray) -> None:
        most = np.minimum(known[x], known[among])
        able = (100 * most >= percent * (n[x] + n[among] - most)) & (label[among] != label[x])
        among = among[able]
        if not len(among):
            return
        tokens = np.concatenate([inverse[begin[y] : begin[y] + n[y]] for y in among])
        has = np.zeros(len(times), bool)
        has[inverse[begin[x] : begin[x] + n[x]]] = True
        edges = np.cumsum(n[among]) - n[among]
        common = np.add.reduceat(has[tokens].astype(np.int64), edges)
        for y in among[100 * common >= percent * (n[x] + n[among] - common)].tolist():
            if label[x] != label[y]:
                links.append((x, y))
                label[label == label[y]] = label[x]

    everyone = np.arange(len(sets))
    compare(0, everyone[1:])
    for x in np.flatnonzero(label != label[0]).tolist():
        rest = everyone[1:]
        # of two that are both apart from the pivot, the later is compared with the earlier
        rest = rest[(label[rest] == label[0]) | (rest < x)]
        compare(x, rest if one_block else rest[block[rest] != block[x]])
    return links, label == label[0]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("p", pa.int64()), ("c", pa.int64())])
_LINKS_DDL = "a long, b long, p long, c long"


def _link(percent: int):
    """Links (a, b) of spanning forests, and (p, c) of the members that are joined to their pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(4)], schema=_LINKS)

        for group in _runs(batches):
            block = group.column("block").to_numpy()
            order = np.argsort(block, kind="stable")  # the pivot first
            ids = group.column("c").to_numpy()[order]
            data = group.column("set")
            sets = [np.frombuffer(data[i].as_py(), np.uint64) for i in order.tolist()]
            links, joined = spanning_links(sets, block[order], percent)
            found += [(int(ids[x]), int(ids[y]), None, None) for x, y in links]
            found += [(None, None, int(ids[0]), int(c)) for c in ids[1:][joined[1:]]]
            if len(found) > 10_000:
                yield flush()
                found = []
        yield flush()
        give_back_memory()

    return run


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(c, label) of every end of the edges (a, b): label is the smallest id that c is connected with.

    Large stars and small stars in turn, until nothing changes; the number of rounds grows with the
    logarithm of the longest path.
    """
    def sorted_pair(u: str, v: str) -> list[Column]:
        return [F.least(u, v).alias("a"), F.greatest(u, v).alias("b")]

    now = scratch.table(edges.where("a <> b").select(*sorted_pair("a", "b")).distinct(), f"{name}-0")
    rounds = 0
    while True:
        # only stars are left when every b has one a, and no a is a b
        edges_now, ends_now = now.agg(F.count("*"), F.count_distinct("b")).first()
        if edges_now == ends_now and not now.join(now.select(F.col("b").alias("a")), "a", "left_semi").take(1):
            break
        rounds += 1
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(*sorted_pair("v", "m")).where("a <> b").distinct()
        large = scratch.table(large, f"{name}-{rounds}-large")
        # small stars: a is always the smaller end, so the smaller neighbours of b are its rows
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        down = large.join(least, "b")
        small = down.select(*sorted_pair("a", "m")).union(least.select(*sorted_pair("b", "m"))).where("a <> b").distinct()
        now = scratch.table(small, f"{name}-{rounds}")
        scratch.drop(f"{name}-{rounds}-large")
        scratch.drop(f"{name}-{rounds - 1}")
    ends = now.select(F.col("b").alias("c"), F.col("a").alias("label"))
    return ends.union(now.select(F.col("a").alias("c"), F.col("a").alias("label")).distinct())


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, k: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept.

    Documents are linked if their shingle sets have a Jaccard similarity of at least percent / 100.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    text = F.col(text_col).cast("string")
    rid = F.coalesce(F.col(id_col).cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(text), 1))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), rid.alias("rid"), F.encode(text, "UTF-8").alias("text"))
    with small_batches(spark):
        rows = scratch.table(source.mapInArrow(_sketches(words, k), _SKETCH_DDL), "sketches")
    classes = rows.where("n > 0").groupBy("sig").agg(F.min("rid").alias("c"), F.min("doc_id").alias("head"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = scratch.table(classes, "classes")

    t_k = least_shared(k, percent / 100)
    size = F.least("n", F.lit(k))
    shared_least = F.when(F.col("n") * 100 <= percent * k, F.ceil(F.col("n") * percent / F.lit(100))).otherwise(t_k)
    values = classes.select("c", F.explode("sketch").alias("v"))
    frequent = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    listed = values.join(frequent, "v").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    listed = listed.join(classes.select("c", "n"), "c")
    # a class's first values are those that nobody shares; of the places left, the rarest
    places = size - shared_least + 1 - (size - F.size("vs"))
    alone = F.round(1 - F.size("vs") / size, 3)
    listed = listed.where(F.size("vs") >= shared_least).select("c", F.struct(alone.alias("alone"), (-F.col("n")).alias("n"), "c").alias("rank"), F.explode(F.slice("vs", 1, F.greatest(places, F.lit(0)).cast("int"))).alias("x"))
    lists = scratch.table(listed.select("c", "rank", F.col("x.v").alias("v")), "lists")

    # Groups around pivots: (p, bi, bj) is a task's share, block tells the pivot (-1), residents (0) and visitors (1).
    pivots = lists.groupBy("v").agg(F.min("rank").alias("best"), F.count("*").alias("listed")).where("listed > 1").select("v", F.col("best.c").alias("p"))
    members = lists.join(pivots, "v").where("c <> p").select("p", "c").distinct()
    members = scratch.table(members, "memberships")
    blocks = members.groupBy("p").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = scratch.table(members.join(blocks, "p").withColumn("bj", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")), "blocks")
    own = classes.select("c", "n", "sketch")

    def linked(placed: DataFrame, tag: str, across: bool) -> DataFrame:
        """Links and joined members of the tasks' shares, with the pivot in each."""
        placed = scratch.table(placed, f"members{tag}")
        joined = placed.union(placed.select("p", "bi", "bj", F.col("p").alias("c"), F.lit(-1).alias("block")).distinct())
        few = placed.count() <= BROADCAST_MEMBERS
        groups = own.join(F.broadcast(joined) if few else joined, "c").repartition("p", "bi", "bj").sortWithinPartitions("p", "bi", "bj", "block", "c")
        hopeful = groups.select("p", "bi", "bj", "c", "block", "n", "sketch").mapInArrow(_hopeful(k, percent, t_k, across), "p long, bi int, bj int, c long, block int")
        with rows_at_once(spark, 2000):
            hopeful = scratch.table(hopeful, f"hopeful{tag}")
        wanted = scratch.table(hopeful.select(F.col("c").alias("rid")).distinct(), f"wanted{tag}")
        found = source.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "rid", "left_semi")
        with rows_at_once(spark, 200):
            sets = scratch.table(found.mapInArrow(_full_sets(words), _SETS_DDL), f"sets{tag}")
            full = sets.join(F.broadcast(hopeful) if hopeful.count() <= BROADCAST_MEMBERS else hopeful, "c").repartition("p", "bi", "bj").sortWithinPartitions("p", "bi", "bj", "block", "c")
            links = scratch.table(full.mapInArrow(_link(percent), _LINKS_DDL), f"links{tag}")
        for done in ("members", "hopeful", "wanted", "sets"):
            scratch.drop(f"{done}{tag}")
        return links

    links = linked(members.select("p", F.lit(0).alias("bi"), "bj", "c", F.lit(0).alias("block")), "-1", False)
    apart = members.where("blocks > 1").join(links.where("c is not null").select("p", "c").distinct(), ["p", "c"], "left_anti")
    apart = scratch.table(apart.select("p", "c", "blocks", F.col("bj").alias("home")), "apart")
    if apart.take(1):
        chunks = apart.groupBy("p").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
        visitors = apart.join(chunks, "p").select("p", F.pmod(F.xxhash64("c", F.lit(1)), F.col("chunks")).cast("int").alias("bi"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("bj"), "c", "home")
        visitors = visitors.where("bj <> home").select("p", "bi", "bj", "c", F.lit(1).alias("block"))
        residents = members.join(chunks, "p").select("p", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("bi"), "bj", "c", F.lit(0).alias("block"))
        links = links.select("a", "b").union(linked(residents.union(visitors), "-2", True).select("a", "b"))
    links = links.where("a is not null").select("a", "b")
    label = scratch.table(components(links, scratch, "cc"), "labels")
    for done in ("lists", "memberships", "blocks", "apart", "links-1", "links-2"):
        scratch.drop(done)

    # From classes to rows: only classes of several rows or with links need a look-up.
    moved = classes.where("head is not null or copies > 1").join(label, "c", "left").where("copies > 1 or label is not null").select("sig", "head", F.coalesce("label", "c").alias("label"))
    heads = moved.groupBy("label").agg(F.min("head").alias("component"))
    named = moved.join(heads, "label").select("sig", "component", F.lit(True).alias("found"))
    out = rows.select("doc_id", "n", "sig").join(named, "sig", "left")
    component = F.when(F.col("found"), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which one document of each group stays: the smallest id, null after all others; of rows that share it any one."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    if not docs.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1)).take(1):
        decided = near_dedup(docs, words, percent, id_col=id_col, text_col=text_col).where("not kept")
        return by_ids(docs, scratch.table(decided.select("doc_id"), "dropped"), id_col, "left_anti")
    # ids that don't tell rows apart: the rows get numbers, and each group's best row is found by id
    (own,) = unused(docs.columns, "own_number")
    docs = scratch.table(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    decided = near_dedup(docs, words, percent, id_col=own, text_col=text_col).where("n_shingles > 0").select(F.col("doc_id").alias("number_"), "component_id")
    ids = docs.select(F.col(own).alias("number_"), F.struct(F.col(id_col).isNull().alias("void"), F.col(id_col).alias("id"), F.col(own).alias("n")).alias("rank"))
    ranked = scratch.table(decided.join(ids, "number_"), "ranked")
    best = ranked.groupBy("component_id").agg(F.min("rank").alias("best"))
    dropped = scratch.table(ranked.join(best, "component_id").where("rank <> best").select("number_"), "dropped")
    return by_ids(docs, dropped, own, "left_anti").drop(own)


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85)


#: Links by full comparison of every two documents that share a shingle, components by recursion.
SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
s as materialized (
  select doc_id, unnest(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(list_slice(words, i, i + 2), ' '))) end) as x from w),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
o as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
e as materialized (
  select a, b from o join n p on p.doc_id = a join n q on q.doc_id = b where 100 * common >= 85 * (p.n + q.n - common)),
d as (select a, b from e union select b, a from e),
r(x, y) as (select doc_id, doc_id from w union select r.x, d.b from r join d on d.a = r.y)
select x as doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(y) as component_id, x = min(y) as kept
from r left join n on n.doc_id = x group by x"""
