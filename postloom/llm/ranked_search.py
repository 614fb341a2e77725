"""Ranked lexical search with a hierarchical max tree over document ranges.

1. One pass over the documents counts terms. A task cuts its documents into ranges of at most RANGE, and writes
   for each range the terms of its documents that some query has. Counts of documents, terms and documents a
   term come from the same pass.
2. Each range becomes a tree: its leaves hold every document's part of the score of each term, a node above
   holds for each term the largest part below it, FAN children a node, up to one root.
3. The weights of a query times the largest parts of a node bound the scores below it. The roots of all ranges
   give, for each query, the ranges with the highest bounds; the k-th best score in these is a floor.
4. All ranges are then read once. In each, a query descends best-first: the node with the highest bound opens
   next, until the bound is below the k-th best score so far. Nodes with an equal bound still open, as a
   smaller doc_id wins ties. The best k of each task are ranked together.

Queries go through in blocks, bounded by the bytes of their text; a block's terms and floors are what the
driver holds and what tasks get. A task holds one range's tree and k results for each query of the block.

Defined cases: a null or empty text has no terms and doesn't count as a document; it is no one's result. A query
without a term found gives no row. Rows that repeat a doc_id are documents of their own. Rows that repeat item
and text of a query count once; other texts of one item are queries of their own. Null doc_ids come last in ties.
Other columns aren't read. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postloom.llm.common import Scratch, give_back_memory, small_batches, whole_text

#: Documents and postings of a range at most (one document may have more), and children of a node.
RANGE, POSTINGS, FAN = 1024, 128 << 10, 16
#: Ranges that give each query its floor.
SEEDS = 2
#: Bytes of query text in a block.
BLOCK_BYTES = 4 << 20
#: Bytes to a space if they end a term, else lower-cased; every byte of a code point above U+007F is part of a term.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32) for b in range(256))

_RAW = pa.schema(
    [("range", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()), ("ends", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
    + [("df_term", pa.list_(pa.int32())), ("df", pa.list_(pa.int64()))]
)
_RAW_DDL = "range long, ids binary, lengths binary, ends binary, terms binary, counts binary, n_docs long, n_terms long, df_term array<int>, df array<long>"
_TREE = pa.schema([("range", pa.int64()), ("ids", pa.binary()), ("root_terms", pa.binary()), ("root_most", pa.binary()), ("ends", pa.list_(pa.binary())), ("terms", pa.list_(pa.binary())), ("most", pa.list_(pa.binary()))])
_TREE_DDL = "range long, ids binary, root_terms binary, root_most binary, ends array<binary>, terms array<binary>, most array<binary>"
_BOUND = pa.schema([("query", pa.int32()), ("range", pa.int64()), ("bound", pa.int64())])
_FOUND = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
#: Stands for a null doc_id: after all others.
_LAST = np.iinfo(np.int64).max


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _read(vocabulary: dict[bytes, int], range_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        n_docs = n_terms = 0
        df: Counter = Counter()
        ids, lengths, ends, terms, counts = [], [], [], [], []

        def written(last: bool) -> pa.RecordBatch:
            blobs = [np.array(x, t).tobytes() for x, t in ((ids, "<i8"), (lengths, "<i8"), (ends, "<i4"), (terms, "<i4"), (counts, "<i4"))]
            stats = (n_docs, n_terms, list(df), list(df.values())) if last else (None,) * 4
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip([number, *blobs, *stats], _RAW)], schema=_RAW)

        for batch in batches:
            for doc_id, text in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text"))):
                found = terms_of(text)
                if not found:
                    continue
                n_docs += 1
                n_terms += len(found)
                own = [(vocabulary[t], n) for t, n in Counter(found).items() if t in vocabulary]
                if not own:
                    continue
                df.update([t for t, _ in own])
                ids.append(_LAST if doc_id is None else doc_id)
                lengths.append(len(found))
                terms += [t for t, _ in own]
                counts += [n for _, n in own]
                ends.append(len(terms))
                if len(ids) == range_docs or len(terms) >= POSTINGS:
                    yield written(False)
                    number += 1
                    ids, lengths, ends, terms, counts = [], [], [], [], []
        yield written(True)
        give_back_memory()

    return run


def levels_of(ends: np.ndarray, terms: np.ndarray, most: np.ndarray, fan: int = FAN) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The levels of a range's tree from its leaves up to the root: where each node's entries end, their terms, their maxima."""
    levels = [(ends, terms, most)]
    while len(ends) > 1:
        node = np.repeat(np.arange(len(ends)) // fan, np.diff(ends, prepend=0))
        order = np.lexsort((terms, node))
        node, terms, most = node[order], terms[order], most[order]
        first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (terms[1:] != terms[:-1])])
        most, terms = np.maximum.reduceat(most, first), terms[first]
        ends = np.searchsorted(node[first], np.arange(-(-len(ends) // fan)), "right")
        levels.append((ends, terms, most))
    return levels


def _grow(n: int, total: int, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends, terms, counts = (np.frombuffer(r[k], "<i4").astype(np.int64) for k in ("ends", "terms", "counts"))
                if not len(ends):
                    continue
                slow = 75 + 25 * np.frombuffer(r["lengths"], "<i8") * n // total
                part = 1_000_000_000 * counts // (1000 * counts + 12 * np.repeat(slow, np.diff(ends, prepend=0)))
                levels = levels_of(ends, terms, part, fan)
                packed = [[x[i].astype("<i4").tobytes() for x in levels] for i in range(3)]
                row = [r["range"], r["ids"], packed[1][-1], packed[2][-1], *packed]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _TREE)], schema=_TREE)
        give_back_memory()

    return run


class Block:
    """Queries as weights: for query q the terms[starts[q]:starts[q + 1]], each with weight and repeats multiplied."""

    def __init__(self, texts: list[bytes]):
        self.vocabulary: dict[bytes, int] = {}
        self.own = [{self.vocabulary.setdefault(t, len(self.vocabulary)): n for t, n in Counter(terms_of(x)).items()} for x in texts]
        self.starts = np.cumsum([0, *map(len, self.own)])
        self.terms = np.array([t for own in self.own for t in own], np.int64)

    def weigh(self, n: int, df: dict[int, int]) -> None:
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
        self.weights = np.array([weight.get(t, 0) * c for own in self.own for t, c in own.items()], np.int64)

    def bounds(self, terms: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The bound of each query in a node."""
        of_term = np.zeros(len(self.vocabulary), np.int64)
        of_term[terms] = most
        sums = np.concatenate([[0], np.cumsum(self.weights * of_term[self.terms])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]


def _roots(block: Block, seeds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in block.own]
        for batch in batches:
            for number, terms, most in zip(*(batch.column(k).to_pylist() for k in ("range", "root_terms", "root_most"))):
                bounds = block.bounds(np.frombuffer(terms, "<i4"), np.frombuffer(most, "<i4"))
                for q in np.flatnonzero(bounds).tolist():
                    (heapq.heappush if len(best[q]) < seeds else heapq.heappushpop)(best[q], (int(bounds[q]), number))
        flat = [(q, number, bound) for q, own in enumerate(best) for bound, number in own]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(list(zip(*flat)) or [[]] * 3, _BOUND)], schema=_BOUND)

    return run


class Best:
    """The k best documents of a query: the highest score, then the smallest doc_id."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.heap = k, floor, []

    def least(self) -> int:
        """Lower scores can't get in."""
        return max(self.floor, self.heap[0][0]) if len(self.heap) == self.k else self.floor

    def offer(self, score: int, doc_id: int) -> None:
        (heapq.heappush if len(self.heap) < self.k else heapq.heappushpop)(self.heap, (score, -doc_id))


def descend(levels: list, ids: np.ndarray, weights: np.ndarray, bound: int, best: Best, fan: int = FAN) -> int:
    """Best-first through a range's tree; weights has the query's weight of every term. The number of nodes opened."""
    todo, opened = [(-bound, len(levels) - 1, 0)], 0
    if len(levels) == 1 and bound >= best.least():
        best.offer(bound, int(ids[0]))
        return 0
    while todo:
        bound, level, node = heapq.heappop(todo)
        if -bound < best.least():
            break
        opened += 1
        ends, terms, most = levels[level - 1]
        first = node * fan
        cuts = np.concatenate([[ends[first - 1] if first else 0], ends[first : first + fan]])
        sums = np.concatenate([[0], np.cumsum(weights[terms[cuts[0] : cuts[-1]]] * most[cuts[0] : cuts[-1]])])[cuts - cuts[0]]
        bounds = np.diff(sums)
        for child in np.flatnonzero((bounds > 0) & (bounds >= best.least())).tolist():
            if level == 1:
                best.offer(int(bounds[child]), int(ids[first + child]))
            else:
                heapq.heappush(todo, (-int(bounds[child]), level - 1, first + child))
    return opened


def _search(block: Block, k: int, floors: np.ndarray, only: dict[int, list[int]] | None, fan: int):
    """only: the queries of each range, else every query whose bound reaches its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(k, int(x)) for x in floors]
        for batch in batches:
            for r in batch.to_pylist():
                bounds = block.bounds(np.frombuffer(r["root_terms"], "<i4"), np.frombuffer(r["root_most"], "<i4"))
                ids = np.frombuffer(r["ids"], "<i8")
                levels = [tuple(np.frombuffer(x, "<i4").astype(np.int64) for x in level) for level in zip(r["ends"], r["terms"], r["most"])]
                weights = np.zeros(len(block.vocabulary), np.int64)
                asked = only.get(r["range"], ()) if only is not None else np.flatnonzero((bounds > 0) & (bounds >= floors)).tolist()
                for q in asked:
                    if bounds[q] < found[q].least():
                        continue
                    own = slice(block.starts[q], block.starts[q + 1])
                    weights[block.terms[own]] = block.weights[own]
                    descend(levels, ids, weights, int(bounds[q]), found[q], fan)
                    weights[block.terms[own]] = 0
        flat = [(q, None if -i == _LAST else -i, score) for q, best in enumerate(found) for score, i in best.heap]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(list(zip(*flat)) or [[]] * 3, _FOUND)], schema=_FOUND)
        give_back_memory()

    return run


def _blocks(queries: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    rows, size = [], 0
    for item, text in queries.select(F.col(id_col).cast("long"), F.encode(whole_text(text_col), "UTF-8")).distinct().toLocalIterator():
        rows.append((item, bytes(text)))
        size += len(text) + 100
        if size >= block_bytes:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _ranked(spark: SparkSession, texts: DataFrame, rows: list[tuple], k: int, scratch: Scratch, label: str, range_docs: int, fan: int) -> DataFrame | None:
    block = Block([text for _, text in rows])
    with small_batches(spark):
        raw = scratch.table(texts.mapInArrow(_read(block.vocabulary, range_docs), _RAW_DDL), f"raw-{label}", compression="zstd")
    n, total = (x or 0 for x in raw.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    if not total:
        return None
    pairs = raw.where("df is not null").select(F.explode(F.arrays_zip("df_term", "df")).alias("x")).select("x.*")
    block.weigh(n, dict(pairs.groupBy("df_term").agg(F.sum("df")).collect()))
    with small_batches(spark):  # rows of up to a MB
        trees = scratch.table(raw.select("range", "ids", "lengths", "ends", "terms", "counts").mapInArrow(_grow(n, total, fan), _TREE_DDL), f"trees-{label}", compression="zstd")
        scratch.drop(f"raw-{label}")
        bounds = trees.select("range", "root_terms", "root_most").mapInArrow(_roots(block, SEEDS), "query int, range long, bound long")
        highest = bounds.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "range"))).where(F.col("r") <= SEEDS)
        only: dict[int, list[int]] = {}
        for q, number in highest.select("query", "range").collect():
            only.setdefault(number, []).append(q)
        ddl, none = "query int, doc_id long, score long", np.zeros(len(rows), np.int64)
        seeds = spark.createDataFrame([(x,) for x in only], "range long")
        first = trees.join(F.broadcast(seeds), "range", "left_semi").select(*trees.columns).mapInArrow(_search(block, k, none, only, fan), ddl)
        floors = none.copy()
        for q, score in first.groupBy("query").agg(F.sort_array(F.collect_list("score"), False).alias("s")).where(F.size("s") >= k).select("query", F.get("s", F.lit(k - 1))).collect():
            floors[q] = score
        found = trees.mapInArrow(_search(block, k, floors, None, fan), ddl)
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        items = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(rows)], "query int, item_id long")
        ranked = found.withColumn("rank", rank).where(F.col("rank") <= k).join(F.broadcast(items), "query").select("item_id", "rank", "doc_id", "score")
        done = scratch.table(ranked, f"ranked-{label}")
    scratch.drop(f"trees-{label}")
    return done


def search(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text", range_docs: int = RANGE, fan: int = FAN, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each query; scores are above 0."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked-search")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(whole_text(text_col), "UTF-8").alias("text"))
    done = None
    for i, rows in enumerate(_blocks(queries, item_col, query_col, block_bytes)):
        part = _ranked(spark, texts, rows, k, scratch, str(i), range_docs, fan)
        done = done.unionByName(part) if done is not None and part is not None else done if part is None else part
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if done is None else done


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
with d as (select doc_id, row_number() over () as r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents where text is not null),
sizes as (select r, doc_id, cast(len(ts) as bigint) as n from d where len(ts) > 0),
totals as (select count(*) as nn, cast(sum(n) as bigint) as ll from sizes),
items as (select distinct item_id, text from benchmark where text is not null),
terms as (select item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from items),
q as (select item_id, text, term, count(*) as c from terms group by all),
post as (select r, term, count(*) as tf from (select r, unnest(ts) as term from d) where term in (select term from q) group by all),
w as (select term, cast(floor(1000 * ln(cast(2 * nn + 2 as double) / (2 * count(*) + 1))) as bigint) as w from post, totals group by term, nn),
scored as (select item_id, q.text, doc_id, r, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) as bigint) as score
  from q join post using (term) join w using (term) join sizes using (r), totals group by all),
ranked as (select *, row_number() over (partition by item_id, text order by score desc, doc_id nulls last) as rank from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 20"""
