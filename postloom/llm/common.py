"""Helpers that the corpus operators share: scratch tables on the shared folder and text expressions."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words: space and U+0009 to U+000D.
SEPARATORS = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in spark.checkpoint.dir.

    Only a local session may lack the setting; it gets a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        own = tempfile.mkdtemp(prefix="postloom-")
        atexit.register(shutil.rmtree, own, True)
        spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Scratch:
    """Tables of one operator run, written below the shared folder.

    A written table cuts the lineage and survives lost executors; its readers all see the same rows
    even if the plan that made it isn't deterministic.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/postloom-{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def path(self, label: str) -> str:
        return f"{self.root}/{label}"

    def table(self, df: DataFrame, label: str, **options: str) -> DataFrame:
        df.write.mode("overwrite").options(**options).parquet(self.path(label))
        return self.spark.read.schema(df.schema).parquet(self.path(label))

    def drop(self, label: str | None = None) -> None:
        """Deletes one table, or all of them at the end of the driver; only what no later read needs."""
        try:
            jvm = self.spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(self.path(label) if label else self.root)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session may have ended; the folder is then left to its owner
            if label:
                raise


def unused(names: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, each made longer until it clashes with none of names, in any case."""
    taken, found = {n.lower() for n in names}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text as an array; only the first or last piece of a split can be empty."""
    return F.array_remove(F.split(text, SEPARATORS), "")


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def bound(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_bytes(spark: SparkSession, default: int = 128 << 20) -> int:
    """Bytes that a task should read: the session's own setting for file splits."""
    said = spark.conf.get("spark.sql.files.maxPartitionBytes", str(default)).lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30}
    return int(said[:-1]) << units[said[-1]] if said[-1] in units else int(said)


#: Ids that are broadcast at most, 32 MB; beyond it the join shuffles.
BROADCAST_IDS = 4_000_000


def by_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """The rows of docs whose id is among ids (left_semi) or isn't (left_anti); null is an id like others."""
    named = ids.toDF(*unused(docs.columns, "other_id"))
    found = F.broadcast(named) if named.count() <= BROADCAST_IDS else named
    return docs.join(found, docs[id_col].eqNullSafe(named[named.columns[0]]), how)


@contextlib.contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, tasks hand Python so many rows at once: wide rows in small batches bound its memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: str = "4m", rows: int = 32) -> Iterator[None]:
    """While it lasts, readers take so many rows at once and tasks hand Python batches of about that size: for wide rows."""
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": size, "spark.sql.parquet.columnarReaderBatchSize": str(rows)}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def release_shuffles(spark: SparkSession) -> None:
    """Between steps that end in written tables: Spark deletes the shuffle files of plans that nothing refers to any more.

    The last job's plan is let go a moment after it ends, so the driver collects twice.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)
    spark.sparkContext._jvm.System.gc()


def give_back_memory() -> None:
    """At the end of a task: what Arrow and the allocator hold but don't use goes back to the machine."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
