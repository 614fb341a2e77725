"""Summaries that grow by batches: counts that add up, and tables of distinct keys that take only new ones."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class RunningSummary:
    """Counts and distinct keys by group, kept below a folder; a batch costs its own rows and the keys in its buckets.

    Each batch leaves a partition of counts, and of keys those that no batch with a smaller number has. A batch that
    is replayed overwrites its own partitions, so that it counts once. Batches may be replayed in any order as long as
    those with larger numbers are replayed after, or the replay has the same rows.
    """

    BUCKETS = 16

    def __init__(self, spark: SparkSession, root: str, group: str, counts: dict[str, Column], distinct: dict[str, Column]):
        self.spark, self.root, self.group, self.counts, self.distinct = spark, root, group, counts, distinct
        self.count_type = f"{group} string, " + ", ".join(f"{c} long" for c in counts) + ", batch long"
        self.key_type = f"{group} string, kind string, key string, batch long, bucket int"

    def _stored(self, table: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(f"{self.root}/{table}")

    def _replace(self, rows: DataFrame, table: str, batch: int, *more: str) -> None:
        """The batch's partition is written beside and takes its place by one rename."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        beside, final = f"{self.root}/_{table}-{uuid.uuid4().hex}", f"{self.root}/{table}/batch={batch}"
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*more) if more else writer).parquet(beside)
        fs = jvm.Path(final).getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(jvm.Path(f"{self.root}/{table}"))
        fs.delete(jvm.Path(final), True)
        if not fs.rename(jvm.Path(beside), jvm.Path(final)):
            raise OSError(f"{final} couldn't be written")

    def add(self, rows: DataFrame, batch: int) -> None:
        own = rows.groupBy(F.col(self.group).cast("string").alias(self.group)).agg(*[F.count_if(c).cast("long").alias(n) for n, c in self.counts.items()])
        self._replace(own, "counts", batch)
        named = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in self.distinct.items()]))
        keys = rows.select(F.col(self.group).cast("string").alias(self.group), named.alias("x")).select(self.group, "x.*").where("key <> ''").distinct()
        keys = keys.withColumn("bucket", F.pmod(F.hash(self.group, "kind", "key"), F.lit(self.BUCKETS)))
        before = self._stored("keys", self.key_type).where(F.col("batch") < batch).drop("batch")
        self._replace(keys.join(before, ["bucket", self.group, "kind", "key"], "left_anti"), "keys", batch, "bucket")

    def summary(self) -> DataFrame:
        """A row a group: sums of the counts and the number of distinct keys of each kind."""
        sums = self._stored("counts", self.count_type).groupBy(self.group).agg(*[F.sum(c).alias(c) for c in self.counts])
        kinds = self._stored("keys", self.key_type).groupBy(self.group).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in self.distinct])
        return sums.join(kinds, self.group, "left").na.fill(0, list(self.distinct))
