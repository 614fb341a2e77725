"""The newest live fetch of each board over a stream of attempts, and the rows that it leaves in force.

Spark keeps the newest fetch of each board as the state of a streaming aggregate. A micro-batch gives only the boards that it
changed; they are written as one numbered set of changes. The number is the last thing that is written, so a batch that is
replayed finds its number taken and changes nothing, and one that died before is written anew. Every COMPACT sets,
the changes become one base and older folders go. Late rows need no watermark: an older fetch never wins over a newer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.operators import boards

COMPACT = 8
NEWEST = "BoardKey string, newest struct<FetchedAt:timestamp,seq:long,Status:string,SourceBatch:string>"


class Newest:
    """The table of newest fetches below a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self, kind: str) -> list[int]:
        """The committed sets: Spark marks a folder when it is whole."""
        folder = self.path(f"{self.root}/{kind}")
        found = [int(s.getPath().getName()) for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return sorted(n for n in found if self.fs.exists(self.path(f"{self.root}/{kind}/{n}/_SUCCESS")))

    def committed(self) -> int:
        return max([*self.numbers("changes"), *self.numbers("base")], default=-1)

    def read(self) -> DataFrame:
        base = self.numbers("base")[-1:]
        changes = [n for n in self.numbers("changes") if not base or n > base[0]]
        paths = [f"{self.root}/base/{n}" for n in base] + [f"{self.root}/changes/{n}" for n in changes]
        if not paths:
            return self.spark.createDataFrame([], NEWEST)
        return self.spark.read.schema(NEWEST).parquet(*paths).groupBy("BoardKey").agg(F.max("newest").alias("newest"))

    def take(self, changed: DataFrame, number: int) -> bool:
        if number <= self.committed():
            return False
        changed.write.mode("overwrite").parquet(f"{self.root}/changes/{number}")
        if len(self.numbers("changes")) >= COMPACT:
            self.read().write.mode("overwrite").parquet(f"{self.root}/base/{number}")
            for kind, old in [("changes", n) for n in self.numbers("changes") if n <= number] + [("base", n) for n in self.numbers("base") if n < number]:
                self.fs.delete(self.path(f"{self.root}/{kind}/{old}"), True)
        return True


def follow(fetches: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Takes all that the stream has and stops; a later call goes on from there."""
    live = fetches.where(F.col("Status").isin(*boards.LIVE)).groupBy(boards.board_key().alias("BoardKey")).agg(F.max(F.struct("FetchedAt", "seq", "Status", "SourceBatch")).alias("newest"))

    def step(batch: DataFrame, number: int) -> None:
        Newest(batch.sparkSession, root).take(batch, number)

    return live.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
