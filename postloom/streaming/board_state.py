"""Board state over a stream of fetch attempts.

Each micro-batch is reduced to one partial state per board and merged into the stored state. States lie in BUCKETS parts by a
hash of the board: a batch reads and rewrites only those that its boards fall into, below its own number. A batch that is replayed reads
what was before it and writes the same again. Of each part the last two versions stay, older ones go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.operators import boards

BUCKETS = 64
#: A partial state: attempts, the newest one, the newest that didn't fail, and failures after it.
STATE = "BoardKey string, ATS string, AttemptCount long, last struct<FetchedAt:timestamp,seq:long,Status:string,JobCount:long>, LastSuccessAt timestamp, calm struct<FetchedAt:timestamp,seq:long>, ConsecutiveFailures long"


def partial_state(fetches: DataFrame) -> DataFrame:
    at = F.struct("FetchedAt", "seq")
    own = fetches.withColumn("BoardKey", boards.board_key())
    first = own.groupBy("BoardKey").agg(
        F.min("ATS").alias("ATS"), F.count("*").alias("AttemptCount"), F.max(F.struct("FetchedAt", "seq", "Status", "JobCount")).alias("last"),
        F.max(F.when(F.col("Status").isin(*boards.LIVE), F.col("FetchedAt"))).alias("LastSuccessAt"), F.max(F.when(F.col("Status") != "failed", at)).alias("calm"),
    )
    failed = own.where("Status = 'failed'").select("BoardKey", at.alias("at")).join(first.select("BoardKey", "calm"), "BoardKey")
    runs = failed.where(F.col("calm").isNull() | (F.col("at") > F.col("calm"))).groupBy("BoardKey").agg(F.count("*").alias("ConsecutiveFailures"))
    return first.join(runs, "BoardKey", "left").na.fill(0, ["ConsecutiveFailures"])


def merged(before: DataFrame, batch: DataFrame) -> DataFrame:
    """The states of both, where the batch comes after what was before."""
    b = batch.toDF(*[f"b_{c}" if c != "BoardKey" else c for c in batch.columns])
    both = before.join(b, "BoardKey", "full")
    c = F.col
    return both.select(
        "BoardKey", F.coalesce("ATS", "b_ATS").alias("ATS"), (F.coalesce("AttemptCount", F.lit(0)) + F.coalesce("b_AttemptCount", F.lit(0))).alias("AttemptCount"), F.greatest("last", "b_last").alias("last"),
        F.greatest("LastSuccessAt", "b_LastSuccessAt").alias("LastSuccessAt"), F.greatest("calm", "b_calm").alias("calm"),
        F.when(c("b_calm").isNotNull(), c("b_ConsecutiveFailures")).otherwise(F.coalesce("ConsecutiveFailures", F.lit(0)) + F.coalesce("b_ConsecutiveFailures", F.lit(0))).alias("ConsecutiveFailures"),
    )


def as_board_state(state: DataFrame) -> DataFrame:
    status = F.col("last.Status")
    coverage = F.when(status == "success", "JOBS_FOUND").when(status == "empty", "FETCHED_EMPTY").when(status == "failed", "FETCH_FAILED").otherwise("UNSUPPORTED")
    rows = state.withColumns({"CoverageStatus": coverage, "LastFetchStatus": status, "LastAttemptAt": F.col("last.FetchedAt"), "JobCount": F.col("last.JobCount")})
    return rows.withColumn("NextCheckAt", boards.next_check(F.col("CoverageStatus"), F.col("LastAttemptAt"), F.col("ConsecutiveFailures"))).drop("last", "calm")


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _versions(spark: SparkSession, root: str) -> dict[int, list[int]]:
    """Of each bucket, the numbers of the committed batches that wrote it, rising."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, found = path(root).getFileSystem(spark._jsc.hadoopConfiguration()), {}
    for batch in fs.listStatus(path(root)) if fs.exists(path(root)) else []:
        if fs.exists(path(f"{batch.getPath()}/_SUCCESS")):
            number = int(batch.getPath().getName().split("=")[1])
            for part in fs.listStatus(batch.getPath()):
                if part.isDirectory():
                    found.setdefault(int(part.getPath().getName().split("=")[1]), []).append(number)
    return {b: sorted(ns) for b, ns in found.items()}


def read_state(spark: SparkSession, root: str, batch_id: int, buckets: list[int] | None = None) -> DataFrame:
    """The states after that batch, of all buckets or of some."""
    paths = []
    for b, numbers in _versions(spark, root).items():
        own = [n for n in numbers if n <= batch_id]
        if own and (buckets is None or b in buckets):
            paths.append(f"{root}/batch={own[-1]}/bucket={b}")
    return spark.read.schema(STATE).parquet(*paths) if paths else spark.createDataFrame([], STATE)


def follow(fetches: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keeps the state of a stream below root; a batch changes the parts of its boards."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            touched = [r.b for r in batch.select(bucket_of(boards.board_key()).alias("b")).distinct().collect()]  # BUCKETS at most
            now = merged(read_state(spark, root, batch_id - 1, touched), partial_state(batch)).withColumn("bucket", bucket_of(F.col("BoardKey")))
            now.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/batch={batch_id}")
        finally:
            batch.unpersist()
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        for b, numbers in _versions(spark, root).items():
            for old in [n for n in numbers if n <= batch_id][:-2]:
                fs.delete(path(f"{root}/batch={old}/bucket={b}"), True)

    return fetches.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
