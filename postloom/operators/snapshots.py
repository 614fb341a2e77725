"""Snapshots: differences, histories, trends and movement between full states of a feed.

A snapshot has a row for each key (company_no, part_no); snapshot_id orders the snapshots. Presence is worked
out by aggregates over keys, so that nothing needs all snapshots of a feed side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["company_no", "part_no"]


def last_two(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the newest and of the previous snapshot."""
    ids = [r[0] for r in snapshots.select("snapshot_id").distinct().orderBy(F.desc("snapshot_id")).limit(2).collect()]
    pick = lambda i: snapshots.where(F.col("snapshot_id") == (ids[i] if len(ids) > i else None))
    return pick(0), pick(1)


def diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Every key of either side: added, removed or continuing."""
    now, then = current.select(*KEY, F.lit(True).alias("_now")), previous.select(*KEY, F.lit(True).alias("_then"))
    status = F.when(F.col("_then").isNull(), "added").when(F.col("_now").isNull(), "removed").otherwise("continuing")
    return now.join(then, KEY, "full").select(*KEY, status.alias("status"))


def company_trends(current: DataFrame, previous: DataFrame) -> DataFrame:
    counted = diff(current, previous).groupBy("company_no").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("added", "removed", "continuing")])
    return counted.select("company_no", (F.col("added") + F.col("continuing")).alias("current_jobs"), (F.col("removed") + F.col("continuing")).alias("previous_jobs"), (F.col("added") - F.col("removed")).alias("net"), "added", "removed")


def history(snapshots: DataFrame) -> DataFrame:
    """Of each key: first and last snapshot, how many, and the score of the latest."""
    return snapshots.groupBy(*KEY).agg(
        F.min("snapshot_id").alias("first_seen"), F.max("snapshot_id").alias("last_seen"), F.count("*").alias("snapshots"), F.max(F.struct("snapshot_id", "score"))["score"].alias("latest_score"),
    )


def reappeared(snapshots: DataFrame) -> DataFrame:
    """Keys of the newest snapshot that were seen before, missing in between and are back: with the last gap."""
    ids = snapshots.select("snapshot_id").distinct()
    number = ids.withColumn("n", F.row_number().over(Window.orderBy("snapshot_id")))
    rows = snapshots.select("snapshot_id", *KEY).join(F.broadcast(number), "snapshot_id")
    before = F.lag("n").over(Window.partitionBy(*KEY).orderBy("n"))
    top = number.agg(F.max("n").alias("top"))
    gaps = rows.withColumn("gap", F.col("n") - before - 1).where("gap > 0")
    found = gaps.groupBy(*KEY).agg(F.count("*").alias("gaps"), F.max(F.struct("n", "gap"))["gap"].alias("last_gap"))
    newest = rows.join(F.broadcast(top), F.col("n") == F.col("top"), "left_semi").select(*KEY)
    return found.join(newest, KEY, "left_semi")


def churn(snapshots: DataFrame) -> DataFrame:
    """Per snapshot: jobs, and how many came and went since the one before."""
    ids = snapshots.select("snapshot_id").distinct().withColumn("n", F.row_number().over(Window.orderBy("snapshot_id")))
    rows = snapshots.select("snapshot_id", *KEY).join(F.broadcast(ids), "snapshot_id")
    own = Window.partitionBy(*KEY).orderBy("n")
    rows = rows.withColumns({"came": F.coalesce(F.col("n") - F.lag("n").over(own) > 1, F.lit(True)), "next": F.lead("n").over(own)})
    gone = rows.where("next is null or next > n + 1").groupBy((F.col("n") + 1).alias("n")).agg(F.count("*").alias("removed"))
    here = rows.groupBy("snapshot_id", "n").agg(F.count("*").alias("jobs"), F.count_if("came").alias("added"))
    return here.join(gone, "n", "left").select("snapshot_id", "jobs", F.when(F.col("n") > 1, F.col("added")).otherwise(0).alias("added"), F.coalesce("removed", F.lit(0)).alias("removed"))


def market(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("snapshot_id").agg(
        F.count("*").alias("jobs"), F.count_distinct("company_no").alias("companies"), F.count_distinct("part_no").alias("titles"), F.round(F.avg("score"), 4).alias("average_score"), F.max("price").alias("highest_price"),
    )


def repeat_companies(snapshots: DataFrame, least: int = 3) -> DataFrame:
    seen = snapshots.groupBy("company_no").agg(F.count_distinct("snapshot_id").alias("snapshots"), F.countDistinct("part_no").alias("titles"), F.min("snapshot_id").alias("first_seen"))
    return seen.where(F.col("snapshots") >= least)


def range_metrics(snapshots: DataFrame) -> DataFrame:
    """Over all snapshots: keys, keys in every one, keys in just one, keys of the newest."""
    n = snapshots.agg(F.count_distinct("snapshot_id").alias("all_ids"), F.max("snapshot_id").alias("newest"))
    keys = history(snapshots).join(F.broadcast(n))
    return keys.agg(
        F.count("*").alias("jobs"), F.count_if(F.col("snapshots") == F.col("all_ids")).alias("persistent"), F.count_if(F.col("snapshots") == 1).alias("once"), F.count_if(F.col("last_seen") == F.col("newest")).alias("present"),
    )
