"""Global orders without a task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.functions.folders import ensure_checkpoints


def numbered(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """The rows with their place in a total order, from 1.

    Range partitions are numbered on their own; a first pass counts them, and their starts, a line a partition, are
    broadcast. The dealt rows are checkpointed, as range bounds are sampled anew whenever a plan runs. Rows that
    compare equal get places in no set order, so name a last column that tells them apart.
    """
    ensure_checkpoints(df.sparkSession)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols: list[Column] = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(parts, *cols).withColumn("part_", F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy("part_").agg(F.count("*").alias("n_"))
    starts = counts.select("part_", F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start_"))
    within = F.row_number().over(Window.partitionBy("part_").orderBy(*cols))
    return ranged.withColumn("within_", within).join(F.broadcast(starts), "part_").withColumn("place", (F.col("start_") + F.col("within_")).cast("long")).drop("part_", "start_", "within_")


def ranked_within(rows: DataFrame, group: list[str], order: list, id_cols: list[str]) -> DataFrame:
    """id_cols with `rank` (from 1, in that order) and `size` of each group; a group with most rows lies in many tasks.

    rows should be narrow: they are numbered in one order over all, and a group's ranks begin at its smallest number.
    """
    placed = numbered(rows, [*group, *order])
    starts = placed.groupBy(*group).agg(F.min("place").alias("first_"), F.count("*").alias("size"))
    joined = placed.join(starts, group)
    return joined.select(*id_cols, (F.col("place") - F.col("first_") + 1).alias("rank"), "size")


def first_values(rows: DataFrame, group: list[str], value: str, name: str, most: int = 10) -> DataFrame:
    """Of each group its first distinct values that aren't blank, joined by bars; no list is longer than that."""
    values = rows.where(F.col(value) != "").select(*group, value).distinct()
    top = values.withColumn("place_", F.row_number().over(Window.partitionBy(*group).orderBy(value))).where(F.col("place_") <= most)
    return top.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_list(value)), " | ").alias(name))


def spread_key(key: Column, id_col: str) -> Column:
    """The key, or for a blank one something that matches nothing and differs by row: blanks meet in no task."""
    return F.when(key != "", key).otherwise(F.concat(F.lit("\0"), F.col(id_col).cast("string")))
