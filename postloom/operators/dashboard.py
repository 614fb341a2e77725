"""The status dashboard: many counts of different tables in one row, and what to do next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of candidates from which an archive run is worth it.
ARCHIVE_BYTES = 1 << 30


def split_plan(plan: DataFrame, index: DataFrame) -> DataFrame:
    """Plan rows with `State`: READY, STALE (ready, but a batch of that name is there already) or SKIPPED."""
    done = index.select("BatchName").distinct().withColumn("done", F.lit(True))
    ready = F.col("PlanStatus") == "READY"
    return plan.join(done, "BatchName", "left").withColumn("State", F.when(ready & F.col("done").isNotNull(), "STALE").when(ready, "READY").otherwise("SKIPPED")).drop("done")


def next_action(row: dict[str, Column], archive_bytes: int = ARCHIVE_BYTES) -> Column:
    """A ladder: what is missing first, then due boards, then files to archive, else the next release."""
    missing = lambda c: F.coalesce(c, F.lit(0)) == 0
    return (
        F.when(missing(row["TotalRows"]), "PUBLIC_RELEASE").when(missing(row["HealthRows"]), "ATS_HEALTH").when(missing(row["CoverageRows"]), "CRAWL_COVERAGE").when(missing(row["FetchEligibleBoards"]), "BOARD_FRESHNESS")
        .when(row["DueBoards"] > 0, "MAINTAIN_INDEX").when(F.coalesce(row["ArchiveCandidateBytes"], F.lit(0)) > archive_bytes, "ARCHIVE").otherwise("PUBLIC_RELEASE")
    )


def dashboard(sources: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """One row: each source is aggregated once, and its row is looked up as a scalar."""
    spark = next(iter(sources.values()))[0].sparkSession
    row = spark.range(1).select()
    for df, measures in sources.values():
        one = df.agg(F.struct(*[c.alias(n) for n, c in measures.items()]).alias("r")).scalar()
        row = row.withColumn("_r", one).select(*[F.col(f"`{c}`") for c in row.columns], "_r.*")
    return row.withColumn("PlanStale", F.col("StaleReadyRows") > 0).withColumn("SuggestedNextAction", next_action({c: F.col(c) for c in row.columns}))
