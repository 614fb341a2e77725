"""Display rows, checks of a package's data, and outliers among snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import text
from postloom.operators.snapshots import KEY, history

#: What a posting matched by, in the order in which phrases are looked for.
WHY = [
    ("Documentation/docs signal", ["documentation", "docs"]), ("Technical writing/content match", ["technical content", "technical writing", "technical writer"]),
    ("UX/content design signal", ["ux writing", "ux writer", "content design", "content designer"]),
    ("Developer documentation/devrel signal", ["developer advocate", "developer relations", "devrel", "developer documentation", "api"]), ("Knowledge/documentation systems match", ["knowledge", "knowledge base"]),
]


def why_matched() -> Column:
    combined = F.lower(F.concat_ws(" ", "Title", "TitleDomainSignal", "WriterFitReasons"))
    found = F.when(F.col("MatchedWatchlistTitle") != "", F.concat(F.lit("Matched watchlist title: "), "MatchedWatchlistTitle"))
    for name, phrases in WHY:
        found = found.when(text.has_any(combined, phrases), name)
    return found.otherwise("High writer-fit score")


def display_rows(jobs: DataFrame, run_date: Column) -> DataFrame:
    """What a reader of a sheet sees of a posting; links as formulas with doubled quotes."""
    role = F.when(F.col("TitleCategory").isin("Adjacent Roles", "Unknown"), "Adjacent / Transferable").otherwise(F.col("TitleCategory"))
    link = F.when(F.col("URL") == "", "").otherwise(F.concat(F.lit('=HYPERLINK("'), F.replace("URL", F.lit('"'), F.lit('""')), F.lit('","Apply")')))
    age = F.greatest(F.datediff(run_date, F.to_date("DatePosted")), F.lit(0)).cast("long")
    return jobs.select("seq", "Title", "Company", "Location", link.alias("ApplyLink"), F.col("WriterFitScore").cast("long").alias("WriterFitScore"), "WriterFitTier", why_matched().alias("WhyItMatched"), role.alias("RoleType"), F.col("RemoteStatus").alias("WorkArrangement"), F.col("SalaryText").alias("Salary"), "DatePosted", age.alias("AgeDays"), F.col("ATS").alias("Source"))


def excess_duplicates(rows: DataFrame, field: str) -> DataFrame:
    """Rows beyond the first of each value that isn't blank."""
    counts = rows.where(text.clean(F.col(field)) != "").groupBy(text.clean(F.col(field)).alias("value")).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))


def quality_checks(jobs: DataFrame, fields: list[str], least_share: float = 1.0) -> DataFrame:
    """Per source and check: rows that miss a field, their share, and whether it is a spike."""
    checks = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), (text.clean(F.col(f)) == "").alias("missing")) for f in fields]))
    found = jobs.select("ATS", checks.alias("c")).groupBy("ATS", F.col("c.field").alias("field")).agg(F.count("*").alias("rows"), F.count_if("c.missing").alias("missing"))
    share = F.round(F.col("missing") / F.col("rows") * 100, 2)
    return found.withColumns({"share": share, "spike": share >= least_share})


def first_of_company(snapshots: DataFrame) -> DataFrame:
    """The first snapshot of each company, its rows there and its best score since."""
    first = snapshots.groupBy("company_no", "snapshot_id").agg(F.count("*").alias("n"), F.max("score").alias("top"))
    return first.groupBy("company_no").agg(F.min("snapshot_id").alias("first_seen"), F.min(F.struct("snapshot_id", "n"))["n"].alias("first_jobs"), F.max("top").alias("best_score"))


def category_counts(jobs: DataFrame) -> DataFrame:
    """Title categories by count, with their share and rank; equal counts by name."""
    counts = jobs.groupBy("TitleCategory").agg(F.count("*").alias("jobs"), F.count_distinct("Company").alias("companies"), F.round(F.avg("WriterFitScore"), 2).alias("average_score"))
    total = counts.agg(F.sum("jobs").alias("total"))
    return counts.join(F.broadcast(total)).select("TitleCategory", "jobs", "companies", "average_score", F.round(F.col("jobs") / F.col("total") * 100, 2).alias("share"))
