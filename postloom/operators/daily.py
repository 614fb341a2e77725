"""Reports over dated snapshots of a display feed.

A row is a posting in a snapshot: day (a day number), Key (its job key), Company, Title, Location, Link, Score, Age (days, null if
unknown) and Source. Presence is worked out by aggregates over keys; the days themselves are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.functions import text
from postloom.operators.postings import title_category

#: Categories that editors don't look at, and the order of the outlier rules.
NOT_EDITORIAL = ["Adjacent Roles", "Unknown"]
OUTLIERS = ["EXTREME_OLD_POSTING", "LONG_RUNNING_JOB", "HIGH_SCORE_OLD_JOB", "REAPPEARED_JOB", "COMPANY_WITH_MANY_JOBS"]


def job_key(link: Column, company: Column, title: Column, location: Column, plain: bool = False) -> Column:
    """url:… of the link without trailing slashes (plain: nor query and fragment), else fallback:company|title|location."""
    url = F.lower(F.trim(F.coalesce(link, F.lit(""))))
    url = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", "") if plain else url, "/+$", "")
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(url != "", F.concat(F.lit("url:"), url)).otherwise(F.concat(F.lit("fallback:"), F.concat_ws("|", low(company), low(title), low(location))))


def trend_title(title: Column) -> Column:
    """A title without punctuation (but / and -) and without words of seniority."""
    t = F.regexp_replace(F.lower(F.trim(F.coalesce(title, F.lit("")))), r"[^\w\s/-]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\b(senior|sr|staff|principal|lead|junior|jr|mid|associate)\b", " "), r"\s+", " "))


def explicit_us(location: Column) -> Column:
    """Whether a location names the United States: United States, USA, US or U.S. as words of their own."""
    return F.coalesce(location.rlike(r"(?i)\bunited\s+states\b") | location.rlike(r"(?i)\busa\b") | location.rlike(r"(?i)(?:^|[\s,;|(/-])u\.?\s*s\.?(?=$|[\s,;|)/-])"), F.lit(False))


def newest(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the newest snapshot and of the one before."""
    days = [r[0] for r in rows.select("day").distinct().orderBy(F.desc("day")).limit(2).collect()] + [None, None]
    return tuple(rows.where(F.col("day") == F.lit(d)) for d in days[:2])


def trend_range(rows: DataFrame, mode: str = "weekly", days: int = 7, low: int | None = None, high: int | None = None) -> DataFrame:
    """Rows of a range of snapshots: weekly, days, all, current-previous, or explicit ends. Where a range of days
    holds just one snapshot, all snapshots count."""
    top = rows.agg(F.max("day")).first()[0]
    if mode == "current-previous":
        known = rows.select("day").distinct().orderBy(F.desc("day")).limit(2)
        return rows.join(F.broadcast(known), "day", "left_semi")
    if mode == "snapshots":
        return rows.where(F.col("day").between(low, high))
    if mode == "all" or top is None:
        return rows
    within = rows.where(F.col("day") >= top - (7 if mode == "weekly" else days))
    return within if within.select("day").distinct().count() > 1 else rows


def history(rows: DataFrame) -> DataFrame:
    """Of each key: first and last day, snapshots, and its latest row."""
    return rows.groupBy("Key").agg(F.min("day").alias("FirstSeen"), F.max("day").alias("LastSeen"), F.count("*").alias("SnapshotCount"), F.max_by(F.struct("Company", "Title", "Location", "Score", "Age", "Source"), "day").alias("latest"))


def lifecycle(rows: DataFrame) -> DataFrame:
    """The history of each key and whether the newest snapshot has it."""
    top = rows.agg(F.max("day").alias("top"))
    known = history(rows).join(F.broadcast(top))
    return known.select("Key", "latest.Company", "latest.Title", "FirstSeen", "LastSeen", "SnapshotCount", (F.col("LastSeen") == F.col("top")).alias("CurrentlyPresent"))


def top_of(rows: DataFrame, by: str) -> DataFrame:
    """Of each group, how many rows, and title and link of the best one: score, then company and title."""
    order = F.struct((-F.coalesce("Score", F.lit(0))).alias("s"), F.lower("Company"), F.lower("Title"), "Link")
    return rows.groupBy(by).agg(F.count("*").alias("CurrentJobs"), F.min_by(F.struct("Title", "Link"), order).alias("t")).select(by, "CurrentJobs", F.col("t.Title").alias("TopTitle"), F.col("t.Link").alias("TopURL"))


def new_companies(current: DataFrame, previous: DataFrame) -> DataFrame:
    return top_of(current.join(previous.select("Company").distinct(), "Company", "left_anti"), "Company")


def movement(current: DataFrame, previous: DataFrame, by: str) -> DataFrame:
    """Per value: jobs now and before, net change, new and removed jobs, and the best title now."""
    new = current.join(previous.select("Key"), "Key", "left_anti").groupBy(by).agg(F.count("*").alias("NewJobs"))
    gone = previous.join(current.select("Key"), "Key", "left_anti").groupBy(by).agg(F.count("*").alias("RemovedJobs"))
    was = previous.groupBy(by).agg(F.count("*").alias("PreviousJobs"))
    out = top_of(current, by).join(was, by, "full").join(new, by, "full").join(gone, by, "full").na.fill(0).na.fill("")
    return out.select(by, "CurrentJobs", "PreviousJobs", (F.col("CurrentJobs") - F.col("PreviousJobs")).alias("NetChange"), "NewJobs", "RemovedJobs", "TopTitle")


def continuing(current: DataFrame, previous: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the newest snapshot that the one before has too, with when they were first seen and how often."""
    return current.join(previous.select("Key"), "Key", "left_semi").join(history(rows).select("Key", "FirstSeen", "SnapshotCount"), "Key").select("Key", "Company", "Title", "Score", "FirstSeen", "SnapshotCount")


def us_remote_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Confirmed remote jobs of the United States: added, removed or continuing."""
    own = lambda df: df.where((F.lower("Arrangement") == "remote") & explicit_us(F.col("Location"))).select("Key")
    now, then = own(current).withColumn("now", F.lit(1)), own(previous).withColumn("then", F.lit(1))
    return now.join(then, "Key", "full").select("Key", F.when(F.col("then").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("continuing").alias("Status"))


def range_changes(within: DataFrame, rows: DataFrame) -> DataFrame:
    """Keys of a range: NEW if first seen in it, DROPPED if its last snapshot lacks them, PERSISTENT if all have them; and the
    last snapshot of the range that has them."""
    ends = within.agg(F.min("day").alias("low"), F.max("day").alias("high"), F.count_distinct("day").alias("all_days"))
    keys = within.groupBy("Key").agg(F.max("day").alias("LastInRange"), F.count_distinct("day").alias("DaysInRange")).join(history(rows).select("Key", "FirstSeen"), "Key").join(F.broadcast(ends))
    kinds = F.filter(F.array(F.when(F.col("FirstSeen") > F.col("low"), F.lit("NEW")), F.when(F.col("LastInRange") < F.col("high"), F.lit("DROPPED")), F.when(F.col("DaysInRange") == F.col("all_days"), F.lit("PERSISTENT"))), lambda x: x.isNotNull())
    return keys.select("Key", "FirstSeen", "LastInRange", "DaysInRange", F.array_join(kinds, " | ").alias("Changes"))


def rolling(rows: DataFrame, spans: tuple[int, ...] = (7, 14, 30), top: int = 5) -> DataFrame:
    """Over the last days: snapshots, jobs, jobs first seen, companies, and the companies of most jobs."""
    ends = rows.agg(F.max("day").alias("newest"))
    known = rows.groupBy("Key").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.max_by("Company", "day").alias("Company")).join(F.broadcast(ends))
    spanned = known.withColumn("days", F.explode(F.array(*[F.lit(s) for s in spans]))).where(F.col("last") >= F.col("newest") - F.col("days"))
    by_company = spanned.groupBy("days", "Company").agg(F.count("*").alias("n"), F.count_if(F.col("first") >= F.col("newest") - F.col("days")).alias("new"))
    place = F.row_number().over(Window.partitionBy("days").orderBy(F.desc("n"), "Company"))
    named = by_company.withColumn("place", place)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") <= top, F.struct("place", F.concat("Company", F.lit(":"), "n").alias("t"))))), lambda x: x.t), " | ")
    found = named.groupBy("days").agg(F.sum("n").alias("UniqueJobs"), F.sum("new").alias("FirstSeenJobs"), F.count("*").alias("Companies"), listed.alias("TopCompanies"))
    counted = rows.select("day").distinct().join(F.broadcast(ends)).withColumn("days", F.explode(F.array(*[F.lit(s) for s in spans]))).where(F.col("day") >= F.col("newest") - F.col("days")).groupBy("days").agg(F.count("*").alias("Snapshots"))
    return found.join(counted, "days").select(F.col("days").cast("long").alias("days"), "Snapshots", "UniqueJobs", "FirstSeenJobs", "Companies", "TopCompanies")


def ages(current: DataFrame) -> DataFrame:
    """Of the newest rows: ages within 7, 14 and 30 days, unknown ones, exact median, mean and extremes."""
    return current.agg(
        *[F.count_if(F.col("Age") <= d).alias(f"Last{d}Days") for d in (7, 14, 30)], F.count_if(F.col("Age").isNull()).alias("UnknownAge"), F.round(F.median("Age"), 1).alias("MedianAge"), F.round(F.avg("Age"), 1).alias("AverageAge"),
        F.max("Age").alias("OldestAge"), F.min("Age").alias("NewestAge"),
    )


def outliers(rows: DataFrame) -> DataFrame:
    """Five rules over the newest snapshot, a line for each that a row meets; the last rule gives a company's best row."""
    current, previous = newest(rows)
    n = rows.agg(F.count_distinct("day").alias("all_days"))
    known = current.join(history(rows).select("Key", "SnapshotCount"), "Key").join(previous.select("Key", F.lit(True).alias("was")), "Key", "left").join(F.broadcast(n))
    editorial = known.where(~title_category(F.col("Title")).isin(NOT_EDITORIAL))
    rules = F.filter(F.array(
        F.when(F.col("Age") >= 500, F.lit(OUTLIERS[0])), F.when(F.col("SnapshotCount") >= F.greatest(F.lit(4), F.col("all_days") - 1), F.lit(OUTLIERS[1])),
        F.when((F.col("Score") >= 85) & (F.col("Age") >= 90), F.lit(OUTLIERS[2])), F.when((F.col("SnapshotCount") >= 2) & F.col("was").isNull(), F.lit(OUTLIERS[3])),
    ), lambda x: x.isNotNull())
    cols = ["Key", "Company", "Score", "SnapshotCount"]
    single = editorial.select(*cols, F.explode(rules).alias("Outlier"))
    sizes = current.groupBy("Company").agg(F.count("*").alias("jobs")).where("jobs >= 3")
    order = F.struct((-F.coalesce("Score", F.lit(0))).alias("s"), F.lower("Company"), F.lower("Title"), "Key")
    best = editorial.join(sizes, "Company", "left_semi").groupBy("Company").agg(F.min_by(F.struct(*cols), order).alias("r")).select("r.*", F.lit(OUTLIERS[4]).alias("Outlier"))
    return single.unionByName(best)


def posting_patterns(rows: DataFrame) -> DataFrame:
    """Per source and, stacked below, per company: unique jobs, active snapshots, median of jobs a snapshot, the usual weekday
    (the smaller of equally frequent ones), its share, and the share of rows with a known age."""
    tagged = rows.withColumn("by", F.explode(F.array(F.struct(F.lit("source").alias("kind"), F.col("Source").alias("name")), F.struct(F.lit("company").alias("kind"), F.col("Company").alias("name"))))).select("by.kind", "by.name", "day", "Key", "Age")
    daily = tagged.groupBy("kind", "name", "day").agg(F.count("*").alias("n"), F.count("Age").alias("dated"))
    weekdays = daily.groupBy("kind", "name", F.pmod("day", F.lit(7)).alias("w")).agg(F.sum("n").alias("n"))
    modal = weekdays.groupBy("kind", "name").agg(F.min_by("w", F.struct((-F.col("n")).alias("n"), "w")).alias("Weekday"), F.max("n").alias("top"))
    sums = daily.groupBy("kind", "name").agg(F.count("*").alias("ActiveSnapshots"), F.median("n").alias("MedianJobs"), F.sum("n").alias("all_n"), F.sum("dated").alias("dated"))
    jobs = tagged.groupBy("kind", "name").agg(F.count_distinct("Key").alias("UniqueJobs"))
    out = sums.join(jobs, ["kind", "name"]).join(modal, ["kind", "name"])
    return out.select("kind", "name", "UniqueJobs", "ActiveSnapshots", "MedianJobs", F.col("Weekday").cast("long").alias("Weekday"), F.round(F.col("top") / F.col("all_n") * 100, 2).alias("WeekdayShare"), F.round(F.col("dated") / F.col("all_n") * 100, 2).alias("DatedShare"))


def unknown_categories(current: DataFrame) -> DataFrame:
    """Titles without a category: jobs, their share, and what they look like."""
    total = current.agg(F.count("*").alias("all_n"))
    t = F.lower("Title")
    bucket = F.when(text.clean(F.col("Title")) == "", "blank").when(t.rlike("writ|doc|content|edit"), "possible").otherwise("other")
    found = current.where(title_category(F.col("Title")) == "Unknown").groupBy("Title", bucket.alias("Bucket")).agg(F.count("*").alias("Jobs"))
    return found.join(F.broadcast(total)).select("Title", "Bucket", "Jobs", F.round(F.col("Jobs") / F.col("all_n") * 100, 2).alias("Share"))


def metric_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Metrics of two releases side by side: difference, and change in per cent (0 if equal, null from nothing)."""
    def metrics(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(F.count("*").alias("TotalRows"), F.count_distinct("Company").alias("Companies"), F.count_if(F.col("Score") >= 80).alias("HighScores"), F.count_if(F.col("Age").isNull()).alias("Undated"), F.count_if(F.col("Score") > 1000).alias("Impossible"))
        return one.select(F.expr("stack(5, 'TotalRows', TotalRows, 'Companies', Companies, 'HighScores', HighScores, 'Undated', Undated, 'Impossible', Impossible) as (Metric, value)")).withColumnRenamed("value", name)

    both = metrics(current, "Current").join(metrics(previous, "Previous"), "Metric")
    change = F.when(F.col("Previous") != 0, F.round((F.col("Current") - F.col("Previous")) / F.col("Previous") * 100, 2)).when(F.col("Current") == F.col("Previous"), 0.0)
    return both.select("Metric", "Current", "Previous", (F.col("Current") - F.col("Previous")).alias("Difference"), change.alias("PercentChange"))


def moved_dates(current: DataFrame, previous: DataFrame, least: int = 30) -> DataFrame:
    """Rows whose age fell by at least so many days since the snapshot before, though time went on."""
    then = previous.select("Key", F.col("Age").alias("AgeBefore"))
    return current.join(then, "Key").where(F.col("AgeBefore") - F.col("Age") >= least).select("Key", "AgeBefore", "Age")


def upload_order() -> list[Column]:
    """Youngest first with unknown ages last, then score, company, title and link."""
    return [F.col("Age").asc_nulls_last(), F.col("Score").desc_nulls_last(), F.lower("Company"), F.lower("Title"), F.col("Link")]
