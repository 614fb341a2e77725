"""Coverage: fetch logs against the registry's companies, merged board states, and planning of batches.

A log row is an attempt: seq (its place in the log), ATS, CatalogSlug, CompanyKey, FetchedAt, Status, HttpStatus, JobCount,
Error and BatchName. Latest rows are aggregates, so that a board with many attempts is reduced before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.operators import boards as B
from postloom.operators.ordering import ranked_within

#: Rows of a batch for each provider, and providers that only count where they are a company's best.
BATCH_LIMITS = {"ashby": 500, "greenhouse": 250, "lever": 100, "workday": 50, "bamboohr": 100, "icims": 25}
STRICT = ["ashby", "greenhouse", "lever"]
#: Batches that a provider gets at a time, for these recommendations.
PLAN_RULES = {"ashby": (["SCALE_NOW"], 2), "greenhouse": (["SAMPLE_MORE", "SCALE_NOW"], 1)}


def coverage_key(ats: Column, slug: Column, company_key: Column, company: Column) -> Column:
    """ats:slug:…, else ats:company:…, else ats:unknown:…"""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    tail = F.when(low(slug) != "", F.concat(F.lit("slug:"), low(slug))).when(low(company_key) != "", F.concat(F.lit("company:"), low(company_key))).otherwise(F.concat(F.lit("unknown:"), low(company)))
    return F.concat(low(ats), F.lit(":"), tail)


def log_key() -> Column:
    return coverage_key(F.col("ATS"), F.col("CatalogSlug"), F.col("CompanyKey"), F.lit(""))


def distinct_attempts(log: DataFrame) -> DataFrame:
    """Of attempts that agree in provider, slug, time and status (whatever the case), the last."""
    key = [F.lower(c) for c in ("ATS", "CatalogSlug")] + [F.col("FetchedAt"), F.lower("Status")]
    last = log.groupBy(*[k.alias(f"k{i}") for i, k in enumerate(key)]).agg(F.max_by(F.struct(*log.columns), "seq").alias("r"))
    return last.select("r.*")


def newest_first(rows: DataFrame, *by: Column) -> DataFrame:
    """Of each key, the row of the latest FetchedAt; of equal times the earlier row."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(by)]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.struct("FetchedAt", -F.col("seq"))).alias("r"))
    return best.select(*[f"k{i}" for i in range(len(by))], "r.*")


def upserted(log: DataFrame, key: Column) -> DataFrame:
    """Of each key the last row, at the place of its first; blank keys are left out."""
    best = log.where(key != "").groupBy(key.alias("key")).agg(F.min("seq").alias("place"), F.max_by(F.struct(*log.columns), "seq").alias("r"))
    return best.select("place", "r.*")


def job_counts(postings: DataFrame) -> DataFrame:
    """Per provider and company: jobs, those of tier A or B, and the latest time."""
    own = postings.where((F.coalesce("ATS", F.lit("")) != "") & (F.coalesce("CompanyKey", F.lit("")) != ""))
    return own.groupBy(F.lower("ATS").alias("ATS"), F.lower("CompanyKey").alias("CompanyKey")).agg(
        F.count("*").alias("JobsFound"), F.count_if(F.col("WriterFitTier").isin("A", "B")).alias("GoodMatchesFound"), F.max("FetchedAt").alias("LastChecked"),
    )


def present_boards(registered: DataFrame) -> DataFrame:
    """A line per company and provider that it has a slug or URL of, with what the crawl queue says of the company."""
    queue = B.crawl_queue(registered)
    parts = ", ".join(f"'{a}', coalesce({a}_Slug, ''), coalesce({a}_BoardURL, '')" for a in B.PROVIDERS)
    rows = registered.select("CompanyKey", F.expr(f"stack({len(B.PROVIDERS)}, {parts}) as (ATS, Slug, BoardURL)")).where("Slug <> '' or BoardURL <> ''")
    return rows.join(queue.select("CompanyKey", "Company", "BestATS", "CrawlReady", "CrawlPriority", "FetchSupportStatus", "EstimatedFetchURL"), "CompanyKey")


def candidates(present: DataFrame) -> DataFrame:
    """Boards that can be fetched: with a slug, and of strict providers only a company's best one, ready and supported."""
    strict = (F.col("BestATS") == F.col("ATS")) & F.col("CrawlReady") & F.col("FetchSupportStatus").isin("SUPPORTED", "BEST_EFFORT")
    rows = present.where((F.col("Slug") != "") & F.when(F.col("ATS").isin(STRICT), strict).otherwise(F.col("CrawlPriority") != ""))
    return rows.withColumn("CoverageKey", coverage_key(F.col("ATS"), F.col("Slug"), F.col("CompanyKey"), F.col("Company")))


def remaining(present: DataFrame, log: DataFrame) -> DataFrame:
    """Candidates that no attempt has the coverage key of."""
    return candidates(present).join(log.select(log_key().alias("CoverageKey")).distinct(), "CoverageKey", "left_anti")


def row_indexes(present: DataFrame) -> DataFrame:
    """Of each candidate: its place among those of its provider and priority, and the batch that holds it."""
    limit = F.element_at(F.create_map(*[F.lit(x) for p in BATCH_LIMITS.items() for x in p]), F.col("ATS"))
    # few groups with many rows: numbered in one order over all, not each in a task
    rows = ranked_within(candidates(present), ["ATS", "CrawlPriority"], ["CompanyKey"], candidates(present).columns).withColumn("Index", F.col("rank") - 1).drop("rank", "size")
    offset = (F.floor(F.col("Index") / limit) * limit).cast("long")
    return rows.withColumns({"Offset": offset, "BatchName": F.concat("ATS", F.lit("-"), F.lower("CrawlPriority"), F.lit("-"), padded(offset))})


def padded(offset: Column) -> Column:
    """At least four digits."""
    return F.when(offset < 10_000, F.lpad(offset.cast("string"), 4, "0")).otherwise(offset.cast("string"))


def company_coverage(present: DataFrame, log: DataFrame, counts: DataFrame) -> DataFrame:
    """Companies and their providers with the latest attempt, by coverage key or else by company, and a status."""
    by_key = newest_first(log, log_key()).select(F.col("k0").alias("CoverageKey"), F.struct("Status", "FetchedAt", "Error").alias("exact"))
    named = log.where((F.coalesce("CompanyKey", F.lit("")) != "") & (F.coalesce("ATS", F.lit("")) != ""))
    by_company = newest_first(named, F.lower("ATS"), F.lower("CompanyKey")).select(F.col("k0").alias("ATS"), F.col("k1").alias("CompanyKey"), F.struct("Status", "FetchedAt", "Error").alias("nearby"))
    rows = present.withColumn("CoverageKey", coverage_key(F.col("ATS"), F.col("Slug"), F.col("CompanyKey"), F.col("Company")))
    rows = rows.join(by_key, "CoverageKey", "left").join(by_company, ["ATS", "CompanyKey"], "left").join(counts.withColumnRenamed("LastChecked", "JobsChecked"), ["ATS", "CompanyKey"], "left")
    last = F.coalesce("exact", "nearby")
    rows = rows.withColumns({"last": last, "JobsFound": F.coalesce("JobsFound", F.lit(0)), "GoodMatchesFound": F.coalesce("GoodMatchesFound", F.lit(0))})
    supported = ~F.col("ATS").isin(STRICT) | F.col("FetchSupportStatus").isin("SUPPORTED", "BEST_EFFORT")
    status = (
        F.when(F.col("GoodMatchesFound") > 0, "GOOD_MATCHES_FOUND").when(F.col("JobsFound") > 0, "JOBS_FOUND").when(F.col("FetchSupportStatus") == "CATALOG_ONLY", "CATALOG_ONLY").when(~supported, "UNSUPPORTED")
        .when(F.col("last.Status") == "empty", "FETCHED_EMPTY").when(F.col("last.Status") == "failed", "FETCH_FAILED").when(F.col("last.Status") == "skipped", "UNSUPPORTED").otherwise("NOT_ATTEMPTED")
    )
    return rows.select("CompanyKey", "ATS", "Company", "BestATS", status.alias("CoverageStatus"), "JobsFound", "GoodMatchesFound", F.coalesce(F.col("last.FetchedAt"), F.col("JobsChecked").cast("timestamp")).alias("LastChecked"),
                       F.coalesce("last.Status", F.lit("")).alias("LastFetchStatus"), F.coalesce("last.Error", F.lit("")).alias("LastFetchError"))


def by_provider(present: DataFrame, log: DataFrame) -> DataFrame:
    """Per provider: boards, candidates, attempted coverage keys by latest outcome, what remains, and coverage in per cent."""
    names = present.sparkSession.createDataFrame([(a,) for a in B.PROVIDERS], "ATS string")
    boards_ = present.groupBy("ATS").agg(F.count("*").alias("CatalogRows"))
    ready = candidates(present).groupBy("ATS").agg(F.count("*").alias("FetchSupportedRows"))
    left = remaining(present, log).groupBy("ATS").agg(F.count("*").alias("RemainingRows"))
    latest = newest_first(log, log_key())
    has_jobs = F.coalesce("JobCount", F.lit(0)) > 0
    tried = latest.groupBy(F.lower("ATS").alias("ATS")).agg(
        F.count("*").alias("AttemptedRows"), F.count_if((F.col("Status") == "success") & has_jobs).alias("SuccessRows"), F.count_if((F.col("Status") == "empty") | (F.col("Status") == "success") & ~has_jobs).alias("EmptyRows"),
        F.count_if(F.col("Status") == "failed").alias("FailedRows"), F.count_if(F.col("Status") == "skipped").alias("SkippedRows"),
    )
    rows = F.broadcast(names).join(boards_, "ATS", "left").join(ready, "ATS", "left").join(left, "ATS", "left").join(tried, "ATS", "left").na.fill(0)
    share = F.when(F.col("FetchSupportedRows") == 0, 100.0).otherwise(F.round(F.least("FetchSupportedRows", "AttemptedRows") / F.col("FetchSupportedRows") * 100, 2))
    status = F.when((F.col("FetchSupportedRows") > 0) & (F.col("RemainingRows") == 0), "COMPLETE").when((F.col("FetchSupportedRows") > 0) & (F.col("AttemptedRows") > 0), "IN_PROGRESS").otherwise("NOT_STARTED")
    return rows.withColumns({"CoveragePercent": share, "CompletionStatus": status})


def coverage_summary(rows: DataFrame) -> DataFrame:
    """The totals over by_provider()."""
    supported, tried = F.sum("FetchSupportedRows"), F.sum(F.least("AttemptedRows", "FetchSupportedRows"))
    return rows.agg(
        F.sum("CatalogRows").alias("CatalogRowsTotal"), supported.alias("FetchSupportedTotal"), tried.alias("AttemptedTotal"), F.sum("RemainingRows").alias("RemainingTotal"),
        F.when(supported == 0, 100.0).otherwise(F.round(tried / supported * 100, 2)).alias("CoveragePercentOverall"),
        F.count_if(F.col("CompletionStatus") == "COMPLETE").alias("SupportedATSCompleteCount"), F.count_if(F.col("CompletionStatus") == "IN_PROGRESS").alias("SupportedATSInProgressCount"),
    )


def matched_cohort(log: DataFrame, now: Column) -> DataFrame:
    """Boards with attempts in both windows, [now - 24 h, now] and the seven days before: their latest attempt of each."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros("FetchedAt")
    day = 86_400_000_000
    windows = {"recent": (age >= 0) & (age <= day), "baseline": (age > day) & (age <= 8 * day)}
    key = [F.lower("ATS"), F.lower("CatalogSlug")]
    recent, base = (newest_first(log.where((F.coalesce("ATS", F.lit("")) != "") & w), *key).select("k0", "k1", F.col("Status").alias(n), F.col("JobCount").alias(f"{n}_jobs")) for n, w in windows.items())
    return recent.join(base, ["k0", "k1"]).select(F.col("k0").alias("ATS"), F.col("k1").alias("CatalogSlug"), "recent", "baseline", "recent_jobs", "baseline_jobs")


def batch_index(log: DataFrame) -> DataFrame:
    """Per batch: attempts, outcomes, jobs, and the count of each status as a map in the order of names."""
    counts = log.groupBy("BatchName", "Status").agg(F.count("*").alias("n"), F.sum("JobCount").alias("jobs"), F.min("FetchedAt").alias("first"), F.max("FetchedAt").alias("last"))
    return counts.groupBy("BatchName").agg(
        F.sum("n").alias("BoardsAttempted"), F.sum("jobs").alias("JobsFetched"), F.sum(F.when(F.col("Status") == "failed", F.col("n")).otherwise(0)).alias("FailedBoards"),
        F.min("first").alias("StartedAt"), F.max("last").alias("FinishedAt"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("Status", "n"))), lambda x: F.concat(x.Status, F.lit(":"), x.n)), " | ").alias("StatusCounts"),
    )


def next_offsets(batches: DataFrame) -> DataFrame:
    """Per provider: the furthest end of a batch. Offset: stated, else in the name, else 0; limit: stated, else boards attempted."""
    inside = F.regexp_extract("BatchName", r"(?:^|-)(\d{4,})(?:-|$)", 1)
    own_name = F.lower(F.split("BatchName", "-")[0]) == F.lower("ATS")
    offset = F.coalesce(F.col("Offset"), F.when(own_name & (inside != ""), inside.cast("long")), F.lit(0))
    limit = F.coalesce(F.nullif("Limit", F.lit(0)), F.nullif("BoardsAttempted", F.lit(0)), F.lit(0))
    return batches.groupBy(F.lower("ATS").alias("ATS")).agg(F.max(offset + limit).alias("NextOffset"))


def plan_batches(offsets: DataFrame, recommended: DataFrame, eligible: DataFrame, taken: DataFrame, ahead: int = 50) -> DataFrame:
    """The next batches of each provider that a rule allows: offsets from the next one on whose names aren't taken.

    Names are tried up to `ahead` limits on; a plan beyond the eligible rows is SKIPPED.
    """
    rules = offsets.sparkSession.createDataFrame([(a, r, n, BATCH_LIMITS[a]) for a, (r, n) in PLAN_RULES.items()], "ATS string, allowed array<string>, batches int, Limit int")
    rows = F.broadcast(rules).join(recommended, "ATS").join(eligible, "ATS", "left").join(offsets, "ATS", "left").na.fill(0, ["EligibleRows", "NextOffset"])
    rows = rows.where(F.array_contains("allowed", F.col("ScaleRecommendation"))).select("ATS", "ScaleRecommendation", "batches", F.col("Limit").cast("long").alias("Limit"), "EligibleRows", "NextOffset", F.explode(F.sequence(F.lit(0), F.lit(ahead - 1))).alias("step"))
    rows = rows.withColumn("Offset", F.col("NextOffset") + F.col("step") * F.col("Limit"))
    rows = rows.withColumn("BatchName", F.concat("ATS", F.lit("-high-"), padded(F.col("Offset")))).join(taken.select("BatchName").distinct(), "BatchName", "left_anti")
    turn = F.row_number().over(Window.partitionBy("ATS").orderBy("Offset"))
    rows = rows.withColumn("turn", turn).where("turn <= batches")
    return rows.select("ATS", "ScaleRecommendation", "Offset", "Limit", "BatchName", F.when(F.col("Offset") < F.col("EligibleRows"), "READY").otherwise("SKIPPED").alias("PlanStatus"))


def coverage_lookup(coverage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The latest coverage row of each board (where its slug is known) and of each company; of equal times the later row."""
    order = F.struct(F.coalesce("LastChecked", F.timestamp_seconds(F.lit(0))), "seq")
    row = F.struct("CoverageStatus", "LastFetchStatus", "LastChecked", "JobsFound", "GoodMatchesFound").alias("r")
    own = coverage.select(F.lower("ATS").alias("ATS"), F.lower("CompanyKey").alias("CompanyKey"), F.lower("Slug").alias("Slug"), row, order.alias("o"))
    exact = own.where("Slug <> ''").groupBy(F.concat_ws("|", "ATS", "Slug").alias("BoardKey")).agg(F.max_by("r", "o").alias("exact"))
    return exact, own.groupBy("ATS", "CompanyKey").agg(F.max_by("r", "o").alias("company"))


def synced_state(entries: DataFrame, previous: DataFrame, coverage: DataFrame) -> DataFrame:
    """The board state after a new catalogue: a full outer join of its entries with the state before.

    entries: BoardKey, ATS, CompanyKey, FetchEligible. previous: BoardKey, ATS, CompanyKey, CoverageStatus, LastFetchStatus,
    LastAttemptAt, JobCount, ConsecutiveFailures, NextCheckAt. Coverage counts only if it is newer than the last attempt;
    boards that left the catalogue become inactive. Coverage by company isn't used for providers whose companies
    have several boards.
    """
    exact, company = coverage_lookup(coverage)
    rows = entries.join(exact, "BoardKey", "left").join(company, ["ATS", "CompanyKey"], "left")
    rows = rows.withColumn("cov", F.coalesce("exact", F.when(~F.col("ATS").isin("workday", "icims"), F.col("company"))))
    was = previous.select("BoardKey", F.struct(*previous.columns).alias("was"))
    rows = rows.select("BoardKey", "ATS", "CompanyKey", "FetchEligible", "cov", F.lit(True).alias("Active")).join(was, "BoardKey", "full")
    epoch = F.timestamp_seconds(F.lit(0))
    at = lambda c: F.coalesce(F.col(c), epoch)
    active = F.coalesce("Active", F.lit(False))
    eligible = active & F.coalesce("FetchEligible", F.lit(False))
    newer = eligible & F.col("cov").isNotNull() & (F.col("was").isNull() | (at("cov.LastChecked") > at("was.LastAttemptAt")))
    fresh = F.coalesce(F.nullif(F.upper("cov.CoverageStatus"), F.lit("")), F.lit("NOT_ATTEMPTED"))
    status = F.when(active & ~eligible, "UNSUPPORTED").when(newer, fresh).otherwise(F.coalesce("was.CoverageStatus", F.lit("NOT_ATTEMPTED")))
    failures = F.when(newer & (fresh == "FETCH_FAILED"), F.greatest(F.lit(1), F.coalesce("was.ConsecutiveFailures", F.lit(0)))).when(newer, 0).otherwise(F.coalesce("was.ConsecutiveFailures", F.lit(0)))
    attempt = F.when(newer, F.col("cov.LastChecked")).otherwise(F.col("was.LastAttemptAt"))
    out = rows.select(
        "BoardKey", F.coalesce("ATS", "was.ATS").alias("ATS"), F.coalesce("CompanyKey", "was.CompanyKey").alias("CompanyKey"), active.alias("Active"), eligible.alias("FetchEligible"), status.alias("CoverageStatus"),
        attempt.alias("LastAttemptAt"), failures.cast("long").alias("ConsecutiveFailures"), F.coalesce(F.when(newer, F.col("cov.JobsFound")).otherwise(F.col("was.JobCount")), F.lit(0)).cast("long").alias("JobCount"),
        F.when(~newer, F.col("was.NextCheckAt")).alias("kept"),
    )
    due = F.coalesce("kept", B.next_check(F.col("CoverageStatus"), F.coalesce("LastAttemptAt", epoch), F.col("ConsecutiveFailures")))
    return out.withColumn("NextCheckAt", F.when(F.col("FetchEligible"), due)).drop("kept")


def refresh_candidates(matches: DataFrame, covered: DataFrame, allowed: list[str]) -> DataFrame:
    """Boards worth fetching again, of two sources: first names that aren't blank, best score, summed rows, latest fetch, reasons."""
    cols = ["seq", "ATS", "Slug", "Company", "CompanyKey", "FetchedAt", "Score", "GoodMatchRows", "SourceReason"]
    rows = matches.withColumns({"GoodMatchRows": F.lit(1).cast("long"), "SourceReason": F.lit("top-match"), "side": F.lit(0)}).select(*cols, "side").unionByName(
        covered.where("CoverageStatus = 'GOOD_MATCHES_FOUND'").withColumns({"Score": F.lit(0).cast("long"), "SourceReason": F.lit("coverage-good-matches"), "side": F.lit(1)}).select(*cols, "side"))
    rows = rows.where(F.lower("ATS").isin(allowed) & (F.col("Slug") != ""))
    first = lambda c: F.coalesce(F.min_by(c, F.when(F.col(c) != "", F.struct("side", "seq"))), F.lit(""))
    return rows.groupBy(F.concat_ws("|", F.lower("ATS"), F.lower("Slug")).alias("BoardKey")).agg(
        first("Company").alias("Company"), first("CompanyKey").alias("CompanyKey"), F.max("Score").alias("MaxWriterFitScore"), F.sum("GoodMatchRows").alias("GoodMatchRows"),
        F.max("FetchedAt").alias("LatestFetchedAt"), F.array_join(F.array_sort(F.collect_set("SourceReason")), " | ").alias("SourceReasons"),
    )


def freshness_issues(summary: DataFrame) -> DataFrame:
    """What doesn't add up in a freshness summary, a line for each issue."""
    c = F.col
    checks = {
        "FetchEligibleBoards exceeds ActiveBoards": c("FetchEligibleBoards") > c("ActiveBoards"),
        "attempt accounting": c("AttemptedBoards") + c("NeverAttemptedBoards") != c("FetchEligibleBoards"),
        "freshness windows are not monotonic": (c("Checked24Hours") > c("Checked7Days")) | (c("Checked7Days") > c("Checked30Days")),
        "Checked30Days exceeds AttemptedBoards": c("Checked30Days") > c("AttemptedBoards"),
        "DueBoards exceeds FetchEligibleBoards": c("DueBoards") > c("FetchEligibleBoards"),
        "failed-board retry accounting": c("RetryDelayedFailedBoards") + c("DueFailedBoards") != c("FailedBoards"),
    }
    return summary.select("ATS", F.explode(F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in checks.items()]), lambda x: x.isNotNull())).alias("Issue"))
