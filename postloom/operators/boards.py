"""Boards: catalogue analysis, fetch attempts, state, freshness, anomalies and scheduling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.functions import fixed, text

LIVE = ("success", "empty")
TERMINAL = ("success", "empty", "failed")

#: Hours until a board of that status is checked again; others wait a week, null never.
INTERVAL_HOURS = {"GOOD_MATCHES_FOUND": 24, "JOBS_FOUND": 120, "FETCHED_EMPTY": 240, "NOT_ATTEMPTED": 0}
STATUS_RANK = {"GOOD_MATCHES_FOUND": 0, "JOBS_FOUND": 1, "FETCH_FAILED": 2, "FETCHED_EMPTY": 3, "NOT_ATTEMPTED": 4}
STATUSES = ["GOOD_MATCHES_FOUND", "JOBS_FOUND", "FETCHED_EMPTY", "FETCH_FAILED", "NOT_ATTEMPTED"]


def board_key() -> Column:
    return F.concat_ws("|", F.lower(text.clean(F.col("ATS"))), F.lower(text.clean(F.col("CatalogSlug"))))


def error_class(status: Column, ats: Column, name: Column | None = None, message: Column | None = None, skip: Column | None = None) -> Column:
    """The class of a failed fetch: by what it says of itself, then its HTTP status, then its message."""
    said = F.lower(F.trim(F.coalesce(message, F.lit("")))) if message is not None else F.lit("")
    called = F.lower(F.trim(F.coalesce(name, F.lit("")))) if name is not None else F.lit("")
    skipped = F.coalesce(skip, F.lit(False)) if skip is not None else F.lit(False)
    status = F.coalesce(status, F.lit(0))
    return (
        F.when(skipped | said.rlike("no usable .* fetch url"), "NO_USABLE_URL").when((called == "aborterror") | said.rlike("abort|timed? out|timeout"), "TIMEOUT")
        .when(status == 429, "RATE_LIMITED").when(status >= 500, "UPSTREAM_SERVER_ERROR").when(status.isin(404, 410), "BOARD_NOT_FOUND").when(status.isin(401, 403), "ACCESS_BLOCKED")
        .when((F.lower(ats) == "workday") & (status == 422), "ENDPOINT_REJECTED").when(status >= 400, "HTTP_CLIENT_ERROR")
        .when(said.rlike("json|parse|unexpected token|html"), "RESPONSE_PARSE_ERROR").when(said.rlike("dns|enotfound|getaddrinfo|network|fetch failed|econn"), "NETWORK_ERROR").otherwise("UNKNOWN_FETCH_ERROR")
    )


def rate(count: Column, of: Column) -> Column:
    return F.when(of > 0, F.round(count / of * 100, 2)).otherwise(0.0)


def attempt_summary(fetches: DataFrame, *by: str) -> DataFrame:
    """Attempts with a final status: how many, and count and rate of HTTP failures, empty and job-less ones."""
    own = fetches.where(F.col("Status").isin(*TERMINAL))
    counted = own.groupBy(*by).agg(
        F.count("*").alias("Attempts"),
        F.count_if((F.col("Status") == "failed") & (F.col("HttpStatus").cast("int") >= 400)).alias("HTTPFailureCount"),
        F.count_if(F.col("Status") == "empty").alias("EmptyCount"), F.count_if(F.col("JobCount") == 0).alias("ZeroJobCount"),
    )
    return counted.withColumns({f"{n}Rate": rate(F.col(f"{n}Count"), F.col("Attempts")) for n in ("HTTPFailure", "Empty", "ZeroJob")})


def latest(rows: DataFrame, key: Column, order: list[str], *fields: str) -> DataFrame:
    """Of each key, the row that comes last in that order; an aggregate, so that hot keys are reduced before they move."""
    packed = F.max(F.struct(*order, *[f for f in fields if f not in order])).alias("r")
    return rows.groupBy(key.alias("BoardKey")).agg(packed).select("BoardKey", *[F.col("r")[f].alias(f) for f in fields])


def latest_live(fetches: DataFrame) -> DataFrame:
    """Of each board with an ATS and a slug, its newest successful or empty fetch; of equal times the later row."""
    live = fetches.where(F.lower("Status").isin(*LIVE) & (text.clean(F.col("ATS")) != "") & (text.clean(F.col("CatalogSlug")) != ""))
    return live.groupBy(board_key().alias("BoardKey")).agg(F.max(F.struct("FetchedAt", "seq", F.lower("Status").alias("Status"), F.col("SourceBatch"))).alias("newest"))


def superseded(rows: DataFrame, newest: DataFrame) -> DataFrame:
    """Postings with `keep`: false where their board's newest live fetch came later.

    After an empty fetch only postings fetched later stay, after a successful one only those of its batch. Boards without a
    live fetch, and rows without a board, keep all. newest is that of latest_live(), a row a board.
    """
    of = F.when((text.clean(F.col("ATS")) != "") & (text.clean(F.col("CatalogSlug")) != ""), board_key())
    joined = rows.withColumn("BoardKey", F.coalesce(of, F.lit(""))).join(newest, "BoardKey", "left")
    gone = F.when(F.col("newest.Status") == "empty", F.col("FetchedAt") <= F.col("newest.FetchedAt")).when(F.col("newest.Status") == "success", text.clean(F.col("SourceBatch")) != text.clean(F.col("newest.SourceBatch")))
    return joined.withColumn("keep", ~F.coalesce(gone, F.lit(False))).drop("newest")


def anomalies(fetches: DataFrame, now: Column, recent_hours: int = 24, baseline_days: int = 7, least_recent: int = 20, least_baseline: int = 50) -> DataFrame:
    """Per ATS and metric: rates of boards fetched in both windows, whether they alert and how severely.

    A board counts by its last attempt of each window, and only if it has one in both, so that new boards of a catalogue don't look like a change.
    """
    age = now.cast("timestamp").cast("long") - F.col("FetchedAt").cast("long")
    recent = (age >= 0) & (age <= recent_hours * 3600)
    baseline = (age > recent_hours * 3600) & (age <= (recent_hours + 24 * baseline_days) * 3600)
    # of equal times the first row stays
    row = F.struct("FetchedAt", (-F.col("seq")).alias("s"), "Status", "HttpStatus", "JobCount")
    boards = fetches.groupBy(F.lower("ATS").alias("ATS"), F.lower(text.clean(F.col("CatalogSlug"))).alias("slug")).agg(F.max(F.when(recent, row)).alias("recent"), F.max(F.when(baseline, row)).alias("baseline"))
    matched = F.col("recent").isNotNull() & F.col("baseline").isNotNull()

    def counts(w: str) -> list[Column]:
        ended = matched & F.col(f"{w}.Status").isin(*TERMINAL)
        of = {"Attempts": F.lit(True), "HTTPFailure": (F.col(f"{w}.Status") == "failed") & (F.col(f"{w}.HttpStatus").try_cast("int") >= 400), "Empty": F.col(f"{w}.Status") == "empty", "ZeroJob": F.col(f"{w}.JobCount") == 0}
        return [F.count_if(ended & c).alias(f"{w}_{n}") for n, c in of.items()]

    side = boards.groupBy("ATS").agg(F.count("recent").alias("RecentBoards"), F.count("baseline").alias("BaselineBoards"), F.count_if(matched).alias("MatchedBoards"), *counts("recent"), *counts("baseline"))
    metric = F.explode(F.array(*[F.struct(F.lit(n).alias("Metric"), rate(F.col(f"recent_{n}"), F.col("recent_Attempts")).alias("RecentRate"), rate(F.col(f"baseline_{n}"), F.col("baseline_Attempts")).alias("BaselineRate")) for n in ("HTTPFailure", "Empty", "ZeroJob")]))
    rows = side.select("ATS", "RecentBoards", "BaselineBoards", "MatchedBoards", (F.col("RecentBoards") - F.col("MatchedBoards")).alias("NewRecentBoards"), F.col("recent_Attempts").alias("RecentAttempts"), F.col("baseline_Attempts").alias("BaselineAttempts"), metric.alias("m"))
    rows = rows.select(*[c for c in rows.columns if c != "m"], "m.*")
    up = F.round(F.col("RecentRate") - F.col("BaselineRate"), 2)
    ratio = F.when(F.col("BaselineRate") > 0, F.round(F.col("RecentRate") / F.col("BaselineRate"), 2)).when(F.col("RecentRate") == 0, 1.0)
    rows = rows.withColumns({"PointIncrease": up, "Ratio": ratio})
    enough = (F.col("RecentAttempts") >= least_recent) & (F.col("BaselineAttempts") >= least_baseline)
    over = F.when(F.col("BaselineRate") == 0, F.col("RecentRate") >= 10).otherwise(F.col("Ratio") >= 1.5)
    alert = (F.col("PointIncrease") >= 10) & over
    severity = F.when(~enough, "INSUFFICIENT_DATA").when(alert & (F.col("PointIncrease") >= 20) & (F.col("Ratio").isNull() | (F.col("Ratio") >= 2)), "HIGH").when(alert, "WARN").otherwise("OK")
    return rows.withColumn("Verdict", severity)


def board_state(fetches: DataFrame) -> DataFrame:
    """The state of each board after its attempts in order: counts, latest outcome, failures in a row, next check.

    The fold is aggregates only, so that a board with many attempts is no unbounded group.
    """
    order = F.struct("FetchedAt", "seq")
    own = fetches.withColumns({"BoardKey": board_key(), "_at": order})
    summed = own.groupBy("BoardKey").agg(
        F.min("ATS").alias("ATS"), F.count("*").alias("AttemptCount"), F.max(F.struct("_at", "Status", "JobCount")).alias("_last"),
        F.max(F.when(F.col("Status") != "failed", F.col("_at"))).alias("_calm"), F.max(F.when(F.col("Status").isin(*LIVE), F.col("FetchedAt"))).alias("LastSuccessAt"),
    )
    failed = own.where("Status = 'failed'").join(summed.select("BoardKey", "_calm"), "BoardKey")
    runs = failed.where(F.col("_calm").isNull() | (F.col("_at") > F.col("_calm"))).groupBy("BoardKey").agg(F.count("*").alias("ConsecutiveFailures"))
    status = F.col("_last.Status")
    coverage = F.when(status == "success", "JOBS_FOUND").when(status == "empty", "FETCHED_EMPTY").when(status == "failed", "FETCH_FAILED").otherwise("UNSUPPORTED")
    df = summed.join(runs, "BoardKey", "left").withColumns({
        "ConsecutiveFailures": F.coalesce("ConsecutiveFailures", F.lit(0)), "CoverageStatus": coverage, "LastFetchStatus": status, "LastAttemptAt": F.col("_last._at.FetchedAt"), "JobCount": F.col("_last.JobCount"),
    })
    return df.withColumn("NextCheckAt", next_check(F.col("CoverageStatus"), F.col("LastAttemptAt"), F.col("ConsecutiveFailures"))).drop("_last", "_calm")


def interval_hours(status: Column, failures: Column) -> Column:
    found = F.when(status.isin("UNSUPPORTED", "CATALOG_ONLY"), F.lit(None)).when(status == "FETCH_FAILED", F.least(F.lit(168.0), 24 * F.pow(F.lit(2.0), F.greatest(F.lit(0), failures - 1))))
    for s, h in INTERVAL_HOURS.items():
        found = found.when(status == s, float(h))
    return found.otherwise(168.0)


def next_check(status: Column, at: Column, failures: Column) -> Column:
    return F.timestamp_add("SECOND", (interval_hours(status, failures) * 3600).cast("int"), at)


def freshness(state: DataFrame, now: Column) -> DataFrame:
    """Per ATS and over all: boards attempted, checked within days, due, failed, and shares of them."""
    age = now.cast("timestamp").cast("long") - F.col("LastAttemptAt").cast("long")
    live = F.col("CoverageStatus") != "UNSUPPORTED"
    due = live & (F.col("NextCheckAt") <= now.cast("timestamp"))
    failed = F.col("CoverageStatus") == "FETCH_FAILED"
    counts = {
        "AttemptedBoards": live & F.col("LastAttemptAt").isNotNull(), "NeverAttemptedBoards": live & F.col("LastAttemptAt").isNull(), "ActiveBoards": F.lit(True), "FetchEligibleBoards": live, "Checked24Hours": live & (age <= 86400), "Checked7Days": live & (age <= 7 * 86400), "Checked30Days": live & (age <= 30 * 86400),
        "DueBoards": due, "JobsFoundBoards": F.col("CoverageStatus") == "JOBS_FOUND", "EmptyBoards": F.col("CoverageStatus") == "FETCHED_EMPTY", "FailedBoards": failed,
        "RetryDelayedFailedBoards": failed & ~due, "DueFailedBoards": failed & due,
    }
    out = state.rollup("ATS").agg(F.grouping("ATS").alias("whole"), *[F.count_if(c).alias(n) for n, c in counts.items()])
    share = F.when(F.col("FetchEligibleBoards") > 0, F.round(F.col("Checked7Days") / F.col("FetchEligibleBoards") * 100, 2)).otherwise(100.0)
    return out.withColumns({"ATS": F.when(F.col("whole") == 1, "all").otherwise(F.col("ATS")), "Fresh7DayPercent": share}).drop("whole")


def due_boards(state: DataFrame, now: Column, most: int = 60, per_ats: int = 15) -> DataFrame:
    """Boards to check next: by status, due time and key within their ATS, taken in turns over the ATS."""
    due = state.where((F.col("CoverageStatus") != "UNSUPPORTED") & (F.col("NextCheckAt") <= now.cast("timestamp")))
    order = [text.ranked(F.col("CoverageStatus"), STATUS_RANK), "NextCheckAt", "BoardKey"]
    # first within parts of a provider, so that one with most boards doesn't meet in one task
    part = F.pmod(F.xxhash64("BoardKey"), F.lit(64))
    due = due.withColumn("turn", F.row_number().over(Window.partitionBy("ATS", part).orderBy(*order))).where(F.col("turn") <= per_ats)
    turns = due.withColumn("turn", F.row_number().over(Window.partitionBy("ATS").orderBy(*order))).where(F.col("turn") <= per_ats)
    first = turns.orderBy("turn", "ATS").limit(most)
    return first.withColumn("place", F.row_number().over(Window.orderBy("turn", "ATS")))


def fetch_health(fetches: DataFrame) -> DataFrame:
    """Per ATS: boards, attempts, outcome counts and rates, jobs, and the counts as text."""
    n = {s: F.count_if(F.col("Status") == s) for s in ("success", "empty", "failed", "skipped")}
    df = fetches.groupBy("ATS").agg(F.count_distinct(board_key()).alias("BoardsAttempted"), F.count("*").alias("Attempts"), *[c.alias(f"{s.title()}Count") for s, c in n.items()], F.sum("JobCount").alias("JobsFetched"))
    texts = [F.when(F.col(f"{s.title()}Count") > 0, F.concat(F.lit(f"{s}:"), F.col(f"{s.title()}Count"))) for s in n]
    return df.withColumns({"SuccessRate": rate(F.col("SuccessCount"), F.col("Attempts")), "FailureRate": rate(F.col("FailedCount"), F.col("Attempts")), "StatusCounts": F.concat_ws(" | ", *texts)})


def recommendations(health: DataFrame, published: DataFrame, names: list[str], supported: list[str]) -> DataFrame:
    """Of each ATS, its fetches' and its published rows' health joined, what to do next, how many boards and how slowly."""
    known = F.col("ATS").isin(supported)
    said = health.sparkSession.createDataFrame([(a,) for a in names], "ATS string")
    rows = F.broadcast(said).join(health, "ATS", "left").join(published.select("ATS", "PublicRows"), "ATS", "left").na.fill(0)
    jobs, attempted, public = F.col("JobsFetched"), F.col("BoardsAttempted"), F.col("PublicRows")
    ladder = [
        (known & (jobs > 1000) & (F.col("SuccessRate") >= 50), "SCALE_NOW", 500, 250), ((jobs > 0) & ((attempted < 100) | (public < 1000)) & known, "SAMPLE_MORE", 100, 250), ((jobs > 0) & ((attempted < 100) | (public < 1000)), "SAMPLE_MORE", 50, 500),
        (known & (jobs > 0) & (F.col("FailureRate") >= 50), "REVIEW_FETCHER", 50, 500), (jobs > 0, "KEEP_BEST_EFFORT", 50, 500), (known & (attempted > 0), "REVIEW_FETCHER", 25, 500),
    ]
    found = F.lit(None).cast("struct<verdict:string,many:long,delay:long>")
    for when, verdict, many, delay in ladder:
        found = F.coalesce(found, F.when(when, F.struct(F.lit(verdict).alias("verdict"), F.lit(many).cast("long").alias("many"), F.lit(delay).cast("long").alias("delay"))))
    found = F.coalesce(found, F.struct(F.lit("CATALOG_ONLY_FOR_NOW").alias("verdict"), F.lit(0).cast("long").alias("many"), F.lit(0).cast("long").alias("delay")))
    return rows.select("ATS", "BoardsAttempted", "JobsFetched", "PublicRows", found["verdict"].alias("ScaleRecommendation"), found["many"].alias("SuggestedNextBatchLimit"), found["delay"].alias("SuggestedDelayMs"))


def recommendation(health: DataFrame, supported: list[str]) -> DataFrame:
    """What to do next with each ATS, by volume and rates."""
    known, jobs, attempted = F.col("ATS").isin(supported), F.col("JobsFetched"), F.col("BoardsAttempted")
    verdict = (
        F.when(known & (jobs > 1000) & (F.col("SuccessRate") >= 50), "SCALE_NOW").when((jobs > 0) & (attempted < 100), "SAMPLE_MORE").when(known & (jobs > 0) & (F.col("FailureRate") >= 50), "REVIEW_FETCHER")
        .when(jobs > 0, "KEEP_BEST_EFFORT").when(known & (attempted > 0), "REVIEW_FETCHER").otherwise("CATALOG_ONLY_FOR_NOW")
    )
    return health.withColumn("ScaleRecommendation", verdict)


# ---- catalogue

def malformed_reason() -> Column:
    url = text.clean(F.col("BoardURL"))
    bad = (url != "") & (url.rlike(r"\s") | ~text.is_web_url(F.col("BoardURL")))
    return F.concat_ws(" | ", F.when(text.clean(F.col("ATS")) == "", F.lit("Missing ATS")), F.when(text.clean(F.col("Slug")) == "", F.lit("Missing CatalogSlug")), F.when(bad, F.lit("Suspicious BoardURL")))


def catalog_breakdown(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("ATS").agg(
        F.count("*").alias("Rows"), F.count_distinct("Slug").alias("DistinctSlugs"), F.count_distinct("CompanyKey").alias("DistinctCompanies"),
        F.count_if(F.col("BoardURL") != "").alias("WithURL"), F.count_if(malformed_reason() != "").alias("Malformed"),
    )


def duplicate_values(catalog: DataFrame) -> DataFrame:
    """Slugs that occur more than once, blank ones left out, with their ATS and companies.

    Lists are of distinct values, which the partial aggregates reduce first; a slug has few of them, as blanks don't count.
    """
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(c, F.lit("")))), " | ")
    return catalog.where("Slug <> ''").groupBy("Slug").agg(F.count("*").alias("Count"), listed("ATS").alias("ATSList"), listed("CompanyKey").alias("CompanyKeys")).where("Count > 1")


def key_overlap(catalog: DataFrame) -> DataFrame:
    """Companies on more than one ATS or with more than one slug; rows without a company or slug say nothing."""
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(c, F.lit("")))), " | ")
    found = catalog.where("CompanyKey <> ''").groupBy("CompanyKey").agg(F.count_distinct("ATS").alias("ATSCount"), F.count_distinct(F.nullif("Slug", F.lit(""))).alias("SlugCount"), listed("ATS").alias("ATSList"), listed("Slug").alias("Slugs"))
    return found.where("ATSCount > 1 or SlugCount > 1")


def registry(catalog: DataFrame) -> DataFrame:
    """A line per company: of each ATS, the first slug and URL that aren't blank, and how many boards it has."""
    def first(ats: str, c: str) -> Column:
        return F.min(F.when((F.col("ATS") == ats) & (F.col(c) != ""), F.struct("seq", c)))[c]

    cols = [f(a, c).alias(f"{a}_{c}") for a in fixed.ATS for f, c in ((first, "Slug"), (first, "BoardURL"))]
    return catalog.groupBy("CompanyKey").agg(F.count("*").alias("Boards"), F.min(F.struct("seq", "Company"))["Company"].alias("Company"), *cols)


def enumerate_boards(registered: DataFrame) -> DataFrame:
    """The registry's columns back as a line per board."""
    parts = ", ".join(f"'{a}', {a}_Slug, {a}_BoardURL" for a in fixed.ATS)
    rows = registered.select("CompanyKey", "Company", F.expr(f"stack({len(fixed.ATS)}, {parts}) as (ATS, Slug, BoardURL)")).where("Slug is not null")
    return rows.withColumn("BoardKey", F.concat_ws("|", "ATS", "Slug"))


# ---- crawl queue

#: Providers in the order of preference, how well they are supported, and the addresses of their public job lists.
PROVIDERS = ["ashby", "greenhouse", "lever", "workday", "bamboohr", "icims"]
PROVIDER_PRIORITY = {"ashby": "HIGH", "greenhouse": "HIGH", "lever": "HIGH", "workday": "MEDIUM", "bamboohr": "LOW", "icims": "LOW"}
SUPPORTED = ["ashby", "greenhouse", "lever"]
FETCH_URLS = {
    "ashby": "https://api.ashbyhq.com/posting-api/job-board/{}", "greenhouse": "https://boards-api.greenhouse.io/v1/boards/{}/jobs?content=true", "lever": "https://api.lever.co/v0/postings/{}?mode=json",
    "bamboohr": "https://{}.bamboohr.com/careers/list",
}
PRIORITIES = ["HIGH", "MEDIUM", "LOW", "SKIP"]


def fetch_url(ats: str, slug: Column, url: Column) -> Column:
    """The board's own URL, else that of the provider's list for the slug, else empty."""
    made = F.lit("")
    if ats in FETCH_URLS:
        before, after = FETCH_URLS[ats].split("{}")
        made = F.when(slug != "", F.concat(F.lit(before), F.replace(F.url_encode(slug), F.lit("+"), F.lit("%20")), F.lit(after))).otherwise("")
    return F.when(url != "", url).otherwise(made)


def crawl_queue(registered: DataFrame) -> DataFrame:
    """A line per company of registry(): the best provider that it has, where to fetch, how well that works and how soon."""
    value = lambda a, c: F.coalesce(F.col(f"{a}_{c}"), F.lit(""))
    has = {a: (value(a, "Slug") != "") | (value(a, "BoardURL") != "") for a in PROVIDERS}
    best = F.coalesce(*[F.when(has[a], F.lit(a)) for a in PROVIDERS], F.lit(""))
    url = F.coalesce(*[F.when(has[a], fetch_url(a, value(a, "Slug"), value(a, "BoardURL"))) for a in PROVIDERS], F.lit(""))
    names = F.filter(F.array(*[F.when(has[a], F.lit(a)) for a in PROVIDERS]), lambda x: x.isNotNull())
    # those that a company is on, but that nothing can be fetched from
    unavailable = F.filter(F.array(*[F.when(has[a] & (fetch_url(a, value(a, "Slug"), value(a, "BoardURL")) == ""), F.lit(a)) for a in PROVIDERS]), lambda x: x.isNotNull())
    df = registered.select("CompanyKey", "Company", best.alias("BestATS"), url.alias("EstimatedFetchURL"), F.array_join(names, " | ").alias("ATSList"), F.size(names).cast("long").alias("ATSCount"), F.array_join(unavailable, " | ").alias("UnavailableATSList"))
    ready = (F.col("CompanyKey") != "") & (F.col("Company") != "") & (F.col("EstimatedFetchURL") != "")
    support = F.when(F.col("BestATS") == "", "UNSUPPORTED").when(F.col("BestATS").isin(SUPPORTED), "SUPPORTED").when(F.col("EstimatedFetchURL") != "", "BEST_EFFORT").otherwise("CATALOG_ONLY")
    reason = F.when(F.col("CompanyKey") == "", "Missing company key").when(F.col("Company") == "", "Missing preferred company name").when(F.col("EstimatedFetchURL") == "", "No usable URL").otherwise(F.concat("BestATS", F.lit(" board available")))
    priority = F.lit("SKIP")
    for a, p in PROVIDER_PRIORITY.items():
        priority = F.when(ready & (F.col("BestATS") == a), p).otherwise(priority)
    status = F.when(ready, "READY").when(F.col("ATSCount") > 0, "NOT_READY").otherwise("SKIP")
    return df.withColumns({"CrawlReady": ready, "CrawlPriority": priority, "CrawlStatus": status, "FetchSupportStatus": support, "CrawlReason": reason})


def queue_summary(queue: DataFrame) -> DataFrame:
    """A row of counts over the queue: by readiness, priority, provider, and what a provider has but can't be fetched."""
    n = F.count_if
    on = lambda a: F.array_contains(F.split("UnavailableATSList", r" \| "), a)
    best = {a: F.col("BestATS") == a for a in PROVIDERS}
    later = [a for a in PROVIDERS if a not in SUPPORTED]
    return queue.agg(
        F.count("*").alias("TotalRegistryCompanies"), n("CrawlReady").alias("CrawlReadyCount"), *[n(F.col("CrawlPriority") == p).alias(f"{p.title()}{'' if p == 'SKIP' else 'Priority'}Count") for p in PRIORITIES],
        *[n(c).alias(f"{a.title()}Count") for a, c in best.items()], *[n(F.col("CrawlReady") & best[a]).alias(f"{a.title()}Ready") for a in SUPPORTED], *[n(on(a)).alias(f"{a.title()}CatalogOnly") for a in later],
        n(F.col("CrawlStatus") == "NOT_READY").alias("CatalogOnlyCount"), n(on(later[0]) | on(later[1]) | on(later[2])).alias("MessyButExportableCount"),
    )


def priority_breakdown(queue: DataFrame) -> DataFrame:
    """Companies of each priority, how many are ready and supported, zero counts included."""
    found = queue.groupBy("CrawlPriority").agg(F.count("*").alias("Companies"), F.count_if("CrawlReady").alias("Ready"), F.count_if(F.col("FetchSupportStatus") == "SUPPORTED").alias("Supported"), F.count_if(F.col("ATSCount") > 1).alias("OnMany"))
    names = queue.sparkSession.createDataFrame([(p,) for p in PRIORITIES], "CrawlPriority string")
    return F.broadcast(names).join(found, "CrawlPriority", "left").na.fill(0)


def queue_heads(queue: DataFrame, most: int = 100) -> DataFrame:
    """The first companies of each priority: a report whose length is the feature."""
    order = Window.partitionBy("CrawlPriority").orderBy(F.desc("ATSCount"), "CompanyKey")
    return queue.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)

