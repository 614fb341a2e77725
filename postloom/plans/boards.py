"""Queries over boards and fetch attempts, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.functions import fixed
from postloom.operators import boards as B
from postloom.plans import views

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def fetches(spark, sf_dir):
    return views.view(spark, sf_dir, views.FETCHES)


def catalog(spark, sf_dir):
    return views.view(spark, sf_dir, views.CATALOG)


def latest_time(df):
    """The time of the newest attempt, the queries' now."""
    return F.lit(df.agg(F.max("FetchedAt")).first()[0])


_L = f"l as (select *, lower(ATS) || '|' || lower(CatalogSlug) as BoardKey from ({views.plain(views.FETCHES)}))"
_C = f"c as ({views.plain(views.CATALOG)})"
_now = "(select max(FetchedAt) from l)"
_rate = lambda a, b: f"case when {b} > 0 then round({a} / {b} * 100, 2) else 0 end"
_hours = f"""case when CoverageStatus = 'UNSUPPORTED' then null when CoverageStatus = 'FETCH_FAILED' then least(168, 24 * pow(2, greatest(0, ConsecutiveFailures - 1)))
  {" ".join(f"when CoverageStatus = '{s}' then {h}" for s, h in B.INTERVAL_HOURS.items())} else 168 end"""
_STATE = f"""{_L},
o as (select *, row_number() over (partition by BoardKey order by FetchedAt desc, seq desc) as back from l),
b as (select BoardKey, min(ATS) as ATS, count(*) as AttemptCount, max(case when back = 1 then Status end) as LastFetchStatus, max(FetchedAt) as LastAttemptAt, max(case when back = 1 then JobCount end) as JobCount,
  max(case when Status in ('success', 'empty') then FetchedAt end) as LastSuccessAt, coalesce(min(case when Status <> 'failed' then back end), count(*) + 1) - 1 as ConsecutiveFailures from o group by BoardKey),
s0 as (select *, case LastFetchStatus when 'success' then 'JOBS_FOUND' when 'empty' then 'FETCHED_EMPTY' when 'failed' then 'FETCH_FAILED' else 'UNSUPPORTED' end as CoverageStatus from b),
s as (select *, LastAttemptAt + to_seconds(cast(({_hours}) * 3600 as bigint)) as NextCheckAt from s0)"""
_time = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def shown(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query(f"with {_STATE} select BoardKey, ATS, AttemptCount, LastFetchStatus, {_time('LastAttemptAt')} as LastAttemptAt, {_time('LastSuccessAt')} as LastSuccessAt, JobCount, ConsecutiveFailures, CoverageStatus, {_time('NextCheckAt')} as NextCheckAt from s")
def e1_board_state(spark, sf_dir):
    return B.board_state(fetches(spark, sf_dir)).select("BoardKey", "ATS", "AttemptCount", "LastFetchStatus", shown("LastAttemptAt"), shown("LastSuccessAt"), "JobCount", "ConsecutiveFailures", "CoverageStatus", shown("NextCheckAt"))


@query(f"""with {_STATE}, f as (select *, CoverageStatus <> 'UNSUPPORTED' as live, epoch({_now}) - epoch(LastAttemptAt) as age, CoverageStatus <> 'UNSUPPORTED' and NextCheckAt <= {_now} as due from s)
select coalesce(ATS, 'all') as ATS, count(*) filter (live and LastAttemptAt is not null) as AttemptedBoards, count(*) filter (live and LastAttemptAt is null) as NeverAttemptedBoards, count(*) as ActiveBoards, count(*) filter (live) as FetchEligibleBoards, count(*) filter (live and age <= 86400) as Checked24Hours, count(*) filter (live and age <= 604800) as Checked7Days,
  count(*) filter (live and age <= 2592000) as Checked30Days, count(*) filter (due) as DueBoards, count(*) filter (CoverageStatus = 'JOBS_FOUND') as JobsFoundBoards, count(*) filter (CoverageStatus = 'FETCHED_EMPTY') as EmptyBoards,
  count(*) filter (CoverageStatus = 'FETCH_FAILED') as FailedBoards, count(*) filter (CoverageStatus = 'FETCH_FAILED' and not due) as RetryDelayedFailedBoards, count(*) filter (CoverageStatus = 'FETCH_FAILED' and due) as DueFailedBoards,
  case when count(*) filter (live) > 0 then round(count(*) filter (live and age <= 604800) / count(*) filter (live) * 100, 2) else 100 end as Fresh7DayPercent from f group by rollup (ATS)""")
def a26_freshness(spark, sf_dir):
    log = fetches(spark, sf_dir)
    return B.freshness(B.board_state(log), latest_time(log))


@query(f"""with {_STATE}, d as (select *, row_number() over (partition by ATS order by case CoverageStatus {" ".join(f"when '{k}' then {v}" for k, v in B.STATUS_RANK.items())} else 99 end, NextCheckAt, BoardKey) as turn
  from s where CoverageStatus <> 'UNSUPPORTED' and NextCheckAt <= {_now}), t as (select * from d where turn <= 15)
select BoardKey, ATS, CoverageStatus, turn, row_number() over (order by turn, ATS) as place from t qualify place <= 60""")
def w28_due_boards(spark, sf_dir):
    """A schedule of the next boards: its length is the feature."""
    log = fetches(spark, sf_dir)
    return B.due_boards(B.board_state(log), latest_time(log)).select("BoardKey", "ATS", "CoverageStatus", F.col("turn").cast("long").alias("turn"), F.col("place").cast("long").alias("place"))


_sum = """count(*) as Attempts, count(*) filter (Status = 'failed' and cast(HttpStatus as int) >= 400) as HTTPFailureCount, count(*) filter (Status = 'empty') as EmptyCount, count(*) filter (JobCount = 0) as ZeroJobCount"""
_rates = ", ".join(f"{_rate(n + 'Count', 'Attempts')} as {n}Rate" for n in ("HTTPFailure", "Empty", "ZeroJob"))


@query(f"with {_L}, x as (select ATS, {_sum} from l where Status in ('success', 'empty', 'failed') group by ATS) select *, {_rates} from x")
def a22_attempt_summary(spark, sf_dir):
    return B.attempt_summary(fetches(spark, sf_dir), "ATS")


_one = lambda side: f"max_by(struct_pack(s := Status, h := HttpStatus, j := JobCount), FetchedAt) filter (side = '{side}')"
_ended = lambda w: f"r is not null and b is not null and {w}.s in ('success', 'empty', 'failed')"
_side = lambda w, n: f"count(*) filter ({_ended(w)}) as {n}Attempts, count(*) filter ({_ended(w)} and {w}.s = 'failed' and try_cast({w}.h as int) >= 400) as {n}HTTPFailure, count(*) filter ({_ended(w)} and {w}.s = 'empty') as {n}Empty, count(*) filter ({_ended(w)} and {w}.j = 0) as {n}ZeroJob"
_metrics = " union all ".join(f"select ATS, RecentBoards, BaselineBoards, MatchedBoards, RecentBoards - MatchedBoards as NewRecentBoards, RecentAttempts, BaselineAttempts, '{n}' as Metric, {_rate('Recent' + n, 'RecentAttempts')} as RecentRate, {_rate('Baseline' + n, 'BaselineAttempts')} as BaselineRate from p" for n in ("HTTPFailure", "Empty", "ZeroJob"))


@query(f"""with {_L}, a as (select *, floor(epoch({_now})) - floor(epoch(FetchedAt)) as age from l), w as (select *, case when age between 0 and 86400 then 'recent' when age > 86400 and age <= 691200 then 'baseline' end as side from a),
f as (select * from w where side is not null qualify row_number() over (partition by BoardKey, side order by FetchedAt desc, seq) = 1),
y as (select BoardKey, any_value(ATS) as ATS, {_one('recent')} as r, {_one('baseline')} as b from f group by BoardKey),
z as (select ATS, count(r) as RecentBoards, count(b) as BaselineBoards, count(*) filter (r is not null and b is not null) as MatchedBoards, {_side('r', 'Recent')}, {_side('b', 'Baseline')} from y group by ATS),
p as (select names.ATS, z.* exclude (ATS) from (select distinct ATS from l) as names left join z using (ATS)),
m as ({_metrics}), r as (select *, round(RecentRate - BaselineRate, 2) as PointIncrease, case when BaselineRate > 0 then round(RecentRate / BaselineRate, 2) when RecentRate = 0 then 1 end as Ratio from m)
select *, case when RecentAttempts < 20 or BaselineAttempts < 50 then 'INSUFFICIENT_DATA' when PointIncrease >= 10 and case when BaselineRate = 0 then RecentRate >= 10 else Ratio >= 1.5 end
  then case when PointIncrease >= 20 and (Ratio is null or Ratio >= 2) then 'HIGH' else 'WARN' end else 'OK' end as Verdict from r""")
def c16_anomaly(spark, sf_dir):
    log = fetches(spark, sf_dir)
    return B.anomalies(log, latest_time(log))


@query(f"with {_L} select BoardKey, Status, seq from l where Status in ('success', 'empty') qualify row_number() over (partition by BoardKey order by FetchedAt desc, seq desc) = 1")
def w12_latest_fetch(spark, sf_dir):
    log = fetches(spark, sf_dir)
    return B.latest(log.where(F.col("Status").isin(*B.LIVE)), B.board_key(), ["FetchedAt", "seq"], "Status", "seq")


#: Fetches with the batch they came in; some have no slug.
_G = f"g as (select *, lower(ATS) || '|' || lower(CatalogSlug) as BoardKey, BatchName as SourceBatch from ({views.plain(views.LOG)}))"
SUPERSEDED = f"""with {_G}, n as (select BoardKey, Status as ns, FetchedAt as nt, SourceBatch as nb from g where CatalogSlug <> '' and Status in ('success', 'empty') qualify row_number() over (partition by BoardKey order by FetchedAt desc, seq desc) = 1)
select seq, ATS, CatalogSlug, SourceBatch, coalesce(case ns when 'empty' then FetchedAt > nt when 'success' then SourceBatch = nb end, true) as keep from g left join n on n.BoardKey = g.BoardKey and CatalogSlug <> '' where Status <> 'skipped'"""


def batch_log(spark, sf_dir):
    return views.view(spark, sf_dir, views.LOG).withColumn("SourceBatch", F.col("BatchName"))


@query(SUPERSEDED)
def j1_superseded_rows(spark, sf_dir):
    """Rows of each fetch that wasn't skipped, and whether the newest live fetch of their board leaves them in force."""
    log = batch_log(spark, sf_dir)
    return B.superseded(log.where("Status <> 'skipped'"), B.latest_live(log)).select("seq", "ATS", "CatalogSlug", "SourceBatch", "keep")


_health = """h as (select ATS, count(distinct BoardKey) as BoardsAttempted, count(*) as Attempts, count(*) filter (Status = 'success') as SuccessCount, count(*) filter (Status = 'empty') as EmptyCount,
  count(*) filter (Status = 'failed') as FailedCount, count(*) filter (Status = 'skipped') as SkippedCount, sum(JobCount)::bigint as JobsFetched from l group by ATS),
g as (select *, round(SuccessCount / Attempts * 100, 2) as SuccessRate, round(FailedCount / Attempts * 100, 2) as FailureRate, array_to_string(list_filter([case when SuccessCount > 0 then 'success:' || SuccessCount end,
  case when EmptyCount > 0 then 'empty:' || EmptyCount end, case when FailedCount > 0 then 'failed:' || FailedCount end, case when SkippedCount > 0 then 'skipped:' || SkippedCount end], lambda x: x is not null), ' | ') as StatusCounts from h)"""
SUPPORTED = ["ashby", "greenhouse", "lever"]


@query(f"with {_L}, {_health} select * from g")
def a28_fetch_health(spark, sf_dir):
    return B.fetch_health(fetches(spark, sf_dir))


@query(f"""with {_L}, {_health} select ATS, case when ATS in ('ashby', 'greenhouse', 'lever') and JobsFetched > 1000 and SuccessRate >= 50 then 'SCALE_NOW' when JobsFetched > 0 and BoardsAttempted < 100 then 'SAMPLE_MORE'
  when ATS in ('ashby', 'greenhouse', 'lever') and JobsFetched > 0 and FailureRate >= 50 then 'REVIEW_FETCHER' when JobsFetched > 0 then 'KEEP_BEST_EFFORT'
  when ATS in ('ashby', 'greenhouse', 'lever') then 'REVIEW_FETCHER' else 'CATALOG_ONLY_FOR_NOW' end as ScaleRecommendation from g""")
def c20_recommendation(spark, sf_dir):
    return B.recommendation(B.fetch_health(fetches(spark, sf_dir)), SUPPORTED).select("ATS", "ScaleRecommendation")


@query(f"with {_C} select ATS, count(*) as Rows, count(distinct Slug) as DistinctSlugs, count(distinct CompanyKey) as DistinctCompanies, count(*) filter (BoardURL <> '') as WithURL, count(*) filter (ATS = '' or Slug = '' or regexp_matches(BoardURL, '\\s')) as Malformed from c group by ATS")
def a16_catalog_breakdown(spark, sf_dir):
    return B.catalog_breakdown(catalog(spark, sf_dir))


_set = lambda c: f"array_to_string(list_sort(list(distinct {c})), ' | ')"


@query(f"with {_C} select Slug, count(*) as Count, {_set('ATS')} as ATSList, {_set('CompanyKey')} as CompanyKeys from c group by Slug having count(*) > 1")
def a17_duplicate_values(spark, sf_dir):
    return B.duplicate_values(catalog(spark, sf_dir))


@query(f"with {_C} select CompanyKey, count(distinct ATS) as ATSCount, count(distinct Slug) as SlugCount, {_set('ATS')} as ATSList, {_set('Slug')} as Slugs from c group by CompanyKey having count(distinct ATS) > 1 or count(distinct Slug) > 1")
def a18_key_overlap(spark, sf_dir):
    return B.key_overlap(catalog(spark, sf_dir))


_pivot = ", ".join(f"first({c} order by seq) filter (ATS = '{a}' and {c} <> '') as {a}_{c}" for a in fixed.ATS for c in ("Slug", "BoardURL"))


@query(f"with {_C} select CompanyKey, count(*) as Boards, first(Company order by seq) as Company, {_pivot} from c group by CompanyKey")
def a19_registry_pivot(spark, sf_dir):
    return B.registry(catalog(spark, sf_dir))


_unpivot = " union all ".join(f"select CompanyKey, '{a}' as ATS, {a}_Slug as Slug, '{a}|' || {a}_Slug as BoardKey from r where {a}_Slug is not null" for a in fixed.ATS)


@query(f"with {_C}, r as (select CompanyKey, {_pivot} from c group by CompanyKey) {_unpivot}")
def p27_boards(spark, sf_dir):
    return B.enumerate_boards(B.registry(catalog(spark, sf_dir))).select("CompanyKey", "ATS", "Slug", "BoardKey")


@query(f"""with {_C}, o as (select distinct ATS || '|' || Slug as BoardKey from c where Country < 'M'), n as (select distinct ATS || '|' || Slug as BoardKey from c where Country >= 'F')
select BoardKey, case when o.BoardKey is null then 'added' when n.BoardKey is null then 'removed' else 'retained' end as status from o full join n using (BoardKey)""")
def u3_board_diff(spark, sf_dir):
    """Boards of two states of a catalogue: that of countries up to L, and that of countries from F."""
    own = catalog(spark, sf_dir).withColumn("BoardKey", F.concat_ws("|", "ATS", "Slug"))
    old = own.where("Country < 'M'").select("BoardKey", F.lit(1).alias("o")).distinct()
    new = own.where("Country >= 'F'").select("BoardKey", F.lit(1).alias("n")).distinct()
    return old.join(new, "BoardKey", "full").select("BoardKey", F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("retained").alias("status"))


_q = lambda x: "'" + x + "'"
_has = lambda a: f"(coalesce({a}_Slug, '') <> '' or coalesce({a}_BoardURL, '') <> '')"


def _fetch_url(a: str) -> str:
    made = "''"
    if a in B.FETCH_URLS:
        before, after = B.FETCH_URLS[a].split("{}")
        made = f"case when coalesce({a}_Slug, '') <> '' then '{before}' || {a}_Slug || '{after}' else '' end"
    return f"case when coalesce({a}_BoardURL, '') <> '' then {a}_BoardURL else {made} end"


_QUEUE = f"""{_C}, r as (select CompanyKey, first(Company order by seq) as Company, {_pivot} from c group by CompanyKey),
q0 as (select CompanyKey, Company, case {" ".join(f"when {_has(a)} then '{a}'" for a in B.PROVIDERS)} else '' end as BestATS, case {" ".join(f"when {_has(a)} then {_fetch_url(a)}" for a in B.PROVIDERS)} else '' end as EstimatedFetchURL,
  list_filter([{", ".join(f"case when {_has(a)} then '{a}' end" for a in B.PROVIDERS)}], lambda x: x is not null) as names,
  array_to_string(list_filter([{", ".join(f"case when {_has(a)} and {_fetch_url(a)} = '' then '{a}' end" for a in B.PROVIDERS)}], lambda x: x is not null), ' | ') as UnavailableATSList from r),
q1 as (select * exclude (names), array_to_string(names, ' | ') as ATSList, len(names) as ATSCount, CompanyKey <> '' and Company <> '' and EstimatedFetchURL <> '' as CrawlReady from q0),
q as (select *, case when not CrawlReady then 'SKIP' {" ".join(f"when BestATS = '{a}' then '{p}'" for a, p in B.PROVIDER_PRIORITY.items())} else 'SKIP' end as CrawlPriority,
  case when CrawlReady then 'READY' when ATSCount > 0 then 'NOT_READY' else 'SKIP' end as CrawlStatus,
  case when BestATS = '' then 'UNSUPPORTED' when BestATS in ({", ".join(map(_q, B.SUPPORTED))}) then 'SUPPORTED' when EstimatedFetchURL <> '' then 'BEST_EFFORT' else 'CATALOG_ONLY' end as FetchSupportStatus,
  case when CompanyKey = '' then 'Missing company key' when Company = '' then 'Missing preferred company name' when EstimatedFetchURL = '' then 'No usable URL' else BestATS || ' board available' end as CrawlReason from q1)"""


@query(f"with {_QUEUE} select * from q")
def p23_crawl_queue(spark, sf_dir):
    return B.crawl_queue(B.registry(catalog(spark, sf_dir)))


_later = [a for a in B.PROVIDERS if a not in B.SUPPORTED]
_on = lambda a: f"contains(UnavailableATSList, '{a}')"
_counted = ", ".join(
    [f"count(*) filter (CrawlPriority = '{p}') as {p.title()}{'' if p == 'SKIP' else 'Priority'}Count" for p in B.PRIORITIES] + [f"count(*) filter (BestATS = '{a}') as {a.title()}Count" for a in B.PROVIDERS]
    + [f"count(*) filter (CrawlReady and BestATS = '{a}') as {a.title()}Ready" for a in B.SUPPORTED] + [f"count(*) filter ({_on(a)}) as {a.title()}CatalogOnly" for a in _later]
)


@query(f"with {_QUEUE} select count(*) as TotalRegistryCompanies, count(*) filter (CrawlReady) as CrawlReadyCount, {_counted}, count(*) filter (CrawlStatus = 'NOT_READY') as CatalogOnlyCount, count(*) filter ({' or '.join(map(_on, _later))}) as MessyButExportableCount from q")
def a20_queue_summary(spark, sf_dir):
    return B.queue_summary(B.crawl_queue(B.registry(catalog(spark, sf_dir))))


@query(f"with {_QUEUE}, dim as (select unnest([{', '.join(map(_q, B.PRIORITIES))}]) as CrawlPriority) select CrawlPriority, count(q.CompanyKey) as Companies, count(*) filter (CrawlReady) as Ready, count(*) filter (FetchSupportStatus = 'SUPPORTED') as Supported, count(*) filter (ATSCount > 1) as OnMany from dim left join q using (CrawlPriority) group by 1")
def a20_priority_breakdown(spark, sf_dir):
    return B.priority_breakdown(B.crawl_queue(B.registry(catalog(spark, sf_dir))))


@query(f"with {_QUEUE} select CompanyKey, CrawlPriority, row_number() over (partition by CrawlPriority order by ATSCount desc, CompanyKey) as place from q qualify place <= 100")
def o3_queue_heads(spark, sf_dir):
    return B.queue_heads(B.crawl_queue(B.registry(catalog(spark, sf_dir)))).select("CompanyKey", "CrawlPriority", F.col("place").cast("long").alias("place"))
