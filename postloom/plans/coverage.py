"""Queries over coverage, merged states and batch plans, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.operators import boards as B
from postloom.operators import coverage as V
from postloom.plans import views
from postloom.plans.boards import _C, _QUEUE, _STATE, _now, _pivot, catalog, fetches, latest_time, shown

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def log(spark, sf_dir):
    return views.view(spark, sf_dir, views.LOG)


def public(spark, sf_dir):
    return views.view(spark, sf_dir, views.PUBLIC)


def present(spark, sf_dir):
    return V.present_boards(B.registry(catalog(spark, sf_dir)))


_q = lambda x: "'" + x + "'"
_time = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
_G = f"g as ({views.plain(views.LOG)})"
_key = lambda ats, slug, company: f"lower({ats}) || ':' || case when {slug} <> '' then 'slug:' || lower({slug}) when {company} <> '' then 'company:' || lower({company}) else 'unknown:' end"
_GK = f"{_G}, gk as (select *, {_key('ATS', 'CatalogSlug', 'CompanyKey')} as CoverageKey from g), lat as (select * from gk qualify row_number() over (partition by CoverageKey order by FetchedAt desc, seq) = 1)"


@query(f"""with {_G} select seq, case when regexp_matches(lower(Error), 'no usable .* fetch url') then 'NO_USABLE_URL' when regexp_matches(lower(Error), 'abort|timed? out|timeout') then 'TIMEOUT'
  when s = 429 then 'RATE_LIMITED' when s >= 500 then 'UPSTREAM_SERVER_ERROR' when s in (404, 410) then 'BOARD_NOT_FOUND' when s in (401, 403) then 'ACCESS_BLOCKED' when ATS = 'workday' and s = 422 then 'ENDPOINT_REJECTED'
  when s >= 400 then 'HTTP_CLIENT_ERROR' when regexp_matches(lower(Error), 'json|parse|unexpected token|html') then 'RESPONSE_PARSE_ERROR'
  when regexp_matches(lower(Error), 'dns|enotfound|getaddrinfo|network|fetch failed|econn') then 'NETWORK_ERROR' else 'UNKNOWN_FETCH_ERROR' end as ErrorClass
from (select *, coalesce(try_cast(HttpStatus as int), 0) as s from g where Status = 'failed')""")
def c15_error_class(spark, sf_dir):
    failed = log(spark, sf_dir).where("Status = 'failed'")
    return failed.select("seq", B.error_class(F.expr("try_cast(HttpStatus as int)"), F.col("ATS"), message=F.col("Error")).alias("ErrorClass"))


@query(f"with {_G} select seq, {_key('ATS', 'CatalogSlug', 'CompanyKey')} as CoverageKey from g")
def x32_coverage_key(spark, sf_dir):
    return log(spark, sf_dir).select("seq", V.log_key().alias("CoverageKey"))


@query(f"with {_G} select max(seq) as seq, lower(ATS) as ATS, lower(CatalogSlug) as Slug, count(*) as Rows from g group by lower(ATS), lower(CatalogSlug), FetchedAt, lower(Status)")
def s11_distinct_attempts(spark, sf_dir):
    df = log(spark, sf_dir)
    rows = df.groupBy(F.lower("ATS").alias("ATS"), F.lower("CatalogSlug").alias("Slug"), "FetchedAt", F.lower("Status").alias("s")).agg(F.count("*").alias("Rows"), F.max("seq").alias("seq"))
    return V.distinct_attempts(df).select("seq").join(rows, "seq").select("seq", "ATS", "Slug", "Rows")


@query(f"with {_G} select BatchName, count(*) as Attempts, count(distinct ATS) as Providers, min(seq) as FirstRow from g group by BatchName")
def s10_batch_logs(spark, sf_dir):
    """Logs of all batches written to a folder each and read back as one, tagged by their folder."""
    from postloom.functions.folders import scratch_folder
    from postloom.sources import feeds

    path = scratch_folder(spark, "logs")
    log(spark, sf_dir).write.partitionBy("BatchName").mode("overwrite").json(path)
    found = feeds.batch_logs(spark, path, "seq long, ATS string, CatalogSlug string, CompanyKey string, FetchedAt timestamp, Status string, HttpStatus string, JobCount long, Error string")
    return found.groupBy("BatchName").agg(F.count("*").alias("Attempts"), F.count_distinct("ATS").alias("Providers"), F.min("seq").alias("FirstRow"))


@query(f"with {_GK} select CoverageKey, seq, Status, {_time('FetchedAt')} as FetchedAt from lat")
def w13_latest_log(spark, sf_dir):
    return V.newest_first(log(spark, sf_dir), V.log_key()).select(F.col("k0").alias("CoverageKey"), "seq", "Status", shown("FetchedAt"))


@query(f"with {_G} select lower(ATS) as ATS, lower(CatalogSlug) as Slug, seq, Status from g where FetchedAt > (select max(FetchedAt) from g) - interval 1 day qualify row_number() over (partition by lower(ATS), lower(CatalogSlug) order by FetchedAt desc, seq) = 1")
def w14_latest_in_window(spark, sf_dir):
    df = log(spark, sf_dir)
    recent = df.where(F.col("FetchedAt") > latest_time(df) - F.expr("interval 1 day"))
    return V.newest_first(recent, F.lower("ATS"), F.lower("CatalogSlug")).select(F.col("k0").alias("ATS"), F.col("k1").alias("Slug"), "seq", "Status")


@query(f"with {_G} select CatalogSlug, min(seq) as place, max(seq) as seq, arg_max(Status, seq) as Status from g where CatalogSlug <> '' group by CatalogSlug")
def w15_merged_log(spark, sf_dir):
    return V.upserted(log(spark, sf_dir), F.col("CatalogSlug")).select("CatalogSlug", "place", "seq", "Status")


@query(f"""with {_G}, w as (select *, epoch_us((select max(FetchedAt) from g)) - epoch_us(FetchedAt) as age from g),
r as (select lower(ATS) as ATS, lower(CatalogSlug) as CatalogSlug, Status as recent, JobCount as recent_jobs from w where age <= 86400000000 qualify row_number() over (partition by lower(ATS), lower(CatalogSlug) order by FetchedAt desc, seq) = 1),
b as (select lower(ATS) as ATS, lower(CatalogSlug) as CatalogSlug, Status as baseline, JobCount as baseline_jobs from w where age > 86400000000 and age <= 691200000000 qualify row_number() over (partition by lower(ATS), lower(CatalogSlug) order by FetchedAt desc, seq) = 1)
select * from r join b using (ATS, CatalogSlug)""")
def j2_matched_cohort(spark, sf_dir):
    df = log(spark, sf_dir)
    return V.matched_cohort(df, latest_time(df))


_PUB = f"pub as ({views.plain(views.PUBLIC)}), jc as (select ATS, CompanyKey, count(*) as JobsFound, count(*) filter (WriterFitTier in ('A', 'B')) as GoodMatchesFound, max(FetchedAt) as JobsChecked from pub group by 1, 2)"


@query(f"with {_PUB} select ATS, CompanyKey, JobsFound, GoodMatchesFound, {_time('JobsChecked')} as LastChecked from jc")
def a24_job_counts(spark, sf_dir):
    return V.job_counts(public(spark, sf_dir)).select("ATS", "CompanyKey", "JobsFound", "GoodMatchesFound", shown("LastChecked"))


_present = " union all ".join(f"select CompanyKey, '{a}' as ATS, coalesce({a}_Slug, '') as Slug, coalesce({a}_BoardURL, '') as BoardURL from r where coalesce({a}_Slug, '') <> '' or coalesce({a}_BoardURL, '') <> ''" for a in B.PROVIDERS)
_PRESENT = f"""{_QUEUE}, pr as (select p.*, q.Company, q.BestATS, q.CrawlReady, q.CrawlPriority, q.FetchSupportStatus, {_key('p.ATS', 'p.Slug', 'p.CompanyKey')} as CoverageKey from ({_present}) p join q using (CompanyKey)),
ca as (select * from pr where Slug <> '' and case when ATS in ('ashby', 'greenhouse', 'lever') then BestATS = ATS and CrawlReady and FetchSupportStatus in ('SUPPORTED', 'BEST_EFFORT') else CrawlPriority <> '' end)"""


@query(f"""with {_PRESENT}, {_GK}, {_PUB}, byc as (select lower(ATS) as ATS, lower(CompanyKey) as CompanyKey, Status as cs, FetchedAt as cf, Error as ce from g qualify row_number() over (partition by lower(ATS), lower(CompanyKey) order by FetchedAt desc, seq) = 1),
j as (select pr.*, coalesce(lat.Status, cs) as st, case when lat.seq is not null then lat.FetchedAt else cf end as ft, case when lat.seq is not null then lat.Error else ce end as er, coalesce(JobsFound, 0) as JobsFound, coalesce(GoodMatchesFound, 0) as GoodMatchesFound, JobsChecked
  from pr left join lat using (CoverageKey) left join byc on byc.ATS = pr.ATS and byc.CompanyKey = pr.CompanyKey left join jc on jc.ATS = pr.ATS and jc.CompanyKey = pr.CompanyKey)
select CompanyKey, ATS, Company, BestATS, case when GoodMatchesFound > 0 then 'GOOD_MATCHES_FOUND' when JobsFound > 0 then 'JOBS_FOUND' when FetchSupportStatus = 'CATALOG_ONLY' then 'CATALOG_ONLY'
  when ATS in ('ashby', 'greenhouse', 'lever') and FetchSupportStatus not in ('SUPPORTED', 'BEST_EFFORT') then 'UNSUPPORTED' when st = 'empty' then 'FETCHED_EMPTY' when st = 'failed' then 'FETCH_FAILED' when st = 'skipped' then 'UNSUPPORTED' else 'NOT_ATTEMPTED' end as CoverageStatus,
  JobsFound, GoodMatchesFound, {_time('coalesce(ft, JobsChecked)')} as LastChecked, coalesce(st, '') as LastFetchStatus, coalesce(er, '') as LastFetchError from j""")
def j3_company_coverage(spark, sf_dir):
    rows = V.company_coverage(present(spark, sf_dir), log(spark, sf_dir), V.job_counts(public(spark, sf_dir)))
    return rows.withColumn("LastChecked", shown("LastChecked"))


@query(f"with {_PRESENT}, {_GK} select CompanyKey, ATS, Slug, CoverageKey from ca where CoverageKey not in (select CoverageKey from gk)")
def j4_remaining(spark, sf_dir):
    return V.remaining(present(spark, sf_dir), log(spark, sf_dir)).select("CompanyKey", "ATS", "Slug", "CoverageKey")


@query(f"with {_C}, {_G} select seq, Slug from c where Slug not in (select CatalogSlug from g where lower(Status) in ('success', 'empty', 'failed', 'skipped') and CatalogSlug <> '')")
def j5_not_attempted(spark, sf_dir):
    """Catalogue rows to go on with: those without an attempt of a terminal status."""
    done = log(spark, sf_dir).where(F.lower("Status").isin("success", "empty", "failed", "skipped") & (F.col("CatalogSlug") != "")).select(F.col("CatalogSlug").alias("Slug")).distinct()
    return catalog(spark, sf_dir).join(done, "Slug", "left_anti").select("seq", "Slug")


_limit = "case ATS " + " ".join(f"when '{a}' then {n}" for a, n in V.BATCH_LIMITS.items()) + " end"
_pad = lambda x: f"case when {x} < 10000 then lpad(({x})::varchar, 4, '0') else ({x})::varchar end"


@query(f"""with {_PRESENT}, i as (select CompanyKey, ATS, CrawlPriority, row_number() over (partition by ATS, CrawlPriority order by CompanyKey) - 1 as Index from ca), o as (select *, (floor(Index / {_limit}) * {_limit})::bigint as "Offset" from i)
select *, ATS || '-' || lower(CrawlPriority) || '-' || {_pad('"Offset"')} as BatchName from o""")
def w29_row_indexes(spark, sf_dir):
    return V.row_indexes(present(spark, sf_dir)).select("CompanyKey", "ATS", "CrawlPriority", "Index", "Offset", "BatchName")


_BY = f"""{_PRESENT}, {_GK}, dim as (select unnest([{', '.join(map(_q, B.PROVIDERS))}]) as ATS), a as (select ATS, count(*) as n from pr group by 1), b as (select ATS, count(*) as n, count(*) filter (CoverageKey not in (select CoverageKey from gk)) as left_ from ca group by 1),
t as (select lower(ATS) as ATS, count(*) as AttemptedRows, count(*) filter (Status = 'success' and JobCount > 0) as SuccessRows, count(*) filter (Status = 'empty' or Status = 'success' and JobCount = 0) as EmptyRows,
  count(*) filter (Status = 'failed') as FailedRows, count(*) filter (Status = 'skipped') as SkippedRows from lat group by 1),
v as (select dim.ATS, coalesce(a.n, 0) as CatalogRows, coalesce(b.n, 0) as FetchSupportedRows, coalesce(left_, 0) as RemainingRows, coalesce(AttemptedRows, 0) as AttemptedRows, coalesce(SuccessRows, 0) as SuccessRows, coalesce(EmptyRows, 0) as EmptyRows,
  coalesce(FailedRows, 0) as FailedRows, coalesce(SkippedRows, 0) as SkippedRows from dim left join a using (ATS) left join b using (ATS) left join t using (ATS)),
by_ as (select *, case when FetchSupportedRows = 0 then 100 else round(least(FetchSupportedRows, AttemptedRows) / FetchSupportedRows * 100, 2) end as CoveragePercent,
  case when FetchSupportedRows > 0 and RemainingRows = 0 then 'COMPLETE' when FetchSupportedRows > 0 and AttemptedRows > 0 then 'IN_PROGRESS' else 'NOT_STARTED' end as CompletionStatus from v)"""


@query(f"with {_BY} select * from by_")
def a25_ats_coverage(spark, sf_dir):
    return V.by_provider(present(spark, sf_dir), log(spark, sf_dir))


@query(f"""with {_BY} select sum(CatalogRows)::bigint as CatalogRowsTotal, sum(FetchSupportedRows)::bigint as FetchSupportedTotal, sum(least(AttemptedRows, FetchSupportedRows))::bigint as AttemptedTotal, sum(RemainingRows)::bigint as RemainingTotal,
  case when sum(FetchSupportedRows) = 0 then 100 else round(sum(least(AttemptedRows, FetchSupportedRows)) / sum(FetchSupportedRows) * 100, 2) end as CoveragePercentOverall,
  count(*) filter (CompletionStatus = 'COMPLETE') as SupportedATSCompleteCount, count(*) filter (CompletionStatus = 'IN_PROGRESS') as SupportedATSInProgressCount from by_""")
def a25_coverage_summary(spark, sf_dir):
    return V.coverage_summary(V.by_provider(present(spark, sf_dir), log(spark, sf_dir)))


_BATCHES = f"""{_G}, ix as (select BatchName, count(*) as BoardsAttempted, sum(JobCount)::bigint as JobsFetched, count(*) filter (Status = 'failed') as FailedBoards, min(FetchedAt) as StartedAt, max(FetchedAt) as FinishedAt from g group by 1),
sc as (select BatchName, string_agg(Status || ':' || n, ' | ' order by Status) as StatusCounts from (select BatchName, Status, count(*) as n from g group by 1, 2) group by 1)"""


@query(f"with {_BATCHES} select BatchName, BoardsAttempted, JobsFetched, FailedBoards, {_time('StartedAt')} as StartedAt, {_time('FinishedAt')} as FinishedAt, StatusCounts from ix join sc using (BatchName)")
def a30_batch_index(spark, sf_dir):
    return V.batch_index(log(spark, sf_dir)).withColumns({"StartedAt": shown("StartedAt"), "FinishedAt": shown("FinishedAt")})


@query(f"with {_BATCHES}, s as (select BatchName, case when n % 3 = 0 then null else n * 10 end as SummaryRows from (select BatchName, row_number() over (order by BatchName) as n from ix)) select BatchName, coalesce(nullif(SummaryRows, 0), JobsFetched) as PublicFeedRows, SummaryRows is null as Recomputed from ix left join s using (BatchName)")
def a29_batch_rows(spark, sf_dir):
    """Per batch the row count that its summary states, else the count of its log: here every third summary is missing."""
    from pyspark.sql import Window

    index = V.batch_index(log(spark, sf_dir))
    n = F.row_number().over(Window.orderBy("BatchName"))
    summaries = index.select("BatchName").withColumn("n", n).select("BatchName", F.when(F.col("n") % 3 != 0, F.col("n") * 10).cast("long").alias("SummaryRows"))
    return index.join(summaries, "BatchName", "left").select("BatchName", F.coalesce(F.nullif("SummaryRows", F.lit(0)), "JobsFetched").alias("PublicFeedRows"), F.col("SummaryRows").isNull().alias("Recomputed"))


_NEXT = f"""{_BATCHES}, nx as (select split_part(BatchName, '-', 1) as ATS, max(regexp_extract(BatchName, '(?:^|-)(\\d{{4,}})(?:-|$)', 1)::bigint + BoardsAttempted) as NextOffset from ix group by 1)"""


def _indexed(spark, sf_dir):
    index = V.batch_index(log(spark, sf_dir))
    return index.select(F.split("BatchName", "-")[0].alias("ATS"), "BatchName", F.lit(None).cast("long").alias("Offset"), F.lit(None).cast("long").alias("Limit"), "BoardsAttempted")


@query(f"with {_NEXT} select * from nx")
def a43_next_offsets(spark, sf_dir):
    return V.next_offsets(_indexed(spark, sf_dir))


_rules = ", ".join(f"({_q(a)}, [{', '.join(map(_q, r))}], {n}, {V.BATCH_LIMITS[a]})" for a, (r, n) in V.PLAN_RULES.items())


@query(f"""with {_NEXT}, rules(ATS, allowed, batches, Limit_) as (values {_rules}), rec(ATS, ScaleRecommendation) as (values ('ashby', 'SCALE_NOW'), ('greenhouse', 'SAMPLE_MORE'), ('lever', 'KEEP_BEST_EFFORT')),
pub as ({views.plain(views.PUBLIC)}), el as (select ATS, count(distinct CompanyKey) * 20 as EligibleRows from pub group by 1),
o as (select ATS, ScaleRecommendation, batches, Limit_::bigint as "Limit", coalesce(EligibleRows, 0) as EligibleRows, coalesce(NextOffset, 0) + unnest(range(0, 50)) * Limit_ as "Offset" from rules join rec using (ATS) left join el using (ATS) left join nx using (ATS) where list_contains(allowed, ScaleRecommendation)),
n as (select *, ATS || '-high-' || {_pad('"Offset"')} as BatchName from o), f as (select *, row_number() over (partition by ATS order by "Offset") as turn from n where BatchName not in (select BatchName from ix))
select ATS, ScaleRecommendation, "Offset", "Limit", BatchName, case when "Offset" < EligibleRows then 'READY' else 'SKIPPED' end as PlanStatus from f where turn <= batches""")
def w30_next_batches(spark, sf_dir):
    """The next batches, for recommendations as a health report states them."""
    index = _indexed(spark, sf_dir)
    said = spark.createDataFrame([("ashby", "SCALE_NOW"), ("greenhouse", "SAMPLE_MORE"), ("lever", "KEEP_BEST_EFFORT")], "ATS string, ScaleRecommendation string")
    eligible = public(spark, sf_dir).groupBy("ATS").agg((F.count_distinct("CompanyKey") * 20).alias("EligibleRows"))
    return V.plan_batches(V.next_offsets(index), said, eligible, index)


def _entries(spark, sf_dir):
    own = catalog(spark, sf_dir).where("Country >= 'F'")
    first = own.groupBy(F.concat_ws("|", "ATS", "Slug").alias("BoardKey")).agg(F.min_by(F.struct("ATS", "CompanyKey"), "seq").alias("r"))
    return first.select("BoardKey", "r.ATS", "r.CompanyKey", (F.col("r.ATS") != "icims").alias("FetchEligible"))


def _previous(spark, sf_dir):
    state = B.board_state(log(spark, sf_dir).where("CatalogSlug <> ''"))
    company = log(spark, sf_dir).where("CatalogSlug <> ''").groupBy(B.board_key().alias("BoardKey")).agg(F.min("CompanyKey").alias("CompanyKey"))
    return state.join(company, "BoardKey").select("BoardKey", "ATS", "CompanyKey", "CoverageStatus", "LastFetchStatus", "LastAttemptAt", "JobCount", F.col("ConsecutiveFailures").cast("long").alias("ConsecutiveFailures"), "NextCheckAt")


def _covered(spark, sf_dir):
    own = public(spark, sf_dir)
    status = F.when(F.col("seq") % 3 == 0, "GOOD_MATCHES_FOUND").when(F.col("seq") % 3 == 1, "FETCH_FAILED").otherwise("fetched_empty")
    return own.select("seq", "ATS", "CompanyKey", F.when(F.col("seq") % 2 == 0, F.concat(F.lit("slug-"), F.col("seq") % 83)).otherwise("").alias("Slug"), status.alias("CoverageStatus"), F.lit("success").alias("LastFetchStatus"),
                      F.col("FetchedAt").alias("LastChecked"), (F.col("seq") % 7).alias("JobsFound"), (F.col("seq") % 2).alias("GoodMatchesFound"))


_state_g = _STATE.replace(views.plain(views.FETCHES), f"select * from ({views.plain(views.LOG)}) where CatalogSlug <> ''")
_hours = f"""case when CoverageStatus in ('UNSUPPORTED', 'CATALOG_ONLY') then null when CoverageStatus = 'FETCH_FAILED' then least(168, 24 * pow(2, greatest(0, ConsecutiveFailures - 1))) {" ".join(f"when CoverageStatus = '{s}' then {h}" for s, h in B.INTERVAL_HOURS.items())} else 168 end"""
_SYNC = f"""{_state_g}, {_C}, pv as (select s.*, ck from s join (select BoardKey, min(CompanyKey) as ck from l group by 1) using (BoardKey)),
en as (select ATS || '|' || Slug as BoardKey, arg_min(ATS, seq) as ATS, arg_min(CompanyKey, seq) as CompanyKey, arg_min(ATS, seq) <> 'icims' as FetchEligible from c where Country >= 'F' group by 1),
pub as ({views.plain(views.PUBLIC)}), cv as (select seq, ATS, CompanyKey, case when seq % 2 = 0 then 'slug-' || (seq % 83) else '' end as Slug, case seq % 3 when 0 then 'GOOD_MATCHES_FOUND' when 1 then 'FETCH_FAILED' else 'fetched_empty' end as CoverageStatus, FetchedAt as LastChecked, seq % 7 as JobsFound from pub),
ex as (select ATS || '|' || Slug as BoardKey, CoverageStatus as xs, LastChecked as xt, JobsFound as xj from cv where Slug <> '' qualify row_number() over (partition by ATS, Slug order by LastChecked desc, seq desc) = 1),
co as (select ATS, CompanyKey, CoverageStatus as cs, LastChecked as ct, JobsFound as cj from cv qualify row_number() over (partition by ATS, CompanyKey order by LastChecked desc, seq desc) = 1),
e1 as (select en.*, case when xs is not null then xs when en.ATS not in ('workday', 'icims') then cs end as vs, case when xs is not null then xt when en.ATS not in ('workday', 'icims') then ct end as vt,
  case when xs is not null then xj when en.ATS not in ('workday', 'icims') then cj end as vj from en left join ex using (BoardKey) left join co on co.ATS = en.ATS and co.CompanyKey = en.CompanyKey),
m as (select coalesce(e1.BoardKey, pv.BoardKey) as BoardKey, coalesce(e1.ATS, pv.ATS) as ATS, coalesce(e1.CompanyKey, pv.ck) as CompanyKey, e1.BoardKey is not null as Active, coalesce(e1.FetchEligible, false) as FetchEligible,
  coalesce(e1.FetchEligible, false) and vs is not null and (pv.BoardKey is null or vt > pv.LastAttemptAt) as newer, vs, vt, vj, pv.CoverageStatus as ps, pv.LastAttemptAt as pt, pv.JobCount as pj, pv.ConsecutiveFailures as pf, pv.NextCheckAt as pn from e1 full join pv on pv.BoardKey = e1.BoardKey),
z as (select BoardKey, ATS, CompanyKey, Active, FetchEligible, case when Active and not FetchEligible then 'UNSUPPORTED' when newer then upper(vs) else coalesce(ps, 'NOT_ATTEMPTED') end as CoverageStatus, case when newer then vt else pt end as LastAttemptAt,
  (case when newer and upper(vs) = 'FETCH_FAILED' then greatest(1, coalesce(pf, 0)) when newer then 0 else coalesce(pf, 0) end)::bigint as ConsecutiveFailures, coalesce(case when newer then vj else pj end, 0)::bigint as JobCount, case when not newer then pn end as kept from m),
y as (select *, case when FetchEligible then coalesce(kept, coalesce(LastAttemptAt, timestamp '1970-01-01') + to_seconds(cast(({_hours}) * 3600 as bigint))) end as NextCheckAt from z)"""


@query(f"with {_SYNC} select BoardKey, ATS, CompanyKey, Active, FetchEligible, CoverageStatus, {_time('LastAttemptAt')} as LastAttemptAt, ConsecutiveFailures, JobCount, {_time('NextCheckAt')} as NextCheckAt from y")
def j6_synced_state(spark, sf_dir):
    found = V.synced_state(_entries(spark, sf_dir), _previous(spark, sf_dir), _covered(spark, sf_dir))
    return found.select("BoardKey", "ATS", "CompanyKey", "Active", "FetchEligible", "CoverageStatus", shown("LastAttemptAt"), "ConsecutiveFailures", "JobCount", shown("NextCheckAt"))


@query(f"with {_SYNC} select BoardKey, xs as CoverageStatus, {_time('xt')} as LastChecked, xj as JobsFound from ex")
def j7_coverage_lookup(spark, sf_dir):
    exact, _ = V.coverage_lookup(_covered(spark, sf_dir))
    return exact.select("BoardKey", "exact.CoverageStatus", F.date_format("exact.LastChecked", "yyyy-MM-dd HH:mm:ss").alias("LastChecked"), "exact.JobsFound")


@query(f"with {_QUEUE} select ATS || '|' || Slug as BoardKey, arg_min(CompanyKey, c.seq) as CompanyKey, arg_min(coalesce(q.Company, c.Company), c.seq) as Company, arg_min(coalesce(q.CrawlPriority, 'SKIP'), c.seq) as CrawlPriority from c left join q using (CompanyKey) group by 1")
def j9_board_catalog(spark, sf_dir):
    """Catalogue rows with what the queue says of their company; the first row of a board wins."""
    rows = catalog(spark, sf_dir)
    queue = B.crawl_queue(B.registry(rows)).select("CompanyKey", F.col("Company").alias("named"), "CrawlPriority")
    first = rows.join(queue, "CompanyKey", "left").groupBy(F.concat_ws("|", "ATS", "Slug").alias("BoardKey")).agg(F.min_by(F.struct("CompanyKey", F.coalesce("named", "Company").alias("Company"), F.coalesce("CrawlPriority", F.lit("SKIP")).alias("CrawlPriority")), "seq").alias("r"))
    return first.select("BoardKey", "r.*")


_one_hot = ", ".join(f"BestATS = '{a}' as Has_{a}, case when BestATS = '{a}' then EstimatedFetchURL else '' end as {a}_URL" for a in B.PROVIDERS)


@query(f"with {_QUEUE} select CompanyKey, BestATS, {_one_hot} from q where BestATS <> ''")
def p28_fetch_rows(spark, sf_dir):
    """Boards back as one-hot queue rows."""
    queue = B.crawl_queue(B.registry(catalog(spark, sf_dir))).where("BestATS <> ''")
    hot = [c for a in B.PROVIDERS for c in ((F.col("BestATS") == a).alias(f"Has_{a}"), F.when(F.col("BestATS") == a, F.col("EstimatedFetchURL")).otherwise("").alias(f"{a}_URL"))]
    return queue.select("CompanyKey", "BestATS", *hot)


@query(f"with {_QUEUE} select CompanyKey, row_number() over (order by CompanyKey) - 1 as place from q where BestATS = 'ashby' and CrawlPriority = 'HIGH' and CrawlReady and CompanyKey <> '' qualify place >= 2 and place < 7")
def f9_candidate_page(spark, sf_dir):
    """A page of a provider's ready companies: offset 2, limit 5. The limit is the feature."""
    queue = B.crawl_queue(B.registry(catalog(spark, sf_dir)))
    from pyspark.sql import Window

    rows = queue.where("BestATS = 'ashby' and CrawlPriority = 'HIGH' and CrawlReady and CompanyKey <> ''").orderBy("CompanyKey").offset(2).limit(5)
    return rows.withColumn("place", (F.row_number().over(Window.orderBy("CompanyKey")) + 1).cast("long")).select("CompanyKey", "place")


@query(f"with {_QUEUE} select BestATS as ATS, count(*) as EligibleRows from q where CrawlPriority = 'HIGH' and CrawlReady group by 1")
def f12_eligible_rows(spark, sf_dir):
    return B.crawl_queue(B.registry(catalog(spark, sf_dir))).where("CrawlPriority = 'HIGH' and CrawlReady").groupBy(F.col("BestATS").alias("ATS")).agg(F.count("*").alias("EligibleRows"))


@query(f"""with pub as ({views.plain(views.PUBLIC)}), x as (select seq, ATS, 'slug-' || (seq % 83) as Slug, case when seq % 4 = 0 then '' else 'Firm ' || (seq % 83) end as Company, CompanyKey, FetchedAt, seq % 101 as Score, 1 as GoodMatchRows, 'top-match' as SourceReason, 0 as side from pub where WriterFitTier in ('A', 'B')
  union all select seq, ATS, 'slug-' || (seq % 83), 'Covered ' || (seq % 83), CompanyKey, FetchedAt, 0, seq % 2 + 1, 'coverage-good-matches', 1 from pub where seq % 3 = 0 and WriterFitTier = 'C')
select ATS || '|' || Slug as BoardKey, coalesce(arg_min(Company, (side, seq)) filter (Company <> ''), '') as Company, coalesce(arg_min(CompanyKey, (side, seq)) filter (CompanyKey <> ''), '') as CompanyKey, max(Score)::bigint as MaxWriterFitScore, sum(GoodMatchRows)::bigint as GoodMatchRows,
  {_time('max(FetchedAt)')} as LatestFetchedAt, array_to_string(list_sort(list(distinct SourceReason)), ' | ') as SourceReasons from x where ATS in ('ashby', 'greenhouse', 'lever', 'bamboohr') group by 1""")
def j20_refresh_candidates(spark, sf_dir):
    own = public(spark, sf_dir).withColumn("Slug", F.concat(F.lit("slug-"), F.col("seq") % 83))
    matches = own.where("WriterFitTier in ('A', 'B')").select("seq", "ATS", "Slug", F.when(F.col("seq") % 4 == 0, "").otherwise(F.concat(F.lit("Firm "), F.col("seq") % 83)).alias("Company"), "CompanyKey", "FetchedAt", (F.col("seq") % 101).alias("Score"))
    covered = own.where("WriterFitTier = 'C'").select("seq", "ATS", "Slug", F.concat(F.lit("Covered "), F.col("seq") % 83).alias("Company"), "CompanyKey", "FetchedAt", F.when(F.col("seq") % 3 == 0, "GOOD_MATCHES_FOUND").otherwise("JOBS_FOUND").alias("CoverageStatus"), (F.col("seq") % 2 + 1).alias("GoodMatchRows"))
    return V.refresh_candidates(matches, covered, ["ashby", "greenhouse", "lever", "bamboohr"]).withColumn("LatestFetchedAt", shown("LatestFetchedAt"))


@query(f"select row_number() over (order by LatestFetchedAt, GoodMatchRows desc, MaxWriterFitScore desc, BoardKey) as place, * from ({SQL['j20_refresh_candidates']})")
def o9_stalest_first(spark, sf_dir):
    """Candidates in the order of refreshing: stalest first, then more good rows, better score."""
    from postloom.operators.ordering import numbered

    return numbered(QUERIES["j20_refresh_candidates"](spark, sf_dir), ["LatestFetchedAt", F.desc("GoodMatchRows"), F.desc("MaxWriterFitScore"), "BoardKey"])


@query("select ATS, Issue from (values ('edited', 'attempt accounting'), ('edited', 'freshness windows are not monotonic')) as v(ATS, Issue)")
def a27_freshness_issues(spark, sf_dir):
    """The measured summaries add up; one with two edited counts gives two issues."""
    df = fetches(spark, sf_dir)
    found = B.freshness(B.board_state(df), latest_time(df))
    edited = found.where("ATS = 'all'").withColumns({"ATS": F.lit("edited"), "AttemptedBoards": F.col("AttemptedBoards") + 1, "Checked7Days": F.lit(-1).cast("long")})
    return V.freshness_issues(found.unionByName(edited))


@query(f"with {_G} select seq, row_number() over (order by ATS, CompanyKey, FetchedAt, seq) as place from g")
def o11_attempt_listing(spark, sf_dir):
    """Attempts in the order of provider, company and time: a range-partitioned sort numbers them without one task for all."""
    from postloom.operators.ordering import numbered

    return numbered(log(spark, sf_dir).select("seq", "ATS", "CompanyKey", "FetchedAt"), ["ATS", "CompanyKey", "FetchedAt", "seq"]).select("seq", "place")
