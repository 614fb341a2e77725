"""Queries over the second generation of rules, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.functions import fixed
from postloom.operators import postings as P
from postloom.operators import variants as V
from postloom.plans.boards import _L, _now, fetches, latest_time
from postloom.plans.jobs import ENRICHED, _any, _J, _list, _q, _rank, _title, enriched, jobs

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


_records = ", ".join(f"({r['at']}, {_q(r['title'])}, {_q(r['category'])}, {_q(r['norm'])}, {_list(r['tokens'])})" for r in P.watchlist())
_core = f"""{_J}, watch(pos, wtitle, wcategory, wnorm, wtokens) as (values {_records}),
c1 as (select Title, trim(regexp_replace(lower(trim(Title)), '\\s+', ' ', 'g')) as norm from (select distinct Title from j)),
c2 as (select *, list_intersect(list_filter(list_distinct(string_split(norm, ' ')), lambda x: x <> ''), wtokens) as both_ from c1, watch),
c3 as (select *, len(list_filter(both_, lambda x: list_contains({_list(fixed.CORE_STRONG)}, x))) as strong,
  len(list_filter(both_, lambda x: list_contains({_list([w for w in fixed.CORE_WEAK if w not in fixed.CORE_STRONG])}, x))) as weak from c2),
c4 as (select *, least((strong * 10 + weak * 2) * 100.0 / len(wtokens), 100) as raw from c3),
c5 as (select *, case when norm = wnorm then 100 when contains(norm, wnorm) then greatest(boosted, 95) else boosted end as score from (select *, case when strong >= 2 then least(raw + 25, 100) when strong = 1 then least(raw + 10, 100) else raw end as boosted from c4)),
c6 as (select * from c5 qualify row_number() over (partition by Title order by score desc, pos) = 1),
c as (select Title, case when score = 0 then 'none' when norm = wnorm then 'exact' when contains(norm, wnorm) then 'contains' else 'none' end as TitleMatchType, floor(score + 0.5)::bigint as TitleMatchScore,
  case when score > 0 then wtitle else '' end as MatchedWatchlistTitle, case when score > 0 then wcategory else '' end as TitleMatchCategory,
  case when score >= 80 then 'high' when score >= 60 then 'medium' when score > 0 then 'low' else 'none' end as TitleConfidence from c6)"""


@query(f"with {_core} select * from c")
def c2_title_match_core(spark, sf_dir):
    return V.core_title_matches(jobs(spark, sf_dir).select("Title").distinct())


_first = lambda pairs: "case " + " ".join(f"when {_any('lower(Title)', ps)} then {_q(n)}" for n, ps in pairs) + " else '' end"


@query(f"""with {_core}, r as (select *, {_first(fixed.CORE_DOMAINS)} as TitleDomainSignal, {_first([(k, [k]) for k in fixed.CORE_SENIORITY])} as TitleSenioritySignal,
  {_any('lower(Title)', fixed.CORE_LEADERSHIP)} as TitleLeadershipSignal, {_any('lower(Title)', fixed.CORE_IC)} as TitleICSignal from c)
select Title, case when TitleMatchScore >= 80 then 'HIGH_PRIORITY_MATCH' when TitleMatchScore >= 60 then 'POTENTIAL_MATCH' when TitleSenioritySignal <> '' and TitleDomainSignal <> '' then 'SENIOR_IN_DOMAIN'
  when TitleLeadershipSignal and TitleDomainSignal <> '' then 'LEADERSHIP_ROLE' when TitleICSignal and TitleDomainSignal <> '' then 'IC_IN_DOMAIN' when TitleDomainSignal <> '' then 'IN_DOMAIN' when TitleSenioritySignal <> '' then 'SENIOR_ROLE' else 'IGNORE_FOR_NOW' end as TitleReviewBucket,
  (case when TitleMatchScore >= 80 then 1 when TitleMatchScore >= 60 then 2 when TitleSenioritySignal <> '' and TitleDomainSignal <> '' then case when TitleLeadershipSignal then 1 else 3 end
  when TitleLeadershipSignal and TitleDomainSignal <> '' then 1 when TitleICSignal and TitleDomainSignal <> '' then 3 when TitleDomainSignal <> '' then 4 else 5 end)::bigint as TitleReviewPriority,
  TitleDomainSignal, TitleSenioritySignal, TitleLeadershipSignal, TitleICSignal from r""")
def c4_title_review_core(spark, sf_dir):
    return V.core_title_reviews(V.core_title_matches(jobs(spark, sf_dir).select("Title").distinct()))


_fields = ["ATS", "Company", "Title", "Location", "Description", "URL", "DatePosted", "RawJobId"]


@query(f"""with {_J}, k as (select seq, coalesce(nullif(regexp_replace(regexp_replace(lower(trim(Company)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unknown') || '-' || {_title('Title')} as DedupeKey,
  {" + ".join(f"case when {f} <> '' then 1 else 0 end" for f in _fields)} as filled from j)
select DedupeKey, seq, count(*) over (partition by DedupeKey) as GroupSize from k qualify row_number() over (partition by DedupeKey order by filled desc, seq) = 1""")
def w10_core_canonical(spark, sf_dir):
    return V.canonical_jobs(jobs(spark, sf_dir), _fields)


_var = lambda x: f"array_to_string(list_transform(string_split({x}, ' '), lambda t: case t {' '.join(f'when {_q(k)} then {_q(v)}' for k, v in fixed.VARIANTS.items())} else t end), ' ')"


@query(f"""with {_J}, watch(pos, wtitle, wcategory, wnorm, wtokens) as (values {_records}),
t1 as (select Title, {_title('Title')} as norm from (select distinct Title from j)), t2 as (select *, {_var('norm')} as var, {_var('wnorm')} as wvar from t1, watch),
t3 as (select *, case when norm = '' then 0 when norm = wnorm then 3 when var = wvar then 2
  when contains(' ' || var || ' ', ' ' || wvar || ' ') and not ({_any('var', fixed.MARKETING)} and not {_any('wvar', fixed.MARKETING)}) then 1 else 0 end as tier from t2),
t4 as (select * from t3 qualify row_number() over (partition by Title order by tier desc, case when tier = 1 then length(wvar) else 0 end desc, pos) = 1)
select Title, case tier when 3 then 'exact' when 2 then 'variant' when 1 then 'contains' else 'none' end as MatchType, case when tier > 0 then wtitle else '' end as MatchedTitle, case when tier > 0 then wcategory else '' end as MatchedCategory from t4""")
def j17_consumer_match(spark, sf_dir):
    return V.consumer_matches(jobs(spark, sf_dir).select("Title").distinct())


@query(f"""with {_L}, a as (select *, floor(epoch({_now})) - floor(epoch(FetchedAt)) <= 86400 as recent from l),
g as (select ATS, count(*) filter (recent) as RecentAttempts, count(*) filter (not recent) as BaselineAttempts, count(*) filter (recent and Status = 'failed') as f, sum(case when recent then JobCount end) as rj, sum(case when not recent then JobCount end) as bj from a group by ATS),
h as (select *, f / RecentAttempts as share, case when bj > 0 then (rj / RecentAttempts - bj / BaselineAttempts) / (bj / BaselineAttempts) else 0 end as change from g where RecentAttempts > 0)
select ATS, RecentAttempts, BaselineAttempts, round(share * 100, 2) as FailedRate, round(change * 100, 2) as JobCountChange,
  case when share > 0.25 then 'CRITICAL' when share > 0.10 or (BaselineAttempts > 0 and change < -0.05) then 'DEGRADED' else 'NORMAL' end as Health from h""")
def c17_anomaly_core(spark, sf_dir):
    log = fetches(spark, sf_dir)
    return V.core_anomalies(log, latest_time(log))


@query(f"""with {ENRICHED}, k as (select *, lower(trim(Company)) || '|' || lower(trim(Title)) as GroupKey, lower(trim(Location)) as spot from e),
g as (select GroupKey, count(*) as Postings, count(distinct nullif(spot, '')) as Places, list_sort(list(distinct nullif(trim(Location), ''))) as names, min(DatePosted) as first_date from k group by 1),
b as (select GroupKey, seq from k semi join (select GroupKey from g where Places >= 2) using (GroupKey) qualify row_number() over (partition by GroupKey order by {_rank('RemoteStatus', fixed.REMOTE_RANK)}, WriterFitScore desc, Location, seq) = 1)
select seq, Postings, 'Multiple locations (' || Postings || ' postings): ' || array_to_string(names[1:8], '; ') || case when len(names) > 8 then '; +' || (len(names) - 8) || ' more' else '' end as Location, first_date as DatePosted from b join g using (GroupKey)
union all select seq, 1, Location, DatePosted from k anti join (select GroupKey from g where Places >= 2) using (GroupKey)""")
def w16_consolidation(spark, sf_dir):
    return V.consolidated(enriched(spark, sf_dir))


@query(f"with {ENRICHED} select seq, lower('feed:' || ATS || ':' || JobKey) as sourceId, Title as title, Company as company, Location as location, RemoteStatus as workArrangement, WriterFitScore::bigint as fitScore, WriterFitTier as fitTier, CanonicalURLKey as url, case when SalaryDetected then SalaryMin end as salaryMin, case when SalaryDetected then SalaryMax end as salaryMax, DatePosted as postedAt, 1 as schemaVersion from e where RemoteStatus <> 'Hybrid'")
def p20_consumer_jobs(spark, sf_dir):
    rows = enriched(spark, sf_dir).where("RemoteStatus <> 'Hybrid'")
    return rows.select(
        "seq", F.lower(F.concat(F.lit("feed:"), "ATS", F.lit(":"), "JobKey")).alias("sourceId"), F.col("Title").alias("title"), F.col("Company").alias("company"), F.col("Location").alias("location"), F.col("RemoteStatus").alias("workArrangement"),
        F.col("WriterFitScore").cast("long").alias("fitScore"), F.col("WriterFitTier").alias("fitTier"), F.col("CanonicalURLKey").alias("url"), F.col("SalaryMin").alias("salaryMin"), F.col("SalaryMax").alias("salaryMax"), F.col("DatePosted").alias("postedAt"), F.lit(1).alias("schemaVersion"),
    )
