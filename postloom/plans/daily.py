"""Queries over dated snapshots, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.operators import daily as D
from postloom.operators.ordering import numbered
from postloom.plans import views
from postloom.plans.jobs import TITLED

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def rows(spark, sf_dir):
    """The view with its job keys."""
    return views.view(spark, sf_dir, views.DAILY).withColumn("Key", D.job_key(F.col("Link"), F.col("Company"), F.col("Title"), F.col("Location"), plain=True))


_key = "'url:' || regexp_replace(regexp_replace(lower(Link), '[?#].*$', ''), '/+$', '')"
_D = f"""d as (select *, {_key} as Key from ({views.plain(views.DAILY)})), mx as (select max(day) as cur, (select max(day) from d where day < (select max(day) from d)) as prv, count(distinct day) as all_days from d),
cur as (select d.* from d, mx where day = cur), prv as (select d.* from d, mx where day = prv),
h as (select Key, min(day) as FirstSeen, max(day) as LastSeen, count(*) as SnapshotCount, arg_max(Company, day) as Company, arg_max(Title, day) as Title from d group by 1)"""
_best = "-coalesce(Score, 0), lower(Company), lower(Title), Link"
_US = "(regexp_matches(Location, '(?i)\\bunited\\s+states\\b') or regexp_matches(Location, '(?i)\\busa\\b') or regexp_matches(Location, '(?i)(?:^|[\\s,;|(/-])u\\.?\\s*s\\.?(?:$|[\\s,;|)/-])'))"
_CAT = f"j as (select distinct Title from d), {TITLED.strip()}"


@query(f"with {_D} select day, Company, Title, Location, {_key} as PlainKey, 'url:' || regexp_replace(lower(Link), '/+$', '') as JobKey, 'fallback:' || lower(Company) || '|' || lower(Title) || '|' || lower(Location) as Fallback from cur")
def x15_snapshot_keys(spark, sf_dir):
    c = [F.col(x) for x in ("Company", "Title", "Location")]
    return D.newest(rows(spark, sf_dir))[0].select("day", "Company", "Title", "Location", F.col("Key").alias("PlainKey"), D.job_key(F.col("Link"), *c).alias("JobKey"), D.job_key(F.lit(""), *c).alias("Fallback"))


_trend = "trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(Title)), '[^A-Za-z0-9_\\s/-]', ' ', 'g'), '\\b(senior|sr|staff|principal|lead|junior|jr|mid|associate)\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"with {_D} select {_trend} as TrendTitle, count(*) as Jobs from cur group by 1")
def x2_trend_titles(spark, sf_dir):
    return D.newest(rows(spark, sf_dir))[0].groupBy(D.trend_title(F.col("Title")).alias("TrendTitle")).agg(F.count("*").alias("Jobs"))


@query(f"with {_D} select Location, count(*) as Jobs, any_value({_US}) as ExplicitUS from d group by 1")
def f8_us_locations(spark, sf_dir):
    return rows(spark, sf_dir).groupBy("Location").agg(F.count("*").alias("Jobs")).withColumn("ExplicitUS", D.explicit_us(F.col("Location")))


@query(f"with {_D}, n as (select Key from cur where lower(Arrangement) = 'remote' and {_US}), p as (select Key from prv where lower(Arrangement) = 'remote' and {_US}) select Key, case when p.Key is null then 'added' when n.Key is null then 'removed' else 'continuing' end as Status from n full join p using (Key)")
def u2_us_remote_changes(spark, sf_dir):
    return D.us_remote_changes(*D.newest(rows(spark, sf_dir)))


@query(f"with {_D} select h.Key, Company, Title, FirstSeen, LastSeen, SnapshotCount, LastSeen = cur as CurrentlyPresent from h, mx")
def w21_lifecycle(spark, sf_dir):
    return D.lifecycle(rows(spark, sf_dir))


#: Some companies are missing on days of uneven months.
SPARSE = "not (day % 2 = 1 and cast(substring(Company, 6, 9) as int) % 4 = 3)"
_D4 = _D.replace(")), mx as (", f") where {SPARSE}), mx as (", 1)


@query(f"with {_D4} select Company, count(*) as CurrentJobs, arg_min(Title, ({_best})) as TopTitle, arg_min(Link, ({_best})) as TopURL from cur where Company not in (select Company from prv) group by 1")
def u4_new_companies(spark, sf_dir):
    return D.new_companies(*D.newest(rows(spark, sf_dir).where(SPARSE)))


def _moves(by: str) -> str:
    return f"""with {_D}, c as (select {by}, count(*) as n, arg_min(Title, ({_best})) as TopTitle from cur group by 1), p as (select {by}, count(*) as n from prv group by 1),
a as (select {by}, count(*) as n from cur where Key not in (select Key from prv) group by 1), r as (select {by}, count(*) as n from prv where Key not in (select Key from cur) group by 1), k as (select {by} from c union select {by} from p)
select {by}, coalesce(c.n, 0) as CurrentJobs, coalesce(p.n, 0) as PreviousJobs, coalesce(c.n, 0) - coalesce(p.n, 0) as NetChange, coalesce(a.n, 0) as NewJobs, coalesce(r.n, 0) as RemovedJobs, coalesce(TopTitle, '') as TopTitle
from k left join c using ({by}) left join p using ({by}) left join a using ({by}) left join r using ({by})"""


@query(_moves("Company"))
def u5_company_movement(spark, sf_dir):
    return D.movement(*D.newest(rows(spark, sf_dir)), "Company")


@query(_moves("Title"))
def u5_title_movement(spark, sf_dir):
    return D.movement(*D.newest(rows(spark, sf_dir)), "Title")


@query(f"with {_D} select cur.Key, cur.Company, cur.Title, Score, FirstSeen, SnapshotCount from cur join h using (Key) where cur.Key in (select Key from prv)")
def u8_continuing_jobs(spark, sf_dir):
    df = rows(spark, sf_dir)
    return D.continuing(*D.newest(df), df)


_RANGE = f"{_D}, w as (select d.* from d, mx where day >= cur - 7), b as (select min(day) as low, max(day) as high, count(distinct day) as days from w), k as (select Key, max(day) as LastInRange, count(distinct day) as DaysInRange from w group by 1)"


@query(f"with {_RANGE} select Key, FirstSeen, LastInRange, DaysInRange, concat_ws(' | ', case when FirstSeen > low then 'NEW' end, case when LastInRange < high then 'DROPPED' end, case when DaysInRange = days then 'PERSISTENT' end) as Changes from k join h using (Key), b")
def u7_weekly_listing(spark, sf_dir):
    df = rows(spark, sf_dir)
    return D.range_changes(D.trend_range(df), df)


@query(f"with {_RANGE} select Key, LastInRange from k")
def w24_last_in_range(spark, sf_dir):
    df = rows(spark, sf_dir)
    return D.range_changes(D.trend_range(df), df).select("Key", "LastInRange")


_modes = {"weekly": "day >= cur - 7", "days": "day >= cur - 20", "all": "true", "current-previous": "day >= prv", "snapshots": "day between 10 and 25"}


@query(f"with {_D} " + " union all ".join(f"select '{m}' as Mode, count(distinct day) as Snapshots, count(*) as Rows, min(day) as FirstDay, max(day) as LastDay from d, mx where {w}" for m, w in _modes.items()))
def u9_trend_ranges(spark, sf_dir):
    df = rows(spark, sf_dir)
    found = [D.trend_range(df, m, days=20, low=10, high=25).agg(F.lit(m).alias("Mode"), F.count_distinct("day").alias("Snapshots"), F.count("*").alias("Rows"), F.min("day").alias("FirstDay"), F.max("day").alias("LastDay")) for m in _modes]
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


_metrics = {"TotalRows": "count(*)", "Companies": "count(distinct Company)", "HighScores": "count(*) filter (Score >= 80)", "Undated": "count(*) filter (Age is null)", "Impossible": "count(*) filter (Score > 1000)"}
_side = lambda t, n: " union all ".join(f"select '{m}' as Metric, {e} as {n} from {t}" for m, e in _metrics.items())
_CHANGES = f"with {_D}, a as ({_side('cur', 'Current')}), b as ({_side('prv', 'Previous')}) select Metric, Current, Previous, Current - Previous as Difference, case when Previous <> 0 then round((Current - Previous) / Previous * 100, 2) when Current = Previous then 0 end as PercentChange from a join b using (Metric)"


@query(_CHANGES)
def u10_release_changes(spark, sf_dir):
    return D.metric_changes(*D.newest(rows(spark, sf_dir)))


@query(f"with {_D} select count(*) as CurrentJobs, (select count(*) from prv) as PreviousJobs, count(*) filter (Key not in (select Key from prv)) as NewJobs, (select count(*) from prv where Key not in (select Key from cur)) as RemovedJobs, count(*) filter (Key in (select Key from prv)) as ContinuingJobs from cur")
def a33_current_previous(spark, sf_dir):
    now, then = D.newest(rows(spark, sf_dir))
    both = now.select("Key", F.lit(1).alias("now")).join(then.select("Key", F.lit(1).alias("then")), "Key", "full")
    has, had = F.col("now").isNotNull(), F.col("then").isNotNull()
    return both.agg(F.count("now").alias("CurrentJobs"), F.count("then").alias("PreviousJobs"), F.count_if(has & ~had).alias("NewJobs"), F.count_if(had & ~has).alias("RemovedJobs"), F.count_if(has & had).alias("ContinuingJobs"))


@query(f"with {_D} select " + ", ".join(f"count(*) filter (Age <= {n}) as Last{n}Days" for n in (7, 14, 30)) + ", count(*) filter (Age is null) as UnknownAge, round(median(Age), 1) as MedianAge, round(avg(Age), 1) as AverageAge, max(Age) as OldestAge, min(Age) as NewestAge from cur")
def a35_freshness_ages(spark, sf_dir):
    return D.ages(D.newest(rows(spark, sf_dir))[0])


@query(f"""with {_D}, s(days) as (values (7), (14), (30)), f as (select days, Key, FirstSeen, Company, cur from h, mx, s where LastSeen >= cur - days), c as (select days, Company, count(*) as n, count(*) filter (FirstSeen >= cur - days) as new from f group by 1, 2),
p as (select *, row_number() over (partition by days order by n desc, Company) as place from c), z as (select days, count(distinct day) as Snapshots from d, mx, s where day >= cur - days group by 1)
select days::bigint as days, any_value(Snapshots) as Snapshots, sum(n)::bigint as UniqueJobs, sum(new)::bigint as FirstSeenJobs, count(*) as Companies, string_agg(Company || ':' || n, ' | ' order by place) filter (place <= 5) as TopCompanies from p join z using (days) group by days""")
def w25_rolling(spark, sf_dir):
    return D.rolling(rows(spark, sf_dir))


@query(f"""with {_D}, {_CAT}, e as (select cur.*, SnapshotCount, all_days, cur.Key in (select Key from prv) as was from cur join h using (Key) join t on t.Title = cur.Title, mx where TitleCategory not in ('Adjacent Roles', 'Unknown')),
m as (select Company from cur group by 1 having count(*) >= 3)
select Key, Company, Score, SnapshotCount, unnest(list_filter([case when Age >= 500 then 'EXTREME_OLD_POSTING' end, case when SnapshotCount >= greatest(4, all_days - 1) then 'LONG_RUNNING_JOB' end, case when Score >= 85 and Age >= 90 then 'HIGH_SCORE_OLD_JOB' end,
  case when SnapshotCount >= 2 and not was then 'REAPPEARED_JOB' end], lambda x: x is not null)) as Outlier from e
union all select Key, Company, Score, SnapshotCount, 'COMPANY_WITH_MANY_JOBS' from e where Company in (select Company from m) qualify row_number() over (partition by Company order by -coalesce(Score, 0), lower(Company), lower(Title), Key) = 1""")
def w26_outliers(spark, sf_dir):
    return D.outliers(rows(spark, sf_dir))


@query(f"""with {_D}, y as (select 'source' as kind, Source as name, day, Key, Age from d union all select 'company', Company, day, Key, Age from d), g as (select kind, name, day, count(*) as n, count(Age) as dated from y group by 1, 2, 3),
w as (select kind, name, (day % 7)::bigint as w, sum(n) as n from g group by 1, 2, 3), m as (select kind, name, arg_min(w, (-n, w)) as Weekday, max(n) as top from w group by 1, 2), u as (select kind, name, count(distinct Key) as UniqueJobs from y group by 1, 2)
select kind, name, any_value(UniqueJobs) as UniqueJobs, count(*) as ActiveSnapshots, median(g.n) as MedianJobs, any_value(Weekday) as Weekday, round(any_value(top) / sum(g.n) * 100, 2) as WeekdayShare, round(sum(dated) / sum(g.n) * 100, 2) as DatedShare from g join u using (kind, name) join m using (kind, name) group by 1, 2""")
def a38_posting_patterns(spark, sf_dir):
    return D.posting_patterns(rows(spark, sf_dir))


@query(f"with {_D}, {_CAT} select Title, case when trim(Title) = '' then 'blank' when regexp_matches(lower(Title), 'writ|doc|content|edit') then 'possible' else 'other' end as Bucket, count(*) as Jobs, round(count(*) / (select count(*) from cur) * 100, 2) as Share from cur join t using (Title) where TitleCategory = 'Unknown' group by 1, 2")
def a39_unknown_categories(spark, sf_dir):
    return D.unknown_categories(D.newest(rows(spark, sf_dir))[0])


@query(f"with {_D} select cur.Key, prv.Age as AgeBefore, cur.Age from cur join prv using (Key) where prv.Age - cur.Age >= 30")
def j15_moved_dates(spark, sf_dir):
    return D.moved_dates(*D.newest(rows(spark, sf_dir)))


@query(f"with {_D} select Key, row_number() over (order by Age asc nulls last, Score desc nulls last, lower(Company), lower(Title), Link) as place from cur")
def o4_upload_order(spark, sf_dir):
    return numbered(D.newest(rows(spark, sf_dir))[0], D.upload_order()).select("Key", "place")


@query(f"with {_D} select Key, row_number() over (order by Score desc, lower(Company), lower(Title), Key) as place from cur")
def o5_score_order(spark, sf_dir):
    return numbered(D.newest(rows(spark, sf_dir))[0], [F.desc("Score"), F.lower("Company"), F.lower("Title"), "Key"]).select("Key", "place")
