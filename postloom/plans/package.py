"""Queries over display rows, checks, outliers and round trips of files, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.functions.folders import scratch_folder
from postloom.operators import package as K
from postloom.plans.jobs import ENRICHED, _any, _J, enriched, jobs
from postloom.plans.snapshots import _S, _hist, snapshots
from postloom.sources import feeds, sinks

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


_both = "lower(concat_ws(' ', Title, TitleDomainSignal, WriterFitReasons))"
_why = " ".join(f"when {_any(_both, ps)} then '{n}'" for n, ps in K.WHY)


@query(f"""with {ENRICHED} select seq, Title, Company, Location, case when URL = '' then '' else '=HYPERLINK("' || replace(URL, '"', '""') || '","Apply")' end as ApplyLink, WriterFitScore::bigint as WriterFitScore, WriterFitTier,
  case when MatchedWatchlistTitle <> '' then 'Matched watchlist title: ' || MatchedWatchlistTitle {_why} else 'High writer-fit score' end as WhyItMatched,
  case when TitleCategory in ('Adjacent Roles', 'Unknown') then 'Adjacent / Transferable' else TitleCategory end as RoleType, RemoteStatus as WorkArrangement, SalaryText as Salary, DatePosted,
  greatest(date_diff('day', cast(DatePosted as date), date '2000-01-01'), 0)::bigint as AgeDays, ATS as Source from e""")
def p21_display_rows(spark, sf_dir):
    return K.display_rows(enriched(spark, sf_dir), F.lit("2000-01-01").cast("date"))


@query(f"""with {_J}, c as (select ATS, unnest(['Company', 'Title', 'Location', 'Description', 'URL', 'RawJobId']) as field, unnest([Company, Title, Location, Description, URL, RawJobId]) as v from j)
select ATS, field, count(*) as rows, count(*) filter (trim(v) = '') as missing, round(count(*) filter (trim(v) = '') / count(*) * 100, 2) as share, round(count(*) filter (trim(v) = '') / count(*) * 100, 2) >= 1 as spike from c group by 1, 2""")
def a41_quality_checks(spark, sf_dir):
    return K.quality_checks(jobs(spark, sf_dir), ["Company", "Title", "Location", "Description", "URL", "RawJobId"])


@query(f"with {_J}, c as (select trim(URL) as v, count(*) as n from j where trim(URL) <> '' group by 1) select coalesce(sum(n - 1), 0)::bigint as excess from c")
def a41_excess_urls(spark, sf_dir):
    return K.excess_duplicates(jobs(spark, sf_dir), "URL")


@query(f"with {_S}, f as (select company_no, snapshot_id, count(*) as n, max(score) as top from s group by 1, 2) select company_no, min(snapshot_id) as first_seen, arg_min(n, snapshot_id) as first_jobs, max(top) as best_score from f group by 1")
def w22_company_first_seen(spark, sf_dir):
    return K.first_of_company(snapshots(spark, sf_dir))


@query(f"with {ENRICHED} select TitleCategory, count(*) as jobs, count(distinct Company) as companies, round(avg(WriterFitScore), 2) as average_score, round(count(*) / (select count(*) from e) * 100, 2) as share from e group by 1")
def a36_category_counts(spark, sf_dir):
    return K.category_counts(enriched(spark, sf_dir))


@query("select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, p_type, cast(p_size as varchar) as p_size from part")
def s4_roundtrip_delimited(spark, sf_dir):
    """Delimited text written and read again."""
    path = scratch_folder(spark, "delimited")
    sinks.write_delimited(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), path)
    return feeds.delimited(spark, path)


@query("select event_id, user_id, event_type, value from events")
def s2_roundtrip_json(spark, sf_dir):
    """JSON lines written and read again as the lines of an array."""
    path = scratch_folder(spark, "json")
    sinks.write_json_lines(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value"), path)
    return feeds.json_array_lines(spark, path, "event_id long, user_id long, event_type string, value double")


@query("select s_suppkey, s_name, s_nationkey from supplier")
def k8_publish(spark, sf_dir):
    """A table published as a checked version and read through its name."""
    root = scratch_folder(spark, "published")
    sinks.publish(spark, {"supplier": spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")}, root)
    return sinks.published(spark, root, "supplier")
