"""Queries over snapshots, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.operators import snapshots as S
from postloom.plans import views

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def snapshots(spark, sf_dir):
    return views.view(spark, sf_dir, views.SNAPSHOTS)


_S = f"""s as ({views.plain(views.SNAPSHOTS)}), ids as (select distinct snapshot_id, dense_rank() over (order by snapshot_id) as n, dense_rank() over (order by snapshot_id desc) as back from s),
sn as (select s.*, n, back from s join ids using (snapshot_id)), cur as (select * from sn where back = 1), prev as (select * from sn where back = 2)"""
_diff = """d as (select company_no, part_no, case when prev.score is null then 'added' when cur.score is null then 'removed' else 'continuing' end as status from cur full join prev using (company_no, part_no))"""
_hist = """h as (select company_no, part_no, min(snapshot_id) as first_seen, max(snapshot_id) as last_seen, count(*) as snapshots, arg_max(score, snapshot_id) as latest_score from s group by 1, 2)"""


@query(f"with {_S}, {_diff} select * from d")
def u1_snapshot_diff(spark, sf_dir):
    return S.diff(*S.last_two(snapshots(spark, sf_dir)))


@query(f"with {_S}, {_diff}, g as (select company_no, count(*) filter (status = 'added') as added, count(*) filter (status = 'removed') as removed, count(*) filter (status = 'continuing') as kept from d group by 1) select company_no, added + kept as current_jobs, removed + kept as previous_jobs, added - removed as net, added, removed from g")
def u5_company_trends(spark, sf_dir):
    return S.company_trends(*S.last_two(snapshots(spark, sf_dir)))


@query(f"with {_S}, {_hist} select * from h")
def w20_history(spark, sf_dir):
    return S.history(snapshots(spark, sf_dir))


@query(f"with {_S}, g as (select company_no, part_no, n, n - lag(n) over (partition by company_no, part_no order by n) - 1 as gap from sn), x as (select company_no, part_no, count(*) as gaps, arg_max(gap, n) as last_gap from g where gap > 0 group by 1, 2) select x.* from x semi join cur using (company_no, part_no)")
def w23_reappeared(spark, sf_dir):
    return S.reappeared(snapshots(spark, sf_dir)).select("company_no", "part_no", "gaps", F.col("last_gap").cast("long").alias("last_gap"))


@query(f"""with {_S}, g as (select *, lag(n) over (partition by company_no, part_no order by n) as was, lead(n) over (partition by company_no, part_no order by n) as later from sn),
r as (select n + 1 as n, count(*) as removed from g where later is null or later > n + 1 group by 1),
a as (select snapshot_id, n, count(*) as jobs, case when n > 1 then count(*) filter (was is null or was < n - 1) else 0 end as added from g group by 1, 2)
select snapshot_id, jobs, added, coalesce(removed, 0) as removed from a left join r using (n)""")
def w27_churn(spark, sf_dir):
    return S.churn(snapshots(spark, sf_dir))


@query(f"with {_S} select snapshot_id, count(*) as jobs, count(distinct company_no) as companies, count(distinct part_no) as titles, round(avg(score), 4) as average_score, max(price) as highest_price from s group by 1")
def a34_market_history(spark, sf_dir):
    return S.market(snapshots(spark, sf_dir))


@query(f"with {_S} select company_no, count(distinct snapshot_id) as snapshots, count(distinct part_no) as titles, min(snapshot_id) as first_seen from s group by 1 having count(distinct snapshot_id) >= 3")
def a37_repeat_companies(spark, sf_dir):
    return S.repeat_companies(snapshots(spark, sf_dir))


@query(f"with {_S}, {_hist} select count(*) as jobs, count(*) filter (snapshots = (select count(*) from ids)) as persistent, count(*) filter (snapshots = 1) as once, count(*) filter (last_seen = (select max(snapshot_id) from ids)) as present from h")
def u6_range_metrics(spark, sf_dir):
    return S.range_metrics(snapshots(spark, sf_dir))
