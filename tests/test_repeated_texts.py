"""Rules that read only a posting's texts are worked out once a text, and what is read again is worked out once."""

from pyspark.sql import functions as F

from postloom.operators import postings
from postloom.plans import jobs as plans

DIR = "/root/testdata/sf0.001"


def odd_jobs(spark):
    rows = plans.jobs(spark, DIR).where("seq < 300")
    blank = lambda c, n: F.when(F.col("seq") % n == 0, None).when(F.col("seq") % n == 1, " ").otherwise(F.col(c)).alias(c)
    return rows.select("seq", "ATS", blank("Company", 17), blank("Title", 13), blank("Location", 11), blank("Description", 7), blank("URL", 19), "DatePosted", "RawJobId").cache()


def test_by_texts_as_by_rows(spark):
    jobs = odd_jobs(spark)
    for whole in (postings.enriched, postings.graded):
        by_text, by_row = whole(jobs), whole(jobs, 0)
        assert set(by_text.columns) == set(by_row.columns)
        order = sorted(by_row.columns)
        shown = lambda df: sorted(map(str, df.select(*order).collect()))
        assert shown(by_text) == shown(by_row)


def test_rows_are_spared_the_patterns(spark):
    for name in ("c9_quality", "c10_writer_fit", "o8_bad_rows"):
        plan = {**plans.QUERIES, **__import__("postloom.plans.reports", fromlist=["QUERIES"]).QUERIES}[name](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" not in plan, name


def test_winners_read_stored_rows(spark):
    plan = plans.QUERIES["w5_winners"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and "try_parse_url" not in plan


def test_readers_of_stored_rows(spark):
    from postloom.plans import QUERIES

    for name in ("w16_consolidation", "w17_grouped_postings", "w18_other_links", "w19_title_families"):
        plan = QUERIES[name](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan and "o_orderkey" not in plan, name
