"""What several postings' queries share: no row is parsed, measured or shuffled again for what is known of it."""

import random

import pytest
from pyspark.sql import functions as F

from postloom.functions import text
from postloom.operators import postings
from postloom.plans import QUERIES

DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["f4_slice_membership", "p21_display_rows", "c10_writer_fit", "c9_quality"])
def test_facts_of_rows_are_stored(spark, name):
    own = plan(spark, name)
    assert "octet_length" not in own and "try_parse_url" not in own and "ParseUrl" not in own


def test_tiers_read_stored_counts(spark):
    assert "CanonicalURLKey" not in plan(spark, "a7_fit_tier_summary")


def test_diagnostics_need_no_duplicates(spark):
    own = plan(spark, "p19_match_diagnostics")
    assert "CanonicalURLKey" not in own and "PossibleDuplicate" not in own


def test_run_summary_copies_no_rows(spark):
    own = plan(spark, "a1_run_summary")
    assert "Expand" not in own and "CanonicalURLKey" not in own


def test_slices_move_numbers(spark):
    own = plan(spark, "w7_slice_components")
    assert "DuplicateGroupKey" not in own and "CanonicalURLKey" not in own


def test_urls_read_as_parsed(spark):
    urls = [
        "http://a.example", "HTTPS://A.Example/X//", "http://u:p@h.example:80/a/b/?q=/x#/y", "//h.example/a", "//h.example/http://b/c", "http://h?x/y", "http://h#/x", "http:///x", "mailto:a@b", "a:b//c", "http://[::1]:8/x", "http://1.2.3/x",
        "ftp://f.example/%20 b", "http://h_x/y", "not a url", "", " ", None, "http://h/ä/", "http://h/a?b?c//", "http://h//", "x+y.z-1://h/p/", "http://h/a|b", "/only/path", "http://", "h.example/a", "http://h:80",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "u string").withColumn("t", text.url_text(F.col("u")))
    scheme, host, path = (F.try_parse_url("t", F.lit(x)) for x in ("PROTOCOL", "HOST", "PATH"))
    canonical = F.coalesce(F.concat(F.lower(scheme), F.lit("://"), F.lower(host), F.regexp_replace(F.coalesce(path, F.lit("")), "/+$", "")), F.lit(""))
    web = F.coalesce(F.lower(scheme).isin("http", "https") & host.isNotNull(), F.lit(False))
    for r in df.select("u", text.canonical_url(F.col("u")), canonical, text.is_web_url(F.col("u")), web).collect():
        assert r[1] == r[2] and r[3] == r[4], r


def test_components_by_heads(spark):
    draw, rows = random.Random(7), []
    for i in range(400):
        rows.append((i, [f"k{draw.randrange(500)}" for _ in range(draw.choice([1, 1, 1, 2, 3]))]))
    rows += [(1000 + i, [f"c{i}", f"c{i + 1}"]) for i in range(40)] + [(2000 - i, [f"d{i}", f"d{i + 1}", f"d{i + 2}"]) for i in range(40)]
    top = {i: i for i, _ in rows}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    first = {}
    for i, ks in rows:
        for k in ks:
            a, b = find(first.setdefault(k, i)), find(i)
            top[max(a, b)] = min(a, b)
    found = postings.components(spark.createDataFrame(rows, "seq long, keys array<string>"))
    assert {r["id"]: r["component"] for r in found.collect()} == {i: find(i) for i in top}
