"""Catalogues, running summaries, streams, refreshes, cards, dates, addresses and packages on small fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F


@pytest.fixture
def checkpoints(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))


def test_entries_of_every_form(spark):
    from postloom.operators import catalogs

    entries = ['" acme "', '{"id":7,"name":" Acme Inc ","url":"https://x.example.com"}', '{"slug":null,"company":"","careersUrl":" https://c.example.com "}', "[1,\"a\"]", "5", "null", "{broken", "", None, '{"slug":"a b/ü"}']
    rows = spark.createDataFrame(list(enumerate(entries)), "k int, Entry string").withColumn("ATS", F.lit("lever"))
    got = {r.k: (r.CatalogSlug, r.CatalogCompany, r.CatalogValue, r.BoardURL) for r in catalogs.catalog_entries(rows).collect()}
    assert got[0] == ("acme", "", "acme", "https://jobs.lever.co/acme") and got[1] == ("7", "Acme Inc", "Acme Inc", "https://x.example.com") and got[2] == ("", "", "https://c.example.com", "https://c.example.com")
    assert got[3] == ("", "", '[1,"a"]', "") and got[4] == ("", "", "5", "") and got[6] == got[7] == got[8] == ("", "", "", "") and got[9][3] == "https://jobs.lever.co/a%20b%2F%C3%BC"


def test_nested_text(spark):
    from postloom.operators import catalogs

    values = ['{"a":{"b":"x "}}', '{"a":{"b":{"title":"T","value":" V "}}}', '{"a":{"b":[{"name":"N"},"s",null,{"q":1}]}}', '{"a":{"b":3}}', '{"a":{}}', '{"a":{"b":[]}}']
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, j string")
    assert [r.p for r in rows.select(catalogs.nested_text(F.parse_json("j"), "$.a.b").alias("p"), "k").orderBy("k").collect()] == ["x", "V", "N | s", "3", "", ""]


def test_totals_scan_once(spark):
    from postloom.operators import boards, catalogs

    rows = spark.createDataFrame([("ashby", "A", "c1", ""), ("ashby", "a", "c1", "http://x.example"), ("lever", "b", "", "no url"), ("", "", "c2", "")], "ATS string, Slug string, CompanyKey string, BoardURL string")
    found = catalogs.catalog_totals(rows, boards.malformed_reason())
    assert str(found._jdf.queryExecution().optimizedPlan()).count("Expand") == 1 and str(found._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") == 1
    r = found.first()
    assert (r.TotalRows, r.UniqueATS, r.UniqueCatalogValues, r.UniqueCompanyKeys, r.RowsWithBoardURL, r.MalformedRows, r.DuplicateCatalogValueGroups, r.CompanyKeyOverlapGroups) == (4, 3, 2, 2, 2, 2, 1, 0)
    assert r.Counts == {"ashbyCount": 2, "leverCount": 1, "Count": 1}
    assert catalogs.catalog_totals(rows.where("false"), boards.malformed_reason()).first().TotalRows == 0


def test_running_summary_counts_a_replayed_batch_once(spark, tmp_path):
    from postloom.operators.counters import RunningSummary

    rows = spark.createDataFrame([(i % 4, f"g{i % 3}", f"c{i % 7}", i) for i in range(200)], "batch int, g string, c string, x int")
    state = RunningSummary(spark, str(tmp_path), "g", {"n": F.lit(True), "big": F.col("x") > 100}, {"cs": F.col("c"), "xs": F.col("x")})
    for b in (0, 1, 2, 1, 3, 3, 0):
        state.add(rows.where(F.col("batch") == b), b)
    want = rows.groupBy("g").agg(F.count("*").alias("n"), F.count_if(F.col("x") > 100).alias("big"), F.count_distinct("c").alias("cs"), F.count_distinct("x").alias("xs"))
    assert sorted(map(tuple, state.summary().collect())) == sorted(map(tuple, want.collect()))
    new = spark.read.parquet(str(tmp_path / "keys")).where("kind = 'cs' and batch = 3").count()
    assert new == 0  # batch 3 brings no key that others don't have


def test_superseding_stream_replays_and_compacts(spark, tmp_path, monkeypatch):
    from postloom.operators import boards
    from postloom.streaming import superseding

    monkeypatch.setattr(superseding, "COMPACT", 3)
    at = lambda m: datetime.datetime(2026, 7, 1, 0, m)
    log = [(i, "ashby", f"s{i % 5}" if i % 11 else "", at(i * 7 % 60), ["success", "empty", "failed", "skipped"][i % 4], f"b{i % 6}") for i in range(80)]
    schema = "seq long, ATS string, CatalogSlug string, FetchedAt timestamp, Status string, SourceBatch string"
    rows = spark.createDataFrame(log, schema)
    state = superseding.Newest(spark, str(tmp_path / "newest"))
    for k in range(8):
        spark.createDataFrame(log[k * 10 : k * 10 + 10], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        superseding.follow(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "newest"), str(tmp_path / "checkpoint")).awaitTermination()
    assert state.numbers("base") and len(state.numbers("changes")) < 3
    before = sorted(map(str, state.read().collect()))
    assert not state.take(state.read().where("false"), state.committed()) and sorted(map(str, state.read().collect())) == before
    key = lambda r: (r.seq, r.keep)
    got = sorted(map(key, boards.superseded(rows, state.read()).collect()))
    assert got == sorted(map(key, boards.superseded(rows, boards.latest_live(rows)).collect()))
    newest = {}
    for seq, ats, slug, t, status, batch in sorted(log, key=lambda r: (r[3], r[0])):
        if slug and status in ("success", "empty"):
            newest[slug] = (t, status, batch)
    for seq, ats, slug, t, status, batch in log:
        n = newest.get(slug)
        assert dict(got)[seq] == (n is None or (t > n[0] if n[1] == "empty" else batch == n[2]))


def test_refresh_guards_what_is_in_use(spark, tmp_path):
    from postloom.operators import catalogs

    root = str(tmp_path)
    rows = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(5)], "ATS string, k int")
    first = {r.ATS: r for r in catalogs.refresh(rows, ["a", "b", "c"], root).collect()}
    assert (first["a"].Status, first["b"].RowCount, first["c"].Status, first["c"].Usable) == ("updated", 5, "failed", False)
    second = {r.ATS: r for r in catalogs.refresh(rows.where("ATS = 'a' and k < 7 or ATS = 'b'"), ["a", "b"], root).collect()}
    assert (second["a"].Status, second["a"].RowCount, second["b"].Status) == ("fallback", 10, "unchanged") and "from 10 to 7" in second["a"].Error
    assert catalogs.refreshed(spark, root, rows.schema).where("ATS = 'a'").count() == 10
    assert catalogs.refresh_summary(catalogs.last_manifest(spark, root)[0]).first().RefreshStatus == "partial"
    with pytest.raises(Exception):  # noqa: B017  a refresh that dies changes nothing
        catalogs.refresh(rows.withColumn("k", F.raise_error(F.lit("broken"))), ["a", "b"], root).collect()
    assert catalogs.last_manifest(spark, root)[1] == 2 and catalogs.refreshed(spark, root, rows.schema).count() == 15
    third = {r.ATS: r for r in catalogs.refresh(rows.where("k < 8"), ["a", "b"], root).collect()}
    assert (third["a"].Status, third["a"].RowCount) == ("updated", 8)


def test_cards_and_pages(spark):
    from postloom.operators import catalogs

    card = lambda i, t, e="": f'<LI class="x iCIMS_JobCardItem"><div class="header left"><span>A</span><span>US-{i}</span></div><a href="https://c.example.com/jobs/{i}/t/job?in_iframe=1&x=2{e}"><h3>\n {t} &amp; b</h3></a><div class="description">d<br>e</div></li>'
    pages = [("p", 0, card(1, "One") + card(2, "Two")), ("p", 1, card(2, "Two") + card(3, "Three")), ("p", 2, card(1, "One")), ("p", 3, card(9, "Late")), ("q", 0, "<li>no card</li>"), ("q", 1, None), ("r", 25, card(1, "x"))]
    found = catalogs.cards(spark.createDataFrame(pages, "Board string, Page int, Html string"))
    got = sorted((r.Board, r.CardId, r.Page, r.Title, r.URL, r.Location, r.Description) for r in catalogs.new_cards(found).collect())
    assert [g[1:3] for g in got] == [("1", 0), ("2", 0), ("3", 1)]
    assert got[0][3:] == ("One & b", "https://c.example.com/jobs/1/t/job?x=2", "US-1", "d e")


def test_dates(spark):
    from postloom.functions import dates

    want = {
        "20260715-1230": "2026-07-15 12:30:00", "2026-07-15": "2026-07-15 00:00:00", "2026-02-31": "2026-03-03 00:00:00", "2026-13-01": "2027-01-01 00:00:00", "2026-07-15 12:30 UTC": "2026-07-15 12:30:00", " 7/5/26 ": "2026-07-05 00:00:00",
        "12/31/2025": "2025-12-31 00:00:00", "2026-07-15T12:30:00Z": "2026-07-15 12:30:00", "2026-07-15T12:30:00.250+02:00": "2026-07-15 10:30:00", "2026-07-15T12:30:00-0530": "2026-07-15 18:00:00", "Wed, 15 Jul 2026 12:30:05 GMT": "2026-07-15 12:30:05",
        "July 5, 2026": "2026-07-05 00:00:00", "Sept 5, 2026 7:08": "2026-09-05 07:08:00", "5 march 2026": "2026-03-05 00:00:00", "Sunday, 5 Apr 2026": "2026-04-05 00:00:00", "soon": None, "": None, None: None, "15.07.2026": None, "2026-7-5": None,
    }
    rows = spark.createDataFrame([(k,) for k in want], "t string").select("t", F.date_format(dates.coerce_date(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("d"), dates.shown_date(F.col("t")).alias("s"))
    assert {r.t: r.d for r in rows.collect()} == want and {r.t: r.s for r in rows.collect()}["soon"] == ""
    row = spark.range(1).select(dates.age_days(F.lit("2026-07-01"), F.lit("2026-07-15").cast("date")).alias("a"), dates.age_days(F.lit("2027-01-01"), F.lit("2026-07-15").cast("date")).alias("b"), dates.shown_range(F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp")).alias("c")).first()
    assert tuple(row) == (14, 0, "")


def test_slugs_and_failed_links(spark):
    from postloom.operators import urls

    cases = [
        ("ashby", "https://jobs.ashbyhq.com/acme/1", "acme"), ("greenhouse", "https://boards-api.greenhouse.io/v1/boards/acme/jobs", "acme"), ("greenhouse", "https://job-boards.greenhouse.io/acme", "acme"), ("lever", "https://jobs.lever.co/", ""), ("bamboohr", "https://ac-me.bamboohr.com/x", "ac-me"),
        ("bamboohr", "https://bamboohr.com/x", ""), ("icims", "https://Careers-acme.icims.com/jobs", "acme"), ("workday", "https://acme.wd5.myworkdayjobs.com/en/Site", "acme|wd5|en"), ("workday", "https://x.wd1.myworkdayjobs.com/wday/cxs/t/Site/jobs", "t|wd1|Site"), ("workday", "https://x.example.com/a", ""), ("ashby", "no url", ""), ("ashby", None, ""),
    ]
    rows = spark.createDataFrame(cases, "ats string, url string, want string")
    assert all(r.got == r.want for r in rows.select("want", urls.slug_from_url(F.col("ats"), F.col("url")).alias("got")).collect())
    checks = [("Yes", "OK", "", True, True), ("No", "Missing URL", None, False, False), ("No", "Bad", "HTTP 404 Not Found", False, False), ("No", "Bad", "HTTP 503", True, False), ("No", "Bad", "Greenhouse job URL redirected to board", False, False), ("No", "Review", "HTTP 404", True, False), ("No", None, None, True, False)]
    rows = spark.createDataFrame(checks, "ok string, status string, issue string, safe boolean, whole boolean")
    for r in rows.select("*", urls.kept_after_check(F.col("ok"), F.col("status"), F.col("issue"), True).alias("a"), urls.kept_after_check(F.col("ok"), F.col("status"), F.col("issue"), False).alias("b")).collect():
        assert (r.a, r.b) == (r.safe, r.whole), r
    names = spark.createDataFrame([("acme_LABS 3d-print | US",), ("  ",), (None,)], "n string")
    assert [r[0] for r in names.select(urls.shown_company(F.col("n"))).collect()] == ["Acme Labs 3d Print", "", ""]


def test_packages(spark, tmp_path):
    from postloom.sources import packages

    table = spark.createDataFrame([(1, 'a "q",\nb', 0.5, True, ["x", "y"]), (2, None, 3.0, False, [])], "k int, s string, ScorePercent double, b boolean, l array<string>")
    outputs = [packages.Output("all", "Everything", lambda t: t), packages.Output("lines", "As lines", lambda t: t, "json"), packages.Output("late", "Never made", lambda t: t, "json")]
    got = {r.Name: r for r in packages.write_package(table, outputs[:2], str(tmp_path)).collect()}
    assert got["all"].Rows == 2 and got["lines"].Rows == 2 and got["all"].Exists and got["all"].SizeBytes > 0
    assert [r.Name for r in packages.missing(packages.manifest(spark, outputs, str(tmp_path))).collect()] == ["late"]
    assert {tuple(r) for r in packages.shown(table).collect()} == {("1", 'a "q",\nb', "0.50%", "Yes", "x | y"), ("2", "", "3.00%", "No", "")}


def test_groups_with_most_rows_are_ranked_in_many_tasks(spark, checkpoints):
    from postloom.operators.ordering import numbered, ranked_within

    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("g"), "id")
    got = ranked_within(rows, ["g"], [F.desc("id")], ["g", "id"]).collect()
    want = {}
    for g, i in sorted(((r.g, r.id) for r in got), key=lambda x: (x[0], -x[1])):
        want.setdefault(g, []).append(i)
    assert all(want[r.g][r.rank - 1] == r.id and r.size == len(want[r.g]) for r in got)
    parts = numbered(rows, ["g", F.desc("id")], 8)
    assert parts.count() == 3000
    largest = rows.repartitionByRange(8, "g", F.desc("id")).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 700  # the hot third lies in several


def test_title_families_bound_their_lists(spark):
    from postloom.operators import catalogs

    rows = [("Acme", f"Content Writer - Q{i:03d} - Remote", f"P{i % 30:02d}", f"l{i}") for i in range(200)] + [("Acme", "SEO Writer - A - Remote", "x", "y"), ("Acme", "SEO Writer - B - Remote", "x", "y"), ("B", "X - y - Remote", "", ""), (None, None, None, None)]
    got = catalogs.title_families(spark.createDataFrame(rows, "Company string, Title string, Location string, Link string")).collect()
    assert len(got) == 1 and (got[0].Listings, got[0].Titles, got[0].Places) == (200, 200, 30) and got[0].Locations == " | ".join(f"P{i:02d}" for i in range(10))


def test_freshness_of_boards_without_a_provider(spark):
    from postloom.operators import boards

    rows = spark.createDataFrame([(None, "FETCH_FAILED"), ("ashby", "JOBS_FOUND")], "ATS string, CoverageStatus string").withColumns({"LastAttemptAt": F.lit("2026-07-01 00:00:00").cast("timestamp"), "NextCheckAt": F.lit("2026-07-02 00:00:00").cast("timestamp")})
    got = {r.ATS: r.ActiveBoards for r in boards.freshness(rows, F.lit("2026-07-03 00:00:00")).collect()}
    assert got == {None: 1, "ashby": 1, "all": 2}
