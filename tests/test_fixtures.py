"""Small fixtures with known answers: error classes, freshness, remote changes, feeds, publishing, orders."""

import datetime

import pytest
from pyspark.sql import functions as F


def test_error_classes(spark):
    from postloom.operators.boards import error_class

    rows = [
        ("ashby", 429, None, None, False, "RATE_LIMITED"), ("lever", 503, None, None, False, "UPSTREAM_SERVER_ERROR"), ("lever", 404, None, None, False, "BOARD_NOT_FOUND"), ("workday", 422, None, None, False, "ENDPOINT_REJECTED"),
        ("ashby", 0, "AbortError", "x", False, "TIMEOUT"), ("icims", None, None, "No usable iCIMS fetch URL", False, "NO_USABLE_URL"), ("icims", None, None, None, True, "NO_USABLE_URL"), ("ashby", 403, None, None, False, "ACCESS_BLOCKED"),
        ("ashby", 418, None, None, False, "HTTP_CLIENT_ERROR"), ("ashby", None, None, "Unexpected token <", False, "RESPONSE_PARSE_ERROR"), ("ashby", None, None, "getaddrinfo ENOTFOUND x", False, "NETWORK_ERROR"), ("ashby", None, None, "", None, "UNKNOWN_FETCH_ERROR"),
    ]
    df = spark.createDataFrame(rows, "ats string, status int, name string, message string, skip boolean, want string")
    got = df.select("want", error_class(F.col("status"), F.col("ats"), F.col("name"), F.col("message"), F.col("skip")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_remote_jobs_of_the_united_states(spark):
    from postloom.operators import daily as D

    schema = "Key string, Arrangement string, Location string"
    now = spark.createDataFrame([("a", "Remote", "US"), ("b", "remote", "U.S."), ("c", "Remote", "Canada"), ("d", "Hybrid", "USA"), ("e", "Remote", "Boston, MA")], schema)
    then = spark.createDataFrame([("a", "Remote", "USA"), ("f", "Remote", "US-PA-Remote")], schema)
    assert {r.Key: r.Status for r in D.us_remote_changes(now, then).collect()} == {"a": "continuing", "b": "added", "f": "removed"}


def test_strict_reader_over_many_splits(spark, tmp_path):
    from postloom.sources import feeds

    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = tmp_path / "big.json"
    lines = [f'{{"a": {i}}}' for i in range(3000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        path.write_text("[\n" + ",\n".join(lines) + "\n]\n")
        got = feeds.strict_json_array_lines(spark, str(path), "a int")
        assert got.rdd.getNumPartitions() > 1 and sorted(r.a for r in got.collect()) == list(range(3000))
        for bad, message in (("[\n" + ",\n".join([*lines[:2000], "oops", *lines[2000:]]) + "\n]\n", "line 2002"), ("[\n" + ",\n".join([*lines[:5], "]", *lines[5:]]) + "\n]\n", "line 7"), (",\n".join(lines) + "\n]\n", "open"), ("[\n" + ",\n".join(lines), "close"), ("", "open")):
            path.write_text(bad)
            with pytest.raises(feeds.FeedError, match=message):
                feeds.strict_json_array_lines(spark, str(path), "a int")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_lenient_reader_and_headers(spark, tmp_path):
    from postloom.sources import feeds

    (tmp_path / "a.json").write_text('[\n{"a": 1},\nbroken\n]\n')
    assert [r.a for r in feeds.json_array_lines(spark, str(tmp_path / "a.json"), "a int").collect()] == [1]
    told = feeds.json_array_lines(spark, str(tmp_path / "a.json"), "a int, _corrupt_record string").collect()
    assert sorted((r.a, r._corrupt_record) for r in told if r.a is None) == [(None, "broken")]
    (tmp_path / "t").mkdir()
    for k in "12":
        (tmp_path / "t" / f"{k}.csv").write_text(f'Name,Note\nn{k},"x\ny"\nName,Note\n')
    got = feeds.delimited(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, got.collect())) == [("Name", "Note")] * 2 + [("n1", "x\ny"), ("n2", "x\ny")]  # only headers go
    assert feeds.count_records(spark, str(tmp_path / "t")) == 4 and feeds.headers(spark, str(tmp_path / "t")) == ["Name", "Note"]
    with pytest.raises(feeds.FeedError, match="missing required columns: URL"):
        feeds.with_columns(got, ["Name", "URL"])


def test_failed_versions_stay_unseen(spark, tmp_path):
    from postloom.sources import sinks

    root = str(tmp_path / "out")
    one = spark.createDataFrame([(1,)], "k int")
    sinks.publish(spark, {"t": one}, root)
    for tables, required in (({"t": one.where("false")}, None), ({"t": one}, {"t": ["k", "missing"]}), ({"t": one.select(F.raise_error(F.lit("boom")).cast("int").alias("k"))}, None)):
        with pytest.raises(Exception):  # noqa: B017  the write's own error
            sinks.publish(spark, tables, root, required=required)
        assert sinks.published(spark, root, "t").first().k == 1
    for k in (2, 3, 4):
        sinks.publish(spark, {"t": one.withColumn("k", F.lit(k))}, root)
        assert sinks.published(spark, root, "t").first().k == k
    assert len(list((tmp_path / "out" / "latest").iterdir())) == 2


def test_json_array(spark, tmp_path):
    import json

    from postloom.sources import sinks

    rows = spark.createDataFrame([(i, f"a b{i}") for i in range(50)], "k int, t string").repartition(4)
    sinks.write_json_array(rows, str(tmp_path / "out"))
    data = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("*.txt")))
    assert " " not in data and sorted(r["k"] for r in json.loads(data)) == list(range(50))


def test_numbered_places(spark, tmp_path):
    from postloom.operators.ordering import numbered

    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rows = spark.createDataFrame([(i, i * 7919 % 1000, None if i % 9 == 0 else i % 5) for i in range(1000)], "k int, v int, n int")
    got = {r.k: r.place for r in numbered(rows, [F.col("n").asc_nulls_last(), F.desc("v"), "k"], parts=6).collect()}
    want = sorted(rows.collect(), key=lambda r: (r.n is None, r.n or 0, -r.v, r.k))
    assert [got[r.k] for r in want] == list(range(1, 1001))


def test_merged_state(spark):
    from postloom.operators.coverage import synced_state

    at = lambda d: datetime.datetime(2026, 7, d)
    entries = spark.createDataFrame([("ashby|a", "ashby", "ca", True), ("workday|w1", "workday", "cw", True), ("workday|w2", "workday", "cw", True), ("icims|i", "icims", "ci", False)], "BoardKey string, ATS string, CompanyKey string, FetchEligible boolean")
    previous = spark.createDataFrame([("ashby|a", "ashby", "ca", "FETCH_FAILED", "failed", at(3), 0, 2, at(9)), ("lever|gone", "lever", "cl", "JOBS_FOUND", "success", at(1), 5, 0, at(2))],
                                     "BoardKey string, ATS string, CompanyKey string, CoverageStatus string, LastFetchStatus string, LastAttemptAt timestamp, JobCount long, ConsecutiveFailures long, NextCheckAt timestamp")
    coverage = spark.createDataFrame([(1, "ashby", "ca", "", "JOBS_FOUND", "success", at(2), 4, 0), (2, "workday", "cw", "w1", "GOOD_MATCHES_FOUND", "success", at(5), 7, 1)],
                                     "seq long, ATS string, CompanyKey string, Slug string, CoverageStatus string, LastFetchStatus string, LastChecked timestamp, JobsFound long, GoodMatchesFound long")
    got = {r.BoardKey: r for r in synced_state(entries, previous, coverage).collect()}
    assert got["ashby|a"].CoverageStatus == "FETCH_FAILED" and got["ashby|a"].NextCheckAt == at(9)  # the coverage is older
    assert (got["workday|w1"].CoverageStatus, got["workday|w1"].JobCount, got["workday|w1"].NextCheckAt) == ("GOOD_MATCHES_FOUND", 7, at(6))
    assert got["workday|w2"].CoverageStatus == "NOT_ATTEMPTED"  # sites of one tenant stay apart
    assert got["icims|i"].CoverageStatus == "UNSUPPORTED" and got["icims|i"].NextCheckAt is None
    assert (got["lever|gone"].Active, got["lever|gone"].FetchEligible, got["lever|gone"].NextCheckAt) == (False, False, None)
