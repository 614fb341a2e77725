"""Every query of the library against its SQL, and the operators' own fixtures."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from postloom.functions import text
from postloom.operators import boards, postings
from postloom.plans import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as from '{DIR}/{t}.parquet'")
    return c


def shown(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda r: tuple(map(shown, r))
    assert sorted(map(key, got.select(*want.columns).collect())) == sorted(map(key, want.fetchall()))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_title_categories(spark):
    pairs = {"Senior Technical Writer": "Technical Writing", "Documentation Engineer": "Documentation Engineering", "UX Writer": "Content Design / UX Writing", "Developer Advocate": "Developer Relations", "Director of Documentation": "Management / Leadership", "Knowledge Manager": "Knowledge Management", "Product Manager": "Adjacent Roles", "Chef": "Unknown", "": "Unknown"}
    rows = spark.createDataFrame(list(pairs.items()), "title string, want string").withColumn("got", postings.title_category(F.col("title"))).collect()
    assert all(r.got == r.want for r in rows)


def test_word_boundaries_are_ascii(spark):
    row = spark.createDataFrame([("éremote", "aremote", "a remote-job", "u.s.a")], "a string, b string, c string, d string")
    got = row.select(*[text.matches(F.col(c), r"\bremote\b") for c in "abc"], text.matches(F.col("d"), r"\bu\.s\.\b")).first()
    assert tuple(got) == (True, False, True, True)


def test_urls(spark):
    rows = spark.createDataFrame([("https://Ex.com:443/a/b//?q=1#f",), ("not a url",), (None,), ("HTTP://x.org",)], "u string")
    got = [r[0] for r in rows.select(text.canonical_url(F.col("u"))).collect()]
    assert got == ["https://ex.com/a/b", "", "", "http://x.org"]


def test_components_chain(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rows = [(i, [f"k{i}", f"k{i + 1}"]) for i in range(40)] + [(100, ["x"]), (101, ["x", "y"]), (102, ["z"])]
    got = dict(postings.components(spark.createDataFrame(rows, "seq long, keys array<string>")).collect())
    assert all(got[i] == 0 for i in range(40)) and (got[100], got[101], got[102]) == (100, 100, 102)


def test_backoff(spark):
    rows = spark.createDataFrame([("FETCH_FAILED", 1), ("FETCH_FAILED", 3), ("FETCH_FAILED", 9), ("JOBS_FOUND", 0), ("UNSUPPORTED", 0), ("OTHER", 0)], "s string, f int")
    assert [r[0] for r in rows.select(boards.interval_hours(F.col("s"), F.col("f"))).collect()] == [24, 96, 168, 120, None, 168]


def test_feeds(spark, tmp_path):
    from postloom.sources import feeds

    good = tmp_path / "good.json"
    good.write_text('[\n{"a": 1, "b": "x"},\n\n{"a": 2, "b": "y"}\n]\n')
    for read in (feeds.json_array_lines, feeds.strict_json_array_lines):
        assert sorted(map(tuple, read(spark, str(good), "a int, b string").collect())) == [(1, "x"), (2, "y")]
    bad = tmp_path / "bad.json"
    bad.write_text('[\n{"a": 1},\nnot json\n]\n')
    with pytest.raises(feeds.FeedError, match="line 3"):
        feeds.strict_json_array_lines(spark, str(bad), "a int")
    table = tmp_path / "t.csv"
    table.write_text('Name,name,,Note\n"a, b",c,d,"two\nlines ""q"""\n,,,\nx\n')
    got = feeds.delimited(spark, str(table))
    assert got.columns == ["Name", "name_2", "Column3", "Note"]
    assert sorted(map(tuple, got.collect())) == [("a, b", "c", "d", 'two\nlines "q"'), ("x", "", "", "")]
    assert feeds.watchlist_markdown(["# A", "- one", "* two", "text", "## B", "+ three"]) == [("A", "one"), ("A", "two"), ("B", "three")]
    spark.createDataFrame([(1,)], "k int").write.parquet(str(tmp_path / "s/20260101-0900/jobs"))
    assert [r.snapshot_id for r in feeds.snapshot_folders(spark, str(tmp_path / "s"), "k int").collect()] == ["20260101-0900"]


def test_payloads(spark):
    from postloom.sources import feeds

    rows = spark.createDataFrame([(json.dumps({"id": "7", "title": " Writer ", "location": {"name": "Remote"}, "content": "<p>Hi&nbsp;<b>you</b></p>", "created_at": "2026-01-02", "updated_at": "2026-02-03"}),)], "j string")
    got = feeds.from_greenhouse(rows.select(F.from_json("j", feeds.GREENHOUSE).alias("r")).select("r.*")).first()
    assert (got.Title, got.Description, got.DatePosted) == ("Writer", "Hi you", "2026-01-02")
    rows = spark.createDataFrame([(json.dumps({"id": "1", "text": "T", "createdAt": 0, "descriptionPlain": "a", "lists": [{"text": "b", "content": "<li>c</li>"}], "additionalPlain": "d"}),)], "j string")
    got = feeds.from_lever(rows.select(F.from_json("j", feeds.LEVER).alias("r")).select("r.*")).first()
    assert (got.Description, got.DatePosted) == ("a b c d", "1970-01-01T00:00:00.000Z")
    rows = spark.createDataFrame([(json.dumps({"id": "1", "title": "T", "location": "X", "secondaryLocations": [{"location": "Y"}, {"location": "X"}], "team": "docs"}),)], "j string")
    got = feeds.from_ashby(rows.select(F.from_json("j", feeds.ASHBY).alias("r")).select("r.*")).first()
    assert (got.Location, got.Department) == ("X | Y", "docs")


def test_publishing(spark, tmp_path):
    from postloom.sources import sinks

    root = str(tmp_path / "out")
    one = spark.createDataFrame([(1, True, ["a", "b"])], "k int, b boolean, l array<string>")
    first = sinks.publish(spark, {"t": one}, root)
    with pytest.raises(ValueError):
        sinks.publish(spark, {"t": one.where("false")}, root)
    assert sinks.published(spark, root, "t").first().k == 1 and first
    sinks.publish(spark, {"t": one.withColumn("k", F.lit(2))}, root)
    assert sinks.published(spark, root, "t").first().k == 2
    assert tuple(sinks.as_text(one).first()) == ("1", "TRUE", "a | b")
    sinks.write_delimited(one, str(tmp_path / "csv"))
    assert "1,TRUE,a | b" in "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*.csv"))


def test_stream_equals_batch(spark, tmp_path):
    from postloom.plans.boards import fetches
    from postloom.streaming import board_state as stream

    log = fetches(spark, DIR)
    ordered = log.orderBy("FetchedAt", "seq").collect()
    schema = log.schema
    for i in range(4):  # four files in order of time, one a batch
        part = ordered[i * len(ordered) // 4 : (i + 1) * len(ordered) // 4]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream.follow(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    got = stream.as_board_state(stream.read_state(spark, str(tmp_path / "state"), 3))
    want = boards.board_state(log).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
