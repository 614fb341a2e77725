"""Readers of feeds: line-oriented JSON arrays, delimited text, Markdown watchlists, snapshot folders, payloads."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postloom.functions import text


class FeedError(ValueError):
    """A feed that isn't what it should be; the message names the file's first bad line."""


def json_array_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of a JSON array with an object a line; blank lines, brackets and trailing commas are skipped.

    A line that isn't JSON gives no row, unless the schema has a string column _corrupt_record, which then holds it.
    """
    line = F.regexp_replace(F.trim("value"), r",$", "")
    lines = spark.read.text(path).select(line.alias("line")).where(~F.col("line").isin("", "[", "]"))
    told = "_corrupt_record" in (schema if isinstance(schema, str) else schema.names)
    if not told:
        lines = lines.where(F.try_parse_json("line").isNotNull())
    return lines.select(F.from_json("line", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")


def strict_json_array_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The same of files that must open with [ on the first line, close with ] on the last, and hold an object on every
    other line that isn't blank.

    Files are split as text is. Lines are checked where they are read; only if one is bad, the lines before it are
    counted for its number.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    at, line = F.struct("block", "id"), F.regexp_replace("value", r",$", "")
    # a bracket with its place: the first line may be [, the last that isn't blank ]
    good = (F.col("value") == "") | F.col("value").isin("[", "]") | F.startswith("value", F.lit("{")) & F.try_parse_json(line).isNotNull()
    filled = F.when(F.col("value") != "", at)
    ends = lines.groupBy("file").agg(
        F.min_by("value", at).alias("first"), F.min(at).alias("first_at"), F.max_by("value", filled).alias("last"), F.max(filled).alias("last_at"), F.min(F.when(~good, at)).alias("bad"),
        F.max(F.when(F.col("value") == "[", at)).alias("open_at"), F.min(F.when(F.col("value") == "]", at)).alias("close_at"),
    )
    wrong = (F.col("first") != "[") | (F.col("last") != "]") | F.col("last").isNull()
    stray = F.least(F.col("bad"), F.when(F.col("open_at") > F.col("first_at"), F.col("open_at")), F.when(F.col("close_at") < F.col("last_at"), F.col("close_at")))
    issue = ends.where(wrong | stray.isNotNull()).select("file", wrong.alias("wrong"), stray.alias("stray")).orderBy("file").first()
    if issue is not None or not lines.take(1):
        if issue is None or issue["wrong"] and issue["stray"] is None:
            raise FeedError(f"{path}: an array must open with [ on its first line and close with ] on its last")
        block, number = issue["stray"]
        n = lines.where((F.col("file") == issue["file"]) & ((F.col("block") < block) | (F.col("block") == block) & (F.col("id") <= number))).count()
        raise FeedError(f"{issue['file']}: line {n} isn't a JSON object")
    return lines.where(~F.col("value").isin("", "[", "]")).select(F.from_json(line, schema).alias("r")).select("r.*")


def delimiter(first_line: str) -> str:
    return "\t" if first_line.count("\t") > first_line.count(",") else ","


def unique_headers(headers: list[str]) -> list[str]:
    """Blank headers become ColumnN; repeats, regardless of case and punctuation, get _2, _3, ..."""
    seen: dict[str, int] = {}
    out = []
    for i, h in enumerate(headers):
        name = h.strip() or f"Column{i + 1}"
        key = re.sub(r"[^a-z0-9]", "", name.lower())
        seen[key] = seen.get(key, 0) + 1
        out.append(name if seen[key] == 1 else f"{name}_{seen[key]}")
    return out


def delimited(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text with quotes and line breaks in them; blank records dropped, missing fields empty, all strings.

    Names come from the first file's first record, and every file's first record is its header. Line breaks in quotes
    keep a file from being split: many files are read in parallel, one is not.
    """
    first = spark.read.text(path).first()
    if first is None:
        return spark.createDataFrame([], StructType())
    options = {"sep": delimiter(first[0]), "quote": '"', "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False}
    head = [(v or "").removeprefix("\ufeff") for v in spark.read.options(header=False, **options).csv(path).first()]
    names = unique_headers(head)
    schema = StructType([StructField(n, StringType()) for n in names])
    rows = spark.read.options(header=True, enforceSchema=True, **options).schema(schema).csv(path).na.fill("")
    blank = F.concat_ws("", *[F.trim(F.col(f"`{c}`")) for c in names]) == ""
    return rows.where(~blank)


def count_records(spark: SparkSession, path: str) -> int:
    """Records of delimited text, without headers and blank ones; line breaks in quotes don't count."""
    return delimited(spark, path).count()


def headers(spark: SparkSession, path: str) -> list[str]:
    return delimited(spark, path).columns


def with_columns(df: DataFrame, required: list[str], name: str = "feed") -> DataFrame:
    """df, if it has the columns that a reader needs."""
    if missing := [c for c in required if c not in df.columns]:
        raise FeedError(f"{name} is missing required columns: {', '.join(missing)}")
    return df


def watchlist_markdown(lines: list[str]) -> list[tuple[str, str]]:
    """(category, title) of headings and the bullets under them."""
    out, heading = [], ""
    for line in lines:
        if m := re.match(r"#{1,6}\s+(.+?)\s*$", line):
            heading = m[1].strip()
        elif m := re.match(r"\s*[-*+]\s+(.+?)\s*$", line):
            out.append((heading, m[1].strip()))
    return out


def snapshot_folders(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Parquet below folders named YYYYMMDD-HHmm, with snapshot_id and snapshot_ts of the folder; corrupt files are skipped."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).parquet(path)
    found = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{8}-\d{4})(?=/)", 1)
    rows = rows.withColumn("snapshot_id", found).where("snapshot_id <> ''")
    return rows.withColumn("snapshot_ts", F.try_to_timestamp("snapshot_id", F.lit("yyyyMMdd-HHmm")))


def first_text(*values: Column) -> Column:
    """The first that isn't blank, else empty."""
    return F.coalesce(*[F.nullif(text.clean(v), F.lit("")) for v in values], F.lit(""))


GREENHOUSE = "id string, title string, absolute_url string, location struct<name:string>, content string, first_published string, published_at string, created_at string, updated_at string, departments array<struct<name:string>>"
LEVER = "id string, text string, hostedUrl string, categories struct<location:string, team:string>, descriptionPlain string, additionalPlain string, lists array<struct<text:string, content:string>>, createdAt long"
ASHBY = "id string, title string, location string, secondaryLocations array<struct<location:string>>, publishedAt string, department string, team string, jobUrl string, applyUrl string, descriptionPlain string"


def from_greenhouse(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.select(
        F.lit("greenhouse").alias("ATS"), text.clean(c("id")).alias("RawJobId"), text.clean(c("title")).alias("Title"), text.clean(c("location.name")).alias("Location"), text.strip_html(c("content")).alias("Description"),
        first_text(c("first_published"), c("published_at"), c("created_at"), c("updated_at")).alias("DatePosted"), text.clean(c("absolute_url")).alias("URL"), first_text(F.get("departments", F.lit(0))["name"]).alias("Department"),
    )


def from_lever(rows: DataFrame) -> DataFrame:
    c = F.col
    lists = F.transform(F.coalesce(c("lists"), F.array().cast("array<struct<text:string, content:string>>")), lambda x: F.concat_ws(" ", x["text"], text.strip_html(x["content"])))
    return rows.select(
        F.lit("lever").alias("ATS"), text.clean(c("id")).alias("RawJobId"), text.clean(c("text")).alias("Title"), text.clean(c("categories.location")).alias("Location"),
        text.squeezed(F.concat_ws(" ", c("descriptionPlain"), F.array_join(lists, " "), c("additionalPlain"))).alias("Description"),
        F.coalesce(F.date_format(F.timestamp_millis("createdAt"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit("")).alias("DatePosted"), text.clean(c("hostedUrl")).alias("URL"), text.clean(c("categories.team")).alias("Department"),
    )


def from_ashby(rows: DataFrame) -> DataFrame:
    c = F.col
    more = F.transform(F.coalesce(c("secondaryLocations"), F.array().cast("array<struct<location:string>>")), lambda x: F.coalesce(F.trim(x["location"]), F.lit("")))
    places = F.filter(F.array_distinct(F.concat(F.array(text.clean(c("location"))), more)), lambda x: x != "")
    return rows.select(
        F.lit("ashby").alias("ATS"), text.clean(c("id")).alias("RawJobId"), text.clean(c("title")).alias("Title"), F.array_join(places, " | ").alias("Location"), text.clean(c("descriptionPlain")).alias("Description"),
        text.clean(c("publishedAt")).alias("DatePosted"), first_text(c("jobUrl"), c("applyUrl")).alias("URL"), first_text(c("department"), c("team")).alias("Department"),
    )


PLACE = "struct<city:string, state:string, province:string, region:string, country:string, name:string, label:string>"
WORKDAY = "id string, jobReqId string, title string, jobTitle string, externalPath string, externalUrl string, url string, locationsText string, jobFamily string, department string, jobDescription string, description string, postedOn string, startDate string, updated string, bulletFields array<string>"
BAMBOOHR = f"id string, jobOpeningId string, openingId string, applicationUrl string, jobOpeningUrl string, url string, location {PLACE}, atsLocation {PLACE}, locationName string, locationLabel string, jobOpeningName string, title string, jobTitle string, name string, departmentLabel string, departmentName string, description string, jobDescription string, summary string, postedDate string, datePosted string, createdDate string"
ICIMS = f"id string, jobId string, requisitionId string, reqId string, url string, applyUrl string, externalUrl string, portalUrl string, jobUrl string, title string, jobTitle string, name string, location {PLACE}, locationName string, city string, jobLocation string, departmentName string, category string, description string, jobDescription string, overview string, datePosted string, postedDate string, createdDate string"


def place_text(c: Column) -> Column:
    """The different parts of a place that aren't blank, joined by commas."""
    parts = F.array(*[text.clean(c[f]) for f in ("city", "state", "province", "region", "country", "name", "label")])
    return F.coalesce(F.array_join(F.filter(F.array_distinct(parts), lambda x: x != ""), ", "), F.lit(""))


def extract_jobs(rows: DataFrame, body: str, schema: str) -> DataFrame:
    """The objects of the first array among the payload itself and its members result, jobs, jobOpenings and openings."""
    found = F.when(F.ltrim(F.col(body)).startswith("["), F.col(body))
    for name in ("result", "jobs", "jobOpenings", "openings"):
        own = F.get_json_object(body, f"$.{name}")
        found = F.coalesce(found, F.when(F.ltrim(own).startswith("["), own))
    return rows.select(F.explode(F.from_json(found, f"array<struct<{schema_fields(schema)}>>")).alias("r")).select("r.*")


def schema_fields(ddl: str) -> str:
    """Column definitions as the fields of a struct."""
    return re.sub(r"(^|, )(\w+) (?=[a-z]+(?:[<,]|$))", r"\1\2:", ddl)


def from_workday(rows: DataFrame, board_url: str) -> DataFrame:
    """Postings of a board; links that aren't whole are resolved against the board's."""
    c, board = F.col, board_url.strip().rstrip("/")
    path = first_text(c("externalPath"), c("externalUrl"), c("url"))
    url = F.when(path.startswith("http"), path).when(path == "", board).otherwise(F.concat(F.lit(board), F.when(path.startswith("/"), "").otherwise("/"), path))
    return rows.select(
        F.lit("workday").alias("ATS"), first_text(c("id"), c("jobReqId"), F.get("bulletFields", F.lit(0)), path).alias("RawJobId"), first_text(c("title"), c("jobTitle")).alias("Title"), first_text(c("locationsText")).alias("Location"),
        first_text(c("jobDescription"), c("description"), c("title")).alias("Description"), first_text(c("postedOn"), c("startDate"), c("updated")).alias("DatePosted"), url.alias("URL"), first_text(c("jobFamily"), c("department")).alias("Department"),
    )


def from_bamboohr(rows: DataFrame, board_url: str) -> DataFrame:
    c, board = F.col, re.sub(r"/list/?$", "", board_url.strip())
    own = first_text(c("id"), c("jobOpeningId"), c("openingId"))
    title = first_text(c("jobOpeningName"), c("title"), c("jobTitle"), c("name"))
    return rows.select(
        F.lit("bamboohr").alias("ATS"), own.alias("RawJobId"), title.alias("Title"), first_text(place_text(c("location")), place_text(c("atsLocation")), c("locationName"), c("locationLabel")).alias("Location"),
        first_text(c("description"), c("jobDescription"), c("summary"), title).alias("Description"), first_text(c("postedDate"), c("datePosted"), c("createdDate")).alias("DatePosted"),
        first_text(c("applicationUrl"), c("jobOpeningUrl"), c("url"), F.when(own != "", F.concat(F.lit(f"{board}/"), own))).alias("URL"), first_text(c("departmentLabel"), c("departmentName")).alias("Department"),
    )


def from_icims(rows: DataFrame, board_url: str) -> DataFrame:
    c = F.col
    where = first_text(c("location.name"), c("location.label"), place_text(c("location")), c("locationName"), c("city"), c("jobLocation"))
    return rows.select(
        F.lit("icims").alias("ATS"), first_text(c("id"), c("jobId"), c("requisitionId"), c("reqId")).alias("RawJobId"), first_text(c("title"), c("jobTitle"), c("name")).alias("Title"), where.alias("Location"),
        first_text(c("description"), c("jobDescription"), c("overview")).alias("Description"), first_text(c("datePosted"), c("postedDate"), c("createdDate")).alias("DatePosted"),
        first_text(c("url"), c("applyUrl"), c("externalUrl"), c("portalUrl"), c("jobUrl"), F.lit(board_url)).alias("URL"), first_text(c("departmentName"), c("category")).alias("Department"),
    )


def batch_logs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The logs of all batches below a folder, each row tagged with the folder (BatchName=… or plain) that it lies in."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    return rows.withColumn("BatchName", F.url_decode(F.regexp_replace(folder, "^BatchName=", "")))
