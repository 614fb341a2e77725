"""Catalogues of boards: entries of mixed form, totals in one pass, folders of files, guarded refreshes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postloom.functions import fixed, text
from postloom.functions.folders import stored
from postloom.operators.ordering import first_values

# ---- entries of mixed form


def present(entry: Column, keys: list[str]) -> Column:
    """The first of an object's keys whose value isn't blank, as trimmed text; else empty."""
    found = [F.nullif(text.clean(F.try_variant_get(entry, f"$.{k}", "string")), F.lit("")) for k in keys]
    return F.coalesce(*found, F.lit(""))


def shape(entry: Column) -> Column:
    """object, array, string or other, by the schema of a variant."""
    kind = F.schema_of_variant(entry)
    return F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").otherwise("other")


def board_url(ats: Column, slug: Column, source: Column) -> Column:
    made = F.lit("")
    for name, address in fixed.BOARD_URLS.items():
        made = F.when(F.lower(ats) == name, F.concat(F.lit(address), F.replace(F.url_encode(slug), F.lit("+"), F.lit("%20")))).otherwise(made)
    return F.when(source != "", source).when(slug == "", "").otherwise(made)


def catalog_entries(rows: DataFrame, entry: str = "Entry", ats: str = "ATS") -> DataFrame:
    """CatalogSlug, CatalogCompany, CatalogValue and BoardURL of entries that are JSON text of any form.

    A string is the slug; an object names it; anything else is kept as its JSON. Text that isn't JSON gives empty columns.
    """
    v = F.col("_entry")
    df = rows.withColumn("_entry", F.try_parse_json(F.col(entry))).withColumn("_shape", shape(v))
    plain = text.clean(F.try_variant_get(v, "$", "string"))
    by_shape = lambda string, other, object_: F.when(F.col("_shape") == "string", string).when(F.col("_shape") == "object", object_).otherwise(F.coalesce(other, F.lit("")))
    nothing = F.lit("")
    df = df.withColumns({
        "CatalogSlug": by_shape(plain, nothing, present(v, ["slug", "id"])),
        "CatalogCompany": by_shape(nothing, nothing, present(v, ["company", "name"])),
        "CatalogValue": by_shape(plain, F.to_json(v), present(v, fixed.ENTRY_VALUES)),
        "_url": by_shape(nothing, nothing, present(v, fixed.ENTRY_URLS)),
    })
    return df.withColumn("BoardURL", board_url(F.col(ats), F.col("CatalogSlug"), F.col("_url"))).drop("_entry", "_shape", "_url")


def nested_text(entry: Column, path: str) -> Column:
    """Text at a path of a variant: a scalar's own, an object's name, label, value or title, an array's items joined."""
    names = ["name", "label", "value", "title"]
    item = lambda x: F.when(shape(x) == "object", present(x, names)).otherwise(text.clean(F.try_variant_get(x, "$", "string")))
    value, many = F.try_variant_get(entry, path, "variant"), F.try_variant_get(entry, path, "array<variant>")
    return F.coalesce(F.when(shape(value) == "array", F.array_join(F.filter(F.transform(many, item), lambda x: x != ""), " | ")).otherwise(item(value)), F.lit(""))


# ---- totals in one pass

def catalog_totals(catalog: DataFrame, malformed: Column) -> DataFrame:
    """A row of counts over all entries and of groups among them, from one scan: grouping sets, then sums of their rows."""
    rows = catalog.select("ATS", text.clean(F.lower("Slug")).alias("Value"), "CompanyKey", (text.clean(F.col("BoardURL")) != "").alias("linked"), (malformed != "").alias("bad"))
    sets = rows.groupingSets([[], [F.col("ATS")], [F.col("Value")], [F.col("CompanyKey")]], "ATS", "Value", "CompanyKey").agg(
        F.grouping_id().alias("g"), F.count("*").alias("n"), F.count_if("linked").alias("linked"), F.count_if("bad").alias("bad"),
        (F.min("ATS") != F.max("ATS")).alias("many_ats"), F.coalesce(F.min(F.nullif("Value", F.lit(""))) != F.max("Value"), F.lit(False)).alias("many_values"),
    )
    # the bits of g say what is summed over: ATS 4, Value 2, CompanyKey 1
    whole, by_ats, by_value, by_key = (F.col("g") == g for g in (7, 3, 5, 6))
    value, key = by_value & (F.col("Value") != ""), by_key & (F.col("CompanyKey") != "")
    of_all = lambda c: F.coalesce(F.max(F.when(whole, F.col(c))), F.lit(0))
    counts = F.array_sort(F.collect_list(F.when(by_ats, F.struct(F.concat("ATS", F.lit("Count")).alias("key"), F.col("n").alias("value")))))
    return sets.agg(
        of_all("n").alias("TotalRows"), F.count_if(by_ats).alias("UniqueATS"), F.count_if(value).alias("UniqueCatalogValues"), F.count_if(key).alias("UniqueCompanyKeys"), of_all("linked").alias("RowsWithBoardURL"),
        (of_all("n") - of_all("linked")).alias("RowsWithoutBoardURL"), of_all("bad").alias("MalformedRows"), F.count_if(value & (F.col("n") > 1)).alias("DuplicateCatalogValueGroups"),
        F.count_if(key & (F.col("many_ats") | F.col("many_values"))).alias("CompanyKeyOverlapGroups"), F.map_from_entries(counts).alias("Counts"),
    )


def category_totals(rows: DataFrame, category: str, distinct: str) -> DataFrame:
    """TotalTitles, UniqueTitles and a key `<Category>Count` for each category that occurs, as a map; one scan."""
    sets = rows.groupingSets([[], [F.col(category)], [F.col(distinct)]], category, distinct).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    counts = F.array_sort(F.collect_list(F.when(F.col("g") == 1, F.struct(F.concat(F.coalesce(F.col(category), F.lit("")), F.lit("Count")).alias("key"), F.col("n").alias("value")))))
    return sets.agg(F.coalesce(F.max(F.when(F.col("g") == 3, F.col("n"))), F.lit(0)).alias("TotalTitles"), F.count_if(F.col("g") == 2).alias("UniqueTitles"), F.map_from_entries(counts).alias("Counts"))


# ---- folders of files

def largest_folders(files: DataFrame, shallow: int = 2, deep: int = 5, most: int = 20) -> DataFrame:
    """Path, Files and SizeBytes of the largest folders: each file counts for all its prefixes between the depths. The length is the feature."""
    parts = F.split("Path", "/")
    upto = F.least(F.size(parts) - 1, F.lit(deep))
    rows = files.where(upto >= shallow).select("SizeBytes", F.explode(F.transform(F.sequence(F.lit(shallow), upto), lambda d: F.array_join(F.slice(parts, F.lit(1), d), "/"))).alias("Folder"))
    return rows.groupBy("Folder").agg(F.count("*").alias("Files"), F.sum("SizeBytes").alias("SizeBytes")).orderBy(F.desc("SizeBytes"), "Folder").limit(most)


def file_totals(files: DataFrame, category: Column) -> DataFrame:
    """Files and bytes of each category and (`all`) of all, from one scan."""
    rows = files.select(category.alias("Category"), "SizeBytes").rollup("Category").agg(F.grouping("Category").alias("g"), F.count("*").alias("Files"), F.sum("SizeBytes").alias("SizeBytes"), F.max("SizeBytes").alias("LargestBytes"))
    return rows.select(F.when(F.col("g") == 1, "all").otherwise(F.col("Category")).alias("Category"), "Files", F.coalesce("SizeBytes", F.lit(0)).alias("SizeBytes"), F.coalesce("LargestBytes", F.lit(0)).alias("LargestBytes"))


# ---- guarded refreshes

MANIFEST = "ATS string, Status string, Usable boolean, RowCount long, PreviousRowCount long, Digest string, Version long, Error string"


def content(rows: DataFrame, by: str) -> DataFrame:
    """RowCount and Digest of each source's rows, in whatever order they come."""
    own = [F.col(f"`{c}`") for c in rows.columns]
    sums = [F.sum(F.xxhash64(F.lit(seed), *own).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    return rows.groupBy(F.col(by).alias("ATS")).agg(F.count("*").alias("RowCount"), F.sha2(F.concat_ws(",", F.count("*").cast("string"), *sums), 256).alias("Digest"))


def last_manifest(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """What the last refresh left below root, and its number; 0 if there was none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifests")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    # only whole ones count: Spark marks them when it commits
    done = [int(s.getPath().getName()) for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifests/{s.getPath().getName()}/_SUCCESS"))] if fs.exists(path) else []
    number = max(done, default=0)
    return (spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{number}") if number else spark.createDataFrame([], MANIFEST)), number


def refresh(rows: DataFrame, sources: list[str], root: str, by: str = "ATS", most_dropped: float = 0.2, allow_large_drop: bool = False) -> DataFrame:
    """Takes a new version of the sources' rows unless it lost too many: then the last good version stays in use.

    The rows are written once. Each source is `updated`, `unchanged` (same content), `fallback` (fewer rows than
    floor(previous * (1 - most_dropped)), or none, where there was a version) or `failed` (never any row). The manifest names
    the version in use; it is written last, so that a refresh that dies changes nothing.
    """
    spark = rows.sparkSession
    before, number = last_manifest(spark, root)
    number += 1
    rows.where(F.col(by).isin(sources)).withColumn("source", F.col(by)).write.mode("overwrite").partitionBy("source").parquet(f"{root}/rows/{number}")
    written = spark.read.schema(_with_source(rows.schema)).parquet(f"{root}/rows/{number}")
    now = content(written.drop("source"), by)
    named = spark.createDataFrame([(s,) for s in sources], "ATS string")
    had = F.coalesce("p.RowCount", F.lit(0))
    got = F.coalesce("n.RowCount", F.lit(0))
    least = F.floor(had * F.lit(1 - most_dropped))
    lost = (got == 0) | (F.lit(not allow_large_drop) & (had > 0) & (got < least))
    error = F.when(got == 0, "no rows").when(lost, F.format_string("row count fell from %d to %d", had, got)).otherwise("")
    both = named.join(now.alias("n"), "ATS", "left").join(before.alias("p"), "ATS", "left")
    status = F.when(lost & (had > 0), "fallback").when(lost, "failed").when(F.col("n.Digest") == F.coalesce("p.Digest", F.lit("")), "unchanged").otherwise("updated")
    kept = lambda new, old: F.when(lost, old).otherwise(new)
    manifest = both.select(
        "ATS", status.alias("Status"), (~lost | (had > 0)).alias("Usable"), kept(got, had).alias("RowCount"), had.alias("PreviousRowCount"), kept(F.col("n.Digest"), F.col("p.Digest")).alias("Digest"),
        kept(F.lit(number).cast("long"), F.col("p.Version")).alias("Version"), error.alias("Error"),
    )
    manifest.write.mode("overwrite").parquet(f"{root}/manifests/{number}")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{number}")


def _with_source(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("source", StringType())])


def refreshed(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows in use: of each source those of the version that the last manifest names."""
    manifest, _ = last_manifest(spark, root)
    versions = [r.Version for r in manifest.where("Version is not null").select("Version").distinct().collect()]  # a line a version in use
    found = spark.createDataFrame([], schema)
    for v in versions:
        own = manifest.where(F.col("Version") == v).select("ATS")
        rows = spark.read.schema(_with_source(schema)).parquet(f"{root}/rows/{v}")
        found = found.unionByName(rows.join(F.broadcast(own), rows["source"] == own["ATS"], "left_semi").drop("source"))
    return found


def refresh_summary(manifest: DataFrame) -> DataFrame:
    """RefreshStatus and the counts of a manifest."""
    of = lambda s: F.count_if(F.col("Status") == s)
    unusable = F.count_if(~F.col("Usable"))
    status = F.when(unusable > 0, "failed").when(of("fallback") > 0, "partial").otherwise("complete")
    return manifest.agg(status.alias("RefreshStatus"), F.count("*").alias("SourceCount"), of("updated").alias("UpdatedSourceCount"), of("fallback").alias("FallbackSourceCount"), unusable.alias("UnusableSourceCount"), F.coalesce(F.sum("RowCount"), F.lit(0)).alias("TotalRows"))


# ---- cards of search pages

def cards(pages: DataFrame, html: str = "Html") -> DataFrame:
    """The cards of search pages, exploded: CardId, Title, URL, Location and Description from aligned matches."""
    card = F.explode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r'(?i)<li[^>]*class="[^"]*iCIMS_JobCardItem[^"]*"[^>]*>[\s\S]*?</li>'), F.lit(0)))
    first = lambda p, g=1: F.regexp_extract("card", p, g)
    link = r'(?i)<a[^>]+href="([^"]*/jobs/(\d+)/[^"]+)"[^>]*>[\s\S]*?<h3[^>]*>([\s\S]*?)</h3>'
    spans = F.regexp_extract_all(first(r'(?i)class="[^"]*header left[^"]*"[^>]*>([\s\S]*?)</div>'), F.lit(r"(?i)<span[^>]*>([\s\S]*?)</span>"), F.lit(1))
    places = F.filter(F.transform(spans, text.strip_html), lambda x: x != "")
    url = F.regexp_replace(F.regexp_replace(text.strip_html(first(link, 1)), r"([?&])in_iframe=1(&|$)", "$1"), "[?&]$", "")
    rows = pages.drop(html).withColumn("_", F.lit(0)).columns[:-1]
    found = pages.select(*rows, card.alias("card")).withColumn("CardId", first(link, 2)).where("CardId <> ''")
    return found.select(*rows, "CardId", text.strip_html(first(link, 3)).alias("Title"), url.alias("URL"), F.coalesce(F.try_element_at(places, F.lit(-1)), F.lit("")).alias("Location"), text.strip_html(first(r'(?i)class="[^"]*description[^"]*"[^>]*>([\s\S]*?)</div>')).alias("Description"))


def new_cards(found: DataFrame, board: str = "Board", page: str = "Page", most_pages: int = 20) -> DataFrame:
    """Each card of a board once, from its first page; the pages end before the first that brings no new card, or at most_pages."""
    firsts = found.groupBy(board, "CardId").agg(F.min_by(F.struct(*[c for c in found.columns if c not in (board, "CardId")]), F.col(page)).alias("r")).select(board, "CardId", "r.*")
    pages = found.select(board, page).distinct().join(firsts.groupBy(board, page).agg(F.count("*").alias("fresh")), [board, page], "left")
    last = pages.groupBy(board).agg(F.min(F.when(F.col("fresh").isNull(), F.col(page))).alias("stop"))
    return firsts.join(last, board).where((F.col("stop").isNull() | (F.col(page) < F.col("stop"))) & (F.col(page) < most_pages)).drop("stop")


# ---- families of titles

def title_families(rows: DataFrame, most: int = 10) -> DataFrame:
    """Company and family of titles `X - qualifier - Remote` with several titles, to be reviewed; lists hold the first `most` values of all counted."""
    pattern = r"(?i)^(.+?)\s+-\s+[^-]+\s+-\s+(remote)$"
    title = text.clean(F.col("Title"))
    plain = lambda c: F.lower(text.squeezed(text.clean(c)))
    calm = rows.where(~F.lower(title).rlike(r"\b(" + "|".join(fixed.TITLE_NOISE) + r")\b")).where(title.rlike(pattern))
    family = F.concat(plain(F.regexp_extract(title, pattern, 1)), F.lit(" - [qualifier] - remote"))
    keyed = calm.select(plain(F.col("Company")).alias("CompanyKey"), family.alias("TitleFamily"), title.alias("Title"), text.clean(F.col("Location")).alias("Location"), text.clean(F.col("Link")).alias("Link"))
    keyed = stored(keyed, "families")  # the counts and each list read it
    keys = ["CompanyKey", "TitleFamily"]
    out = keyed.groupBy(*keys).agg(F.count("*").alias("Listings"), F.count_distinct("Title").alias("Titles"), F.count_distinct(F.nullif("Location", F.lit(""))).alias("Places"))
    out = out.where("Listings > 1 and Titles > 1")
    for column, name in (("Title", "DistinctTitles"), ("Location", "Locations"), ("Link", "ApplyLinks")):
        lists = first_values(keyed, keys, column, name, most)
        out = out.join(lists, keys, "left").na.fill("", [name])
    return out


# ---- batches to take over, and names shown

def inspected(files: DataFrame, required: list[str], existing: DataFrame) -> DataFrame:
    """files (BatchName, File) as BatchName, Status and Issue: READY if all required files are there and no batch of that name exists, else SKIP."""
    own = files.groupBy("BatchName").agg(*[F.max(F.col("File") == f).alias(f"_{i}") for i, f in enumerate(required)])
    missing = F.filter(F.array(*[F.when(~F.col(f"_{i}"), F.lit(f)) for i, f in enumerate(required)]), lambda x: x.isNotNull())
    done = existing.select("BatchName").distinct().withColumn("_done", F.lit(True))
    rows = own.select("BatchName", missing.alias("_missing")).join(done, "BatchName", "left")
    issue = F.when(F.size("_missing") > 0, F.concat(F.lit("missing required files: "), F.array_join("_missing", ", "))).when(F.col("_done"), "target batch folder already exists").otherwise("")
    return rows.select("BatchName", F.when(issue == "", "READY").otherwise("SKIP").alias("Status"), issue.alias("Issue"))


#: Aliases that are broadcast at most; beyond it the join shuffles.
BROADCAST_ALIASES = 200_000


def displayed(rows: DataFrame, aliases: DataFrame, company: str = "Company") -> DataFrame:
    """rows with DisplayCompany: the name that aliases (Name, Shown) give for it, compared by letters and digits, else its own or Unknown."""
    key = lambda c: F.regexp_replace(F.lower(text.clean(c)), "[^a-z0-9]", "")
    named = aliases.groupBy(key(F.col("Name")).alias("_alias")).agg(F.max("Shown").alias("_shown"))
    named = F.broadcast(named) if named.count() <= BROADCAST_ALIASES else named
    own = F.coalesce(F.nullif(text.clean(F.col(company)), F.lit("")), F.lit("Unknown"))
    return rows.withColumn("_alias", key(own)).join(named, "_alias", "left").withColumn("DisplayCompany", F.coalesce("_shown", own)).drop("_alias", "_shown")
