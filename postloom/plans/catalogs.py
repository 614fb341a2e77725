"""Queries over catalogues, files, dates, title families, plans and packages, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.functions import dates, fixed
from postloom.functions.folders import scratch_folder, stored
from postloom.operators import boards as B
from postloom.operators import catalogs as K
from postloom.operators import coverage as V
from postloom.operators import dashboard as D
from postloom.operators import postings as P
from postloom.operators import urls as U
from postloom.operators import variants as N
from postloom.operators.counters import RunningSummary
from postloom.plans import coverage, views
from postloom.plans.boards import _C, _L, _STATE, SUPERSEDED, _health, batch_log, catalog, fetches, latest_time
from postloom.plans.coverage import _BATCHES, log, public
from postloom.plans.jobs import ENRICHED, jobs
from postloom.sources import packages
from postloom.streaming import superseding

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


_q = lambda x: "'" + x + "'"


def messy(spark, sf_dir):
    return views.view(spark, sf_dir, views.MESSY)


# ---- entries of mixed form

_get = lambda k: f"nullif(trim(json_extract_string(j, '$.{k}')), '')"
_present = lambda ks: f"coalesce({', '.join(map(_get, ks))}, '')"
_by = lambda s, other, o: f"case json_type(j) when 'VARCHAR' then {s} when 'OBJECT' then {o} else coalesce({other}, '') end"
_plain = "trim(json_extract_string(j, '$'))"
_made = " ".join(f"when ATS = '{a}' then '{u}' || url_encode(CatalogSlug)" for a, u in fixed.BOARD_URLS.items())
_ENTRIES = f"""r as ({views.plain(views.ENTRIES.replace("{{", "{").replace("}}", "}"))}), e0 as (select *, case when json_valid(Entry) then cast(Entry as json) end as j from r),
e1 as (select seq, ATS, {_by(_plain, "''", _present(["slug", "id"]))} as CatalogSlug, {_by("''", "''", _present(["company", "name"]))} as CatalogCompany,
  {_by(_plain, "cast(j as varchar)", _present(fixed.ENTRY_VALUES))} as CatalogValue, {_by("''", "''", _present(fixed.ENTRY_URLS))} as u from e0)"""


def entries(spark, sf_dir):
    return views.view(spark, sf_dir, views.ENTRIES)


@query(f"with {_ENTRIES} select seq, CatalogSlug, CatalogCompany, CatalogValue, case when u <> '' then u when CatalogSlug = '' then '' {_made} else '' end as BoardURL from e1")
def p14_catalog_entries(spark, sf_dir):
    return K.catalog_entries(entries(spark, sf_dir)).select("seq", "CatalogSlug", "CatalogCompany", "CatalogValue", "BoardURL")


_item = lambda x: f"case json_type({x}) when 'OBJECT' then coalesce({', '.join(f'''nullif(trim(json_extract_string({x}, '$.{k}')), '')''' for k in ('name', 'label', 'value', 'title'))}, '') else coalesce(trim(json_extract_string({x}, '$')), '') end"


@query(f"""with {_ENTRIES}, n as (select seq, json_extract(cast(Nested as json), '$.office.place') as v from r)
select seq, case json_type(v) when 'ARRAY' then array_to_string(list_filter(list_transform(json_extract(v, '$[*]'), lambda x: {_item('x')}), lambda x: x <> ''), ' | ') else {_item('v')} end as Place from n""")
def p10_nested_text(spark, sf_dir):
    return entries(spark, sf_dir).select("seq", K.nested_text(F.parse_json("Nested"), "$.office.place").alias("Place"))


# ---- totals in one pass

_M = f"c as ({views.plain(views.MESSY)})"
_bad = "(trim(ATS) = '' or trim(Slug) = '' or trim(BoardURL) <> '' and not regexp_matches(BoardURL, '^https?://[^ ]+$'))"


@query(f"""with {_M}, v as (select lower(Slug) as x, count(*) as n from c where Slug <> '' group by 1), k as (select CompanyKey, count(distinct ATS) as a, count(distinct nullif(lower(Slug), '')) as s from c where CompanyKey <> '' group by 1),
a as (select ATS || 'Count=' || count(*) as t from c group by ATS)
select count(*) as TotalRows, count(distinct ATS) as UniqueATS, (select count(*) from v) as UniqueCatalogValues, (select count(*) from k) as UniqueCompanyKeys, count(*) filter (BoardURL <> '') as RowsWithBoardURL, count(*) filter (BoardURL = '') as RowsWithoutBoardURL,
  count(*) filter ({_bad}) as MalformedRows, (select count(*) from v where n > 1) as DuplicateCatalogValueGroups, (select count(*) from k where a > 1 or s > 1) as CompanyKeyOverlapGroups, (select string_agg(t, ' | ' order by t) from a) as Counts from c""")
def a15_catalog_totals(spark, sf_dir):
    """One scan: four grouping sets, then sums of their rows."""
    found = K.catalog_totals(messy(spark, sf_dir), B.malformed_reason())
    return found.withColumn("Counts", F.array_join(F.array_sort(F.transform(F.map_entries("Counts"), lambda x: F.concat(x["key"], F.lit("="), x["value"]))), " | "))


@query("""with t as (select p_brand || 'Count=' || count(*) as t from part group by p_brand) select count(*) as TotalTitles, count(distinct p_name) as UniqueTitles, (select string_agg(t, ' | ' order by t) from t) as Counts from part""")
def a21_category_totals(spark, sf_dir):
    found = K.category_totals(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand", "p_name"), "p_brand", "p_name")
    return found.withColumn("Counts", F.array_join(F.array_sort(F.transform(F.map_entries("Counts"), lambda x: F.concat(x["key"], F.lit("="), x["value"]))), " | "))


_set = lambda c: f"array_to_string(list_sort(list(distinct {c}) filter ({c} <> '')), ' | ')"


@query(f"with {_M} select Slug, count(*) as Count, {_set('ATS')} as ATSList, {_set('CompanyKey')} as CompanyKeys from c where Slug <> '' group by Slug having count(*) > 1")
def a17_values_of_messy_rows(spark, sf_dir):
    return B.duplicate_values(messy(spark, sf_dir))


@query(f"with {_M} select CompanyKey, count(distinct ATS) as ATSCount, count(distinct nullif(Slug, '')) as SlugCount, {_set('ATS')} as ATSList, {_set('Slug')} as Slugs from c where CompanyKey <> '' group by CompanyKey having count(distinct ATS) > 1 or count(distinct nullif(Slug, '')) > 1")
def a18_keys_of_messy_rows(spark, sf_dir):
    return B.key_overlap(messy(spark, sf_dir))


# ---- folders of files

def files(spark, sf_dir):
    """Pages as files: host, path and what follows as folders."""
    url = F.regexp_replace("url", "^[a-z]+://", "")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.regexp_replace(url, "[?#&]", "/").alias("Path"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("SizeBytes"))


_FILES = "f as (select regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#&]', '/', 'g') as Path, coalesce(strlen(html), 0)::bigint as SizeBytes from pages), s as (select *, string_split(Path, '/') as p from f)"


@query(f"""with {_FILES}, x as (select SizeBytes, p, unnest(range(2, least(len(p) - 1, 5) + 1)) as d from s where len(p) > 2)
select array_to_string(p[1:d], '/') as Folder, count(*) as Files, sum(SizeBytes)::bigint as SizeBytes from x group by 1 order by SizeBytes desc, Folder limit 20""")
def a32_prefix_rollup(spark, sf_dir):
    """The twenty largest folders: their number is the feature."""
    return K.largest_folders(files(spark, sf_dir))


@query(f"""with {_FILES}, c as (select p[2] as Category, SizeBytes from s) select case when grouping(Category) = 1 then 'all' else Category end as Category, count(*) as Files, sum(SizeBytes)::bigint as SizeBytes, max(SizeBytes) as LargestBytes from c group by rollup (Category)""")
def a31_file_totals(spark, sf_dir):
    return K.file_totals(files(spark, sf_dir), F.try_element_at(F.split("Path", "/"), F.lit(2)))


# ---- counters that grow by batches

_P = f"p as ({views.plain(views.PUBLIC)})"


@query(f"with {_P} select WriterFitTier, count(*) as Rows, count(*) filter (ATS = 'ashby') as Ashby, count(distinct CompanyKey) as Companies, count(distinct cast(FetchedAt as date)) as Days from p group by 1")
def a13_running_summary(spark, sf_dir):
    """Four batches of the feed, one of them replayed: the state equals an aggregate over all rows."""
    rows = public(spark, sf_dir)
    state = RunningSummary(spark, scratch_folder(spark, "summary"), "WriterFitTier", {"Rows": F.lit(True), "Ashby": F.col("ATS") == "ashby"}, {"Companies": F.col("CompanyKey"), "Days": F.col("FetchedAt").cast("date")})
    batch = F.pmod(F.xxhash64("seq"), F.lit(4))
    for number in (0, 1, 2, 1, 3):
        state.add(rows.where(batch == number), number)
    return state.summary()


# ---- the newest fetch of each board over a stream

@query(SUPERSEDED)
def e9_superseded_stream(spark, sf_dir):
    """The rows of j1_superseded_rows from a stream of attempts in several micro-batches, the last one replayed."""
    root = scratch_folder(spark, "superseding")
    source = views.view(spark, sf_dir, views.LOG).withColumn("SourceBatch", F.col("BatchName"))
    source.repartitionByRange(4, "seq").write.parquet(f"{root}/attempts")
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/attempts")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(before), 64)))  # a state store for each
    try:
        superseding.follow(stream, f"{root}/newest", f"{root}/checkpoint").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    newest = superseding.Newest(spark, f"{root}/newest")
    newest.take(newest.read().limit(1), newest.committed())  # changes nothing
    rows = batch_log(spark, sf_dir).where("Status <> 'skipped'")
    return B.superseded(rows, newest.read()).select("seq", "ATS", "CatalogSlug", "SourceBatch", "keep")


# ---- guarded refreshes

_v = "(ATS < 'h' or seq % 20 <> 0)"
_third = "(ATS not in ('ashby', 'lever') or seq % 3 = 0)"


@query(f"""with {_C}, n(Round, ATS) as (select r, a from unnest([1, 2, 3]) as t(r), unnest({list(fixed.ATS)}) as u(a)),
g as (select 1 as Round, ATS, count(*) as n, sum(seq) as s from c group by ATS union all select 2, ATS, count(*), sum(seq) from c where {_v} group by ATS union all select 3, ATS, count(*), sum(seq) from c where {_v} and {_third} group by ATS),
w as (select n.Round, n.ATS, coalesce(g.n, 0) as got, g.s from n left join g using (Round, ATS)),
o as (select a.ATS, a.got as g1, a.s as s1, b.got as g2, b.s as s2, d.got as g3, d.s as s3 from w a join w b using (ATS) join w d using (ATS) where a.Round = 1 and b.Round = 2 and d.Round = 3),
f as (select *, g2 = 0 or g2 < floor(g1 * 0.8) as l2 from o), h as (select *, case when l2 then g1 else g2 end as k2, case when l2 then s1 else s2 end as t2 from f), i as (select *, g3 = 0 or g3 < floor(k2 * 0.8) as l3 from h)
select 1 as Round, ATS, case when g1 = 0 then 'failed' else 'updated' end as Status, g1 > 0 as Usable, g1 as RowCount, 0 as PreviousRowCount from i
union all select 2, ATS, case when l2 and g1 > 0 then 'fallback' when l2 then 'failed' when s1 = s2 and g1 = g2 then 'unchanged' else 'updated' end, not l2 or g1 > 0, k2, g1 from i
union all select 3, ATS, case when l3 and k2 > 0 then 'fallback' when l3 then 'failed' when t2 = s3 and k2 = g3 then 'unchanged' else 'updated' end, not l3 or k2 > 0, case when l3 then k2 else g3 end, k2 from i""")
def s19_refresh(spark, sf_dir):
    """Three versions of the catalogue through the guard: the second lost a few rows of some sources, the third most of two."""
    root, rows, found = scratch_folder(spark, "refresh"), catalog(spark, sf_dir), None
    for round_, kept in enumerate(("true", _v, f"{_v} and {_third}"), 1):
        manifest = K.refresh(rows.where(kept), fixed.ATS, root).select(F.lit(round_).alias("Round"), "ATS", "Status", "Usable", "RowCount", "PreviousRowCount")
        found = manifest if found is None else found.unionByName(manifest)
    return found


# ---- cards of search pages

_card = lambda name, kind, id_, board: f"""concat('<li class="row iCIMS_JobCardItem x"><div class="header left"><span>Posted</span><span> ', {kind}, ' </span></div><a class="t" href="https://careers-', cast({board} as string), '.example.com/jobs/', cast({id_} as string), '/job?in_iframe=1"><span></span><h3> ', {name}, ' &amp; Co</h3></a><div class="description">About ', {kind}, '&nbsp;<b>now</b></div></li>')"""
_board, _place = "cast(floor(p_partkey / 60) as bigint)", "p_partkey % 60"
_pg = f"cast(floor(({_place}) / 6) as bigint)"
# from the eighth page on, every other board repeats what its first pages had
_id = f"case when {_board} % 2 = 0 and {_pg} >= 7 then {_board} * 60 + ({_place}) % 18 else p_partkey end"
CARD_ROWS = f"select {_board} as Board, {_pg} as Page, p_partkey as k, {_card('p_name', 'p_type', _id, _board)} as card from {{part}}"


@query(f"""with h as (select Board, Page, '<html><ul>' || string_agg(card, chr(10) order by k) || '</ul></html>' as html from ({views.plain(CARD_ROWS)}) group by all),
c as (select Board, Page, unnest(regexp_extract_all(html, '(?i)<li[^>]*class="[^"]*iCIMS_JobCardItem[^"]*"[^>]*>[\\s\\S]*?</li>')) as card from h),
x as (select Board, Page, regexp_extract(card, 'href="([^"]*/jobs/(\\d+)/[^"]+)"', 2) as CardId, trim(replace(regexp_extract(card, '<h3[^>]*>([\\s\\S]*?)</h3>', 1), '&amp;', '&')) as Title, regexp_replace(regexp_extract(card, 'href="([^"]*)"', 1), '[?]in_iframe=1$', '') as URL,
  trim(regexp_extract_all(card, '<span[^>]*>([\\s\\S]*?)</span>', 1)[2]) as Location, trim(regexp_replace(replace(regexp_replace(regexp_extract(card, 'class="description">([\\s\\S]*?)</div>', 1), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '\\s+', ' ', 'g')) as Description from c),
f as (select * from x qualify row_number() over (partition by Board, CardId order by Page) = 1),
s as (select p.Board, min(p.Page) as stop from (select distinct Board, Page from x) p left join (select distinct Board, Page from f) g using (Board, Page) where g.Page is null group by 1)
select f.* from f left join s using (Board) where (stop is null or f.Page < stop) and f.Page < 20""")
def s22_search_cards(spark, sf_dir):
    rows = views.view(spark, sf_dir, CARD_ROWS)
    sorted_ = F.array_sort(F.collect_list(F.struct("k", "card")))
    pages = rows.groupBy("Board", "Page").agg(F.concat(F.lit("<html><ul>"), F.array_join(F.transform(sorted_, lambda x: x["card"]), "\n"), F.lit("</ul></html>")).alias("Html"))
    return K.new_cards(K.cards(pages)).select("Board", "Page", "CardId", "Title", "URL", "Location", "Description")


# ---- dates, addresses, names

_whole = "regexp_replace(trim(Text), '/(\\d\\d)$', '/20\\1')"  # two digits of a year are of this century
_formats = ["%Y%m%d-%H%M", "%Y-%m-%d %H:%M UTC", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d", "%m/%d/%Y", "%a, %d %b %Y %H:%M:%S GMT", "%B %d, %Y", "%d %B %Y"]


@query(f"""with t as ({views.plain(views.DATE_TEXTS)}), d as (select seq, Text, try_strptime({_whole}, {_formats!r}) as d from t)
select seq, Text, strftime(d, '%Y-%m-%d %H:%M:%S') as Moment, coalesce(strftime(d, '%Y-%m-%d'), '') as Shown, greatest(date_diff('day', cast(d as date), date '1999-01-01'), 0)::int as AgeDays from d""")
def x19_dates(spark, sf_dir):
    rows = views.view(spark, sf_dir, views.DATE_TEXTS)
    return rows.select("seq", "Text", F.date_format(dates.coerce_date(F.col("Text")), "yyyy-MM-dd HH:mm:ss").alias("Moment"), dates.shown_date(F.col("Text")).alias("Shown"), dates.age_days(F.col("Text"), F.lit("1999-01-01").cast("date")).alias("AgeDays"))


@query(f"""with t as ({views.plain(views.DATE_TEXTS)}), d as (select seq % 100 as Company, try_strptime({_whole}, {_formats!r}) as d from t), r as (select Company, strftime(min(d), '%Y-%m-%d %H:%M UTC') as a, strftime(max(d), '%Y-%m-%d %H:%M UTC') as b from d group by 1)
select Company, coalesce(case when a = b then a else a || ' to ' || b end, '') as Checked from r""")
def a42_checked_range(spark, sf_dir):
    rows = views.view(spark, sf_dir, views.DATE_TEXTS).select((F.col("seq") % 100).alias("Company"), dates.coerce_date(F.col("Text")).alias("d"))
    return rows.groupBy("Company").agg(dates.shown_range(F.min("d"), F.max("d")).alias("Checked"))


_W = f"w as ({views.plain(views.BOARD_LINKS)}), s as (select *, regexp_extract(URL, '^https?://([^/?]+)', 1) as host, list_filter(string_split(regexp_extract(URL, '^https?://[^/?#]+([^?#]*)', 1), '/'), lambda x: x <> '') as p from w)"
_wd = "regexp_extract(host, '(wd\\d+)', 1)"
_slug = f"""case when host = '' then '' when ATS in ('ashby', 'lever') then coalesce(p[1], '') when ATS = 'greenhouse' then coalesce(case when list_position(p, 'boards') > 0 then p[list_position(p, 'boards') + 1] else p[1] end, '')
  when ATS = 'bamboohr' then case when host like '%.bamboohr.com' then string_split(host, '.')[1] else '' end when ATS = 'icims' then replace(string_split(host, '.')[1], 'careers-', '') when ATS = 'workday' then case when host not like '%.myworkdayjobs.com' then '' when p[2] = 'cxs' then p[3] || '|' || {_wd} || '|' || p[4] else string_split(host, '.')[1] || '|' || {_wd} || '|' || p[1] end else '' end"""


@query(f"with {_W} select seq, ATS, {_slug} as SlugFromURL from s")
def x13_slugs_from_urls(spark, sf_dir):
    return views.view(spark, sf_dir, views.BOARD_LINKS).select("seq", "ATS", U.slug_from_url(F.col("ATS"), F.col("URL")).alias("SlugFromURL"))


@query(f"""with {_W}, z as (select seq, URL, case when host like '%myworkdayjobs.com' then case when p[2] = 'cxs' then p[3] || '|' || {_wd} || '|' || p[4] else string_split(host, '.')[1] || '|' || {_wd} || '|' || p[1] end else Slug end as sl from s where ATS = 'workday'), y as (select *, string_split(sl, '|') as q from z)
select seq, case when contains(URL, '/wday/cxs/') then URL when len(q) >= 3 then 'https://' || q[1] || '.' || q[2] || '.myworkdayjobs.com/wday/cxs/' || q[1] || '/' || q[3] || '/jobs' else '' end as FetchURL,
  case when URL <> '' and not contains(URL, '/wday/cxs/') then URL when len(q) >= 3 then 'https://' || q[1] || '.' || q[2] || '.myworkdayjobs.com/' || q[3] else URL end as BoardURL from y""")
def x14_workday_urls(spark, sf_dir):
    fetch, board = U.workday_urls(F.col("Slug"), F.col("URL"))
    return views.view(spark, sf_dir, views.BOARD_LINKS).where("ATS = 'workday'").select("seq", fetch.alias("FetchURL"), board.alias("BoardURL"))


@query("""with n as (select c_custkey, string_split(trim(regexp_replace(regexp_replace(replace(lower(c_name), 'customer', 'big CUSTOMER'), '\\|.*$', ''), '[^A-Za-z0-9]+', ' ', 'g')), ' ') as w from customer)
select c_custkey, array_to_string(list_transform(w, lambda x: case when regexp_matches(x, '^[0-9]') then x else upper(x[1]) || lower(x[2:]) end), ' ') as Shown from n""")
def x6_company_names(spark, sf_dir):
    name = F.concat(F.replace(F.lower("c_name"), F.lit("customer"), F.lit("big CUSTOMER")), F.lit(" | what follows a bar"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", U.shown_company(name).alias("Shown"))


# ---- families of titles and grouped postings

_X = f"x as ({views.plain(views.FAMILIES)})"
_sq = lambda c: f"lower(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"
_top = lambda c: f"coalesce(array_to_string((list_sort(list(distinct {c}) filter ({c} <> '')))[1:10], ' | '), '')"
_noise = "\\b(" + "|".join(fixed.TITLE_NOISE) + ")\\b"


@query(f"""with {_X}, k as (select {_sq('Company')} as CompanyKey, {_sq("regexp_extract(trim(Title), '(?i)^(.+?)\\s+-\\s+[^-]+\\s+-\\s+(remote)$', 1)")} || ' - [qualifier] - remote' as TitleFamily, trim(Title) as Title, trim(Location) as Location, trim(Link) as Link
  from x where not regexp_matches(lower(trim(Title)), '{_noise}') and regexp_matches(trim(Title), '(?i)^(.+?)\\s+-\\s+[^-]+\\s+-\\s+(remote)$'))
select CompanyKey, TitleFamily, count(*) as Listings, count(distinct Title) as Titles, count(distinct nullif(Location, '')) as Places, {_top('Title')} as DistinctTitles, {_top('Location')} as Locations, {_top('Link')} as ApplyLinks from k group by 1, 2 having count(*) > 1 and count(distinct Title) > 1""")
def w19_title_families(spark, sf_dir):
    return K.title_families(views.view(spark, sf_dir, views.FAMILIES))


_GROUPED = f"""{_X}, k as (select *, {_sq('Company')} || '|' || {_sq('Title')} as GroupKey, trim(Location) as place, trim(Link) as lk, upper(lower(trim(Arrangement))[1]) || lower(trim(Arrangement))[2:] as kind from x),
r as (select *, row_number() over (partition by GroupKey order by case kind when 'Remote' then 0 when 'Hybrid' then 1 when 'Onsite' then 2 else 99 end, Age nulls last, Score desc, place, lk) as turn from k),
h as (select GroupKey, count(*) as Postings, count(distinct nullif(place, '')) as Places, count(distinct nullif(lk, '')) as n, list_sort(list(distinct place) filter (place <> '')) as names, min(nullif(trim(Posted), '')) as d, max(Age) as LargestAge, max(Checked) as seen from k group by 1 having count(distinct nullif(place, '')) > 1),
o as (select GroupKey, Postings, 'Multiple locations (' || Postings || ' postings): ' || array_to_string(names[1:8], '; ') || case when Places > 8 then '; +' || (Places - 8) || ' more' else '' end as Location, kind as WorkArrangement, Age, place as RepresentativeLocation, lk as ApplyLink,
  n - case when lk <> '' then 1 else 0 end as OtherLinks, coalesce(d, '') as PostedDate, LargestAge, seen as LastChecked from h join r using (GroupKey) where turn = 1)"""


@query(f"with {_GROUPED} select * from o")
def w17_grouped_postings(spark, sf_dir):
    return N.grouped_postings(views.view(spark, sf_dir, views.FAMILIES))


@query(f"with {_GROUPED} select distinct GroupKey, lk as Link from k join o using (GroupKey) where lk <> '' and lk <> ApplyLink")
def w18_other_links(spark, sf_dir):
    rows = stored(views.view(spark, sf_dir, views.FAMILIES), "postings")
    return N.other_links(rows, N.grouped_postings(rows))


# ---- health, plans and the dashboard

_names = ", ".join(f"({_q(a)})" for a in fixed.ATS)
_RECOMMEND = f"""{_L}, {_health}, {_P}, pb as (select ATS, count(*) as PublicRows from p where WriterFitTier in ('A', 'B') group by 1), names(ATS) as (values {_names}),
z as (select names.ATS, coalesce(BoardsAttempted, 0) as BoardsAttempted, coalesce(JobsFetched, 0) as JobsFetched, coalesce(PublicRows, 0) as PublicRows, coalesce(SuccessRate, 0) as sr, coalesce(FailureRate, 0) as fr, names.ATS in ({", ".join(map(_q, B.SUPPORTED))}) as known from names left join g using (ATS) left join pb using (ATS)),
y as (select *, case when known and JobsFetched > 1000 and sr >= 50 then 1 when JobsFetched > 0 and (BoardsAttempted < 100 or PublicRows < 1000) then case when known then 2 else 3 end when known and JobsFetched > 0 and fr >= 50 then 4 when JobsFetched > 0 then 5 when known and BoardsAttempted > 0 then 6 else 7 end as k from z)"""


def health_rows(spark, sf_dir):
    rows = public(spark, sf_dir).where("WriterFitTier in ('A', 'B')").groupBy("ATS").agg(F.count("*").alias("PublicRows"))
    return B.recommendations(B.fetch_health(fetches(spark, sf_dir)), rows, fixed.ATS, B.SUPPORTED)


@query(f"""with {_RECOMMEND} select ATS, BoardsAttempted, JobsFetched, PublicRows, ['SCALE_NOW', 'SAMPLE_MORE', 'SAMPLE_MORE', 'REVIEW_FETCHER', 'KEEP_BEST_EFFORT', 'REVIEW_FETCHER', 'CATALOG_ONLY_FOR_NOW'][k] as ScaleRecommendation,
  [500, 100, 50, 50, 50, 25, 0][k] as SuggestedNextBatchLimit, [250, 250, 500, 500, 500, 500, 0][k] as SuggestedDelayMs from y""")
def j18_recommendations(spark, sf_dir):
    return health_rows(spark, sf_dir)


def plan_rows(spark, sf_dir):
    """A plan made from the log's first half, held against the batches of the whole log."""
    half = log(spark, sf_dir).where("seq % 1000 < 400")
    index = V.batch_index(half)
    known = index.select(F.split("BatchName", "-")[0].alias("ATS"), "BatchName", F.lit(None).cast("long").alias("Offset"), F.lit(None).cast("long").alias("Limit"), "BoardsAttempted")
    plan = known.select("ATS", "BatchName").distinct().withColumn("n", F.expr("cast(regexp_extract(BatchName, '(\\\\d+)$', 1) as int)"))
    return plan.select("ATS", F.concat("ATS", F.lit("-high-"), F.lpad(((F.col("n") * 7) % 31).cast("string"), 4, "0")).alias("BatchName"), F.when(F.col("n") % 4 == 3, "SKIPPED").otherwise("READY").alias("PlanStatus")).distinct()


_PLAN = f"""{_BATCHES}, h as (select distinct split_part(BatchName, '-', 1) as ATS, cast(regexp_extract(BatchName, '(\\d+)$', 1) as int) as n from ({views.plain(views.LOG)}) where seq % 1000 < 400),
pl as (select distinct ATS, ATS || '-high-' || lpad(cast((n * 7) % 31 as varchar), 4, '0') as BatchName, case when n % 4 = 3 then 'SKIPPED' else 'READY' end as PlanStatus from h),
st as (select *, case when PlanStatus = 'READY' and BatchName in (select BatchName from ix) then 'STALE' when PlanStatus = 'READY' then 'READY' else 'SKIPPED' end as State from pl)"""


@query(f"with {_PLAN} select * from st")
def j19_plan_rows(spark, sf_dir):
    return D.split_plan(plan_rows(spark, sf_dir), V.batch_index(log(spark, sf_dir)))


def dashboard_row(spark, sf_dir):
    n = F.count_if
    attempts = fetches(spark, sf_dir)
    now = latest_time(attempts)
    fresh = B.freshness(B.board_state(attempts), now).where("ATS = 'all'")
    states = D.split_plan(plan_rows(spark, sf_dir), V.batch_index(log(spark, sf_dir)))
    alerts = B.anomalies(attempts, now)
    return D.dashboard({
        "feed": (public(spark, sf_dir), {"TotalRows": F.count("*"), "StrongRows": n(F.col("WriterFitTier").isin("A", "B"))}), "health": (health_rows(spark, sf_dir), {"HealthRows": F.count("*"), "ScaleNow": n(F.col("ScaleRecommendation") == "SCALE_NOW")}),
        "coverage": (catalog(spark, sf_dir), {"CoverageRows": F.count("*"), "CoveredCompanies": F.count_distinct("CompanyKey")}), "freshness": (fresh, {"FetchEligibleBoards": F.max("FetchEligibleBoards"), "DueBoards": F.max("DueBoards"), "Fresh7DayPercent": F.max("Fresh7DayPercent")}),
        "plan": (states, {"ReadyRows": n(F.col("State") == "READY"), "StaleReadyRows": n(F.col("State") == "STALE"), "SkippedRows": n(F.col("State") == "SKIPPED")}), "alerts": (alerts, {"AnomalyAlerts": n(F.col("Verdict").isin("WARN", "HIGH"))}),
        "files": (files(spark, sf_dir), {"TotalFiles": F.count("*"), "ArchiveCandidateBytes": F.sum(F.when(F.col("SizeBytes") > 8000, F.col("SizeBytes")))}),
    })


_DASH = f"""with y as (with {_RECOMMEND} select * from y), st as (with {_PLAN} select * from st), c as (with {_C} select * from c), f as (with {_FILES} select * from f), p as (with {_P} select * from p), an as (ALERTS),
v as (with {_STATE} select *, CoverageStatus <> 'UNSUPPORTED' as live, (select max(FetchedAt) from l) as now from s), w as (select *, epoch(now) - epoch(LastAttemptAt) as age from v),
t as (select (select count(*) from p) as TotalRows, (select count(*) from p where WriterFitTier in ('A', 'B')) as StrongRows, (select count(*) from y) as HealthRows, (select count(*) from y where k = 1) as ScaleNow, (select count(*) from c) as CoverageRows,
  (select count(distinct CompanyKey) from c) as CoveredCompanies, (select count(*) from w where live) as FetchEligibleBoards, (select count(*) from w where live and NextCheckAt <= now) as DueBoards,
  (select round(count(*) filter (live and age <= 604800) / count(*) filter (live) * 100, 2) from w) as Fresh7DayPercent, (select count(*) from st where State = 'READY') as ReadyRows, (select count(*) from st where State = 'STALE') as StaleReadyRows,
  (select count(*) from st where State = 'SKIPPED') as SkippedRows, (select count(*) from an where Verdict in ('WARN', 'HIGH')) as AnomalyAlerts, (select count(*) from f) as TotalFiles, (select sum(SizeBytes) filter (SizeBytes > 8000) from f)::bigint as ArchiveCandidateBytes)
select *, StaleReadyRows > 0 as PlanStale, case when TotalRows = 0 then 'PUBLIC_RELEASE' when HealthRows = 0 then 'ATS_HEALTH' when CoverageRows = 0 then 'CRAWL_COVERAGE' when FetchEligibleBoards = 0 then 'BOARD_FRESHNESS'
  when DueBoards > 0 then 'MAINTAIN_INDEX' when ArchiveCandidateBytes > 1073741824 then 'ARCHIVE' else 'PUBLIC_RELEASE' end as SuggestedNextAction from t"""


def _dashboard_sql() -> str:
    from postloom.plans.boards import SQL as own

    return _DASH.replace("ALERTS", own["c16_anomaly"])


@query(_dashboard_sql())
def j19_dashboard(spark, sf_dir):
    return dashboard_row(spark, sf_dir)


@query(f"with x as ({_dashboard_sql()}) select SuggestedNextAction, DueBoards, PlanStale from x")
def c21_next_action(spark, sf_dir):
    return dashboard_row(spark, sf_dir).select("SuggestedNextAction", "DueBoards", "PlanStale")


# ---- packages

@query(f"""with {_P} select 'all-rows' as Name, 'Every row' as Purpose, 'csv' as Format, true as Exists, count(*) as Rows from p union all select 'strong', 'Tiers A and B', 'parquet', true, count(*) from p where WriterFitTier in ('A', 'B')
union all select 'by-ats', 'Rows of each provider', 'csv', true, count(distinct ATS) from p union all select 'lines', 'The same as lines', 'json', false, null union all select 'none', 'Rows of no tier', 'parquet', true, 0""")
def k12_package(spark, sf_dir):
    """A package of five outputs, the JSON ones switched off; the rows are the manifest as the file system has it."""
    outputs = [
        packages.Output("all-rows", "Every row", lambda t: t), packages.Output("strong", "Tiers A and B", lambda t: t.where("WriterFitTier in ('A', 'B')"), "parquet"),
        packages.Output("by-ats", "Rows of each provider", lambda t: t.groupBy("ATS").count()), packages.Output("lines", "The same as lines", lambda t: t, "json"), packages.Output("none", "Rows of no tier", lambda t: t.where("WriterFitTier = 'Z'"), "parquet"),
    ]
    return packages.write_package(public(spark, sf_dir), outputs, scratch_folder(spark, "package"), skip=("json",)).select("Name", "Purpose", "Format", "Exists", "Rows")


# ---- diagnostics, batches to take over, names and cells as they are shown

@query(f"with {ENRICHED} select seq, Title, norm as NormalizedTitle, Company, ATS, BestCandidateTitle, BestCandidateScore::bigint as BestCandidateScore, TitleMatchType, MatchedWatchlistTitle, MatchReason, TitleReviewBucket, RemoteStatus, USRemoteEligible, LocationRisk, SalaryDetected, SalaryMin, SalaryMax from e")
def p19_match_diagnostics(spark, sf_dir):
    """How each posting was matched: the columns of the matcher as they are, nothing is matched again."""
    columns = ["seq", "Title", "NormalizedTitle", "Company", "ATS", "BestCandidateTitle", "BestCandidateScore", "TitleMatchType", "MatchedWatchlistTitle", "MatchReason", "TitleReviewBucket", "RemoteStatus", "USRemoteEligible", "LocationRisk", "SalaryDetected", "SalaryMin", "SalaryMax"]
    return P.described(jobs(spark, sf_dir)).select(*columns).withColumn("BestCandidateScore", F.col("BestCandidateScore").cast("long"))


_FILES_OF = f"(select distinct BatchName, Status as File from ({views.plain(views.LOG)}) where seq % 37 < 12)"


@query(f"""with f as {_FILES_OF}, b as (select BatchName, bool_or(File = 'success') as s, bool_or(File = 'empty') as e, bool_or(File = 'failed') as x from f group by 1), t as (select distinct BatchName from ({views.plain(views.LOG)}) where user_id_is_low),
i as (select BatchName, list_filter([case when not s then 'success' end, case when not e then 'empty' end, case when not x then 'failed' end], lambda v: v is not null) as m, BatchName in (select BatchName from t) as done from b),
j as (select BatchName, case when len(m) > 0 then 'missing required files: ' || array_to_string(m, ', ') when done then 'target batch folder already exists' else '' end as Issue from i) select BatchName, case when Issue = '' then 'READY' else 'SKIP' end as Status, Issue from j""".replace("user_id_is_low", "seq % 101 = 0"))
def u11_batches_to_import(spark, sf_dir):
    """Batches with a file of each outcome that no batch of the target has the name of."""
    attempts = log(spark, sf_dir)
    return K.inspected(attempts.where("seq % 37 < 12").select("BatchName", F.col("Status").alias("File")), ["success", "empty", "failed"], attempts.where("seq % 101 = 0"))


@query("""with a as (select regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') as k, max(c_mktsegment || ' ' || c_custkey) as shown from customer where c_custkey % 3 = 0 group by 1), o as (select c_custkey, case when c_custkey % 10 = 0 then ' ' else upper(c_name) || '.' end as Company from customer)
select c_custkey, coalesce(a.shown, coalesce(nullif(trim(Company), ''), 'Unknown')) as DisplayCompany from o left join a on a.k = regexp_replace(lower(coalesce(nullif(trim(Company), ''), 'Unknown')), '[^a-z0-9]', '', 'g')""")
def x25_display_companies(spark, sf_dir):
    own = spark.read.parquet(f"{sf_dir}/customer.parquet")
    aliases = own.where("c_custkey % 3 = 0").select(F.col("c_name").alias("Name"), F.concat("c_mktsegment", F.lit(" "), "c_custkey").alias("Shown"))
    return K.displayed(own.select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, " ").otherwise(F.concat(F.upper("c_name"), F.lit("."))).alias("Company")), aliases).select("c_custkey", "DisplayCompany")


@query("""select cast(p_partkey as varchar) as p_partkey, p_name, printf('%.2f', p_retailprice / 10) || '%' as SharePercent, case when p_size > 25 then 'Yes' else 'No' end as Large, case when p_size / 4.0 = floor(p_size / 4.0) then cast(cast(floor(p_size / 4.0) as bigint) as varchar) else rtrim(printf('%.4f', p_size / 4.0), '0') end as Quarter from part""")
def x21_display_cells(spark, sf_dir):
    """Cells as reports show them, by the names and types of their columns."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", (F.col("p_retailprice") / 10).alias("SharePercent"), (F.col("p_size") > 25).alias("Large"), (F.col("p_size") / 4).alias("Quarter"))
    return packages.shown(rows)


@query(f"""with x as ({coverage.SQL["j3_company_coverage"]}) select Company, ATS, CoverageStatus as "Coverage Status", JobsFound as "Jobs Found", GoodMatchesFound as "Good Matches Found", coalesce(LastChecked, '') as "Last Checked", LastFetchStatus as "Last Fetch Status", LastFetchError as "Fetch Notes" from x""")
def p22_coverage_rows(spark, sf_dir):
    """Coverage under the names that sheets show."""
    shown = {"CoverageStatus": "Coverage Status", "JobsFound": "Jobs Found", "GoodMatchesFound": "Good Matches Found", "LastChecked": "Last Checked", "LastFetchStatus": "Last Fetch Status", "LastFetchError": "Fetch Notes"}
    return coverage.j3_company_coverage(spark, sf_dir).na.fill("", ["LastChecked"]).select("Company", "ATS", *[F.col(c).alias(n) for c, n in shown.items()])
