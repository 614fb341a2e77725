"""Logical tables of the engine over the given star schema, as SQL that Spark and other engines read alike.

Postings come from orders and customers, fetch attempts from events, snapshots from line items, and boards of
a catalogue from suppliers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postloom.functions.fixed import ATS

TITLES = [
    "Technical Writer", "Senior Technical Writer", "Staff Technical Writer, API", "Documentation Engineer", "Docs Platform Engineer", "Head of Documentation", "Director, Technical Publications",
    "Content Designer", "UX Writer", "Senior Content Designer", "Developer Advocate", "Developer Relations Manager", "DevRel Engineer", "Knowledge Manager", "Knowledge Base Specialist",
    "Content Writer", "Copywriter", "Writer / Editor", "Technical Editor", "Curriculum Content Developer", "Software Engineer", "Backend Engineer", "Solutions Architect", "Product Designer",
    "Technical Support Engineer", "Registered Nurse", "Video Editor", "Product Manager", "Technical Program Manager", "Account Executive", "Information Architect", "Sales Manager", "Editor & Writer", "", "Lead Product Designer and Technical Writer", "Documentation Manager, Video Editor and Technical Writer",
]
LOCATIONS = ["Remote", "Remote - US", "Remote, Canada", "New York, NY", "London, United Kingdom", "Berlin", "Anywhere in the US", "Hybrid - Austin, TX", "Bengaluru, India", "Remote EMEA", "", "Singapore"]
DESCRIPTIONS = [
    "Write documentation, guides and tutorials for our API. This is a remote role open to candidates in the United States. Pay: $120,000 - $150,000 per year.",
    "We are a distributed team and you can work from home anywhere in North America. You will own docs, the knowledge base and content strategy for developers.",
    "This hybrid position has three office days a week. Compensation is $95k to $120k plus equity, and clinical experience helps in this regulated environment today.",
    "Onsite role. Candidates must be located in Canada. You will support customers and keep the systems running around the clock with the rest of the team.",
    "You will build services in Go and Java, review designs, and mentor other engineers. Salary range $140,000 – $180,000. Remote across EMEA and Europe only.",
    "Short text.",
    "",
    "Lead our community and education programs, write examples and content for developers, and speak at events. Based in Australia or New Zealand, travel as needed.",
    "Technical writing for regulated products. <b>Remote</b> in the USA &amp; the Americas. Base pay&nbsp;$80 - $95 per hour, with benefits from the first day on the job.",
    "Edit film and motion graphics with an AI trainer workflow. In-office four days a week with a small team of producers and designers in the studio downtown.",
]


def one_of(values: list[str], number: str) -> str:
    own = " ".join(f"when {i} then '" + v.replace("'", "''") + "'" for i, v in enumerate(values))
    return f"case cast(({number}) % {len(values)} as int) {own} end"


JOBS = f"""
select o_orderkey as seq, {one_of(ATS, "o_orderkey")} as ATS,
  case when o_orderkey % 11 = 0 then concat('Careers at ', c_name) else c_name end as Company,
  {one_of(TITLES, "o_orderkey * 7 + o_custkey")} as Title,
  {one_of(LOCATIONS, "o_orderkey * 3 + o_custkey")} as Location,
  {one_of(DESCRIPTIONS, "o_orderkey * 13 + o_custkey")} as Description,
  case when o_orderkey % 97 = 0 then 'not a url' when o_orderkey % 101 = 0 then ''
    else concat('https://Jobs.Example.com/', cast(o_custkey as string), '/', cast(o_orderkey % 7 as string), case when o_orderkey % 5 = 0 then '?ref=feed' else '/' end) end as URL,
  cast(cast(o_orderdate as date) as string) as DatePosted,
  case when o_orderkey % 3 = 0 then '' else concat('R-', cast(o_orderkey as string)) end as RawJobId
from {{orders}} join {{customer}} on o_custkey = c_custkey"""

#: Postings whose descriptions are whole documents with a sentence about the work behind them.
DOCUMENT_JOBS = f"""
select doc_id as seq, {one_of(ATS, "doc_id")} as ATS, concat('Firm ', cast(doc_id % 50 as string)) as Company, {one_of(TITLES, "doc_id * 5")} as Title, {one_of(LOCATIONS, "doc_id * 7")} as Location,
  concat(coalesce(text, ''), case when doc_id % 2 = 0 then ' ' else '' end, {one_of(DESCRIPTIONS, "doc_id * 3")}) as Description, concat('https://docs.example.com/', cast(doc_id as string)) as URL, '2026-01-01' as DatePosted, '' as RawJobId
from {{documents}}"""

FETCHES = f"""
select event_id as seq, {one_of(ATS, "user_id")} as ATS, concat('board-', cast(user_id as string)) as CatalogSlug, cast(ts as timestamp) as FetchedAt,
  case event_type when 'purchase' then 'success' when 'view' then 'success' when 'click' then 'empty' when 'error' then 'failed' else 'skipped' end as Status,
  case when event_type = 'error' then {one_of(["404", "422", "429", "500"], "event_id")} else '200' end as HttpStatus,
  case when event_type in ('purchase', 'view') then cast(floor(value) as bigint) else 0 end as JobCount
from {{events}}"""

ERRORS = ["", "The operation was aborted due to timeout", "Unexpected token < in JSON at position 0", "getaddrinfo ENOTFOUND boards.example.com", "no usable Workday fetch URL", "fetch failed", "odd"]

LOG = f"""
select event_id as seq, {one_of(ATS, "user_id")} as ATS, case when user_id % 10 = 0 then '' else concat('slug-', cast(user_id % 83 as string)) end as CatalogSlug, concat('company', cast(user_id % 40 as string)) as CompanyKey,
  cast(ts as timestamp) as FetchedAt, case event_type when 'purchase' then 'success' when 'view' then 'success' when 'click' then 'empty' when 'error' then 'failed' else 'skipped' end as Status,
  case when event_type = 'error' then {one_of(["404", "422", "429", "500", "", "403", "410", "418", ""], "event_id")} else '200' end as HttpStatus, case when event_type in ('purchase', 'view') then cast(floor(value) as bigint) else 0 end as JobCount,
  case when event_type = 'error' then {one_of(ERRORS, "event_id")} else '' end as Error,
  concat({one_of(ATS, "event_id")}, '-high-', case when event_id % 12 < 10 then '000' else '00' end, cast(event_id % 12 as string)) as BatchName
from {{events}}"""

PUBLIC = f"""
select o_orderkey as seq, {one_of(ATS, "o_orderkey")} as ATS, concat('company', cast(o_custkey % 160 as string)) as CompanyKey, {one_of(["A", "C", "B", "D", "F", "F"], "o_orderkey * 7 + o_custkey")} as WriterFitTier,
  cast(o_orderdate as timestamp) as FetchedAt from {{orders}}"""

SNAPSHOTS = """
select cast(month(l_shipdate) as int) as snapshot_id, l_suppkey as company_no, l_partkey as part_no, max(l_quantity) as score, max(l_extendedprice) as price
from {lineitem} group by 1, 2, 3"""

PLACES = ["Remote, US", "U.S. Remote", "USA", "US-PA-Remote", "Canada", "Boston, MA", "United States", "Remote EMEA", "Austin", "Brussels", ""]

DAILY = f"""
select cast(5 * month(l_shipdate) as int) as day, concat('Firm ', cast(l_suppkey as string)) as Company, {one_of(TITLES, "l_partkey * 3 + l_suppkey")} as Title, {one_of(PLACES, "l_partkey + l_suppkey * 5")} as Location,
  {one_of(["Remote", "remote", "Hybrid", "Onsite"], "l_partkey")} as Arrangement, {one_of(ATS, "l_suppkey")} as Source,
  concat('https://Jobs.example.com/', cast(l_suppkey as string), '/', cast(l_partkey as string), case when l_partkey % 5 = 0 then '?ref=feed' when l_partkey % 5 = 1 then '/' else '' end) as Link,
  cast(max(l_quantity) + 45 as bigint) as Score, case when l_partkey % 17 = 0 then null else cast(floor(max(l_extendedprice)) as bigint) % 600 end as Age
from {{lineitem}} group by month(l_shipdate), l_suppkey, l_partkey"""

CATALOG = f"""
select s_suppkey as seq, {one_of(ATS, "s_suppkey")} as ATS, concat('slug-', cast(s_suppkey % 83 as string)) as Slug, concat('company', cast(s_suppkey % 40 as string)) as CompanyKey,
  s_name as Company, case when s_suppkey % 9 = 0 then '' else concat('https://boards.example.com/', cast(s_suppkey as string)) end as BoardURL, n_name as Country
from {{supplier}} join {{nation}} on s_nationkey = n_nationkey"""

#: The catalogue with blank values and addresses that are none, as feeds have them.
MESSY = f"""
select seq, case when seq % 29 = 0 then '' else ATS end as ATS, case when seq % 13 = 0 then '' when seq % 7 = 0 then upper(Slug) else Slug end as Slug, case when seq % 11 = 0 then '' else CompanyKey end as CompanyKey, Company,
  case when seq % 10 = 0 then 'not an address' else BoardURL end as BoardURL, Country from ({CATALOG}) as c"""

ENTRIES = f"""
select s_suppkey as seq, {one_of(ATS, "s_suppkey * 5")} as ATS, case cast(s_suppkey % 8 as int)
  when 0 then concat('" ', replace(s_name, '#', ' no '), ' "') when 1 then concat('{{{{"slug":"', lower(replace(s_name, '#', '-')), '","company":"', n_name, '","url":""}}}}')
  when 2 then concat('{{{{"id":', cast(s_suppkey as string), ',"name":" ', n_name, '","careersUrl":"https://careers.example.com/', cast(s_suppkey as string), '"}}}}') when 3 then concat('["', n_name, '",', cast(s_nationkey as string), ']')
  when 4 then cast(s_suppkey as string) when 5 then concat('{{{{"name":"  ","slug":null,"careerSiteUrl":"https://jobs.example.com/', cast(s_nationkey as string), '"}}}}') when 6 then concat(s_name, ' is no JSON') else '""' end as Entry,
  concat('{{{{"office":{{{{"place":', case cast(s_suppkey % 5 as int) when 0 then concat('"', n_name, ' "') when 1 then concat('{{{{"label":" ', n_name, ' ","code":7}}}}') when 2 then concat('[{{{{"name":"', n_name, '"}}}},{{{{"value":"Hub"}}}},"plain",null,{{{{"x":1}}}}]')
    when 3 then cast(s_nationkey as string) else 'null' end, '}}}}}}}}') as Nested
from {{supplier}} join {{nation}} on s_nationkey = n_nationkey"""

_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_two = lambda x: f"lpad(cast({x} as string), 2, '0')"
_ymd = f"concat(cast(year(o_orderdate) as string), '-', {_two('month(o_orderdate)')}, '-', {_two('day(o_orderdate)')})"
_hm = f"concat({_two('o_custkey % 24')}, ':', {_two('o_orderkey % 60')})"
_month = one_of(_MONTHS, "month(o_orderdate) - 1")
_dmy = f"concat(cast(day(o_orderdate) as string), ' ', {_month}, ' ', cast(year(o_orderdate) as string))"

#: Dates as feeds write them.
DATE_TEXTS = f"""
select o_orderkey as seq, case cast(o_orderkey % 13 as int) when 0 then concat(replace({_ymd}, '-', ''), '-', replace({_hm}, ':', '')) when 1 then {_ymd} when 2 then concat({_ymd}, ' ', {_hm}, ' UTC')
  when 3 then concat(cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/', substring(cast(year(o_orderdate) as string), 3, 2)) when 4 then concat(cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/', cast(year(o_orderdate) as string))
  when 5 then concat({_ymd}, 'T', {_hm}, ':07Z') when 6 then concat('Mon, ', cast(day(o_orderdate) as string), ' ', substring({_month}, 1, 3), ' ', cast(year(o_orderdate) as string), ' ', {_hm}, ':30 GMT')
  when 7 then concat({_month}, ' ', cast(day(o_orderdate) as string), ', ', cast(year(o_orderdate) as string)) when 8 then {_dmy} when 9 then concat('  ', {_ymd}, ' ') when 10 then '' when 11 then concat('around ', {_dmy}) else concat(cast(o_custkey as string), '/x') end as Text
from {{orders}}"""

PARTS_OF = ["Amharic", "Thai", "Dutch", "Health", "Finance"]
FAMILIES = f"""
select day, Company, case when Score % 3 = 0 and Title <> '' then concat(Title, ' - ', {one_of(PARTS_OF, "Score + coalesce(Age, 0)")}, '  -  ', case when Score % 2 = 0 then 'Remote' else 'remote' end) when Score % 17 = 0 then concat('SEO ', Title, ' - Thai - Remote') else Title end as Title,
  Location, Link, Arrangement, Score, Age, case when Score % 9 = 0 then '' else concat('2026-0', cast(1 + Score % 8 as string), '-1', cast(coalesce(Age, 4) % 10 as string)) end as Posted, concat('2026-09-0', cast(1 + Score % 9 as string), ' 1', cast(coalesce(Age, 2) % 10 as string), ':30 UTC') as Checked from ({DAILY}) as d"""

BOARD_LINKS = f"""
select s_suppkey as seq, {one_of(ATS, "s_suppkey")} as ATS, case {one_of(ATS, "s_suppkey")}
  when 'ashby' then concat('https://jobs.ashbyhq.com/', lower(n_name), '/', cast(s_suppkey as string)) when 'lever' then concat('https://jobs.lever.co/', lower(n_name))
  when 'greenhouse' then case when s_suppkey % 4 < 2 then concat('https://boards-api.greenhouse.io/v1/boards/', lower(n_name), '/jobs?content=true') else concat('https://job-boards.greenhouse.io/', lower(n_name)) end
  when 'bamboohr' then concat('https://', lower(n_name), '.bamboohr.com/careers/list') when 'icims' then concat('https://careers-', lower(n_name), '.icims.com/jobs/search')
  when 'workday' then case when s_suppkey % 4 < 2 then concat('https://', lower(n_name), '.wd5.myworkdayjobs.com/wday/cxs/', lower(n_name), '/External/jobs') else concat('https://', lower(n_name), '.wd1.myworkdayjobs.com/Careers') end
  else 'no address' end as URL, concat(lower(n_name), '|wd3|Site', cast(s_suppkey % 3 as string)) as Slug from {{supplier}} join {{nation}} on s_nationkey = n_nationkey where s_suppkey % 17 <> 0
union all select s_suppkey, {one_of(ATS, "s_suppkey")}, case when s_suppkey % 2 = 0 then '' else 'http://nowhere' end, 'one|two' from {{supplier}} where s_suppkey % 17 = 0"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations", "benchmark", "embeddings")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer splits than the session has cores over all of them, where rows cost more than moving them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of one of the views above."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    if "orders" in used:  # postings are the rows that patterns are tried on
        used["orders"] = spread(used["orders"].select("o_orderkey", "o_custkey", "o_orderdate"))
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same SQL with table names in place."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql
