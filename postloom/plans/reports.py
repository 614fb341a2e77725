"""Run reports over postings, slices without duplicates, links and payloads, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions import fixed
from postloom.functions.folders import ensure_checkpoints, scratch_folder, stored
from postloom.operators import postings as P
from postloom.operators import urls as U
from postloom.operators.ordering import numbered, ranked_within
from postloom.plans import views
from postloom.plans.boards import fetches
from postloom.plans.jobs import ENRICHED, _focus, _J, _named, _prefer, _q, _strong, _usr, enriched, jobs
from postloom.sources import feeds

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


#: Conditional counts that both summaries have; the conditions read alike in either SQL.
COUNTS = {
    "ExportOKCount": "ExportQualityFlag = 'OK'", "ExportReviewCount": "ExportQualityFlag = 'REVIEW'", "ExportBadRowCount": "ExportQualityFlag = 'BAD_ROW'", "PossibleDuplicateCount": "PossibleDuplicate",
    "StrongMatchCount": "TitleReviewBucket = 'STRONG_MATCH'", "PossibleMatchCount": "TitleReviewBucket = 'POSSIBLE_MATCH'", "AdjacentCount": "TitleReviewBucket = 'ADJACENT'", "LowSignalCount": "TitleReviewBucket = 'LOW_SIGNAL'",
    "IgnoreForNowCount": "TitleReviewBucket = 'IGNORE_FOR_NOW'", "RemoteCount": "RemoteStatus = 'Remote'", "HybridCount": "RemoteStatus = 'Hybrid'", "OnsiteCount": "RemoteStatus = 'Onsite'",
    "UnknownRemoteStatusCount": "RemoteStatus = 'Unknown'", "USRemoteEligibleTrueCount": "USRemoteEligible = 'true'", "SalaryDetectedCount": "SalaryDetected",
    **{f"WriterFit{t}Count": f"WriterFitTier = '{t}'" for t in "ABCDF"}, "WriterFitGuardrailAppliedCount": "WriterFitGuardrailApplied", "WriterFitPenaltyAppliedCount": "WriterFitPenaltySignals <> ''",
    "DemotedHighScoreCount": "(WriterFitGuardrailApplied or WriterFitPenaltySignals <> '') and WriterFitBaseScore >= 75",
}
RUN_COUNTS = {
    "JobsWithTitleMatch": "TitleMatchType <> 'none'", "JobsExactTitleMatch": "TitleMatchType = 'exact'", "JobsContainsTitleMatch": "TitleMatchType = 'contains'", "JobsTokenTitleMatch": "TitleMatchType = 'token'",
    "JobsNoTitleMatch": "TitleMatchType = 'none'", "USRemoteEligibleFalseCount": "USRemoteEligible = 'false'", "USRemoteEligibleUnknownCount": "USRemoteEligible = 'unknown'",
}
_counts = lambda cs: ", ".join(f"count(*) filter ({c}) as {n}" for n, c in cs.items())
_scores = "coalesce(round(avg(WriterFitScore), 2), 0) as AverageWriterFitScore, coalesce(max(WriterFitScore), 0)::bigint as MaxWriterFitScore, count(distinct nullif(DuplicateGroupKey, '')) as DuplicateGroupCount"


def counted(conditions: dict[str, str]) -> list:
    return [F.count_if(F.expr(c)).alias(n) for n, c in conditions.items()]


def scores() -> list:
    return [F.coalesce(F.round(F.avg("WriterFitScore"), 2), F.lit(0.0)).alias("AverageWriterFitScore"), F.coalesce(F.max("WriterFitScore"), F.lit(0)).cast("long").alias("MaxWriterFitScore"), F.count_distinct(F.nullif("DuplicateGroupKey", F.lit(""))).alias("DuplicateGroupCount")]


_L = f"l as ({views.plain(views.FETCHES)})"


@query(f"""with {ENRICHED}, {_L}, b as (select count(*) as BoardsAttempted, count(*) filter (Status = 'success') as BoardsSucceeded, count(*) filter (Status = 'failed') as BoardsFailed, count(*) filter (Status = 'empty') as BoardsEmpty from l),
u as (select coalesce(max(n), 0) as TopUnmatchedTitleCount from (select norm, count(*) as n from e where TitleMatchType = 'none' group by 1)),
r as (select count(*) as JobsFetched, count(distinct nullif(norm, '')) as UniqueJobTitles, count(distinct case when TitleMatchType <> 'none' then nullif(norm, '') end) as MatchedUniqueJobTitles, count(distinct case when TitleMatchType = 'none' then nullif(norm, '') end) as UnmatchedUniqueJobTitles,
  coalesce(round(avg(BestCandidateScore), 2), 0) as AverageBestCandidateScore, {_counts(RUN_COUNTS)}, {_counts(COUNTS)}, {_scores} from e) select * from b, u, r""")
def a1_run_summary(spark, sf_dir):
    """All metrics of a run in one row."""
    read = ["NormalizedTitle", "TitleMatchType", "BestCandidateScore", "ExportQualityFlag", "PossibleDuplicate", "TitleReviewBucket", "RemoteStatus", "USRemoteEligible", "SalaryDetected", "WriterFitTier", "WriterFitGuardrailApplied", "WriterFitPenaltySignals", "WriterFitBaseScore", "WriterFitScore", "DuplicateGroupKey"]
    e = stored(enriched(spark, sf_dir).select(*read), "run")
    # by title first: the counts of titles and of jobs then come from one pass, and no row is copied for each kind of distinct values
    conditions = RUN_COUNTS | COUNTS
    titles = e.groupBy("NormalizedTitle").agg(
        F.count("*").alias("n"), *counted(conditions), *[f(c).alias(f"{n}_{c}") for c in ("BestCandidateScore", "WriterFitScore") for n, f in (("sum", F.sum), ("n", F.count))], F.max("WriterFitScore").alias("most"),
    )
    title, none = F.col("NormalizedTitle") != "", F.col("JobsNoTitleMatch")
    average = lambda c: F.coalesce(F.round(F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")), 2), F.lit(0.0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    summary = titles.agg(
        total("n").alias("JobsFetched"), F.count_if(title).alias("UniqueJobTitles"), F.count_if(title & (F.col("n") > none)).alias("MatchedUniqueJobTitles"), F.count_if(title & (none > 0)).alias("UnmatchedUniqueJobTitles"),
        average("BestCandidateScore").alias("AverageBestCandidateScore"), *[total(n).alias(n) for n in conditions], average("WriterFitScore").alias("AverageWriterFitScore"), F.coalesce(F.max("most"), F.lit(0)).cast("long").alias("MaxWriterFitScore"),
        F.coalesce(F.max(none), F.lit(0)).alias("TopUnmatchedTitleCount"),
    )
    groups = e.where("DuplicateGroupKey <> ''").select("DuplicateGroupKey").distinct().agg(F.count("*").alias("DuplicateGroupCount"))
    log = fetches(spark, sf_dir).agg(F.count("*").alias("BoardsAttempted"), *[F.count_if(F.col("Status") == s).alias(n) for s, n in (("success", "BoardsSucceeded"), ("failed", "BoardsFailed"), ("empty", "BoardsEmpty"))])
    found = F.broadcast(log).join(F.broadcast(groups)).join(summary)
    shown = [c for c in summary.columns if c != "TopUnmatchedTitleCount"]
    return found.select(*log.columns, "TopUnmatchedTitleCount", *shown, "DuplicateGroupCount")


_supported = "|".join(fixed.ATS)


@query(f"""with {ENRICHED} select 'all' as ATS, {_q(_supported)} as SupportedATS, array_to_string(list_filter([{", ".join(map(_q, fixed.ATS))}], lambda x: list_contains(list(distinct lower(ATS)), x)), '|') as ATSIncluded, count(*) as TotalRows,
  coalesce(nullif(count(distinct nullif(trim(CompanyKey), '')), 0), count(distinct nullif(trim(Company), ''))) as UniqueCompanies, count(distinct nullif(norm, '')) as UniqueTitles, {_counts(COUNTS)}, {_scores} from (select *, '' as CompanyKey from e)""")
def a10_merged_summary(spark, sf_dir):
    """The summary of all batches together; companies count by key, or by name where there are no keys."""
    return merged_summary(enriched(spark, sf_dir).withColumn("CompanyKey", F.lit("")))


def merged_summary(e: DataFrame) -> DataFrame:
    named = lambda c: F.count_distinct(F.nullif(F.trim(c), F.lit("")))
    included = F.array_join(F.filter(F.array(*map(F.lit, fixed.ATS)), lambda x: F.array_contains(F.col("own_ats"), x)), "|")
    found = e.agg(
        F.collect_set(F.lower("ATS")).alias("own_ats"), F.count("*").alias("TotalRows"), F.coalesce(F.nullif(named("CompanyKey"), F.lit(0)), named("Company")).alias("UniqueCompanies"),
        F.count_distinct(F.nullif("NormalizedTitle", F.lit(""))).alias("UniqueTitles"), *counted(COUNTS), *scores(),
    )
    return found.select(F.lit("all").alias("ATS"), F.lit(_supported).alias("SupportedATS"), included.alias("ATSIncluded"), *[c for c in found.columns if c != "own_ats"])


# ---- slices without duplicates

DEDUPED = ["deduped-firehose", "deduped-writer-focus", "deduped-strong-matches", "deduped-remote-writer-focus", "deduped-top"]
_deduped = _named([("deduped-firehose", "true"), ("deduped-writer-focus", _focus), ("deduped-strong-matches", _strong), ("deduped-remote-writer-focus", f"{_usr} and {_focus}"), ("deduped-top", _strong)])


def deduped_slices():
    conditions = [F.lit(True), P.writer_focus(), P.strong_match(), P.remote_us() & P.writer_focus(), P.strong_match()]
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in zip(DEDUPED, conditions)]), lambda x: x.isNotNull())


@query(f"with {ENRICHED} select seq, unnest({_deduped}) as SliceName from e")
def f5_deduped_slices(spark, sf_dir):
    return enriched(spark, sf_dir).select("seq", F.explode(deduped_slices()).alias("SliceName"))


_MEMBERS = f"""{ENRICHED}, m as materialized (select *, unnest({_deduped}) as SliceName from e),
keys as (select SliceName, seq, unnest(case when DuplicateGroupKey <> '' or CanonicalURLKey <> '' then list_filter([case when DuplicateGroupKey <> '' then 'duplicate:' || DuplicateGroupKey end, case when CanonicalURLKey <> '' then 'canonical:' || CanonicalURLKey end], lambda x: x is not null)
  else ['fallback:' || coalesce(nullif(CompanyTitleLocationKey, ''), nullif(JobKey, ''), nullif(trim(URL), ''), 'row-' || seq)] end) as k from m),
heads as (select SliceName, k, min(seq) as head from keys group by 1, 2 having count(*) > 1), links as materialized (select distinct SliceName as s, seq, head from keys join heads using (SliceName, k) where seq <> head),
both_ as materialized (select s, seq as a, head as b from links union select s, head, seq from links), reach(s, x, y) as (select SliceName, seq, seq from m union select reach.s, reach.x, both_.b from reach join both_ on both_.a = reach.y and both_.s = reach.s),
comp as (select s as SliceName, x as seq, min(y) as component from reach group by 1, 2),
won as (select m.*, component, row_number() over (partition by m.SliceName, component order by {_prefer}) as DedupeRank, count(*) over (partition by m.SliceName, component) as DedupeGroupSize from m join comp on comp.SliceName = m.SliceName and comp.seq = m.seq)"""
_MEMBERS = _MEMBERS.replace("lower(Company), lower(Title), seq)", "lower(Company), lower(Title), m.seq)")


def slice_rows(spark, sf_dir: str) -> DataFrame:
    """Postings with the numbers of their slices; stored, as all that follows reads them again."""
    own = enriched(spark, sf_dir).select("seq", *P.KEYED_BY, *P.PREFERRED_BY, F.transform(deduped_slices(), lambda n: F.array_position(F.array(*map(F.lit, DEDUPED)), n)).alias("slices"))
    return stored(own, "postings")


def _within(number, seq):
    """A slice's number, or one made of it, before a posting's, in one long."""
    return F.shiftleft(number.cast("long"), 48).bitwiseOR(seq)


def slice_winners(rows: DataFrame) -> DataFrame:
    """SliceName, seq, component, DedupeRank and DedupeGroupSize of rows in each of their slices: components found within the slices, and ranks in them.

    What doesn't depend on the slice comes before a posting is dealt to its slices: its place in the order of preference, and the keys that it shares
    with any other, each as the smallest posting that has it and its kind. Slices then move only numbers.
    """
    texts = P.dedupe_keys(rows).select("seq", "slices", F.explode("keys").alias("key")).withColumn("hash", F.xxhash64("key"))
    shared = texts.groupBy("hash", "key").agg(F.min("seq").alias("head"), F.count("*").alias("n")).where("n > 1")
    kind = F.when(F.startswith("key", F.lit("duplicate:")), 0).when(F.startswith("key", F.lit("canonical:")), 1).otherwise(2)
    keys = stored(texts.join(shared, ["hash", "key"]).select("seq", "slices", "head", kind.alias("kind")), "keys")
    links = keys.select("seq", "head", "kind", F.explode("slices").alias("slice"))
    comp = P.linked(links.select(_within(F.col("slice"), F.col("seq")).alias("id"), _within(F.col("slice") * 4 + F.col("kind"), F.col("head")).alias("key")))
    placed = numbered(rows.select("slices", *P.PREFERRED_BY, "seq"), P.preference()).select("seq", "place", F.explode("slices").alias("slice"))
    members = stored(placed.select(_within(F.col("slice"), F.col("seq")).alias("id"), "place").join(comp, "id", "left"), "members")
    ranks = ranked_within(members.where("component is not null"), ["component"], ["place"], ["id", "component"])
    alone = members.where("component is null").select("id", F.col("id").alias("component"), F.lit(1).cast("long").alias("rank"), F.lit(1).cast("long").alias("size"))
    seq = lambda c: F.col(c).bitwiseAND(F.lit((1 << 48) - 1)).alias("seq" if c == "id" else c)
    name = F.element_at(F.array(*map(F.lit, DEDUPED)), F.shiftright("id", 48).cast("int"))
    return ranks.union(alone).select(name.alias("SliceName"), seq("id"), seq("component"), F.col("rank").alias("DedupeRank"), F.col("size").alias("DedupeGroupSize"))


@query(f"with recursive {_MEMBERS} select SliceName, seq, component, DedupeRank, DedupeGroupSize from won")
def w7_slice_components(spark, sf_dir):
    ensure_checkpoints(spark)
    return slice_winners(slice_rows(spark, sf_dir)).select("SliceName", "seq", "component", "DedupeRank", "DedupeGroupSize")


@query(f"with recursive {_MEMBERS} select SliceName, count(*) as RawRows, count(*) filter (DedupeRank = 1) as KeptRows, count(*) filter (DedupeRank > 1) as RejectedRows, count(*) filter (DedupeRank = 1 and DedupeGroupSize > 1) as Decisions from won group by 1")
def e5_stage_outputs(spark, sf_dir):
    """Winners of each slice written to its folder, read again and counted next to what was rejected."""
    ensure_checkpoints(spark)
    won = slice_winners(slice_rows(spark, sf_dir)).select("SliceName", "seq", "DedupeRank", "DedupeGroupSize")
    path = scratch_folder(spark, "slices")
    won.write.partitionBy("SliceName").parquet(path)
    back = spark.read.parquet(path)
    kept = F.col("DedupeRank") == 1
    return back.groupBy("SliceName").agg(F.count("*").alias("RawRows"), F.count_if(kept).alias("KeptRows"), F.count_if(~kept).alias("RejectedRows"), F.count_if(kept & (F.col("DedupeGroupSize") > 1)).alias("Decisions")).withColumn("SliceName", F.col("SliceName").cast("string"))


@query(f"with {ENRICHED} select seq, DuplicateGroupKey, row_number() over (order by DuplicateGroupKey, Company, Title, seq) as place from d where PossibleDuplicate")
def o7_duplicate_listing(spark, sf_dir):
    rows = P.with_duplicate_flags(jobs(spark, sf_dir)).where("PossibleDuplicate").select("seq", "DuplicateGroupKey", "Company", "Title")
    return numbered(rows, ["DuplicateGroupKey", "Company", "Title", "seq"]).select("seq", "DuplicateGroupKey", "place")


@query(f"with {ENRICHED} select seq, ExportQualityFlag, ExportQualityIssues, Company, Title, URL, ATS from q where ExportQualityFlag = 'BAD_ROW'")
def o8_bad_rows(spark, sf_dir):
    rows = P.graded(jobs(spark, sf_dir)).where("ExportQualityFlag = 'BAD_ROW'")
    return rows.select("seq", "ExportQualityFlag", "ExportQualityIssues", "Company", "Title", "URL", "ATS")


@query(f"with {ENRICHED} select CanonicalURLKey, count(*) as Rows from d where CanonicalURLKey <> '' group by 1")
def a9_key_counts(spark, sf_dir):
    return P.with_keys(jobs(spark, sf_dir)).where("CanonicalURLKey <> ''").groupBy("CanonicalURLKey").agg(F.count("*").alias("Rows"))


@query(f"with {ENRICHED} select seq, row_number() over (order by WriterFitBaseScore desc, lower(Company), lower(Title), seq) as place, WriterFitBaseScore::bigint as WriterFitBaseScore, WriterFitScore::bigint as WriterFitScore, WriterFitPenaltySignals from e where (WriterFitGuardrailApplied or WriterFitPenaltySignals <> '') and WriterFitBaseScore >= 75")
def p29_demoted_rows(spark, sf_dir):
    rows = enriched(spark, sf_dir).where("(WriterFitGuardrailApplied or WriterFitPenaltySignals <> '') and WriterFitBaseScore >= 75").select("seq", "Company", "Title", "WriterFitBaseScore", "WriterFitScore", "WriterFitPenaltySignals")
    placed = numbered(stored(rows, "demoted"), [F.desc("WriterFitBaseScore"), F.lower("Company"), F.lower("Title"), "seq"])
    return placed.select("seq", "place", F.col("WriterFitBaseScore").cast("long").alias("WriterFitBaseScore"), F.col("WriterFitScore").cast("long").alias("WriterFitScore"), "WriterFitPenaltySignals")


# ---- links and keys

_raw = "case page_id % 4 when 0 then '=HYPERLINK(\"' || url || '\",\"Apply\")' when 1 then regexp_replace(url, '^https?://', '') when 2 then '  ' || url || '/  ' else url end"
_squeeze = "trim(regexp_replace(raw, '\\s+', ' ', 'g'))"
_unwrapped = f"case when regexp_extract({_squeeze}, '(?i)^=HYPERLINK\\(\\s*\"([^\"]+)\"', 1) <> '' then regexp_extract({_squeeze}, '(?i)^=HYPERLINK\\(\\s*\"([^\"]+)\"', 1) else {_squeeze} end"


@query(f"with r as (select page_id, {_raw} as raw from pages), u as (select page_id, {_unwrapped} as url from r), n as (select page_id, case when regexp_matches(url, '(?i)^https?://') then url when regexp_matches(url, '(?i)^[A-Za-z0-9_.-]+\\.[a-z]{{2,}}(?:/|$)') then 'https://' || url else url end as url from u) select page_id, url, lower(regexp_replace(url, '/+$', '')) as LookupKey from n")
def x11_unwrapped_urls(spark, sf_dir):
    url = F.col("url")
    raw = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit('=HYPERLINK("'), url, F.lit('","Apply")'))).when(F.col("page_id") % 4 == 1, F.regexp_replace(url, "^https?://", "")).when(F.col("page_id") % 4 == 2, F.concat(F.lit("  "), url, F.lit("/  "))).otherwise(url)
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", U.normal_url(raw).alias("url"), U.url_lookup_key(raw).alias("LookupKey"))


# Addresses of boards made of the pages' own hosts and numbers; the SQL reads hosts, segments and texts out of them again.
_word, _number = "regexp_extract(url, '://([a-z]+)', 1)", "regexp_extract(url, '/([0-9]+)', 1)"
_original = f"case page_id % 3 when 0 then concat('https://boards.greenhouse.io/', {_word}, '/jobs/', {_number}, '?gh=', cast(page_id as string)) when 1 then concat('https://job-boards.greenhouse.io/', {_word}) else url end"
_final = f"case page_id % 7 when 0 then concat('https://', {_word}, '.example/404/') when 1 then concat('https://boards.greenhouse.io/', {_word}, '/jobs/', {_number}, '1') when 2 then concat('https://boards.greenhouse.io/', {_word}) when 3 then {_word} else url end"
_hosts = ", ".join(map(_q, U.BOARD_HOSTS))
_board = lambda u, n: f"lower(regexp_extract({u}, '^[A-Za-z]+://([^/?#:]+)', 1)) as {n}host, list_filter(string_split(regexp_extract({u}, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), '/'), lambda x: x <> '') as {n}p"
_job = lambda n: f"case when {n}host in ({_hosts}) and list_position({n}p, 'jobs') > 0 then coalesce({n}p[list_position({n}p, 'jobs') + 1], '') else '' end"
_slug = lambda n: f"case when {n}host in ({_hosts}) then coalesce(case when list_position({n}p, 'jobs') > 1 then {n}p[list_position({n}p, 'jobs') - 1] else {n}p[1] end, '') else '' end"


def _pages(spark, sf_dir):
    """Pages with the address they had and the one they led to."""
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.expr(_original).alias("OriginalURL"), F.expr(_final).alias("FinalURL"), "html")


@query(f"with o as (select page_id, {_original} as u from pages), h as (select page_id, {_board('u', 'o')} from o) select page_id, {_job('o')} as JobId, {_slug('o')} as Slug from h")
def x12_board_ids(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", U.board_job_id(F.col("OriginalURL")).alias("JobId"), U.board_slug(F.col("OriginalURL")).alias("Slug"))


def _checks(spark, sf_dir):
    p = F.col("page_id")
    page = F.when(p % 11 == 0, F.concat(F.coalesce("html", F.lit("")), F.lit(" This job is closed"))).otherwise(F.col("html"))
    return _pages(spark, sf_dir).select("page_id", "OriginalURL", "FinalURL", F.when(p % 10 == 0, 404).otherwise(200).alias("HttpStatus"), page.alias("Page"))


_C18 = f"""with i as (select page_id, {_original} as o, {_final} as f, case when page_id % 10 = 0 then 404 else 200 end as HttpStatus, case when page_id % 11 = 0 then coalesce(html, '') || ' This job is closed' else html end as page from pages),
h as (select *, {_board('o', 'o')}, {_board('f', 'f')} from i), j as (select *, {_job('o')} as oj, {_job('f')} as fj, {_slug('o')} as os, {_slug('f')} as fs from h),
v as (select page_id, case when HttpStatus >= 400 then 'HTTP ' || HttpStatus when regexp_matches(f, '(?i){"|".join(U.DEAD_URLS)}') then 'Final URL matches a known expired/error page pattern.' when fhost = '' then 'Could not parse final URL'
  when oj <> '' and fj <> '' and fj <> oj then 'Greenhouse job URL redirected to a different job id (' || fj || ').' when oj <> '' and fhost in ({_hosts}) and fj = '' then 'Greenhouse job URL redirected to the company board instead of the job detail page.'
  when coalesce(regexp_matches(page, '(?i){"|".join(U.DEAD_PAGES)}'), false) then 'Page text matches a known closed/not-found job pattern.' else '' end as Issue from j)"""


@query(f"{_C18} select * from v")
def c18_url_verdicts(spark, sf_dir):
    return U.verdicts(_checks(spark, sf_dir)).select("page_id", "Issue")


@query(f"{_C18} select count(*) as Checked, count(*) filter (Issue = '') as Passed, count(*) filter (Issue <> '') as Failed, count(*) filter (Issue like 'HTTP %') as HttpFailures from v")
def a40_check_counts(spark, sf_dir):
    issue = F.col("Issue")
    return U.verdicts(_checks(spark, sf_dir)).agg(F.count("*").alias("Checked"), F.count_if(issue == "").alias("Passed"), F.count_if(issue != "").alias("Failed"), F.count_if(issue.startswith("HTTP ")).alias("HttpFailures"))


_keep = lambda safe: "Issue = ''" + (" or not (regexp_matches(Issue, '^HTTP (404|410)') or Issue in (" + ", ".join(map(_q, U.FINAL_ISSUES)) + ") or starts_with(Issue, 'Greenhouse job URL redirected'))" if safe else "")


@query(f"{_C18} select page_id, {_keep(True)} as KeptSafe, {_keep(False)} as KeptAll from v")
def f17_pruned_links(spark, sf_dir):
    """Links that stay after a check: in safe mode all that didn't fail for good."""
    ok, status = F.when(F.col("Issue") == "", "Yes").otherwise("No"), F.when(F.col("Issue") == "", "OK").otherwise("Bad")
    return U.verdicts(_checks(spark, sf_dir)).select("page_id", U.kept_after_check(ok, status, F.col("Issue"), True).alias("KeptSafe"), U.kept_after_check(ok, status, F.col("Issue"), False).alias("KeptAll"))


_suffixes = ["", ", Inc.", " Technologies LLC", " & Co", "-Labs"]
_suffix = views.one_of(_suffixes, "s_suppkey")


@query(f"with s as (select s_suppkey, s_name || {_suffix} as name from supplier), k as (select s_suppkey, name, list_filter(string_split_regex(regexp_replace(lower(trim(name)), '[-!\"#$%&''()*+,./:;<=>?@\\[\\\\\\]^`{{|}}~_]', ' ', 'g'), '\\s+'), lambda w: w <> '' and w not in ({', '.join(map(_q, U.KEY_LESS))})) as ws from s) select s_suppkey, name, array_to_string(ws, '') as CompanyKey from k")
def x5_company_keys(spark, sf_dir):
    name = F.concat("s_name", F.expr(_suffix))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", name.alias("name"), U.company_key(name).alias("CompanyKey"))


# ---- payloads of the remaining providers

# Payload text made of the tables' own words, with its fields under different names; both sides read the JSON by the same names.
_s = lambda x: f"cast({x} as string)"
_field = lambda name, value: f"concat('\"{name}\":\"', {value}, '\"')"
_BODIES = f"""
select o_orderkey as seq, case cast(o_orderkey % 3 as int) when 0 then {_field("id", "concat(' R-', " + _s("o_orderkey") + ")")} when 1 then concat({_field("jobReqId", _s("o_custkey"))}, ',"id":" "') else {_field("reqId", _s("o_orderkey"))} end as own,
  case when o_orderkey % 4 < 3 then {_field("title", "concat(c_mktsegment, '  writer ')")} else concat('"title":null,', {_field("jobTitle", "c_name")}) end as called,
  case cast(o_orderkey % 5 as int) when 0 then {_field("externalPath", "concat('https://x.example/job/', " + _s("o_orderkey") + ")")} when 1 then {_field("externalPath", "concat('/job/', o_orderpriority)")} when 2 then {_field("externalPath", "concat('job/', " + _s("o_custkey") + ")")} when 3 then {_field("url", "concat('https://y.example/', " + _s("o_orderkey") + ")")} else '"externalPath":""' end as link,
  case cast(o_custkey % 4 as int) when 0 then {_field("locationsText", "concat(' ', n_name)")} when 1 then concat('"location":{{{{', {_field("label", "n_name")}, '}}}}') when 2 then concat('"location":{{{{', {_field("city", "n_name")}, ',"state":"TX"}}}}') else {_field("city", "n_name")} end as place
from {{orders}} join {{customer}} on o_custkey = c_custkey join {{nation}} on c_nationkey = n_nationkey"""
_B = f"b as ({views.plain(_BODIES).replace('{{', '{').replace('}}', '}')}), d as (select seq, cast('{{' || own || ',' || called || ',' || link || ',' || place || '}}' as json) as j from b)"
_get = lambda n: f"nullif(trim(json_extract_string(j, '$.{n}')), '')"
_any_of = lambda *ns: f"coalesce({', '.join(_get(n) for n in ns)}, '')"


def bodies(spark, sf_dir):
    """seq and body, the JSON text of one posting."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")
    rows = spark.sql(_BODIES, orders=o, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation")})
    return rows.select("seq", F.concat(F.lit("{"), F.concat_ws(",", "own", "called", "link", "place"), F.lit("}")).alias("body"))


@query(f"""with {_B}, w as (select {_any_of("externalPath", "externalUrl", "url")} as p, {_any_of("id", "jobReqId")} as i, {_any_of("title", "jobTitle")} as Title, {_any_of("locationsText")} as Location from d)
select case when i <> '' then i else p end as RawJobId, Title, Location, case when p like 'http%' then p when p = '' then 'https://acme.example/careers' when p like '/%' then 'https://acme.example/careers' || p else 'https://acme.example/careers/' || p end as URL from w""")
def p4_workday_payloads(spark, sf_dir):
    """Payloads with a whole, a relative and no link, resolved against the board's."""
    rows = bodies(spark, sf_dir).select(F.from_json("body", feeds.WORKDAY).alias("r")).select("r.*")
    return feeds.from_workday(rows, "https://acme.example/careers/").select("RawJobId", "Title", "Location", "URL")


_where = "case when json_type(json_extract(j, '$.location')) = 'OBJECT' then coalesce(nullif(trim(json_extract_string(j, '$.location.name')), ''), nullif(trim(json_extract_string(j, '$.location.label')), ''), nullif(array_to_string(list_filter([trim(json_extract_string(j, '$.location.city')), trim(json_extract_string(j, '$.location.state'))], lambda x: coalesce(x, '') <> ''), ', '), '')) end"
_wrapped = "case cast(seq % 4 as int) when 0 then concat('[', body, ']') when 1 then concat('{\"meta\":[1],\"result\":[', body, ']}') when 2 then concat('{\"jobs\":[', body, ',', body, ']}') else concat('{\"jobOpenings\":[', body, ']}') end"


@query(f"""with {_B}, w as (select {_wrapped.replace('body', 'cast(j as varchar)')} as t from d), x as (select unnest(case when t like '[%' then json_extract(t::json, '$[*]') when json_type(t::json, '$.result') = 'ARRAY' then json_extract(t::json, '$.result[*]') when json_type(t::json, '$.jobs') = 'ARRAY' then json_extract(t::json, '$.jobs[*]') else json_extract(t::json, '$.jobOpenings[*]') end) as j from w)
select {_any_of("id", "jobOpeningId", "openingId")} as RawJobId, {_any_of("jobOpeningName", "title", "jobTitle", "name")} as Title, coalesce({_where}, '') as Location, coalesce({_get("url")}, case when {_get("id")} is not null then 'https://acme.example/careers/' || {_get("id")} end, '') as URL from x""")
def p5_bamboohr_payloads(spark, sf_dir):
    """Arrays of openings under the names that payloads use, found by extract_jobs (S23)."""
    wrapped = bodies(spark, sf_dir).select(F.expr(_wrapped).alias("body"))
    return feeds.from_bamboohr(feeds.extract_jobs(wrapped, "body", feeds.BAMBOOHR), "https://acme.example/careers/list").select("RawJobId", "Title", "Location", "URL")


@query(f"""with {_B} select {_any_of("id", "jobId", "requisitionId", "reqId")} as RawJobId, {_any_of("title", "jobTitle", "name")} as Title, coalesce({_where}, {_get("city")}, '') as Location, coalesce({_get("url")}, 'https://board.example') as URL from d""")
def p6_icims_payloads(spark, sf_dir):
    rows = bodies(spark, sf_dir).select(F.from_json("body", feeds.ICIMS).alias("r")).select("r.*")
    return feeds.from_icims(rows, "https://board.example").select("RawJobId", "Title", "Location", "URL")


# ---- consumer file and lists

_policy = "\n".join(t["title"] for t in P.watchlist())


@query(f"with {_J} select 'all' as source, sha256({_q(_policy)}) as titlePolicySha256, {len(P.watchlist())}::bigint as titleCount, count(*) as scannedRows, count(*) filter (trim(Title) <> '') as titledRows from j")
def k14_consumer_header(spark, sf_dir):
    """The head of a consumer file: digest of the title policy and counts, written with its rows and read again."""
    df = jobs(spark, sf_dir)
    head = df.agg(F.lit("all").alias("source"), F.sha2(F.lit(_policy), 256).alias("titlePolicySha256"), F.lit(len(P.watchlist())).cast("long").alias("titleCount"), F.count("*").alias("scannedRows"), F.count_if(F.trim("Title") != "").alias("titledRows"))
    path = scratch_folder(spark, "consumer")
    head.coalesce(1).write.json(path)
    return spark.read.schema(head.schema).json(path)


_columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_lines = " union all ".join(f"select '{c}' as name, {i}::bigint as place, count({c}) as filled, count(distinct {c}) as distinct_values from orders" for i, c in enumerate(_columns, 1))


@query(f"select name, case when name like 'o_order%' then 'order' when name like 'o_cust%' then 'customer' else 'value' end as category, place, filled, distinct_values from ({_lines})")
def p30_data_dictionary(spark, sf_dir):
    """A line per column of a table: a category by its name's beginning, its place, and how many values it has, from one scan."""
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    counts = df.agg(*[F.struct(F.lit(n).alias("name"), F.lit(i).cast("long").alias("place"), F.count(n).alias("filled"), F.count_distinct(n).alias("distinct_values")).alias(n) for i, n in enumerate(df.columns, 1)])
    lines = counts.select(F.explode(F.array(*counts.columns)).alias("x")).select("x.*")
    return lines.select("name", F.when(F.col("name").startswith("o_order"), "order").when(F.col("name").startswith("o_cust"), "customer").otherwise("value").alias("category"), "place", "filled", "distinct_values")
