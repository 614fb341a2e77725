"""Queries over postings, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.functions import fixed, text
from postloom.functions.folders import ensure_checkpoints, stored
from postloom.operators import postings as P
from postloom.operators.ordering import first_values, spread_key
from postloom.plans import views

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


# ---- SQL for the enriched postings, step by step

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(map(_q, words)) + "]"


def _named(pairs) -> str:
    return "list_filter([" + ", ".join(f"case when {c} then {_q(n)} end" for n, c in pairs) + "], lambda x: x is not null)"


def _rank(x: str, ranks: dict) -> str:
    return f"case {x} " + " ".join(f"when {_q(k)} then {v}" for k, v in ranks.items()) + " else 99 end"


def _any(x: str, phrases) -> str:
    return "(" + " or ".join(f"contains({x}, {_q(p)})" for p in phrases) + ")"


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _title(x: str) -> str:
    return _squeeze(f"regexp_replace(replace(lower(trim({x})), '&', ' and '), '[-_/!\"#$%''()*+,.:;<=>?@\\[\\\\\\]^`{{|}}~]', ' ', 'g')")


def _search(x: str) -> str:
    return _squeeze(f"regexp_replace(lower(trim({x})), '[_/.,;:()\\[\\]{{}}]+', ' ', 'g')")


def _key(x: str) -> str:
    return f"regexp_replace(lower(trim({x})), '[-_/!\"#$%&''()*+,.:;<=>?@\\[\\\\\\]^`{{|}}~]|\\s', '', 'g')"


def _matched(x: str, patterns) -> str:
    return f"regexp_matches({x}, {_q('|'.join(f'(?:{p})' for p in patterns))})"


def _url(x: str) -> str:
    host = f"regexp_extract({x}, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)', "
    return f"case when regexp_matches({x}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+') then lower({host}1)) || '://' || lower({host}2)) || regexp_replace({host}3), '/+$', '') else '' end"


HAS = lambda n: f"list_contains(signals, {_q(n)})"
_us = f"({HAS('remote us')} or {HAS('anywhere in the us')})"
ARRANGED = f"""
j as ({views.plain(views.JOBS)}),
a1 as (select *, {_squeeze("lower(Title || ' ' || Location || ' ' || Description)")} as hay, lower(trim(Location)) as place from j),
a2 as (select *, {_named([(n, _matched("hay", [p])) for n, p in fixed.REMOTE_SIGNALS])} as signals from a1),
a3 as (select *, {_named([(n, _matched("hay", [p]) + (f" or {_us}" if n == "United States" else "")) for n, p in fixed.COUNTRY_SIGNALS])} as countries,
  case when list_has_any(signals, ['hybrid', 'office days']) then 'Hybrid'
    when list_has_any(signals, ['remote', 'remote us', 'anywhere in the us', 'distributed', 'work from home']) then 'Remote'
    when list_has_any(signals, ['onsite', 'must be located in']) then 'Onsite'
    when place <> '' and not regexp_matches(place, '\\bremote\\b|\\banywhere\\b|\\bglobal\\b|\\bworldwide\\b') then 'Onsite' else 'Unknown' end as RemoteStatus from a2),
a4 as (select *, case when RemoteStatus in ('Onsite', 'Hybrid') then 'false' when RemoteStatus = 'Unknown' then 'unknown'
    when list_has_any(countries, ['United States', 'North America', 'Americas']) then 'true' when len(countries) > 0 then 'false' else 'unknown' end as USRemoteEligible from a3),
a as (select *, array_to_string(signals, ' | ') as RemoteSignal, array_to_string(countries, ' | ') as LocationCountrySignal,
  case RemoteStatus when 'Unknown' then 'none' when 'Remote' then case when len(countries) > 0 then 'high' else 'medium' end else case when len(signals) > 0 then 'high' else 'medium' end end as RemoteConfidence,
  case RemoteStatus when 'Remote' then case USRemoteEligible when 'true' then 'LOW' when 'false' then 'HIGH' else 'MEDIUM' end when 'Unknown' then 'UNKNOWN' else 'HIGH' end as LocationRisk,
  case RemoteStatus when 'Remote' then case USRemoteEligible when 'true' then 'Remote role with US eligibility signal'
      when 'false' then 'Remote signal found, but location appears non-US or location-limited' else 'Remote role but country eligibility is unclear' end
    when 'Hybrid' then 'Hybrid or office-days signal found'
    when 'Onsite' then case when list_has_any(signals, ['must be located in', 'based in']) then 'Location-specific requirement found' else 'City-specific or onsite location signal found' end
    else case when len(countries) > 0 then 'Country or region signal found, but work arrangement is unclear' else 'Insufficient location/work arrangement signal' end end as LocationReviewReason from a4)"""

_amount = lambda n, k: f"try_cast(replace({n}, ',', '') as bigint) * case when lower({k}) = 'k' then 1000 else 1 end"
_one, _two = (_q(p) for p in fixed.SALARY_PATTERNS)
PAID = f""",
s1 as (select *, {_squeeze("replace(regexp_replace(regexp_replace(Description, '<[^>]+>', ' ', 'g'), '(?i)&nbsp;', ' ', 'g'), '&amp;', '&')")} as pay from a),
s2 as (select *, case when regexp_matches(pay, {_one}) then {_one} else {_two} end as pat from s1),
s3 as (select *, case when regexp_matches(pay, {_one}) then [regexp_extract(pay, {_one}, 0), regexp_extract(pay, {_one}, 2), regexp_extract(pay, {_one}, 3), regexp_extract(pay, {_one}, 4), regexp_extract(pay, {_one}, 5)]
  else [regexp_extract(pay, {_two}, 0), regexp_extract(pay, {_two}, 2), regexp_extract(pay, {_two}, 3), regexp_extract(pay, {_two}, 4), regexp_extract(pay, {_two}, 5)] end as m from s2),
s as (select *, m[1] <> '' as SalaryDetected, m[1] as SalaryText, case when m[1] <> '' then {_amount("m[2]", "m[3]")} end as SalaryMin, case when m[1] <> '' then {_amount("m[4]", "m[5]")} end as SalaryMax from s3)"""

_records = ", ".join(f"({r['at']}, {_q(r['title'])}, {_q(r['category'])}, {_q(r['norm'])}, {_list(r['strong'])}::varchar[], {_list(r['weak'])}::varchar[])" for r in P.watchlist())
_in = lambda words: f"list_filter(tokens, lambda x: list_contains({_list(words)}, x))"
_phrase = lambda p: f"contains(norm, {_q(' '.join(p.replace('-', ' ').split()))})"
_token = lambda p: _phrase(p) if " " in p else f"list_contains(tokens, {_q(p)})"
_cat = "regexp_replace(trim(regexp_replace(regexp_replace(replace(lower(Title), '&', ' and '), '[^A-Za-z0-9_\\s/-]', ' ', 'g'), '\\s+', ' ', 'g')), '^$', '')"
TITLED = f"""
watch(pos, wtitle, wcategory, wnorm, wstrong, wweak) as (values {_records}),
t1 as (select Title, {_title("Title")} as norm from (select distinct Title from j)),
t2 as (select *, list_filter(list_distinct(string_split(norm, ' ')), lambda x: x <> '') as tokens from t1),
t3 as (select *, {_in(fixed.STRONG_TOKENS)} as strong, {_in(fixed.WEAK_TOKENS)} as weak from t2),
t4 as (select t3.*, watch.*, list_intersect(strong, wstrong) as shared, list_intersect(weak, wweak) as shared_weak from t3, watch),
t5 as (select *, len(shared) >= 2 and len(list_filter(shared, lambda x: not list_contains({_list(fixed.PAIRED_ONLY_TOKENS)}, x))) >= 1 as usable from t4),
t6 as (select *, case when norm = wnorm then 100 when contains(norm, wnorm) then 90 when norm <> '' and contains(wnorm, norm) then 80 when usable then 75
  when len(shared) > 0 then 25 when len(shared_weak) > 0 then 10 else 0 end as score from t5),
t7 as (select * from t6 qualify row_number() over (partition by Title order by score desc, len(shared) desc, len(shared_weak) desc, length(wnorm) desc, pos) = 1),
t8 as (select *, case when norm = '' then 'none' when score = 100 then 'exact' when score = 90 then 'contains' when score >= 50 and usable then 'token' else 'none' end as TitleMatchType from t7),
t9 as (select *, case TitleMatchType when 'exact' then 100 when 'contains' then 90 when 'token' then 75 else 0 end as TitleMatchScore,
  case when TitleMatchType <> 'none' then wcategory else '' end as TitleMatchCategory, case when TitleMatchType <> 'none' then wtitle else '' end as MatchedWatchlistTitle,
  case when TitleMatchType in ('exact', 'contains') then 'high' when TitleMatchType = 'token' then 'medium' else 'none' end as TitleConfidence,
  wtitle as BestCandidateTitle, score as BestCandidateScore,
  case when score = 100 then 'Exact normalized title match' when score = 90 then 'Watchlist phrase contained in title' when score = 80 then 'Title contained in watchlist phrase'
    when len(shared) = 0 and len(shared_weak) > 0 then 'Only weak generic tokens shared' when len(shared) = 0 then 'No strong domain tokens shared'
    when not usable or score < 50 then 'Strong token overlap below threshold' else 'Strong token overlap candidate' end as MatchReason,
  {_named([(p, _phrase(p)) for p in fixed.DOMAIN_PHRASES])} as domains, {_named([(p, _token(p)) for p in fixed.SENIORITY])} as seniority,
  len({_named([(p, _token(p)) for p in fixed.LEADERSHIP])}) > 0 as TitleLeadershipSignal, len({_named([(p, _token(p)) for p in fixed.IC])}) > 0 as TitleICSignal,
  {_cat} as cat from t8),
t as (select *, case when TitleMatchType in ('exact', 'contains') or (TitleMatchType = 'token' and len(shared) >= 2) then 'STRONG_MATCH'
    when TitleMatchScore >= 60 or ((len(list_filter(strong, lambda x: not list_contains({_list(fixed.PAIRED_ONLY_TOKENS)}, x))) > 0 or len(strong) >= 2) and len({_in(fixed.ROLE_TOKENS)}) > 0) then 'POSSIBLE_MATCH'
    when len(domains) > 0 or len({_in(fixed.ADJACENT_TOKENS)}) > 0 then 'ADJACENT' when len(weak) > 0 or score > 0 then 'LOW_SIGNAL' else 'IGNORE_FOR_NOW' end as TitleReviewBucket,
  array_to_string(domains, ' | ') as TitleDomainSignal, array_to_string(seniority, ' | ') as TitleSenioritySignal,
  case when cat = '' then 'Unknown' {" ".join(f"when {_matched('cat', ps)} then {_q(n)}" for n, ps in fixed.CATEGORY_PATTERNS)} else 'Unknown' end as TitleCategory from t9)"""

_w = lambda ps: _any("w", ps)
_t = lambda *ps: _any("tt", ps)
_b = lambda *ps: _any("b", ps)
_one_if = lambda c, n: f"case when {c} then {n} else 0 end"
_pen = [
    (-35, "len(nonwriter) > 0", "'Strong non-writer title signal: ' || array_to_string(nonwriter[1:3], ', ')"),
    (-40, f"{_t('architect')} and not docs and not exc", "'Architect title without documentation/content/writing/devrel signal'"),
    (-35, f"{_t('developer', 'engineer')} and not exc and ((not devrel_title and not docs) or (devrel_title and not devrel))", "'Developer/engineer title without documentation/content/writing/devrel signal'"),
    (-50, f"({_t('therapist', 'nurse')} or {_b('clinical')}) and not writer", "'Therapist/nurse/clinical role without documentation writer signal'"),
    (-35, f"({_t('video editor', 'film editor', 'motion graphics')} or ({_t('editor')} and {_b('trainer')})) and not {_b('technical writing', 'content strategy')}", "'Video/film/editor AI trainer role without technical writing/content strategy signal'"),
    (-30, f"{_t('product designer', 'ux designer')} and not {_t('ux writer', 'content designer')}", "'Product/UX designer role without UX Writer or Content Designer exact phrase'"),
    (-25, f"{_t('support engineer', 'support specialist')} and not {_b('knowledge base', 'docs', 'documentation', 'content')}", "'Support engineer/specialist role without knowledge base/docs/content signal'"),
]
FLAGGED = f""",
d1 as (select s.*, t.* exclude (Title), array_to_string(list_filter([{_key("Company")}, {_key(_title("s.Title"))}, {_key("Location")}], lambda x: x <> ''), ':') as CompanyTitleLocationKey,
  {_url("URL")} as CanonicalURLKey from s join t on s.Title = t.Title),
d2 as (select *, array_to_string(list_filter([{_key("ATS")}, case when {_key("RawJobId")} <> '' then {_key("RawJobId")} else CompanyTitleLocationKey end], lambda x: x <> ''), ':') as JobKey,
  CanonicalURLKey <> '' and count(*) over (partition by CanonicalURLKey) > 1 as by_url, CompanyTitleLocationKey <> '' and count(*) over (partition by CompanyTitleLocationKey) > 1 as by_place from d1),
d as (select *, case when by_url and by_place then 'Both canonical URL and company/title/location' when by_url then 'Same canonical URL' when by_place then 'Same company/title/location' else '' end as DuplicateReason,
  case when by_url and by_place then CanonicalURLKey || ' | ' || CompanyTitleLocationKey when by_url then CanonicalURLKey when by_place then CompanyTitleLocationKey else '' end as DuplicateGroupKey,
  by_url or by_place as PossibleDuplicate from d2)"""
SCORED = f""",
q1 as (select *, length(trim(Description))::bigint as DescriptionLength, regexp_matches(URL, '^(?i:https?)://[^/?#]+') as URLValid, lower(regexp_extract(URL, '^[A-Za-z]+://([^/?#:]+)', 1)) as ApplyURLHost from d),
q2 as (select *, {_named([("Missing Title", "Title = ''"), ("Missing URL", "URL = ''"), ("Invalid URL", "URL <> '' and not URLValid")])} as bad,
  {_named([("Missing Company", "Company = ''"), ("Missing Description", "Description = ''"), ("Description under 100 characters", "DescriptionLength between 1 and 99"), ("RemoteStatus Unknown", "RemoteStatus = 'Unknown'"), ("Possible duplicate", "PossibleDuplicate")])} as review from q1),
q as (select *, case when len(bad) > 0 then 'BAD_ROW' when len(review) > 0 then 'REVIEW' else 'OK' end as ExportQualityFlag,
  array_to_string(case when len(bad) > 0 then bad else review end, ' | ') as ExportQualityIssues,
  array_to_string({_named([(c, f"trim({c}) = ''") for c in ("Company", "Title", "URL", "ATS")])}, ' | ') as MissingRequiredFields from q2),
f1 as (select *, {_search("Title || ' ' || MatchedWatchlistTitle || ' ' || TitleDomainSignal || ' ' || Description")} as w, {_search("Title || ' ' || Description")} as b, {_search("Title")} as tt from q),
f2 as (select *, {_t(*fixed.DEVREL_TITLE)} as devrel_title, {_w(fixed.DOCS_EVIDENCE)} as docs, {_w(fixed.WRITER_EXCEPTION)} as exc, {_t(*fixed.SEVERE_NON_WRITER)} as severe from f1),
f3 as (select *, devrel_title and {_w(fixed.DEVREL_EVIDENCE)} as devrel, {_named([(p, f"list_contains(domains, {_q(p)})") for p in fixed.SCORE_DOMAINS])}[1:5] as own_domains,
  {_named([(p, _t(p)) for p in fixed.NON_WRITER])} as nonwriter from f2),
f4 as (select *, {_w([p for p in fixed.WRITER_DOC if p not in fixed.WRITER_DOC_DEVREL])} or ({_w(fixed.WRITER_DOC_DEVREL)} and devrel) as writer from f3),
f5 as (select *, {_rank("TitleReviewBucket", fixed.BUCKET_SCORE)} + {_one_if("SalaryDetected", 5)} + {_one_if("TitleLeadershipSignal", 10)} + {_one_if("TitleICSignal", 10)} + 5 * len(own_domains)
    + case ExportQualityFlag when 'OK' then 5 when 'REVIEW' then -5 else -50 end + {_one_if("PossibleDuplicate", -5)} as base,
  {" + ".join(_one_if(c, n) for n, c, _ in _pen)} as lost, list_filter([{", ".join(f"case when {c} then {r} end" for _, c, r in _pen)}], lambda x: x is not null) as penalties from f4),
f6 as (select *, greatest(0, least(100, base + lost)) as score0 from f5),
f7 as (select *, not severe and score0 < 85 and TitleReviewBucket = 'STRONG_MATCH' and TitleMatchType <> 'none' and MatchedWatchlistTitle <> '' and writer as listed,
  not severe and score0 < 85 and {_t(*fixed.TITLE_FLOOR)} and writer as floored from f6),
f8 as (select *, case when listed or floored then 85 else score0 end as raised from f7),
f as (select *, greatest(0, least(100, base)) as WriterFitBaseScore, raised >= 60 and not writer as WriterFitGuardrailApplied, case when raised >= 60 and not writer then least(raised, 59) else raised end as WriterFitScore,
  array_to_string(penalties, ' | ') as WriterFitPenaltySignals from f8),
e as (select *, case when WriterFitScore >= 80 then 'A' when WriterFitScore >= 60 then 'B' when WriterFitScore >= 40 then 'C' when WriterFitScore >= 20 then 'D' else 'F' end as WriterFitTier,
  array_to_string(list_filter(list_concat([case TitleReviewBucket {" ".join(f"when {_q(k)} then {_q(v)}" for k, v in fixed.BUCKET_REASON.items())} end,
    case when SalaryDetected then 'Salary detected' end, case when TitleLeadershipSignal then 'Leadership title signal' end, case when TitleICSignal then 'IC title signal' end],
    list_transform(own_domains, lambda x: x || ' domain signal'),
    [case ExportQualityFlag when 'OK' then 'Export quality OK' when 'REVIEW' then 'Export quality review penalty' else 'Bad row penalty' end, case when PossibleDuplicate then 'Possible duplicate penalty' end], penalties,
    [case when listed then 'Watchlist strong title match floor' end, case when floored and not listed then 'Strong writer/docs title signal floor' end,
     case when WriterFitGuardrailApplied then 'Missing strong writer/docs signal for A/B tier' end]), lambda x: x is not null), ' | ') as WriterFitReasons from f)"""
ENRICHED = ARRANGED + PAID + "," + TITLED + FLAGGED + SCORED


def jobs(spark, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.JOBS)


def enriched(spark, sf_dir: str) -> DataFrame:
    return P.enriched(jobs(spark, sf_dir))


def won(spark, sf_dir: str) -> DataFrame:
    return P.winners(enriched(spark, sf_dir).select("seq", *P.KEYED_BY, *P.PREFERRED_BY))


# ---- row-level operators

@query(f"with {ARRANGED} select seq, RemoteStatus, RemoteSignal, RemoteConfidence, LocationCountrySignal, USRemoteEligible from a")
def c6_work_arrangement(spark, sf_dir):
    return P.with_arrangement(jobs(spark, sf_dir)).select("seq", "RemoteStatus", "RemoteSignal", "RemoteConfidence", "LocationCountrySignal", "USRemoteEligible")


@query(f"with {ARRANGED} select seq, USRemoteEligible, LocationRisk, LocationReviewReason from a")
def c7_location_risk(spark, sf_dir):
    return P.with_arrangement(jobs(spark, sf_dir)).select("seq", "USRemoteEligible", "LocationRisk", "LocationReviewReason")


@query(f"with {ARRANGED}{PAID} select seq, SalaryDetected, SalaryMin, SalaryMax, case when SalaryDetected then 'USD' else '' end as SalaryCurrency, "
       "case when coalesce(greatest(SalaryMin, SalaryMax), 0) > 20000 then 'annual' else '' end as SalaryPeriod, SalaryText from s")
def c8_salary(spark, sf_dir):
    return P.with_salary(jobs(spark, sf_dir)).select("seq", "SalaryDetected", "SalaryMin", "SalaryMax", "SalaryCurrency", "SalaryPeriod", "SalaryText")


_J = f"j as ({views.plain(views.JOBS)})"


@query(f"with {_J},{TITLED} select Title, TitleMatchType, TitleMatchScore::bigint as TitleMatchScore, TitleMatchCategory, MatchedWatchlistTitle, TitleConfidence, BestCandidateTitle, BestCandidateScore::bigint as BestCandidateScore, MatchReason, norm as NormalizedTitle from t")
def c1_title_match(spark, sf_dir):
    found = P.title_matches(jobs(spark, sf_dir).select("Title").distinct())
    return found.select("Title", "TitleMatchType", F.col("TitleMatchScore").cast("long").alias("TitleMatchScore"), "TitleMatchCategory", "MatchedWatchlistTitle", "TitleConfidence", "BestCandidateTitle", F.col("BestCandidateScore").cast("long").alias("BestCandidateScore"), "MatchReason", "NormalizedTitle")


@query(f"with {_J},{TITLED} select Title, TitleReviewBucket, ({_rank('TitleReviewBucket', {b: i + 1 for i, b in enumerate(fixed.BUCKETS)})})::bigint as TitleReviewPriority, TitleDomainSignal, TitleSenioritySignal, TitleLeadershipSignal, TitleICSignal from t")
def c3_title_review(spark, sf_dir):
    found = P.title_reviews(P.title_matches(jobs(spark, sf_dir).select("Title").distinct()))
    return found.select("Title", "TitleReviewBucket", F.col("TitleReviewPriority").cast("long").alias("TitleReviewPriority"), "TitleDomainSignal", "TitleSenioritySignal", "TitleLeadershipSignal", "TitleICSignal")


@query(f"with {_J},{TITLED} select Title, TitleCategory from t")
def c5_title_category(spark, sf_dir):
    return jobs(spark, sf_dir).select("Title").distinct().withColumn("TitleCategory", P.title_category(F.col("Title")))


@query(f"with {ENRICHED} select seq, JobKey, CompanyTitleLocationKey, CanonicalURLKey, PossibleDuplicate, DuplicateReason, DuplicateGroupKey from d")
def w1_duplicate_flags(spark, sf_dir):
    return P.with_duplicate_flags(jobs(spark, sf_dir)).select("seq", "JobKey", "CompanyTitleLocationKey", "CanonicalURLKey", "PossibleDuplicate", "DuplicateReason", "DuplicateGroupKey")


@query(f"with {ENRICHED} select seq, ExportQualityFlag, ExportQualityIssues, MissingRequiredFields, DescriptionLength, URLValid, ApplyURLHost from q")
def c9_quality(spark, sf_dir):
    return P.graded(jobs(spark, sf_dir)).select("seq", "ExportQualityFlag", "ExportQualityIssues", "MissingRequiredFields", "DescriptionLength", "URLValid", "ApplyURLHost")


@query(f"with {ENRICHED} select seq, WriterFitBaseScore::bigint as WriterFitBaseScore, WriterFitScore::bigint as WriterFitScore, WriterFitTier, WriterFitReasons, WriterFitPenaltySignals, WriterFitGuardrailApplied from e")
def c10_writer_fit(spark, sf_dir):
    return enriched(spark, sf_dir).select("seq", F.col("WriterFitBaseScore").cast("long").alias("WriterFitBaseScore"), F.col("WriterFitScore").cast("long").alias("WriterFitScore"), "WriterFitTier", "WriterFitReasons", "WriterFitPenaltySignals", "WriterFitGuardrailApplied")


# ---- the same rules over whole documents as descriptions

_documents = lambda sql: sql.replace(views.plain(views.JOBS), views.plain(views.DOCUMENT_JOBS))


def document_jobs(spark, sf_dir: str) -> DataFrame:
    return views.view(spark, sf_dir, views.DOCUMENT_JOBS)


@query(_documents(SQL["c6_work_arrangement"]))
def c6_arrangement_in_documents(spark, sf_dir):
    return P.with_arrangement(document_jobs(spark, sf_dir)).select("seq", "RemoteStatus", "RemoteSignal", "RemoteConfidence", "LocationCountrySignal", "USRemoteEligible")


@query(_documents(SQL["c8_salary"]))
def c8_salary_in_documents(spark, sf_dir):
    return P.with_salary(document_jobs(spark, sf_dir)).select("seq", "SalaryDetected", "SalaryMin", "SalaryMax", "SalaryCurrency", "SalaryPeriod", "SalaryText")


@query(_documents(SQL["c10_writer_fit"]))
def c10_fit_in_documents(spark, sf_dir):
    return P.enriched(document_jobs(spark, sf_dir)).select("seq", F.col("WriterFitBaseScore").cast("long").alias("WriterFitBaseScore"), F.col("WriterFitScore").cast("long").alias("WriterFitScore"), "WriterFitTier", "WriterFitReasons", "WriterFitPenaltySignals", "WriterFitGuardrailApplied")


# ---- summaries

_n = lambda c: f"count(*) filter ({c})"
_S = {
    "RemoteCount": "RemoteStatus = 'Remote'", "HybridCount": "RemoteStatus = 'Hybrid'", "OnsiteCount": "RemoteStatus = 'Onsite'", "USRemoteEligibleCount": "USRemoteEligible = 'true'",
    "SalaryDetectedCount": "SalaryDetected", "StrongTitleCount": "TitleReviewBucket = 'STRONG_MATCH'", "BadRowCount": "ExportQualityFlag = 'BAD_ROW'", "ReviewCount": "ExportQualityFlag = 'REVIEW'",
    "PossibleDuplicateCount": "PossibleDuplicate", "TierACount": "WriterFitTier = 'A'", "TierBCount": "WriterFitTier = 'B'", "GuardrailCount": "WriterFitGuardrailApplied",
}
_sums = ", ".join(f"{_n(c)} as {n}" for n, c in _S.items())


def _counts() -> list:
    return [F.count_if(F.expr(c)).alias(n) for n, c in _S.items()]


@query(f"with {ENRICHED} select ATS, count(*) as TotalJobs, count(distinct Company) as Companies, {_sums}, round(avg(WriterFitScore), 2) as AverageScore from e group by ATS")
def a11_ats_summary(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("ATS").agg(F.count("*").alias("TotalJobs"), F.count_distinct("Company").alias("Companies"), *_counts(), F.round(F.avg("WriterFitScore"), 2).alias("AverageScore"))


def dimension(spark, column: str, values: list[str]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{column} string, place long"))


@query(f"with {ENRICHED}, dim as (select unnest({_list(fixed.BUCKETS)}) as TitleReviewBucket) select TitleReviewBucket, count(e.seq) as Count, count(distinct norm) as UniqueTitles, "
       "coalesce(array_to_string(list_sort(list(distinct nullif(Title, '')))[1:10], ' | '), '') as ExampleTitles from dim left join e using (TitleReviewBucket) group by 1")
def a2_bucket_summary(spark, sf_dir):
    rows = P.with_titles(jobs(spark, sf_dir)).groupBy("TitleReviewBucket", "NormalizedTitle", "Title").agg(F.count("*").alias("n"))
    found = rows.groupBy("TitleReviewBucket").agg(F.sum("n").alias("n"), F.count_distinct("NormalizedTitle").alias("u"))
    out = dimension(spark, "TitleReviewBucket", fixed.BUCKETS).join(found, "TitleReviewBucket", "left").join(first_values(rows, ["TitleReviewBucket"], "Title", "ExampleTitles"), "TitleReviewBucket", "left")
    return out.select("TitleReviewBucket", F.coalesce("n", F.lit(0)).alias("Count"), F.coalesce("u", F.lit(0)).alias("UniqueTitles"), F.coalesce("ExampleTitles", F.lit("")).alias("ExampleTitles"))


@query(f"with {ENRICHED} select Title, count(*) as Count, count(distinct Company) as Companies, any_value(BestCandidateTitle) as BestCandidateTitle, any_value(BestCandidateScore)::bigint as BestCandidateScore, any_value(MatchReason) as MatchReason from e where TitleMatchType = 'none' group by Title")
def a3_unmatched_titles(spark, sf_dir):
    own = P.with_titles(jobs(spark, sf_dir)).where("TitleMatchType = 'none'")
    return own.groupBy("Title").agg(F.count("*").alias("Count"), F.count_distinct("Company").alias("Companies"), F.first("BestCandidateTitle").alias("BestCandidateTitle"), F.first("BestCandidateScore").cast("long").alias("BestCandidateScore"), F.first("MatchReason").alias("MatchReason"))


_states = ["Remote", "Hybrid", "Onsite", "Unknown"]


@query(f"with {ARRANGED}, dim as (select unnest({_list(_states)}) as RemoteStatus) select RemoteStatus, count(a.seq) as Count, {_n(chr(85) + 'SRemoteEligible = ' + _q('true'))} as Eligible, {_n('USRemoteEligible = ' + _q('false'))} as NotEligible, {_n('USRemoteEligible = ' + _q('unknown'))} as Unclear from dim left join a using (RemoteStatus) group by 1")
def a4_remote_summary(spark, sf_dir):
    found = P.with_arrangement(jobs(spark, sf_dir)).groupBy("RemoteStatus").agg(F.count("*").alias("Count"), *[F.count_if(F.col("USRemoteEligible") == v).alias(n) for n, v in (("Eligible", "true"), ("NotEligible", "false"), ("Unclear", "unknown"))])
    return dimension(spark, "RemoteStatus", _states).join(found, "RemoteStatus", "left").na.fill(0).drop("place")


@query(f"with {ARRANGED}{PAID}, dim as (select unnest([true, false]) as SalaryDetected) select SalaryDetected, count(s.seq) as Count, min(least(SalaryMin, SalaryMax)) as Lowest, max(greatest(SalaryMin, SalaryMax)) as Highest from dim left join s using (SalaryDetected) group by 1")
def a5_salary_summary(spark, sf_dir):
    found = P.with_salary(jobs(spark, sf_dir)).groupBy("SalaryDetected").agg(F.count("*").alias("Count"), F.min(F.least("SalaryMin", "SalaryMax")).alias("Lowest"), F.max(F.greatest("SalaryMin", "SalaryMax")).alias("Highest"))
    both = F.broadcast(spark.createDataFrame([(True,), (False,)], "SalaryDetected boolean"))
    return both.join(found, "SalaryDetected", "left").select("SalaryDetected", F.coalesce("Count", F.lit(0)).alias("Count"), "Lowest", "Highest")


_flags = ["OK", "REVIEW", "BAD_ROW"]


@query(f"with {ENRICHED}, dim as (select unnest({_list(_flags)}) as ExportQualityFlag) select ExportQualityFlag, count(q.seq) as Count from dim left join q using (ExportQualityFlag) group by 1")
def a6_quality_summary(spark, sf_dir):
    found = P.graded(jobs(spark, sf_dir)).groupBy("ExportQualityFlag").agg(F.count("*").alias("Count"))
    return dimension(spark, "ExportQualityFlag", _flags).join(found, "ExportQualityFlag", "left").na.fill(0).drop("place")


_tiers = ["A", "B", "C", "D", "F"]


@query(f"with {ENRICHED}, dim as (select unnest({_list(_tiers)}) as WriterFitTier) select WriterFitTier, count(e.seq) as Count, min(WriterFitScore)::bigint as MinScore, max(WriterFitScore)::bigint as MaxScore, round(avg(WriterFitScore), 2) as AverageScore, "
       "coalesce(array_to_string(list_sort(list(distinct nullif(Title, '')))[1:10], ' | '), '') as ExampleTitles from dim left join e using (WriterFitTier) group by 1")
def a7_fit_tier_summary(spark, sf_dir):
    # a row for each tier and title, from which both the counts and the titles come: stored, or the postings would be worked out for either
    rows = enriched(spark, sf_dir).groupBy("WriterFitTier", "Title").agg(F.count("*").alias("n"), F.min("WriterFitScore").alias("low"), F.max("WriterFitScore").alias("high"), F.sum("WriterFitScore").alias("sum"))
    rows = stored(rows, "tiers")
    found = rows.groupBy("WriterFitTier").agg(F.sum("n").alias("Count"), F.min("low").cast("long").alias("MinScore"), F.max("high").cast("long").alias("MaxScore"), F.round(F.sum("sum") / F.sum("n"), 2).alias("AverageScore"))
    out = dimension(spark, "WriterFitTier", _tiers).join(found, "WriterFitTier", "left").join(first_values(rows, ["WriterFitTier"], "Title", "ExampleTitles"), "WriterFitTier", "left")
    return out.na.fill(0, ["Count"]).na.fill("", ["ExampleTitles"]).drop("place")


@query(f"with {ENRICHED} select count(*) as TotalRows, {_n('PossibleDuplicate')} as PossibleDuplicateCount, count(distinct nullif(DuplicateGroupKey, '')) as DuplicateGroupCount, {_n('by_url')} as CanonicalURLDuplicateCount, {_n('by_place')} as CompanyTitleLocationDuplicateCount from d")
def a8_duplicate_summary(spark, sf_dir):
    reason = F.col("DuplicateReason")
    return P.with_duplicate_flags(jobs(spark, sf_dir)).agg(
        F.count("*").alias("TotalRows"), F.count_if(F.col("PossibleDuplicate")).alias("PossibleDuplicateCount"), F.count_distinct(F.nullif("DuplicateGroupKey", F.lit(""))).alias("DuplicateGroupCount"),
        F.count_if(reason.contains("canonical URL")).alias("CanonicalURLDuplicateCount"), F.count_if(reason.contains("company/title/location")).alias("CompanyTitleLocationDuplicateCount"),
    )


# ---- slices and choice among duplicates

_focus = "(WriterFitTier in ('A', 'B', 'C') or TitleReviewBucket in ('STRONG_MATCH', 'POSSIBLE_MATCH', 'ADJACENT'))"
_strong = "(WriterFitTier in ('A', 'B') or TitleReviewBucket = 'STRONG_MATCH')"
_usr = "(USRemoteEligible = 'true' and RemoteStatus = 'Remote')"
_slices = _named([
    ("firehose", "true"), ("writer-focus", _focus), ("strong-matches", _strong), ("remote-us-likely", _usr), ("remote-writer-focus", f"{_usr} and {_focus}"), ("salary-detected", "SalaryDetected"),
    ("review-needed", "ExportQualityFlag = 'REVIEW' or PossibleDuplicate"), ("demoted-high-score", "(WriterFitGuardrailApplied or WriterFitPenaltySignals <> '') and WriterFitBaseScore >= 75"), ("top", _strong),
])


@query(f"with {ENRICHED} select seq, unnest({_slices}) as SliceName from e")
def f4_slice_membership(spark, sf_dir):
    return enriched(spark, sf_dir).select("seq", F.explode(P.slices()).alias("SliceName"))


@query(f"with {ENRICHED}, m as (select *, unnest({_slices}) as SliceName from e) select SliceName, count(*) as Rows, count(distinct Company) as Companies, count(distinct norm) as UniqueTitles, {_sums} from m group by SliceName")
def a12_slice_summary(spark, sf_dir):
    rows = enriched(spark, sf_dir).withColumn("SliceName", F.explode(P.slices()))
    return rows.groupBy("SliceName").agg(F.count("*").alias("Rows"), F.count_distinct("Company").alias("Companies"), F.count_distinct("NormalizedTitle").alias("UniqueTitles"), *_counts())


@query(f"with {ENRICHED} select seq, row_number() over (order by WriterFitScore desc, {_rank('TitleReviewBucket', {b: i + 1 for i, b in enumerate(fixed.BUCKETS)})}, case USRemoteEligible when 'true' then 0 else 1 end, case when SalaryDetected then 0 else 1 end, lower(Company), lower(Title), seq) as top_place from e where {_strong} qualify top_place <= 500")
def o1_top_rows(spark, sf_dir):
    """The 500 best postings: a top-k report, so that the limit is the feature."""
    order = [F.col("WriterFitScore").desc(), "TitleReviewPriority", F.when(F.col("USRemoteEligible") == "true", 0).otherwise(1), F.when(F.col("SalaryDetected"), 0).otherwise(1), F.lower("Company"), F.lower("Title"), "seq"]
    top = enriched(spark, sf_dir).where(P.strong_match()).orderBy(*order).limit(500)
    return top.withColumn("top_place", F.row_number().over(Window.orderBy(*order)).cast("long")).select("seq", "top_place")


_keys = """keys as (select seq, unnest(case when DuplicateGroupKey <> '' or CanonicalURLKey <> '' then list_filter([case when DuplicateGroupKey <> '' then 'duplicate:' || DuplicateGroupKey end, case when CanonicalURLKey <> '' then 'canonical:' || CanonicalURLKey end], lambda x: x is not null)
  else ['fallback:' || coalesce(nullif(CompanyTitleLocationKey, ''), nullif(JobKey, ''), nullif(trim(URL), ''), 'row-' || seq)] end) as k from e)"""
_components = f"""{_keys}, heads as (select k, min(seq) as head from keys group by k having count(*) > 1), links as materialized (select distinct seq, head from keys join heads using (k) where seq <> head),
both_ as materialized (select seq as a, head as b from links union select head, seq from links),
reach(x, y) as (select seq, seq from e union select reach.x, both_.b from reach join both_ on both_.a = reach.y), comp as (select x as seq, min(y) as component from reach group by x)"""


@query(f"with {ENRICHED}, {_keys} select seq, string_agg(k, ' ; ' order by k) as keys from keys group by seq")
def w2_dedupe_keys(spark, sf_dir):
    return P.dedupe_keys(P.with_duplicate_flags(jobs(spark, sf_dir))).select("seq", F.array_join(F.array_sort("keys"), " ; ").alias("keys"))


@query(f"with recursive {ENRICHED}, {_components} select seq, component from comp")
def w3_components(spark, sf_dir):
    ensure_checkpoints(spark)
    return P.components(P.dedupe_keys(P.with_duplicate_flags(jobs(spark, sf_dir))).select("seq", "keys")).select(F.col("id").alias("seq"), "component")


_prefer = f"""WriterFitScore desc, {_rank("WriterFitTier", fixed.TIER_RANK)}, {_rank("ExportQualityFlag", fixed.QUALITY_RANK)}, case USRemoteEligible when 'true' then 1 when 'unknown' then 2 else 3 end, {_rank("RemoteStatus", fixed.REMOTE_RANK)},
case when SalaryDetected then 0 else 1 end, {_rank("ATS", fixed.ATS_RANK)}, DatePosted desc, case when regexp_matches(Company, '^(?i:careers?|jobs?)\\b') then 1 else 0 end, lower(Company), lower(Title), seq"""
_won = f"{_components}, won as (select e.*, component, count(*) over (partition by component) as DedupeGroupSize, row_number() over (partition by component order by {_prefer}) as DedupeRank from e join comp using (seq))"


@query(f"with recursive {ENRICHED}, {_won} select seq, component, DedupeGroupSize, DedupeRank, DedupeRank = 1 as DedupeSelected from won")
def w5_winners(spark, sf_dir):
    ensure_checkpoints(spark)
    return won(spark, sf_dir).select("seq", "component", "DedupeGroupSize", F.col("DedupeRank").cast("long").alias("DedupeRank"), "DedupeSelected")


@query(f"with recursive {ENRICHED}, {_won}, w as (select component, seq as SelectedSeq, 'Selected from ' || DedupeGroupSize || ' rows | WriterFitScore ' || WriterFitScore || ' | tier ' || WriterFitTier || ' | quality ' || ExportQualityFlag || ' | ATS ' || ATS as SelectionReason from won where DedupeRank = 1) "
       "select component, DedupeGroupSize, DedupeRank, seq as RejectedSeq, SelectedSeq, SelectionReason, ATS || ' / ' || Company || ' / ' || coalesce(nullif(Title, ''), 'unknown title') || ' / ' || WriterFitScore || ' / ' || WriterFitTier || case when URL <> '' then ' / ' || URL else '' end as RejectedRow from won join w using (component) where DedupeRank > 1")
def w6_decisions(spark, sf_dir):
    """A row for each rejected posting; a component's rejected rows are never gathered."""
    ensure_checkpoints(spark)
    rows = won(spark, sf_dir).where("DedupeGroupSize > 1")
    reason = F.concat(F.lit("Selected from "), "DedupeGroupSize", F.lit(" rows | WriterFitScore "), "WriterFitScore", F.lit(" | tier "), "WriterFitTier", F.lit(" | quality "), "ExportQualityFlag", F.lit(" | ATS "), "ATS")
    line = F.concat_ws(" / ", "ATS", "Company", F.coalesce(F.nullif("Title", F.lit("")), F.lit("unknown title")), "WriterFitScore", "WriterFitTier", F.nullif("URL", F.lit("")))
    first = rows.where("DedupeRank = 1").select("component", F.col("seq").alias("SelectedSeq"), reason.alias("SelectionReason"))
    return rows.where("DedupeRank > 1").join(first, "component").select("component", "DedupeGroupSize", F.col("DedupeRank").cast("long").alias("DedupeRank"), F.col("seq").alias("RejectedSeq"), "SelectedSeq", "SelectionReason", line.alias("RejectedRow"))


@query(f"with {ENRICHED}, place as (select CompanyTitleLocationKey, list(distinct ATS) as own_ats from d where CompanyTitleLocationKey <> '' group by 1), url as (select CanonicalURLKey, list(distinct ATS) as own_ats from d where CanonicalURLKey <> '' group by 1), "
       f"u as (select seq, list_distinct(list_concat([ATS], coalesce(place.own_ats, []), coalesce(url.own_ats, []))) as own from d left join place using (CompanyTitleLocationKey) left join url using (CanonicalURLKey)) select seq, len(own)::bigint as SourceATSCount, len(own) > 1 as CrossATSDuplicate, array_to_string(list_filter({_list(fixed.ATS)}, lambda x: list_contains(own, x)), ' | ') as SourceATSList from u")
def j14_cross_ats(spark, sf_dir):
    df = P.with_keys(jobs(spark, sf_dir))
    out = df
    for key, name in (("CompanyTitleLocationKey", "_place"), ("CanonicalURLKey", "_url")):
        own = df.where(F.col(key) != "").groupBy(F.col(key).alias("_k")).agg(F.collect_set("ATS").alias(name))
        out = out.withColumn("_k", spread_key(F.col(key), "seq")).join(own, "_k", "left").drop("_k")
    none = F.array().cast("array<string>")
    own = F.array_distinct(F.concat(F.array("ATS"), F.coalesce("_place", none), F.coalesce("_url", none)))
    listed = F.filter(F.array(*[F.lit(a) for a in fixed.ATS]), lambda a: F.array_contains(F.col("_own"), a))
    return out.withColumn("_own", own).select("seq", F.size("_own").cast("long").alias("SourceATSCount"), (F.size("_own") > 1).alias("CrossATSDuplicate"), F.array_join(listed, " | ").alias("SourceATSList"))


# ---- pages

@query("select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '\\s+', ' ', 'g')) as text from pages")
def x16_strip_html(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", text.strip_html(F.col("html")).alias("text"))


@query(f"select page_id, {_url('url')} as CanonicalURLKey, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) as host, regexp_matches(url, '^(?i:https?)://[^/?#]+') as valid from pages")
def x9_url_keys(spark, sf_dir):
    url = F.col("url")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", text.canonical_url(url).alias("CanonicalURLKey"), text.url_host(url).alias("host"), text.is_web_url(url).alias("valid"))
