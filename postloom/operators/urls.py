"""Links of postings: unwrapping, ids in them, company keys, and what a checked link is worth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import text

#: Words that a company's key leaves out, hosts of one provider's boards, and what dead links and pages look like.
KEY_LESS = ["inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "technologies", "technology", "labs", "group", "holdings", "ai"]
BOARD_HOSTS = ["boards.greenhouse.io", "job-boards.greenhouse.io"]
DEAD_URLS = [r"[?&]error=true(?:&|$)", r"/404(?:/|$)", r"/not-found(?:/|$)", r"/job-not-found(?:/|$)"]
DEAD_PAGES = [
    r"\bjob (?:is )?no longer available\b", r"\bposting (?:is )?no longer available\b", r"\bposition (?:has been )?filled\b", r"\bjob not found\b", r"\bpage not found\b", r"\bthis job is closed\b",
    r"\bthis position is closed\b", r"\bno longer accepting applications\b",
]
#: Issues of a checked link that won't go away.
FINAL_ISSUES = ["Final URL matches a known expired/error page pattern.", "URL is on the reviewed confirmed-dead job URL list.", "Page text matches a known closed/not-found job pattern."]


def normal_url(value: Column) -> Column:
    """A link out of a spreadsheet formula; hosts without a scheme get https://."""
    raw = text.squeezed(F.coalesce(value, F.lit("")))
    inside = F.regexp_extract(raw, r'(?i)^=HYPERLINK\(\s*"([^"]+)"', 1)
    url = F.when(inside != "", inside).otherwise(raw)
    return F.when(url.rlike(r"(?i)^https?://"), url).when(url.rlike(r"(?i)^[\w.-]+\.[a-z]{2,}(?:/|$)"), F.concat(F.lit("https://"), url)).otherwise(url)


def url_lookup_key(value: Column) -> Column:
    return F.lower(F.regexp_replace(normal_url(value), "/+$", ""))


def _path(url: Column) -> Column:
    """The segments of a URL's path that aren't empty."""
    return F.filter(F.split(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1), "/"), lambda x: x != "")


def board_job_id(url: Column) -> Column:
    """The segment after `jobs` of a board's link, else empty."""
    parts = _path(url)
    at = F.array_position(parts, "jobs")
    found = F.when(at > 0, F.coalesce(F.get(parts, at.cast("int")), F.lit(""))).otherwise("")
    return F.when(text.url_host(url).isin(BOARD_HOSTS), found).otherwise("")


def board_slug(url: Column) -> Column:
    """The segment before `jobs`, else the first one."""
    parts = _path(url)
    at = F.array_position(parts, "jobs")
    found = F.when(at > 1, F.get(parts, (at - 2).cast("int"))).otherwise(F.get(parts, F.lit(0)))
    return F.when(text.url_host(url).isin(BOARD_HOSTS), F.coalesce(found, F.lit(""))).otherwise("")


def company_key(value: Column) -> Column:
    """Words without punctuation and legal or industry words, run together."""
    plain = F.regexp_replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), r"[-!\"#$%&'()*+,./:;<=>?@\[\\\]^`{|}~_]", " ")
    return F.array_join(F.filter(F.split(plain, r"\s+"), lambda w: (w != "") & ~w.isin(KEY_LESS)), "")


def verdicts(checks: DataFrame) -> DataFrame:
    """checks (OriginalURL, FinalURL, HttpStatus, Page) with what is wrong with each link, empty if nothing is."""
    final, was, now = F.coalesce("FinalURL", F.lit("")), board_job_id(F.col("OriginalURL")), board_job_id(F.col("FinalURL"))
    any_of = lambda c, ps: F.coalesce(c.rlike("(?i)" + "|".join(ps)), F.lit(False))
    issue = (
        F.when(~F.col("HttpStatus").between(200, 299), F.concat(F.lit("HTTP "), "HttpStatus")).when(any_of(final, DEAD_URLS), "Final URL matches a known expired/error page pattern.")
        .when(~final.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"), "Could not parse final URL").when((was != "") & (now != "") & (was != now), F.concat(F.lit("Greenhouse job URL redirected to a different job id ("), now, F.lit(").")))
        .when((was != "") & (now == "") & text.url_host(F.col("FinalURL")).isin(BOARD_HOSTS), "Greenhouse job URL redirected to the company board instead of the job detail page.")
        .when(any_of(F.col("Page"), DEAD_PAGES), "Page text matches a known closed/not-found job pattern.").otherwise("")
    )
    return checks.withColumn("Issue", issue)


def slug_from_url(ats: Column, url: Column) -> Column:
    """The slug that a board's address says, by its provider; empty if it says none."""
    value = text.clean(url)
    host, parts = F.lower(F.regexp_extract(value, r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1)), _path(value)
    first = F.coalesce(F.get(parts, F.lit(0)), F.lit(""))
    at = F.array_position(parts, "boards")
    greenhouse = F.when(at > 0, F.coalesce(F.get(parts, at.cast("int")), first)).otherwise(first)
    tenant = F.regexp_extract(host, r"^([^.]+)\.(wd\d+)\.myworkdayjobs\.com$", 1)
    segment = F.regexp_extract(host, r"^([^.]+)\.(wd\d+)\.myworkdayjobs\.com$", 2)
    at_ = lambda k: F.coalesce(F.get(parts, F.lit(k)), F.lit(""))
    service = (first == "wday") & (at_(1) == "cxs") & (at_(2) != "") & (at_(3) != "")
    workday = F.when((tenant == "") | (first == ""), "").when(service, F.concat_ws("|", at_(2), segment, at_(3))).otherwise(F.concat_ws("|", tenant, segment, first))
    name = F.lower(ats)
    found = (
        F.when(name.isin("ashby", "lever"), first).when(name == "greenhouse", greenhouse).when(name == "bamboohr", F.regexp_extract(host, r"^([^.]+)\.bamboohr\.com$", 1))
        .when(name == "icims", F.regexp_replace(F.split_part(host, F.lit("."), F.lit(1)), "^careers-", "")).when(name == "workday", workday).otherwise("")
    )
    return F.when(host != "", found).otherwise("")


def workday_urls(slug: Column, source: Column) -> tuple[Column, Column]:
    """The address that a Workday board is fetched from, and the one it is shown at, from its slug and an address given."""
    direct = text.clean(source)
    said = F.coalesce(F.nullif(slug_from_url(F.lit("workday"), direct), F.lit("")), text.clean(slug))
    parts = F.filter(F.transform(F.split(said, r"\|"), text.clean), lambda x: x != "")
    ok = (F.size(parts) >= 3) & F.coalesce(F.get(parts, F.lit(1)).rlike(r"(?i)^wd\d+$"), F.lit(False))
    host = F.concat(F.lit("https://"), F.get(parts, F.lit(0)), F.lit("."), F.get(parts, F.lit(1)), F.lit(".myworkdayjobs.com"))
    service = F.contains(direct, F.lit("/wday/cxs/"))
    fetch = F.when((direct != "") & service, F.split_part(direct, F.lit("?"), F.lit(1))).when(ok, F.concat(host, F.lit("/wday/cxs/"), F.get(parts, F.lit(0)), F.lit("/"), F.get(parts, F.lit(2)), F.lit("/jobs"))).otherwise("")
    board = F.when((direct != "") & ~service, direct).when(ok, F.concat(host, F.lit("/"), F.get(parts, F.lit(2)))).otherwise(direct)
    return fetch, board


def prunable(status: Column, issue: Column) -> Column:
    """Whether a checked link failed for good."""
    said = F.coalesce(issue, F.lit(""))
    final = said.rlike(r"^HTTP (404|410)\b") | said.isin(*FINAL_ISSUES) | said.startswith("Greenhouse job URL redirected")
    return F.coalesce(status.isin("Missing URL", "Invalid URL") | ((status == "Bad") & final), F.lit(False))


def kept_after_check(ok: Column, status: Column, issue: Column, safe: bool) -> Column:
    """Rows that stay: links that work, and in safe mode those that didn't fail for good."""
    return (ok == "Yes") | (~prunable(status, issue) if safe else F.lit(False))


def shown_company(value: Column) -> Column:
    """A company's name in title case: cut at a bar, punctuation as spaces, words that begin with a digit as they are."""
    cut = F.regexp_replace(text.clean(value), r"\|.*$", "")
    words = F.split(text.squeezed(F.translate(cut, text.PUNCTUATION + "&", " " * (len(text.PUNCTUATION) + 1))), " ")
    return F.array_join(F.transform(words, lambda w: F.when(w.rlike(r"^\d"), w).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2)))))), " ")
