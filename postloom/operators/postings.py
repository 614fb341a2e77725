"""Postings: arrangement, pay, title match, review, duplicate flags, quality, fit score and choice among duplicates.

Each operator takes a DataFrame and returns it with columns added; all are built-in expressions, so that one
scan feeds one projection. Titles repeat far more than postings, so the title operators work on distinct
titles and join back; where whole texts repeat, enriched() and graded() do so with all rules that read only these.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import fixed, text
from postloom.functions.folders import ensure_checkpoints, stored
from postloom.operators.ordering import ranked_within, spread_key


def _named(pairs: list[tuple[str, Column]]) -> Column:
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in pairs]), lambda x: x.isNotNull())


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that later filters and projections read instead of computing it again.

    The optimizer copies an expression into every filter above it; not so the output of a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_arrangement(jobs: DataFrame) -> DataFrame:
    """RemoteStatus, RemoteSignal, RemoteConfidence, LocationCountrySignal, USRemoteEligible, LocationRisk and LocationReviewReason."""
    hay = text.squeezed(F.lower(F.concat_ws(" ", *[text.clean(F.col(c)) for c in ("Title", "Location", "Description")])))
    place = text.squeezed(F.lower(text.clean(F.col("Location"))))
    df = pinned(jobs.withColumn("_place", place), "_hay", hay)
    df = pinned(df, "_signals", _named([(n, text.matches(F.col("_hay"), p)) for n, p in fixed.REMOTE_SIGNALS]))
    has = lambda n: F.array_contains("_signals", n)
    us = has("remote us") | has("anywhere in the us")
    first = [(n, text.matches(F.col("_hay"), p) | us if n == "United States" else text.matches(F.col("_hay"), p)) for n, p in fixed.COUNTRY_SIGNALS]
    df = pinned(df, "_countries", _named(first))
    city = (F.col("_place") != "") & ~text.matches(F.col("_place"), r"\bremote\b|\banywhere\b|\bglobal\b|\bworldwide\b")
    any_of = lambda *ns: F.arrays_overlap("_signals", F.array(*[F.lit(n) for n in ns]))
    status = (
        F.when(any_of("hybrid", "office days"), "Hybrid")
        .when(any_of("remote", "remote us", "anywhere in the us", "distributed", "work from home"), "Remote")
        .when(any_of("onsite", "must be located in"), "Onsite")
        .when(city, "Onsite")
        .otherwise("Unknown")
    )
    df = pinned(df, "RemoteStatus", status)
    remote, placed = F.col("RemoteStatus") == "Remote", F.col("RemoteStatus").isin("Onsite", "Hybrid")
    some = F.size("_countries") > 0
    wide = F.arrays_overlap("_countries", F.array(F.lit("United States"), F.lit("North America"), F.lit("Americas")))
    eligible = F.when(placed, "false").when(remote & wide, "true").when(remote & some, "false").otherwise("unknown")
    df = pinned(df, "USRemoteEligible", eligible)
    yes, no = F.col("USRemoteEligible") == "true", F.col("USRemoteEligible") == "false"
    confidence = F.when(F.col("RemoteStatus") == "Unknown", "none").when(remote & some, "high").when(remote, "medium").when(F.size("_signals") > 0, "high").otherwise("medium")
    risk = F.when(remote & yes, "LOW").when(remote & no, "HIGH").when(remote, "MEDIUM").when(placed, "HIGH").otherwise("UNKNOWN")
    reason = (
        F.when(remote & yes, "Remote role with US eligibility signal")
        .when(remote & no, "Remote signal found, but location appears non-US or location-limited")
        .when(remote, "Remote role but country eligibility is unclear")
        .when(F.col("RemoteStatus") == "Hybrid", "Hybrid or office-days signal found")
        .when((F.col("RemoteStatus") == "Onsite") & any_of("must be located in", "based in"), "Location-specific requirement found")
        .when(F.col("RemoteStatus") == "Onsite", "City-specific or onsite location signal found")
        .when(some, "Country or region signal found, but work arrangement is unclear")
        .otherwise("Insufficient location/work arrangement signal")
    )
    return df.withColumns({
        "RemoteConfidence": confidence, "LocationRisk": risk, "LocationReviewReason": reason,
        "RemoteSignal": F.array_join("_signals", " | "), "LocationCountrySignal": F.array_join("_countries", " | "),
    }).drop("_hay", "_place", "_signals", "_countries")


def with_salary(jobs: DataFrame) -> DataFrame:
    """SalaryDetected, SalaryMin, SalaryMax, SalaryCurrency, SalaryPeriod and SalaryText, from pay fields and description."""
    plain = F.coalesce(F.col("Description"), F.lit(""))
    visible = plain
    for p in (r"(?is)<script.*?</script>", r"(?is)<style.*?</style>", r"<[^>]+>", "(?i)&nbsp;|&#160;"):
        visible = F.regexp_replace(visible, p, " ")
    for p, to in (("(?i)&amp;", "&"), ("(?i)&ndash;|&#8211;", "–"), ("(?i)&mdash;|&#8212;", "—")):
        visible = F.regexp_replace(visible, p, to)
    # patterns cost more than looking whether there is anything for them
    df = pinned(jobs, "_pay", F.when(~F.contains(plain, F.lit("$")), "").otherwise(text.squeezed(F.when(F.contains(plain, F.lit("<")) | F.contains(plain, F.lit("&")), visible).otherwise(plain))))
    one, two = fixed.SALARY_PATTERNS
    part = lambda i: F.when(F.regexp_extract("_pay", one, 0) != "", F.regexp_extract("_pay", one, i)).otherwise(F.regexp_extract("_pay", two, i))
    none = F.array(*[F.lit("")] * 6)
    df = pinned(df, "_m", F.when(F.col("_pay") == "", none).otherwise(F.array(*[part(i) for i in range(6)])))
    found = F.col("_m")[0] != ""
    amount = lambda n, k: F.replace(n, F.lit(","), F.lit("")).try_cast("long") * F.when(F.lower(k) == "k", 1000).otherwise(1)
    low, high = (F.when(found, amount(F.col("_m")[a], F.col("_m")[b])) for a, b in ((2, 3), (4, 5)))
    df = df.withColumns({"SalaryDetected": found, "SalaryMin": low, "SalaryMax": high, "SalaryText": F.col("_m")[0]})
    return df.withColumns({
        "SalaryCurrency": F.when(found, "USD").otherwise(""),
        "SalaryPeriod": F.when(F.coalesce(F.greatest("SalaryMin", "SalaryMax"), F.lit(0)) > 20000, "annual").otherwise(""),
    }).drop("_pay", "_m")


def title_category(title: Column) -> Column:
    t = text.category_text(title)
    found = F.when(t == "", F.lit("Unknown"))
    for name, patterns in fixed.CATEGORY_PATTERNS:
        found = found.when(text.matches_any(t, patterns), name)
    return found.otherwise("Unknown")


def watchlist() -> list[dict]:
    """The watchlist's records with normalised titles and tokens."""
    rows = []
    for category, titles in fixed.WATCHLIST:
        for title in titles:
            norm = " ".join(title.lower().replace("&", " and ").split())
            own = list(dict.fromkeys(norm.split()))
            rows.append({
                "at": len(rows), "title": title, "category": category, "norm": norm, "tokens": own,
                "strong": [t for t in own if t in fixed.STRONG_TOKENS], "weak": [t for t in own if t in fixed.WEAK_TOKENS],
            })
    return rows


def title_matches(titles: DataFrame) -> DataFrame:
    """Of distinct titles: the best watchlist record, its score and the verdict. A record is chosen by score,
    shared strong tokens, shared weak tokens, length of its title and place in the list."""
    df = pinned(titles, "_norm", text.normalized_title(F.col("Title")))
    df = pinned(df, "_tokens", text.tokens(F.col("_norm")))
    df = pinned(df, "_strong", text.of(F.col("_tokens"), fixed.STRONG_TOKENS))
    df = pinned(df, "_weak", text.of(F.col("_tokens"), fixed.WEAK_TOKENS))
    words = lambda ws: F.array(*[F.lit(w) for w in ws]).cast("array<string>")
    candidates = []
    for r in watchlist():
        norm = F.lit(r["norm"])
        shared = F.array_intersect("_strong", words(r["strong"]))
        usable = (F.size(shared) >= 2) & (F.size(F.array_except(shared, words(fixed.PAIRED_ONLY_TOKENS))) >= 1)
        weak = F.array_intersect("_weak", words(r["weak"]))
        some = F.col("_norm") != ""
        score = (
            F.when(F.col("_norm") == norm, 100)
            .when(F.contains(F.col("_norm"), norm), 90)
            .when(some & F.contains(norm, F.col("_norm")), 80)
            .when(usable, 75)
            .when(F.size(shared) > 0, 25)
            .when(F.size(weak) > 0, 10)
            .otherwise(0)
        )
        candidates.append(F.struct(
            score.alias("score"), F.size(shared).alias("n_strong"), F.size(weak).alias("n_weak"), F.lit(len(r["norm"])).alias("width"), F.lit(-r["at"]).alias("order"),
            F.lit(r["title"]).alias("title"), F.lit(r["category"]).alias("category"), usable.alias("usable"), shared.alias("strong"), weak.alias("weak"),
            F.array_except(words(r["strong"]), F.col("_strong")).alias("missing"),
        ))
    df = pinned(df, "_best", F.array_max(F.array(*candidates)))
    best = F.col("_best")
    kind = F.when(F.col("_norm") == "", "none").when(best.score == 100, "exact").when(best.score == 90, "contains").when((best.score >= 50) & best.usable, "token").otherwise("none")
    df = pinned(df, "TitleMatchType", kind)
    hit = F.col("TitleMatchType") != "none"
    reason = (
        F.when(best.score == 100, "Exact normalized title match")
        .when(best.score == 90, "Watchlist phrase contained in title")
        .when(best.score == 80, "Title contained in watchlist phrase")
        .when((best.n_strong == 0) & (best.n_weak > 0), "Only weak generic tokens shared")
        .when(best.n_strong == 0, "No strong domain tokens shared")
        .when(~best.usable | (best.score < 50), "Strong token overlap below threshold")
        .otherwise("Strong token overlap candidate")
    )
    score = F.when(F.col("TitleMatchType") == "exact", 100).when(F.col("TitleMatchType") == "contains", 90).when(hit, 75).otherwise(0)
    return df.withColumns({
        "TitleMatchScore": score,
        "TitleMatchCategory": F.when(hit, best.category).otherwise(""),
        "MatchedWatchlistTitle": F.when(hit, best.title).otherwise(""),
        "TitleConfidence": F.when(F.col("TitleMatchType").isin("exact", "contains"), "high").when(hit, "medium").otherwise("none"),
        "BestCandidateTitle": best.title, "BestCandidateScore": best.score, "MatchReason": reason,
        "SharedStrongTokens": best.strong, "SharedWeakTokens": best.weak, "MissingStrongTokens": best.missing, "NormalizedTitle": F.col("_norm"),
    }).drop("_strong", "_weak", "_best")


def title_reviews(matched: DataFrame) -> DataFrame:
    """Of title_matches' rows: review bucket, priority, reason and the domain, seniority, leadership and IC signals."""
    norm, toks = F.col("_norm"), F.col("_tokens")
    phrase = lambda p: F.contains(norm, F.lit(" ".join(p.replace("-", " ").split())))
    token = lambda p: phrase(p) if " " in p else F.array_contains(toks, p)
    domain = _named([(p, phrase(p)) for p in fixed.DOMAIN_PHRASES])
    senior = _named([(p, token(p)) for p in fixed.SENIORITY])
    strong = text.of(toks, fixed.STRONG_TOKENS)
    useful = (F.size(F.array_except(strong, F.array(*[F.lit(w) for w in fixed.PAIRED_ONLY_TOKENS]))) > 0) | (F.size(strong) >= 2)
    role = F.size(text.of(toks, fixed.ROLE_TOKENS)) > 0
    bucket = (
        F.when(F.col("TitleMatchType").isin("exact", "contains") | ((F.col("TitleMatchType") == "token") & (F.size("SharedStrongTokens") >= 2)), "STRONG_MATCH")
        .when((F.col("TitleMatchScore") >= 60) | (useful & role), "POSSIBLE_MATCH")
        .when((F.size(domain) > 0) | (F.size(text.of(toks, fixed.ADJACENT_TOKENS)) > 0), "ADJACENT")
        .when((F.size(text.of(toks, fixed.WEAK_TOKENS)) > 0) | (F.col("BestCandidateScore") > 0), "LOW_SIGNAL")
        .otherwise("IGNORE_FOR_NOW")
    )
    reasons = {
        "STRONG_MATCH": "Strict title match or strong token match", "POSSIBLE_MATCH": "Useful domain signal plus role signal", "ADJACENT": "Adjacent docs/content/title signal present",
        "LOW_SIGNAL": "Weak generic title signal only", "IGNORE_FOR_NOW": "No meaningful title signal",
    }
    df = pinned(matched, "TitleReviewBucket", bucket)
    return df.withColumns({
        "TitleReviewPriority": text.ranked(F.col("TitleReviewBucket"), {b: i + 1 for i, b in enumerate(fixed.BUCKETS)}),
        "TitleReviewReason": F.element_at(F.create_map(*[F.lit(x) for kv in reasons.items() for x in kv]), F.col("TitleReviewBucket")),
        "TitleDomainSignal": F.array_join(domain, " | "), "TitleSenioritySignal": F.array_join(senior, " | "),
        "TitleLeadershipSignal": F.size(_named([(p, token(p)) for p in fixed.LEADERSHIP])) > 0,
        "TitleICSignal": F.size(_named([(p, token(p)) for p in fixed.IC])) > 0,
    }).drop("_norm", "_tokens")


def with_titles(jobs: DataFrame, plain: DataFrame | None = None) -> DataFrame:
    """Title match, review and category, worked out once for each distinct title.

    plain may give the same titles from a cheaper plan, as the titles are looked for in a pass of their own.
    """
    titles = title_reviews(title_matches((jobs if plain is None else plain).select("Title").distinct())).withColumn("TitleCategory", title_category(F.col("Title")))
    titles = titles.withColumn("_fit", fit_signals())
    return jobs.join(titles.withColumnRenamed("Title", "_title"), jobs["Title"].eqNullSafe(F.col("_title")), "left").drop("_title")


def fit_signals() -> Column:
    """What the fit score asks of a title alone, worked out once for each title: flags, named signals, and the ends that a phrase may reach over into the description."""
    f = fixed
    t = text.search_text(F.col("Title"))
    writer = text.search_text(F.concat_ws(" ", *[text.clean(F.col(c)) for c in ("Title", "MatchedWatchlistTitle", "TitleDomainSignal")]))
    title = lambda *ps: text.has_any(t, list(ps))
    flags = {
        "devrel": title(*f.DEVREL_TITLE), "severe": title(*f.SEVERE_NON_WRITER), "architect": title("architect"), "builder": title("developer", "engineer"), "care": title("therapist", "nurse"), "film": title("video editor", "film editor", "motion graphics"),
        "editor": title("editor"), "designer": title("product designer", "ux designer") & ~title("ux writer", "content designer"), "support": title("support engineer", "support specialist"), "floor": title(*f.TITLE_FLOOR),
    }
    flags |= {f"w_{n}": text.has_any(writer, ps) for n, ps in _WRITER_PHRASES.items()} | {f"b_{n}": text.has_any(t, ps) for n, ps in _BOTH_PHRASES.items()}
    end = lambda c: F.right(c, F.lit(REACH))
    return F.struct(*[c.alias(n) for n, c in flags.items()], F.slice(_named([(p, title(p)) for p in f.NON_WRITER]), 1, 3).alias("non_writer"), end(writer).alias("writer_end"), end(t).alias("title_end"))


#: Phrases that are looked for in title and description: with the matched record and the domains, and without.
_WRITER_PHRASES = {
    "docs": fixed.DOCS_EVIDENCE, "exception": fixed.WRITER_EXCEPTION, "evidence": fixed.DEVREL_EVIDENCE, "writer": [p for p in fixed.WRITER_DOC if p not in fixed.WRITER_DOC_DEVREL], "advocate": fixed.WRITER_DOC_DEVREL,
}
_BOTH_PHRASES = {"clinical": ["clinical"], "trainer": ["trainer"], "strategy": ["technical writing", "content strategy"], "base": ["knowledge base", "docs", "documentation", "content"]}
#: More than the longest of these phrases.
REACH = 40


def with_keys(jobs: DataFrame) -> DataFrame:
    df = pinned(pinned(jobs, "title_part_", _title_part()), "location_part_", _location_part())
    return with_job_key(_place_and_url(df, F.col("title_part_"), F.col("location_part_"))).drop("title_part_", "location_part_")


def _title_part() -> Column:
    return text.key_part(text.normalized_title(F.col("Title")))


def _location_part() -> Column:
    return text.key_part(F.col("Location"))


def with_host(jobs: DataFrame) -> DataFrame:
    """jobs with url_ and host_, the URL as it is read and its host; once for all that reads them."""
    return jobs if "host_" in jobs.columns else pinned(pinned(jobs, "url_", text.url_text(F.col("URL"))), "host_", text.parsed_host(F.col("url_")))


def _place_and_url(jobs: DataFrame, title: Column, location: Column) -> DataFrame:
    df = with_host(jobs)
    df = pinned(df, "company_part_", text.key_part(F.col("Company")))
    place = text.joined([F.col("company_part_"), title, location], ":")
    return df.withColumns({"CompanyTitleLocationKey": place, "CanonicalURLKey": text.canonical_of(F.col("url_"), F.col("host_"))}).drop(*set(df.columns) - set(jobs.columns))


def with_job_key(keyed: DataFrame) -> DataFrame:
    raw = text.key_part(F.col("RawJobId"))
    return keyed.withColumn("JobKey", text.joined([text.key_part(F.col("ATS")), F.when(raw != "", raw).otherwise(F.col("CompanyTitleLocationKey"))], ":"))


def with_duplicate_flags(jobs: DataFrame) -> DataFrame:
    """PossibleDuplicate, DuplicateReason and DuplicateGroupKey, by URL and by company, title and location.

    Counts are aggregates that join back, so that a key with many rows needs no window over them.
    """
    df = jobs if {"CanonicalURLKey", "CompanyTitleLocationKey"} <= set(jobs.columns) else with_keys(jobs)
    for key, name in (("CanonicalURLKey", "_by_url"), ("CompanyTitleLocationKey", "_by_place")):
        # keys begin alike: with a hash before them they are sorted by that
        many = df.where(F.col(key) != "").groupBy(F.xxhash64(key).alias("_h"), F.col(key).alias("_k")).agg(F.count("*").alias("_n")).where("_n > 1").select("_h", "_k", F.lit(True).alias(name))
        df = df.withColumn("_k", spread_key(F.col(key), "seq")).withColumn("_h", F.xxhash64("_k")).join(many, ["_h", "_k"], "left").drop("_h", "_k")
    url, place = F.coalesce("_by_url", F.lit(False)), F.coalesce("_by_place", F.lit(False))
    reason = F.when(url & place, "Both canonical URL and company/title/location").when(url, "Same canonical URL").when(place, "Same company/title/location").otherwise("")
    group = F.when(url & place, F.concat_ws(" | ", "CanonicalURLKey", "CompanyTitleLocationKey")).when(url, F.col("CanonicalURLKey")).when(place, F.col("CompanyTitleLocationKey")).otherwise("")
    return df.withColumns({"DuplicateReason": reason, "DuplicateGroupKey": group, "PossibleDuplicate": url | place}).drop("_by_url", "_by_place")


def with_quality(jobs: DataFrame) -> DataFrame:
    """ExportQualityFlag, ExportQualityIssues, MissingRequiredFields, DescriptionLength, URLValid and ApplyURLHost."""
    return rated(with_row_facts(with_text_facts(jobs)))


def _blank(c: str) -> Column:
    return (text.clean(F.col(c)) == "").alias(f"no_{c}_")


def with_text_facts(texts: DataFrame) -> DataFrame:
    """What quality reads of a posting's texts: DescriptionLength, and whether title and description are blank."""
    length = (F.octet_length(F.encode(text.clean(F.col("Description")), "UTF-16BE")) / 2).cast("long")
    return pinned(texts, "facts_", F.struct(length.alias("DescriptionLength"), _blank("Title"), _blank("Description"))).select("*", "facts_.*").drop("facts_")


def with_row_facts(jobs: DataFrame) -> DataFrame:
    """What quality reads of the rest: URLValid, ApplyURLHost, and whether company, address and ATS are blank."""
    df = with_host(jobs)
    facts = F.struct(text.is_web_of(F.col("url_"), F.col("host_")).alias("URLValid"), F.coalesce(F.lower("host_"), F.lit("")).alias("ApplyURLHost"), (F.col("url_") == "").alias("no_URL_"), _blank("Company"), _blank("ATS"))
    return pinned(df, "facts_", facts).select("*", "facts_.*").drop("facts_", "url_", "host_")


def rated(jobs: DataFrame) -> DataFrame:
    """The quality of rows that have both kinds of facts."""
    no = lambda c: F.col(f"no_{c}_")
    bad = [("Missing Title", no("Title")), ("Missing URL", no("URL")), ("Invalid URL", ~no("URL") & ~F.col("URLValid"))]
    review = [
        ("Missing Company", no("Company")), ("Missing Description", no("Description")), ("Description under 100 characters", F.col("DescriptionLength").between(1, 99)),
        ("RemoteStatus Unknown", F.col("RemoteStatus") == "Unknown"), ("Possible duplicate", F.col("PossibleDuplicate")),
    ]
    some = lambda pairs: reduce(or_, (c for _, c in pairs))
    flag = F.when(some(bad), "BAD_ROW").when(some(review), "REVIEW").otherwise("OK")
    issues = F.array_join(F.when(some(bad), _named(bad)).otherwise(_named(review)), " | ")
    missing = F.array_join(_named([(c, no(c)) for c in ("Company", "Title", "URL", "ATS")]), " | ")
    return jobs.withColumns({"ExportQualityFlag": flag, "ExportQualityIssues": issues, "MissingRequiredFields": missing}).drop(*[f"no_{c}_" for c in ("Title", "Description", "Company", "URL", "ATS")])


def with_fit(jobs: DataFrame) -> DataFrame:
    """WriterFitBaseScore, WriterFitScore, WriterFitTier, WriterFitReasons, WriterFitPenaltySignals and WriterFitGuardrailApplied."""
    f = fixed
    df = jobs if "_fit" in jobs.columns else jobs.withColumn("_fit", fit_signals())
    df = pinned(df, "_d", text.search_text(F.col("Description")))
    over = lambda c: F.concat(F.col(f"_fit.{c}"), F.lit(" "), F.left("_d", F.lit(REACH)))
    df = df.withColumns({"_over_w": over("writer_end"), "_over_b": over("title_end")})
    # a title that has it spares the description; a phrase may also begin in one and end in the other
    w = lambda n: F.coalesce(F.col(f"_fit.w_{n}"), F.lit(False)) | text.has_any(F.col("_d"), _WRITER_PHRASES[n]) | text.has_any(F.col("_over_w"), _WRITER_PHRASES[n])
    b = lambda n: F.coalesce(F.col(f"_fit.b_{n}"), F.lit(False)) | text.has_any(F.col("_d"), _BOTH_PHRASES[n]) | text.has_any(F.col("_over_b"), _BOTH_PHRASES[n])
    t = lambda n: F.coalesce(F.col(f"_fit.{n}"), F.lit(False))
    df = df.withColumns({"_devrel_title": t("devrel"), "_docs": w("docs"), "_exception": w("exception"), "_severe": t("severe")})
    df = df.withColumn("_devrel", F.col("_devrel_title") & w("evidence"))
    df = pinned(df, "_writer", w("writer") | (F.col("_devrel") & w("advocate")))
    # (points, reason or null), in order
    domains = F.slice(_named([(p, F.array_contains(F.split("TitleDomainSignal", r" \| "), p)) for p in f.SCORE_DOMAINS]), 1, 5)
    bucket = text.ranked(F.col("TitleReviewBucket"), f.BUCKET_SCORE)
    gains = F.array(
        F.element_at(F.create_map(*[F.lit(x) for kv in f.BUCKET_REASON.items() for x in kv]), F.col("TitleReviewBucket")),
        F.when(F.col("SalaryDetected"), F.lit("Salary detected")), F.when(F.col("TitleLeadershipSignal"), F.lit("Leadership title signal")), F.when(F.col("TitleICSignal"), F.lit("IC title signal")),
    )
    ends = F.array(
        F.when(F.col("ExportQualityFlag") == "OK", F.lit("Export quality OK")), F.when(F.col("ExportQualityFlag") == "REVIEW", F.lit("Export quality review penalty")),
        F.when(F.col("ExportQualityFlag") == "BAD_ROW", F.lit("Bad row penalty")), F.when(F.col("PossibleDuplicate"), F.lit("Possible duplicate penalty")),
    )
    quality = F.when(F.col("ExportQualityFlag") == "OK", 5).when(F.col("ExportQualityFlag") == "REVIEW", -5).when(F.col("ExportQualityFlag") == "BAD_ROW", -50).otherwise(0)
    one = lambda c, n: F.when(c, n).otherwise(0)
    base = bucket + one(F.col("SalaryDetected"), 5) + one(F.col("TitleLeadershipSignal"), 10) + one(F.col("TitleICSignal"), 10) + 5 * F.size(domains) + quality + one(F.col("PossibleDuplicate"), -5)
    non_writer = F.coalesce(F.col("_fit.non_writer"), F.array().cast("array<string>"))
    no_docs, no_exception = ~F.col("_docs"), ~F.col("_exception")
    penalties = [
        (-35, F.size(non_writer) > 0, F.concat(F.lit("Strong non-writer title signal: "), F.array_join(non_writer, ", "))),
        (-40, t("architect") & no_docs & no_exception, F.lit("Architect title without documentation/content/writing/devrel signal")),
        (-35, t("builder") & no_exception & ((~F.col("_devrel_title") & no_docs) | (F.col("_devrel_title") & ~F.col("_devrel"))), F.lit("Developer/engineer title without documentation/content/writing/devrel signal")),
        (-50, (t("care") | b("clinical")) & ~F.col("_writer"), F.lit("Therapist/nurse/clinical role without documentation writer signal")),
        (-35, (t("film") | (t("editor") & b("trainer"))) & ~b("strategy"), F.lit("Video/film/editor AI trainer role without technical writing/content strategy signal")),
        (-30, t("designer"), F.lit("Product/UX designer role without UX Writer or Content Designer exact phrase")),
        (-25, t("support") & ~b("base"), F.lit("Support engineer/specialist role without knowledge base/docs/content signal")),
    ]
    df = df.withColumns({"_base": base, "_lost": sum((one(c, n) for n, c, _ in penalties), F.lit(0)), "_gains": F.concat(gains, F.transform(domains, lambda x: F.concat(x, F.lit(" domain signal"))), ends)})
    df = df.withColumn("_penalties", F.filter(F.array(*[F.when(c, r) for _, c, r in penalties]), lambda x: x.isNotNull()))
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(100), c))
    df = pinned(df, "_score", clamp(F.col("_base") + F.col("_lost")))
    open_ = ~F.col("_severe") & (F.col("_score") < 85)
    listed = open_ & (F.col("TitleReviewBucket") == "STRONG_MATCH") & F.col("TitleMatchType").isin("exact", "contains", "token") & (F.col("MatchedWatchlistTitle") != "") & F.col("_writer")
    floor = open_ & ~listed & t("floor") & F.col("_writer")
    df = df.withColumns({"_listed": listed, "_floor": floor})
    df = pinned(df, "_raised", F.when(F.col("_listed") | F.col("_floor"), 85).otherwise(F.col("_score")))
    guard = (F.col("_raised") >= 60) & ~F.col("_writer")
    df = df.withColumns({"WriterFitBaseScore": clamp(F.col("_base")), "WriterFitGuardrailApplied": guard, "WriterFitScore": F.when(guard, F.least(F.col("_raised"), F.lit(59))).otherwise(F.col("_raised"))})
    last = F.array(
        F.when(F.col("_listed"), F.lit("Watchlist strong title match floor")), F.when(F.col("_floor"), F.lit("Strong writer/docs title signal floor")),
        F.when(F.col("WriterFitGuardrailApplied"), F.lit("Missing strong writer/docs signal for A/B tier")),
    )
    reasons = F.filter(F.concat("_gains", "_penalties", last), lambda x: x.isNotNull())
    s = F.col("WriterFitScore")
    df = df.withColumns({
        "WriterFitTier": F.when(s >= 80, "A").when(s >= 60, "B").when(s >= 40, "C").when(s >= 20, "D").otherwise("F"),
        "WriterFitReasons": F.array_join(reasons, " | "), "WriterFitPenaltySignals": F.array_join("_penalties", " | "),
    })
    return df.drop(*[c for c in df.columns if c.startswith("_")])


#: All that the rules of title, arrangement, pay and fit read of a posting as it comes.
TEXTS = ["Title", "Location", "Description"]
#: Different texts that are worked out apart from the rows, and broadcast; with more of them every row is worked out by itself.
MOST_TEXTS = 20_000
#: What with_fit adds.
FIT = ["WriterFitBaseScore", "WriterFitScore", "WriterFitTier", "WriterFitReasons", "WriterFitPenaltySignals", "WriterFitGuardrailApplied"]


def repeated_texts(jobs: DataFrame, most: int = MOST_TEXTS) -> DataFrame | None:
    """The different TEXTS of jobs with a number each in text_, or None if there are more than most."""
    ensure_checkpoints(jobs.sparkSession)
    found = jobs.select(*TEXTS).distinct().limit(most + 1).repartition(jobs.sparkSession.sparkContext.defaultParallelism)  # one more tells that there are too many
    found = found.withColumn("text_", F.monotonically_increasing_id()).checkpoint()
    return found if found.count() <= most else None


def _numbered_texts(jobs: DataFrame, texts: DataFrame, *more: Column) -> DataFrame:
    """jobs with the number of their texts and more of them in the texts' place; the texts themselves aren't shuffled."""
    numbers = F.broadcast(texts.select("text_", *[F.col(c).alias(f"{c}_") for c in TEXTS], *more))
    return jobs.join(numbers, [jobs[c].eqNullSafe(F.col(f"{c}_")) for c in TEXTS]).drop(*TEXTS, *[f"{c}_" for c in TEXTS])


def _flagged(jobs: DataFrame, texts: DataFrame, known: DataFrame) -> DataFrame:
    """jobs with duplicate flags, the facts of their rows and the columns of known, one of whose rows goes with each text."""
    rows = _numbered_texts(jobs, texts, _title_part().alias("title_part_"), _location_part().alias("location_part_"))
    rows = with_row_facts(_place_and_url(with_host(rows), F.col("title_part_"), F.col("location_part_"))).drop("title_part_", "location_part_")
    # three readers follow: the counts by either key, and the rows
    return with_duplicate_flags(with_job_key(stored(rows, "keys"))).join(F.broadcast(known), "text_")


def graded(jobs: DataFrame, most: int = MOST_TEXTS) -> DataFrame:
    """jobs with arrangement, duplicate flags and quality."""
    texts = repeated_texts(jobs, most)
    if texts is None:
        return with_quality(with_duplicate_flags(with_arrangement(jobs)))
    return rated(_flagged(jobs, texts, with_text_facts(with_arrangement(texts)).checkpoint())).drop("text_")


def described(jobs: DataFrame, most: int = MOST_TEXTS) -> DataFrame:
    """jobs with all that their texts alone decide: title match and review, arrangement and pay. Rows are read twice and not shuffled."""
    texts = repeated_texts(jobs, most)
    if texts is None:
        return with_salary(with_arrangement(with_titles(jobs))).drop("_fit")
    known = with_salary(with_arrangement(with_titles(texts))).drop("_fit").checkpoint()
    return _numbered_texts(jobs, texts).join(F.broadcast(known), "text_").drop("text_")


def enriched(jobs: DataFrame, most: int = MOST_TEXTS) -> DataFrame:
    """All of the above. What reads the rows more than once comes first, so that it doesn't repeat the costly columns.

    Texts that repeat are worked out once; the fit score also asks for quality and duplication, and is worked out for each outcome of both.
    """
    texts = repeated_texts(jobs, most)
    if texts is None:
        return with_fit(with_quality(with_salary(with_arrangement(with_titles(with_duplicate_flags(jobs), jobs)))))
    known = with_text_facts(with_salary(with_arrangement(with_titles(texts)))).checkpoint()
    outcomes = known.withColumn("ExportQualityFlag", F.explode(F.array(*map(F.lit, fixed.QUALITY_RANK)))).withColumn("PossibleDuplicate", F.explode(F.array(F.lit(True), F.lit(False))))
    by = ["text_", "ExportQualityFlag", "PossibleDuplicate"]
    scores = with_fit(outcomes).select(*by, *FIT).checkpoint()
    return rated(_flagged(jobs, texts, known.drop("_fit"))).join(F.broadcast(scores), by).drop("text_")


def dedupe_keys(jobs: DataFrame) -> DataFrame:
    """The rows with `keys`: strong keys if there are any, else one fallback."""
    strong = F.filter(F.array(
        F.when(F.col("DuplicateGroupKey") != "", F.concat(F.lit("duplicate:"), "DuplicateGroupKey")), F.when(F.col("CanonicalURLKey") != "", F.concat(F.lit("canonical:"), "CanonicalURLKey")),
    ), lambda x: x.isNotNull())
    rest = F.concat(F.lit("fallback:"), F.coalesce(*[F.nullif(c, F.lit("")) for c in (F.col("CompanyTitleLocationKey"), F.col("JobKey"), text.clean(F.col("URL")))], F.concat(F.lit("row-"), "seq")))
    return jobs.withColumn("keys", F.when(F.size(strong) > 0, strong).otherwise(F.array(rest)))


def components(keyed: DataFrame, id_col: str = "seq") -> DataFrame:
    """(id, component): rows that share keys, directly or over others, get the smallest id among them.

    Few rows share keys, and only those take part.
    """
    keyed = stored(keyed.select(id_col, "keys"), "keyed")
    found = linked(keyed.select(F.col(id_col).alias("id"), F.explode("keys").alias("key")))
    return keyed.select(F.col(id_col).alias("id")).join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def linked(links: DataFrame) -> DataFrame:
    """(id, component) of the rows of (id, key) that share a key with others. links are read twice, so they should be stored.

    The head of a key is its smallest row. A row with one head goes with it; where a row has several, the heads are linked, and only their
    labels spread in rounds, each a checkpoint that survives lost executors.
    """
    heads = links.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    own = links.join(heads, "key").groupBy("id").agg(F.collect_set("head").alias("heads"))
    own = stored(own.select("id", F.array_min("heads").alias("first"), F.when(F.size("heads") > 1, F.col("heads")).alias("heads")), "heads")
    edges = own.where("heads is not null").select(F.explode("heads").alias("id"), "first").where("id <> first").distinct()
    edges = edges.union(edges.select("first", "id")).toDF("id", "other").checkpoint()
    label = edges.select("id").distinct().withColumn("label", F.col("id"))
    while True:
        near = edges.join(label.toDF("other", "near"), "other").groupBy("id").agg(F.min("near").alias("near"))
        step = label.join(near, "id").select("id", F.least("label", "near").alias("next"), "label")
        # a label's own label is as good: halves the rounds on long chains
        step = step.join(label.toDF("next", "far"), "next", "left").select("id", F.least("next", F.coalesce("far", "next")).alias("next"), "label").checkpoint()
        changed = step.where("next <> label").count()
        label = step.select("id", F.col("next").alias("label"))
        if not changed:
            break
    return own.select("id", "first").join(label.toDF("first", "label"), "first", "left").select("id", F.coalesce("label", "first").alias("component"))


#: What dedupe_keys() and preference() read.
KEYED_BY = ["DuplicateGroupKey", "CanonicalURLKey", "CompanyTitleLocationKey", "JobKey", "URL"]
PREFERRED_BY = ["WriterFitScore", "WriterFitTier", "ExportQualityFlag", "USRemoteEligible", "RemoteStatus", "SalaryDetected", "ATS", "DatePosted", "Company", "Title"]


def preference() -> list[Column]:
    """The order in which rows of a component are preferred."""
    c = F.col
    eligible = F.when(c("USRemoteEligible") == "true", 1).when(c("USRemoteEligible").isin("unknown", ""), 2).otherwise(3)
    label = F.when(text.clean(c("Company")).rlike(text.pattern(r"(?i)^(careers?|jobs?)\b")), 1).otherwise(0)
    return [
        c("WriterFitScore").desc(), text.ranked(c("WriterFitTier"), fixed.TIER_RANK), text.ranked(c("ExportQualityFlag"), fixed.QUALITY_RANK), eligible,
        text.ranked(c("RemoteStatus"), fixed.REMOTE_RANK), F.when(c("SalaryDetected"), 0).otherwise(1), text.ranked(F.lower("ATS"), fixed.ATS_RANK), c("DatePosted").desc(),
        label, F.lower("Company"), F.lower("Title"), c("seq"),
    ]


def winners(jobs: DataFrame) -> DataFrame:
    """Rows with component, DedupeGroupSize, DedupeRank and DedupeSelected. They are stored, so select no more columns than are wanted."""
    rows = stored(jobs, "rows")
    found = components(dedupe_keys(rows).select("seq", "keys"))
    ranks = ranked_within(rows.join(found, rows["seq"] == found["id"]).select("component", *PREFERRED_BY, "seq"), ["component"], preference(), ["seq", "component"])
    return rows.join(ranks.withColumnsRenamed({"size": "DedupeGroupSize", "rank": "DedupeRank"}), "seq").withColumn("DedupeSelected", F.col("DedupeRank") == 1)


def writer_focus() -> Column:
    return F.col("WriterFitTier").isin("A", "B", "C") | F.col("TitleReviewBucket").isin("STRONG_MATCH", "POSSIBLE_MATCH", "ADJACENT")


def strong_match() -> Column:
    return F.col("WriterFitTier").isin("A", "B") | (F.col("TitleReviewBucket") == "STRONG_MATCH")


def remote_us() -> Column:
    return (F.col("USRemoteEligible") == "true") & (F.col("RemoteStatus") == "Remote")


def slices() -> Column:
    """The names of the slices that a row belongs to."""
    demoted = (F.col("WriterFitGuardrailApplied") | (F.col("WriterFitPenaltySignals") != "")) & (F.col("WriterFitBaseScore") >= 75)
    return _named([
        ("firehose", F.lit(True)), ("writer-focus", writer_focus()), ("strong-matches", strong_match()), ("remote-us-likely", remote_us()), ("remote-writer-focus", remote_us() & writer_focus()),
        ("salary-detected", F.col("SalaryDetected")), ("review-needed", (F.col("ExportQualityFlag") == "REVIEW") | F.col("PossibleDuplicate")), ("demoted-high-score", demoted), ("top", strong_match()),
    ])
