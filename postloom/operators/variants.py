"""The second generation of title, duplicate and anomaly rules, the consumer's title match, and consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import fixed, text
from postloom.functions.folders import stored
from postloom.operators.ordering import first_values
from postloom.operators.boards import rate
from postloom.operators.postings import pinned, watchlist


def core_title_matches(titles: DataFrame) -> DataFrame:
    """Of distinct titles: the watchlist record with the highest weighted share of tokens, the first of equals."""
    df = pinned(titles, "_norm", text.squeezed(F.lower(text.clean(F.col("Title")))))
    df = pinned(df, "_tokens", text.tokens(F.col("_norm")))
    candidates = []
    for r in watchlist():
        has = lambda ws: sum((F.array_contains("_tokens", w).cast("int") for w in ws), F.lit(0))
        strong = has([t for t in r["tokens"] if t in fixed.CORE_STRONG])
        weak = has([t for t in r["tokens"] if t in fixed.CORE_WEAK and t not in fixed.CORE_STRONG])
        share = F.least((strong * 10 + weak * 2) * 100.0 / len(r["tokens"]), F.lit(100.0))
        share = F.when(strong >= 2, F.least(share + 25, F.lit(100.0))).when(strong == 1, F.least(share + 10, F.lit(100.0))).otherwise(share)
        exact, inside = F.col("_norm") == r["norm"], F.contains(F.col("_norm"), F.lit(r["norm"]))
        score = F.when(exact, 100.0).when(inside, F.greatest(share, F.lit(95.0))).otherwise(share)
        kind = F.when(exact, "exact").when(inside, "contains").otherwise("none")
        candidates.append(F.struct(score.alias("score"), F.lit(-r["at"]).alias("order"), kind.alias("kind"), F.lit(r["title"]).alias("title"), F.lit(r["category"]).alias("category")))
    df = pinned(df, "_best", F.array_max(F.array(*candidates)))
    best = F.col("_best")
    hit = best.score > 0
    return df.select(
        "Title", F.when(hit, best.kind).otherwise("none").alias("TitleMatchType"), F.floor(best.score + 0.5).cast("long").alias("TitleMatchScore"),
        F.when(hit, best.title).otherwise("").alias("MatchedWatchlistTitle"), F.when(hit, best.category).otherwise("").alias("TitleMatchCategory"),
        F.when(best.score >= 80, "high").when(best.score >= 60, "medium").when(hit, "low").otherwise("none").alias("TitleConfidence"),
    )


def core_title_reviews(matched: DataFrame) -> DataFrame:
    """Of core_title_matches' rows: bucket and priority by match score, seniority, leadership, IC and domain."""
    low = F.lower(F.coalesce(F.col("Title"), F.lit("")))
    first = lambda pairs: F.coalesce(*[F.when(text.has_any(low, ps), F.lit(n)) for n, ps in pairs], F.lit(""))
    df = pinned(matched, "_domain", first(fixed.CORE_DOMAINS))
    df = pinned(df, "_senior", first([(k, [k]) for k in fixed.CORE_SENIORITY]))
    leads, ic = text.has_any(low, fixed.CORE_LEADERSHIP), text.has_any(low, fixed.CORE_IC)
    domain, senior, score = F.col("_domain") != "", F.col("_senior") != "", F.col("TitleMatchScore")
    ladder = [
        (score >= 80, "HIGH_PRIORITY_MATCH", F.lit(1)), (score >= 60, "POTENTIAL_MATCH", F.lit(2)), (senior & domain, "SENIOR_IN_DOMAIN", F.when(leads, 1).otherwise(3)), (leads & domain, "LEADERSHIP_ROLE", F.lit(1)),
        (ic & domain, "IC_IN_DOMAIN", F.lit(3)), (domain, "IN_DOMAIN", F.lit(4)), (senior, "SENIOR_ROLE", F.lit(5)),
    ]
    bucket, priority = F.lit("IGNORE_FOR_NOW"), F.lit(5)
    for c, n, p in reversed(ladder):
        bucket, priority = F.when(c, n).otherwise(bucket), F.when(c, p).otherwise(priority)
    return df.select("Title", bucket.alias("TitleReviewBucket"), priority.cast("long").alias("TitleReviewPriority"), F.col("_domain").alias("TitleDomainSignal"), F.col("_senior").alias("TitleSenioritySignal"), leads.alias("TitleLeadershipSignal"), ic.alias("TitleICSignal"))


def canonical_jobs(jobs: DataFrame, fields: list[str]) -> DataFrame:
    """One row per company and title: the one with most fields filled, the first of equals."""
    company = F.regexp_replace(F.regexp_replace(F.lower(text.clean(F.col("Company"))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    key = F.concat_ws("-", F.coalesce(F.nullif(company, F.lit("")), F.lit("unknown")), text.normalized_title(F.col("Title")))
    filled = sum((F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", 1).otherwise(0) for f in fields), F.lit(0))
    keyed = jobs.withColumns({"DedupeKey": key, "Filled": filled})
    best = keyed.groupBy("DedupeKey").agg(F.max(F.struct("Filled", (-F.col("seq")).alias("s")))["s"].alias("s"), F.count("*").alias("GroupSize"))
    return best.select("DedupeKey", (-F.col("s")).alias("seq"), "GroupSize")


def variant(normalized: Column) -> Column:
    """Normalised titles with abbreviations written out."""
    out = F.split(normalized, " ")
    word = lambda t: F.coalesce(*[F.when(t == k, F.lit(v)) for k, v in fixed.VARIANTS.items()], t)
    return F.array_join(F.transform(out, word), " ")


def consumer_matches(titles: DataFrame) -> DataFrame:
    """Of distinct titles: an exact, variant or longest contained watchlist title, unless only marketing makes it one."""
    df = pinned(titles, "_norm", text.normalized_title(F.col("Title")))
    df = pinned(df, "_variant", variant(F.col("_norm")))
    marketing = text.has_any(F.col("_variant"), fixed.MARKETING)
    padded = F.concat(F.lit(" "), F.col("_variant"), F.lit(" "))
    candidates = []
    for r in watchlist():
        own = " ".join(fixed.VARIANTS.get(t, t) for t in r["norm"].split())
        collides = marketing & F.lit(not any(m in own for m in fixed.MARKETING))
        tier = F.when(F.col("_norm") == r["norm"], 3).when(F.col("_variant") == own, 2).when(F.contains(padded, F.lit(f" {own} ")) & ~collides, 1)
        rank = F.when(tier == 1, len(own)).otherwise(0)
        candidates.append(F.when(tier.isNotNull(), F.struct(tier.alias("tier"), rank.alias("rank"), F.lit(-r["at"]).alias("order"), F.lit(r["title"]).alias("title"), F.lit(r["category"]).alias("category"))))
    df = pinned(df, "_best", F.array_max(F.array(*candidates)))
    best = F.col("_best")
    hit = best.isNotNull() & (F.col("_norm") != "")
    return df.select("Title", F.when(hit, F.element_at(F.array(F.lit("contains"), F.lit("variant"), F.lit("exact")), best.tier)).otherwise("none").alias("MatchType"), F.when(hit, best.title).otherwise("").alias("MatchedTitle"), F.when(hit, best.category).otherwise("").alias("MatchedCategory"))


def core_anomalies(fetches: DataFrame, now: Column, recent_hours: int = 24) -> DataFrame:
    """Per ATS: failure rate of the recent attempts and change of the mean job count against those before."""
    age = now.cast("timestamp").cast("long") - F.col("FetchedAt").cast("long")
    recent = age <= recent_hours * 3600
    failed = F.col("Status") == "failed"
    df = fetches.groupBy("ATS").agg(
        F.count_if(recent).alias("RecentAttempts"), F.count_if(~recent).alias("BaselineAttempts"), F.count_if(recent & failed).alias("_f"),
        F.sum(F.when(recent, F.col("JobCount"))).alias("_rj"), F.sum(F.when(~recent, F.col("JobCount"))).alias("_bj"),
    ).where("RecentAttempts > 0")
    share = F.col("_f") / F.col("RecentAttempts")
    was = F.when(F.col("BaselineAttempts") > 0, F.col("_bj") / F.col("BaselineAttempts"))
    change = F.when(was != 0, (F.col("_rj") / F.col("RecentAttempts") - was) / was).otherwise(0.0)
    status = F.when(share > 0.25, "CRITICAL").when((share > 0.10) | ((F.col("BaselineAttempts") > 0) & (change < -0.05)), "DEGRADED").otherwise("NORMAL")
    return df.select("ATS", "RecentAttempts", "BaselineAttempts", rate(F.col("_f"), F.col("RecentAttempts")).alias("FailedRate"), F.round(change * 100, 2).alias("JobCountChange"), status.alias("Health"))


def consolidated(rows: DataFrame) -> DataFrame:
    """Postings of one company and title in two or more places as one, with its places; others as they are.

    The first eight places are named, and the representative is the best scored of the most open arrangement.
    """
    key = F.concat_ws("|", F.lower(text.clean(F.col("Company"))), F.lower(text.clean(F.col("Title"))))
    place = F.lower(text.clean(F.col("Location")))
    keyed = stored(rows.withColumn("GroupKey", key).select("GroupKey", "seq", "Location", "RemoteStatus", "WriterFitScore", "DatePosted"), "consolidated")
    groups = keyed.groupBy("GroupKey").agg(F.count("*").alias("Postings"), F.count_distinct(F.nullif(place, F.lit(""))).alias("Places"))
    merged = groups.where("Places >= 2").select("GroupKey")
    rank = text.ranked(F.col("RemoteStatus"), fixed.REMOTE_RANK)
    top = F.min(F.struct(rank.alias("r"), (-F.col("WriterFitScore")).alias("s"), "Location", "seq"))
    names = F.array_sort(F.collect_set(F.nullif(text.clean(F.col("Location")), F.lit(""))))
    one = keyed.join(merged, "GroupKey", "left_semi").groupBy("GroupKey").agg(F.count("*").alias("Postings"), names.alias("names"), top["seq"].alias("seq"), F.min("DatePosted").alias("DatePosted"))
    more = F.when(F.size("names") > 8, F.concat(F.lit("; +"), F.size("names") - 8, F.lit(" more"))).otherwise("")
    shown = F.concat(F.lit("Multiple locations ("), "Postings", F.lit(" postings): "), F.array_join(F.slice("names", 1, 8), "; "), more)
    many = one.select("seq", "Postings", shown.alias("Location"), "DatePosted")
    single = keyed.join(merged, "GroupKey", "left_anti").select("seq", F.lit(1).cast("long").alias("Postings"), "Location", "DatePosted")
    return many.unionByName(single)



def grouped_postings(rows: DataFrame, most: int = 8) -> DataFrame:
    """Postings of one company and title in several places as one row; groups in one place aren't merged and not returned.

    The arrangement is Remote, Hybrid or Onsite, whichever comes first among the group's; the representative has it, and is the
    least old (blank ages last), best scored one, then by place and link. The first places are named and the others counted; the
    earliest date, the largest age and the newest check are the group's. rows: GroupKey comes from Company and Title.
    """
    plain = lambda c: F.lower(text.squeezed(text.clean(F.col(c))))
    place, link = text.clean(F.col("Location")), text.clean(F.col("Link"))
    keyed = rows.withColumns({"GroupKey": F.concat_ws("|", plain("Company"), plain("Title")), "place": place, "link": link, "kind": F.initcap(plain("Arrangement"))})
    keyed = stored(keyed.select("GroupKey", "place", "link", "kind", "Age", "Score", "Posted", "Checked"), "grouped")  # the groups and their places read it
    kinds = ["Remote", "Hybrid", "Onsite"]
    rank = text.ranked(F.col("kind"), {k: i for i, k in enumerate(kinds)})
    best = F.struct(rank.alias("r"), F.col("Age").isNull().alias("old"), "Age", (-F.coalesce(F.col("Score").cast("double"), F.lit(float("-inf")))).alias("s"), "place", "link", "kind")
    said = F.regexp_extract(F.col("Checked"), r"(?i)^(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}) UTC$", 1)
    groups = keyed.groupBy("GroupKey").agg(
        F.count("*").alias("Postings"), F.count_distinct(F.nullif("place", F.lit(""))).alias("Places"), F.count_distinct(F.nullif("link", F.lit(""))).alias("Links"), F.min(best).alias("b"),
        F.min(F.nullif(text.clean(F.col("Posted")), F.lit(""))).alias("PostedDate"), F.max("Age").alias("LargestAge"), F.max(F.nullif(said, F.lit(""))).alias("seen"),
    ).where("Places > 1")
    names = first_values(keyed, ["GroupKey"], "place", "names", most)
    more = F.when(F.col("Places") > most, F.concat(F.lit("; +"), F.col("Places") - most, F.lit(" more"))).otherwise("")
    shown = F.concat(F.lit("Multiple locations ("), "Postings", F.lit(" postings): "), F.replace("names", F.lit(" | "), F.lit("; ")), more)
    out = groups.join(names, "GroupKey")
    others = F.col("Links") - F.when(F.col("b.link") != "", 1).otherwise(0)
    return out.select(
        "GroupKey", "Postings", shown.alias("Location"), F.col("b.kind").alias("WorkArrangement"), F.col("b.Age").alias("Age"), F.col("b.place").alias("RepresentativeLocation"), F.col("b.link").alias("ApplyLink"),
        others.alias("OtherLinks"), F.coalesce("PostedDate", F.lit("")).alias("PostedDate"), "LargestAge", F.coalesce(F.concat("seen", F.lit(" UTC")), F.lit("")).alias("LastChecked"),
    )


def other_links(rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """A row for each link of a group besides its representative's: GroupKey and Link."""
    plain = lambda c: F.lower(text.squeezed(text.clean(F.col(c))))
    links = rows.select(F.concat_ws("|", plain("Company"), plain("Title")).alias("GroupKey"), text.clean(F.col("Link")).alias("Link")).where("Link <> ''").distinct()
    return links.join(grouped.select("GroupKey", "ApplyLink"), "GroupKey").where("Link <> ApplyLink").select("GroupKey", "Link")
