"""Quality rules: a table of thresholds compiled into one Spark projection.

Every figure is a built-in expression over the whole text, so the plan is a scan and a projection: no
shuffle, no Python. Word windows are compared within the row: their hashes are sorted next to their
positions, so a text of n words costs n log n.

Defined cases: a null text has no words, fails the base rules and isn't kept; an empty text likewise.
Repeated rows are judged one by one, and other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import bound, whole_text, words_of

WINDOW = 8

#: Frequent words of the corpus languages.
STOP_WORDS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was with".split(),
    "de": "das dem den der des die ein eine für im in ist mit nicht sich und von zu".split(),
    "es": "con de del el en es la las lo los no para por que se un una y".split(),
    "fr": "au de des du elle en est et il la le les par pas pour que qui un une".split(),
}


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= numerator / denominator <= high, where texts with too few words pass."""

    name: str
    numerator: str
    denominator: str | None
    low: float
    high: float
    from_words: int = 0


#: What a kept text must hold besides the base rules.
RULES = (
    Rule("length", "n_words", None, 20, 1_000_000),
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", 0.0, 0.25),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, 1.0, 50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 0.0, 0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", 0.0, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", 0.0, 0.3),
)


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found at least twice in the text."""
    n = F.size(words)

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, i: F.coalesce(F.least(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def twins(s: Column) -> Column:
        same = lambda i, x: F.coalesce(F.get(s, i).getField("h") == x.getField("h"), F.lit(False))
        found = F.filter(s, lambda x, i: same(i - 1, x) | same(i + 1, x))
        return bound(F.sort_array(F.transform(found, lambda x: x.getField("i"))), covered)

    def windows(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) < F.size(g), bound(ordered, twins)).otherwise(0)

    def hashed(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    each = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n > WINDOW, bound(bound(each, hashed), windows)).otherwise(0)


def _figures(text: Column) -> Column:
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws})
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)

    def of_words(words: Column) -> Column:
        stop = F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(stops))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.size(stop).cast("long").alias("n_stop_words"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(rows: Column) -> Column:
        return F.struct(
            F.size(rows).cast("long").alias("n_lines"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(rows, lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullet_lines"),
            F.size(F.filter(rows, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        )

    return F.struct(bound(words_of(text), of_words).alias("w"), bound(lines, of_lines).alias("l"))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its figures, base_failed, failed_rules (names, in table order) and kept."""
    text = whole_text(text_col)
    figures = docs.select(
        F.col(id_col),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _figures(text).alias("f"),
    ).select(id_col, "word_chars", "n_symbols", "f.w.*", "f.l.*")

    def broken(rule: Rule) -> Column:
        value = F.col(rule.numerator).cast("double")
        if rule.denominator:
            value = value / F.greatest(F.col(rule.denominator), F.lit(1))
        return ~value.between(rule.low, rule.high) & (F.col("n_words") >= rule.from_words)

    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return figures.select("*", base_failed.alias("base_failed"), failed.alias("failed_rules")).select(
        "*", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept")
    )


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    rows = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    stops = ", ".join("'" + w + "'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
    terms = []
    for r in RULES:
        value = f"{r.numerator}::double" + (f" / greatest({r.denominator}, 1)" if r.denominator else "")
        terms.append(f"({value} between {r.low} and {r.high} or n_words < {r.from_words})")
    return rf"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (
  select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from t),
g as (
  select doc_id, unnest(range(1, len(words) - 6)) as i, unnest(list_transform(range(1, len(words) - 6), lambda i: list_slice(words, i, i + 7))) as win
  from w where len(words) > 8),
c as (select doc_id, i, count(*) over (partition by doc_id, win) as n from g),
r as (select doc_id, count(distinct i + k) as n_repeat_words from c, range(8) as s(k) where n > 1 group by doc_id),
m as (
  select doc_id, len(words)::bigint as n_words,
    coalesce(length(array_to_string(words, '')), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(lines) as n_lines,
    len(list_filter(words, lambda x: list_contains([{stops}], lower(rtrim(x, '.,;:!?'))))) as n_stop_words,
    len(list_filter(lines, lambda x: left(ltrim(x, ' '), 1) in ('-', '*', '•'))) as n_bullet_lines,
    len(list_filter(lines, lambda x: ends_with(rtrim(x, ' '), '...') or ends_with(rtrim(x, ' '), '…'))) as n_ellipsis_lines
  from w left join r using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {" and ".join(terms)} as kept
from b"""


SQL = _sql()
