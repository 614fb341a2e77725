"""Text, URL and key expressions: pure Column functions, evaluated in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word boundary that only knows ASCII letters, digits and the underscore.
BOUNDARY = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"


def pattern(p: str) -> str:
    """p with each \\b as an ASCII word boundary; where its neighbour shows which side is the word, a single look."""
    out, last = [], 0
    for m in re.finditer(r"\\b", p):
        out.append(p[last : m.start()])
        before, after = p[: m.start()], p[m.end() :]
        group = before[before.rfind("(") :] if before.endswith(")") else ""
        if after[:1].isalnum() or after[:1] == "(":
            out.append(r"(?<![A-Za-z0-9_])")
        elif (before[-1:].isalnum() or before[-1:] == "?" or (group and r"\." not in group)) and not before.endswith(r"\."):
            out.append(r"(?![A-Za-z0-9_])")
        else:
            out.append(BOUNDARY)
        last = m.end()
    return "".join([*out, p[last:]])


def literals(p: str) -> list[str]:
    """Text that every match of p holds: the plain beginning of each alternative, or nothing if one has none."""
    parts, depth, last = [], 0, 0
    for i, c in enumerate(p):
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            parts.append(p[last:i])
            last = i + 1
    found = []
    for part in [*parts, p[last:]]:
        m = re.match(r"(?:\\b)?((?:[a-z -]|\\\.)*)([?*{]?)", part)
        own = m[1].replace("\\.", ".")
        found.append(own[:-1] if m[2] else own)
    return found if all(len(x) > 1 for x in found) else []


def matches(text: Column, p: str) -> Column:
    """Whether p is found; a search for plain text first spares most texts the pattern."""
    found = text.rlike(pattern(p))
    return has_any(text, own) & found if (own := literals(p)) else found


def matches_any(text: Column, patterns: list[str]) -> Column:
    return text.rlike(pattern("|".join(f"(?:{p})" for p in patterns)))


#: White space as Unicode has it.
SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


#: ASCII punctuation but for the ampersand, which titles read as a word.
PUNCTUATION = "-_/!\"#$%'()*+,.:;<=>?@[\\]^`{|}~"


def clean(c: Column) -> Column:
    """Trimmed text; null is empty."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")), F.lit(SPACES))


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalized_title(c: Column) -> Column:
    """Lower case, & as and, separators and punctuation as spaces."""
    text = F.replace(F.lower(clean(c)), F.lit("&"), F.lit(" and "))
    return squeezed(F.translate(text, PUNCTUATION, " " * len(PUNCTUATION)))


def category_text(c: Column) -> Column:
    text = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "&", " and ")
    return squeezed(F.regexp_replace(text, r"[^A-Za-z0-9_\s/-]", " "))


def search_text(c: Column) -> Column:
    return squeezed(F.translate(F.lower(clean(c)), "_/.,;:()[]{}", " " * 12))


def has_any(text: Column, phrases: list[str]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | F.contains(text, F.lit(p))
    return found


def tokens(normalized: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(normalized, " "), ""))


def of(tokens_: Column, words: list[str]) -> Column:
    """The tokens that are among words, in their order."""
    return F.filter(tokens_, lambda t: t.isin(words))


def key_part(c: Column) -> Column:
    """Lower case without punctuation or white space."""
    return F.translate(F.lower(clean(c)), PUNCTUATION + "&" + SPACES, "")


def joined(parts: list[Column], by: str) -> Column:
    """The parts that aren't empty."""
    return F.concat_ws(by, *[F.nullif(p, F.lit("")) for p in parts])


def url_text(c: Column) -> Column:
    """What the functions of URLs below read."""
    return F.replace(clean(c), F.lit(" "), F.lit("%20"))


def parsed_host(url: Column) -> Column:
    """The host of url_text(), null if it has none or isn't a URL. A parse costs more than the rest: with a host, scheme and path are read off the text."""
    return F.try_parse_url(url, F.lit("HOST"))


def canonical_url(c: Column) -> Column:
    """scheme://host/path, lower-case but for the path, without trailing slashes; empty if it isn't a URL."""
    return canonical_of(url_text(c), parsed_host(url_text(c)))


def canonical_of(url: Column, host: Column) -> Column:
    path = F.rtrim(F.regexp_extract(url, "^[^:]+://[^/?#]*([^?#]*)", 1), F.lit("/"))
    found = F.concat(F.lower(F.substring_index(url, ":", 1)), F.lit("://"), F.lower(host), path)
    return F.when(host.isNotNull() & ~F.startswith(url, F.lit("//")), found).otherwise("")


def url_host(c: Column) -> Column:
    return F.coalesce(F.lower(parsed_host(url_text(c))), F.lit(""))


def is_web_url(c: Column) -> Column:
    return is_web_of(url_text(c), parsed_host(url_text(c)))


def is_web_of(url: Column, host: Column) -> Column:
    return host.isNotNull() & F.lower(F.substring_index(url, ":", 1)).isin("http", "https")


def strip_html(c: Column) -> Column:
    """Scripts, styles and tags as spaces, then entities decoded."""
    text = F.coalesce(c, F.lit(""))
    for p in (r"(?is)<script.*?</script>", r"(?is)<style.*?</style>", r"<[^>]+>"):
        text = F.regexp_replace(text, p, " ")
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return squeezed(text)


def ranked(c: Column, ranks: dict[str, int]) -> Column:
    found = F.lit(99)
    for k, v in reversed(ranks.items()):
        found = F.when(c == k, v).otherwise(found)
    return found
