"""Column functions on strings: white space as Unicode has it, rewrites with a lookup, frontmatter, addresses."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed: a year suffix of a Hebrew law title, and the marks that a lookup key drops.
YEAR_SUFFIX = r"""(?U),\s*ה?תש[א-ת]*"[א-ת]-\d{4}$"""
YEAR_ANYWHERE = r"""(?U),?\s+ה?תש[א-ת'"״]+(?:-\d{4})?"""
QUOTES = "[\"'״]"


def truthy(c: Column) -> Column:
    """A string that is neither null nor empty."""
    return c.isNotNull() & (c != "")


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def quote(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"'))


def rewrite(text: Column, pattern: str, each: Callable[[Column], Column]) -> Column:
    """text with every match of pattern put through each(match); matches must not be empty."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    joined = F.zip_with(gaps, F.transform(hits, each), lambda g, h: F.concat(F.coalesce(g, F.lit("")), F.coalesce(h, F.lit(""))))
    return F.array_join(joined, "")


def split_frontmatter(text: Column) -> tuple[Column, Column]:
    """(block, body): the block reaches from a leading "---" through the next line that begins with "---" and the line
    feed right behind those three, so block and body put together are the text."""
    close = F.locate("\n---", text, 4)
    fenced = text.startswith("---") & (close > 0)
    end = close + 3 + F.when(F.substring(text, close + 4, F.lit(1)) == "\n", 1).otherwise(0)
    return F.when(fenced, F.substring(text, F.lit(1), end)).otherwise(F.lit("")), F.when(fenced, F.substring(text, end + 1, F.length(text))).otherwise(text)


def render_frontmatter(lines: Column) -> Column:
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n"))


def field(block: Column, name: str) -> Column:
    """A scalar field of a frontmatter block, outer quotes dropped; null if absent or empty."""
    raw = F.regexp_extract(block, rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    return F.nullif(F.regexp_replace(raw, "^[\"']|[\"']$", ""), F.lit(""))


def tag_list(block: Column, name: str) -> Column:
    """A list field in block or inline form."""
    inline = F.regexp_extract(block, rf"(?m)^{name}:[ \t]*\[(.*?)\]", 1)
    listed = F.regexp_extract(block, rf"(?m)^{name}:[ \t]*\n((?:[ \t]+- .*(?:\n|$))+)", 1)
    parts = F.when(inline != "", F.split(inline, ",")).otherwise(F.split(listed, "\n"))
    clean = F.transform(parts, lambda x: F.regexp_replace(x, "^[ \\t]*(?:- )?[ \\t]*[\"']?|[\"']?[ \\t]*$", ""))
    return F.filter(clean, lambda x: x != "")


def int_list(block: Column, name: str) -> Column:
    """An inline list of integers; what is no integer is dropped."""
    parts = F.split(F.regexp_extract(block, rf"(?m)^{name}:[ \t]*\[(.*?)\]", 1), ",")
    return F.filter(F.transform(parts, lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull())


def description(title: Column, date: Column, validity: Column, brand: str, default: str = "תקף") -> Column:
    """The page description of a law."""
    year = F.when(truthy(date), F.concat(F.lit(" ("), F.substring(date, 1, 4), F.lit(")"))).otherwise("")
    status = F.when(truthy(validity), validity).otherwise(default)
    return F.concat(title, year, F.lit(" — "), status, F.lit(". "), F.lit(brand))


def title_key(c: Column) -> Column:
    """The lookup key of a law title: no year, no quotes, single spaces."""
    return squeeze(F.regexp_replace(F.regexp_replace(c, YEAR_ANYWHERE, ""), QUOTES, ""))


def strip_year(c: Column) -> Column:
    return strip(F.regexp_replace(c, YEAR_SUFFIX, ""))


def plain_title(c: Column) -> Column:
    """A title without bracketed remarks, year suffix and trailing comma."""
    bare = F.regexp_replace(c, r"(?U)\s*\[.*?\]", "")
    return strip(F.regexp_replace(strip(F.regexp_replace(bare, YEAR_SUFFIX[:-1] + r"(?:\s*\[.*?\])?$", "")), ",+$", ""))


def absolute_url(c: Column, host: str) -> Column:
    return F.when(c.startswith("//"), F.concat(F.lit("https:"), c)).when(c.startswith("/"), F.concat(F.lit(host), c)).otherwise(c)


def external_link(c: Column) -> Column:
    """The public address of an identifier address: no /id/, https."""
    return F.regexp_replace(F.replace(c, F.lit("/id/"), F.lit("/")), "^http://", "https://")


def act_slug(c: Column) -> Column:
    """type-year-number of an identifier address; null where it is none."""
    p = r"/id/([a-z]+)/(\d+)/(\d+)(?:/|$)"
    return F.when(c.rlike(p), F.concat_ws("-", *(F.regexp_extract(c, p, i) for i in (1, 2, 3))))


def escape_braces(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("{"), F.lit("\\{")), F.lit("}"), F.lit("\\}"))


def unescape_braces(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\{"), F.lit("{")), F.lit("\\}"), F.lit("}"))


def undecorated(c: Column) -> Column:
    """Rendered text without footnote marks, anchors, status notes, link targets, brackets and bold."""
    for pattern in (  # fixed values: the patterns and their order
        r"\[\^[^\]]+\]",
        r'<span id="[^"]*" */>',
        r" \(repealed(?: for [^)]+)?\)",
        r" \[(REPEALED|NOT YET IN FORCE — prospective)\]",
        r"\]\((?:https?://[^)]*|\./[a-zA-Z0-9_-]+\.md(?:#[a-zA-Z0-9_-]+)?|#[a-zA-Z0-9_-]+|)\)",
        r"[\[\]]",
        r"\*\*",
    ):
        c = F.regexp_replace(c, pattern, "")
    return squeeze(unescape_braces(c))


def valid_number(c: Column) -> Column:
    """A provision number: digits with letters, roman, letters, or a range of two."""
    one = "(?:[0-9]+[A-Z]*|[ivxlcdm]+|[a-z]+)"
    return F.coalesce(c.rlike(f"(?i)^{one}(?:[–—-]{one})?$"), F.lit(False))


def clean_ocr(c: Column) -> Column:
    """Text without what optical recognition leaves behind."""
    for pattern, to in (  # fixed values: the patterns and their order
        ("[\u200e\u200f\u202a-\u202e\u2066-\u2069]", ""),
        (r"(?U)\(\s*[₪$€£]\s*\)", ""),
        (r"(?U)(?<!\w)₪(?!\w)", ""),
        (r"[|\[\]]", ""),
        (r"(?U)\s--\s?", " "),
        (r"\\([,;.])", "$1"),
        (r"(?Umd)(?:^|\s)\\(?=\s|$)", ""),
        (r"(?Umd)\s+,\s*$", ""),
        (r"(?U),\s*,", ","),
        (r"[ \t]{2,}", " "),
    ):
        c = F.regexp_replace(c, pattern, to)
    return strip(c)


def clean_rtl(c: Column) -> Column:
    """Right-to-left text without what extraction from laid-out pages leaves behind."""
    for pattern, to in (  # fixed values: the patterns and their order
        ("([א-ת])\u00ad([א-ת])", "$1-$2"),
        ("(?U)(?<!\\w)\u00ad(\\d+)\\b", "[^$1]"),
        ("(?U)\\b(\\d+)\u00ad(?!\\w)", "[^$1]"),
        ("\u00ad", ""),
        (r"(?U)\)\s*([^()]*?[א-ת][^()]*?)\s*\(", "($1)"),
        (r"(?Um)(^|\s)\.(\d{1,3})\b", "$1$2."),
        (r"(?U),(\d+)([א-ת]\w*)", "$2 $1,"),
        (r"(\d+)([א-ת])", "$1 $2"),
        (r"([א-ת])(\d+)", "$1 $2"),
        (r"([א-ת])\(", "$1 ("),
        (r"\)([א-ת])", ") $1"),
        (r"[ \t]{2,}", " "),
        (r"[ \t]+\n", "\n"),
    ):
        c = F.regexp_replace(c, pattern, to)
    return c


def meaningful(c: Column, least: int = 2) -> Column:
    return (F.regexp_count(c, F.lit("[א-ת]")) >= least) & ~c.rlike(r"(?U)^[\s\W_]+$")


def unfenced(c: Column) -> Column:
    """A model's answer without an outer code fence."""
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"^```[a-zA-Z]*\n", ""), r"\n?```$", ""))


def chunks(c: Column, size: int) -> Column:
    """Pieces of at most size characters; one empty piece of an empty text."""
    n = F.greatest(F.ceil(F.length(c) / size).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(c, i * size + 1, F.lit(size)))


@F.pandas_udf(StringType())
def _ascii(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition without what isn't ASCII: no built-in function decomposes letters."""
    return texts.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def slug(name: Column, key: Column) -> Column:
    """ASCII slug of a title with its kind in front and its year behind; the id where no letter is left."""
    text = F.regexp_replace(F.regexp_replace(strip(name), "[\u05b0-\u05c7]", ""), r"""[:\.,;()\[\]"'״׳]""", " ")
    basic, law = text.rlike("^חוק[- ]יסוד"), text.startswith("חוק")
    kind = F.when(basic, "basic-law-").when(law, "law-").otherwise("")
    bare = F.when(basic, F.regexp_replace(text, r"(?U)^חוק.יסוד\s*", "")).when(law, F.regexp_replace(text, r"(?U)^חוק\s*", "")).otherwise(text)
    year = F.regexp_extract(name, r"(?U)(\d{4})", 1)
    plain = F.regexp_replace(F.regexp_replace(_ascii(bare), r"[^a-zA-Z0-9\s-]", ""), r"^\s+|\s+$", "")
    plain = F.regexp_replace(F.regexp_replace(F.lower(plain), r"[\s-]+", "-"), "^-+|-+$", "")
    ended = F.concat(kind, plain, F.when(year != "", F.concat(F.lit("-"), year)).otherwise(""))
    by_id = F.concat(F.when(kind == "", "law-").otherwise(kind), key.cast("string"))
    return F.lower(F.regexp_replace(F.when(plain == "", by_id).otherwise(ended), "-+", "-"))


def title_category(name: Column) -> Column:
    """The category that a title's first words tell."""
    return F.when(strip(name).rlike("^חוק[- ]יסוד"), "basic-laws").otherwise("civil-law")


def hebrew_year(footnotes: Column) -> Column:
    """The first year in Hebrew letters in an array of footnotes, null where there is none."""
    return F.nullif(F.regexp_extract(F.array_join(footnotes, " "), 'ה?ת[שרקצפ][א-ת]"[א-ת]', 0), F.lit(""))


def tidy(c: Column) -> Column:
    """Plain hyphens, no space before closing punctuation, single spaces, subsection marks in straight brackets."""
    for pattern, to in (
        ("\u00ad", "-"),
        (r"[ \t]+([.,;:])", "$1"),
        (r"\)([א-ת]{1,2}|\d{1,3})\(", "($1)"),
        (" {2,}", " "),
    ):
        c = F.regexp_replace(c, pattern, to)
    return c


def without_margin_prefix(line: Column, phrases: Column) -> Column:
    """A list line without the margin note that recognition put before it.

    The longest of the known phrases that the line begins with goes; then up to six words before a section number go,
    unless they end a sentence or hold a bracket.
    """
    s = strip(line)
    fitting = F.filter(phrases, lambda p: F.startswith(s, p) & (F.length(p) < F.length(s) - 1))
    by_length = F.array_sort(F.transform(fitting, lambda p: F.struct((-F.length(p)).alias("n"), p.alias("p"))))
    first = F.get(by_length, F.lit(0))["p"]
    s = F.when(first.isNotNull(), F.regexp_replace(F.substring(s, F.length(first) + 1, F.length(s)), "^[ ,.|-]+", "")).otherwise(s)
    at = F.regexp_instr(s, F.lit(r"(?U)(?<![\d.])(\d{1,2})(?:\s*\.)?\s+(?=[\(א-ת])"))
    lead = strip(F.substring(s, F.lit(1), at - 1))
    short = (lead != "") & (F.size(F.split(lead, r"(?U)\s+")) <= 6) & ~lead.rlike("[.:;]$") & ~F.contains(lead, F.lit("("))
    return F.when((at > 1) & short, F.substring(s, at, F.length(s))).otherwise(s)


def year_of(c: Column) -> Column:
    return F.substring(c, 1, 4).try_cast("int")


def iso_date(c: Column) -> Column:
    """yyyy-MM-dd of a date-like string, else its first ten characters."""
    return F.coalesce(F.date_format(F.try_to_date(c, "yyyy-MM-dd"), "yyyy-MM-dd"), F.substring(c, 1, 10))
