"""Column functions on whole Markdown documents: frontmatter of a law, source footers, descriptions, tails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions.text import description, quote, render_frontmatter, strip, strip_year, truthy

#: Fixed: the words of a source link, its icon, and the headings that end a document.
SOURCE = "מסמך המקור באתר הכנסת"
ICON = "[![מסמך PDF](/img/pdf-icon.svg)]"
SIDENOTES = "## Sidenotes"


def verbatim(c: Column) -> Column:
    """A string as the replacement of a pattern, its dollar signs and backslashes escaped."""
    return F.regexp_replace(c, r"([\\$])", r"\\$1")


def law_frontmatter(entry: dict[str, Column], brand: str, maker: str, model: str, now: Column) -> Column:
    """The frontmatter of a catalog row; a line whose value is missing is left out.

    entry: columns law_id, bill_id, name_he, publication_date, latest_publication_date, is_basic_law, is_budget_law,
    law_validity, category, tags (array of names), ministry_ids (array of numbers) and pdf_url.
    """
    e = entry
    title = strip_year(F.coalesce(e["name_he"], F.lit("")))
    published, latest = first_date(e["publication_date"]), first_date(e["latest_publication_date"])
    line = lambda name, c: F.concat(F.lit(f"{name}: "), c)
    when = lambda name, c, shown=None: F.when(truthy(c), line(name, c if shown is None else shown))
    tags = tag_lines(e["tags"])
    lines = F.array(
        F.when(e["law_id"].isNotNull() & (e["law_id"] != 0), line("law_id", e["law_id"].cast("string"))).otherwise(line("bill_id", F.coalesce(e["bill_id"].cast("string"), F.lit("None")))),
        line("title", quote(title)),
        line("title_he", quote(title)),
        line("sidebar_label", quote(title)),
        line("description", quote(description(title, published, e["law_validity"], brand))),
        F.lit("hide_table_of_contents: true"),
        line("publication_date", F.when(truthy(published), published).otherwise("~")),
        when("latest_publication_date", changed_date(published, latest)),
        F.when(e["is_basic_law"], "is_basic_law: true"),
        F.when(e["is_budget_law"], "is_budget_law: true"),
        when("law_validity", e["law_validity"], F.concat(F.lit('"'), e["law_validity"], F.lit('"'))),
        when("category", e["category"]),
        F.when(tags != "", F.concat(F.lit("law_tags:\n"), tags)),
        F.when(F.size(e["ministry_ids"]) > 0, line("ministry_ids", id_list(e["ministry_ids"]))),
        line("source_pdf", F.coalesce(e["pdf_url"], F.lit(""))),
        F.lit(f"generated_by: {maker}"),
        F.lit(f"model: {model}"),
        line("generated_at", now),
    )
    return render_frontmatter(F.array_compact(lines))


def first_date(c: Column) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, 10)


def changed_date(published: Column, latest: Column) -> Column:
    """The latest date where there is one that differs from the first."""
    return F.when(truthy(latest) & ~latest.eqNullSafe(published), latest)


def as_at(valid: Column, retrieved: Column) -> Column:
    """The date that a text stands for: its valid date, else when it was retrieved."""
    return F.coalesce(F.nullif(valid, F.lit("")), retrieved)


def tag_lines(tags: Column) -> Column:
    """Quoted list items of the tags that aren't empty."""
    return F.array_join(F.transform(F.filter(tags, truthy), lambda x: F.concat(F.lit('  - "'), x, F.lit('"'))), "\n")


def id_list(ids: Column) -> Column:
    """Numbers as a JSON array with a space behind each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(ids, lambda x: x.cast("string")), ", "), F.lit("]"))


def source_link(url: Column) -> Column:
    return F.concat(F.lit(f"{ICON}("), url, F.lit(f") [{SOURCE}]("), url, F.lit(")"))


def with_footer(text: Column, url: Column) -> Column:
    """The text with a source link at its end, where there is an address."""
    ended = F.concat(F.regexp_replace(text, r"(?U)\s+$", ""), F.lit("\n\n---\n\n"), source_link(url), F.lit("\n"))
    return F.when(truthy(url), ended).otherwise(text)


def without_footer(text: Column) -> Column:
    """The text before its source footer and its index of side notes."""
    bare = F.regexp_replace(text, rf"(?s)\n+---\n+\[{SOURCE.split()[0]} {SOURCE.split()[1]}.*$", "")
    return F.regexp_replace(bare, rf"(?s)\n+{SIDENOTES}\n.*$", "")


def source_address(text: Column) -> Column:
    """The source_pdf field of a document, null where it has none."""
    return F.nullif(strip(F.regexp_extract(text, r"(?md)^source_pdf:\s*(.+)$", 1)), F.lit(""))


def repaired_footer(text: Column) -> Column:
    """struct(status, text): the source link brought into its present form.

    A link in the old form or its bare words are replaced where they stand; where there is none, a footer goes before
    the index of side notes or to the end.
    """
    url = source_address(text)
    link = source_link(url)
    old, bare, ruled = rf"\[{SOURCE}\]\([^)]+\)", rf"(?<!\[){SOURCE}(?!\])", rf"---\s*\n\n{SOURCE}"
    at = F.regexp_instr(text, F.lit(rf"(?U)\n{SIDENOTES}\b"))
    block = F.concat(F.lit("\n\n---\n\n"), link, F.lit("\n"))
    inserted = F.concat(F.substring(text, F.lit(1), at - 1), block, F.substring(text, at, F.length(text)))
    cases = [
        (url.isNull(), "skip (no source_pdf)", text),
        (F.contains(text, F.concat(F.lit(f"{ICON}("), url, F.lit(")"))), "ok (already new format)", text),
        (text.rlike(old), "fixed (old link → new format)", F.regexp_replace(text, F.lit(old), verbatim(link))),
        (text.rlike(bare) & text.rlike(ruled), "fixed (plain text → new format)", F.regexp_replace(text, F.lit(ruled), verbatim(F.concat(F.lit("---\n\n"), link)))),
        (text.rlike(bare), "fixed (plain text → new format)", F.regexp_replace(text, F.lit(bare), verbatim(link))),
        (at > 0, "fixed (missing → added)", inserted),
    ]
    out = F.struct(F.lit("fixed (missing → added)").alias("status"), with_footer(text, url).alias("text"))
    for case, status, changed in reversed(cases):
        out = F.when(case, F.struct(F.lit(status).alias("status"), changed.alias("text"))).otherwise(out)
    return out


def described(text: Column, brand: str) -> Column:
    """struct(status, text): a description, and a title where there is none, put behind the title_he line once."""
    value = lambda name: strip(F.regexp_extract(text, rf'(?m)^{name}:\s*"?([^"\n]*)"?\s*$', 1))
    line = r'(?m)^title_he:\s*"[^"\n]*"\s*\n'
    found, at = F.regexp_extract(text, line, 0), F.regexp_instr(text, F.lit(line))
    head = F.when(text.rlike("(?m)^title:"), F.lit("")).otherwise(F.concat(F.lit('title: "'), value("title_he"), F.lit('"\n')))
    made = F.concat(F.lit("description: "), quote(description(value("title_he"), value("publication_date"), value("law_validity"), brand)), F.lit("\n"))
    end = at + F.length(found)
    new = F.concat(F.substring(text, F.lit(1), end - 1), head, made, F.substring(text, end, F.length(text)))
    state = F.when(text.rlike("(?m)^description:"), "ok (already has description)").when(value("title_he") == "", "skip (no title_he)").when(found == "", "skip (title_he line not matched)").otherwise("fixed")
    return F.struct(state.alias("status"), F.when(state == "fixed", new).otherwise(text).alias("text"))


def cut_from(text: Column, marker: str) -> Column:
    """The text before the first line that begins with marker, without white space at its end."""
    at = F.instr(text, f"\n{marker}")
    place = F.when(at > 0, at).otherwise(F.instr(text, marker))
    return F.regexp_replace(F.when(place > 0, F.substring(text, F.lit(1), place - 1)).otherwise(text), r"(?U)\s+$", "")


def lines_from(text: Column, first: int) -> Column:
    """The lines of a text from line number first (1 and up) on."""
    lines = F.split(F.regexp_replace(text, r"\n$", ""), "\n", -1)
    return F.array_join(F.slice(lines, F.lit(first), F.greatest(F.size(lines) - first + 1, F.lit(0))), "\n")


def tail_repaired(text: Column, marker: str, tail: Column) -> Column:
    """A text cut at marker with a newly made tail put on."""
    return F.concat(cut_from(text, marker), F.lit("\n\n"), tail, F.lit("\n"))
