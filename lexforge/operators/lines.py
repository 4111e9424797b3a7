"""Line operators: explode and rebuild, anchors, references, margin notes, dictionary links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.text import rewrite

#: Fixed: a numbered heading, the anchors of earlier passes, references to sections and the links made of them.
HEADING = r"(?s)^(#{1,2} )(\d+)([א-ת]?)((?:\([^)]+\))*)(\.)(.*)$"
OLD_ANCHOR = r"""(?U)\s*(?:\{#section-\d+\}|<span id="section-\d+" />)"""

#: What a reference begins with is looked for first, as that rules out nearly every place at once.
REFERENCE = r"(?=[לבמכס])(?<![/א-ת\[#])([לבמכ]?(?:סעיף|סעיפים|סעיפי))\s+(\d+)(?!\d)([א-ת]?(?:\([^)]+\))*)(?![א-ת]?\s+ל(?:חוק(?!\s+זה)|פקודת|תקנות|דבר\s+המלך))"
REFERENCE_LINK = r"\[([לבמכ]?(?:סעיף|סעיפים|סעיפי)\s+\d+[א-ת]?(?:\([^)]+\))*)\]\(#section-\d+\)"

#: An index that an earlier pass put in: its first bullet with what stands before it, then bullet by bullet.
OLD_INDEX = r"(?:\n+(?:##+ (?:Sidenotes|הערות גיליון)\n\n?)?|(?<=\n)\G)- \[[^\]]*\]\(#section-\d+\)\n"


def explode_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos, line)"""
    return docs.select(key, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))


def rebuild(lines: DataFrame, key: str = "doc_id", name: str = "text") -> DataFrame:
    """(key, name): lines joined in their order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return lines.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias(name))


def section_anchors(lines: DataFrame, heading: str = HEADING, number: int = 2) -> DataFrame:
    """Numbered headings get an anchor span; column anchor holds its id. Lettered sections share the base number's."""
    hit = F.col("line").rlike(heading)
    anchor = F.when(hit, F.concat(F.lit("section-"), F.regexp_extract("line", heading, number)))
    # the long searches are made only where their first or last letters stand
    spaced = F.substring("line", -1, 1).rlike(r"(?U)\s")
    ended = F.when(spaced, F.regexp_replace("line", r"(?U)\s+$", "")).otherwise(F.col("line"))
    old = F.contains("line", F.lit("{#section-")) | F.contains("line", F.lit('<span id="section-'))
    clean = F.when(old, F.regexp_replace(ended, OLD_ANCHOR, "")).otherwise(ended)
    lined = F.when(hit, F.concat(clean, F.lit(' <span id="'), anchor, F.lit('" />'))).otherwise(F.col("line"))
    return lines.withColumns({"anchor": anchor, "line": lined})


def carried(lines: DataFrame, anchor: str = "anchor", key: str = "doc_id") -> DataFrame:
    """Each line with the last anchor at or before it (column current)."""
    by = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("current", F.last(anchor, ignorenulls=True).over(by))


def margin_notes(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, current, note): one-line quotes under an anchor."""
    notes = carried(lines, key=key).filter(F.col("line").startswith("> ") & F.col("current").isNotNull())
    return notes.select(key, "pos", "current", F.trim(F.expr("substring(line, 3)")).alias("note")).filter("note <> ''")


def margin_index(lines: DataFrame, key: str = "doc_id", title: str = "## Sidenotes") -> DataFrame:
    """(key, index): the list of margin notes with links to their sections."""
    bullet = F.concat(F.lit("- ["), F.col("note"), F.lit("](#"), F.col("current"), F.lit(")"))
    notes = margin_notes(lines, key).select(key, "pos", bullet.alias("line"))
    return rebuild(notes, key, "index").withColumn("index", F.concat(F.lit(f"\n\n{title}\n\n"), "index"))


def with_margin_index(docs: DataFrame, lines: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document without an old index and, where its lines hold margin notes, with a new one at its end."""
    clean = F.regexp_replace(text, OLD_INDEX, "")
    ended = F.concat(F.regexp_replace(clean, r"(?U)\s+$", ""), F.col("index"), F.lit("\n"))
    met = docs.join(margin_index(lines, key), key, "left")
    return met.withColumn(text, F.when(F.col("index").isNull(), clean).otherwise(ended)).select(*docs.columns)


def linked_references(lines: DataFrame, known: DataFrame, pattern: str, number: str = r"(\d+)", key: str = "doc_id", old: str | None = None) -> DataFrame:
    """References whose number is a section of the same document become links; quoted lines stay.

    known: (key, num) of sections. Only the numbers that lines name are joined to the sections, a row each, so a
    document's sections are never copied to its lines. old: links of an earlier pass, undone first (pattern, its
    group 1 being the words); documents without any section stay as they are.

    What a line asks for are the numbers it names and, where an old link is undone, whether there is any section, so
    lines meet what was found once. Conditions stand within generators: a filter would be moved below and search
    every line again.
    """
    mark = lambda num: F.concat(F.lit("#"), num)
    sections = known.select(key, F.explode(F.array(mark(F.col("num")), F.lit("any"))).alias("_num")).distinct()
    plain = lines.withColumn("_plain", F.regexp_replace("line", old, "$1") if old else F.col("line"))
    named = F.transform(F.regexp_extract_all("_plain", F.lit(pattern), F.lit(0)), lambda m: mark(F.regexp_extract(m, number, 1)))
    none = F.array().cast("array<string>")
    nums = F.when(~F.col("_plain").startswith(">"), F.array_distinct(named)).otherwise(none)
    undone = F.when(F.col("_plain") != F.col("line"), F.array(F.lit("any"))).otherwise(none)
    asked = plain.select(key, "pos", F.explode(F.concat(nums, undone)).alias("_num"))
    found = asked.join(sections, [key, "_num"], "left_semi").groupBy(key, "pos").agg(F.collect_list("_num").alias("_nums"))
    met = lines.join(found, [key, "pos"], "left")

    def link(m: Column) -> Column:
        n = F.regexp_extract(m, number, 1)
        shown = F.regexp_replace(m, r"\s+(\d)", " $1")
        return F.when(F.array_contains("_nums", mark(n)), F.concat(F.lit("["), shown, F.lit("](#section-"), n, F.lit(")"))).otherwise(m)

    # the line is bound to a lambda variable, so old links are undone once
    plain = F.array(F.regexp_replace("line", old, "$1") if old else F.col("line"))
    lined = F.when(F.col("_nums").isNull(), F.col("line")).otherwise(F.get(F.transform(plain, lambda x: rewrite(x, pattern, link)), F.lit(0)))
    return met.withColumn("line", lined).select(*lines.columns)


def section_links(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines that section_anchors() gave anchors, with references to sections of the document as links."""
    num = F.array(F.regexp_extract("anchor", r"(\d+)", 1))
    known = lines.select(key, F.explode(F.when(F.col("anchor").isNotNull(), num)).alias("num"))
    return linked_references(lines, known, REFERENCE, key=key, old=REFERENCE_LINK)


def found_names(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, name) of the names that occur in a text, wherever a word they begin or end in starts or ends.

    Any number of names will do. The words inside a name, between its first and its last, must stand whole in the
    text, so texts and names meet by an equi-join on runs of up to three of them; a name of one or two words
    can lie within longer words, so it meets the words of the corpus that hold its longest word. Whole names are
    then looked for in the texts that they met.
    """
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    keyed = names.select("name").filter("name <> ''").distinct().withColumn("w", words(F.col("name")))
    inner = keyed.filter((F.size("w") > 2) & (F.col("name") == F.trim("name")))
    inner = inner.withColumn("m", F.least(F.size("w") - 2, F.lit(3))).select("name", "m", F.array_join(F.slice("w", F.lit(2), F.col("m")), " ").alias("run"))
    sizes = [r.m for r in inner.select("m").distinct().collect()]  # of 1, 2 and 3
    rows = docs.select(key, words(F.col(text)).alias("w"))
    # the words are bound to a lambda variable, so a text is split once and not for every run
    window = lambda m: lambda w: F.array_distinct(F.transform(w, lambda x, i: F.array_join(F.slice(w, i + 1, F.lit(m)), " ")))
    met = None
    for m in sorted(sizes):
        runs = F.get(F.transform(F.array(words(F.col(text))), window(m)), F.lit(0))
        some = docs.select(key, F.explode(runs).alias("run"))
        hit = some.join(inner.filter(F.col("m") == m), "run").select(key, "name")
        met = hit if met is None else met.unionByName(hit)
    within = keyed.filter((F.size("w") <= 2) | (F.col("name") != F.trim("name")))
    longest = F.array_max(F.transform("w", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    within = within.select("name", F.coalesce(longest["w"], F.lit("")).alias("part"))
    lengths = [r.n for r in within.select(F.length("part").alias("n")).distinct().collect()]
    if lengths:
        stock = rows.select(F.explode("w").alias("word")).distinct()
        cut = lambda n: lambda i: F.substring("word", i, F.lit(n))
        places = lambda n: F.sequence(F.lit(1), F.greatest(F.length("word") - n + 1, F.lit(1)))
        pieces = F.flatten(F.array(*(F.transform(places(n), cut(n)) for n in lengths)))
        held = stock.select("word", F.explode(F.array_distinct(pieces)).alias("part")).join(within, "part").select("word", "name").distinct()
        hit = rows.select(key, F.explode(F.array_distinct("w")).alias("word")).join(held, "word").select(key, "name")
        met = hit if met is None else met.unionByName(hit)
    if met is None:
        return docs.select(key).limit(0).withColumn("name", F.lit(""))
    return met.distinct().join(docs.select(key, text), key).filter(F.contains(text, F.col("name"))).select(key, "name")


def dictionary_links(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", hosts: str | None = None) -> DataFrame:
    """Names (name, url) found in the text become links, longest first, in one pass; linked text is not touched.

    Each document is searched for the names alone that found_names() gives for it. In one pass no name is linked
    within the words of another's link; where names are replaced one after another, a shorter name in the middle of a
    longer one is. hosts: a pattern; links to such hosts or to relative files that an earlier pass put in are undone
    first. A name with two urls has the smallest.
    """
    plain = docs if hosts is None else docs.withColumn(text, unlinked(F.col(text), hosts))
    one = names.groupBy("name").agg(F.min("url").alias("url"))
    order = F.struct((-F.length("name")).alias("n"), "name", "url")
    found = found_names(plain, one, key, text).join(one, "name").groupBy(key).agg(F.array_sort(F.collect_list(order)).alias("_names"))
    met = plain.join(found, key, "left")
    return met.withColumn(text, F.when(F.col("_names").isNull(), F.col(text)).otherwise(linked_names(F.col(text), F.col("_names"), "name"))).select(*docs.columns)


def linked_names(text: Column, names: Column, name: str = "found") -> Column:
    """The text with each of its own names, an ordered array of (name, url), as a link; linked words are left alone."""
    escaped = F.transform(names, lambda x: F.regexp_replace(x[name], r"([\\.\[\]{}()*+\-?^$|#&~])", r"\\$1"))
    pattern = F.concat(F.lit(r"(?<!\[)(?:"), F.array_join(escaped, "|"), F.lit(r")(?!\]\()"))
    urls = F.map_from_entries(F.transform(names, lambda x: F.struct(x[name], x["url"])))
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    links = F.transform(hits, lambda m: F.concat(F.lit("["), m, F.lit("]("), F.element_at(urls, m), F.lit(")")))
    return F.array_join(F.zip_with(gaps, links, lambda g, h: F.concat(F.coalesce(g, F.lit("")), F.coalesce(h, F.lit("")))), "")


def unlinked(c: Column, hosts: str) -> Column:
    """Text without links that an earlier pass put in: ones to numbered files, then ones to hosts (a pattern)."""
    own = F.regexp_replace(c, r"\[([^\[\]]+)\]\(\./\d+\.md\)", "$1")
    return F.regexp_replace(own, rf"\[([^\[\]]+)\]\(https://(?:{hosts})/[^)]+\)", "$1")


def first_difference(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos): the first line at which two versions differ."""
    met = a.alias("a").join(b.alias("b"), [key, "pos"], "full")
    return met.filter(~F.col("a.line").eqNullSafe(F.col("b.line"))).groupBy(key).agg(F.min("pos").alias("pos"))
