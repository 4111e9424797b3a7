"""Rendering of parsed legislation as Markdown, of a whole batch at a time.

Works on the rows that lexforge.sources.clml.parse() gives. Every event of running text becomes a string of its own by
its kind alone, because changes come as open and close events; a text is then an ordered concatenation, and a document
an ordered concatenation of blocks. Which links stay within the batch is settled by joins with the anchors of all its
documents, so no document has to be rendered before another. Nothing is collected: documents are independent keys.
The rows are read for each kind of block, so they should come from a table, or be cached, and not be parsed each time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.text import act_slug, escape_braces, external_link, quote, strip, truthy
from lexforge.operators.links import decided
from lexforge.operators.tree import CONTAINERS, NO_ANCHOR

TRAIL, LATE = 1 << 30, (1 << 30) + 1
#: Fixed: what stands for a repealed text, and the marks and headings of a rendered document.
ELLIPSIS = ". . . . . ."
STATES = {"Repealed": " **[REPEALED]**", "Prospective": " **[NOT YET IN FORCE — prospective]**"}
QUOTED = "> [Quoted block text — not this Act's own numbered provision]\n"
TERMS = "## Defined Terms"
NOTES = "## Editorial Notes\n\nNotes recorded by the source publisher and not tied to a specific inline amendment marker above:\n\n"
UNAPPLIED = (" change(s) not yet applied to this Act.** ", "has recorded amendments that are not yet incorporated into the text below:")


def joined(order: str, value: str, sep: str = ""):
    """An aggregate: values in their order, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), sep)


def anchors(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, anchor) of every provision that gets one."""
    own = rows.filter((F.col("row") == "provision") & ~F.col("kind").isin(*NO_ANCHOR) & truthy(F.col("id")))
    return own.select(key, F.col("id").alias("anchor")).distinct()


def citations(rows: DataFrame, slugs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, row, path, target_slug, target, link) of every citation with an address.

    slugs: (key, slug) of the batch. The link is null where a document cites itself as a whole.
    """
    cited = rows.filter((F.col("kind") == "citation") & truthy(F.col("uri")) & F.col("row").isin("run", "note_run"))
    cited = cited.select(key, "row", "path", "uri", "target", act_slug(F.col("uri")).alias("slug"))
    named = slugs.select(key, F.col("slug").alias("own"))
    known = anchors(rows, key).join(slugs, key).select("slug", F.col("anchor").alias("target"), F.lit(True).alias("known")).distinct()
    parsed = rows.filter("row <> 'finding'").select(key).distinct().join(slugs, key).select("slug", F.lit(True).alias("parsed")).distinct()
    batch = slugs.select("slug", F.lit(True).alias("listed")).distinct()
    met = cited.join(named, key, "left").join(batch, "slug", "left").join(parsed, "slug", "left").join(known, ["slug", "target"], "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    itself, held = yes(F.col("slug") == F.col("own")), yes(F.col("known"))
    kept = F.when(held | (~itself & ~yes(F.col("parsed"))), F.col("target"))
    link = decided(F.col("slug"), F.col("target"), F.coalesce("own", F.lit("")), yes(F.col("listed")), yes(F.col("parsed")), held, external_link(F.col("uri")))
    inside = yes(F.col("listed")) & (truthy(kept) | ~itself)
    return met.select(key, "row", "path", F.when(inside, F.col("slug")).alias("target_slug"), F.when(inside, kept).alias("target"), link.alias("link"))


def events(rows: DataFrame, slugs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The events of running texts with column shown: what each of them puts into the text."""
    runs = rows.filter(F.col("row").isin("run", "note_run"))
    cited = citations(rows, slugs, key).select(key, "row", "path", "link")
    met = runs.join(cited, [key, "row", "path"], "left")
    words = escape_braces(F.coalesce("text", F.lit("")))
    mark = F.when(truthy(F.col("ref")), F.concat(F.lit("[^f"), F.col("ref"), F.lit("]"))).otherwise("")
    note = F.when(F.col("status") == "repeal", F.concat(F.lit(" (repealed"), F.when(truthy(F.col("extent")), F.concat(F.lit(" for "), F.col("extent"))).otherwise(""), F.lit(")"))).otherwise("")
    shown = (
        F.when(F.col("kind") == "open", F.lit("["))
        .when(F.col("kind") == "close", F.concat(F.lit("]"), mark, note))
        .when(F.col("kind") == "repeal", F.concat(F.lit(ELLIPSIS), mark))
        .when(F.col("kind") == "commentary", mark)
        .when((F.col("kind") == "citation") & F.col("link").isNotNull(), F.concat(F.lit("["), words, F.lit("]("), F.col("link"), F.lit(")")))
        .when(F.col("kind") == "emphasis", F.concat(F.lit("*"), words, F.lit("*")))
        .otherwise(words)
    )
    return met.withColumn("shown", shown)


def footnotes(shown: DataFrame, rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ref, place, anchors): one footnote for each commentary that a text refers to, by first use.

    A commentary that another one refers to stands before it; those that only unused commentaries refer to come last.
    """
    used = shown.filter("row = 'run'").filter(truthy(F.col("ref"))).select(key, "ref", "path", "anchor")
    inner = shown.filter("row = 'note_run'").filter(truthy(F.col("ref"))).select(key, F.col("id").alias("by"), "ref", F.element_at("path", -1).alias("i"))
    places = used.groupBy(key, "ref").agg(F.min(F.concat("path", F.array(F.lit(1)))).alias("place"))

    inner_empty = not inner.limit(1).count()
    def closed(found: DataFrame) -> DataFrame:
        """With the commentaries that those found refer to, level by level until no new ones come."""
        new = found
        while not inner_empty:
            nested = F.concat(F.slice("place", F.lit(1), F.size("place") - 1), F.array(F.lit(0), F.col("i"), F.lit(1)))
            below = new.withColumnRenamed("ref", "by").join(inner, [key, "by"]).select(key, "ref", nested.alias("place")).groupBy(key, "ref").agg(F.min("place").alias("place"))
            head = F.size("_old") - 1
            # a commentary within itself is not met again
            itself = F.slice("place", F.lit(1), F.coalesce(head, F.lit(0))) == F.slice("_old", F.lit(1), F.coalesce(head, F.lit(0)))
            met = below.join(found.select(key, "ref", F.col("place").alias("_old")), [key, "ref"], "left")
            below = met.filter(F.col("_old").isNull() | ((F.col("place") < F.col("_old")) & ~itself)).drop("_old")
            if not below.limit(1).count():
                break
            found = found.unionByName(below).groupBy(key, "ref").agg(F.min("place").alias("place"))
            new = below
        return found

    body = closed(places)
    bare = rows.filter("row = 'commentary' and text <> ''").select(key, F.col("id").alias("ref"), F.element_at("path", 1).alias("n"))
    unused = bare.join(body, [key, "ref"], "left_anti")
    late = unused.withColumnRenamed("ref", "by").join(inner, [key, "by"]).select(key, "ref", F.array(F.lit(LATE), F.col("n"), F.col("i"), F.lit(1)).alias("place"))
    late = late.join(body, [key, "ref"], "left_anti").groupBy(key, "ref").agg(F.min("place").alias("place"))
    everything = body if inner_empty else body.unionByName(closed(late).join(body, [key, "ref"], "left_anti"))
    held = used.filter(truthy(F.col("anchor"))).groupBy(key, "ref", "anchor").agg(F.min("path").alias("path"))
    listed = held.groupBy(key, "ref").agg(F.transform(F.array_sort(F.collect_list(F.struct("path", "anchor"))), lambda x: x["anchor"]).alias("anchors"))
    return everything.join(listed, [key, "ref"], "left")


def provision_blocks(rows: DataFrame, shown: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, path, block): headings with what belongs to them, and texts before and behind the children."""
    doc_extent = rows.filter("row = 'meta' and kind = 'RestrictExtent'").select(key, F.col("text").alias("_extent"))
    slot = F.slice("path", F.lit(1), F.size("path") - 1)
    texts = shown.filter("row = 'run'").select(key, slot.alias("slot"), F.element_at("path", -1).alias("i"), "shown").groupBy(key, "slot").agg(joined("i", "shown").alias("body"))
    texts = texts.select(key, F.slice("slot", F.lit(1), F.size("slot") - 1).alias("path"), F.element_at("slot", -1).alias("part"), "body")
    lead, tail = (texts.filter(F.col("part") == n).drop("part") for n in (0, TRAIL))
    own = rows.filter("row = 'provision'").join(doc_extent, key, "left").join(lead, [key, "path"], "left")
    some = lambda c: F.nullif(c, F.lit(""))
    number, heading = some(F.col("number")), some(F.col("heading"))
    group = F.col("kind").isin(*CONTAINERS)
    label = F.when(F.col("kind") == "section", F.concat(number, F.lit("."))).otherwise(F.concat(F.lit("("), number, F.lit(")")))
    title = F.when(group, F.concat_ws(" — ", number, heading)).otherwise(F.coalesce(some(F.concat_ws(" ", label, heading)), F.lit("(unnumbered)")))
    state = F.lit("")
    for name, mark in STATES.items():
        state = F.when(F.col("status") == name, mark).otherwise(state)
    span = F.when(truthy(F.col("id")), F.concat(F.lit(' <span id="'), F.col("id"), F.lit('" />'))).otherwise("")
    head = F.concat(F.repeat(F.lit("#"), F.least(F.col("level"), F.lit(6))), F.lit(" "), title, F.when(group, "").otherwise(state), span, F.lit("\n\n"))
    enabled = F.when((F.col("kind") == "schedule") & truthy(F.col("ref")), F.concat(F.lit("> [Enabled by — "), F.col("ref"), F.lit("]\n\n"))).otherwise("")
    extent = F.when(truthy(F.col("extent")) & ~F.col("extent").eqNullSafe(F.col("_extent")), F.concat(F.lit("> [Extent — "), title, F.lit("] "), F.col("extent"), F.lit("\n\n"))).otherwise("")
    text = strip(F.coalesce("body", F.lit("")))
    block = F.concat(head, enabled, extent, F.when(group | (text == ""), "").otherwise(F.concat(text, F.lit("\n\n"))))
    lines = F.regexp_replace(text, "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85  ]", "\n> ")
    quoted = F.concat(F.lit(QUOTED), F.lit("> "), lines, F.lit("\n\n"))
    bare = F.concat(F.coalesce("body", F.lit("")), F.lit("\n\n"))
    first = own.select(key, "path", F.when(F.col("kind") == "block_quote", quoted).when(F.col("kind").isin("uncertain", "table"), bare).otherwise(block).alias("block"))
    behind = tail.filter(strip(F.col("body")) != "").select(key, F.concat("path", F.array(F.lit(TRAIL))).alias("path"), F.concat(strip(F.col("body")), F.lit("\n\n")).alias("block"))
    return first.unionByName(behind)


def frontmatter(rows: DataFrame, retrieved: str, maker: str, key: str = "doc_id") -> DataFrame:
    """(key, block): the fields of each document, ~ for what is missing."""
    effects = rows.filter("row = 'effect'").groupBy(key).agg(F.count("*").alias("effects"))
    names = ("title", "long_title", "Year", "Number", "EnactmentDate", "DocumentMainType", "DocumentStatus", "valid", "RestrictExtent", "NumberOfProvisions", "publisher")
    meta = rows.filter("row = 'meta'").groupBy(key).agg(*(F.max(F.when(F.col("kind") == n, F.col("text"))).alias(n) for n in names)).join(effects, key, "left")
    bare = lambda label, n: F.concat(F.lit(f"{label}: "), F.coalesce(F.nullif(F.col(n), F.lit("")), F.lit("~")))
    worded = lambda label, n: F.concat(F.lit(f"{label}: "), quote(F.coalesce(n, F.lit(""))))
    lines = (
        F.lit("---"), worded("title", "title"), worded("long_title", "long_title"), bare("year", "Year"), bare("chapter", "Number"), bare("enactment_date", "EnactmentDate"),
        bare("document_main_type", "DocumentMainType"), bare("document_status", "DocumentStatus"), bare("valid_date", "valid"),
        F.concat(F.lit('as_at: "'), F.coalesce(F.nullif("valid", F.lit("")), F.lit(retrieved)), F.lit('"')), bare("extent", "RestrictExtent"), bare("number_of_provisions", "NumberOfProvisions"),
        F.concat(F.lit("unapplied_effects_count: "), F.coalesce("effects", F.lit(0)).cast("string")), F.when(truthy(F.col("publisher")), worded("publisher", "publisher")).otherwise("publisher: ~"),
        F.lit("jurisdiction: uk"), F.lit(f"generated_by: {maker}"), F.lit(f"retrieved_at: {retrieved}"), F.lit("---"), F.lit(""),
    )
    return meta.select(key, F.concat_ws("\n", *lines).alias("block"))


def banner(rows: DataFrame, publisher: str, key: str = "doc_id") -> DataFrame:
    """(key, block): the changes that a text does not hold yet."""
    line = F.concat(F.lit("> - "), F.coalesce(F.nullif("ref", F.lit("")), F.lit("unspecified provision(s)")), F.lit(": "), "kind", F.lit(" (by *"), "text", F.lit("*)"))
    some = rows.filter("row = 'effect'").select(key, "path", line.alias("line")).groupBy(key).agg(F.count("*").alias("n"), joined("path", "line", "\n").alias("lines"))
    return some.select(key, F.concat(F.lit("> **"), F.col("n").cast("string"), F.lit(f"{UNAPPLIED[0]}The source publisher ({publisher}) {UNAPPLIED[1]}\n>\n"), "lines", F.lit("\n\n")).alias("block"))


def term_index(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, block): the defined terms by letter, whatever their case."""
    first = rows.filter("row = 'run' and kind = 'term'").groupBy(key, "text").agg(F.min("path").alias("path"))
    order = F.struct(F.lower("text").alias("low"), "path", "text")
    listed = first.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: F.concat(F.lit("- "), x["text"])), "\n").alias("lines"))
    return listed.select(key, F.concat(F.lit(f"{TERMS}\n\n"), "lines", F.lit("\n\n")).alias("block"))


def note_texts(rows: DataFrame, shown: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ref, n, text, note): each commentary with its place, its plain text and its rendered one."""
    made = shown.filter("row = 'note_run'").groupBy(key, F.col("id").alias("ref")).agg(joined("path", "shown").alias("made"))
    own = rows.filter("row = 'commentary'").groupBy(key, F.col("id").alias("ref")).agg(F.max_by("text", "path").alias("text"), F.min(F.element_at("path", 1)).alias("n"))
    return own.join(made, [key, "ref"], "left").select(key, "ref", "n", "text", F.coalesce("made", escape_braces(F.col("text"))).alias("note"))


def rendered(rows: DataFrame, slugs: DataFrame, retrieved: str, publisher: str = "", maker: str = "lexforge", key: str = "doc_id") -> DataFrame:
    """(key, markdown) of every parsed document: fields, banner, preamble, body, terms, notes, footnotes."""
    shown = events(rows, slugs, key)
    notes, marks = note_texts(rows, shown, key), footnotes(shown, rows, key)
    lost = F.concat(F.lit("see amending instrument (commentary "), F.col("ref"), F.lit(" not found)"))
    back = F.when(F.size("anchors") > 0, F.concat(F.array_join(F.transform("anchors", lambda a: F.concat(F.lit("["), a, F.lit("](#"), a, F.lit(")"))), ", "), F.lit(": "))).otherwise("")
    entry = F.concat(F.lit("[^f"), F.col("ref"), F.lit("]: "), back, F.coalesce("note", lost), F.lit("\n"))
    foot = marks.join(notes, [key, "ref"], "left").select(key, "place", entry.alias("line")).groupBy(key).agg(joined("place", "line").alias("block"))
    # commentaries that no text refers to; those that only such commentaries refer to are listed as well
    used = marks.filter(F.element_at("place", 1) != LATE)
    other = notes.filter("text <> ''").join(used, [key, "ref"], "left_anti").select(key, "n", F.concat(F.lit("- "), "note", F.lit("\n")).alias("line")).groupBy(key).agg(joined("n", "line").alias("block"))
    preamble = rows.filter("row = 'meta' and kind = 'preamble' and text <> ''").select(key, F.concat(escape_braces(F.col("text")), F.lit("\n\n")).alias("block"))
    at = lambda df, n: df.select(key, F.array(F.lit(n)).alias("path"), "block")
    parts = [
        at(frontmatter(rows, retrieved, maker, key), -3),
        at(banner(rows, publisher, key), -2),
        at(preamble, -1),
        provision_blocks(rows, shown, key).select(key, "path", "block"),
        at(term_index(rows, key), 2),
        at(other.withColumn("block", F.concat(F.lit(NOTES), "block", F.lit("\n"))), 3),
        at(foot.withColumn("block", F.concat(F.lit("---\n\n"), "block")), 4),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(joined("path", "block").alias("markdown"))


def internal_links(rows: DataFrame, slugs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(src, dst, anchor): links that rendering puts within the batch, those of footnotes back to provisions included."""
    cited = citations(rows, slugs, key).filter("target_slug is not null").join(slugs, key)
    shown = events(rows, slugs, key)
    marks = footnotes(shown, rows, key)
    # commentaries are rendered where they are used or listed: all but empty ones that nothing refers to
    seen = rows.filter("row = 'commentary' and text <> ''").select(key, F.col("id").alias("ref")).unionByName(marks.select(key, "ref")).distinct()
    ids = rows.filter("row = 'note_run'").select(key, "path", F.col("id").alias("ref")).join(seen, [key, "ref"], "left_semi").select(key, "path")
    body = cited.filter("row = 'run'").unionByName(cited.filter("row = 'note_run'").join(ids, [key, "path"], "left_semi"))
    back = marks.join(slugs, key).select(F.col("slug").alias("src"), F.col("slug").alias("dst"), F.explode("anchors").alias("anchor"))
    return body.select(F.col("slug").alias("src"), F.col("target_slug").alias("dst"), F.col("target").alias("anchor")).unionByName(back)


def validated(rows: DataFrame, markdown: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, code, message): texts that didn't come through, malformed numbers, repeated ids, empty bodies."""
    from lexforge.functions.text import squeeze, undecorated
    from lexforge.operators import links, tree
    from lexforge.sources.clml import provisions

    nodes = provisions(rows, key).withColumnRenamed(key, "doc_id")
    bare = squeeze(F.replace(F.replace(F.replace("text", F.lit("["), F.lit("")), F.lit("]"), F.lit("")), F.lit("**"), F.lit("")))
    sources = rows.filter("row = 'source'").select(F.col(key).alias("doc_id"), bare.alias("source"))
    texts = markdown.select(F.col(key).alias("doc_id"), F.col("markdown").alias("rendered"))
    meta = rows.filter("row = 'meta' and kind = 'NumberOfProvisions'").select(F.col(key).alias("doc_id"), F.col("text").try_cast("int").alias("n_declared"))
    found = [links.missing_texts(sources, texts, clean=undecorated), tree.malformed_numbers(nodes), tree.duplicate_siblings(nodes.withColumn("parent", F.concat_ws(":", "root", "parent"))), tree.empty_bodies(meta, nodes)]
    return reduce(DataFrame.unionByName, found)
