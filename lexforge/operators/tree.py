"""Tree operators on flattened provisions: (doc_id, path ARRAY<INT>, kind, id, number, heading, text, ...).

Paths sort in document order, so reading a tree in order is a sort by (doc_id, path); no recursion is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.text import escape_braces, valid_number

CONTAINERS = ("part", "chapter", "crossheading", "schedule")
NO_ANCHOR = ("block_quote", "uncertain", "table")
NO_LEAF = (*NO_ANCHOR, "part", "chapter", "crossheading")


def known_anchors(provisions: DataFrame) -> DataFrame:
    return provisions.filter(~F.col("kind").isin(*NO_ANCHOR) & F.col("id").isNotNull()).select("doc_id", F.col("id").alias("anchor")).distinct()


def leaf_counts(provisions: DataFrame) -> DataFrame:
    return provisions.groupBy("doc_id").agg(F.count_if(~F.col("kind").isin(*NO_LEAF)).alias("leaves"))


def empty_bodies(meta: DataFrame, provisions: DataFrame) -> DataFrame:
    """Documents that declare provisions (n_declared) but have no leaf."""
    met = meta.join(leaf_counts(provisions), "doc_id", "left").filter((F.col("n_declared") > 0) & (F.coalesce("leaves", F.lit(0)) == 0))
    return met.select("doc_id", F.lit("EMPTY_BODY").alias("code"), F.col("n_declared").cast("string").alias("message"))


def malformed_numbers(provisions: DataFrame) -> DataFrame:
    bad = provisions.filter(~F.col("kind").isin(*CONTAINERS, *NO_ANCHOR) & (F.col("number") != "") & ~valid_number(F.col("number")))
    return bad.select("doc_id", F.lit("MALFORMED_NUMBER").alias("code"), F.col("number").alias("message"))


def duplicate_siblings(provisions: DataFrame, parent: str = "parent") -> DataFrame:
    """Ids that an earlier sibling has."""
    by = Window.partitionBy("doc_id", parent, "id").orderBy("path")
    rows = provisions.filter("id is not null").withColumn("n", F.row_number().over(by)).filter("n > 1")
    return rows.select("doc_id", F.lit("DUPLICATE_ID").alias("code"), F.col("id").alias("message"))


def inherited_extent(provisions: DataFrame) -> DataFrame:
    """A leaf without an extent takes that of its parent node."""
    up = provisions.select("doc_id", F.col("path").alias("_up"), F.col("extent").alias("_extent"))
    own = provisions.withColumn("_up", F.slice("path", F.lit(1), F.greatest(F.size("path") - 1, F.lit(0))))
    return own.join(up, ["doc_id", "_up"], "left").withColumn("extent", F.coalesce(F.nullif("extent", F.lit("")), "_extent")).drop("_up", "_extent")


def terms(runs: DataFrame) -> DataFrame:
    """Distinct defined terms of each document in their first-seen order, blank ones dropped."""
    first = runs.filter((F.col("kind") == "term") & (F.trim("text") != "")).groupBy("doc_id", "text").agg(F.min("path").alias("path"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy("path")))


def footnotes(marks: DataFrame) -> DataFrame:
    """Footnotes by first use with the anchors that use them: marks (doc_id, ref, anchor, path)."""
    used = marks.groupBy("doc_id", "ref", "anchor").agg(F.min("path").alias("path"))
    notes = used.groupBy("doc_id", "ref").agg(F.min("path").alias("first"), F.transform(F.array_sort(F.collect_list(F.struct("path", "anchor"))), lambda x: x["anchor"]).alias("anchors"))
    return notes.withColumn("number", F.row_number().over(Window.partitionBy("doc_id").orderBy("first")))


def block_lines(provisions: DataFrame) -> DataFrame:
    """(doc_id, path, line): a heading or quote for each provision. Text after children comes with a path of its own."""
    level = F.least(F.size("path") + 1, F.lit(6))
    label = F.when(F.coalesce("number", F.lit("")) == "", "(unnumbered)").when(F.col("kind") == "section", F.concat("number", F.lit("."))).otherwise(F.concat(F.lit("("), "number", F.lit(")")))
    head = F.when(F.col("kind").isin(*CONTAINERS), F.concat_ws(" ", F.nullif("number", F.lit("")), "heading")).otherwise(F.concat_ws(" ", label, F.nullif("heading", F.lit(""))))
    span = F.when(F.col("id").isNotNull(), F.concat(F.lit(' <span id="'), "id", F.lit('" />'))).otherwise("")
    state = F.when(F.col("status") == "Repealed", " [REPEALED]").when(F.col("status") == "Prospective", " [NOT YET IN FORCE — prospective]").otherwise("")
    title = F.concat(F.repeat(F.lit("#"), level), F.lit(" "), escape_braces(head), state, span)
    text = escape_braces(F.coalesce("text", F.lit("")))
    quoted = F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> ")))
    body = F.when(F.col("kind") == "block_quote", quoted).when(F.col("kind").isin("table", "tail", "para"), text)
    return provisions.select("doc_id", "path", F.coalesce(body, F.concat_ws("\n\n", title, F.nullif(text, F.lit("")))).alias("line"))


def rendered(blocks: DataFrame) -> DataFrame:
    """(doc_id, markdown): blocks joined in order of their paths."""
    ordered = F.array_sort(F.collect_list(F.struct("path", "line")))
    return blocks.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n\n").alias("markdown"))


def pipe_table(rows):
    """A pipe table of an array of rows (arrays of cells); the first row is the head."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(F.get(rows, F.lit(0)))))
    lines = F.transform(rows, line)
    return F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")
