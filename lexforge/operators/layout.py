"""Layout operators: rows, margin notes, boxes and as-of placement of page spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gap_clusters(rows: DataFrame, keys: list[str], y: str, tie: str, gap: float) -> DataFrame:
    """Column cluster: a new one where y lies more than gap below the previous row's."""
    by = Window.partitionBy(*keys).orderBy(y, tie)
    new = F.coalesce((F.col(y) - F.lag(y).over(by) > gap).cast("int"), F.lit(1))
    return rows.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def _folded(rows: DataFrame, keys: list[str], order: list, schema: str, fold) -> DataFrame:
    """An ordered fold over the rows of each key, in sorted partitions: linear, and no group is held in memory.

    fold is a generator function; it gets (key, row) pairs in order, rows as tuples, and yields rows of schema.
    """
    import pyarrow as pa

    width = len(keys)

    def run(batches):
        def pairs():
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    yield row[:width], row[width:]

        out = []
        kinds = pa.schema(empty)
        for r in fold(pairs()):
            out.append(r)
            if len(out) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    from pyspark.sql.pandas.types import to_arrow_schema

    empty = list(to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema))
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _kinds(rows: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)


def start_clusters(rows: DataFrame, keys: list[str], y: str, tie: str, tolerance: float, carry: tuple[str, ...] = ()) -> DataFrame:
    """(keys, tie, carry, cluster): rows of a page within tolerance of the first y of their cluster.

    The window deals and sorts the rows and marks where a page begins, where they aren't dealt so already; the fold
    reads that mark and y alone, and all other columns pass by it as they are.
    """
    import pyarrow as pa

    names = [*keys, tie, *carry]

    def run(batches):
        top, n = None, 0
        for b in batches:
            out = []
            starts, ys = b.column(len(names)), b.column(len(names) + 1)
            ys = ys.to_pylist() if ys.null_count else ys.to_numpy().tolist()
            for place, at in zip(starts.to_numpy().tolist(), ys, strict=True):
                if place == 1:
                    top, n = None, 0
                if top is None or at - top > tolerance:
                    top, n = at, n + 1
                out.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(out, pa.int32())], names=[*names, "cluster"])

    some = rows.select(*names, F.col(y).cast("double").alias("_y"))
    placed = some.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy("_y", tie)))
    return placed.select(*names, "_place", "_y").mapInArrow(run, f"{_kinds(rows, names)}, cluster int")


def merged_boxes(boxes: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Boxes (x0, top, x1, bottom, text) whose top and bottom lie within tolerance of the box before grow into it.

    On a line the box farthest to the right comes first; boxes without text are never merged.
    """

    def fold(pairs):
        page, last = None, None
        for key, (_, top, bottom, x0, x1, text) in pairs:
            if last and key == page and text and last[4] and abs(top - last[0]) <= tolerance and abs(bottom - last[1]) <= tolerance:
                last = [min(last[0], top), max(last[1], bottom), min(last[2], x0), max(last[3], x1), f"{last[4]} {text}"]
                continue
            if last:
                yield (*page, *last)
            page, last = key, [top, bottom, x0, x1, text]
        if last:
            yield (*page, *last)

    some = boxes.select(*keys, (-F.col("x0").cast("double")).alias("_right"), *(F.col(c).cast("double").alias(c) for c in ("top", "bottom", "x0", "x1")), "text")
    return _folded(some, keys, ["top", "_right", "bottom", "x1", "text"], f"{_kinds(boxes, keys)}, top double, bottom double, x0 double, x1 double, text string", fold)


def notes_at_rows(notes: DataFrame, rows: DataFrame, keys: list[str], slack: float = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each note with the first row at or below note_y - slack (null: the page's end), by one sort and no pairs.

    The sort runs up the page, so the window takes the last row met and its frame only ever grows. carry: columns of
    both; with them the rows stay too (side 1, notes being side 0), so neither is joined to what it was placed by.
    """
    both = notes.select(*keys, (F.col("note_y") - slack).alias("y"), F.lit(0).alias("side"), "note_id", F.lit(None).cast("double").alias("row_y"), *carry)
    both = both.unionByName(rows.select(*keys, F.col("row_y").alias("y"), F.lit(1).alias("side"), F.lit(None).cast(notes.schema["note_id"].dataType).alias("note_id"), F.col("row_y").cast("double").alias("row_y"), *carry))
    ahead = Window.partitionBy(*keys).orderBy(F.col("y").desc(), F.col("side").desc()).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("at", F.last("row_y", ignorenulls=True).over(ahead))
    return placed.select(*keys, "side", "at", *carry) if carry else placed.filter("side = 0").select(*keys, "note_id", "at")


def commonest(rows: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """The mode of value per key, the first met of equally frequent ones."""
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(pos).alias("first"))
    by = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "first", value)
    return counts.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r", "first")


def with_commonest(rows: DataFrame, keys: list[str], value: str, pos: str, name: str) -> DataFrame:
    """All rows with what commonest() gives for their key as column name: dealt by windows, and not joined."""
    alike = Window.partitionBy(*keys, value)
    counted = rows.withColumns({"_n": F.count("*").over(alike), "_first": F.min(pos).over(alike)})
    by = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), "_first", value)
    return counted.withColumn(name, F.first(value).over(by)).drop("_n", "_first")


def row_text(words: DataFrame, keys: list[str], x: str = "x", text: str = "text") -> DataFrame:
    """Texts of a row from right to left."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col(x)).alias("_x"), text)))
    return words.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda w: w[text]), " ").alias(text))


def zoned(x, width, low: float = 0.18, high: float = 0.82):
    """Whether a place lies in a margin of the page."""
    return (x < width * low) | (x > width * high)


# ---------------------------------------------------------------- pages of spans

#: Fixed: kinds of layout elements in tagged output, and the grid that their places lie on.
ELEMENTS = r"(?s)<(section_header_level_\d+|list_item|text|footnote|page_footer|caption|title)><loc_(\d+)><loc_(\d+)><loc_(\d+)><loc_(\d+)>(.*?)</\1>"
GRID = 500


def elements(docs: DataFrame, key: str = "doc_id", tags: str = "tags") -> DataFrame:
    """(key, pos, kind, text, x0, y0, x1, y1) of the elements in tagged layout output, in order."""
    part = lambda i: F.regexp_extract_all(tags, F.lit(ELEMENTS), F.lit(i))
    names = ("kind", "x0", "y0", "x1", "y1", "text")
    rows = docs.select(key, F.posexplode(F.arrays_zip(*(part(i + 1).alias(n) for i, n in enumerate(names)))).alias("pos", "e"))
    return rows.select(key, "pos", "e.kind", "e.text", *(F.col(f"e.{c}").cast("double").alias(c) for c in names[1:5]))


def span_lines(spans: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, line, y0, x0, x1, size, text): lines of spans, by the least size of a span that isn't blank.

    spans: keys, line, span (its number), x0, y0, x1, size, text; a line of blank spans goes.
    """
    solid = F.trim("text") != ""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: s["text"]), "")
    lines = spans.groupBy(*keys, "line").agg(F.min("y0").alias("y0"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.round(F.min(F.when(solid, F.col("size"))), 1).alias("size"), joined.alias("text"))
    return lines.filter("size is not null")


def classified(lines: DataFrame, keys: list[str], width: float, low: float = 0.18) -> DataFrame:
    """Lines with column margin: smaller than the commonest size of their page and wholly within an outer zone."""
    small = F.col("size") < F.col("_body")
    out = (F.col("x1") < width * low) | (F.col("x0") > width * (1 - low))
    known = lines
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    return with_commonest(known, keys, "size", "line", "_body").withColumn("margin", small & out).drop("_body")


def page_rows(lines: DataFrame, keys: list[str], tolerance: float = 4) -> DataFrame:
    """(keys, row, y, text): body lines as visual rows, their lines from right to left."""
    body = lines.filter("not margin")
    placed = start_clusters(body, keys, "y0", "line", tolerance, ("x0", "y0", "text")).withColumnRenamed("cluster", "row")
    # dealt by page, as all that follows needs it
    met = placed.filter("line is not null").repartition(*keys)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("x0")).alias("x"), "y0", "line", "text")))
    return met.groupBy(*keys, "row").agg(F.min("y0").alias("y"), F.array_join(F.transform(ordered, lambda w: w["text"]), " ").alias("text"))


def page_notes(lines: DataFrame, keys: list[str], gap: float = 14) -> DataFrame:
    """(keys, note_id, note_y, text): margin lines that follow each other closely, as one note."""
    placed = gap_clusters(lines.filter("margin"), keys, "y0", "line", gap)
    ordered = F.array_sort(F.collect_list(F.struct("y0", "line", F.trim("text").alias("text"))))
    return placed.groupBy(*keys, F.col("cluster").alias("note_id")).agg(F.min("y0").alias("note_y"), F.array_join(F.transform(ordered, lambda w: w["text"]), " ").alias("text"))


def page_markdown(lines: DataFrame, key: str = "doc_id", page: str = "page", gap: float = 14) -> DataFrame:
    """(key, text): classified lines as Markdown, each note as a quote before its row, pages a blank line apart.

    A row that lies more than gap below the row before it begins a paragraph; notes below the last row end the page.
    """
    keys = [key, page]
    rows, notes = page_rows(lines, keys), page_notes(lines, keys)
    met = notes_at_rows(notes.withColumn("own", F.col("note_y")), rows.withColumn("own", F.col("y")).withColumnRenamed("y", "row_y"), keys, carry=("own", "text"))
    end, is_row = F.lit(float("inf")), F.col("side") == 1
    shown = F.when(is_row, F.col("text")).otherwise(F.concat(F.lit("> *"), F.trim("text"), F.lit("*")))
    items = met.select(*keys, F.when(is_row, F.col("own")).otherwise(F.coalesce("at", end)).alias("at"), F.col("side").alias("kind"), "own", shown.alias("text"))
    by = Window.partitionBy(*keys).orderBy("at", "kind", "own", "text")
    before = F.lag("kind").over(by)
    last = F.col("at") == end
    far = F.col("own") - F.lag("own").over(by) > gap
    blank = F.when(F.col("kind") == 1, (before == 1) & far).otherwise((before == 1) | ((before == 0) & last))
    parts = F.array_compact(F.array(F.when(blank, F.lit("")), F.col("text"), F.when((F.col("kind") == 0) & ~last, F.lit(""))))
    shown = items.withColumn("parts", parts).withColumn("n", F.row_number().over(by))
    pages = shown.groupBy(*keys).agg(F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "parts"))), lambda x: x["parts"])), "\n").alias("text"))
    return pages.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, "text"))), lambda x: x["text"]), "\n\n").alias("text"))


def syntax_tree(items: DataFrame, clean, key: str = "doc_id", zone: float = 0.82) -> DataFrame:
    """(key, part, pos, text, x0, y0, x1, y1): elements sorted into the parts of a law, as elements() gives them.

    Texts in the right margin are notes if they mean something; list items are sections, without the notes that
    recognition put before them; the last section header is the title. Sections and other texts on a line are merged.
    clean: the column function that cleans a text.
    """
    from lexforge.functions.text import meaningful, without_margin_prefix

    texts = items.withColumn("text", clean(F.col("text")))
    aside = (F.col("kind") == "text") & (F.col("x0") >= GRID * zone)
    notes = texts.filter(aside & meaningful(F.col("text")))
    phrases = notes.groupBy(key).agg(F.collect_set("text").alias("_phrases"))
    rest = texts.filter(~aside & (F.col("text") != "")).join(phrases, key, "left")
    no_phrases = F.array().cast("array<string>")
    kind = F.when(F.col("kind").startswith("section_header"), "title").when(F.col("kind") == "list_item", "section").when(F.col("kind") == "footnote", "footnote").when(F.col("kind") == "page_footer", "artifact").when(F.col("kind") == "text", "auxiliary")
    rest = rest.withColumn("text", F.when(F.col("kind") == "list_item", without_margin_prefix(F.col("text"), F.coalesce("_phrases", no_phrases))).otherwise(F.col("text")))
    rest = rest.withColumn("part", kind).filter("part is not null").drop("_phrases", "kind")
    columns = [key, "part", "pos", "text", "x0", "y0", "x1", "y1"]
    latest = F.row_number().over(Window.partitionBy(key).orderBy(F.col("pos").desc()))
    title = rest.filter("part = 'title'").withColumn("_n", latest).filter("_n = 1")
    boxes = rest.filter("part in ('section', 'auxiliary')").withColumnsRenamed({"y0": "top", "y1": "bottom"})
    merged = merged_boxes(boxes, [key, "part"], 3).withColumnsRenamed({"top": "y0", "bottom": "y1"})
    order = Window.partitionBy(key, "part").orderBy("y0", F.col("x0").desc(), "text")
    merged = merged.withColumn("pos", F.row_number().over(order) - 1)
    plain = rest.filter("part in ('footnote', 'artifact')").unionByName(title.drop("_n")).unionByName(notes.withColumn("part", F.lit("note")).drop("kind"))
    return plain.select(*columns).unionByName(merged.select(*columns))


#: Fixed: the parts of a law in order, their headings, and how their entries are written.
PARTS = (("title", None, "# ", ""), ("section", "## Full Text", "", ""), ("auxiliary", "## Signatures", "", ""), ("note", "## Margin Notes", "- ", ""), ("footnote", "## Footnotes", "", ""), ("artifact", "<!-- page artifacts (excluded from main rendering) -->", "<!-- ", " -->"))


def tree_markdown(parts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, body): the parts of a law that syntax_tree() gives as Markdown."""
    of = lambda name: F.array_sort(F.collect_list(F.when(F.col("part") == name, F.struct("pos", "text"))))
    rows = parts.groupBy(key).agg(*(of(name).alias(name) for name, *_ in PARTS))
    wrapped = lambda before, after: lambda x: F.concat(F.lit(before), x["text"], F.lit(after))
    blocks = []
    for name, heading, before, after in PARTS:
        shown = F.transform(name, wrapped(before, after))
        spaced = F.flatten(F.transform(shown, lambda x: F.array(x, F.lit(""))))
        none = F.array().cast("array<string>")
        if name == "title":
            block = F.concat(shown, F.array(F.lit("")))
        elif name == "section":
            block = F.concat(F.array(F.lit(heading), F.lit("")), spaced)
        elif name == "artifact":
            block = F.when(F.size(name) > 0, F.concat(F.array(F.lit(heading)), shown)).otherwise(none)
        else:
            entries = F.concat(shown, F.array(F.lit(""))) if name == "note" else spaced
            block = F.when(F.size(name) > 0, F.concat(F.array(F.lit(heading), F.lit("")), entries)).otherwise(none)
        blocks.append(block)
    return rows.select(key, F.concat(F.array_join(F.concat(*blocks), "\n"), F.lit("\n")).alias("body"))
