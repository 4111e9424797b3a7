"""Catalog operators: lookups, latest rows, batches, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.text import truthy


def keep(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order (keep-last: descending positions)."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(by)).filter("_n = 1").drop("_n")


def latest_document(documents: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    """The row with the greatest date string per key, null as empty, the first of equal ones."""
    return keep(documents, [key], [F.coalesce(F.col(date).cast("string"), F.lit("")).desc(), F.col(tie).asc()])


def lookup_list(rows: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Values per key in their order of arrival."""
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias(name))


def preserved(new: DataFrame, old: DataFrame, key: str, columns: dict[str, object]) -> DataFrame:
    """New rows with the old rows' columns; a default only where no old row exists."""
    prior = old.select(F.col(key), F.lit(True).alias("_old"), *(F.col(c).alias(f"_{c}") for c in columns))
    met = new.join(prior, key, "left")
    kept = {c: F.when(F.col("_old"), F.col(f"_{c}")).otherwise(F.lit(default)) for c, default in columns.items()}
    return met.withColumns(kept).drop("_old", *(f"_{c}" for c in columns))


def next_batch(manifest: DataFrame, done: DataFrame, failed: DataFrame, priority: DataFrame, n: int, key: str = "doc_id", pos: str = "pos", force: bool = False) -> DataFrame:
    """The next n entries: the priority queue in its order, then the manifest in its own; done and failed ones not.

    manifest (key, pos, ...), priority (key, prio); a repeated manifest id counts as its last row, a repeated
    priority id as its first.
    """
    rows = keep(manifest, [key], [F.col(pos).desc()])
    first = priority.groupBy(F.col(key).cast("string").alias("_k")).agg(F.min("prio").alias("_prio"))
    rows = rows.withColumn("_k", F.col(key).cast("string")).join(first, "_k", "left")
    if not force:
        gone = done.select(F.col(key).cast("string").alias("_k")).union(failed.select(F.col(key).cast("string"))).distinct()
        rows = rows.join(gone, "_k", "left_anti")
    tier = F.when(F.col("_prio").isNull(), 1).otherwise(0)
    ranked = rows.withColumn("tier", tier).withColumn("place", F.coalesce("_prio", F.col(pos)))
    return ranked.orderBy("tier", "place", key).limit(n).drop("_k", "_prio")


def status(manifest: DataFrame, done: DataFrame, failed: DataFrame, source: Column, deployed: int, key: str = "doc_id") -> DataFrame:
    """One row: total, with_source, done, failed, pending, deployed."""
    d, f = (x.select(F.col(key).cast("string").alias("_k")).distinct() for x in (done, failed))
    marked = d.withColumn("s", F.lit("d")).union(f.withColumn("s", F.lit("f")))
    counts = marked.agg(F.count_if(F.col("s") == "d").alias("done"), F.count_if(F.col("s") == "f").alias("failed"))
    gone = marked.select("_k").distinct().withColumn("_gone", F.lit(True))
    rows = manifest.select(F.col(key).cast("string").alias("_k"), source.alias("_source")).join(gone, "_k", "left")
    total = rows.agg(F.count("*").alias("total"), F.count_if("_source").alias("with_source"), F.count_if(F.col("_source") & F.col("_gone").isNull()).alias("pending"))
    one = F.lit(1).alias("_one")
    return total.select("*", one).join(counts.select("*", one), "_one").drop("_one").withColumn("deployed", F.lit(deployed).cast("long"))


def deploy_due(converted: Column, deployed: Column, step: int = 25) -> Column:
    """Whether converted has reached the next multiple of step above what is deployed."""
    return converted >= (F.floor(deployed / step) + 1) * step


def requeue(unresolved: DataFrame, priority: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Unresolved ids that are neither queued nor done, first-seen order kept in column prio."""
    known = priority.select(F.col(key).cast("string").alias("_k")).union(done.select(F.col(key).cast("string")))
    first = unresolved.groupBy(key).agg(F.min("pos").alias("prio")).withColumn("_k", F.col(key).cast("string"))
    return first.join(known, "_k", "left_anti").drop("_k")


def category(first_id: Column, slug: Column, is_basic: Column) -> Column:
    """The slug of the first classification; basic laws without any get their own; an unmapped id gets none."""
    return F.when(first_id.isNotNull(), F.coalesce(slug, F.lit(""))).when(is_basic, "basic-laws").otherwise("")


def gate(provisions: Column, has_body: Column, state: Column) -> Column:
    """fetched, pdf_only or wrong_version; a body missing with provisions counted shows as wrong_version."""
    stub = provisions.isNull() | (provisions == 0)
    return F.when(stub, "pdf_only").when(~has_body | (state != "revised") | state.isNull(), "wrong_version").otherwise("fetched")


def with_source(df: DataFrame, path: str = "pdf_path") -> DataFrame:
    return df.filter(truthy(F.col(path)))


def tsv_words(lines: DataFrame, columns: tuple[str, ...], numbers: tuple[str, ...]) -> DataFrame:
    """Words of recognition output: rows of all columns, numbers that parse, text not blank."""
    # generators hold what is split and typed: filters stay above them, and would split the line again for each column
    # if they were moved below
    rest = [c for c in lines.columns if c != "line"]
    parts = lines.select(*rest, F.explode(F.array(F.split("line", "\t", -1))).alias("p")).filter(F.size("p") == len(columns))
    typed = [(F.trim(F.get("p", F.lit(i))).try_cast("double") if c in numbers else F.get("p", F.lit(i))).alias(c) for i, c in enumerate(columns)]
    out = parts.select(*rest, F.inline(F.array(F.struct(*typed))))
    return out.filter(F.trim(F.col(columns[-1])) != "").dropna(subset=list(numbers))


def tsv_records(files: DataFrame, text: str = "text") -> DataFrame:
    """A row for each line of a table with a header line: columns of files, and a map from header to field.

    A line with more or fewer fields than the header is dropped.
    """
    lines = F.split(F.regexp_replace(text, r"\n+$", ""), "\n", -1)
    rest = [c for c in files.columns if c != text]
    rows = files.select(*rest, F.split(F.get(lines, F.lit(0)), "\t", -1).alias("_head"), F.posexplode(lines).alias("pos", "_line")).filter("pos > 0")
    rows = rows.withColumn("_row", F.split("_line", "\t", -1)).filter(F.size("_row") == F.size("_head"))
    return rows.select(*rest, "pos", F.map_from_arrays("_head", "_row").alias("record"))


def size_pin(docs: DataFrame, expected: int) -> DataFrame:
    """One row (code, message) if the corpus hasn't the expected number of documents, else none."""
    n = docs.agg(F.count("*").alias("n")).filter(F.col("n") != expected)
    return n.select(F.lit("CORPUS_SIZE").alias("code"), F.concat(F.lit(f"expected {expected}, found "), F.col("n").cast("string")).alias("message"))
