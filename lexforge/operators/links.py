"""Link graph operators: resolution, decision tables, broken links, reference lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upgraded(links: DataFrame, targets: DataFrame) -> DataFrame:
    """(src, url, target): links whose url is known by (url, target), except to their own document."""
    return links.join(targets, "url").filter(F.col("target") != F.col("src"))


def resolved(refs: DataFrame, titles: DataFrame, converted: DataFrame, base: str) -> DataFrame:
    """References looked up by official name, then by the text found; links to converted laws are internal.

    refs (official, found, ...), titles (title, law_id), converted (law_id).
    """
    t1, t2 = (titles.select(F.col("title").alias(k), F.col("law_id").alias(i)) for k, i in (("official", "_a"), ("found", "_b")))
    done = converted.select(F.col("law_id"), F.lit(True).alias("_done")).distinct()
    met = refs.join(t1, "official", "left").join(t2, "found", "left").withColumn("law_id", F.coalesce("_a", "_b")).drop("_a", "_b")
    out = met.join(done, "law_id", "left")
    url = F.when(F.col("_done"), F.concat(F.lit("./"), F.col("law_id"), F.lit(".md"))).when(F.col("law_id").isNotNull(), F.concat(F.lit(base), F.col("law_id").cast("string")))
    return out.withColumns({"is_internal": F.coalesce("_done", F.lit(False)), "url": url}).drop("_done")


def decided(slug: Column, anchor: Column, own: Column, in_batch: Column, has_anchors: Column, anchor_known: Column, uri: Column) -> Column:
    """The link of a citation: external, fragment, plain text (null) or relative file."""
    external = slug.isNull() | ~in_batch
    itself = slug == own
    kept = F.when(itself & ~anchor_known, F.lit(None)).when(~itself & has_anchors & ~anchor_known, F.lit(None)).otherwise(anchor)
    file = F.concat(F.lit("./"), slug, F.lit(".md"))
    return F.when(external, uri).when(itself & kept.isNull(), F.lit(None)).when(itself, F.concat(F.lit("#"), kept)).when(kept.isNull(), file).otherwise(F.concat(file, F.lit("#"), kept))


def broken(links: DataFrame, docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(src, dst, anchor, code) of links to no document, or to a document without the anchor.

    links (src, dst, anchor), docs (dst), anchors (dst, anchor).
    """
    known = docs.select("dst").distinct()
    lost = links.join(known, "dst", "left_anti").withColumn("code", F.lit("BROKEN_INTERNAL_LINK"))
    aimed = links.filter("anchor is not null and anchor <> ''").join(known, "dst", "left_semi")
    off = aimed.join(anchors.select("dst", "anchor").distinct(), ["dst", "anchor"], "left_anti").withColumn("code", F.lit("BROKEN_ANCHOR"))
    cols = ["src", "dst", "anchor", "code"]
    return lost.select(*cols).unionByName(off.select(*cols))


def anchors_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, anchor) of every anchor span in rendered text."""
    return docs.select(key, F.explode(F.regexp_extract_all(text, F.lit(r'<span id="([^"]+)"'), F.lit(1))).alias("anchor"))


def missing_texts(sources: DataFrame, rendered: DataFrame, key: str = "doc_id", clean=None) -> DataFrame:
    """(key, code, message) of source texts that the rendered document does not contain.

    clean: a column function on the rendered text, put on once for each document that has sources.
    """
    asked = sources.filter("source <> ''")
    texts = rendered.join(asked.select(key).distinct(), key, "left_semi")
    if clean:
        texts = texts.withColumn("rendered", clean(F.col("rendered")))
    met = asked.join(texts, key).filter(~F.contains(F.col("rendered"), F.col("source")))
    return met.select(key, F.lit("ROUND_TRIP_MISSING").alias("code"), F.substring("source", 1, 80).alias("message"))


def title_index(manifest: DataFrame, name: str = "name_he", pos: str = "pos", **values: str) -> DataFrame:
    """(title, values) by the lookup key of a title, the last of equal ones."""
    from lexforge.functions.text import title_key
    from lexforge.operators.manifest import keep

    rows = manifest.withColumn("title", title_key(F.coalesce(name, F.lit("")))).filter("title <> ''")
    return keep(rows, ["title"], [F.col(pos).desc()]).select("title", *(F.col(c).alias(n) for n, c in values.items()))


def pdf_index(manifest: DataFrame, converted: DataFrame, pos: str = "pos") -> DataFrame:
    """(url, target): the converted law of each document address, the last of equal ones."""
    from lexforge.operators.manifest import keep

    rows = manifest.filter("pdf_url is not null and pdf_url <> ''").withColumn("target", F.col("law_id").cast("string"))
    rows = rows.join(converted.select(F.col("law_id").cast("string").alias("target")).distinct(), "target", "left_semi")
    return keep(rows, ["pdf_url"], [F.col(pos).desc()]).select(F.col("pdf_url").alias("url"), "target")


def with_upgraded_links(docs: DataFrame, targets: DataFrame, host: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents whose links to known PDF addresses on a host (a pattern) are links to their own files, with n_upgraded.

    Addresses are joined as rows, so the table of targets (url, target) may have any size.
    """
    from lexforge.functions.text import rewrite

    pattern = rf"(?i)\[([^\]]+)\]\((https://{host}[^)]+\.PDF)\)"
    urls = docs.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)))).alias("url"))
    known = urls.join(targets, "url").filter(F.col("target") != F.col(key).cast("string")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("url", "target"))).alias("_known"))
    met = docs.join(known, key, "left")
    url = lambda m: F.regexp_extract(m, pattern, 2)
    link = lambda m: F.concat(F.lit("["), F.regexp_extract(m, pattern, 1), F.lit("](./"), F.element_at("_known", url(m)), F.lit(".md)"))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    counted = F.coalesce(F.size(F.filter(hits, lambda u: F.map_contains_key("_known", u))), F.lit(0))
    lined = F.when(F.col("_known").isNull(), F.col(text)).otherwise(rewrite(F.col(text), pattern, lambda m: F.coalesce(link(m), m)))
    return met.withColumn("n_upgraded", F.when(F.col("_known").isNull(), 0).otherwise(counted)).withColumn(text, lined).select(*docs.columns, "n_upgraded")


def reference_counts(refs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_internal, n_external) of resolved references."""
    return refs.groupBy(key).agg(F.count_if("is_internal").alias("n_internal"), F.count_if(~F.col("is_internal")).alias("n_external"))
