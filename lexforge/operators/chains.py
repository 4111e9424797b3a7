"""Chains of operators over whole corpora: conversion, link passes, cross links, batches.

A chain is a plan over tables: a step that a document does not pass is a missing row and a finding, steps already done
are anti-joins, and nothing is decided on the driver but whether a batch has rows at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.footers import with_footer, without_footer
from lexforge.functions.text import split_frontmatter, title_key, truthy
from lexforge.operators import lines, links, manifest
from lexforge.operators.models import request


def valid_laws(laws: DataFrame, validity: int = 6079) -> DataFrame:
    """Laws in force, by the number that the service gives them."""
    return laws.filter(F.col("validity") == validity)


def binding_of_type(bindings: DataFrame, kind: int = 6012) -> DataFrame:
    """Bindings of a law to its original bill."""
    return bindings.filter(F.col("type") == kind)


def gazette_documents(documents: DataFrame, group: int = 9) -> DataFrame:
    """Documents of the gazette group that are PDFs, whatever the case of their type."""
    return documents.filter((F.col("group_type") == group) & (F.upper(F.coalesce("application", F.lit(""))) == "PDF"))


def published_urls(bills: DataFrame, documents: DataFrame, host: str, key: str = "bill_id") -> DataFrame:
    """Bills with pdf_url: the address of the latest gazette document, null where its path is empty."""
    from lexforge.functions.text import absolute_url

    last = manifest.latest_document(gazette_documents(documents), key, "updated", "pos")
    url = F.when(truthy(F.col("file_path")), absolute_url(F.col("file_path"), host))
    return bills.join(last.select(key, url.alias("pdf_url")), key, "left")


def ministry_lists(rows: DataFrame, key: str = "law_id", value: str = "ministry_id", order: str = "pos") -> DataFrame:
    """Ministries per law in order of arrival; a row counts if both ids are there and not zero."""
    both = rows.filter((F.coalesce(key, F.lit(0)) != 0) & (F.coalesce(value, F.lit(0)) != 0))
    return manifest.lookup_list(both, key, order, value, "ministry_ids")


def fetched(rows: DataFrame, slug: str | None = None) -> DataFrame:
    """Rows that were fetched, of one slug if given."""
    out = rows.filter(F.col("status") == "fetched")
    return out.filter(F.col("slug") == slug) if slug else out


def uncached(batch: DataFrame, cache: DataFrame, key: str = "uri") -> tuple[DataFrame, DataFrame]:
    """(rows of the cache that the batch asks for, rows of the batch that have to be fetched)."""
    known = cache.select(key).distinct()
    return cache.join(batch.select(key).distinct(), key, "left_semi"), batch.join(known, key, "left_anti")


def merged(base: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """Base rows with the fields of their state rows; a field that both have is the state's."""
    shared = [c for c in states.columns if c != key]
    new = states.select(key, F.lit(True).alias("_has"), *(F.col(c).alias(f"_{c}") for c in shared))
    met = base.join(new, key, "left")
    columns = [F.when(F.col("_has"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in shared else F.col(c) for c in base.columns]
    return met.select(*columns, *(F.col(f"_{c}").alias(c) for c in shared if c not in base.columns))


def outcome(selected: DataFrame, done: DataFrame, key: str = "doc_id", partial: int = 2) -> DataFrame:
    """One row: n_done, n_selected and the exit code, 0 if all were done."""
    marked = selected.select(key).join(done.select(key).distinct().withColumn("_done", F.lit(True)), key, "left")
    out = marked.agg(F.count("_done").alias("n_done"), F.count("*").alias("n_selected"))
    return out.withColumn("code", F.when(F.col("n_done") == F.col("n_selected"), 0).otherwise(partial))


def recognised(pages: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pages, characters) of recognised text."""
    return pages.groupBy(key).agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("characters"))


def both_done(texts: DataFrame, layouts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key) of documents that have their text and their layout: one without the other doesn't count."""
    return texts.select(key).distinct().join(layouts.select(key).distinct(), key, "left_semi")


def converted(batch: DataFrame, native: DataFrame, ocr: DataFrame, layouts: DataFrame, model: Callable[[Column], Column], prompt: str, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(converted (key, markdown), findings (key, code)): each law through native text, recognition, reconciliation.

    A step asks for the one before it, so a law that one step lacks goes through none after it. model: a column
    function from requests to answers, null where it fails; the source footer is put on.
    """
    own = batch.select(key, "pdf_url")
    have = own.join(native.select(key, F.col("text").alias("native")), key, "left").join(both_done(ocr, layouts, key).withColumn("_ocr", F.lit(True)), key, "left")
    have = have.join(ocr.select(key, F.col("text").alias("ocr")), key, "left")
    ready = F.col("native").isNotNull() & F.col("_ocr")
    answer = have.withColumn("answer", model(F.when(ready, request(F.col("native"), F.col("ocr"), prompt))))
    code = F.when(F.col("native").isNull(), "NATIVE_MISSING").when(F.col("_ocr").isNull(), "OCR_MISSING").when(F.col("answer").isNull(), "RECONCILE_FAILED")
    marked = answer.withColumn("code", code)
    return marked.filter("code is null").select(key, with_footer(F.col("answer"), F.col("pdf_url")).alias("markdown")), marked.filter("code is not null").select(key, "code")


def link_resolved(docs: DataFrame, targets: DataFrame, host: str, key: str = "doc_id", text: str = "markdown") -> DataFrame:
    """(key, text): section anchors, links to them, the index of margin notes, links between laws, in this order.

    The frontmatter stays as it is. targets: (url, target) as links.pdf_index() gives it. The documents are read for
    each pass, so they should come from a table or be cached.
    """
    head, body = split_frontmatter(F.col(text))
    parts = docs.select(key, head.alias("_head"), body.alias("_body"))
    rows = lines.section_anchors(lines.explode_lines(parts, key, "_body"))
    linked = lines.section_links(rows, key)
    whole = lines.with_margin_index(lines.rebuild(linked, key, "_body"), linked, key, "_body")
    upgraded = links.with_upgraded_links(whole, targets, host, key, "_body")
    met = parts.select(key, "_head").join(upgraded.select(key, "_body"), key)
    return met.select(key, F.concat("_head", "_body").alias(text))


def cross_linked(docs: DataFrame, refs: DataFrame, catalog: DataFrame, done: DataFrame, hosts: str, key: str = "doc_id", text: str = "markdown") -> tuple[DataFrame, DataFrame]:
    """(documents with links between laws, unresolved (key, law_id, pos)).

    refs: (key, pos, found, official) as a model finds them; catalog: (pos, name_he, law_id, pdf_url); done: (law_id).
    A law is linked once in a document, at the name found first; a law not converted yet is linked to its PDF and
    is unresolved.
    """
    resolved = resolve(refs, catalog, done, key)
    head, body = split_frontmatter(F.col(text))
    parts = docs.select(key, head.alias("_head"), body.alias("_body"))
    shown = linked_by_document(parts, resolved.filter("url <> ''"), key, hosts)
    joined = shown.select(key, F.concat("_head", "_body").alias(text))
    return joined, resolved.filter("url <> '' and not is_internal").select(key, "law_id", "pos")


def resolve(refs: DataFrame, catalog: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, found, law_id, url, is_internal): references by official name, else by the words found."""
    known = links.title_index(catalog, law_id="law_id", pdf_url="pdf_url")
    two = [known.select(F.col("title").alias(k), F.col("law_id").cast("string").alias(i), F.col("pdf_url").alias(u)) for k, i, u in (("_k1", "_i1", "_u1"), ("_k2", "_i2", "_u2"))]
    asked = refs.filter(truthy(F.trim("found"))).withColumn("found", F.trim("found"))
    asked = asked.withColumn("_k1", title_key(F.coalesce(F.nullif(F.trim("official"), F.lit("")), "found"))).withColumn("_k2", title_key(F.col("found")))
    met = asked.join(two[0], "_k1", "left").join(two[1], "_k2", "left")
    first = F.col("_i1").isNotNull()
    met = met.select(key, "pos", "found", F.coalesce("_i1", "_i2").alias("law_id"), F.when(first, F.col("_u1")).otherwise(F.col("_u2")).alias("_pdf")).filter("law_id is not null")
    once = manifest.keep(met, [key, "law_id"], [F.col("pos").asc()])
    here = done.select(F.col("law_id").cast("string").alias("law_id")).distinct().withColumn("_done", F.lit(True))
    out = once.join(here, "law_id", "left").withColumn("is_internal", F.coalesce("_done", F.lit(False)))
    return out.withColumn("url", F.when(F.col("is_internal"), F.concat(F.lit("./"), "law_id", F.lit(".md"))).otherwise(F.coalesce("_pdf", F.lit("")))).select(key, "pos", "found", "law_id", "url", "is_internal")


def linked_by_document(docs: DataFrame, resolved: DataFrame, key: str, hosts: str) -> DataFrame:
    """Documents (key, _body, ...) with their own resolved names as links; those without any stay as they are."""
    order = F.struct((-F.length("found")).alias("n"), F.col("pos"), F.col("found"), F.col("url"))
    own = resolved.groupBy(key, "found").agg(F.min(F.struct("pos", "url")).alias("x")).select(key, "found", "x.*")
    own = own.groupBy(key).agg(F.array_sort(F.collect_list(order)).alias("_names"))
    met = docs.join(own, key, "left")
    plain = lines.unlinked(F.col("_body"), hosts)
    return met.withColumn("_body", F.when(F.col("_names").isNull(), F.col("_body")).otherwise(lines.linked_names(plain, F.col("_names")))).drop("_names")


def extraction_text(markdown: Column) -> Column:
    """The body of a document without footer and index: what references are looked for in."""
    return without_footer(split_frontmatter(markdown)[1])


def run_batch(catalog: DataFrame, state: dict[str, DataFrame], witnesses: dict[str, DataFrame], model: Callable[[Column], Column], find: Callable[[DataFrame], DataFrame], size: int, host: str, prompt: str = "", step: int = 25) -> dict[str, DataFrame]:
    """A batch from selection to deployment, as tables: batch, documents, findings, queue, status and due.

    catalog: (doc_id, pos, name_he, pdf_url, pdf_path); state: done, failed, priority (doc_id, prio), documents
    (doc_id, markdown) and deployed (n); witnesses: native, ocr, layout; find: from documents to references (doc_id,
    pos, found, official). Documents of the batch are converted, get their links, and name laws to convert next.
    """
    source = manifest.with_source(catalog)
    batch = manifest.next_batch(source, state["done"], state["failed"], state["priority"], size)
    made, findings = converted(batch, witnesses["native"], witnesses["ocr"], witnesses["layout"], model, prompt)
    done = state["done"].select(F.col("doc_id").cast("string").alias("doc_id")).unionByName(made.select(F.col("doc_id").cast("string").alias("doc_id"))).distinct()
    laws = catalog.withColumn("law_id", F.col("doc_id").cast("string"))
    finished = done.withColumnRenamed("doc_id", "law_id")
    resolved = link_resolved(made, links.pdf_index(laws, finished), host)
    crossed, unresolved = cross_linked(resolved, find(resolved), laws, finished, host)
    waiting = state["priority"].join(made.select("doc_id"), "doc_id", "left_anti")
    queue = manifest.requeue(unresolved.select(F.col("law_id").alias("doc_id"), "pos"), waiting, done)
    failed = state["failed"].select(F.col("doc_id").cast("string").alias("doc_id")).unionByName(findings.select(F.col("doc_id").cast("string").alias("doc_id")))
    counted = done.select(F.lit(1).alias("one"), F.lit(0).cast("long").alias("n")).unionByName(state["deployed"].select(F.lit(0).alias("one"), F.col("n").cast("long")))
    due = counted.agg(F.sum("one").alias("n_done"), F.max("n").alias("n_deployed")).withColumn("due", manifest.deploy_due(F.col("n_done"), F.col("n_deployed"), step))
    return {"batch": batch, "documents": crossed, "findings": findings, "queue": queue, "done": done, "failed": failed, "due": due}


def relinked(docs: DataFrame, targets: DataFrame, host: str, key: str = "doc_id", text: str = "markdown") -> DataFrame:
    """All documents through the link passes again; index pages stay out."""
    return link_resolved(docs.filter(~F.col(key).cast("string").isin("index", "_index", "placeholder")), targets, host, key, text)
