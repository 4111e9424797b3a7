"""Readers with explicit schemas: catalogs, Markdown corpora, page text, PDF bytes and a paged service."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringStartsWith

MANIFEST_BILL = "bill_id BIGINT, name_he STRING, publication_date STRING, sub_type_id INT, pdf_path STRING, pdf_url STRING"
MANIFEST_LAW = (
    "law_id BIGINT, name_he STRING, publication_date STRING, latest_publication_date STRING, is_basic_law BOOLEAN, is_budget_law BOOLEAN,"
    " law_validity STRING, classifications ARRAY<STRUCT<id:BIGINT,desc:STRING>>, category STRING, ministry_ids ARRAY<BIGINT>, bill_id BIGINT,"
    " pdf_url STRING, pdf_path STRING, status STRING"
)
MANIFEST_UK = (
    "uri STRING, type STRING, requested_url STRING, status STRING, xml_path STRING, skip_reason STRING, slug STRING, resolved_document_uri STRING,"
    " doc_status STRING, title STRING, year STRING, number STRING, number_of_provisions INT, fetched_at STRING"
)
#: Fixed: the columns of recognition output.
TSV_COLUMNS = ("level", "page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height", "conf", "text")


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A catalog: a JSON array of objects, or JSON lines in a folder that manifest_sink wrote."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def markdown(spark: SparkSession, path: str, skip: tuple[str, ...] = ("index",)) -> DataFrame:
    """(doc_id, text) of a folder of Markdown files, by file stem, index pages left out."""
    rows = spark.read.text(path, wholetext=True, pathGlobFilter="*.md").select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.md$", 1).alias("doc_id"), F.col("value").alias("text"))
    return rows.filter(~F.col("doc_id").isin(*skip))


def page_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc columns, page, text) of form-feed separated pages."""
    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, F.posexplode(F.split(text, "\f", -1)).alias("page", text))


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, content) of PDF or XML bytes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")


def extracted(pdfs: DataFrame, extract: Callable[[bytes], str]) -> DataFrame:
    """(path, text, error) with a pluggable extractor run on the executors; a failing file gives its error."""

    def run(batches):
        for b in batches:
            texts, errors = [], []
            for c in b["content"]:
                try:
                    texts.append(extract(bytes(c)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the batch goes on
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield b[["path"]].assign(text=texts, error=errors)

    return pdfs.mapInPandas(run, "path string, text string, error string")


class PagedService(DataSource):
    """A paged JSON service, read until its first empty page, equality and prefix filters sent along.

    Options: url, page (rows a page), pages (how many pages to read side by side, if their number is known; the rest
    is read on by one task until a page is empty). A subclass gives the static method fetch, which gets (url,
    filter text, skip, top); a page that fails three times fails its task, so no scan is silently partial. Filters are
    sent along if spark.sql.python.filterPushdown.enabled is set, which the reader asks for.
    """

    fetch: Callable[[str, str, int, int], list[dict]] | None = None

    @classmethod
    def name(cls):
        return "paged_service"

    def schema(self):
        return self.options.get("schema", "value string")

    def reader(self, schema):
        return _Pages(schema, self.options, type(self).fetch)


class _Pages(DataSourceReader):
    def __init__(self, schema, options, fetch):
        self.names, self.url, self.fetch = [f.name for f in schema.fields], options.get("url", ""), fetch
        self.page, self.pages, self.filters = int(options.get("page", 100)), int(options.get("pages", 0)), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo):
                self.filters.append(f"{'/'.join(f.attribute)} eq {literal(f.value)}")
            elif isinstance(f, StringStartsWith):
                self.filters.append(f"startswith({'/'.join(f.attribute)},{literal(f.value)})")
            else:
                yield f

    def partitions(self):
        return [InputPartition((i * self.page, i == self.pages)) for i in range(self.pages + 1)]

    def _page(self, skip: int) -> list[dict]:
        for attempt in range(3):
            try:
                return self.fetch(self.url, " and ".join(self.filters), skip, self.page)
            except OSError:
                if attempt == 2:
                    raise
        return []

    def read(self, partition):
        skip, on = partition.value
        while rows := self._page(skip):
            for r in rows:
                yield tuple(r.get(n) for n in self.names)
            if not on:
                break
            skip += self.page


def literal(value) -> str:
    """A value in a service filter; quotes are doubled."""
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def enacted_filter(status: int = 118, prefixes: tuple[str, ...] = ()) -> str:
    """The service filter of enacted bills, by name prefixes if any."""
    names = " or ".join(f"startswith(Name,{literal(p)})" for p in prefixes)
    return f"StatusID eq {status}" + (f" and ({names})" if names else "")


def rendered_pages(pdfs: DataFrame, render: Callable[[bytes, float], list[bytes]], dpi: int = 300) -> DataFrame:
    """(path, page, image) with a pluggable renderer that gets the scale dpi / 72."""

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = [(p, i, img) for p, c in zip(b["path"], b["content"], strict=True) for i, img in enumerate(render(bytes(c), dpi / 72))]
            yield pd.DataFrame(rows, columns=["path", "page", "image"])

    return pdfs.mapInPandas(run, "path string, page int, image binary")


def fetched(batch: DataFrame, cache: DataFrame, fetch: Callable[[str], bytes], key: str = "url", delay: float = 0.0) -> DataFrame:
    """(key, content, error) of the rows of a batch that the cache (key) lacks, with a pluggable fetcher.

    With a delay the service asks for, one task fetches them all, that long apart; without, tasks fetch side by side.
    A file that fails gives its error and no content, so nothing partial is kept.
    """

    def run(batches):
        import time

        for b in batches:
            contents, errors = [], []
            for address in b[key]:
                try:
                    contents.append(fetch(address))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the batch goes on
                    contents.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
                if delay:
                    time.sleep(delay)
            yield b[[key]].assign(content=contents, error=errors)

    asked = batch.select(key).join(cache.select(key).distinct(), key, "left_anti")
    return (asked.coalesce(1) if delay else asked).mapInPandas(run, f"`{key}` string, content binary, error string")


def recognised_pages(pages: DataFrame, text: Callable[[bytes], str], layout: Callable[[bytes], str]) -> DataFrame:
    """(path, page, text, layout) of page images with a pluggable recogniser: plain text, and its table of words."""

    def run(batches):
        for b in batches:
            yield b[["path", "page"]].assign(text=[text(bytes(i)) for i in b["image"]], layout=[layout(bytes(i)) for i in b["image"]])

    return pages.mapInPandas(run, "path string, page int, text string, layout string")


def markdown_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows (doc_id, markdown) that markdown_sink() wrote."""
    return spark.read.parquet(path).drop("bucket")


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of each document in a table that progress_sink() appended to."""
    rows = spark.read.parquet(path)
    return rows.groupBy("doc_id").agg(F.max_by("state", "seq").alias("state"), F.max("seq").alias("seq"))
