"""Writers: catalogs, Markdown files, progress, facets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_sink(df: DataFrame, path: str) -> None:
    """JSON lines, characters kept as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def catalog_text(df: DataFrame, order: str, name: str = "json") -> DataFrame:
    """One row: the catalog as one JSON array in the given order, indented, characters kept. For catalogs that a file
    can hold; manifest_sink() writes larger ones as JSON lines."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), F.struct(*df.columns).alias("row"))))
    return df.agg(F.to_json(F.transform(rows, lambda x: x["row"]), {"pretty": "true", "ignoreNullFields": "false"}).alias(name))


def markdown_sink(df: DataFrame, path: str, key: str = "doc_id", text: str = "markdown", buckets: int = 256) -> None:
    """Documents by id in a fixed number of buckets, so the store lists as many folders at any size of the corpus."""
    rows = df.select(key, text).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def markdown_files(df: DataFrame, path: str, key: str = "doc_id", text: str = "markdown") -> None:
    """One text file per document, in a folder of its id: for the edge of a corpus, such as a batch to publish."""
    df.select(key, text).write.mode("overwrite").partitionBy(key).option("lineSep", "\n").text(path)


def tree_sink(parts: DataFrame, path: str, key: str = "doc_id") -> None:
    """The parts of each law as one JSON object a line: (key, part, pos, text, x0, y0, x1, y1) rows by part."""
    entry = F.struct("pos", "text", F.array("x0", "y0", "x1", "y1").alias("bbox"))
    by_part = parts.groupBy(key, "part").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    by_part.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("part", "entries")))).alias("parts")).write.mode("overwrite").json(path)


def facet_sink(rows: DataFrame, path: str) -> None:
    """Facet rows as JSON lines, empty fields kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def table_sink(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet, only the partitions that df has being replaced when by is given."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(by) if by else w).parquet(path)


def progress_sink(df: DataFrame, path: str) -> None:
    """Append (doc_id, state, seq); the state of a document is its latest row."""
    df.select("doc_id", "state", "seq").write.mode("append").parquet(path)


def json_map(df: DataFrame, key: str, value: str):
    """One row with a JSON object of values by key, keys sorted, and its digest."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))
    return df.agg(F.to_json(entries).alias("json")).withColumn("sha256", F.sha2("json", 256))
