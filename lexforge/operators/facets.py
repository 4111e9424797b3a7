"""Facets: labels, group keys and counts for browsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_key(*labels: Column) -> Column:
    """The first label that is not empty, else Other."""
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in labels), F.lit("Other"))


def first_mapped(ids: Column, names: dict[int, str]) -> Column:
    """The name of the first id that has one."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.get(F.filter(F.transform(ids, lambda i: table[i]), lambda n: n.isNotNull()), F.lit(0))


def facet_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(facet, value, n) of several keys in one pass."""
    pairs = F.array(*(F.struct(F.lit(k).alias("facet"), group_key(F.col(k)).alias("value")) for k in keys))
    return rows.select(F.explode(pairs).alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def with_facets(items: DataFrame, facets: DataFrame, key: str, **missing: object) -> DataFrame:
    """Items with their facet row, the given values where there is none."""
    met = items.join(facets, key, "left")
    return met.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in missing.items()})


def facet_row(block: Column, categories: dict[str, str], ministries: dict[int, str]) -> Column:
    """struct(year, category, minister, status) of a law's frontmatter, for browsing."""
    from lexforge.functions.text import field, int_list, year_of

    label = F.create_map(*(F.lit(x) for pair in categories.items() for x in pair))[F.coalesce(field(block, "category"), F.lit(""))]
    fields = {"year": year_of(field(block, "publication_date")), "category": F.coalesce(label, field(block, "category")), "minister": first_mapped(int_list(block, "ministry_ids"), ministries), "status": field(block, "law_validity")}
    return F.struct(*(c.alias(n) for n, c in fields.items()))


def ordered_groups(counts: DataFrame) -> DataFrame:
    """Groups with their place: numbers by size, other keys by Hebrew collation, Other last. There is a row for each
    label, so one task orders them."""
    order = Window.orderBy("facet", F.col("value") == "Other", F.expr("try_cast(value AS INT)").asc_nulls_last(), F.collate("value", "he"))
    return counts.withColumn("place", F.row_number().over(order))


def country_of(path: Column, infixes: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for infix, country in infixes.items():
        out = F.when(F.contains(path, F.lit(infix)) | path.endswith(infix.rstrip("/")), country).otherwise(out)
    return out


def redirect(path: Column, old: str = "/laws/", country: str = "israel") -> Column:
    """The address from before laws were sorted by country."""
    return F.replace(path, F.lit(f"{old}{country}/"), F.lit(old))


def json_record(**fields: Column) -> Column:
    """A JSON object without its empty fields."""
    return F.to_json(F.struct(*(F.nullif(c, F.lit("")).alias(k) for k, c in fields.items())))
