"""Model-backed steps as interfaces with a callable, and deterministic stand-ins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.text import title_key

UNCERTAIN = "[?]"


def reconciled(docs: DataFrame, model: Callable[[str], str], request: str = "request") -> DataFrame:
    """Column answer: the model's text for each request; the callable runs on the executors."""

    @F.pandas_udf("string")
    def ask(requests):
        return requests.map(lambda r: None if r is None else model(r))

    return docs.withColumn("answer", ask(request))


def request(native: Column, ocr: Column, prompt: str) -> Column:
    return F.concat(F.lit(prompt), F.lit("\n\n<native>\n"), native, F.lit("\n</native>\n\n<ocr>\n"), ocr, F.lit("\n</ocr>\n"))


def agreed(native: Column, ocr: Column, far: int = 3) -> Column:
    """Two witnesses of a line: characters by the native text, an unclear line marked."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    near = F.levenshtein(native, ocr) <= far
    return F.when(blank(native), ocr).when(blank(ocr) | near, native).otherwise(F.concat(native, F.lit(f" {UNCERTAIN}")))


def found_titles(docs: DataFrame, titles: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, title, pos): known titles of so many words in the text, by an equi-join of word windows."""

    def each(tokens: Column) -> Column:
        # bound to a lambda variable, so the text is split once and not for every window
        starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - words, F.lit(0)))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(words)), " "))

    windows = F.get(F.transform(F.array(F.split(title_key(F.col(text)), " ")), each), F.lit(0))
    return docs.select(key, F.posexplode(windows).alias("pos", "title")).join(titles.select("title").distinct(), "title").select(key, "title", "pos")


def parsed_refs(raw: Column) -> Column:
    """References of a model's JSON answer; anything but an array is empty."""
    kind = "array<struct<found_in_doc:string,official_name:string,year_ce:int>>"
    return F.when(F.ltrim(raw).startswith("["), F.coalesce(F.from_json(raw, kind), F.array().cast(kind))).otherwise(F.array().cast(kind))
