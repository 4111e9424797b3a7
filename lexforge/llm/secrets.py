"""Secret scans, all in DataFrame functions: fixed patterns, then multipart credential linking.

The base kinds are found by leftmost non-overlapping matching; their offsets come from the lengths of the texts
between matches. Linking then looks at weak parts that are no base span by themselves: access identifiers,
secrets and endpoints. Parts meet in an interval join within a scope (a distance in code points), by equal buckets of
positions; a weak identifier or secret is reported only when a complementary part lies in its scope.

Results: one row per input row. A null text counts as empty (no spans). Rows that repeat an id are scanned each by
itself: they are told apart by their text's digest, and equal rows get equal results. A null id stays null. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import written

#: Fixed by the contract: (kind, pattern, group that is measured, its least length), in the order of kinds.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: A run of a secret's characters; what it must hold: 20 or more of them, a digit, an upper and a lower letter.
_RUN = "[A-Za-z0-9+/_=-]"
_MIXED = f"(?={_RUN}{{20}})(?=[A-Za-z+/_=-]*+[0-9])(?=[a-z0-9+/_=-]*+[A-Z])(?=[A-Z0-9+/_=-]*+[a-z])"
#: The same of a name before "=": such a name is part of the secret.
_MIXED_NAME = "(?=[A-Za-z0-9_-]{20})(?=[A-Za-z_-]*+[0-9])(?=[a-z0-9_-]*+[A-Z])(?=[A-Z0-9_-]*+[a-z])"
#: Weak parts: (kind, part, pattern). Parts complement each other: an identifier or an endpoint with a secret.
#: A weak secret is a whole run, however long, without a leading name= where what follows is a secret by itself; the
#: span is the pattern's group, which ends the match.
WEAK = (
    ("weak_id", "id", r"""(?<![A-Za-z0-9])(?:(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}|(?i:access_?key_?id|client_?id|user_?name|login)["']?\x20{0,4}[:=]\x20{0,4}["']?[A-Za-z0-9@._-]{4,})"""),
    ("weak_secret", "secret", rf"""(?<!{_RUN}){_MIXED}(?:(?!{_MIXED_NAME})[A-Za-z0-9_-]++=++(?={_MIXED}))?({_RUN}{{20,}}+)"""),
    ("endpoint", "endpoint", r"""(?i:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9.:@_-]{4,}|(?i:endpoint|host)["']?\x20{0,4}[:=]\x20{0,4}["']?[A-Za-z0-9.:_-]{4,}"""),
)
SCOPE = 300


def spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0, last: bool = False) -> Column:
    """Array of (start, kind, end) of leftmost non-overlapping matches, those whose group is too short dropped.

    With last the span is the group alone, which has to end the match.
    """
    whole, measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    both = F.arrays_zip(gaps.alias("gap"), F.transform(whole, lambda m: F.length(m)).alias("size"), F.transform(measured, lambda m: F.length(m)).alias("inner"))
    found = F.filter(both, lambda x: x["size"].isNotNull())
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:string,end:int>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        begin = start + x["size"] - x["inner"] if last else start
        span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (start + x["size"]).alias("end")))
        return F.struct((start + x["size"]).alias("at"), F.when(x["inner"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    return F.when(text.rlike(_sieve(kind, pattern)), F.aggregate(found, first, step, lambda acc: acc["out"])).otherwise(none)


def _sieve(kind: str, pattern: str) -> str:
    """A pattern that every text with a span of the kind matches and that is cheap to try."""
    return {"access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}.get(kind, pattern)


def _equals(value: str):
    return lambda x: x == value


def joined(found: Column) -> Column:
    """kind:start:end of spans in their order, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def ordered(found: Column, kinds: tuple[str, ...]) -> Column:
    """Spans by start, then kind as listed."""
    rank = F.array(*map(F.lit, kinds))
    keyed = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.array_position(rank, x["kind"]).alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak identifiers and secrets with a complementary part at most scope code points away.

    parts: (doc, digest, start, kind, end, part). Identifiers and endpoints are dealt to the buckets that their
    reach touches, secrets to the buckets of their start and their end: parts that are near don't overlap, so one of
    the two ends lies within the reach. A pair may meet twice; only whether a complement exists is kept.
    """
    bucket = lambda c: F.floor(c / scope).cast("int")
    secrets = parts.filter("part = 'secret'").withColumn("b", F.explode(F.array_distinct(F.array(bucket(F.col("start")), bucket(F.col("end"))))))
    others = parts.filter("part <> 'secret'").withColumn("b", F.explode(F.sequence(bucket(F.greatest(F.col("start") - scope, F.lit(0))), bucket(F.col("end") + scope))))
    # extremes by bucket decide whether any complement is near, so no bucket's pairs are multiplied out
    s, o = secrets.alias("s"), others.alias("o")
    same = F.col("s.doc").eqNullSafe(F.col("o.doc")) & (F.col("s.digest") == F.col("o.digest")) & (F.col("s.b") == F.col("o.b"))
    near = (F.col("s.start") < F.col("o.end") + scope) & (F.col("o.start") < F.col("s.end") + scope) & ((F.col("s.end") <= F.col("o.start")) | (F.col("o.end") <= F.col("s.start")))
    keep = ["doc", "digest", "start", "kind", "end"]
    hit_secrets = s.join(o, same & near, "left_semi").select(*keep).distinct()
    hit_others = o.join(s, same & near, "left_semi").filter("part = 'id'").select(*keep).distinct()
    return hit_secrets.unionByName(hit_others).filter("kind like 'weak%'")


def _reportable(text: Column) -> Column:
    """Whether a text has a weak identifier or a weak secret; no other text can gain a span by linking."""
    return text.rlike(WEAK[0][2]) | text.rlike(WEAK[1][2])


def secret_spans(docs: DataFrame, scope: int = SCOPE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, digest, base, every): arrays of (start, kind, end) of each row, base ones alone and with linked ones.

    Only rows with a weak part that could be reported are shuffled; the others are done where they are read.
    """
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = tuple(k[0] for k in BASE)
    base = ordered(F.concat(*(spans(F.col("text"), *k) for k in BASE)), kinds)
    alone = rows.filter(~_reportable(F.col("text"))).select(F.col("doc").alias(key), F.sha2("text", 256).alias("digest"), base.alias("base"))
    alone = alone.withColumn("every", F.col("base"))

    # base spans are parts too: access keys identify, assigned values and hex strings are secrets
    some = rows.filter(_reportable(F.col("text"))).withColumn("digest", F.sha2("text", 256))
    weak = F.concat(*(spans(F.col("text"), k, p, int(k == "weak_secret"), 0, k == "weak_secret") for k, _, p in WEAK))
    some = written(some.select("doc", "digest", base.alias("base"), weak.alias("weak")), "parts")
    clear = F.filter(F.col("weak"), lambda w: ~F.exists(F.col("base"), lambda b: (w["start"] < b["end"]) & (b["start"] < w["end"])))
    part = F.create_map(*(F.lit(x) for k, p, _ in WEAK for x in (k, p)), *(F.lit(x) for x in ("assign", "secret", "hex", "secret", "access", "id")))
    found = some.select("doc", "digest", F.explode(F.concat(clear, "base")).alias("x"))
    parts = found.select("doc", "digest", "x.*").distinct().withColumn("part", part[F.col("kind")])
    extra = linked(parts, scope).groupBy("doc", "digest").agg(F.collect_set(F.struct("start", "kind", "end")).alias("extra"))

    f, e = some.select("doc", "digest", "base").alias("f"), extra.alias("e")
    met = f.join(e, F.col("f.doc").eqNullSafe(F.col("e.doc")) & (F.col("f.digest") == F.col("e.digest")), "left")
    none = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    every = ordered(F.concat(F.col("f.base"), F.coalesce(F.col("e.extra"), none)), (*kinds, *(w[0] for w in WEAK)))
    return alone.unionByName(met.select(F.col("f.doc").alias(key), F.col("f.digest").alias("digest"), "base", every.alias("every")))


def secret_scan(docs: DataFrame, scope: int = SCOPE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans) of each row."""
    got = secret_spans(docs, scope, key, text)
    counts = [F.size(F.filter(F.transform("base", lambda x: x["kind"]), _equals(k))).cast("long").alias(f"n_{k}") for k, *_ in BASE]
    return got.select(key, *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("every")).alias("spans"))


def _found(text: Column) -> Column:
    """Whether a text may hold a span that is replaced."""
    return F.coalesce(functools.reduce(lambda a, b: a | b, (text.rlike(_sieve(k, p)) for k, p, *_ in BASE)) | _reportable(text), F.lit(False))


def redacted(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, each secret span (of either sort) replaced by mark; n_chars, if there, follows the text.

    Rows without a span pass as they are; only the others are written, scanned and joined with their spans.
    """
    own = written(docs.filter(_found(F.col(text))), "suspects")
    cuts = F.filter("every", lambda x: x["kind"] != "endpoint")
    found = secret_spans(own, scope, key, text).select(F.col(key).alias("doc"), "digest", cuts.alias("cuts"))
    found = found.filter(F.size("cuts") > 0).distinct().alias("f")
    # the row's own columns stay in a struct, so no name of theirs can clash
    rows = own.select(F.struct(*own.columns).alias("row"), F.col(key).alias("doc"), F.sha2(text, 256).alias("digest"), F.col(text).alias("text")).alias("o")
    met = rows.join(found, F.col("o.doc").eqNullSafe(F.col("f.doc")) & (F.col("o.digest") == F.col("f.digest")), "left").select("row", "text", "cuts")
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        more = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

    def rest(acc):
        return F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))

    new = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.aggregate("cuts", first, step, rest))
    out = met.select(*(new.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
    out = out.unionByName(docs.filter(~_found(F.col(text))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
