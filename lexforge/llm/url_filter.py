"""URL rules, then a character language-model ratio, all in DataFrame functions.

Host and path are cut from the url; the longest rule that fits gives the verdict. Two smoothed variable-order Markov
models (interpolated by Witten-Bell weights) are trained: one of rejected URLs, those that a rule blocks, and one of
accepted URLs, all that no rule blocks: no other labels exist. Addresses are halved by their CRC-32, and each half is
scored by models of the other half, so no URL is judged by models that were trained on it. URLs without a rule are
judged by the difference of the two log-likelihoods per character, against a threshold below which at most one in
twenty accepted URLs falls; it is never above 0, so none is blocked that looks more like the accepted ones.

The models read the whole URL behind "://": its host, path, query and fragment.

Every character is a symbol of its own, and contexts have no greatest length: they grow along 0, 1, 2, 3, 5, 8, 13 and
so on, wherever the shorter one was seen LEAST times, up to the whole prefix. The places of all addresses are first
made distinct by prefix and symbol; counts of a context and its symbols are tables, aggregated and joined once for
each length, so what is gathered grows with the input. No array of a fixed size is kept, and no Python runs.

Results: one row per input row, whatever its id (null, repeated); rows that share an address share its verdict. A long
URL has as many contexts as characters, each as long as training bears. A null url or one without "://" has empty host and
path and, as the models say nothing of it (score 0), is allowed unless the threshold is above 0. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import dropped, written

#: Fixed by the contract: (rule, verdict).
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))

#: A context is lengthened where training has seen it so often.
LEAST = 4
FALSE_BLOCKS = 0.05


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty where there is no "://"."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def whole_address(url: Column) -> Column:
    """The URL behind "://", A-Z of its host lower-cased; empty where there is no "://"."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.concat(host_path(url)[0], F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1), F.lit("")))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, says in sorted(rules, key=lambda r: len(r[0])):
        on, slash, prefix = name.partition("/")
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def places(addresses: DataFrame) -> DataFrame:
    """The columns of addresses with before and symbol of each place of address and of its end (symbol "")."""
    at = addresses.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("address"))))
    return at.withColumns({"before": F.expr("substring(address, 1, i)"), "symbol": F.expr("substring(address, i + 1, 1)")}).drop("i")


def log_ratios(edges: DataFrame) -> DataFrame:
    """(side, before, symbol, ratio): log p(accepted) - log p(rejected) of each edge. edges: (side, before, symbol, allow,
    block), a side being models of their own.

    allow and block are how often training holds the edge. An edge leaves the loop when its context is the whole
    prefix, boundary included ("^"), or was seen less than LEAST times; the others go on to a longer context.
    """
    live = written(edges, "edges")
    n_symbols = live.agg(F.count_distinct("symbol")).first()[0]
    live = live.withColumns({f"p_{v}": F.lit(1.0 / (n_symbols + 1)) for v in ("allow", "block")})
    done, order, longer = None, 0, 1
    while True:
        size = F.length("before")
        context = F.when(size < order, F.concat(F.lit("^"), F.col("before"))).otherwise(F.concat(F.lit("."), F.expr(f"right(before, {order})")))
        at = live.withColumn("context", context)
        counts = at.groupBy("side", "context", "symbol").agg(*(F.sum(v).alias(f"c_{v}") for v in ("allow", "block")))
        # a context has a row for each symbol, so a window over it is small
        by = Window.partitionBy("side", "context")
        sums = {f"n_{v}": F.sum(f"c_{v}").over(by) for v in ("allow", "block")}
        sums |= {f"t_{v}": F.count_if(F.col(f"c_{v}") > 0).over(by) for v in ("allow", "block")}
        met = at.join(counts.withColumns(sums), ["side", "context", "symbol"])

        def p(v: str) -> Column:
            c, n, t, shorter = (F.col(f"{x}_{v}") for x in "cntp")
            return F.when(n > 0, (c + t * shorter) / (n + t)).otherwise(shorter)

        more = (size >= order) & (F.col("n_allow") + F.col("n_block") >= LEAST)
        out = met.select("side", "before", "symbol", "allow", "block", p("allow").alias("p_allow"), p("block").alias("p_block"), more.alias("more"))
        out = written(out, "edges")
        ended = written(out.filter(~F.col("more")).select("side", "before", "symbol", F.round(F.log("p_allow") - F.log("p_block"), 9).alias("ratio")), "ratios")
        done = ended if done is None else done.unionByName(ended)
        dropped(live)
        live = out.filter("more").drop("more")
        if live.isEmpty():
            return done
        order, longer = longer, max(order + longer, 2)


def url_filter(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, score) of each row; score is null where a rule decides."""
    host, path = host_path(F.col(url))
    rows = pages.select(key, host.alias("host"), path.alias("path"), whole_address(F.col(url)).alias("address"))
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "says": says})
    verdict = F.coalesce("says", F.lit("allow"))
    # an address has one verdict, so rows that share it are counted together
    taught = rows.filter(F.length("address") > 0).groupBy("address").agg(F.min(verdict).alias("verdict"), F.count("*").alias("many"), F.bool_or(F.col("says").isNull()).alias("asked"))
    taught = written(taught.withColumn("half", F.pmod(F.crc32(F.col("address")), F.lit(2)).cast("int")), "addresses")
    # an edge of one half counts for the models of the other, and is asked of them for its own
    each = places(taught.select("address", "half", "verdict", "many")).groupBy("half", "before", "symbol").agg(*(F.sum(F.when(F.col("verdict") == v, F.col("many")).otherwise(0)).alias(v) for v in ("allow", "block")))
    sides = F.explode(F.array(F.struct(F.col("half").alias("side"), F.lit(0).alias("k")), F.struct((1 - F.col("half")).alias("side"), F.lit(1).alias("k"))))
    both = each.select("*", sides.alias("x")).groupBy("x.side", "before", "symbol").agg(*(F.sum(F.col(v) * F.col("x.k")).alias(v) for v in ("allow", "block")))
    ratios = log_ratios(both)
    # what is asked: rows without a rule, and the accepted ones for the threshold
    asked = taught.filter(F.col("asked") | (F.col("verdict") == "allow"))
    total = places(asked.withColumn("side", F.col("half"))).join(ratios, ["side", "before", "symbol"]).groupBy("address").agg(F.round(F.sum(F.col("ratio").cast("decimal(28,9)")).cast("double") / F.count("*"), 6).alias("score"))
    scores = written(asked.join(total, "address"), "scores")

    # the threshold that blocks at most FALSE_BLOCKS of accepted URLs, but never more than 0
    held = scores.filter(F.col("verdict") == "allow").select(F.round("score", 3).alias("score"), "many")
    limit = held.agg(F.least(F.lit(0.0), F.coalesce(F.round(F.percentile("score", F.lit(FALSE_BLOCKS), F.col("many")), 3), F.lit(0.0))).alias("t")).scalar()
    own = scores.select(F.col("address").alias("of"), F.col("score").alias("found"))
    out = rows.join(own, F.col("address") == F.col("of"), "left").withColumn("score", F.when(F.col("says").isNull(), F.coalesce("found", F.lit(0.0))))
    verdict = F.coalesce("says", F.when(F.round("score", 3) >= limit, "allow").otherwise("block"))
    return out.select(key, "host", "path", "rule", verdict.alias("verdict"), "score")
