"""N-gram Jaccard join as a blocked sparse matrix product.

The incidence matrix of documents by shingles is multiplied with its transpose shingle by shingle (a block is a
posting list), and overlap counts of pairs are accumulated. Bounds that follow from set sizes keep it sparse:

* every set is put in one order (rare first by a fixed-size count sketch over all documents, then by hash). Sets of
  sizes n that reach the threshold t share one of their first n - ceil(t n) + 1 entries, so only those are multiplied;
* a pair whose sizes differ by more than t, or that could not reach the overlap its sizes demand with what both sets
  have left after the entry they share, is discarded;
* every incidence row is also kept folded, its columns added modulo 2 into 1,024. Two sets differ in at least as many
  entries as their folded rows differ in columns, and linked sets of sizes x, y differ in at most
  (1 - t) / (1 + t) (x + y), so a pair whose folded rows differ in more is discarded without its sets being moved.

Tables that grow with the documents are joined by sorting at every size, so small inputs run as large ones do.

What remains is verified on whole sets. Documents with equal sets are joined by their digest first and count once.
In a posting list every document is multiplied with the list's first document alone, and of those that pass the bounds
the nearest is verified, so that a set is moved once; links found so are merged into components. Then all pairs of a
list that lie in different components are multiplied, in blocks, with the bounds as part of the product: no pair of
different components is missed, and only pairs that pass every bound leave it.

Results: one row per document id; rows that share an id count as the greatest text. A null text is empty: no
shingles, linked with nothing. A null id is linked with nothing and has a null component. Other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import components, dropped, one_row_per_id, written
from lexforge.llm.shingles import mixed, shingle_sets

SKETCH_BITS, FOLD, BLOCK = 18, 16, 1024
FOLDS = [f"w{i}" for i in range(FOLD)]
FEW = FOLDS[: FOLD // 4]


def _batches(batches, k: int):
    for b in batches:
        for at in range(0, b.num_rows, 256):
            some = b.slice(at, 256)
            yield some.column(0), shingle_sets(some.column(1).to_pylist(), k)


def count_sketch(rows: DataFrame, k: int) -> np.ndarray:
    """How many shingles of all documents fall in each of 2**SKETCH_BITS cells: 2 MB at any size of the input."""

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for _, sets in _batches(batches, k):
            total += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    got = rows.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out


def _folded(s: np.ndarray, bits: int) -> np.ndarray:
    """The incidence row of a set folded to so many columns modulo 2, packed in integers."""
    column = (s & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(column, minlength=bits).astype(np.uint8) & 1, bitorder="little").view("<i8")


def _profiles(rows: DataFrame, k: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """(id, n, digest, prefix, wide, w0...): set size, digest of the set, its first entries in the common order, and the
    folded row: of 64 * FOLD columns, and for larger sets a wide one of at least as many columns as entries."""
    few = np.minimum(np.log2(sketch + 1) * 4, 255).astype(np.uint8)  # order needs the magnitude only

    def run(batches):
        for ids, sets in _batches(batches, k):
            n = np.array([len(s) for s in sets], np.int64)
            with np.errstate(over="ignore"):
                digest = [int(mixed(s).sum().astype(np.int64)) for s in sets]
            prefix = []
            for s in sets:
                take = len(s) - -(-percent * len(s) // 100) + 1
                rank = few[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                prefix.append(s[np.argsort(rank, kind="stable")[:take]].view(np.int64))
            folds = np.stack([_folded(s, 64 * FOLD) for s in sets])
            wide = [_folded(s, 1 << (len(s) - 1).bit_length()) if len(s) > 64 * FOLD else None for s in sets]
            columns = [ids, pa.array(n), pa.array(digest, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(folds[:, i]) for i in range(FOLD))], ["id", "n", "digest", "prefix", "wide", *FOLDS])

    return rows.mapInArrow(run, "id long, n long, digest long, prefix array<long>, wide array<long>, " + ", ".join(f"{w} long" for w in FOLDS))


def _apart(a: str, b: str, words: list[str]):
    """In how many columns the folded rows of a and b differ: never more than the sets themselves."""
    return sum((F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in words), F.lit(0))


def _may_link(a: str, b: str, percent: int, apart):
    """Sets of sizes x, y that link differ in at most (1 - t) / (1 + t) * (x + y) entries."""
    return (100 + percent) * apart <= (100 - percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _close(pairs: DataFrame, folded: DataFrame, percent: int) -> DataFrame:
    """(a, b, apart) of the pairs (a, b) whose folded rows, the wide ones too, allow a link."""
    x, y = (folded.select(F.col("id").alias(i), F.struct("n", "wide", *FOLDS).alias(side)) for i, side in (("a", "x"), ("b", "y")))
    met = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").filter(_may_link("x", "y", percent, _apart("x", "y", FOLDS)))
    xor = lambda p, q: F.zip_with(p, q, lambda u, v: u.bitwiseXOR(v))
    half = lambda w: xor(F.slice(w, F.lit(1), (F.size(w) / 2).cast("int")), F.slice(w, (F.size(w) / 2).cast("int") + 1, (F.size(w) / 2).cast("int")))
    # linked sets differ in size by less than half, so the larger row needs one more fold at most
    met = met.withColumns({"u": F.col("x.wide"), "v": F.col("y.wide")})
    met = met.withColumns({"u": F.when(F.size("u") > F.size("v"), half(F.col("u"))).otherwise(F.col("u")), "v": F.when(F.size("v") > F.size("u"), half(F.col("v"))).otherwise(F.col("v"))})
    wide = F.aggregate(xor(F.col("u"), F.col("v")), F.lit(0), lambda n, w: n + F.bit_count(w))
    met = met.withColumn("apart", F.coalesce(wide, _apart("x", "y", FOLDS)))
    return met.filter(_may_link("x", "y", percent, F.col("apart"))).select("a", "b", (F.col("apart") / (F.col("x.n") + F.col("y.n"))).alias("apart"))


def _verified(pairs: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the threshold, written.

    The text of b is sent to that of a, and sets are made where they meet, which moves less than sets would. An a with
    many pairs is dealt to several tasks, its text to each of them.
    """
    pairs = written(pairs.select("a", "b"), "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts"))
    heads = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("a").alias("id"))
    ends = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), F.col("b").alias("id"))
    asked = written(heads.unionByName(ends), "asked")
    sent = rows.join(asked.hint("merge"), "id").select("a", "part", "role", "id", "text")

    def run(batches):
        first, own = None, None
        for b in batches:
            for at in range(0, b.num_rows, 64):
                some = b.slice(at, 64)
                a, role, ids = (some.column(c).to_pylist() for c in ("a", "role", "id"))
                hits = []
                for i, s in enumerate(shingle_sets(some.column("text").to_pylist(), k)):
                    if role[i] == 0:
                        first, own = a[i], s
                        continue
                    assert first == a[i]
                    both = len(np.intersect1d(own, s, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(s) - both):
                        hits.append((a[i], ids[i]))
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*hits, strict=True)], ["a", "b"])

    met = sent.repartition("a", "part").sortWithinPartitions("a", "part", "role").mapInArrow(run, "a long, b long")
    out = written(met, "links")
    dropped(pairs)
    dropped(asked)
    return out


def _multiplied(placed: DataFrame, folded: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a list and pass all bounds.

    A list is cut in blocks of BLOCK documents and every pair of blocks is a key of its own, so that no task gets more
    than two blocks of a list at once; the bounds are part of the join, so only pairs that pass leave it.
    """
    order = Window.partitionBy("s").orderBy("id")
    # a document whose neighbours by size in the list are too large or too small meets none of them
    by_size = Window.partitionBy("s").orderBy("n", "id")
    ahead, behind = F.lead("n").over(by_size), F.lag("n").over(by_size)
    near = (100 * F.col("n") >= percent * F.coalesce(ahead, 100 * F.col("n"))) | (100 * F.coalesce(behind, F.lit(0)) >= percent * F.col("n"))
    placed = placed.withColumn("_near", near).filter("_near").drop("_near")
    cut = placed.withColumn("own", F.floor((F.row_number().over(order) - 1) / BLOCK).cast("int"))
    cut = written(cut.withColumn("last", F.max("own").over(Window.partitionBy("s"))), "cut")
    part = lambda i: reduce(lambda x, y: x.bitwiseXOR(y), (F.col(w) for w in FOLDS[i :: len(FEW)]))
    half = [part(i).alias(w) for i, w in enumerate(FEW)]  # folded further, as lists are many
    cut = cut.join(folded.select("id", *half).hint("merge"), "id")
    l = cut.withColumn("other", F.explode(F.sequence("own", "last"))).alias("l")
    r = cut.withColumn("with", F.explode(F.sequence(F.lit(0), "own"))).alias("r")
    met = (F.col("l.s") == F.col("r.s")) & (F.col("l.own") == F.col("r.with")) & (F.col("l.other") == F.col("r.own"))
    overlap = F.ceil(F.lit(percent) * (F.col("l.n") + F.col("r.n")) / (100 + percent))
    first = (F.col("l.pos") <= F.col("l.n") - overlap) & (F.col("r.pos") <= F.col("r.n") - overlap)
    unlike = (F.col("l.id") < F.col("r.id")) & (F.col("l.component") != F.col("r.component"))
    near = 100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n")
    pairs = l.join(r, met & unlike & near & first & _may_link("l", "r", percent, _apart("l", "r", FEW)))
    return pairs.select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()


def ngram_join(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of each document; links need 100 * intersection >= percent * union."""
    rows = one_row_per_id(docs, key, text).toDF("id", "text")
    profiles = written(_profiles(rows, k, percent, count_sketch(rows, k)), "profiles")
    sized = profiles.filter("n > 0 and id is not null")
    groups = sized.groupBy("n", "digest").agg(F.min(F.struct("id", "prefix", "wide", *FOLDS)).alias("one"))
    heads = written(groups.select("n", "digest", "one.*"), "heads")
    own = written(profiles.select("id", "n", "digest"), "sizes")
    dropped(profiles)
    posted = heads.select("id", "n", F.posexplode("prefix").alias("pos", "s"))
    by_list = Window.partitionBy("s")
    lists = posted.withColumns({"first": F.min(F.struct("id", "n", "pos")).over(by_list), "many": F.count("*").over(by_list)})
    lists = written(lists.filter("many > 1").drop("many"), "lists")

    folded = written(heads.select("id", "n", "digest", "wide", *FOLDS), "folded")
    dropped(heads)
    star = lists.filter(F.col("id") != F.col("first.id")).select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct()
    # one leader for each document, so that its text is sent once
    best = _close(star, folded, percent).groupBy("b").agg(F.min(F.struct("apart", "a")).alias("best"))
    found = _verified(best.select("best.a", "b"), rows, k, percent)
    part = components(found)

    placed = lists.select("s", "id", "n", "pos").join(part.hint("shuffle_hash"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed_lists = placed.groupBy("s").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("s")
    placed = placed.join(mixed_lists.hint("merge"), "s")
    more = _verified(_close(_multiplied(placed, folded, percent), folded, percent), rows, k, percent)
    dropped(lists)
    ends = lambda e: e.select("a", "b")
    # links of the second pass join components of the first
    joined = part.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(ends(more))
    final = components(joined)

    of_group = folded.select("n", "digest", "id").join(final, "id", "left").select("n", "digest", F.coalesce("component", "id").alias("component_id"))
    out = own.join(of_group.hint("merge"), ["n", "digest"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay when each group of linked rows keeps the one with the smallest id, a null id last.

    Where an id is null or repeats, every row gets a key of its own for the join, so that rows are dropped for a link
    only; of rows with the same id the one with the smallest digest of the text goes first.
    """
    if not docs.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).limit(1).count():
        stay = ngram_join(docs, k, percent, key, text).filter(F.col(key) == F.col("component_id")).select(key)
        return docs.join(stay, key, "left_semi").select(*docs.columns)
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.sha2(text, 256).alias("digest"), F.col("_row").alias("row"))
    met = rows.select("_row", order.alias("x")).join(ngram_join(rows, k, percent, "_row", text), "_row")
    stay = met.groupBy("component_id").agg(F.min("x").alias("x")).select(F.col("x.row").alias("_row"))
    return rows.join(stay, "_row", "left_semi").select(*docs.columns)
