"""Embedding near-dedup by a forest of random-projection trees.

Equal vectors of a label are counted as one first. Each tree splits at random directions, recursively; a vector
near a split goes to both sides (spill), so close pairs seldom part. The upper part of each tree is fitted on a bounded
sample (SAMPLE vectors) and deals every row to cells; within its cell a tree splits on by further directions at the
medians of the cell's own rows, so leaves stay small at any number of vectors. Within a leaf pairs of a label are
compared in double precision, and only a spanning forest of the links leaves the task; components come from those.
A leaf that no direction splits, as many rows lie close together, is compared through leaders: rows that link with a
leader need no comparison among each other to be one component.

Links are then counted within components, exactly: their rows are compared in blocks, two blocks a key, so that a
large component is many tasks.

Results: one row per vector id; rows that share an id count as one, the greatest vector of the greatest label.
Vectors that are null, empty, zero, or hold null or non-finite components, and those without a label, link with
nothing; so do vectors of different lengths. A null id has a null component and is not kept. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import components, dropped, written

#: Rows of the sample that upper trees are fitted on, dimensions that get upper trees (other ones have a cell a tree
#: and label, split within it alike), trees, rows of a leaf, spill, rows of a block.
SAMPLE, DIMENSIONS, TREES, LEAF, SPILL, BLOCK = 20_000, 100, 5, 64, 0.01, 512


def _way(seed: int, size: int) -> np.ndarray:
    way = np.random.default_rng(seed).normal(size=size)
    return way / np.linalg.norm(way)


class Tree:
    """Random splits at medians; a node keeps the seed of its direction instead of the direction."""

    def __init__(self, x: np.ndarray, leaf: int, seed: int):
        self.nodes: list[tuple] = []  # (seed, cut, left, right) or (leaf number,)
        self.leaves, self.rows = 0, []
        self._grow(x, np.arange(len(x)), leaf, seed, 0)

    def _grow(self, x, rows, leaf, seed, depth) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) > leaf and depth < 60:
            for k in range(4):  # a direction along which the rows lie apart
                own = hash((seed, at, k)) & 0x7FFFFFFF
                p = x[rows] @ _way(own, x.shape[1])
                cut = np.median(p)
                low, high = p < cut + SPILL, p >= cut - SPILL
                if low.sum() + high.sum() <= 1.5 * len(rows) and low.any() and high.any():
                    left = self._grow(x, rows[low], leaf, seed, depth + 1)
                    right = self._grow(x, rows[high], leaf, seed, depth + 1)
                    self.nodes[at] = (own, cut, left, right)
                    return at
        self.nodes[at] = (self.leaves,)
        self.rows.append(rows)
        self.leaves += 1
        return at

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that a row falls in."""
        out, todo = [], [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            node = self.nodes[at]
            if len(node) == 1:
                out.append((rows, np.full(len(rows), node[0])))
            elif len(rows):
                p = x[rows] @ _way(node[0], x.shape[1])
                todo += [(node[2], rows[p < node[1] + SPILL]), (node[3], rows[p >= node[1] - SPILL])]
        return np.concatenate([r for r, _ in out]), np.concatenate([v for _, v in out])


class Roots:
    """Union of row numbers, the smallest being the root."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def top(self, i: int) -> int:
        while self.of[i] != i:
            self.of[i] = self.of[self.of[i]]
            i = self.of[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.top(i), self.top(j)
        self.of[max(i, j)] = min(i, j)


def join_leaf(x: np.ndarray, rows: np.ndarray, least: float, roots: Roots) -> None:
    """Joins the linked ones among some rows of x."""
    if len(rows) <= BLOCK:
        y = x[rows]
        near = y @ y.T >= least
        np.fill_diagonal(near, True)
        if near.sum() == len(rows):
            return
        label = np.arange(len(rows))
        while True:  # the smallest label next to each row, until none changes
            new = np.where(near, label[None], len(rows)).min(1)
            if (new == label).all():
                break
            label = new
        for i in np.flatnonzero(label != np.arange(len(rows))):
            roots.join(int(rows[i]), int(rows[label[i]]))
        return
    owner, leaders = np.full(len(rows), -1), []
    while (free := np.flatnonzero(owner < 0)).size:
        at = int(free[0])
        hit = x[rows] @ x[rows[at]] >= least
        hit[at] = True
        for k in np.unique(owner[hit & (owner >= 0)]):
            roots.join(int(rows[at]), int(rows[leaders[k]]))
        owner[hit & (owner < 0)] = len(leaders)
        leaders.append(at)
    for i in np.flatnonzero(np.array(leaders)[owner] != np.arange(len(rows))):
        roots.join(int(rows[i]), int(rows[leaders[owner[i]]]))
    # rows of two leaders may link though neither leader does; not where the leaders lie more than three links apart
    heads, far = x[rows[leaders]], np.cos(min(np.pi, 3 * np.arccos(min(1.0, least)))) - 1e-9
    own = [rows[owner == k] for k in range(len(leaders))]
    for k in range(len(leaders)):
        for j in np.flatnonzero(heads[:k] @ heads[k] >= far):
            if roots.top(int(own[k][0])) != roots.top(int(own[j][0])) and _meet(x, own[k], own[j], least):
                roots.join(int(own[k][0]), int(own[j][0]))


def _meet(x: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether any row of a links with one of b, in blocks."""
    return any((x[a[i : i + BLOCK]] @ x[b[j : j + BLOCK]].T >= least).any() for i in range(0, len(a), BLOCK) for j in range(0, len(b), BLOCK))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def near_vectors(vectors: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) of each vector."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    if rows.groupBy("id").count().filter("count > 1").limit(1).count():
        rows = rows.groupBy("id").agg(F.max(F.struct("label", "v")).alias("x")).select("id", "x.v", "x.label")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda c: c != 0))
    # -0.0 and 0.0 compare equal; written the same they hash the same
    usable = usable.withColumn("v", F.transform("v", lambda c: c + F.lit(0.0)))
    groups = usable.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    groups = written(groups.withColumn("d", F.size("v")), "vectors")
    many = groups.groupBy("d").count().filter(F.col("count") > SAMPLE).orderBy(F.desc("count"), "d").limit(DIMENSIONS).collect()

    forests = {}
    for d, n in ((r.d, r["count"]) for r in many):
        some = groups.filter(F.col("d") == d).orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").toArrow()
        x = _unit(_matrix(some["v"].combine_chunks()))
        forests[d] = [Tree(x, max(4, 1024 * len(x) // n), 97 * t + d) for t in range(TREES)]
        for tree in forests[d]:
            tree.rows = []
    shared = spark.sparkContext.broadcast(forests)  # seeds and cuts: under 0.2 MB a tree, of DIMENSIONS * TREES at most

    def place(batches):
        for b in batches:
            ds = b.column("d").to_numpy()
            for d in np.unique(ds):
                some = b.filter(pa.array(ds == d))
                x = _unit(_matrix(some.column("v")))
                trees = [t.place(x) for t in shared.value[int(d)]] if int(d) in shared.value else [(np.arange(len(x)), np.zeros(len(x), np.int64))] * TREES
                row = np.concatenate([r for r, _ in trees])
                cell = np.concatenate([v + (t << 40) for t, (_, v) in enumerate(trees)])
                yield pa.RecordBatch.from_arrays([*(some.column(c).take(pa.array(row)) for c in ("label", "d", "id", "v")), pa.array(cell)], ["label", "d", "id", "v", "cell"])

    kind = rows.schema["label"].dataType.simpleString()
    dealt = groups.select("label", "d", "id", "v").mapInArrow(place, f"label {kind}, d int, id long, v array<double>, cell long")

    def compare(table: pa.Table) -> pa.Table:
        ids, cell = table["id"].to_numpy(), table["cell"][0].as_py()
        order = np.argsort(ids)
        ids = ids[order]
        x = _unit(_matrix(table["v"].combine_chunks().take(pa.array(order))))
        roots = Roots(len(ids))
        for own in Tree(x, LEAF, cell + 1).rows:
            join_leaf(x, own, least, roots)
        top = np.array([roots.top(i) for i in range(len(ids))])
        some = top != np.arange(len(ids))
        return pa.table({"id": ids[some], "head": ids[top[some]]})

    edges = written(dealt.groupBy("label", "d", "cell").applyInArrow(compare, "id long, head long"), "links")
    part = components(edges, "id", "head")
    dropped(edges)
    counts = written(_counted(groups.join(part.hint("merge"), "id"), least), "counts")
    heads = groups.select("label", "v", "id", "copies").join(counts.hint("merge"), "id", "left")
    heads = heads.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    own = usable.select("id", "label", "v").join(heads.hint("merge"), ["label", "v"]).select("id", "n", "c")
    out = rows.select("id").join(own.hint("merge"), "id", "left")
    return out.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "id").alias("component_id"), F.coalesce(F.coalesce("c", "id") == F.col("id"), F.lit(False)).alias("kept"))


def _counted(members: DataFrame, least: float) -> DataFrame:
    """(id, component, links) of the members (id, component, v, copies) of components: links by all pairs, in blocks."""
    sizes = members.groupBy("component").agg((F.ceil(F.count("*") / BLOCK) - 1).cast("int").alias("last"))
    cut = members.join(sizes.hint("merge"), "component")  # a join splits where one component has many rows
    cut = cut.select("component", "id", "v", "copies", "last", F.pmod(F.xxhash64("id"), F.col("last") + 1).cast("int").alias("own"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    dealt = dealt.select("component", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "id", "copies", "v")

    def run(batches):
        held, now = [], None

        def product():
            own, ids, copies = (np.concatenate([h[i] for h in held]) for i in range(3))
            x = np.concatenate([h[3] for h in held])
            left, right = np.flatnonzero(own == now[1]), np.flatnonzero(own == now[2])
            near = x[left] @ x[right].T >= least
            if now[1] == now[2]:
                np.fill_diagonal(near, False)
                return ids[left], near @ copies[right], now[0]
            return np.concatenate((ids[left], ids[right])), np.concatenate((near @ copies[right], copies[left] @ near)), now[0]

        def done(out):
            i, n, c = ([o[k] for o in out] for k in range(3))
            part = np.repeat(np.array(c, np.int64), [len(a) for a in i])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(i)), pa.array(part), pa.array(np.concatenate(n))], ["id", "component", "links"])

        out = []
        for b in batches:
            key = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("component", "bi", "bj")], 1)
            cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
            for a, z in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
                if now is not None and (key[a] != now).any():
                    out.append(product())
                    held = []
                now, some = key[a], b.slice(a, z - a)
                held.append((*(some.column(c).to_numpy() for c in ("own", "id", "copies")), _unit(_matrix(some.column("v")))))
            if len(out) > 1000:
                yield done(out)
                out = []
        if held:
            out.append(product())
        if out:
            yield done(out)

    keys = ["component", "bi", "bj"]
    counted = dealt.repartition(*keys).sortWithinPartitions(*keys, "own", "id").mapInArrow(run, "id long, component long, links long")
    return counted.groupBy("id", "component").agg(F.sum("links").alias("links"))
