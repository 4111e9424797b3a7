"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m characters that occurs in a text with at most e edits shares m + 1 - q (e + 1) q-grams with it
on diagonals no more than e apart. Shared q-grams are counted in overlapping bands of diagonals; a region that meets
the bound is verified by a bit-parallel alignment of the item within its band.

Both sides are compared as UTF-8 bytes, A-Z lower-cased and white space as plain spaces, place by place. The budget
is a tenth of an item's length, less for short items so that the bound stays positive; items under q bytes must
occur as they are. Items are taken in blocks of at most about BLOCK_BYTES, which bounds what is broadcast; every
block passes over all texts.

Results: one row per document row and item found in it, at its best place. Null or empty texts and items match
nothing; null ids are kept as they are; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q, RATE, BLOCK_BYTES, _SLOTS = 8, 0.1, 4_000_000, 22
_FOLD = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def folded(text: str | None) -> bytes:
    return (text or "").encode().translate(_FOLD)


def best_match(item: bytes, text: bytes) -> tuple[int, int]:
    """(edits, end) of the best place of item in text, the first such end."""
    m, eq = len(item), {}
    for i, c in enumerate(item):
        eq[c] = eq.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, edits = full, 0, m
    best = (m, 0)
    for j, c in enumerate(text, 1):
        e = eq.get(c, 0)
        xv, xh = e | down, (((e & up) + up) ^ up) | e
        ph, mh = down | (full & ~(xh | up)), up & xh
        edits += 1 if ph & high else -1 if mh & high else 0
        if edits < best[0]:
            best = (edits, j)
        ph, mh = ph << 1 & full, mh << 1 & full
        up, down = mh | (full & ~(xv | ph)), ph & xv
    return best


def _grams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(a[:8].view("<u8"), (len(a) - Q + 1,), (1,)) if len(a) >= Q else np.zeros(0, "<u8")


def _slot(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)


class Items:
    """The q-gram index of a block of benchmark items: (item id, text)."""

    def __init__(self, items: list[tuple]):
        items = [(i, folded(t)) for i, t in items]
        self.short = [(i, t) for i, t in items if 0 < len(t) < Q]
        items = [(i, t) for i, t in items if len(t) >= Q]
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.minimum((m * RATE).astype(np.int64), (m - Q) // Q)
        self.bound = m + 1 - Q * (self.budget + 1)
        self.band = max(32, 1 << int(self.budget.max(initial=1)).bit_length())
        code = np.concatenate([_grams(t) for t in self.texts] or [np.zeros(0, "<u8")])
        item = np.repeat(np.arange(len(m)), np.maximum(0, m - Q + 1))
        place = np.concatenate([np.arange(len(t) - Q + 1) for t in self.texts] or [np.zeros(0, np.int64)])
        order = np.argsort(code, kind="stable")
        self.codes, self.first = np.unique(code[order], return_index=True)
        self.ends = np.append(self.first, len(code))[1:]
        self.item, self.place = item[order], place[order]
        self.maybe = np.zeros(1 << _SLOTS, bool)
        self.maybe[_slot(self.codes)] = True

    def regions(self, texts: list[bytes]):
        """(text, item, band) that meet the bound, each text's diagonals counted from its own start."""
        if not len(self.codes):
            return
        data = (b"\0" * Q).join([*texts, b""])
        starts = np.cumsum([0] + [len(t) + Q for t in texts])
        codes = _grams(data)
        at = np.flatnonzero(self.maybe[_slot(codes)])
        found = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        hit = self.codes[found] == codes[at]
        at, found = at[hit], found[hit]
        text = np.searchsorted(starts, at, "right") - 1
        # an item can only lie in a text that has as many known q-grams as the least bound
        enough = np.bincount(text, minlength=len(texts)) >= self.bound.min()
        keep = enough[text]
        at, found, text = at[keep], found[keep], text[keep]
        many = self.ends[found] - self.first[found]
        own = np.repeat(np.arange(len(at)), many)
        spot = np.repeat(self.first[found] - np.cumsum(many) + many, many) + np.arange(many.sum())
        item = self.item[spot]
        diagonal = at[own] - starts[text[own]] - self.place[spot]
        band, inside = np.divmod(diagonal, self.band)
        second = inside < self.budget[item]
        text = np.concatenate([text[own], text[own][second]])
        item, band = np.concatenate([item, item[second]]), np.concatenate([band, band[second] - 1])
        if not len(text):
            return
        low = int(band.min())
        span = int(band.max()) - low + 1
        key, n = np.unique((text * len(self.ids) + item) * span + (band - low), return_counts=True)
        both, band = np.divmod(key, span)
        text, item = np.divmod(both, len(self.ids))
        good = n >= self.bound[item]
        yield from zip(text[good].tolist(), item[good].tolist(), (band[good] + low).tolist(), strict=True)

    def matches(self, texts: list[bytes]) -> list[tuple]:
        """(text, item id, first byte, end byte, edits), the best place of each item in each text."""
        best: dict[tuple, tuple] = {}
        for text, item, band in self.regions(texts):
            t, e, m = self.texts[item], int(self.budget[item]), len(self.texts[item])
            first = max(0, band * self.band - e)
            part = texts[text][first : band * self.band + 2 * self.band + m + e]
            edits, end = best_match(t, part)
            if edits <= e and (edits, first + end) < best.get((text, item), (e + 1, 0, 0))[:2]:
                back, size = best_match(t[::-1], part[max(0, end - m - e) : end][::-1])
                best[text, item] = (edits, first + end, first + end - size)
        out = [(text, self.ids[item], a, b, edits) for (text, item), (edits, b, a) in best.items()]
        for i, t in self.short:
            out += [(k, i, at, at + len(t), 0) for k, x in enumerate(texts) if (at := x.find(t)) >= 0]
        return sorted(out, key=lambda r: (r[0], str(r[1])))


def item_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text"):
    """Blocks of (item id, text), each of at most about BLOCK_BYTES."""
    known = benchmark.select(item, text).filter(F.length(text) > 0)
    size = known.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for b in range(blocks):
        yield [tuple(r) for r in known.filter(F.pmod(F.xxhash64(item, text), F.lit(blocks)) == b).collect()]


_indexes: dict[int, Items] = {}


def _index(shared) -> Items:
    if shared.id not in _indexes:
        _indexes.clear()
        _indexes[shared.id] = Items(shared.value)
    return _indexes[shared.id]


class _Shared:
    """A broadcast with a number that tells it from others in a worker."""

    def __init__(self, spark, items):
        self.it, self.id = spark.sparkContext.broadcast(items), hash(repr(items))

    @property
    def value(self):
        return self.it.value


def _groups(column):
    """Texts of a batch, folded, some at a time: (offset, texts)."""
    texts = column.to_pylist()
    at, size, some = 0, 0, []
    for i, t in enumerate(texts):
        some.append(folded(t))
        size += len(some[-1])
        if size > 1_000_000:
            yield at, some
            at, size, some = i + 1, 0, []
    if some:
        yield at, some


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(key, item, start, end, edits) of each document and benchmark item in it; offsets in code points."""
    spark = docs.sparkSession
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, start long, end long, edits long"
    kind = benchmark.select(item).limit(0).toArrow().schema.field(0).type
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, item, text):
        shared = _Shared(spark, block)

        def run(batches, shared=shared):
            items = _index(shared)
            for b in batches:
                rows = []
                ids = b.column(0)
                for at, texts in _groups(b.column(1)):
                    for k, i, a, z, edits in items.matches(texts):
                        raw = texts[k]
                        points = lambda x, raw=raw: sum(1 for c in raw[:x] if c & 0xC0 != 0x80)
                        rows.append((at + k, i, points(a), points(z), edits))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], kind), *(pa.array(c, pa.int64()) for c in cols[2:])], [key, item, "start", "end", "edits"])

        out = out.unionByName(docs.select(key, text).mapInArrow(run, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows whose text holds no benchmark item, all columns as they are; nothing is shuffled."""
    for block in item_blocks(benchmark, item, text):
        shared, at = _Shared(docs.sparkSession, block), docs.columns.index(text)

        def run(batches, shared=shared, at=at):
            items = _index(shared)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for first, texts in _groups(b.column(at)):
                    for k, *_ in items.matches(texts):
                        keep[first + k] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
