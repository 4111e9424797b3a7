"""Packing by bounded-space online best fit.

Each partition keeps a fixed number of open windows. Whole windows of a long document go out at once; its rest goes
to the open window that it leaves fullest, and when none has room the fullest window is emitted. What is open at the
end of a partition is merged: the leftovers of several partitions are laid end to end and cut freely at the window
size, in rounds, until one short window is left of them all.

Results: one row per piece. Rows are packed one by one, so repeated ids give pieces of each row; a null text counts
as empty (one id: the end id); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import dropped, written
from lexforge.llm.units import arrow_coder

_FIELDS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_MERGED = 1 << 62


class Windows:
    """Open windows of one partition: each a list of (key, start, ids, document's ids)."""

    def __init__(self, size: int, most: int, first: int):
        self.size, self.most, self.next = size, most, first
        self.open: list[list] = []
        self.room = np.zeros(0, np.int64)
        self.done: list[tuple] = []

    def emit(self, pieces: list) -> None:
        at = 0
        for key, start, ids, n in pieces:
            self.done.append((key, start, len(ids) // 4, zlib.crc32(ids), n, self.next, at))
            at += len(ids) // 4
        self.next += 1

    def place(self, key, ids: bytes) -> None:
        n, width, start = len(ids) // 4, self.size * 4, 0
        while len(ids) - start >= width:
            self.emit([(key, start // 4, ids[start : start + width], n)])
            start += width
        if start == len(ids):
            return
        piece, need = (key, start // 4, ids[start:], n), n - start // 4
        fits = np.flatnonzero(self.room >= need)
        if len(fits):
            at = fits[np.argmin(self.room[fits])]
            self.open[at].append(piece)
            self.room[at] -= need
            if not self.room[at]:
                self._out(at)
        else:
            if len(self.open) == self.most:
                self._out(int(np.argmin(self.room)))
            self.open.append([piece])
            self.room = np.append(self.room, self.size - need)

    def _out(self, at: int) -> None:
        self.emit(self.open.pop(at))
        self.room = np.delete(self.room, at)


def _batch(rows: list[tuple], kind: pa.DataType, left: list[tuple] = ()) -> pa.RecordBatch:
    """Finished pieces, then leftovers, which carry ids in place of a sequence."""
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
    rest = list(zip(*left, strict=True)) if left else [[]] * 4
    none = [None] * len(left)
    arrays = [pa.array([*cols[0], *rest[0]], kind)]
    arrays += [pa.array([*a, *b], pa.int64()) for a, b in zip(cols[1:], (rest[1], none, none, rest[3], none, none), strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([None] * len(rows) + [*rest[2]], pa.binary())], ["key", *_FIELDS, "ids"])


def pack(docs: DataFrame, path: str, size: int = 4096, windows: int = 64, end_id: int = 2, merge: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece.

    path: vocabulary that drops white space; windows: open windows in a partition; merge: partitions whose
    leftovers are laid together in a round, so no task gets more than merge * windows * size ids.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, {', '.join(f'`{f}` long' for f in _FIELDS)}, ids binary"

    def first(batches):
        part = TaskContext.get().partitionId()
        got, of, known = Windows(size, windows, part << 32), None, arrow_coder(path, False)
        for b in batches:
            of = b.column(0).type
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                ids, counts = known.encode(some.column(1))
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4", copy=False).tobytes()
                ends = (np.cumsum(counts + 1) * 4).tolist()
                for k, begin, stop in zip(some.column(0).to_pylist(), [0, *ends[:-1]], ends, strict=True):
                    got.place(k, ids[begin:stop])
                yield _batch(got.done, of)
                got.done = []
        if of is not None:
            yield _batch(got.done, of, [p for w in got.open for p in w])

    pieces = written(docs.select(F.col(key).alias("key"), text).mapInArrow(first, schema).withColumn("part", F.spark_partition_id()), "packed")
    done = pieces.filter("ids is null").select("key", *_FIELDS)
    left = pieces.filter("ids is not null")
    parts, level = (left.agg(F.max("part")).first()[0] or 0) + 1, 0

    while True:
        level += 1
        groups = -(-parts // merge)
        last = groups == 1

        def lay(batches, level=level, last=last):
            part = TaskContext.get().partitionId()
            got, of, held, full = Windows(size, 1, _MERGED | level << 52 | part << 24), None, [], 0
            for b in batches:
                of = b.column(0).type
                for k, start, ids, n in zip(*(b.column(c).to_pylist() for c in (0, 1, 7, 4)), strict=True):
                    while ids:
                        take = min(len(ids) // 4, size - full)
                        held.append((k, start, ids[: take * 4], n))
                        ids, start, full = ids[take * 4 :], start + take, full + take
                        if full == size:
                            got.emit(held)
                            held, full = [], 0
                yield _batch(got.done, of)
                got.done = []
            if of is not None:
                if last and held:
                    got.emit(held)
                    held = []
                yield _batch(got.done, of, held)

        by = left.withColumn("g", (F.col("part") / merge).cast("int")).drop("part")
        dealt = by.repartitionById(groups, F.col("g")) if groups > 1 else by.coalesce(1)
        rows = dealt.drop("g").mapInArrow(lay, schema).withColumn("part", F.spark_partition_id())
        if last:
            return done.unionByName(rows.select("key", *_FIELDS)).withColumnRenamed("key", key)
        rows = written(rows, "packed")
        done = done.unionByName(rows.filter("ids is null").select("key", *_FIELDS))
        left, parts = rows.filter("ids is not null"), groups
