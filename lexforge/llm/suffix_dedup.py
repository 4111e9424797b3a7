"""Removal of repeated byte strings by prefix-free parsing.

Triggers of a rolling hash cut each text into phrases: a place is a trigger if its hash is the least in a string of
the wanted length that holds it. Every phrase reaches on over the length of such a string past its last start, so
each string of the length lies whole in exactly one phrase, and equal strings lie in phrases with equal triggers,
wherever they are: no phrase's set of strings is a part of another's by chance of cutting (the parse is prefix-free).

The parse is the table of phrases with their places; the dictionary holds each distinct phrase once, at its first
place. A phrase that the parse repeats repeats all its strings, so it is removed as one (phrases are the same if their
triggers, lengths and 56-bit digests are). Only phrases that differ but share a trigger can share some strings: for
them, suffix arrays of the dictionary are made, trigger by trigger: all suffixes in the order of their letters, cut at
the wanted length. Suffixes that stand beside each other are compared byte by byte, and the places of their phrases
give the corpus order: all but the first of equal ones are removed.

Phrases that one batch of documents repeats are settled within it, so a passage that a third of all documents
hold is shuffled once a batch. A trigger with more than HOT phrases is dealt to LANES tasks by the place of the trigger
in the string, which equal strings have in common.

Results: one row per document id; rows that share an id count as the greatest text. A null text counts as empty; a
null id sorts first. Ids may be of any type that sorts. A very long text is parsed whole, in one task, with memory of
about 60 bytes a byte. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import one_row_per_id, written
from lexforge.llm.shingles import mixed, range_hashes

GRAM, HOT, LANES, CHUNK, KNOWN = 36, 4096, 16, 300_000, 255


def _phrases(texts: list[bytes], length: int):
    """(text, first start, number of starts, trigger, digest) of the phrases of some texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    if len(data) < length:
        return None
    places = np.arange(len(data) - GRAM + 1)
    own = least = range_hashes(data, places, places + GRAM)
    size, wide = 1, length - GRAM + 1
    while size * 2 <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if wide > size:
        least = np.minimum(least[: -(wide - size)], least[wide - size :])
    # starts whose string ends within their text
    starts = np.concatenate([np.arange(a, max(a, z - length + 1)) for a, z in zip(bounds[:-1], bounds[1:], strict=True)])
    if not len(starts):
        return None
    value = least[starts]
    # a phrase ends behind its trigger, also where an equal hash follows, as in a text with a period
    new = np.concatenate(([True], (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1) | (own[starts[:-1]] == value[:-1])))
    text = np.searchsorted(bounds, starts, "right") - 1
    new[1:] |= text[1:] != text[:-1]
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    digest = range_hashes(data, begin, begin + runs + length - 1)
    owner = text[first]
    return owner, begin - bounds[owner], runs, value[first], digest


def _some(batch, most: int = 1_000_000):
    """Rows of a batch with their texts in bytes, some at a time: (offset, texts)."""
    at, size, some = 0, 0, []
    for i in range(batch.num_rows):
        some.append((batch.column("text")[i].as_py() or "").encode())
        size += len(some[-1])
        if size > most:
            yield at, some
            at, size, some = i + 1, 0, []
    if some:
        yield at, some


def remove_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of each document; see repeats() for the spans."""
    return _cut(docs, length, key, text, False)


def kept_texts(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kept): the bytes that stay of each document."""
    return _cut(docs, length, key, text, True)


def _settled(trigger: np.ndarray, digest: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a phrase, in the order of places, repeats one before it."""
    seen = np.zeros(len(n), bool)
    by = np.argsort(mixed(trigger ^ mixed(digest + n.astype(np.uint64))), kind="stable")
    same = (trigger[by][1:] == trigger[by][:-1]) & (digest[by][1:] == digest[by][:-1]) & (n[by][1:] == n[by][:-1])
    seen[by[1:][same]] = True
    return seen


def repeated_suffixes(bucket: np.ndarray, data: np.ndarray, at: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at places at of data, cut at length, stand in their bucket with an earlier one (by place).

    The suffix array of each bucket is made by letters, of those suffixes alone whose hash another one has too.
    """
    out = np.zeros(len(at), bool)
    if not len(at):
        return out
    low, high = int(at.min()), int(at.max()) + length
    h = range_hashes(data[low:high], at - low, at - low + length)
    by = np.lexsort((h, bucket))
    same = (h[by][1:] == h[by][:-1]) & (bucket[by][1:] == bucket[by][:-1])
    some = by[np.append(same, False) | np.append(False, same)]
    if not len(some):
        return out
    rows = np.empty((len(some), 8 + length), np.uint8)
    rows[:, :8] = bucket[some].astype(">u8")[:, None].view(np.uint8).reshape(len(some), 8)
    rows[:, 8:] = np.lib.stride_tricks.sliding_window_view(data, length)[at[some]]
    letters = rows.view(f"V{8 + length}").ravel()
    array = np.argsort(letters, kind="stable")
    new = np.append(True, letters[array][1:] != letters[array][:-1])
    group = np.cumsum(new) - 1
    first = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, group, place[some[array]])
    out[some[array]] = place[some[array]] != first[group]
    return out


def _repeats(rows: DataFrame, length: int) -> DataFrame:
    """(id, start, end): byte ranges of rows (id, text) that occur earlier, in pieces that may overlap."""
    if not GRAM <= length < GRAM + 254:
        raise ValueError(f"repeats of {GRAM} to {GRAM + 253} bytes can be found")
    kind = rows.schema["id"].dataType.simpleString()

    def parse(batches):
        for b in batches:
            parts = []
            for at, texts in _some(b):
                if (got := _phrases(texts, length)) is not None:
                    parts.append((got[0] + at, *got[1:]))
            if not parts:
                continue
            owner, start, n, trigger, digest = (np.concatenate(c) for c in zip(*parts, strict=True))
            ids = b.column("id")
            rank = np.empty(b.num_rows, np.int64)
            rank[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(b.num_rows)
            if (rank[1:] < rank[:-1]).any():  # phrases in the order of their places
                by = np.lexsort((start, rank[owner]))
                owner, start, n, trigger, digest = (c[by] for c in (owner, start, n, trigger, digest))
            known = _settled(trigger, digest, n)
            mark = (digest & np.uint64(0xFFFFFFFFFFFFFF00)).astype(np.int64) | n
            # what is settled here is done: phrases that follow each other are one range, at a trigger of its own
            at = np.flatnonzero(known)
            new = np.append(True, (np.diff(at) > 1) | (np.diff(owner[at]) != 0) | (start[at][1:] != (start + n)[at][:-1])) if len(at) else np.zeros(0, bool)
            first = at[new]
            size = np.add.reduceat(n[at], np.flatnonzero(new)) if len(at) else np.zeros(0, np.int64)
            alone = mixed((rank[owner[first]].astype(np.uint64) << np.uint64(32)) ^ start[first].astype(np.uint64) ^ trigger[first])
            open_ = ~known
            columns = [np.concatenate(c) for c in ((trigger[open_], alone), (mark[open_], size << 8 | KNOWN), (owner[open_], owner[first]), (start[open_], start[first]))]
            for low in range(0, len(columns[0]), 100_000):
                t, m, o, x = (c[low : low + 100_000] for c in columns)
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(m), ids.take(pa.array(o)), pa.array(x)], ["trigger", "mark", "id", "start"])

    phrases = rows.mapInArrow(parse, f"trigger long, mark long, id {kind}, start long")
    by = Window.partitionBy("trigger").orderBy("mark", F.col("id").asc_nulls_first(), "start")
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    settled = F.col("mark").bitwiseAND(0xFF) == KNOWN
    own = F.when(~settled, F.col("mark"))
    seen = phrases.withColumns({"again": settled | F.coalesce(F.lag(own).over(by) == own, F.lit(False)), "mixed": F.min(own).over(whole) != F.max(own).over(whole), "many": F.count("*").over(whole)})
    size = F.when(settled, F.shiftright("mark", 8)).otherwise(F.col("mark").bitwiseAND(0xFF))
    seen = seen.filter("again or mixed").select("id", "start", size.alias("n"), "again", "trigger", "many")
    seen = written(seen, "phrases")

    # phrases that differ from others with their trigger, with their bytes
    some = seen.filter("not again").groupBy("id").agg(F.collect_list(F.struct("start", "n", "trigger", "many")).alias("at"))
    open_texts = rows.join(some, rows.id.eqNullSafe(some.id)).select(rows.id, "text", "at")

    def fetch(batches):
        for b in batches:
            held, raw = [], []

            def out(b=b, held=held, raw=raw):
                trigger, lane, own, start, n = (np.concatenate(c) for c in zip(*held, strict=True))
                got = pa.RecordBatch.from_arrays([pa.array(trigger), pa.array(lane), b.column("id").take(pa.array(own)), pa.array(start), pa.array(n.astype(np.int32)), pa.array(raw, pa.binary())], ["trigger", "lane", "id", "start", "n", "bytes"])
                held.clear()
                raw.clear()
                return got

            for i in range(b.num_rows):
                data, at = (b.column("text")[i].as_py() or "").encode(), b.column("at")[i].values
                trigger, start, n, many = (at.field(c).to_numpy() for c in ("trigger", "start", "n", "many"))
                times = np.where(many > HOT, LANES, 1)
                lane = np.where(np.repeat(many > HOT, times), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times), -1).astype(np.int32)
                trigger, start, n = (np.repeat(c, times) for c in (trigger, start, n))
                held.append((trigger, lane, np.full(len(n), i), start, n))
                raw += [data[x:z] for x, z in zip(start.tolist(), (start + n + length - 1).tolist(), strict=True)]
                if len(raw) > 20_000:
                    yield out()
            if raw:
                yield out()

    dictionary = open_texts.mapInArrow(fetch, f"trigger long, lane int, id {kind}, start long, n int, bytes binary")

    def sort(batches):
        held, size, last = [], 0, None

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            n, lane = t["n"].to_numpy().astype(np.int64), t["lane"].to_numpy()
            key = np.stack([t["trigger"].to_numpy(), lane.astype(np.int64)], 1)
            bucket = np.cumsum(np.append(True, (key[1:] != key[:-1]).any(1)))
            blob = t["bytes"].combine_chunks()
            offset = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64)
            data = np.frombuffer(blob.buffers()[2], np.uint8) if len(blob) else np.zeros(0, np.uint8)
            begin = offset[:-1]
            row = np.repeat(np.arange(len(n)), n)
            j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            if (lane >= 0).any():  # of a hot trigger, the strings of this lane alone
                place = np.zeros(len(n), np.int64)
                for r in np.flatnonzero(lane >= 0):
                    grams = np.arange(begin[r], begin[r] + n[r] + length - GRAM)
                    place[r] = np.argmax(range_hashes(data[grams[0] : grams[-1] + GRAM], grams - grams[0], grams - grams[0] + GRAM) == key[r, 0].view(np.uint64))
                keep = (lane[row] < 0) | ((place[row] - j) % LANES == lane[row])
                row, j = row[keep], j[keep]
            ids = t["id"].combine_chunks()
            order = np.empty(len(n), np.int64)
            order[pc.sort_indices(pa.table({"i": ids, "s": t["start"]}), sort_keys=[("i", "ascending"), ("s", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(n))
            # of places within one document the phrase's comes first, as phrases do not overlap in starts
            gone = repeated_suffixes(bucket[row], data, begin[row] + j, order[row] * (1 << 32) + j, length)
            row, j = row[gone], j[gone]
            new = np.append(True, (row[1:] != row[:-1]) | (j[1:] > j[:-1] + length))
            cuts = np.flatnonzero(new)
            if not len(row):
                return None
            ends = np.append(cuts[1:], len(row)) - 1
            start = t["start"].to_numpy()[row[cuts]]
            return pa.RecordBatch.from_arrays([ids.take(pa.array(row[cuts])), pa.array(start + j[cuts]), pa.array(start + j[ends] + length)], ["id", "start", "end"])

        for b in batches:
            key = np.stack([b.column("trigger").to_numpy(), b.column("lane").to_numpy().astype(np.int64)], 1)
            cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
            for a, z in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
                if size > CHUNK and (key[a] != last).any():
                    if (out := flush()) is not None:
                        yield out
                    held, size = [], 0
                part = b.slice(a, z - a)
                held.append(part)
                size += int(part.column("n").to_numpy().sum())
                last = key[a]
        if held and (out := flush()) is not None:
            yield out

    later = dictionary.repartition("trigger", "lane").sortWithinPartitions("trigger", "lane").mapInArrow(sort, f"id {kind}, start long, end long")
    return seen.filter("again").select("id", "start", (F.col("start") + F.col("n") + length - 1).alias("end")).unionByName(later)


def repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): maximal byte ranges of each document that occur earlier."""
    rows = one_row_per_id(docs, key, text).toDF("id", "text")
    by = Window.partitionBy("id").orderBy("start", "end")
    ahead = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    cut = _repeats(rows, length).withColumn("new", F.coalesce((F.col("start") > ahead).cast("int"), F.lit(1)))
    runs = cut.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0))).groupBy("id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy(F.col("id").alias(key)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _cut(docs: DataFrame, length: int, key: str, text: str, whole: bool) -> DataFrame:
    rows = one_row_per_id(docs, key, text).toDF("id", "text")
    ranges = _repeats(rows, length).groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("r"))
    met = rows.join(ranges, rows.id.eqNullSafe(ranges.id), "left").select(rows.id, "text", "r")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                data = (b.column("text")[i].as_py() or "").encode()
                kept, spans = data, 0
                if b.column("r")[i].is_valid:
                    r = b.column("r")[i].values
                    step = np.zeros(len(data) + 1, np.int64)
                    np.add.at(step, r.field("start").to_numpy(), 1)
                    np.add.at(step, r.field("end").to_numpy(), -1)
                    gone = np.cumsum(step[:-1]) > 0
                    spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((len(data), len(data) - len(kept), spans, kept if whole else hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary() if whole else pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], [key, "n_bytes", "n_removed", "n_spans", "kept" if whole else "kept_sha256"])

    return met.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, {'kept binary' if whole else 'kept_sha256 string'}")
