"""Token ids in binary files under a static range asymmetric numeral system.

Documents are dealt out by ranges of their ids and sorted, so the files in order hold all ids in ascending order of
documents. A file is a run of segments of whole documents. A segment has one frequency table that its blocks share;
a block is a fixed number of tokens in interleaved lanes with a word stream of its own, so any block decodes
without its neighbours. Checkpoints say where each block's words begin, and each block and table has a CRC-32.
All lanes of all blocks of a segment are coded together, one numpy step for each token position.

Segment layout, little-endian: magic "RNS1", u32 counts (tokens, documents, blocks, table bytes, words), u32 CRC of
the table, then the table (zlib: symbols and frequencies), documents' token counts (u32), block checkpoints
(u32 first word, u32 CRC), the lanes' final states (u64), words (u32).

Results: rows that share an id count as one document, the greatest text; a null text counts as empty (the end id
alone); a null id sorts first; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import one_row_per_id, table_path
from lexforge.llm.units import arrow_coder

BITS, LANES, STEPS = 20, 32, 512
_LOW, _MAGIC = 1 << 31, b"RNS1"


def _frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2**BITS, each at least 1."""
    total = 1 << BITS
    freq = np.maximum(1, counts * total // counts.sum())
    over = int(freq.sum()) - total
    while over > 0:  # taken from the largest, never below 1
        cut = np.minimum(freq - 1, np.maximum(1, freq * over // int(freq.sum())))
        by_size = np.argsort(-freq, kind="stable")
        taken = np.minimum(np.cumsum(cut[by_size]), over)
        freq[by_size] -= np.diff(taken, prepend=0)
        over = int(freq.sum()) - total
    freq[np.argmax(freq)] -= over
    return freq


def encode_segment(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """One segment: all ids of its documents and each document's count."""
    counts = np.bincount(ids)  # as long as the vocabulary
    symbols = np.flatnonzero(counts)
    freq = _frequencies(counts[symbols])
    start = np.cumsum(freq) - freq
    per = LANES * STEPS
    blocks = -(-len(ids) // per)
    grid = np.full(blocks * per, symbols[0] if len(symbols) else 0, ids.dtype)  # the last block is filled up with the first symbol
    grid[: len(ids)] = ids
    grid = grid.reshape(blocks, STEPS, LANES)
    of_id = np.zeros((2, max(len(counts), 1)), np.uint32)  # frequency and start by id
    of_id[0, symbols], of_id[1, symbols] = freq, start
    state = np.full((blocks, LANES), _LOW, np.uint64)
    mask = np.zeros((blocks, STEPS, LANES), bool)
    word = np.zeros((blocks, STEPS, LANES), "<u4")
    for t in range(STEPS - 1, -1, -1):
        f, s = of_id[:, grid[:, t]].astype(np.uint64)
        out = state >= (f << np.uint64(63 - BITS))
        mask[:, t], word[:, t] = out, state.astype(np.uint32)
        state >>= out.astype(np.uint64) << np.uint64(5)
        q = state // f
        state += q * (np.uint64(1 << BITS) - f) + s
    words = word[mask]
    lens = mask.reshape(blocks, -1).sum(1)
    first = np.cumsum(lens) - lens
    crcs = [zlib.crc32(words[a : a + n].tobytes(), zlib.crc32(state[b].astype("<u8").tobytes())) for b, (a, n) in enumerate(zip(first, lens, strict=True))]
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    head = struct.pack("<4s6I", _MAGIC, len(ids), len(sizes), blocks, len(table), len(words), zlib.crc32(table))
    points = np.stack([first, np.array(crcs, np.int64)], 1).astype("<u4").tobytes()
    return b"".join([head, table, sizes.astype("<u4").tobytes(), points, state.astype("<u8").tobytes(), words.tobytes()])


def decode_segment(data: bytes, blocks: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """(ids, documents' counts); with a slice of blocks, only their ids. Raises ValueError on a wrong checksum."""
    magic, n, docs, total, size, n_words, crc = struct.unpack_from("<4s6I", data)
    at = struct.calcsize("<4s6I")
    table = data[at : at + size]
    if magic != _MAGIC or zlib.crc32(table) != crc:
        raise ValueError("segment head or table is damaged")
    at += size
    raw = np.frombuffer(zlib.decompress(table), "<u4")
    symbols, freq = np.cumsum(raw[: len(raw) // 2]).astype(np.uint32), raw[len(raw) // 2 :].astype(np.int64)
    sizes = np.frombuffer(data, "<u4", docs, at)
    at += docs * 4
    points = np.frombuffer(data, "<u4", total * 2, at).reshape(total, 2).astype(np.int64)
    at += total * 8
    states = np.frombuffer(data, "<u8", total * LANES, at).reshape(total, LANES)
    words = np.frombuffer(data, "<u4", n_words, at + total * LANES * 8)
    chosen = np.arange(total)[blocks]
    ends = np.append(points[1:, 0], n_words)
    for b in chosen:
        if zlib.crc32(words[points[b, 0] : ends[b]].tobytes(), zlib.crc32(states[b].tobytes())) != points[b, 1]:
            raise ValueError(f"block {b} is damaged")
    slots = np.repeat(np.arange(len(freq)), freq)
    start64, freq64 = (np.cumsum(freq) - freq).astype(np.uint64), freq.astype(np.uint64)
    state, ptr = states[chosen].copy(), points[chosen, 0].copy()
    padded = np.append(words, np.zeros(LANES + 1, np.uint32))
    out = np.zeros((len(chosen), STEPS, LANES), np.int64)
    low = np.uint64((1 << BITS) - 1)
    for t in range(STEPS):
        slot = state & low
        s = slots[slot.astype(np.int64)]
        out[:, t] = s
        state = freq64[s] * (state >> np.uint64(BITS)) + slot - start64[s]
        need = state < np.uint64(_LOW)
        ahead = np.cumsum(need, 1)
        got = padded[np.minimum(ptr[:, None] + ahead - 1, n_words)]
        state = np.where(need, (state << np.uint64(32)) | got, state)
        ptr += ahead[:, -1]
    ids = symbols[out.reshape(-1)] if len(symbols) else np.zeros(0, np.uint32)
    return (ids[:n] if blocks == slice(None) else ids), sizes


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 2, segment: int = 1 << 21, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files of all documents to folder and return the table of their segments.

    path: byte-level vocabulary (.json); segment: tokens after which a segment ends with its document. Spark writes
    the segments (part, segment, keys, payload), so the folder may be in any store that Spark writes to.
    """
    spark = docs.sparkSession
    rows = one_row_per_id(docs, key, text)
    parts = max(rows.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        part, known = TaskContext.get().partitionId(), arrow_coder(path)
        keys, held, sizes, size, number = [], [], [], 0, 0

        def out():
            data = encode_segment(np.concatenate(held), np.concatenate(sizes))
            ids = pa.concat_arrays(keys)
            listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([number]), pa.array([size]), listed, pa.array([data], pa.binary())], ["part", "segment", "tokens", "keys", "payload"])

        for b in batches:
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                ids, counts = known.encode(some.column(1))
                ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
                ends, first, begin = np.cumsum(counts), 0, 0
                while first < len(ends):  # up to the document that fills the segment
                    last = min(int(np.searchsorted(ends, begin + segment - size)) + 1, len(ends))
                    end = int(ends[last - 1])
                    keys.append(some.column(0).slice(first, last - first))
                    held.append(ids[begin:end])
                    sizes.append(counts[first:last])
                    size, first, begin = size + end - begin, last, end
                    if size >= segment:
                        yield out()
                        keys, held, sizes, size, number = [], [], [], 0, number + 1
        if held:
            yield out()

    dealt = rows.repartitionByRange(parts, F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    dealt.mapInArrow(run, f"part long, segment long, tokens long, keys array<{kind}>, payload binary").write.option("compression", "none").parquet(folder)
    return spark.read.parquet(folder)


def read_token_files(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, decoded from the files."""
    # where each part and segment begins: totals by part first, so one task orders a row per part only
    by_part = files.groupBy("part").agg(F.sum("tokens").alias("n"))
    ahead = by_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment")
    begins = files.select("part", "segment", (F.sum("tokens").over(inside) - F.col("tokens")).alias("within"))
    begins = begins.join(ahead, "part").select("part", "segment", (F.col("before") + F.col("within")).alias("first"))
    kind = files.schema["keys"].dataType.elementType.simpleString()

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, sizes = decode_segment(b.column("payload")[i].as_py())
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes.astype(np.int64))
                starts = ends - sizes
                crcs = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
                keys = b.column("keys").slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([keys, pa.array([b.column("part")[i].as_py()] * len(keys), pa.int64()), pa.array([b.column("segment")[i].as_py()] * len(keys), pa.int64()), pa.array(starts), pa.array(sizes.astype(np.int64)), pa.array(crcs, pa.int64())], [key, "part", "segment", "at", "n_tokens", "ids_crc32"])

    got = files.select("part", "segment", "keys", "payload").mapInArrow(run, f"`{key}` {kind}, part long, segment long, at long, n_tokens long, ids_crc32 long")
    return got.join(begins, ["part", "segment"]).select(key, (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str, end_id: int = 2, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files (to the shared folder unless told) and read them back."""
    return read_token_files(write_token_files(docs, path, folder or table_path(docs.sparkSession, "tokens"), end_id, key=key, text=text), key)
