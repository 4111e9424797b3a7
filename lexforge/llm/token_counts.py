"""Token counts by rank-synchronous array merging.

Distinct pre-tokens of a batch lie as one ragged numpy array of symbols. In every round each sequence takes the
lowest-ranked pair that it holds and merges all its places at once, left to right; a sequence without a ranked pair
is done, and its surviving symbols are counted. Texts then add up the counts of their units.

A sequence needs as many rounds as it merges different pairs, so a long one (text without white space) is cut into
windows that merge side by side. A row of symbols is what merging a text gives if, and only if, every two neighbours are
what merging their own text gives; so the cuts are right where the two symbols beside them stay two, and windows
around other cuts are joined and merged again. Time is then linear in a text's length.

Results: one row per input row, whatever its id (null, repeated); a null text counts as empty (0 bytes, 0 tokens);
other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexforge.llm.units import _ENDS, byte_letters, byte_units


LONG, WINDOW = 1024, 48


class RankMerger:
    """Counts of byte-level pre-tokens under the merges of a tokenizers .json file."""

    def __init__(self, path: str, pattern: str, most: int = 250_000):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.symbols = np.array([vocab[c] for c in letters], np.int64)
        self.width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.order], made
        # a bitmap of hashed pairs lets most absent pairs skip the search
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.keys)] = True
        self.split = regex.compile(pattern).findall
        self.most, self.now, self.old = most, {"": 0}, {}
        byte = {c: i for i, c in enumerate(letters)}
        self.bytes = {n: bytes(byte[c] for c in t) for t, n in vocab.items() if all(c in byte for c in t)}

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        rank = np.full(len(key), len(self.keys), np.int64)
        if len(at := np.flatnonzero(self.maybe[self._slot(key)])):
            found = np.minimum(np.searchsorted(self.keys, key[at]), len(self.keys) - 1)
            hit = self.keys[found] == key[at]
            rank[at[hit]] = self.order[found[hit]]
        return rank

    def survivors(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token."""
        out = self._merged([t if len(t) <= LONG else b"" for t in tokens])
        for i, t in enumerate(tokens):
            if len(t) > LONG:
                out[i] = self._long(t)
        return out

    def _symbols(self, tokens: list[bytes]) -> list[np.ndarray]:
        """The symbols left of each pre-token, some of them at a time."""
        out, at = [], 0
        while at < len(tokens):
            end, size = at, 0
            while end < len(tokens) and (end == at or size < 1_000_000):
                size += len(tokens[end])
                end += 1
            held: list[tuple] = []
            counts = self._merged(tokens[at:end], held)
            seq = np.concatenate([s for s, _ in held])
            sym = np.concatenate([x for _, x in held])[np.argsort(seq, kind="stable")]
            out += np.split(sym, np.cumsum(counts)[:-1])
            at = end
        return out

    def _long(self, token: bytes) -> int:
        """Symbols left of a long pre-token, merged in windows whose cuts are proved or joined."""
        parts = [token[i : i + WINDOW] for i in range(0, len(token), WINDOW)]
        done = self._symbols(parts)
        loose, proved = np.arange(len(parts) - 1), {}
        while len(loose):
            beside = [(int(done[i][-1]), int(done[i + 1][0])) for i in loose]
            new = [p for p in dict.fromkeys(beside) if p not in proved]
            for p, got in zip(new, self._symbols([self.bytes[a] + self.bytes[b] for a, b in new]), strict=True):
                proved[p] = got.tolist() == [*p]
            cut = np.ones(len(parts) + 1, bool)
            cut[1:-1][loose[[not proved[p] for p in beside]]] = False
            if cut.all():
                break
            first = np.flatnonzero(cut)
            again = [k for k in range(len(first) - 1) if first[k + 1] - first[k] > 1]
            whole = {k: b"".join(parts[first[k] : first[k + 1]]) for k in again}
            made = dict(zip(again, self._symbols(list(whole.values())), strict=True))
            parts = [whole.get(k, parts[first[k]]) for k in range(len(first) - 1)]
            done = [made[k] if k in made else done[first[k]] for k in range(len(first) - 1)]
            loose = np.array(sorted({i for k in again for i in (k - 1, k) if 0 <= i < len(parts) - 1}), np.int64)
        return sum(map(len, done))

    def _merged(self, tokens: list[bytes], held: list[tuple] | None = None) -> np.ndarray:
        """Symbols left of each pre-token; held takes (pre-token, symbol) arrays of what is done."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        out, none = sizes.copy(), len(self.keys)
        if not len(sizes) or not sizes.sum():
            return out
        sym = self.symbols[np.frombuffer(b"".join(tokens), np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), sizes)
        while len(sym):
            rank = self._ranks(sym[:-1], sym[1:])
            rank[seq[:-1] != seq[1:]] = none
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            least = np.minimum.reduceat(rank, starts)
            runs = np.diff(np.append(starts, len(sym)))
            live = least < none
            out[seq[starts]] = runs
            keep = np.repeat(live, runs)
            if held is not None:
                held.append((seq[~keep], sym[~keep]))
            if not live.any():
                break
            best = np.repeat(least, runs)[keep]
            sym, seq, rank = sym[keep], seq[keep], rank[keep]
            pick = rank == best
            # the same pair at neighbouring places ("aaa"): take every other one of a run, from its left
            if (pick[1:] & pick[:-1]).any():
                at = np.arange(len(pick))
                first = np.maximum.accumulate(np.where(pick, -1, at))
                pick &= (at - first) % 2 == 1
            sym = np.where(pick, self.made[np.minimum(rank, none - 1)], sym)
            gone = np.append(False, pick[:-1])
            sym, seq = sym[~gone], seq[~gone]
        return out

    def _learn(self, units: list[str]) -> None:
        if not units:
            return
        now, pieces, owner = self.now, [], []
        special = 0
        for i, u in enumerate(units):
            base = 0
            if (body := u.rstrip(_ENDS)) and (body[1:] if body[0] == " " else body).isalpha():
                pieces.append(body)
                owner.append(i)
                if len(body) < len(u):
                    pieces.append(u[len(body):])
                    owner.append(i)
            else:
                parts = [u]
                for s in self.special:
                    cut = [p.split(s) for p in parts]
                    base += sum(len(x) - 1 for x in cut)
                    parts = [y for x in cut for y in x]
                got = [t for p in parts for t in self.split(p)]
                pieces += got
                owner += [i] * len(got)
            now[u] = base
            special += base
        distinct = {p: k for k, p in enumerate(dict.fromkeys(pieces))}
        counts = self.survivors([p.encode() for p in distinct])
        each = counts[[distinct[p] for p in pieces]] if pieces else np.zeros(0, np.int64)
        total = np.bincount(np.array(owner, np.int64), weights=each, minlength=len(units)).astype(np.int64)
        if special:
            total += np.array([now[u] for u in units], np.int64)
        now.update(zip(units, total.tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        out, at = [], 0
        while at < len(texts):
            parts, size, missing = [], 0, set()
            if len(self.now) > self.most:
                self.old, self.now = self.now, {"": 0}
            while at < len(texts) and size < 4_000_000:
                units = byte_units(texts[at])
                size += len(texts[at])
                parts.append(units)
                missing.update(set(units).difference(self.now))
                at += 1
            old, now = self.old, self.now
            new = []
            for u in missing:
                if (n := old.get(u)) is None:
                    new.append(u)
                else:
                    now[u] = n
            for k in range(0, len(new), 100_000):
                self._learn(new[k : k + 100_000])
            out += [sum(map(now.__getitem__, units)) for units in parts]
        return out


_mergers: dict[str, RankMerger] = {}


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row; path: vocabulary (.json), pattern: how it splits text."""

    def run(batches):
        if path not in _mergers:
            _mergers[path] = RankMerger(path, pattern)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = np.array(_mergers[path].count(texts), np.int64)
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
