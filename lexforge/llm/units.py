"""Token ids of whole texts by the tokenizers library, asked once per distinct unit.

A unit is a run of white space with the run of other characters after it. In both vocabularies no token reaches
over the start of such a unit (the splitting patterns never match from a character that is not white space into
white space, and added tokens hold none), so the ids of a text are those of its units, one after another. Units
are looked up in a bounded two-generation cache; what is missing goes to the library. UnitCoder does so text by text;
ArrowCoder cuts and looks up all units of a batch at once, in numpy arrays.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa

_WS = "\t-\r \x85\xa0  -     　"
_ODD = re.compile("[\x00\t\x0b-\r\x1c-\x1f\x85\xa0  -     　]")
_UNIT = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_BODY = re.compile(f"[^{_WS}]+")
_ENDS = ".,;:!?|%$#*&"
_packed = [struct.Struct(f"<{n}I").pack for n in range(65)]


def byte_units(text: str) -> list[str]:
    """Units for a vocabulary in which white space counts; joined they give the text."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _ODD.search(text):
        return _UNIT.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def word_units(text: str) -> list[str]:
    """Units for a vocabulary that drops white space."""
    return _BODY.findall(text) if re.search("[\x1c-\x1f]", text) else text.split()


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else 256 and up in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class UnitCoder:
    """Little-endian unsigned 32-bit ids of texts.

    path: a tokenizers .json file; spaced: white space is part of tokens (byte-level) or dropped (word ends).
    most: units in one generation of the cache, about 250 bytes each.
    """

    def __init__(self, path: str, spaced: bool, most: int = 250_000):
        from tokenizers import Tokenizer

        self.whole, self.spaced, self.most = Tokenizer.from_file(path), spaced, most
        self.model, self.units = self.whole.model, byte_units if spaced else word_units
        self.letters = dict(enumerate(byte_letters()))
        self.now: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _slow(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _stays_one(body: str) -> bool:
        """Whether letters stay letters when normalised: some decompose into a letter and a mark, where words are cut."""
        return not ("Σ" in body or "İ" in body) and unicodedata.normalize("NFC", body).isalpha()

    def _word(self, unit: str) -> bytes:
        """Ids of one unit whose body is letters only: one piece for the model."""
        if not self.spaced:
            unit = unicodedata.normalize("NFC", unit).lower()
        if unit.isascii():
            seen = unit.replace(" ", self.letters[32])
        else:
            seen = unit.encode().decode("latin-1").translate(self.letters)
        return _packed[n](*ids) if (n := len(ids := [t.id for t in self.model.tokenize(seen)])) < 65 else struct.pack(f"<{n}I", *ids)

    def _learn(self, units) -> None:
        now, old, odd = self.now, self.old, []
        for u in units:
            if (ids := old.get(u)) is not None:
                now[u] = ids
                continue
            body = u.rstrip(_ENDS)
            bare = body[1:] if self.spaced and body[:1] == " " else body
            if bare.isalpha() and len(u) < 64 and (self.spaced or bare.isascii() or self._stays_one(bare)):
                if body is not u and body != u:
                    end = u[len(body):]
                    if (tail := now.get(end)) is None:
                        tail = now[end] = self._slow([end])[0]
                    if (head := now.get(body)) is None:
                        head = now[body] = old[body] if body in old else self._word(body)
                    now[u] = head + tail
                else:
                    now[u] = self._word(u)
            else:
                odd.append(u)
        for at in range(0, len(odd), 1024):
            now.update(zip(odd[at : at + 1024], self._slow(odd[at : at + 1024]), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, null counting as empty."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            parts, size = [], 0
            while at < len(texts) and size < 4_000_000:
                text = texts[at] or ""
                size += len(text)
                parts.append(self.units(text))
                at += 1
            if len(self.now) > self.most:
                self.old, self.now = self.now, {"": b""}
            self._learn(set().union(*parts).difference(self.now))
            find = self.now.__getitem__
            out += [b"".join(map(find, units)) for units in parts]
        return out


class UnitTable:
    """Ids by unit: a hash table over arrays. Units of up to 24 bytes without NUL are keys of three words, compared whole."""

    def __init__(self):
        self.slots = np.full(1 << 12, -1, np.int32)
        self.rows = np.zeros((1 << 11, 4), np.uint64)  # three words of the unit, first id << 32 | number of ids
        self.ids = np.zeros(1 << 14, np.uint32)
        self.size = self.used = self.long_bytes = 0
        self.long: dict[bytes, int] = {}

    def full(self, most: int) -> bool:
        return self.size + 4 * len(self.long) > most or self.used > 8 * most or self.long_bytes > 16 * most

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """Row of each key, or -1."""
        at = self._place(keys)
        row = self.slots[at]
        out = self._same(row, keys)
        left = np.flatnonzero((out < 0) & (row >= 0))
        while len(left):  # others hold the slot: on to the next one
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            row = self.slots[at[left]]
            out[left] = got = self._same(row, [k[left] for k in keys])
            left = left[(got < 0) & (row >= 0)]
        return out

    def _place(self, keys: list[np.ndarray]) -> np.ndarray:
        """The first slot of each key."""
        h = keys[0] * np.uint64(0x9E3779B97F4A7C15) + keys[1] * np.uint64(0xC2B2AE3D27D4EB4F) + keys[2] * np.uint64(0x165667B19E3779F9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _same(self, row: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        held = self.rows.take(row, 0, mode="wrap")
        same = (held[:, 0] == keys[0]) & (held[:, 1] == keys[1]) & (held[:, 2] == keys[2])
        return np.where(same, row, -1)

    def add(self, keys: list[np.ndarray], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Rows of new units; keys of zeros stay out of the slots."""
        rows = np.arange(self.size, self.size + len(counts))
        # one row more than is used, so that row -1 (no row) holds no key
        self.rows = _room(self.rows, self.size + len(counts) + 1)
        self.ids = _room(self.ids, self.used + len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        for i, k in enumerate(keys):
            self.rows[rows, i] = k
        self.rows[rows, 3] = (self.used + np.cumsum(counts) - counts) << 32 | counts
        self.size, self.used = self.size + len(counts), self.used + len(ids)
        if self.size * 2 > len(self.slots):
            self.slots = np.full(1 << (self.size * 4).bit_length(), -1, np.int32)
            self._slot(np.arange(self.size))
        else:
            self._slot(rows)
        return rows

    def _slot(self, rows: np.ndarray) -> None:
        rows = rows[self.rows[rows, 0] != 0].astype(np.int32)
        at = self._place([self.rows[rows, i] for i in range(3)])
        while len(rows):
            free = self.slots[at] < 0
            self.slots[at[free]] = rows[free]
            lost = self.slots[at] != rows
            rows, at = rows[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these rows, one after another; their numbers of ids)."""
        at = self.rows[rows, 3]
        counts = (at & np.uint64(0xFFFFFFFF)).astype(np.int64)
        shift = (at >> np.uint64(32)).astype(np.int64) - (np.cumsum(counts) - counts)
        return self.ids[np.repeat(shift, counts) + np.arange(counts.sum())], counts


def _room(a: np.ndarray, size: int) -> np.ndarray:
    return a if size <= len(a) else np.concatenate([a, np.zeros((max(size - len(a), len(a) // 2), *a.shape[1:]), a.dtype)])


# kinds of bytes: 0 space, 1 other white space, 2 within a letter or sign of several bytes, 3 may begin white space of
# several bytes, 4 leaves its text to UnitCoder, 5 sign or digit, 6 letter
_KINDS = bytes(0 if b == 32 else 1 if b in b"\t\n\r" else 4 if b in b"\x00\x0b\x0c\x1c\x1d\x1e\x1f" else 3 if b in b"\xc2\xe1\xe2\xe3" else 2 if b > 127 else 6 if chr(b).isalpha() else 5 for b in range(256))
_WIDE = np.zeros(1 << 14, bool)  # white space among the code points that those bytes begin
_WIDE[[c for c in range(128, 1 << 14) if re.match(f"[{_WS}]", chr(c))]] = True
_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])
_STAYS = np.array([bool(_LETTER[c]) and UnitCoder._stays_one(chr(c)) for c in range(1 << 16)])  # letters when normalised, too
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # of a vocabulary that drops white space
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class ArrowCoder:
    """Ids of a column of texts, cut and looked up in arrays.

    Units are shorter here, by the library's own patterns: letters are cut from signs and digits, but not from an
    apostrophe before them. Where white space is part of tokens (spaced, byte-level), a run of it is cut before its last
    character, which what follows joins only if it is a space. Where it is dropped, units hold none; letters that do not
    stay letters when normalised are not cut from signs, and A-Z is lower-cased first, unless a character of several
    bytes follows, which may be a mark that joins it. Texts with rare white space, NUL or added tokens go to UnitCoder.
    most: units in one generation of the cache, about 100 bytes each; those of over 24 bytes count five times.
    """

    def __init__(self, path: str, spaced: bool = True, most: int = 500_000, piece: int = 1 << 20):
        self.texts, self.spaced, self.most, self.piece = UnitCoder(path, spaced, 50_000), spaced, most, piece
        self.now, self.old = UnitTable(), UnitTable()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        self.special = [x["content"].encode() for x in spec["added_tokens"]]
        if spaced:
            self.known = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec["normalizer"]
        else:
            steps, pieces = (spec["normalizer"] or {}).get("normalizers", []), before.get("pretokenizers", [])
            self.special = [x.lower() for x in self.special]  # found in any case
            self.known = [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in pieces] == ["Split", "ByteLevel"] and pieces[0]["pattern"] == {"Regex": _PIECES} and pieces[0]["invert"] and not (pieces[1]["use_regex"] or pieces[1]["add_prefix_space"])
        # a letter that no token joins to others keeps words apart, so that one call takes many
        plain = spaced and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        joined = set().union(*(t for t in model["vocab"] if len(t) > 1))
        self.apart = next((c for c in byte_letters()[:32] if plain and c in model["vocab"] and c not in joined), None)
        self.apart_id = model["vocab"].get(self.apart)
        self.points = np.array([ord(self.apart or "\0"), *map(ord, byte_letters()[1:])], "<u4")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; each text's number of ids), null counting as empty."""
        column = column.fill_null("") if column.null_count else column
        wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
        if not len(column):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        off = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        raw = memoryview(column.buffers()[2] or b"")
        got, at = [], 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(off, off[at] + self.piece, "right")) - 1)
            got.append(self._some(bytes(raw[off[at] : off[end]]), off[at : end + 1] - off[at]))
            at = end
        return np.concatenate([i for i, _ in got]), np.concatenate([n for _, n in got])

    def _some(self, raw: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
        own = self._own_path(raw, kinds, off)
        if not len(own):
            return self._cut(raw, kinds, off)
        texts = [raw[a:z] for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        parts = dict(zip(own.tolist(), self.texts.encode([texts[i].decode() for i in own.tolist()]), strict=True))
        rest = [t for i, t in enumerate(texts) if i not in parts]
        joined = b"".join(rest)
        ids, counts = self._cut(joined, np.frombuffer(joined.translate(_KINDS), np.uint8), np.cumsum([0, *map(len, rest)]))
        others = iter(np.split(ids, np.cumsum(counts)[:-1])) if rest else iter(())
        out = [np.frombuffer(parts[i], "<u4") if i in parts else next(others) for i in range(len(texts))]
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def _own_path(self, raw: bytes, kinds: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The texts that UnitCoder takes."""
        if not self.known:
            return np.arange(len(off) - 1)
        at = [np.flatnonzero(kinds == 4)]
        if len(lead := np.flatnonzero(kinds == 3)):
            data = np.frombuffer(raw + b"\0\0", np.uint8)
            a, b, c = (data[lead + i].astype(np.int64) & 63 for i in range(3))
            at.append(lead[_WIDE[np.where(data[lead] < 0xE0, (a & 31) << 6 | b, (a & 3) << 12 | b << 6 | c)]])
        raw = raw if self.spaced else raw.lower()
        for token in self.special:
            found = raw.find(token)
            while found >= 0:
                at.append(np.array([found]))
                found = raw.find(token, found + 1)
        return np.unique(np.searchsorted(off, np.concatenate(at), "right") - 1)

    def _cut(self, raw: bytes, kinds: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not raw:
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        data, white = np.frombuffer(raw, np.uint8), kinds < 2
        turn = white[1:] != white[:-1]
        cut = np.zeros(len(raw), bool)
        if self.spaced:
            last = turn & white[:-1]  # the last character of a run
            cut[1:] = turn & (kinds[:-1] != 0)  # a run begins, or a word after other white space than a space
            last[off[(off > 0) & (off < len(raw))] - 1] = False  # a run that ends its text stays whole
            cut[:-1] |= last
        else:
            cut[1:] = turn
            upper = data - 65 < 26
            upper[:-1] &= data[1:] < 128
            data = data | upper.astype(np.uint8) << 5
            raw = data.tobytes()
        sign, letter = kinds == 5, kinds == 6
        cut[1:] |= sign[1:] & letter[:-1]
        cut[1:] |= letter[1:] & sign[:-1] & (data[:-1] != 39)
        wide = np.flatnonzero(sign[1:] & (data[:-1] > 127)) + 1  # signs after a character of several bytes
        a, b, c = (data[np.maximum(wide - i, 0)].astype(np.int64) for i in (3, 2, 1))
        point = np.where(b >= 0xC0, (b & 31) << 6 | c & 63, np.where(a >> 4 == 14, (a & 15) << 12 | (b & 63) << 6 | c & 63, 0))
        cut[wide[(_LETTER if self.spaced else _STAYS)[point]]] = True
        cut[off[off < len(raw)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(raw))
        if not self.spaced:
            held = ~white[starts]
            starts, ends = starts[held], ends[held]
        if self.now.full(self.most):
            self.old, self.now = self.now, UnitTable()
        ids, counts = self.now.gather(self._rows(raw, starts, ends))
        return ids, np.diff(np.append(0, np.cumsum(counts))[np.searchsorted(starts, off)])

    def _rows(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows in the table of these units, which it then has."""
        size = ends - starts
        words = np.frombuffer(raw + bytes(40 - len(raw) % 8), "<u8")
        at, bits = starts >> 3, ((starts & 7) << 3).astype(np.uint64)
        keys, low = [], words[at]
        for i in range(3):
            high = words[at + i + 1]
            mask = _MASKS[np.clip(size - 8 * i, 0, 8)]
            keys.append((low >> bits | high << (np.uint64(56) - bits) << np.uint64(8)) & mask)
            low = high
        long = np.flatnonzero(size > 24)
        rows = self.now.find(keys)
        rows[long] = [self.now.long.get(raw[a:z], -1) for a, z in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        if not len(lost := np.flatnonzero(rows < 0)):
            return rows
        # one place of each missing unit, its ids from the last generation or learned
        names = [raw[a:z] for a, z in zip(starts[lost].tolist(), ends[lost].tolist(), strict=True)]
        units = list(dict.fromkeys(names))
        of = np.fromiter(map(dict(zip(units, range(len(units)), strict=True)).__getitem__, names), np.int64, len(names))
        place = np.empty(len(units), np.int64)
        place[of] = lost
        keys, long = [k[place] for k in keys], np.flatnonzero(size[place] > 24)
        before = self.old.find(keys)
        before[long] = [self.old.long.get(units[i], -1) for i in long.tolist()]
        for k in keys:
            k[long] = 0
        kept, new = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
        told, ids, counts = self._learn([units[i] for i in new.tolist()])
        old_ids, old_counts = self.old.gather(before[kept])
        order = np.append(kept, new[told])
        made = np.empty(len(units), np.int64)
        made[order] = self.now.add([k[order] for k in keys], np.append(old_ids, ids), np.append(old_counts, counts))
        for i in long.tolist():
            self.now.long[units[i]] = int(made[i])
            self.now.long_bytes += len(units[i])
        rows[lost] = made[of]
        return rows

    def _learn(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the order in which these units follow, their ids, each one's number of ids)."""
        texts = b"\0".join(units).decode().split("\0") if units else []
        if self.spaced:
            is_word = np.array([len(u) < 64 and u[u[0] == " " :].isalpha() for u in texts], bool)
        else:
            is_word = np.array([len(u) < 64 and u.isalpha() and (u.isascii() or self.texts._stays_one(u)) for u in texts], bool)
        words, odd = np.flatnonzero(is_word), np.flatnonzero(~is_word)
        ids, counts = self._words([units[i] for i in words.tolist()])
        rest = [x for at in range(0, len(odd), 1024) for x in self.texts._slow([texts[i] for i in odd[at : at + 1024].tolist()])]
        counts = np.append(counts, np.array([len(x) // 4 for x in rest], np.int64))
        return np.append(words, odd), np.append(ids, np.frombuffer(b"".join(rest), "<u4")), counts

    def _words(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, each unit's number) of units whose body is letters only: each one piece for the model."""
        if not self.spaced:
            return self._lowered(units)
        if self.apart is None:
            got = [self.texts._word(u.decode()) for u in units]
            return np.frombuffer(b"".join(got), "<u4"), np.array([len(x) // 4 for x in got], np.int64)
        ids, tokenize = [], self.texts.model.tokenize
        for at in range(0, len(units), 48):
            raw = b"\0".join(units[at : at + 48]) + b"\0"
            ids += [t.id for t in tokenize(self.points[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-32-le"))]
        flat = np.array(ids, np.uint32)
        ends = np.flatnonzero(flat == self.apart_id)
        return flat[flat != self.apart_id], np.diff(ends, prepend=-1) - 1

    def _lowered(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """_words where white space is dropped: all are normalised and spelt in the vocabulary's letters at once."""
        ids, counts, tokenize = [], [], self.texts.model.tokenize
        if units:
            raw = unicodedata.normalize("NFC", b" ".join(units).decode()).lower().encode()
            seen = self.points[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-32-le")
            for word in seen.split(self.texts.letters[32]):
                ids += (got := [t.id for t in tokenize(word)])
                counts.append(len(got))
        return np.array(ids, np.uint32), np.array(counts, np.int64)


_coders: dict = {}


def arrow_coder(path: str, spaced: bool = True) -> ArrowCoder:
    """The coder of columns of this Python worker, kept from task to task."""
    if (path, spaced) not in _coders:
        _coders[path, spaced] = ArrowCoder(path, spaced)
    return _coders[path, spaced]
