"""Quality classifier: naive Bayes support vectors.

A word is itself if it is frequent in the training sample, else its shape (letter case, digits and punctuation, runs
cut short). Features are indicators of single words and of word pairs. They are scaled by the log-ratio of their
smoothed frequencies in the two classes, and a linear hinge-loss model is fitted to them by dual coordinate descent;
a logistic curve fitted on a fifth of the sample, set aside for it, turns margins into scores.

The model is fitted in one task on at most SAMPLE labelled rows (least CRC-32 of the id first), so it has a fixed
bound of WORDS + SHAPES codes and their pairs at any input size; scoring reads every text whole.

Results: one row per input row, whatever its id (null, repeated). A null text counts as empty, and a text without
features gets the score of the bias alone. Words and texts count whole, however long; the sample's texts are held in
one task, so its memory is that of SAMPLE texts. An empty table gives an empty result. Labels that are null are not learned from; several labels of an id count
as the greatest. With labels of one class only, or none, every score is that class's rate (0.5 without any).
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, WORDS, SHAPES, LEAST_TEXTS, ROUNDS, C = 6000, 1500, 500, 3, 12, 0.5


_PLAIN = str.maketrans({chr(c): "A" if c < 91 else "a" for c in (*range(65, 91), *range(97, 123))} | {str(d): "0" for d in range(10)})
_LETTER, _DIGIT, _RUN = re.compile(r"[^\W\d_]"), re.compile(r"\d"), re.compile(r"(.)\1+")


def shape(word: str) -> str:
    if word.isascii():
        s = word.translate(_PLAIN)
    else:
        s = _DIGIT.sub("0", _LETTER.sub(lambda m: "A" if m.group().isupper() else "a", word))
    return _RUN.sub(r"\1\1", s)


class Codes:
    """Codes of words, remembered up to a bound."""

    def __init__(self, words: dict[str, int], shapes: dict[str, int]):
        self.words, self.shapes, self.known = words, shapes, {}
        self.other = len(words) + len(shapes)
        self.n = self.other + 1

    def of(self, text: str | None) -> np.ndarray:
        parts = (text or "").split()
        if len(self.known) > 300_000:
            self.known = {}
        known, words, shapes, other = self.known, self.words, self.shapes, self.other
        for w in set(parts).difference(known):
            c = words.get(w)
            known[w] = c if c is not None else shapes.get(shape(w), other)
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))

    def features(self, text: str | None) -> np.ndarray:
        """Distinct features: codes, then pairs of codes."""
        c = self.of(text)
        return np.concatenate([np.unique(c), np.unique(c[:-1] * self.n + c[1:]) + self.n]) if len(c) else c


def fit(texts: list[str], labels: np.ndarray) -> dict:
    """The model of a sample: vocabulary, dense weights of features, scale and offset of the logistic curve."""
    from collections import Counter

    words, shapes, seen = Counter(), Counter(), {}
    for t in texts:
        own = set(t.split())
        words.update(own)
        for w in own.difference(seen):
            seen[w] = shape(w)
        shapes.update(set(map(seen.__getitem__, own)))
    by_count = lambda c, n: {w: i for i, (w, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:n])}
    vocabulary = by_count(Counter({w: n for w, n in words.items() if n >= 10}), WORDS)
    forms = {w: i + len(vocabulary) for w, i in by_count(shapes, SHAPES).items()}
    codes = Codes(vocabulary, forms)
    found = [codes.features(t) for t in texts]
    y = np.where(labels > 0, 1.0, -1.0)
    n = codes.n + codes.n**2
    pos, neg = (np.bincount(np.concatenate([f for f, v in zip(found, y, strict=True) if v == s] or [np.zeros(0, np.int64)]), minlength=n) for s in (1, -1))
    rate = float((y > 0).mean()) if len(y) else 0.5
    if not len(y) or abs(rate - 0.5) == 0.5:
        return {"codes": (vocabulary, forms), "weights": np.zeros(n, np.float32), "bias": 0.0, "a": 0.0, "b": 30.0 * (2 * rate - 1) if len(y) else 0.0}
    keep = pos + neg >= LEAST_TEXTS
    ratio = np.where(keep, np.log((pos + 1) / (pos.sum() + keep.sum())) - np.log((neg + 1) / (neg.sum() + keep.sum())), 0.0)
    xs = [f[keep[f]] for f in found]
    norm = [1 / max(1e-9, np.sqrt((ratio[f] ** 2).sum())) for f in xs]  # rows of length one, whatever a text's length
    fold = np.arange(len(y)) % 5 == 0
    rng, w, bias = np.random.default_rng(7), np.zeros(n), 0.0
    train = np.flatnonzero(~fold)
    alpha = np.zeros(len(y))
    cost = np.where(y > 0, C / (2 * rate), C / (2 * (1 - rate))) * 4
    for _ in range(ROUNDS):
        for i in rng.permutation(train):
            v = ratio[xs[i]] * norm[i]
            g = y[i] * (v @ w[xs[i]] + bias) - 1
            new = min(max(alpha[i] - g / (1.0 + 1.0), 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[xs[i]] += step * v
                bias += step
                alpha[i] = new
    weights = w * ratio
    margin = np.array([weights[xs[i]].sum() * norm[i] + bias for i in np.flatnonzero(fold)])
    t = (y[fold] > 0).astype(float)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of logistic regression on the margin, slightly held back
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum() + 1e-2 * (a - 1), (p - t).sum()])
        q = p * (1 - p)
        h = np.array([[(q * margin**2).sum() + 1e-2, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-2]])
        da, db = np.linalg.solve(h, g)
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    return {"codes": (vocabulary, forms), "weights": weights.astype(np.float32), "square": (ratio**2).astype(np.float32), "bias": bias, "a": float(max(a, 0.1)), "b": float(b)}


def score(model: dict, codes: Codes, text: str | None) -> float:
    f = codes.features(text)
    raw = model["bias"]
    if len(f) and "square" in model and (size := float(model["square"][f].sum())) > 0:
        raw += float(model["weights"][f].sum()) / size**0.5
    return float(1 / (1 + np.exp(-np.clip(model["a"] * raw + model["b"], -30, 30))))


def _packed(model: dict) -> bytes:
    sparse = {k: (np.flatnonzero(v), v[np.flatnonzero(v)], len(v)) for k, v in model.items() if isinstance(v, np.ndarray)}
    return pickle.dumps({k: sparse.get(k, v) for k, v in model.items()})


def _opened(data: bytes) -> dict:
    model = pickle.loads(data)
    for k in ("weights", "square"):
        if k in model:
            at, values, n = model[k]
            model[k] = np.zeros(n, np.float32)
            model[k][at] = values
    return model


def held_out(key):
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


_models: dict[int, tuple] = {}


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> bytes:
    """The packed model of the labelled rows that are not held out."""
    taught = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("k")).agg(F.max(label).alias("y"))
    some = taught.orderBy(F.crc32(F.concat(F.col("k").cast("string"), F.lit("#"))), "k").limit(SAMPLE)
    sample = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(some), "k").groupBy("k", "y").agg(F.max("t").alias("t"))

    def train(batches):
        rows = sorted((k, t or "", y) for b in batches for k, t, y in zip(*(b.column(c).to_pylist() for c in ("k", "t", "y")), strict=True))
        rows = [rows[i] for i in np.random.default_rng(3).permutation(len(rows))]
        model = fit([r[1] for r in rows], np.array([r[2] for r in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([_packed(model)], pa.binary())], ["model"])

    got = sample.coalesce(1).mapInArrow(train, "model binary").first()
    return bytes(got.model) if got else _packed(fit([], np.zeros(0, np.int64)))


def _model(shared, mark: int) -> tuple[dict, Codes]:
    """The opened model of a worker, kept from task to task."""
    if mark not in _models:
        _models.clear()
        model = _opened(shared.value)
        _models[mark] = model, Codes(*model["codes"])
    return _models[mark]


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, held_out, score, predicted) of each row; learned from rows that are not held out."""
    data = trained(docs, labels, key, text, label)
    shared, mark = docs.sparkSession.sparkContext.broadcast(data), zlib.crc32(data)

    def run(batches):
        model, codes = _model(shared, mark)
        for b in batches:
            s = np.array([score(model, codes, t) for t in b.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [key, "held_out", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), F.col(text)).mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose text scores at least the threshold, all columns as they are."""
    at = docs.columns.index(text)
    data = trained(docs, labels, key, text)
    shared, mark = docs.sparkSession.sparkContext.broadcast(data), zlib.crc32(data)

    def run(batches):
        model, codes = _model(shared, mark)
        for b in batches:
            yield b.filter(pa.array([score(model, codes, t) >= threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
