"""Quality rules: counted rules plus a calibrated logistic model on hashed word and character n-grams.

Every count covers the whole text. The model is fitted on a bounded sample of labelled rows (`bound`,
half of each class); its features are hashed words, word pairs and 4-byte n-grams, each family divided
by its number of tokens, so that scoring is a mean of table look-ups. Margins of held-out folds are
turned into probabilities by Platt scaling with the class sizes of all labels as weights.

Defined cases: a null or empty text has no words, all counts 0, and fails the base rules; repeated rows
give repeated results; without labels of both classes the model keeps everything; extra columns are
ignored by `measure` and carried along by `keep`.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, U, byte_set, labelled_sample, mix, prefix_sums, repeated, runs, shared, sigmoid, slices, span_hashes, windows, words

BITS = 15
BOUND = 1600
MIN_GOOD = 0.3  # fixed threshold on the calibrated probability
SYMBOLS = byte_set(b"#*$%&|<>")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_PAIR, _CHAR = 1 << BITS, 2 << BITS
WIDTH = 3 << BITS


def _slots(s, c, h, owner) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slot, owning text) of every token of the three families."""
    shift = U(64 - BITS)
    out = [((mix(h) >> shift).astype(np.int32), owner)]
    pair, first = windows(h, owner, 2)
    out.append(((pair >> shift).astype(np.int32) + _PAIR, owner[first]))
    b = s.buf.astype(np.uint32)
    if len(b) >= 4:
        g = (b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)) * np.uint32(0x9E3779B1)
        sizes = np.diff(s.at) - 1
        keep = np.ones(len(g), bool)
        for back in range(4):  # n-grams that reach over the line feed between two texts
            gone = s.at[1:] - 1 - back
            keep[gone[(gone >= 0) & (gone < len(g))]] = False
        own = np.repeat(np.arange(s.n), np.maximum(sizes - 3, 0))
        out.append(((g[keep] >> np.uint32(32 - BITS)).astype(np.int32) + _CHAR, own))
    return out


def counts_of(texts: list) -> dict[str, np.ndarray]:
    """The counted measures of whole texts, by numpy."""
    out = {k: np.zeros(len(texts), np.int64) for k in COUNTS}
    for s in slices(texts):
        _counts(s, prefix_sums(s.buf), out)
    return out


def _counts(s, c, out) -> tuple[np.ndarray, np.ndarray]:
    at = slice(s.lo, s.lo + s.n)
    start, end, h, owner = words(s, ~SPACE, c)
    out["n_words"][at] = np.bincount(owner, minlength=s.n)
    out["word_chars"][at] = s.per_text(~SPACE[s.buf] & ((s.buf & 0xC0) != 0x80))
    out["n_symbols"][at] = s.per_text(SYMBOLS[s.buf])
    stop = np.flatnonzero(s.buf == 10)
    begin = np.concatenate(([0], stop[:-1] + 1)) if len(stop) else stop
    if len(stop):
        has = np.searchsorted(start, stop) > np.searchsorted(start, begin)
        begin, stop = begin[has], stop[has]
        own = s.owner(begin)
        key = mix(span_hashes(c, begin, stop) + own.astype(U) * U(0x9E3779B97F4A7C15))
        o = np.argsort(key, kind="stable")  # earlier lines first
        later = np.zeros(len(key), bool)
        later[o[1:][key[o][1:] == key[o][:-1]]] = True
        out["n_dup_lines"][at] = np.bincount(own[later], minlength=s.n)
    w, first = windows(h, owner, 3)
    if len(w):
        twice = first[repeated(mix(w + owner[first].astype(U) * U(0x9E3779B97F4A7C15)))]
        covered = np.zeros(len(h), bool)
        for k in range(3):
            covered[twice + k] = True
        out["n_repeat_words"][at] = np.bincount(owner[covered], minlength=s.n)
    return h, owner


@dataclass
class Model:
    """Weights of the hashed slots and the two numbers of the calibration."""

    weight: np.ndarray
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margin + self.shift)


def margins(s, c, h, owner, weight: np.ndarray) -> np.ndarray:
    total = np.zeros(s.n)
    for slot, own in _slots(s, c, h, owner):
        n = np.bincount(own, minlength=s.n)
        total += np.bincount(own, weights=weight[slot], minlength=s.n) / np.maximum(n, 1)
    return total


def _rows(batches):
    """Slots and shares of each labelled text, for the fit."""
    for b in batches:
        texts = b.column("_text").to_pylist()
        idx, val = [], []
        for s in slices(texts):
            c = prefix_sums(s.buf)
            _, _, h, owner = words(s, ~SPACE, c)
            fam = [(slot, own, np.bincount(own, minlength=s.n)) for slot, own in _slots(s, c, h, owner)]
            key = np.concatenate([own.astype(np.int64) * WIDTH + slot for slot, own, _ in fam]) if fam else np.zeros(0, np.int64)
            share = np.concatenate([1.0 / n[own] for _, own, n in fam]) if fam else np.zeros(0)
            u, inv = np.unique(key, return_inverse=True)
            v = np.bincount(inv, weights=share, minlength=len(u)).astype(np.float32)
            cut = np.searchsorted(u, np.arange(s.n + 1) * WIDTH)
            for i in range(s.n):
                idx.append((u[cut[i]:cut[i + 1]] % WIDTH).astype(np.int32).tobytes())
                val.append(v[cut[i]:cut[i + 1]].tobytes())
        yield pa.RecordBatch.from_arrays([b.column("_y"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], ["y", "idx", "val"])


def fit_logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, l2: float = 1e-4, steps: int = 80, rate: float = 2.0) -> np.ndarray:
    """Logistic regression on sparse rows by Adam on the full sample; the last weight is the intercept."""
    own = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    idx = np.concatenate([i for i, _ in rows]) if rows else np.zeros(0, np.int32)
    val = np.concatenate([v for _, v in rows]).astype(np.float64) if rows else np.zeros(0)
    used, col = np.unique(idx, return_inverse=True)
    w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
    for t in range(1, steps + 1):
        z = np.bincount(own, weights=val * w[col], minlength=len(y)) + w[-1]
        g = (sigmoid(z) - y) / len(y)
        grad = np.append(np.bincount(col, weights=val * g[own], minlength=len(used)), g.sum())
        grad[:-1] += l2 * w[:-1] / len(y)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-10) / np.sqrt(1 + t / 25)
    out = np.zeros(width + 1)
    out[used], out[-1] = w[:-1], w[-1]
    return out


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities: weighted Newton steps on smoothed targets."""
    pos, neg = weight[y == 1].sum(), weight[y == 0].sum()
    goal = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.std(margin)), 1e-9)
    x = np.stack([margin / scale, np.ones_like(margin)])
    a = np.array([1.0, np.log((pos + 1) / (neg + 1))])
    for _ in range(steps):
        p = sigmoid(a @ x)
        grad = x @ (weight * (p - goal)) + 1e-3 * a * [1, 0]
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a = a - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0] / scale), float(a[1])


def train(docs: DataFrame, labels: DataFrame, bound: int = BOUND, label: str = "quality") -> Model | None:
    """Fit on at most `bound` labelled rows; None without both classes."""
    sample, sizes = labelled_sample(docs, labels, label, bound)
    got = sample.mapInArrow(_rows, "y int, idx binary, val binary").collect()
    y = np.array([r["y"] for r in got], float)
    if len(set(y)) < 2:
        return None
    rows = [(np.frombuffer(r["idx"], np.int32), np.frombuffer(r["val"], np.float32)) for r in got]
    order = np.array(sorted(range(len(rows)), key=lambda i: (y[i], len(rows[i][0]), bytes(got[i]["idx"]), bytes(got[i]["val"]))))  # the same folds whatever the task order
    rows, y = [rows[i] for i in order], y[order]
    fold = np.arange(len(y)) % 2
    held = np.zeros(len(y))
    for k in range(2):
        part = fit_logistic([r for r, f in zip(rows, fold, strict=True) if f != k], y[fold != k], WIDTH)
        for i in np.flatnonzero(fold == k):
            held[i] = part[rows[i][0]] @ rows[i][1] + part[-1]
    share = {c: sizes.get(c, 0) / max((y == c).sum(), 1) for c in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    slope, shift = platt(held, y, weight * len(y) / weight.sum())
    full = fit_logistic(rows, y, WIDTH)
    return Model(full[:-1].astype(np.float32), slope, shift + slope * float(full[-1]))


def measure(docs: DataFrame, model: Model | None, min_good: float = MIN_GOOD) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, p_good and kept."""
    spark = docs.sparkSession
    shared(spark)
    fixed = spark.sparkContext.broadcast(model)  # 3 x 2^15 weights, whatever the corpus

    def score(batches):
        m = fixed.value
        for b in batches:
            texts = b.column("text").to_pylist()
            out = {k: np.zeros(len(texts), np.int64) for k in COUNTS}
            p = np.ones(len(texts))
            for s in slices(texts):
                c = prefix_sums(s.buf)
                h, owner = _counts(s, c, out)
                if m is not None:
                    p[s.lo:s.lo + s.n] = m.probability(margins(s, c, h, owner, m.weight))
            n = out["n_words"]
            failed = (n < 50) | (100 * out["n_repeat_words"] > 50 * n)
            kept = ~failed & (p >= min_good)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(out[k]) for k in COUNTS), pa.array(failed), pa.array(p), pa.array(kept)],
                                             ["doc_id", *COUNTS, "base_failed", "p_good", "kept"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, {', '.join(f'{k} long' for k in COUNTS)}, base_failed boolean, p_good double, kept boolean")


def keep(docs: DataFrame, model: Model | None, min_good: float = MIN_GOOD) -> DataFrame:
    """The documents the rules keep, with all their columns.

    The verdict is a function of the text, so it comes from an Arrow function on the text column and no
    join is needed.
    """
    fixed = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def verdict(text):
        import pandas as pd

        texts = text.tolist()
        out = {k: np.zeros(len(texts), np.int64) for k in COUNTS}
        p = np.ones(len(texts))
        for s in slices(texts):
            c = prefix_sums(s.buf)
            h, owner = _counts(s, c, out)
            if fixed.value is not None:
                p[s.lo:s.lo + s.n] = fixed.value.probability(margins(s, c, h, owner, fixed.value.weight))
        n = out["n_words"]
        return pd.Series(~((n < 50) | (100 * out["n_repeat_words"] > 50 * n)) & (p >= min_good))

    return docs.where(verdict(F.coalesce(F.col("text"), F.lit(""))))
