"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed for whole texts in Arrow batches. Trees are complete binary trees of fixed
depth, fitted on the histograms of quantile bins of a bounded sample of labelled rows (`bound`), and
flattened into three arrays (feature, threshold, leaf value); scoring walks all rows of a batch one
level at a time with numpy.

Defined cases: a null or empty text has statistics of 0 and is scored like any other; repeated rows get
repeated results; without labels of both classes every score is the share of label 1 (0.5 without
labels); a null doc_id counts as the empty text in the held-out rule; extra columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, U, byte_set, labelled_sample, mix, prefix_sums, repeated, shared, sigmoid, slices, span_hashes, windows, words

BOUND = 20000
BINS, DEPTH, TREES, RATE, LAMBDA, MIN_ROWS = 64, 4, 60, 0.2, 1.0, 8
THRESHOLD = 0.3
UPPER, LOWER, DIGIT = byte_set(range(65, 91)), byte_set(range(97, 123)), byte_set(range(48, 58))
SIGNS = byte_set(b"#*$%&|<>")
STOPS = byte_set(b".!?")
PUNCT = byte_set([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
STATS = ("log_chars", "log_words", "word_len", "word_len_sd", "long_words", "short_words", "upper", "lower", "digit", "signs", "stops", "punct", "high_bytes", "space",
         "line_len", "dup_lines", "dup_line_share", "word_variety", "repeat_pairs", "repeat_triples", "next_same", "caps_words", "sign_words", "line_end_stop", "exclaim")


def statistics(texts: list) -> np.ndarray:
    """One row of STATS per whole text."""
    out = np.zeros((len(texts), len(STATS)))
    for s in slices(texts):
        c = prefix_sums(s.buf)
        size = np.maximum(np.diff(s.at) - 1, 1)
        start, end, h, own = words(s, ~SPACE, c)
        n = np.bincount(own, minlength=s.n)
        nn = np.maximum(n, 1)
        length = (end - start).astype(float)

        def per_word(x, own=own, s=s, nn=nn):
            return np.bincount(own, weights=x, minlength=s.n) / nn

        def share(t, s=s, size=size):
            return s.per_text(t[s.buf]) / size

        mean = per_word(length)
        salt = own.astype(U) * U(0x9E3779B97F4A7C15)
        key = mix(h + salt)
        variety = np.bincount(own[np.unique(key, return_index=True)[1]], minlength=s.n) / nn
        rep = []
        for k in (2, 3):
            w, first = windows(h, own, k)
            o = own[first]
            rep.append(np.bincount(o, weights=repeated(mix(w + o.astype(U) * U(0x9E3779B97F4A7C15))), minlength=s.n) / nn)
        same = np.zeros(len(h))
        same[1:] = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
        caps = np.concatenate(([0], np.cumsum(UPPER[s.buf])))
        sign = np.concatenate(([0], np.cumsum(SIGNS[s.buf])))
        stop = np.flatnonzero(s.buf == 10)
        begin = np.concatenate(([0], stop[:-1] + 1))
        full = stop > begin
        begin, stop = begin[full], stop[full]
        lo = s.owner(begin)
        lines = np.maximum(np.bincount(lo, minlength=s.n), 1)
        lkey = mix(span_hashes(c, begin, stop) + lo.astype(U) * U(0x9E3779B97F4A7C15))
        dup = repeated(lkey)
        out[s.lo:s.lo + s.n] = np.stack([
            np.log1p(np.diff(s.at) - 1), np.log1p(n), mean, np.sqrt(np.maximum(per_word(length ** 2) - mean ** 2, 0)), per_word(length > 12), per_word(length <= 2),
            share(UPPER), share(LOWER), share(DIGIT), share(SIGNS), share(STOPS), share(PUNCT), share(byte_set(range(128, 256))), share(SPACE),
            (np.diff(s.at) - 1) / lines, np.bincount(lo, weights=dup, minlength=s.n) / lines, np.bincount(lo, weights=dup * (stop - begin), minlength=s.n) / size,
            variety * (n > 0), rep[0], rep[1], per_word(same), per_word((caps[end] - caps[start] >= length) & (length > 1)), per_word(sign[end] > sign[start]),
            np.bincount(lo, weights=STOPS[s.buf[stop - 1]], minlength=s.n) / lines, share(byte_set(b"!"))], axis=1)
    return out


@dataclass
class Trees:
    """Flattened trees: node k of a tree has children 2k+1 and 2k+2; leaves are numbered left to right."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, f[node]] > t[node])
            total += leaf[node - inner]
        return sigmoid(total)


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosting on the logistic loss; each level takes the best gain over feature histograms per node."""
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(k)]
    bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)  # bin b: at most edge b
    inner = 2 ** DEPTH - 1
    feature, threshold, leaf = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    start = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    f = np.full(n, start)
    cell = bins + np.arange(k) * BINS
    for t in range(TREES):
        p = sigmoid(f)
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            width = 2 ** level
            at = ((node - (width - 1))[:, None] * (k * BINS) + cell).ravel()
            shape = (width, k, BINS)
            hg = np.bincount(at, np.repeat(g, k), width * k * BINS).reshape(shape).cumsum(axis=2)
            hh = np.bincount(at, np.repeat(h, k), width * k * BINS).reshape(shape).cumsum(axis=2)
            hn = np.bincount(at, minlength=width * k * BINS).reshape(shape).cumsum(axis=2)
            tg, th, tn = hg[:, :, -1:], hh[:, :, -1:], hn[:, :, -1:]
            gain = hg ** 2 / (hh + LAMBDA) + (tg - hg) ** 2 / (th - hh + LAMBDA) - tg ** 2 / (th + LAMBDA)
            gain[(hn < MIN_ROWS) | (tn - hn < MIN_ROWS)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for i, b in enumerate(best):
                j, cut = divmod(int(b), BINS)
                if gain[i, j, cut] > 1e-6 and cut < len(edges[j]):
                    feature[t, width - 1 + i], threshold[t, width - 1 + i] = j, edges[j][cut]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        leaf[t] = RATE * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + LAMBDA)
        f += leaf[t, at]
    return Trees(feature, threshold, leaf, start)


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: crc32 of the id as text leaves remainder 0 modulo 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _stat_rows(batches):
    for b in batches:
        x = statistics(b.column("_text").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y"), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Trees | float:
    """Trees fitted on at most `bound` rows outside the held-out fifth; a constant without both classes."""
    sample, sizes = labelled_sample(docs, labels, "quality", bound, ~held_out(F.col("_id")))
    kind = dict(docs.dtypes)["doc_id"]
    got = sorted(sample.mapInArrow(_stat_rows, f"id {kind}, y int, x binary").collect(), key=lambda r: (r["id"], bytes(r["x"])))
    y = np.array([r["y"] for r in got], float)
    if len(set(y)) < 2:
        known = sum(sizes.values())
        return sizes.get(1, 0) / known if known else 0.5
    return fit(np.stack([np.frombuffer(r["x"], float) for r in got]), y)


def score(docs: DataFrame, model: Trees | float, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    shared(spark)
    fixed = spark.sparkContext.broadcast(model)  # TREES x 2^DEPTH numbers

    def run(batches):
        for b in batches:
            x = statistics(b.column("text").to_pylist())
            p = fixed.value.score(x) if isinstance(fixed.value, Trees) else np.full(len(x), float(fixed.value))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
