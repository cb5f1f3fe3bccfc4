"""Toxicity by a classifier chain of linear models on hashed words.

The categories are predicted in a fixed order. The model of a category sees the words of the text and
the probabilities of the categories before it; those inputs are out-of-fold predictions while fitting
and the earlier models' own predictions while scoring. The labels give one mark (`toxic`); the finer
categories are rows with that mark that use words of a stated group.

A feature is the presence of a hashed word, or of a hashed word beginning, in the whole text: long texts
are not diluted, and inflected or compounded forms of a telling word share its beginning. Features whose presence does not tell the classes of a category apart (|z| below MIN_Z) get no
weight. The fit uses a bounded sample of labelled rows (`bound`, half of each class).

Defined cases: a null or empty text has no feature and gets the base probability; repeated rows give
repeated results; without labels of both classes every probability is the share of label 1 (0 without
labels); extra columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, U, labelled_sample, mix, prefix_sums, shared, sigmoid, slices, span_hashes, words

BOUND = 2400
BITS = 17
PREFIXES = (4, 5, 6)
WIDTH = (1 + len(PREFIXES)) << BITS
MIN_Z, MIN_SEEN = 4.0, 3
THRESHOLD = 0.3
FOLDS = 4
_SHIFT = U(64 - BITS)
# Words that name the finer categories.
GROUPS = {
    "insult": ("idiot", "moron", "loser", "clown", "scum"),
    "contempt": ("stupid", "pathetic", "worthless", "disgusting", "trash"),
}
CHAIN = (*GROUPS, "toxic")


def _slots(s) -> tuple[np.ndarray, np.ndarray]:
    """(slot, owning text) of every lower-cased word and of its beginnings of PREFIXES bytes."""
    c = prefix_sums(s.buf)
    start, end, h, own = words(s, ALNUM, c)
    slot, owner = [(mix(h) >> _SHIFT).astype(np.int64)], [own]
    for k, n in enumerate(PREFIXES, 1):
        on = end - start >= n
        slot.append((mix(span_hashes(c, start[on], start[on] + n)) >> _SHIFT).astype(np.int64) + (k << BITS))
        owner.append(own[on])
    return np.concatenate(slot), np.concatenate(owner)


def word_slots(terms) -> np.ndarray:
    """Slots of single words."""
    out = []
    for t in terms:
        buf = np.frombuffer(t.lower().encode(), np.uint8)
        out.append(int(mix(span_hashes(prefix_sums(buf), np.array([0]), np.array([len(buf)])))[0] >> _SHIFT))
    return np.array(out, np.int64)


def _rows(batches):
    for b in batches:
        found = []
        for s in slices(b.column("_text").to_pylist(), lower=True):
            slot, own = _slots(s)
            u = np.unique(own * WIDTH + slot)
            cut = np.searchsorted(u, np.arange(s.n + 1) * WIDTH)
            found += [(u[cut[i]:cut[i + 1]] % WIDTH).astype(np.int32).tobytes() for i in range(s.n)]
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y"), pa.array(found, pa.binary())], ["id", "y", "idx"])


@dataclass
class Link:
    """Model of one category: word weights, weights of the earlier categories, intercept."""

    weight: np.ndarray
    earlier: np.ndarray
    shift: float


@dataclass
class Chain:
    names: tuple
    links: list = field(default_factory=list)
    base: float = 0.0

    def probabilities(self, n: int, slot: np.ndarray, own: np.ndarray) -> np.ndarray:
        out = np.full((n, len(self.names)), self.base)
        for k, link in enumerate(self.links):
            z = link.shift + out[:, :k] @ link.earlier + np.bincount(own, weights=link.weight[slot], minlength=n)
            out[:, k] = sigmoid(z)
        return out


def _fit(rows, y, prior, weight, l2: float = 1.0, steps: int = 200) -> Link:
    """Weighted logistic regression on the telling features and the earlier categories' probabilities."""
    own = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    idx = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)
    a = np.bincount(idx, weights=y[own], minlength=WIDTH)
    b = np.bincount(idx, minlength=WIDTH) - a
    p = (a + b + 1) / (n1 + n0 + 2)
    z = (a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    good = (np.abs(z) >= MIN_Z) & (a + b >= MIN_SEEN)
    place = np.cumsum(good) - 1
    on = good[idx]
    own, col = own[on], place[idx[on]]
    width, k = int(good.sum()), prior.shape[1]
    w, m, v = (np.zeros(width + k + 1) for _ in range(3))
    weight = weight / weight.sum()
    for t in range(1, steps + 1):
        s = np.bincount(own, weights=w[col], minlength=len(y)) + prior @ w[width:width + k] + w[-1]
        g = weight * (sigmoid(s) - y)
        grad = np.concatenate([np.bincount(col, weights=g[own], minlength=width), prior.T @ g, [g.sum()]])
        grad[:-1] += l2 * w[:-1] / len(y)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-10) / np.sqrt(1 + t / 50)
    out = np.zeros(WIDTH)
    out[good] = w[:width]
    return Link(out, w[width:width + k], float(w[-1]))


def train_chain(rows: list[np.ndarray], marks: dict[str, np.ndarray], weight: np.ndarray) -> Chain:
    """Fit the categories in order; each sees out-of-fold probabilities of those before it."""
    chain = Chain(tuple(marks))
    fold = np.arange(len(rows)) % FOLDS
    prior = np.zeros((len(rows), 0))
    for y in marks.values():
        y = y.astype(float)
        oof = np.zeros(len(rows))
        for k in range(FOLDS):
            a, b = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            part = _fit([rows[i] for i in a], y[a], prior[a], weight[a])
            for i in b:
                oof[i] = sigmoid(part.shift + prior[i] @ part.earlier + part.weight[rows[i]].sum())
        chain.links.append(_fit(rows, y, prior, weight))
        prior = np.concatenate([prior, oof[:, None]], axis=1)
    return chain


def train(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Chain:
    sample, sizes = labelled_sample(docs, labels, "toxic", bound)
    kind = dict(docs.dtypes)["doc_id"]
    got = sorted(sample.mapInArrow(_rows, f"id {kind}, y int, idx binary").collect(), key=lambda r: (r["id"], bytes(r["idx"])))
    y = np.array([r["y"] for r in got])
    known = sum(sizes.values())
    if len(set(y)) < 2:
        return Chain(CHAIN, base=sizes.get(1, 0) / known if known else 0.0)
    rows = [np.frombuffer(r["idx"], np.int32) for r in got]
    marks = {name: np.array([t and bool(np.isin(group, r).any()) for r, t in zip(rows, y, strict=True)]) for name, group in ((n, word_slots(g)) for n, g in GROUPS.items())}
    share = {c: sizes.get(c, 0) / max((y == c).sum(), 1) for c in (0, 1)}
    return train_chain(rows, {**marks, "toxic": y == 1}, np.where(y == 1, share[1], share[0]))


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, one probability per category, and toxic."""
    spark = docs.sparkSession
    shared(spark)
    fixed = spark.sparkContext.broadcast(chain)  # 3 x 2^19 weights, whatever the corpus
    names = [f"p_{n}" for n in chain.names]

    def run(batches):
        c = fixed.value
        live = np.zeros(WIDTH, bool)
        for link in c.links:
            live |= link.weight != 0
        for b in batches:
            texts = b.column("text").to_pylist()
            p = np.zeros((len(texts), len(c.names)))
            for s in slices(texts, lower=True):
                slot, own = _slots(s)
                on = live[slot]
                u = np.unique(own[on] * WIDTH + slot[on])
                p[s.lo:s.lo + s.n] = c.probabilities(s.n, u % WIDTH, u // WIDTH)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(p[:, k]) for k in range(len(names)))], ["doc_id", *names])

    kind = dict(docs.dtypes)["doc_id"]
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {', '.join(f'{n} double' for n in names)}")
    return out.withColumn("toxic", (F.col(names[-1]) >= threshold).cast("int"))
