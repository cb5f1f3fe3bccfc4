"""Helpers the operators of this folder share: shared storage, words as hashes in numpy, components.

Texts are handled in Arrow batches. A batch is cut into slices of a few MB, a slice is one byte
buffer, and words, lines and n-grams of the buffer are hashed with prefix sums, so no Python loop
runs per word. Nothing is cut off: a slice always holds whole texts.
"""
from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
SLICE, TEXTS = 750_000, 2_000  # bytes and texts one numpy step handles


# --- storage -----------------------------------------------------------------------------------
def shared(spark: SparkSession) -> None:
    """Make sure checkpoints go to the folder the session names; a local one serves local masters only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="caseflux-"))


def settle(df: DataFrame) -> DataFrame:
    """Write a table once into the shared folder; later steps read it instead of computing it again."""
    shared(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage: shuffle files go with the plans that made them, once these are settled."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(doc_id: Column, text: Column) -> list[Column]:
    """Join key of a row that stays apart from rows with the same doc_id but another text; nulls allowed."""
    return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("_kid"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_kh")]


# --- words in numpy ----------------------------------------------------------------------------
def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
_POW = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, 0..n-1."""
    if len(_POW[0]) < n:
        for k, b in enumerate((_BASE, _BASE_INV)):
            p = np.full(n, b, U)
            p[0] = 1
            _POW[k] = np.multiply.accumulate(p)
    return _POW[0][:n], _POW[1][:n]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    c = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * powers(len(buf))[0], out=c[1:])
    return c


def span_hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end), the same wherever they stand."""
    return mix((c[end] - c[start]) * powers(len(c))[1][start] + (end - start).astype(U))


def byte_set(codes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(codes)] = True
    return t


SPACE = byte_set([32, *range(9, 14)])
ALNUM = byte_set([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])


def runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    d = np.flatnonzero(np.diff(np.concatenate(([False], flag, [False])).view(np.int8)))
    return d[::2], d[1::2]


@dataclass
class Slice:
    """Some whole texts as one buffer; text i is buf[at[i]:at[i+1]-1], a line feed ends each."""

    lo: int
    n: int
    buf: np.ndarray
    at: np.ndarray

    def owner(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, pos, side="right") - 1

    def per_text(self, flag: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        c = np.concatenate(([0], np.cumsum(flag)))
        return c[self.at[1:]] - c[self.at[:-1]]


def slices(texts: list | pa.Array, lower: bool = False, limit: int = SLICE, most: int = TEXTS) -> Iterator[Slice]:
    """Slices of a list of texts, or of an Arrow column, of which one slice at a time becomes Python strings."""
    held = isinstance(texts, list)
    lo = 0
    while lo < len(texts):
        raw, size, hi = [], 0, lo
        while hi < len(texts) and hi - lo < most:
            t = (texts[hi] if held else texts[hi].as_py()) or ""
            if size and size + len(t) >= limit:
                break
            raw.append((t.lower() if lower else t).encode("utf-8", "surrogatepass"))
            size += len(raw[-1]) + 1
            hi += 1
        raw.append(b"")
        at = np.concatenate(([0], np.cumsum([len(x) + 1 for x in raw[:-1]]))).astype(np.int64)
        yield Slice(lo, hi - lo, np.frombuffer(b"\n".join(raw), np.uint8), at)
        lo = hi


def words(s: Slice, letters: np.ndarray, c: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, hashes and owning texts of the words of a slice."""
    start, end = runs(letters[s.buf])
    c = prefix_sums(s.buf) if c is None else c
    return start, end, span_hashes(c, start, end), s.owner(start)


def windows(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row, and the index of the first; windows stay inside one text."""
    if len(h) < n:
        return h[:0], np.zeros(0, np.int64)
    w = np.zeros(len(h) - n + 1, U)
    for k in range(n):
        w = w * U(_BASE) + h[k:len(h) - n + 1 + k]
    inside = np.flatnonzero(owner[: len(w)] == owner[n - 1:])
    return mix(w[inside]), inside


def repeated(key: np.ndarray) -> np.ndarray:
    """Which entries occur at least twice."""
    o = np.argsort(key, kind="stable")
    same = key[o][1:] == key[o][:-1]
    out = np.zeros(len(key), bool)
    out[o[1:][same]] = True
    out[o[:-1][same]] = True
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


# --- labelled rows -----------------------------------------------------------------------------
def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, where: Column | None = None) -> tuple[DataFrame, dict[int, int]]:
    """At most `bound` labelled documents, half of each class, and the class sizes over all labels.

    The sample takes the smallest hashes of doc_id, so it is the same in every run. Rows with a null
    id or label are left out; of several labels of one id the smallest counts.
    """
    lab = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.min("_y").alias("_y"))
    if where is not None:
        lab = lab.where(where)
    sizes = {r["_y"]: r["count"] for r in lab.groupBy("_y").count().collect()}
    pick = [lab.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(bound // 2) for y in (0, 1)]
    chosen = pick[0].unionByName(pick[1])  # at most `bound` rows of two numbers
    text = docs.select(F.col("doc_id").alias("_d"), F.col("text").alias("_text"))
    joined = text.join(F.broadcast(chosen), F.col("_d") == F.col("_id")).select("_id", "_text", "_y")
    return joined, sizes


# --- components --------------------------------------------------------------------------------
def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of each node (columns node, root) of the undirected links (a, b).

    Labels move along links to the minimum and then jump to the label of their label, so the number of
    rounds grows with the logarithm of the longest chain. Each round is written to the shared folder, and what
    executors hold for it (shuffle files, broadcast plans) goes with it.
    """
    e = links.select("a", "b").where("a != b")
    e = settle(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    lab = settle(e.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = e.join(lab.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = lab.join(near, "node", "left").select("node", "root", F.least("root", F.coalesce("near", "root")).alias("next"))
        heads = step.groupBy(F.col("root").alias("head")).agg(F.min("next").alias("lead"))  # what a root's members have heard of
        step = step.join(heads, F.col("root") == F.col("head"), "left").select("node", "root", F.least("next", "lead").alias("next"))
        nxt = settle(step)
        release(links.sparkSession)
        if nxt.where("next != root").limit(1).count() == 0:
            return nxt.select("node", F.col("next").alias("root"))
        jump = nxt.select(F.col("node").alias("next"), F.col("next").alias("far"))
        lab = settle(nxt.drop("root").join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("root")))
