"""Exact removal of repeated byte strings: every byte covered by a LENGTH-byte string that also starts elsewhere.

The question for each start of a string ("window") is whether its first LENGTH bytes occur anywhere else.
Sorting all suffixes answers it, but front-coded runs of all suffixes are some hundred times the text, and a
merge by loser trees runs row by row; neither fits the memory and disk a task has here (see README).
What is kept of that method is that known common prefixes are never compared again: windows are grouped
by ever longer common parts, and only groups that are still undecided go on.

At each level a window is named by the smallest hash of its `gram`-byte substrings, so equal windows have
equal names. Neighbouring windows with one name are a run. A name that one run has is unique and its windows
are done. Runs with one name and one content of the whole run repeat each other entirely and are done. Names
with several contents go on: one run of each content is cut out and looked at with a longer gram, until the
gram is the window itself. Names are counted with partial sums, so a string that a third of all documents
share is a counter and never a group in one task; nothing is capped.

Defined cases: null counts as the empty text; texts under LENGTH bytes keep every byte; repeated rows are
copies of each other; documents are told apart by id and text; extra columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Slice, U, mix, powers, prefix_sums, release, settle, slices, span_hashes

LENGTH = 400
GRAMS = (96, 360, 400)
_RUN = "g long, u long, k1 long, k2 long, j long, n long, known boolean"


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w values in a row: running minima of blocks from both ends."""
    if w == 1:
        return v
    n = len(v) - w + 1
    padded = np.full(-(-len(v) // w) * w, ~U(0))
    padded[:len(v)] = v
    q = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(q, axis=1).ravel()
    back = np.minimum.accumulate(q[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def runs_in(s: Slice, gram: int, length: int = LENGTH):
    """Runs of a slice: name, content hash, owner, first window (in its text), windows, known to be repeated.

    In a run whose name stands at several places windows can equal one another. There only the first of
    equal windows stays in a run, and all of them are given out as rows that are known to be repeated.
    """
    n = len(s.buf) - length + 1
    if n <= 0:
        return None
    c = prefix_sums(s.buf)
    v = mix((c[gram:] - c[:-gram]) * powers(len(c))[1][:len(c) - gram])
    w = length - gram + 1
    name = _sliding_min(v, w)[:n]
    inside = np.zeros(n + 1, np.int64)
    lo, hi = s.at[:-1], s.at[1:] - length
    some = hi > lo
    np.add.at(inside, lo[some], 1)
    np.add.at(inside, hi[some], -1)
    ok = np.cumsum(inside)[:n] > 0
    new = np.ones(n, bool)
    new[1:] = (name[1:] != name[:-1]) | (ok[1:] != ok[:-1])
    new[lo[some]] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    first, last = first[ok[first]], last[ok[first]]
    g = name[first]
    multi = np.zeros(len(g), bool)
    look = np.arange(w)
    for k in range(0, len(g), 20_000):  # does the name stand at two places of the run?
        f, z, h = first[k:k + 20_000], last[k:k + 20_000], g[k:k + 20_000, None]
        left = f + (v[f[:, None] + look] == h).argmax(axis=1)
        right = z + w - 1 - (v[z[:, None] + look[::-1]] == h).argmax(axis=1)
        multi[k:k + 20_000] = left != right
    known = np.zeros(len(g), bool)
    if multi.any():
        f, z, h = first[multi], last[multi], g[multi]
        size = z - f + 1
        run = np.repeat(np.arange(len(f)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + f[run]
        key = mix(span_hashes(c, at, at + length) + run.astype(U) * U(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        later, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
        later[order[1:][same]] = True
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        keep = ~multi
        first, last, g, known = first[keep], last[keep], g[keep], known[keep]
        for flag, told in ((~later, False), (twice, True)):
            lo, hi = _stretches(flag, run)
            first, last, g = np.concatenate([first, at[lo]]), np.concatenate([last, at[hi - 1]]), np.concatenate([g, h[run[lo]]])
            known = np.concatenate([known, np.full(len(lo), told)])
    u = mix(span_hashes(c, first, last + length) + g)
    own = s.owner(first)
    return g, u, own, first - s.at[own], last - first + 1, known


def _stretches(flag: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of True that stay in one run."""
    edge = np.ones(len(flag) + 1, bool)
    edge[1:-1] = (flag[1:] != flag[:-1]) | (run[1:] != run[:-1])
    cut = np.flatnonzero(edge)
    on = flag[cut[:-1]]
    return cut[:-1][on], cut[1:][on]


def _batch(g, u, k1, k2, j, n, known) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(u.view(np.int64)), pa.array(k1), pa.array(k2), pa.array(j), pa.array(n.astype(np.int64)), pa.array(known)],
                                      ["g", "u", "k1", "k2", "j", "n", "known"])


def _text_runs(batches):
    for b in batches:
        k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
        for s in slices(b.column("t")):
            r = runs_in(s, GRAMS[0])
            if r is not None:
                g, u, own, j, n, known = r
                yield _batch(g, u, k1[s.lo + own], k2[s.lo + own], j, n, known)


def _byte_slices(parts: list[bytes], limit: int = 3_000_000):
    lo = 0
    while lo < len(parts):
        hi, size = lo, 0
        while hi < len(parts) and (hi == lo or size + len(parts[hi]) < limit):
            size += len(parts[hi]) + 1
            hi += 1
        at = np.concatenate(([0], np.cumsum([len(x) + 1 for x in parts[lo:hi]]))).astype(np.int64)
        yield Slice(lo, hi - lo, np.frombuffer(b"\n".join([*parts[lo:hi], b""]), np.uint8), at)
        lo = hi


def _region_runs(gram: int):
    def run(batches):
        for b in batches:
            k1, k2, base = (b.column(x).to_numpy() for x in ("k1", "k2", "j"))
            for s in _byte_slices(b.column("region").to_pylist()):
                r = runs_in(s, gram)
                if r is not None:
                    g, u, own, j, n, known = r
                    yield _batch(g, u, k1[s.lo + own], k2[s.lo + own], base[s.lo + own] + j, n, known)

    return run


def _cut_regions(batches):
    """The bytes of the runs that stay undecided, from the compressed texts."""
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        k1, k2, j, region = [], [], [], []
        for a, c, z, todo in zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("z").to_pylist(), b.column("todo").to_pylist(), strict=True):
            text = unpack.decompress(z)
            for x in todo:
                k1.append(a)
                k2.append(c)
                j.append(x["j"])
                region.append(text[x["j"]:x["j"] + x["n"] - 1 + LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(j, pa.int64()), pa.array(region, pa.binary())], ["k1", "k2", "j", "region"])


def _cut_again(batches):
    for b in batches:
        k1, k2, j, region = [], [], [], []
        for a, c, base, text, todo in zip(*(b.column(x).to_pylist() for x in ("k1", "k2", "base", "region", "todo")), strict=True):
            for x in todo:
                at = x["j"] - base
                k1.append(a)
                k2.append(c)
                j.append(x["j"])
                region.append(text[at:at + x["n"] - 1 + LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(j, pa.int64()), pa.array(region, pa.binary())], ["k1", "k2", "j", "region"])


def _packed(batches):
    pack = zstandard.ZstdCompressor(level=1)
    for b in batches:
        z = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in b.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(z, pa.binary())], ["doc_id", "k1", "k2", "z"])


def _decide(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Covered windows (k1, k2, j, n) and one run of each content of the undecided names.

    Names are counted first; `runs` is computed a second time rather than kept, since most names are unique.
    """
    often = runs.where("not known").groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g", F.lit(True).alias("often"))
    runs = settle(runs.join(often, "g", "left").where("often or known").drop("often"))
    release(runs.sparkSession)
    content = runs.where("not known").groupBy("g", "u").agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "j", "n")).alias("rep"))
    names = content.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1").select("g")
    twice = content.where("c > 1").select("g", "u")
    covered = runs.where("not known").join(twice, ["g", "u"]).select("k1", "k2", "j", "n").unionByName(runs.where("known").select("k1", "k2", "j", "n"))
    todo = content.join(names, "g").select("rep.k1", "rep.k2", "rep.j", "rep.n")
    return covered, todo


def covered_windows(docs: DataFrame) -> DataFrame:
    """Windows that occur at least twice, as rows k1, k2 (the document), j (first window), n (windows in a row)."""
    covered, todo = _decide(docs.where(F.octet_length("t") >= LENGTH).mapInArrow(_text_runs, _RUN))
    per_doc = todo.groupBy("k1", "k2").agg(F.collect_list(F.struct("j", "n")).alias("todo"))  # places of one document
    packed = docs.where(F.octet_length("t") >= LENGTH).select("doc_id", "k1", "k2", "t").mapInArrow(_packed, f"doc_id {dict(docs.dtypes)['doc_id']}, k1 long, k2 long, z binary")
    regions = settle(packed.join(per_doc, ["k1", "k2"]).mapInArrow(_cut_regions, "k1 long, k2 long, j long, region binary"))
    release(docs.sparkSession)
    out = covered
    for gram in GRAMS[1:-1]:
        covered, todo = _decide(regions.mapInArrow(_region_runs(gram), _RUN))
        out = out.unionByName(covered)
        # a run belongs to the region that holds it
        wider = regions.select("k1", "k2", F.col("j").alias("base"), "region")
        own = todo.join(wider.select("k1", "k2", "base", F.length("region").alias("size")), ["k1", "k2"]).where((F.col("j") >= F.col("base")) & (F.col("j") + F.col("n") - 1 + LENGTH <= F.col("base") + F.col("size")))
        own = own.groupBy("k1", "k2", "j", "n").agg(F.min("base").alias("base")).groupBy("k1", "k2", "base").agg(F.collect_list(F.struct("j", "n")).alias("todo"))
        regions = settle(wider.join(own, ["k1", "k2", "base"]).mapInArrow(_cut_again, "k1 long, k2 long, j long, region binary"))
    last = regions.mapInArrow(_region_runs(GRAMS[-1]), _RUN)
    last = settle(last.dropDuplicates(["k1", "k2", "j", "known"]))
    release(docs.sparkSession)
    often = last.where("not known").groupBy("g").agg(F.count("*").alias("windows")).where("windows > 1").select("g")
    return out.unionByName(last.join(often, "g").select("k1", "k2", "j", "n")).unionByName(last.where("known").select("k1", "k2", "j", "n"))


def _remove(batches):
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        size, removed, runs, kept, texts = [], [], [], [], []
        for z, spans in zip(b.column("z").to_pylist(), b.column("spans").to_pylist(), strict=True):
            text = unpack.decompress(z)
            merged: list[list[int]] = []
            for x in sorted((x["j"], x["j"] + x["n"] - 1 + LENGTH) for x in spans or ()):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append([*x])
            at, left = 0, []
            for lo, hi in merged:
                left.append(text[at:lo])
                at = hi
            rest = b"".join([*left, text[at:]])
            size.append(len(text))
            removed.append(len(text) - len(rest))
            runs.append(len(merged))
            kept.append(hashlib.sha256(rest).hexdigest())
            texts.append(rest)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.string()), pa.array(texts, pa.binary())],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = d.withColumns({"k1": F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "k2": F.xxhash64("t")}).select("doc_id", "k1", "k2", "t")
    spans = settle(covered_windows(d).groupBy("k1", "k2").agg(F.collect_list(F.struct("j", "n")).alias("spans")))  # places of one document
    release(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    packed = d.mapInArrow(_packed, f"doc_id {kind}, k1 long, k2 long, z binary")
    return packed.join(spans, ["k1", "k2"], "left").mapInArrow(_remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
