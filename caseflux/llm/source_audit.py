"""Divergence of sources: how differently the sources of a language use its terms.

Each task sorts pointers to the word starts of its texts, inside the Arrow buffers: a multikey quicksort over
eight bytes at a time, where only slices of equal words so far go eight bytes deeper, and all slices of one
depth are partitioned by one call. Pointers start in order of group and document, so equal runs fall into
parts of one (lang, source), and give a term's occurrences and its documents there without any set.
Runs are added up by (lang, source, term); documents per (lang, term) decide which terms a language keeps.

Shares are whole numbers of billionths (`share`), computed with decimals, so every result is exact. The distance
of two sources is the sum over all kept terms of the difference of their shares. Most terms are absent from most
sources, where the share is one number per source: terms are dealt into blocks by hash, a block has the counts
of at most two tiles of sources as small dense matrices, and gives partial sums per pair of sources.

Defined cases: null text, lang and source are the empty string; a group without terms has count 0 everywhere; a
language without kept terms has distance 0 between its sources and no term rows; repeated rows are documents
of their own; ties go by item; extra columns are ignored; texts of any length stay whole.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle

LEAST_DOCS = 30
TOP = 50
SCALE, PRIOR = 1_000_000_000, 5
SHARD = 8_000_000  # bytes of text whose pointers are sorted together; a longer text is a shard of its own
TILE = 128  # sources side by side in a block
BLOCK = 16_384  # terms of a block, about


def _term_bytes() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return t


_TERM = _term_bytes()


# --- sorted pointers -----------------------------------------------------------------------------
def word_starts(buf: np.ndarray, text_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the terms of texts that lie side by side; text i is buf[text_at[i]:text_at[i+1]]."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = _TERM[buf]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edge = np.unique(text_at[(text_at > 0) & (text_at < len(buf))])
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1 - start


def sort_pointers(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by their terms (stable), and where a new term begins in that order."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(buf) + 1, ">u8", padded, strides=(1,))
    order = np.arange(len(start))
    head = np.zeros(len(start), bool)
    head[:1] = True
    active = order.copy()
    depth = 0
    while len(active):
        p = order[active]
        left = np.minimum(length[p] - depth, 8)
        gone = ((8 - np.maximum(left, 1)) * 8).astype(np.uint64)
        key = eight[np.minimum(start[p] + depth, len(buf))].astype(np.uint64) >> gone << gone
        key[left <= 0] = 0
        part = np.cumsum(head[active])  # the slice each pointer is in
        o = np.argsort(key, kind="stable") if part[-1] == 1 else np.lexsort((key, part))
        order[active], key = p[o], key[o]
        new = head[active]
        new[1:] |= key[1:] != key[:-1]
        head[active] = new
        run = np.cumsum(new) - 1
        deeper = (np.bincount(run)[run] > 1) & (key & np.uint64(255) != 0)  # several pointers, and the words may go on
        active = active[deeper]
        depth += 8
    return order, head


def _shards(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of about SHARD bytes, their bytes and where each text begins, straight from the Arrow buffer."""
    text = pc.fill_null(b.column("text"), "").cast(pa.large_string())
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SHARD, side="right")) - 1)
        yield b.slice(lo, hi - lo), raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def _runs(b: pa.RecordBatch, buf: np.ndarray, text_at: np.ndarray) -> pa.RecordBatch:
    """Per (lang, source, term) of a shard: occurrences and documents."""
    lang, source = (pc.fill_null(b.column(c), "").dictionary_encode() for c in ("lang", "source"))
    n = len(source.dictionary)
    group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + source.indices.to_numpy(zero_copy_only=False)
    start, length = word_starts(buf, text_at)
    doc = np.searchsorted(text_at, start, side="right") - 1
    first = np.argsort(group[doc], kind="stable")  # group, then document, then place
    start, length, doc = start[first], length[first], doc[first]
    lower = np.where((buf >= 0x41) & (buf <= 0x5A), buf | 0x20, buf).astype(np.uint8)
    order, head = sort_pointers(lower, start, length)
    doc = doc[order]
    g = group[doc]
    new = head.copy()
    new[1:] |= g[1:] != g[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(order)))
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    docs = np.add.reduceat(fresh.astype(np.int64), at) if len(at) else at
    s, w = start[order[at]], length[order[at]]
    end = np.cumsum(w)
    body = lower[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(s - (end - w), w)]
    term = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.concatenate(([0], end)).astype(np.int64)), pa.py_buffer(body)).cast(pa.string())
    of = g[at]
    return pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(of // n)), source.dictionary.take(pa.array(of % n)), term, pa.array(count, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def term_runs(docs: DataFrame) -> DataFrame:
    """Per shard of texts and (lang, source, term): occurrences n and documents docs."""

    def run(batches):
        for b in batches:
            for shard in _shards(b):
                yield _runs(*shard)

    return docs.select("text", "lang", "source").mapInArrow(run, "lang string, source string, term string, n long, docs long")


# --- shares and distances ------------------------------------------------------------------------
def share(n: Column | str, total: Column | str, kept: Column | str) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * kept)), exact; null for a language that keeps no term."""
    n, total, kept = (F.col(c) if isinstance(c, str) else c for c in (n, total, kept))
    top = (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + F.lit(PRIOR) * kept).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, F.nullif(bottom, F.lit(0).cast("decimal(20,0)")))


def _tiled_sums(counts: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """Per ordered pair of sources of a language: the sum of share differences over the terms of either's tile, and their number.

    `counts` has (lang, source, term, n), `groups` (lang, source, total, kept, tile). Every block of terms and
    pair of tiles is one small group: its terms' counts in at most two tiles, and the tiles' sources. A language
    has as many blocks as its kept terms need, so partial sums grow with the vocabulary, not with the cluster.
    """
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))  # one row per language
    pairs_of = F.expr("transform(sequence(0, tiles - 1), j -> struct(least(tile, j) AS lo, greatest(tile, j) AS hi))")
    spread = groups.join(tiles, "lang").select("lang", "source", "total", "kept", "tile", F.explode(pairs_of).alias("x")).select("lang", "source", "total", "kept", "tile", "x.lo", "x.hi")
    of = F.pmod(F.xxhash64("term"), F.ceil(F.col("kept") / block)).cast("int")
    cells = counts.join(spread.select("lang", "source", "lo", "hi", "kept"), ["lang", "source"]).select("lang", "lo", "hi", of.alias("block"), "source", "term", "n")
    used = cells.select("lang", "lo", "hi", "block").distinct()
    frame = used.join(spread, ["lang", "lo", "hi"]).select(F.col("lang").alias("l"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("block").alias("b2"), "source", "total", "kept", "tile")

    def add(cells: pa.Table, frame: pa.Table) -> pa.Table:
        place = pc.sort_indices(frame, [("tile", "ascending"), ("source", "ascending")])
        frame = frame.take(place)
        names = frame["source"].combine_chunks()
        tile_of = frame["tile"].to_numpy()
        bottom = frame["total"].to_numpy() + PRIOR * frame["kept"].to_numpy()
        zero = _share(np.zeros(len(bottom), np.int64), bottom)
        row = pc.index_in(cells["source"].combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
        term = cells["term"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = cells["n"].to_numpy()
        order = np.argsort(term, kind="stable")
        row, term, n = row[order], term[order], n[order]
        width = int(term[-1]) + 1 if len(term) else 0
        lo_rows, hi_rows = np.flatnonzero(tile_of == tile_of[0]), np.flatnonzero(tile_of == tile_of[-1])
        sums = np.zeros((len(lo_rows), len(hi_rows)), np.int64)
        step = max(1, 2_000_000 // max(1, len(names)))  # terms per dense matrix
        for at in range(0, width, step):
            a, b = np.searchsorted(term, [at, at + step])
            p = np.repeat(zero[:, None], min(step, width - at), axis=1)
            p[row[a:b], term[a:b] - at] = _share(n[a:b], bottom[row[a:b]])
            for k, r in enumerate(lo_rows):
                sums[k] += np.abs(p[hi_rows] - p[r]).sum(axis=1)
        i, j = np.repeat(lo_rows, len(hi_rows)), np.tile(hi_rows, len(lo_rows))
        v = sums.ravel()
        keep = i != j
        i, j, v = i[keep], j[keep], v[keep]
        if len(lo_rows) and tile_of[0] != tile_of[-1]:  # two tiles: both directions
            i, j, v = np.concatenate((i, j)), np.concatenate((j, i)), np.concatenate((v, v))
        lang = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(i), np.int32)), frame["l"].combine_chunks().slice(0, 1)).cast(pa.string())
        return pa.table([lang, names.take(pa.array(i)), names.take(pa.array(j)), pa.array(v, pa.int64()), pa.array(np.full(len(i), width), pa.int64())], ["lang", "source", "item", "value", "terms"])

    key = ["lang", "lo", "hi", "block"]
    got = cells.groupBy(*key).cogroup(frame.groupBy("l", "lo2", "hi2", "b2")).applyInArrow(add, "lang string, source string, item string, value long, terms long")
    return got.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def _share(n: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """`share` in numpy; counts too large for 64 bits are divided as Python numbers."""
    if len(n) and int(n.max()) + PRIOR > (2**63 - 1) // SCALE:
        return np.array([1 + SCALE * (int(x) + PRIOR) // int(y) for x, y in zip(n, bottom, strict=True)], np.int64)
    return 1 + SCALE * (n + PRIOR) // np.maximum(bottom, 1)


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Per (lang, source): every other source of the language by distance (part `pair`), and the terms the
    source uses more than its language does (part `term`, ranks to `top`): lang, source, part, item, value, rank."""
    runs = term_runs(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")  # at most one row per source
    counts = settle(runs.withColumn("spread", F.sum("docs").over(term)).withColumn("all", F.sum("n").over(term)).where(F.col("spread") >= least).select("lang", "source", "term", "n", "all"))
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang", "term").agg(F.first("all").alias("all")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("whole"))
    order = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1  # one row per group of the corpus
    groups = named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kept", "whole"])
    groups = settle(groups.withColumn("tile", F.floor(order / tile).cast("int")))
    sums = _tiled_sums(counts, groups.where("kept > 0"), block)
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("other"))
    grid = groups.join(other, "lang").where("source != item")  # the rows asked for, one per pair of sources
    apart = F.abs(share(F.lit(0), "total", "kept") - share(F.lit(0), "other", "kept"))  # at every term both lack
    value = F.coalesce(F.col("value") + (F.col("kept") - F.col("terms")) * apart, F.col("kept") * apart, F.lit(0)).cast("long")
    pairs = grid.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", value.alias("value"))
    mine = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pair_rows = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(mine).alias("rank"))
    p, q = share("n", "total", "kept"), share("all", "whole", "kept")
    terms = counts.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    term_rows = terms.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pair_rows.unionByName(term_rows)
