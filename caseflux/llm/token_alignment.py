"""Alignment of two tokenizers: token-byte incidence matrices in CSR form and their products.

Of each chunk of text (`chunk_memo`; both tokenizers end a token at its ends) the tokens of tokenizer A and of
tokenizer B are rows of two incidence matrices over the same byte columns. The product A.B^T, row by row after
Gustavson, has an entry where two tokens overlap; its value is the number of shared bytes. Bytes where both end
a token cut tokens into groups; the product of the token-group incidences links tokens of one group, and its
symbolic step alone counts them, so a group of any size is counted without its pairs.

Chunks are aligned once and remembered in a bounded table. Counts of id pairs over the corpus take two steps:
documents are dealt into blocks of about `BLOCK` characters, a block names each of its id pairs once with its
number of documents, the counts are added up by pair, and come back to each block that named the pair. So one
row per block and pair is shuffled, a pair that is in every document has one row per block, and nothing is
broadcast. Documents' own pairs wait as numbers into their block's list, compressed, in the shared folder.

Defined cases: null and empty texts and texts that either tokenizer does not give back byte by byte have no
tokens (zeros and an empty groups digest); repeated rows are documents of their own; a null doc_id is carried
along; extra columns are ignored; texts of any length are handled in parts.
"""
from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import one_word
from .chunk_memo import Memo, Ragged, parts, spelled
from .common import settle
from .packing import _LETTER

BLOCK = 4_000_000  # characters of text whose id pairs are named together; a longer text is a block of its own
_SHIFT = 32  # an id pair is a << 32 | b
_LETTER_STOP = re.compile(r"[a-zß-öø-ÿ][.,]")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


# --- sparse products ---------------------------------------------------------------------------
@dataclass
class CSR:
    """A sparse matrix by rows: row i has the columns col[ptr[i]:ptr[i+1]] with the values val there."""

    ptr: np.ndarray
    col: np.ndarray
    val: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def incidence(ends: np.ndarray, width: int) -> CSR:
    """Rows that cover the columns one after the other, row i up to ends[i]."""
    return CSR(np.concatenate(([0], ends)), np.arange(width), np.ones(width, np.int64), width)


def transpose(m: CSR) -> CSR:
    order = np.argsort(m.col, kind="stable")
    return CSR(np.concatenate(([0], np.cumsum(np.bincount(m.col, minlength=m.width)))), m.rows[order], m.val[order], len(m.ptr) - 1)


def row_sizes(a: CSR, b: CSR) -> np.ndarray:
    """Symbolic step of the product of matrices whose rows meet each column once: entries per row."""
    c = np.concatenate(([0], np.cumsum(np.diff(b.ptr)[a.col])))
    return c[a.ptr[1:]] - c[a.ptr[:-1]]


def product(a: CSR, b: CSR) -> CSR:
    """a.b after Gustavson: row i of the result adds up the rows of b that row i of a names."""
    count = np.diff(b.ptr)[a.col]
    end = np.cumsum(count)
    take = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(b.ptr[a.col] - (end - count), count)
    key = np.repeat(a.rows, count) * b.width + b.col[take]
    val = np.repeat(a.val, count) * b.val[take]
    if np.any(key[1:] < key[:-1]):
        order = np.argsort(key, kind="stable")
        key, val = key[order], val[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    key, val = key[first], np.add.reduceat(val, first) if len(first) else val
    row = key // b.width if b.width else key
    return CSR(np.searchsorted(row, np.arange(len(a.ptr))), key - row * b.width, val, b.width)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, width: int) -> CSR:
    """A tokens x B tokens: bytes both cover."""
    return product(incidence(a_ends, width), transpose(incidence(b_ends, width)))


def group_incidence(ends: np.ndarray, common: np.ndarray) -> CSR:
    """Tokens x groups: the group each token lies in, groups ending at the common ends."""
    return CSR(np.arange(len(ends) + 1), np.searchsorted(common, ends), np.ones(len(ends), np.int64), len(common))


def shared_group(a_ends: np.ndarray, b_ends: np.ndarray, common: np.ndarray) -> tuple[CSR, CSR]:
    """The two factors of the shared-group links: tokens of A x groups, groups x tokens of B."""
    return group_incidence(a_ends, common), transpose(group_incidence(b_ends, common))


# --- the two tokenizers over chunks --------------------------------------------------------------
def _table(raw: list[bytes]) -> Ragged:
    """The bytes of each id."""
    out = Ragged(np.uint8)
    out.append(np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw], np.int64))
    return out


class ByteLetters:
    """A: a byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = {c: b for b, c in _LETTER.items()}
        raw = [b""] * self.tokenizer.get_vocab_size()
        for word, i in self.tokenizer.get_vocab().items():
            raw[i] = bytes(byte[c] for c in word) if all(c in byte for c in word) else word.encode()
        self.bytes = _table(raw)

    def ids(self, chunks: list[str]) -> list[list[int]]:
        model = self.tokenizer.model
        out: list = [one_word(model, c) for c in chunks]
        rest = [k for k, i in enumerate(out) if i is None]
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for k, e in zip(rest, encode([chunks[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = e.ids
        return out


class BytePieces:
    """B: a piece vocabulary that writes a blank as U+2581 and unknown bytes as <0xHH>, and adds the first blank."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = _table([bytes([int(m[1], 16)]) if self.model.is_byte(i) and (m := _BYTE_PIECE.match(p)) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.stops = not any(_LETTER_STOP.search(p) for p in pieces)  # no piece joins a letter and a stop: a cut between them is exact
        self.stem = len(self.model.encode("a"))

    def ids(self, chunks: list[str]) -> list[list[int]]:
        out = self.model.encode([c[1:] if c[:1] == " " else "a" + c for c in chunks], num_threads=1)
        return [i if c[:1] == " " else i[self.stem:] for c, i in zip(chunks, out, strict=True)]


class Aligner:
    """Alignments of chunks, remembered: ids, groups as text, overlapping id pairs."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLetters(a_path), BytePieces(b_path)
        self.top = max(len(self.a.bytes.size), len(self.b.bytes.size))
        decimal = list(map(str, range(self.top)))
        self.said = [d + mark for mark in ",|;" for d in decimal]
        self.said_size = np.array([len(d) + 1 for d in decimal])
        self.memo = Memo(self._learn, self._clear, 400_000)

    def _clear(self) -> None:
        self.links = Ragged(np.int64)
        self.groups: list[str | None] = []  # None: one tokenizer does not give the chunk back
        self.counts: list[np.ndarray] = []  # tokens of A, of B, groups, shared-group links
        self.frozen = None

    def tokens(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B of all chunks in a row, tokens of A and B per chunk, and the chunks both give back byte by byte.
        The ids of the other chunks are left out."""
        raw = [c.encode() for c in chunks]
        width = np.fromiter(map(len, raw), np.int64, len(raw))
        flat, count = [], []
        ok = np.ones(len(raw), bool)
        for side in (self.a, self.b):
            ids = side.ids(chunks)
            count.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int64, int(count[-1].sum())))
            ok &= _sums(side.bytes.size[flat[-1]], count[-1]) == width
        want = np.frombuffer(b"".join(raw), np.uint8)
        for side, ids, n in zip((self.a, self.b), flat, count, strict=True):  # of equal length, so bytes lie side by side
            got, _ = side.bytes.gather(ids[np.repeat(ok, n)])
            ok[ok] = _sums(got != want[np.repeat(ok, width)], width[ok]) == 0
        kept = [ids[np.repeat(ok, n)] for ids, n in zip(flat, count, strict=True)]
        return *kept, *(np.where(ok, n, 0) for n in count), ok

    def _learn(self, new: list) -> None:
        flat_a, flat_b, n_a, n_b, ok = self.tokens([spelled(c) for c in new])
        ends_a, ends_b = np.cumsum(self.a.bytes.size[flat_a]), np.cumsum(self.b.bytes.size[flat_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        link = overlaps(ends_a, ends_b, int(ends_a[-1]) if len(ends_a) else 0)
        group_a, group_b = shared_group(ends_a, ends_b, common)
        last_a = np.cumsum(n_a)  # tokens of A up to each chunk's end
        upto = np.concatenate(([0], group_a.col + 1))[last_a]
        shared = np.concatenate(([0], np.cumsum(row_sizes(group_a, group_b))))[last_a]
        self.counts.append(np.stack((n_a, n_b, np.diff(upto, prepend=0), np.diff(shared, prepend=0))))
        self.frozen = None
        self.links.append((flat_a[link.rows] << _SHIFT) | flat_b[link.col], np.diff(link.ptr[last_a], prepend=0))
        # tokens group by group, those of A before those of B, each with the mark that follows it
        group = np.concatenate((group_a.col, np.repeat(np.arange(len(common)), np.diff(group_b.ptr))))
        side = np.repeat([0, 1], [len(flat_a), len(flat_b)])
        order = np.argsort(group * 2 + side, kind="stable")
        ids, group, side = np.concatenate((flat_a, flat_b))[order], group[order], side[order]
        last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[: len(ids)]
        mark = np.where(last, side + 1, 0)
        said = "".join(map(self.said.__getitem__, (mark * self.top + ids).tolist()))
        size = np.cumsum(self.said_size[ids])
        hi = np.concatenate(([0], size))[np.cumsum(n_a + n_b)].tolist()  # a chunk's groups are its own
        self.groups.extend(said[lo:max(lo, up - 1)] if o else None for lo, up, o in zip([0, *hi], hi, ok.tolist(), strict=False))

    def count_of(self, which: np.ndarray) -> np.ndarray:
        """Tokens of A, of B, groups and shared-group links of the chunks together."""
        if self.frozen is None:
            self.frozen = np.concatenate(self.counts, axis=1)
            self.counts = [self.frozen]
        return self.frozen[:, which].sum(axis=1)


def _sums(x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of x."""
    c = np.concatenate(([0], np.cumsum(x)))
    end = np.cumsum(count)
    return c[end] - c[end - count]


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _texts(batch: pa.RecordBatch) -> list[str]:
    """Space + text; a null or empty text stays empty."""
    return [" " + t if t else "" for t in batch.column("text").to_pylist()]


def _packed(number: np.ndarray, times: np.ndarray) -> bytes:
    """Rising numbers and their times, as differences, byte planes apart, compressed."""
    both = np.concatenate((np.diff(number, prepend=0), times)).astype("<u4")
    return pa.compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True) if len(number) else b""


def _unpacked(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)
    return np.cumsum(both[:n]), both[n:]


class _Block:
    """Documents of a block: their counts and digests, and their id pairs as (document, pair, times) in sorted runs."""

    def __init__(self):
        self.rows: list[int] = []
        self.pairs: list[list[tuple[np.ndarray, np.ndarray]]] = []
        self.count: list[np.ndarray] = []
        self.said: list = []
        self.bad: list[bool] = []
        self.chars = 0

    def open(self, row: int) -> None:
        self.rows.append(row)
        self.pairs.append([])
        self.count.append(np.zeros(5, np.int64))
        self.said.append(hashlib.sha256())
        self.bad.append(False)

    def close(self) -> tuple[list, np.ndarray, np.ndarray]:
        """Rows' columns, the block's pairs and how many of its documents hold each."""
        merged = []
        for k, runs in enumerate(self.pairs):
            if self.bad[k] or not runs:
                self.count[k][:] = 0
                merged.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
                continue
            pair, where = np.unique(np.concatenate([p for p, _ in runs]), return_inverse=True)
            merged.append((pair, np.bincount(where, np.concatenate([t for _, t in runs]), len(pair)).astype(np.int64)))
        every = [p for p, _ in merged if len(p)]
        pair, where, docs = np.unique(np.concatenate(every), return_inverse=True, return_counts=True) if every else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        out, lo = [], 0
        for k, (own, times) in enumerate(merged):
            number = where[lo:lo + len(own)]
            lo += len(own)
            out.append((self.rows[k], *self.count[k].tolist(), self.said[k].hexdigest() if len(own) else "", len(own), _packed(number, times)))
        return out, pair, docs


def _block_rows(docs: DataFrame, a_path: str, b_path: str, block: int) -> DataFrame:
    """One row per document (what its block must know of it) and one per block (its pairs and their document counts)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        from pyspark import TaskContext

        al = aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 32  # a block's number is unique inside the one job that settles it
        for b in batches:
            held = _Block()
            for rows, chunked in parts(_texts(b), stops=al.b.stops):
                which = al.memo.numbers([c for x in chunked for c in x])
                ends = np.cumsum([len(x) for x in chunked])
                pairs, n_links = al.links.gather(which)
                cut = np.concatenate(([0], np.cumsum(n_links)))[np.concatenate(([0], ends))]
                doc = np.repeat(np.arange(len(rows)), np.diff(cut))
                order = np.lexsort((pairs, doc))  # each text's own pairs, counted
                p, d = pairs[order], doc[order]
                first = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (d[1:] != d[:-1])))) if len(p) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(p)))
                run_at = np.searchsorted(d[first], np.arange(len(rows) + 1))
                p = p[first]
                lo = 0
                for k, row in enumerate(rows):
                    if not held.rows or held.rows[-1] != row:
                        if held.chars >= block:
                            yield from _emit(b, held, number)
                            number += 1
                            held = _Block()
                        held.open(row)
                    hi = int(ends[k])
                    mine = which[lo:hi]
                    if hi > lo:
                        said = [al.groups[x] for x in mine.tolist()]
                        if None in said:
                            held.bad[-1] = True
                        else:
                            first_part = not held.pairs[-1]
                            held.said[-1].update((("" if first_part else ";") + ";".join(said)).encode())
                            held.count[-1] += np.append(al.count_of(mine), n_links[lo:hi].sum())
                            held.pairs[-1].append((p[run_at[k]:run_at[k + 1]], times[run_at[k]:run_at[k + 1]]))
                            if len(held.pairs[-1]) > 8:  # a long text: its parts' pairs are merged on the way
                                pair, at = np.unique(np.concatenate([x for x, _ in held.pairs[-1]]), return_inverse=True)
                                held.pairs[-1] = [(pair, np.bincount(at, np.concatenate([t for _, t in held.pairs[-1]]), len(pair)).astype(np.int64))]
                        held.chars += sum(map(len, chunked[k]))
                    lo = hi
            if held.rows:
                yield from _emit(b, held, number)
                number += 1

    def _emit(b, held, number):
        out, pair, docs_with = held.close()
        cols = list(zip(*out, strict=True))
        n = len(out)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number] * n, pa.int64()), b.column("doc_id").take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int64()) for c in cols[1:6]], pa.array(cols[6], pa.string()), pa.array(cols[7], pa.int32()), pa.array(cols[8], pa.binary()), pa.array([None] * n, pa.list_(pa.int64())), pa.array([None] * n, pa.list_(pa.int32()))], NAMES)
        whole = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t)) for x, t in ((pair, pa.int64()), (docs_with, pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.nulls(1, b.column("doc_id").type), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), *whole], NAMES)

    schema = f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_shared long, n_links long, groups_sha256 string, n_own int, own binary, pairs array<long>, docs array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_shared", "n_links", "groups_sha256", "n_own", "own", "pairs", "docs"]


def pair_counts(named: DataFrame) -> DataFrame:
    """Per id pair of the corpus: pair, n (documents that hold it), best (no pair of its A id has more)."""
    n = named.groupBy("pair").agg(F.sum("docs").alias("n"))
    top = n.groupBy(F.shiftright("pair", _SHIFT).alias("a")).agg(F.max("n").alias("most"))  # at most one row per id of A
    return n.withColumn("a", F.shiftright("pair", _SHIFT)).join(top, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared (links inside groups)."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = settle(_block_rows(docs, a_path, b_path, block))
    named = rows.where("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.docs").cast("long").alias("docs"))
    known = named.select(F.col("block").alias("_b"), "pair").join(pair_counts(named), "pair")
    own = rows.where("pairs is null").drop("pairs", "docs").withColumnRenamed("block", "_block")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pair"].to_numpy())  # numbers of a block are places in its sorted pairs
        n, best = right["n"].to_numpy()[order], right["best"].to_numpy()[order]
        n_best, total = [], []
        for raw, size in zip(left["own"], left["n_own"].to_pylist(), strict=True):
            number, times = _unpacked(raw.as_py(), size)
            n_best.append(int(times[best[number]].sum()))
            total.append(int((times * n[number]).sum()))
        return pa.table([*[left[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), left["groups_sha256"], left["n_shared"]],
                        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"])

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long"
    return own.groupBy("_block").cogroup(known.groupBy("_b")).applyInArrow(look_up, schema)


def link_rows(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The overlap links themselves: doc_id, index and id of the A token, index and id of the B token, shared bytes."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        al = aligner(a_path, b_path)
        for b in batches:
            texts = _texts(b)
            whole = {row: True for row in range(len(texts))}
            for rows, chunked in parts(texts, stops=al.b.stops):  # a text is judged before its links are given
                for row, x in zip(rows, chunked, strict=True):
                    whole[row] &= all(al.groups[k] is not None for k in al.memo.numbers(x).tolist())
            at = {row: (0, 0) for row in whole}
            for rows, chunked in parts(texts, stops=al.b.stops):
                for row, x in zip(rows, chunked, strict=True):
                    if not (whole[row] and x):
                        continue
                    a, c, *_ = al.tokens([spelled(k) for k in x])
                    ends = [np.cumsum(s.bytes.size[t]) for s, t in ((al.a, a), (al.b, c))]
                    m = overlaps(*ends, int(ends[0][-1]))
                    i, j = at[row]
                    at[row] = (i + len(a), j + len(c))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(np.full(len(m.col), row))), *[pa.array(v, pa.int64()) for v in (m.rows + i, a[m.rows], m.col + j, c[m.col], m.val)]], ["doc_id", "a_index", "a", "b_index", "b", "bytes"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, a_index long, a long, b_index long, b long, bytes long")
