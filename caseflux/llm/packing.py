"""Packing by powers of two: every document is split into binary-length pieces, each its own sequence.

A document of n tokens becomes n // 2048 pieces of 2048 and one piece for each binary digit of the rest,
longest first. A piece is a whole sequence of power-of-two length, so no sequence crosses documents and
none needs padding. Sequences are bucketed by length: ids run through the longest bucket first, so a
trainer draws batches of one length from a range of ids.

Token ids are made once, in Arrow batches. Blank-separated chunks of text are tokenised independently of
one another by these tokenizers, so each chunk's ids are remembered in a bounded table and texts are put
together from it with numpy.

Defined cases: a null or empty text has only the closing id and makes one piece of length 1; repeated rows
are packed each; a null doc_id is carried along; extra columns are ignored.
"""
from __future__ import annotations

import re
import string
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .chunk_memo import Memo, Ragged
from .common import settle

LONGEST = 2048
CLOSING = 1
REMEMBERED = 600_000  # chunks a worker keeps; a full table is started anew


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTER = _byte_letters()
_LETTER_CODES = np.array([32 if b == 32 else ord(_LETTER[b]) for b in range(256)], "<u4")  # blanks stay, they part words
_MARKS = string.punctuation
_MARK = re.compile(rf"([{re.escape(_MARKS)}])(?<=[^\W_].)")  # the mark first: the search then skips what is none


class ChunkTable:
    """Token ids of blank-free chunks of text.

    Plain texts are lower-cased and get a blank before a punctuation mark that follows a letter or digit:
    these tokenizers lower-case and split there anyway, and far fewer chunks differ. Arrow tells the chunks of
    a batch apart, so only its distinct ones are looked up. A chunk of letters is one word to the tokenizer, so
    its model is asked directly; every other chunk goes through all of it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ask = self.tokenizer.model.tokenize
        self.lowers = self._whole("QZ") == self._whole("qz")
        words = ("plain", "naïve", "straße", "слово")
        self.direct = self.lowers and self._words(list(words)) == [self._whole(w) for w in words]
        self.marks = all(self._whole(f"{w}{x}") == self._whole(f"{w} {x}") for w in ("ab", "é", "я7") for m in _MARKS for x in (m, m + "s", m + ".b"))
        self.memo = Memo(self._learn, self.clear, REMEMBERED)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _words(self, words: list[str]) -> list[list[int]]:
        joined = " ".join(words)
        if not joined.isascii():
            words = _LETTER_CODES[np.frombuffer(joined.encode(), np.uint8)].tobytes().decode("utf-32-le").split(" ")
        return [[t.id for t in self.ask(w)] for w in words]

    def clear(self) -> None:
        self.ids = Ragged(np.uint32)

    def _learn(self, chunks: list[str]) -> None:
        lows = [c.lower() for c in chunks]
        one = [self.direct and c.isalpha() and (c.isascii() or (w == c and unicodedata.is_normalized("NFC", c))) for c, w in zip(chunks, lows, strict=True)]
        words = iter(self._words([w for w, o in zip(lows, one, strict=True) if o]))
        others = (e.ids for e in self._encodings([c for c, o in zip(chunks, one, strict=True) if not o]))
        ids = [next(words if o else others) for o in one]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids.append(np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())), size)

    def _encodings(self, chunks: list[str]):
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for lo in range(0, len(chunks), 20_000):
            yield from encode(chunks[lo:lo + 20_000], add_special_tokens=False)

    def _plain(self, t: str) -> str:
        """The text with its chunks parted by single blanks."""
        if self.lowers and self.marks and (t.isascii() or ("Σ" not in t and "İ" not in t and unicodedata.is_normalized("NFC", t))) and "<|" not in t:
            t = _MARK.sub(r" \1", t.lower())
        return t.replace("\n", " ").replace("\t", " ").replace("\r", " ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and each text's number of ids."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lists = pc.split_pattern(pa.array([self._plain(t) for t in texts], pa.large_string()), " ")
        told = lists.flatten().dictionary_encode()
        number = self.memo.numbers(told.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, count = self.ids.gather(number[told.indices.to_numpy()])
        upto = np.concatenate(([0], np.cumsum(count)))[lists.offsets.to_numpy()]
        return ids, np.diff(upto)


@lru_cache(maxsize=1)
def chunk_table(path: str) -> ChunkTable:
    return ChunkTable(path)


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of a document of n tokens."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pieces(docs: DataFrame, tokenizer: str, longest: int = LONGEST, closing: int = CLOSING) -> DataFrame:
    """Per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens."""

    def cut(batches):
        table = chunk_table(tokenizer)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < 2_000_000):
                    size += len(texts[hi])
                    hi += 1
                ids, counts = table.encode(texts[lo:hi])
                row, start, length, raw, total = [], [], [], [], []
                at = 0
                for k, n in enumerate(counts.tolist()):
                    own = np.append(ids[at:at + n], np.uint32(closing)).astype("<u4")
                    at += n
                    s = 0
                    for m in binary_lengths(n + 1, longest):
                        row.append(lo + k)
                        start.append(s)
                        length.append(m)
                        raw.append(own[s:s + m].tobytes())
                        total.append(n + 1)
                        s += m
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(raw, pa.binary()), pa.array(total, pa.int64())],
                                                 ["doc_id", "start", "length", "ids", "doc_tokens"])
                lo = hi

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")


def bucket(cut: DataFrame) -> DataFrame:
    """Number the sequences: bucket after bucket, longest first.

    Rows are numbered inside (length, part) with parts by hash, and the parts' sizes, one row per part and
    length, give the offsets: no bucket passes through one task.
    """
    spark = cut.sparkSession
    split = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [c for c in cut.columns if c != "length"]
    cut = settle(cut.withColumn("_part", F.pmod(F.xxhash64(*own), F.lit(split)).cast("int")))
    sizes = cut.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    offset = sizes.select("length", "_part", (F.sum("_n").over(W.orderBy(F.desc("length"), "_part")) - F.col("_n")).alias("_from"))  # at most 12 x parts rows
    rank = F.row_number().over(W.partitionBy("length", "_part").orderBy(*own)) - 1
    return cut.withColumn("_rank", rank).join(offset, ["length", "_part"]).withColumn("sequence_id", F.col("_from") + F.col("_rank")).withColumn("offset", F.lit(0).cast("long")).drop("_part", "_rank", "_from")


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """All pieces with their ids, sequence and offset."""
    return bucket(pieces(docs, tokenizer))


def pack_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """As `pack`, with the checksum of the ids in place of the ids, so that no ids are moved."""
    cut = pieces(docs, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return bucket(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
