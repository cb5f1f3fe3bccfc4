"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (base64 bytes and rank per line) becomes a BPE model of the tokenizers library: each byte is
written as its printable letter, and a token's merges are all its splits into two tokens, in rank order, since
ranks merge two neighbours by the string they make, whatever its parts.
Texts are cut into chunks that cannot influence one another (`chunk_memo`), a chunk is tokenised once and
remembered in a bounded table, and the ids of texts are put together with numpy.

Offsets are characters: a token that starts or ends inside a character covers all of it. Decoding goes from
ids to bytes by the table, and to text by UTF-8; a character split over tokens belongs to the token that ends it.

Defined cases: null and empty texts have no tokens (digest of the empty string); repeated rows are encoded
each; a null doc_id is carried along; extra columns are ignored. Ids outside the table raise KeyError in `decode`.
"""
from __future__ import annotations

import base64
import codecs
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunk_memo import Memo, Ragged, parts, spelled
from .packing import _LETTER


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def letters(raw: bytes) -> str:
    """Bytes as the printable letters that stand for them."""
    return raw.decode("latin-1").translate(_LETTER)


def one_word(model, chunk: str) -> list[int] | None:
    """Ids of a chunk that is one match of the pattern, Latin letters with or without a blank, else None."""
    w = chunk[1:] if chunk[:1] == " " else chunk
    if not w.isalpha() or not (plain := w.isascii()) and max(w) > "ɏ":
        return None
    word = w if plain else letters(w.encode())
    return [t.id for t in model.tokenize(word if len(w) == len(chunk) else _LETTER[32] + word)]


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        top = max(self.token) + 1
        size = np.zeros(top, np.int64)
        size[list(self.token)] = [len(t) for t in self.token.values()]
        self.bytes = Ragged(np.uint8)
        self.bytes.append(np.frombuffer(b"".join(self.token.get(i, b"") for i in range(top)), np.uint8), size)
        self.decimal = [str(i) for i in range(top)]
        vocab = {letters(t): i for t, i in ranks.items()}
        merges = [(letters(t[:k]), letters(t[k:])) for t in sorted(ranks, key=ranks.get) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.model = models.BPE(vocab=vocab, merges=merges, ignore_merges=True)
        self.tokenizer = Tokenizer(self.model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.memo = Memo(self._learn, self._clear, 600_000)

    def _clear(self) -> None:
        self.ids = Ragged(np.int32)

    def _learn(self, new: list) -> None:
        texts = [spelled(c) for c in new]
        ids: list = [one_word(self.model, t) for t in texts]
        rest = [k for k, i in enumerate(ids) if i is None]
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for lo in range(0, len(rest), 5_000):
            for k, e in zip(rest[lo:lo + 5_000], encode([texts[k] for k in rest[lo:lo + 5_000]], add_special_tokens=False), strict=True):
                ids[k] = e.ids
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids.append(np.fromiter((i for x in ids for i in x), np.int32, int(size.sum())), size)

    def encode(self, texts: list[str]):
        """Yields (rows, ids of their parts one after the other, number of ids per part); long texts have several parts."""
        for rows, held in parts(texts, stops=True):
            which = self.memo.numbers([c for x in held for c in x])
            ids, count = self.ids.gather(which)
            upto = np.concatenate(([0], np.cumsum(count)))
            ends = np.cumsum([len(x) for x in held])
            yield rows, ids, np.diff(np.concatenate(([0], upto[ends])))

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids one after the other, and the number of bytes per id."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.decimal) or not self.bytes.size[ids].all()):
            raise KeyError("an id outside the table")
        return self.bytes.gather(ids)


@lru_cache(maxsize=1)
def loaded(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def char_spans(raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end character of each token of a text given as bytes and bytes per token."""
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    end = np.cumsum(size)
    return char[end - size], char[end - 1] + 1


def spoken(raw: bytes, size: np.ndarray) -> list[str]:
    """What each token adds to the text; a split character is added by the token that ends it, a broken one is U+FFFD."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    out, at = [], 0
    for n in size.tolist():
        out.append(decoder.decode(raw[at:at + n]))
        at += n
    if out:
        out[-1] += decoder.decode(b"", True)
    return out


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, ids, first and past-the-end character of each token."""

    def run(batches):
        bpe = loaded(path, pattern)
        for b in batches:
            texts = _texts(b)
            done: dict[int, list] = {}
            for rows, ids, n in bpe.encode(texts):
                raw, size = bpe.decode(ids)
                lo = at = 0
                for row, k in zip(rows, n.tolist(), strict=True):
                    w = int(size[lo:lo + k].sum())
                    held = done.setdefault(row, [0, [], [], []])
                    if k:
                        first, end = char_spans(raw[at:at + w], size[lo:lo + k])
                        for x, y in zip(held[1:], (ids[lo:lo + k], first + held[0], end + held[0]), strict=True):
                            x.append(y)
                        held[0] += int(end[-1])
                    lo, at = lo + k, at + w
                ready = [r for r in done if r != rows[-1]]  # the last row may go on in the next part
                if ready:
                    yield _arrays(b, ready, done)
            if done:
                yield _arrays(b, list(done), done)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, first array<int>, past array<int>")


def _arrays(b: pa.RecordBatch, rows: list[int], done: dict) -> pa.RecordBatch:
    held = [done.pop(r) for r in rows]
    size = np.array([sum(map(len, h[1])) for h in held])
    offsets = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
    flat = [np.concatenate([np.zeros(0, np.int32), *[y for h in held for y in h[k]]]).astype(np.int32) for k in (1, 2, 3)]
    return pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(rows, pa.int64())), *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in flat]], ["doc_id", "ids", "first", "past"])


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of (doc_id, ids): doc_id, raw bytes, text, pieces (what each token adds), n_split (tokens that end inside a character)."""

    def run(batches):
        bpe = loaded(path, pattern)
        for b in batches:
            for k, ids in enumerate(b.column("ids")):
                ids = np.array(ids.values if ids.is_valid else [], np.int64)
                raw, size = bpe.decode(ids)
                word = raw.tobytes()
                inside = np.concatenate(((raw & 0xC0) == 0x80, [False]))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(k, 1), pa.array([word], pa.binary()), pa.array([word.decode("utf-8", "replace")]), pa.array([spoken(word, size)], pa.list_(pa.string())), pa.array([int(inside[np.cumsum(size)].sum())], pa.int64())],
                                                 ["doc_id", "raw", "text", "pieces", "n_split"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, raw binary, text string, pieces array<string>, n_split long")


def encode_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of the decimal ids and of the bytes decoded from the ids; memory is bounded for texts of any length."""

    def run(batches):
        bpe = loaded(path, pattern)
        for b in batches:
            n_tokens = [0] * b.num_rows
            said = [hashlib.sha256() for _ in n_tokens]
            back = [hashlib.sha256() for _ in n_tokens]
            for rows, ids, n in bpe.encode(_texts(b)):
                raw, size = bpe.decode(ids)
                raw = raw.tobytes()
                words = list(map(bpe.decimal.__getitem__, ids.tolist()))
                cut = np.concatenate(([0], np.cumsum(size)))[np.cumsum(n)].tolist()
                lo = at = 0
                for row, k, hi in zip(rows, n.tolist(), cut, strict=True):
                    if k:
                        said[row].update((("," if n_tokens[row] else "") + ",".join(words[lo:lo + k])).encode())
                        back[row].update(raw[at:hi])
                        n_tokens[row] += k
                    lo, at = lo + k, hi
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array([h.hexdigest() for h in said]), pa.array([h.hexdigest() for h in back])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
