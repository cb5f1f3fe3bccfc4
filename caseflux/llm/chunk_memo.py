"""Texts as chunks that byte-pair tokenizers treat independently of one another, each tokenised once.

A cut is made before a blank that follows a character that is no white space. The splitting patterns of the
byte-level vocabularies end a match there, and no entry of the piece vocabulary has a blank behind another
character, so ids of a text are the ids of its chunks in a row. Byte-level patterns also end a match between
a letter and a stop or comma, where a cut makes far fewer chunks differ. A chunk is written without the blank
it starts with; one that starts with none is written as a 1-tuple, or as `_BARE` and itself.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np

REMEMBERED = 300_000  # chunks a worker keeps
KEPT_CHARS = 20  # characters of them, per chunk that may be kept; a full table is started anew
PART = 1_000_000  # characters handled at once; a longer text is handled in parts that end at a cut

_ODD = re.compile(r"\s |\s\Z")
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_STOP = re.compile(r"(?<=[a-zß-öø-ÿ])([.,])(?= |\Z)")
_BARE = "\x01"  # before a stop that was parted from its word


def chunks(text: str, stops: bool = False) -> list:
    """The chunks of a text, in order; with `stops` also stops and commas behind a letter are chunks."""
    if _BARE in text or _ODD.search(text):
        out = [c[1:] if c[:1] == " " and c[1:2] != _BARE else (c,) for c in _CUT.split(text)]
    elif stops:
        out = _STOP.sub(f" {_BARE}\\1", text).split(" ")
        if out[0]:
            out[0] = (out[0],)
        else:
            del out[0]
    else:
        out = text.split(" ")
        if out[0]:
            out[0] = (out[0],)
        else:
            del out[0]
    return out


def spelled(chunk) -> str:
    return chunk[0] if isinstance(chunk, tuple) else chunk[1:] if chunk[:1] == _BARE else " " + chunk


def parts(texts: list[str], size: int = PART, stops: bool = False) -> Iterator[tuple[list[int], list[list]]]:
    """Batches of (row, chunks) of about `size` characters; a long text comes in several parts of one row."""
    rows: list[int] = []
    held: list[list] = []
    n = 0
    for k, text in enumerate(texts):
        lo = 0
        while True:
            cut = _CUT.search(text, lo + size) if len(text) - lo > size else None
            hi = cut.start() if cut else len(text)
            rows.append(k)
            held.append(chunks(text[lo:hi], stops) if hi > lo else [])
            n += hi - lo
            if n >= size:
                yield rows, held
                rows, held, n = [], [], 0
            if cut is None:
                break
            lo = hi
    if rows:
        yield rows, held


class Ragged:
    """Arrays of different lengths, appended in batches and gathered by number."""

    def __init__(self, kind):
        self.kind = kind
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.pool = np.zeros(0, kind)

    def append(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.start = np.concatenate((self.start, len(self.pool) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.pool = np.concatenate((self.pool, flat.astype(self.kind)))

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays numbered `which` one after the other, and their lengths."""
        count = self.size[which]
        end = np.cumsum(count)
        total = int(end[-1]) if len(end) else 0
        return self.pool[np.arange(total) + np.repeat(self.start[which] - (end - count), count)], count


class Memo:
    """Numbers of chunks; chunks not seen yet are given to `learn` in one batch, in the order of their numbers."""

    def __init__(self, learn: Callable[[list], None], clear: Callable[[], None], remembered: int = REMEMBERED):
        self.learn, self.clear_values, self.remembered = learn, clear, remembered
        self.clear()

    def clear(self) -> None:
        self.at: dict = {}
        self.chars = 0
        self.clear_values()

    def numbers(self, keys: list) -> np.ndarray:
        if len(self.at) > self.remembered or self.chars > self.remembered * KEPT_CHARS:
            self.clear()
        which = np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(which < 0)
        if len(missing):
            new = list(dict.fromkeys(keys[k] for k in missing))
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
            self.chars += sum(len(spelled(c)) for c in new)
            self.learn(new)
            which[missing] = [self.at[keys[k]] for k in missing]
        return which
