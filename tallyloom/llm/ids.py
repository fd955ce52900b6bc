"""Ids of whole texts, a batch at a time: safe cuts, each different piece encoded once, the ids put together by numpy."""

from __future__ import annotations

import gc
from array import array

import numpy as np
import pyarrow as pa

from tallyloom.llm.common import kept_in_worker
from tallyloom.llm.pieces import load

PIECES_KEPT, IDS_KEPT = 700_000, 8_000_000  # memory bounds of the memo; a full one is emptied, results don't change
BATCH_BYTES = 1 << 16  # so many bytes of new pieces are encoded together
SLICE_BYTES = 1 << 22  # so many bytes of texts are cut together; a longer text makes a slice of its own
TAIL = ".,;:!?#*$%&"


def _flags(chars: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(chars.encode())] = True
    return flags


BLANK, GAP, MARK = _flags("\t\n\v\f\r\x1c\x1d\x1e\x1f "), _flags(" \n"), _flags(TAIL)
LETTER = _flags("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
LATIN = np.zeros(256, bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False  # behind 0xC3 these two are signs, all others letters

FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[10] = 32


def slices(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Runs (from, to) of texts of at most SLICE_BYTES together, or of one longer text."""
    out, start, held = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > SLICE_BYTES:
            out.append((start, i))
            start, held = i, 0
        held += n
    return [*out, (start, len(lengths))] if len(lengths) else out


def safe_cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where pieces begin: each of starts, a space or line feed behind a character
    that isn't white space, and a mark of TAIL behind a letter.

    Both tokenizers' splitters end a piece there and never look back, and they look ahead
    over white space only, which never ends a part cut at such places.
    """
    begins = np.zeros(len(data), bool)
    at = np.flatnonzero(GAP[data[1:]]) + 1
    at = at[~BLANK[data[at - 1]]]
    begins[at] = True
    wide = at[data[at - 1] >= 0x80]
    if len(wide):  # white space of two or three bytes, and what shares its first bytes
        one, two, three = data[wide - 1], data[wide - 2], data[np.maximum(wide - 3, 0)]
        blank = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
        blank |= (three == 0xE1) & ((two == 0x9A) | (two == 0xA0)) | (three == 0xE2) & ((two == 0x80) | (two == 0x81)) | (three == 0xE3) & (two == 0x80)
        begins[wide[blank]] = False
    at = np.flatnonzero(MARK[data[1:]]) + 1
    last = data[at - 1]
    begins[at[LETTER[last] | LATIN[last] & (data[np.maximum(at - 2, 0)] == 0xC3)]] = True
    begins[starts[starts < len(data)]] = True
    return np.flatnonzero(begins)


class Ids:
    """A tokenizer's ids of texts, without added special tokens.

    folds: the tokenizer lower-cases and takes any white space alike, so pieces that differ
    in that alone are one; texts that may hold a special token's string are left as they are.
    """

    def __init__(self, path: str, folds: bool = False) -> None:
        self.folds = folds
        self.tokenizer = load(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.empty()

    def empty(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.ends = array(self.code), array("q", [0])

    def numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The memo's number of each piece."""
        if len(self.known) + len(pieces) > PIECES_KEPT or len(self.flat) > IDS_KEPT:
            self.empty()
        known, new = self.known, []
        held = 0
        for p in pieces:
            if p not in known:
                known[p] = len(known)
                new.append(p.decode())
                held += len(p)
                if held >= BATCH_BYTES:
                    self.encode(new)
                    new, held = [], 0
        self.encode(new)
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, new: list[str]) -> None:
        for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False) if new else ():
            self.flat.extend(e.ids)
            self.ends.append(len(self.flat))

    def slice(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts that begin at starts in data (UTF-8), and how many each has."""
        if not len(data):
            return np.empty(0, self.code), np.zeros(len(starts), np.int64)
        begins = safe_cuts(data, starts)
        if self.folds and b"<|" not in data.tobytes():
            data = FOLDED[data]
        offsets = np.append(begins, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        numbers = self.numbers(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        ends, flat = np.frombuffer(self.ends, np.int64), np.frombuffer(self.flat, self.code)
        to = np.cumsum(ends[numbers + 1] - ends[numbers])
        ids = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat)).take(pa.array(numbers)).flatten().to_numpy()
        bounds = np.append(0, to)[np.searchsorted(begins, np.append(starts, len(data)))]
        del ends, flat  # an array can't grow while its buffer is lent
        return ids, np.diff(bounds)

    def __call__(self, texts: pa.Array):
        """(ids, lengths) of one slice of texts after another, null as empty."""
        texts = texts.cast(pa.large_binary())
        gc.disable()  # nothing here makes cycles, and passes over a large memo are slow
        try:
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for a, b in slices(np.diff(offsets)):
                yield self.slice(data[offsets[a] : offsets[b]], offsets[a:b] - offsets[a])
        finally:
            gc.enable()


def ids_of(path: str, folds: bool = False) -> Ids:
    """The worker's own Ids of a tokenizer file."""
    return kept_in_worker(f"ids of {path} {folds}", lambda: Ids(path, folds))
