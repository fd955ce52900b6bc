"""A memo of what a tokenizer makes of the words of a text, filled in batches balanced by bytes."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterable

import regex

BATCH_BYTES = 1 << 16
WORDS_KEPT, PIECES_KEPT = 600_000, 500_000  # memory bounds; a full memo is emptied, results don't change
UNSAFE = object()
TAIL = ".,;:!?#*$%&"


def load(path: str):
    """The tokenizer of a .json file, encoding on the calling task's one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PieceMemo(dict):
    """What each word becomes: join(encode(piece) for the pieces of the word).

    pattern: the tokenizer's own splitter, which may be applied by hand to Latin-1 words
    without anything that looks like a special token; all others are encoded as they are.
    """

    def __init__(self, pattern: str, encode: Callable[[list[str]], list], join: Callable[[Iterable], object], lead: str = "", lower: bool = False) -> None:
        super().__init__()
        self.wide, self.narrow = regex.compile(pattern), re.compile(pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace("[[", "[").replace("]]", "]"), re.ASCII)
        self.encode, self.join, self.lead, self.lower, self.short = encode, join, lead, lower, {}

    def cut(self, word: str) -> list[str]:
        core = word.rstrip(TAIL)
        if core.isalpha() and (core.isascii() or max(core) <= "\xff"):  # most words: letters, then at most one run of marks
            head = self.lead + (core.lower() if self.lower else core)
            return [head] if len(core) == len(word) else [head, word[len(core) :]]
        word = self.lead + word
        if "<|" in word:
            return [word]
        if word.isascii():
            return self.narrow.findall(word.lower() if self.lower else word)
        if max(word) > "\xff" or min(word) < " ":
            return [word]
        return self.wide.findall(word.lower() if self.lower else word)

    def fill(self, words: set, unsafe: Callable[[str], bool] | None = None) -> None:
        """Encode the words (str, or bytes in UTF-8) that are new."""
        gc.disable()  # nothing here makes cycles, and passes over a large memo are slow
        try:
            self._fill(words, unsafe)
        finally:
            gc.enable()

    def _fill(self, words: set, unsafe: Callable[[str], bool] | None) -> None:
        new = words.difference(self)
        if len(self) + len(new) > WORDS_KEPT:
            self.clear()
            new = words
        if len(self.short) > PIECES_KEPT:
            self.short.clear()
        cut = {w: self.cut(w.decode() if isinstance(w, bytes) else w) for w in new if not (unsafe and unsafe(w))}
        batch, held = [], 0
        for p in {p for c in cut.values() for p in c}.difference(self.short):
            batch.append(p)
            held += len(p)
            if held >= BATCH_BYTES:
                self.short.update(zip(batch, self.encode(batch), strict=True))
                batch, held = [], 0
        if batch:
            self.short.update(zip(batch, self.encode(batch), strict=True))
        short, join = self.short, self.join
        for w in new:
            c = cut.get(w)
            self[w] = UNSAFE if c is None else short[c[0]] if len(c) == 1 else join(map(short.__getitem__, c))
