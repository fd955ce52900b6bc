"""Token counts: batches of pieces, balanced by bytes, encoded in Arrow functions that return lengths only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import batches, kept_in_worker, table
from tallyloom.llm.pieces import PieceMemo, load

# The byte-level splitter's pattern.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROWS = 256  # texts whose new words are encoded together


def loose(word: str) -> bool:
    """Whether a text may not be cut at the space before or behind this word."""
    return not word or word[0].isspace() or word[-1].isspace()


class Counter:
    """Numbers of ids of whole texts.

    A text is cut at safe boundaries: before a space that stands between two characters
    which aren't white space.  The byte-level splitter always begins a new piece there, as
    it takes one leading space into a word and looks ahead for white space only.
    """

    def __init__(self, tokenizer) -> None:
        def lengths(pieces: list[str]) -> list[int]:
            return list(map(len, tokenizer.encode_batch_fast(pieces, add_special_tokens=False)))

        self.tokenizer = tokenizer
        self.first, self.inner = PieceMemo(SPLIT, lengths, sum), PieceMemo(SPLIT, lengths, sum, lead=" ")

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [x.split(" ") for x in texts]
        self.first.fill({c[0] for c in cut}, loose)
        self.inner.fill(set().union(*(c[1:] for c in cut)), loose)
        out = []
        for text, (first, *rest) in zip(texts, cut, strict=True):
            try:
                out.append(self.first[first] + sum(map(self.inner.__getitem__, rest)))
            except TypeError:  # a space beside other white space: safe cuts only
                out.append(sum(map(len, self.tokenizer.encode_batch_fast(re.split(r"(?<=\S)(?= \S)", text), add_special_tokens=False))))
        return out


def token_counts(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row's whole text.

    path: a byte-level tokenizer's .json file, present on every executor.  A null or empty
    text has 0 bytes and tokens.  Repeated rows and null keys are counted as they come; no
    other column of docs is read, so their names may be any.
    """
    kept = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_in_worker(f"counts of {path}", lambda: Counter(load(path)))

        def of(batch: pa.RecordBatch) -> list:
            found, sizes = [], []
            for start in range(0, batch.num_rows, ROWS):
                part = [x or "" for x in batch.column("text").slice(start, ROWS).to_pylist()]
                found += counter(part)
                sizes += [len(x.encode()) for x in part]
            return [batch.column("doc_id"), sizes, found]

        return batches(rows, out, of)

    counted = kept.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", counted.n_tokens > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
