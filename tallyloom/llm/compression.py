"""Quality rules by compression bands: zstandard ratios of whole texts and of fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import WordHashes, batches, kept_in_worker, table, windows_hashed

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
BLANK_BYTES = BLANKS.encode()


@dataclass(frozen=True)
class Band:
    """Limits of compressed size / size for texts of at most `up_to` bytes."""

    up_to: float
    low: float
    high: float


#: Short texts compress little, whatever they say; long prose reaches 0.3 to 0.5.
BANDS = (Band(256, 0.32, 1.1), Band(1024, 0.30, 0.90), Band(4096, 0.28, 0.75), Band(16384, 0.25, 0.68), Band(float("inf"), 0.20, 0.65))
CHUNK = 4096
CHUNK_BAND = Band(CHUNK, 0.20, 0.75)
CHUNKS_FAILED = 0.25  # of a text's chunks, at most


def band_of(n: int, bands: tuple[Band, ...]) -> Band:
    return next(b for b in bands if n <= b.up_to)


def base_counts(text: str, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int]:
    """(word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return chars, symbols, len(lines) - len(set(lines)), repeated_words(hashes)


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a window of `width` words found twice or more in the text."""
    found = windows_hashed(hashes, width)
    if len(found) < 2:
        return 0
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(found), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[: len(found)] += twice
    edges[width : width + len(found)] -= twice
    return int(np.count_nonzero(np.cumsum(edges)))


def chunk_starts(data: bytes, chunk: int) -> list[int]:
    """Starts of the full chunks; what is left over is seen by a last chunk that ends at the text's end."""
    starts = list(range(0, len(data) - chunk + 1, chunk))
    return starts + [len(data) - chunk] if starts and len(data) % chunk else starts


def quality_by_compression(
    docs: DataFrame, bands: tuple[Band, ...] = BANDS, chunk: int = CHUNK, chunk_band: Band = CHUNK_BAND, chunks_failed: float = CHUNKS_FAILED, level: int = 3
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, n_chunks, n_chunks_failed, kept) per row.

    kept: false if the base rules fail, the whole text's ratio leaves the band of its
    length, or more than `chunks_failed` of its chunks leave theirs (a repetitive or
    random part in a normal whole).  A null text counts as empty: no words, so base_failed,
    ratio null.  Each row is judged by itself, so repeated rows, null ids and any other
    columns change nothing.
    """
    out = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_chunks_failed", pa.int64()), ("kept", pa.bool_())])

    def judge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer, memo = zstandard.ZstdCompressor(level=level), kept_in_worker("words", WordHashes)

        def one(text: str) -> tuple:
            data = text.encode()
            words = data.split()
            counts = base_counts(text, words, memo.of(words))
            failed = len(words) < 20 or 100 * counts[3] > 30 * len(words)
            ratio = len(packer.compress(data)) / len(data) if data else None
            band, starts = band_of(len(data), bands), chunk_starts(data, chunk)
            parts = [len(packer.compress(data[i : i + chunk])) / chunk for i in starts]
            bad = sum(not chunk_band.low <= x <= chunk_band.high for x in parts)
            kept = not failed and band.low <= ratio <= band.high and bad <= chunks_failed * len(parts)
            return len(words), *counts, failed, ratio, len(parts), bad, kept

        def of(batch: pa.RecordBatch) -> list:
            found = [one(x or "") for x in batch.column("text").to_pylist()]
            return [batch.column("doc_id"), *([list(c) for c in zip(*found, strict=True)] or [[]] * 10)]

        return batches(rows, out, of)

    fields = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, n_chunks long, n_chunks_failed long, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(judge, fields)


def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_by_compression(table(spark, sf_dir, "documents"))
