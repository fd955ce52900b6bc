"""Benchmark decontamination by spaced seeds: masks that ignore some places find substituted copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import MEMO_ENTRIES, kept_in_worker, table, texts, windows_hashed, written

# The places of a window that each mask reads.  They hit each overlap of 13 to 24 words with LEAST_WORDS equal
# ones at a share of LEAST_EQUAL, wherever the others stand; a longer overlap holds one of these.
MASKS = ((0, 1, 2, 3, 5, 6, 7), (0, 1, 3, 8, 9, 11, 12), (0, 1, 3, 7, 9, 10, 11), (0, 1, 2, 3, 6, 10, 11), (0, 1, 5, 7, 11, 12, 13), (0, 2, 4, 6, 7, 8, 9))
SPAN = 14  # items of fewer words are looked for as a whole
LEAST_WORDS = 13  # equal words of an overlap, or all of a shorter item
LEAST_EQUAL = 0.8  # of the words of an overlap
CONTEXT = 128  # words kept on each side of a hit
FILTER_BITS = 24  # of the fixed-size filter of test hashes
PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


class CoreHashes(dict):
    """A word's hash without outer punctuation and case; 0 for what has nothing else."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        core = word.strip(PUNCTUATION)
        core = core.lower() if core.isascii() else core.decode().lower().encode()
        self[word] = found = (xxhash.xxh3_64_intdigest(core) | 1) if core else 0
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes(text: bytes) -> np.ndarray:
    found = kept_in_worker("cores", CoreHashes).of(text.split())
    return found[found != 0]


def masks_for(short: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    """(mask number, places): the spaced ones, and the whole for each length of short items."""
    return [*enumerate(MASKS), *((100 + n, tuple(range(n))) for n in short)]


def test_items(benchmark: DataFrame, key: str) -> DataFrame:
    """(item_key, item_ids, words): one row for each different word sequence; null and empty texts have none."""

    def split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [word_hashes(x) for x in texts(batch)]
            keys = [xxhash.xxh3_128_hexdigest(x.tobytes()) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(keys, pa.string()), pa.array([x.tobytes() for x in found], pa.binary())], ["item_id", "item_key", "words"])

    rows = benchmark.select(F.col(key).cast("long").alias("item_id"), "text").mapInArrow(split, "item_id long, item_key string, words binary")
    return rows.where(F.length("words") > 0).groupBy("item_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.first("words").alias("words"))


def item_hashes(items: DataFrame) -> DataFrame:
    """(item_key, item_pos, mask, hash) of all windows of all items."""

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys, at, masks, hashes = [], [], [], []
            for key, raw in zip(batch.column("item_key").to_pylist(), batch.column("words").to_pylist(), strict=True):
                words = np.frombuffer(raw, np.uint64)
                for mask, places in enumerate(MASKS) if len(words) >= SPAN else masks_for([len(words)])[-1:]:
                    h = windows_hashed(words, places[-1] + 1, places)
                    keys += [key] * len(h)
                    at += range(len(h))
                    masks += [mask] * len(h)
                    hashes.append(h)
            h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(at, pa.int32()), pa.array(masks, pa.int32()), pa.array(h.view(np.int64))], ["item_key", "item_pos", "mask", "hash"])

    return items.select("item_key", "words").mapInArrow(hashed, "item_key string, item_pos int, mask int, hash long")


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a hash in the filter."""
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64), ((h >> np.uint64(8)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A filter of 2 ** FILTER_BITS bits (2 MB, whatever the benchmark's size), made block by block on the executors."""

    def places(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = np.unique(np.concatenate(_places(batch.column("hash").to_numpy().view(np.uint64))))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 16), pa.array(at & 0xFFFF)], ["block", "bit"])

    def packed(key, rows):
        bits = np.zeros(1 << 16, np.uint8)
        bits[rows["bit"].to_numpy()] = 1
        return pa.table({"block": [key[0].as_py()], "bits": [np.packbits(bits).tobytes()]})

    rows = hashes.mapInArrow(places, "block long, bit long").distinct().groupBy("block").applyInArrow(packed, "block long, bits binary").collect()
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in rows:
        out[r.block << 13 : (r.block + 1) << 13] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _segments(docs: DataFrame, filter_: np.ndarray, short: list[int]) -> DataFrame:
    """(k1, k2, words, hits): for each different text with hits in the filter, the stretches around them."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)
    masks = masks_for(short)

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("words", pa.binary()), ("masks", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64())), ("at", pa.list_(pa.int32()))])
        for batch in rows:
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            out: list[list] = [[] for _ in schema]
            for first in range(0, batch.num_rows, 128):
                per_text = [word_hashes(x) for x in texts(batch.slice(first, 128))]
                ends = np.cumsum([len(x) for x in per_text])
                words = np.concatenate(per_text)
                found_at, found_mask, found_hash = [], [], []
                for mask, places in masks:
                    h = windows_hashed(words, places[-1] + 1, places)
                    a, b = _places(h)
                    at = np.flatnonzero((bits[a >> 3] >> (7 - (a & 7)).astype(np.uint8)) & 1)
                    b = b[at]
                    at = at[((bits[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1).astype(bool)]
                    at = at[np.searchsorted(ends, at, "right") == np.searchsorted(ends, at + places[-1], "right")]
                    found_at.append(at)
                    found_mask.append(np.full(len(at), mask))
                    found_hash.append(h[at])
                at = np.concatenate(found_at)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, mask, hash_ = at[order], np.concatenate(found_mask)[order], np.concatenate(found_hash)[order].view(np.int64)
                owner = np.searchsorted(ends, at, "right")
                cuts = np.flatnonzero((np.diff(at) > CONTEXT) | (np.diff(owner) > 0)) + 1
                for part in np.split(np.arange(len(at)), cuts):
                    doc = owner[part[0]]
                    low, high = ends[doc] - len(per_text[doc]), ends[doc]
                    start, end = max(low, at[part[0]] - CONTEXT), min(high, at[part[-1]] + SPAN + CONTEXT)
                    row = (k1[first + doc], k2[first + doc], words[start:end].tobytes(), mask[part].tolist(), hash_[part].tolist(), (at[part] - start).tolist())
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return docs.select("k1", "k2", "text").mapInArrow(search, "k1 long, k2 long, words binary, masks array<int>, hashes array<long>, at array<int>")


def overlap(a: np.ndarray, b: np.ndarray, shift: int, least_equal: float) -> tuple[int, int, int]:
    """(equal words, start, end in b) of the stretch where a[i] meets b[i + shift] with the most equal words.

    A stretch's score is +1 for an equal pair and less for another, so that stretches with
    a share of equal words of at least least_equal score at least 0.  For each end the
    earliest start with such a score is taken."""
    low, high = max(0, -shift), min(len(a), len(b) - shift)
    if high <= low:
        return 0, 0, 0
    same = a[low:high] == b[low + shift : high + shift]
    score = np.concatenate([[0.0], np.cumsum(np.where(same, 1.0, -least_equal / (1 - least_equal)))])
    starts = np.searchsorted(-np.minimum.accumulate(score), -score - 1e-6)
    equal = np.concatenate([[0], np.cumsum(same)])
    end = int((equal - equal[starts]).argmax())
    start = int(starts[end])
    return int(equal[end] - equal[start]), low + shift + start, low + shift + end


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "item_id", least_words: int = LEAST_WORDS, least_equal: float = LEAST_EQUAL) -> DataFrame:
    """(k1, k2, n_equal, item_ids): the texts of docs, by both hashes, that hold a benchmark passage.

    A hit of a mask is verified on the whole words around it: the best stretch on its
    diagonal must have at least least_words equal words (all words of a shorter item) and a
    share of least_equal.  Copies of a text are searched once.
    """
    items = written(test_items(benchmark, key), "items")
    hashes = written(item_hashes(items), "item-hashes")
    short = sorted(r[0] for r in items.select((F.length("words") / 8).cast("int").alias("n")).where(F.col("n") < SPAN).distinct().collect())
    distinct = text_keys(docs).select("k1", "k2", "text")
    segments = written(_segments(distinct, hash_filter(hashes), short), "segments").withColumn("segment", F.monotonically_increasing_id())
    segments = written(segments, "numbered")
    hits = segments.select("segment", F.explode(F.arrays_zip("masks", "hashes", "at")).alias("h")).select("segment", F.col("h.masks").alias("mask"), F.col("h.hashes").alias("hash"), F.col("h.at").alias("at"))
    met = hits.join(hashes, ["mask", "hash"]).select("segment", "item_key", (F.col("at") - F.col("item_pos")).alias("shift")).distinct()
    pairs = met.groupBy("segment", "item_key").agg(F.collect_set("shift").alias("shifts"))
    pairs = pairs.join(items.select("item_key", "item_ids", F.col("words").alias("item_words")), "item_key").join(segments.select("segment", "k1", "k2", "words"), "segment")

    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = []
            for raw, item, shifts in zip(batch.column("words").to_pylist(), batch.column("item_words").to_pylist(), batch.column("shifts").to_pylist(), strict=True):
                a, b = np.frombuffer(item, np.uint64), np.frombuffer(raw, np.uint64)
                n = max(overlap(a, b, s, least_equal)[0] for s in shifts)
                found.append(n if n >= min(least_words, len(a)) else 0)
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), batch.column("item_ids"), pa.array(found, pa.int64())], ["k1", "k2", "item_ids", "n_equal"])

    checked = pairs.select("k1", "k2", "item_ids", "words", "item_words", "shifts").mapInArrow(verify, "k1 long, k2 long, item_ids array<long>, n_equal long").where("n_equal > 0")
    return checked.groupBy("k1", "k2").agg(F.max("n_equal").alias("n_equal"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"))


def text_keys(docs: DataFrame) -> DataFrame:
    """docs with k1, k2: two hashes of the text, null as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*[docs[c] for c in docs.columns if c not in ("k1", "k2")], F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2"))


def contamination(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """(doc_id, contaminated, n_equal, item_ids) per row of docs.

    Null and empty texts, and any text against an empty benchmark, are clean (0, no ids).
    Repeated rows and null ids get the verdict of their text; other columns aren't read.
    """
    found = overlaps(docs.select("doc_id", "text"), benchmark, **limits)
    rows = text_keys(docs.select("doc_id", "text")).select("doc_id", "k1", "k2").join(found, ["k1", "k2"], "left")
    return rows.select("doc_id", F.col("n_equal").isNotNull().alias("contaminated"), F.coalesce("n_equal", F.lit(0).cast("long")).alias("n_equal"), F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The rows of docs, with their own columns, that hold no benchmark passage."""
    found = overlaps(docs.select("doc_id", "text"), benchmark, **limits).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.join(found, (F.xxhash64(text) == found["_k1"]) & (F.xxhash64(F.lit("second"), text) == found["_k2"]), "left_anti")


def op8_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
