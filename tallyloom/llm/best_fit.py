"""Best-fit packing: documents, longest first, each into the fullest sequence that still has room."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import running_totals, table, written
from tallyloom.llm.ids import ids_of

END_ID = 0  # closes a document
RANK_BITS = 42  # places among pieces of one length; lengths take the bits above


class OpenBins:
    """Sequences that still have room, as runs of neighbouring numbers by remaining room.

    A segment tree over the rooms 0 .. size holds which of them has an open sequence; the
    least room that a length fits into is found in logarithmic time.
    """

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _mark(self, room: int, full: bool) -> None:
        node = self.leaves + room
        while node and self.tree[node] != full:
            self.tree[node] = full
            node >>= 1
            full = bool(self.tree[2 * node] or self.tree[2 * node + 1]) if node else full

    def put(self, room: int, first: int, last: int) -> None:
        """Sequences first .. last - 1 have this room."""
        if room and first < last:
            self.runs[room].append((first, last))
            self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, False)
        return run

    def tightest(self, length: int) -> int | None:
        """The least room of at least length."""
        node = self.leaves + length
        if self.tree[node]:
            return length
        while node > 1:
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.tree[2 * node])
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], size: int) -> tuple[np.ndarray, int]:
    """(runs, number of sequences) of so many pieces of each length, longest first.

    A run places the pieces rank, rank + 1, ... of a length, `each` of them side by side in
    every sequence from `sequence` on, the first at `offset`: its columns are length, rank,
    sequence, each, offset.  Pieces of one length go one after another into the tightest
    sequence until it has no room for another, so all equal sequences can be filled in one
    step: the work depends on size, not on the number of pieces.
    """
    bins, used, runs = OpenBins(size), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room, first = size, used
                last = used = used + -(-left // (size // length))
            else:
                first, last = bins.take(room)
            each = room // length
            full = min(last - first, left // each)
            runs.append((length, rank, first, each, size - room))
            bins.put(room - each * length, first, first + full)
            rank, left, first = rank + full * each, left - full * each, first + full
            if left and first < last:  # less than `each` pieces are left for the next sequence
                bins.put(room - left * length, first, first + 1)
                first, left = first + 1, 0
            bins.put(room, first, last)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), used


def pieces_of(docs: DataFrame, path: str, size: int, key: str, text: str, with_ids: bool) -> DataFrame:
    """One row per piece of a text's ids and END_ID: all `size` long but the first.

    chunk and nth place it among the pieces of its length: the task that made it, and how
    many such pieces that task had made before.
    """
    kinds = {"row_id": pa.int64(), "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "chunk": pa.int64(), "nth": pa.int64()}
    schema = pa.schema([*kinds.items(), *([("ids", pa.binary())] if with_ids else [])])

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, chunk = ids_of(path), [0] * (size + 1), TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        for batch in rows:
            row = 0
            row_ids, keys = (batch.column(c).to_pylist() for c in (0, 1))
            for ids, lengths in encoder(batch.column(2)):
                ids, found, base = memoryview(ids.astype("<u4").tobytes()), [], 0
                for n in lengths.tolist():
                    start, piece = 0, 0
                    while start <= n:
                        length = min(n + 1, (n + 1) % size or size) if not piece else size
                        to = start + length
                        part = ids[4 * (base + start) : 4 * (base + min(to, n))]
                        crc = zlib.crc32(part)
                        if to > n:
                            crc = zlib.crc32(end, crc)
                        found.append((row_ids[row], keys[row], piece, start, length, crc, chunk, seen[length], *([bytes(part) + end * (to > n)] if with_ids else [])))
                        seen[length] += 1
                        start, piece = to, piece + 1
                    base, row = base + n, row + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    kept = docs.select(F.monotonically_increasing_id().alias("row_id"), docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return kept.mapInArrow(cut, "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long, chunk long, nth long" + ", ids binary" * with_ids)


def pack_best_fit(docs: DataFrame, path: str, size: int = 2048, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, row_id) per piece; with_ids adds ids.

    A document is its ids and END_ID; a longer one than size is cut into pieces of size ids,
    the first of which holds the rest.  Pieces are packed by best-fit decreasing over all
    rows at once.  Which pieces share a sequence depends on their lengths alone, so the
    driver gets the number of pieces of each length (at most `size` numbers) and plans runs
    of equal sequences; tasks then place each piece by its rank among those of its length.

    ids: the piece's ids as little-endian 32-bit numbers (see `sequences`).  A null or empty
    text is END_ID alone; null keys and repeated rows are packed row by row (row_id tells
    them apart); pieces of one length are placed in the order of their rows; one very long
    text is encoded in one piece of memory; no other column is read.  An empty table gives
    no pieces.  path: a tokenizer's .json file, present on every executor.
    """
    pieces = written(pieces_of(docs, path, size, key, text, with_ids), "pieces")
    in_chunk = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    runs, _ = best_fit_decreasing({r.length: r.n for r in in_chunk.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator()}, size)
    before = running_totals(in_chunk, ["length"], "chunk", F.col("n"), "before").withColumnsRenamed({"length": "_length", "chunk": "_chunk"})
    ranked = pieces.join(before, (F.col("length") == F.col("_length")) & (F.col("chunk") == F.col("_chunk")))
    ranked = ranked.select("row_id", "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"), *["ids"] * with_ids)
    return _placed(ranked, docs.sparkSession.sparkContext.broadcast(runs))


def _placed(ranked: DataFrame, runs) -> DataFrame:
    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, sequence, each, offset = runs.value.T
        keys = (length << RANK_BITS) + rank
        for batch in rows:
            own, nth = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = np.searchsorted(keys, (own << RANK_BITS) + nth, "right") - 1
            at, beside = np.divmod(nth - rank[run], each[run])
            columns = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name not in ("rank", "ids", "row_id")]
            columns += [pa.array(sequence[run] + at), pa.array(offset[run] + beside * own), batch.column("row_id")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "row_id"]
            if "ids" in batch.schema.names:
                columns, names = [*columns, batch.column("ids")], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, row_id long" + ", ids binary" * ("ids" in ranked.columns))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of pieces packed with_ids: each sequence's ids in their order, unpadded.

    A sequence has at most as many pieces as ids, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("hex"))))
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return rows.select("sequence_id", "length", F.unhex(F.array_join("parts.hex", "")).alias("ids"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("row_id")
