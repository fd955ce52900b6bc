"""Mixture-controlled packing: deficit round-robin over source queues into full token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import FEW_ROWS, batches, running_totals, table, written
from tallyloom.llm.ids import ids_of

END_ID = 1  # closes a document
LEAST_SLICE = 64  # tokens: a source whose share of a sequence is less sends so many in some rounds
BLOCK_DOCS = 2048  # about so many documents make a block of a queue's running total
BLOCK_ROUNDS = 64  # so many rounds make a block of the stream's running total
LATE = 1 << 35  # rounds of sources without weight: behind all others


def token_ids(docs: DataFrame, path: str, source: str = "source") -> DataFrame:
    """(doc_id, source, ids, doc_tokens): each text's ids as little-endian 16-bit numbers, END_ID last."""
    out = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = ids_of(path, folds=True), np.array([END_ID], "<u2").tobytes()
        if encoder.code != "H":
            raise ValueError("the vocabulary has more than 65,536 ids")
        for batch in rows:
            row = 0
            for ids, lengths in encoder(batch.column("text")):
                held, at = memoryview(ids.astype("<u2").tobytes()), 0
                found = []
                for n in lengths.tolist():
                    found.append(bytes(held[2 * at : 2 * (at + n)]) + end)
                    at += n
                columns = [batch.column(c).slice(row, len(found)) for c in ("doc_id", "source")]
                row += len(found)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary()), pa.array(lengths + 1)], schema=out)

    kept = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.col(source).cast("string").alias("source"))
    return kept.mapInArrow(encode, "doc_id long, source string, ids binary, doc_tokens long")


def pack(docs: DataFrame, path: str, size: int = 2048, weights: dict[str, float] | None = None, source: str = "source") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, row_id) per piece.

    Deficit round-robin: in each round a source's queue of documents earns size * share
    tokens of credit and sends them, cutting documents where the credit ends; a source that
    earns less than LEAST_SLICE a round saves until it can send that many.  What a round
    leaves of a token is carried to the next.  The round of each slice follows from its
    place in its queue, so no state has to pass from task to task.  The stream, ordered by
    round, source and queue, is cut every `size` ids: all sequences but the last are full,
    and each holds its sources' shares to within a slice (two of a source that saves up).

    shares: each source's part of all tokens, or `weights` by source (others 1); when a
    queue runs dry, those left share the sequences in the same proportions.  Sources of
    weight 0 come behind all others, in equal parts; a negative weight is refused.

    A null or empty text is END_ID alone; a null source is a queue of its own; repeated rows
    and null ids are packed row by row (row_id tells them apart); other columns aren't read,
    but there must be a source column.  An empty table gives no pieces.  The order within a
    queue is that of hashed row ids.
    """
    if weights and min(weights.values()) < 0:
        raise ValueError("weights can't be negative")
    spark = docs.sparkSession
    held = written(token_ids(docs, path, source).withColumn("row_id", F.monotonically_increasing_id()), "token-ids", 2 * FEW_ROWS)
    narrow = held.select("row_id", "source", "doc_tokens")
    totals = narrow.groupBy("source").agg(F.sum("doc_tokens").alias("queue_tokens"), F.count("*").alias("queue_docs"))
    if weights:
        weight = F.coalesce(F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))])[F.col("source")], F.lit(1.0))
        totals = totals.withColumn("weight", weight)
    else:
        totals = totals.withColumn("weight", F.col("queue_tokens").cast("double"))
    every = totals.agg(F.sum("weight").alias("all_weight"), F.count_if(F.col("weight") == 0).alias("none"))
    quantum = F.when(F.col("weight") > 0, F.col("weight") * size / F.col("all_weight")).otherwise(F.lit(float(size)) / F.col("none"))
    totals = totals.join(F.broadcast(every)).select(
        F.col("source").alias("_source"), quantum.alias("quantum"), F.greatest(quantum, F.lit(float(min(LEAST_SLICE, size)))).alias("slice"),
        F.when(F.col("weight") > 0, F.lit(0)).otherwise(F.lit(LATE)).alias("late"), (F.floor(F.col("queue_docs") / BLOCK_DOCS) + 1).alias("blocks"),
    )
    queued = narrow.join(totals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    place = F.xxhash64("row_id")
    queued = queued.withColumn("place", place).withColumn("block", F.pmod("place", "blocks").cast("long"))
    before = running_totals(queued, ["source"], "block", F.col("doc_tokens"), "block_start").withColumnsRenamed({"source": "_source", "block": "_block"})
    queued = queued.join(before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))).drop("_source", "_block")
    line = Window.partitionBy("source", "block").orderBy("place", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    queued = queued.withColumn("queue_start", F.col("block_start") + F.coalesce(F.sum("doc_tokens").over(line), F.lit(0)))

    # Slice k of a queue holds its tokens from floor(k * slice) on.
    first = lambda k: F.floor(k * F.col("slice")).cast("long")
    near = lambda at: F.floor(at / F.col("slice")).cast("long")
    holding = lambda at: near(at) + F.when(first(near(at) + 1) <= at, 1).otherwise(0) - F.when(first(near(at)) > at, 1).otherwise(0)
    queued = queued.withColumn("queue_end", F.col("queue_start") + F.col("doc_tokens"))
    packets = queued.select("*", F.explode(F.sequence(holding(F.col("queue_start")), holding(F.col("queue_end") - 1))).alias("k"))
    start, end = F.greatest(first(F.col("k")), "queue_start"), F.least(first(F.col("k") + 1), "queue_end")
    packets = packets.withColumns({"start": start - F.col("queue_start"), "length": end - start})
    # Queues that don't send in each round begin at different ones.
    phase = F.when(F.col("slice") == F.col("quantum"), F.lit(0.0)).otherwise(F.pmod(F.xxhash64("source"), F.lit(1024)) / 1024)
    round_ = F.col("late") + F.floor((F.col("k") + phase) * F.col("slice") / F.col("quantum")).cast("long")
    packets = packets.withColumn("round", round_).withColumn("block", F.floor(F.col("round") / BLOCK_ROUNDS).cast("long"))
    packets = packets.select("row_id", "source", "place", "start", "length", "round", "block")
    packets = written(packets, "packets")
    ahead = running_totals(packets, [], "block", F.col("length"), "block_start")
    packets = packets.join(ahead, "block")
    line = Window.partitionBy("block").orderBy("round", "source", "place", "row_id", "start").rowsBetween(Window.unboundedPreceding, -1)
    packets = packets.withColumn("at", F.col("block_start") + F.coalesce(F.sum("length").over(line), F.lit(0)))
    by_row = packets.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "length", "at"))).alias("packets"))
    return _cut(held.join(by_row, "row_id"), size)


def _cut(rows: DataFrame, size: int) -> DataFrame:
    """Cut each packet where sequences end, and sum its ids up."""
    out = pa.schema([*[(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")], ("source", pa.string()), ("row_id", pa.int64())])

    def cut(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(batch: pa.RecordBatch) -> list:
            found: list[list] = [[] for _ in out]
            for row in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "ids", "doc_tokens", "source", "row_id", "packets")), strict=True):
                doc, ids, total, source, row_id, packets = row
                ids = np.frombuffer(ids, np.uint16).astype("<u4").tobytes()
                for packet in packets:
                    start, left, at = packet["start"], packet["length"], packet["at"]
                    while left:
                        length = min(left, size - at % size)
                        piece = (doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, at // size, at % size, source, row_id)
                        for column, value in zip(found, piece, strict=True):
                            column.append(value)
                        start, at, left = start + length, at + length, left - length
            return found

        return batches(batches_, out, of)

    kept = rows.select("doc_id", "ids", "doc_tokens", "source", "row_id", "packets")
    return kept.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, row_id long")


def op10_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("row_id")
