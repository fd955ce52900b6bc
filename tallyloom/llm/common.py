"""What several text operators share: reading, scratch tables, word hashes, running totals."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
MEMO_ENTRIES = 400_000  # memory bound of a task's memo; a full memo is emptied, results don't change
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROWS_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
FEW_ROWS = 1000  # of a batch whose rows are whole texts or sets: tens of megabytes at most
LEVELS = 3  # of running_totals: blocks of 1024 blocks of 1024 blocks
FAN = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; only a session without that setting gets a local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir() + "/tallyloom-scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage, survives lost executors.

    What was shuffled for it isn't read again, so Spark deletes those files once it is written;
    that is a setting of the session, put back at the end.  rows: of a batch that Python
    gets, at most; a lower setting of the session holds.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = {CLEANUP: spark.conf.get(CLEANUP, "false"), ROWS_A_BATCH: spark.conf.get(ROWS_A_BATCH)}
    spark.conf.set(CLEANUP, "true")
    if rows and not 0 < int(before[ROWS_A_BATCH]) < rows:
        spark.conf.set(ROWS_A_BATCH, rows)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts as UTF-8, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def kept_in_worker(name: str, make):
    """make(), once for all tasks of a Python worker: memos of bounded size outlive a task."""
    home = sys.modules.setdefault("tallyloom_worker", types.ModuleType("tallyloom_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept up to MEMO_ENTRIES."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows_hashed(words: np.ndarray, width: int, offsets: tuple[int, ...] | None = None) -> np.ndarray:
    """A hash for each window of width words, in order; with offsets, of those places of the window only."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width) if offsets is None else offsets:
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
        out ^= out >> np.uint64(29)
    return mixed(out)


def batches(rows: Iterator[pa.RecordBatch], schema: pa.Schema, of) -> Iterator[pa.RecordBatch]:
    """Apply of(batch) -> columns to each batch."""
    for batch in rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(of(batch), schema, strict=True)], schema=schema)


def running_totals(df: DataFrame, keys: list[str], block: str, amount: Column, out: str) -> DataFrame:
    """df's (keys, block) with the sum of amount over all smaller blocks of the same keys.

    block: a long from 0.  Blocks are summed first and then carried over FAN blocks at a
    time, so no task gets all blocks of a hot key; the levels cover FAN ** LEVELS blocks.
    """
    sums = [df.groupBy(*keys, F.col(block).alias("_b0")).agg(F.sum(amount).alias("_s0"))]
    for k in range(1, LEVELS):
        below = sums[-1]
        sums.append(below.groupBy(*keys, F.floor(F.col(f"_b{k - 1}") / FAN).cast("long").alias(f"_b{k}")).agg(F.sum(f"_s{k - 1}").alias(f"_s{k}")))
    total: DataFrame | None = None
    for k in range(LEVELS - 1, -1, -1):
        up = F.floor(F.col(f"_b{k}") / FAN).cast("long") if k < LEVELS - 1 else F.lit(0).cast("long")
        here = sums[k].withColumn("_up", up)
        own = F.sum(f"_s{k}").over(Window.partitionBy(*keys, "_up").orderBy(f"_b{k}").rowsBetween(Window.unboundedPreceding, -1))
        here = here.withColumn("_own", F.coalesce(own, F.lit(0).cast("long")))
        if total is not None:
            above = total.select(*[F.col(x).alias(f"_k{i}") for i, x in enumerate(keys)], F.col(f"_b{k + 1}").alias("_at"), F.col("_total").alias("_before"))
            on = F.col("_up") == F.col("_at")
            for i, x in enumerate(keys):
                on &= F.col(x).eqNullSafe(F.col(f"_k{i}"))
            here = here.join(above, on).withColumn("_own", F.col("_own") + F.col("_before"))
        total = here.select(*keys, f"_b{k}", F.col("_own").alias("_total"))
    return total.select(*keys, F.col("_b0").alias(block), F.col("_total").alias(out))
