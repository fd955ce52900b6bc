"""Exports dropped into a folder, read as a stream and merged into the table.

A micro-batch's rows first go to a waiting folder beside the checkpoint.  All files that
wait are then merged, the older ones of a source first, so that newer rows win.  A file
stops waiting when its source has succeeded; a failed one, or a lead file without its
partner, is tried again with each later micro-batch.  A replayed micro-batch changes
nothing: its rows replace themselves and the upsert only rewrites what it already wrote.

The ledger of micro-batch n lists the files that still wait after it.  The next one reads
that list and its own rows, and deletes the rows that nobody waits for any more: what a
micro-batch costs depends on what waits, not on all that was ever dropped.
"""

from __future__ import annotations

import json
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.order import union_all
from tallyloom.plans.batch import run
from tallyloom.settings import RunOptions
from tallyloom.sources.files import base_name, name_day, sources_of
from tallyloom.sources.grids import GRID_SCHEMA
from tallyloom.sources.registry import LABELS, LEAD_KEYS
from tallyloom.sources.storage import exists, names, read_text, remove, write_text



class Waiting(NamedTuple):
    day: int
    path: str
    source: str
    batch: int


def watch(
    spark: SparkSession, drop: str, archive: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Streaming grid of a drop folder; landed parts that were read are moved to `archive`."""
    reader = spark.readStream.format(fmt).schema(GRID_SCHEMA)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(drop)


def rounds(files: list[Waiting]) -> list[list[Waiting]]:
    """What to merge one after the other: the n-th oldest file of each source in the n-th round.

    Leads go in pairs, of the same day where there is one and else the newest with the
    newest.  One lead file that still has no partner goes along, so that it is reported.
    """
    by_source: dict[str, list[Waiting]] = defaultdict(list)
    for f in sorted(files):
        by_source[f.source].append(f)
    ql, ft = (by_source.pop(k, []) for k in LEAD_KEYS)
    pairs = []
    for f in list(ql):
        partner = next((g for g in ft if g.day == f.day), None)
        if partner:
            pairs.append([f, partner])
            ql.remove(f)
            ft.remove(partner)
    if ql and ft:
        pairs.append([ql.pop(), ft.pop()])
    pairs.sort(key=lambda pair: max(f.day for f in pair))
    groups = [[[f] for f in own] for own in by_source.values()] + [pairs]
    out = [[f for g in groups if i < len(g) for f in g[i]] for i in range(max(map(len, groups)))]
    alone = (ql + ft)[-1:]
    if alone and not pairs:
        out = [[*out[0], *alone], *out[1:]] if out else [alone]
    return out


def _ledger(folder: str, batch_id: int) -> str:
    return f"{folder}/ledger/{batch_id}.json"


def read_ledger(spark: SparkSession, folder: str, batch_id: int) -> list[Waiting]:
    """Files that waited when that micro-batch was done; none before the first one."""
    path = _ledger(folder, batch_id)
    return [Waiting(*f) for f in json.loads(read_text(spark, path))] if exists(spark, path) else []


def write_ledger(spark: SparkSession, folder: str, batch_id: int, files: list[Waiting]) -> None:
    write_text(spark, _ledger(folder, batch_id), json.dumps(sorted(files)))
    remove(spark, _ledger(folder, batch_id - 2))


def _rows(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.schema(GRID_SCHEMA).parquet(f"{folder}/rows/batch={batch_id}")


def dropped_files(grid: DataFrame, batch_id: int) -> list[Waiting]:
    """Files of a micro-batch per source; comes to the driver, as plans are built from it."""
    file_name = base_name(F.col("path"))
    found = grid.select("path").distinct().select(
        "path", name_day(file_name).alias("day"), F.explode(sources_of(file_name)).alias("source")
    )
    return [Waiting(r.day or 0, r.path, r.source, batch_id) for r in found.collect()]


def forget_rows(spark: SparkSession, folder: str, batch_id: int, waiting: list[Waiting]) -> None:
    """Delete rows of earlier micro-batches that no file waits for."""
    needed = {f.batch for f in waiting}
    for n in names(spark, f"{folder}/rows"):
        number = int(n.removeprefix("batch="))
        if number < batch_id and number not in needed:
            remove(spark, f"{folder}/rows/{n}")


def merge_waiting(
    spark: SparkSession,
    folder: str,
    table: str,
    batch_id: int,
    options: RunOptions | None = None,
    archive: str | None = None,
) -> dict:
    """Merge all that waits; one report, counts summed over its rounds."""
    total: dict = {"failed": [], "files": {}}
    absent: dict[str, str] = {}
    tried = set()
    before = read_ledger(spark, folder, batch_id - 1)
    forget_rows(spark, folder, batch_id, before)
    new = dropped_files(_rows(spark, folder, batch_id), batch_id)
    again = {f.path for f in new}  # a file dropped again counts by its last drop only
    waiting = [f for f in before if f.path not in again] + new
    for files in rounds(waiting):
        by_batch: dict[int, list[str]] = defaultdict(list)
        for f in files:
            by_batch[f.batch].append(f.path)
        rows = union_all(_rows(spark, folder, b).filter(F.col("path").isin(*paths)) for b, paths in by_batch.items())
        report = run(spark, table, rows, options, archive=archive)
        here = {LABELS[f.source] for f in files}
        failed = dict(report["failed"])
        merged = {f for f in files if LABELS[f.source] not in failed}
        waiting = [f for f in waiting if f not in merged]
        tried |= here
        absent |= {k: v for k, v in failed.items() if k not in here}
        total["failed"] += [(k, v) for k, v in report["failed"] if k in here]
        total["files"].update({f.source: f.path for f in files})
        total.setdefault("archived", {}).update(report.get("archived", {}))
        for k, v in report.items():
            if k not in ("failed", "files", "archived"):
                total[k] = total.get(k, 0) + (v or 0)
    write_ledger(spark, folder, batch_id, waiting)
    total["failed"] += [(k, v) for k, v in absent.items() if k not in tried]
    return total


def intake(
    spark: SparkSession,
    drop: str,
    table: str,
    checkpoint: str,
    archive: str | None = None,
    options: RunOptions | None = None,
    fmt: str = "parquet",
    on_report=None,
) -> StreamingQuery:
    """Start merging everything that waits in the folder; stops when it is done.

    With `archive`, landed parts move there once read, and the exports they were landed
    from, where their paths can be reached, once their source has succeeded.
    """
    folder = f"{checkpoint.rstrip('/')}_waiting"

    def merge_batch(grid: DataFrame, batch_id: int) -> None:
        own = grid.sparkSession
        grid.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")
        report = merge_waiting(own, folder, table, batch_id, options, archive)
        if on_report:
            on_report(batch_id, report)

    return (
        watch(spark, drop, archive, fmt)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
