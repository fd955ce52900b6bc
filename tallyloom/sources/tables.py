"""The fact table: Parquet, one folder per month, in versions that change by whole months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.predicates import between
from tallyloom.operators.upsert import change_counts, insert_rows, mark_updates
from tallyloom.schema import FACT_COLUMNS, FACT_SCHEMA, conform, warehouse_shape
from tallyloom.sources.storage import remove, scratch
from tallyloom.sources.versions import (
    Conflict,
    Version,
    change_folder,
    commit,
    month_folders,
    new_change,
    publish,
    version,
)

TABLE_SCHEMA = T.StructType([*FACT_SCHEMA.fields, T.StructField("ym", T.StringType())])
# As on disk: what the change made of a row, and which change it was.
_STORED = T.StructType(
    [
        *FACT_SCHEMA.fields,
        T.StructField("_change", T.StringType()),
        T.StructField("change", T.StringType()),
        T.StructField("ym", T.StringType()),
    ]
)
NO_MONTH = "undated"
ATTEMPTS = 5  # merges tried by an upsert while others change the same months


def with_month(df: DataFrame) -> DataFrame:
    month = F.coalesce(F.date_format("Date", "yyyy-MM"), F.lit(NO_MONTH))
    return df.withColumn("ym", month)


def _write(df: DataFrame, path: str, change: str) -> None:
    """Write marked rows of a change by month.

    The rebalance hint lets the adaptive planner cut a month that holds much of the
    data into several files of the advisory size, and pack small months together.
    """
    (
        with_month(df)
        .hint("rebalance", "ym")
        .sortWithinPartitions("ym", "Date", "Country", "Channel")
        .write.mode("append")
        .partitionBy("ym")
        .parquet(change_folder(path, change))
    )


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).option("basePath", f"{path.rstrip('/')}/data").parquet(*folders)


def read_table(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """Rows of the newest version or of version `at`; later changes don't show in the frame."""
    found = version(spark, path, at)
    if found is None:
        raise FileNotFoundError(f"no table in {path}")
    return _read(spark, path, month_folders(path, found)).select(*TABLE_SCHEMA.fieldNames())


def read_facts(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    return read_table(spark, path, at).select(*FACT_COLUMNS)


def read_days(spark: SparkSession, path: str, first, last, at: int | None = None) -> DataFrame:
    """Facts of a closed range of days; only the folders of its months are listed and read."""
    first, last = (dt.date.fromisoformat(x) if isinstance(x, str) else x for x in (first, last))
    months = F.col("ym").between(first.isoformat()[:7], last.isoformat()[:7])
    return between(read_table(spark, path, at).filter(months), first, last).select(*FACT_COLUMNS)


def read_last_days(spark: SparkSession, path: str, days: int = 7, today=None, at: int | None = None) -> DataFrame:
    """Facts from `days` days ago up to yesterday."""
    today = dt.date.fromisoformat(today) if isinstance(today, str) else today or dt.date.today()
    return read_days(spark, path, today - dt.timedelta(days), today - dt.timedelta(1), at)


def read_changes(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """What made version `at` (default: the newest): its rows with `_change`, untouched ones left out.

    `_change` is 'updated', 'inserted' or 'loaded'.
    """
    found = version(spark, path, at)
    before = version(spark, path, found.number - 1).months if found.number else {}
    months = [m for m, c in found.months.items() if before.get(m) != c]
    rows = _read(spark, path, month_folders(path, found, months))
    return rows.filter("_change <> 'kept'").select(*FACT_COLUMNS, "_change")


def read_change(spark: SparkSession, path: str, change: str | None) -> DataFrame:
    """All rows a change wrote, with their months; none for None."""
    folders = [] if change is None else [change_folder(path, change)]
    return _read(spark, path, folders).select(*TABLE_SCHEMA.fieldNames())


def ensure_table(spark: SparkSession, path: str) -> bool:
    """True if the table was there; creates it empty otherwise."""
    return version(spark, path) is not None or not publish(spark, path, Version(0, {}))


def replace_table(spark: SparkSession, path: str, rows: DataFrame) -> Version:
    """Make these rows the whole table; a reader goes on with the rows it opened."""
    ensure_table(spark, path)
    change = new_change()
    _write(conform(rows).withColumn("_change", F.lit("loaded")), path, change)
    return commit(spark, path, version(spark, path), change, None)


def initial_load(spark: SparkSession, path: str, rows: DataFrame, run_date=None) -> int:
    """Replace the whole table by clean rows, all-text ones included; no deduplication."""
    made = replace_table(spark, path, warehouse_shape(rows, run_date))
    return read_table(spark, path, made.number).count()  # from the file footers


def _merge(spark: SparkSession, path: str, base: Version, source: DataFrame, months: list[str], strict: bool) -> dict:
    """One try to put a batch on top of a version; the counts of the change."""
    change = new_change()
    folder = change_folder(path, change)
    try:
        target = _read(spark, path, month_folders(path, base, months)).select(*FACT_COLUMNS)
        _write(mark_updates(target, source, strict), path, change)
        # What the batch hit is now on disk: the rest of the batch is new.
        written = [f"{folder}/ym={m}" for m in months if m in base.months]
        hits = _read(spark, path, written).filter("_change = 'updated'").select(*FACT_COLUMNS)
        _write(insert_rows(hits, source).withColumn("_change", F.lit("inserted")), path, change)
        # Counted from what was written: exact even if lost tasks ran twice.
        counts = change_counts(_read(spark, path, [folder])).first().asDict()
        commit(spark, path, base, change, months)
    except BaseException:
        remove(spark, folder)
        raise
    return counts


def upsert(spark: SparkSession, path: str, batch: DataFrame, strict: bool = False) -> dict:
    """Merge a deduplicated batch into the table; returns the counts of the change.

    The batch is staged once, in a folder of its own, so it is not computed again for each
    join.  Its months are the only ones read, once, and are written as a change that one
    step makes the newest version: a run that dies before had no effect.  If another writer
    changed one of these months meanwhile, the batch is merged with the newer rows instead.
    """
    ensure_table(spark, path)
    staged = scratch(spark, "batch")
    try:
        conform(batch).write.parquet(staged)
        source = spark.read.schema(FACT_SCHEMA).parquet(staged)
        months = [r.ym for r in with_month(source).select("ym").distinct().collect()]  # a month list
        if not months:
            return {"updated": 0, "inserted": 0, "rows_before": 0, "rows_after": 0}
        for left in range(ATTEMPTS - 1, -1, -1):
            try:
                return _merge(spark, path, version(spark, path), source, months, strict)
            except Conflict:
                if not left:
                    raise
    finally:
        remove(spark, staged)
