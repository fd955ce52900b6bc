"""Which file to read for each source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.functions.dates import yymmdd
from tallyloom.operators.sequence import newest_per_group


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def sources_of(file_name: Column, patterns: Mapping[str, str] = S.FILE_PATTERNS) -> Column:
    """Array of the sources a file name belongs to.

    A name with a longer pattern that begins like this one belongs to the longer only.
    """
    hits = []
    for key, text in patterns.items():
        longer = [p for p in patterns.values() if p != text and p.startswith(text)]
        hit = file_name.contains(text)
        for p in longer:
            hit = hit & ~file_name.contains(p)
        hits.append(F.when(hit, F.lit(key)))
    return F.array_compact(F.array(*hits))


def name_day(file_name: Column) -> Column:
    """YYMMDD number from the first six digits in a row, 0 without any."""
    digits = F.regexp_extract(file_name, r"(\d{6})", 1)
    return F.when(digits == "", F.lit(0)).otherwise(yymmdd(digits).try_cast("int"))


def newest_files(
    manifest: DataFrame, patterns: Mapping[str, str] = S.FILE_PATTERNS
) -> DataFrame:
    """(source, path) of the newest file of each source in a table of paths."""
    file_name = base_name(F.col("path"))
    listed = manifest.select(
        "path",
        name_day(file_name).alias("day"),
        F.explode(sources_of(file_name, patterns)).alias("source"),
    )
    return newest_per_group(listed, "source", F.col("day"), "path")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of a drop folder: names only, no contents are read."""
    return (
        spark.read.format("binaryFile").load(folder).select("path")
    )
