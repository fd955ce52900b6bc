"""Delimited text with preamble lines before the header; quoted cells may hold line breaks.

Which lines begin a record depends on all quotes before them in the file.  Each line turns
one state into another: between records, or inside a quoted cell.  Lines are taken in
order within their split, by the task that reads it, splits by what they do to the state
as a whole; so the text isn't shuffled.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.schema import SourceError
from tallyloom.sources.grids import by_name, unique_headers, with_names
from tallyloom.sources.storage import scratch

_UNIT = 1 << 16  # bytes; file splits are larger than this
_BITS = 31  # of a line number, for the place among the lines of a task


def line_number() -> Column:
    """Number that grows with the line's place in its file.

    The split's start (in units of 64 KiB) comes first, then the line's place in the
    task that reads the split.  Needs no sort and no second pass; numbers have gaps.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _BITS) - 1))
    start = F.floor(F.col("_metadata.file_block_start") / F.lit(_UNIT)).cast("bigint")
    return F.shiftleft(start, _BITS) + place


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with file and number; their bytes are as in the file, valid text or not."""
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("_path"),
        line_number().alias("_row_no"),
        F.col("value"),
    )


def from_windows_1252(text: Column) -> Column:
    """Text whose bytes are Windows-1252: Latin-1 but for the characters at 0x80 to 0x9f."""
    latin, windows = "", ""
    for byte in range(0x80, 0xA0):
        char = bytes([byte]).decode("cp1252", errors="ignore")
        if char:
            latin, windows = latin + chr(byte), windows + char
    return F.translate(F.decode(text.cast("binary"), "ISO-8859-1"), latin, windows)


def decoded_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of files in UTF-8, or in Windows-1252 where a file is not valid UTF-8."""
    lines = read_lines(spark, paths)
    broken = lines.filter(~F.is_valid_utf8("value")).select("_path").distinct()
    joined = lines.join(F.broadcast(broken.withColumn("_broken", F.lit(True))), "_path", "left")  # a row per file
    value = F.col("value")
    text = F.when(F.col("_broken"), from_windows_1252(value)).otherwise(value)
    return joined.select("_path", "_row_no", text.alias("value"))


def _staged(df: DataFrame, what: str) -> DataFrame:
    """df written to a folder of its own and read again, as several steps need it."""
    folder = scratch(df.sparkSession, what)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _ends_inside(value: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line that begins between records, or inside a quoted cell, ends inside one.

    A cell is quoted if it begins with a quote; inside, a doubled quote stands for one.
    """
    other = rf"[^\x{ord(sep):02x}]"
    quoted = r'[^"]*+(?:""[^"]*+)*+"' + other + "*+"
    cell = rf'(?:"{quoted}|[^"\x{ord(sep):02x}]{other}*+|)'
    more = rf"(?:\x{ord(sep):02x}{cell})*+\z"
    plain = ~value.contains('"')
    from_outside = F.when(plain, F.lit(False)).otherwise(~value.rlike(rf"\A{cell}{more}"))
    from_inside = F.when(plain, F.lit(True)).otherwise(~value.rlike(rf"\A{quoted}{more}"))
    return from_outside, from_inside


def _carried(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Add what all rows up to and with this one do to the state, and what those before do.

    A row either sets the state (`_sets`, NULL if not) or may turn it over (`_turns`, 0 or
    1); so do rows in a row: the last one that sets it counts, and the turns since.
    """
    line = Window.partitionBy(*by).orderBy(order)
    sofar = line.rowsBetween(Window.unboundedPreceding, 0)
    turns = F.sum("_turns").over(sofar)
    df = df.withColumn("_t", turns).withColumn(
        "_last", F.last(F.when(F.col("_sets").isNotNull(), F.struct("_sets", "_t")), ignorenulls=True).over(sofar)
    )
    odd = F.pmod(F.col("_t") - F.coalesce(F.col("_last._t"), F.lit(0)), F.lit(2))
    state = F.struct((F.col("_last._sets") != (odd == 1)).alias("sets"), odd.alias("turns"))
    df = df.withColumn("_after", state)
    return df.withColumn("_before", F.lag("_after").over(line)).drop("_t", "_last")


def _applied(change: Column, state: Column) -> Column:
    """The state after a change."""
    return F.coalesce(change["sets"], state != (F.coalesce(change["turns"], F.lit(0)) == 1))


def _within_splits() -> tuple:
    """(summed, joined): what a task does with its lines, batch by batch.

    Nested, so that they are sent along and workers need no copy of this package.
    """

    def states(outside: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line ends inside a cell, if the first one begins between records or inside one."""
        sets, turns, at = outside == inside, np.cumsum(outside & ~inside), np.arange(len(outside))
        last = np.maximum.accumulate(np.where(sets, at, -1))
        since = np.where(last >= 0, turns - turns[np.maximum(last, 0)], turns) % 2 == 1
        fixed = outside[np.maximum(last, 0)]
        return tuple(np.where(last >= 0, fixed, begin) ^ since for begin in (False, True))

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        """The batch's lines by split, in order."""
        path, block = batch.column("_path"), batch.column("_block").to_numpy()
        new = (block[1:] != block[:-1]) | pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:], strict=False):
            if stop > start:
                yield (path[start].as_py(), int(block[start])), batch.slice(start, stop - start)

    def flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("_o", "_i"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per split: where it ends and the records that begin in it, for either state at its start."""
        done: dict[tuple, list] = {}
        for batch in batches:
            for key, lines in runs(batch):
                ends = states(*flags(lines))
                now = done.setdefault(key, [False, True, 0, 0])
                for k in (0, 1):
                    begin = now[k]
                    mine = ends[int(begin)]
                    now[2 + k] += int(not begin) + int(np.count_nonzero(~mine[:-1]))
                    now[k] = bool(mine[-1])
        columns = [[key[0] for key in done], [key[1] for key in done], *([v[k] for v in done.values()] for k in range(4))]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["_path", "_block", "_open0", "_open1", "_n0", "_n1"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records of each split with their place; what may go on in the next split, or comes from one before, by itself.

        `_part`: 0 a whole record, 1 the last one of a split, 2 lines of an earlier split's record.
        """
        names = ["_path", "_block", "_row_no", "_nth", "value", "_part"]

        def out(key, rows, nths, values, part):
            n = len(values)
            columns = [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array(rows, pa.int64()), pa.array(nths, pa.int64()), values, pa.array([part] * n, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names)

        key, state, held = None, False, []  # of the split at hand; held: (row_no, nth, lines) of its last record

        def last():
            row, nth, lines = held
            return out(key, [row], [nth], pa.array(["\n".join(lines)], pa.string()), 2 if nth is None else 1)

        for batch in batches:
            for split, lines in runs(batch):
                if split != key:
                    if held:
                        yield last()
                    key, state, held = split, lines.column("_begin")[0].as_py(), []
                    seen = lines.column("_passed")[0].as_py()
                ends = states(*flags(lines))[int(state)]
                first = ~np.r_[state, ends[:-1]]
                rows, values, state = lines.column("_row_no"), lines.column("value"), bool(ends[-1])
                heads = np.flatnonzero(first)
                before = values[: heads[0] if len(heads) else len(values)].to_pylist()
                if before:
                    held = held or [rows[0].as_py(), None, []]
                    held[2].extend(before)
                if not len(heads):
                    continue
                if held:
                    whole = last()
                    yield whole if held[1] is None else whole.set_column(5, "_part", pa.array([0], pa.int32()))
                offsets = pa.array(heads, pa.int32())
                texts = pc.binary_join(pa.ListArray.from_arrays(offsets, values.slice(0, int(heads[-1]))), "\n") if len(heads) > 1 else pa.array([], pa.string())
                at = rows.to_numpy()[heads]
                if len(texts):
                    yield out(key, at[:-1], np.arange(seen, seen + len(texts)), texts, 0)
                seen += len(heads)
                held = [int(at[-1]), seen - 1, values[int(heads[-1]) :].to_pylist()]
        if held:
            yield last()

    return summed, joined


def _assembled(lines: DataFrame, sep: str) -> DataFrame:
    """(path, number, nth, value) of records; those of several lines have them joined.

    Lines are joined where they are read: a row per split carries the state across, and only
    records that may go on in the next split are put together by a shuffle.
    """
    summed, joined = _within_splits()
    outside, inside = _ends_inside(F.col("value"), sep)
    rows = lines.withColumns({"_block": F.shiftright("_row_no", _BITS), "_o": outside, "_i": inside})
    split = ["_path", "_block"]
    splits = rows.select(*split, "_o", "_i").mapInArrow(summed, "_path string, _block long, _open0 boolean, _open1 boolean, _n0 long, _n1 long")
    zero, one = F.col("_open0"), F.col("_open1")
    splits = splits.withColumns({"_sets": F.when(zero == one, zero), "_turns": (zero & ~one).cast("int")})
    splits = _staged(_carried(splits, ["_path"], "_block"), "splits")
    at_start = F.lit(False)
    ends = splits.select("_path", "_block", _applied(F.col("_after"), at_start).alias("_open"))
    never = ends.groupBy("_path").agg(F.max_by("_open", "_block").alias("_open")).filter("_open").first()
    if never:
        raise SourceError(f"a quoted cell is never closed in {never._path.rsplit('/', 1)[-1]}")
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(_applied(F.col("_before"), at_start), at_start)
    splits = splits.withColumn("_begin", begin).select(
        *split, "_begin", F.coalesce(F.sum(F.when(F.col("_begin"), F.col("_n1")).otherwise(F.col("_n0"))).over(earlier), F.lit(0)).alias("_passed")
    )
    rows = rows.join(F.broadcast(splits), split).select(*split, "_row_no", "value", "_o", "_i", "_begin", "_passed")
    schema = "_path string, _block long, _row_no long, _nth long, value string, _part int"
    found = _staged(rows.mapInArrow(joined, schema), "records")
    open_ = found.filter("_part > 0")
    sofar = Window.partitionBy("_path").orderBy("_block", "_row_no").rowsBetween(Window.unboundedPreceding, 0)
    open_ = open_.withColumn("_record", F.max(F.when(F.col("_part") == 1, F.col("_row_no"))).over(sofar))
    parts = F.array_sort(F.collect_list(F.struct("_row_no", "value")))["value"]
    ended = open_.groupBy("_path", F.col("_record").alias("_row_no")).agg(F.max("_nth").alias("_nth"), F.concat_ws("\n", parts).alias("value"))
    return found.filter("_part = 0").select("_path", "_row_no", "_nth", "value").unionByName(ended)


def read_records(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """Records with file, number, place in the file (`_nth`, from 0) and text.

    Files in which every line is a record by itself (none ends inside a quoted cell) are
    numbered without sorting them; the others' lines are put together.
    """
    lines = decoded_lines(spark, paths)
    block = F.shiftright("_row_no", _BITS).alias("_block")
    splits = lines.groupBy("_path", block).agg(
        F.min("_row_no").alias("_top"), F.count(F.lit(1)).alias("_n"), F.max(_ends_inside(F.col("value"), sep)[0]).alias("_opens")
    )
    file, earlier = Window.partitionBy("_path"), Window.partitionBy("_path").orderBy("_block")
    passed = F.coalesce(F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("_path", "_block", "_top", passed.alias("_passed"), F.max("_opens").over(file).alias("_opens"))
    splits = _staged(splits, "splits")  # one row per split
    plain = lines.withColumn("_block", block).join(F.broadcast(splits.filter("NOT _opens")), ["_path", "_block"])
    plain = plain.select("_path", "_row_no", (F.col("_passed") + F.col("_row_no") - F.col("_top")).alias("_nth"), "value")
    opened = splits.filter("_opens").select("_path").distinct()
    if opened.isEmpty():
        return plain
    return plain.unionByName(_assembled(lines.join(F.broadcast(opened), "_path"), sep))


def _header_lines(records: DataFrame, skip: int) -> DataFrame:
    """(path, header_row, header) of each file: its first filled record after the preamble.

    One aggregate and no sort; any number of blank lines may stand before the header.
    """
    filled = records.filter((F.col("_nth") >= skip) & (F.trim("value") != ""))
    return filled.groupBy("_path").agg(
        F.min("_row_no").alias("header_row"),
        F.min_by("value", "_row_no").alias("header"),
    )


def scan_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    skip: int = S.PREAMBLE_ROWS,
    sep: str = ",",
) -> DataFrame:
    """Raw text table of files of any number of layouts, columns by name; records are parsed once.

    A file whose last quoted cell is never closed is refused, as its records can't be told.
    A carriage return before a line break inside a cell is dropped.
    """
    lines = read_records(spark, paths, sep)
    names_of = lambda header: unique_headers(next(csv.reader(io.StringIO(header, newline=""), delimiter=sep)))
    named, labels, widest = with_names(_header_lines(lines, skip), names_of)
    body = lines.join(F.broadcast(named), "_path").filter(
        (F.col("_row_no") > F.col("header_row")) & (F.trim("value") != "")
    )
    schema = ", ".join(f"c{i} STRING" for i in range(widest))
    parsed = body.select(F.from_csv("value", schema, {"sep": sep, "escape": '"'}).alias("_r"), "_path", "_row_no", "_places")
    cells = F.array(*[F.col(f"_r.c{i}") for i in range(widest)])
    return parsed.select(
        *[by_name(cells, i).alias(n) for i, n in enumerate(labels)],
        "_path",
        F.lit("").alias("_sheet"),
        F.lit(1).alias("_sheet_no"),
        "_row_no",
    )
