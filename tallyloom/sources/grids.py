"""Sheets landed as rows of cells, and the raw tables found in them.

A grid frame has columns source, path, sheet, sheet_no, row_no, cells; `row_no` is
unique in a sheet and grows downwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import settings as S
from tallyloom.functions.scalars import code, strip
from tallyloom.schema import SourceError

GRID_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("sheet_no", T.IntegerType()),
        T.StructField("row_no", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)
SHEET = ("path", "sheet", "sheet_no")
OPEN_FILES = 16  # sources whose rows a task lands unsorted, a file open for each; with more, Spark sorts the rest
ROW_GROUP = 32 << 20  # bytes, so that a task's open files hold 512 MB at most


def scan_grid(spark: SparkSession, folder: str, source: str | None = None, fmt="parquet") -> DataFrame:
    """Landed grids; a source filter prunes folders when the landing is split by source."""
    grid = spark.read.format(fmt).schema(GRID_SCHEMA).load(folder)
    return grid if source is None else grid.filter(F.col("source") == source)


def land_grid(grid: DataFrame, folder: str, mode: str = "append") -> None:
    """Write the grid, split by source.

    A task would sort all its rows by source in memory, which grows with them; it keeps a
    file open for each source instead.  That is a setting of the session, put back at the end.
    """
    conf, key = grid.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(OPEN_FILES))
    try:
        grid.write.mode(mode).option("parquet.block.size", ROW_GROUP).partitionBy("source").parquet(folder)
    finally:
        conf.set(key, before)


# Header rows -------------------------------------------------------------------


def first_row() -> Column:
    """The sheet's first row is the header."""
    return F.lit(True)


def some_cell_contains(text: str) -> Column:
    return F.exists("cells", lambda x: F.coalesce(x.contains(text), F.lit(False)))


def cells_equal(*texts: str) -> Column:
    """Some cell equals each of the texts."""
    wanted = F.array(*[F.lit(t) for t in texts])
    return F.size(F.array_except(wanted, F.col("cells"))) == 0


def cells_cover(texts: Sequence[str]) -> Column:
    """Each text is found among the trimmed cells, case ignored."""
    wanted = F.array(*[F.lit(t.lower()) for t in texts])
    return F.size(F.array_except(wanted, F.transform("cells", lambda x: F.lower(strip(x))))) == 0


def position_of(text: str, header: str = "header") -> Column:
    """0-based place of the first cell equal to the text, case and blanks ignored."""
    low = F.transform(header, lambda x: F.lower(strip(x)))
    return F.nullif(F.array_position(low, text.lower()), F.lit(0)) - 1


def locate_headers(grid: DataFrame, is_header: Column, by: Sequence[str] = SHEET) -> DataFrame:
    """One row per sheet: header_row and header, NULL where no row qualifies.

    An aggregate over each task's own rows first, so a sheet of any size is fine.
    """
    at = F.when(is_header, F.col("row_no"))
    return grid.groupBy(*by).agg(
        F.min(at).alias("header_row"), F.min_by("cells", at).alias("header")
    )


# Sheet choice ------------------------------------------------------------------

SheetRule = Callable[[Column], Column]


def any_sheet(sheet: Column) -> Column:
    return F.lit(True)


def has_word(*words: str) -> SheetRule:
    def rule(sheet):
        return F.lower(sheet).rlike("|".join(words))

    return rule


def is_daily(sheet: Column) -> Column:
    return sheet == "Daily"


def is_daily_any_case(sheet: Column) -> Column:
    return F.lower(sheet) == "daily"


def not_daily(sheet: Column) -> Column:
    return F.lower(sheet) != "daily"


def country_sheet(sheet: Column) -> Column:
    return code(sheet).isin(*S.APAC)


def no_sheet(sheet: Column) -> Column:
    return F.lit(False)


def choose_sheets(
    sheets: DataFrame,
    rule: Column,
    fallback: Column | None = None,
    many: Column | bool = False,
    by: Sequence[str] = ("path",),
) -> DataFrame:
    """Keep the first sheet of each file that satisfies the rule, or all that do (`many`).

    A file without any keeps its first sheet that satisfies `fallback` (default: any).
    Works on one row per sheet, so the groups are the sheets of one workbook.
    """
    many = F.lit(many) if isinstance(many, bool) else many
    fallback = F.lit(True) if fallback is None else fallback
    workbook = W.partitionBy(*by)
    order = workbook.orderBy(F.col("_fits").desc(), F.col("_falls").desc(), "sheet_no")
    return (
        sheets.withColumns(
            {
                "_fits": F.coalesce(rule, F.lit(False)),
                "_falls": F.coalesce(fallback, F.lit(False)),
            }
        )
        .withColumns(
            {"_n": F.row_number().over(order), "_any": F.max("_fits").over(workbook)}
        )
        .filter(
            F.when(many & F.col("_any"), F.col("_fits")).otherwise(
                (F.col("_n") == 1) & (F.col("_fits") | F.col("_falls"))
            )
        )
        .drop("_fits", "_falls", "_n", "_any")
    )


# Tables ------------------------------------------------------------------------


def unique_headers(cells: Sequence[str | None]) -> list[str]:
    """Column names of a header row: blanks get a name, repeats a suffix."""
    seen: dict[str, int] = {}
    out = []
    for i, cell in enumerate(cells):
        label = cell if cell not in (None, "") else f"Unnamed: {i}"
        again = seen.get(label.lower(), 0)
        seen[label.lower()] = again + 1
        out.append(f"{label}.{again}" if again else label)
    return out


def named_cells(grid: DataFrame, header: Sequence[str | None]) -> DataFrame:
    """Cells as named text columns next to the row's origin."""
    return grid.select(
        *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(unique_headers(header))],
        F.col("path").alias("_path"),
        F.col("sheet").alias("_sheet"),
        F.col("sheet_no").alias("_sheet_no"),
        F.col("row_no").alias("_row_no"),
    )


def table_below(grid: DataFrame, path: str, sheet: str, header_row: int, header) -> DataFrame:
    """Raw table of one sheet whose header is known: filters with constants, no join."""
    body = grid.filter(
        (F.col("path") == path) & (F.col("sheet") == sheet) & (F.col("row_no") > header_row)
    )
    return named_cells(body, header)


def tables_of_layout(grid: DataFrame, sheets: Sequence[tuple[str, str, int]], header) -> DataFrame:
    """Raw table of all (path, sheet, header_row) that share a header: one scan, no join."""
    below = [
        (F.col("path") == path) & (F.col("sheet") == sheet) & (F.col("row_no") > top)
        for path, sheet, top in sheets
    ]
    return named_cells(grid.filter(reduce(lambda a, b: a | b, below)), header)


def with_names(heads: DataFrame, names_of: Callable) -> tuple[DataFrame, list[str], int]:
    """Heads with `_places`, all the names there are, and the most cells a header has.

    `_places` holds the place of each of the names in the head's own layout (case ignored),
    NULL where it has none: found once per layout, not for each row.  The driver sees the
    different header rows, nothing else; how many there are does not change the plan.
    """
    layouts = [(r.header, names_of(r.header)) for r in heads.select("header").distinct().collect()]
    if not layouts:
        raise SourceError("no header row")
    labels: dict[str, str] = {}
    for _, names in sorted(layouts, key=lambda x: x[1]):
        for n in names:
            labels.setdefault(n.lower(), n)
    placed = []
    for header, names in layouts:
        at = {n.lower(): i for i, n in reversed(list(enumerate(names)))}
        placed.append((header, [at.get(low) for low in labels]))
    kind = heads.schema["header"].dataType.simpleString()
    known = heads.sparkSession.createDataFrame(placed, f"_header {kind}, _places array<int>")
    named = heads.join(known, F.col("header") == F.col("_header")).drop("header", "_header")
    return named, list(labels.values()), max(len(names) for _, names in layouts)


def by_name(cells: Column, nth: int) -> Column:
    """The cell of the nth name of all, NULL in a layout without it."""
    return F.get(cells, F.get("_places", F.lit(nth)))


def tables_below(grid: DataFrame, heads: DataFrame) -> DataFrame:
    """Raw table of all the sheets in `heads` (from `locate_headers`), columns by name.

    The sheets are read once, whatever the number of layouts.  Whether the sheet list is
    broadcast is left to adaptive execution.
    """
    named, labels, _ = with_names(heads.filter(F.col("header_row").isNotNull()), unique_headers)
    rows = grid.join(named.select(*SHEET, "header_row", "_places"), list(SHEET))
    return rows.filter(F.col("row_no") > F.col("header_row")).select(
        *[by_name(F.col("cells"), i).alias(n) for i, n in enumerate(labels)],
        F.col("path").alias("_path"),
        F.col("sheet").alias("_sheet"),
        F.col("sheet_no").alias("_sheet_no"),
        F.col("row_no").alias("_row_no"),
    )
