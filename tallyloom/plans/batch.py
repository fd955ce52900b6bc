"""One run: newest export of each source, to fact rows, to the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.counts import run_summary
from tallyloom.operators.dedup import dedup
from tallyloom.operators.order import union_all
from tallyloom.operators.predicates import funded
from tallyloom.schema import FAULT, SourceError, empty_facts, name, warehouse_shape
from tallyloom.settings import RunOptions
from tallyloom.sources import grids as G
from tallyloom.sources.delimited import scan_delimited
from tallyloom.sources.files import newest_files
from tallyloom.sources.leads import lead_facts, lead_rows
from tallyloom.sources.registry import LABELS, LEAD_KEYS, LEADS_LABEL, SOURCES, SourceSpec, lead_header
from tallyloom.sources.storage import exists, move, names, remove, scratch
from tallyloom.sources.tables import upsert

# Columns a fact row carries until duplicates are gone: where it stands in the run.
PLACE = ("_source", "_rank", "_sheet_no", "_row_no")
CRM_RANK = 1 << 20  # lead counts stand after every ad source
TOP_ROWS = 64  # of a sheet, searched for the header before the rest is
WORKBOOKS = (".xlsx", ".xls")


@dataclass
class Parsed:
    """Fact rows of the sources that could be used, and the reason for each other one."""

    facts: DataFrame
    failed: list[tuple[str, str]] = field(default_factory=list)
    files: dict[str, str] = field(default_factory=dict)
    folder: str | None = None  # where the rows are staged


class ChosenSheet(NamedTuple):
    path: str
    sheet: str
    header_row: int | None
    header: list[str | None] | None


# Source health ------------------------------------------------------------------


def source_status(frame: DataFrame) -> DataFrame:
    """Per source: rows, rows with a fault, and the reason it fails (NULL if it does not)."""
    fault = F.col(FAULT)
    counted = frame.groupBy("_source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(fault).alias("faults"),
        F.min(fault).alias("reason"),
    )
    return counted


def verdicts(seen: Mapping[str, tuple[int, str | None]], labels: Sequence[str]) -> list[tuple[str, str]]:
    """(label, reason) of the labels that fail, of (rows, reason of a fault) by label.

    A source fails as a whole; one that yields no row fails as well.
    """
    return [
        (label, seen[label][1] if seen.get(label, (0, None))[0] else "no usable rows")
        for label in labels
        if not seen.get(label, (0, None))[0] or seen[label][1]
    ]


def gate(frame: DataFrame, labels: Sequence[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Rows of the sources without any fault, and (label, reason) of the rest.

    `labels` are those expected; the driver sees one line per label.
    """
    known = source_status(frame.filter(F.col("_source").isin(*labels))).collect()
    failed = verdicts({r["_source"]: (r.rows, r.reason) for r in known}, labels)
    bad = {label for label, _ in failed}
    return frame.filter(F.col("_source").isin([x for x in labels if x not in bad])), failed


def staged_once(frame: DataFrame, labels: Sequence[str]) -> tuple[DataFrame, dict[str, tuple[int, str | None]], str]:
    """The frame written once and read again, (rows, reason) by label, and its folder.

    Rows and faults are observed while the rows are written, so nothing is computed twice.
    The files aren't split by source, as each task would sort all its rows for that; they
    mostly hold one source each, so a filter on it skips those of the others.
    """
    spark, folder, seen = frame.sparkSession, scratch(frame.sparkSession, "parsed"), Observation()
    mine = [F.col("_source") == label for label in labels]
    metrics = [F.count_if(m).alias(f"rows{i}") for i, m in enumerate(mine)]
    metrics += [F.min(F.when(m, F.col(FAULT))).alias(f"fault{i}") for i, m in enumerate(mine)]
    frame.observe(seen, *metrics).write.parquet(folder)
    found = seen.get
    status = {label: (found[f"rows{i}"], found[f"fault{i}"]) for i, label in enumerate(labels)}
    return spark.read.schema(frame.schema).parquet(folder), status, folder


# Reading ------------------------------------------------------------------------


def _by_path(files: Mapping[str, str], value) -> Column:
    """CASE over the chosen files; `value` maps a source key to a column."""
    out = F.lit(None)
    for key, path in files.items():
        out = F.when(F.col("path") == path, value(key)).otherwise(out)
    return out


def chosen_sheets(grid: DataFrame, files: Mapping[str, str], specs: Sequence[SourceSpec]):
    """Sheets to read with their header rows, by path: {path: [(sheet, header_row, header)]}.

    Comes to the driver, as plans are built from it: a few rows per workbook.  Names
    are looked at first, then the top rows of the chosen sheets, then all rows of those
    that have no header there.
    """
    by_key = {s.key: s for s in specs}
    lead = SourceSpec(LEADS_LABEL, "ql", None, header=lead_header)
    spec = lambda key: by_key.get(key, lead)
    mine = grid.filter(F.col("path").isin(*files.values()))
    sheet = F.col("sheet")
    picked = G.choose_sheets(
        mine.select(*G.SHEET).distinct(),
        rule=_by_path(files, lambda k: spec(k).sheet(sheet)),
        fallback=_by_path(files, lambda k: spec(k).fallback(sheet)),
        many=_by_path(files, lambda k: F.lit(spec(k).many)),
    ).collect()

    def heads(sheets, rows: DataFrame) -> dict:
        if not sheets:
            return {}
        here = reduce(
            lambda a, b: a | b,
            [(F.col("path") == s.path) & (F.col("sheet") == s.sheet) for s in sheets],
        )
        is_header = _by_path(files, lambda k: spec(k).header())
        located = G.locate_headers(rows.filter(here), is_header).collect()
        return {(r.path, r.sheet): r for r in located if r.header_row is not None}

    # A header among a sheet's top rows is its first one: the rest of the sheet isn't read.
    found = heads(picked, mine.filter(F.col("row_no") < TOP_ROWS))
    deeper = [s for s in picked if (s.path, s.sheet) not in found]
    found |= heads(deeper, mine)
    out: dict[str, list] = {}
    for s in sorted(picked, key=lambda s: (s.path, s.sheet_no)):
        head = found.get((s.path, s.sheet))
        out.setdefault(s.path, []).append(
            ChosenSheet(s.path, s.sheet, head and head.header_row, head and head.header)
        )
    return out


def raw_tables(grid: DataFrame, sheets: Sequence) -> list[DataFrame]:
    """Raw tables of the given sheets, one per different header row."""
    located = [s for s in sheets if s.header_row is not None]
    if not located:
        raise SourceError("no header row" if sheets else "no matching sheet")
    layouts: dict[tuple, list] = {}
    for s in located:
        layouts.setdefault(tuple(s.header), []).append(s)
    return [
        G.tables_of_layout(grid, [(s.path, s.sheet, s.header_row) for s in group], header)
        for header, group in layouts.items()
    ]


def _placed(facts: DataFrame, label: str, rank: int) -> DataFrame:
    return facts.withColumns({"_source": F.lit(label), "_rank": F.lit(rank)})


def _leads(grid, files, sheets) -> tuple[DataFrame, str]:
    """Fact rows of the lead pair, and the folder its rows are staged in."""
    missing = [f"{k.upper()}_ file missing" for k in LEAD_KEYS if k not in files]
    if missing:
        raise SourceError("; ".join(missing))
    feeds = [
        union_all(lead_rows(t) for t in raw_tables(grid, sheets.get(files[k], []))).withColumn("feed", F.lit(k))
        for k in LEAD_KEYS
    ]
    both, seen = union_all(feeds), Observation()
    folder = scratch(both.sparkSession, "leads")
    both.observe(
        seen,
        *[F.count_if(F.col("feed") == k).alias(k) for k in LEAD_KEYS],
        F.count_if((F.col("feed") == "ft") & funded("Stage")).alias("funded"),
    ).write.parquet(folder)
    for what, why in (
        ("ql", "QL: no valid rows"),
        ("ft", "FT: no valid rows"),
        ("funded", "FT: no rows in a funded stage"),
    ):
        if not seen.get[what]:
            remove(both.sparkSession, folder)
            raise SourceError(why)
    staged = both.sparkSession.read.schema(both.schema).parquet(folder)
    facts = lead_facts(*(staged.filter(F.col("feed") == k).drop("feed") for k in LEAD_KEYS))
    return facts.withColumns(
        {
            "_sheet_no": F.lit(None).cast("int"),
            "_row_no": F.lit(None).cast("bigint"),
            FAULT: F.lit(None).cast("string"),
        }
    ), folder


def delimited_exports(spark: SparkSession, folder: str) -> list[str]:
    """Files of a drop folder that aren't workbooks."""
    return [
        f"{folder.rstrip('/')}/{n}"
        for n in sorted(names(spark, folder))
        if not n.startswith((".", "_")) and not n.lower().endswith(WORKBOOKS)
    ]


def parse_all(
    grid: DataFrame,
    options: RunOptions | None = None,
    specs: Sequence[SourceSpec] = SOURCES,
    tables: Mapping[str, DataFrame] | None = None,
    drop: str | None = None,
) -> Parsed:
    """Fact rows of the newest export of every source; a failing source only gets reported.

    Files come from the grids and, where a source may be delimited text, from the folder
    `drop`; the newest of both is read.  `tables` holds raw tables already read, by source
    key.  All rows are computed once, staged, and read from there by whatever follows.
    """
    options, spark = options or RunOptions(), grid.sparkSession
    tables = dict(tables or {})
    exports = delimited_exports(spark, drop) if drop else []
    manifest = grid.select("path").distinct()
    if exports:
        manifest = manifest.union(spark.createDataFrame([(p,) for p in exports], "path string"))
    files = {r.source: r.path for r in newest_files(manifest).collect()}
    text = {k: p for k, p in files.items() if p in set(exports) and k not in tables}
    on_grid = {k: p for k, p in files.items() if k not in tables and k not in text}
    sheets = chosen_sheets(grid, on_grid, specs) if on_grid else {}
    frames, failed, lead_rows_at = [], [], None

    for rank, spec in enumerate(specs):
        try:
            if spec.key in text:
                if spec.preamble is None:
                    raise SourceError("not a workbook")
                tables[spec.key] = scan_delimited(spark, [text[spec.key]], spec.preamble)
            if spec.key in tables:
                facts = spec.harmonise(tables[spec.key], options)
            elif spec.key in files:
                mine = sheets.get(files[spec.key], [])
                read = spec.reader(mine)
                facts = union_all(read(t, options) for t in raw_tables(grid, mine))
            else:
                raise SourceError("no input file found")
            frames.append(_placed(facts, spec.label, rank).drop("_path", "_sheet"))
        except SourceError as e:
            failed.append((spec.label, str(e)))

    try:
        leads, lead_rows_at = _leads(grid, on_grid, sheets)
        frames.append(_placed(leads, LEADS_LABEL, CRM_RANK))
    except SourceError as e:
        failed.append((LEADS_LABEL, str(e)))

    if not frames:
        return Parsed(empty_facts(spark), failed, files)
    tried = [s.label for s in specs] + [LEADS_LABEL]
    already = {label for label, _ in failed}
    left = [x for x in tried if x not in already]
    facts, status, folder = staged_once(union_all(frames), left)
    if lead_rows_at:
        remove(spark, lead_rows_at)
    more = verdicts(status, left)
    bad = {label for label, _ in more}
    facts = facts.filter(F.col("_source").isin([x for x in left if x not in bad]))
    order = {label: i for i, label in enumerate(tried)}
    return Parsed(facts.drop(FAULT), sorted(failed + more, key=lambda f: order[f[0]]), files, folder)


# The run ------------------------------------------------------------------------


def place_number(sheet_no: Column, row_no: Column) -> Column:
    """Sheet and row as one number: row numbers use the lower 55 bits."""
    return F.shiftleft(F.coalesce(sheet_no, F.lit(0)).cast("bigint"), 55) + F.coalesce(
        row_no, F.lit(0)
    )


def deduplicated(facts: DataFrame, run_date=None, **ad_options) -> DataFrame:
    """Stamped facts, one row per key, firsts taken in the order of the run.

    An ad key names its channel and so its source; sheet and row are order enough.
    Lead-signature rows of ad exports come before the lead counts and are ranked by
    campaign, as the run's presentation order has them.
    """
    shaped = warehouse_shape(facts, run_date, extras=PLACE).withColumns(
        {
            "_place": place_number(F.col("_sheet_no"), F.col("_row_no")),
            "_late": F.col("_rank") == CRM_RANK,
            "_unnamed": name("Campaign").isNull(),
        }
    )
    return dedup(
        shaped,
        ["_place"],
        lead_order=["_late", "_unnamed", "Campaign", "_rank", "_place"],
        group_from_channel=True,
        **ad_options,
    )


def archive_files(spark: SparkSession, parsed: Parsed, archive: str, labels: Mapping[str, str]) -> dict[str, str]:
    """Move the files of sources that succeeded; a name that is taken gets a suffix.  New paths by source."""
    failed = {label for label, _ in parsed.failed}
    done = {k: p for k, p in parsed.files.items() if labels.get(k) not in failed and exists(spark, p)}
    moved = {p: move(spark, p, archive) for p in sorted(set(done.values()))}
    return {k: moved[p] for k, p in done.items()}


def run(
    spark: SparkSession,
    table: str,
    grid: DataFrame,
    options: RunOptions | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    drop: str | None = None,
    archive: str | None = None,
) -> dict:
    """Parse, upsert, and report: failed sources, summary counts, change counts.

    The parsed rows are staged once: gate, summary and upsert read them from there.  With
    `archive`, files that were merged are moved there once the table has them.
    """
    options = options or RunOptions()
    parsed = parse_all(grid, options, tables=tables, drop=drop)
    try:
        summary = run_summary(parsed.facts).first().asDict()
        report = {"failed": parsed.failed, "files": parsed.files, **summary}
        if summary["total_rows"]:
            report.update(upsert(spark, table, deduplicated(parsed.facts, options.run_date)))
    finally:
        if parsed.folder:
            remove(spark, parsed.folder)
    if archive:
        report["archived"] = archive_files(spark, parsed, archive, LABELS)
    return report
