"""Finding files, scanning text and grids, choosing sheets, finding headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.functions.scalars import to_num
from tallyloom.operators.order import union_all
from tallyloom.plans.queries.base import (
    EXPORT,
    LEAD_FACTS,
    LEAD_RAW,
    OPTIONS,
    RUN_DATE,
    plain,
    query,
    sql_num,
)
from tallyloom.schema import FACT_COLUMNS, stamp
from tallyloom.sources import grids as G
from tallyloom.sources import leads
from tallyloom.sources.delimited import scan_delimited
from tallyloom.sources.files import newest_files
from tallyloom.sources.registry import SOURCES, lead_header
from tallyloom.sources.storage import scratch

EXP = plain(EXPORT)

# One file name per order: dated names of several sources, some without a date.
MANIFEST = """
SELECT '/drop/' || CASE o_custkey % 6 WHEN 0 THEN 'Meta_' WHEN 1 THEN 'Meta_Agency_'
 WHEN 2 THEN 'x Bing_' WHEN 3 THEN 'QL_' WHEN 4 THEN 'TA_Media_' ELSE 'notes ' END
 || CASE WHEN o_orderpriority = '1-URGENT' THEN 'undated' ELSE
  substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 9, 2)
  || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 6, 2)
  || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 3, 2) END
 || ' ' || o_orderstatus || '.csv' AS path
FROM {orders}
"""


@query(
    "a01_newest_file",
    f"""WITH m AS (SELECT path, CASE WHEN path LIKE '%Meta_Agency_%' THEN 'meta_agency'
  WHEN path LIKE '%Meta_%' THEN 'meta' WHEN path LIKE '%Bing_%' THEN 'bing'
  WHEN path LIKE '%QL_%' THEN 'ql' WHEN path LIKE '%TA_Media_%' THEN 'ta_media' END AS source,
  regexp_extract(path, '([0-9]{{6}})', 1) AS d FROM ({plain(MANIFEST)})),
 k AS (SELECT *, CASE WHEN d = '' THEN 0
  ELSE CAST(substr(d, 5, 2) || substr(d, 3, 2) || substr(d, 1, 2) AS INT) END AS day FROM m)
 SELECT source, arg_min(path, (-day, path)) AS path FROM k WHERE source IS NOT NULL GROUP BY 1""",
)
def _(t):
    return newest_files(t.sql(MANIFEST))


def write_exports(lines: DataFrame, preamble: list[str], folder: str) -> None:
    """Write text lines as files that all start with the preamble."""
    import pyarrow as pa

    def with_preamble(batches):
        schema = pa.schema([("value", pa.string())])
        yield pa.RecordBatch.from_arrays([pa.array(preamble, pa.string())], schema=schema)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string())], schema=schema)

    lines.mapInArrow(with_preamble, "value STRING").write.mode("overwrite").text(folder)


def csv_line(*columns):
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"')) for c in columns]
    return F.concat_ws(",", *quoted).alias("value")


@query(
    "a02_delimited_scan",
    f"""SELECT camp, land, {sql_num('amount')} AS amount, count(*) AS n
 FROM (SELECT nullif(camp, '') AS camp, land, amount FROM ({EXP})) GROUP BY 1, 2, 3""",
)
def _(t):
    folder = scratch(t.spark, "exports")
    preamble = [f"report line {i}" for i in range(S.PREAMBLE_ROWS)] + ["camp,land,amount"]
    write_exports(t.sql(EXPORT).select(csv_line("camp", "land", "amount")), preamble, folder)
    raw = scan_delimited(t.spark, [folder])
    return (
        raw.withColumn("amount", to_num(F.col("amount")))
        .withColumn("camp", F.when(F.col("camp") != "", F.col("camp")))
        .withColumn("land", F.when(F.col("land") != "", F.col("land")))
        .groupBy("camp", "land", "amount")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "a02_quoted_records",
    f"""SELECT camp || chr(10) || '"' || brand || '", ' || chr(10) || chr(10) AS note, land, {sql_num('amount')} AS amount,
 count(*) AS n FROM (SELECT coalesce(camp, '') AS camp, brand, coalesce(land, '') AS land, amount FROM ({EXP}))
 GROUP BY 1, 2, 3""",
)
def _(t):
    """Cells with line breaks, quotes and commas, in the preamble as well."""
    folder = scratch(t.spark, "exports")
    preamble = [f"report line {i}" for i in range(S.PREAMBLE_ROWS - 1)] + ['"over', 'two"', "note,land,amount"]
    text = t.sql(EXPORT).withColumn(
        "note", F.concat(F.coalesce("camp", F.lit("")), F.lit('\n""'), "brand", F.lit('"", \n\n'))
    )
    write_exports(text.select(csv_line("note", "land", "amount")), preamble, folder)
    raw = scan_delimited(t.spark, [folder])
    return (
        raw.withColumn("amount", to_num(F.col("amount")))
        .withColumn("land", F.coalesce("land", F.lit("")))
        .groupBy("note", "land", "amount")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# Every line item as a grid row.  Six sheets per file; a title row and a header row on
# top of each, the header lying in row 1.
SHEETS = """CASE line % 6 WHEN 1 THEN 'Summary' WHEN 2 THEN 'Raw export' WHEN 3 THEN 'my DATA'
 WHEN 4 THEN 'Daily' WHEN 5 THEN 'daily' ELSE ' vn ' END"""


def grid(t, header: list[str], cells: list[str], one_sheet: bool = False) -> DataFrame:
    """Grid of the export rows: given expressions as cells, given texts as header."""
    name, number = ("'Daily'", "1") if one_sheet else (SHEETS, "CAST(line % 6 AS INT)")
    rows = t.sql(EXPORT).select(
        F.lit("any").alias("source"),
        F.col("pth").alias("path"),
        F.expr(name).alias("sheet"),
        F.expr(number).cast("int").alias("sheet_no"),
        F.col("rn").alias("row_no"),
        F.array(*[F.expr(c).cast("string") for c in cells]).alias("cells"),
    )
    sheets = rows.select("source", "path", "sheet", "sheet_no").distinct()
    pad = [F.lit(None).cast("string")] * (len(header) - 1)
    tops = [
        sheets.select(
            "*", F.lit(i).cast("bigint").alias("row_no"), F.array(*texts).alias("cells")
        )
        for i, texts in enumerate(
            ([F.lit("exported by nobody"), *pad], [F.lit(h) for h in header])
        )
    ]
    return union_all([*tops, rows])


@query(
    "a03_grid_scan",
    f"""SELECT 'drop/f' || supp AS path, line % 6 AS sheet_no, camp AS c0, clk AS c1, count(*) AS n
 FROM ({EXP}) WHERE line % 6 = 4 GROUP BY ALL""",
)
def _(t):
    folder = scratch(t.spark, "landing")
    G.land_grid(grid(t, ["Campaign", "Clicks"], ["camp", "clk"]), folder)
    rows = G.scan_grid(t.spark, folder, "any").filter(
        (F.col("sheet") == "Daily") & (F.col("row_no") > 1)
    )
    return rows.groupBy(
        "path", "sheet_no", F.get("cells", F.lit(0)).alias("c0"), F.get("cells", F.lit(1)).alias("c1")
    ).agg(F.count(F.lit(1)).alias("n"))


RULES = {
    "first": (G.any_sheet, None, False),
    "word": (G.has_word("raw", "data"), None, False),
    "required": (G.is_daily, G.no_sheet, False),
    "other": (G.not_daily, None, False),
    "any case": (G.is_daily_any_case, None, False),
    "countries": (G.country_sheet, G.no_sheet, True),
}


def chosen_by(label, rule, fallback, many, sheets):
    other = None if fallback is None else fallback(F.col("sheet"))
    picked = G.choose_sheets(sheets, rule(F.col("sheet")), other, many)
    return picked.select(F.lit(label).alias("rule"), "path", "sheet")


SHEET_LIST = f"SELECT DISTINCT pth AS path, {SHEETS} AS sheet, line % 6 AS no FROM ({EXP})"
FIRST_OF = "arg_min(sheet, (CASE WHEN {} THEN 0 ELSE 1 END, no))"


@query(
    "a04_choose_sheet",
    f"""WITH s AS ({SHEET_LIST})
 SELECT 'first' AS rule, path, {FIRST_OF.format('true')} AS sheet FROM s GROUP BY path
 UNION ALL SELECT 'word', path, {FIRST_OF.format("lower(sheet) LIKE '%raw%' OR lower(sheet) LIKE '%data%'")}
  FROM s GROUP BY path
 UNION ALL SELECT 'required', path, 'Daily' FROM s WHERE sheet = 'Daily'
 UNION ALL SELECT 'other', path, {FIRST_OF.format("lower(sheet) <> 'daily'")} FROM s GROUP BY path
 UNION ALL SELECT 'any case', path, {FIRST_OF.format("lower(sheet) = 'daily'")} FROM s GROUP BY path
 UNION ALL SELECT 'countries', path, sheet FROM s WHERE upper(trim(sheet)) = 'VN'""",
)
def _(t):
    sheets = t.sql(EXPORT).select(
        F.col("pth").alias("path"),
        F.expr(SHEETS).alias("sheet"),
        F.expr("CAST(line % 6 AS INT)").alias("sheet_no"),
    ).distinct()
    return union_all(chosen_by(k, *v, sheets) for k, v in RULES.items())


@query(
    "a05_header_row",
    f"""WITH s AS (SELECT DISTINCT pth AS path, line % 6 AS sheet_no FROM ({EXP}))
 SELECT rule, path, sheet_no, 1 AS header_row, col_no FROM s,
 (VALUES ('contains', 0), ('equal', 0), ('cover', 2), ('first', 0)) r(rule, col_no)
 WHERE rule <> 'first'
 UNION ALL SELECT 'first', path, sheet_no, 0, NULL FROM s""",
)
def _(t):
    g = grid(t, ["Day", "Campaign name", "stage ", "Campaign"], ["iso", "camp", "flag", "brand"])
    rules = {
        "contains": G.some_cell_contains("Campaign name"),
        "equal": G.cells_equal("Day", "Campaign"),
        "cover": G.cells_cover(["STAGE", "day"]),
        "first": G.first_row(),
    }
    sought = {"contains": "day", "equal": "day", "cover": "Stage", "first": "day"}
    return union_all(
        G.locate_headers(g, p).select(
            F.lit(rule).alias("rule"),
            "path",
            "sheet_no",
            "header_row",
            G.position_of(sought[rule]).alias("col_no"),
        )
        for rule, p in rules.items()
    )


@query(
    "a05_tables_below",
    f"""SELECT pth AS path, camp, {sql_num('clk')} AS clicks, count(*) AS n
 FROM ({EXP}) WHERE line % 6 IN (2, 3) AND ({sql_num('clk')}) IS NOT NULL AND
 line % 6 = (SELECT min(x.line % 6) FROM ({EXP}) x WHERE x.pth = pth AND x.line % 6 IN (2, 3))
 GROUP BY 1, 2, 3""",
)
def _(t):
    g = grid(t, ["Campaign name", "Clicks"], ["camp", "clk"])
    heads = G.choose_sheets(
        G.locate_headers(g, G.some_cell_contains("Campaign name")),
        G.has_word("raw", "data")(F.col("sheet")),
    )
    raw = G.tables_below(g, heads)
    return (
        raw.select(
            F.col("_path").alias("path"),
            F.col("`Campaign name`").alias("camp"),
            to_num(F.col("Clicks")).alias("clicks"),
        )
        .groupBy("path", "camp", "clicks")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("s14_leads_from_grid", LEAD_FACTS)
def _(t):
    fields = {
        "Stage": "Stage",
        "Created Date": "date_format(Created, 'd/M/yyyy H:mm')",
        "Google UTM Source": "UTM",
        "Google UTM Medium": "Medium",
        "Billing Country": "Country",
    }
    rows = t.sql(LEAD_RAW).select(
        F.col("feed").alias("path"),
        F.lit("s").alias("sheet"),
        F.lit(1).alias("sheet_no"),
        (F.col("event_id") + 10).alias("row_no"),
        F.array(*[F.expr(x) for x in fields.values()]).alias("cells"),
    )
    tops = rows.select("path", "sheet", "sheet_no").distinct()
    header = F.array(*[F.lit(f" {h.upper()}") for h in fields])
    g = tops.select("*", F.lit(3).cast("bigint").alias("row_no"), header.alias("cells")).unionByName(rows)
    heads = G.locate_headers(g, lead_header())
    ql, ft = (
        leads.lead_rows_from_grid(g.filter(F.col("path") == f), heads) for f in ("ql", "ft")
    )
    return stamp(leads.lead_facts(ql, ft), RUN_DATE).select(*FACT_COLUMNS)


@query(
    "k01_registry",
    f"""SELECT label AS "_source", count(*) AS n FROM ({EXP}), (VALUES ('Douyin'), ('BiliBili')) v(label)
 WHERE label = 'BiliBili' OR (camp IS NOT NULL AND trim(camp) <> '') GROUP BY 1""",
)
def _(t):
    columns = {
        "Date": "iso",
        "Campaign Name": "camp",
        "Targeting approach": "brand",
        "Creative Type": "flag",
    }
    raw = t.sql(EXPORT).select(*[F.expr(x).alias(h) for h, x in columns.items()])
    frames = [
        s.harmonise(raw, OPTIONS).withColumn("_source", F.lit(s.label))
        for s in SOURCES
        if s.key in ("douyin", "bilibili")
    ]
    return union_all(frames).groupBy("_source").agg(F.count(F.lit(1)).alias("n"))
