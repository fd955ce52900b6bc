import datetime as dt
import json

import pytest

from conftest import rows
from tallyloom.operators.counts import profile, run_summary
from tallyloom.plans.api_combine import combine
from tallyloom.plans.batch import deduplicated, parse_all, run, staged_once
from tallyloom.settings import LEAD_COLUMNS, RunOptions
from tallyloom.sources.files import list_files, newest_files
from tallyloom.sources.grids import GRID_SCHEMA, OPEN_FILES, land_grid, scan_grid
from tallyloom.sources.registry import LEADS_LABEL, SOURCES
from tallyloom.sources.tables import read_facts, upsert
from tallyloom.streaming.intake import intake

ISO = "2026-04-01"
OPTIONS = RunOptions(run_date=dt.date(2026, 4, 27))
BING = [["report"] + [None] * 7, ["Campaign name", "i", "t", "Day", "Impr.", "Clicks", "CTR", "Spend"]]
BING_ROW = ["HK Brand", "1", "x", ISO, "100", "5", "0.05", "10"]
PLACED = ["Date", "Main Account", "Placement", "Targeting Approach", "Creative", "Impression", "Click", "Cost (AUD)"]
PLACED_ROW = [ISO, "a", "p", "t", "k", "4", "1", "2"]


def workbook():
    """A small export for every source."""
    crm = [["CRM"] + [None] * 4, list(LEAD_COLUMNS), ["HK", "1/4/2026", "fb", None, "Funded"]]
    return {
        ("Bing_010426.xlsx", "S"): [*BING, BING_ROW, BING_ROW],
        ("Meta_010426.xlsx", "Summary"): [["nothing"]],
        ("Meta_010426.xlsx", "Raw Data"): [["Campaign name", "Day", "Impressions", "Clicks (all)"], ["m", ISO, "8", "2"]],
        ("Meta_Agency_020426.xlsx", "x"): [["Day", "Clicks"], [ISO, "3"]],
        ("Meta_311225.xlsx", "Raw Data"): [["Campaign name", "Day"], ["old", ISO]],
        ("Adroll_010426.xlsx", "Other"): [["Day", "Campaign"]],
        ("Adroll_010426.xlsx", "Daily"): [["x"], ["Day", "Campaign", "Spend", "CTR"], [ISO, "APAC_Taiwan_x", "4", "0.1"]],
        ("Bilibili_010426.xlsx", "daily"): [["no"]],
        ("Bilibili_010426.xlsx", "weekly"): [["Date", "Campaign Name", "Click"], [ISO, "b", "1"]],
        ("Rednote_010426.xlsx", "DAILY"): [PLACED, PLACED_ROW, PLACED_ROW],
        ("TradingView_010426.xlsx", "HK"): [["Date", "Amount spent (USD)"], [ISO, "10"]],
        ("TradingView_010426.xlsx", " vn "): [["Amount spent (AUD)", "Date"], ["10", ISO]],
        ("TradingView_010426.xlsx", "Notes"): [["Date"], [ISO]],
        ("Apple_010426.xlsx", "S"): [["p"]] * 6
        + [["Day", "Campaign Name", "Country or Region", "CR (Tap-Through)", "Spend", "Impressions", "Taps"], [ISO, "c", "Taiwan", "0.5", "1", "4", "2"]],
        ("Tiktok_010426.xlsx", "Daily"): [["Date", "Country", "Campaign name", "CTR"], [ISO, "hk", "t", "0.1"]],
        ("Douyin_010426.xlsx", "Daily"): [["Date", "Campaign Name", "Targeting approach", "Creative Type"], [ISO, "d", "t", "v"]],
        ("Kuaishou_010426.xlsx", "Daily"): [PLACED, PLACED_ROW],
        ("TA_Media_010426.xlsx", "Daily"): [["Date", "Country", "Clicks"], [ISO, "vn", "1"]],
        ("Affiliates_010426.xlsx", "S"): [["Date", "Country", "Type", "Commission", "QL", "FT"], ["1/4/2026", "HK", "x", "$5", "1", "2"], [None, "HK", "y", "$6", "3", "4"]],
        ("QL_010426.xlsx", "S"): crm,
        ("FT_010426.xlsx", "S"): crm,
    }


def test_every_source_is_read(grid):
    parsed = parse_all(grid(workbook()), OPTIONS)
    assert parsed.failed == []
    assert parsed.files["meta"] == "Meta_010426.xlsx" and parsed.files["meta_agency"] == "Meta_Agency_020426.xlsx"
    counts = dict(rows(parsed.facts.groupBy("_source").count()))
    assert counts == {s.label: 1 for s in SOURCES} | {
        LEADS_LABEL: 1, "Bing": 2, "RedNote": 2, "TradingView": 2, "Affiliates": 2,
    }
    got = rows(parsed.facts.filter("_source = 'TradingView'"), "Country", "Spend_AUD")
    assert got == [("HK", pytest.approx(15.8)), ("VN", 10.0)]
    assert rows(parsed.facts.filter("_source = 'Apple Search Ads'"), "CTR") == [(0.5,)]


def test_tiktok_country_tabs_win_over_daily(grid):
    book = {
        ("Tiktok_1.xlsx", "Daily"): [["Date"], ["x"]],
        ("Tiktok_1.xlsx", "SG"): [
            ["Week", "Campaign name", "Ad set name", "Impressions", "Clicks (all)", "Amount spent (AUD)", "CTR"],
            [ISO, "c", "s", "1", "1", "1", "0.1"],
        ],
    }
    parsed = parse_all(grid(book), OPTIONS)
    assert rows(parsed.facts, "Country", "Creative") == [("SG", "s")]


def test_failing_sources_are_reported_and_the_others_go_on(grid):
    book = workbook()
    book["Bing_010426.xlsx", "S"] = [*BING, BING_ROW, [*BING_ROW[:3], "soon", *BING_ROW[4:]]]
    book["Douyin_010426.xlsx", "Daily"] = [["Date", "Campaign Name"], [ISO, "d"]]
    book["Adroll_010426.xlsx", "Daily"] = [["Day"], [ISO]]
    book["TA_Media_010426.xlsx", "Daily"] = [["Date", "Country"], [ISO, "AU"]]
    del book["Kuaishou_010426.xlsx", "Daily"], book["FT_010426.xlsx", "S"]
    parsed = parse_all(grid(book), OPTIONS)
    assert parsed.failed == [
        ("Bing", "unreadable date"),
        ("AdRoll", "no header row"),
        ("Douyin", "missing column Creative Type"),
        ("Kuaishou", "no input file found"),
        ("TA Media", "no usable rows"),
        (LEADS_LABEL, "FT_ file missing"),
    ]
    left = {r[0] for r in rows(parsed.facts, "_source")}
    assert left == {s.label for s in SOURCES} - {f[0] for f in parsed.failed}


def test_leads_fail_as_a_pair(grid):
    book = workbook()
    book["FT_010426.xlsx", "S"] = [list(LEAD_COLUMNS), ["HK", "1/4/2026", "fb", None, "Lost"]]
    assert parse_all(grid(book), OPTIONS).failed == [(LEADS_LABEL, "FT: no rows in a funded stage")]


def test_run_deduplicates_upserts_and_reports(grid, spark, tmp_path):
    table = str(tmp_path / "t")
    report = run(spark, table, grid(workbook()), OPTIONS)
    assert report["failed"] == [] and report["total_rows"] == 18 and report["lead_rows"] == 3
    assert (report["total_ql"], report["total_ft"]) == (5, 7)
    assert report["inserted"] == 16  # two Bing and two affiliate rows became one each
    facts = read_facts(spark, table)
    assert rows(facts.filter("Channel = 'Bing - Brand'"), "Impressions", "CTR", "Date_Added") == [(200.0, 0.05, dt.date(2026, 4, 27))]
    assert rows(facts.filter("Channel = 'Affiliates'"), "Spend_AUD", "QL", "FT", "Impressions") == [(11.0, 1, 2, 0.0)]
    again = run(spark, table, grid(workbook()), OPTIONS)
    assert (again["updated"], again["inserted"]) == (16, 0)
    assert read_facts(spark, table).count() == 16


def test_union_keeps_every_row_and_lead_totals_survive_dedup(grid):
    parsed = parse_all(grid(workbook()), OPTIONS)
    facts = deduplicated(parsed.facts, OPTIONS.run_date)
    leads = lambda df: df.filter("Impressions IS NULL AND Spend_AUD IS NULL").selectExpr("sum(QL)", "sum(FT)").first()
    assert leads(parsed.facts) == leads(facts)


def test_rows_are_parsed_once(grid, spark, tmp_path):
    """Gate, summary and upsert read what one job parsed: a reader sees each row once."""
    import dataclasses

    read = spark.sparkContext.accumulator(0)

    def counted(raw, options):
        def passing(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        return spec.harmonise(raw.mapInArrow(passing, raw.schema), options)

    (spec,) = [s for s in SOURCES if s.key == "douyin"]
    parsed = parse_all(grid(workbook()), OPTIONS, specs=[dataclasses.replace(spec, harmonise=counted)])
    assert run_summary(parsed.facts).first().total_rows == 2  # one of Douyin, one of the leads
    assert upsert(spark, str(tmp_path / "t"), deduplicated(parsed.facts, OPTIONS.run_date))["inserted"] == 2
    assert read.value == 1


def test_headers_far_down_are_found(grid):
    far = [[f"note {i}"] for i in range(200)] + BING[1:] + [BING_ROW]
    parsed = parse_all(grid({("Bing_010426.xlsx", "S"): far}), OPTIONS)
    assert parsed.facts.count() == 1 and ("Bing", "no header row") not in parsed.failed


def test_run_finds_delimited_exports_and_archives_what_it_merged(grid, spark, tmp_path):
    drop, archive = tmp_path / "drop", tmp_path / "archive"
    drop.mkdir()
    archive.mkdir()
    top = "".join(f"line {i}\n" for i in range(6)) + "Day,Campaign Name,Country or Region,CR (Tap-Through),Spend,Impressions,Taps\n"
    (drop / "Apple_020426.csv").write_text(top + f'{ISO},"c,\nd",Taiwan,14%,1,4,2\n')
    (drop / "Apple_311225.csv").write_text("older")
    (archive / "Apple_020426.csv").write_text("of last month")
    (drop / "Meta_020426.csv").write_text("Campaign name,Day\nm,2026-04-01\n")
    (drop / "Bing_010426.xlsx").write_text("landed as grid")
    (drop / "Douyin_010426.xlsx").write_text("landed as grid")
    book = {
        (f"{drop}/Bing_010426.xlsx", "S"): [*BING, BING_ROW],
        (f"{drop}/Douyin_010426.xlsx", "Daily"): [["Date"], [ISO]],
        ("Apple_010426.xlsx", "S"): [["x"]],
    }
    report = run(spark, str(tmp_path / "t"), grid(book), OPTIONS, drop=str(drop), archive=str(archive))
    assert report["total_rows"] == 2 and dict(report["failed"])["Meta"] == "not a workbook"
    got = rows(read_facts(spark, str(tmp_path / "t")), "Channel", "Campaign")
    assert got == [("Apple Search Ads", "c,\nd"), ("Bing - Brand", "HK Brand")]
    assert {k: v.rsplit("/", 1)[1] for k, v in report["archived"].items()} == {"apple": "Apple_020426_1.csv", "bing": "Bing_010426.xlsx"}
    assert sorted(f.name for f in drop.iterdir() if not f.name.startswith(".")) == ["Apple_311225.csv", "Douyin_010426.xlsx", "Meta_020426.csv"]
    assert sorted(f.name for f in archive.iterdir() if not f.name.startswith(".")) == ["Apple_020426.csv", "Apple_020426_1.csv", "Bing_010426.xlsx"]


def test_empty_drop(spark):
    parsed = parse_all(spark.createDataFrame([], GRID_SCHEMA), OPTIONS)
    assert parsed.facts.count() == 0 and len(parsed.failed) == len(SOURCES) + 1


def test_newest_files_by_name(spark, tmp_path):
    for n in ("Meta_010426", "Meta_Agency_020426", "Meta_311225", "Meta_", "meta_010427", "TA_Media_5"):
        (tmp_path / n).write_text("x")
    got = {k: p.rsplit("/", 1)[1] for k, p in rows(newest_files(list_files(spark, str(tmp_path))))}
    assert got == {"meta": "Meta_010426", "meta_agency": "Meta_Agency_020426", "ta_media": "TA_Media_5"}


def test_stream_merges_archives_and_replays(grid, spark, tmp_path):
    drop, table, archive = (str(tmp_path / d) for d in ("drop", "table", "archive"))
    reports = []

    def go(checkpoint):
        intake(
            spark, drop, table, str(tmp_path / checkpoint), archive, OPTIONS, on_report=lambda i, r: reports.append(r)
        ).awaitTermination()

    book = workbook()
    grid({k: v for k, v in book.items() if "Bing" in k[0]}).coalesce(1).write.parquet(drop)
    go("c1")
    grid({k: v for k, v in book.items() if "Bing" not in k[0]}).coalesce(1).write.mode("append").parquet(drop)
    go("c1")
    assert [r["inserted"] for r in reports] == [1, 16]  # the older Meta file waits for nobody: it is merged, too
    once = rows(read_facts(spark, table))
    grid(book).coalesce(1).write.mode("overwrite").parquet(drop)
    go("c2")  # a stream without memory reads the same rows again
    assert reports[-1]["inserted"] == 0 and rows(read_facts(spark, table)) == once
    assert list((tmp_path / "archive").rglob("*.parquet"))


def test_stream_keeps_what_it_could_not_merge(grid, spark, tmp_path):
    drop, table = str(tmp_path / "drop"), str(tmp_path / "table")
    book, reports = workbook(), []

    def go(files):
        grid(files).coalesce(1).write.mode("append").parquet(drop)
        intake(spark, drop, table, str(tmp_path / "c"), options=OPTIONS, on_report=lambda i, r: reports.append(r)).awaitTermination()
        return dict(reports[-1]["failed"])

    later = [*BING, [*BING_ROW[:3], "2026-04-02", *BING_ROW[4:]]]
    soon = [*BING, [*BING_ROW[:3], "soon", *BING_ROW[4:]]]
    bing = {("Bing_020426.xlsx", "S"): later, ("Bing_010426.xlsx", "S"): [*BING, BING_ROW], ("Bing_030426.xlsx", "S"): soon}
    failed = go(bing | {("QL_010426.xlsx", "S"): book["QL_010426.xlsx", "S"]})
    assert failed["Bing"] == "unreadable date" and failed[LEADS_LABEL] == "FT_ file missing"
    assert sorted(r[0] for r in rows(read_facts(spark, table), "Date")) == [dt.date(2026, 4, 1), dt.date(2026, 4, 2)]
    mended = [*BING, [*BING_ROW[:3], "2026-04-03", *BING_ROW[4:]]]
    failed = go({("FT_010426.xlsx", "S"): book["FT_010426.xlsx", "S"], ("Bing_030426.xlsx", "S"): mended})
    assert "Bing" not in failed and LEADS_LABEL not in failed
    facts = read_facts(spark, table)
    assert facts.selectExpr("sum(QL)", "sum(FT)").first() == (1, 1)
    assert facts.filter("Channel = 'Bing - Brand'").count() == 3


def test_a_micro_batch_costs_what_waits_not_what_was_ever_dropped(grid, spark, tmp_path):
    from tallyloom.streaming.intake import read_ledger

    drop, table, folder = str(tmp_path / "drop"), str(tmp_path / "table"), tmp_path / "c_waiting"
    waiting = {("QL_010426.xlsx", "S"): workbook()["QL_010426.xlsx", "S"]}
    sizes = []
    for day in range(1, 5):
        bing = {(f"{tmp_path}/Bing_0{day}0426.xlsx", "S"): [*BING, [*BING_ROW[:3], f"2026-04-0{day}", *BING_ROW[4:]]]}
        (tmp_path / f"Bing_0{day}0426.xlsx").write_text("export")
        grid(bing | (waiting if day == 1 else {})).coalesce(1).write.mode("append").parquet(drop)
        stream = intake(spark, drop, table, str(tmp_path / "c"), str(tmp_path / "archive"), OPTIONS)
        stream.awaitTermination()
        sizes.append((sorted(p.name for p in (folder / "rows").iterdir()), [f.path for f in read_ledger(spark, str(folder), day - 1)]))
    lead = ["QL_010426.xlsx"]  # waits for its partner from the first micro-batch on
    assert sizes == [(["batch=0"], lead)] + [(["batch=0", f"batch={n}"], lead) for n in (1, 2, 3)]
    assert len([p for p in (folder / "ledger").iterdir() if not p.name.startswith(".")]) == 2
    assert read_facts(spark, table).count() == 4
    moved = {p.name for p in (tmp_path / "archive").iterdir()}
    assert moved >= {f"Bing_0{day}0426.xlsx" for day in range(1, 5)}
    assert not list(tmp_path.glob("Bing_*.xlsx"))


def test_api_combine(spark):
    doc = {"data": {"advertisable": {"byEID": {"campaigns": [
        {"name": "APAC_Taiwan_x", "metrics": {"byDate": [{"date": ISO, "impressions": 5, "cost": 1.5}]}}]}}}}
    responses = spark.createDataFrame([(json.dumps(doc),)], "value string")
    insights = spark.createDataFrame(
        [("c", "hk", "2026-04-09", "2026-04-09", "1", "4", "2", "1")],
        "campaign_name string, country string, date_start string, date_stop string, reach string, impressions string, spend string, clicks string",
    )
    both = combine(responses, insights, run_date=dt.date(2026, 5, 1))
    assert rows(both, "Country", "Channel", "Spend_AUD") == [("HK", "Meta", 2.0), ("TW", "AdRoll", 1.5)]
    assert combine(responses, insights, "2026-04-05", "2026-04-30").count() == 1
    assert combine(responses, None).count() == 1
    line = profile(both).first()
    assert (line.total_rows, line.countries, line.campaigns, line.total_spend_aud) == (2, 2, 2, 3.5)


def test_combine_without_responses_gives_no_rows(spark):
    from tallyloom.plans.api_combine import combine

    facts = combine(None, None)
    assert facts.count() == 0 and "Country" in facts.columns


def test_seen_per_source_lists_countries_outside_the_region(spark):
    from tallyloom.operators.counts import seen_per_source

    df = spark.createDataFrame([("a", "AU"), ("a", "Peru"), ("a", None), ("b", None)], "_source string, Country string")
    assert {r[0]: (r[1], r[2]) for r in seen_per_source(df).collect()} == {"a": (3, ["AU", "Peru"]), "b": (1, [])}


def test_rows_are_staged_in_their_order(spark):
    """A task's rows aren't sorted by source on their way to the staged files."""
    frame = spark.range(0, 100, 1, 1).selectExpr("id", "IF(id % 2 = 0, 'a', 'b') AS _source", "IF(id = 7, 'bad', NULL) AS _fault")
    staged, status, _ = staged_once(frame, ["a", "b", "c"])
    assert [r.id for r in staged.collect()] == list(range(100))
    assert status == {"a": (50, None), "b": (50, "bad"), "c": (0, None)}


def test_landing_keeps_a_file_open_for_each_source(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(spark.conf.get(key)), write(self, path)))
    before = spark.conf.get(key)
    many = OPEN_FILES + 4
    grid = spark.range(0, 400, 1, 1).selectExpr(f"concat('s', id % {many}) AS source", "'p' AS path", "'x' AS sheet", "1 AS sheet_no", "id AS row_no", "array(string(id)) AS cells")
    land_grid(grid, f"{tmp_path}/landing")
    assert seen == [str(OPEN_FILES)] and spark.conf.get(key) == before
    assert rows(scan_grid(spark, f"{tmp_path}/landing"), "source", "row_no") == rows(grid, "source", "row_no")
    assert scan_grid(spark, f"{tmp_path}/landing", "s3").count() == 400 // many
