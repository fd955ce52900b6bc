import ast
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, canonical

FOLDER = pathlib.Path("/root/testdata/sf0.001")
ROOT = pathlib.Path(__file__).resolve().parent.parent

# A sample over all modules; check_queries.py compares every query.
SAMPLE = (
    "flagship_channel_summary a01_newest_file a05_header_row b09_warehouse_shape c09_row_not_blank "
    "d01_full_outer_counts d04_blend e07_profile f01_occurrence_number f02_forward_fill i08_utm_class "
    "i16_ctr_auto i21_ts_dayfirst l01_gate s01_bing s09_tiktok_tabs s13_affiliates s14_leads "
    "s15_adroll_api"
).split()

# Trained models, compression, tokenizers, alignments and eigenvectors; absent without the text operators.
WITHOUT_SQL = set(
    "pipeline op1_block_lstm op5_compression_bands op6_passage_chains op7_token_counts op8_spaced_seeds "
    "op9_ordinal_quality op10_mixture_packing op12_whitening op13_best_fit_packing".split()
)


@pytest.fixture(scope="module")
def con():
    if not FOLDER.exists():
        pytest.skip("no test data here")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(name, con, spark):
    df = entry.queries()[name](spark, str(FOLDER))
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cur.fetchall(), columns)


def test_every_query_has_sql_and_every_operator_a_query():
    names = set(entry.queries())
    assert names - set(entry.oracle_sql()) == WITHOUT_SQL & names
    assert names - WITHOUT_SQL >= set(SAMPLE)
    for letter, last in {"b": 11, "c": 14, "d": 4, "e": 10, "f": 3, "g": 3, "h": 2, "i": 27, "j": 2}.items():
        for i in range(1, last + 1):
            assert any(n.startswith(f"{letter}{i:02d}_") for n in names), (letter, i)
    for i in range(17):
        assert any(n.startswith(f"s{i:02d}_") for n in names), i


def test_entry_has_rows(con, spark):
    assert entry.entry(spark).count() == 3


def test_hot_paths_stay_in_the_jvm(con, spark):
    for name in ("s02_meta", "s06_rednote", "d02_upsert", "s14_leads", "run_deduplicated"):
        df = entry.queries()[name](spark, str(FOLDER))
        plan = df._jdf.queryExecution().executedPlan().toString()
        for node in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
            assert node not in plan, (name, node)


def test_scan_reads_only_needed_columns(con, spark):
    df = entry.queries()["i15_fx"](spark, str(FOLDER))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in plan
    df = entry.queries()["c14_date_range"](spark, str(FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in df._jdf.queryExecution().executedPlan().toString()


def test_library_collects_only_metadata():
    """Each driver-side collect is one of the known small ones."""
    allowed = {"decoded_lines", "scan_delimited", "tables_below", "flag_any", "gate", "chosen_sheets",
               "heads", "parse_all", "upsert", "with_names", "dropped_files"}
    for file in (ROOT / "tallyloom").rglob("*.py"):
        if {"queries", "llm"} & set(file.parts):
            continue
        tree = ast.parse(file.read_text())
        for fn in [n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef)]:
            calls = [n for n in ast.walk(fn) if isinstance(n, ast.Attribute)]
            if any(c.attr in ("collect", "toPandas", "localCheckpoint") for c in calls):
                assert fn.name in allowed, (file, fn.name)


def test_responses_are_landed_compressed(spark, tmp_path, monkeypatch):
    from tallyloom.plans.queries import tables
    from tallyloom.plans.queries.base import QUERIES

    folder = tmp_path / "in"
    rows = "id + 1 AS l_partkey, cast(id % 7 + 1 as int) AS l_linenumber, timestamp'1996-01-02' AS l_shipdate, 2.0D AS l_quantity, 3.5D AS l_extendedprice, 0.02D AS l_tax"
    spark.range(50).selectExpr(*rows.split(", ")).write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(tables, "scratch", lambda spark, what: f"{tmp_path}/{what}")
    assert QUERIES["a12_raw_json_landing"](spark, str(folder)).first() == (50.0, 10000.0)
    landed = [f.name for f in (tmp_path / "responses").glob("part-*")]
    assert landed and all(f.endswith(".txt.gz") for f in landed)
