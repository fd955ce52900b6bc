import pytest

from conftest import rows
from tallyloom.plans.batch import parse_all
from tallyloom.schema import SourceError
from tallyloom.sources.delimited import read_lines, scan_delimited

TOP = "".join(f"line {i}\n" for i in range(6))
HEAD = "Day,Campaign Name,Country or Region,CR (Tap-Through),Spend,Impressions,Taps\n"


def test_preamble_quotes_and_blank_lines(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text(TOP + '\nx,"y, z"\n1,"2, 3"\n\n4,\n')
    assert rows(scan_delimited(spark, [str(f)]), "x", "`y, z`") == [("1", "2, 3"), ("4", None)]


def test_files_that_are_not_utf8_are_read_as_windows_1252(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes((TOP + "x\nCafé – €5\n").encode("cp1252"))
    (tmp_path / "b.csv").write_bytes((TOP + "x\nNiño\n").encode("utf-8"))
    assert rows(scan_delimited(spark, [str(tmp_path)]), "x") == [("Café – €5",), ("Niño",)]


def test_layouts_may_differ(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TOP + "x,y\n1,2\n")
    (tmp_path / "b.csv").write_text(TOP + "y,x\n4,3\n")
    assert rows(scan_delimited(spark, [str(tmp_path)]), "x", "y") == [("1", "2"), ("3", "4")]


def test_any_number_of_blank_lines_and_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TOP + "k,v0\n0,0\n")
    for i in range(1, 205):
        (tmp_path / f"{i}.csv").write_text(TOP + "\n" * (i % 40) + f"v{i},K\n{i},{i}\n")
    got = scan_delimited(spark, [str(tmp_path)])
    assert got.selectExpr("count(*)", "sum(cast(k as int))", "max(v204)").first() == (205, 20910, "204")


def test_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TOP)
    with pytest.raises(SourceError, match="no header row"):
        scan_delimited(spark, [str(tmp_path)])


def test_line_numbers_follow_the_file_across_splits(spark, tmp_path):
    big = tmp_path / "big.txt"
    big.write_text("".join(f"{i:07d} {'x' * 50}\n" for i in range(120_000)))
    (tmp_path / "small.txt").write_text("0\n1\n2\n")
    settings = {"spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "1k"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    lines = read_lines(spark, [str(tmp_path)])
    assert lines.rdd.getNumPartitions() > 4
    got = {}
    for path, number, value in rows(lines, "_path", "_row_no", "value"):
        got.setdefault(path.rsplit("/", 1)[1], []).append((number, int(value[:7])))
    for k in settings:
        spark.conf.unset(k)
    for name, size in (("big.txt", 120_000), ("small.txt", 3)):
        assert [v for _, v in sorted(got[name])] == list(range(size))
        assert len({n for n, _ in got[name]}) == size


def parsed_by_csv(text, skip):
    """Rows of the standard library's reader below the preamble, blank records left out."""
    import csv
    import io

    csv.field_size_limit(1 << 30)
    records = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    head, *body = records[skip:]
    return [tuple((r + [None] * len(head))[: len(head)]) for r in body]


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "1k"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def test_quoted_line_breaks_across_splits(spark, tmp_path, small_splits):
    import random

    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b c", '5" nail', "x,y", "", "two\nlines", '"quoted"\n\nand, more', "\n"])
    cell = lambda w: '"' + w.replace('"', '""') + '"' if any(c in w for c in ',\n') or w.startswith('"') else w
    top = "".join(f"line {i}\n" for i in range(5)) + '"a preamble cell\nover two lines"\n'
    rows_of = ["k,v,w"] + [f"{i},{cell(word())},{cell(word())}" for i in range(60_000)]
    rows_of[30_000] = '29999,"' + "long\n" * 400_000 + '",x'  # one cell over more than a split
    text = top + "\n".join(rows_of) + "\n"
    (tmp_path / "big.csv").write_text(text)
    (tmp_path / "plain.csv").write_text(TOP + "w,k\n5\" nail,-1\n")
    got = scan_delimited(spark, [str(tmp_path)])
    assert read_lines(spark, [str(tmp_path / "big.csv")]).rdd.getNumPartitions() > 3
    want = [(k, v or None, w or None) for k, v, w in parsed_by_csv(text, 6)]
    assert sorted(rows(got.filter("k >= 0"), "k", "v", "w"), key=lambda r: int(r[0])) == want
    assert rows(got.filter("k < 0"), "k", "v", "w") == [("-1", None, '5" nail')]


def test_preamble_over_several_splits(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text(("p" * 1000 + "\n") * 3000 + "x\n1\n")
    assert rows(scan_delimited(spark, [str(tmp_path)], skip=3000), "x") == [("1",)]
    assert rows(scan_delimited(spark, [str(tmp_path)], skip=2999), "p" * 1000) == [("x",), ("1",)]


def test_a_cell_that_is_never_closed_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TOP + 'x,y\n1,"2\n3,4\n')
    with pytest.raises(SourceError, match="never closed in a.csv"):
        scan_delimited(spark, [str(tmp_path)])


def test_delimited_export_joins_a_run(spark, grid, tmp_path):
    f = tmp_path / "Apple_010426.csv"
    f.write_text(TOP + HEAD + "2026-04-01,c,Taiwan,14%,1,4,2\n2026-04-01,c,Japan,14%,1,4,2\n")
    parsed = parse_all(grid({("x", "s"): [["a"]]}), tables={"apple": scan_delimited(spark, [str(f)])})
    assert rows(parsed.facts, "Country", "CTR", "Clicks") == [("TW", 0.14, 2.0)]


def test_records_of_several_lines_across_splits_and_batches(spark, tmp_path):
    """Cells with many line breaks in small splits and batches; their text isn't shuffled by file."""
    cells = [f"{i}\n" * (1 + i % 7 * (40 if i % 50 == 0 else 1)) + '""q"", \n' for i in range(16000)]
    (tmp_path / "a.csv").write_text(TOP + "x,y\n" + "".join(f'"{c}",{i}\n' for i, c in enumerate(cells)))
    (tmp_path / "b.csv").write_text(TOP + "y,x\n" + "".join(f"{i},p\n" for i in range(-3, 0)))
    settings = {"spark.sql.files.maxPartitionBytes": "70k", "spark.sql.files.openCostInBytes": "1k", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = scan_delimited(spark, [str(tmp_path)])
        got = {int(y): x for x, y in rows(found, "x", "y")}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert got == {i: c.replace('""', '"') for i, c in enumerate(cells)} | {i: "p" for i in range(-3, 0)}
    assert "SortMergeJoin [_path" not in plan and "ShuffledHashJoin [_path" not in plan
