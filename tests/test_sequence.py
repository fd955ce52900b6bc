import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.operators.sequence import PIECES, _in_blocks, forward_fill, newest_per_group, number_repeats, occurrence


@pytest.fixture(scope="module")
def skewed(spark):
    """Three files; one holds most rows and one value a third of them."""
    rng = random.Random(7)
    data, at = [], {}
    for _ in range(600):
        path = rng.choices(["a", "b", "c"], [8, 1, 1])[0]
        at[path] = at.get(path, 0) + rng.choice([1, 1, 1, 40])
        value = rng.choice(["hot", "hot", None, *"uvwxyz"])
        data.append((path, at[path], value))
    return data, spark.createDataFrame(data, "p string, n bigint, v string").repartition(5)


@pytest.mark.parametrize("block", [3, 50, 1 << 20])
def test_forward_fill_across_blocks(skewed, block):
    data, df = skewed
    last, want = {}, []
    for p, n, v in sorted(data, key=lambda r: (r[0], r[1])):
        last[p] = v if v is not None else last.get(p)
        want.append((p, n, last[p]))
    assert rows(forward_fill(df, ["v"], ["p"], "n", block)) == sorted(want, key=repr)


@pytest.mark.parametrize("block", [3, 50, 1 << 20])
def test_occurrence_across_blocks_with_null_groups(skewed, block):
    data, df = skewed
    seen, want = {}, []
    for p, n, v in sorted(data, key=lambda r: (r[0], r[1])):
        seen[p, v] = seen.get((p, v), 0) + 1
        want.append((p, n, v, seen[p, v]))
    assert rows(occurrence(df, ["p", "v"], "n", "k", block)) == sorted(want, key=repr)


@pytest.mark.parametrize("numbering", ["n", "n * 8000000000", "n * n * n", "n + IF(n < 5, 0, 1000000000000000)"])
@pytest.mark.parametrize("block", [7, 400, 3000])
def test_blocks_follow_the_numbering(spark, numbering, block):
    df = spark.range(1, 6001).toDF("n").selectExpr(f"cast({numbering} AS bigint) AS n")
    cut = _in_blocks(df, "n", block)
    assert cut.columns == ["n", "_blk"]
    blocks = cut.groupBy("_blk").agg(F.count("*").alias("rows"), F.min("n").alias("a"), F.max("n").alias("b"))
    met = sorted(rows(blocks, "_blk", "rows", "a", "b"))
    assert all(x[3] < y[2] for x, y in zip(met, met[1:]))
    # the share of a piece is the most that uneven steps may put in one block
    assert max(m[1] for m in met) <= max(2 * block, 3 * 6000 // PIECES)
    assert len(met) <= 6000 // block + PIECES + 1


def test_blocks_of_no_rows_and_of_one(spark):
    none = spark.createDataFrame([], "p string, n bigint, v string")
    assert rows(forward_fill(none, ["v"], ["p"], "n")) == rows(occurrence(none, ["p", "v"], "n")) == []
    one = spark.createDataFrame([("f", 4, None)], "p string, n bigint, v string")
    assert rows(occurrence(one, ["p", "v"], "n", "k", 1)) == [("f", 4, None, 1)]


def test_repeats_are_numbered_from_the_second(spark):
    df = spark.createDataFrame([("f", i, "x") for i in range(3)] + [("g", 9, "x")], "p string, n bigint, v string")
    assert rows(number_repeats(df, "v", ["p"], "n"), "p", "v") == [
        ("f", "x"), ("f", "x #2"), ("f", "x #3"), ("g", "x"),
    ]


def test_no_window_spans_a_file_and_the_rows_move_once(spark, skewed):
    _, df = skewed
    for out in (forward_fill(df, ["v"], ["p"], "n", 50), occurrence(df, ["p", "v"], "n", "k", 50)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        windows = [l for l in plan.splitlines() if "Window [" in l]
        assert len(windows) == 2
        big = [w for w in windows if "row_number" in w or "last(v" in w]
        assert len(big) == 1 and "_blk" in big[0].split("specifiedwindowframe")[0] + big[0]
        assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line for line in plan.splitlines())


def test_small_groups_are_numbered_by_one_shuffle(spark):
    df = spark.range(300).selectExpr("IF(id % 7 = 0, NULL, id % 100) AS v", "-id AS n", "'f' AS p").repartition(5)
    out = occurrence(df, ["p", "v"], "n", "k", 60)
    assert _shuffles(out) == 1 and "Join" not in out._jdf.queryExecution().executedPlan().toString()
    seen, want = {}, []
    for i in sorted(range(300), reverse=True):
        v = None if i % 7 == 0 else i % 100
        seen[v] = seen.get(v, 0) + 1
        want.append((v, -i, "f", seen[v]))
    assert rows(out) == want
    assert out.schema == occurrence(df, ["p", "v"], "n", "k", 20).schema


def test_only_rows_of_large_groups_are_cut(spark):
    values = ["hot" if i % 3 else f"v{i % 30}" for i in range(900)]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(values)], "p string, n bigint, v string").repartition(5)
    seen, want = {}, []
    for i, v in enumerate(values):
        seen[v] = seen.get(v, 0) + 1
        want.append(("f", i, v, seen[v]))
    assert rows(occurrence(df, ["p", "v"], "n", "k", 100)) == want


def test_newest_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("s", 1, "b"), ("s", 2, "z"), ("s", 2, "y"), ("t", 0, "q")], "s string, d int, p string")
    assert rows(newest_per_group(df, "s", F.col("d"), "p")) == [("s", "y"), ("t", "q")]
