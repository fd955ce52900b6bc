import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.operators.dedup import dedup, dedup_ads
from tallyloom.operators.upsert import change_counts, merge
from tallyloom.schema import FACT_COLUMNS
from tallyloom.sources.tables import (
    ensure_table,
    initial_load,
    read_changes,
    read_days,
    read_facts,
    read_last_days,
    read_table,
    replace_table,
    upsert,
)
from tallyloom.sources.versions import Conflict, Version, commit, new_change, numbers, publish, vacuum, version

AD = {"Date": "2026-04-01", "Country": "HK", "Channel": "Meta", "Campaign": "c", "Channel_Group": "Meta"}
LEAD = {"Date": "2026-04-01", "Country": "HK", "Channel": "Meta", "Campaign": "Meta", "Channel_Group": "Meta"}


def test_affiliate_lines_sum_spend_but_keep_the_first_counts(facts):
    line = {**AD, "Channel": "Affiliates", "Campaign": "Affiliates"}
    df = facts({**line, "Spend_AUD": 5.0, "QL": 2, "FT": 1}, {**line, "Spend_AUD": 7.0, "QL": 9, "FT": 9})
    (got,) = dedup(df, ["n"]).collect()
    assert (got.Spend_AUD, got.QL, got.FT, got.Impressions, got.Clicks) == (12.0, 2, 1, 0.0, 0.0)
    (got,) = dedup_ads(df, ["n"], lead_agg="sum").collect()
    assert (got.QL, got.FT) == (11, 10)


def test_first_is_the_first_known_in_order(facts):
    df = facts(
        {**AD, "Impressions": 10.0, "Clicks": 1.0, "CTR": None},
        {**AD, "Impressions": 10.0, "Clicks": 3.0, "CTR": 0.3},
        {**AD, "Impressions": 20.0, "Clicks": 4.0, "CTR": 0.2},
    )
    for order in (["n"], ["Campaign", "n"]):
        (got,) = dedup(df.orderBy(F.desc("n")), order).collect()
        assert (got.CTR, got.Impressions, got.Clicks) == (0.3, 40.0, 8.0)
    (got,) = dedup(df, ["n"], ctr_mode="ratio", group_from_channel=True).collect()
    assert got.CTR == 0.2


def test_null_keys_stay_and_row_types_stay_apart(facts):
    df = facts(
        {**AD, "Country": None, "Spend_AUD": 1.0},
        {**AD, "Country": None, "Spend_AUD": 2.0},
        {**AD, "Creative": "", "Spend_AUD": 4.0},
        {**AD, "Creative": None, "Spend_AUD": 8.0},
        {**LEAD, "QL": 1, "FT": 0},
        {**LEAD, "QL": 2, "FT": None},
    )
    got = rows(dedup(df, ["n"]), "Country", "Creative", "Spend_AUD", "QL", "FT")
    assert got == sorted(
        [(None, None, 3.0, None, None), ("HK", "", 4.0, None, None), ("HK", None, 8.0, None, None), ("HK", None, None, 3, 0)],
        key=repr,
    )


def test_dedup_is_hashed_when_order_is_one_number(facts):
    df = facts({**AD, "Spend_AUD": 1.0})
    plan = dedup_ads(df, ["n"], group_from_channel=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_merge_updates_metrics_and_keeps_identity(facts):
    old = facts(
        {**AD, "Creative": None, "Spend_AUD": 1.0, "Date_Added": "2026-01-01", "Date_Modified": "2026-01-01"},
        {**LEAD, "QL": 1, "FT": 1, "Date_Added": "2026-01-01"},
        {**AD, "Campaign": "other", "Spend_AUD": 3.0},
    ).drop("n")
    new = facts(
        {**AD, "Creative": "", "Spend_AUD": 2.0, "Date_Added": "2026-02-02", "Date_Modified": "2026-02-02"},
        {**LEAD, "Campaign": "renamed", "QL": 5, "FT": 0, "Date_Added": "2026-02-02"},
        {**AD, "Date": None, "Spend_AUD": 9.0},
    ).drop("n")
    out = merge(old, new, mark=True)
    assert change_counts(out).first().asDict() == {"updated": 2, "inserted": 1, "rows_before": 3, "rows_after": 4}
    got = rows(out, "_change", "Campaign", "Creative", "Spend_AUD", "QL", "Date_Added")
    day = dt.date(2026, 1, 1)
    assert got == sorted(
        [
            ("updated", "c", None, 2.0, None, day),
            ("updated", "Meta", None, None, 5, day),
            ("kept", "other", None, 3.0, None, None),
            ("inserted", "c", None, 9.0, None, None),
        ],
        key=repr,
    )


def test_two_batch_rows_for_one_target_row_are_refused(facts):
    old = facts({**AD, "Spend_AUD": 1.0}).drop("n")
    new = facts({**AD, "Creative": "", "Spend_AUD": 2.0}, {**AD, "Creative": None, "Spend_AUD": 3.0}).drop("n")
    with pytest.raises(Exception, match="several batch rows"):
        merge(old, new).collect()
    apart = old.withColumn("Campaign", F.lit("elsewhere"))
    assert merge(apart, new).count() == 3  # nothing is hit, so both are new
    with pytest.raises(Exception, match="several batch rows"):
        merge(apart, new, strict=True).collect()


def test_one_batch_row_updates_every_target_row_it_matches(facts):
    old = facts({**AD, "Creative": "", "Spend_AUD": 1.0}, {**AD, "Creative": None, "Spend_AUD": 1.5}).drop("n")
    new = facts({**AD, "Spend_AUD": 7.0}).drop("n")
    assert rows(merge(old, new), "Creative", "Spend_AUD") == [("", 7.0), (None, 7.0)]


def test_merge_joins_on_equality_only(facts, spark):
    df = facts({**AD, "Spend_AUD": 1.0}).drop("n")
    for limit in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        plan = merge(df, df)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "EvalPython" not in plan
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "facts")


def month(facts, m, spend, **more):
    return facts({**AD, "Date": f"2026-0{m}-05", "Spend_AUD": spend, **more}).drop("n")


def test_upsert_twice_is_once_and_other_months_stay(facts, spark, table):
    assert not ensure_table(spark, table)
    assert ensure_table(spark, table)
    first = month(facts, 3, 1.0).unionByName(month(facts, 4, 1.0))
    assert upsert(spark, table, first) == {"updated": 0, "inserted": 2, "rows_before": 0, "rows_after": 2}
    march = {r[0] for r in read_table(spark, table).filter("ym = '2026-03'").select("_metadata.file_path").collect()}
    late = month(facts, 4, 5.0)
    assert upsert(spark, table, late)["updated"] == 1
    once = rows(read_facts(spark, table))
    assert upsert(spark, table, late) == {"updated": 1, "inserted": 0, "rows_before": 1, "rows_after": 1}
    assert rows(read_facts(spark, table)) == once
    again = {r[0] for r in read_table(spark, table).filter("ym = '2026-03'").select("_metadata.file_path").collect()}
    assert march == again and len(march) == 1  # the month was not touched


def test_disjoint_batches_commute(facts, spark, tmp_path):
    a, b = month(facts, 3, 1.0), month(facts, 3, 2.0, Campaign="d")
    tables = [str(tmp_path / n) for n in "xy"]
    for t, order in zip(tables, ((a, b), (b, a))):
        for batch in order:
            upsert(spark, t, batch)
    assert rows(read_facts(spark, tables[0])) == rows(read_facts(spark, tables[1]))


def test_undated_rows_are_always_added(facts, spark, table):
    batch = facts({**AD, "Date": None, "Spend_AUD": 1.0}).drop("n")
    upsert(spark, table, batch)
    assert upsert(spark, table, batch)["inserted"] == 1
    assert read_facts(spark, table).count() == 2


def test_refused_batch_leaves_the_table_as_it_was(facts, spark, table):
    upsert(spark, table, month(facts, 4, 1.0))
    bad = month(facts, 4, 2.0, Creative="").unionByName(month(facts, 4, 3.0))
    with pytest.raises(Exception, match="several batch rows"):
        upsert(spark, table, bad)
    assert rows(read_facts(spark, table), "Spend_AUD") == [(1.0,)]
    assert upsert(spark, table, month(facts, 4, 4.0))["updated"] == 1


def test_interrupted_upsert_has_no_effect(facts, spark, table, monkeypatch):
    from tallyloom.sources import tables as module

    upsert(spark, table, month(facts, 4, 1.0))

    def die(*a):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(module, "commit", die)
        with pytest.raises(RuntimeError):
            upsert(spark, table, month(facts, 4, 8.0))
    assert rows(read_facts(spark, table), "Spend_AUD") == [(1.0,)]
    assert upsert(spark, table, month(facts, 4, 8.0))["updated"] == 1
    assert rows(read_facts(spark, table), "Spend_AUD") == [(8.0,)]


def test_readers_keep_their_version(facts, spark, table):
    upsert(spark, table, month(facts, 4, 1.0))
    opened = read_facts(spark, table)
    upsert(spark, table, month(facts, 4, 2.0).unionByName(month(facts, 5, 3.0)))
    assert rows(opened, "Spend_AUD") == [(1.0,)] == rows(read_facts(spark, table, 1), "Spend_AUD")
    assert rows(read_facts(spark, table), "Spend_AUD") == [(2.0,), (3.0,)]
    assert rows(read_changes(spark, table), "Spend_AUD", "_change") == [(2.0, "updated"), (3.0, "inserted")]
    assert replace_table(spark, table, month(facts, 6, 9.0)).number == 3
    assert rows(read_facts(spark, table), "Spend_AUD") == [(9.0,)]
    assert rows(read_changes(spark, table), "Spend_AUD", "_change") == [(9.0, "loaded")]
    assert read_changes(spark, table, 0).count() == 0 and read_facts(spark, table, 0).count() == 0
    with pytest.raises(FileNotFoundError):
        read_table(spark, table + "-elsewhere")


def test_a_writer_who_comes_late_merges_with_the_newer_rows(facts, spark, table, monkeypatch):
    from tallyloom.sources import tables as module

    upsert(spark, table, month(facts, 4, 1.0))
    published, others = module.commit, [month(facts, 4, 5.0, Campaign="other"), month(facts, 5, 6.0)]

    def after_another(spark, path, base, change, months):
        if others:
            upsert_now = others.pop()
            with monkeypatch.context() as m:
                m.setattr(module, "commit", published)
                upsert(spark, path, upsert_now)
        return published(spark, path, base, change, months)

    monkeypatch.setattr(module, "commit", after_another)
    # First another month changes, which is no conflict; then nobody is left to interfere.
    assert upsert(spark, table, month(facts, 4, 2.0))["updated"] == 1
    assert rows(read_facts(spark, table), "Spend_AUD") == [(2.0,), (6.0,)]
    # Now the same month changes: the batch is merged again, and nothing is lost.
    assert upsert(spark, table, month(facts, 4, 3.0)) == {"updated": 1, "inserted": 0, "rows_before": 2, "rows_after": 2}
    assert rows(read_facts(spark, table), "Spend_AUD") == [(3.0,), (5.0,), (6.0,)]


def test_versions_are_taken_once(spark, table):
    assert publish(spark, table, Version(0, {})) and not publish(spark, table, Version(0, {"2026-04": "x"}))
    assert version(spark, table) == Version(0, {})
    base = Version(0, {})
    assert publish(spark, table, Version(1, {"2026-04": "x"}))
    with pytest.raises(Conflict, match="2026-04"):
        commit(spark, table, base, new_change(), ["2026-04"])
    assert commit(spark, table, base, new_change(), ["2026-05"]) == Version(2, {"2026-04": "x"})
    assert numbers(spark, table) == [0, 1, 2]


def test_many_writers_at_once_lose_nothing(facts, spark, table):
    from concurrent.futures import ThreadPoolExecutor

    batches = [month(facts, 4, float(i), Campaign=f"c{i}") for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: upsert(spark, table, b), batches))
    assert rows(read_facts(spark, table), "Spend_AUD") == [(float(i),) for i in range(4)]


def test_vacuum_keeps_what_versions_need(facts, spark, table):
    for spend in (1.0, 2.0, 3.0):
        upsert(spark, table, month(facts, 4, spend))
    upsert(spark, table, month(facts, 5, 4.0))
    assert vacuum(spark, table, keep=1) == 0  # younger than a day
    assert numbers(spark, table) == [4]
    assert vacuum(spark, table, keep=1, grace_hours=0) == 2
    assert rows(read_facts(spark, table), "Spend_AUD") == [(3.0,), (4.0,)]


def test_kept_summaries_equal_recounts(facts, spark, table):
    from tallyloom.operators.counts import channel_summary, profile
    from tallyloom.sources.summaries import partial_sums, table_channels, table_profile

    ensure_table(spark, table)
    assert rows(table_profile(spark, table)) == rows(profile(read_facts(spark, table)))
    for batch in (month(facts, 3, 1.0).unionByName(month(facts, 4, 2.0)), month(facts, 4, 5.0, Country="TW"), month(facts, 3, 7.0)):
        upsert(spark, table, batch)
        assert rows(table_profile(spark, table)) == rows(profile(read_facts(spark, table)))
        assert rows(table_channels(spark, table)) == rows(channel_summary(read_facts(spark, table)))
    assert rows(table_channels(spark, table, 1)) == rows(channel_summary(read_facts(spark, table, 1)))
    files = {r[0] for r in partial_sums(spark, table).select("_metadata.file_path").collect()}
    assert files and all("/summaries/" in f for f in files)  # the table itself isn't read


def explained(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_days_read_the_folders_of_their_months_alone(facts, spark, table):
    for m in (3, 4, 5):
        upsert(spark, table, month(facts, m, float(m)))
    df = read_last_days(spark, table, 7, "2026-05-04")
    (line,) = [x for x in explained(spark, df).splitlines() if x.startswith("PartitionFilters")]
    assert "ym#" in line and ">= 2026-04" in line and "<= 2026-05" in line
    assert rows(df) == [] and rows(read_days(spark, table, "2026-03-05", "2026-04-05"), "Spend_AUD") == [(3.0,), (4.0,)]


def test_initial_load_reads_text_and_replaces(facts, spark, table):
    upsert(spark, table, month(facts, 4, 1.0))
    text = spark.createDataFrame(
        [("2026-04-01", "HK", "12.5", "3", "x"), ("2026-05-01", None, "1,0", "3.0", None)],
        "Date string, Country string, `Spend (AUD)` string, QL string, Extra string",
    )
    assert initial_load(spark, table, text, dt.date(2026, 6, 1)) == 2
    assert read_facts(spark, table).columns == FACT_COLUMNS
    got = rows(read_facts(spark, table), "Date", "Country", "Spend_AUD", "QL", "Date_Added")
    assert got == [
        (dt.date(2026, 4, 1), "HK", 12.5, 3, dt.date(2026, 6, 1)),
        (dt.date(2026, 5, 1), None, None, 3, dt.date(2026, 6, 1)),
    ]


def test_upsert_prunes_months(facts, spark, table):
    upsert(spark, table, month(facts, 3, 1.0).unionByName(month(facts, 4, 1.0)))
    df = read_table(spark, table).filter(F.col("ym").isin(["2026-04"]))
    files = {r[0] for r in df.select("_metadata.file_path").collect()}
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    (line,) = [x for x in plan.splitlines() if x.startswith("PartitionFilters")]
    assert len(files) == 1 and "ym#" in line
