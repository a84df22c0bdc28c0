"""Joins follow known numbers of rows: what the planner takes for small because its files are must not pass through the driver."""

import pytest
from pyspark.sql import functions as F

from stratum.operators.scd2 import Scd2Spec, scd2_commit
from stratum.operators.sized import fits, look_up, sized, threshold
from stratum.plans import ads, reports
from stratum.sources.snapshots import ChangeTable
from tests.test_plans import plan

ROWS = 400_000      # two bigint columns take some 10 MB in memory, their files far less than the default threshold


@pytest.fixture(scope="module")
def keys_file(spark, tmp_path_factory):
    """Rows that compress well: 400,000 keys in few MB."""
    path = str(tmp_path_factory.mktemp("sized") / "keys")
    spark.range(ROWS).selectExpr("id AS k", "id AS sk", "'the same text' AS a", "'and another' AS b").coalesce(2).write.parquet(
        path, compression="zstd")
    return path


@pytest.mark.parametrize("text, size", [("10485760b", 10485760), ("256k", 262144), ("10m", 10485760), ("1GB", 1 << 30), ("-1", -1), ("77", 77)])
def test_threshold_is_read_as_spark_reads_it(spark, text, size):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
    try:
        assert threshold(spark) == size
        assert fits(spark.range(1), 1) == (size >= 16) and not fits(spark.range(1), None)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_a_side_is_broadcast_by_its_rows_not_by_its_files(spark, keys_file):
    side = spark.read.parquet(keys_file).select("k", "sk")
    facts = spark.range(1000).selectExpr("id AS k")
    assert "BroadcastExchange" in plan(facts.join(side, "k", "left"))       # the planner's estimate
    assert "BroadcastExchange" not in plan(facts.join(sized(side, 10 * ROWS), "k", "left"))
    assert "BroadcastExchange" not in plan(facts.join(sized(side), "k", "left"))
    assert "BroadcastExchange" in plan(facts.join(sized(side.filter("k < 10"), 10), "k", "left"))


def test_look_up_equals_left_joins_and_moves_keys_alone(spark, keys_file):
    large = spark.read.parquet(keys_file).select(F.col("k").alias("to"), F.col("sk").alias("to_sk"))
    small = spark.createDataFrame([(0, "even"), (1, "odd")], "kind long, name string")
    rows = spark.range(2000).selectExpr("id", "if(id % 7 = 0, NULL, id * 300) AS to", "id % 3 AS kind", "repeat('x', 50) AS wide")
    found = look_up(rows, ["id"], [("to", large, 10 * ROWS), ("kind", small, 2)])
    p = plan(found)
    plain = rows.join(large, "to", "left").join(small, "kind", "left").select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count() == 2000
    assert p.count("BroadcastHashJoin") == 1 and p.count("SortMergeJoin") == 2


def test_reads_of_a_stored_table_broadcast_only_few_rows(spark, tmp_path, keys_file):
    rows = spark.read.parquet(keys_file)
    t = ChangeTable(spark, str(tmp_path / "t"), ["k"])
    t.commit(rows.withColumn("a", F.lit("old")))
    t.commit(rows.filter("k < 5"))
    assert t.manifest()["rows"] == {"0": ROWS, "1": 5}
    assert "BroadcastExchange" in plan(t.read()) and t.read().count() == ROWS     # five rows
    t.commit(rows)
    t.commit(rows)
    assert "BroadcastExchange" not in plan(t.read()) and t.read().count() == ROWS
    batch = rows.select("k")
    assert "BroadcastExchange" not in plan(t.read_for(batch, most=ROWS * 10))
    assert t.read_for(batch.filter("k = 3"), most=1).count() == 1


def test_dimension_runs_do_not_broadcast_the_dimension(spark, tmp_path, keys_file, monkeypatch):
    """The second run of a dimension: all its rows are read for, and closed or left."""
    spec = Scd2Spec("d_sk", ["k"], {"a": ""}, carried=("b",))
    rows = spark.read.parquet(keys_file).select("k", "a", "b")
    t = ChangeTable(spark, str(tmp_path / "d"), ["d_sk"])
    ts = [F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2)]
    scd2_commit(t, rows, spec, ts[0], 0)
    seen = []
    commit = t.commit
    monkeypatch.setattr(t, "commit", lambda df, *a, **k: (seen.append(plan(df)), commit(df, *a, **k))[1])
    monkeypatch.setattr("stratum.operators.sized.threshold", lambda session: 4 << 20)
    scd2_commit(t, rows.withColumn("a", F.when(F.col("k") % 100 == 0, "new").otherwise(F.col("a"))), spec, ts[1], 1)
    broadcasts = [ln for ln in seen[0].splitlines() if "BroadcastExchange" in ln]
    assert all("input[0, int" in ln for ln in broadcasts), broadcasts      # the key offsets of partitions
    assert t.read().count() == ROWS + ROWS // 100 and t.changes(1).count() == 2 * (ROWS // 100)


def test_facts_star_and_report_merge_with_large_dimensions(spark, keys_file):
    big = 10 ** 9
    d = spark.read.parquet(keys_file)
    dims = {"ad": d.selectExpr("k AS ad_id", "sk AS dim_ad_sk", "a AS ad_name", "b AS creative_title", "true AS is_current"),
            "adset": d.selectExpr("k AS adset_id", "sk AS dim_adset_sk", "a AS adset_name", "b AS optimization_goal", "true AS is_current"),
            "campaign": d.selectExpr("k AS campaign_id", "sk AS dim_campaign_sk", "a AS campaign_name", "b AS objective",
                                     "a AS status", "true AS is_current"),
            "ad_account": d.selectExpr("k AS account_id", "sk AS dim_ad_account_sk", "a AS account_name", "true AS is_current")}
    most = dict.fromkeys(dims, big)
    insights = spark.range(50).selectExpr(
        "id AS ad_id", "id AS adset_id", "id AS campaign_id", "if(id = 3, NULL, id) AS ad_account_id", "date'2024-01-01' AS date_start",
        "date'2024-01-01' AS date_stop", "id AS impressions", "id AS reach", "id AS clicks", "cast(id AS decimal(18,2)) AS spend",
        "1 AS cpc", "1 AS cpm", "1 AS ctr", "'{}' AS actions_raw", "true AS is_valid_record", "false AS is_deleted", "true AS is_valid_date_range")
    facts = ads.fact_source(insights, dims, most)
    assert "BroadcastExchange" not in plan(facts)
    got = {r["ad_id"]: (r["dim_ad_sk"], r["dim_adset_sk"], r["dim_campaign_sk"], r["dim_ad_account_sk"]) for r in facts.collect()}
    assert got == {i: (i, i, i, None if i == 3 else i) for i in range(50)}
    dates = spark.createDataFrame([("2024-01-01", "Mon")], "d string, day_name string").selectExpr("cast(d AS date) AS date_id", "day_name")
    star = reports.star(facts.withColumn("insight_sk", F.col("ad_id")), dims, dates, most)
    assert plan(star).count("BroadcastExchange") == 1 and star.count() == 50       # the calendar
    report = reports.campaign_performance(facts, dims["campaign"], most=big)
    assert "BroadcastExchange" not in plan(report)
    assert report.collect()[0]["total_ads"] == 50


def test_bucketed_tables_never_pass_through_the_driver(spark, tmp_path, keys_file):
    """What layer_counts, empty_tables and pipeline_run read side by side: large tables, and runs that meet all of one."""
    from stratum.operators.merge import fact_merge
    rows = spark.read.parquet(keys_file)
    t = ChangeTable(spark, str(tmp_path / "b"), ["k"], buckets=4)
    t.commit(rows)
    t.commit(rows.filter("k % 2 = 0").withColumn("a", F.lit("new")))
    assert "BroadcastExchange" not in plan(t.read().groupBy().count()) and t.read().count() == ROWS
    assert "BroadcastExchange" not in plan(t.read_for(rows)) and t.read_for(rows.filter("k < 7")).count() == 7
    stamps = {c: F.lit(None).cast("timestamp_ntz") for c in ("gold_loaded_at", "gold_updated_at")}
    merged = fact_merge(t.read().withColumns(stamps), rows, ["k"], run_ts=F.lit("2024-01-01").cast("timestamp_ntz"), only_source=True)
    assert "BroadcastExchange" not in plan(merged) and merged.count() == ROWS
