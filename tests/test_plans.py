"""Plan-shape guards: no Python evaluation, column pruning at the scan, partial dedup, checked broadcasts."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["dedup_latest", "proper_case", "ad_metrics", "json_array_flatten", "hash_key",
                                 "campaign_performance", "valid_email", "date_parts", "rate_pct"])
def test_no_python_in_plan(spark, key):
    p = plan(E.queries()[key](spark, SF0001))
    assert not any(n in p for n in PY_NODES), key


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["valid_composite"](spark, SF0001))
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    # the lineitem scan feeding a 3-column validity check must not read every column
    assert "l_extendedprice" not in scan and "l_discount" not in scan and "l_tax" not in scan


def test_dedup_is_partial_before_shuffle_in_pipeline(spark):
    p = plan(E.queries()["dedup_latest"](spark, SF0001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_calendar_broadcast_is_the_bounded_side(spark):
    p = plan(E.queries()["star_join"](spark, SF0001))
    assert "BroadcastHashJoin" in p


@pytest.mark.parametrize("name", ["slv_event", "slv_insight_ad", "slv_smtp_event", "slv_smtp_email"])
def test_a_run_sorts_its_batch_after_the_shuffle(spark, name):
    """A map task that sorts all it has read spills: a run's rows are dealt to their keys first, in one exchange."""
    from stratum.plans import runner
    source = runner.sources(spark, SF0001)[name]
    raw, ts = source.batches[-1]
    p = plan(source.spec.prepare(raw, ts, keyed=True))
    before = plan(raw).count("Exchange hashpartitioning")
    dealt = p.count("REPARTITION_BY_COL")
    assert dealt == 1 and p.count("Exchange hashpartitioning") == before + 1
    assert p.index("Window ") < p.index("REPARTITION_BY_COL")      # the plan is printed from its result downwards
    assert " Sort " not in p[p.index("REPARTITION_BY_COL"):]


@pytest.mark.parametrize("name", ["slv_insight_ad", "slv_smtp_event"])
def test_runs_of_a_large_table_shuffle_only_their_batches(spark, name, tmp_path):
    """The stored rows are bucketed by the key: neither the merge with a batch nor a read of the table moves them."""
    from dataclasses import replace

    from stratum.plans import runner
    from stratum.plans.state import silver_runs
    spec, batches = (s := runner.sources(spark, SF0001)[name]).spec, s.batches
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = silver_runs(spark, spec, batches, name, root=str(tmp_path / "bucketed"))
        plain = silver_runs(spark, replace(spec, bucketed=False), batches, name, root=str(tmp_path / "plain"))
        n, (raw, ts) = history.table.buckets, batches[-1]
        merged = spec.merge_prepared(history.table.read(0), spec.prepare(raw, ts, keyed=True, partitions=n), ts, only_source=True)
        p = plan(merged.repartition(n, *spec.keys))
        assert p.count("Exchange hashpartitioning") == plan(raw).count("Exchange hashpartitioning") + 1
        assert "Exchange" not in plan(history[-1])
        for k in range(len(batches)):
            assert sorted(map(str, history[k].collect())) == sorted(map(str, plain[k].collect()))
            assert sorted(map(str, history.changed_rows(k).collect())) == sorted(map(str, plain.changed_rows(k).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_event_dimensions_are_cut_to_one_row_per_key_before_they_meet_the_changed_keys(spark):
    """Few policies and plans have most events: a join of all events with the keys would put them into few tasks."""
    from stratum.plans import mailing
    silver = mailing.event_runs(spark, SF0001)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for source, of in ((mailing.dim_policy_source, mailing.POLICY_OF), (mailing.dim_plan_source, mailing.PLAN_OF)):
            rows, _ = mailing.dim_event_sources(silver, source, of)[1]
            p = plan(rows)
            assert p.index("LeftSemi") < p.index("Window ")      # the plan is printed from its result downwards
            whole = set(map(str, source(silver[1]).collect()))
            assert set(map(str, rows.collect())) <= whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_facts_are_read_and_written_where_their_keys_are(spark):
    """Bucketed by the key: reading the fact moves no row, and a run writes at most one file per bucket and part."""
    from stratum.plans import ads, mailing
    fact = ads.fact_runs(spark, SF0001)
    n = fact.table.buckets
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(fact[-1]) and "Exchange" not in plan(mailing.fact_event(spark, SF0001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len(fact.table.changes(0).inputFiles()) <= n and len(fact.table.changes(1).inputFiles()) <= 4 * n
