"""Stored runs: quarantine, resumption, deltas; and the operators that merge changes or survive hot keys."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from stratum.functions.temporal import ts_literal
from stratum.operators import (change_feed, change_feed_by_digest, distinct_bitmaps, heavy_keys, history as H, hot_key_join,
                               merged_distinct, merged_sums, signed_sums)
from stratum.operators.change_feed import BUCKET, bucket_digests, with_bucket
from stratum.plans import ads, mailing, quality, runner, specs
from stratum.plans.state import new_table, silver_runs
from stratum.sources.snapshots import ChangeTable
from tests.conftest import SF0001


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_every_record_is_taken_in_superseded_or_quarantined(spark, tmp_path):
    """All 15 Silver tables, on feeds in which every fourth record has lost its key; two runs for one of them."""
    found = runner.sources(spark, SF0001)
    assert len(found) == 15
    for name, source in found.items():
        key = source.spec.keys[0]
        batches = source.batches[:2 if name == "slv_contact_list" else 1]
        broken = [(raw.unionByName(raw.filter(F.pmod(F.xxhash64(*raw.columns), F.lit(4)) == 0)
                                   .withColumns({c: F.lit(None).cast(raw.schema[c].dataType) for c in lost_columns(raw, source.spec, key)})), ts)
                  for raw, ts in batches]
        history = silver_runs(spark, source.spec, broken, name, root=str(tmp_path / name))
        rejected = {r["run"]: r["n"] for r in history.quarantined().groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect()}
        whole = " AND ".join(f"{k} IS NOT NULL" for k in source.spec.keys)
        for run, (raw, ts) in enumerate(broken):
            r = source.spec.clean(raw, ts).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr(whole)).alias("usable"),
                                               F.count_distinct(*source.spec.keys).alias("keys")).first()
            assert rejected.get(run, 0) == r["n"] - r["usable"], name
            # the key of an SMTP event is a hash that takes NULL parts as empty: it is never NULL
            assert rejected.get(run, 0) > 0 or name == "slv_smtp_event", name
            assert source.spec.prepare(raw, ts).filter(whole).count() == r["keys"], name


def lost_columns(raw, spec, key):
    """The raw columns that a Silver key is made of."""
    if key in raw.columns:
        return [key]
    return [c for c in raw.columns if c in ("report_date", "message_id", "event", "event_date", "email")][:1]


def test_quarantine_of_a_committed_run_is_made_up_for(spark, tmp_path):
    batch = [(next(iter(runner.sources(spark, SF0001).values())).batches[0][0].limit(50), ts_literal("2024-03-01 00:00:00"))]
    batch = [(batch[0][0].withColumn("contact_id", F.lit(None).cast("long")), batch[0][1])]
    root = str(tmp_path / "t")
    table = new_table(spark, "t", ["contact_id"], root)
    table.commit(specs.SLV_CONTACT.merge_prepared(None, specs.SLV_CONTACT.prepare(*batch[0]), batch[0][1]), 0)
    assert silver_runs(spark, specs.SLV_CONTACT, batch, "t", root=root).quarantined().count() == 50


def test_pipeline_killed_between_steps_equals_one_run(spark, tmp_path):
    done, kills = set(), []

    def kill(step):
        if step not in done and len(done) % 14 == 13 and len(kills) < 3:
            done.add(step)
            kills.append(step)
            raise runner.Stopped(step)
        done.add(step)

    digest = lambda tables: sorted(tuple(r) for r in quality.stack(
        [quality.digest(t, k) for k, t in sorted(tables.items())]).collect())
    while True:
        try:
            broken = runner.pipeline_run(spark, SF0001, str(tmp_path / "broken"), runs=1, before=kill)
            break
        except runner.Stopped:
            pass
    assert len(kills) >= 2
    assert digest(broken) == digest(runner.pipeline_run(spark, SF0001, str(tmp_path / "whole"), runs=1))


def test_gate_reads_more_folders_than_a_driver_would_list(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from stratum.streaming import has_new_files, pending_rows, stream_ingest
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    put = lambda k: ((tmp_path / "landing" / f"x {k}").mkdir(parents=True),
                     (tmp_path / "landing" / f"x {k}" / "part.csv").write_text(f"name,id\nn{k},{k}\n" if k % 2 else f"ID,Name\n{k},n{k}\n"))
    put(0)
    where = (f"{tmp_path}/landing/*", f"{tmp_path}/bronze", schema, f"{tmp_path}/_ck")
    stream_ingest(spark, *where).awaitTermination()
    for k in range(1, 1002):
        put(k)
    glob = f"{tmp_path}/landing/*/*.csv"
    assert has_new_files(spark, glob, where[3])
    got = {(r["id"], r["name"]) for r in pending_rows(spark, glob, where[3], schema).collect()}
    assert got == {(k, f"n{k}") for k in range(1, 1002)}


def test_a_merge_sees_only_its_keys_below_the_window(spark, tmp_path):
    t = ChangeTable(spark, str(tmp_path / "t"), ["k"])
    for v in range(4):
        t.commit(spark.range(v * 10, v * 10 + 1000).selectExpr("id AS k", f"{v} AS x"), v)
    batch = spark.createDataFrame([(3,), (25,)], "k long")
    rows = t.read_for(batch)
    assert sorted(tuple(r) for r in rows.collect()) == [(3, 0), (25, 2)]
    plan = plan_of(rows).splitlines()
    windows = [i for i, line in enumerate(plan) if "Window" in line]
    scans = [i for i, line in enumerate(plan) if "Relation" in line and "parquet" in line]
    joins = [i for i, line in enumerate(plan) if "LeftSemi" in line]
    assert windows and len(joins) == len(scans) >= 4          # each stored part is cut down before it is scanned further
    assert all(any(plan[j].index("Join") < plan[s].index("Relation") and j < s for j in joins) for s in scans)
    assert all(depth(plan[j]) > depth(plan[windows[-1]]) for j in joins if j > windows[-1])


def depth(line):
    return len(line) - len(line.lstrip(" :+-"))


def test_second_fact_run_writes_only_what_changed(spark):
    fact = ads.fact_runs(spark, SF0001)
    table, insights = fact.table, ads.insight_runs(spark, SF0001)
    dims = {e: ads.entity_dims(spark, SF0001, e) for e in ads.ENTITIES}
    written = table.changes(1)
    keys = list(ads.FACT_KEYS)
    changed = insights.changed_rows(1).withColumnsRenamed({"date_start": "date_start_id", "date_stop": "date_stop_id"}).select(*keys)
    rest = written.join(changed, keys, "left_anti")
    for e, (column, key) in ads.LINKS.items():
        rest = rest.join(dims[e].opened(1).select(F.col(key).alias(column)), column, "left_anti")
    assert rest.count() == 0 < written.count() < fact[1].count()
    # nothing changed: nothing is written
    none = insights.changed_rows(1).limit(0)
    rows, base = ads.fact_delta(table.read_for, table.read(), none, {e: d[1] for e, d in dims.items()},
                                {e: d.opened(1).limit(0) for e, d in dims.items()}, ads.run_ts(2), ads.run_ts(1), 7)
    assert rows.count() == 0 and base == 7


def test_maintained_sums_equal_a_recount(spark):
    fact = ads.fact_runs(spark, SF0001)
    merged = merged_sums(fact.partial_sums(0).unionByName(fact.partial_sums(1)), ads.AD_GRAIN, ads.AD_SUMS)
    again = fact[1].groupBy(*ads.AD_GRAIN).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(c) for c in ads.AD_SUMS])
    rows = lambda df: sorted(map(str, df.select(*ads.AD_GRAIN, "n_rows", *ads.AD_SUMS).collect()))
    assert rows(merged) == rows(again)


def test_signed_sums_follow_updates_and_deletions(spark):
    rng = random.Random(2)
    table, parts = {}, []
    for run in range(5):
        new = {rng.randrange(60): (rng.choice("abc"), rng.randrange(100)) for _ in range(30)}
        frame = lambda d: spark.createDataFrame([(g, v) for g, v in d.values()], "g string, v long")
        old = {k: table[k] for k in new if k in table}
        parts.append(signed_sums(frame(new), frame(old) if old else None, ["g"], ["v"]))
        table |= new
    total = merged_sums(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4]), ["g"], ["v"])
    want = {g: (sum(x[0] == g for x in table.values()), sum(x[1] for x in table.values() if x[0] == g)) for g in "abc"}
    assert {r["g"]: (r["n_rows"], r["v"]) for r in total.collect()} == {g: w for g, w in want.items() if w[0]}


def test_bitmaps_count_like_count_distinct(spark):
    rng = random.Random(1)
    runs = [[(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(200), rng.randrange(10**9)])) for _ in range(400)]
            for _ in range(3)] + [[("nulls", None)]]
    frames = [spark.createDataFrame(r, "g string, k long") for r in runs]
    maps = [distinct_bitmaps(f, ["g"], "k") for f in frames]
    merged = merged_distinct(maps[0].unionByName(maps[1]).unionByName(maps[2]).unionByName(maps[3]), ["g"])
    want = {}
    for g, k in itertools.chain(*runs):
        want.setdefault(g, set()).update([k] if k is not None else [])
    assert {r["g"]: r["n_distinct"] for r in merged.collect()} == {g: len(s) for g, s in want.items()}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_equals_a_plain_join(spark, how):
    rows = [(k, None if k % 5 == 0 else 7 if k % 3 == 0 else k % 400) for k in range(6000)]
    facts = spark.createDataFrame(rows, "id long, key long")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(0, 390)], "key long, name string")
    heavy = heavy_keys(facts, ["key"])
    assert len(heavy) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = hot_key_join(facts, dim, ["key"], how)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, out.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    assert got == sorted(map(str, facts.join(dim, ["key"], how).collect()))


def test_sweep_equals_join_with_many_versions_and_a_hot_key(spark):
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(hours=n)
    rng = random.Random(4)
    versions = [(1, f"v{k}", day(k), day(k + 1)) for k in range(10_000)]
    versions += [(2, "early", day(10), day(20)), (2, "late", day(30), dt.datetime(9999, 12, 31)), (3, "only", day(5), day(6))]
    facts = [(k, rng.choice([1, 1, 2, 3, 4, None]), rng.choice([day(rng.randrange(-5, 10_100)), day(30), day(20), None])) for k in range(3000)]
    f = spark.createDataFrame(facts, "id long, key long, ts timestamp_ntz")
    d = spark.createDataFrame(versions, "key long, name string, start timestamp_ntz, end timestamp_ntz")
    want = sorted(map(str, H.as_of_join(f, d, ["key"], "ts", "start", "end").select("id", "key", "ts", "name", "start", "end").collect()))
    for heavy in (None, []):
        out = H.as_of_sweep(f, d, ["key"], "ts", "start", "end", heavy=heavy).select("id", "key", "ts", "name", "start", "end")
        assert sorted(map(str, out.collect())) == want
    assert heavy_keys(f, ["key"])
    assert "Join" not in plan_of(H.as_of_sweep(f, d, ["key"], "ts", "start", "end", heavy=[]))


def test_only_buckets_that_differ_are_compared(spark, tmp_path):
    old = spark.range(20_000).selectExpr("id AS k", "concat('x', id) AS v")
    new = old.filter("k <> 77").unionByName(spark.createDataFrame([(77, "changed")], "k long, v string"))
    stored = []
    for name, df in (("old", old), ("new", new)):
        with_bucket(df, ["k"], 32).write.partitionBy(BUCKET).parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    feed = change_feed_by_digest(*stored, *map(bucket_digests, stored), ["k"])
    assert sorted(map(str, feed.collect())) == sorted(map(str, change_feed(old, new, ["k"]).collect()))
    import re
    assert len(set(re.findall(r"key_bucket#\d+ = (\d+)|key_bucket=(\d+)", plan_of(feed)))) <= 1
    same = change_feed_by_digest(stored[0], stored[0], *[bucket_digests(stored[0])] * 2, ["k"])
    assert same.count() == 0


def test_bucketed_tables_meet_without_an_exchange(spark, tmp_path):
    from stratum.sources.bucketed import attach, latest_per_key, write_bucketed
    rows = spark.range(3000).selectExpr("id % 500 AS k", "id AS at", "concat('v', id) AS v")
    facts = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 600 END AS k", "id AS n")
    a = write_bucketed(rows, "versions_b", str(tmp_path / "a"), ["k"], 4)
    b = write_bucketed(facts, "facts_b", str(tmp_path / "b"), ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = b.join(latest_per_key(a, ["k"], ["at"]), "k", "left")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Window" in plan and "Exchange" not in plan
        plain = facts.join(latest_per_key(rows, ["k"], ["at"]), "k", "left")
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE versions_b")
    again = attach(spark, "versions_again", str(tmp_path / "a"), rows, ["k"], 4)
    assert again.count() == 3000
    spark.sql("DROP TABLE versions_again")
    spark.sql("DROP TABLE facts_b")


def test_shuffles_of_a_finished_job_are_removed(spark):
    """a scheduled run keeps no shuffle files of the steps that have ended."""
    import time
    from pyspark.sql import functions as F
    held = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    had, rows = spark.conf.get(runner.CLEANUP, None), spark.range(1000).groupBy(F.col("id") % 7).count()
    with runner.shuffles_removed(spark):
        n = held()
        rows.write.format("noop").mode("overwrite").save()
        until = time.time() + 20
        while held() > n and time.time() < until:
            time.sleep(0.1)
        assert held() <= n
    assert spark.conf.get(runner.CLEANUP, None) == had
