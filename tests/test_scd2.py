"""M4-M7 SCD-2 runs and M6 surrogate keys (FIXTURES.md part D)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from stratum.functions.temporal import ts_literal
from stratum.operators import assign_surrogate_keys, history as H, scd2_apply
from stratum.operators.scd2 import Scd2Spec

SPEC = Scd2Spec(sk_col="sk", keys=("k",), tracked={"name": "", "n": 0}, carried=("note",))
SRC = "k long, name string, n long, note string"
R1, R2, R3 = "2024-03-01 00:00:00", "2024-03-02 00:00:00", "2024-03-03 00:00:00"
OPEN = dt.datetime(9999, 12, 31)


def run(spark, dim, rows, ts):
    return scd2_apply(dim, spark.createDataFrame(rows, SRC), SPEC, ts_literal(ts))


def by_key(dim):
    out = {}
    for r in dim.collect():
        out.setdefault(r["k"], []).append(r.asDict())
    return {k: sorted(v, key=lambda x: x["sk"]) for k, v in out.items()}


def test_scd2_cases(spark):
    d1 = run(spark, None, [(1, "a", 1, "x"), (2, "b", 0, "x"), (3, None, 5, "x"), (4, "d", 0, "x"),
                           (5, "e", 1, "x")], R1)
    d2 = run(spark, d1, [
        (1, "a", 1, "x"),        # unchanged
        (2, "B", 0, "x"),        # tracked change -> new version
        (3, "", 5, "y"),         # NULL -> '' and an untracked change: no version
        (4, "d", None, "x"),     # 0 -> NULL: no version
        (6, "f", 1, "x"),        # new key
    ], R2)                       # key 5 absent (e.g. deleted in Silver): stays current
    v = by_key(d2)
    assert [x["is_current"] for x in v[1]] == [True]
    assert [(x["name"], x["is_current"]) for x in v[2]] == [("b", False), ("B", True)]
    assert v[2][0]["effective_end_date"] == dt.datetime(2024, 3, 2) == v[2][1]["effective_start_date"]
    assert v[2][1]["effective_end_date"] == OPEN and v[2][0]["gold_updated_at"] == dt.datetime(2024, 3, 2)
    assert len(v[3]) == 1 and v[3][0]["note"] == "x" and len(v[4]) == 1 and v[5][0]["is_current"]
    assert v[6][0]["sk"] == 7 and v[2][1]["sk"] == 6  # new keys after the max, in natural-key order
    d3 = run(spark, d2, [(1, "a", 1, "x"), (2, "B", 0, "x"), (6, "f", 1, "x")], R3)  # same input: nothing moves
    assert by_key(d3) == {k: [dict(x) for x in v] for k, v in by_key(d2).items()}


def test_invariants_one_current_no_overlap(spark):
    d = None
    for i, ts in enumerate((R1, R2, R3)):
        d = run(spark, d, [(k, f"n{(k + i) % 3}", k, "z") for k in range(50)], ts)
    assert d.groupBy("k").agg(F.sum(F.col("is_current").cast("int")).alias("c")).filter("c != 1").count() == 0
    adj = H.adjacent_versions(d, ["k"], ["name"])
    hist = d.filter(~F.col("is_current")).count()
    assert hist > 0 and d.filter(~F.col("is_current")).join(
        d.select("k", F.col("effective_start_date").alias("effective_end_date")),
        ["k", "effective_end_date"], "left_anti").count() == 0
    assert adj.count() <= d.filter("is_current").count()
    sks = sorted(r[0] for r in d.select("sk").collect())
    assert sks == list(range(1, len(sks) + 1))


def test_surrogate_keys_match_global_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(((F.col("id") * 7919) % 5000).alias("k"))
    out = assign_surrogate_keys(df, ["k"], "sk", base=100, num_partitions=5)
    got = sorted((r["k"], r["sk"]) for r in out.collect())
    assert got == [(k, 101 + k) for k in range(5000)]


def test_point_in_time_edges(spark):
    d = run(spark, None, [(1, "a", 1, "x")], R1)
    d = run(spark, d, [(1, "b", 1, "x")], R2)
    def names(ts):
        return sorted(r["name"] for r in H.as_of(d, ts_literal(ts)).collect())
    assert names(R1) == ["a"]            # exactly at start: included
    assert names(R2) == ["b"]            # at the end of the first version: excluded (half open)
    assert names("2024-02-01 00:00:00") == []  # before the first version
    facts = spark.createDataFrame([(1, dt.datetime(2024, 3, 1, 12)), (1, dt.datetime(2024, 3, 5)),
                                   (2, dt.datetime(2024, 3, 5))], "k long, ts timestamp_ntz")
    j = H.as_of_join(facts, d.select("k", "name", "effective_start_date", "effective_end_date"), ["k"], "ts")
    assert sorted((r["k"], r["name"]) for r in j.collect()) == [(1, "a"), (1, "b"), (2, None)]


def test_keys_go_on_after_a_restart(spark, tmp_path):
    """The key base is part of each commit: a process that opens the table again goes on from there."""
    from stratum.operators.scd2 import scd2_changes
    from stratum.plans.state import scd2_runs
    src = lambda rows: spark.createDataFrame(rows, SRC)
    runs = [(src([(k, "a", 1, "x") for k in range(100)]), ts_literal(R1)), (src([(5000, "n", 1, "x")]), ts_literal(R2)),
            (src([(7, "changed", 1, "x")]), ts_literal(R3))]
    for n in (1, 2, 3):                       # each call is a new table object on the same folder
        snaps = scd2_runs(spark, SPEC, runs[:n], "t", root=str(tmp_path / "dim"))
    sks = sorted(r["sk"] for r in snaps[-1].collect())
    assert sks == list(range(1, 103))
    with pytest.raises(TypeError):            # a part of a dimension needs the key base
        scd2_changes(snaps[-1].filter("is_current").limit(0), runs[0][0], SPEC, ts_literal(R3))


def test_scd2_keys_stay_unique_over_runs(spark):
    """A run that meets only unknown keys continues the key sequence, it does not restart it."""
    from stratum.plans.state import scd2_runs
    src = lambda rows: spark.createDataFrame(rows, SRC)
    snaps = scd2_runs(spark, SPEC, [(src([(1, "a", 1, "x")]), ts_literal(R1)),
                                    (src([(k, "n", 1, "x") for k in range(100, 140)]), ts_literal(R2)),
                                    (src([(1, "changed", 1, "x")]), ts_literal(R3))], "t")
    final = snaps[-1]
    sks = [r["sk"] for r in final.collect()]
    assert len(sks) == len(set(sks)) == 42 and sorted(sks) == list(range(1, 43))
    assert snaps[0].count() == 1 and snaps[1].count() == 41   # earlier versions stay readable
