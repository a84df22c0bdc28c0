"""M1-M3 truth table: every clause, NULL flag and sequence case of the SCD-1 merge."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.functions.temporal import ts_literal
from stratum.operators import dedup_latest, fact_merge, scd1_merge, split_null_keys

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 3)
RUN = "2024-02-01 00:00:00"
RUN_DT = dt.datetime(2024, 2, 1)

TGT = "k long, v string, created string, audit_updated_at timestamp_ntz, is_deleted boolean, " \
      "silver_loaded_at timestamp_ntz, silver_updated_at timestamp_ntz"
SRC = "k long, v string, created string, audit_updated_at timestamp_ntz, is_deleted boolean"


def merge(spark, target_rows, source_rows):
    t = spark.createDataFrame(target_rows, TGT)
    s = spark.createDataFrame(source_rows, SRC)
    out = scd1_merge(t, s, ["k"], update_cols=["v", "audit_updated_at", "is_deleted"],
                     insert_cols=["k", "v", "created", "audit_updated_at", "is_deleted"], run_ts=ts_literal(RUN))
    return {r["k"]: r.asDict() for r in out.collect()}


@pytest.mark.parametrize("src_deleted,src_ts,tgt_ts,expect", [
    # clause 1: a delete wins even when stale; nothing but the flag and updated_at moves
    (True, T2, T1, "deleted"), (True, T0, T1, "deleted"), (True, None, T1, "deleted"),
    # clause 2: newer (or target audit NULL) overwrites
    (False, T2, T1, "updated"), (False, T2, None, "updated"), (None, T2, T1, "updated"),
    # clause 4: equal, older, or NULL source audit against a non-NULL target: no change
    (False, T1, T1, "same"), (False, T0, T1, "same"), (False, None, T1, "same"), (None, T0, T1, "same"),
])
def test_matched_clauses(spark, src_deleted, src_ts, tgt_ts, expect):
    out = merge(spark, [(1, "old", "c0", tgt_ts, False, T0, None)], [(1, "new", "c1", src_ts, src_deleted)])
    r = out[1]
    assert r["created"] == "c0"  # never in the update list
    assert r["silver_loaded_at"] == T0
    if expect == "deleted":
        assert (r["v"], r["is_deleted"], r["audit_updated_at"], r["silver_updated_at"]) == ("old", True, tgt_ts, RUN_DT)
    elif expect == "updated":
        assert (r["v"], r["is_deleted"], r["audit_updated_at"], r["silver_updated_at"]) == \
            ("new", src_deleted, src_ts, RUN_DT)
    else:
        assert (r["v"], r["is_deleted"], r["silver_updated_at"]) == ("old", False, None)


@pytest.mark.parametrize("src_deleted,inserted", [(False, True), (True, False), (None, False)])
def test_unmatched_insert_only_live(spark, src_deleted, inserted):
    out = merge(spark, [(1, "a", "c", T0, False, T0, None)], [(2, "b", "c2", T1, src_deleted)])
    assert (2 in out) is inserted
    if inserted:
        assert out[2]["silver_loaded_at"] == RUN_DT and out[2]["silver_updated_at"] is None


def test_resurrection_of_deleted_row(spark):
    out = merge(spark, [(1, "a", "c", T0, True, T0, T1)], [(1, "b", "c", T1, False)])
    assert (out[1]["is_deleted"], out[1]["v"]) == (False, "b")


def test_null_key_never_inserted_and_quarantined(spark):
    s = spark.createDataFrame([(None, "x", "c", T1, False), (3, "y", "c", T1, False)], SRC)
    good, bad = split_null_keys(s, ["k"])
    assert good.count() == 1 and bad.count() == 1
    out = merge(spark, [], [(None, "x", "c", T1, False)])
    assert out == {}


def test_replaying_a_batch_is_a_no_op(spark):
    rows = [(1, "a", "c", T1, False), (2, "b", "c", T1, False)]
    s = spark.createDataFrame(rows, SRC)
    t0 = spark.createDataFrame([], TGT)
    kw = dict(update_cols=["v", "audit_updated_at", "is_deleted"], insert_cols=["k", "v", "created",
              "audit_updated_at", "is_deleted"], run_ts=ts_literal(RUN))
    once = scd1_merge(t0, s, ["k"], **kw)
    twice = scd1_merge(once, s, ["k"], **kw)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_fact_merge_overwrites_without_guard(spark):
    t = spark.createDataFrame([(1, "old", T0, None)], "k long, v string, gold_loaded_at timestamp_ntz, "
                                                        "gold_updated_at timestamp_ntz")
    s = spark.createDataFrame([(1, "new"), (2, "ins")], "k long, v string")
    out = {r["k"]: r for r in fact_merge(t, s, ["k"], run_ts=ts_literal(RUN)).collect()}
    assert out[1]["v"] == "new" and out[1]["gold_updated_at"] == RUN_DT and out[1]["gold_loaded_at"] == T0
    assert out[2]["gold_loaded_at"] == RUN_DT and out[2]["gold_updated_at"] is None


def test_dedup_ties_nulls_single(spark):
    df = spark.createDataFrame([(1, None, 1), (1, T1, 2), (1, T1, 3), (2, None, 4), (2, None, 5), (3, T0, 6)],
                               "k long, ts timestamp_ntz, row_no long")
    out = {r["k"]: r["row_no"] for r in dedup_latest(df, ["k"], ["ts"], [F.col("row_no").desc()]).collect()}
    assert out == {1: 3, 2: 5, 3: 6}


def test_dedup_is_partial_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = dedup_latest(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_spec_quarantine_plus_loaded_equals_input(spark):
    """NULL keys go to quarantine; every other key is loaded."""
    from stratum.plans import specs
    rows = [(1, 10, " a@b.co ", " x ", None, "v", True, T1, T1, False, "[1]", None, 1),
            (2, None, "c@d.co", "y", "z", "v", False, T1, T1, False, None, None, 1),
            (3, 11, "e@f.co", "w", "q", "v", True, T0, T0, False, "[]", None, 1)]
    raw = spark.createDataFrame(rows, "row_no long, contact_id long, email string, first_name string, "
                                      "last_name string, vehicle_make string, is_email_optin boolean, "
                                      "modified_at timestamp_ntz, audit_updated_at timestamp_ntz, is_deleted boolean, "
                                      "list_ids_raw string, list_unsubscribed_raw string, batch_no int")
    raw = raw.selectExpr("*", "cast(null AS date) AS date_of_birth", "false AS is_email_blacklisted", "true AS is_sms_blacklisted",
                         "modified_at AS created_at", "modified_at AS api_extracted_at")
    run = ts_literal(RUN)
    loaded = specs.SLV_CONTACT.merge(None, raw, run)
    bad = specs.SLV_CONTACT.quarantine(raw, run)
    assert sorted(r["contact_id"] for r in loaded.collect()) == [10, 11]
    assert [r["row_no"] for r in bad.collect()] == [2]
