"""Property test: the SCD-1 merge equals a direct model of the reference's four MERGE clauses."""

import datetime as dt

from hypothesis import given, settings, HealthCheck, strategies as st

from stratum.functions.temporal import ts_literal
from stratum.operators import scd1_merge

RUN = "2024-02-01 00:00:00"
RUN_DT = dt.datetime(2024, 2, 1)
LOADED = dt.datetime(2024, 1, 15)
TS = st.one_of(st.none(), st.sampled_from([dt.datetime(2024, 1, d) for d in (1, 2, 3)]))
FLAG = st.sampled_from([True, False, None])
TGT = "k long, v string, audit_updated_at timestamp_ntz, is_deleted boolean, " \
      "silver_loaded_at timestamp_ntz, silver_updated_at timestamp_ntz"
SRC = "k long, v string, audit_updated_at timestamp_ntz, is_deleted boolean"


def model(target: dict, source: dict) -> dict:
    out = {}
    for k in set(target) | set(source):
        t, s = target.get(k), source.get(k)
        if t and s:
            if s["is_deleted"] is True:                                         # clause 1
                out[k] = {**t, "is_deleted": True, "silver_updated_at": RUN_DT}
            elif t["audit_updated_at"] is None or (s["audit_updated_at"] is not None
                                                   and t["audit_updated_at"] < s["audit_updated_at"]):
                out[k] = {**t, "v": s["v"], "audit_updated_at": s["audit_updated_at"],   # clause 2
                          "is_deleted": s["is_deleted"], "silver_updated_at": RUN_DT}
            else:
                out[k] = t                                                       # clause 4
        elif t:
            out[k] = t
        elif s["is_deleted"] is False:                                           # clause 3
            out[k] = {**s, "silver_loaded_at": RUN_DT, "silver_updated_at": None}
    return out


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tgt=st.dictionaries(st.integers(0, 5), st.tuples(TS, st.booleans()), max_size=6),
       src=st.dictionaries(st.integers(0, 7), st.tuples(TS, FLAG), max_size=8))
def test_merge_matches_clause_model(spark, tgt, src):
    target = {k: {"k": k, "v": f"t{k}", "audit_updated_at": a, "is_deleted": d, "silver_loaded_at": LOADED,
                  "silver_updated_at": None} for k, (a, d) in tgt.items()}
    source = {k: {"k": k, "v": f"s{k}", "audit_updated_at": a, "is_deleted": d} for k, (a, d) in src.items()}
    t = spark.createDataFrame([tuple(r.values()) for r in target.values()], TGT)
    s = spark.createDataFrame([tuple(r.values()) for r in source.values()], SRC)
    got = {r["k"]: r.asDict() for r in scd1_merge(
        t, s, ["k"], update_cols=["v", "audit_updated_at", "is_deleted"],
        insert_cols=["k", "v", "audit_updated_at", "is_deleted"], run_ts=ts_literal(RUN)).collect()}
    assert got == model(target, source)


def scd2_model(runs):
    """Versions after each run: close a current row when a tracked value differs (NULL = ''/0), open a
    row for changed and new keys; new keys get surrogate keys after the max, in key order."""
    versions, base = [], 0
    for i, source in enumerate(runs):
        ts = dt.datetime(2024, 3, 1 + i)
        current = {v["k"]: v for v in versions if v["is_current"]}
        opened = []
        for k in sorted(source):
            name, n = source[k]
            cur = current.get(k)
            if cur is not None and (name or "") == (cur["name"] or "") and (n or 0) == (cur["n"] or 0):
                continue
            if cur is not None:
                cur.update(effective_end_date=ts, is_current=False, gold_updated_at=ts)
            opened.append(k)
        for j, k in enumerate(opened, start=1):
            name, n = source[k]
            versions.append({"sk": base + j, "k": k, "name": name, "n": n, "effective_start_date": ts,
                             "effective_end_date": dt.datetime(9999, 12, 31), "is_current": True,
                             "gold_loaded_at": ts, "gold_updated_at": None})
        base += len(opened)
    return sorted(versions, key=lambda v: v["sk"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs=st.lists(st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from(["a", "b", "", None]),
                                                                   st.sampled_from([0, 1, None])), max_size=7),
                     min_size=1, max_size=3))
def test_scd2_matches_version_model(spark, runs):
    from stratum.operators.scd2 import Scd2Spec, scd2_apply
    spec = Scd2Spec(sk_col="sk", keys=("k",), tracked={"name": "", "n": 0})
    dim = None
    for i, source in enumerate(runs):
        src = spark.createDataFrame([(k, nm, n) for k, (nm, n) in source.items()], "k long, name string, n long")
        dim = scd2_apply(dim, src, spec, ts_literal(f"2024-03-0{1 + i} 00:00:00"))
        dim = spark.createDataFrame(dim.collect(), dim.schema)      # small: cut lineage between runs
    got = sorted((r.asDict() for r in dim.collect()), key=lambda v: v["sk"])
    assert got == scd2_model(runs)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.dictionaries(st.integers(0, 6), st.sampled_from(["a", "b", None]), max_size=7),
       new=st.dictionaries(st.integers(0, 6), st.sampled_from(["a", "b", None]), max_size=7))
def test_change_feed_matches_diff_model(spark, old, new):
    from stratum.operators import change_feed
    o = spark.createDataFrame([(k, v) for k, v in old.items()], "k long, v string")
    n = spark.createDataFrame([(k, v) for k, v in new.items()], "k long, v string")
    got = sorted((r["k"], r["v"] or "~", r["metadata_action"], r["metadata_is_update"])
                 for r in change_feed(o, n, ["k"]).collect())
    want = []
    for k in set(old) | set(new):
        if k in old and k in new:
            if old[k] != new[k]:
                want += [(k, old[k] or "~", "DELETE", True), (k, new[k] or "~", "INSERT", True)]
        elif k in old:
            want.append((k, old[k] or "~", "DELETE", False))
        else:
            want.append((k, new[k] or "~", "INSERT", False))
    assert got == sorted(want)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3))), max_size=20))
def test_dedup_matches_latest_model(spark, rows):
    from pyspark.sql import functions as F
    from stratum.operators import dedup_latest
    data = [(k, ts, i) for i, (k, ts) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, ts long, row_no long")
    got = {r["k"]: r["row_no"] for r in dedup_latest(df, ["k"], ["ts"], [F.col("row_no").desc()]).collect()}
    want = {}
    for k, ts, i in data:   # latest ts, NULL last; ties -> highest row_no
        best = want.get(k)
        rank = (ts is not None, ts if ts is not None else -1, i)
        if best is None or rank > best[0]:
            want[k] = (rank, i)
    assert got == {k: v[1] for k, v in want.items()}
