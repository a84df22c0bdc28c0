"""CSV scan, inference, load by name, quarantine, snapshots, stage listing and cleanup."""

import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from stratum.sources import (SnapshotTable, infer_schema, load_by_name, load_csv_with_quarantine, normalize_name,
                             read_csv, remove_files, stage_inventory)

CSV = ('"Id","First Name","Attributes","Created At"\n'
       '1,"Al-Suwaidi","{""geo"":""x""}",2024-01-01 10:00:00\n'
       '\n'
       '2,"",,2024-01-02 11:00:00\n'
       '3,Bob,"{}",not-a-time\n'
       '4,Long,"{}",2024-01-03 00:00:00,EXTRA\n'
       '5,Short\n')


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_csv_quotes_blank_lines_empty_vs_null(spark, tmp_path):
    path = write(tmp_path, "a.csv", CSV.split("3,Bob")[0])
    df = read_csv(spark, path, StructType([StructField(n, StringType()) for n in
                                           ("Id", "First Name", "Attributes", "Created At")]))
    r = {x["Id"]: x for x in df.collect()}
    assert set(r) == {"1", "2"}                       # blank line skipped
    assert r["1"]["Attributes"] == '{"geo":"x"}'      # doubled quotes inside a quoted value
    assert r["2"]["First Name"] == "" and r["2"]["Attributes"] is None  # "" stays '', empty is NULL


def test_infer_schema_types(spark, tmp_path):
    path = write(tmp_path, "b.csv", "id,flag,ts,name\n1,true,2024-01-01 00:00:00,a\n2,false,2024-01-02 00:00:00,b\n")
    s = infer_schema(spark, path)
    assert [f.dataType.simpleString() for f in s.fields][:2] == ["int", "boolean"]
    assert s["ts"].dataType.simpleString().startswith("timestamp")


def test_normalize_and_load_by_name(spark):
    assert normalize_name("First Name") == "first_name" == normalize_name("FIRST_NAME") == normalize_name(" first-name ")
    df = spark.createDataFrame([("7", "x", "9", "zz")], "`ID` string, `first name` string, `Extra` string, `AGE` string")
    target = StructType([StructField("id", LongType()), StructField("First_Name", StringType()),
                         StructField("missing", IntegerType()), StructField("age", IntegerType())])
    r = load_by_name(df, target).collect()[0]
    assert tuple(r) == (7, "x", None, None) and load_by_name(df, target).columns == ["id", "First_Name", "missing", "age"]


def test_quarantine_keeps_every_row(spark, tmp_path):
    path = write(tmp_path, "c.csv", CSV)
    target = StructType([StructField("id", LongType()), StructField("first_name", StringType()),
                         StructField("created_at", TimestampNTZType())])
    good, bad = load_csv_with_quarantine(spark, path, target, ["Id", "First Name", "Attributes", "Created At"])
    assert sorted(r["id"] for r in good.collect()) == [1, 2]
    assert bad.count() == 3                      # bad cast, too many fields, too few fields
    assert good.count() + bad.count() == 5


def test_snapshot_table_versions_and_replay(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "tbl"))
    assert t.read() is None
    assert t.publish(spark.range(3)) == 0
    assert t.publish(spark.range(5)) == 1
    assert t.publish(spark.range(100), version=1) == 1   # already committed: replay is a no-op
    assert t.read().count() == 5 and t.read(0).count() == 3
    os.makedirs(tmp_path / "tbl" / "v=2")                # a version without _SUCCESS is invisible
    assert t.current_version() == 1
    t.append(spark.range(2), "b1")
    t.append(spark.range(9), "b1")
    assert spark.read.parquet(str(tmp_path / "tbl" / "batch=b1")).count() == 2


def test_stage_inventory_and_cleanup(spark, tmp_path):
    a = write(tmp_path, "x1.csv", "a\n1\n")
    write(tmp_path, "x2.csv", "a\n2\n3\n")
    inv = {r["file_name"]: r["size_bytes"] for r in stage_inventory(spark, str(tmp_path / "x*.csv")).collect()}
    assert inv == {"x1.csv": 4, "x2.csv": 6}
    assert remove_files(spark, [a]) == 1 and not os.path.exists(a) and os.path.exists(tmp_path / "x2.csv")


MERGE_COLS = ["k", "v", "audit_updated_at", "is_deleted"]
MERGE_SCHEMA = "k long, v string, audit_updated_at timestamp_ntz, is_deleted boolean"


def run_merge(table, rows, day, version=None):
    """One SCD-1 run of ``rows`` (k, v, audit day, deleted) on a ChangeTable at 2024-02-``day``."""
    import datetime as dt
    from pyspark.sql import functions as F
    from stratum.functions.temporal import ts_literal
    from stratum.operators import scd1_merge
    from stratum.operators.merge import insert_into_empty
    ts = ts_literal(f"2024-02-{day:02d} 00:00:00")

    def merge(target, src):
        if target is None:
            return insert_into_empty(src, ["k"], columns=MERGE_COLS, run_ts=ts)
        return scd1_merge(target, src, ["k"], update_cols=MERGE_COLS[1:], insert_cols=MERGE_COLS, run_ts=ts)

    source = table.spark.createDataFrame([(k, v, dt.datetime(2024, 1, d), gone) for k, v, d, gone in rows], MERGE_SCHEMA)
    changed = (F.col("silver_loaded_at") == ts) | (F.col("silver_updated_at") == ts)
    return table.merge(source, merge, changed, version)


def test_change_table_writes_only_changed_rows(spark, tmp_path):
    from stratum.sources.snapshots import ChangeTable
    t = ChangeTable(spark, str(tmp_path / "bt"), ["k"])
    assert t.read() is None and run_merge(t, [(k, "a", 1, False) for k in range(20_000)], 1) == 0
    batch = [(k * 97, "b", 2, False) for k in range(200)] + [(5, "late", 1, False), (90_000, "new", 2, False), (90_001, "x", 2, True)]
    assert run_merge(t, batch, 2) == 1
    assert t.changes(1).count() == 201 and t.changes(0).count() == 20_000     # scattered keys: the batch, not the table
    files = list((tmp_path / "bt" / "v=1").glob("part-*"))
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert len(got) == 20_001 and got[97] == "b" and got[5] == "a" and got[90_000] == "new"
    assert run_merge(t, [(5, "z", 9, False)], 3, version=1) == 1 and t.last_commit() == 1   # replay: no-op
    assert {r["k"]: r["v"] for r in t.read(as_of=0).collect()}[97] == "a"      # earlier versions stay readable


def test_change_table_compacts_and_expires(spark, tmp_path):
    from stratum.sources.snapshots import ChangeTable
    t = ChangeTable(spark, str(tmp_path / "ct"), ["k"], max_changes=2)
    for n in range(5):
        run_merge(t, [(k, f"r{n}", n + 1, False) for k in range(n, n + 4)], n + 1)
    want = {0: "r0", 1: "r1", 2: "r2", 3: "r3", **{k: "r4" for k in range(4, 8)}}
    assert {r["k"]: r["v"] for r in t.read().collect()} == want
    assert t.manifest()["base"] == 2 and t.manifest()["changes"] == [3, 4]
    assert t.expire(keep=1) > 0
    assert {r["k"]: r["v"] for r in ChangeTable(spark, t.root, ["k"]).read().collect()} == want
    assert not (tmp_path / "ct" / "v=0").exists() and (tmp_path / "ct" / "v=4").exists()


def test_change_table_survives_a_crash_before_the_manifest(spark, tmp_path):
    from stratum.sources.snapshots import ChangeTable
    t = ChangeTable(spark, str(tmp_path / "crash"), ["k"])
    run_merge(t, [(k, "a", 1, False) for k in range(50)], 1)
    t.read().withColumn("v", F.lit("BROKEN")).write.parquet(str(tmp_path / "crash" / "v=1"))   # no manifest
    assert t.last_commit() == 0 and "BROKEN" not in {r["v"] for r in t.read().collect()}
    run_merge(t, [(1, "b", 2, False)], 2, version=1)
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert t.last_commit() == 1 and got[1] == "b" and "BROKEN" not in got.values() and len(got) == 50


def test_change_table_refuses_a_second_commit_of_a_version(spark, tmp_path):
    from stratum.sources.snapshots import ChangeTable
    t = ChangeTable(spark, str(tmp_path / "two"), ["k"])
    run_merge(t, [(1, "a", 1, False)], 1)
    with pytest.raises(RuntimeError):
        t._write_manifest(0, {"base": None, "changes": [0], "meta": {}})


def test_empty_first_batch_has_no_change_rows(spark, tmp_path):
    from stratum.sources.snapshots import ChangeTable
    t = ChangeTable(spark, str(tmp_path / "none"), ["k"])
    run_merge(t, [], 1)
    assert t.read().count() == 0 and t.changes(0).count() == 0
    run_merge(t, [(1, "a", 1, False)], 2)
    assert t.changes(1).count() == 1


def test_load_extract_appends_good_rows_once(spark, tmp_path):
    from stratum.sources.csv import load_extract
    path = write(tmp_path, "d.csv", CSV)
    target = StructType([StructField("id", LongType()), StructField("first_name", StringType()),
                         StructField("created_at", TimestampNTZType())])
    bronze, aside = (SnapshotTable(spark, str(tmp_path / n)) for n in ("bronze", "aside"))
    for _ in range(2):                                                     # replay: nothing appended twice
        load_extract(spark, path, target, bronze, "extract-1", aside)
    os.remove(path)                                                        # the stage is cleaned; both sides stay
    loaded = spark.read.parquet(str(tmp_path / "bronze" / "batch=*"))
    assert sorted(r["id"] for r in loaded.collect()) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "aside" / "batch=*")).count() == 3


def test_load_extract_without_quarantine_refuses_bad_rows(spark, tmp_path):
    from stratum.sources.csv import load_extract
    target = StructType([StructField("id", LongType())])
    with pytest.raises(ValueError):
        load_extract(spark, write(tmp_path, "e.csv", "id\nx\n"), target, SnapshotTable(spark, str(tmp_path / "b")), "e")


def test_columns_are_matched_by_each_files_header(spark, tmp_path):
    write(tmp_path, "h1.csv", "id,city,name\n1,Rome,Ann\n")
    write(tmp_path, "h2.csv", "Name,ID\nBob,2\n")
    df = read_csv(spark, str(tmp_path / "h*.csv"), StructType.fromDDL("id long, name string, city string"))
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Ann", "Rome"), (2, "Bob", None)]


def test_contracts_of_a_stage_are_inferred_kept_and_widened(spark, tmp_path):
    from stratum.sources.contracts import column_states, contracts, from_json, merged_states, to_json
    from stratum.sources.csv import load_files

    def put(stage, table, name, text):
        (tmp_path / stage / table).mkdir(parents=True, exist_ok=True)
        (tmp_path / stage / table / name).write_text(text)
    for k in range(88):
        put("one", f"t{k:02d}", "a.csv", f"Id,Sent At,Flag,Note,Col {k}\n1,2024-01-02,true,,{k}\n2,2024-01-03,FALSE,,7\n")
        put("one", f"t{k:02d}", "b.csv", f"col-{k},ID\n3,3\n")                   # other columns in another order
    put("one", "odd", "a.csv", 'Text,Quoted\n"a\nb","1,5"\n"",""\n')
    put("one", "odd", "empty.csv", "")
    first = column_states(spark, str(tmp_path / "one"))
    found = contracts(first)
    assert len(found) == 89 and all(
        [(f.name, f.dataType.simpleString()) for f in found[f"t{k:02d}"].fields]
        == [("id", "bigint"), ("sent_at", "date"), ("flag", "boolean"), ("note", "string"), (f"col_{k}", "bigint")]
        or sorted(f.name for f in found[f"t{k:02d}"].fields) == sorted(["id", "sent_at", "flag", "note", f"col_{k}"]) for k in range(88))
    assert {f.name: f.dataType.simpleString() for f in found["odd"].fields} == {"text": "string", "quoted": "string"}
    assert from_json(to_json(found)) == found
    put("two", "t05", "c.csv", "SENT AT,col 5,id,flag\n2024-01-04 10:00:00,1.5,x9,true\n")
    after = contracts(merged_states(first, column_states(spark, str(tmp_path / "two"))))
    kinds = {f.name: f.dataType.simpleString() for f in after["t05"].fields}
    assert kinds == {"id": "string", "sent_at": "timestamp_ntz", "col_5": "double", "flag": "boolean", "note": "string"}
    assert after["t06"] == found["t06"]
    good, bad = load_files(spark, f"{tmp_path}/*/t05/*.csv", after["t05"])
    assert good.count() == 4 and bad.count() == 0
    assert sorted(str(r["id"]) for r in good.collect()) == ["1", "2", "3", "x9"]


def test_cast_guards_refuse_nothing_that_casts(spark):
    """A value is only cast where it looks like its type: the look must hold for all that does cast."""
    from pyspark.sql import functions as F
    from stratum.sources import contracts as C
    texts = ["1", "+1", "-0", "1.", ".5", "1e5", "1E-3", "1e+3f", "1d", "0x1p3", "NaN", "nan", "inf", "-Infinity", "+inf",
             "9223372036854775807", "-9223372036854775808", "12345678901234567890", "1995", "199506", "1995-1-1", "1995-01-01",
             "+12345-01-01", "1995-01-01T10", "1995-01-01 10:00:00", "1995-01-01 10:00:00Z", "T10:00", "10:00", "n/a", "true",
             "Customer#1", "--1", "+", ".", "e5", "1,000"]
    padded = [(p + t + q,) for t in texts for p in ("", "\t", "\n", "\x01") for q in ("", "\t", "\n", "\x7f", "x")]
    df = spark.createDataFrame(padded, "v string")
    for name, kind in C.TYPES:
        if name in C.LIKE:
            casts = F.col("v").try_cast(kind).isNotNull()
            assert df.filter(casts).count() > 0
            assert df.filter(casts & ~F.col("v").rlike(C.LIKE[name])).count() == 0, name


def test_column_names_are_worked_out_per_file(spark, tmp_path):
    """No regular expression over the path or the header runs for each cell, and no file's rows are shuffled for its header."""
    from stratum.sources.contracts import column_states
    for name, text in (("a", "X Id,Note\n1,hello\n2,\n"), ("b", "note,,x-id\nq,9,2.5\n")):
        (tmp_path / "t").mkdir(exist_ok=True)
        (tmp_path / "t" / f"{name}.csv").write_text(text)
    states = column_states(spark, str(tmp_path))
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    got = {r["column_name"]: (r["table_name"], r["n_values"], r["long"], r["double"]) for r in states.collect()}
    assert got == {"x_id": ("t", 3, False, True), "note": ("t", 2, False, False)}
