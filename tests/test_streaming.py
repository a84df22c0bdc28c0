"""Landing -> Bronze -> Silver with Structured Streaming equals the batch result."""

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.plans import feeds, mailing, specs
from stratum.sources import SnapshotTable
from stratum.streaming import MergeSink, has_new_files, land_batch, read_bronze, stream_ingest, stream_merge
from tests.conftest import SF0001


def test_csv_ingest_available_now_and_clean_source(spark, tmp_path):
    landing, bronze, ck = str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "ck")
    os.makedirs(landing)
    st = StructType.fromDDL("id long, name string")
    (tmp_path / "landing" / "a b.csv").write_text("id,name\n1,a\n2,b\n")     # a blank in the name
    (tmp_path / "landing" / "head.csv").write_text("id,name\n")               # no rows
    (tmp_path / "landing" / "empty.csv").write_text("")
    run = lambda: stream_ingest(spark, landing, bronze, st, ck, clean_source="delete",
                                source_file_col="source_file").awaitTermination()
    assert has_new_files(spark, landing + "/*.csv", ck)
    run()
    assert read_bronze(spark, bronze).count() == 2
    assert not has_new_files(spark, landing + "/*.csv", ck)
    (tmp_path / "landing" / "b.csv").write_text("NAME,Extra,Id\nc,x,3\n")      # another order, another column
    assert has_new_files(spark, landing + "/*.csv", ck)
    run()
    assert sorted((r["id"], r["name"]) for r in read_bronze(spark, bronze).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    run()                                                      # nothing new: nothing appended
    assert read_bronze(spark, bronze).count() == 3
    assert read_bronze(spark, bronze + "_quarantine").count() == 0


def test_csv_ingest_keeps_every_row(spark, tmp_path):
    """Good + bad = input: bad, short, long and multi-line records, a missing key, columns in another order."""
    landing, bronze, ck = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ck")
    landing.mkdir()
    st = StructType.fromDDL("id long, name string, city string")
    (landing / "a.csv").write_text('id,city,name\nabc,Paris,Ann\n2,Rome,Bob,EXTRA\n3\n4,"Oslo\nNorth, ""old""",Cy\n,Bonn,Di\n5,,""\n')
    stream_ingest(spark, str(landing), bronze, st, ck, keys=("id",), clean_source="delete").awaitTermination()
    good = sorted(tuple(r) for r in read_bronze(spark, bronze).select("id", "name", "city").collect())
    assert good == [(4, "Cy", 'Oslo\nNorth, "old"'), (5, "", None)]
    bad = read_bronze(spark, bronze + "_quarantine").collect()
    assert sorted(r["reason"] for r in bad) == ["fields", "fields", "no id", "type of id"]
    assert all(r["source_file"].endswith("a.csv") for r in bad) and any("abc" in r["record"] for r in bad)


def test_stream_merge_equals_batch_merge_and_replay_is_idempotent(spark, tmp_path):
    root = str(tmp_path / f"s{uuid.uuid4().hex}")
    feed = feeds.contact_feed(spark, SF0001)
    table = SnapshotTable(spark, f"{root}/silver")
    sink = MergeSink(table, specs.SLV_CONTACT.merge, lambda b: mailing.run_ts(b + 1))
    for batch in mailing.CONTACT_BATCH_ORDER:
        land_batch(feed.filter(F.col("batch_no") == batch), f"{root}/bronze", f"batch-{batch}")
        stream_merge(spark, f"{root}/bronze", feed.schema, sink, f"{root}/ck").awaitTermination()
    streamed = table.read()
    batch = mailing.contact_silver(spark, SF0001)[-1]
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.select(*streamed.columns).collect()))
    version = table.current_version()
    sink(feed.filter(F.col("batch_no") == 3), version)   # a replayed micro-batch changes nothing
    assert table.current_version() == version
