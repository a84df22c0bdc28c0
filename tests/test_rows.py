"""F14/M9 JSON flatten, T4/T5 change rows, J8-J10 history helpers."""

from pyspark.sql import functions as F

from stratum.operators import change_feed, flatten_json_array, inserts_only, list_membership
from stratum.operators import history as H


def test_flatten_edge_inputs(spark):
    df = spark.createDataFrame([(1, "[1,2]"), (2, "[]"), (3, '[1,"3",null,"x"]'), (4, '{"a":5}'), (5, "7"),
                                (6, "[1,"), (7, ""), (8, None)], "id int, j string")
    key = lambda t: (t[0], t[1] is None, t[1] or 0)
    got = sorted(((r["id"], r["value"]) for r in flatten_json_array(df, "j", keep=["id"]).collect()), key=key)
    # arrays give one row per element (an element that is not an int becomes NULL), an object one
    # row per field; empty, scalar, malformed, '' and NULL inputs give no rows
    assert got == [(1, 1), (1, 2), (3, 1), (3, 3), (3, None), (3, None), (4, 5)]


def test_list_membership_only_live_contacts(spark):
    df = spark.createDataFrame([
        (1, "a@x.com", "[10, 11]", "[12]", True, False),
        (2, "b@x.com", "[10]", None, True, True),      # deleted: no rows
        (3, "c@x.com", "[10]", "[]", False, False),    # invalid: no rows
    ], "contact_id long, email string, list_ids_raw string, list_unsubscribed_raw string, "
       "is_valid_record boolean, is_deleted boolean")
    got = sorted((r["contact_id"], r["list_id"], r["is_unsubscribed"]) for r in list_membership(df).collect())
    assert got == [(1, 10, False), (1, 11, False), (1, 12, True)]


def test_change_feed_update_is_delete_plus_insert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k long, v string")
    ch = change_feed(old, new, ["k"])
    got = sorted((r["k"], r["v"] or "", r["metadata_action"], r["metadata_is_update"]) for r in ch.collect())
    assert got == [(2, "B", "INSERT", True), (2, "b", "DELETE", True), (4, "d", "INSERT", False)]
    assert sorted(r["k"] for r in inserts_only(ch).collect()) == [2, 4]
    gone = change_feed(new, old, ["k"])
    assert sorted((r["k"], r["metadata_action"]) for r in gone.filter(~F.col("metadata_is_update")).collect()) == \
        [(4, "DELETE")]


def test_history_helpers(spark):
    import datetime as dt
    t1, t2, t3, end = (dt.datetime(2024, 3, d) for d in (1, 2, 3)), None, None, None
    a, b, c = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2), dt.datetime(2024, 3, 3)
    open_end = dt.datetime(9999, 12, 31)
    dim = spark.createDataFrame([
        (1, "x", a, b, False), (1, "y", b, c, False), (1, "z", c, open_end, True), (2, "p", a, open_end, True)],
        "k long, v string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, is_current boolean")
    assert sorted(r["k"] for r in H.multi_version_rows(dim, ["k"]).collect()) == [1, 1, 1]
    vc = H.version_counts(dim, ["k"]).collect()
    assert [(r["k"], r["total_versions"], r["current_versions"], r["historical_versions"]) for r in vc] == [(1, 3, 1, 2)]
    assert sorted(r["previous_v"] for r in H.current_vs_previous(dim, ["k"], ["v"]).collect()) == ["x", "y"]
    assert [r["previous_v"] for r in H.adjacent_versions(dim, ["k"], ["v"]).collect()] == ["y"]
    assert H.versions_opened_since(dim, ["k"], F.lit(b).cast("timestamp_ntz")).collect()[0]["num_versions"] == 2
