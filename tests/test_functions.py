from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratum import functions as X


def one(spark, values, fn, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_proper_case_dialect_delimiters(spark):
    got = one(spark, ["mc.donald", "al-suwaidi", "o'brien", "", None, "double  space", "ÉCOLE x_y"],
              X.proper_case)
    assert got == ["Mc.Donald", "Al-Suwaidi", "O'brien", "", None, "Double  Space", "École X_Y"]


def test_valid_email(spark):
    got = one(spark, ["a@b.co", "a@b.c", "@b.co", " ", None, "x y@mail.com"], X.valid_email)
    assert got == [True, False, False, False, False, True]


def test_clean_trim_case(spark):
    assert one(spark, ["  MiXed  "], X.clean_lower) == ["mixed"]
    assert one(spark, ["  MiXed  "], X.clean_upper) == ["MIXED"]


def test_rate_pct_zero_null_negative_and_overflow(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (5, None), (1, -4), (20000, 1), (1, 8)], "n long, d long")
    got = [r[0] for r in df.select(X.rate_pct("n", "d")).collect()]
    assert got == [Decimal("33.33"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("2000000.00"), Decimal("12.50")]


def test_safe_ratio_nullif(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(X.safe_ratio(F.col("n").cast("decimal(20,0)"), "d", 100, 2)).collect()]
    assert got[:2] == [None, None] and got[2] == Decimal("66.67")


def test_exact_ratio_half_up(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(X.exact_ratio(F.col("n") * 100, "d", 1)).collect()]
    assert got == [Decimal("12.5"), Decimal("-12.5"), None]


def test_ad_metrics_floor_denominators(spark):
    df = spark.createDataFrame([(Decimal("10.00"), 0, 0, 0), (Decimal("12.34"), 4, 1000, 700)],
                               "spend decimal(18,2), clicks long, impressions long, reach long")
    m = X.ad_metrics("spend", "clicks", "impressions", "reach")
    r = df.select(*[m[k].alias(k) for k in ("cpc", "cpm", "ctr", "frequency")]).collect()
    assert tuple(r[0]) == (Decimal("10.00"), Decimal("10000.00"), Decimal("0.0000"), Decimal("0.00"))
    assert tuple(r[1]) == (Decimal("3.09"), Decimal("12.34"), Decimal("0.4000"), Decimal("1.43"))


def test_hash_key_null_handling(spark):
    df = spark.createDataFrame([("A", None), (None, None)], "a string, b string")
    r = df.select(X.hash_key("a", "b").alias("k"), X.hash_key("a", "b", null_as_empty=False).alias("s")).collect()
    import hashlib
    assert r[0]["k"] == hashlib.md5(b"A|").hexdigest() and r[0]["s"] is None
    assert r[1]["k"] == hashlib.md5(b"|").hexdigest()


def test_row_hash_none_text(spark):
    import hashlib
    df = spark.createDataFrame([("x", None)], "a string, b long")
    r = df.select(X.row_hash("a", "b").alias("h"), X.row_hash32("a", "b").alias("h32")).first()
    assert r["h"] == hashlib.sha256(b"x|None").hexdigest() and r["h32"] == r["h"][:32]


def test_date_parts_and_weekend(spark):
    df = spark.createDataFrame([("2024-01-07",), ("2024-01-08",)], "d string").select(F.to_date("d").alias("d"))
    parts = X.date_parts("d")
    r = df.select(*[v.alias(k) for k, v in parts.items()]).collect()
    assert (r[0]["month_name"], r[0]["day_name"], r[0]["is_weekend"]) == ("Jan", "Sun", True)
    assert (r[1]["day_name"], r[1]["is_weekend"], r[1]["quarter"]) == ("Mon", False, 1)


def test_ts_text_three_fraction_digits(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:05.12",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.select(X.ts_text("t")).first()[0] == "2024-01-01 10:00:05.120"


def test_try_parse_ts(spark):
    assert one(spark, ["2024-01-01 00:00:00", "nope", None], X.try_parse_ts)[1:] == [None, None]


def test_null_default_differs(spark):
    df = spark.createDataFrame([(None, ""), ("a", None), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(X.null_default_differs(F.col("a"), F.col("b"), "")).collect()]
    assert got == [False, True, False]


@pytest.mark.parametrize("start,stop,expected", [
    ("2024-01-01", "2024-01-02", True), ("2024-01-03", "2024-01-02", False), (None, "2024-01-02", False),
    ("2030-01-01", "2030-01-02", False)])
def test_valid_date_range(spark, start, stop, expected):
    df = spark.createDataFrame([(start, stop)], "a string, b string").select(
        F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert df.select(X.valid_date_range("a", "b", F.lit("2025-01-01").cast("date"))).first()[0] is expected


def test_valid_metrics_null_counts_fall_through(spark):
    df = spark.createDataFrame([("p", None, None), ("", 1, 1), ("p", 5, 6), ("p", -1, 0), ("p", 5, 5)],
                               "p string, r long, d long")
    assert [r[0] for r in df.select(X.valid_metrics("p", "r", "d")).collect()] == [True, False, False, False, True]
