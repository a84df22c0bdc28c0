"""Feeds: the driver's tables re-shaped into the reference's source records (FIXTURES.md part C).

Each feed is a plain projection of one table (no filter, no sampling): its size grows with the
table. The same definitions are written in SQL in :mod:`stratum.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stratum import functions as X
from stratum.functions.temporal import ts_literal


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the files once per process, not by a job for every use."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _s(c) -> F.Column:
    return c.cast("string")


def contact_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact change records from ``events`` (one per event, three batches by time)."""
    e = table(spark, sf_dir, "events")
    eid, uid, et, ts = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("ts")
    return e.select(
        eid.alias("row_no"),
        uid.alias("contact_id"),
        F.when(eid % 7 == 0, F.lit("")).when(eid % 11 == 0, F.lit("bad-address"))
         .otherwise(F.concat(F.lit(" User"), _s(uid), F.lit("@Mail"), _s(eid % 5), F.lit(".COM ")))
         .alias("email"),
        F.concat(F.lit(" "), et, F.lit(" o'brien-"), _s(uid % 3), F.lit("x ")).alias("first_name"),
        F.when(eid % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("mc."), et, F.lit("  jr"))).alias("last_name"),
        et.alias("vehicle_make"),
        F.when(uid % 8 != 0, F.date_add(F.lit("1960-01-01").cast("date"), ((uid * 37) % 15000).cast("int")))
         .alias("date_of_birth"),
        (eid % 6 == 0).alias("is_email_blacklisted"),
        (F.col("value") > 25).alias("is_email_optin"),
        F.when(eid % 4 != 0, uid % 2 == 0).alias("is_sms_blacklisted"),
        ts.alias("created_at"),
        X.add_hours(ts, 1).alias("api_extracted_at"),
        ts.alias("modified_at"),
        ts.alias("audit_updated_at"),
        F.when(eid % 13 == 0, F.lit(None).cast("boolean"))
         .otherwise((et == "error") & (eid % 3 == 0)).alias("is_deleted"),
        F.when(eid % 10 == 0, F.lit("[1, 2")).when(eid % 10 == 1, F.lit(None).cast("string"))
         .when(eid % 10 == 2, F.lit("[]"))
         .otherwise(F.concat(F.lit("["), _s(eid % 50), F.lit(", "), _s(50 + uid % 50), F.lit("]")))
         .alias("list_ids_raw"),
        F.when(F.col("value") > 40, F.concat(F.lit("["), _s(100 + uid % 7), F.lit("]")))
         .alias("list_unsubscribed_raw"),
        F.when(ts < ts_literal("2024-01-11 00:00:00"), F.lit(1))
         .when(ts < ts_literal("2024-01-21 00:00:00"), F.lit(2)).otherwise(F.lit(3)).alias("batch_no"),
    )


def policy_event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy/payment events from ``orders`` (one per order)."""
    o = table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    start = F.to_date(F.col("o_orderdate"))
    return o.select(
        F.concat(F.lit("ord-"), _s(ok)).alias("event_uuid"),
        ck.alias("contact_id"),
        (ck + 100000).alias("customer_id"),
        F.concat(F.lit(" Cust"), _s(ck), F.lit("@Mail.COM ")).alias("email"),
        F.concat(F.lit(" anne-"), _s(ck % 3), F.lit("x ")).alias("first_name"),
        F.when(ck % 9 != 0, F.concat(F.lit("van der "), F.lower("o_orderpriority"))).alias("last_name"),
        (ok % 9).alias("event_filter_id"),
        (ok % 5).alias("payment_status_id"),
        F.concat(F.lit('{"contact":'), _s(ck), F.lit("}")).alias("contact_properties_raw"),
        F.concat(F.lit('{"priority":"'), F.col("o_orderpriority"), F.lit('"}')).alias("event_properties_raw"),
        X.add_hours("o_orderdate", 1).alias("api_extracted_at"),
        F.col("o_orderstatus").alias("event_name"),
        F.when(ok % 17 == 0, F.lit(None).cast("string")).when(ck % 3 == 0, F.lit("AUTO"))
         .when(ck % 3 == 1, F.lit("HOME")).otherwise(F.lit("LIFE")).alias("policy_code"),
        F.concat(F.lit("POL-"), _s(ck % 500)).alias("policy_number"),
        F.col("o_orderpriority").alias("coverage_code"),
        start.alias("policy_start_date"),
        F.date_add(start, 365).alias("policy_end_date"),
        F.round(F.col("o_totalprice"), 2).cast("decimal(10,2)").alias("premium_amount"),
        (ok % 30).alias("plan_id"),
        F.when(ok % 4 == 0, F.lit("Stripe")).when(ok % 4 == 1, F.lit("PayPal"))
         .when(ok % 4 == 2, F.lit("")).otherwise(F.lit(None).cast("string")).alias("payment_gateway"),
        F.col("o_orderdate").alias("event_date"),
        F.col("o_orderdate").alias("audit_updated_at"),
        ((F.col("o_orderstatus") == "P") & (ok % 19 == 0)).alias("is_deleted"),
    )


def insight_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ad-insight rows from ``lineitem`` (one per line)."""
    li = table(spark, sf_dir, "lineitem")
    ship = F.to_date(F.col("l_shipdate"))
    return li.select(
        F.col("l_partkey").alias("ad_id"),
        F.col("l_suppkey").alias("adset_id"),
        (F.col("l_partkey") % 25).alias("campaign_id"),
        (F.col("l_suppkey") % 5).alias("ad_account_id"),
        ship.alias("date_start"),
        F.when(F.col("l_linenumber") == 7, F.lit("1995-01-01").cast("date")).otherwise(ship).alias("date_stop"),
        F.floor(F.col("l_extendedprice")).cast("bigint").alias("impressions"),
        F.floor(F.col("l_extendedprice") * 0.7).cast("bigint").alias("reach"),
        F.col("l_quantity").cast("bigint").alias("clicks"),
        F.round(F.col("l_extendedprice"), 2).cast("decimal(18,2)").alias("spend"),
        F.concat(F.lit(" Ad "), _s(F.col("l_partkey")), F.lit(" ")).alias("ad_name"),
        F.concat(F.lit('{"link_click":'), _s(F.col("l_quantity").cast("bigint")), F.lit("}")).alias("actions"),
        F.col("l_shipdate").alias("audit_updated_at"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)).alias("is_deleted"),
        F.col("l_orderkey").alias("src_order"),
        F.col("l_linenumber").alias("src_line"),
    )


def daily_report_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily e-mail aggregate report from ``events`` (one row per day)."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return (e.groupBy(F.to_date("ts").alias("report_date"))
            .agg(F.count(F.lit(1)).alias("requests"), one(et != "error").alias("delivered"),
                 one(et.isin("view", "click")).alias("opens"), one(et == "view").alias("unique_opens"),
                 one((et == "click") | (F.col("value") > 45)).alias("clicks"), one(et == "click").alias("unique_clicks"),
                 one(et == "error").alias("hard_bounces"), one((et != "error") & (F.col("value") < 1)).alias("soft_bounces"),
                 one(F.col("value") > 49).alias("blocked"), one((et == "error") & (F.col("value") > 40)).alias("spam_reports"),
                 one((et == "view") & (F.col("value") < 2)).alias("unsubscribed"))
            .withColumn("api_extracted_at", X.add_hours(F.col("report_date").cast("timestamp_ntz"), 25))
            .withColumn("audit_updated_at", X.add_days(F.col("report_date").cast("timestamp_ntz"), 1))
            .withColumn("is_deleted", F.lit(False)))


# Ads entity snapshots: two extracts ("runs") of each entity table. Run 2 changes some
# attributes (tracked and untracked) and soft-deletes some rows, by rules on the row values.
def ad_account_feed(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    r = table(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    status = F.lit(1) if run == 1 else F.when(k == 2, F.lit(2)).otherwise(F.lit(1))
    tz = F.lit("UTC") if run == 1 else F.when(k == 3, F.lit("Europe/Paris")).otherwise(F.lit("UTC"))
    return r.select(
        k.cast("bigint").alias("account_id"), F.concat(F.lit("act_"), _s(k)).alias("account_id_text"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("account_name"),
        ((k + 1) * 100000).cast("bigint").alias("spend_cap"), (k * 1234 + run).cast("bigint").alias("amount_spent"),
        ((k + 1) * 100000 - k * 1234 - run).cast("bigint").alias("balance"),
        status.alias("account_status"), F.lit("USD").alias("currency"), tz.alias("timezone_name"),
        (k + 9000).cast("bigint").alias("business_id"), F.concat(F.lit("biz "), F.lower("r_name")).alias("business_name"),
        _audit(run), F.lit(False).alias("is_deleted"))


def campaign_feed(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    objective = F.lit("REACH") if run == 1 else F.when(F.col("n_regionkey") == 1, F.lit("CONVERSIONS")).otherwise(F.lit("REACH"))
    buying = F.lit("AUCTION") if run == 1 else F.when(k % 2 == 0, F.lit("RESERVED")).otherwise(F.lit("AUCTION"))
    return n.select(
        k.cast("bigint").alias("campaign_id"), F.col("n_name").alias("campaign_name"),
        F.lit("ACTIVE").alias("status"), F.lit("ACTIVE").alias("effective_status"), objective.alias("objective"),
        buying.alias("buying_type"), ((k + 1) * 1000).cast("bigint").alias("daily_budget"),
        F.lit(None).cast("bigint").alias("lifetime_budget"), (k % 3 == run).alias("budget_remaining"),
        F.when(k % 4 == 0, F.lit(" HOUSING ")).otherwise(F.lit("")).alias("special_ad_categories"),
        _day_text(k).alias("created_time"), F.when(k % 5 != 0, _day_text(k + 10)).otherwise(F.lit("soon")).alias("start_time"),
        F.when(k % 2 == 0, _day_text(k + 100)).alias("stop_time"), _day_text(k + run).alias("updated_time"),
        F.col("n_regionkey").cast("bigint").alias("ad_account_id"), _audit(run), F.lit(False).alias("is_deleted"))


def adset_feed(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k, bal = F.col("s_suppkey"), F.col("s_acctbal")
    budget = F.floor(bal).cast("bigint") if run == 1 else \
        F.when(bal < 0, F.lit(0).cast("bigint")).otherwise(F.floor(bal).cast("bigint"))
    deleted = F.lit(False) if run == 1 else (bal > 9900)
    return s.select(
        k.alias("adset_id"), F.col("s_name").alias("adset_name"), (k % 25).alias("campaign_id"),
        F.lit("ACTIVE").alias("status"), F.lit("ACTIVE").alias("effective_status"),
        F.lit("LOWEST_COST").alias("bid_strategy"), F.lit("LINK_CLICKS").alias("optimization_goal"),
        budget.alias("daily_budget"), F.lit(None).cast("bigint").alias("lifetime_budget"),
        (k % 50 * 10).alias("bid_amount"), F.lit(" IMPRESSIONS ").alias("billing_event"),
        F.when(k % 2 == 0, F.lit("WEBSITE ")).alias("destination_type"), _day_text(k % 300).alias("start_time"),
        F.when(k % 3 != 0, _day_text(k % 300 + 30)).otherwise(F.lit("never")).alias("end_time"),
        _day_text(k % 300 + run).alias("updated_time"),
        F.concat(F.lit('{"nation":'), _s(F.col("s_nationkey")), F.lit("}")).alias("targeting_raw"),
        F.when(k % 7 == 0, F.concat(F.lit('{"page":'), _s(k), F.lit("}"))).alias("promoted_object_raw"),
        (F.col("s_nationkey") % 5).cast("bigint").alias("ad_account_id"), _audit(run), deleted.alias("is_deleted"))


def ad_feed(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    status = F.lit("ACTIVE") if run == 1 else F.when(F.col("p_size") > 45, F.lit("PAUSED")).otherwise(F.lit("ACTIVE"))
    cta = F.lit("LEARN_MORE") if run == 1 else F.when(F.col("p_size") < 5, F.lit("SHOP_NOW")).otherwise(F.lit("LEARN_MORE"))
    return p.select(
        k.alias("ad_id"), F.col("p_name").alias("ad_name"), (k % 1000).alias("adset_id"), (k % 25).alias("campaign_id"),
        status.alias("status"), status.alias("effective_status"), (k + 500000).alias("creative_id"),
        F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")).alias("creative_name"), F.col("p_brand").alias("creative_title"),
        F.concat(F.lit(" Buy "), F.col("p_name"), F.lit(" ")).alias("creative_body"),
        F.concat(F.lit("https://img.example/"), _s(k), F.lit(".png ")).alias("creative_image_url"),
        cta.alias("creative_cta_type"), _day_text(k % 200).alias("created_time"),
        F.when(k % 6 != 0, _day_text(k % 200 + run)).otherwise(F.lit("")).alias("updated_time"),
        F.lit(None).cast("bigint").alias("ad_account_id"), _audit(run),
        F.lit(False).alias("is_deleted"))


# Fixed extraction times of the two entity runs.
ENTITY_AUDIT_TS = {1: "2024-02-15 00:00:00", 2: "2024-02-20 00:00:00"}


def _day_text(n: F.Column) -> F.Column:
    """Noon of the n-th day of 2023, as the text an extract holds (F3 parses it)."""
    day = F.date_add(F.lit("2023-01-01").cast("date"), n.cast("int"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 12:00:00"))


def _audit(run: int) -> F.Column:
    return ts_literal(ENTITY_AUDIT_TS[run]).alias("audit_updated_at")


# More source records: each is one aggregation or projection over a whole driver table.
LOAD_AUDIT_TS = "2024-02-15 00:00:00"


def contact_list_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mailing lists = nations; subscribers = their customers."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    per_list = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("total_subscribers"),
        F.count_distinct("c_mktsegment").alias("unique_subscribers"),
        F.sum(F.when(F.col("c_acctbal") < 0, 1).otherwise(0)).cast("bigint").alias("total_blacklisted"))
    return n.join(per_list, "n_nationkey", "left").select(
        F.col("n_nationkey").cast("bigint").alias("list_id"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" list ")).alias("name"),
        F.col("n_regionkey").cast("bigint").alias("folder_id"), "total_subscribers", "unique_subscribers",
        "total_blacklisted", X.add_minutes(ts_literal(LOAD_AUDIT_TS), 5).alias("api_extracted_at"),
        ts_literal(LOAD_AUDIT_TS).alias("audit_updated_at"), F.lit(False).alias("is_deleted"))


def smtp_email_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transactional e-mail per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("em-"), _s(F.col("o_orderkey"))).alias("email_uuid"),
        F.concat(F.lit("msg-"), _s(F.col("o_orderkey"))).alias("message_id"),
        F.col("o_orderdate").alias("email_date"),
        F.concat(F.lit(" Customer"), _s(F.col("o_custkey")), F.lit("@Mail.COM")).alias("smtp_email"),
        F.concat(F.lit("Event"), _s(F.col("o_custkey") % 100), F.lit("@Mail.COM ")).alias("smtp_event_email"),
        F.lit("NoReply@Shop.COM").alias("from_email"),
        F.col("o_orderpriority").alias("subject"), F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(",order ")).alias("tags"),
        F.col("o_orderdate").alias("audit_updated_at"), F.lit(False).alias("is_deleted"))


def smtp_event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery event per order line (several lines can report the same event)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("msg-"), _s(F.col("l_orderkey"))).alias("message_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("opened")).otherwise(F.lit("delivered")).alias("event"),
        F.col("l_shipdate").alias("event_date"),
        F.concat(F.lit(" Part"), _s(F.col("l_partkey")), F.lit("@Mail.COM")).alias("email"),
        F.lit("NoReply@Shop.COM ").alias("from_email"),
        F.concat(F.lit(" Line "), _s(F.col("l_linenumber"))).alias("subject"),
        F.when(F.col("l_returnflag") == "R", F.lit("bounced")).otherwise(F.lit("")).alias("reason"),
        (F.col("l_suppkey") % 12).alias("template_id"), X.add_hours("l_shipdate", 1).alias("api_extracted_at"),
        F.col("l_shipdate").alias("audit_updated_at"), F.col("l_linenumber").alias("line_no"),
        F.lit(False).alias("is_deleted"))


def custom_audience_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        (F.col("s_suppkey") + 700000).alias("audience_id"), F.concat(F.col("s_name"), F.lit(" lookalike ")).alias("name"),
        F.lit("LOOKALIKE").alias("subtype"), F.floor(F.col("s_acctbal")).cast("bigint").alias("approx_count_lower"),
        F.ceil(F.col("s_acctbal") * 2).cast("bigint").alias("approx_count_upper"),
        (F.col("s_nationkey") + 30).alias("retention_days"), F.lit("").alias("lookalike_spec"),
        F.concat(F.lit(" from "), F.col("s_name")).alias("description"),
        F.when(F.col("s_acctbal") < 0, F.lit(300)).otherwise(F.lit(200)).alias("delivery_status_code"),
        F.when(F.col("s_acctbal") < 0, F.lit("too small ")).otherwise(F.lit("ready ")).alias("delivery_status_desc"),
        F.lit("EVENT_BASED").alias("data_source_type"), F.lit(" WEB").alias("data_source_sub_type"),
        (F.col("s_nationkey") % 5).cast("bigint").alias("ad_account_id"),
        ts_literal(LOAD_AUDIT_TS).alias("audit_updated_at"), F.lit(False).alias("is_deleted"))


def insight_level_feed(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """Account / campaign / adset insights: the ad-level rows summed per entity and day range."""
    i = insight_feed(spark, sf_dir)
    return (i.groupBy(level, "date_start", "date_stop")
            .agg(F.sum("impressions").alias("impressions"), F.sum("reach").alias("reach"),
                 F.sum("clicks").alias("clicks"), F.sum("spend").cast("decimal(18,2)").alias("spend"),
                 F.max("audit_updated_at").alias("audit_updated_at"))
            .withColumn("actions", F.concat(F.lit('{"link_click":'), _s(F.col("clicks")), F.lit("}")))
            .withColumn("action_values", F.concat(F.lit('{"purchase":'), _s(F.col("spend")), F.lit("}")))
            .withColumn("level_name", F.concat(F.lit(" "), F.lit(level), F.lit("-"), _s(F.col(level)), F.lit(" ")))
            .withColumn("is_deleted", F.lit(False)))


# Two deliveries of the tables that have no extracts of their own: every record arrives in both. By a number n of the
# record, the first holds it as deleted (n % 10 = 9: it is not inserted), the second brings changed values with a newer
# audit time (n % 3 = 0; some of them twice with one audit time), an older audit time (n % 12 = 0: late data),
# a deletion (n % 15 = 0) or nothing new.
# name: (n, changed columns, columns of the twin record)
DELIVERIES = {
    "slv_contact_list": ("list_id", {"total_subscribers": "total_subscribers + 1"},
                         {"total_subscribers": "total_subscribers + 2"}),
    "slv_event": ("cast(substr(event_uuid, 5) AS bigint)",
                  {"coverage_code": "'CHANGED'", "payment_gateway": "'Klarna'", "event_filter_id": "99L",
                   "policy_end_date": "date_add(policy_end_date, 30)"},
                  {"coverage_code": "'CHANGED'", "payment_gateway": "'Klarna'", "event_filter_id": "99L",
                   "policy_end_date": "date_add(policy_end_date, 30)",
                   "premium_amount": "cast(premium_amount + 1 AS decimal(10,2))"}),
    "slv_agg_report": ("cast(day(report_date) AS bigint)", {"spam_reports": "spam_reports + 100"},
                       {"spam_reports": "spam_reports + 101"}),
    "slv_smtp_email": ("cast(substr(email_uuid, 4) AS bigint)", {"subject": "'resent'"}, {"subject": "'sent again'"}),
    "slv_smtp_event": ("cast(substr(message_id, 5) AS bigint)", {"subject": "'resent'"}, {"subject": "'sent again'"}),
    "slv_custom_audience": ("audience_id", {"retention_days": "retention_days + 1"}, {"retention_days": "retention_days + 2"}),
    "slv_insight_account": ("dayofyear(date_start) + ad_account_id", {"reach": "reach + 7"}, {"reach": "reach + 8"}),
    "slv_insight_campaign": ("dayofyear(date_start) + campaign_id", {"reach": "reach + 7"}, {"reach": "reach + 8"}),
    "slv_insight_adset": ("dayofyear(date_start) + adset_id", {"reach": "reach + 7"}, {"reach": "reach + 8"}),
    "slv_insight_ad": ("src_order", {"reach": "reach + 7"}, {"reach": "reach + 8"}),
}


def delivered(feed: DataFrame, name: str, run: int) -> DataFrame:
    """The ``run``-th delivery (1 or 2) of ``feed`` for the table ``name``."""
    number, changed, twin = DELIVERIES[name]
    n = F.expr(number)
    if run == 1:
        return feed.withColumn("is_deleted", F.col("is_deleted") | (n % 10 == 9))
    audit = (F.when(n % 12 == 0, X.add_days("audit_updated_at", -1)).when(n % 3 == 0, X.add_days("audit_updated_at", 30))
             .otherwise(F.col("audit_updated_at")))
    again = {"audit_updated_at": audit, "is_deleted": F.col("is_deleted") | (n % 15 == 0)}
    with_new = lambda values: {c: F.when(n % 3 == 0, F.expr(e)).otherwise(F.col(c)) for c, e in values.items()}
    twins = feed.filter(n % 21 == 0)          # in addition to the records themselves
    return feed.withColumns(again | with_new(changed)).unionByName(twins.withColumns(again | with_new(twin)))
