"""Silver (SCD-1) and Gold (SCD-2) table specs: each table is configuration, not code."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from stratum import functions as X
from stratum.operators.dedup import dedup_latest
from stratum.operators.merge import insert_into_empty, scd1_merge, split_null_keys
from stratum.operators.scd2 import Scd2Spec


@dataclass(frozen=True)
class SilverSpec:
    name: str
    keys: Sequence[str]
    clean: Callable[[DataFrame, Column], DataFrame]   # raw feed, run_ts -> typed, cleaned rows
    columns: Sequence[str]                            # target columns (without load timestamps)
    order_by: Sequence[str] = ("audit_updated_at",)   # DESC NULLS LAST
    tie_break: Sequence[str] = ()                     # DESC; makes the survivor reproducible
    no_update: Sequence[str] = ("audit_inserted_at",)  # inserted but never overwritten
    loaded_col: str = "silver_loaded_at"
    updated_col: str = "silver_updated_at"
    # A batch holds few rows of a key: they are dealt to their keys' partitions and sorted there. Otherwise a map task first cuts
    # its rows to one of each key, for which it sorts all it has read.
    few_per_key: bool = True
    keys_as_is: bool = True                           # ``clean`` hands the key columns on as they are
    raw_keys: Callable[[], Sequence[Column]] | None = None    # the keys over the raw columns, where ``clean`` derives them
    bucketed: bool = False                            # stored bucketed by the keys: large tables that each run meets as a whole

    @property
    def update_cols(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys and c not in self.no_update]

    def prepare(self, raw: DataFrame, run_ts: Column, keyed: bool = False, partitions: int | None = None) -> DataFrame:
        """clean -> latest row per key -> target columns. ``keyed``, for a whole run: without the rows whose key has a NULL part,
        which no merge takes in, and dealt to their keys' partitions (``partitions``: so many) before anything is sorted
        (``few_per_key``)."""
        deal = keyed and self.few_per_key
        n = (partitions,) if partitions else ()
        if deal and self.raw_keys:        # before the columns are derived: those are not shuffled
            raw = raw.repartition(*n, *self.raw_keys())
        elif deal and self.keys_as_is:
            raw = split_null_keys(raw, self.keys)[0].repartition(*n, *self.keys)
        cleaned = self.clean(raw, run_ts)
        if keyed:
            cleaned = split_null_keys(cleaned, self.keys)[0]
        if deal and not self.keys_as_is and not self.raw_keys:
            cleaned = cleaned.repartition(*n, *self.keys)
        latest = dedup_latest(cleaned, self.keys, self.order_by,
                              # total: rows that still tie are equal in every target column
                              [F.col(c).desc_nulls_last() for c in (*self.tie_break, *self.columns)])
        return latest.select(*self.columns)

    def quarantine(self, raw: DataFrame, run_ts: Column) -> DataFrame:
        """Cleaned rows whose key has a NULL part: the reference's MERGE would fail the whole statement
        on them; here they are kept aside (the merge skips them) so nothing is lost silently."""
        return split_null_keys(self.clean(raw, run_ts), self.keys)[1]

    def empty_target(self, spark, source_schema: StructType) -> DataFrame:
        fields = [StructField(c, source_schema[c].dataType) for c in self.columns]
        fields += [StructField(self.loaded_col, TimestampNTZType()), StructField(self.updated_col, TimestampNTZType())]
        return spark.createDataFrame([], StructType(fields))

    def merge(self, target: DataFrame | None, raw: DataFrame, run_ts: Column) -> DataFrame:
        return self.merge_prepared(target, self.prepare(raw, run_ts), run_ts)

    def merge_prepared(self, target: DataFrame | None, src: DataFrame, run_ts: Column, only_source: bool = False) -> DataFrame:
        if target is None:  # first load: only the insert clause can fire
            return insert_into_empty(src, self.keys, columns=self.columns, run_ts=run_ts,
                                     loaded_col=self.loaded_col, updated_col=self.updated_col)
        return scd1_merge(target, src, self.keys, update_cols=self.update_cols, insert_cols=self.columns,
                          run_ts=run_ts, loaded_col=self.loaded_col, updated_col=self.updated_col, only_source=only_source)

    def changed_by(self, run_ts: Column) -> Column:
        """Rows that the run at ``run_ts`` inserted or updated."""
        return F.coalesce(F.col(self.loaded_col) == run_ts, F.lit(False)) | \
            F.coalesce(F.col(self.updated_col) == run_ts, F.lit(False))


def _batch(n) -> Column:
    return F.concat(F.lit("batch-"), F.lit(n).cast("string") if isinstance(n, int) else n.cast("string"))


# ---------------------------------------------------------------- e-mail / policy events source

def _clean_contact(raw: DataFrame, run_ts: Column) -> DataFrame:
    return raw.select(
        "contact_id", X.clean_lower("email").alias("email"),
        X.proper_case(F.trim("first_name")).alias("first_name"),
        X.proper_case(F.trim("last_name")).alias("last_name"),
        "date_of_birth", X.clean_trim("vehicle_make").alias("vehicle_make"), "is_email_blacklisted", "is_email_optin",
        "is_sms_blacklisted", "created_at", "modified_at", "api_extracted_at",
        X.clean_trim("list_ids_raw").alias("list_ids_raw"),
        X.clean_trim("list_unsubscribed_raw").alias("list_unsubscribed_raw"),
        X.valid_email("email").alias("is_valid_email"),
        X.valid_required("contact_id").alias("is_valid_record"),
        F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted",
        _batch(F.col("batch_no")).alias("batch_id"), "row_no")


SLV_CONTACT = SilverSpec(
    name="slv_contact", keys=("contact_id",), clean=_clean_contact,
    columns=("contact_id", "email", "first_name", "last_name", "date_of_birth", "vehicle_make", "is_email_blacklisted",
             "is_email_optin", "is_sms_blacklisted", "created_at", "modified_at", "list_ids_raw",
             "list_unsubscribed_raw", "is_valid_email", "is_valid_record", "api_extracted_at", "audit_inserted_at",
             "audit_updated_at", "is_deleted", "batch_id"),
    no_update=("created_at", "audit_inserted_at"),
    order_by=("modified_at", "audit_updated_at"), tie_break=("row_no",), few_per_key=False)


def _clean_event(raw: DataFrame, run_ts: Column) -> DataFrame:
    return raw.select(
        "event_uuid", "contact_id", "customer_id", X.clean_lower("email").alias("email"),
        X.proper_case(F.trim("first_name")).alias("first_name"), X.proper_case(F.trim("last_name")).alias("last_name"),
        X.clean_trim("event_name").alias("event_name"), "event_date", "event_filter_id", "payment_status_id",
        "contact_properties_raw", "event_properties_raw", "api_extracted_at",
        X.clean_trim("policy_code").alias("policy_code"), X.clean_trim("policy_number").alias("policy_number"),
        X.clean_trim("coverage_code").alias("coverage_code"), "policy_start_date", "policy_end_date",
        "premium_amount", "plan_id", X.clean_trim("payment_gateway").alias("payment_gateway"),
        X.valid_required_nonblank(nonblank=("event_uuid", "event_name")).alias("is_valid_record"),
        X.valid_event_time("event_date", run_ts).alias("is_valid_event_date"),
        F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted",
        _batch(1).alias("batch_id"))


SLV_EVENT = SilverSpec(
    name="slv_event", keys=("event_uuid",), clean=_clean_event,
    columns=("event_uuid", "contact_id", "customer_id", "email", "first_name", "last_name", "event_name", "event_date",
             "event_filter_id", "policy_code", "policy_number", "coverage_code", "policy_start_date", "policy_end_date",
             "premium_amount", "plan_id", "payment_status_id", "payment_gateway", "contact_properties_raw",
             "event_properties_raw", "is_valid_record", "is_valid_event_date", "api_extracted_at", "audit_inserted_at",
             "audit_updated_at", "is_deleted", "batch_id"),
    no_update=("event_filter_id", "audit_inserted_at"), bucketed=True)


def _clean_agg_report(raw: DataFrame, run_ts: Column) -> DataFrame:
    period = F.concat(F.col("report_date").cast("string"), F.lit("|"), F.col("report_date").cast("string"))
    return raw.select(
        period.alias("date_range"), "requests", "delivered", "opens", "unique_opens", "clicks", "unique_clicks",
        "hard_bounces", "soft_bounces", "blocked", "spam_reports", "unsubscribed", "api_extracted_at",
        X.rate_pct("unique_opens", "delivered").alias("open_rate_pct"),
        X.rate_pct("unique_clicks", "delivered").alias("click_rate_pct"),
        X.rate_pct("delivered", "requests").alias("delivery_rate_pct"),
        X.rate_pct(F.col("hard_bounces") + F.col("soft_bounces"), "requests").alias("bounce_rate_pct"),
        X.valid_metrics(period, "requests", "delivered").alias("is_valid_record"),
        F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted", _batch(1).alias("batch_id"))


SLV_AGG_REPORT = SilverSpec(
    name="slv_agg_report", keys=("date_range",), clean=_clean_agg_report,
    columns=("date_range", "requests", "delivered", "opens", "unique_opens", "clicks", "unique_clicks", "hard_bounces",
             "soft_bounces", "blocked", "spam_reports", "unsubscribed", "open_rate_pct", "click_rate_pct",
             "delivery_rate_pct", "bounce_rate_pct", "is_valid_record", "api_extracted_at", "audit_inserted_at", "audit_updated_at", "is_deleted", "batch_id"), keys_as_is=False)

def _clean_contact_list(raw: DataFrame, run_ts: Column) -> DataFrame:
    return raw.select(
        "list_id", X.clean_trim("name").alias("list_name"), "folder_id", "total_subscribers", "unique_subscribers",
        "total_blacklisted", "api_extracted_at",
        X.valid_required_nonblank(not_null=("list_id",), nonblank=("name",)).alias("is_valid_record"),
        F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted")


SLV_CONTACT_LIST = SilverSpec(
    name="slv_contact_list", keys=("list_id",), clean=_clean_contact_list,
    columns=("list_id", "list_name", "folder_id", "total_subscribers", "unique_subscribers", "total_blacklisted",
             "is_valid_record", "api_extracted_at", "audit_inserted_at", "audit_updated_at", "is_deleted"))


def _clean_smtp_email(raw: DataFrame, run_ts: Column) -> DataFrame:
    return raw.select(
        "email_uuid", X.clean_trim("message_id").alias("message_id"), X.clean_lower("smtp_email").alias("recipient_email"),
        X.clean_lower("smtp_event_email").alias("event_email"), X.clean_lower("from_email").alias("from_email"),
        X.clean_trim("subject").alias("subject"), F.col("email_date").alias("sent_at"), X.clean_trim("tags").alias("tags"),
        X.valid_required_nonblank(nonblank=("email_uuid", "smtp_email")).alias("is_valid_record"),
        F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted", _batch(1).alias("batch_id"))


SLV_SMTP_EMAIL = SilverSpec(
    name="slv_smtp_email", keys=("email_uuid",), clean=_clean_smtp_email,
    columns=("email_uuid", "message_id", "recipient_email", "event_email", "from_email", "subject", "sent_at", "tags",
             "is_valid_record", "audit_inserted_at", "audit_updated_at", "is_deleted", "batch_id"), bucketed=True)


def _smtp_event_id() -> Column:
    return X.hash_key("message_id", "event", "event_date")


def _clean_smtp_event(raw: DataFrame, run_ts: Column) -> DataFrame:
    return raw.select(
        _smtp_event_id().alias("smtp_event_id"),   # key over the *raw* values
        "message_id", X.clean_upper("event").alias("event_type"), "event_date",
        X.clean_lower("email").alias("recipient_email"), X.clean_lower("from_email").alias("from_email"),
        X.clean_trim("subject").alias("subject"), X.clean_trim("reason").alias("failure_reason"), "template_id",
        "api_extracted_at", _batch(1).alias("batch_id"),
        X.valid_required_nonblank(nonblank=("message_id", "event")).alias("is_valid_record"),
        X.valid_event_time("event_date", run_ts).alias("is_valid_event_date"),
        F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted", "line_no")


SLV_SMTP_EVENT = SilverSpec(
    name="slv_smtp_event", keys=("smtp_event_id",), clean=_clean_smtp_event,
    columns=("smtp_event_id", "message_id", "event_type", "event_date", "recipient_email", "from_email", "subject",
             "failure_reason", "template_id", "is_valid_record", "is_valid_event_date", "api_extracted_at",
             "audit_inserted_at", "audit_updated_at", "is_deleted", "batch_id"),
    tie_break=("line_no", "failure_reason", "recipient_email", "template_id"), keys_as_is=False,
    raw_keys=lambda: [_smtp_event_id()], bucketed=True)


# ---------------------------------------------------------------- ads source


def _clean_insight_ad(raw: DataFrame, run_ts: Column) -> DataFrame:
    m = X.ad_metrics("spend", "clicks", "impressions")
    return raw.select(
        "ad_id", "adset_id", "campaign_id", "ad_account_id", "date_start", "date_stop", "impressions", "reach",
        "clicks", "spend", m["cpc"].alias("cpc"), m["cpm"].alias("cpm"), m["ctr"].alias("ctr"),
        X.clean_trim("ad_name").alias("ad_name"), F.col("actions").alias("actions_raw"),
        X.valid_required("ad_id", "date_start").alias("is_valid_record"),
        X.valid_date_range("date_start", "date_stop", F.to_date(run_ts)).alias("is_valid_date_range"),
        F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted",
        _batch(1).alias("batch_id"), "src_order", "src_line")


SLV_INSIGHT_AD = SilverSpec(
    name="slv_insight_ad", keys=("ad_id", "date_start", "date_stop"), clean=_clean_insight_ad,
    columns=("ad_id", "ad_name", "adset_id", "campaign_id", "ad_account_id", "date_start", "date_stop", "impressions",
             "reach", "clicks", "spend", "cpc", "cpm", "ctr", "actions_raw", "is_valid_record",
             "is_valid_date_range", "audit_inserted_at", "audit_updated_at", "is_deleted", "batch_id"),
    tie_break=("src_order", "src_line", "spend", "clicks", "adset_id"), bucketed=True)


def _entity_clean(key: str, text_cols: Sequence[str], other: Sequence[str], times: Sequence[str],
                  renamed: dict[str, str]):
    def clean(raw: DataFrame, run_ts: Column) -> DataFrame:
        return raw.select(
            key, *[X.clean_trim(renamed.get(c, c)).alias(c) for c in text_cols],
            *[F.col(renamed.get(c, c)).alias(c) for c in other], *[X.try_parse_ts(c).alias(c) for c in times],
            X.valid_required(key).alias("is_valid_record"),
            F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted",
            _batch(1).alias("batch_id"))
    return clean


def _entity_spec(name: str, key: str, text_cols: Sequence[str], other: Sequence[str], times: Sequence[str] = (),
                 renamed: dict[str, str] | None = None) -> SilverSpec:
    """``renamed``: target column -> source column, where they differ. ``times``: texts that F3 parses."""
    return SilverSpec(name=name, keys=(key,), clean=_entity_clean(key, text_cols, other, times, renamed or {}),
                      columns=(key, *text_cols, *other, *times, "is_valid_record", "audit_inserted_at",
                               "audit_updated_at", "is_deleted", "batch_id"))


SLV_AD_ACCOUNT = _entity_spec("slv_ad_account", "account_id", ("account_name", "currency", "timezone_name", "business_name"),
                              ("account_id_text", "account_status", "spend_cap", "amount_spent", "balance", "business_id"))
SLV_CAMPAIGN = _entity_spec("slv_campaign", "campaign_id", ("campaign_name", "status", "effective_status", "objective",
                                                            "buying_type", "special_ad_categories"),
                            ("daily_budget", "lifetime_budget", "budget_remaining", "ad_account_id"),
                            times=("created_time", "start_time", "stop_time", "updated_time"))
SLV_ADSET = _entity_spec("slv_adset", "adset_id", ("adset_name", "status", "effective_status", "bid_strategy",
                                                   "billing_event", "optimization_goal", "destination_type"),
                         ("campaign_id", "bid_amount", "daily_budget", "lifetime_budget", "targeting_raw",
                          "promoted_object_raw", "ad_account_id"),
                         times=("start_time", "end_time", "updated_time"))
SLV_AD = _entity_spec("slv_ad", "ad_id", ("ad_name", "status", "effective_status", "creative_name", "creative_title",
                                          "creative_body", "creative_image_url", "creative_cta_type"),
                      ("adset_id", "campaign_id", "creative_id", "ad_account_id"),
                      times=("created_time", "updated_time"))

SLV_CUSTOM_AUDIENCE = _entity_spec("slv_custom_audience", "audience_id",
                                   ("audience_name", "description", "subtype", "delivery_status_desc", "data_source_type",
                                    "data_source_sub_type"),
                                   ("approx_count_lower", "approx_count_upper", "retention_days", "delivery_status_code",
                                    "lookalike_spec_raw", "ad_account_id"),
                                   renamed={"audience_name": "name", "lookalike_spec_raw": "lookalike_spec"})


def _clean_insight_level(level: str, with_frequency: bool):
    def clean(raw: DataFrame, run_ts: Column) -> DataFrame:
        m = X.ad_metrics("spend", "clicks", "impressions", "reach" if with_frequency else None)
        key = F.col(level)
        extra = {
            "ad_account_id": [m["frequency"].alias("frequency") if with_frequency else None,
                              F.col("action_values").alias("action_values_raw")],
            "campaign_id": [X.clean_trim("level_name").alias("campaign_name"), (key % 5).alias("ad_account_id")],
            "adset_id": [X.clean_trim("level_name").alias("adset_name"), (key % 25).alias("campaign_id"),
                         (key % 5).alias("ad_account_id")]}[level]
        return raw.select(
            level, "date_start", "date_stop", "impressions", "reach", "clicks", "spend",
            m["cpc"].alias("cpc"), m["cpm"].alias("cpm"), m["ctr"].alias("ctr"), *extra,
            F.col("actions").alias("actions_raw"), _batch(1).alias("batch_id"),
            X.valid_required(level, "date_start").alias("is_valid_record"),
            X.valid_date_range("date_start", "date_stop", F.to_date(run_ts)).alias("is_valid_date_range"),
            F.col("audit_updated_at").alias("audit_inserted_at"), "audit_updated_at", "is_deleted")
    return clean


def _insight_level_spec(level: str, with_frequency: bool = False) -> SilverSpec:
    name = {"ad_account_id": "slv_insight_account", "campaign_id": "slv_insight_campaign",
            "adset_id": "slv_insight_adset"}[level]
    metrics = ("cpc", "cpm", "ctr", "actions_raw") + {
        "ad_account_id": ("frequency", "action_values_raw"), "campaign_id": ("campaign_name", "ad_account_id"),
        "adset_id": ("adset_name", "campaign_id", "ad_account_id")}[level]
    return SilverSpec(name=name, keys=(level, "date_start", "date_stop"),
                      clean=_clean_insight_level(level, with_frequency),
                      columns=(level, "date_start", "date_stop", "impressions", "reach", "clicks", "spend", *metrics,
                               "is_valid_record", "is_valid_date_range", "audit_inserted_at", "audit_updated_at",
                               "is_deleted", "batch_id"))


SLV_INSIGHT_ACCOUNT = _insight_level_spec("ad_account_id", with_frequency=True)
SLV_INSIGHT_CAMPAIGN = _insight_level_spec("campaign_id")
SLV_INSIGHT_ADSET = _insight_level_spec("adset_id")

# ---------------------------------------------------------------- Gold SCD-2 dimensions

DIM_CONTACT = Scd2Spec(sk_col="dim_contact_sk", keys=("contact_id",),
                       tracked={"email": "", "first_name": "", "last_name": "", "vehicle_make": "",
                                "is_email_blacklisted": False, "is_email_optin": False},
                       carried=("full_name", "date_of_birth", "is_sms_blacklisted", "contact_created_at"))
DIM_POLICY = Scd2Spec(sk_col="dim_policy_sk", keys=("policy_id",),
                      tracked={"coverage_code": "", "policy_end_date": None},
                      carried=("policy_code", "policy_number", "policy_start_date", "policy_duration_days"))
DIM_PLAN = Scd2Spec(sk_col="dim_plan_sk", keys=("plan_id_key",), tracked={"payment_gateway": ""},
                    carried=("plan_id",))
DIM_AD_ACCOUNT = Scd2Spec(sk_col="dim_ad_account_sk", keys=("account_id",),
                          tracked={"account_name": "", "account_status": 0, "currency": "", "business_name": ""},
                          carried=("timezone_name", "business_id"))
DIM_CAMPAIGN = Scd2Spec(sk_col="dim_campaign_sk", keys=("campaign_id",),
                        tracked={"campaign_name": "", "status": "", "effective_status": "", "objective": "",
                                 "daily_budget": 0, "lifetime_budget": 0},
                        carried=("buying_type", "ad_account_id"))
DIM_ADSET = Scd2Spec(sk_col="dim_adset_sk", keys=("adset_id",),
                     tracked={"adset_name": "", "status": "", "effective_status": "", "bid_strategy": "",
                              "optimization_goal": "", "daily_budget": 0},
                     carried=("campaign_id", "lifetime_budget", "ad_account_id"))
DIM_AD = Scd2Spec(sk_col="dim_ad_sk", keys=("ad_id",),
                  tracked={"ad_name": "", "status": "", "effective_status": "", "creative_name": "",
                           "creative_title": ""},
                  carried=("adset_id", "campaign_id", "creative_id", "creative_cta_type", "ad_account_id"))
