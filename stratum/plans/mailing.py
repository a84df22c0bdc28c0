"""E-mail/policy source: Silver SCD-1 tables, Gold SCD-2 dimensions and the event fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum import functions as X
from stratum.functions.temporal import ts_literal
from stratum.operators.dedup import dedup_latest
from stratum.operators.merge import fact_merge
from stratum.operators.flatten import list_membership
from stratum.operators.sized import look_up
from stratum.plans import feeds, specs
from stratum.plans.state import DimHistory, SilverHistory, memo, new_table, scd2_runs, silver_runs

# Fixed run times of the three pipeline runs (one shared run_ts per run).
RUN_TS = {1: "2024-03-01 00:00:00", 2: "2024-03-02 00:00:00", 3: "2024-03-03 00:00:00"}
# Batch 2 lands before batch 1, so the late-data guard (M3) and stale deletes (M2) are exercised.
CONTACT_BATCH_ORDER = (2, 1, 3)


def run_ts(run: int):
    return ts_literal(RUN_TS[run])


def contact_silver(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """SLV_CONTACT after each of the three runs."""
    def build():
        feed = feeds.contact_feed(spark, sf_dir)
        batches = [(feed.filter(F.col("batch_no") == batch), run_ts(run))
                   for run, batch in enumerate(CONTACT_BATCH_ORDER, start=1)]
        return silver_runs(spark, specs.SLV_CONTACT, batches, "slv_contact")
    return memo(spark, sf_dir, "contact_silver", build)


def dim_contact_source(silver: DataFrame) -> DataFrame:
    return (silver.filter(X.active_valid("is_valid_record", "is_deleted"))
            .withColumn("full_name", X.full_name("first_name", "last_name"))
            .withColumn("contact_created_at", F.col("created_at")))


def contact_dims(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """DIM_CONTACT after each run (SCD-2 over the Silver snapshot of that run)."""
    def build():
        # Gold is fed the change rows of each Silver run, and each SCD-2 run writes only the versions of
        # those keys that it closes or opens.
        silver = contact_silver(spark, sf_dir)
        sources = [(dim_contact_source(silver.changed_rows(i)), run_ts(i + 1)) for i in range(len(silver))]
        return scd2_runs(spark, specs.DIM_CONTACT, sources, "dim_contact")
    return memo(spark, sf_dir, "contact_dims", build)


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SLV_CONTACT_LIST_MEMBERSHIP rebuilt from the final contact snapshot (M9)."""
    return list_membership(contact_silver(spark, sf_dir)[-1])


def two_runs(spark: SparkSession, sf_dir: str, spec, feed) -> SilverHistory:
    """A Silver table after each of two deliveries of its feed (``feeds.delivered``)."""
    def build():
        raw = feed(spark, sf_dir)
        return silver_runs(spark, spec, [(feeds.delivered(raw, spec.name, run), run_ts(run)) for run in (1, 2)], spec.name)
    return memo(spark, sf_dir, f"two_runs_{spec.name}", build)


def event_runs(spark: SparkSession, sf_dir: str) -> SilverHistory:
    return two_runs(spark, sf_dir, specs.SLV_EVENT, feeds.policy_event_feed)


def event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_runs(spark, sf_dir)[-1]


def agg_report_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_runs(spark, sf_dir, specs.SLV_AGG_REPORT, feeds.daily_report_feed)[-1]


def policy_id(code="policy_code", number="policy_number", null_as_empty=False):
    return X.hash_key(code, number, null_as_empty=null_as_empty)


def plan_id_key(plan="plan_id", gateway="payment_gateway"):
    return X.hash_key(plan, gateway)


def dim_policy_source(events: DataFrame) -> DataFrame:
    """Latest valid event per policy (the reference takes every distinct event: see README)."""
    src = (events.filter(F.coalesce(F.col("is_valid_record"), F.lit(False))
                         & F.col("policy_code").isNotNull() & F.col("policy_number").isNotNull())
           .withColumn("policy_id", policy_id()))
    latest = dedup_latest(src, ["policy_id"], ["event_date", "audit_updated_at"], [F.col("event_uuid").desc()])
    return latest.select("policy_id", "policy_code", "policy_number", "coverage_code", "policy_start_date",
                         "policy_end_date",
                         X.days_between("policy_start_date", "policy_end_date").alias("policy_duration_days"))


def dim_plan_source(events: DataFrame) -> DataFrame:
    """Distinct (plan, gateway) pairs; '' and NULL gateways share a key, the non-NULL one is kept."""
    src = (events.filter(F.coalesce(F.col("is_valid_record"), F.lit(False)) & F.col("plan_id").isNotNull())
           .select("plan_id", "payment_gateway").distinct()
           .withColumn("plan_id_key", plan_id_key()))
    return dedup_latest(src, ["plan_id_key"], ["payment_gateway"])


def dim_event_sources(silver: SilverHistory, source, of: list[str]) -> list:
    """Per run the source rows of an event dimension, each with its run time. After the first run: of those dimension keys
    (columns ``of``, which a key's events share) only that a row written by the run has or had, since the others' events are
    what they were. The events are cut to the few source rows before these meet the keys: no event moves for the join."""
    out = [(source(silver[0]), run_ts(1))]
    for k in range(1, len(silver)):
        changed = silver.changed_rows(k)
        had = silver[k - 1].join(changed.select("event_uuid").hint("merge"), "event_uuid", "left_semi")
        keys = changed.select(*of).unionByName(had.select(*of)).distinct()
        alike = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in of]
        rows = source(silver[k]).join(keys.select(*[F.col(c).alias(f"__{c}") for c in of]).hint("merge"), alike, "left_semi")
        out.append((rows, run_ts(k + 1)))
    return out


def _event_dims(spark: SparkSession, sf_dir: str, name: str, source, spec, of: list[str]) -> DimHistory:
    def build():
        return scd2_runs(spark, spec, dim_event_sources(event_runs(spark, sf_dir), source, of), name)
    return memo(spark, sf_dir, name, build)


# the plan alone: a NULL and an empty gateway of one plan share a key
POLICY_OF, PLAN_OF = ["policy_code", "policy_number"], ["plan_id"]


def policy_dims(spark: SparkSession, sf_dir: str) -> DimHistory:
    """DIM_POLICY after each run: the latest event of every policy that a changed event belongs to."""
    return _event_dims(spark, sf_dir, "dim_policy", dim_policy_source, specs.DIM_POLICY, POLICY_OF)


def plan_dims(spark: SparkSession, sf_dir: str) -> DimHistory:
    return _event_dims(spark, sf_dir, "dim_plan", dim_plan_source, specs.DIM_PLAN, PLAN_OF)


def policy_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_dims(spark, sf_dir)[-1]


def plan_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_dims(spark, sf_dir)[-1]


FACT_EVENT_COLS = ("event_uuid", "dim_contact_sk", "dim_policy_sk", "dim_plan_sk", "contact_id", "event_date_id",
                   "policy_id", "plan_id_key", "event_name", "premium_amount", "payment_status_id", "event_date", "customer_id")


def fact_event_source(events: DataFrame, dim_contact: DataFrame, dim_policy: DataFrame,
                      dim_plan: DataFrame, most: tuple[int | None, ...] = (None, None, None)) -> DataFrame:
    """Valid, live inserted events linked to the dimension rows current at load.

    ``most``: the rows that each dimension has at most, where that is known: it is broadcast when these are below
    ``spark.sql.autoBroadcastJoinThreshold``; to a larger one only the events' keys are shuffled.
    """
    e = (events.filter(X.active_valid("is_valid_record", "is_deleted", "is_valid_event_date"))
         .withColumn("policy_id", policy_id(null_as_empty=True))
         .withColumn("plan_id_key", plan_id_key()))
    dc = dim_contact.filter("is_current").select("contact_id", "dim_contact_sk")
    dp = dim_policy.filter("is_current").select("policy_id", "dim_policy_sk")
    dl = dim_plan.filter("is_current").select("plan_id_key", "dim_plan_sk")
    joined = look_up(e, ["event_uuid"], [("contact_id", dc, most[0]), ("policy_id", dp, most[1]), ("plan_id_key", dl, most[2])])
    # events are unique by event_uuid (the Silver key) and every dimension has one current row per key
    return joined.select(*[F.to_date("event_date").alias(c) if c == "event_date_id" else F.col(c)
                           for c in FACT_EVENT_COLS])


def event_fact_history(spark: SparkSession, silver: SilverHistory, contacts: DimHistory, policies: DimHistory,
                       plans: DimHistory, runs: int, root: str | None = None) -> list[DataFrame]:
    """FACT_EVENT after each of ``runs`` runs; each takes in the rows its Silver run inserted or updated, linked to the
    dimension versions of that run, and writes only those. With ``root``, committed runs are not repeated."""
    table = new_table(spark, "fact_event", ["event_uuid"], root, bucketed=True)
    whole = bool(table.buckets)
    for k in range(runs):
        last = table.last_commit()
        if last is not None and k <= last:
            continue
        src, ts = fact_event_source(silver.changed_rows(k), contacts[k], policies[k], plans[k],
                                    (contacts.most, policies.most, plans.most)), run_ts(k + 1)
        empty = (src.limit(0).withColumn("gold_loaded_at", F.lit(None).cast("timestamp_ntz"))
                 .withColumn("gold_updated_at", F.lit(None).cast("timestamp_ntz")))
        table.merge(src, lambda fact, new, ts=ts, empty=empty: fact_merge(
            empty if fact is None else fact, new, ["event_uuid"], run_ts=ts, only_source=whole),
            changed=F.lit(True), version=k, whole=whole)
    return [table.read(k) for k in range(runs)]


def fact_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FACT_EVENT after two runs, each on the contact, policy and plan versions of its own run."""
    def build():
        silver = event_runs(spark, sf_dir)
        return event_fact_history(spark, silver, contact_dims(spark, sf_dir), policy_dims(spark, sf_dir),
                                  plan_dims(spark, sf_dir), len(silver))[-1]
    return memo(spark, sf_dir, "fact_event", build)


# Silver tables without a Gold table: spec and feed.
MORE_SILVER = {
    "slv_contact_list": (specs.SLV_CONTACT_LIST, feeds.contact_list_feed),
    "slv_smtp_email": (specs.SLV_SMTP_EMAIL, feeds.smtp_email_feed),
    "slv_smtp_event": (specs.SLV_SMTP_EVENT, feeds.smtp_event_feed),
    "slv_custom_audience": (specs.SLV_CUSTOM_AUDIENCE, feeds.custom_audience_feed),
    "slv_insight_account": (specs.SLV_INSIGHT_ACCOUNT, lambda spark, sf: feeds.insight_level_feed(spark, sf, "ad_account_id")),
    "slv_insight_campaign": (specs.SLV_INSIGHT_CAMPAIGN, lambda spark, sf: feeds.insight_level_feed(spark, sf, "campaign_id")),
    "slv_insight_adset": (specs.SLV_INSIGHT_ADSET, lambda spark, sf: feeds.insight_level_feed(spark, sf, "adset_id")),
}
