"""Q9-Q18 reports over the Silver and Gold layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratum.functions.numeric import exact_ratio
from stratum.functions.temporal import ts_text
from stratum.operators.sized import sized


def layer_lineage(bronze: DataFrame, silver: DataFrame, gold: DataFrame, n: int = 5) -> DataFrame:
    """Q9: the same contacts seen in Bronze, Silver and Gold as text (top ``n`` ids per layer)."""
    b = (bronze.orderBy(F.col("contact_id").desc(), F.col("row_no").desc()).limit(n)
         .select(F.lit("BRONZE").alias("layer"), F.col("contact_id").cast("string").alias("id"), "email",
                 "vehicle_make", F.col("is_deleted").cast("string").alias("flag"),
                 ts_text("audit_updated_at").alias("audit_ts")))
    s = (silver.orderBy(F.col("contact_id").desc()).limit(n)
         .select(F.lit("SILVER"), F.col("contact_id").cast("string"), "email", "vehicle_make",
                 F.col("is_valid_record").cast("string"), ts_text("silver_loaded_at")))
    g = (gold.filter("is_current").orderBy(F.col("contact_id").desc()).limit(n)
         .select(F.lit("GOLD"), F.col("contact_id").cast("string"), "email", "vehicle_make",
                 F.col("is_current").cast("string"), ts_text("effective_start_date")))
    return b.union(s).union(g)


def campaign_performance(fact: DataFrame, dim_campaign: DataFrame, n: int = 20, most: int | None = None) -> DataFrame:
    """Q17: per campaign version: ads, impressions, reach, clicks, spend and ratio-of-sums KPIs. ``fact`` may be the fact or
    its sums per campaign version and ad. ``most``: the rows that ``dim_campaign`` has at most, if that is known."""
    campaigns = dim_campaign.select("dim_campaign_sk", "campaign_name", "objective", "status")
    j = fact.join(sized(campaigns, most), "dim_campaign_sk", "inner")
    agg = j.groupBy("campaign_name", "objective", "status").agg(
        F.count_distinct("ad_id").alias("total_ads"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("reach").alias("total_reach"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("spend").alias("total_spend"))
    return (agg.select(
                "campaign_name", "objective", "status", "total_ads", "total_impressions", "total_reach",
                "total_clicks", F.col("total_spend").cast("decimal(38,2)").alias("total_spend"),
                exact_ratio(F.col("total_clicks") * 100, "total_impressions", 2).alias("avg_ctr"),
                exact_ratio(F.col("total_spend") * 100, F.col("total_clicks") * 100, 2).alias("avg_cpc"),
                exact_ratio(F.col("total_spend") * 1000, "total_impressions", 2).alias("avg_cpm"))
            .orderBy(F.col("total_spend").desc_nulls_first(), "campaign_name", "objective", "status")
            .limit(n))


STAR = {"ad_account": ["account_name"], "campaign": ["campaign_name", "objective"], "adset": ["adset_name", "optimization_goal"],
        "ad": ["ad_name", "creative_title"]}


def star(fact: DataFrame, dims: dict[str, DataFrame], dim_date: DataFrame, most: dict[str, int | None] | None = None) -> DataFrame:
    """The fact with all its dimensions (by surrogate key) and the calendar (by date). ``most``: the rows that each
    dimension has at most, where that is known."""
    for entity, names in STAR.items():
        sk = f"dim_{entity}_sk"
        fact = fact.join(sized(dims[entity].select(sk, *names), (most or {}).get(entity)), sk, "left")
    return (fact
            .join(F.broadcast(dim_date.select(F.col("date_id").alias("date_start_id"), "day_name")),
                  "date_start_id", "left")
            .select("insight_sk", "account_name", "campaign_name", "objective", "adset_name", "optimization_goal",
                    "ad_name", "creative_title", F.col("date_start_id").alias("report_date"), "day_name",
                    "impressions", "reach", "clicks", "spend", "ctr", "cpc", "cpm"))
