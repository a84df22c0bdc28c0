"""Ads source: Silver entities and insights, Gold SCD-2 dimensions and the ad-insight fact."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum import functions as X
from stratum.functions.temporal import ts_literal
from stratum.operators.calendar import date_dimension
from stratum.operators.increments import merged_sums, signed_sums
from stratum.operators.sized import look_up, sized
from stratum.operators.surrogate import assign_surrogate_keys_counted
from stratum.plans import feeds, specs
from stratum.sources.snapshots import SnapshotTable
from stratum.plans.state import DimHistory, SilverHistory, memo, new_table, scd2_runs, silver_runs

# Fixed run times of the two ads runs.
RUN_TS = {1: "2024-03-01 00:00:00", 2: "2024-03-02 00:00:00"}

ENTITIES = {
    # name: (silver spec, gold spec, feed)
    "ad_account": (specs.SLV_AD_ACCOUNT, specs.DIM_AD_ACCOUNT, feeds.ad_account_feed),
    "campaign": (specs.SLV_CAMPAIGN, specs.DIM_CAMPAIGN, feeds.campaign_feed),
    "adset": (specs.SLV_ADSET, specs.DIM_ADSET, feeds.adset_feed),
    "ad": (specs.SLV_AD, specs.DIM_AD, feeds.ad_feed),
}


def run_ts(run: int):
    return ts_literal(RUN_TS[run])


def entity_silver(spark: SparkSession, sf_dir: str, entity: str) -> list[DataFrame]:
    silver_spec, _, feed = ENTITIES[entity]

    def build():
        return silver_runs(spark, silver_spec, [(feed(spark, sf_dir, run), run_ts(run)) for run in (1, 2)],
                           f"slv_{entity}")
    return memo(spark, sf_dir, f"silver_{entity}", build)


def dim_source(silver: DataFrame) -> DataFrame:
    return silver.filter(X.active_valid("is_valid_record", "is_deleted"))


def entity_dims(spark: SparkSession, sf_dir: str, entity: str) -> list[DataFrame]:
    _, gold_spec, _ = ENTITIES[entity]

    def build():
        silver = entity_silver(spark, sf_dir, entity)
        sources = [(dim_source(silver.changed_rows(i)), run_ts(i + 1))
                   for i in range(len(silver))]
        return scd2_runs(spark, gold_spec, sources, f"dim_{entity}")
    return memo(spark, sf_dir, f"dim_{entity}", build)


def all_entity_dims(spark: SparkSession, sf_dir: str) -> dict[str, list[DataFrame]]:
    """The four dimension pipelines are independent: submit them as concurrent Spark jobs
    (the reference's task graph also runs them in parallel)."""
    with ThreadPoolExecutor(max_workers=len(ENTITIES)) as pool:
        futures = {e: pool.submit(entity_dims, spark, sf_dir, e) for e in ENTITIES}
        return {e: f.result() for e, f in futures.items()}


def insight_runs(spark: SparkSession, sf_dir: str) -> SilverHistory:
    """SLV_INSIGHT_AD after each of two deliveries."""
    def build():
        raw = feeds.insight_feed(spark, sf_dir)
        name = specs.SLV_INSIGHT_AD.name
        return silver_runs(spark, specs.SLV_INSIGHT_AD,
                           [(feeds.delivered(raw, name, run), run_ts(run)) for run in (1, 2)], name)
    return memo(spark, sf_dir, "insight_runs", build)


def insight_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insight_runs(spark, sf_dir)[-1]


FACT_KEYS = ("ad_id", "date_start_id", "date_stop_id")
FACT_COLS = ("insight_sk", "dim_ad_account_sk", "dim_campaign_sk", "dim_adset_sk", "dim_ad_sk", "ad_id",
             "adset_id", "campaign_id", "ad_account_id", "date_start_id", "date_stop_id", "impressions", "reach",
             "clicks", "spend", "cpc", "cpm", "ctr", "actions_raw", "gold_loaded_at", "gold_updated_at")


def fact_source(insights: DataFrame, dims: dict[str, DataFrame], most: dict[str, int | None] | None = None) -> DataFrame:
    """Valid, live insights with the surrogate keys of the dimension rows current *now* (J1). ``most``: the rows that each
    dimension has at most, where that is known."""
    i = insights.filter(X.active_valid("is_valid_record", "is_deleted", "is_valid_date_range"))
    j = look_up(i, ["ad_id", "date_start", "date_stop"], [
        (column, dims[e].filter("is_current").select(F.col(key).alias(column), f"dim_{e}_sk"), (most or {}).get(e))
        for e, (column, key) in LINKS.items()])
    # insights are unique by (ad, start, stop), the Silver key, and every dimension has one current row per key
    return j.select("dim_ad_account_sk", "dim_campaign_sk", "dim_adset_sk", "dim_ad_sk", "ad_id", "adset_id",
                         "campaign_id", "ad_account_id", F.col("date_start").alias("date_start_id"),
                         F.col("date_stop").alias("date_stop_id"), "impressions", "reach", "clicks", "spend", "cpc",
                         "cpm", "ctr", "actions_raw")


def touched(fact: DataFrame, run_ts) -> DataFrame:
    """The fact as the reference's whole-table upsert would leave it after the run at ``run_ts``: that upsert stamps every row
    that is in its source, changed or not, so the stamp of a live row is the last run's and need not be stored."""
    stamp = F.when(F.col("in_source") & (F.col("gold_loaded_at") < run_ts), run_ts).otherwise(F.col("gold_updated_at"))
    return fact.withColumn("gold_updated_at", stamp).select(*FACT_COLS)


LINKS = {"ad": ("ad_id", "ad_id"), "adset": ("adset_id", "adset_id"), "campaign": ("campaign_id", "campaign_id"),
         "ad_account": ("ad_account_id", "account_id")}     # entity -> column of the fact, key of the dimension


def fact_delta(*args, **kwargs) -> tuple[DataFrame, int]:
    """:func:`fact_delta_parts` as one DataFrame."""
    parts, base = fact_delta_parts(*args, **kwargs)
    return reduce(DataFrame.unionByName, parts), base


def fact_delta_parts(fact_for, fact: DataFrame | None, changed: DataFrame, dims: dict[str, DataFrame],
                     opened: dict[str, DataFrame], run_ts, last_ts, base: int,
                     most: dict[str, int | None] | None = None) -> tuple[list[DataFrame], int]:
    """The fact rows that one run has to write (in parts), and the next key base (M8 as a delta).

    ``changed`` are the insights that the Silver run wrote, ``opened`` the dimension versions that this run opened.
    Written are the facts of changed insights, looked up in the current dimensions, and those whose dimension row is
    new; every other row of the fact keeps its place. ``fact_for(rows)`` gives the facts with the keys of ``rows``. Fact
    and insights are bucketed by one key: what is sorted by range or looked up elsewhere are the keys alone, and the whole
    rows are joined to the outcome where they lie. ``most``: the rows that each dimension has at most, where that is known."""
    keys, most = list(FACT_KEYS), most or {}
    fresh = fact_source(changed, dims, most)
    changed = changed.withColumnsRenamed({"date_start": "date_start_id", "date_stop": "date_stop_id"})
    live = F.coalesce(X.active_valid("is_valid_record", "is_deleted", "is_valid_date_range"), F.lit(False))
    new = changed.filter(live).select(*keys)
    none = F.lit(None).cast("timestamp_ntz")
    if fact is None:
        again = []
    else:
        n_changed = changed.count()       # of the files' footers; no more rows of the fact have their keys
        held = fact_for(changed)
        had = held.select(*keys, F.col("insight_sk").alias("had_sk"), F.col("gold_loaded_at").alias("had_at"))
        both = fresh.join(sized(had, n_changed), keys, "left")
        new = new.join(sized(held.select(*keys), n_changed), keys, "left_anti")
        same = both.filter("had_sk IS NOT NULL").select(
            F.col("had_sk").alias("insight_sk"), *fresh.columns, F.col("had_at").alias("gold_loaded_at"),
            run_ts.alias("gold_updated_at"), F.lit(True).alias("in_source"))
        # insights that are no longer valid or live leave the source: their facts stay, with the last run's stamp
        gone = sized(changed.filter(~live).select(*keys), n_changed)
        left = touched_stamp(held.filter("in_source"), last_ts).join(gone, keys, "left_semi")
        kept = fact.filter("in_source").join(sized(changed.select(*keys), n_changed), keys, "left_anti")
        pointed = [f"dim_{e}_sk" for e in LINKS]
        moved = kept.select(*dict.fromkeys([*keys, *[column for column, _ in LINKS.values()]]))
        for entity, (column, key) in LINKS.items():
            sk = f"dim_{entity}_sk"
            versions = opened[entity].select(F.col(key).alias(f"to_{column}"), F.col(sk).alias(f"to_{sk}"))
            moved = moved.join(sized(versions, most.get(entity)), F.col(column) == F.col(f"to_{column}"), "left").drop(f"to_{column}")
        moved = moved.filter(F.coalesce(*[f"to_{c}" for c in pointed]).isNotNull()).select(*keys, *[f"to_{c}" for c in pointed])
        moved = (kept.join(moved.hint("merge"), keys)
                 .withColumns({c: F.coalesce(f"to_{c}", c) for c in pointed}).drop(*[f"to_{c}" for c in pointed]))
        cols = [*FACT_COLS, "in_source"]
        again = [same.select(*cols), left.select(*cols), moved.select(*cols)]
    numbered, n = assign_surrogate_keys_counted(new, keys, "insight_sk", base=base)
    keyed = fresh.join(sized(numbered, n), keys).withColumns({"gold_loaded_at": run_ts, "gold_updated_at": none, "in_source": F.lit(True)})
    keyed = keyed.select(*FACT_COLS, "in_source")
    return [*again, keyed], base + n


def touched_stamp(rows: DataFrame, last_ts) -> DataFrame:
    return rows.withColumns({"gold_updated_at": F.when(F.col("gold_loaded_at") < last_ts, last_ts)
                             .otherwise(F.col("gold_updated_at")), "in_source": F.lit(False)})


AD_GRAIN, AD_SUMS = ["dim_campaign_sk", "ad_id"], ["impressions", "reach", "clicks", "spend"]


class FactHistory(list):
    """The fact after each run (a list) and what each run changed."""

    def __init__(self, snapshots, table):
        super().__init__(snapshots)
        self.table = table

    def partial_sums(self, run_index: int) -> DataFrame:
        """What the run added to the sums of each ad under each campaign version, from the rows it wrote alone."""
        new = self.table.changes(run_index)
        old = self.table.read_for(new, as_of=run_index - 1) if run_index else None
        return signed_sums(new, old, AD_GRAIN, AD_SUMS)


def fact_history(spark: SparkSession, insights: SilverHistory, dims: dict[str, DimHistory], runs: int,
                 root: str | None = None) -> FactHistory:
    """FACT_AD_INSIGHT after each of ``runs`` runs. A run reads the fact once and writes only the rows it changes; with
    ``root`` the table lives there and runs it has committed are not repeated."""
    table = new_table(spark, "fact_ad_insight", list(FACT_KEYS), root, bucketed=True)
    for k in range(runs):
        last = table.last_commit()
        if last is not None and k <= last:
            continue
        rows, base = fact_delta_parts(table.read_for, table.read(), insights.changed_rows(k), {e: d[k] for e, d in dims.items()},
                                      {e: d.opened(k) for e, d in dims.items()}, run_ts(k + 1), run_ts(max(k, 1)),
                                      table.meta().get("sk_base", 0), {e: d.most for e, d in dims.items()})
        table.commit(table.dealt(rows), k, meta={"sk_base": base}, dealt=True)
    return FactHistory([touched(table.read(k), run_ts(k + 1)) for k in range(runs)], table)


def maintained_sums(spark: SparkSession, fact: FactHistory, root: str) -> DataFrame:
    """The sums of each ad under each campaign version, kept under ``root`` as one partial per run: a run whose partial is
    there is not read again."""
    store = SnapshotTable(spark, root)
    for k in range(len(fact)):
        store.append(fact.partial_sums(k), str(k))
    schema = fact.partial_sums(0).schema
    return merged_sums(spark.read.schema(schema).parquet(f"{store.root}/batch=*"), AD_GRAIN, AD_SUMS)


def fact_runs(spark: SparkSession, sf_dir: str) -> FactHistory:
    """FACT_AD_INSIGHT after each run."""
    def build():
        with ThreadPoolExecutor(max_workers=2) as pool:
            dims = pool.submit(all_entity_dims, spark, sf_dir)
            insights = insight_runs(spark, sf_dir)
            return fact_history(spark, insights, dims.result(), len(insights))
    return memo(spark, sf_dir, "fact_ad_insight", build)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 date dimension anchored at the first year of the insight data."""
    first = feeds.table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate")).first()[0]
    return date_dimension(spark, f"{first.year:04d}-01-01")
