"""End-to-end runs (T8's order as plain driver code): load, Silver, dimensions, facts.

Independent branches are submitted as concurrent Spark jobs; each step is a DataFrame job on the cluster. ``run_all`` builds
every table from scratch for one session, ``pipeline_run`` keeps them at given locations and goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratum.operators.flatten import list_membership
from stratum.plans import ads, catalog, feeds, mailing, specs
from stratum.plans.state import DimHistory, SilverHistory, scd2_runs, silver_runs
from stratum.sources.snapshots import SnapshotTable


def run_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    silver_only = ("slv_contact_list", "slv_smtp_email", "slv_smtp_event", "slv_custom_audience",
                   "slv_insight_account", "slv_insight_campaign", "slv_insight_adset")
    with ThreadPoolExecutor(max_workers=4) as pool:
        # Silver and the dimension chains that depend only on their own Silver tables
        contacts = pool.submit(mailing.contact_dims, spark, sf_dir)
        policy = pool.submit(mailing.policy_dim, spark, sf_dir)
        plan = pool.submit(mailing.plan_dim, spark, sf_dir)
        entity_dims = pool.submit(ads.all_entity_dims, spark, sf_dir)
        insights = pool.submit(ads.insight_silver, spark, sf_dir)
        others = {k: pool.submit(catalog.QUERIES[k], spark, sf_dir) for k in silver_only}
        contacts.result(), policy.result(), plan.result(), entity_dims.result(), insights.result()
        # facts after all their dimensions
        fact_event = pool.submit(mailing.fact_event, spark, sf_dir)
        fact_ad = pool.submit(ads.fact_runs, spark, sf_dir)
        tables = {
            "slv_contact": mailing.contact_silver(spark, sf_dir)[-1],
            "slv_contact_list_membership": mailing.membership(spark, sf_dir),
            "slv_event": mailing.event_silver(spark, sf_dir),
            "slv_agg_report": mailing.agg_report_silver(spark, sf_dir),
            "slv_insight_ad": insights.result(),
            **{f"slv_{e}": ads.entity_silver(spark, sf_dir, e)[-1] for e in ads.ENTITIES},
            **{k: f.result() for k, f in others.items()},
            "dim_contact": contacts.result()[-1], "dim_policy": policy.result(), "dim_plan": plan.result(),
            **{f"dim_{e}": d[-1] for e, d in entity_dims.result().items()},
            "dim_date": ads.dim_date(spark, sf_dir),
            "fact_event": fact_event.result(), "fact_ad_insight": fact_ad.result()[-1],
        }
    return tables


@dataclass(frozen=True)
class Source:
    """A Silver table of the scheduled run: its spec and the raw records of each of its runs, with the run's time."""
    spec: object
    batches: list


def sources(spark: SparkSession, sf_dir: str) -> dict[str, Source]:
    """All Silver tables by name. Contacts arrive in three runs, everything else in two."""
    contact = feeds.contact_feed(spark, sf_dir)
    out = {"slv_contact": Source(specs.SLV_CONTACT, [(contact.filter(contact["batch_no"] == b), mailing.run_ts(k))
                                                     for k, b in enumerate(mailing.CONTACT_BATCH_ORDER, start=1)])}
    delivered = {"slv_event": (specs.SLV_EVENT, feeds.policy_event_feed), "slv_agg_report": (specs.SLV_AGG_REPORT, feeds.daily_report_feed),
                 "slv_insight_ad": (specs.SLV_INSIGHT_AD, feeds.insight_feed), **mailing.MORE_SILVER}
    for name, (spec, feed) in delivered.items():
        raw = feed(spark, sf_dir)
        out[name] = Source(spec, [(feeds.delivered(raw, spec.name, run), mailing.run_ts(run)) for run in (1, 2)])
    for name, (spec, _, feed) in ads.ENTITIES.items():
        out[f"slv_{name}"] = Source(spec, [(feed(spark, sf_dir, run), ads.run_ts(run)) for run in (1, 2)])
    return out


RUNS = 3
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Spark removes each job's shuffle files when the job has ended, not when the driver next collects garbage: a step's rows
    are in its table by then, so the disk holds the shuffles of the running steps alone."""
    had = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if had is None else spark.conf.set(CLEANUP, had)


class Stopped(RuntimeError):
    """Raised by ``pipeline_run`` before a step its ``before`` hook refuses (tests of resumption)."""


def pipeline_run(spark: SparkSession, sf_dir: str, root: str, runs: int = RUNS,
                 before: Callable[[str], None] | None = None) -> dict[str, DataFrame]:
    """The scheduled runs 1 to ``runs`` of the whole graph over tables kept under ``root`` (shared storage): per run the load
    of every source into Bronze, the 15 Silver tables, the 7 dimensions from Silver's change rows, and both facts.

    Every step is a table's commit of one run and is skipped where that commit exists, so a call after a crash, also in
    another process, does what is left, and a call without new batches does nothing. Steps of one level run as
    concurrent Spark jobs. ``before`` is called with each step's name before it starts."""
    root, start = root.rstrip("/"), before or (lambda step: None)
    raw = sources(spark, sf_dir)
    silver: dict[str, SilverHistory] = {}
    dims: dict[str, DimHistory] = {}
    facts: dict[str, list[DataFrame]] = {}

    def load(name: str, upto: int) -> list:
        """Bronze: each run's records under the run's own name; a loaded run is not read from its source again."""
        table = SnapshotTable(spark, f"{root}/bronze/{name}")
        out = []
        for k, (records, ts) in enumerate(raw[name].batches[:upto]):
            start(f"load {name} {k}")
            table.append(records, str(k))
            out.append((spark.read.schema(records.schema).parquet(f"{table.root}/batch={k}"), ts))
        return out

    def merge(name: str, upto: int) -> None:
        batches = load(name, upto)
        start(f"{name} {upto}")
        silver[name] = silver_runs(spark, raw[name].spec, batches, name, root=f"{root}/{name}")

    def dimension(name: str, spec, fed, upto: int) -> None:
        start(f"{name} {upto}")
        dims[name] = scd2_runs(spark, spec, fed(), name, root=f"{root}/{name}")

    def changes(name: str, source):
        return lambda: [(source(silver[name].changed_rows(k)), ts) for k, (_, ts) in enumerate(raw[name].batches[:len(silver[name])])]

    def event_changes(source, of):
        return lambda: mailing.dim_event_sources(silver["slv_event"], source, of)

    def facts_of(kind: str, upto: int) -> None:
        start(f"{kind} {upto}")
        if kind == "fact_event":
            facts[kind] = mailing.event_fact_history(spark, silver["slv_event"], dims["dim_contact"], dims["dim_policy"],
                                                     dims["dim_plan"], len(silver["slv_event"]), root=f"{root}/{kind}")
        else:
            facts[kind] = ads.fact_history(spark, silver["slv_insight_ad"], {e: dims[f"dim_{e}"] for e in ads.ENTITIES},
                                           len(silver["slv_insight_ad"]), root=f"{root}/{kind}")

    with shuffles_removed(spark), ThreadPoolExecutor(max_workers=6) as pool:
        def level(jobs) -> None:
            for done in [pool.submit(*j) for j in jobs]:
                done.result()

        for upto in range(1, runs + 1):
            level([(merge, name, min(upto, len(s.batches))) for name, s in raw.items()])
            level([(dimension, "dim_contact", specs.DIM_CONTACT, changes("slv_contact", mailing.dim_contact_source), upto),
                   (dimension, "dim_policy", specs.DIM_POLICY, event_changes(mailing.dim_policy_source, mailing.POLICY_OF), upto),
                   (dimension, "dim_plan", specs.DIM_PLAN, event_changes(mailing.dim_plan_source, mailing.PLAN_OF), upto),
                   *[(dimension, f"dim_{e}", gold, changes(f"slv_{e}", ads.dim_source), upto)
                     for e, (_, gold, _) in ads.ENTITIES.items()]])
            level([(facts_of, "fact_event", upto), (facts_of, "fact_ad_insight", upto)])
    return {**{k: v[-1] for k, v in silver.items()}, **{k: v[-1] for k, v in dims.items()}, **{k: v[-1] for k, v in facts.items()},
            "slv_contact_list_membership": list_membership(silver["slv_contact"][-1]), "dim_date": ads.dim_date(spark, sf_dir)}
