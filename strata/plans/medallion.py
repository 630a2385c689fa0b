"""Bronze, silver and gold for a set of feeds, in dependency order (R5).

``refresh`` runs the triggered bronze streams, then recomputes every enabled
feed's staged rows (written once), silver and quarantine tables from bronze, then the gold fact from
silver - the same full-recompute semantics as materialized views.  Every
layer is written under ``out_root`` as a new version that counts once committed,
so readers never see a half-written table and later jobs (and reruns after a
lost executor or driver) start from stored tables, not from lineage.  ``Layers``
holds the folders of the versions this run wrote.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.operators.audit import SWEEP, completeness, landed_pages, newest_pages, offset_gaps, with_runs
from strata.operators.flatten import flatten
from strata.operators.quality import counts_table, observe_rules, quarantine, silver
from strata.operators.salvage import damaged_records, with_salvaged
from strata.plans.feeds import ALL_FEEDS, gold_flights
from strata.sources.bronze import corrupt_documents, read_bronze
from strata.sources.tables import write_version
from strata.spec import FeedSpec
from strata.streaming.ingest import ingest_feeds


@dataclass
class Layers:
    bronze: dict = field(default_factory=dict)
    staged: dict = field(default_factory=dict)
    silver: dict = field(default_factory=dict)
    quarantine: dict = field(default_factory=dict)
    corrupt: dict = field(default_factory=dict)
    damaged: dict = field(default_factory=dict)
    gold: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    audits: dict = field(default_factory=dict)


def staged(spark: SparkSession, spec: FeedSpec, bronze_dir: str) -> DataFrame:
    """Staged rows: those of good documents and the complete records of bad ones."""
    return flatten(with_salvaged(read_bronze(spark, bronze_dir, spec), spec), spec)


def rule_counts(observed: dict, spec: FeedSpec) -> dict:
    """{rule: (action, n_pass, n_fail)} from an observation of the checked rows."""
    rows = observed.get("rows", 0)
    return {r.name: (r.action, observed[f"{r.name}_pass"], rows - observed[f"{r.name}_pass"])
            for r in spec.rules if r.sql}


def refresh(spark: SparkSession, landing_root: str, out_root: str,
            feeds: Sequence[FeedSpec] = ALL_FEEDS, mode: str = "dedup_then_check",
            with_gold: bool = True, archive_root: str | None = None,
            max_files_per_trigger: int | None = None) -> Layers:
    out_root = out_root.rstrip("/")
    layers = Layers(bronze=ingest_feeds(spark, feeds, landing_root, out_root,
                                        max_files_per_trigger=max_files_per_trigger,
                                        archive_root=archive_root))

    def build(spec: FeedSpec) -> None:
        st_path = f"{out_root}/staged/{spec.category}_{spec.name}"
        s_path = f"{out_root}/silver/{spec.category}_{spec.name}"
        q_path = f"{out_root}/silver/{spec.category}_{spec.name}_quarantine"
        # Staged rows are written once: the record JSON of bronze is parsed
        # by one job instead of by both silver and quarantine, and both read
        # columnar rows from a stored table (lineage cut).  Rule pass counts
        # ride along the silver write, at the point where the rules apply.
        st_path = write_version(staged(spark, spec, layers.bronze[spec.name]), st_path)
        stg = spark.read.parquet(st_path)
        counted: list = []

        def observe(checked: DataFrame) -> DataFrame:
            out, obs = observe_rules(checked, [r for r in spec.rules if r.sql], f"dq_{spec.name}")
            counted.append(obs)
            return out

        layers.staged[spec.name] = st_path
        layers.silver[spec.name] = write_version(silver(stg, spec, mode=mode, on_checked=observe), s_path)
        layers.quarantine[spec.name] = write_version(quarantine(stg, spec.rules), q_path)
        observed = counted[0].get
        layers.metrics[spec.name] = rule_counts(observed, spec)
        layers.counts[spec.name] = write_version(counts_table(spark, spec.name, observed, spec.rules),
                                                 f"{out_root}/metrics/{spec.category}_{spec.name}_full")
        bronze = read_bronze(spark, layers.bronze[spec.name], spec)
        c_path = f"{out_root}/quarantine/{spec.category}_{spec.name}_documents"
        layers.corrupt[spec.name] = write_version(corrupt_documents(bronze), c_path)
        d_path = f"{out_root}/quarantine/{spec.category}_{spec.name}_records"
        layers.damaged[spec.name] = write_version(damaged_records(bronze, spec), d_path)
        # Landing audits per run of an endpoint, found from when its pages landed.
        sweep = list(SWEEP)
        pages = newest_pages(with_runs(landed_pages(with_salvaged(bronze, spec), spec)), sweep)
        a_path = f"{out_root}/audit/{spec.category}_{spec.name}"
        layers.audits[spec.name] = {
            "completeness": write_version(completeness(pages, sweep, recovered="recovered"), f"{a_path}_completeness"),
            "gaps": write_version(offset_gaps(pages, sweep), f"{a_path}_gaps")}

    todo = [spec for spec in feeds if spec.enabled and spec.name in layers.bronze]
    if todo:  # feeds do not depend on each other: their jobs share the cluster
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            for f in [pool.submit(build, spec) for spec in todo]:
                f.result()
    needed = {"flights", "airports", "airlines", "aircraft", "countries"}
    if with_gold and needed <= set(layers.silver):
        t = {n: spark.read.parquet(layers.silver[n]) for n in needed}
        g_path = f"{out_root}/gold/fact_flights_master"
        layers.gold["fact_flights_master"] = write_version(
            gold_flights(t["flights"], t["airports"], t["airlines"], t["aircraft"], t["countries"]), g_path)
    return layers
