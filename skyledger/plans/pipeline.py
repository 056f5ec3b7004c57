"""End-to-end run: feeds -> silver -> gold, with written tables between layers.

``space_objects`` is read by every gold table, so a run writes it once to the
shared folder and the six gold jobs scan the written table (column pruning
and filter pushdown then reach parquet), instead of re-running the silver
shuffles six times.  Writing a table also cuts lineage: a lost executor only
costs the tasks of the job that was running.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sources.adapters import load_feeds
from ..sources.catalog import read_layer, write_table
from . import gold, silver


def objects_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    satcat_raw, gp_raw = load_feeds(spark, sf_dir)
    return silver.space_objects(satcat_raw, gp_raw)


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object table written once to the shared folder, for jobs that read it
    several times."""
    base = scratch_path(spark, "objects")
    write_table(objects_from_testdata(spark, sf_dir), base, "space_objects", "silver")
    return read_layer(spark, base, "space_objects")


TABLE_COMMENTS = {
    "space_objects": "unified object table: newest catalogue row per id + newest elements",
    "fragmentation_events": "debris pieces per launch and country (10 or more)",
    "orbital_census": "objects per type, regime and country, one partition per snapshot",
    "congestion_metrics": "objects per 50 km apogee band",
    "country_leaderboard": "objects, payloads, debris and ratios per country",
    "constellation_growth": "size and launch span of the large constellations",
    "decay_tracker": "low-perigee objects not yet decayed, with a drag term",
    "globe_data": "objects with a TLE pair, lowest ids per regime up to the quotas",
}


@dataclass
class RunResult:
    base: str
    tables: dict[str, str] = field(default_factory=dict)
    quality: dict[str, int] = field(default_factory=dict)


def run_batch(spark: SparkSession, satcat_raw: DataFrame, gp_raw: DataFrame,
              base: str, snapshot_date=None) -> RunResult:
    """Build silver and gold tables under ``base`` (overwrite)."""
    res = RunResult(base)
    objects, obs = silver.space_objects_checked(satcat_raw, gp_raw)
    res.tables["space_objects"] = write_table(objects, base, "space_objects", "silver",
                                              TABLE_COMMENTS["space_objects"])
    res.quality = dict(obs.get)
    res.tables["fragmentation_events"] = write_table(
        silver.fragmentation_events(satcat_raw), base, "fragmentation_events", "silver",
        TABLE_COMMENTS["fragmentation_events"])
    stored = read_layer(spark, base, "space_objects")
    for name, fn in gold.GOLD_TABLES.items():
        if name == "orbital_census":
            # census keeps one partition per snapshot date (history of runs)
            res.tables[name] = write_table(fn(stored, snapshot_date), base, name, "gold",
                                           TABLE_COMMENTS[name], partition_by=["snapshot_date"])
        else:
            res.tables[name] = write_table(fn(stored), base, name, "gold", TABLE_COMMENTS[name])
    return res


@dataclass
class FullRunResult:
    bronze: dict[str, str]
    batch: RunResult
    export: list
    envelopes: dict[str, int]


def run_full(spark: SparkSession, landing: str, base: str, export_base: str | None = None,
             snapshot_date=None, max_files_per_trigger: int | None = None) -> FullRunResult:
    """The scheduled run: drain new envelopes under ``landing/satcat`` and
    ``landing/gp`` into bronze (append, each file once), rebuild silver and gold
    from the whole bronze tables, then export gold as JSON.

    Layout under ``base``: ``bronze/<feed>``, ``_checkpoints/<feed>``, silver
    and gold tables by name.  Rerunning with no new files re-ingests nothing.
    """
    from ..sources.export import export_all
    from ..streaming.bronze import ingest_envelopes, read_bronze

    bronze, counts, frames = {}, {}, {}
    for feed in ("satcat", "gp"):
        path = f"{base.rstrip('/')}/bronze/{feed}"
        res = ingest_envelopes(spark, f"{landing.rstrip('/')}/{feed}", path,
                               f"{base.rstrip('/')}/_checkpoints/{feed}",
                               max_files_per_trigger=max_files_per_trigger)
        bronze[feed], counts[feed] = path, res.envelopes
        frames[feed] = read_bronze(spark, path, res.schema)
    batch = run_batch(spark, frames["satcat"], frames["gp"], base, snapshot_date)
    exported = []
    if export_base:
        tables = {name: read_layer(spark, base, name) for name in gold.GOLD_TABLES}
        exported, _ = export_all(spark, tables, export_base)
    return FullRunResult(bronze, batch, exported, counts)
