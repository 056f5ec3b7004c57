"""End-to-end batch run: written silver/gold tables, allow-listed lookup, export."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from compare import SF_SMALL
from skyledger.plans import gold
from skyledger.plans.pipeline import objects_from_testdata, run_batch
from skyledger.sources.adapters import load_feeds
from skyledger.sources.catalog import load_gold, read_layer, read_snapshot, table_properties
from skyledger.sources.export import ExportError, export_all, file_inventory, read_export


def test_run_batch_writes_all_layers(spark, scratch):
    satcat_raw, gp_raw = load_feeds(spark, SF_SMALL)
    res = run_batch(spark, satcat_raw, gp_raw, scratch, snapshot_date="2026-01-01")
    assert set(res.tables) == {"space_objects", "fragmentation_events", *gold.GOLD_TABLES}
    assert res.quality["rows"] == read_layer(spark, scratch, "space_objects").count()
    assert res.quality["valid_norad_id"] == 0
    assert table_properties(spark, scratch, "congestion_metrics")["layer"] == "gold"
    lb = load_gold(spark, scratch, "country_leaderboard")
    direct = gold.country_leaderboard(objects_from_testdata(spark, SF_SMALL))
    assert lb.exceptAll(direct).count() == 0 and direct.exceptAll(lb).count() == 0
    with pytest.raises(ValueError):
        load_gold(spark, scratch, "space_objects")
    # a second snapshot adds a partition and leaves the first one in place
    run_batch(spark, satcat_raw, gp_raw, scratch, snapshot_date="2026-02-01")
    first = read_snapshot(spark, scratch, "orbital_census", "2026-01-01")
    second = read_snapshot(spark, scratch, "orbital_census", "2026-02-01")
    assert first.count() == second.count() > 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_export_round_trip_and_failure(spark, scratch):
    objects = objects_from_testdata(spark, SF_SMALL)
    tables = {"decay_tracker": gold.decay_tracker(objects),
              "congestion_metrics": gold.congestion_metrics(objects)}
    results, manifest = export_all(spark, tables, scratch)
    m = manifest.first()
    assert m.tables == ["congestion_metrics", "decay_tracker"]
    assert m.endpoints == {"decay_tracker": "decay_tracker.json",
                           "congestion_metrics": "congestion_metrics.json"}
    assert m.total_rows == sum(r.rows for r in results)
    for r in results:  # every endpoint opens below the base
        assert spark.read.json(f"{scratch}/{m.endpoints[r.table]}").count() == r.rows
    back = read_export(spark, scratch, "decay_tracker", tables["decay_tracker"].schema)
    assert back.exceptAll(tables["decay_tracker"]).count() == 0
    assert file_inventory(spark, f"{scratch}/decay_tracker.json", "*.json").first().total_bytes > 0

    bad = {"ok": gold.census_by_type(objects),
           "broken": objects.select(F.col("object_name").cast("int").alias("x"))}
    with pytest.raises(ExportError) as err:
        export_all(spark, bad, f"{scratch}/second")
    assert list(err.value.errors) == ["broken"]
    assert spark.read.json(f"{scratch}/second/_manifest").first().tables == ["ok"]


def test_full_run_from_landed_files(spark, scratch):
    from skyledger.__main__ import main
    from skyledger.plans.pipeline import run_full
    landing, base, export = f"{scratch}/landing", f"{scratch}/base", f"{scratch}/export"
    assert main(["land", "--sf-dir", SF_SMALL, "--landing", landing]) == 0
    res = run_full(spark, landing, base, export, snapshot_date="2026-01-01")
    assert res.envelopes["satcat"] > 0 and res.envelopes["gp"] > 0
    lb = load_gold(spark, base, "country_leaderboard")
    direct = gold.country_leaderboard(objects_from_testdata(spark, SF_SMALL))
    assert lb.exceptAll(direct).count() == 0 and direct.exceptAll(lb).count() == 0
    assert {r.table for r in res.export} == set(gold.GOLD_TABLES)
    again = run_full(spark, landing, base, None, snapshot_date="2026-01-01")
    assert again.envelopes == {"satcat": 0, "gp": 0}
    assert read_layer(spark, base, "space_objects").count() == \
        objects_from_testdata(spark, SF_SMALL).count()


def test_scratch_folder_needs_a_shared_place_off_local_mode(spark, monkeypatch):
    from skyledger import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
