"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each query derives the catalogue feeds from the driver's ``orders`` table
and runs the library function over the whole input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .params import (CENSUS_DATES, GLOBE_DIGITS, POSITION_STEP_SECONDS, POSITION_STEPS, POSITION_T0,
                     SNAPSHOT_CUTOFF, SNAPSHOT_DATE, STORM_MAX_LAG_HOURS)
from .functions import classify
from .operators.quality import OBJECT_EXPECTATIONS, violation_counts
from .plans import gold, history, panels, silver
from .plans.pipeline import objects_from_testdata, stored_objects
from .session import ensure_conf
from .sources.adapters import load_feeds

Query = Callable[[SparkSession, str], DataFrame]


class _Registry(dict):
    """Every registered query first applies the required session settings
    (UTC session zone, AQE), whatever session the caller passes in."""

    def __setitem__(self, name: str, fn: Query) -> None:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        super().__setitem__(name, run)


QUERIES: dict[str, Query] = _Registry()


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _on_objects(name: str, fn, **kw) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(objects_from_testdata(spark, sf_dir), **kw)


@register("space_objects")
def _space_objects(spark, sf_dir):
    return objects_from_testdata(spark, sf_dir)


@register("fragmentation_events")
def _fragmentation(spark, sf_dir):
    satcat_raw, _ = load_feeds(spark, sf_dir)
    return silver.fragmentation_events(satcat_raw)


_on_objects("orbital_census", gold.orbital_census, snapshot_date=SNAPSHOT_DATE)
_on_objects("census_by_type", gold.census_by_type)
_on_objects("census_by_regime", gold.census_by_regime)
_on_objects("census_by_country", gold.census_by_country)
_on_objects("census_grouping_sets", gold.census_grouping_sets)
_on_objects("congestion_metrics", gold.congestion_metrics)
_on_objects("country_leaderboard", gold.country_leaderboard)
_on_objects("constellation_growth", gold.constellation_growth)
_on_objects("decay_tracker", gold.decay_tracker)
QUERIES["globe_data"] = lambda spark, sf_dir: gold.globe_data(stored_objects(spark, sf_dir))
_on_objects("quality_report", violation_counts, rules=OBJECT_EXPECTATIONS)


# Panels: roll-ups over the gold tables ---------------------------------------
def _census(spark, sf_dir):
    return gold.orbital_census(objects_from_testdata(spark, sf_dir), SNAPSHOT_DATE)


def _gold_of(fn):
    return lambda spark, sf_dir: fn(objects_from_testdata(spark, sf_dir))


def _panel(name: str, fn, source) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(source(spark, sf_dir))


_panel("rollup_by_type", panels.rollup_by_type, _census)
_panel("regime_breakdown", panels.regime_breakdown, _census)
_panel("total_objects", panels.total_objects, _census)
_panel("headline_counts", panels.headline_counts, _census)
_panel("reband_congestion", panels.reband, _gold_of(gold.congestion_metrics))
_panel("type_share", lambda c: panels.type_share(panels.rollup_by_type(c)), _census)
def _globe(spark, sf_dir):
    # the sample reads its input twice: the object table is stored first
    return gold.globe_data(stored_objects(spark, sf_dir))


_panel("points_by_type", panels.points_by_type, _globe)
_panel("visible_objects", lambda g: panels.visible_objects(g, ["DEBRIS", "UNKNOWN"]), _globe)
_panel("point_colors", lambda g: g.select("norad_cat_id", *[
    classify.type_rgba("object_type")[i].cast("double").alias(c)
    for i, c in enumerate("rgba")]), _globe)
_panel("top_countries", panels.top_countries, _gold_of(gold.country_leaderboard))
_panel("country_page", lambda lb: panels.country_page(lb, 0), _gold_of(gold.country_leaderboard))
_panel("country_page_count", panels.country_pages, _gold_of(gold.country_leaderboard))
_panel("top_constellations", panels.top_constellations, _gold_of(gold.constellation_growth))
_panel("decay_page", lambda d: panels.decay_page(d, 1), _gold_of(gold.decay_tracker))
_panel("decay_page_count", panels.country_pages, _gold_of(gold.decay_tracker))


# Bronze: landed envelopes drained by a triggered stream ------------------------
def _bronze(spark, sf_dir, names=("satcat", "gp")):
    from .session import scratch_path
    from .sources.adapters import GP_FIELDS, SATCAT_FIELDS, land_feed
    from .streaming.bronze import ingest_envelopes, read_bronze
    satcat_raw, gp_raw = load_feeds(spark, sf_dir)
    root = scratch_path(spark, "bronze-run")
    out = {}
    for name, raw, fields in (("satcat", satcat_raw, SATCAT_FIELDS), ("gp", gp_raw, GP_FIELDS)):
        if name not in names:
            continue
        land_feed(raw, f"{root}/landing/{name}", name, fields)
        res = ingest_envelopes(spark, f"{root}/landing/{name}", f"{root}/bronze/{name}",
                               f"{root}/checkpoints/{name}")
        out[name] = read_bronze(spark, f"{root}/bronze/{name}", res.schema)
    return out


@register("bronze_satcat")
def _bronze_satcat(spark, sf_dir):
    from .sources.adapters import SATCAT_FIELDS
    return _bronze(spark, sf_dir, ("satcat",))["satcat"].select(*SATCAT_FIELDS)


@register("bronze_gp")
def _bronze_gp(spark, sf_dir):
    from .sources.adapters import GP_FIELDS
    return _bronze(spark, sf_dir, ("gp",))["gp"].select(*GP_FIELDS)


@register("bronze_lineage")
def _bronze_lineage(spark, sf_dir):
    """Lineage of the ingested catalogue by collection: records, and the first and
    last position in the envelopes."""
    rows = _bronze(spark, sf_dir, ("satcat",))["satcat"]
    return rows.groupBy("_collected_at").agg(
        F.count(F.lit(1)).alias("records"), F.min("_record_index").alias("first_index"),
        F.count_if(F.col("_source_file").isNull() | F.col("_ingestion_ts").isNull())
         .alias("without_lineage")).withColumnRenamed("_collected_at", "collected_at")


@register("bronze_evolved")
def _bronze_evolved(spark, sf_dir):
    """Two runs on one checkpoint: the records before the cut-off land without
    RCS_SIZE, the later ones with it; nothing of the new field is lost."""
    from .session import scratch_path
    from .sources.adapters import SATCAT_FIELDS, land_feed
    from .streaming.bronze import ingest_envelopes, read_bronze
    raw, _ = load_feeds(spark, sf_dir)
    root = scratch_path(spark, "bronze-evolved")
    late = F.col("_ingestion_ts") >= F.lit(SNAPSHOT_CUTOFF).cast(
        raw.schema["_ingestion_ts"].dataType)
    early = [c for c in SATCAT_FIELDS if c != "RCS_SIZE"]
    for rows, fields in ((raw.where(~late), early), (raw.where(late), SATCAT_FIELDS)):
        land_feed(rows, f"{root}/landing", "satcat", fields)
        res = ingest_envelopes(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    return read_bronze(spark, f"{root}/bronze", res.schema).select(*SATCAT_FIELDS)


@register("space_objects_from_bronze")
def _objects_from_bronze(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return silver.space_objects(b["satcat"], b["gp"])


@register("file_inventory")
def _file_inventory(spark, sf_dir):
    """Files of a landing area: one envelope for each month of the catalogue."""
    from .session import scratch_path
    from .sources.adapters import SATCAT_FIELDS, land_feed
    from .sources.export import file_inventory
    root = scratch_path(spark, "inventory")
    land_feed(load_feeds(spark, sf_dir)[0], f"{root}/landing", "satcat", SATCAT_FIELDS)
    return file_inventory(spark, f"{root}/landing", "*.txt") \
        .select("files", (F.col("total_bytes") > 0).alias("has_bytes"))


# Export: written JSON read back, manifest, tables by name -----------------------
def _round_trip(name):
    def run(spark, sf_dir):
        """A gold table exported as JSON and read back with its schema."""
        from .session import scratch_path
        from .sources.export import export_json, read_export
        table = _gold(name, stored_objects(spark, sf_dir))
        base = scratch_path(spark, "export")
        export_json(table, base, name)
        return read_export(spark, base, name, table.schema)
    return run


def _gold(name, objects):
    fn = gold.GOLD_TABLES[name]
    return fn(objects, SNAPSHOT_DATE) if name == "orbital_census" else fn(objects)


QUERIES["export_round_trip"] = _round_trip("decay_tracker")
for _name in gold.GOLD_TABLES:
    if _name != "decay_tracker":
        QUERIES[f"export_round_trip_{_name}"] = _round_trip(_name)


def _export_all(spark, sf_dir):
    from .session import scratch_path
    from .sources.export import export_all
    objects = stored_objects(spark, sf_dir)
    base = scratch_path(spark, "export-all")
    return base, export_all(spark, {n: _gold(n, objects) for n in gold.GOLD_TABLES}, base)


@register("export_manifest")
def _export_manifest(spark, sf_dir):
    """All six gold tables exported; the manifest row."""
    _, (_, manifest) = _export_all(spark, sf_dir)
    # canonical text for the nested columns: sorted list, sorted compact JSON
    return manifest.select(
        F.array_join(F.sort_array("tables"), ",").alias("tables"),
        F.to_json(F.map_from_entries(F.sort_array(F.map_entries("endpoints"))))
         .alias("endpoints"),
        "total_rows")


@register("export_rows")
def _export_rows(spark, sf_dir):
    """Rows of each exported table, counted from what its manifest endpoint holds,
    and whether the export's own count and size agree."""
    base, (results, manifest) = _export_all(spark, sf_dir)
    stated = {r.table: r for r in results}
    parts = [spark.read.text(f"{base}/{path}").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), "rows",
        ((F.col("rows") == stated[name].rows) & F.lit(stated[name].bytes > 0)).alias("agrees"))
        for name, path in sorted(manifest.first()["endpoints"].items())]
    return reduce(DataFrame.unionAll, parts)


@register("named_table")
def _named_table(spark, sf_dir):
    """A gold table written with its layer and loaded by its allow-listed name."""
    from .session import scratch_path
    from .sources.catalog import load_gold, table_properties, write_table
    base = scratch_path(spark, "catalog")
    write_table(gold.country_leaderboard(objects_from_testdata(spark, sf_dir)), base,
                "country_leaderboard", "gold")
    layer = table_properties(spark, base, "country_leaderboard")["layer"]
    return load_gold(spark, base, "country_leaderboard").withColumn("layer", F.lit(layer))


# TLE fields and positions --------------------------------------------------------


@register("tle_fields")
def _tle_fields(spark, sf_dir):
    from .functions.tle import parse_tle
    objects = objects_from_testdata(spark, sf_dir).where("tle_line1 IS NOT NULL")
    return parse_tle(objects.select("norad_cat_id", "tle_line1", "tle_line2"))


def _tle_lines(spark, sf_dir):
    """Complete element lines for every order (fixed values of the adapter)."""
    from .sources.adapters import TLE_LINES_SQL, read_table
    from .session import scratch_path
    path = scratch_path(spark, "tle-lines")
    # stored, or the long text expressions are evaluated again for every field
    spark.sql(TLE_LINES_SQL, orders=read_table(spark, sf_dir, "orders")).write.parquet(path)
    return spark.read.parquet(path)


@register("tle_full_fields")
def _tle_full_fields(spark, sf_dir):
    """Every field of complete lines, with checksums and letter-led numbers."""
    from .functions.tle import parse_tle
    return parse_tle(_tle_lines(spark, sf_dir)).drop("tle_line1", "tle_line2")


@register("globe_positions")
def _globe_positions(spark, sf_dir):
    """Positions straight from element lines: parse, then propagate."""
    from .functions.tle import elements_from_tle
    from .plans.positions import position_grid
    rows = elements_from_tle(_tle_lines(spark, sf_dir))
    return position_grid(rows, POSITION_T0, POSITION_STEPS, POSITION_STEP_SECONDS,
                         keep=["object_id"], digits=GLOBE_DIGITS)


@register("position_grid")
def _position_grid(spark, sf_dir):
    from .plans.positions import position_grid
    return position_grid(objects_from_testdata(spark, sf_dir), POSITION_T0,
                         POSITION_STEPS, POSITION_STEP_SECONDS)


@register("epoch_dates")
def _epoch_dates(spark, sf_dir):
    """Objects by the date part of their element epoch."""
    objects = objects_from_testdata(spark, sf_dir).where("epoch IS NOT NULL")
    return objects.groupBy(classify.iso_date_part("epoch").alias("epoch_date")) \
        .agg(F.count(F.lit(1)).alias("objects"))


# Element history and snapshots -------------------------------------------------


@register("altitude_trend")
def _altitude_trend(spark, sf_dir):
    _, gp_raw = load_feeds(spark, sf_dir)
    return history.altitude_trend(gp_raw)


@register("catalogue_upsert")
def _catalogue_upsert(spark, sf_dir):
    satcat_raw, _ = load_feeds(spark, sf_dir)
    return history.catalogue_upsert(satcat_raw, SNAPSHOT_CUTOFF)


@register("change_feed")
def _change_feed(spark, sf_dir):
    return history.changes_since(load_feeds(spark, sf_dir)[0], SNAPSHOT_CUTOFF)


@register("census_change")
def _census_change(spark, sf_dir):
    return history.census_since(load_feeds(spark, sf_dir)[0], SNAPSHOT_CUTOFF)


@register("raw_quality_report")
def _raw_quality(spark, sf_dir):
    """Expectations on the raw catalogue, where some rows violate them."""
    raw, _ = load_feeds(spark, sf_dir)
    return violation_counts(raw, {"valid_object_id": "OBJECT_ID IS NOT NULL",
                                  "valid_designator": "OBJECT_ID LIKE '____-%'",
                                  "decayed": "DECAY IS NOT NULL"})


_on_objects("growth_by_launch_year", history.growth_by_launch_year)
_on_objects("altitude_inclination_heatmap", history.altitude_inclination_heatmap)


@register("latest_satcat_stream")
def _latest_satcat_stream(spark, sf_dir):
    """Newest catalogue row per id kept current by a stateful stream over the landed
    SATCAT envelopes: two runs on one checkpoint, several micro-batches each."""
    from .session import scratch_path
    from .sources.adapters import SATCAT_FIELDS, land_feed
    from .streaming.bronze import LINEAGE, envelope_stream
    from .streaming.latest import keep_latest, read_latest
    satcat_raw, _ = load_feeds(spark, sf_dir)
    root = scratch_path(spark, "latest-stream")
    late = F.col("_ingestion_ts") >= F.lit(SNAPSHOT_CUTOFF).cast(
        satcat_raw.schema["_ingestion_ts"].dataType)
    for rows in (satcat_raw.where(~late), satcat_raw.where(late)):
        land_feed(rows, f"{root}/landing", "satcat", SATCAT_FIELDS)
        stream = silver.clean_satcat(envelope_stream(
            spark, f"{root}/landing", SATCAT_FIELDS, max_files_per_trigger=24).where("_status = 'ok'"))
        keep_latest(stream, f"{root}/latest", f"{root}/checkpoint", ["norad_cat_id"],
                    silver.recency(LINEAGE))
    return read_latest(spark, f"{root}/latest", ["norad_cat_id"]).select(*silver.SATCAT_COLUMNS)


@register("object_versions")
def _object_versions(spark, sf_dir):
    """SCD2 validity intervals of catalogue attributes over monthly collections."""
    satcat_raw, _ = load_feeds(spark, sf_dir)
    return history.object_versions(satcat_raw, F.date_trunc("month", F.col("_ingestion_ts")))


@register("census_at_dates")
def _census_at_dates(spark, sf_dir):
    """Census of the catalogue at many dates in one pass over its validity intervals."""
    satcat_raw, _ = load_feeds(spark, sf_dir)
    versions = history.object_versions(
        satcat_raw, F.date_trunc("month", F.col("_ingestion_ts")),
        ["object_type", "country", "apogee_km", "perigee_km"])
    return history.census_at(versions.withColumn("orbital_regime", classify.orbital_regime()),
                             CENSUS_DATES)


@register("altitude_trend_history")
def _altitude_trend_history(spark, sf_dir):
    """The trend from the stored history: a backfill, the same rows again, then the
    rows after the cut-off."""
    from .plans.elements import history_trend, load_history
    from .session import scratch_path
    _, gp_raw = load_feeds(spark, sf_dir)
    base = scratch_path(spark, "history")
    cut = F.lit(SNAPSHOT_CUTOFF).cast(gp_raw.schema["_ingestion_ts"].dataType)
    load_history(spark, base, gp_raw.where(F.col("_ingestion_ts") < cut))
    load_history(spark, base, gp_raw.where(
        F.col("_ingestion_ts").between(cut - F.expr("INTERVAL 40 DAYS"), cut)))
    load_history(spark, base, gp_raw.where(F.col("_ingestion_ts") >= cut))
    return history_trend(spark, base)


@register("elements_as_of")
def _elements_as_of(spark, sf_dir):
    """Every object's state in every collection with the elements in force then."""
    from .plans.elements import elements_as_of_collections
    satcat_raw, gp_raw = load_feeds(spark, sf_dir)
    return elements_as_of_collections(satcat_raw, gp_raw,
                                      F.date_trunc("month", F.col("_ingestion_ts")))


@register("decay_ranks")
def _decay_ranks(spark, sf_dir):
    """Display rank of every row of the decay tracker."""
    from .operators.ranking import rank_table
    decay = gold.decay_tracker(objects_from_testdata(spark, sf_dir)).select(
        "norad_cat_id", "object_name", "perigee_km", "decay_risk")
    order = [F.col("perigee_km").asc_nulls_last(), F.col("norad_cat_id").asc_nulls_last()]
    return rank_table(decay, order).ranked()


@register("decay_deep_page")
def _decay_deep_page(spark, sf_dir):
    """The last full page of the ranked decay tracker."""
    from .operators.ranking import rank_table
    decay = gold.decay_tracker(objects_from_testdata(spark, sf_dir)).select(
        "norad_cat_id", "object_name", "perigee_km", "decay_risk")
    order = [F.col("perigee_km").asc_nulls_last(), F.col("norad_cat_id").asc_nulls_last()]
    ranked = rank_table(decay, order)
    return ranked.page(max(ranked.rows // 20 - 1, 0))


@register("owner_enrichment")
def _owner_enrichment(spark, sf_dir):
    """Objects and their owners, joined from two bucketed tables without a shuffle."""
    from .plans.owners import OWNER_COLUMNS, clean_owners, enrich_owners, store_bucketed
    from .session import scratch_path
    from .sources.adapters import load_owners
    root = scratch_path(spark, "bucketed")
    tag = root.rsplit("-", 1)[1]
    objects = store_bucketed(objects_from_testdata(spark, sf_dir).where("norad_cat_id IS NOT NULL"),
                             f"objects_{tag}", f"{root}/objects")
    owners = store_bucketed(clean_owners(load_owners(spark, sf_dir)), f"owners_{tag}",
                            f"{root}/owners")
    return enrich_owners(objects, owners).select(
        "norad_cat_id", "object_name", "object_category", "country", *OWNER_COLUMNS)


# Space weather -------------------------------------------------------------------


@register("clean_readings")
def _clean_readings(spark, sf_dir):
    from .plans.weather import clean_readings
    from .sources.adapters import load_readings
    return clean_readings(load_readings(spark, sf_dir))


@register("clean_readings_stream")
def _clean_readings_stream(spark, sf_dir):
    """The same by a stream with a watermark, over readings that land week by week."""
    from .session import scratch_path
    from .sources.adapters import load_readings
    from .streaming.readings import clean_to_parquet, readings_stream
    raw = load_readings(spark, sf_dir)
    root = scratch_path(spark, "readings")
    days = F.datediff("received", F.lit("2024-01-01").cast("date"))
    for week in range(5):   # the test tables cover 30 days
        part = (days >= 7 * week) if week == 4 else days.between(7 * week, 7 * week + 6)
        raw.where(part).drop("received").write.mode("append").json(f"{root}/landing")
        clean_to_parquet(readings_stream(spark, f"{root}/landing", 4), f"{root}/clean",
                         f"{root}/checkpoint", "8 days")
    return spark.read.parquet(f"{root}/clean").select("series", "time_tag", "value")


@register("solar_weather")
def _solar_weather(spark, sf_dir):
    """Three signals merged hour by hour, the last values carried forward."""
    from .plans.weather import clean_readings, hourly_merge
    from .sources.adapters import load_readings
    return hourly_merge(clean_readings(load_readings(spark, sf_dir)))


@register("storm_impact")
def _storm_impact(spark, sf_dir):
    """Correlation of Kp with drag up to three days later, all lags at once."""
    from .plans.weather import clean_readings, storm_impact
    from .sources.adapters import load_readings
    return storm_impact(clean_readings(load_readings(spark, sf_dir)), STORM_MAX_LAG_HOURS)


# Typed ingest --------------------------------------------------------------------


def _typed_landing(spark, sf_dir):
    """Orders landed as envelopes whose fields have types of their own: whole, with
    fractions, mixed, nested, absent in some records."""
    from .session import scratch_path
    from .sources.adapters import read_table
    from .sources.envelopes import write_envelopes
    orders = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = orders.select(
        k.alias("id"), F.col("o_totalprice").alias("price"),
        F.when(k % 3 == 0, F.expr("parse_json(CAST(o_custkey AS STRING))"))
         .otherwise(F.expr("parse_json('\"c' || o_custkey || '\"')")).alias("mixed"),
        F.struct((k % 5 == 0).alias("urgent"),
                 F.array(F.lit("o"), F.col("o_orderstatus")).alias("tags")).alias("nested"),
        F.col("o_orderpriority").alias("priority"), "o_orderdate", k.alias("_k"))
    path = f"{scratch_path(spark, 'typed')}/landing"
    write_envelopes(rows, path, "orders", ["id", "price", "mixed", "nested", "priority"],
                    collected_at=F.date_trunc("year", F.col("o_orderdate")), seq=F.col("_k"))
    return path


@register("bronze_types")
def _bronze_types(spark, sf_dir):
    """Names and types of the landed fields."""
    from .sources.typed import infer_record_schema
    schema = infer_record_schema(spark, _typed_landing(spark, sf_dir))
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]  # one row a field
    return spark.createDataFrame(rows, "field string, type string")


@register("bronze_typed")
def _bronze_typed(spark, sf_dir):
    """Landed records as columns of the inferred types; mixed and nested fields as JSON."""
    from .sources.typed import infer_record_schema, landed_records, typed_records
    path = _typed_landing(spark, sf_dir)
    rows = typed_records(landed_records(spark, path), infer_record_schema(spark, path))
    return rows.select("id", "price", "priority", F.to_json("mixed").alias("mixed"),
                       F.col("nested.urgent").alias("urgent"),
                       F.array_join("nested.tags", "+").alias("tags"))
