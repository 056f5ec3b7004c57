"""Edge semantics of SURVEY 2.12 on small hand-made feeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skyledger.plans import gold, silver

SAT_COLS = ["NORAD_CAT_ID", "SATNAME", "OBJECT_ID", "OBJECT_TYPE", "COUNTRY", "LAUNCH",
            "DECAY", "PERIOD", "APOGEE", "PERIGEE", "RCS_SIZE", "CURRENT_FLAG"]
GP_COLS = ["NORAD_CAT_ID", "EPOCH", "MEAN_MOTION", "ECCENTRICITY", "INCLINATION",
           "RA_OF_ASC_NODE", "ARG_OF_PERICENTER", "MEAN_ANOMALY", "BSTAR", "REV_AT_EPOCH",
           "TLE_LINE1", "TLE_LINE2"]
T0 = dt.datetime(2024, 1, 1)


def satcat(spark, rows):
    """rows: dicts of overrides; day offset ``t`` gives _ingestion_ts."""
    base = dict(NORAD_CAT_ID="1", SATNAME="X", OBJECT_ID="2000-001A", OBJECT_TYPE="DEBRIS",
                COUNTRY="US", LAUNCH="2000-01-01", DECAY=None, PERIOD="90.0", APOGEE="500",
                PERIGEE="400", RCS_SIZE="SMALL", CURRENT_FLAG="Y")
    data = []
    for i, r in enumerate(rows):
        d = {**base, **{k: v for k, v in r.items() if k != "t"}}
        data.append(tuple(d[c] for c in SAT_COLS) + (T0 + dt.timedelta(days=r.get("t", 0)), i))
    schema = ", ".join(f"{c} string" for c in SAT_COLS) + ", _ingestion_ts timestamp_ntz, _seq long"
    return spark.createDataFrame(data, schema)


def gp(spark, rows):
    base = dict(NORAD_CAT_ID="1", EPOCH="2024-01-01T00:00:00", MEAN_MOTION="15.0",
                ECCENTRICITY="0.001", INCLINATION="51.6", RA_OF_ASC_NODE="10",
                ARG_OF_PERICENTER="20", MEAN_ANOMALY="30", BSTAR="0.0001", REV_AT_EPOCH="1",
                TLE_LINE1="1 x", TLE_LINE2="2 x")
    data = []
    for i, r in enumerate(rows):
        d = {**base, **{k: v for k, v in r.items() if k != "t"}}
        data.append(tuple(d[c] for c in GP_COLS) + (T0 + dt.timedelta(days=r.get("t", 0)), i))
    schema = ", ".join(f"{c} string" for c in GP_COLS) + ", _ingestion_ts timestamp_ntz, _seq long"
    return spark.createDataFrame(data, schema)


def test_raw_string_ids_differ_in_fragmentation_only(spark):
    raw = satcat(spark, [{"NORAD_CAT_ID": "5"}, {"NORAD_CAT_ID": "05"}] +
                 [{"NORAD_CAT_ID": str(100 + i)} for i in range(8)])
    ev = silver.fragmentation_events(raw).collect()
    assert [(r.launch_id, r.debris_count) for r in ev] == [("2000-001", 10)]
    objects = silver.space_objects(raw, gp(spark, []))
    assert objects.where("norad_cat_id = 5").count() == 1


def test_unparsed_and_missing_launch_ids_are_groups(spark):
    rows = ([{"NORAD_CAT_ID": str(i), "OBJECT_ID": "BAD"} for i in range(10)]
            + [{"NORAD_CAT_ID": str(100 + i), "OBJECT_ID": None} for i in range(10)]
            + [{"NORAD_CAT_ID": str(200 + i), "COUNTRY": "US" if i < 10 else "RU"}
               for i in range(20)])
    ev = {(r.launch_id, r.country): (r.debris_count, r.severity)
          for r in silver.fragmentation_events(satcat(spark, rows)).collect()}
    assert ev == {("", "US"): (10, "minor"), (None, "US"): (10, "minor"),
                  ("2000-001", "US"): (10, "minor"), ("2000-001", "RU"): (10, "minor")}


def test_newest_row_wins_and_ties_break_on_seq(spark):
    raw = satcat(spark, [{"SATNAME": "old", "t": 0}, {"SATNAME": "new-a", "t": 1},
                         {"SATNAME": "new-b", "t": 1}])
    assert silver.latest_satcat(raw).first().object_name == "new-b"


def test_null_epoch_sorts_last_and_left_join_keeps_objects(spark):
    sat = satcat(spark, [{"NORAD_CAT_ID": "1"}, {"NORAD_CAT_ID": "2"}])
    el = gp(spark, [{"NORAD_CAT_ID": "1", "EPOCH": "2024-01-02T00:00:00", "MEAN_MOTION": "14.0"},
                    {"NORAD_CAT_ID": "1", "EPOCH": "garbage", "MEAN_MOTION": "13.0", "t": 5},
                    {"NORAD_CAT_ID": None, "MEAN_MOTION": "12.0"}])
    rows = {r.norad_cat_id: r for r in silver.space_objects(sat, el).collect()}
    assert rows[1].mean_motion == 14.0          # a parsable epoch beats a newer null one
    assert rows[2].mean_motion is None and rows[2].epoch is None   # kept without elements
    assert set(rows) == {1, 2}                  # the null-id element row joins nothing


def test_null_apogee_and_decayed_objects(spark):
    raw = satcat(spark, [
        {"NORAD_CAT_ID": "1", "APOGEE": None, "OBJECT_TYPE": "PAYLOAD"},
        {"NORAD_CAT_ID": "2", "APOGEE": "-1", "PERIGEE": "-5"},
        {"NORAD_CAT_ID": "3", "DECAY": "2020-01-01", "PERIGEE": "150"},
        {"NORAD_CAT_ID": "4", "PERIGEE": "150"}])
    objects = silver.space_objects(raw, gp(spark, [{"NORAD_CAT_ID": str(i)} for i in range(1, 5)]))
    bands = {r.altitude_band_km: r.total_objects for r in gold.congestion_metrics(objects).collect()}
    assert bands == {-50: 1, 500: 2}            # null apogee dropped, -1 floors to -50
    assert gold.country_leaderboard(objects).first().total_objects == 4   # kept in A6
    assert gold.orbital_census(objects).agg(F.sum("object_count")).first()[0] == 4
    decay = {r.norad_cat_id: r.decay_risk for r in gold.decay_tracker(objects).collect()}
    assert decay == {2: "imminent", 4: "imminent"}   # decayed object 3 excluded


def test_object_versions_runs_and_validity(spark):
    from skyledger.plans.history import object_versions
    rows = [{"SATNAME": "A", "t": 0}, {"SATNAME": "A", "t": 40},     # same state, later month
            {"SATNAME": "B", "t": 70}, {"SATNAME": "B-old", "t": 69},  # same month: newest wins
            {"SATNAME": "A", "t": 100},
            {"NORAD_CAT_ID": "2", "SATNAME": "Z", "t": 0}]
    raw = satcat(spark, rows)
    v = object_versions(raw, F.date_trunc("month", F.col("_ingestion_ts")))
    got = [(r.norad_cat_id, r.object_name, r.valid_from.date().isoformat(),
            r.valid_to.date().isoformat() if r.valid_to else None, r.is_current)
           for r in v.orderBy("norad_cat_id", "valid_from").collect()]
    assert got == [
        (1, "A", "2024-01-01", "2024-03-01", False),
        (1, "B", "2024-03-01", "2024-04-01", False),
        (1, "A", "2024-04-01", None, True),
        (2, "Z", "2024-01-01", None, True),
    ]
