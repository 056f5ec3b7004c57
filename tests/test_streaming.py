"""Bronze stream: new files once, schema evolution, rerun adds nothing."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from compare import SF_CHECK
from skyledger.plans import silver
from skyledger.plans.pipeline import objects_from_testdata
from skyledger.streaming.bronze import (CorruptEnvelopes, ingest_envelopes, read_bronze,
                                        read_quarantine)


def _envelope(path, collected_at, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump({"source": "spacetrack", "dataset": "satcat", "collected_at": collected_at,
                   "record_count": len(records), "data": records}, f, indent=2)


def test_stream_new_files_once_and_schema_evolution(spark, scratch):
    landing, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    _envelope(f"{landing}/2024-01-01/a.json", "2024-01-01T00:00:00Z",
              [{"NORAD_CAT_ID": "1", "SATNAME": "A"}, {"NORAD_CAT_ID": "2", "SATNAME": None}])
    r1 = ingest_envelopes(spark, landing, bronze, ckpt)
    assert r1.envelopes == 1
    assert read_bronze(spark, bronze).count() == 2

    # second file with a new field: the schema widens, old rows read back null
    _envelope(f"{landing}/2024-01-02/b.json", "2024-01-02T00:00:00Z",
              [{"NORAD_CAT_ID": "1", "SATNAME": "A2", "RCS_SIZE": "LARGE"}])
    r2 = ingest_envelopes(spark, landing, bronze, ckpt)
    assert r2.envelopes == 1
    assert "RCS_SIZE" in r2.schema.fieldNames()
    df = read_bronze(spark, bronze)
    rows = {(r.NORAD_CAT_ID, r.SATNAME, r.RCS_SIZE, r._record_index) for r in df.collect()}
    assert rows == {("1", "A", None, 0), ("2", None, None, 1), ("1", "A2", "LARGE", 0)}
    assert df.where(F.col("_source_file").endswith("b.json")).count() == 1

    # reading with the stream's schema equals merging the file footers
    typed = read_bronze(spark, bronze, r2.schema)
    assert sorted(map(tuple, typed.select(df.columns).collect())) == sorted(map(tuple, df.collect()))

    # rerun with nothing new reads nothing and writes nothing
    r3 = ingest_envelopes(spark, landing, bronze, ckpt)
    assert r3.envelopes == 0
    assert read_bronze(spark, bronze).count() == 3


def test_empty_data_array_gives_no_rows(spark, scratch):
    landing, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    _envelope(f"{landing}/x/a.json", "2024-01-01T00:00:00Z", [{"NORAD_CAT_ID": "9"}])
    _envelope(f"{landing}/x/b.json", "2024-01-02T00:00:00Z", [])
    r = ingest_envelopes(spark, landing, bronze, ckpt)
    assert r.envelopes == 2
    assert read_bronze(spark, bronze).count() == 1


def test_objects_from_bronze_equal_direct_objects(spark):
    import __spark_entry__ as E
    from_bronze = E.queries()["space_objects_from_bronze"](spark, SF_CHECK)
    direct = objects_from_testdata(spark, SF_CHECK)
    cols = silver.OBJECT_COLUMNS
    assert from_bronze.select(cols).exceptAll(direct.select(cols)).count() == 0
    assert direct.select(cols).exceptAll(from_bronze.select(cols)).count() == 0


def test_stateful_stream_keeps_newest_over_batches_and_restarts(spark, scratch):
    from skyledger.streaming.bronze import envelope_stream
    from skyledger.streaming.latest import keep_latest, newest_rows, read_latest
    landing, target, ckpt = f"{scratch}/landing", f"{scratch}/latest", f"{scratch}/ckpt"
    order = F.struct("_collected_at", "_source_file", "_record_index")

    def run():
        stream = envelope_stream(spark, landing, ["NORAD_CAT_ID", "SATNAME"],
                                 max_files_per_trigger=1).where("_status = 'ok'") \
            .drop("_rescued", "_status", "_ingestion_ts")
        return keep_latest(stream, target, ckpt, ["NORAD_CAT_ID"], order)

    def held():
        return {(r.NORAD_CAT_ID, r.SATNAME)
                for r in read_latest(spark, target, ["NORAD_CAT_ID"]).collect()}

    _envelope(f"{landing}/a/1.json", "2024-01-01T00:00:00Z",
              [{"NORAD_CAT_ID": "1", "SATNAME": "A"}, {"NORAD_CAT_ID": "2", "SATNAME": "B"}])
    _envelope(f"{landing}/a/2.json", "2024-01-02T00:00:00Z",
              [{"NORAD_CAT_ID": "1", "SATNAME": "A2"}, {"NORAD_CAT_ID": "1", "SATNAME": "A3"}])
    run()   # two files, one per micro-batch
    assert held() == {("1", "A3"), ("2", "B")}
    _envelope(f"{landing}/a/3.json", "2023-12-31T00:00:00Z",   # late, older collection
              [{"NORAD_CAT_ID": "2", "SATNAME": "OLD"}, {"NORAD_CAT_ID": "3", "SATNAME": "C"}])
    run()   # a new query on the same checkpoint goes on from the stored state
    want = {("1", "A3"), ("2", "B"), ("3", "C")}
    assert held() == want
    run()   # nothing new
    assert held() == want
    # a micro-batch that is written again after a failure changes nothing
    last = max(d for d in os.listdir(target) if d.startswith("batch="))
    rows = spark.read.parquet(f"{target}/{last}").collect()
    spark.createDataFrame(rows, spark.read.parquet(f"{target}/{last}").schema) \
        .write.mode("overwrite").parquet(f"{target}/{last}")
    assert held() == want
    # the same aggregate on a batch table
    batch = spark.createDataFrame([("x", 1, "old"), ("x", 2, "new"), (None, 1, "n")],
                                  "k string, t int, v string")
    assert {(r.k, r.v) for r in newest_rows(batch, ["k"], F.col("t")).collect()} == \
        {("x", "new"), (None, "n")}


def test_late_readings_are_dropped_and_counted(spark, scratch):
    from skyledger.streaming.readings import clean_to_parquet, readings_stream
    landing, target, ckpt = f"{scratch}/landing", f"{scratch}/clean", f"{scratch}/ckpt"

    def land(name, rows):
        os.makedirs(landing, exist_ok=True)
        with open(f"{landing}/{name}.json", "w") as f:
            for i, (series, at, value) in enumerate(rows):
                f.write(json.dumps({"series": series, "time_tag": at, "value": value,
                                    "reading_id": i}) + "\n")

    def run():
        return clean_to_parquet(readings_stream(spark, landing, 1), target, ckpt, "2 hours")

    land("a", [("kp", "2024-05-10 00:10:00", "3.5"), ("kp", "2024-05-10 00:10:00", "3.5"),
               ("kp", "2024-05-10 09:00:00", "bad"), ("kp", "unknown", "1"), ("kp", None, "1"),
               ("wind", "2024-05-10 00:10:00", "400"), ("wind", "2024-05-10 10:00:00", "NaN")])
    assert run().late == 0
    land("b", [("kp", "2024-05-10 12:00:00", "6"), ("kp", "2024-05-10 00:20:00", "4")])
    assert run().late == 0   # not late yet: the newest time seen was 00:10
    land("c", [("kp", "2024-05-10 09:59:00", "9"),       # over two hours behind 12:00
               ("kp", "2024-05-10 10:30:00", "8"),       # within
               ("kp", "2024-05-10 12:00:00", "6")])      # sent again
    assert run().late == 1
    got = sorted((r.series, str(r.time_tag)[11:16], r.value)
                 for r in spark.read.parquet(target).collect())
    assert got == [("kp", "00:10", 3.5), ("kp", "00:20", 4.0), ("kp", "10:30", 8.0),
                   ("kp", "12:00", 6.0), ("wind", "00:10", 400.0)]


def test_latest_stream_equals_batch_dedup(spark):
    import __spark_entry__ as E
    from skyledger.sources.adapters import load_feeds
    streamed = E.queries()["latest_satcat_stream"](spark, SF_CHECK)
    batch = silver.latest_satcat(load_feeds(spark, SF_CHECK)[0])
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_latest_state_has_a_partition_a_core_at_most(spark, scratch):
    """Every micro-batch commits and writes each of them.  A restart with other settings
    goes on with the state that is there; the session's setting stays as it was."""
    from skyledger.session import settings
    from skyledger.streaming.latest import keep_latest, read_latest
    landing, schema = f"{scratch}/in", "k int, at int, v string"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(landing)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(landing)
        keep_latest(stream, f"{scratch}/out", f"{scratch}/ckpt", ["k"], F.struct("at"))
        return {tuple(r) for r in read_latest(spark, f"{scratch}/out", ["k"]).collect()}

    cores = spark.sparkContext.defaultParallelism
    with settings(spark, {"spark.sql.shuffle.partitions": str(5 * cores)}):
        first = run([(i, 1, "a") for i in range(300)] + [(None, 1, "n"), (None, 2, "o")])
        assert first == {(i, 1, "a") for i in range(300)} | {(None, 2, "o")}
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(5 * cores)
    states = [p for p in os.listdir(f"{scratch}/ckpt/state/0") if p.isdigit()]
    assert len(states) == cores
    again = run([(7, 2, "b"), (8, 0, "late"), (300, 1, "new"), (None, 1, "late")])
    assert again == first - {(7, 1, "a")} | {(7, 2, "b"), (300, 1, "new")}
    assert len([p for p in os.listdir(f"{scratch}/ckpt/state/0") if p.isdigit()]) == cores


def _paths(scratch):
    return f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"


def _read(spark, bronze, *columns):
    return {tuple(r) for r in read_bronze(spark, bronze).select(*columns).collect()}


def test_an_old_file_is_read_whatever_its_age(spark, scratch):
    landing, bronze, ckpt = _paths(scratch)
    _envelope(f"{landing}/x/a.json", "2024-01-09T00:00:00Z", [{"ID": "1"}])
    _envelope(f"{landing}/x/b.json", "2024-01-01T00:00:00Z", [{"ID": "2"}])
    old = time.time() - 8 * 86400
    os.utime(f"{landing}/x/b.json", (old, old))
    assert ingest_envelopes(spark, landing, bronze, ckpt).envelopes == 2
    assert _read(spark, bronze, "ID") == {("1",), ("2",)}


def test_a_new_field_in_a_file_with_an_old_time_is_kept(spark, scratch):
    landing, bronze, ckpt = _paths(scratch)
    _envelope(f"{landing}/x/a.json", "2024-01-01T00:00:00Z", [{"ID": "1"}])
    ingest_envelopes(spark, landing, bronze, ckpt)
    _envelope(f"{landing}/x/b.json", "2024-01-02T00:00:00Z", [{"ID": "2", "NEW": "n"}])
    old = time.time() - 3600
    os.utime(f"{landing}/x/b.json", (old, old))
    r = ingest_envelopes(spark, landing, bronze, ckpt)
    assert r.schema.fieldNames() == ["ID", "NEW"]
    assert _read(spark, bronze, "ID", "NEW") == {("1", None), ("2", "n")}
    _envelope(f"{landing}/x/c.json", "2024-01-03T00:00:00Z", [{"ID": "3", "NEW": "m"}])
    ingest_envelopes(spark, landing, bronze, ckpt)  # now it has a column of its own
    assert _read(spark, bronze, "ID", "NEW") == {("1", None), ("2", "n"), ("3", "m")}


def test_only_empty_collections_on_the_first_and_a_later_run(spark, scratch):
    landing, bronze, ckpt = _paths(scratch)
    _envelope(f"{landing}/x/a.json", "2024-01-01T00:00:00Z", [])
    assert ingest_envelopes(spark, landing, bronze, ckpt).envelopes == 1
    _envelope(f"{landing}/x/b.json", "2024-01-02T00:00:00Z", [{"ID": "1"}])
    assert ingest_envelopes(spark, landing, bronze, ckpt).records == 1
    _envelope(f"{landing}/x/c.json", "2024-01-03T00:00:00Z", [])
    r = ingest_envelopes(spark, landing, bronze, ckpt)
    assert (r.envelopes, r.records) == (1, 0)
    assert _read(spark, bronze, "ID") == {("1",)}


def test_a_field_that_changes_its_type_stays_readable(spark, scratch):
    landing, bronze, ckpt = _paths(scratch)
    _envelope(f"{landing}/x/a.json", "2024-01-01T00:00:00Z", [{"ID": 1, "V": 2.5}])
    ingest_envelopes(spark, landing, bronze, ckpt)
    _envelope(f"{landing}/x/b.json", "2024-01-02T00:00:00Z", [{"ID": "2", "V": "high"},
                                                            {"ID": "3", "V": {"a": [1]}}])
    ingest_envelopes(spark, landing, bronze, ckpt)
    assert _read(spark, bronze, "ID", "V") == {("1", "2.5"), ("2", "high"), ("3", '{"a":[1]}')}


def test_broken_files_are_reported_and_kept_apart(spark, scratch):
    landing, bronze, ckpt = _paths(scratch)
    _envelope(f"{landing}/x/good.json", "2024-01-01T00:00:00Z", [{"ID": "1"}])
    _envelope(f"{landing}/x/cut.json", "2024-01-01T00:00:00Z", [{"ID": "2"}] * 50)
    with open(f"{landing}/x/cut.json", "r+") as f:
        f.truncate(400)
    with open(f"{landing}/x/short.json", "w") as f:
        json.dump({"collected_at": "2024-01-01T00:00:00Z", "record_count": 3,
                   "data": [{"ID": "7"}]}, f)
    with pytest.raises(CorruptEnvelopes) as err:
        ingest_envelopes(spark, landing, bronze, ckpt)
    assert err.value.files == 2
    assert _read(spark, bronze, "ID") == {("1",)}
    held = {(r._status, os.path.basename(r._source_file))
            for r in read_quarantine(spark, bronze).collect()}
    assert held == {("corrupt", "cut.json"), ("count", "short.json")}
    assert ingest_envelopes(spark, landing, bronze, ckpt).envelopes == 0


def test_counts_cover_more_batches_than_progress_keeps(spark, scratch):
    landing, bronze, ckpt = _paths(scratch)
    for i in range(5):
        _envelope(f"{landing}/x/{i}.json", "2024-01-01T00:00:00Z", [{"ID": str(i)}])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        r = ingest_envelopes(spark, landing, bronze, ckpt, max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (r.envelopes, r.records) == (5, 5)


def test_a_late_file_with_an_older_collection_does_not_replace_a_newer_row(spark):
    rows = [("1", "old", "2024-01-09T00:00:00Z", "2024-01-09 01:00:00"),
            ("1", "late", "2024-01-02T00:00:00Z", "2024-02-01 00:00:00"),
            ("1", "offset", "2024-01-09T03:00:00+04:00", "2024-01-10 00:00:00")]
    raw = spark.createDataFrame(rows, "NORAD_CAT_ID string, SATNAME string, _collected_at string, "
                                      "ts string")
    for c in ("OBJECT_ID", "OBJECT_TYPE", "COUNTRY", "LAUNCH", "DECAY", "PERIOD", "APOGEE",
              "PERIGEE", "RCS_SIZE", "CURRENT_FLAG"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    raw = raw.withColumn("_ingestion_ts", F.to_timestamp("ts"))
    assert silver.latest_satcat(raw).first().object_name == "old"


def test_exploded_records_do_not_carry_the_array_of_their_file(spark, scratch, capsys):
    from skyledger.streaming.bronze import envelope_stream
    _envelope(f"{scratch}/landing/a.json", "2024-01-01T00:00:00Z", [{"ID": "1"}])
    envelope_stream(spark, f"{scratch}/landing", ["ID"]).explain()
    line, = [x for x in capsys.readouterr().out.splitlines() if "Generate posexplode" in x]
    assert line.count("data#") == 1   # the generator's own input only


def test_a_file_is_not_opened_again_for_each_record(spark, scratch):
    from skyledger.sources.envelopes import field_names
    from skyledger.streaming.bronze import envelope_stream
    records = [{"ID": str(i), "V": "v" * 300} for i in range(5000)]
    _envelope(f"{scratch}/landing/a.json", "2024-01-01T00:00:00Z", records)
    size = os.path.getsize(f"{scratch}/landing/a.json")
    assert field_names(spark, f"{scratch}/landing") == ["ID", "V"]
    before = _bytes_read(spark)
    q = envelope_stream(spark, f"{scratch}/landing", ["ID", "V"]).writeStream.format("noop") \
        .option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert size <= _bytes_read(spark) - before < 1.5 * size


def _bytes_read(spark):
    statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in statistics)


def test_odd_envelopes_read_as_by_a_multiline_reader(spark, scratch):
    from skyledger.sources.envelopes import CORRUPT, ENVELOPE, ENVELOPE_FILES
    head = '{"collected_at":"t","record_count":1,\n "data": ['
    texts = {"numbers": head + '{"a": 1.10,"b":1e400 , "c":12345678901234567890.50,"d":NaN}]}',
             "escapes": head + '{"a":"\\u00e9\\ud800 \\/ é ", "a" : "again"}, null, "x", 7, [1 , 2]]}',
             "no records": '﻿\n{"collected_at":null,"data":[]}\n\n',
             "two": '[{"collected_at":"p","data":[{"a":1}]},\r\n {"collected_at":"q"}]',
             "cut": head + '{"a":"1"},{"a":', "text": "not json", "empty": "", "blank": " \n "}
    os.makedirs(f"{scratch}/landing/x")
    for name, text in texts.items():
        with open(f"{scratch}/landing/x/{name}.json", "w", newline="") as f:
            f.write(text)
    with open(f"{scratch}/landing/x/wide.json", "wb") as f:
        f.write('{"collected_at":"é","record_count":0,"data":[]}'.encode("utf-16"))

    def read(**options):
        rows = spark.read.schema(ENVELOPE).options(**options).json(f"{scratch}/landing") \
            .select(F.regexp_extract("_metadata.file_path", "[^/]+$", 0), "collected_at",
                    "record_count", "data", F.col(CORRUPT).isNotNull())
        return sorted(map(str, rows.collect()))

    assert read(**ENVELOPE_FILES) == read(multiLine=True, columnNameOfCorruptRecord=CORRUPT,
                                          recursiveFileLookup=True)


def test_records_in_an_envelope_follow_their_order_then_their_number(spark, scratch):
    from skyledger.sources.envelopes import write_envelopes
    rows = spark.createDataFrame([(3, "b", "x"), (1, "b", "y"), (2, None, "z"), (4, "a", None)],
                                 "n long, o string, V string")
    write_envelopes(rows, f"{scratch}/l", "d", ["V"], F.lit("2024-01-01").cast("timestamp"),
                    F.col("n"), [F.col("o")])
    line, = spark.read.text(f"{scratch}/l").select("value").collect()
    assert [r["V"] for r in json.loads(line.value)["data"]] == ["z", None, "y", "x"]


def test_totals_of_a_run_are_counted_by_file_not_over_expanded_rows(spark, capsys):
    from skyledger.streaming.bronze import run_totals
    rows = spark.createDataFrame(
        [("ok", "a", None), ("ok", "a", {"N": "1"}), ("count", "c", None), ("count", "c", None),
         ("corrupt", "b", None), ("empty", "d", None), ("ok", "b", None)],
        "_status string, _source_file string, _rescued map<string,string>")
    assert run_totals(rows).first() == (4, 3, 1, 2, "b")
    assert run_totals(rows.where("false")).first() == (0, 0, 0, 0, None)
    run_totals(rows).explain()
    assert "Expand" not in capsys.readouterr().out


def test_files_of_a_batch_are_not_listed_by_a_task_each(spark, scratch):
    landing, bronze, ckpt = _paths(scratch)
    files = 8 * spark.sparkContext.defaultParallelism
    for i in range(files):
        _envelope(f"{landing}/x/{i}.json", "2024-01-01T00:00:00Z", [{"ID": str(i)}])
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting, None)
    first = _last_stage(spark)
    r = ingest_envelopes(spark, landing, bronze, ckpt)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(i) for i in range(first + 1, _last_stage(spark))]
    assert (r.envelopes, r.records) == (files, files)
    assert 0 < max(x.numTasks for x in stages if x) < files
    assert spark.conf.get(setting, None) == before


def _last_stage(spark):
    sc = spark.sparkContext
    group = f"mark-{time.time()}"
    sc.setJobGroup(group, "")
    sc.parallelize([1], 1).count()
    sc.setLocalProperty("spark.jobGroup.id", None)
    job, = sc.statusTracker().getJobIdsForGroup(group)
    return max(sc.statusTracker().getJobInfo(job).stageIds)
