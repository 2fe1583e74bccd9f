import json

import pytest
from conftest import at, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anemos.operators import metrics
from anemos.params import EVENT_LAYOUT, StoreLayout
from anemos.sources import readers, writers

STORE = "dataset_name string, spot_id string, forecast_time timestamp_ntz, wind_speed_10m double"


def test_hourly_payload_files(spark, tmp_path):
    good = {"spot_id": "a", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "wind_speed_10m": [1.0, None]},
            "hourly_units": {"wind_speed_10m": "km/h", "wind_speed_80m": "mph"}}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"spot_id": "b", "hourly": {}, "hourly_units": {}}))
    (tmp_path / "c.json").write_text("{ broken")
    docs = readers.read_hourly_payloads(spark, str(tmp_path)).drop("_corrupt_record")
    hours = readers.hourly_rows(docs)
    assert rows(hours, "spot_id", "time", "wind_speed_10m", "cape") == [("a", at(0), 1.0, None), ("a", at(1), None, None)]
    # A unit counts only for a field that was landed.
    assert rows(readers.hourly_units(docs), "field", "unit") == [("wind_speed_10m", "km/h")]
    spots = spark.createDataFrame([("a",), ("b",), ("c",)], "spot_id string")
    assert rows(readers.missing_entities(spots, hours), "spot_id") == [("b",), ("c",)]


def test_entity_parquet_takes_the_spot_from_the_file_name(spark, tmp_path):
    import pandas as pd

    for name, value in (("a", 1.0), ("b", float("nan"))):
        pd.DataFrame({"wind_speed_10m": [value]}).to_parquet(tmp_path / f"{name}.parquet")
    spots = spark.createDataFrame([("a", 46.0), ("b", 47.0)], "spot_id string, lat double")
    got = readers.read_entity_parquet(spark, str(tmp_path / "*.parquet"), spots)
    assert rows(got, "spot_id", "wind_speed_10m", "lat") == [("a", 1.0, 46.0), ("b", None, 47.0)]


def test_contract_is_checked_before_any_job(spark):
    with pytest.raises(ValueError, match="endpoint"):
        writers.check_contract(spark.createDataFrame([("7", "a", at(0))], "model_version string, spot_id string, prediction_timestamp timestamp_ntz"), EVENT_LAYOUT)


def slice_rows(spark, *entries):
    return spark.createDataFrame([("train", s, at(h), v) for s, h, v in entries], STORE)


def test_second_write_replaces_only_its_slice(spark, tmp_path):
    path = str(tmp_path / "store")
    writers.write_slices(slice_rows(spark, ("u", 0, 1.0), ("u", 1, 2.0), ("s", 0, 3.0)), path)
    writers.write_slices(slice_rows(spark, ("u", 5, 9.0)), path)
    assert rows(readers.read_slice(spark, path, "train", "u"), "time", "wind_speed_10m") == [(at(5), 9.0)]
    assert rows(readers.read_slice(spark, path, "train", "s"), "wind_speed_10m") == [(3.0,)]
    with pytest.raises(FileNotFoundError):
        readers.read_slice(spark, path, "train", "nowhere")
    plan = readers.read_slice(spark, path, "train", "u")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "spot_id" in plan.split("PartitionFilters")[1].split("]")[0]


def test_bucketed_store_keeps_the_other_slices(spark, tmp_path):
    path = str(tmp_path / "store")
    names = [f"s{i}" for i in range(30)]
    writers.replace_slices(slice_rows(spark, *[(n, h, 1.0) for n in names for h in range(3)]), path, 4)
    writers.replace_slices(slice_rows(spark, ("s3", 7, 9.0), ("new", 0, 5.0)), path, 4)
    got = {r.spot_id: (r.n, r.v) for r in spark.read.parquet(path).groupBy("spot_id").agg(F.count("*").alias("n"), F.sum("wind_speed_10m").alias("v")).collect()}
    assert got == {**{n: (3, 3.0) for n in names}, "s3": (1, 9.0), "new": (1, 5.0)}
    one = readers.read_bucketed_slice(spark, path, 4, "train", "s3")
    assert rows(one, "wind_speed_10m") == [(9.0,)] and len(one.inputFiles()) >= 1


def test_day_partitions_and_retention(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([("a", at(24 * d)) for d in range(20)], "spot_id string, t timestamp_ntz")
    writers.write_by_day(df, path, StoreLayout("t", ("spot_id",), 5))
    kept = readers.read_retained(spark, path, 5, F.lit("2024-01-20"))
    assert kept.count() == 5
    assert "PartitionFilters: [isnotnull(day" in kept._jdf.queryExecution().executedPlan().toString()


def test_offline_export_order_and_absence(spark, tmp_path):
    df = slice_rows(spark, ("u", 0, 1.0), ("s", 0, 2.0), ("u", 1, 3.0), ("s", 1, 4.0))
    assert [r.spot_id for r in writers.offline_store(df, "train").collect()] == ["s", "u", "s", "u"]
    with pytest.raises(FileNotFoundError):
        writers.export_offline_store(df, "other", str(tmp_path / "x"))
    for fmt in ("parquet", "csv"):
        writers.write_entity_rows(writers.entity_rows(df, "train"), str(tmp_path / fmt), fmt)
        assert spark.read.option("header", True).format(fmt).load(str(tmp_path / fmt)).count() == 4
    with pytest.raises(ValueError):
        writers.write_entity_rows(df, str(tmp_path / "y"), "orc")


def test_event_log_appends_to_two_places_and_skips_broken_lines(spark, tmp_path):
    history, working = str(tmp_path / "h"), str(tmp_path / "w")
    event = spark.createDataFrame([("t", 1.0)], "prediction_timestamp string, quality_index double")
    writers.append_events(event, history, working)
    writers.append_events(event, history, working)
    (tmp_path / "h" / "extra.json").write_text('{"prediction_timestamp": "u", "quality_index": 2}\n{ broken\n')
    assert readers.read_event_log(spark, history).count() == 3 and readers.read_event_log(spark, working).count() == 2
    with pytest.raises(ValueError):
        writers.append_events(event, history, history + "/")


def test_reports_by_pattern_without_unreadable_files(spark, tmp_path):
    (tmp_path / "feature-pipeline-a.json").write_text(json.dumps({"run_id": "1", "dataset": "train"}))
    (tmp_path / "feature-pipeline-b.json").write_text("{ nope")
    (tmp_path / "training-a.json").write_text(json.dumps({"run_id": "2"}))
    assert rows(readers.read_reports(spark, str(tmp_path), "feature-pipeline-*.json"), "run_id") == [("1",)]


def test_metric_text_file(spark, tmp_path):
    (tmp_path / "m.txt").write_text('# x\nup{job="a"} 0\nup{job="b"} 1\n')
    found = readers.read_metric_text(spark, str(tmp_path))
    assert rows(metrics.select_samples(found, "up", ("job", "=", "a")), "value") == [(0.0,)]


def test_routes(spark):
    df = spark.createDataFrame([('{"routes":[{"duration":1800.0},{"duration":60.0}]}',), ('{"routes":[]}',), ("{",)], "doc string")
    assert rows(df.select(readers.drive_minutes(F.col("doc")).alias("m")), "m") == [(30.0,), (None,), (None,)]
    with pytest.raises(PySparkException, match="no route"):
        df.select(readers.require_route(readers.drive_minutes(F.col("doc")))).collect()


def test_fingerprint_follows_content_only(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    digest = lambda x: writers.table_fingerprint(x, ("id", "v")).first().digest
    assert digest(df) == digest(df.repartition(7)) != digest(df.where("id <> 5"))
    assert digest(df) != digest(df.withColumn("v", F.when(F.col("id") == 3, None).otherwise(F.col("v"))))
    assert digest(df) != digest(df.unionAll(df.limit(1)))
    for name in "ab":
        (tmp_path / f"{name}.bin").write_bytes(name.encode())
    assert readers.file_fingerprints(spark, str(tmp_path)).select("digest").distinct().count() == 2


def test_order_counts_in_the_ordered_fingerprint(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).alias("v"))
    digest = lambda x: writers.ordered_fingerprint(x, ("id",), ("v",)).first()
    swapped = df.withColumn("id", F.when(F.col("id") == 3, 4).when(F.col("id") == 4, 3).otherwise(F.col("id")))
    assert digest(df) == digest(df.repartition(7)) == digest(df.orderBy(F.desc("id")).coalesce(1))
    assert digest(df).digest != digest(swapped).digest and digest(swapped).rows == 200
    assert writers.table_fingerprint(df, ("v",)).first() == writers.table_fingerprint(swapped, ("v",)).first()
    ties = df.withColumn("id", F.lit(1))
    assert digest(ties) == digest(ties.repartition(5)) and digest(df.limit(0)).rows == 0


def test_positions_in_the_whole_table(spark):
    from anemos.operators.ordered import global_positions

    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k")).repartition(6)
    assert rows(global_positions(df, ("k",)), "k", "position") == [(i, i + 1) for i in range(500)]


def test_directory_fingerprint(spark, tmp_path):
    def folder(name, **files):
        (tmp_path / name).mkdir()
        for file, content in files.items():
            (tmp_path / name / file).write_bytes(content)
        return readers.directory_fingerprint(spark, str(tmp_path / name)).first().digest

    one = folder("one", a=b"x", b=b"y")
    assert one == folder("same", b=b"y", a=b"x")
    assert len({one, folder("swapped", a=b"y", b=b"x"), folder("renamed", a=b"x", c=b"y"), folder("more", a=b"x", b=b"y", c=b"z")}) == 4
    assert one == folder("empty", a=b"x", b=b"y", c=b"")  # Spark lists no file without a byte


def land(folder, spot, values, groups=1):
    import pyarrow as pa
    import pyarrow.parquet as pq

    with pq.ParquetWriter(folder / f"{spot}.parquet", pa.schema([("v", pa.float64()), ("note", pa.string())]), write_page_checksum=True,
                          compression="none", use_dictionary=False) as out:
        for k in range(groups):
            part = values[k::groups]
            out.write_table(pa.table({"v": part, "note": [f"n{x}" for x in part]}))


def test_bad_files_are_listed_and_give_no_row(spark, tmp_path):
    for spot in ("good", "torn", "cut", "other", "folder"):
        land(tmp_path, spot, [float(i) for i in range(4000)], 4)
    data = bytearray((tmp_path / "torn.parquet").read_bytes())
    import pyarrow.parquet as pq

    at = pq.ParquetFile(tmp_path / "torn.parquet").metadata.row_group(2).column(0).data_page_offset
    data[at + 40:at + 90] = b"\xff" * 50  # damaged values of the third row group
    (tmp_path / "torn.parquet").write_bytes(data)
    whole = (tmp_path / "cut.parquet").read_bytes()
    (tmp_path / "cut.parquet").write_bytes(whole[:len(whole) // 2])
    (tmp_path / "other.parquet").write_text("this is no parquet file")
    (tmp_path / "void.parquet").write_bytes(b"")
    # A spot of two files, one of them bad: its other rows would be half a delivery.
    (tmp_path / "folder.parquet").rename(tmp_path / "part-0.parquet")
    (tmp_path / "folder.parquet").mkdir()
    (tmp_path / "part-0.parquet").rename(tmp_path / "folder.parquet" / "part-0.parquet")
    (tmp_path / "folder.parquet" / "part-1.parquet").write_text("nothing")
    schema = spark.createDataFrame([], "v double, note string").schema
    found, report = readers.read_isolated(spark, str(tmp_path), schema)
    assert rows(report.groupBy("spot_id", "reason").count(), "spot_id", "reason") == [
        ("cut", "foreign"), ("folder", "foreign"), ("folder", "ok"), ("good", "ok"), ("other", "foreign"), ("torn", "torn")]
    assert rows(found.groupBy("spot_id").agg(F.count("*").alias("n"), F.sum("v").alias("s")), "spot_id", "n", "s") == [("good", 4000, 7998000.0)]
    spots = spark.createDataFrame([(s,) for s in ("good", "torn", "void", "folder", "never")], "spot_id string")
    assert rows(readers.missing_entities(spots, found), "spot_id") == [("folder",), ("never",), ("torn",), ("void",)]
    assert rows(readers.entity_status(spots, report), "spot_id", "status") == [
        ("folder", "foreign"), ("good", "delivered"), ("never", "absent"), ("torn", "torn"), ("void", "absent")]


def test_report_file(spark, tmp_path):
    m = spark.createDataFrame([("rmse", 0.5), ("mae", 0.12345)], "metric string, value double")
    writers.write_evaluation_report(m, str(tmp_path / "report"))
    assert [r.value for r in spark.read.text(str(tmp_path / "report")).collect()] == ["| mae | 0.1235 |", "| rmse | 0.5000 |"]


def test_report_lines(spark):
    m = spark.createDataFrame([("rmse", 0.5), ("mae", 0.12345)], "metric string, value double")
    assert [r.line for r in writers.evaluation_report(m).collect()] == ["| mae | 0.1235 |", "| rmse | 0.5000 |"]


def test_delivered_files_hold_all_events(spark):
    from conftest import SMALL

    from anemos.plans.bindings import Tables
    from anemos.plans.source_queries import delivered

    events = Tables(spark, SMALL).table("events").select("user_id", "event_type").collect()
    signed = {r["user_id"] for r in events if r["event_type"] == "signup"}
    want = sum(r["user_id"] in signed and r["user_id"] % 4 != 0 for r in events)
    assert delivered(Tables(spark, SMALL))[0].count() == want > sum(r["event_type"] == "signup" for r in events)


def test_bad_files_of_many_spots_take_their_spots_along(spark, tmp_path):
    for delivery, spots in (("one", "ab"), ("two", "cd"), ("three", "de"), ("four", "f")):
        spark.createDataFrame([(s, float(i)) for s in spots for i in range(3)], "spot_id string, v double").coalesce(1).write.parquet(
            str(tmp_path / f"{delivery}.parquet"))
    for part in (tmp_path / "three.parquet").glob("part-*"):
        part.write_text("this is no parquet file")
    spark.createDataFrame([("f", 9.0)], "spot_id string, v double").coalesce(1).write.parquet(str(tmp_path / "five.parquet"))
    next((tmp_path / "four.parquet").glob("part-*")).with_name("part-more.parquet").write_text("nothing")
    manifest = spark.createDataFrame([("one", "a"), ("one", "b"), ("two", "c"), ("two", "d"), ("three", "d"), ("three", "e"), ("six", "g")],
                                     "delivery string, spot_id string")
    schema = spark.createDataFrame([], "spot_id string, v double").schema
    found, report = readers.read_isolated(spark, str(tmp_path), schema, manifest)
    # The manifest says that d and e were in the broken file; f is named nowhere, but stands in a folder with a broken file.
    assert rows(found.groupBy("spot_id").agg(F.count("*").alias("n")), "spot_id", "n") == [("a", 3), ("b", 3), ("c", 3)]
    spots = spark.createDataFrame([(s,) for s in "abcdefgh"], "spot_id string")
    assert rows(readers.entity_status(spots, report), "spot_id", "status") == [
        ("a", "delivered"), ("b", "delivered"), ("c", "delivered"), ("d", "foreign"), ("e", "foreign"), ("f", "foreign"), ("g", "absent"), ("h", "absent")]


def test_files_grow_with_rows_not_with_spots(spark, tmp_path, monkeypatch):
    from anemos.plans import source_queries

    monkeypatch.setattr(source_queries, "SPOTS_PER_FILE", 50)
    events = spark.range(0, 1200, 1, 6).select(F.concat(F.lit("s"), F.col("id") % 300).alias("spot_id"), (F.col("id") % 300).alias("user_id"))
    manifest = source_queries.land_deliveries(events, "user_id % 4 = 0", str(tmp_path / "landed"))
    files = [f for f in (tmp_path / "landed").rglob("part-*") if f.is_file()]
    assert len(files) <= 12 and manifest.count() == 300
    found, report = readers.read_isolated(spark, str(tmp_path / "landed"), events.schema, manifest)
    assert found.count() == 900 and rows(report.groupBy("reason").count(), "reason", "count") == [("foreign", 75), ("ok", 225)]
