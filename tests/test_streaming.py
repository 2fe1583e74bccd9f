"""Each stream gives its batch twin's answer when it has read the same files."""

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from anemos.operators.features import wind_steadiness
from anemos.operators.ordered import Series
from anemos.plans import stream_queries as sq
from anemos.plans.bindings import READINGS
from anemos.plans.catalog import QUERIES
from anemos.streaming import jobs


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """The events in eight files, in time order, read one file per micro-batch."""
    path = tmp_path_factory.mktemp("feed")
    events = spark.read.parquet(f"{SMALL}/events.parquet").where("ts < TIMESTAMP_NTZ '2024-01-20'").orderBy("ts").toPandas()
    size = len(events) // 8 + 1
    for i in range(8):
        events.iloc[i * size:(i + 1) * size].to_parquet(path / f"{i:02d}.parquet", coerce_timestamps="us", index=False)
    static = spark.read.parquet(str(path))
    stream = lambda: spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(str(path))
    return static, stream


def run_closed(spark, job, stream, name, **paths):
    end = jobs.end_folder(spark)
    return jobs.run_to_table(job(jobs.with_end(sq.requests(stream), "ts", end)), name, end=end, **paths)


def test_ingest(feed):
    static, stream = feed
    out = jobs.run_to_table(jobs.ingest_events(sq.repeated_events(stream())), "t-ingest")
    twin = jobs.ingest_events(sq.repeated_events(static))
    assert rows(out, "seq") == rows(twin, "seq")
    assert twin.where("prediction_timestamp IS NULL").count() > 0


def test_different_events_of_one_time_model_and_spot_stay(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet").where("event_id < 60")
    events.unionAll(events.withColumns({"event_id": F.col("event_id") + 100_000, "user_id": F.col("user_id") + 1500})).coalesce(1).write.parquet(
        str(tmp_path / "written"))
    (part,) = (tmp_path / "written").glob("*.parquet")
    (tmp_path / "events.parquet").write_bytes(part.read_bytes())
    got = QUERIES["stream_event_ingest"](spark, str(tmp_path)).where("prediction_timestamp IS NOT NULL")
    assert sorted(r.seq for r in got.collect()) == [n for k in (0, 100_000) for n in range(k, k + 60) if n % 101]


def sessions(df):
    return jobs.alert_sessions(df, F.col("value") > 20, "2 hours", 15)


WINDOWED = [(jobs.request_counts, ("window_start", "endpoint", "requests")),
            (lambda df: jobs.error_rate(df, 0.001), ("window_start", "endpoint", "requests", "errors")),
            (sessions, ("endpoint", "breach_start", "breach_end", "samples"))]


@pytest.mark.parametrize("job, names", WINDOWED)
def test_windows_to_the_end(spark, feed, job, names):
    static, stream = feed
    out = run_closed(spark, job, stream(), "t-windows")
    twin = job(sq.requests(static))
    assert rows(out, *names) == rows(twin, *names) and out.count() > 5


def plain_sessions(samples, gap, hold):
    """Sessions by the row: (endpoint, start, end, samples)."""
    out = []
    for endpoint, ts in sorted(samples):
        if out and out[-1][0] == endpoint and ts < out[-1][2] + gap:
            out[-1] = (endpoint, out[-1][1], ts, out[-1][3] + 1)
        else:
            out.append((endpoint, ts, ts, 1))
    return [s for s in out if s[2] - s[1] >= hold]


SAMPLE = "ts timestamp, endpoint string, value double"


def hot_samples():
    """One endpoint holds nearly all samples; gaps a little below, at and above half an hour, and ties."""
    import random
    from datetime import timedelta

    from conftest import START

    rng, minute, out, ts = random.Random(3), timedelta(minutes=1), [], START
    for _ in range(600):
        ts += rng.choice([0, 1, 7, 29, 30, 31, 59, 60, 61, 200]) * minute + rng.choice([-1, 0, 0, 1]) * timedelta(microseconds=1)
        out += [("hot", ts)] * rng.choice([1, 1, 5])
    return out + [("cold", START + i * 29 * minute) for i in range(9)] + [("cold", START + 500 * minute)]


@pytest.mark.parametrize("files", [None, 12])
def test_sessions_of_a_hot_endpoint(spark, tmp_path, files):
    """Static and as a stream whose batches cut sessions anywhere, with rows out of order inside the delay."""
    import random
    from datetime import timedelta

    half = timedelta(minutes=30)
    samples = sorted(hot_samples(), key=lambda s: s[1])
    job = lambda df: jobs.alert_sessions(df, F.col("value") > 20, "30 minutes", 15, delay="3 hours")
    quiet = [("hot", ts + half / 2, 1.0) for _, ts in samples[::50]]
    rows_in = [(ts, e, 21.0) for e, ts in samples] + [(ts, e, v) for e, ts, v in quiet]
    if files is None:
        out = job(spark.createDataFrame(rows_in, SAMPLE))
    else:
        rng = random.Random(files)
        rows_in.sort(key=lambda r: (r[0] + rng.random() * timedelta(hours=2), r[1]))  # at most two hours late
        size = len(rows_in) // files + 1
        for i in range(files):
            part = rows_in[i * size:(i + 1) * size]
            spark.createDataFrame(part, SAMPLE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        end = jobs.end_folder(spark)
        out = jobs.run_to_table(job(jobs.with_end(stream, "ts", end)), "t-hot", end=end)
    want = plain_sessions(samples, half, half / 2)
    assert rows(out, "endpoint", "breach_start", "breach_end", "samples") == sorted(want) and len(want) > 50


def test_a_hot_endpoint_is_spread(spark):
    """Spans of the endpoint that holds all samples lie in every task."""
    df = spark.createDataFrame([(ts, "hot", 21.0) for _, ts in hot_samples()], SAMPLE)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = jobs.breach_spans(df, F.col("value") > 20, "30 minutes").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks == 4


def test_windows_after_a_restart(spark, feed, tmp_path):
    """Half of the files, a stop, then the rest with the same folders: the batch twin's answer."""
    static, _ = feed
    files = sorted(static.inputFiles())
    paths = {"out": str(tmp_path / "out"), "state": str(tmp_path / "state")}
    folder = tmp_path / "in"
    stream = lambda: spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    land(files[:4], folder)
    end = jobs.end_folder(spark, str(tmp_path / "end"))
    job = lambda: jobs.request_counts(jobs.with_end(sq.requests(stream()), "ts", end))
    first = jobs.run_to_table(job(), "t-restart", **paths).count()
    land(files[4:], folder)
    out = jobs.run_to_table(job(), "t-restart", end=end, **paths)
    names = ("window_start", "endpoint", "requests")
    assert rows(out, *names) == rows(jobs.request_counts(sq.requests(static)), *names)
    assert 0 < first < out.count()


def land(files, folder):
    import os
    import shutil

    folder.mkdir(exist_ok=True)
    for f in files:
        copy = shutil.copy(f.removeprefix("file://"), folder)
        # The stream takes files by age; copies of one moment would come in any order.
        os.utime(copy, (1.7e9 + len(os.listdir(folder)),) * 2)


def test_late_truth(spark, feed):
    static, stream = feed
    made = lambda df: df.selectExpr(*sq.PREDICTIONS).withColumn("forecast_time", F.col("forecast_time").cast("timestamp")).select(
        "seq", "spot_id", "forecast_time", "quality_index")
    end = jobs.end_folder(spark)
    joined = jobs.late_truth(jobs.with_end(made(stream()), "forecast_time", end), jobs.with_end(sq.outcomes(stream()), "time", end))
    out = jobs.run_to_table(joined, "t-truth", end=end)
    twin = jobs.late_truth(made(static), sq.outcomes(static))
    names = ("seq", "forecast_hour", "actual_quality_index")
    assert rows(out, *names) == rows(twin, *names) and out.count() > 20


def batches(spark, folder, parts):
    """Readings of spot a at some hours, one file per batch."""
    from conftest import at

    folder.mkdir(exist_ok=True)
    for hours in parts:
        spark.createDataFrame([("a", at(h), h, float(h * h % 7 + 1)) for h in hours],
                              "spot_id string, time timestamp_ntz, event_id long, wind_speed_10m double").coalesce(1).write.mode(
            "append").parquet(str(folder))


def late_feed(spark, tmp_path, parts, split):
    paths = {"out": str(tmp_path / "out"), "state": str(tmp_path / "state"), "delay": "1 DAY"}
    stream = lambda: spark.readStream.schema(
        "spot_id string, time timestamp_ntz, event_id long, wind_speed_10m double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for some in (parts[:split], parts[split:]):  # the second call restarts the feed
        batches(spark, tmp_path / "in", some)
        out = jobs.steadiness_feed(stream(), **paths)
    twin = wind_steadiness(spark.read.parquet(str(tmp_path / "in")), Series(("spot_id",), ("time", "event_id")))
    return ({r.event_id: r.wind_steadiness for r in x.collect()} for x in (out, twin))


def test_steadiness_of_late_rows(spark, tmp_path):
    got, want = late_feed(spark, tmp_path, [(1, 3, 4), (2, 5), (30,), (29, 31), (28, 60)], 2)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())


def test_rows_older_than_the_context_go_aside(spark, tmp_path):
    got, want = late_feed(spark, tmp_path, [(1, 2, 3, 4), (40, 41), (2,), (42,)], 2)
    assert [r.event_id for r in jobs.late_readings(spark, str(tmp_path / "out")).collect()] == [2]
    assert set(got) == set(want)


@pytest.mark.parametrize("limit", [None, 15])
def test_steadiness(feed, limit):
    static, stream = feed
    shape = lambda df: df.selectExpr(*READINGS).select("spot_id", "time", "event_id", "wind_speed_10m")
    out = jobs.steadiness_feed(shape(stream()), rows_per_segment=limit)
    twin = wind_steadiness(shape(static), Series(("spot_id",), ("time", "event_id")))
    got, want = ({r.event_id: r.wind_steadiness for r in x.collect()} for x in (out, twin))
    assert got.keys() == want.keys()
    assert all(got[k] == (None if v is None else pytest.approx(v, abs=1e-12)) for k, v in want.items())


def test_online_latest(feed):
    static, stream = feed
    shape = lambda df: df.selectExpr(*READINGS).select("spot_id", "time", "event_id")
    out = jobs.online_latest_feed(shape(stream()))
    twin = static.groupBy("user_id").agg(F.max_by("event_id", "ts").alias("event_id"))
    assert rows(out, "event_id") == rows(twin, "event_id")


def test_a_repeated_batch_starts_from_the_same_state(spark, tmp_path):
    """A batch whose checkpoint was lost after its state was written gives the same rows again."""
    import shutil

    paths = {"out": str(tmp_path / "out"), "state": str(tmp_path / "state"), "delay": "1 DAY"}
    stream = lambda: spark.readStream.schema(
        "spot_id string, time timestamp_ntz, event_id long, wind_speed_10m double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    batches(spark, tmp_path / "in", [(1, 3, 4), (2, 5)])
    jobs.steadiness_feed(stream(), **paths)
    shutil.copytree(tmp_path / "state", tmp_path / "saved")
    batches(spark, tmp_path / "in", [(6, 30), (29, 31)])
    jobs.steadiness_feed(stream(), **paths)
    out = jobs.steadiness_feed(stream(), out=paths["out"], delay="1 DAY", state=str(tmp_path / "saved"))  # both batches again
    twin = wind_steadiness(spark.read.parquet(str(tmp_path / "in")), Series(("spot_id",), ("time", "event_id")))
    got, want = ({r.event_id: r.wind_steadiness for r in x.collect()} for x in (out, twin))
    assert got.keys() == want.keys()
    assert all(got[k] == (None if v is None else pytest.approx(v, abs=1e-12)) for k, v in want.items())


def test_a_batch_rewrites_the_buckets_of_its_spots_only(spark, tmp_path, monkeypatch):
    from conftest import at

    from anemos.sources import slicestore

    monkeypatch.setattr(jobs, "SliceStore", lambda spark, path, **kw: slicestore.SliceStore(spark, path, limit=20, **kw))
    kind = "spot_id string, time timestamp_ntz, event_id long"
    folder = tmp_path / "in"
    stream = lambda: spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(folder))
    paths = {"out": str(tmp_path / "out"), "state": str(tmp_path / "state")}
    land = lambda data: spark.createDataFrame(data, kind).coalesce(1).write.mode("append").parquet(str(folder))
    land([(f"s{i}", at(i % 7), i) for i in range(400)])
    jobs.online_latest_feed(stream(), **paths)
    before = {b.folder for b in slicestore.SliceStore(spark, paths["out"]).buckets()[1]}
    land([("s5", at(100), 1000), ("s5", at(99), 999)])
    out = jobs.online_latest_feed(stream(), **paths)
    after = {b.folder for b in slicestore.SliceStore(spark, paths["out"]).buckets()[1]}
    assert len(before) > 10 and len(before - after) == 1
    assert rows(out, "spot_id", "event_id") == sorted([(f"s{i}", 1000 if i == 5 else i) for i in range(400)])
