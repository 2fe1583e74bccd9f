"""Structured Streaming jobs. Each transformation also runs on a static DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anemos.operators.features import wind_steadiness
from anemos.operators.ordered import Series
from anemos.operators.ranking import latest_per_key
from anemos.params import LATENCY_BOUNDS
from anemos.session import fresh_path, settle
from anemos.sources.slicestore import SliceStore

EVENT_KEY = ("prediction_timestamp", "model_version", "spot_id", "forecast_time")


#: A time after all others. A row that carries it closes a stream (see ``with_end``).
END = "TIMESTAMP '9000-01-01 00:00:00'"


def _watermark(df: DataFrame, column: str, delay: str, wanted: Column | None = None) -> DataFrame:
    """Watermark a stream and then drop its end mark; a static frame has neither.

    Both tests are one expression over the event time, so Spark can't move a part of it
    below the watermark, where the end mark would be lost.
    """
    if not df.isStreaming:
        return df if wanted is None else df.where(wanted)
    before_end = F.col(column) < F.expr(END)
    return df.withWatermark(column, delay).where(F.when(before_end, F.lit(True) if wanted is None else wanted))


def ingest_events(events: DataFrame, delay: str = "1 day", key=EVENT_KEY) -> DataFrame:
    """Typed events without repeats, which agree in ``key``. Rows without a prediction time can't be tracked: all of them pass.

    A log that numbers its events has the number in its key: of two events that only share model, spot and times both stay.
    """
    timed = events.where(F.col("prediction_timestamp").isNotNull())
    untimed = events.where(F.col("prediction_timestamp").isNull())
    if events.isStreaming:
        once = timed.withWatermark("prediction_timestamp", delay).dropDuplicatesWithinWatermark(list(key))
    else:
        once = timed.dropDuplicates(list(key))
    return once.unionByName(untimed)


def request_counts(requests: DataFrame, delay: str = "10 minutes", bounds=LATENCY_BOUNDS) -> DataFrame:
    """Requests per minute and route with cumulative latency buckets."""
    buckets = [F.count_if(F.col("latency") <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    found = _watermark(requests, "ts", delay).groupBy(F.window("ts", "1 minute"), "endpoint").agg(
        F.count("*").alias("requests"), *buckets)
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        "endpoint", "requests", *[f"le_{i}" for i in range(len(bounds))])


def error_rate(requests: DataFrame, limit: float, delay: str = "10 minutes") -> DataFrame:
    """Errors per second in a 15-minute window sliding by one minute, with its threshold."""
    found = _watermark(requests, "ts", delay).groupBy(F.window("ts", "15 minutes", "1 minute"), "endpoint").agg(
        F.count_if("is_error").alias("errors"), F.count("*").alias("requests"))
    rate = F.col("errors") / F.lit(900.0)
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        "endpoint", "errors", "requests", rate.alias("rate"), (rate > limit).alias("firing"))


def breach_spans(samples: DataFrame, breach: Column, gap: str, delay: str = "10 minutes") -> DataFrame:
    """Breaching samples as spans: per endpoint and tumbling window as wide as the gap one first and last time, and a count.

    All samples of a window belong to one session. They are counted on the map side and then dealt by endpoint and
    window, so an endpoint that holds all samples is spread over as many tasks as there are windows.
    """
    spans = _watermark(samples, "ts", delay, breach).groupBy(F.window("ts", gap).alias("w"), "endpoint").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))
    return spans.select(F.window_time("w").alias("closed"), "endpoint", F.struct("first", "last", "n").alias("span"))


def alert_sessions(samples: DataFrame, breach: Column, gap: str, hold_minutes: int, delay: str = "10 minutes") -> DataFrame:
    """Sessions of breaching samples that lasted at least the hold time.

    Samples become spans; those of neighbouring windows form a run, which is the open end kept as state (a span a
    gap of breach time, whatever the samples). A run lies open until the window after its last one has been read, so no span that could
    join it comes later; then it is cut where two spans lie a gap or more apart.
    """
    runs = breach_spans(samples, breach, gap, delay).groupBy(
        F.session_window("closed", f"{gap} 1 microsecond").alias("run"), "endpoint").agg(
        F.array_sort(F.collect_list("span")).alias("spans"))
    apart = lambda s, i: (i == 0) | (
        s["first"] >= F.element_at("spans", F.greatest(i, F.lit(1)))["last"] + F.expr(f"INTERVAL '{gap}'"))
    # A session goes from a span that lies apart to the one before the next such.
    firsts = F.filter(F.transform("spans", lambda s, i: F.when(apart(s, i), i)), lambda i: i.isNotNull())
    whole = F.transform("firsts", lambda at, k: F.slice(
        "spans", at + 1, F.coalesce(F.get("firsts", k + 1), F.size("spans")) - at))
    found = runs.withColumn("firsts", firsts).select("endpoint", F.explode(whole).alias("s")).select(
        "endpoint", F.element_at("s", 1)["first"].alias("breach_start"), F.element_at("s", -1)["last"].alias("breach_end"),
        F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + x["n"]).alias("samples"))
    held = F.col("breach_end") >= F.col("breach_start") + F.expr(f"INTERVAL {hold_minutes} MINUTES")
    return found.where(held).withColumn("window_end", F.col("breach_end") + F.expr(f"INTERVAL '{gap}'"))


def late_truth(predictions: DataFrame, observed: DataFrame, lag_hours: int = 120, delay: str = "2 hours") -> DataFrame:
    """Predictions joined to the hourly outcome that arrives ``lag_hours`` later.

    Outcomes are reduced to one row per spot and hour first, so a prediction
    meets one outcome. The time range bounds the state both sides keep.
    """
    arrival = f"INTERVAL {lag_hours} HOURS"
    seen = _watermark(observed.withColumn("arrived", F.col("time") + F.expr(arrival)), "arrived", delay)
    hourly = seen.groupBy(F.window("arrived", "1 hour").alias("w"), F.col("spot_id").alias("o_spot")).agg(
        F.min_by("actual_quality_index", F.struct("time", "event_id")).alias("actual_quality_index"))
    made = _watermark(predictions, "forecast_time", delay).withColumn(
        "forecast_hour", F.date_trunc("hour", "forecast_time"))
    outcome = hourly.select("o_spot", "actual_quality_index", F.col("w"), F.window_time("w").alias("o_time"),
                            (F.col("w.start") - F.expr(arrival)).alias("o_hour"))
    return made.join(outcome, F.expr(f"""spot_id = o_spot AND forecast_hour = o_hour
        AND o_time >= forecast_time + INTERVAL {lag_hours - 1} HOURS AND o_time <= forecast_time + INTERVAL {lag_hours + 2} HOURS""")).select(
        "seq", "spot_id", "forecast_hour", "quality_index", "actual_quality_index")


# Running ---------------------------------------------------------------------

_MARK = "at timestamp"


def end_folder(spark: SparkSession, path: str | None = None) -> str:
    """A folder for the end mark of a stream; without a path a fresh one."""
    path = path or fresh_path(spark, "end")
    spark.createDataFrame([], _MARK).write.mode("append").parquet(path)
    return path


def with_end(stream: DataFrame, time: str, folder: str) -> DataFrame:
    """The stream and, once it is closed, a last row at END in ``time`` that lets open windows out."""
    marks = stream.sparkSession.readStream.schema(_MARK).parquet(folder)
    # No column is null: a join asks for keys that aren't, and Spark would ask before the watermark.
    filler = {"string": F.lit(""), "timestamp": F.col("at"), "boolean": F.lit(False)}
    return stream.unionByName(marks.select(*[
        (F.col("at") if f.name == time else filler.get(f.dataType.simpleString(), F.lit(0))).cast(f.dataType).alias(f.name)
        for f in stream.schema.fields]))


def run_to_table(stream: DataFrame, name: str, out: str | None = None, state: str | None = None,
                 end: str | None = None) -> DataFrame:
    """Process all available input into an append-only parquet table and read it.

    With ``out`` and ``state`` given, a later call goes on where this one stopped. ``end`` names the
    folder of ``with_end``: the stream is then closed after its input, and windows that are still
    open come out. Rows that arrive after that are late.
    """
    spark = stream.sparkSession
    out, state = out or fresh_path(spark, name), state or fresh_path(spark, f"{name}-checkpoint")

    def run() -> None:
        query = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", state).trigger(availableNow=True).start(out)
        )
        query.awaitTermination()

    run()
    if end:
        spark.range(1).select(F.expr(END).alias("at")).write.mode("append").parquet(end)
        run()
    return spark.read.schema(stream.schema).parquet(out)


def _run_batches(stream: DataFrame, step, state: str) -> None:
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def steadiness_feed(readings: DataFrame, rows: int = 3, rows_per_segment: int | None = None, delay: str = "1 DAY",
                    out: str | None = None, state: str | None = None) -> DataFrame:
    """Rolling steadiness over a live feed whose rows may come out of order.

    Kept per spot are the rows newer than ``delay`` before its newest one, and the ``rows - 1``
    before these as context. A late row changes the rows after it, so all kept rows from the
    earliest new one on are computed and written anew; the newest version of a row counts. Rows
    older than the context can't be placed: they go to ``late_readings``. What is kept lies in a slice store:
    a micro-batch reads and rewrites the buckets of its own spots only, as the store's next version; a batch
    that is repeated starts from the same version and rewrites its own. With ``out`` and ``state`` given, a later call
    goes on where this one stopped.
    """
    spark = readings.sparkSession
    out, state = out or fresh_path(spark, "steadiness"), state or fresh_path(spark, "steadiness-checkpoint")
    order = ("time", "event_id")
    place = F.struct(*order)

    def step(batch: DataFrame, batch_id: int) -> None:
        store = SliceStore(batch.sparkSession, f"{out}/tail")
        batch = settle(batch.withColumn("dataset_name", F.lit("tail")), "batch")
        old = store.read_for(batch, batch_id)
        batch = batch.drop("dataset_name")
        fresh = batch.withColumn("_state", F.lit("new"))
        if old is not None:
            old = old.drop("dataset_name")
            last = old.where("_state = 'context'").groupBy("spot_id").agg(F.max(place).alias("_last"))
            placed = fresh.join(last, "spot_id", "left")
            fits = F.col("_last").isNull() | (place > F.col("_last"))
            placed.where(~fits).drop("_last", "_state").write.mode("overwrite").parquet(f"{out}/late/version={batch_id}")
            fresh = placed.where(fits).drop("_last")
        now = fresh if old is None else fresh.unionByName(old)
        done = wind_steadiness(now, Series.measure(now, ("spot_id",), order, rows_per_segment), rows)
        first = fresh.groupBy("spot_id").agg(F.min(place).alias("_first"))
        done.join(first, "spot_id").where((F.col("_state") != "context") & (place >= F.col("_first"))).drop(
            "_state", "_first").write.mode("overwrite").parquet(f"{out}/rows/version={batch_id}")
        edges = now.groupBy("spot_id").agg((F.max("time") - F.expr(f"INTERVAL {delay}")).alias("_edge"))
        split = now.drop("_state").join(edges, "spot_id")
        young = split.where("time > _edge").withColumn("_state", F.lit("kept"))
        newest = Window.partitionBy("spot_id").orderBy(*[F.desc(c) for c in order])
        context = split.where("time <= _edge").withColumn("_rn", F.row_number().over(newest)).where(
            F.col("_rn") < rows).drop("_rn").withColumn("_state", F.lit("context"))
        kept = young.unionByName(context).drop("_edge").withColumn("dataset_name", F.lit("tail"))
        store.replace(settle(kept, "kept"), batch_id)

    _run_batches(readings, step, state)
    versions = spark.read.parquet(f"{out}/rows")
    fields = [c for c in versions.columns if c not in ("spot_id", "event_id", "version")]
    return versions.groupBy("spot_id", "event_id").agg(F.max_by(F.struct(*fields), "version").alias("_row")).select(
        "spot_id", "event_id", "_row.*")


def late_readings(spark: SparkSession, out: str) -> DataFrame:
    """Rows of a steadiness feed that came too late to be placed."""
    return spark.read.parquet(f"{out}/late").drop("version")


def online_latest_feed(features: DataFrame, keys=("spot_id",), order=("time", "event_id"), out: str | None = None,
                       state: str | None = None) -> DataFrame:
    """Latest row per spot, merged per micro-batch into the buckets of its spots; resumable like the others."""
    spark = features.sparkSession
    name, spot = "dataset_name", keys[0]
    out, state = out or fresh_path(spark, "online"), state or fresh_path(spark, "online-checkpoint")

    def step(batch: DataFrame, batch_id: int) -> None:
        store = SliceStore(batch.sparkSession, out, keys=(name, spot))
        best = settle(latest_per_key(batch.withColumn(name, F.lit("online")), keys, order), "latest")
        stored = store.read_for(best, batch_id)
        rows = best if stored is None else latest_per_key(best.unionByName(stored), keys, order)
        store.replace(settle(rows, "latest"), batch_id)

    _run_batches(features, step, state)
    return SliceStore(spark, out, keys=(name, spot)).read("online").drop(name)
