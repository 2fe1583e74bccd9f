"""Reading landed files: payloads, entity parquet, reports, metric text, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos import schemas
from anemos.operators.features import missing_to_null
from anemos.operators.metrics import parse_samples
from anemos.params import RAW_COLUMNS
from anemos.session import settle
from anemos.sources.writers import ordered_fingerprint


def read_hourly_payloads(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Landed forecast documents, one JSON object per file (or per line); bad ones keep only their text."""
    with_bad = schemas.StructType([*schemas.HOURLY_PAYLOAD.fields,
                                   schemas.StructField("_corrupt_record", schemas.StringType())])
    return (
        spark.read.schema(with_bad).option("multiLine", one_per_file)
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    )


def parse_hourly_payloads(lines: DataFrame, text: str = "value") -> DataFrame:
    """The same documents from a text column."""
    return lines.select(F.from_json(text, schemas.HOURLY_PAYLOAD).alias("_p")).select("_p.*")


def hourly_rows(payloads: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """Parallel arrays to one row per hour; empty documents give none, times are UTC.

    A field that was not landed becomes a column of nulls.
    """
    nulls = F.transform("hourly.time", lambda _: F.lit(None).cast("double"))
    arrays = [F.col("hourly.time").alias("time")]
    arrays += [F.coalesce(F.col(f"hourly.{c}"), nulls).alias(c) for c in columns]
    rows = payloads.where(F.size("hourly.time") > 0).select("spot_id", F.inline(F.arrays_zip(*arrays)))
    return missing_to_null(rows.withColumn("time", F.to_timestamp("time").cast("timestamp_ntz")))


def hourly_units(payloads: DataFrame) -> DataFrame:
    """One row per document and landed field that has values, with its unit."""
    fields = F.array(*[
        F.struct(F.lit(c).alias("field"), F.element_at("hourly_units", F.lit(c)).alias("unit"),
                 F.col(f"hourly.{c}").isNotNull().alias("present")) for c in RAW_COLUMNS])
    return payloads.select("spot_id", F.inline(fields)).where("present").drop("present")


_SPOT_FILE = r"([^/=]+)\.parquet(?:/[^/]*)?$"


def _spot_of(path: str) -> Column:
    return F.regexp_extract(F.col(path), _SPOT_FILE, 1)


def read_entity_parquet(spark: SparkSession, path: str, spots: DataFrame) -> DataFrame:
    """One parquet file (or folder) per spot, named ``<spot>.parquet``; a large spot's folder holds several files. Any bad file is an error."""
    rows = spark.read.parquet(path).withColumn("spot_id", _spot_of("_metadata.file_path"))
    return missing_to_null(rows).join(spots, "spot_id")


def read_isolated(spark: SparkSession, path: str, schema, manifest: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The readable rows of one file (or folder) per spot, and a report of every landed file.

    With a manifest (``delivery``, ``spot_id``: a stored table) a file or folder ``<delivery>.parquet`` holds many spots: rows tell their
    ``spot_id``, the manifest tells which spots a file was to bring, also where it can't be read, and the report has a row
    per file and spot. Every file costs a listing, two openings and a footer, so files of many spots suit many spots.

    The report has file, spot_id, length and reason: ``ok``, ``foreign`` (no parquet footer) or ``torn`` (fewer rows could be
    read than the footer names, whatever the cause: damaged pages, other types, a failing disk). Spark lists no file
    without a byte, so an empty file counts as not landed. A file that is not ok gives no row, and neither do the other files of its spot, whose
    data would be incomplete. Data is read once, page checksums are verified; footers are read a second time.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"))
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True)
    # Without a column the rows of a file are those that its footer names.
    promised = reader.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("promised"))
    checked = reader.option("parquet.page.verify-checksum.enabled", True).parquet(path)
    names = [f.name for f in schema.fields]
    landed = settle(checked.select(F.col("_metadata.file_path").alias("file"), *names), "landed")
    found = landed.groupBy("file").agg(F.count("*").alias("found"))
    reason = F.when(F.col("promised").isNull() & F.col("found").isNull(), "foreign").when(
        F.coalesce("found", F.lit(0)) != F.coalesce("promised", F.lit(0)), "torn").otherwise("ok")
    named = "spot_id" if manifest is None else "delivery"
    report = settle(listed.join(promised, "file", "left").join(found, "file", "left").select(
        "file", _spot_of("file").alias(named), "length", reason.alias("reason")), "files")
    if manifest is None:
        bad = report.where("reason <> 'ok'").select("spot_id").distinct()
        rows = landed.withColumn("spot_id", _spot_of("file")).drop("file").join(bad, "spot_id", "left_anti")
        return missing_to_null(rows), report
    # A file may hold spots that the manifest doesn't name for it; where it is bad, they are as incomplete as the others.
    inside = landed.select("file", "spot_id").distinct().join(report.select("file", "delivery"), "file").select("delivery", "spot_id")
    pairs = inside.union(manifest.select("delivery", "spot_id")).distinct()
    report = settle(report.join(pairs, "delivery", "left").select("file", "spot_id", "length", "reason"), "spot_files")
    bad = report.where("reason <> 'ok'").select("spot_id").distinct()
    return missing_to_null(landed.drop("file").join(bad, "spot_id", "left_anti")), report


def entity_status(spots: DataFrame, report: DataFrame) -> DataFrame:
    """One row per spot: ``delivered``, ``absent``, or the reason of its worst file."""
    worst = report.groupBy("spot_id").agg(F.max(F.when(F.col("reason") != "ok", F.col("reason"))).alias("bad"), F.count("*").alias("files"))
    return spots.join(worst, "spot_id", "left").withColumn(
        "status", F.coalesce("bad", F.when(F.col("files").isNull(), "absent").otherwise("delivered"))).drop("bad", "files")


def missing_entities(spots: DataFrame, loaded: DataFrame) -> DataFrame:
    """Spots that delivered no readable row."""
    return spots.join(loaded.select("spot_id").distinct(), "spot_id", "left_anti")


def read_metric_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_samples(spark.read.text(path))


def read_reports(spark: SparkSession, path: str, glob: str, schema=schemas.RUN_SUMMARY,
                 one_per_file: bool = True) -> DataFrame:
    """Report documents by file pattern; unreadable documents are left out."""
    with_bad = schemas.StructType([*schema.fields, schemas.StructField("_corrupt_record", schemas.StringType())])
    found = (
        spark.read.schema(with_bad).option("multiLine", one_per_file).option("pathGlobFilter", glob)
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    )
    return found.where(F.col(schema.fieldNames()[0]).isNotNull()).drop("_corrupt_record")


def drive_minutes(payload: Column) -> Column:
    """Minutes of the first route of a routing document; null when there is none."""
    routes = F.from_json(payload, schemas.ROUTE_PAYLOAD)["routes"]
    return F.get(routes, F.lit(0))["duration"] / 60.0


def require_route(minutes: Column) -> Column:
    return F.coalesce(minutes, F.raise_error(F.lit("no route")).cast("double"))


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of the event log, as landed text fields; broken lines are left out."""
    return spark.read.schema(schemas.PREDICTION_EVENT).option("mode", "DROPMALFORMED").json(path)


def read_slice(spark: SparkSession, path: str, dataset: str, spot_id) -> DataFrame:
    """One stored slice in time order; only its partition is read."""
    found = (
        spark.read.parquet(path).where((F.col("dataset_name") == dataset) & (F.col("spot_id") == spot_id))
        .drop("dataset_name", "spot_id").withColumnRenamed("forecast_time", "time")
    )
    if found.isEmpty():
        raise FileNotFoundError(f"no rows stored for {dataset}/{spot_id}")
    return found.orderBy("time")


def file_fingerprints(spark: SparkSession, path: str, name: str = r"([^/]+)$") -> DataFrame:
    """Digest per file, named by the part of its path that the pattern's group takes."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.regexp_extract("path", name, 1).alias("file"), F.sha2("content", 256).alias("digest"))


def directory_fingerprint(spark: SparkSession, path: str, name: str = r"([^/]+)$") -> DataFrame:
    """One digest of all files in name order, names and contents (files without a byte are not listed)."""
    return ordered_fingerprint(file_fingerprints(spark, path, name), ("file",), ("file", "digest"))


def read_retained(spark: SparkSession, path: str, days: int, today: Column) -> DataFrame:
    """Rows within the retention; a filter on the partition column, so old days are not read."""
    return spark.read.parquet(path).where(F.col("day") > F.date_sub(F.to_date(today), days))


def read_bucketed_slice(spark: SparkSession, path: str, buckets: int, dataset: str, spot_id: str) -> DataFrame:
    """One slice of a bucketed store: one bucket directory is read."""
    bucket = F.pmod(F.xxhash64(F.lit(dataset), F.lit(spot_id)), F.lit(buckets))
    return spark.read.parquet(path).where(
        (F.col("dataset_name") == dataset) & (F.col("bucket") == bucket) & (F.col("spot_id") == spot_id)
    ).drop("bucket")
