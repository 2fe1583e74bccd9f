"""Writing tables: slices, day partitions, event logs, exports, reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.operators.ordered import global_positions
from anemos.params import StoreLayout
from anemos.schemas import require_columns

#: Text formats write milliseconds unless told otherwise.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def check_contract(df: DataFrame, layout: StoreLayout) -> DataFrame:
    """The time field and every cluster field must be there; no job runs."""
    return require_columns(df, (layout.time_field, *layout.cluster_fields), "write contract")


def shape_for_store(df: DataFrame, dataset: str) -> DataFrame:
    return df.withColumnRenamed("time", "forecast_time").withColumn("dataset_name", F.lit(dataset))


def write_slices(df: DataFrame, path: str, keys=("dataset_name", "spot_id")) -> None:
    """Replace exactly the slices present in ``df``; all other slices stay.

    The rebalance hint groups each slice into few files and lets adaptive
    execution split a slice that is much larger than the rest.
    """
    require_columns(df, keys, "slice write")
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path)
    )


def write_by_day(df: DataFrame, path: str, layout: StoreLayout, mode: str = "append") -> None:
    """Day partitions on the time field, rows clustered inside the files."""
    check_contract(df, layout)
    day = df.withColumn("day", F.to_date(layout.time_field))
    (
        day.hint("rebalance", F.col("day"))
        .sortWithinPartitions("day", *layout.cluster_fields)
        .write.mode(mode).partitionBy("day").parquet(path)
    )


def offline_store(df: DataFrame, dataset: str) -> DataFrame:
    """All slices of a dataset, event time in UTC, ordered by time and spot."""
    return (
        df.where(F.col("dataset_name") == dataset).drop("dataset_name")
        .withColumnRenamed("forecast_time", "event_timestamp").orderBy("event_timestamp", "spot_id")
    )


def export_offline_store(df: DataFrame, dataset: str, path: str) -> None:
    found = offline_store(df, dataset)
    if found.isEmpty():
        raise FileNotFoundError(f"no rows stored for {dataset}")
    found.write.mode("overwrite").parquet(path)


def entity_rows(df: DataFrame, dataset: str) -> DataFrame:
    return df.where(F.col("dataset_name") == dataset).select(
        "spot_id", F.col("forecast_time").alias("event_timestamp"))


def write_entity_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt not in ("parquet", "csv"):
        raise ValueError("entity rows are written as parquet or csv")
    # Text files would keep milliseconds only.
    df.write.mode("overwrite").format(fmt).option("header", True).option("timestampNTZFormat", MICROS).option(
        "timestampFormat", MICROS).save(path)


def append_events(events: DataFrame, history: str, working: str) -> None:
    """Append to the durable history and to the working log, which must differ."""
    if history.rstrip("/") == working.rstrip("/"):
        raise ValueError("history and working log must be different places")
    for path in (history, working):
        events.write.mode("append").json(path)


def rewrite_log(retained: DataFrame, path: str) -> None:
    """Write a trimmed working log to a new place (never over the one being read)."""
    retained.write.mode("errorifexists").option("timestampNTZFormat", MICROS).option("timestampFormat", MICROS).json(path)


def write_report_history(report: DataFrame, history: str) -> None:
    """Append to the history; "latest" is a view over it (``latest_with_patch``)."""
    report.write.mode("append").option("timestampNTZFormat", MICROS).json(history)


def write_evaluation_report(metrics: DataFrame, path: str) -> None:
    """The report's lines in order as one text file: as many lines as there are metrics."""
    evaluation_report(metrics).coalesce(1).select(F.col("line").alias("value")).write.mode("errorifexists").text(path)


def evaluation_report(metrics: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """Metric lines of a report table, four decimals."""
    return metrics.select(name, F.format_string("| %s | %.4f |", F.col(name), F.col(value)).alias("line")).orderBy(name)


def _row_text(columns) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])


def table_fingerprint(df: DataFrame, columns) -> DataFrame:
    """Digest of a table: same rows, same digest, in any file or partition order.

    Row digests are summed in two 60-bit lanes, so the work is one partial
    aggregation. ``ordered_fingerprint`` makes the order of rows count.
    """
    row = F.md5(_row_text(columns))
    lane = lambda start: F.sum(F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(20,0)"))
    sums = df.agg(F.count("*").alias("rows"), lane(1).alias("a"), lane(17).alias("b"))
    text = F.concat_ws("|", F.col("rows").cast("string"), F.coalesce(F.col("a").cast("string"), F.lit("0")),
                       F.coalesce(F.col("b").cast("string"), F.lit("0")))
    return sums.select("rows", F.sha2(text, 256).alias("digest"))


def ordered_fingerprint(df: DataFrame, order, columns) -> DataFrame:
    """Digest of a table in an order: two rows that change places change it, partitions and files don't.

    Each row is digested with its place, so the digest of a range of rows is a sum that needs
    only the number of rows before it. Rows that tie in the order are placed by their content.
    """
    placed = global_positions(df.withColumn("_row", F.md5(_row_text(columns))), (*order, "_row"), "_place")
    return table_fingerprint(placed, ("_place", "_row"))


def slice_bucket(buckets: int, *keys) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def replace_slices(df: DataFrame, path: str, buckets: int, keys=("dataset_name", "spot_id")) -> None:
    """Replace slices in a store of fixed size buckets: for very many spots.

    One directory per spot would mean millions of small files. Here slices are
    hashed into buckets; a bucket that receives slices is rewritten with its
    other slices kept, and dynamic overwrite leaves the other buckets alone.
    Rows are sorted by slice, so file statistics still skip to one slice.
    ``df`` is read twice and should be a stored table.
    """
    require_columns(df, keys, "slice write")
    new = df.withColumn("bucket", slice_bucket(buckets, *keys))
    slices = new.select(*keys, "bucket").distinct()
    stored = stored_table(df.sparkSession, path)
    if stored is not None:
        touched = slices.select(keys[0], "bucket").distinct()
        kept = stored.join(touched, [keys[0], "bucket"], "left_semi").join(slices, list(keys), "left_anti")
        new = new.unionByName(kept.select(new.columns))
    (
        new.hint("rebalance", F.col(keys[0]), F.col("bucket"))
        .sortWithinPartitions(keys[0], "bucket", *keys[1:])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(keys[0], "bucket").parquet(path)
    )


def stored_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame | None:
    """The table at a path, or None where nothing was written yet."""
    try:
        reader = spark.read.format(fmt)
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
