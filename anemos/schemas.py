"""Table schemas shared by readers, writers and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType,
    TimestampType,
)

from anemos.params import RAW_COLUMNS


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


HOURLY = StructType(
    [StructField("time", ArrayType(StringType()))]
    + [StructField(name, ArrayType(DoubleType())) for name in RAW_COLUMNS]
)
HOURLY_PAYLOAD = StructType([
    StructField("spot_id", StringType()),
    StructField("hourly", HOURLY),
    StructField("hourly_units", MapType(StringType(), StringType())),
])
PREDICTION_EVENT = _struct(
    prediction_timestamp=StringType(), forecast_time=StringType(), quality_index=DoubleType(),
    endpoint=StringType(), model_version=StringType(), spot_id=StringType(),
    spot_name=StringType(), requested_spot_ids=StringType(),
)
FORECAST_POINT = _struct(time=StringType(), quality_index=DoubleType())
SPOT_FORECAST = _struct(
    spot_id=StringType(), spot_name=StringType(), forecast=ArrayType(FORECAST_POINT),
)
PREDICTION_PAYLOAD = _struct(
    model_version=StringType(), predictions=ArrayType(SPOT_FORECAST), written_at=StringType(),
)
ROUTE_PAYLOAD = _struct(routes=ArrayType(_struct(duration=DoubleType(), distance=DoubleType())))
SPOT_RUN = _struct(
    spot_id=StringType(), status=StringType(), ingest_rows=LongType(), stored_rows=LongType(),
    validation_passed=BooleanType(), range_violation_count=LongType(),
    max_numeric_abs_delta=DoubleType(),
)
RUN_SUMMARY = _struct(
    run_id=StringType(), dataset=StringType(), run_status=StringType(),
    generated_at=TimestampType(), retraining_mode=StringType(),
    stored_spots=ArrayType(StringType()), drifted_spots=ArrayType(StringType()),
    stage_durations_seconds=MapType(StringType(), DoubleType()),
    stage_failure_counts=MapType(StringType(), LongType()), spots=ArrayType(SPOT_RUN),
)


def require_columns(df: DataFrame, names, what: str) -> DataFrame:
    """Fail at analysis time, before any job, when columns are absent."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {', '.join(missing)}")
    return df
