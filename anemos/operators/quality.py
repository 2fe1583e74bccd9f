"""Data-quality checks: null fractions, ranges, verdicts, round trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from anemos.params import EXPECTED_UNITS, MAX_NULL_FRACTION, VALUE_RANGES

FLOATS = ("double", "float")


def _is_missing(df: DataFrame, name: str) -> Column:
    missing = F.col(name).isNull()
    if df.schema[name].dataType.typeName() in FLOATS:
        missing = missing | F.isnan(name)
    return missing


def null_fractions(df: DataFrame, columns, by=()) -> DataFrame:
    """Share of missing values per column in one pass, long form."""
    shares = df.groupBy(*by).agg(*[
        F.coalesce(F.avg(_is_missing(df, c).cast("double")), F.lit(0.0)).alias(c) for c in columns
    ])
    return shares.unpivot(list(by), list(columns), "column", "null_fraction")


def _violations(columns, ranges) -> Column:
    """Array of out-of-range entries of one row, built before any row is multiplied."""
    entries = []
    for name in columns:
        if name not in ranges:
            continue
        low, high = ranges[name]
        entries.append(F.struct(
            F.lit(name).alias("column"), F.col(name).alias("value"),
            F.lit(low).cast("double").alias("min"), F.lit(high).cast("double").alias("max"),
        ))
    return F.filter(
        F.array(*entries),
        lambda e: F.coalesce(e["value"] < e["min"], F.lit(False))
        | F.coalesce(e["value"] > e["max"], F.lit(False)),
    )


def range_violations(df: DataFrame, ids, ranges=VALUE_RANGES) -> DataFrame:
    """One row per value outside its inclusive bounds; missing values never violate."""
    return df.select(*ids, F.inline(_violations(df.columns, ranges)))


def validate_slices(df: DataFrame, required, by=("spot_id",), columns=None, ranges=VALUE_RANGES,
                    max_null: float = MAX_NULL_FRACTION) -> DataFrame:
    """Verdict per slice: schema, completeness, range, all from one aggregation."""
    checked = [c for c in (columns or df.columns) if c not in by]
    missing = sorted(set(required) - set(df.columns))
    found = df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.greatest(*[F.avg(_is_missing(df, c).cast("double")) for c in checked], F.lit(0.0))
        .alias("max_null_fraction"),
        F.sum(F.size(_violations(df.columns, ranges)).cast("bigint")).alias("range_violations"),
    )
    complete, in_range = F.col("max_null_fraction") <= max_null, F.col("range_violations") == 0
    return found.select(
        *by, "rows", F.lit(",".join(missing)).alias("missing_columns"),
        F.lit(not missing).alias("schema_valid"), complete.alias("completeness_valid"),
        in_range.alias("range_valid"), "max_null_fraction", "range_violations",
        (F.lit(not missing) & complete & in_range).alias("is_valid"),
    )


def apply_policy(df: DataFrame, verdict: DataFrame, policy: str, by=("spot_id",)) -> DataFrame:
    """What to do with invalid slices: ``fail`` the job, ``skip`` them, or ``warn`` and keep."""
    if policy == "warn":
        return df
    valid = F.col("is_valid")
    if policy == "fail":
        valid = F.when(valid, True).otherwise(
            F.raise_error(F.concat(F.lit("validation failed: "), F.concat_ws("/", *by))).cast("boolean")
        )
    elif policy != "skip":
        raise ValueError("policy is fail, skip or warn")
    return df.join(verdict.select(*by, "is_valid"), list(by)).where(valid).drop("is_valid")


def unit_contract(units: DataFrame, ids, name: str = "field", unit: str = "unit") -> DataFrame:
    """Check landed units: expected, assumed (``undefined``) or rejected."""
    pairs = [F.lit(x) for pair in EXPECTED_UNITS.items() for x in pair]
    expected = F.element_at(F.create_map(*pairs), F.col(name))
    status = (
        F.when(F.col(unit) == expected, "expected")
        .when(F.col(unit) == "undefined", "assumed")
        .otherwise("rejected")
    )
    return (
        units.where(expected.isNotNull())
        .withColumn("status", status)
        .withColumn("resolved_unit", F.when(F.col("status") == "rejected", F.col(unit)).otherwise(expected))
        .select(*ids, name, unit, "status", "resolved_unit")
    )


def worst_unit(checked: DataFrame, by) -> DataFrame:
    """The worst status of a group's units: rejected before assumed before expected."""
    rank = F.max(F.when(F.col("status") == "rejected", 2).when(F.col("status") == "assumed", 1).otherwise(0))
    named = F.when(rank == 2, "rejected").when(rank == 1, "assumed").otherwise("expected")
    return checked.groupBy(*by).agg(named.alias("unit_status"))


def require_units(checked: DataFrame, name: str = "field", unit: str = "unit") -> DataFrame:
    """Fail the job when a unit was rejected."""
    bad = F.raise_error(F.concat(F.lit("unexpected unit for "), F.col(name), F.lit(": "),
                                 F.coalesce(F.col(unit), F.lit("none"))))
    return checked.where(F.when(F.col("status") == "rejected", bad.cast("boolean")).otherwise(True))


def numeric_columns(df: DataFrame, keys=()) -> tuple[str, ...]:
    """Columns that hold numbers, without the keys."""
    return tuple(f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, NumericType))


def round_trip(written: DataFrame, stored: DataFrame, keys, columns, by=()) -> DataFrame:
    """Rows on both sides and the largest absolute difference; null when they cannot match."""
    shared = [c for c in columns if c in written.columns and c in stored.columns]
    a = written.select(*keys, F.struct(*shared).alias("_a"))
    b = stored.select(*keys, F.struct(*shared).alias("_b"))
    gap = F.greatest(*[F.abs(F.col(f"_a.{c}") - F.col(f"_b.{c}")) for c in shared], F.lit(None).cast("double"))
    return (
        a.join(b, list(keys), "full").groupBy(*by).agg(
            F.count("_a").alias("written_rows"), F.count("_b").alias("stored_rows"),
            F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("matched_rows"),
            F.max(gap).alias("_gap"),
        )
        .withColumn("max_abs_delta", F.when(
            (F.col("written_rows") == F.col("stored_rows")) & (F.col("matched_rows") == F.col("stored_rows")),
            F.col("_gap")))
        .drop("_gap")
    )


def column_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns that are new, missing or shared, by name; reads no data."""
    a, b = set(before.columns), set(after.columns)
    rows = [(c, "new") for c in b - a] + [(c, "missing") for c in a - b] + [(c, "shared") for c in a & b]
    spark = before.sparkSession
    return spark.createDataFrame(sorted(rows, key=lambda r: (r[1], r[0])), "column string, status string")


def field_parity(left: DataFrame, right: DataFrame, keys, fields, tolerant=(),
                 tolerance: float = 1e-12) -> DataFrame:
    """Compare two documents per key field by field; values are compared as text."""
    def long(df: DataFrame, value: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(value))
                          for f in fields if f in df.columns])
        return df.select(*keys, F.inline(pairs))

    a = long(left, "left_value").withColumn("present_left", F.lit(True))
    b = long(right, "right_value").withColumn("present_right", F.lit(True))
    number = F.abs(F.col("left_value").try_cast("double") - F.col("right_value").try_cast("double"))
    same = F.when(F.col("field").isin(*tolerant), number < tolerance).otherwise(
        F.col("left_value").eqNullSafe(F.col("right_value")))
    return (
        a.join(b, [*keys, "field"], "full")
        .withColumns({"present_left": F.coalesce("present_left", F.lit(False)),
                      "present_right": F.coalesce("present_right", F.lit(False))})
        .withColumn("matches", F.col("present_left") & F.col("present_right") & F.coalesce(same, F.lit(False)))
    )
