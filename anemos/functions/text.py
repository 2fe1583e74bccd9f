"""Text and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anemos.functions.temporal import col
from anemos.params import KNOWN_ROUTES


def normalize_id_list(text) -> Column:
    """JSON array or comma text to trimmed, non-empty strings."""
    raw = F.coalesce(col(text), F.lit(""))
    parts = F.coalesce(F.from_json(raw, "array<string>"), F.split(raw, ","))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def normalize_label(text) -> Column:
    return F.coalesce(F.nullif(F.trim(col(text)), F.lit("")), F.lit("unknown"))


def numeric_version(text) -> Column:
    value = F.trim(col(text))
    return F.when(value.rlike("^[0-9]+$"), value.cast("double"))


def normalize_route(path) -> Column:
    return F.when(col(path).isin(*KNOWN_ROUTES), col(path)).otherwise("other")


def sanitize_name(text) -> Column:
    """Metric segment: runs of other characters become one underscore."""
    cleaned = F.regexp_replace(col(text), "[^A-Za-z0-9]+", "_")
    stripped = F.regexp_replace(cleaned, "^_+|_+$", "")
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit("unknown"))


def sanitize_run_key(text) -> Column:
    """Run key: like a metric segment, but keeps ``._-`` and joins with a dash."""
    cleaned = F.regexp_replace(F.trim(col(text)), "[^A-Za-z0-9._-]+", "-")
    stripped = F.regexp_replace(cleaned, "^[.-]+|[.-]+$", "")
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit("manual"))
