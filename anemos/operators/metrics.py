"""Metric samples: selection, arithmetic, aggregation, histograms, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemos.operators.ordered import Series, drop_lookback, islands, with_lookback
from anemos.params import LATENCY_BOUNDS

# The text exposition format: a name, labels in braces, a value, an optional time in milliseconds. A label's
# value is quoted and may hold braces, commas and escaped quotes, backslashes and line ends.
_NAME, _KEY = "[a-zA-Z_:][a-zA-Z0-9_:]*", "[a-zA-Z_][a-zA-Z0-9_]*"
_LABEL = rf'({_KEY})[ \t]*=[ \t]*"((?:[^"\\]|\\.)*)"'
_BARE_LABEL = rf'{_KEY}[ \t]*=[ \t]*"(?:[^"\\]|\\.)*"'
_LABELS = rf"[ \t]*(?:{_BARE_LABEL}[ \t]*(?:,[ \t]*|(?=\}})))*"
_LINE = rf"^[ \t]*({_NAME})(?:[ \t]*\{{({_LABELS})\}}[ \t]*|[ \t]+)([^ \t]+)(?:[ \t]+(-?[0-9]+))?[ \t]*$"


def label(name: str) -> Column:
    """Label value; an absent label reads as empty text."""
    if name == "__name__":
        return F.col("name")
    return F.coalesce(F.element_at("labels", name), F.lit(""))


def _unescaped(quoted: Column) -> Column:
    """A label value as meant: backslashes first go out of the way of the other two escapes."""
    for written, meant in (("\\\\", "\0"), ('\\"', '"'), ("\\n", "\n"), ("\0", "\\")):
        quoted = F.replace(quoted, F.lit(written), F.lit(meant))
    return quoted


def parse_samples(lines: DataFrame, text: str = "value") -> DataFrame:
    """Exposition text to samples: name, labels, value. Comments, blanks and lines that break the format are skipped."""
    rest = [c for c in lines.columns if c != text]
    part = lambda i: F.regexp_extract(text, _LINE, i)
    # A label written twice keeps its last value.
    pairs = F.reverse(F.arrays_zip(
        F.regexp_extract_all("_body", F.lit(_LABEL), 1).alias("k"), F.regexp_extract_all("_body", F.lit(_LABEL), 2).alias("v")))
    unique = F.aggregate(
        pairs, F.create_map().cast("map<string,string>"),
        lambda m, p: F.when(F.map_contains_key(m, p["k"]), m).otherwise(
            F.map_concat(m, F.create_map(p["k"], _unescaped(p["v"])))))
    found = lines.where(F.col(text).rlike(_LINE)).select(
        *rest, part(1).alias("name"), part(2).alias("_body"), part(3).try_cast("double").alias("value"))
    return found.where(F.col("value").isNotNull()).select(*rest, "name", unique.alias("labels"), "value")


def select_samples(samples: DataFrame, name: str, *matchers: tuple[str, str, str]) -> DataFrame:
    """Samples of a name whose labels match; patterns match the whole value."""
    out = samples.where(F.col("name") == name)
    for key, op, value in matchers:
        actual = label(key)
        whole = f"^(?:{value})$"
        test = {"=": actual == value, "!=": actual != value,
                "=~": actual.rlike(whole), "!~": ~actual.rlike(whole)}[op]
        out = out.where(test)
    return out


def aggregate_samples(samples: DataFrame, how: str, by=(), value: str = "value") -> DataFrame:
    """max, min, avg or sum of samples, per labels or over all; empty input gives no row."""
    f = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum}[how]
    return samples.groupBy(*[label(k).alias(k) for k in by]).agg(
        f(value).alias("value"), F.count("*").alias("_n")).where("_n > 0").drop("_n")


def clamp_max(samples: DataFrame, limit: float) -> DataFrame:
    return samples.withColumn("value", F.when(F.col("value") > limit, F.lit(limit)).otherwise(F.col("value")))


def _match_key() -> Column:
    entries = F.map_entries(F.map_filter("labels", lambda k, _: k != "__name__"))
    return F.to_json(F.array_sort(entries))


def vector_arith(lhs: DataFrame, rhs: DataFrame, op: str, order: str) -> DataFrame:
    """Add or subtract samples with equal labels (name aside); the last right sample wins."""
    right = rhs.groupBy(_match_key().alias("_k")).agg(F.max_by("value", order).alias("_r"))
    joined = lhs.withColumn("_k", _match_key()).join(right, "_k")
    result = F.col("value") + F.col("_r") if op == "+" else F.col("value") - F.col("_r")
    return joined.withColumn("value", result).drop("_k", "_r", "name")


def scalar_arith(samples: DataFrame, scalar: Column, op: str, scalar_first: bool = False) -> DataFrame:
    a, b = (scalar, F.col("value")) if scalar_first else (F.col("value"), scalar)
    return samples.withColumn("value", a + b if op == "+" else a - b)


def run_counters(runs: DataFrame, ts: str = "ts") -> DataFrame:
    return runs.groupBy("endpoint", "result").agg(
        F.count("*").alias("runs"), (F.unix_micros(F.max(ts).cast("timestamp")) / 1e6).alias("last_seen_s"))


def latency_histogram(requests: DataFrame, by, latency: str, bounds=LATENCY_BOUNDS) -> DataFrame:
    """Cumulative bucket counts per group in one aggregation, long form; the last bound is infinite."""
    every = [*bounds, float("inf")]
    wide = requests.groupBy(*by).agg(*[
        (F.count(latency) if b == float("inf") else F.count_if(F.col(latency) <= b)).alias(f"_b{i}")
        for i, b in enumerate(every)])
    cells = F.array(*[F.struct(F.lit(b).cast("double").alias("le"), F.col(f"_b{i}").alias("cumulative"))
                      for i, b in enumerate(every)])
    return wide.select(*by, F.inline(cells))


def histogram_quantile(buckets: DataFrame, by, q: float) -> DataFrame:
    """Quantile from cumulative buckets, linear inside a bucket.

    A group holds one row per bound, so its buckets fit in one small array.
    """
    table = buckets.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("le", "cumulative"))).alias("b"))
    total = F.element_at("b", -1)["cumulative"]
    rank = F.lit(q) * total
    i = F.size(F.filter("b", lambda x: x["cumulative"] < rank)) + 1
    here = F.get(F.col("b"), F.col("_i") - 1)
    below = F.get(F.col("b"), F.col("_i") - 2)
    low, under = F.coalesce(below["le"], F.lit(0.0)), F.coalesce(below["cumulative"], F.lit(0))
    inside = low + (here["le"] - low) * F.try_divide(rank - under, here["cumulative"] - under)
    value = F.when(total == 0, None).when(here["le"] == float("inf"), below["le"]).otherwise(inside)
    return table.withColumn("_i", i).select(*by, value.alias("quantile"), total.alias("observations"))


def counter_increase(samples: DataFrame, keys, order, value: str, window: str,
                     rows_per_segment: int | None = None) -> DataFrame:
    """Increase and per-second rate per tumbling window; a drop counts as a reset."""
    series = Series.measure(samples, keys, order, rows_per_segment)
    look = with_lookback(samples, series, 1)
    before = F.lag(value).over(series.window())
    step = F.when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    stepped = drop_lookback(look.withColumn("_step", step))
    span = F.window(F.col(order[0]).cast("timestamp"), window)
    summed = stepped.groupBy(*keys, span.alias("_w")).agg(F.sum("_step").alias("increase"))
    width = F.unix_timestamp(F.col("_w.end")) - F.unix_timestamp(F.col("_w.start"))
    return summed.where(F.col("increase").isNotNull()).select(
        *keys, F.col("_w.start").cast("timestamp_ntz").alias("window_start"), "increase",
        (F.col("increase") / width).alias("rate"))


def latest_samples(samples: DataFrame, keys, order) -> DataFrame:
    """Newest sample per series."""
    return samples.groupBy(*keys).agg(
        F.max_by(F.struct("ts", "value"), F.struct(*order)).alias("_s")).select(*keys, "_s.*")


def threshold_alerts(latest: DataFrame, by, limit: float, compare: str = ">") -> DataFrame:
    """Groups whose largest latest value passes the limit (or equals it)."""
    worst = latest.groupBy(*by).agg(F.max("value").alias("value"))
    return worst.where(F.col("value") > limit if compare == ">" else F.col("value") == limit)


def alert_hold(samples: DataFrame, keys, order, breach: Column, hold_minutes: int,
               rows_per_segment: int | None = None) -> DataFrame:
    """Stretches in which a condition held without a break for at least the hold time."""
    marked = samples.withColumn("_breach", F.coalesce(breach, F.lit(False)))
    series = Series.measure(marked, keys, order, rows_per_segment)
    runs = islands(marked, series, "_breach").where("_breach").groupBy(*keys, "island").agg(
        F.min(order[0]).alias("breach_start"), F.max(order[0]).alias("breach_end"),
        F.count("*").alias("samples"))
    hold = F.expr(f"INTERVAL {hold_minutes} MINUTES")
    return runs.where(F.col("breach_end") >= F.col("breach_start") + hold).select(
        *keys, "breach_start", "breach_end", (F.col("breach_start") + hold).alias("firing_from"), "samples")
