"""Statistical drift between a reference and a current set of rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemos.functions.probability import band_exit_p, chi_square_p
from anemos.functions.text import sanitize_name
from anemos.operators import ordered
from anemos.operators.ordered import Series, running_totals
from anemos.params import DriftRules
from anemos.session import settle

# Column names that carry predictions, times and identifiers.
TIME_NAMES = ("prediction_timestamp", "timestamp", "created_at", "event_time", "time")
PREDICTION_NAMES = ("prediction", "predicted_quality_index", "quality_index", "score")
IDENTIFIER_NAMES = ("spot_id", "model_version", "request_id", "user_id", "session_id")
NUMERIC = ("double", "float", "integer", "long", "short", "byte", "decimal")

#: Rows of the reference up to which a column is tested for significance, beyond for distance.
LARGE_SAMPLE = 1000
#: Product of both sides' rows up to which the Kolmogorov-Smirnov p-value is exact.
EXACT_PATHS = 10_000
#: Rows of a task that counts values per group, before they are melted to a row per column.
ROWS_PER_TASK = 25_000
#: Cases of the exact Kolmogorov-Smirnov test that a task follows.
CASES_PER_TASK = 200
#: Tasks at most; beyond, they hold more rows.
MOST_TASKS = 20_000


def shared_columns(reference: DataFrame, current: DataFrame, allowed=None) -> list[str]:
    """Columns on both sides in reference order, optionally within a list."""
    found = [c for c in reference.columns if c in current.columns and (allowed is None or c in allowed)]
    if not found:
        raise ValueError("the two datasets share no comparable columns")
    return found


def prediction_columns(df: DataFrame) -> list[str]:
    """Prediction-like columns, else any numeric, boolean or text column that is no key or time."""
    usable = [c for c in df.columns
              if c not in IDENTIFIER_NAMES and c not in TIME_NAMES and not c.endswith("_id")]
    preferred = [c for c in usable if c in PREDICTION_NAMES or "prediction" in c.lower()]
    kinds = (*NUMERIC, "boolean", "string")
    found = preferred or [c for c in usable if df.schema[c].dataType.typeName() in kinds]
    if not found:
        raise ValueError("no comparable prediction columns")
    return found


def kolmogorov_p(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 l^2)."""
    lam = statistic * F.sqrt(n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam),
    )
    total = F.lit(2.0) * F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def _melt(df: DataFrame, columns, by, kind: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value"))
                      for c in columns])
    return df.select(*by, "side", F.inline(cells)).where(F.col("value").isNotNull())


def _side_counts(melted: DataFrame, by) -> DataFrame:
    return melted.groupBy(*by, "column", "value").agg(
        F.count_if(F.col("side") == "reference").alias("_a"),
        F.count_if(F.col("side") == "current").alias("_b"))


def _dealt(df: DataFrame, by, rows_per_segment: int | None) -> tuple[DataFrame, int, bool]:
    """The rows, those of the largest group, and whether groups are small: then they are dealt out whole.

    Small groups are dealt out before they are melted: all later steps then stay in their task, whose rows don't grow with the table.
    """
    # A group has at least as many rows as any of its columns has values.
    found = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
    largest = found["largest"] or 0
    small = bool(by) and largest <= min(ROWS_PER_TASK, rows_per_segment or ordered.ROWS_PER_SEGMENT)
    if small:
        df = df.repartition(min(MOST_TASKS, ceil((found["rows"] or 1) / ROWS_PER_TASK)), *by)
    return df, largest, small


def _walked(df: DataFrame, columns, by, rows_per_segment: int | None,
            dealt: tuple[DataFrame, int, bool] | None = None) -> tuple[DataFrame, DataFrame, Series]:
    """Values per column (and group) with counts and running counts of both sides, the melted rows, and their series.

    Rows are counted per distinct value before anything is ordered. The running
    counts then go through the cut series, so a column with billions of
    distinct values does not end up in one task.
    """
    df, largest, _ = dealt or _dealt(df, by, rows_per_segment)
    melted = _melt(df, columns, by, "double")
    series = Series((*by, "column"), ("value",))
    if largest > (rows_per_segment or ordered.ROWS_PER_SEGMENT):
        series = Series.measure(melted, series.keys, series.order, rows_per_segment)
    walked = running_totals(_side_counts(melted, by), series, {"_ca": "_a", "_cb": "_b"},
                            {"_ta": "_a", "_tb": "_b"})
    return walked, melted, series


def _gap() -> Column:
    """Distance of both distribution functions at a value."""
    return F.abs(F.try_divide("_ca", "_ta") - F.try_divide("_cb", "_tb"))


def _largest_gap() -> tuple[Column, ...]:
    return F.max(_gap()).alias("statistic"), F.max("_ta").alias("reference_rows"), F.max("_tb").alias("current_rows")


def _small_gaps(dealt: DataFrame, columns, by) -> DataFrame:
    """Largest gap per column of small groups that are dealt out whole.

    Their rows are ordered at once, without counting values first: equal values are peers of one range frame. Columns are numbers
    until there is one row of each, as most of the time goes into sorting.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("_at"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])
    melted = dealt.select(*by, "side", F.inline(cells)).where(F.col("value").isNotNull())
    w = Window.partitionBy(*by, "_at").orderBy("value")
    up_to, whole = w.rangeBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    a, b = (F.when(F.col("side") == side, 1) for side in ("reference", "current"))
    walked = melted.withColumns({"_ca": F.count(a).over(up_to), "_cb": F.count(b).over(up_to),
                                 "_ta": F.count(a).over(whole), "_tb": F.count(b).over(whole)})
    names = F.array(*[F.lit(c) for c in columns])
    return walked.groupBy(*by, "_at").agg(*_largest_gap()).select(
        *by, F.get(names, "_at").alias("column"), "statistic", "reference_rows", "current_rows")


def _ks_score(tested: DataFrame, by) -> DataFrame:
    """Add the p-value of a Kolmogorov-Smirnov statistic: exact where both sides are small, else asymptotic."""
    n, m = F.col("reference_rows"), F.col("current_rows")
    asymptotic = kolmogorov_p(F.col("statistic"), n.cast("double"), m.cast("double"))
    gap = F.round(F.col("statistic") * n * m).cast("long")
    small = n * m <= EXACT_PATHS
    if not by:
        return tested.withColumn("score", F.when(small, band_exit_p(gap, n, m)).otherwise(asymptotic))
    # Many groups share sizes and statistic: each such case is followed once.
    tested = settle(tested.withColumn("_gap", F.when(small, gap)), "tested")
    names = ["_gap", "reference_rows", "current_rows"]
    cases = settle(tested.where("_gap IS NOT NULL").select(*names).distinct(), "cases")
    # A case is a few bytes and milliseconds of work: by its size, all of them would be one task.
    tasks = min(MOST_TASKS, max(1, ceil(cases.count() / CASES_PER_TASK)))
    cases = cases.repartition(tasks, *names).withColumn("_exact", band_exit_p(F.col("_gap"), n, m))
    return tested.join(cases, names, "left").withColumn("score", F.coalesce("_exact", asymptotic)).drop("_gap", "_exact")


def drift_ks(df: DataFrame, columns, by=(), rows_per_segment: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per column (and group)."""
    dealt = rows, _, small = _dealt(df, by, rows_per_segment)
    if small:
        tested = _small_gaps(rows, columns, by)
    else:
        walked, _, _ = _walked(df, columns, by, rows_per_segment, dealt)
        tested = walked.groupBy(*by, "column").agg(*_largest_gap())
    return _ks_score(tested, by).withColumn("method", F.lit("ks p_value"))


def drift_numeric(df: DataFrame, columns, by=(), large: int = LARGE_SAMPLE, rows_per_segment: int | None = None) -> DataFrame:
    """The test that fits the size of the reference, per column (and group).

    Up to ``large`` rows the Kolmogorov-Smirnov p-value. Beyond, where any difference is significant, the Wasserstein
    distance in standard deviations of the reference (0.001 at least): the gap between both distribution functions
    times the step to the next value, summed. A step may cross a cut of the series.
    """
    walked, melted, series = _walked(df, columns, by, rows_per_segment)
    look = ordered.with_lookback(walked.withColumn("_gap", _gap()), series, 1)
    w = series.window()
    stepped = ordered.drop_lookback(look.withColumn("_area", F.lag("_gap").over(w) * (F.col("value") - F.lag("value").over(w))))
    tested = _ks_score(stepped.groupBy(*by, "column").agg(*_largest_gap(), F.sum("_area").alias("_area")), by)
    spread = melted.where("side = 'reference'").groupBy(*by, "column").agg(F.stddev_pop("value").alias("_spread"))
    is_large = F.col("reference_rows") > large
    out = tested.join(spread, [*by, "column"], "left").withColumn(
        "distance", F.coalesce("_area", F.when(F.col("statistic").isNotNull(), 0.0)) / F.greatest("_spread", F.lit(0.001)))
    return out.withColumns({"score": F.when(is_large, F.col("distance")).otherwise(F.col("score")),
                            "method": F.when(is_large, "wasserstein distance").otherwise("ks p_value")}).drop("_area", "_spread")


def drift_categorical(df: DataFrame, columns, by=()) -> DataFrame:
    """Category counts compared: chi-square statistic with its p-value, Jensen-Shannon and total-variation distance.

    The score is the total-variation distance; ``drift_categories`` takes the test that fits the size.
    """
    counts = _side_counts(_melt(df, columns, by, "string"), by)
    group = [*by, "column"]
    totals = counts.groupBy(*group).agg(F.sum("_a").alias("_ta"), F.sum("_b").alias("_tb"))
    a, b = F.col("_a").cast("double"), F.col("_b").cast("double")
    ta, tb = F.col("_ta").cast("double"), F.col("_tb").cast("double")
    chi = F.pow(a * F.sqrt(F.try_divide(tb, ta)) - b * F.sqrt(F.try_divide(ta, tb)), F.lit(2.0)) / (a + b)
    p, q = F.try_divide(a, ta), F.try_divide(b, tb)
    middle = (p + q) / 2
    part = lambda x: F.when(x == 0, 0.0).otherwise(x * F.log(x / middle))
    return counts.join(totals, group).groupBy(*group).agg(
        F.sum(chi).alias("statistic"), F.max("_ta").alias("reference_rows"),
        F.max("_tb").alias("current_rows"),
        (F.count("*") - 1).alias("degrees_of_freedom"),
        F.sqrt(F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0))).alias("jensen_shannon"),
        (F.lit(0.5) * F.sum(F.abs(p - q))).alias("score"),
    ).withColumns({"p_value": chi_square_p(F.col("statistic"), F.col("degrees_of_freedom")), "method": F.lit("total_variation")})


def drift_categories(df: DataFrame, columns, by=(), large: int = LARGE_SAMPLE) -> DataFrame:
    """The test that fits the size of the reference: chi-square p-value up to ``large`` rows, else the Jensen-Shannon distance."""
    is_large = F.col("reference_rows") > large
    return drift_categorical(df, columns, by).withColumns({
        "score": F.when(is_large, F.col("jensen_shannon")).otherwise(F.col("p_value")),
        "method": F.when(is_large, "jensen-shannon distance").otherwise("chi-square p_value")})


def drift_predictions(sides: DataFrame, by=(), large: int = LARGE_SAMPLE) -> DataFrame:
    """All prediction columns of a log with a ``side``, numbers and categories each by the test that fits."""
    wanted = prediction_columns(sides.drop("side"))
    numbers = [c for c in wanted if sides.schema[c].dataType.typeName() in NUMERIC]
    others = [c for c in wanted if c not in numbers]
    names = [*by, "column", "statistic", "reference_rows", "current_rows", "score", "method"]
    parts = [test(sides, columns, by, large).select(*names)
             for test, columns in ((drift_numeric, numbers), (drift_categories, others)) if columns]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_verdict(tests: DataFrame, rules: DriftRules = DriftRules()) -> DataFrame:
    """Mark drifted columns: low p-values, or large distances; a missing score never drifts."""
    is_p = F.lower("method").contains("p_value") | F.lower("method").contains("p-value")
    threshold = F.when(is_p, rules.p_value).otherwise(rules.distance)
    hit = F.when(is_p, F.col("score") <= threshold).otherwise(F.col("score") >= threshold)
    return tests.withColumns({"threshold": threshold, "drifted": F.coalesce(hit, F.lit(False))})


def drift_report(verdicts: DataFrame, by=(), rules: DriftRules = DriftRules()) -> DataFrame:
    """Header per group: columns, drifted columns, their share and the dataset verdict."""
    share = F.count_if("drifted") / F.count("*")
    return verdicts.groupBy(*by).agg(
        F.max("reference_rows").alias("reference_rows"), F.max("current_rows").alias("current_rows"),
        F.count("*").alias("column_count"), F.count_if("drifted").alias("drifted_column_count"),
        share.alias("share_of_drifted_columns"), (share >= rules.share_threshold).alias("dataset_drift"))


def drift_gauges(report: DataFrame, verdicts: DataFrame, dataset: str, rules: DriftRules = DriftRules()) -> DataFrame:
    """Header and column results as (dataset, column, metric, value) rows."""
    def rows(df: DataFrame, column: Column, metrics: dict[str, Column]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value"))
                          for k, v in metrics.items()])
        return df.select(F.col(dataset).alias("dataset"), column.alias("column"), F.inline(cells))

    header = rows(report, F.lit("dataset"), {
        "threshold": F.lit(rules.share_threshold),
        "drifted_column_count": F.col("drifted_column_count"),
        "share_of_drifted_columns": F.col("share_of_drifted_columns"),
        "dataset_drift": F.col("dataset_drift").cast("int"),
    })
    columns = rows(verdicts, F.col("column"), {
        "drift_detected": F.col("drifted").cast("int"), "drift_score": F.col("score"),
        "threshold": F.col("threshold"),
    })
    return header.unionByName(columns).where(F.col("value").isNotNull())


def drift_breakdown(gauges: DataFrame) -> DataFrame:
    """Mean drifted share per dataset and drifted datasets per column."""
    shares = gauges.where("metric = 'share_of_drifted_columns'").groupBy(
        F.lit("dataset").alias("kind"), F.col("dataset").alias("name")).agg(F.avg("value").alias("value"))
    hits = gauges.where("metric = 'drift_detected'").groupBy(
        F.lit("column").alias("kind"), F.col("column").alias("name")).agg(F.sum("value").alias("value"))
    return shares.unionByName(hits)


def metric_lines(gauges: DataFrame, prefix: str, version: str) -> DataFrame:
    """Gauge lines of text: prefix.dataset.version.column.metric:value|g."""
    parts = [F.lit(prefix), F.col("dataset"), F.lit(version), F.col("column"), F.col("metric")]
    path = F.concat_ws(".", *[sanitize_name(p) for p in parts])
    return gauges.select(F.concat(path, F.lit(":"), F.col("value").cast("string"), F.lit("|g")).alias("line"))
