"""Ordered work inside a key that stays distributed when one key is huge.

A plain window puts every row of a key into one task. Here a key with more
rows than ``rows_per_segment`` is cut along its order column into segments;
windows run per (key, segment) and the little state that crosses a cut (last
value, running total, previous rows) travels through one row per segment.
Keys below the limit keep a single segment, so ordinary data pays one count.

Size bounds: a table of N rows has at most N / rows_per_segment hot keys, and
each is cut into about OVERSPLIT * n / rows_per_segment slices, so the hot-key
table and the per-segment state are a few MB for 10^10 rows and some 100 MB for
10^12. That is what makes them safe to broadcast. Should more than ``HOT_LIMIT`` keys be hot, the
segments are made larger until they are not.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from anemos.session import settle

ROWS_PER_SEGMENT = 2_000_000
OVERSPLIT = 4
LEVELS = 3
HOT_LIMIT = 500_000

SEG = "_seg"
GHOST = "_ghost"


def _scale(df: DataFrame, name: str) -> Column:
    """Order column as a double, for cutting only (never for sorting)."""
    kind = df.schema[name].dataType.typeName()
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(F.col(name)).cast("double")
    return F.col(name).cast("double")


@dataclass(frozen=True)
class Series:
    """How rows of one key are ordered, and which keys need cutting.

    ``order`` starts with the column to cut along and ends in a unique column.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: tuple[DataFrame, ...] = field(default=())

    @classmethod
    def measure(cls, df: DataFrame, keys, order, rows_per_segment: int | None = None,
                probe: DataFrame | None = None) -> Series:
        """Count rows per key once and lay out the cuts of hot keys.

        Heavy tails are cut again, up to LEVELS times, until slices fit.
        ``probe`` is a cheaper table with at least as many rows as any key of
        ``df``; while it is small, ``df`` itself is not counted.
        """
        limit = rows_per_segment or ROWS_PER_SEGMENT
        plan = cls(tuple(keys), tuple(order))
        if probe is not None and probe.count() <= limit:
            return plan
        for level in range(LEVELS):
            table = plan._hot_table(df, limit, level)
            hot = table.limit(HOT_LIMIT + 1).collect()
            while len(hot) > HOT_LIMIT:
                limit *= 4
                table = plan._hot_table(df, limit, level)
                hot = table.limit(HOT_LIMIT + 1).collect()
            if not hot:
                break
            # Read back as local rows, so that later plans do not count again.
            cut = df.sparkSession.createDataFrame(hot, table.schema)
            plan = cls(plan.keys, plan.order, (*plan.cuts, cut))
        return plan

    def ordered_by(self, *order: str) -> Series:
        """The same cuts for a table that names its order columns differently.

        Cuts measured on one table fit any table whose keys hold no more rows,
        such as a filtered or derived one.
        """
        return Series(self.keys, order, self.cuts)

    @property
    def is_cut(self) -> bool:
        return bool(self.cuts)

    def _groups(self, level: int) -> list[str]:
        return [*self.keys, *[f"_s{i}" for i in range(level)]]

    def _hot_table(self, df: DataFrame, limit: int, level: int) -> DataFrame:
        """Groups above the limit whose values differ, with their span and slice count."""
        at = self._with_segments(df)
        x = _scale(df, self.order[0])
        if level:
            at = at.where(F.col(f"_s{level - 1}") > 0)
        return (
            at.groupBy(*self._groups(level))
            .agg(F.count("*").alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi"))
            .where((F.col("_n") > limit) & (F.col("_lo") < F.col("_hi")))
            .withColumn("_slices", F.ceil(F.col("_n") / limit) * OVERSPLIT)
        )

    def _with_segments(self, df: DataFrame) -> DataFrame:
        x = _scale(df, self.order[0])
        out = df
        for level, cut in enumerate(self.cuts):
            group = self._groups(level)
            width = (F.col("_hi") - F.col("_lo")) / F.col("_slices")
            # Values outside the measured span belong to the first or last slice,
            # nulls (which sort first) to the first.
            at = F.coalesce(F.floor((x - F.col("_lo")) / width), F.lit(0))
            slot = F.greatest(F.least(at, F.col("_slices") - 1), F.lit(0)) + 1
            out = (
                _join_null_safe(out, F.broadcast(cut), group)
                .withColumn(f"_s{level}", F.when(F.col("_lo").isNull(), 0).otherwise(slot).cast("bigint"))
                .drop("_n", "_lo", "_hi", "_slices")
            )
        return out

    def cut(self, df: DataFrame) -> DataFrame:
        """Add the segment column; rows of ordinary keys get a constant."""
        if not self.cuts:
            return df.withColumn(SEG, F.lit(0).cast("bigint"))
        names = [f"_s{i}" for i in range(len(self.cuts))]
        return self._with_segments(df).withColumn(SEG, F.struct(*names)).drop(*names)

    def hot_rows(self, cut: DataFrame) -> DataFrame:
        return cut.where(F.col(f"{SEG}._s0") > 0)

    def window(self, descending: bool = False):
        order = [F.desc(c) if descending else F.asc(c) for c in self.order]
        by = [*self.keys, SEG] if self.cuts else list(self.keys)
        return Window.partitionBy(*by).orderBy(*order)

    def whole(self):
        by = [*self.keys, SEG] if self.cuts else list(self.keys)
        return Window.partitionBy(*by)

    def segments(self, descending: bool = False):
        """Window over the one-row-per-segment state of a hot key."""
        return Window.partitionBy(*self.keys).orderBy(F.desc(SEG) if descending else F.asc(SEG))


# Growing frames only: Spark walks them once. A shrinking frame (current row to
# the end) is recomputed for every row, so looking back means sorting downwards.
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, 0)


#: Fields of a segment's state up to which it is sent to every task; more, or nested or text ones, and it is shuffled.
SENT_FIELDS = 16


def _join_null_safe(rows: DataFrame, side: DataFrame, names) -> DataFrame:
    """Left join on columns of the same name in which a null meets a null."""
    for n in names:
        side = side.withColumnRenamed(n, f"_k_{n}")
    same = [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in names]
    return rows.join(side, reduce(lambda a, b: a & b, same), "left").drop(*[f"_k_{n}" for n in names])


def _attach(rows: DataFrame, state: DataFrame, series: Series) -> DataFrame:
    names = [*series.keys, SEG]
    fields = [f for f in state.schema.fields if f.name not in names]
    # The number of segments is bounded, so narrow rows are; payloads of any width are not.
    narrow = len(fields) <= SENT_FIELDS and all(isinstance(f.dataType, (NumericType, DatetimeType, BooleanType)) for f in fields)
    return _join_null_safe(rows, F.broadcast(state) if narrow else state, names)


def fill(df: DataFrame, series: Series, forward: dict[str, str] | None = None,
         backward: dict[str, str] | None = None) -> DataFrame:
    """Add nearest non-null values: ``forward`` at or before the row, ``backward`` at or after.

    Each mapping names output column -> input column.
    """
    forward, backward = forward or {}, backward or {}
    cut = series.cut(df)
    up, down = series.window().rowsBetween(*_UP_TO), series.window(descending=True).rowsBetween(*_UP_TO)
    out = cut.withColumns({
        **{n: F.last(c, ignorenulls=True).over(up) for n, c in forward.items()},
        **{n: F.last(c, ignorenulls=True).over(down) for n, c in backward.items()},
    })
    if series.is_cut:
        at = F.struct(*series.order)
        edge = series.hot_rows(cut).groupBy(*series.keys, SEG).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_f_{n}") for n, c in forward.items()],
            *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_b_{n}") for n, c in backward.items()],
        )
        earlier = series.segments().rowsBetween(*_BEFORE)
        later = series.segments(descending=True).rowsBetween(*_BEFORE)
        state = edge.select(
            *series.keys, SEG,
            *[F.last(f"_f_{n}", True).over(earlier).alias(f"_f_{n}") for n in forward],
            *[F.last(f"_b_{n}", True).over(later).alias(f"_b_{n}") for n in backward],
        )
        out = _attach(out, state, series).withColumns({
            **{n: F.coalesce(n, f"_f_{n}") for n in forward},
            **{n: F.coalesce(n, f"_b_{n}") for n in backward},
        }).drop(*[f"_f_{n}" for n in forward], *[f"_b_{n}" for n in backward])
    return out.drop(SEG)


def running_totals(df: DataFrame, series: Series, sums: dict[str, str],
                   totals: dict[str, str] | None = None) -> DataFrame:
    """Add running sums (and whole-key sums) of non-null numeric columns."""
    totals = totals or {}
    cut = series.cut(df)
    w = series.window().rowsBetween(*_UP_TO)
    out = cut.withColumns({
        **{n: F.sum(c).over(w) for n, c in sums.items()},
        **{n: F.sum(c).over(series.whole()) for n, c in totals.items()},
    })
    if series.is_cut:
        columns = sorted({*sums.values(), *totals.values()})
        edge = series.hot_rows(cut).groupBy(*series.keys, SEG).agg(
            *[F.sum(c).alias(f"_t_{c}") for c in columns])
        ws = series.segments()
        everything = Window.partitionBy(*series.keys)
        state = edge.select(
            *series.keys, SEG,
            *[F.sum(f"_t_{c}").over(ws.rowsBetween(*_BEFORE)).alias(f"_p_{n}") for n, c in sums.items()],
            *[F.sum(f"_t_{c}").over(everything).alias(f"_w_{n}") for n, c in totals.items()],
        )
        out = _attach(out, state, series).withColumns({
            **{n: F.coalesce(F.col(n) + F.col(f"_p_{n}"), n, f"_p_{n}") for n in sums},
            **{n: F.coalesce(F.col(f"_w_{n}"), F.col(n)) for n in totals},
        }).drop(*[f"_p_{n}" for n in sums], *[f"_w_{n}" for n in totals])
    return out.drop(SEG)


def number_rows(df: DataFrame, series: Series, position: str = "position",
                count: str | None = None) -> DataFrame:
    """Add the 1-based position in the key and, if asked, the rows of the key."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(
        one, series, {position: "_one"}, {count: "_one"} if count else None
    ).drop("_one")


def with_lookback(df: DataFrame, series: Series, rows: int) -> DataFrame:
    """Cut rows and prepend to each segment copies of the ``rows`` rows before it.

    Window functions reaching back at most ``rows`` rows are then exact on the
    rows with a false ghost flag. Use ``series.window()`` and drop ghosts after.
    """
    cut = series.cut(df)
    if not series.is_cut:
        return cut.withColumn(GHOST, F.lit(False))
    tail = (
        series.hot_rows(cut)
        .withColumn("_back", F.row_number().over(series.window(descending=True)))
        .where(F.col("_back") <= rows)
    )
    rest = [c for c in df.columns if c not in series.order]
    packed = F.struct(*series.order, *[c for c in rest if c not in series.keys])
    tails = tail.groupBy(*series.keys, SEG).agg(F.sort_array(F.collect_list(packed)).alias("_tail"))
    ws = series.segments()
    nothing = F.expr("slice(_tail, 1, 0)")
    earlier = F.concat(
        *[F.coalesce(F.lag("_tail", k).over(ws), nothing) for k in range(rows, 0, -1)]
    )
    ghosts = (
        tails.withColumn("_prev", earlier)
        .withColumn("_prev", F.expr(f"slice(_prev, greatest(size(_prev) - {rows - 1}, 1), {rows})"))
        .select(*series.keys, SEG, F.explode("_prev").alias("_row"))
        .select(*series.keys, SEG, "_row.*")
    )
    return cut.withColumn(GHOST, F.lit(False)).unionByName(ghosts.withColumn(GHOST, F.lit(True)))


def drop_lookback(df: DataFrame) -> DataFrame:
    return df.where(~F.col(GHOST)).drop(GHOST, SEG)


def islands(df: DataFrame, series: Series, flag: str) -> DataFrame:
    """Runs of equal ``flag``: adds ``island``, a number that grows at each change."""
    look = with_lookback(df, series, 1)
    before = F.lag(flag).over(series.window())
    changed = drop_lookback(look.withColumn(
        "_change", F.when(before.isNull() | before.eqNullSafe(F.col(flag)), 0).otherwise(1).cast("bigint")
    ))
    return running_totals(changed, series, {"island": "_change"}).drop("_change")


def global_positions(df: DataFrame, order, position: str = "position") -> DataFrame:
    """Add the 1-based place of each row in the order of the whole table, without gathering it.

    Rows are dealt out by range and stored, so that every later read sees the same ranges; a range's
    first place is the number of rows in the ranges before it (one row per range).
    """
    ranged = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(*_BEFORE)), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_inside", inside).join(F.broadcast(before), "_range").withColumn(
        position, F.col("_start") + F.col("_inside")).drop("_range", "_inside", "_start")
