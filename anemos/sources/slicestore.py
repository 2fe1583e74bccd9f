"""A store of replaceable slices that grows with its data and changes versions in one step.

Slices (dataset, spot) are hashed; a bucket holds the slices of one dataset whose hash starts with the bucket's prefix. A
bucket that outgrows ``limit`` rows is split by further bits when it is next written, so replacing a
slice rewrites that slice and at most about ``limit`` rows of its neighbours, whatever the store's size.

A write puts new buckets into a folder of its own and then adds one manifest file, which names the folders of all
live buckets. The manifest of the highest version is the store: readers see the old buckets or the new ones, and
a job that dies before its manifest changes nothing. One job may write at a time; a second one that started from the same
version fails. Folders that no manifest names any more can be removed by age.

The manifest is one line per bucket (200 000 for 10^12 rows) and passes through the driver; data doesn't.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.operators.ranking import latest_per_key
from anemos.schemas import require_columns
from anemos.session import settle
from anemos.sources.writers import MICROS, stored_table

BITS = 32
LIMIT = 5_000_000
BUCKETS = "dataset_name string, prefix string, folder string, rows long, shape string"


@dataclass(frozen=True)
class Bucket:
    dataset_name: str
    prefix: str
    folder: str
    rows: int
    shape: str


def slice_bits(*keys) -> Column:
    """The first bits of a slice's hash as text of 0 and 1."""
    low = F.xxhash64(*keys).bitwiseAND(F.lit((1 << BITS) - 1))
    return F.lpad(F.bin(low), BITS, "0")


@dataclass(frozen=True)
class SliceStore:
    spark: SparkSession
    path: str
    limit: int = LIMIT
    keys: tuple[str, str] = ("dataset_name", "spot_id")

    def buckets(self, version: int | None = None) -> tuple[int, list[Bucket]]:
        """Number of the current version (or the one asked for) and its buckets; version 0 is the empty store."""
        found = stored_table(self.spark, f"{self.path}/manifest", "json", f"{BUCKETS}, version long")
        if found is not None and version is None:
            version = found.agg(F.max("version")).first()[0]
        if found is None or not version:
            return 0, []
        lines = found.where((F.col("version") == version) & F.col("prefix").isNotNull()).drop("version").collect()
        return version, [Bucket(**line.asDict()) for line in lines]

    def _read(self, buckets: list[Bucket]) -> DataFrame | None:
        if not buckets:
            return None
        # Footers are compared only where buckets were written with different columns.
        mixed = len({b.shape for b in buckets}) > 1
        return self.spark.read.option("mergeSchema", mixed).parquet(*[f"{self.path}/{b.folder}" for b in buckets])

    def read(self, dataset: str | None = None) -> DataFrame | None:
        """All slices, or those of one dataset; None where there are none."""
        return self._read([b for b in self.buckets()[1] if dataset in (None, b.dataset_name)])

    def read_slice(self, dataset: str, spot_id) -> DataFrame | None:
        """One slice: one bucket is read."""
        bits = self.spark.range(1).select(slice_bits(F.lit(dataset), F.lit(spot_id).cast("string"))).first()[0]
        found = self._read([b for b in self.buckets()[1] if b.dataset_name == dataset and bits.startswith(b.prefix)])
        return None if found is None else found.where(F.col(self.keys[1]) == F.lit(spot_id))

    def _bits(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bits", slice_bits(self.keys[0], F.col(self.keys[1]).cast("string")))

    def _owned(self, df: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
        """Add the prefix of the bucket that each row's slice belongs to; null where there is none.

        No bucket's prefix starts with another's, so one join for each length of prefix finds it.
        """
        out, found, own = self._bits(df), F.lit(None).cast("string"), []
        for n in sorted({len(p) for _, p in names}):
            some = self.spark.createDataFrame([x for x in names if len(x[1]) == n], f"_d{n} string, _p{n} string")
            out = out.join(F.broadcast(some), (F.col(self.keys[0]) == F.col(f"_d{n}")) & (F.substring("_bits", 1, n) == F.col(f"_p{n}")), "left")
            found = F.coalesce(found, F.col(f"_p{n}"))
            own += [f"_d{n}", f"_p{n}"]
        return out.withColumn("_prefix", found).drop(*own)

    def _added(self, slices: DataFrame, buckets: list[Bucket]) -> dict[tuple[str, str], int]:
        """Datasets and prefixes of the buckets that some slices belong to, with the slices' rows (``_n``)."""
        dataset = self.keys[0]
        owners = self._owned(slices, [(b.dataset_name, b.prefix) for b in buckets])
        return {(r[dataset], r["_prefix"]): r["n"] for r in owners.groupBy(
            dataset, F.coalesce("_prefix", F.lit("")).alias("_prefix")).agg(F.sum("_n").alias("n")).collect()}

    def read_for(self, df: DataFrame, version: int | None = None) -> DataFrame | None:
        """The stored rows of the slices in ``df``; only their buckets are read."""
        slices = settle(df.groupBy(*self.keys).agg(F.count("*").alias("_n")), "slices")
        _, buckets = self.buckets(version)
        added = self._added(slices, buckets)
        stored = self._read([b for b in buckets if (b.dataset_name, b.prefix) in added])
        return None if stored is None else stored.join(slices.drop("_n"), list(self.keys), "left_semi")

    def replace(self, df: DataFrame, base: int | None = None) -> int:
        """Replace exactly the slices present in ``df`` (a stored table, it is read twice); the number of the new version.

        With a version given as ``base`` the new one follows on it, and takes the place of one that did so before: a
        batch that is repeated starts from the same state and gives the same version.
        """
        dataset, spot = self.keys
        require_columns(df, self.keys, "slice write")
        version, buckets = self.buckets(base)
        mode = "errorifexists" if base is None else "overwrite"
        slices = settle(df.groupBy(dataset, spot).agg(F.count("*").alias("_n")), "slices")
        added = self._added(slices, buckets)
        if not added:
            self._commit(base or version, buckets, None, mode)
            return (base or version) + 1
        touched = [b for b in buckets if (b.dataset_name, b.prefix) in added]
        names = list(added)
        rows = self._owned(df, names)
        old = self._read(touched)
        if old is not None:
            kept = self._owned(old.join(slices.drop("_n"), [dataset, spot], "left_anti"), names)
            for r in kept.groupBy(dataset, "_prefix").agg(F.count("*").alias("n")).collect():
                added[r[dataset], r["_prefix"]] += r["n"]
            rows = rows.unionByName(kept, allowMissingColumns=True)
        # A bucket beyond the limit gets as many more bits as halve it below.
        sizes = [(d, p, min(BITS, len(p) + (ceil(log2(n / self.limit)) if n > self.limit else 0))) for (d, p), n in added.items()]
        plan = F.broadcast(self.spark.createDataFrame(sizes, f"{dataset} string, _prefix string, _length int"))
        mark = F.concat(F.lit("b"), F.substring("_bits", F.lit(1), F.col("_length")), F.lit("-"), F.substring(F.sha2(dataset, 256), 1, 16))
        target = rows.join(plan, [dataset, "_prefix"]).withColumn("_bucket", mark).drop("_bits", "_prefix", "_length")
        folder = f"data/{uuid.uuid4().hex}"
        target.hint("rebalance", F.col("_bucket")).sortWithinPartitions("_bucket", spot).write.partitionBy("_bucket").parquet(
            f"{self.path}/{folder}")
        self._commit(base or version, [b for b in buckets if (b.dataset_name, b.prefix) not in added], folder, mode)
        return (base or version) + 1

    def _commit(self, version: int, kept: list[Bucket], folder: str | None, mode: str = "errorifexists") -> None:
        """Name the new buckets beside the kept ones in the manifest of the next version."""
        live = list(kept)
        if folder is not None:
            written = stored_table(self.spark, f"{self.path}/{folder}")
            shape = hashlib.sha256(written.drop("_bucket").schema.json().encode()).hexdigest()[:16]
            found = written.groupBy("_bucket").agg(F.first(self.keys[0]).alias("d"), F.count("*").alias("n")).collect()
            live += [Bucket(r["d"], r["_bucket"][1:].partition("-")[0], f"{folder}/_bucket={r['_bucket']}", r["n"], shape) for r in found]
        # A version without a bucket has a line without a prefix.
        lines = self.spark.createDataFrame([(b.dataset_name, b.prefix, b.folder, b.rows, b.shape) for b in live] or [(None,) * 5], BUCKETS)
        lines.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(f"{self.path}/manifest/version={version + 1}")


# --- the latest row of each spot, kept up by ranges -----------------------------------------

RANGES = "range_start timestamp_ntz, range_end timestamp_ntz, rows long, version long"


@dataclass(frozen=True)
class LatestView:
    """The latest row of each spot, materialized by time ranges, with a ledger of the ranges.

    A range's latest rows are merged with those stored for the same spots, and the later one stays, so a range that is run
    twice or overlaps others leaves the same view. Only the buckets of spots in the range are rewritten. The ledger is
    written after the view: a range without its line is simply run again.
    """

    store: SliceStore
    order: tuple[str, ...]
    dataset: str = "online"

    @property
    def time(self) -> str:
        return self.order[0]

    def materialize(self, source: DataFrame, start, end) -> int:
        """Take in the rows after ``start`` (null: from the first) up to ``end``; the number of spots with rows in it."""
        dataset, spot = self.store.keys
        inside = F.col(self.time) <= F.lit(end)
        rows = source.where(inside if start is None else inside & (F.col(self.time) > F.lit(start)))
        best = settle(latest_per_key(rows.withColumn(dataset, F.lit(self.dataset)), (spot,), self.order), "latest")
        stored = self.store.read_for(best)
        if stored is not None:
            both = best.unionByName(stored, allowMissingColumns=True)
            best = settle(latest_per_key(both, (spot,), self.order), "latest")
        count = best.count()
        version = self.store.replace(best) if count else self.store.buckets()[0]
        line = self.store.spark.createDataFrame([(start, end, count, version)], RANGES)
        line.coalesce(1).write.mode("append").option("timestampNTZFormat", MICROS).json(f"{self.store.path}/ledger")
        return count

    def ledger(self) -> DataFrame:
        found = stored_table(self.store.spark, f"{self.store.path}/ledger", "json", RANGES)
        return self.store.spark.createDataFrame([], RANGES) if found is None else found

    def high_water(self):
        """The time up to which ranges follow on one another from the first one on; null before the first."""
        reached = None
        for line in self.ledger().orderBy(F.asc_nulls_first("range_start"), "range_end").collect():
            if reached is not None and line["range_start"] is not None and line["range_start"] > reached:
                break
            reached = line["range_end"] if reached is None else max(reached, line["range_end"])
        return reached

    def catch_up(self, source: DataFrame, end) -> int:
        """Materialize from the high-water mark on."""
        return self.materialize(source, self.high_water(), end)

    def fresh(self, now: Column, days: int) -> DataFrame | None:
        """The view without rows older than its time to live."""
        stored = self.store.read(self.dataset)
        return None if stored is None else stored.where(F.col(self.time) >= now - F.make_dt_interval(F.lit(days))).drop(self.store.keys[0])
