"""The growing slice store and the view kept up by ranges."""

import os
from datetime import timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from anemos.sources.slicestore import LatestView, SliceStore, slice_bits

KIND = "dataset_name string, spot_id string, forecast_time timestamp_ntz, v double"


def table(spark, *entries, dataset="train"):
    return spark.createDataFrame([(dataset, s, at(h), float(v)) for s, h, v in entries], KIND)


def content(store, dataset="train"):
    found = store.read(dataset)
    return {} if found is None else {(r.spot_id, r.forecast_time): r.v for r in found.collect()}


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_buckets_split_as_they_grow_and_replaced_slices_touch_few(spark, tmp_path):
    store = SliceStore(spark, str(tmp_path), limit=40)
    names = [f"s{i}" for i in range(50)]
    want = {}

    def write(picked, rows_each, value):
        entries = [(n, h, value) for n in picked for h in range(rows_each)]
        for n in picked:
            for key in [k for k in want if k[0] == n]:
                del want[key]
        want.update({(n, at(h)): float(value) for n, h, _ in entries})
        store.replace(table(spark, *entries))
        assert content(store) == want

    write(names[:10], 2, 1)
    assert [b.prefix for b in store.buckets()[1]] == [""]
    write(names, 3, 2)
    write(names, 8, 3)
    version, buckets = store.buckets()
    assert version == 3 and len(buckets) > 4 and sum(b.rows for b in buckets) == 400
    prefixes = [b.prefix for b in buckets]
    assert not any(p != q and q.startswith(p) for p in prefixes for q in prefixes)
    before = {b.folder for b in buckets}
    write(["s7"], 5, 9)
    after = store.buckets()[1]
    # The other buckets are named as they were; one is written anew.
    assert len(before - {b.folder for b in after}) == 1
    # The same slices again leave the same buckets: replaced rows don't count as growth.
    sizes = len(store.buckets()[1])
    write(names, 8, 4)
    assert len(store.buckets()[1]) <= sizes + 2


def test_one_slice_reads_one_bucket(spark, tmp_path):
    store = SliceStore(spark, str(tmp_path), limit=30)
    store.replace(table(spark, *[(f"s{i}", h, i) for i in range(30) for h in range(4)]))
    store.replace(table(spark, ("s3", 0, 5), dataset="other"))
    assert len(store.buckets()[1]) > 3
    one = store.read_slice("train", "s3")
    assert rows(one, "v") == [(3.0,)] * 4
    assert len({os.path.dirname(f) for f in one.inputFiles()}) == 1
    assert rows(store.read_slice("other", "s3"), "v") == [(5.0,)]
    assert store.read_slice("train", "nowhere").count() == 0 and store.read("none") is None


def test_a_crash_before_the_swap_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = SliceStore(spark, str(tmp_path))
    store.replace(table(spark, ("a", 0, 1), ("b", 0, 2)))
    old, before = content(store), files(tmp_path)

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(SliceStore, "_commit", die)
    with pytest.raises(RuntimeError, match="lost"):
        store.replace(table(spark, ("a", 1, 7)))
    assert content(store) == old and before < files(tmp_path)  # data was written, but nothing names it
    monkeypatch.undo()
    store.replace(table(spark, ("a", 1, 7)))
    assert content(store) == {("a", at(1)): 7.0, ("b", at(0)): 2.0}


def test_two_writers_from_one_version(spark, tmp_path):
    store = SliceStore(spark, str(tmp_path))
    store.replace(table(spark, ("a", 0, 1)))
    version, buckets = store.buckets()
    store.replace(table(spark, ("b", 0, 2)))
    with pytest.raises(Exception, match="(?i)exists"):
        store._commit(version, buckets, buckets[0].folder.rsplit("/", 1)[0])
    assert content(store) == {("a", at(0)): 1.0, ("b", at(0)): 2.0}


def test_odd_names_new_columns_and_readers_of_the_old_version(spark, tmp_path):
    store = SliceStore(spark, str(tmp_path))
    odd = "a/b=c %2F é"
    store.replace(table(spark, (odd, 0, 1), dataset=odd))
    reader = store.read(odd)
    store.replace(table(spark, (odd, 0, 2), dataset=odd).withColumn("added", F.lit("x")))
    assert rows(reader, "v") == [(1.0,)]  # still whole
    store.replace(table(spark, ("z", 0, 3), dataset="z"))
    assert rows(store.read(), "spot_id", "v", "added") == [(odd, 2.0, "x"), ("z", 3.0, None)]


def test_bits(spark):
    got = [r[0] for r in spark.range(200).select(slice_bits(F.lit("d"), F.col("id").cast("string"))).collect()]
    assert all(len(b) == 32 and set(b) <= {"0", "1"} for b in got) and len(set(got)) == 200


def test_ranges_may_repeat_and_overlap(spark, tmp_path):
    source = spark.createDataFrame([(f"s{i % 5}", at(i), i, float(i)) for i in range(60)], "spot_id string, time timestamp_ntz, n long, v double")
    view = LatestView(SliceStore(spark, str(tmp_path)), ("time", "n"))
    now = lambda: rows(view.store.read("online"), "spot_id", "n")
    latest = lambda stop: sorted((f"s{k}", max(i for i in range(60) if i % 5 == k and i <= stop)) for k in range(5))
    view.materialize(source, None, at(20))
    assert now() == latest(20) and view.high_water() == at(20)
    view.materialize(source, at(10), at(40))
    once = now()
    view.materialize(source, at(10), at(40))
    assert now() == once == latest(40)
    view.materialize(source, at(5), at(15))  # an old range changes nothing
    assert now() == once and view.high_water() == at(40)
    view.materialize(source, at(50), at(55))  # a gap: the mark stays before it
    assert view.high_water() == at(40)
    assert view.catch_up(source, at(59)) == 5 and now() == latest(59) and view.high_water() == at(59)
    assert view.ledger().count() == 6
    kept = view.fresh(F.lit(at(59) + timedelta(days=1)), 1)
    assert rows(kept, "n") == [(59,)]


def test_a_range_without_its_ledger_line_is_run_again(spark, tmp_path):
    source = spark.createDataFrame([("a", at(1), 1)], "spot_id string, time timestamp_ntz, n long")
    view = LatestView(SliceStore(spark, str(tmp_path)), ("time", "n"))
    view.store.replace(source.withColumn("dataset_name", F.lit("online")))  # the view was written, the line was not
    assert view.high_water() is None
    view.catch_up(source, at(2))
    assert rows(view.store.read("online"), "n") == [(1,)] and view.high_water() == at(2)
    assert view.materialize(source, at(2), at(3)) == 0 and view.high_water() == at(3)
