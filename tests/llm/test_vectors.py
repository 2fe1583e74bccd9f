import numpy as np
import pytest

from anemos.llm import neardup, neighbours
from anemos.llm.components import components
from anemos.llm.vectors import diverse, with_reverse

KIND = "vec_id long, embedding array<float>, vector string, links int"


def groups_of_vectors(seed=1, n=500, size=24):
    """Random vectors, tight groups, equal and scaled copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size))
    out = [base, base[:1] + 0.05 * rng.normal(size=(180, size)), base[5:25] + 0.06 * rng.normal(size=(20, size)),
           np.repeat(base[30:31], 12, axis=0), 3 * base[31:33]]
    return np.concatenate(out).astype(np.float32)


def table(spark, vectors, extra=()):
    rows = [(i, [float(x) for x in v], "clash", 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows + list(extra), KIND)


ODD = [(9001, None, "x", 0), (9002, [0.0] * 24, "x", 0), (9003, [float("nan")] * 24, "x", 0), (None, [1.0] * 24, "x", 0),
       (9004, [float("inf")] + [1.0] * 23, "x", 0), (9005, [None] + [1.0] * 23, "x", 0), (9006, [1.0, 2.0], "x", 0),
       (9007, [], "x", 0), (3, None, "repeated id", 0)]


def cosines(vectors):
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    return units @ units.T


def plain_components(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("together", [8192, 50])
def test_vectors_that_clusters_tear_apart_are_compared_with_all(spark, monkeypatch, together):
    """No overlap and no widening: links lost between clusters come back from the comparison in blocks."""
    monkeypatch.setattr(neardup, "COPIES", 0)
    monkeypatch.setattr(neardup, "OVERLAPS", (0.0, 4.0))
    monkeypatch.setattr(neardup, "SLACK", 1.5)
    monkeypatch.setattr(neardup, "TOGETHER", together)
    rng = np.random.default_rng(8)
    groups = rng.normal(size=(60, 24))
    vectors = (np.repeat(groups, 6, axis=0) + 0.3 * rng.normal(size=(360, 24))).astype(np.float32)
    vectors = np.concatenate((vectors, vectors[:5], rng.normal(size=(80, 24)).astype(np.float32)))
    cos = cosines(vectors)
    np.fill_diagonal(cos, -1)
    called = []
    real = neardup.links_with_all
    monkeypatch.setattr(neardup, "links_with_all", lambda marked, t: called.append(marked.where("failing").count()) or real(marked, t))
    got = {r["vec_id"]: r for r in neardup.near_duplicates(table(spark, vectors, ODD), shard_rows=64).collect()}
    # All vectors are audited here, so each cluster that misses a link is known.
    assert called and called[0] > 0
    assert [got[i]["n_links"] for i in range(len(vectors))] == (cos >= 0.9).sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(vectors))] == plain_components(len(vectors), np.argwhere(np.triu(cos >= 0.9)))


@pytest.mark.parametrize("shard_rows", [2048, 96])
def test_near_duplicates(spark, shard_rows):
    vectors = groups_of_vectors()
    cos = cosines(vectors)
    np.fill_diagonal(cos, -1)
    pairs = np.argwhere(np.triu(cos >= 0.9))
    got = neardup.near_duplicates(table(spark, vectors, ODD), shard_rows=shard_rows).collect()
    assert len(got) == len(vectors) + len(ODD)
    links = {r["vec_id"]: r["n_links"] for r in got}
    recall = sum(links[i] for i in range(len(vectors))) / (2 * len(pairs))
    assert 0.9 <= recall <= 1 and all(links[i] <= (cos[i] >= 0.9).sum() for i in range(len(vectors)))
    if shard_rows == 2048:
        assert recall == 1
    want = plain_components(len(vectors), pairs)
    found = {r["vec_id"]: r["component_id"] for r in got}
    assert np.mean([found[i] == want[i] for i in range(len(vectors))]) >= 0.99
    for r in got:
        assert r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"])
        if r["vec_id"] is None or r["vec_id"] > 9000:
            assert (r["n_links"], r["component_id"]) == (0, r["vec_id"])


def test_one_near_group_over_many_clusters(spark):
    """A third of the rows are near copies of one vector, the others groups of ten: no group is torn by clusters."""
    rng = np.random.default_rng(7)
    near = lambda base, n, cos: np.repeat(base, n, axis=0) + np.sqrt(1 / cos - 1) * rng.normal(size=(n * len(base), 64))
    vectors = np.concatenate((near(rng.normal(size=(1, 64)), 1000, 0.95), near(rng.normal(size=(200, 64)), 10, 0.93))).astype(np.float32)
    cos = cosines(vectors)
    np.fill_diagonal(cos, -1)
    want = (cos >= 0.9).sum(axis=1)
    got = {r["vec_id"]: r["n_links"] for r in neardup.near_duplicates(table(spark, vectors), shard_rows=128).collect()}
    found = np.array([got[i] for i in range(len(vectors))])
    assert (found <= want).all()
    assert found[:1000].sum() >= 0.999 * want[:1000].sum()
    assert found[1000:].sum() >= 0.99 * want[1000:].sum()


def test_audit_sees_pairs_between_clusters(spark):
    angles = np.radians([44, 46, 5, 6])
    rows = [(i, [float(np.cos(a)), float(np.sin(a))], 1 + i) for i, a in enumerate(angles)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>, weight long")
    links, held, _, _ = neardup.audit(df, {2: (np.eye(2), np.arange(2))}, 0.95)
    assert links == {0: 2, 1: 1, 2: 4, 3: 3}
    # The first pair has a cluster in common only where clusters overlap by more than cos 44 - sin 44.
    assert held.tolist() == [0.5] + [1.0] * (len(neardup.OVERLAPS) - 1)


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], KIND)
    assert neardup.near_duplicates(empty).count() == 0
    assert neighbours.nearest(empty, "vec_id", "embedding", 5).count() == 0


@pytest.mark.parametrize("shard_rows", [4096, 150])
def test_nearest(spark, shard_rows):
    vectors = groups_of_vectors(2)
    cos = cosines(vectors)
    np.fill_diagonal(cos, -9)
    got = neighbours.nearest(table(spark, vectors, ODD), "vec_id", "embedding", 5, every=10, shard_rows=shard_rows).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(range(0, len(vectors), 10)), "ids without a usable vector ask nothing"
    hits = 0
    for q, found in by.items():
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        assert found == sorted(found, key=lambda r: (-r["score"], r["vec_id"]))
        assert all(abs(r["score"] - cos[q, r["vec_id"]]) < 1e-12 for r in found)
        hits += sum(cos[q, r["vec_id"]] >= np.sort(cos[q])[-5] - 1e-12 for r in found)
    assert hits / (5 * len(by)) >= 0.95


def test_fewer_candidates_and_ties(spark):
    rows = [(0, [1.0, 0.0], "", 0), (7, [2.0, 0.0], "", 0), (3, [1.0, 0.0], "", 0), (50, [0.0, 1.0], "", 0), (100, [1.0, 1.0, 1.0], "", 0)]
    got = neighbours.nearest(spark.createDataFrame(rows, KIND), "vec_id", "embedding", 5).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(got)] == [
        (0, 1, 3, 1.0), (0, 2, 7, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 3, 0.0), (50, 3, 7, 0.0)]


def test_many_equal_vectors(spark):
    """A third of the rows are equal: their queries get the smallest other ids of the group."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(900, 24)).astype(np.float32)
    equal = rng.permutation(900)[:300]
    vectors[equal] = vectors[equal[0]]
    got = neighbours.nearest(table(spark, vectors), "vec_id", "embedding", 5, every=10, shard_rows=450).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(by) == set(range(0, 900, 10))
    asked = [q for q in by if q in set(equal.tolist())]
    assert len(asked) > 20
    for q in asked:
        assert by[q] == [i for i in sorted(equal.tolist()) if i != q][:5]


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(400 + i, 401 + i) for i in range(60)]
    want = plain_components(500, pairs)
    df = spark.createDataFrame([*pairs, (5, 5), (None, 3), (4, None)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(df).collect()}
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i: want[i] for i in linked}
    assert components(df.limit(0)).count() == 0


def test_pruning():
    units = np.array([[1, 0], [0.999, 0.0447], [0, -1.0], [0.98, 0.199]])
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = np.array([[1, 3, 2]], dtype=np.int32)
    kept = diverse(near, (units[near[0]] @ units[0])[None], units, 3, 1.0)
    assert kept.tolist() == [[1, 2, -1]]
    assert with_reverse(np.array([[1], [2], [-1]]), 2).tolist() == [[1, -1], [2, 0], [1, -1]]
