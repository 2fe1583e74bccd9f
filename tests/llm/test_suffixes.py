"""Removed repeats against a plain table of first places, and previous factors against all pairs."""

import hashlib
import random

import numpy as np
import pytest

from anemos.llm import suffixes
from anemos.llm.queries import QUERIES
from conftest import SMALL

KIND = "doc_id long, text string, doc string, at int"


def plain(rows, length=100):
    """The contract, byte by byte. Rows: (doc_id, text); equal ids only with equal texts."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        data = (rows[i][1] or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if data[s:s + length] in seen:
                covered[s:s + length] = b"\1" * length
            seen.add(data[s:s + length])
        kept = bytes(b for b, c in zip(data, covered) if not c)
        runs = sum(c and not (p and covered[p - 1]) for p, c in enumerate(covered))
        out.append((rows[i][0], len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()], key=str)


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], KIND).repartition(parts)


def texts(seed=4):
    r = random.Random(seed)
    words = ["lorem", "ipsum", "dolor", "sit", "ünïcode", "amet", "elit", "x", "\U0001d54f", "sed"]
    prose = lambda n: " ".join(r.choice(words) + str(r.randrange(50)) for _ in range(n))
    line = prose(12)  # under and over 100 bytes, between other words
    passage = prose(70)
    rows = []
    for i in range(120):
        parts = [prose(r.randrange(2, 60))]
        if i % 3 == 0:
            parts.insert(r.randrange(2), line)
        if i % 4 == 0:
            low = r.randrange(0, 200)
            parts.insert(r.randrange(2), passage[low:low + r.randrange(80, 300)])
        rows.append((i, " ".join(parts)))
    base = prose(150)
    for i in range(200, 230):  # near copies
        at = r.randrange(len(base))
        rows.append((i, base[:at] + r.choice("abc") + base[at + 1:]))
    rows += [(300 + i, base) for i in range(20)]
    rows += [(400, "ab" * 400), (401, "a" * 3000), (402, "a" * 99), (403, "b" * 100), (404, "b" * 101), (405, "abc" * 60 + "Q" + "abc" * 60),
             (406, None), (407, ""), (408, prose(20) * 5), (None, base + "!"), (409, "\0" * 150 + prose(30) + "\0" * 150), (-5, base[:250])]
    rows += [(410, (prose(40) + " ") * 3), (411, passage * 2)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"GROUP_BYTES": 600, "BATCH_BYTES": 1}, {"CHUNK": 700}, {"WINDOWS": 7, "REMEMBERED": 3}])
def test_equal_to_a_plain_table(spark, monkeypatch, limits):
    from anemos.llm import textarrays

    for name, value in limits.items():
        monkeypatch.setattr(suffixes, name, value)
        if name == "CHUNK":
            monkeypatch.setattr(textarrays, name, value)
    rows = texts()
    assert found(suffixes.remove_repeats(table(spark, rows))) == plain(rows)


def test_common_groups_are_dealt_by_piece(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "heavy_keys", lambda docs, length, gram: HEAVY)
    rows = texts(9)
    from anemos.llm.textarrays import chunks
    import pyarrow as pa
    keys = np.concatenate([suffixes.cut_pieces(t, 100, 40).key for t in chunks(pa.array([t for _, t in rows]))])
    value, count = np.unique(keys, return_counts=True)
    HEAVY = value[count > 3]
    assert len(HEAVY)
    assert found(suffixes.remove_repeats(table(spark, rows))) == plain(rows)


def test_sampled_groups(spark):
    docs = spark.createDataFrame([(i, 0, f"{i} " * 40 + "a common line of some length " * 5) for i in range(1200)], "doc long, dg long, text string")
    heavy = suffixes.heavy_keys(docs, 100, 40)
    assert 0 < len(heavy) < 50


def test_equal_rows_and_ids(spark):
    text = "some text that is long enough to be removed where it is repeated " * 3
    rows = [(1, text), (1, text), (1, "short"), (1, "short"), (2, text + "x"), (1, "other " + text)]
    got = found(suffixes.remove_repeats(table(spark, rows, 2)))
    assert len(got) == 6
    whole = [r for r in got if r[1] == len(text)]
    # Of the two equal rows one goes whole; the two texts of one id keep together what one text holds.
    assert sum(r[2] == r[1] for r in whole) >= 1
    assert all(r[2] == 0 for r in got if r[1] == 5)
    assert [r[2] for r in got if r[0] == 2] == [len(text) + 1] or [r[2] for r in got if r[0] == 2] == [len(text)]


def test_empty_table_and_short_texts(spark):
    assert found(suffixes.remove_repeats(table(spark, []))) == []
    assert found(suffixes.remove_repeats(table(spark, [(1, "a"), (2, "a")]))) == plain([(1, "a"), (2, "a")])


def test_previous_factors_of_all_pairs():
    rng = np.random.default_rng(0)
    for size in (1, 2, 40, 300):
        data = rng.integers(0, 2, size + 30).astype(np.uint8)
        order = sorted(range(size), key=lambda i: data[i:].tobytes())
        share = lambda a, b: next((k for k, (x, y) in enumerate(zip(data[a:], data[b:])) if x != y), len(data) - max(a, b))
        common = np.array([0] + [share(a, b) for a, b in zip(order, order[1:])])
        got = suffixes.longest_previous(np.array(order), common, 1)
        assert got.tolist() == [max([share(i, j) for j in range(i)], default=0) for i in order]


def test_a_very_long_text(spark):
    r = random.Random(1)
    long = "".join(r.choice("abcdefgh ") for _ in range(1_300_000))
    rows = [(1, long), (2, "zz" + long[500_000:700_000] + "zz"), (3, long)]
    got = found(suffixes.remove_repeats(table(spark, rows, 3)))
    assert [g[2] for g in got] == [0, 200_000, 1_300_000]


def test_the_table_itself(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op11_suffix_dedup"](spark, SMALL)) == plain(rows)
