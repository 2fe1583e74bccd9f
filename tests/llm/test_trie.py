"""The prefix trie against a plain one of nested paths, over one shard and many."""

import hashlib
import random
import zlib

import pytest

from anemos.llm import trie
from anemos.llm.queries import QUERIES
from conftest import SMALL

KIND = "conv_id long, turn long, role string, text string, depth string, prefix int"


def plain(rows):
    """The contract, word by word."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    nodes = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(convs.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], ([], []))[0].append(c)
        nodes[path][1].append(c)
    out = []
    children, leaves, saved = {}, {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        own = children.get(path, 0)
        leaves[path] = leaves.get(path, 0) + (own == 0)
        saved[path] = saved.get(path, 0) + (len(nodes[path][0]) - 1) * (len(path[-1][1]) if path else 0)
        if path:
            up = path[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
        members, ends = nodes[path]
        out.append((min(members), len(path), min(nodes[path[:-1]][0]) if path else None, len(members), own, leaves[path], saved[path],
                    hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def found(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in df.collect()], key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], KIND)


def dialogues(seed=3, convs=260):
    """Few distinct turns, so that paths share much; copies, odd values and one long conversation twice."""
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        size = r.choice([1, 2, 3, 5, 8])
        for t in range(size):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "bb", "ünï", "𝒳y"]) if t < 3 else f"{t} {r.randrange(3)}"))
    long = [("user", f"turn {k}") for k in range(150)]
    for c, size, last in ((400, 150, "x"), (500, 150, "y"), (600, 70, "x"), (700, 150, "x"), (801, 5, "z")):
        rows += [(c, t, *(long[t] if t < size - 1 else ("user", last))) for t in range(size)]
    rows += [(900, None, None, None), (900, None, "user", "b"), (900, 0, "user", "a"), (900, 0, "user", "a"), (None, 0, "user", "x"),
             (-250, 1, "", "neg"), (-250, 2, "user", ""), (950, 3, "user", "x" * 50_000), (99_999_999, 0, "a", "b"), (None, None, None, None)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard, step", [(500_000, 64), (40, 64), (7, 3), (40, 16)])
def test_equal_to_a_plain_trie(spark, monkeypatch, shard, step):
    monkeypatch.setattr(trie, "SHARD", shard)
    monkeypatch.setattr(trie, "STEP", step)
    monkeypatch.setattr(trie, "MOST_SHARDS", 24)
    rows = dialogues()
    out = trie.prefix_trie(table(spark, rows))
    assert found(out) == plain(rows)
    assert out.columns and set(out.columns) == set(COLUMNS)


def test_many_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "LISTED", 20)
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(2)] + [(1000 + c, 0, "user", str(c % 4)) for c in range(40)]
    assert found(trie.prefix_trie(table(spark, rows))) == plain(rows)


def test_a_hot_conversation_is_cut(spark, monkeypatch):
    from anemos.operators import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_SEGMENT", 50)
    rows = [(7, t, "user", f"t{t % 11}") for t in range(500)] + [(c, t, "user", f"t{t}") for c in range(30, 80) for t in range(4)]
    assert found(trie.prefix_trie(table(spark, rows))) == plain(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert trie.prefix_trie(table(spark, [])).count() == 0
    assert trie.prefix_trie(table(spark, [(None, 1, "a", "b")])).count() == 0
    rows = [(c, 0, "user", "gone") for c in range(1, 60)]
    got = found(trie.prefix_trie(table(spark, rows)))
    assert got == plain(rows) and any(r[1] == 0 and r[7] != trie.NO_ENDS for r in got)


def test_the_table_itself(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_prefix_trie"](spark, SMALL)) == plain(rows)
