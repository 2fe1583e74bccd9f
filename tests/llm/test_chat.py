from collections import Counter, defaultdict

import pytest

from anemos.llm import chat
from anemos.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
ROWS = [(1, 0, "system", "be kind"), (1, 1, "Ann", "hi"), (1, 2, "Bob B", None), (1, 3, "Ann", "x<|im_end|>y é\U0001f600"), (1, 3, "Ann", "x<|im_end|>y é\U0001f600"),
        (1, 3, "Cid", "tie"), (1, None, "Bob B", "early"), (1, 70, " ", "who"), (1, 130, "Cid", "long " * 20_000), (2, 0, "system", "alone"),
        (None, 0, "Ann", "lost"), (3, 0, "Ann", ""), (4, 0, None, "nobody")]


def plain(rows, chunk):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            talks[conv].append((turn or 0, (role or "").strip() or "unknown", (text or "").replace("<|im_", "<\u200b|im_")))
    out = {}
    for conv, talk in talks.items():
        for speaker in {r for _, r, _ in talk} - {"system", "unknown"}:
            for part in {t // chunk for t, _, _ in talk}:
                text, spans, n = "", [], 0
                for turn, role, content in sorted(talk):
                    if turn // chunk != part:
                        continue
                    name = "".join(c if c.isascii() and (c.isalnum() or c in "_.-") else "_" for c in role)
                    shown = "system" if role == "system" else "assistant" if role == speaker else f"user name={name}"
                    text += f"<|im_start|>{shown}\n"
                    start, n = len(text), n + 1
                    text += content + "<|im_end|>\n"
                    if role == speaker:
                        spans.append((start, len(text)))
                out[conv, speaker, part] = (n, text, spans)
    return out


@pytest.mark.parametrize("chunk", [64, 2, 1000])
def test_perspectives(spark, chunk):
    df = spark.createDataFrame([(*r, 9, "clash") for r in ROWS], "conv_id long, turn long, role string, text string, chunk int, speaker string")
    got = {(r["conv_id"], r["speaker"], r["chunk"]): (r["turns"], r["text"], [tuple(s) for s in r["spans"]])
           for r in chat.perspectives(df.repartition(3), chunk).collect()}
    want = plain(ROWS, chunk)
    assert got == want
    for _, text, spans in want.values():
        assert all(text[b - 11:b] == "<|im_end|>\n" for _, b in spans)
    assert chat.perspectives(df.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    cursor = con.execute(ORACLES["op4_perspectives"])
    names = [d[0] for d in cursor.description]
    got = QUERIES["op4_perspectives"](spark, SMALL).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(cursor.fetchall()) and len(got) > 20


def test_repeated_turns_are_cut(spark):
    """A dialogue whose turn numbers repeat or are null, with many equal rows: groups stay small, and nothing is lost."""
    import hashlib

    rows = [(1, 0 if i % 3 else None, ("Ann", "Bob", "system")[i % 3], f"t{i % 50}") for i in range(700)]
    rows += [(1, 5, "Ann", "same")] * 300 + ROWS[9:]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seen = chat.perspectives(df.repartition(3), most=100, size=16).cache()
    assert max(r["turns"] for r in seen.select("turns").collect()) <= 16
    parts = defaultdict(list)
    for r in seen.collect():
        parts[r["conv_id"], r["speaker"], r["chunk"]].append((r["part"], r["parts"], r["turns"], r["text"], [tuple(s) for s in r["spans"]]))
    got = {}
    for key, own in parts.items():
        own.sort()
        assert [p[0] for p in own] == list(range(own[0][1]))
        got[key] = (sum(p[2] for p in own), "".join(p[3] for p in own), [s for p in own for s in p[4]])
    want = plain(rows, chat.CHUNK)
    assert got == want and len(parts[1, "Ann", 0]) == 63
    digests = {(r["conv_id"], r["speaker"], r["chunk"]): r for r in chat.digests(seen).collect()}
    assert set(digests) == set(want)
    for key, (n, text, spans) in want.items():
        r = digests[key]
        assert (r["turns"], r["chars"], r["trained_chars"]) == (n, len(text), sum(b - a for a, b in spans))
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["spans"] == ",".join(f"{a}-{b}" for a, b in spans)


def test_a_speaker_named_unknown(spark):
    rows = [(1, 0, "unknown", "named"), (1, 1, " ", "blank"), (1, 2, "Ann", "hi"), (1, 3, None, "tie"), (1, 3, "unknown", "tie"), (2, 0, "", "alone")]
    got = {r["speaker"]: r for r in chat.perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    turn = lambda who, text: f"<|im_start|>{who}\n{text}<|im_end|>\n"
    assert set(got) == {"unknown", "Ann"}  # nobody speaks for a blank role
    assert got["unknown"]["text"] == "".join((turn("assistant", "named"), turn("user name=unknown", "blank"), turn("user name=Ann", "hi"),
                                              turn("user name=unknown", "tie"), turn("assistant", "tie")))
    assert [got["unknown"]["text"][a:b] for a, b in got["unknown"]["spans"]] == ["named<|im_end|>\n", "tie<|im_end|>\n"]
    assert got["Ann"]["text"].count("user name=unknown") == 4
