import base64
import hashlib
import re
from collections import Counter

import pytest

from anemos.llm import urlfilter, warc
from anemos.llm.queries import ORACLES, PLACES, QUERIES

SMALL = "/root/testdata/sf0.001"
URLS = [None, "", "no scheme", "http://", "http://ORG/", "http://org", "http://a.Example.ORG/es/1?x#y", "http://example.org/es",
        "http://example.org/en/17/x", "http://example.org/EN/1", "http://xexample.org/es/", "ftp://m.com/de/a", "http://com/fr/",
        "http://a.com?/fr/", "http://b.com#/de/", "http://user@c.com:80/fr/", "http://d.com/fr/://e.com/de/",
        "http://cheap-pills.example.com/x", "http://x.net/pills", "http://spammy.net/", "http://spam.example.org/en/2",
        "http://a.net/WP-Login.php", "http://a.net/wp-login.php", "http://a.net/b/wp-login.php?x=1", "http://a.net/wp-login.php5",
        "http://a.net/wp-login.php\n", "http://a.net/user/login", "http://a.net/user/loginx", "http://a.net/cgi-bin/x", "http://a.net/x/cgi-bin/x",
        "http://a.net/cart/checkout/", "http://a.net/calendar/2024/05", "http://a.net/calendar/2024/5", "http://a.net/search/results#top",
        "http://a.net/tag/x/page/3", "http://a.net/tag/x/y/page/3", "http://a.net/forum/profile/12", "http://a.net/forum/a/b/profile/12/",
        "http://a.net/print/12.html", "http://a.net/x;jsessionid=" + "aF" * 16, "http://a.net/x;jsessionid=" + "a" * 33,
        "http://get-free.net/download", "http://freedom.net/download", "http://free-casino.net/download/a.torrent", "http://a.net/A.TORRENT",
        "http://example.org/fr/user/login", "http://x.com/de/user/login",
        "http://a\nb.org/\n", "x://y://z", "http://spam.net/", "http://spam.net/", "http://" + "a." * 5000 + "org/" + "b/" * 5000]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for place, verdict in PLACES:
        name, _, tail = place.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(place) > len(best[0]):
                best = (place, verdict)
    if best:
        return host, path, *best
    spam = any(re.search(rf"\b{w}\b", host, re.ASCII) for w in urlfilter.SPAM_WORDS)
    empty = any(re.search(pattern.replace(r"\z", r"\Z"), host + path, re.ASCII) for _, pattern, _ in urlfilter.EMPTY_PAGES)
    return host, path, None, "block" if spam or empty else "allow"


def judged(df, rules):
    named = [p for p, _ in PLACES]
    return Counter((r["k"], r["host"], r["path"], r["rule"] if r["rule"] in named else None, r["verdict"])
                   for r in urlfilter.filter_urls(df, "k", rules).collect())


RULES = [urlfilter.place_rule(*p) for p in PLACES] + urlfilter.OWN_RULES


def test_url_rules(spark):
    rows = [(i % 20, u, "clash") for i, u in enumerate(URLS + URLS)]
    df = spark.createDataFrame(rows, "k long, url string, token string")
    assert judged(df, RULES) == Counter((k, *plain(u)) for k, u, _ in rows)
    assert urlfilter.filter_urls(df.limit(0), "k", RULES).count() == 0


def test_rule_without_token_and_tie(spark):
    df = spark.createDataFrame([(1, "http://a.b/x"), (2, "http://c.d/x")], "k long, url string")
    rules = [urlfilter.Rule("z", "block", "x$", ()), urlfilter.Rule("y", "allow", "^a", ("a",)), urlfilter.Rule("never", "block", "q", ("q",))]
    got = {r["k"]: (r["rule"], r["verdict"]) for r in urlfilter.filter_urls(df, "k", rules).collect()}
    assert got == {1: ("y", "allow"), 2: ("z", "block")}


def test_rarest_token_is_the_index(spark):
    held = spark.createDataFrame([("a",)] * 3 + [("b",)], "token string")
    index = urlfilter.rarest_tokens(held, [urlfilter.Rule("r", "block", "x", ("a", "b")), urlfilter.Rule("s", "block", "x", ("a",))])
    assert {r["name"]: r["token"] for r in index.collect()} == {"r": "b", "s": "a"}


def test_own_rules_fit_and_win_by_name(spark):
    """Each own rule fits one of the urls, so none is shut out by its tokens; of two that fit the smaller name wins."""
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "k long, url string")
    got = {r["k"]: r["rule"] for r in urlfilter.filter_urls(df, "k", urlfilter.OWN_RULES).collect()}
    assert {name for name, _, _ in urlfilter.EMPTY_PAGES} - set(got.values()) == {"torrent"}
    assert got[URLS.index("http://free-casino.net/download/a.torrent")] == "free download"
    df = spark.createDataFrame([(0, "http://a.net/A.torrent"), (1, "http://a.net/a.torrent/")], "k long, url string")
    assert [r["rule"] for r in urlfilter.filter_urls(df, "k", urlfilter.OWN_RULES).orderBy("k").collect()] == ["torrent", None]


def test_url_sql_on_odd_urls(spark, tmp_path):
    """The query and its SQL over the odd urls, line ends and all."""
    import duckdb

    spark.createDataFrame([(i, u, "") for i, u in enumerate(URLS)], "page_id long, url string, html string").coalesce(1).write.parquet(
        str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert Counter(con.sql(ORACLES["op2_url_filter"]).fetchall()) == Counter(map(tuple, QUERIES["op2_url_filter"](spark, str(tmp_path)).collect()))


def test_native(spark):
    plan = QUERIES["op2_url_filter"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "html" not in plan.split("Physical Plan")[1]


def test_url_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    rows = con.sql(ORACLES["op2_url_filter"]).fetchall()
    got = QUERIES["op2_url_filter"](spark, SMALL).collect()
    assert Counter(rows) == Counter(map(tuple, got))


PAGES = [(1, "http://a/", "same", 0), (2, "http://b/", "same", 0), (2, "http://b/", "same", 0), (3, None, None, 0), (4, "u", "", 0),
         (None, "http://n/", "same", 0), (5, "http://l\r\nb/", "é" * 5000, 0), (6, "x", "\r\n\r\nWARC/1.1\r\n", 0)]
KIND = "page_id long, url string, html string, payload int"


@pytest.fixture
def archive(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archive(spark.createDataFrame(PAGES, KIND), path)
    return path


def test_records(spark, archive):
    rows = warc.records(spark, archive).collect()
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in rows)
    assert got == Counter([
        (1, "revisit", 2, b"same"), (2, "response", None, b"same"), (2, "revisit", 2, b"same"), (None, "revisit", 2, b"same"),
        (3, "revisit", 4, b""), (4, "response", None, b""), (5, "response", None, ("é" * 5000).encode()),
        (6, "response", None, b"\r\n\r\nWARC/1.1\r\n")])
    for r in rows:
        digest = base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()
        assert (r["payload_digest"], r["payload_bytes"]) == (digest, len(r["payload"]))
    assert spark.read.parquet(f"{archive}/blobs").count() == 4  # each payload once


def test_record_text(spark, archive):
    for r in warc.record_text(warc.records(spark, archive)).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        body = rest[:int(fields["Content-Length"])]
        assert rest[len(body):] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
        assert body.partition(b"\r\n\r\n")[2] == (bytes(r["payload"]) if r["record_type"] == "response" else b"")
        assert "\n" not in fields.get("WARC-Target-URI", "")


def test_small_payloads_are_all_responses(spark, tmp_path):
    warc.write_archive(spark.createDataFrame(PAGES, KIND), str(tmp_path / "b"), least_bytes=5)
    assert {r["record_type"] for r in warc.records(spark, str(tmp_path / "b")).collect()} == {"response"}


def test_damage_is_found(spark, archive, tmp_path):
    from pyspark.sql import functions as F

    blobs = spark.read.parquet(f"{archive}/blobs")
    blobs.withColumn("payload", F.lit("other").cast("binary")).write.parquet(str(tmp_path / "c/blobs"))
    spark.read.parquet(f"{archive}/headers").write.parquet(str(tmp_path / "c/headers"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.records(spark, str(tmp_path / "c")).collect()


def test_empty_archive(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], KIND), str(tmp_path / "d"))
    assert warc.records(spark, str(tmp_path / "d")).count() == 0


def test_archive_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    largest = {}
    for p in pages:
        largest[p["html"]] = max(largest.get(p["html"], -1), p["page_id"])
    want = Counter()
    for p in pages:
        data, last = (p["html"] or "").encode(), largest[p["html"]] == p["page_id"]
        want[p["page_id"], len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
             "response" if last else "revisit", None if last else largest[p["html"]]] += 1
    assert Counter(map(tuple, QUERIES["op5_warc_archive"](spark, SMALL).collect())) == want
