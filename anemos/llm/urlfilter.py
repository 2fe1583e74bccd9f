"""URL filters: pattern rules found through their rarest literal token.

Each rule is a regular expression over host + path and names literal tokens (runs of
a-z and 0-9) that every match must hold. Of a rule's tokens the one that the fewest
urls hold is its place in the index. A url's tokens fetch candidate rules; only those
run their expression. All of it is DataFrame work: no Python runs on rows.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule
with a host fits it. Urls are judged once however often they occur, and repeated rows
get the same answer. A rule without tokens is tried on every url. Of rules that fit,
the largest weight wins, then the smaller name. An empty table gives an empty result.
Columns other than the url are not read.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemos.session import settle

TOKEN = re.compile("[a-z0-9]+")
#: A rule index of at most so many rows and characters is sent to every task; a larger one is joined by a shuffle.
SENT_ROWS, SENT_CHARS = 100_000, 10_000_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` holds for host + path; ``tokens``: literal tokens in all that it matches."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int = 0


def place_rule(place: str, verdict: str) -> Rule:
    """A rule for a host with its subdomains and a path prefix, written ``host/path``. The longer place weighs more."""
    host, slash, path = place.partition("/")
    escaped = re.sub(r"([^A-Za-z0-9/])", r"\\\1", host + slash + path)
    # The last token is complete only if the place goes on behind it.
    found = [m for m in TOKEN.finditer(place.lower()) if m.end() < len(place)]
    return Rule(place, verdict, rf"^([^/]*\.)?{escaped}", tuple(m[0] for m in found), len(place))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def tokens(place: Column) -> Column:
    """Distinct tokens of host + path; the empty one stands for rules without tokens."""
    return F.array_union(F.array(F.lit("")), F.split(lower_ascii(place), "[^a-z0-9]+"))


def rarest_tokens(held: DataFrame, rules: list[Rule]) -> DataFrame:
    """The index: token, rule number, pattern, weight. ``held``: one row per url and token."""
    spark = held.sparkSession
    own = spark.createDataFrame([(i, t) for i, r in enumerate(rules) for t in (r.tokens or ("",))],
                                "rule_no long, token string")
    text = spark.createDataFrame([(i, r.pattern, r.weight, r.name) for i, r in enumerate(rules)],
                                 "rule_no long, pattern string, weight long, name string")
    counts = held.join(_sent(own.select("token").distinct(), rules), "token").groupBy("token").agg(
        F.count("*").alias("n"))
    rarest = own.join(counts, "token", "left").groupBy("rule_no").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("pick"))
    return rarest.join(text, "rule_no").select(F.col("pick.token").alias("token"), "rule_no", "pattern", "weight", "name")


def _sent(df: DataFrame, rules: list[Rule]) -> DataFrame:
    small = len(rules) <= SENT_ROWS and sum(len(r.pattern) + len(r.name) + 40 for r in rules) <= SENT_CHARS
    return F.broadcast(df) if small else df


def judge(urls: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """The winning rule of each distinct url that has one: url, rule (its name), verdict."""
    spark = urls.sparkSession
    distinct = urls.select(F.col(url_col).alias("url")).where("url IS NOT NULL").distinct()
    host, path = host_path(F.col("url"))
    held = distinct.select("url", F.concat(host, path).alias("place")).select(
        "url", "place", F.explode(tokens(F.col("place"))).alias("token"))
    index = _sent(rarest_tokens(held.select("token"), rules), rules)
    fitting = held.join(index, "token").where("regexp_like(place, pattern)")
    best = fitting.groupBy("url").agg(F.min(F.struct((-F.col("weight")).alias("w"), "name", "rule_no")).alias("best"))
    verdicts = spark.createDataFrame([(i, r.verdict) for i, r in enumerate(rules)], "rule_no long, verdict string")
    return best.select("url", F.col("best.name").alias("rule"), F.col("best.rule_no").alias("rule_no")).join(
        _sent(verdicts, rules), "rule_no").drop("rule_no")


def filter_urls(rows: DataFrame, key: str, rules: list[Rule], url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """One row per row: the key, host, path, rule (null if none fits), verdict."""
    found = settle(judge(rows, rules, url_col).withColumnRenamed("url", "_judged"), "verdicts")
    host, path = host_path(F.col("_url"))
    return rows.select(F.col(key), F.col(url_col).alias("_url")).join(
        found, F.col("_url") == F.col("_judged"), "left").select(
        key, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), "rule",
        F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))


#: The method's own rules: words that stand alone in a host name, and pages that hold no prose. Each pattern's tokens
#: are whole in everything that it matches, and behind the last one the place ends or another sign follows.
SPAM_WORDS = ("spam", "pills", "bets", "casino", "porn", "xxx", "viagra", "escorts", "payday", "jackpot")
EMPTY_PAGES = (
    ("login page", r"/wp-login\.php\z", ("wp", "login", "php")),
    ("user login", r"/user/login(?:/|\z)", ("user", "login")),
    ("script folder", r"^[^/]*/cgi-bin/", ("cgi", "bin")),
    ("checkout", r"/cart/checkout(?:/|\z)", ("cart", "checkout")),
    ("calendar day", r"/calendar/[0-9]{4}/[0-9]{2}(?:/|\z)", ("calendar",)),
    ("search result", r"/search/results(?:/|\z)", ("search", "results")),
    ("tag listing", r"/tag/[^/]+/page/[0-9]+(?:/|\z)", ("tag", "page")),
    ("member profile", r"/forum/(?:[^/]+/)*profile/[0-9]+(?:/|\z)", ("forum", "profile")),
    ("printed copy", r"/print/[0-9]+\.html\z", ("print", "html")),
    ("session number", r";jsessionid=[0-9A-Fa-f]{32}(?:[./]|\z)", ("jsessionid",)),
    ("free download", r"^[^/]*\bfree\b[^/]*/download(?:/|\z)", ("free", "download")),
    ("torrent", r"\.torrent\z", ("torrent",)),
)
SPAM_RULES = [Rule(f"host word {w}", "block", rf"^[^/]*\b{w}\b", (w,), -1) for w in SPAM_WORDS]
OWN_RULES = SPAM_RULES + [Rule(name, "block", pattern, own, -1) for name, pattern, own in EMPTY_PAGES]
