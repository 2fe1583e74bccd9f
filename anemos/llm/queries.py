"""The operators of this subpackage as queries over the given tables, and their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.llm import bpe, chat, jaccard, langid, neardup, neighbours, packing, quality, suffixes, trie, urlfilter, warc, whitening
from anemos.session import fresh_path, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text they decode to, as digests."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), word_vocabulary()).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"))
    return bpe.decode(coded, word_vocabulary(), keep=("doc_id", "n_tokens", "ids_sha256")).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and packed into sequences of 2048 tokens."""
    pieces = packing.cut_documents(table(spark, sf_dir, "documents"), word_vocabulary())
    return packing.pack(settle(pieces, "pieces"))


#: Rules of the url query (host with its subdomains, path prefix).
PLACES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
          ("com/fr/", "allow"), ("com/de/", "block"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url: the longest place rule that fits, else the method's own rules, else allow."""
    rules = [urlfilter.place_rule(*p) for p in PLACES] + urlfilter.OWN_RULES
    out = urlfilter.filter_urls(table(spark, sf_dir, "pages"), "page_id", rules)
    named = F.col("rule").isin([p for p, _ in PLACES])
    return out.select("page_id", "host", "path", F.when(named, F.col("rule")).alias("rule"), "verdict",
                      F.when(~named, F.col("rule")).alias("own_rule"))


def _places_sql() -> str:
    rows = ", ".join(f"('{h}', '/{p}', '{h}/{p}', '{v}')" for place, v in PLACES for h, _, p in [place.partition("/")])
    own = ", ".join(f"CASE WHEN regexp_matches(host || path, '{r.pattern}') THEN '{r.name}' END" for r in urlfilter.OWN_RULES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH places(rule_host, rule_path, rule, verdict) AS (VALUES {rows}),
parts AS (SELECT row_number() OVER () AS n, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
fits AS (SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM split JOIN places ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY n),
words AS (SELECT n, list_min([{own}]) AS own_rule FROM split)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN own_rule IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
    CASE WHEN rule IS NULL THEN own_rule END AS own_rule
FROM split LEFT JOIN fits USING (n) LEFT JOIN words USING (n)"""


ORACLES["op2_url_filter"] = _places_sql()


@query
def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as a content-addressed archive and read its records back."""
    path = fresh_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    predict = langid.predict_with(spark, langid.fit(langid.learning_rows(docs)))
    found = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"),
                        predict(F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
                        F.col("found.ambiguous").alias("ambiguous"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.grades(table(spark, sf_dir, "labels")))
    return docs.select("doc_id", quality.rate_with(spark, model)("text").alias("rated")).select("doc_id", "rated.*")


@query
def op3_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 5)


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the eight whitened components of largest variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 8)


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked at a Jaccard similarity of 0.75 of their 5-word shingles."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@query
def op4_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as seen by each of its speakers: digest of the text, and the spans to train on."""
    return chat.digests(chat.perspectives(table(spark, sf_dir, "conversations")))


ORACLES["op4_perspectives"] = f"""
WITH t AS (SELECT conv_id, coalesce(turn, 0) AS turn, coalesce(nullif(trim(role), ''), 'unknown') AS role,
    coalesce(trim(role) <> '', false) AS named, replace(coalesce(text, ''), '<|im_', '<' || chr(8203) || '|im_') AS content FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE named AND role <> 'system'),
x AS (SELECT t.conv_id, speaker, CAST(floor(turn / {chat.CHUNK}e0) AS BIGINT) AS chunk, turn, role, content, named, named AND role = speaker AS mine,
    '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN named AND role = speaker THEN 'assistant'
      ELSE 'user name=' || regexp_replace(role, '[^A-Za-z0-9_.-]', '_', 'g') END || chr(10) AS head,
    content || '<|im_end|>' || chr(10) AS body FROM t JOIN p USING (conv_id)),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, chunk ORDER BY turn, role, content, named
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM x)
SELECT conv_id, speaker, chunk, count(*) AS turns, CAST(max(stop) AS BIGINT) AS chars,
    CAST(sum(CASE WHEN mine THEN length(body) ELSE 0 END) AS BIGINT) AS trained_chars,
    sha256(string_agg(head || body, '' ORDER BY turn, role, content, named)) AS text_sha256,
    coalesce(string_agg(CASE WHEN mine THEN CAST(stop - length(body) AS VARCHAR) || '-' || CAST(stop AS VARCHAR) END, ','
      ORDER BY turn, role, content, named), '') AS spans
FROM o GROUP BY 1, 2, 3"""


@query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 100-byte strings that start earlier."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations, one row per node."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


# A path's text is the digests of its turns, 32 signs each, so its nodes are its starts.
ORACLES["op13_prefix_trie"] = """
WITH bits AS (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b)),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits),
placed AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn,
    length(coalesce(text, '')) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
    coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS own FROM placed GROUP BY 1),
hashed AS (SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 6 AS h FROM sizes, crc),
plan AS (SELECT c.conv_id, c.conv_id - c.conv_id % 100 AS base, c.own, c.h, least(c.h, coalesce(b.own, 0)) AS k
    FROM hashed c LEFT JOIN sizes b ON b.conv_id = c.conv_id - c.conv_id % 100),
turns AS (SELECT p.conv_id, t.pos, t.turn, t.chars FROM plan p JOIN placed t ON t.conv_id = p.base AND t.pos <= p.k
    UNION ALL SELECT p.conv_id, t.pos - p.h + p.k, t.turn, t.chars FROM plan p JOIN placed t ON t.conv_id = p.conv_id AND t.pos > p.h),
starts AS (SELECT conv_id, pos, chars, string_agg(turn, '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
last AS (SELECT conv_id, max(pos) AS pos FROM starts GROUP BY 1),
nodes AS (SELECT path, s.pos AS depth, min(s.conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    coalesce(string_agg(CASE WHEN last.pos = s.pos THEN CAST(s.conv_id AS VARCHAR) END, ',' ORDER BY s.conv_id), '') AS ends
    FROM starts s JOIN last USING (conv_id) GROUP BY 1, 2),
below AS (SELECT a.path, count(*) FILTER (WHERE b.depth = a.depth + 1) AS n_children FROM nodes a JOIN nodes b
    ON a.path = left(b.path, 32 * (b.depth - 1)) AND b.depth = a.depth + 1 GROUP BY 1),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN below USING (path)),
above AS (SELECT left(path, 32 * d) AS top, n_children, (n_convs - 1) * chars AS saved
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted)),
under AS (SELECT top AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM above GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves, u.saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN under u USING (path) LEFT JOIN counted p ON n.depth > 0 AND p.path = left(n.path, 32 * (n.depth - 1))
    AND p.depth = n.depth - 1"""
