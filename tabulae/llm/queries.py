"""The registered queries of the training-data operators and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.llm import (bpe, decontaminate, divergence, edit_embedding, language, license_scan, near_dup, packing, resampling, sharding,
                         toxicity, training_order, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(make):
        QUERIES[name] = make
        if sql is not None:
            ORACLE[name] = sql
        return make

    return register


DECONTAMINATE_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, letters),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, letters),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
             FROM (SELECT *, least(13, len(w)) AS size FROM b WHERE len(w) > 0))),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
             FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
m AS (SELECT doc_id, dw.size, i, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN s ON d.doc_id = s.doc_id
"""


@query("op1_decontamination", DECONTAMINATE_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document: counts, a digest of the item ids, the verdict."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op5_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY))


def _term_sql(term: str) -> str:
    return f"CAST(regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])') AS INTEGER)"


def _rule_sql(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


URL_SQL = rf"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
u AS (SELECT page_id, translate(coalesce(url, ''), upper, lower) AS low,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), upper, lower) AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*(/[^?#]*)', 1) AS path
      FROM pages, letters),
r AS (SELECT *, CASE {' '.join(f"WHEN {_rule_sql(h, p)} THEN '{h}{p}'" for h, p, _ in sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1])))} END AS rule,
             {' + '.join(map(_term_sql, url_filter.STRICT))} AS strict_hits,
             {' + '.join(f"{w} * {_term_sql(t)}" for t, w in url_filter.SOFT.items())} AS soft_weight FROM u)
SELECT page_id, host, path, rule,
       CASE rule {' '.join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in url_filter.RULES)}
       ELSE CASE WHEN strict_hits > 0 OR soft_weight >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END END AS verdict
FROM r
"""


@query("op9_url_filter", URL_SQL)
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


#: Exact pairs by shared shingles, then the transitive closure of the links.
MINHASH_SQL = r"""
WITH RECURSIVE letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\x20\x09-\x0D]+') AS w FROM documents, letters),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT doc_id, min(other) AS least_other FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least_other, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(least_other, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""


@query("op6_minhash", MINHASH_SQL)
def minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on four-word shingles."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query("op2_sharding")
def balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards with row counts at most one apart, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op10_edit_fingerprint")
def edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with the next document's likeness, and groups of near texts."""
    return edit_embedding.compared_and_grouped(table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels that are not held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_language_id")
def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, markup, address and host; the text model is fitted on documents."""
    model = language.fit(table(spark, sf_dir, "documents"))
    return language.page_languages(table(spark, sf_dir, "pages"), model)


@query("op3_training_order")
def training_order_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of all token sequences of the documents, as read back from the written shards."""
    return training_order.ordered_digest(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_VOCABULARY))


@query("op7_license_scan")
def license_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document with their coverage and spans."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op11_packing")
def packed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its window of tokens, with a checksum of the piece's ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


#: Every group gives every kept term of its language a share; the pairs are summed in full.
DIVERGENCE_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents, letters),
w AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
l AS (SELECT lang, term, n, 1 + (1000000000 * (n::HUGEINT + 1)) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q FROM k),
g AS (SELECT DISTINCT lang, source FROM d),
a AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, term, n, 1 + (1000000000 * (n::HUGEINT + 1)) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source))::HUGEINT AS p FROM a),
v AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
      FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(v.value, 0) AS BIGINT) AS value
          FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
          LEFT JOIN v ON v.lang = x.lang AND v.source = x.source AND v.item = y.source),
terms AS (SELECT s.lang, s.source, 'term' AS part, s.term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value
          FROM s JOIN l ON l.lang = s.lang AND l.term = s.term WHERE s.n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op12_divergence", DIVERGENCE_SQL)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that set each source apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


#: The CRC-32 of a feature goes over its bytes with a table that the bit rule makes.
RESAMPLE_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
steps AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS steps
          FROM (SELECT unnest(range(256)) AS i)),
t AS (SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, letters
      UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark, letters),
f AS (SELECT side, id, array_to_string(w[i:i + size - 1], ' ') AS f
      FROM (SELECT side, id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM t, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)),
g AS (SELECT side, id, f, count(*) AS n FROM f GROUP BY ALL),
k AS (SELECT f, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: CAST(('0x' || x) AS BIGINT)),
             lambda c, x: xor(c >> 8, steps[CAST(xor(c & 255, x) AS INTEGER) + 1]), 4294967295), 4294967295) % 10000 AS bucket
      FROM (SELECT DISTINCT f FROM g), steps),
b AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::BIGINT AS t FROM g JOIN k ON k.f = g.f GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM b) + 10000)::DOUBLE / ((s + 1) * ((SELECT sum(t) FROM b) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM b),
e AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM g JOIN k ON k.f = g.f JOIN gain ON gain.bucket = k.bucket WHERE side = 'd' GROUP BY id),
p AS (SELECT t.id AS doc_id, len(w) >= 20 AS may, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             CAST('0x' || substr(sha256('42:' || t.id), 1, 8) AS BIGINT) AS h FROM t LEFT JOIN e ON e.id = t.id WHERE side = 'd'),
q AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS place, count(*) FILTER (may) OVER () AS n FROM q)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 5 * n // 100 THEN place END AS rank FROM o
"""


@query("op13_resampling", RESAMPLE_SQL)
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark's distribution and the ranks of the drawn twentieth."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")
