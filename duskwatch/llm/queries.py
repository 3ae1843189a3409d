"""The registered queries of these operators, each next to its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm import collocations, ctw, decontaminate, divergence, mixing, neardup, quality_rules, secret_scan, topk_search, toxicity, transcripts, url_filter, warc
from duskwatch.session import prepare, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The rules (verdict, host, path) of the url query.
URL_RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

URL_SQL = """
WITH rules(verdict, host, path) AS (VALUES
  ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
urls AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages)
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.verdict, 'allow') AS verdict
FROM (
  SELECT u.*, (
    SELECT max({'n': length(r.host || r.path), 'h': length(r.host), 'rule': r.host || r.path, 'verdict': r.verdict})
    FROM rules r WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)) AS hit
  FROM urls u)
"""


@query("op1_url_filter", URL_SQL)
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return url_filter.judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


# Fixed value: weights of sources by their order, repeating.
MIX_WEIGHTS = (5, 2, 1)

MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sizes GROUP BY source),
caps AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w FROM ranked),
levels AS (
  SELECT *, total - coalesce(sum(cap) OVER k, 0) AS left_words, all_w - coalesce(sum(w) OVER k, 0) AS left_w
  FROM caps WINDOW k AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT left_words::DOUBLE AS n, left_w::DOUBLE AS d FROM levels WHERE cap::DOUBLE * left_w >= w * left_words::DOUBLE
  ORDER BY cap / w, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN cap::DOUBLE * d < w::DOUBLE * n THEN cap::DOUBLE ELSE w * n / d END AS target FROM caps, level),
wholes AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets),
ordered AS (
  SELECT s.doc_id, t.source_size, s.size, t.target, t.whole, t.target - t.whole * t.source_size AS rest,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('11:' || coalesce(s.doc_id::VARCHAR, '')), s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed
  FROM sizes s JOIN wholes t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source_size, size, target,
  (size * (whole + CASE WHEN rest > 0 AND 2 * passed + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""


@query("op2_mix_sources", MIX_SQL)
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_ids(table(spark, folder, "documents"), mixing.cycle_weights(MIX_WEIGHTS))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SHARED_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
spans AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM b WHERE len(ws) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM spans)),
doc_windows AS (
  SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM spans) WHERE len(ws) >= n)),
hits AS (SELECT d.r, d.i, d.n, k.item_id FROM doc_windows d JOIN item_windows k ON d.win = k.win AND d.n = k.n),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


@query("op3_decontaminate", SHARED_SQL)
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


SECRET_SQL = r"""
WITH kinds(ord, kind, pat, grp, least) AS (VALUES
  (1, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
  (2, 'access', '()AKIA[A-Z0-9]+', 0, 18), (3, 'hex', '()[0-9a-f]+', 0, 16),
  (4, 'private_key', '()-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1), (5, 'github', '()gh[pousr]_[A-Za-z0-9]{36,}', 0, 1),
  (6, 'slack', '()xox[abprs]-[A-Za-z0-9-]{10,}', 0, 1),
  (7, 'jwt', '()eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}', 0, 1)),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT r, ord, kind, least, regexp_extract_all(text, pat, 0) AS ms, CASE WHEN grp = 2 THEN regexp_extract_all(text, pat, 2) ELSE regexp_extract_all(text, pat, 0) END AS gs,
    string_split_regex(text, pat) AS gaps FROM d, kinds),
each AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found),
spans AS (
  SELECT r, ord, kind, length(gs[i]) AS n, least,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s, length(ms[i]) AS m
  FROM each),
good AS (SELECT r, ord, kind, s, kind || ':' || s::BIGINT || ':' || (s + m)::BIGINT AS t FROM spans WHERE n >= least),
per_doc AS (
  SELECT r, count(*) FILTER (WHERE ord = 1) AS n_assign, count(*) FILTER (WHERE ord = 2) AS n_access, count(*) FILTER (WHERE ord = 3) AS n_hex,
    string_agg(t, ',' ORDER BY s, ord) FILTER (WHERE ord <= 3) AS base, string_agg(t, ',' ORDER BY s, ord) AS spans FROM good GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_doc USING (r)
"""


@query("op4_secret_scan", SECRET_SQL)
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"), size=3, percent=85)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


@query("op6_lm_score")
def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2
    scored = ctw.score_texts(table(spark, folder, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query("op7_chat_format")
def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    raw = transcripts.as_transcripts(table(spark, folder, "conversations"))
    model = transcripts.fit(transcripts.lines_of(raw.where(F.pmod(F.xxhash64("conv_id"), F.lit(5)) != 0), "conv_id", "turn", "text", "role"))
    turns = transcripts.turns_of(transcripts.decode(transcripts.lines_of(raw), model))
    return turns.select(F.col("conv").alias("conv_id"), F.col("begins.turn").alias("turn"), F.col("begins.line").alias("line"), "role", "n_lines", "rendered")


# The chain's label columns, in order, with the value that counts as positive.
TOXIC_CHAIN = {"quality": 0, "toxic": 1}


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_chain(docs, table(spark, folder, "labels"), TOXIC_CHAIN))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged, _ = quality_rules.judge_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY sha1(html)) AS first_id FROM p),
bits AS (
  SELECT *, list_transform(range(32), lambda i: (
    (strpos('0123456789abcdef', substr(h, (5 * i // 4 + 1)::INT, 1)) - 1) * 16
    + greatest(strpos('0123456789abcdef', substr(h || '0', (5 * i // 4 + 2)::INT, 1)) - 1, 0)) // (2 ** (3 - 5 * i % 4))::INT % 32) AS digits FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(digits, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM bits
"""


@query("op10_warc", WARC_SQL)
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "archives")
    warc.write_warc(table(spark, folder, "pages"), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
frequent AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) AS t(k) WHERE len(ws) >= k) GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, k AS m, phrase, string_split(phrase, ' ') AS parts, f AS a FROM frequent WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.c, h.f AS l, t.f AS r
  FROM (SELECT *, unnest(range(1, m)) AS c FROM candidates) c
  JOIN frequent h ON h.lang = c.lang AND h.k = c.c AND h.phrase = array_to_string(parts[1:c.c], ' ')
  JOIN frequent t ON t.lang = c.lang AND t.k = c.m - c.c AND t.phrase = array_to_string(parts[c.c + 1:m], ' ')),
best AS (
  SELECT lang, phrase, a, n, min({'score': 1000 * a * n // (l * r), 'c': c, 'l': l, 'r': r}) AS cut FROM cuts JOIN totals USING (lang) GROUP BY ALL),
covers AS (
  SELECT lang, array_to_string(parts[s:s + k - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - k + 2)) AS s FROM candidates, range(2, 5) AS t(k) WHERE k < m) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN covers USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, cut.l::BIGINT AS l, cut.r::BIGINT AS r, n::BIGINT AS n, cut.score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


@query("op11_collocations", PHRASE_SQL)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Each language's first 2000 phrases with 100 occurrences or more, over all documents."""
    return collocations.collocations(table(spark, folder, "documents"), support=100, cover=100, top=2000)


NEAREST_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
scores AS (SELECT q.vec_id AS query_id, q.r, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op12_topk_search", NEAREST_SQL)
def op12_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best other vectors of every vector whose id is divisible by 100, against all vectors."""
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT lang, source, r, term, count(*) AS n FROM (SELECT lang, source, r, unnest(ws) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS lang_n FROM t GROUP BY ALL HAVING count(*) >= 3),
c AS (SELECT t.lang, t.source, t.term, sum(t.n)::BIGINT AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS lang_total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (total + v) AS p, 1 + 1000000000 * (lang_n + 1) // (lang_total + v) AS q
  FROM g JOIN totals USING (lang, source) JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of sources of a language, and the 200 terms most above it for each source, over all documents."""
    return divergence.divergences(table(spark, folder, "documents"), min_docs=3, top=200)
