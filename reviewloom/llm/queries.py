"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.decontaminate import contamination
from reviewloom.llm.licenses import scan_licenses
from reviewloom.llm.lines import dedup_lines
from reviewloom.llm.minhash import near_duplicates
from reviewloom.llm.mixing import mix_sources
from reviewloom.llm.neighbours import nearest
from reviewloom.llm.registry import query, table
from reviewloom.llm.search import search
from reviewloom.llm.substrings import remove_repeats
from reviewloom.llm.tokens import count_tokens
from reviewloom.llm.toxicity import fit_on, held_out, score_toxicity
from reviewloom.llm.url_filter import judge_urls
from reviewloom.llm.warc import archived
from reviewloom.llm.whitening import whiten

# The rules that pages are judged by (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_URL_SQL = """
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(h, p, v) AS (VALUES %s),
judged AS (
  SELECT page_id, host, path, (SELECT max({'n': length(h || p), 'b': v = 'block', 'rule': h || p, 'verdict': v})
    FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM parts)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
""" % ", ".join(str(r) for r in URL_RULES)


@query("op1_url_filters", _URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op2_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


_REPEATS_SQL = r"""
WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
wins AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS win
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM doc WHERE len(w) >= 20)),
again AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS nth FROM wins) WHERE nth > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS g FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM again) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(len(g), 0) AS bigint) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(g, []), i)), ' '), '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (doc_id)
"""


@query("op3_substring_dedup", _REPEATS_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_NEAR_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
one AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM doc),
item AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM one),
near AS (SELECT a, b FROM (SELECT l.doc_id AS a, r.doc_id AS b, any_value(l.n) AS n, any_value(r.n) AS m, count(*) AS c
         FROM item l JOIN item r ON l.x = r.x AND l.doc_id <> r.doc_id AND 100 * least(l.n, r.n) >= 80 * greatest(l.n, r.n) GROUP BY ALL)
         WHERE 100 * c >= 80 * (n + m - c)),
reach AS (SELECT doc_id, doc_id AS other FROM doc UNION SELECT reach.doc_id, near.b FROM reach JOIN near ON reach.other = near.a)
SELECT doc_id, cast(len(s) AS bigint) AS n_shingles, component_id, doc_id = component_id AS kept
FROM one JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


@query("op4_minhash_near_dedup", _NEAR_SQL)
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), length=2, percent=80)


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT d, n, min(page_id) AS first FROM p GROUP BY d, n)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((cast('0x' || substr(d, 1 + 5 * (i // 4), 5) AS bigint) >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (d, n)
"""


@query("op5_warc", _WARC_SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


_LEAK_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id,
       list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
item AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM item WHERE len(w) > 0),
wins AS (SELECT DISTINCT cast(item_id AS varchar) AS item, n, array_to_string(w[s:s + n - 1], ' ') AS win
         FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
placed AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
hit AS (SELECT r, n, s, item FROM placed JOIN wins USING (n, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hit GROUP BY r)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


@query("op6_benchmark_decontamination", _LEAK_SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op7_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


@query("op8_source_mix")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op9_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op10_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


_SEARCH_SQL = r"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS r,
       list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
size AS (SELECT cast(count(*) AS bigint) AS n_docs, cast(sum(len(w)) AS bigint) AS n_terms FROM doc WHERE len(w) > 0),
asked AS (SELECT item_id, t, cast(count(*) AS bigint) AS q FROM (SELECT item_id, unnest(list_filter(regexp_split_to_array(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
       lambda w: w <> '')) AS t FROM benchmark) GROUP BY ALL),
post AS (SELECT r, doc_id, cast(len AS bigint) AS n, t, cast(count(*) AS bigint) AS tf
       FROM (SELECT r, doc_id, len(w) AS len, unnest(w) AS t FROM doc) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weighed AS (SELECT t, cast(floor(1000 * ln((2 * n_docs + 2) / cast(2 * count(*) + 1 AS double))) AS bigint) AS w FROM post, size GROUP BY t, n_docs),
scored AS (SELECT item_id, r, doc_id, cast(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS bigint) AS score
       FROM asked JOIN post USING (t) JOIN weighed USING (t), size GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score,
       cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS integer) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""


@query("op11_ranked_search", _SEARCH_SQL)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"), k=20)


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op13_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")
