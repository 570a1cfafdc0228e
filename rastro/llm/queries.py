"""The operators applied to the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.llm import (
    conversations,
    decontamination,
    hard_negatives,
    html_text,
    language,
    language_model,
    ngram_join,
    packing,
    quality,
    repeats,
    token_counts,
    topk,
    url_rules,
)
from rastro.llm.common import reachable, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKEN_LIMIT = 512

URL_RULES = [
    (url_rules.ALLOW, "com/"),
    (url_rules.BLOCK, "example.com/en/"),
    (url_rules.ALLOW, "www.example.com/en/"),
    (url_rules.BLOCK, "net/es/"),
    (url_rules.BLOCK, "net/fr/"),
]


def vocabulary() -> str:
    """The vocabulary file; every executor has it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def query(name: str):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reachable(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


ORACLE["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * k >= 80 * (x.n + y.n - k)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(v, r) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT ways.b, reach.r FROM reach JOIN ways ON ways.a = reach.v AND reach.r < ways.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY v) c USING (doc_id)
"""


@query("op1_ngram_jaccard_links")
def op1_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_counts(read(spark, sf_dir, "documents"))


ORACLE["op1_ngram_jaccard_links"] = ORACLE["op1_ngram_jaccard_join"].replace(
    "c.component_id\n", "c.component_id, coalesce(l.k, 0)::BIGINT AS n_links\n"
) + "LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM ways GROUP BY a) l USING (doc_id)\n"


@query("op2_html_extraction")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


@query("op3_url_filters")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.match_urls(read(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op3_url_filters"] = r"""
WITH rules(rule, host, path, verdict) AS (VALUES
    ('com/', 'com', '/', 'allow'),
    ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')),
rests AS (
    SELECT page_id, row_number() OVER () AS n,
           CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, n,
           translate(regexp_extract(rest, '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rests),
fits AS (
    SELECT p.page_id, p.n, p.host, p.path, r.rule, r.verdict,
           row_number() OVER (PARTITION BY p.n ORDER BY length(r.host) DESC, length(r.path) DESC) AS k
    FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""


@query("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.likelihood(read(spark, sf_dir, "documents"))


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE["op7_decontamination"] = r"""
WITH lowered AS (
    SELECT doc_id, row_number() OVER () AS n,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
docs AS (
    SELECT doc_id, n, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
items AS (
    SELECT coalesce(item_id::VARCHAR, 'null') AS item_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
    FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM (SELECT *, least(13, len(w)) AS k FROM items WHERE len(w) > 0))),
doc_windows AS (
    SELECT n, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
    FROM (SELECT n, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM docs, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k)),
hits AS (SELECT n, i, k, item_id FROM doc_windows JOIN item_windows USING (k, win)),
words AS (SELECT n, count(DISTINCT p) AS n_hit
          FROM (SELECT n, unnest(range(i, i + k)) AS p FROM hits) GROUP BY n),
found AS (SELECT n, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT n, item_id FROM hits) GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN words USING (n) LEFT JOIN found USING (n)
"""


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = token_counts.prefix_tables(read(spark, sf_dir, "documents"), vocabulary())
    return tables.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary()).drop("row")


@query("op10_exact_top_k")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


ORACLE["op10_exact_top_k"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
           vec_id, score
    FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op11_substring_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op11_substring_dedup"] = r"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, row_number() OVER () AS n,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
windows AS MATERIALIZED (
    SELECT n, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s
    FROM (SELECT n, w, unnest(range(1, len(w) - 33)) AS i FROM docs)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS MATERIALIZED (
    SELECT DISTINCT n, unnest(range(i, i + 35)) AS p FROM windows WHERE s IN (SELECT s FROM repeated)),
left_over AS (
    SELECT n, string_agg(word, ' ' ORDER BY p) AS kept
    FROM (SELECT n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs) ANTI JOIN gone USING (n, p)
    GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words,
       coalesce((SELECT count(*) FROM gone WHERE gone.n = docs.n), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN left_over USING (n)
"""


@query("op12_hard_negatives")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", noisy))


ORACLE["op12_hard_negatives"] = """
WITH whole AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_inner_product(a.v, c.v)::BIGINT AS score
    FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
mined AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM mined WHERE rank <= 5
"""


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(read(spark, sf_dir, "conversations"))
    return conversations.repair(rows, dropped="_dropped")


ORACLE["op13_conversation_repair"] = r"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(
        list_prepend(n, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
named AS (
    SELECT coalesce(conv_id::VARCHAR, ' ') AS k, conv_id, turn, coalesce(role, ' ') AS role,
           coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                          lambda x: ascii(x)::BIGINT) AS bytes
    FROM conversations),
hashed AS (
    SELECT * EXCLUDE (bytes, t), xor(list_reduce(
        list_prepend(4294967295, bytes),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
    FROM named, crc_table),
damaged AS (
    SELECT k, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
           CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE h <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faults AS (
    SELECT k, i, turn, role, text, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS c,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed),
coded AS MATERIALIZED (
    SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 ELSE 0 END AS gone,
           CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
    FROM faults),
sizes AS MATERIALIZED (SELECT k, max(i) AS n FROM coded GROUP BY k),
costs(k, i, f) AS (
    SELECT k, n + 1, [0, 10, 5, 0]::BIGINT[] FROM sizes
    UNION ALL
    SELECT k, i, [least(g[1], 5 + least(g[3], 5 + g[4])), least(g[2], 5 + least(g[3], 5 + g[4])),
                  least(g[3], 5 + g[4]), least(g[4], 5 + g[3])]
    FROM (
        SELECT c.k, c.i, [
            least(2 + f[1], 1 + gone + more + f[3],
                  CASE c.c WHEN 's' THEN gone + more + f[2] WHEN 'u' THEN gone + more + f[3] ELSE 1000000 END),
            least(2 + f[2], 1 + gone + more + f[3], CASE c.c WHEN 'u' THEN gone + more + f[3] ELSE 1000000 END),
            least(2 + f[3], 1 + gone + more + f[4], CASE c.c WHEN 'a' THEN gone + more + f[4] ELSE 1000000 END),
            least(2 + f[4], 1 + gone + more + f[3], CASE c.c WHEN 'u' THEN gone + more + f[3] ELSE 1000000 END)] AS g
        FROM costs o JOIN coded c ON c.k = o.k AND c.i = o.i - 1)),
vectors AS MATERIALIZED (SELECT * FROM costs),
steps AS MATERIALIZED (
    SELECT v.k, v.i, v.f, w.f AS after, c.c, coalesce(c.role, '') AS role, coalesce(c.text, '') AS text,
           coalesce(more, 0) AS more, c.k IS NULL AS ended
    FROM vectors v LEFT JOIN vectors w ON w.k = v.k AND w.i = v.i + 1
    LEFT JOIN coded c ON c.k = v.k AND c.i = v.i),
walk(k, i, q, audit, lines, ended) AS (
    SELECT k, 1::BIGINT, 1, '', []::VARCHAR[], false FROM sizes
    UNION ALL
    SELECT k, CASE WHEN edit IN ('', 'I') THEN i ELSE i + 1 END,
           CASE WHEN edit IN ('I', 'R') THEN nq
                WHEN edit = 'K' THEN CASE c WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END ELSE q END,
           audit || edit,
           CASE edit WHEN 'I' THEN list_append(lines, given || ':') WHEN 'R' THEN list_append(lines, given || ':' || text)
                     WHEN 'K' THEN list_append(lines, role || ':' || text) ELSE lines END,
           edit = ''
    FROM (
        SELECT w.k, w.i, w.q, w.audit, w.lines, s.c, s.role, s.text,
               CASE w.q WHEN 3 THEN 4 ELSE 3 END AS nq, CASE w.q WHEN 3 THEN 'assistant' ELSE 'user' END AS given,
               CASE WHEN NOT s.ended AND s.f[w.q] = 2 + s.after[w.q] THEN 'D'
                    WHEN s.f[w.q] = 5 + s.f[CASE w.q WHEN 3 THEN 4 ELSE 3 END] THEN 'I'
                    WHEN s.ended THEN ''
                    WHEN s.c = 's' AND w.q = 1 AND s.f[w.q] = s.more + s.after[2]
                      OR s.c = 'u' AND w.q <> 3 AND s.f[w.q] = s.more + s.after[3]
                      OR s.c = 'a' AND w.q = 3 AND s.f[w.q] = s.more + s.after[4] THEN 'K'
                    ELSE 'R' END AS edit
        FROM walk w JOIN steps s ON s.k = w.k AND s.i = w.i WHERE NOT w.ended)),
walked AS (SELECT k, audit, array_to_string(lines, chr(10)) AS kept FROM walk WHERE ended),
counted AS (
    SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(c) OVER (PARTITION BY k ORDER BY i) AS before FROM coded) GROUP BY k)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.f[1], 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(kept, '')) AS repaired_sha256
FROM (SELECT DISTINCT k, conv_id FROM named) o LEFT JOIN counted USING (k) LEFT JOIN walked USING (k)
LEFT JOIN vectors v ON v.k = o.k AND v.i = 1
"""
