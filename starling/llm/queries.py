"""Registered queries of the operators, each over its whole table, with oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import (decontaminate, divergence, fingerprints, kn_quality, line_dedup, minhash, near_vectors, packing, secrets,
                          toxicity, url_filter, vector_codes, warc)
from starling.llm.common import scratch


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(_read(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), width=3, numerator=85, denominator=100)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_read(spark, sf_dir, "documents")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_read(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft")


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.archive(_read(spark, sf_dir, "pages"), path)
    return warc.describe(warc.read_archive(spark, path))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return toxicity.rate(documents, toxicity.train(documents, _read(spark, sf_dir, "labels")))


def op8_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(_read(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_removed", "n_left")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find_contamination(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), window=10, slop=2))


def op10_kn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).drop("version")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_read(spark, sf_dir, "documents"))


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(vector_codes.encode(_read(spark, sf_dir, "embeddings")))


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_hyperminhash": op3_hyperminhash,
    "op4_secret_scan": op4_secret_scan,
    "op5_url_filter": op5_url_filter,
    "op6_warc_archive": op6_warc_archive,
    "op7_toxicity": op7_toxicity,
    "op8_line_spread": op8_line_spread,
    "op9_decontamination": op9_decontamination,
    "op10_kn_quality": op10_kn_quality,
    "op11_fingerprints": op11_fingerprints,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_vector_codes": op13_vector_codes,
}


def _term(term: str) -> str:
    return f"regexp_matches(lower(coalesce(url, '')), '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"


_STRICT = " + ".join(f"{_term(t)}::int" for t in url_filter.STRICT)
_SOFT = " + ".join(f"{_term(t)}::int" for t in url_filter.SOFT)


def _vector_codes_sql() -> str:
    """The rounds one after the other: each assigns every part (a) and moves the codebook's entries (b)."""
    ctes = ["""v AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS c FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (
            SELECT vec_id, label, k, c[k * len(c) // 4 + 1:(k + 1) * len(c) // 4] AS x FROM v, range(4) AS t(k)),
        b0 AS MATERIALIZED (
            SELECT * FROM (SELECT k, row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS e, x FROM p) WHERE e < 256)"""]
    for r in range(5):
        ctes.append(f"""a{r} AS MATERIALIZED (
            SELECT vec_id, any_value(label) AS label, k, any_value(x) AS x, min((d, e)) AS best
            FROM (SELECT vec_id, label, p.k, p.x, e,
                         list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                  FROM p JOIN b{r} b ON p.k = b.k) GROUP BY vec_id, k)""")
        if r < 4:
            ctes.append(f"""m{r} AS (
            SELECT k, e, list(c ORDER BY i) AS x FROM (
                SELECT k, best[2] AS e, i, floor(sum(x[i]) / count(*)) AS c
                FROM (SELECT k, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY 1, 2, 3) GROUP BY 1, 2),
        b{r + 1} AS MATERIALIZED (SELECT k, e, coalesce(m{r}.x, b{r}.x) AS x FROM b{r} LEFT JOIN m{r} USING (k, e))""")
    return f"""
        WITH {", ".join(ctes)},
        h AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY k, e, i)) AS digest FROM (
            SELECT k, e, unnest(x) AS c, unnest(range(len(x))) AS i FROM b4)),
        r AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best[2]::BIGINT), '' ORDER BY k) AS code,
                     sum(best[1])::BIGINT AS error FROM a4 GROUP BY vec_id)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
        FROM r, h"""


ORACLE = {
    "op1_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
                  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
        reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
        n AS (SELECT x, count(*) AS n FROM links GROUP BY x),
        c AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
        FROM embeddings JOIN c ON vec_id = c.x LEFT JOIN n ON vec_id = n.x""",
    "op5_url_filter": f"""
        WITH u AS (
            SELECT page_id, coalesce(url, '') AS url,
                   CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        p AS (
            SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                   {_STRICT} AS n_terms, {_SOFT} AS n_soft
            FROM u),
        r AS (
            SELECT *, CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                           WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                           WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                           WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                           WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
            FROM p)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN n_terms > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict,
               n_terms::BIGINT AS n_strict, n_soft::BIGINT AS n_soft
        FROM r""",
    "op6_warc_archive": """
        WITH f AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha256(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (SELECT payload_digest, min(page_id) AS keeper FROM f GROUP BY 1)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> keeper THEN keeper END AS refers_to
        FROM f JOIN g USING (payload_digest)""",
    "op8_line_spread": f"""
        WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                          unnest(range(len(string_split(text, chr(10))))) AS pos
                   FROM documents),
        wide AS (SELECT trim(line) AS line, min((doc_id, pos)) AS first FROM l WHERE trim(line) <> ''
                 GROUP BY 1 HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
        marked AS (SELECT l.*, w.line IS NOT NULL AND w.first <> (l.doc_id, l.pos) AS gone
                   FROM l LEFT JOIN wide w ON trim(l.line) = w.line)
        SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
               count(*) AS n_lines, (count(*) FILTER (gone)) AS n_removed,
               (count(*) FILTER (NOT gone AND trim(line) <> '')) AS n_left
        FROM marked GROUP BY doc_id""",
    "op12_divergence_audit": r"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
            FROM documents),
        w AS MATERIALIZED (
            SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
        k AS MATERIALIZED (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT row) >= 3),
        v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
        c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
        t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2),
        g AS MATERIALIZED (
            SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
            FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN t USING (lang, source) LEFT JOIN v USING (lang)),
        p AS MATERIALIZED (
            SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v)::HUGEINT AS p
            FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
        q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (any_value(whole) + any_value(v))::HUGEINT AS q
              FROM c JOIN (SELECT lang, sum(total) AS whole, any_value(v) AS v FROM g GROUP BY lang) USING (lang) GROUP BY 1, 2),
        s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        u AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM u)
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200""",
    "op13_vector_codes": _vector_codes_sql(),
}
