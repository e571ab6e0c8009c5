"""One query for each operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdspark.llm import (archive, decontaminate, divergence, extract, importance, license_scan, line_dedup, ngram_join,
                            packing, quality, secret_scan, topk, url_rules)

URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
             ("com/de/", "block"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """Where this machine has the vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("select * from values " + ", ".join(map(repr, URL_RULES)) + " as t(rule, verdict)")
    return url_rules.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64.0)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path, end_id=1, window=2048)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archive_round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), n_words=4, percent=85)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(_table(spark, sf_dir, "pages"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"), owner="source", repository=F.col("lang"))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_quality_classifier, op3_exact_topk, op4_packing, op5_warc, op6_line_dedup, op7_ngram_jaccard,
    op8_html_extraction, op9_license_scan, op10_decontamination, op11_importance_resampling, op12_source_divergence,
    op13_secret_scan)}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"

_BARE = (f"length(VALUE) <= {secret_scan.BARE_LENGTH} AND regexp_matches(VALUE, '[0-9]') AND regexp_matches(VALUE, '[A-Za-z]') "
         f"AND NOT regexp_matches(VALUE, '{secret_scan.ACCESS}') AND NOT regexp_matches(VALUE, '{secret_scan.HEX}')")


def _places(kind: int, gaps: str, alls: str, values: str, keep: str) -> str:
    """SQL for the matches of one kind, with gaps and sizes; ``v`` is a candidate's value, else null."""
    return (f"list_transform(range(1, len({alls}) + 1), lambda i: {{'kind': {kind}, 'at': i, 'gap': length({gaps}[i]), "
            f"'size': length({alls}[i]), 'v': CASE WHEN {keep.replace('VALUE', f'{values}[i]')} THEN {values}[i] END}})")

ORACLES = {
    "op1_url_filters": """
        WITH u AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        r AS (SELECT * FROM (VALUES """ + ", ".join(
        f"('{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{r}', '{v}')" for r, v in URL_RULES) + """) t(rhost, rpath, rule, verdict)),
        best AS (
            SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM (SELECT DISTINCT host, path FROM u) d
            JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY host, path)
        SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
        FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path""",
    "op3_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) t
        WHERE rank <= 20""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first, strlen(h) AS size FROM p)
        SELECT page_id, size::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN size >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 1000 AND page_id <> first THEN first END AS refers_to
        FROM m""",
    "op6_line_dedup": """
        WITH d AS (SELECT doc_id, text, md5(concat_ws(chr(1), coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS k FROM documents),
        lines AS (
            SELECT DISTINCT k, doc_id, i, string_split(text, chr(10))[i] AS line
            FROM (SELECT k, doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
        hashed AS (
            SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT % 1000003 AS h,
                   len(string_split_regex(trim(line, ' '), '[ \\t]+')) >= 50 AS long FROM lines),
        rolled AS (
            SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0)) % 1000003 % 4 = 0
                      OR long OR coalesce(lead(long) OVER w, true) AS last
            FROM hashed WINDOW w AS (PARTITION BY k ORDER BY i)),
        numbered AS (
            SELECT *, coalesce(sum(last::INTEGER) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                      AS place FROM rolled),
        chunks AS (
            SELECT k, doc_id, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk, bool_or(long) AS long
            FROM numbered GROUP BY k, doc_id, place),
        judged AS (
            SELECT *, (n > 1 OR long) AND trim(translate(chunk, chr(10) || chr(9) || chr(13), '   '), ' ') <> ''
                      AND row_number() OVER (PARTITION BY chunk, n > 1 OR long ORDER BY doc_id, k, place) > 1 AS gone FROM chunks),
        kept AS (
            SELECT k, string_agg(chunk, chr(10) ORDER BY place) FILTER (NOT gone) AS text,
                   count(*) FILTER (gone) AS removed_chunks, coalesce(sum(n) FILTER (gone), 0) AS removed_lines
            FROM judged GROUP BY k)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
               coalesce(removed_chunks, 0)::INTEGER AS removed_chunks, coalesce(removed_lines, 0)::INTEGER AS removed_lines
        FROM d LEFT JOIN kept ON d.k = kept.k""",
    "op7_ngram_jaccard": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 2))) AS i FROM w WHERE len(words) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        often AS (SELECT shingle FROM s GROUP BY shingle HAVING count(*) > 1),
        t AS (SELECT s.* FROM s JOIN often USING (shingle)),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM t x JOIN t y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
            GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * k >= 85 * (p.n + q.n - k)),
        sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (
            SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
        LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = d.doc_id""",
    "op8_html_extraction": """
        WITH a AS (
            SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'),
                       '</?b>', '', 'g'), '<br>', ' ', 'g') AS body FROM pages),
        b AS (SELECT page_id, url, string_split_regex(body, '</?(h1|p)>') AS parts FROM a),
        c AS (
            SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x:
                trim(regexp_replace(replace(regexp_replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                     '&#x27;', ''''), '&amp;?', chr(1), 'g'), chr(1), '&'), '\\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM b)
        SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM c""",
    "op11_importance_resampling": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents),
        b AS (SELECT regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        vocabulary AS (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
        hashed AS (
            SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen(word) + 1), lambda i:
                       ('0x' || substr(hex(word), 2 * i - 1, 2))::BIGINT)),
                       lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM vocabulary, crc_table),
        df AS (SELECT r, bucket FROM (SELECT r, unnest(w) AS word FROM d) JOIN hashed USING (word)),
        s AS (SELECT bucket, count(*) AS s FROM df GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS word FROM b) JOIN hashed USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
                       / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)),
        weights AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN gains USING (bucket) GROUP BY r),
        scored AS (
            SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                       / 4294967296::DOUBLE)))::BIGINT AS score
            FROM d LEFT JOIN weights USING (r)),
        placed AS (
            SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS draws
            FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= draws THEN place END AS rank
        FROM scored LEFT JOIN placed USING (r)""",
    "op12_source_divergence": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        c AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
        kept AS (SELECT lang, term FROM c GROUP BY ALL HAVING count(*) >= 30),
        v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
        counts AS (SELECT lang, source, term, sum(n) AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT DISTINCT lang, source FROM d),
        filled AS (
            SELECT g.lang, g.source, kept.term, coalesce(n, 0)::HUGEINT AS n FROM g JOIN kept ON kept.lang = g.lang
            LEFT JOIN counts ON counts.lang = g.lang AND counts.source = g.source AND counts.term = kept.term),
        p AS (
            SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 5 * v) AS p
            FROM filled JOIN v USING (lang)),
        whole AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM filled GROUP BY ALL),
        q AS (
            SELECT lang, term, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang)::HUGEINT + 5 * v) AS q
            FROM whole JOIN v USING (lang)),
        pairs AS (
            SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN (
                SELECT a.lang, a.source, b.source AS other, sum(abs(a.p - b.p)) AS value
                FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
            ON s.lang = x.lang AND s.source = x.source AND s.other = y.source),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term)
            WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op13_secret_scan": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner, coalesce(lang, '') AS repo
            FROM documents),
        a AS (
            SELECT *, string_split_regex(t, {_quoted(secret_scan.ASSIGN)}) AS ag, regexp_extract_all(t, {_quoted(secret_scan.ASSIGN)}, 0) AS aa,
                   regexp_extract_all(t, {_quoted(secret_scan.ASSIGN)}, 2) AS av,
                   string_split_regex(t, '{secret_scan.ACCESS}') AS kg, regexp_extract_all(t, '{secret_scan.ACCESS}') AS ka,
                   string_split_regex(t, '{secret_scan.HEX}') AS hg, regexp_extract_all(t, '{secret_scan.HEX}') AS ha FROM d),
        e AS (
            SELECT *, array_to_string(list_transform(range(1, len(ag) + 1), lambda i: ag[i] || CASE WHEN length(av[i]) >= 6
                       THEN repeat(' ', length(aa[i])) ELSE coalesce(aa[i], '') END), '') AS rest FROM a),
        f AS (
            SELECT *, string_split_regex(rest, '{secret_scan.BARE}') AS bg, regexp_extract_all(rest, '{secret_scan.BARE}') AS ba FROM e),
        m AS (
            SELECT r, owner, repo, unnest(list_concat(
                {_places(0, 'ag', 'aa', 'av', 'length(VALUE) >= 6')}, {_places(1, 'kg', 'ka', 'ka', 'true')}, {_places(2, 'hg', 'ha', 'ha', 'true')},
                {_places(3, 'bg', 'ba', 'ba', _BARE)})) AS x
            FROM f),
        s AS (
            SELECT r, owner, repo, x.kind AS kind, x.v AS v, x.size AS size,
                   sum(x.gap + x.size) OVER (PARTITION BY r, x.kind ORDER BY x.at) AS stop FROM m),
        c AS (
            SELECT *, stop - size AS start, length(v) >= 12 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
                   AND len(list_distinct(string_split(v, ''))) >= 8 AND NOT regexp_matches(v, '{secret_scan.PLACEHOLDER}') AS live,
                   regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9]') AS mixed
            FROM s WHERE v IS NOT NULL),
        o AS (
            SELECT v, CASE WHEN count(DISTINCT owner) >= 3 THEN 'example' WHEN bool_or(live) THEN 'live' ELSE 'weak' END AS verdict,
                   min(kind) < 3 AS assigned FROM c GROUP BY v),
        j AS (SELECT * FROM c JOIN o USING (v) WHERE kind < 3 OR (verdict = 'live' AND (mixed OR assigned))),
        l AS (
            SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                   string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind)
                       FILTER (kind < 3) AS base,
                   string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans,
                   count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
            FROM j GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
               coalesce(n_example, 0) AS n_example
        FROM d LEFT JOIN l USING (r)""",
}
