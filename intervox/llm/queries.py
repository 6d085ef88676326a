"""The opN_<name> queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, jaccard_join, language_id, license_scan, line_dedup, mixing, packing, quality, substring_dedup, topk_search
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return out.select("query_id", "rank", "vec_id", "score")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digests(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict:
    return {f.__name__: f for f in (op1_line_dedup, op2_exact_dedup, op3_topk_search, op4_license_scan, op5_language_id, op6_jaccard_join, op7_substring_dedup, op8_packing, op9_quality, op10_mixing)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _license_sql() -> str:
    """The license scan in SQL: the same grams, diagonals, spans and verification, by strings in place of hashes."""
    words = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '{license_scan.NO_WORD}'), lambda x: x <> '')"
    k = license_scan.K
    templates = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(license_scan.TEMPLATES))
    places = [
        f"SELECT doc_id, unnest(list_filter(range(len(w)), lambda i: {' AND '.join(f"w[i + {j + 1}] = '{x}'" for j, x in enumerate(phrase.split(' ')))})) AS place, '{label}' AS label FROM d"
        for phrase, label in license_scan.PHRASES.items()
    ]
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
t AS (SELECT template, label, string_split(txt, ' ') AS tw FROM (VALUES {templates}) v(template, label, txt)),
tg AS (SELECT template, label, p, len(tw) - {k - 1} AS t_grams, array_to_string(tw[p + 1 : p + {k}], ' ') AS gram
       FROM (SELECT *, unnest(range(len(tw) - {k - 1})) AS p FROM t)),
dg AS (SELECT doc_id, p, array_to_string(w[p + 1 : p + {k}], ' ') AS gram
       FROM (SELECT *, unnest(range(greatest(0, len(w) - {k - 1}))) AS p FROM d)),
votes AS (SELECT doc_id, template, label, t_grams, dg.p - tg.p AS diagonal, min(dg.p) AS lo, max(dg.p) AS hi, list_distinct(list(tg.p)) AS hits
          FROM dg JOIN tg USING (gram) GROUP BY ALL),
cut AS (SELECT *, CASE WHEN abs(diagonal - lag(diagonal) OVER a) > {license_scan.SHIFT} OR lo - lag(hi) OVER a > {license_scan.GAP}
               OR lag(hi) OVER a IS NULL THEN 1 ELSE 0 END AS apart
        FROM votes WINDOW a AS (PARTITION BY doc_id, template ORDER BY lo, diagonal)),
spans AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY lo, diagonal ROWS UNBOUNDED PRECEDING) AS span FROM cut),
sized AS (SELECT doc_id, template, label, t_grams, min(lo) AS lo, max(hi) AS hi, len(list_distinct(flatten(list(hits)))) AS matched
          FROM spans GROUP BY doc_id, template, label, t_grams, span),
found AS (SELECT doc_id, list(DISTINCT label) AS found, max(matched / t_grams) AS coverage FROM sized
          WHERE matched / t_grams >= CASE WHEN t_grams <= {license_scan.SHORT} THEN 1.0 ELSE {license_scan.COVERAGE} END
             OR (matched >= {license_scan.LONG_SPAN} AND matched >= {license_scan.COVERAGE} * (hi - lo + 1)) GROUP BY doc_id),
places AS ({' UNION ALL '.join(places)}),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base_labels FROM places GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base_labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(found, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE least(1.0, coalesce(coverage, 0.0)) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


def _line_sql() -> str:
    split, host = line_dedup.SPLIT.replace("'", "''"), line_dedup.HOST.replace("'", "''")
    return f"""
WITH pieces AS (SELECT page_id, row_number() OVER () AS row_no, lower(regexp_extract(coalesce(url, ''), '{host}', 1)) AS host,
                regexp_split_to_array(coalesce(html, ''), '{split}') AS pieces FROM pages),
p AS (SELECT page_id, row_no, host, list_filter(list_transform(pieces, lambda x: trim(regexp_replace(regexp_replace(x, '{line_dedup.INLINE}', '', 'g'),
      '{line_dedup.BLANKS}', ' ', 'g'), ' ')), lambda x: x <> '') AS lines FROM pieces),
totals AS (SELECT host, count(*) AS host_pages FROM p GROUP BY host),
seen AS (SELECT host, unnest(list_distinct(lines)) AS line FROM p),
flagged AS (SELECT host, list(line) AS drops FROM (SELECT host, line, count(*) AS n FROM seen GROUP BY ALL) JOIN totals USING (host)
            WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.RATIO}::DOUBLE * host_pages GROUP BY host),
kept AS (SELECT page_id, host, lines, CASE WHEN drops IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(drops, x)) END AS kept
         FROM p LEFT JOIN flagged USING (host))
SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_removed, sha256(array_to_string(kept, chr(10))) AS kept_sha256 FROM kept"""


SPACES = r"[\x20\x09-\x0D]+"
WORDS_SQL = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda x: x <> '')"

ORACLES = {
    "op3_topk_search": """
WITH v AS (SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS q FROM embeddings
           WHERE len(embedding) > 0 AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row_no, a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.row_no <> b.row_no WHERE a.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op6_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents),
t AS (SELECT t, min(doc_id) AS rep, count(*) AS n_copies, any_value(w) AS w FROM d GROUP BY t),
s AS (SELECT DISTINCT rep, array_to_string(w[p + 1 : p + {jaccard_join.WORDS}], chr(31)) AS g
      FROM (SELECT rep, w, unnest(range(greatest(1, len(w) - {jaccard_join.WORDS - 1}))) AS p FROM t WHERE len(w) > 0)),
n AS (SELECT rep, count(*) AS n FROM s GROUP BY rep),
i AS (SELECT a.rep AS a, b.rep AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.rep < b.rep GROUP BY ALL),
pairs AS (SELECT a, b FROM i JOIN n x ON x.rep = a JOIN n y ON y.rep = b WHERE common >= {jaccard_join.THRESHOLD} * (x.n + y.n - common)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(rep, other) AS (SELECT a, b FROM links UNION SELECT r.rep, l.b FROM reach r JOIN links l ON r.other = l.a),
c AS (SELECT rep, min(other) AS least FROM reach GROUP BY rep),
k AS (SELECT a AS rep, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, least(rep, coalesce(least, rep)) AS class_id, coalesce(k.n, 0) AS n_links, n_copies
FROM d JOIN t USING (t) LEFT JOIN c USING (rep) LEFT JOIN k USING (rep)""",
    "op7_substring_dedup": f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p + 1 : p + {substring_dedup.WINDOW}], chr(31)) AS g
        FROM (SELECT doc_id, w, unnest(range(greatest(0, len(w) - {substring_dedup.WINDOW - 1}))) AS p FROM d)),
late AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM late, range({substring_dedup.WINDOW}) r(o)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op1_line_dedup": _line_sql(),
    "op4_license_scan": _license_sql(),
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
