"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpus_pipeline import run as pipeline
from sentaria.llm.collocations import op12_misra_gries_phrases
from sentaria.llm.decontaminate import op2_spaced_seeds
from sentaria.llm.feistel_shards import op7_feistel_shards
from sentaria.llm.licenses import op4_sentence_rules
from sentaria.llm.line_dedup import op9_segment_edit_lines
from sentaria.llm.mil_quality import op10_attention_quality
from sentaria.llm.multiprobe import op1_multiprobe_neighbours
from sentaria.llm.packing import op8_power_of_two_packing
from sentaria.llm.ranked_search import op13_hybrid_search
from sentaria.llm.simhash import op5_simhash_ball
from sentaria.llm.suffix_dedup import op3_two_stage_suffixes
from sentaria.llm.sum_of_squares import op11_sum_of_squares_packing
from sentaria.llm.warc import op6_seekable_warc

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _with_package(query: Callable[[SparkSession, str], DataFrame]):
    """Python workers of a local session find this package wherever the session was started.

    A cluster installs the package on its executors, as for any Python UDF.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shipped = spark.sparkContext.environment
        known = shipped.get("PYTHONPATH", "").split(os.pathsep)
        if _ROOT not in known:
            shipped["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, known)])
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _with_package(query)
    for query in (
        op1_multiprobe_neighbours,
        op2_spaced_seeds,
        op3_two_stage_suffixes,
        op4_sentence_rules,
        op5_simhash_ball,
        op6_seekable_warc,
        op7_feistel_shards,
        op8_power_of_two_packing,
        op9_segment_edit_lines,
        op10_attention_quality,
        op11_sum_of_squares_packing,
        op12_misra_gries_phrases,
        op13_hybrid_search,
    )
} | {"pipeline": _with_package(pipeline)}

ORACLES: dict[str, str] = {
    "op6_seekable_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest
            FROM pages),
        m AS (SELECT digest, max(page_id) AS target FROM p WHERE n >= 1000 GROUP BY digest)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
            CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN target END AS refers_to
        FROM p LEFT JOIN m ON p.digest = m.digest
    """,
    "op12_misra_gries_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
        starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM runs),
        grams AS (
            SELECT lang, words[i] AS phrase, 1 AS m FROM starts
            UNION ALL SELECT lang, words[i] || ' ' || words[i + 1], 2 FROM starts WHERE i + 1 <= len(words)
            UNION ALL SELECT lang, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2], 3 FROM starts
            WHERE i + 2 <= len(words)),
        f AS (SELECT lang, phrase, m, count(*) AS a FROM grams GROUP BY lang, phrase, m),
        total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
        cand AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 10),
        cuts AS (
            SELECT c.lang, c.phrase, c.m, c.a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:m], ' ') AS y
            FROM cand c, (SELECT 1 AS k UNION ALL SELECT 2) WHERE k < m),
        rated AS (
            SELECT c.*, f1.a AS l, f2.a AS r,
                (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(f1.a AS HUGEINT) * f2.a) AS score
            FROM cuts c JOIN f f1 ON f1.lang = c.lang AND f1.phrase = c.x
            JOIN f f2 ON f2.lang = c.lang AND f2.phrase = c.y),
        worst AS (
            SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        kept AS (
            SELECT * FROM worst s WHERE NOT EXISTS (
                SELECT 1 FROM cand c WHERE c.lang = s.lang AND c.m > s.m AND 100 * c.a >= 50 * s.a
                AND (array_to_string(c.w[1:2], ' ') = s.phrase OR array_to_string(c.w[2:3], ' ') = s.phrase))),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
    "op13_hybrid_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        st AS (
            SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms
            FROM d WHERE len(terms) > 0),
        tf AS (
            SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
            FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY r, doc_id, n, term),
        w AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, st GROUP BY term, n_docs),
        q AS (
            SELECT item_id, term, count(*) AS repeats
            FROM (SELECT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY item_id, term),
        scores AS (
            SELECT item_id, r, doc_id, CAST(sum(repeats * w * ((1000000000 * tf)
                // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM q JOIN w USING (term) JOIN tf USING (term), st GROUP BY item_id, r, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
            doc_id, score
        FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
    """,
}
