"""The registered queries once more, as SQL over the base tables for cross-checking.

Token checks rely on two facts of the benchmark text: NFKC leaves it unchanged, and the
sharp s is its only letter whose lower case is not its case fold.
"""

from __future__ import annotations

_VIEWS = {
    "sentences": """SELECT doc_id AS sentence_id, lang AS language, text, source AS username
        FROM documents""",
    "links_raw": "SELECT l_orderkey AS sentence_id, l_partkey AS translation_id FROM lineitem",
    "links": """SELECT * FROM links_raw
        WHERE sentence_id IN (SELECT sentence_id FROM sentences)
          AND translation_id IN (SELECT sentence_id FROM sentences)""",
    "tags": """SELECT doc_id AS sentence_id, 'OK' AS tag_name FROM labels WHERE quality = 1
        UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1""",
    "quality_ids": "SELECT DISTINCT doc_id AS sentence_id FROM labels WHERE quality = 1",
    "audio_export": """SELECT CAST(user_id AS VARCHAR) AS sentence_id,
        CAST(event_id AS VARCHAR) AS audio_id, 'user' || user_id AS username,
        CASE event_type WHEN 'view' THEN 'CC BY 4.0' WHEN 'click' THEN ' CC0 1.0 '
             WHEN 'signup' THEN '' WHEN 'error' THEN chr(92) || 'N' END AS license,
        CASE WHEN event_id % 2 = 0 THEN 'https://example.com/' || user_id ELSE '' END
            AS attribution_url FROM events""",
    "sentence_audio": """SELECT 'tatoeba' AS source, trim(audio_id) AS audio_id,
        CAST(sentence_id AS BIGINT) AS sentence_id, nullif(trim(username), '') AS username,
        nullif(trim(license), '') AS license, nullif(trim(attribution_url), '') AS attribution_url,
        'https://tatoeba.org/audio/download/' || trim(audio_id) AS download_url,
        'metadata' AS status FROM audio_export""",
    "grammar_patterns": """SELECT 'pat-' || p_partkey AS pattern_id,
        CASE p_partkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'es' ELSE 'fr' END
            AS language, p_name AS name, p_type AS description, p_name AS pattern_text,
        p_brand AS source, '{}' AS metadata_json FROM part""",
    "annotations": """SELECT l_orderkey AS sentence_id, 'pat-' || l_partkey AS pattern_id,
        l_returnflag AS evidence_text, l_discount + 0.0 AS confidence, l_linestatus AS source
        FROM lineitem""",
    "tokens": """SELECT sentence_id, language, unnest(list) AS normalized_token,
        generate_subscripts(list, 1) - 1 AS position
        FROM (SELECT sentence_id, language, regexp_extract_all(
                  replace(lower(text), 'ß', 'ss'), '[\\p{L}\\p{N}]+') AS list FROM sentences)""",
    "query_keys": """SELECT query_id, key, min(pos) AS pos
        FROM (SELECT query_id, unnest(list) AS key, generate_subscripts(list, 1) AS pos
              FROM (SELECT item_id AS query_id, regexp_extract_all(
                        replace(lower(text), 'ß', 'ss'), '[\\p{L}\\p{N}]+') AS list
                    FROM benchmark))
        GROUP BY query_id, key""",
    "translations": """SELECT l.sentence_id, l.translation_id, s.language, s.text
        FROM links l JOIN sentences s ON s.sentence_id = l.translation_id""",
    "exported": """SELECT sentence_id, language, username, CASE WHEN sentence_id % 97 = 0 THEN NULL
        WHEN sentence_id % 89 = 0 THEN '' ELSE regexp_replace(text, '[\\t\\r\\n]', ' ', 'g') END AS text
        FROM sentences""",
    "exported_audio": """SELECT source, audio_id, sentence_id, download_url, status,
        CASE WHEN sentence_id % 11 <> 0 THEN username END AS username,
        CASE WHEN sentence_id % 11 <> 0 THEN license END AS license,
        CASE WHEN sentence_id % 11 <> 0 THEN attribution_url END AS attribution_url
        FROM sentence_audio WHERE sentence_id % 11 = 0 OR sentence_id % 13 <> 0""",
}

_NEEDS = {
    "links": ["links_raw", "sentences"],
    "sentence_audio": ["audio_export"],
    "tokens": ["sentences"],
    "translations": ["links", "sentences"],
    "exported": ["sentences"],
    "exported_audio": ["sentence_audio"],
}


def _with(names: list[str], body: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n]})" for n in wanted) + "\n" + body


_BRIEF = "sentence_id, language, length(text) AS n_chars, md5(text) AS text_md5"

_INDEX = _with(
    ["tokens"],
    """SELECT language, normalized_token, count(*) AS n_tokens,
        count(DISTINCT sentence_id) AS n_sentences, CAST(sum(position) AS BIGINT) AS position_sum
    FROM tokens GROUP BY language, normalized_token""",
)


def _match_all(tail: str = "") -> str:
    return _with(
        ["tokens"],
        """SELECT sentence_id FROM tokens
        WHERE language = 'en' AND normalized_token IN ('the', 'attion')
        GROUP BY sentence_id HAVING count(DISTINCT normalized_token) = 2 """ + tail,
    )


_MATCH_ANY = _with(
    ["tokens"],
    """SELECT DISTINCT sentence_id FROM tokens
    WHERE normalized_token IN ('whereas', 'attion', 'eauouon')""",
)


def _batch(having: str, low: int, high: int) -> str:
    return _with(
        ["tokens", "query_keys"],
        f""", sizes AS (SELECT query_id, count(*) AS n FROM query_keys GROUP BY query_id),
        held AS (SELECT DISTINCT sentence_id, normalized_token FROM tokens),
        hits AS (SELECT k.query_id, h.sentence_id FROM query_keys k
                 JOIN held h ON h.normalized_token = k.key JOIN sizes s ON s.query_id = k.query_id
                 GROUP BY k.query_id, h.sentence_id, s.n {having}),
        ranked AS (SELECT query_id, CAST(row_number() OVER (
                       PARTITION BY query_id ORDER BY sentence_id) AS INTEGER) AS rank, sentence_id
                   FROM hits)
        SELECT query_id, rank, sentence_id FROM ranked WHERE rank > {low} AND rank <= {high}""",
    )


def _ends(rows: str, name: str, order: str, last: str) -> str:
    return f"""{name}_ends AS (SELECT r.sentence_id, count(*) AS n_{name},
        arg_min({last}, {order}) AS first_{name}, arg_max({last}, {order}) AS last_{name}
        FROM {rows} r WHERE r.sentence_id IN (SELECT sentence_id FROM hits) GROUP BY r.sentence_id)"""


_EXTRAS = _with(
    ["tokens", "translations", "sentence_audio", "annotations", "grammar_patterns"],
    ", hits AS (" + """SELECT sentence_id FROM tokens
        WHERE language = 'en' AND normalized_token IN ('the', 'of')
        GROUP BY sentence_id HAVING count(DISTINCT normalized_token) = 2
        ORDER BY sentence_id LIMIT 100""" + "), "
    "french AS (SELECT * FROM translations WHERE language = 'fr'), "
    "known AS (SELECT a.* FROM annotations a JOIN grammar_patterns g USING (pattern_id)), "
    + ", ".join(
        [
            _ends("french", "translations", "(language, translation_id)", "translation_id"),
            _ends("sentence_audio", "audio", "(source, audio_id)", "audio_id"),
            _ends("known", "grammar_patterns", "pattern_id", "pattern_id"),
        ]
    )
    + """ SELECT h.sentence_id,
        coalesce(n_translations, 0) AS n_translations,
        coalesce(first_translations, -1) AS first_translations,
        coalesce(last_translations, -1) AS last_translations,
        coalesce(n_audio, 0) AS n_audio, first_audio, last_audio,
        coalesce(n_grammar_patterns, 0) AS n_grammar_patterns,
        first_grammar_patterns, last_grammar_patterns
    FROM hits h LEFT JOIN translations_ends USING (sentence_id)
    LEFT JOIN audio_ends USING (sentence_id) LEFT JOIN grammar_patterns_ends USING (sentence_id)""",
)

_STORED = _with(
    ["tokens", "sentences"],
    """SELECT s.sentence_id, s.language, md5(s.text) AS text_md5, count(t.sentence_id) AS n_tokens
    FROM sentences s LEFT JOIN tokens t ON t.sentence_id = s.sentence_id
    GROUP BY s.sentence_id, s.language, s.text""",
)

_COUNTS = _with(
    ["links", "tags", "grammar_patterns", "annotations", "sentence_audio"],
    """SELECT 'sentences' AS table_name, count(*) AS n_rows FROM sentences
    UNION ALL SELECT 'links', count(*) FROM links
    UNION ALL SELECT 'tags', count(*) FROM tags
    UNION ALL SELECT 'grammar_patterns', count(*) FROM grammar_patterns
    UNION ALL SELECT 'sentence_grammar_patterns', count(*) FROM annotations
    UNION ALL SELECT 'sentence_audio', count(*) FROM sentence_audio""",
)

#: Columns by which stored tables are compared; the same as those of the queries.
_DIGESTED = {
    "sentences": "sentence_id language text username",
    "sentence_tokens": "sentence_id language normalized_token position",
    "links": "sentence_id translation_id",
    "tags": "sentence_id tag_name",
    "grammar_patterns": "pattern_id language name",
    "sentence_grammar_patterns": "sentence_id pattern_id evidence_text",
    "sentence_audio": "audio_id sentence_id license download_url",
}


def _digest(table: str, rows: str, columns: str | None = None) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in (columns or _DIGESTED[table]).split())
    return f"""SELECT '{table}' AS table_name, count(*) AS n_rows,
        CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest
        FROM {rows}"""


def _digests(**tables: str) -> str:
    columns = {"sentences": "sentence_id language text"}
    return " UNION ALL ".join(_digest(t, rows, columns.get(t)) for t, rows in tables.items())


_TRUSTED = "SELECT * FROM exported WHERE sentence_id IN (SELECT sentence_id FROM quality_ids)"


def _loaded(languages: str) -> str:
    """What the jobs serve: trusted sentences of some languages and what refers to them."""
    ours = "(SELECT sentence_id FROM loaded)"
    empty = "(SELECT * FROM {0} WHERE false)"
    return _with(
        ["exported", "quality_ids", "links_raw", "tags", "exported_audio", "grammar_patterns", "annotations"],
        f""", loaded AS ({_TRUSTED} AND language IN ({languages})),
        loaded_tokens AS (SELECT sentence_id, language, unnest(list) AS normalized_token,
            generate_subscripts(list, 1) - 1 AS position FROM (SELECT sentence_id, language, regexp_extract_all(
                replace(lower(text), 'ß', 'ss'), '[\\p{{L}}\\p{{N}}]+') AS list FROM loaded WHERE text IS NOT NULL))
        """ + _digests(
            sentences="loaded",
            sentence_tokens="loaded_tokens",
            links=f"(SELECT * FROM links_raw WHERE sentence_id IN {ours} AND translation_id IN {ours})",
            tags=f"(SELECT * FROM tags WHERE sentence_id IN {ours})",
            grammar_patterns=empty.format("grammar_patterns"),
            sentence_grammar_patterns=empty.format("annotations"),
            sentence_audio=f"(SELECT * FROM exported_audio WHERE sentence_id IN {ours})",
        ),
    )


_REUSABLE = "coalesce(trim(license), '') NOT IN ('', chr(92) || 'N')"

_DANGLING = """SELECT '{0}' AS table_name, '{1}' AS column_name, CAST({1} AS VARCHAR) AS key,
    count(*) AS n_rows FROM {2} WHERE {1} IS NOT NULL
    AND {1} NOT IN (SELECT {3} FROM {4}) GROUP BY {1}"""

ORACLES: dict[str, str] = {
    "language_filter": _with(
        ["sentences"], f"SELECT {_BRIEF} FROM sentences WHERE language IN ('de', 'fr')"
    ),
    "sentences_by_language": _with(
        ["sentences"], f"SELECT {_BRIEF} FROM sentences WHERE language = 'en'"
    ),
    "long_sentences": _with(
        ["sentences"], f"SELECT {_BRIEF} FROM sentences WHERE length(text) > 1000"
    ),
    "conform_sentences": _with(
        ["sentences"],
        """SELECT sentence_id, language, md5(text) AS text_md5,
        true AS no_username, true AS no_date_added FROM sentences""",
    ),
    "conform_audio": """SELECT 'tatoeba' AS source, CAST(event_id AS VARCHAR) AS audio_id,
        user_id AS sentence_id, coalesce(nullif(event_type, 'view'), 'metadata') AS status,
        true AS no_license FROM events""",
    "list_languages": "SELECT DISTINCT lang AS language FROM documents WHERE lang IS NOT NULL",
    "union_languages": _with(
        ["sentences"],
        """SELECT sentence_id, language, username FROM sentences WHERE language = 'en'
        UNION ALL SELECT sentence_id, language, NULL FROM sentences WHERE language = 'fr'""",
    ),
    "sql_passthrough": _with(
        ["sentences"],
        """SELECT language, username, count(*) AS n_sentences FROM sentences
        WHERE language IN ('en', 'es') AND length(text) >= 200 GROUP BY language, username""",
    ),
    "token_index": _INDEX,
    "stored_token_index": _INDEX,
    "stream_token_index": _INDEX,
    "stream_distinct_sentences": _with(["sentences"], f"SELECT {_BRIEF} FROM sentences"),
    "store_stream_then_batch": _STORED,
    "store_batch_then_stream": _STORED,
    "normalize_query_tokens": _with(
        ["query_keys"],
        """SELECT query_id, count(*) AS n_tokens, string_agg(key, ' ' ORDER BY pos) AS tokens
        FROM query_keys GROUP BY query_id""",
    ),
    "vocab_match_all": _match_all(),
    "vocab_match_any": _MATCH_ANY,
    "vocab_paged": _match_all("ORDER BY sentence_id LIMIT 100 OFFSET 5"),
    "index_match_all": _match_all(),
    "index_match_any": _MATCH_ANY,
    "vocab_batch": _batch("HAVING count(*) = s.n", 0, 100),
    "vocab_batch_any": _batch("", 3, 23),
    "vocab_with_extras": _EXTRAS,
    "index_with_extras": _EXTRAS,
    "vocab_nested": _with(
        ["tokens", "translations", "annotations", "grammar_patterns"],
        """SELECT h.sentence_id,
        (SELECT count(*) FROM translations t WHERE t.sentence_id = h.sentence_id) AS n_translations,
        CAST(0 AS BIGINT) AS n_audio,
        (SELECT count(*) FROM annotations a JOIN grammar_patterns g USING (pattern_id)
         WHERE a.sentence_id = h.sentence_id) AS n_grammar_patterns
        FROM (SELECT sentence_id FROM tokens
            WHERE language = 'en' AND normalized_token IN ('the', 'of')
            GROUP BY sentence_id HAVING count(DISTINCT normalized_token) = 2
            ORDER BY sentence_id LIMIT 50 OFFSET 10) h""",
    ),
    "sentence_by_id": _with(["sentences"], f"SELECT {_BRIEF} FROM sentences WHERE sentence_id = 42"),
    "translations": _with(
        ["translations"],
        "SELECT sentence_id, translation_id, language, md5(text) AS text_md5 FROM translations",
    ),
    "translations_target_lang": _with(
        ["translations", "quality_ids"],
        """SELECT sentence_id, translation_id, language, md5(text) AS text_md5 FROM translations
        WHERE language = 'de' AND sentence_id IN (SELECT sentence_id FROM quality_ids)""",
    ),
    "audio_by_sentence": _with(
        ["sentence_audio", "quality_ids"],
        "SELECT * FROM sentence_audio WHERE sentence_id IN (SELECT sentence_id FROM quality_ids)",
    ),
    "grammar_by_sentence": _with(
        ["annotations", "grammar_patterns", "sentences"],
        """SELECT a.sentence_id, g.pattern_id, g.language, g.name, g.description, g.pattern_text,
        g.source AS pattern_source, g.metadata_json, a.evidence_text, a.confidence,
        a.source AS annotation_source
        FROM annotations a JOIN grammar_patterns g ON g.pattern_id = a.pattern_id
        WHERE a.sentence_id IN (SELECT sentence_id FROM sentences)""",
    ),
    "nested_translations": _with(
        ["translations", "sentences"],
        """SELECT s.sentence_id, count(t.translation_id) AS n_translations,
        count(DISTINCT t.translation_id) AS n_distinct,
        coalesce(arg_min(t.translation_id, (t.language, t.translation_id)), -1) AS first_translation,
        coalesce(arg_max(t.translation_id, (t.language, t.translation_id)), -1) AS last_translation
        FROM sentences s LEFT JOIN translations t ON t.sentence_id = s.sentence_id
        GROUP BY s.sentence_id""",
    ),
    "sentence_with_translations": _with(
        ["translations", "sentences"],
        """SELECT s.sentence_id, s.language AS source_language, t.translation_id, t.language
        FROM sentences s LEFT JOIN translations t ON t.sentence_id = s.sentence_id
        WHERE s.sentence_id = 7""",
    ),
    "translation_pairs": _with(
        ["links", "sentences"],
        """SELECT l.sentence_id, l.translation_id, md5(a.text) AS source_md5,
        md5(b.text) AS target_md5 FROM links l
        JOIN sentences a ON a.sentence_id = l.sentence_id AND a.language = 'en'
        JOIN sentences b ON b.sentence_id = l.translation_id AND b.language = 'fr'""",
    ),
    "tagged_sentences": _with(
        ["sentences", "tags"],
        """SELECT s.sentence_id, s.language, length(s.text) AS n_chars, md5(s.text) AS text_md5
        FROM sentences s JOIN tags t ON t.sentence_id = s.sentence_id WHERE t.tag_name = 'OK'""",
    ),
    "quality_sentences": _with(
        ["sentences", "quality_ids"],
        f"SELECT {_BRIEF} FROM sentences WHERE sentence_id IN (SELECT sentence_id FROM quality_ids)",
    ),
    "quality_links": _with(
        ["links_raw", "quality_ids"],
        """SELECT * FROM links_raw WHERE sentence_id IN (SELECT sentence_id FROM quality_ids)
        AND translation_id IN (SELECT sentence_id FROM quality_ids)""",
    ),
    "quality_tags": _with(
        ["tags", "quality_ids"],
        "SELECT * FROM tags WHERE sentence_id IN (SELECT sentence_id FROM quality_ids)",
    ),
    "quality_flag": _with(
        ["sentences", "quality_ids"],
        """SELECT s.sentence_id, s.language, q.sentence_id IS NOT NULL AS is_quality
        FROM sentences s LEFT JOIN quality_ids q ON q.sentence_id = s.sentence_id""",
    ),
    "quality_from_correctness": """SELECT DISTINCT d.doc_id AS sentence_id FROM documents d
        JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 1""",
    "quality_retention": _with(
        ["sentences", "quality_ids"],
        """SELECT count(*) AS initial_count, count(q.sentence_id) AS kept_count,
        round(100.0 * count(q.sentence_id) / count(*), 4) AS kept_percent
        FROM sentences s LEFT JOIN quality_ids q ON q.sentence_id = s.sentence_id""",
    ),
    "quality_union": """SELECT DISTINCT doc_id AS sentence_id FROM labels
        WHERE quality = 1 OR toxic = 1""",
    "quality_id_count": _with(["quality_ids"], "SELECT count(*) AS n_ids FROM quality_ids"),
    "loaded_links": _with(["links"], "SELECT * FROM links"),
    "loaded_tags": _with(
        ["tags", "sentences"],
        """SELECT * FROM tags
        WHERE sentence_id IN (SELECT sentence_id FROM sentences WHERE language = 'en')""",
    ),
    "loaded_audio": _with(
        ["sentence_audio", "sentences"],
        """SELECT source, audio_id, sentence_id, license, status FROM sentence_audio
        WHERE sentence_id IN (SELECT sentence_id FROM sentences WHERE language = 'en')""",
    ),
    "loaded_annotations": _with(
        ["annotations", "sentences"],
        "SELECT * FROM annotations WHERE sentence_id IN (SELECT sentence_id FROM sentences)",
    ),
    "audio_parse": _with(
        ["sentence_audio", "sentences"],
        "SELECT * FROM sentence_audio WHERE sentence_id IN (SELECT sentence_id FROM sentences)",
    ),
    "audio_license": _with(
        ["audio_export"], f"SELECT audio_id, {_REUSABLE} AS reusable FROM audio_export"
    ),
    "audio_download_plan": _with(
        ["sentence_audio"],
        f"""SELECT audio_id,
        CASE WHEN {_REUSABLE} THEN '/audio/tatoeba/' || audio_id || '.mp3' END AS local_path,
        CASE WHEN {_REUSABLE} THEN '2024-01-01 00:00:00' END AS downloaded_at,
        CASE WHEN {_REUSABLE} THEN 'downloaded' ELSE 'skipped_license' END AS status
        FROM sentence_audio""",
    ),
    "pk_duplicates": """SELECT l_orderkey AS sentence_id, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey HAVING count(*) > 1""",
    "composite_pk_duplicates": _with(
        ["sentence_audio"],
        """SELECT source, username AS audio_id, count(*) AS n_rows FROM sentence_audio
        GROUP BY source, username HAVING count(*) > 1""",
    ),
    "not_null_violations": _with(
        ["sentence_audio"],
        """SELECT 'sentence_audio' AS table_name, 'status' AS column_name, count(*) AS n_rows
        FROM sentence_audio WHERE license IS NULL HAVING count(*) > 0""",
    ),
    "fk_violations": _with(
        ["links_raw", "tags", "annotations", "grammar_patterns", "sentence_audio", "sentences"],
        "\nUNION ALL ".join(
            _DANGLING.format(*parts)
            for parts in (
                ("links", "sentence_id", "links_raw", "sentence_id", "sentences"),
                ("links", "translation_id", "links_raw", "sentence_id", "sentences"),
                ("tags", "sentence_id", "tags", "sentence_id", "sentences"),
                ("sentence_grammar_patterns", "sentence_id", "annotations", "sentence_id", "sentences"),
                ("sentence_grammar_patterns", "pattern_id", "annotations", "pattern_id", "grammar_patterns"),
                ("sentence_audio", "sentence_id", "sentence_audio", "sentence_id", "sentences"),
            )
        )
        + r"""
    UNION ALL SELECT 'sentence_tokens', 'sentence_id', CAST(item_id + 10000000 AS VARCHAR),
        len(regexp_extract_all(text, '[\p{L}\p{N}]+')) FROM benchmark
        WHERE len(regexp_extract_all(text, '[\p{L}\p{N}]+')) > 0""",
    ),
    "length_violations": """SELECT 'sentences' AS table_name, 'username' AS column_name,
        count(*) AS n_rows FROM documents WHERE length(text) > 100 HAVING count(*) > 0""",
    "count_by_language": """SELECT lang AS language, count(*) AS n_sentences FROM documents
        GROUP BY lang""",
    "tag_counts": _with(
        ["tags"], "SELECT sentence_id, count(*) AS n_tags FROM tags GROUP BY sentence_id"
    ),
    "table_row_counts": _COUNTS,
    "length_stats": """SELECT count(n) AS n_sentences, round(avg(n), 4) AS mean_length,
        round(stddev_samp(n), 4) AS std_length, min(n) AS min_length,
        quantile_cont(n, 0.25) AS q25_length, quantile_cont(n, 0.5) AS q50_length,
        quantile_cont(n, 0.75) AS q75_length, max(n) AS max_length
        FROM (SELECT length(text) AS n FROM documents)""",
    "top_words": r"""SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 10""",
    "word_counts": r"""SELECT doc_id AS sentence_id,
        CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS BIGINT)
            AS n_words FROM documents""",
    "write_read_roundtrip": _with(
        ["links", "sentences"],
        f"""SELECT {_BRIEF.replace('sentence_id', 's.sentence_id', 1)}, coalesce(d.n_links, 0) AS n_links
        FROM sentences s LEFT JOIN (SELECT sentence_id, count(*) AS n_links FROM links
            GROUP BY sentence_id) d ON d.sentence_id = s.sentence_id WHERE language = 'en'""",
    ),
    "partition_overwrite": _with(
        ["sentences"],
        """SELECT sentence_id, language,
        length(kept) AS n_chars, md5(kept) AS text_md5
        FROM (SELECT *, CASE WHEN language = 'fr' THEN left(text, 10) ELSE text END AS kept FROM sentences)
        WHERE language IN ('en', 'fr')""",
    ),
    "partitioned_roundtrip": _with(
        ["sentences"], f"SELECT {_BRIEF} FROM sentences WHERE language = 'de'"
    ),
    "compact_roundtrip": _with(["sentences"], f"SELECT {_BRIEF} FROM sentences"),
    "store_load": _with(
        ["tokens", "links", "tags", "grammar_patterns", "annotations", "sentence_audio"],
        " UNION ALL ".join(
            _digest(table, {"sentence_tokens": "tokens", "sentence_grammar_patterns": "annotations"}.get(table, table))
            for table in _DIGESTED
        ),
    ),
    "store_compact": _STORED,
    "store_rebuild_from_self": "SELECT * FROM (" + _STORED + ") WHERE language IN ('fr', 'es')",
    "store_append_repeat": _with(
        ["tokens", "sentences"],
        """SELECT s.sentence_id, s.language, md5(s.text || CASE WHEN language = 'en' THEN '' ELSE ' again' END) AS text_md5,
        (SELECT count(*) FROM tokens t WHERE t.sentence_id = s.sentence_id)
            + CASE WHEN language = 'en' THEN 0 ELSE 1 END AS n_tokens, CAST(0 AS BIGINT) AS n_refused
        FROM sentences s
        UNION ALL SELECT sentence_id, NULL, NULL, NULL, 1 FROM sentences WHERE language = 'en'""",
    ),
    "stream_interrupted": _with(
        ["tokens", "sentences"],
        """, arrived AS (SELECT * FROM sentences WHERE language IN ('en', 'fr')
            UNION ALL SELECT * FROM sentences WHERE language IN ('fr', 'de')),
        of_language AS (SELECT language, count(*) * CASE WHEN language = 'fr' THEN 2 ELSE 1 END AS n_tokens
            FROM tokens WHERE language IN ('en', 'fr', 'de') GROUP BY language)
        SELECT CASE WHEN sentence_id % 10 <> 3 THEN sentence_id END AS sentence_id, a.language,
            md5(text) AS text_md5, count(*) AS n_rows, any_value(n_tokens) AS n_tokens
        FROM arrived a JOIN of_language o ON o.language = a.language GROUP BY 1, 2, 3""",
    ),
    "vocab_deep_page": _with(
        ["tokens"],
        """SELECT sentence_id, count(*) AS n_hits FROM (SELECT sentence_id FROM tokens
        WHERE normalized_token = 'the' ORDER BY sentence_id LIMIT 700 OFFSET 450) GROUP BY sentence_id""",
    ),
    "nested_order": _with(
        ["translations"],
        """SELECT sentence_id, row_number() OVER (PARTITION BY sentence_id ORDER BY language, translation_id) - 1 AS place,
        translation_id, language, count(*) AS copies, md5(text) AS text_md5
        FROM translations GROUP BY sentence_id, translation_id, language, text""",
    ),
    "nested_children": _with(
        ["tokens", "sentence_audio", "annotations", "grammar_patterns"],
        """, hits AS (SELECT sentence_id FROM tokens WHERE language = 'en' AND normalized_token IN ('the', 'of')
            GROUP BY sentence_id HAVING count(DISTINCT normalized_token) = 2 ORDER BY sentence_id LIMIT 100)
        SELECT sentence_id, 'audio' AS kind, audio_id AS key, concat_ws('|', username, license, download_url) AS content,
            count(*) AS n_rows FROM sentence_audio WHERE sentence_id IN (SELECT sentence_id FROM hits) GROUP BY 1, 2, 3, 4
        UNION ALL SELECT a.sentence_id, 'grammar', g.pattern_id, concat_ws('|', g.name, g.source, a.evidence_text, a.source),
            count(*) FROM annotations a JOIN grammar_patterns g USING (pattern_id)
            WHERE a.sentence_id IN (SELECT sentence_id FROM hits) GROUP BY 1, 2, 3, 4""",
    ),
    "grouped_lookup": _with(
        ["translations"],
        """SELECT i.id AS sentence_id, count(t.sentence_id) AS n_translations
        FROM (SELECT item_id AS id FROM benchmark UNION SELECT 1000000000000) i
        LEFT JOIN translations t ON t.sentence_id = i.id GROUP BY i.id""",
    ),
    "requested_ids": "SELECT DISTINCT item_id // 3 AS sentence_id FROM benchmark",
    "clustered_order": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order FROM lineitem",
    "surrogate_id_count": "SELECT count(*) AS n_rows, count(*) AS n_ids, true AS after FROM lineitem",
    "export_sentences": _with(["exported"], f"SELECT {_BRIEF} FROM exported WHERE language IN ('en', 'fr', 'xx')"),
    "export_detailed": _with(
        ["exported"],
        """SELECT sentence_id, language, md5(text) AS text_md5, username, '2021-02-03 04:05:06' AS date_added,
        true AS unmodified FROM exported
        UNION ALL SELECT sentence_id, language, md5(text), NULL, NULL, NULL FROM exported WHERE language = 'de'""",
    ),
    "export_links": _with(["links_raw"], "SELECT * FROM links_raw"),
    "export_tags": _with(["tags"], "SELECT * FROM tags"),
    "export_quality_ids": _with(["quality_ids"], "SELECT * FROM quality_ids"),
    "export_audio": _with(
        ["exported_audio", "sentences"],
        "SELECT * FROM exported_audio WHERE sentence_id IN (SELECT sentence_id FROM sentences)",
    ),
    "audio_fetch": _with(
        ["sentence_audio"],
        f"""SELECT audio_id, CASE WHEN NOT {_REUSABLE} THEN 'skipped_license'
            WHEN audio_id LIKE '%7' THEN 'download_error' ELSE 'downloaded' END AS status,
        CASE WHEN {_REUSABLE} AND audio_id NOT LIKE '%7' THEN 'tatoeba/' || audio_id || '.mp3' END AS path,
        {_REUSABLE} AND audio_id NOT LIKE '%7' AS stamped FROM sentence_audio""",
    ),
    "job_extract": _with(
        ["exported", "quality_ids", "links_raw", "tags", "exported_audio"],
        f""", kept AS ({_TRUSTED} AND language IN ('en', 'de'))
        """ + _digests(
            sentences="kept",
            links="""(SELECT * FROM links_raw WHERE sentence_id IN (SELECT sentence_id FROM quality_ids)
                AND translation_id IN (SELECT sentence_id FROM quality_ids))""",
            tags="(SELECT * FROM tags WHERE sentence_id IN (SELECT sentence_id FROM quality_ids))",
            sentence_audio="(SELECT * FROM exported_audio WHERE sentence_id IN (SELECT sentence_id FROM kept))",
        ),
    ),
    "job_load": _loaded("'de'"),
    "job_run": _loaded("'en', 'fr'"),
}
