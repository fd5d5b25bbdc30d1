"""Searches and lookups against plain loops over the same rows."""

import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentaria.operators import retrieval as r
from sentaria.operators.conform import conform
from sentaria.operators.ranking import page_of
from sentaria.sinks.keyed import in_ranges, value_ranges


def ids(df):
    return sorted(row["sentence_id"] for row in df.collect())


def keys_of(text):
    return {w.casefold() for w in re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", text or ""))}


def slow_search(drawn, words, language=None, target_language=None, match_all=True, limit=100, offset=0):
    """``{id: (translations, audio ids, patterns)}`` of a page, in order."""
    wanted = set().union(*map(keys_of, [words] if isinstance(words, str) else words))
    texts = {n: (lang, text) for n, lang, text in drawn["sentences"]}
    hits = [
        n for n, (lang, text) in sorted(texts.items())
        if wanted and language in (None, lang)
        and (wanted <= keys_of(text) if match_all else wanted & keys_of(text))
    ][offset : offset + limit]
    found = {}
    for n in hits:
        translations = Counter(
            (texts[b][0], b, texts[b][1]) for a, b in drawn["links"]
            if a == n and target_language in (None, texts[b][0])
        )
        audio = sorted(row[0] for row in drawn["sentence_audio"] if row[1] == n)
        patterns = Counter(row[1:] for row in drawn["sentence_grammar_patterns"] if row[0] == n)
        found[n] = (sorted(translations.items()), audio, patterns)
    return found


def fast_search(tables, *args, **options):
    rows = r.search_vocabulary(tables, *args, **options).nested().collect()
    return {
        row["sentence"]["sentence_id"]: (
            [((t["language"], t["translation_id"], t["text"]), t["copies"]) for t in row["translations"]],
            [a["audio_id"] for a in row["audio"]],
            Counter({
                (g["pattern_id"], g["evidence_text"], g["confidence"], g["annotation_source"]): g["copies"]
                for g in row["grammar_patterns"]
            }),
        )
        for row in rows
    }


@pytest.fixture(scope="module", params=["text", "index"])
def tables(request, corpus):
    if request.param == "text":
        return corpus
    return {**corpus, "sentence_tokens": r.token_rows(corpus["sentences"])}


SEARCHES = [
    ("radio", {}),
    (["RADIO", "metro"], {"language": "lat"}),
    ("Radio! ...metro", {"match_all": False, "limit": 9, "offset": 4}),
    ("οδος", {"target_language": "epo"}),
    (["ＳＴＲＡＳＳＥ"], {"target_language": "none"}),
    ("straße radio metro", {"match_all": False, "language": "vol"}),
    ("bla dre", {"match_all": False, "limit": 3}),
    ("radio", {"limit": 2, "offset": 60}),
    ("nowhere", {}),
    (" ... ", {}),
    ([], {}),
]


@pytest.mark.parametrize("words, options", SEARCHES)
def test_search_equals_plain_loops(tables, drawn, words, options):
    want = slow_search(drawn, words, **options)
    got = fast_search(tables, words, **options)
    assert list(got) == list(want)
    assert got == want
    flat = r.search_vocabulary(tables, words, **options).sentences.collect()
    assert [row["sentence_id"] for row in flat] == list(want)


def test_the_searches_find_something(drawn):
    sizes = [len(slow_search(drawn, words, **options)) for words, options in SEARCHES]
    assert sum(n > 1 for n in sizes) >= 6 and sizes[0] > 10


def test_extras_can_be_left_out(tables):
    found = r.search_vocabulary(
        tables, "radio", include_translations=False, include_audio=False, include_grammar=False
    )
    assert found.translations is None
    rows = found.nested().collect()
    assert rows and all(row["translations"] == row["audio"] == row["grammar_patterns"] == [] for row in rows)


def test_an_index_of_missing_sentences_leaves_no_gaps(spark, corpus, drawn):
    gone = [n for n, _, text in sorted(drawn["sentences"]) if "radio" in keys_of(text)][::2]
    index = r.token_rows(corpus["sentences"])
    tables = {**corpus, "sentences": corpus["sentences"].filter(~F.col("sentence_id").isin(gone)), "sentence_tokens": index}
    left = {**drawn, "sentences": [s for s in drawn["sentences"] if s[0] not in gone]}
    found = r.search_vocabulary(tables, "radio", limit=4, offset=1, include_translations=False)
    assert ids(found.sentences) == list(slow_search({**left, "links": []}, "radio", limit=4, offset=1))


def test_many_keys(spark):
    """More keys than one bit mask holds."""
    words = [f"w{i}" for i in range(150)]
    df = spark.createDataFrame(
        [(1, "en", " ".join(words)), (2, "en", " ".join(words[:149])), (3, "en", " ".join(words[1:]))],
        "sentence_id bigint, language string, text string",
    )
    tokens = r.token_rows(df)
    assert ids(r.match_index(tokens, words)) == [1]
    assert ids(r.match_index(tokens, words[:62])) == [1, 2]
    assert ids(r.match_index(tokens, words[:63])) == [1, 2]
    assert ids(r.match_text(df, words)) == [1]


# --- pages ---------------------------------------------------------------------


@pytest.mark.parametrize("limit,offset", [(3, 0), (4, 5), (100, 8), (7, 30), (2, 500), (0, 3)])
def test_deep_pages_equal_shallow_ones(spark, limit, offset):
    rows = [(v // 3 - 5, "ab"[v % 2]) for v in range(60)] + [(7, "b")] * 20 + [(None, "x"), (1 << 62, None)]
    hits = spark.createDataFrame(rows, "sentence_id bigint, note string").repartition(5)
    want = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))[offset : offset + limit]
    for top_rows in (0, 10**6):
        assert [tuple(x) for x in r.page(hits, limit, offset, top_rows).collect()] == want


def test_pages_of_many_partitions(spark, monkeypatch):
    monkeypatch.setattr("sentaria.sinks.parquet.WRITE_PARTITION_BYTES", 20_000)
    hits = spark.range(30_000).select((F.col("id") * 7 % 10_000).alias("sentence_id"))
    got = [x[0] for x in page_of(hits, "sentence_id", 500, 14_990, top_rows=0).collect()]
    assert got == [k // 3 for k in range(14_990, 15_490)]


# --- lookups -------------------------------------------------------------------


@pytest.fixture(scope="module")
def linked(spark):
    sentences = spark.createDataFrame(
        [(1, "en", "a"), (2, "fr", "b"), (3, "de", "c"), (4, None, "d")],
        "sentence_id bigint, language string, text string",
    )
    links = spark.createDataFrame(
        [(1, 2), (1, 2), (1, 3), (1, 4), (1, 99), (2, 1), (98, 1)],
        "sentence_id bigint, translation_id bigint",
    )
    return {"sentences": conform(sentences, "sentences"), "links": conform(links, "links")}


def test_links_are_directed_and_repeats_stay(spark, linked):
    look = lambda ids: r.translations_of(linked["links"], linked["sentences"], r.requested(spark, ids))
    assert sorted((x["sentence_id"], x["translation_id"]) for x in look([1, 1, 3]).collect()) == [
        (1, 2), (1, 2), (1, 3), (1, 4)
    ]
    assert ids(look(3)) == []


def test_grouped_lookups(spark, linked, corpus, drawn):
    rows = {x["sentence_id"]: x["items"] for x in r.grouped_translations(linked, [1, 3, 1, 77]).collect()}
    # A missing language sorts first, then de and fr.
    assert [(i["translation_id"], i["copies"]) for i in rows[1]] == [(4, 1), (3, 1), (2, 2)]
    assert rows[3] == rows[77] == []
    wanted = [n for n, _, _ in drawn["sentences"][:20]]
    audio = {x["sentence_id"]: [i["audio_id"] for i in x["items"]] for x in r.grouped_audio(corpus, wanted).collect()}
    assert audio == {n: sorted(a for a, of, _, _ in drawn["sentence_audio"] if of == n) for n in wanted}
    grammar = {x["sentence_id"]: [i["pattern_id"] for i in x["items"]] for x in r.grouped_grammar(corpus, wanted).collect()}
    own = lambda n: sorted({row[1:] for row in drawn["sentence_grammar_patterns"] if row[0] == n}, key=lambda p: p[0])
    assert grammar == {n: [p[0] for p in own(n)] for n in wanted}


def test_sentence_with_translations(linked):
    found = r.sentence_with_translations(linked, 1)
    assert ids(found.sentences) == [1] and ids(found.translations) == [1, 1, 1, 1]
    unknown = r.sentence_with_translations(linked, 98)
    assert ids(unknown.sentences) == [] and ids(unknown.translations) == []


def test_large_groups_are_split_but_whole(spark):
    children = spark.range(1000).select(
        F.lit(1).cast("bigint").alias("sentence_id"), F.col("id").alias("translation_id")
    )
    children = children.union(spark.createDataFrame([(2, 5)] * 700, children.schema))
    rows = r.nest(children, ("translation_id",), part_rows=100).collect()
    hot = sorted((x for x in rows if x["sentence_id"] == 1), key=lambda x: x["part"])
    assert len(hot) >= 8 and max(len(x["items"]) for x in hot) < 200
    # parts follow one another in order
    assert [i["translation_id"] for x in hot for i in x["items"]] == list(range(1000))
    (copies,) = [x["items"] for x in rows if x["sentence_id"] == 2]
    assert [(i["translation_id"], i["copies"]) for i in copies] == [(5, 700)]


def test_switched_off_extras_keep_their_type(corpus):
    """Arrays have one type, whether an extra was asked for or not."""
    full = r.search_vocabulary(corpus, "radio").nested().schema
    bare = r.search_vocabulary(
        corpus, "radio", include_translations=False, include_audio=False, include_grammar=False
    ).nested().schema
    nothing = r.search_vocabulary(corpus, "...").nested().schema
    kinds = lambda schema: {f.name: f.dataType.simpleString() for f in schema}
    assert kinds(full) == kinds(bare) == kinds(nothing)


def scanned_rows(df):
    """Rows that the scans of an executed plan gave out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.fixture(scope="module")
def stored_tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lookups"))
    n = 40_000
    sentences = spark.range(n).select(
        F.col("id").alias("sentence_id"), F.lit("en").alias("language"), F.md5(F.col("id").cast("string")).alias("text")
    )
    links = spark.range(n).select(F.col("id").alias("sentence_id"), ((F.col("id") * 7919) % n).alias("translation_id"))
    small = {"parquet.block.size": "65536", "parquet.page.size": "8192", "parquet.block.size.row.check.min": "100"}
    for name, df in (("sentences", conform(sentences, "sentences")), ("links", links)):
        writer = df.repartitionByRange(4, "sentence_id").sortWithinPartitions("sentence_id").write
        for key, value in small.items():
            writer = writer.option(key, value)
        writer.parquet(f"{base}/{name}")
    return {name: spark.read.parquet(f"{base}/{name}") for name in ("sentences", "links")}


def test_point_lookup_skips_row_groups_and_shuffles_no_sentences(stored_tables):
    found = r.sentence_with_translations(stored_tables, 1234)
    (row,) = found.translations.collect()
    assert row["translation_id"] == 1234 * 7919 % 40_000
    plan = found.translations._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert f"EqualTo(sentence_id,{row['translation_id']})" in plan
    assert scanned_rows(found.translations) < 20_000


def test_ranges_hold_every_value(spark):
    for values in ([5], [3, 9, 4, 9], list(range(0, 3000, 7)) + [10**12], list(range(30_000))):
        frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
        ranges = value_ranges(frame)
        assert len(ranges) <= 64 and all(a <= b for a, b in ranges)
        inside = spark.range(0, 31_000).toDF("v").union(frame).filter(in_ranges("v", ranges)).filter(F.col("v").isin(values[:50]))
        assert {row["v"] for row in inside.collect()} == set(values[:50])
    assert value_ranges(spark.createDataFrame([], "v bigint")) == []
    assert spark.range(3).filter(in_ranges("id", [])).count() == 0
    words = spark.createDataFrame([(f"k{v:03}",) for v in range(100)], "v string")
    assert words.filter(in_ranges("v", value_ranges(words))).count() == 100


# --- batch search against single searches ---------------------------------------

TEXTS = [
    (i, "en" if i % 3 else "fr", f"the word{i % 7} and item{i % 5} rare{i // 40}") for i in range(200)
]
BATCH = [
    (1, "the", None), (2, "WORD1 item2", None), (3, "the rare3", "en"), (4, "item0 word0 the", "fr"),
    (5, "missing the", None), (6, "...", None), (7, "rare0 rare1", None),
]


@pytest.fixture(scope="module")
def many(spark):
    return spark.createDataFrame(TEXTS, "sentence_id bigint, language string, text string")


@pytest.mark.parametrize("match_all", [True, False])
@pytest.mark.parametrize("limit,offset", [(10, 0), (7, 4), (1500, 0)])
def test_batch_equals_single_searches(spark, many, match_all, limit, offset):
    queries = spark.createDataFrame(BATCH, "query_id int, words string, language string")
    rows = r.search_batch(queries, r.token_rows(many), match_all, limit, offset).collect()
    got = sorted((x["query_id"], x["rank"], x["sentence_id"]) for x in rows)

    want = []
    for query_id, text, language in BATCH:
        keys = set(text.lower().split()) - {"..."}
        if not keys:
            continue
        hits = [
            i for i, lang, sentence in TEXTS
            if language in (None, lang)
            and (keys <= set(sentence.split()) if match_all else keys & set(sentence.split()))
        ]
        page = list(enumerate(hits, 1))[offset : offset + limit]
        want += [(query_id, rank, i) for rank, i in page]
    assert got == sorted(want)


def test_batch_accepts_word_lists(spark, many):
    queries = spark.createDataFrame([(1, ["word1 ITEM2", "the"])], "query_id int, words array<string>")
    rows = r.search_batch(queries, r.token_rows(many)).collect()
    want = [i for i, _, text in TEXTS if {"word1", "item2"} <= set(text.split())]
    assert sorted(x["sentence_id"] for x in rows) == want
