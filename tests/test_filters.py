"""Quality lists, conforming, referential filtering and validation reports."""

import pytest
from pyspark.sql import functions as F

from sentaria.operators import integrity as g
from sentaria.operators import quality as q
from sentaria.operators.conform import conform, surrogate_ids
from sentaria.schemas import SCHEMAS


def values(df, column="sentence_id"):
    return sorted(row[column] for row in df.collect())


def id_frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "sentence_id bigint")


#: Numbered rows, and lists of trusted numbers with repeats and unknown numbers among them.
NUMBERS = list(range(10, 80, 3))
LISTS = [[13, 13, 40, 999], NUMBERS[::2], NUMBERS, [1000]]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(n, f"text {n}") for n in NUMBERS], "sentence_id bigint, text string")


@pytest.mark.parametrize("trusted", LISTS)
def test_keep_and_flag_trusted(spark, rows, trusted):
    ids = id_frame(spark, *trusted)
    assert values(q.keep_trusted(rows, ids)) == [n for n in NUMBERS if n in trusted]
    flagged = {r["sentence_id"]: r["is_quality"] for r in q.flag_trusted(rows, ids).collect()}
    assert flagged == {n: n in trusted for n in NUMBERS}
    kept = sum(n in trusted for n in NUMBERS)
    assert tuple(q.retention(rows, ids).first()) == (len(NUMBERS), kept, 100.0 * kept / len(NUMBERS))
    assert q.trusted_count(ids).first()["n_ids"] == len(set(trusted))
    more = q.add_ids(ids, id_frame(spark, 13, 5))
    assert values(more) == sorted({*trusted, 13, 5})


def test_empty_list_means_no_filter(spark, rows):
    assert values(q.keep_trusted(rows, id_frame(spark))) == NUMBERS
    assert tuple(q.retention(rows, id_frame(spark)).first()) == (len(NUMBERS), len(NUMBERS), 100.0)
    assert tuple(q.retention(rows.limit(0), id_frame(spark, 1)).first()) == (0, 0, None)


def test_keep_trusted_on_both_ends(spark, corpus, drawn):
    trusted = [n for n, _, _ in drawn["sentences"]][::3]
    kept = q.keep_trusted(corpus["links"], id_frame(spark, *trusted), "sentence_id", "translation_id")
    want = [pair for pair in drawn["links"] if pair[0] in trusted and pair[1] in trusted]
    assert want and sorted(map(tuple, kept.select("sentence_id", "translation_id").collect())) == sorted(want)


def test_ids_from_correctness(spark):
    df = spark.createDataFrame(
        [(1, 0), (2, -1), (3, None), (4, 5)], "sentence_id bigint, correctness int"
    )
    assert values(q.ids_from_correctness(df)) == [1, 4]
    assert values(q.ids_from_correctness(df.drop("correctness"))) == []


def test_conform_fills_orders_and_casts(spark):
    df = spark.createDataFrame(
        [("7", 1.0, None, "x"), ("8", float("nan"), "done", "y")],
        "audio_id string, sentence_id double, status string, other string",
    )
    out = conform(df, "sentence_audio")
    assert out.schema.names == SCHEMAS["sentence_audio"].names
    assert [f.dataType for f in out.schema] == [f.dataType for f in SCHEMAS["sentence_audio"]]
    got = sorted((r["source"], r["audio_id"], r["sentence_id"], r["status"]) for r in out.collect())
    assert got == [("tatoeba", "7", 1, "metadata"), ("tatoeba", "8", None, "done")]


def test_conform_nan_confidence_is_null(spark):
    df = spark.createDataFrame([(1, "p", float("nan"))], "sentence_id int, pattern_id string, confidence double")
    assert conform(df, "sentence_grammar_patterns").first()["confidence"] is None


def test_surrogate_ids(spark):
    out = surrogate_ids(spark.range(100).select(F.col("id").alias("sentence_id")), after=10)
    found = values(out, "id")
    assert len(set(found)) == 100 and min(found) == 11


def test_allow_list(spark, rows):
    assert values(g.keep_allowed(rows, None)) == NUMBERS
    assert values(g.keep_allowed(rows, id_frame(spark))) == []
    assert values(g.keep_allowed(rows, id_frame(spark, 16, 7))) == [16]


def test_ids_are_cast_before_comparing(spark):
    text_ids = spark.createDataFrame([("1", "a"), ("5", "b")], "sentence_id string, tag_name string")
    assert values(g.keep_known(text_ids, id_frame(spark, 1, 2))) == [1]


def test_reports_on_clean_corpus_are_empty(corpus):
    from sentaria.operators.retrieval import token_rows

    tables = {**corpus, "sentence_tokens": token_rows(corpus["sentences"])}
    for name, report in g.validate(tables).items():
        assert report.count() == 0, name


def test_reports_find_faults(spark, corpus, drawn):
    taken = min(n for n, _, _ in drawn["sentences"])
    bad_sentence = spark.createDataFrame(
        [(taken, None, "again"), (7, "x" * 11, None)], "sentence_id bigint, language string, text string"
    )
    bad_links = spark.createDataFrame([(taken, 50), (50, 50), (None, taken)], "sentence_id bigint, translation_id bigint")
    audio = corpus["sentence_audio"]
    tables = {
        **corpus,
        "sentences": corpus["sentences"].unionByName(conform(bad_sentence, "sentences")),
        "links": corpus["links"].unionByName(bad_links),
        "sentence_audio": audio.union(audio),
    }
    reports = {name: [tuple(r) for r in df.collect()] for name, df in g.validate(tables).items()}
    assert reports["duplicate_keys_sentences"] == [(taken, 2)]
    assert sorted(reports["duplicate_keys_sentence_audio"]) == sorted(
        ("tatoeba", row[0], 2) for row in drawn["sentence_audio"]
    )
    assert sorted(reports["nulls"]) == [
        ("links", "sentence_id", 1), ("sentences", "language", 1), ("sentences", "text", 1)
    ]
    assert reports["lengths"] == [("sentences", "language", 1)]
    assert sorted(reports["references"]) == [
        ("links", "sentence_id", "50", 1), ("links", "translation_id", "50", 2)
    ]
