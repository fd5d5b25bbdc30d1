import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentaria.functions.scalar import parse_int, strip, word_count
from sentaria.functions.text import (
    TOKEN_PATTERN,
    fold_case,
    nfkc,
    normalize_token,
    query_tokens,
    resolve_query_tokens,
    text_contains,
    tokenize_text,
)


def expected_tokens(text):
    words = re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", text or ""))
    return [(w, w.casefold(), i) for i, w in enumerate(words)]


def tokens_of(spark, texts, tokenizer=tokenize_text):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = df.select("i", tokenizer(F.col("text")).alias("t")).orderBy("i").collect()
    return [[tuple(token) for token in row["t"]] for row in rows]


EDGE_TEXTS = [
    "Zwölf Boxkämpfer; JAGEN Viktor...",
    "ｑｕｉｃｋ　ｂｒｏｗｎ foxes",
    "Straße STRASSE",
    "ΣΑΣ ΐ ǰ",
    "İstanbul ıI",
    "½ ① ²",
    "snake_case __x__",
    "",
    None,
    "日本語のテスト 123",
    "été café",
    "ŉ ﬁre ſharp",
]


def test_tokens_match_plain_python(spark):
    assert tokens_of(spark, EDGE_TEXTS) == [expected_tokens(t) for t in EDGE_TEXTS]


def test_every_assigned_code_point(spark):
    """NFKC, case fold and token class agree with Python wherever both know the character."""
    points = [
        i for i in range(0x110000)
        if unicodedata.category(chr(i)) not in ("Cn", "Cs", "Co") and i != 0
    ]
    import pandas as pd

    word = re.compile(r"[^\W_]")
    chars = pd.Series([chr(i) for i in points])
    frame = pd.DataFrame(
        {
            "i": points,
            "c": chars,
            "form": chars.map(lambda c: unicodedata.normalize("NFKC", c)),
            "folded": chars.map(str.casefold),
            "inside": chars.map(lambda c: bool(word.fullmatch(c))),
        }
    )
    df = spark.createDataFrame(frame).withColumn(
        "known_to_java",
        F.java_method(F.lit("java.lang.Character"), F.lit("getType"), F.col("i").cast("int")) != "0",
    )
    wrong = df.filter(
        (nfkc(F.col("c")) != F.col("form"))
        | (fold_case(F.col("c")) != F.col("folded"))
        | (F.col("known_to_java") & (F.col("c").rlike(f"^{TOKEN_PATTERN}$") != F.col("inside")))
    )
    assert wrong.count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(
            # Scripts old enough for both Unicode versions.
            st.characters(exclude_categories=("Cs", "Cn", "Co"), exclude_characters="\0", max_codepoint=0x86F)
        ),
        min_size=50,
        max_size=200,
    )
)
def test_random_texts(spark, texts):
    assert tokens_of(spark, texts) == [expected_tokens(t) for t in texts]


def test_normalize_token(spark):
    row = spark.range(1).select(normalize_token(F.lit("ＳＴＲＡẞＥ")).alias("x")).first()
    assert row["x"] == "strasse"


def test_query_tokens(spark):
    assert resolve_query_tokens(spark, ["Hello, WORLD", "hello"]) == ["hello", "world"]
    assert resolve_query_tokens(spark, "b a B") == ["b", "a"]
    assert resolve_query_tokens(spark, [12, "x"]) == ["12", "x"]
    assert resolve_query_tokens(spark, []) == []
    assert resolve_query_tokens(spark, " ,. ") == []
    df = spark.createDataFrame([(["b a", "A c"],)], "words array<string>")
    assert df.select(query_tokens(F.col("words"), is_list=True)).first()[0] == ["b", "a", "c"]


def test_text_contains(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "B, c"), (3, None)], "i int, text string")
    def hits(keys, match_all):
        found = df.filter(text_contains(F.col("text"), keys, match_all)).collect()
        return sorted(r["i"] for r in found)

    assert hits(["a", "b"], True) == [1]
    assert hits(["a", "c"], False) == [1, 2]


@pytest.mark.parametrize(
    "text", [" 12 ", "+5", "-7", "12.7", "1_000", "_1", "1__0", "", "x", "\t3 ", "1e3", None]
)
def test_parse_int_like_python(spark, text):
    try:
        want = int(text)
    except (TypeError, ValueError):
        want = None
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(parse_int(F.col("x"))).first()[0] == want


def test_strip_and_word_count(spark):
    texts = ["  a b \t", "\x1fx\x1c y ", "", "one\ttwo\nthree"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = df.select(strip(F.col("x")), word_count(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [(t.strip(), len(t.split())) for t in texts]
