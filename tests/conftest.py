import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SCHEMAS = {
    "sentences": "sentence_id bigint, language string, text string",
    "links": "sentence_id bigint, translation_id bigint",
    "tags": "sentence_id bigint, tag_name string",
    "sentence_audio": "audio_id string, sentence_id bigint, username string, license string",
    "grammar_patterns": "pattern_id string, language string, name string, source string",
    "sentence_grammar_patterns": "sentence_id bigint, pattern_id string, evidence_text string, confidence double, source string",
}


def drawn_rows(seed: int = 20) -> dict[str, list[tuple]]:
    """A corpus of made-up words in four languages; whatever a search should find is worked out from these rows."""
    draw = random.Random(seed)
    languages = ["lat", "epo", "vol", "ido"]
    stems = {lang: [a + b + "aeiou"[k % 5] for k, (a, b) in enumerate(zip("bdfgklmnprst" * 2, "lrmnst" * 4))] for lang in languages}
    shared = ["radio", "Metro", "ΟΔΟΣ", "straße"]
    sentences = []
    for number in draw.sample(range(100, 900), 70):
        lang = draw.choice(languages)
        words = draw.choices(stems[lang][:9] + shared, k=draw.randint(0, 9))
        text = draw.choice(["", "« ", "— "]) + draw.choice([" ", ", ", " / "]).join(draw.choice([str, str.upper, str.title])(w) for w in words)
        sentences.append((number, lang, text))
    numbers = [s[0] for s in sentences]
    pairs = [(draw.choice(numbers), draw.choice(numbers)) for _ in range(160)]
    pairs += draw.choices(pairs, k=15) + [(numbers[0], n) for n in numbers[1:25]]
    patterns = [(f"p{k}", draw.choice(languages), f"pattern {k}", draw.choice(["book", "desk"])) for k in range(8)]
    return {
        "sentences": sentences,
        "links": pairs,
        "tags": [(n, draw.choice(["checked", "odd", "short"])) for n in draw.choices(numbers, k=50)],
        "sentence_audio": [(f"rec{k:03}", draw.choice(numbers), draw.choice(["ines", "tomo"]), draw.choice(["CC0", None])) for k in range(45)],
        "grammar_patterns": patterns,
        "sentence_grammar_patterns": [
            (draw.choice(numbers), draw.choice(patterns)[0], draw.choice([None, "here"]), draw.choice([0.5, 0.25]), "hand")
            for _ in range(60)
        ],
    }


@pytest.fixture(scope="session")
def drawn():
    return drawn_rows()


@pytest.fixture(scope="session")
def corpus(spark, drawn):
    """The drawn rows as tables, without a token index."""
    from sentaria.operators.conform import conform

    return {table: conform(spark.createDataFrame(rows, SCHEMAS[table]), table) for table, rows in drawn.items()}
