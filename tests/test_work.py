"""Work that was done more than once, or row by row in interpreted code."""

from pyspark.sql import functions as F

from sentaria.functions.scalar import parse_int, strip
from sentaria.functions.text import tokenize_text
from sentaria.operators.retrieval import token_rows
from sentaria.plans.sizing import input_bytes
from sentaria.sinks.store import CorpusStore
from sentaria.sources.exports import read_audio_export, read_links


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_token_rows_are_compiled(spark):
    """keys come from no function over an array, and are the same as those of whole texts."""
    texts = ["", None, "The the THE cat", "Straße ΟΔΟΣ İstanbul", "ﬁne １２ x", " \t", "a" * 40 + " é"]
    rows = spark.createDataFrame([(n, "xx" if n % 3 else None, t) for n, t in enumerate(texts)], "sentence_id long, language string, text string")
    found = token_rows(rows)
    assert "lambdafunction" not in plan_of(found)
    whole = rows.select("sentence_id", "language", F.inline(tokenize_text(F.col("text"))))
    assert found.columns == whole.columns and [f.dataType for f in found.schema] == [f.dataType for f in whole.schema]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_a_table_without_rows_is_planned_in_the_jvm(spark, tmp_path):
    """its size is known, and no Python worker makes its rows."""
    held = CorpusStore(spark, str(tmp_path / "store")).create_tables()
    for table, rows in held.tables().items():
        assert input_bytes(rows) is not None and "ExistingRDD" not in plan_of(rows), table
        assert rows.count() == 0


def test_a_line_is_parsed_once(spark, tmp_path):
    """a filter on a field does not parse the line again."""
    (tmp_path / "links").write_text("1\t2\n x\t3\n\\N\t4\n5\n 6\t 7\t8\n")
    links = read_links(spark, str(tmp_path / "links")).filter("sentence_id IS NOT NULL AND sentence_id < 9")
    assert plan_of(links).count("split(") == 1
    assert sorted(map(tuple, links.collect())) == [(1, 2), (5, None), (6, 7)]
    (tmp_path / "audio").write_text("1\tr1\tpia\tCC0\t\n2\n 3 \tr3\n")
    audio = read_audio_export(spark, str(tmp_path / "audio"))
    assert plan_of(audio).count("from_csv(") == 1
    assert sorted((r["sentence_id"], r["audio_id"], r["license"]) for r in audio.collect()) == [(1, "r1", "CC0"), (3, "r3", None)]


def test_quick_ways_to_strip_and_parse_give_the_same(spark):
    """text without space at its ends, and plain digits, skip the patterns."""
    spaces = [" ", "\t", "\n", " ", "　", "\x1c", "\x00", "\x7f", ""]
    values = [a + core + b for a in spaces for b in spaces for core in ("", "5", "-12", "+7", "007", "1_000", "é", "a b", "9223372036854775808")]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v string")
    pattern = F.regexp_replace("v", "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$", "")
    number = F.when(pattern.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.regexp_replace(pattern, "_", "").try_cast("bigint"))
    assert rows.filter(~strip(F.col("v")).eqNullSafe(pattern) | ~parse_int(F.col("v")).eqNullSafe(number)).collect() == []
