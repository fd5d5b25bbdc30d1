"""Readers, writers, the served store, jobs and streams."""

import shutil

import pytest
from pyspark.sql import functions as F

from sentaria.operators import retrieval as r
from sentaria.plans.jobs import ExtractInputs, extract, load, run
from sentaria.sinks import parquet as p
from sentaria.sinks import store as store_module
from sentaria.sinks.folders import Folders
from sentaria.sinks.store import CorpusStore
from sentaria.sources import datasets as d
from sentaria.sources import exports as e
from sentaria.streaming.index_stream import batch_writer, deduplicated, update_index


def ids(df):
    return sorted(row["sentence_id"] for row in df.collect())


def sentences(spark, *rows):
    return spark.createDataFrame(list(rows), "sentence_id bigint, language string, text string")


# --- exports -------------------------------------------------------------------


def test_read_sentences(spark, tmp_path):
    path = tmp_path / "s.tsv"
    text = "long " * 50_000
    path.write_text(f'21\tnob\tHun sa "hei"\n22\tsme\tBures\n23\t\\N\tnone\n24\tsme\t\n25\tsme\t\\N\n26\tsme\nx\tsme\tno id\n27\tnob\t{text}\textra\n', encoding="utf-8")
    got = {row[0]: row[1:] for row in map(tuple, e.read_sentences(spark, str(path)).collect())}
    assert got == {
        21: ("nob", 'Hun sa "hei"'), 22: ("sme", "Bures"), 23: (None, "none"), 24: ("sme", ""), 25: ("sme", None),
        26: ("sme", None), 27: ("nob", text),
    }
    assert ids(e.read_sentences(spark, str(path), [])) == sorted(got)
    assert ids(e.read_sentences(spark, str(path), ["nob"])) == [21, 27]


def test_read_parquet_export_renames_language(spark, tmp_path):
    df = sentences(spark, (1, "eng", "a"), (2, "fra", "b")).withColumnRenamed("language", "lang")
    df.write.parquet(str(tmp_path / "s"))
    out = e.read_sentences(spark, str(tmp_path / "s"), ["fra"], "parquet")
    assert out.columns == ["sentence_id", "language", "text"] and ids(out) == [2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,fra)" in plan or "In(lang" in plan


def test_detailed_sentences(spark, tmp_path):
    basic, detailed = tmp_path / "basic.tsv", tmp_path / "detailed.tsv"
    basic.write_text("1\teng\ta\n", encoding="utf-8")
    rows = e.read_detailed_sentences(spark, str(detailed), str(basic))
    assert rows.columns == ["sentence_id", "language", "text"] and ids(rows) == [1]
    detailed.write_text(
        "1\teng\ta\tann\t2020-01-01 00:00:00\t\\N\n2\tfra\tb\t\\N\t\\N\t\\N\n", encoding="utf-8"
    )
    row = e.read_detailed_sentences(spark, str(detailed), str(basic), ["eng"]).first()
    assert row["username"] == "ann" and row["date_added"].year == 2020 and row["date_modified"] is None


def test_links_tags_and_quality_ids(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("1\t2\n2\t1\n")
    (tmp_path / "t.tsv").write_text("1\tOK\n1\tOK\n")
    (tmp_path / "q.txt").write_text("1\n 2 \n\nx\n3\n2\n²\n-4\n")
    assert ids(e.read_links(spark, str(tmp_path / "l.tsv"))) == [1, 2]
    assert ids(e.read_tags(spark, str(tmp_path / "t.tsv"))) == [1, 1]
    # A line like the superscript is skipped; it does not end the list.
    assert ids(e.read_quality_ids(spark, str(tmp_path / "q.txt"))) == [1, 2, 3]
    with pytest.warns(UserWarning, match="filters nothing"):
        assert ids(e.read_quality_ids(spark, str(tmp_path / "none.txt"))) == []


# --- datasets ------------------------------------------------------------------


def test_only_written_languages_are_replaced(spark, tmp_path):
    base = str(tmp_path)
    p.save_by_language(sentences(spark, (3, "eng", "c"), (1, "eng", "a"), (2, "fra", "b")), base)
    p.save_by_language(sentences(spark, (9, "fra", "z")), base)
    assert ids(d.read_dataset(spark, base)) == [1, 3, 9]
    assert d.list_languages(spark, base) == ["eng", "fra"]
    assert ids(d.read_language(spark, base, language="fra")) == [9]
    assert ids(d.read_languages(spark, base, ["fra", "deu"])) == [9]


def test_missing_data_is_an_error(spark, tmp_path):
    base = str(tmp_path)
    assert d.list_languages(spark, base) == []
    with pytest.raises(FileNotFoundError):
        d.read_dataset(spark, base)
    p.save_by_language(sentences(spark, (1, "eng", "a")), base)
    with pytest.raises(FileNotFoundError):
        d.read_language(spark, base, language="fra")


def test_missing_language_rows_are_kept(spark, tmp_path):
    p.save_by_language(sentences(spark, (1, None, "a"), (2, "eng", "b")), str(tmp_path))
    assert ids(d.read_dataset(spark, str(tmp_path))) == [1, 2]
    assert d.list_languages(spark, str(tmp_path)) == ["eng"]


def test_empty_frame_keeps_its_type(spark, tmp_path):
    p.save_by_language(sentences(spark), str(tmp_path))
    assert d.read_dataset(spark, str(tmp_path)).count() == 0


def test_undeclared_datasets_align_by_name(spark, tmp_path):
    path = str(tmp_path / "notes")
    spark.createDataFrame([(1, "a")], "sentence_id bigint, x string").write.parquet(path)
    spark.createDataFrame([(2, "b")], "sentence_id bigint, y string").write.mode("append").parquet(path)
    rows = sorted(map(tuple, d.read_dataset(spark, str(tmp_path), "notes").select("sentence_id", "x", "y").collect()))
    assert rows == [(1, "a", None), (2, None, "b")]


def test_a_hot_id_is_spread_over_writers(spark, monkeypatch):
    monkeypatch.setattr(p, "WRITE_PARTITION_BYTES", 80_000)
    hot = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("sentence_id"),
        F.lit(1).cast("bigint").alias("translation_id"),
    )
    parts = p.clustered(hot, "sentence_id").groupBy(F.spark_partition_id().alias("p")).count()
    counts = [row["count"] for row in parts.collect()]
    assert sum(counts) == 40_000 and len(counts) == 4 and max(counts) < 20_000


def test_token_index_layout(spark, tmp_path):
    df = sentences(spark, (2, "eng", "b a"), (1, "eng", "a"), (3, "fra", "c"))
    path = str(tmp_path / "sentence_tokens")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    p.write_token_index(r.token_rows(df), path)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    index = d.read_dataset(spark, str(tmp_path), "sentence_tokens")
    hits = r.match_index(index, ["a"], "eng")
    assert ids(hits) == [1, 2]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(language" in plan
    assert "EqualTo(normalized_token,a)" in plan


def test_compaction(spark, tmp_path):
    base, target = str(tmp_path / "a"), str(tmp_path / "b")
    for i in range(5):
        sentences(spark, (i, "eng", "x")).write.mode("append").partitionBy("language").parquet(f"{base}/sentences")
    out = p.compact_dataset(spark, base, "sentences", target, "language")
    assert ids(out) == [0, 1, 2, 3, 4]
    assert len(out.inputFiles()) < len(d.read_dataset(spark, base).inputFiles())


def test_small_files_become_one_at_any_session_width(spark, tmp_path):
    base, target = str(tmp_path / "a"), str(tmp_path / "b")
    for i in range(6):
        sentences(spark, (i, "eng", "x")).coalesce(1).write.mode("append").parquet(f"{base}/sentences")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        out = p.compact_dataset(spark, base, "sentences", target)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ids(out) == [0, 1, 2, 3, 4, 5] and len(out.inputFiles()) == 1


def test_sql_with_markers(spark, corpus, drawn):
    sql = "SELECT sentence_id FROM sentences WHERE language IN (?, ?) ORDER BY 1 LIMIT ? OFFSET ?"
    rows = d.run_sql(spark, {"sentences": corpus["sentences"]}, sql, ["vol", "ido", 5, 2]).collect()
    assert [row["sentence_id"] for row in rows] == sorted(n for n, lang, _ in drawn["sentences"] if lang in ("vol", "ido"))[2:7]


# --- store ---------------------------------------------------------------------


def contents(tables):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in tables.items()}


@pytest.fixture(scope="module")
def loaded(spark, corpus, tmp_path_factory):
    store = CorpusStore(spark, str(tmp_path_factory.mktemp("loaded")))
    store.load_sentences(corpus["sentences"])
    for table in corpus:
        if table != "sentences":
            store.load(table, corpus[table])
    return store


@pytest.fixture
def store(spark, tmp_path, loaded):
    """A copy of its own for each test: a store holds no path outside its folder."""
    shutil.copytree(loaded.base_dir, tmp_path / "store")
    return CorpusStore(spark, str(tmp_path / "store"))


def test_the_store_holds_what_was_loaded(store, corpus):
    want = contents({**corpus, "sentence_tokens": r.token_rows(corpus["sentences"])})
    assert contents(store.tables()) == want
    found = r.search_vocabulary(store.tables(), "radio", "lat", "epo").nested().collect()
    assert found == r.search_vocabulary(corpus, "radio", "lat", "epo").nested().collect() != []


def test_rebuild_empties_every_table(spark, store):
    before = store.tables()
    rows = contents(before)
    store.load_sentences(sentences(spark, (20, "ido", "Radio sola.")))
    counts = {name: df.count() for name, df in store.tables().items()}
    assert counts.pop("sentences") == 1 and counts.pop("sentence_tokens") == 2
    assert set(counts.values()) == {0}
    # who resolved the tables before reads on
    assert contents(before) == rows
    store.prune()
    assert store.read("sentences").count() == 1
    with pytest.raises(Exception):
        before["sentences"].count()


def test_a_rebuild_that_stops_between_tables_changes_nothing(spark, store):
    rows = contents(store.tables())
    with pytest.raises(KeyboardInterrupt), store.rebuilding() as version:
        version.load_sentences(sentences(spark, (20, "ido", "Radio sola.")))
        version.load("links", spark.createDataFrame([(20, 20)], "sentence_id bigint, translation_id bigint"))
        raise KeyboardInterrupt
    assert contents(store.tables()) == rows
    failing = sentences(spark, (3, "eng", "Three.")).withColumn("text", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        store.load_sentences(failing)
    assert contents(store.tables()) == rows


def test_rebuild_from_own_rows(spark, store):
    kept = store.read("sentences").filter("language = 'epo'")
    want = sorted(map(tuple, kept.collect()))
    store.load_sentences(kept)
    assert want and sorted(map(tuple, store.read("sentences").collect())) == want


def test_appends_refuse_keys(spark, store, drawn):
    held = drawn["sentences"][0]
    new = [(1000, "ido", "nova radio"), (1001, "ido", "b"), (1001, "ido", "a"), (1001, "vol", "a"), (None, "ido", "no id"), (held[0], "ido", "taken")]
    before = contents(store.tables())
    refused = store.load_sentences(sentences(spark, *new), rebuild=False)
    assert sorted(map(tuple, refused.collect()), key=str) == sorted(
        [(1001, False, 2), (None, False, 1), (held[0], True, 1)], key=str
    )
    after = contents(store.tables())
    added = [row[:3] for row in after["sentences"] if row not in before["sentences"]]
    assert added == [(1000, "ido", "nova radio"), (1001, "ido", "a")]
    tokens = {row[0] for row in after["sentence_tokens"] if row not in before["sentence_tokens"]}
    assert tokens == {1000, 1001} and after["links"] == before["links"]
    assert 1000 in ids(r.search_vocabulary(store.tables(), "radio", limit=1000).sentences)
    audio = spark.createDataFrame([("rec000", 1000), ("fresh", 1000)], "audio_id string, sentence_id bigint")
    assert [tuple(x) for x in store.load("sentence_audio", audio).collect()] == [("tatoeba", "rec000", True, 1)]
    assert store.read("sentence_audio").count() == len(drawn["sentence_audio"]) + 1
    # links have no key
    assert store.load("links", store.read("links")) is None
    assert store.read("links").count() == 2 * len(drawn["links"])


def test_a_key_check_reads_only_what_may_hold_the_keys(spark, tmp_path):
    from sentaria.sinks.keyed import in_ranges, value_ranges
    from test_retrieval import scanned_rows

    store = CorpusStore(spark, str(tmp_path / "keys"))
    for start in (0, 50_000):
        rows = spark.range(start, start + 50_000).select(F.col("id").alias("sentence_id"), F.lit("en").alias("language"), F.lit("x").alias("text"))
        store.load_sentences(rows, rebuild=False)
    near = store.read("sentences").filter(in_ranges("sentence_id", value_ranges(spark.range(50_100, 50_200))))
    assert scanned_rows(near) <= 50_000
    few = store.read("sentences").filter(in_ranges("sentence_id", [(200_000, 200_000)]))
    assert scanned_rows(few) == 0


def test_store_compaction(spark, store, tmp_path, drawn):
    for k in range(4):
        store.load_sentences(sentences(spark, (2000 + k, "ido", f"nova {k}")), rebuild=False)
    rows = contents(store.tables())
    files = len(store.read("sentences").inputFiles())
    copy = store.compact(str(tmp_path / "copy"))
    assert contents(copy.tables()) == rows
    store.compact()
    assert contents(store.tables()) == rows
    assert len(store.read("sentences").inputFiles()) < files


# --- jobs ----------------------------------------------------------------------


@pytest.fixture
def inputs(tmp_path):
    files = {
        "sentences": "1\teng\tLate train\n2\teng\tWrong train\n3\tfra\tTrain\n4\tdeu\tZug\n",
        "links": "1\t3\n3\t1\n1\t2\n1\t4\n1\t99\n",
        "tags": "1\tOK\n2\tOK\n4\tOK\n",
        "quality": "1\n3\n4\n",
        "audio": "1\t11\tann\tCC0\t\n2\t12\tbob\tCC0\t\n4\t14\teve\tCC0\t\n",
    }
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    at = lambda name: str(folder / name)
    return ExtractInputs(at("sentences"), at("links"), at("tags"), at("audio"), at("quality"))


def pairs(df):
    return sorted((x["sentence_id"], x["translation_id"]) for x in df.collect())


def test_run_extracts_and_loads(spark, tmp_path, inputs):
    out, served = str(tmp_path / "out"), str(tmp_path / "served")
    store = run(spark, inputs, out, served, ["eng", "fra"])
    # Extraction: languages restrict sentences and audio, the list restricts everything.
    assert ids(d.read_dataset(spark, out)) == [1, 3]
    assert pairs(d.read_dataset(spark, out, "links")) == [(1, 3), (1, 4), (3, 1)]
    assert ids(d.read_dataset(spark, out, "tags")) == [1, 4]
    assert ids(d.read_dataset(spark, out, "sentence_audio")) == [1]
    # Loading: children follow the loaded sentences.
    assert ids(store.read("sentences")) == [1, 3]
    assert pairs(store.read("links")) == [(1, 3), (3, 1)]
    assert ids(store.read("tags")) == [1]
    assert store.read("sentence_tokens").count() == 3
    assert store.read("grammar_patterns").count() == 0


def test_load_one_language(spark, tmp_path, inputs):
    out, served = str(tmp_path / "out"), str(tmp_path / "served")
    extract(spark, inputs, out)
    store = load(spark, out, served, ["eng", "xxx"])
    assert ids(store.read("sentences")) == [1] and pairs(store.read("links")) == []


def test_load_without_sentences_changes_nothing(spark, tmp_path, inputs):
    out, served = str(tmp_path / "out"), str(tmp_path / "served")
    extract(spark, inputs, out)
    load(spark, out, served)
    store = load(spark, out, served, ["xxx"])
    assert ids(store.read("sentences")) == [1, 3, 4]


def test_optional_inputs_may_be_absent(spark, tmp_path, inputs):
    store = run(spark, ExtractInputs(inputs.sentences), str(tmp_path / "out"), str(tmp_path / "served"))
    assert ids(store.read("sentences")) == [1, 2, 3, 4] and store.read("links").count() == 0


# --- streams -------------------------------------------------------------------


def token_set(df):
    names = ["sentence_id", "language", "token", "normalized_token", "position"]
    return sorted(map(tuple, df.select(*names).collect()))


def test_stream_equals_batch(spark, tmp_path):
    first = sentences(spark, (1, "nob", "God Morgen"), (2, "sme", "Bures"))
    second = sentences(spark, (3, "deu", "Große morgen"))
    source, base, marks = (str(tmp_path / name) for name in ("in", "store", "marks"))
    store = CorpusStore(spark, base)
    first.write.parquet(source)
    update_index(spark, source, base, marks)
    second.write.mode("append").parquet(source)
    update_index(spark, source, base, marks)
    update_index(spark, source, base, marks)  # nothing new arrives
    assert ids(store.read("sentences")) == [1, 2, 3]
    streamed = store.read("sentence_tokens")
    assert token_set(streamed) == token_set(r.token_rows(first.union(second)))
    assert ids(r.match_index(streamed, ["morgen"])) == [1, 3]


@pytest.mark.parametrize("stream_first", [True, False])
def test_streams_and_batch_loads_share_a_store(spark, tmp_path, stream_first):
    source, base, marks = (str(tmp_path / name) for name in ("in", "store", "marks"))
    streamed = sentences(spark, (1, "eng", "cold tea"), (2, None, "tea"), (3, "fra", ""))
    loaded = sentences(spark, (4, "eng", "hot tea"), (5, "deu", "Tee"))
    streamed.write.parquet(source)
    store = CorpusStore(spark, base)
    steps = [lambda: update_index(spark, source, base, marks), lambda: store.load_sentences(loaded, rebuild=False)]
    for step in steps if stream_first else reversed(steps):
        step()
    assert ids(store.read("sentences")) == [1, 2, 3, 4, 5]
    want = r.token_rows(streamed.union(loaded).filter("language IS NOT NULL"))
    got = store.read("sentence_tokens")
    assert token_set(got.filter("language IS NOT NULL")) == token_set(want)
    assert ids(got.filter("language IS NULL")) == [2]


def test_a_batch_that_comes_again_takes_its_own_place(spark, tmp_path):
    """Repeated and null ids, some of them in earlier loads: the end is as if nothing had been interrupted."""
    first = [(1, "eng", "a b"), (2, "eng", "c"), (None, "eng", "d")]
    again = [(1, "eng", "x"), (1, "eng", "x"), (None, "fra", "y z"), (3, "eng", "w")]
    undisturbed = batch_writer(str(tmp_path / "one"), str(tmp_path / "one-marks"))
    for k, rows in enumerate((first, again)):
        undisturbed(sentences(spark, *rows), k)
    write = batch_writer(str(tmp_path / "two"), str(tmp_path / "two-marks"))
    write(sentences(spark, *first), 0)
    write(sentences(spark, *again[:2]), 1)  # as if it had stopped after a part of its rows
    for _ in range(2):
        write(sentences(spark, *again), 1)
    want, got = (CorpusStore(spark, str(tmp_path / name)).tables() for name in ("one", "two"))
    assert contents(got) == contents(want) and want["sentences"].count() == 7
    # without its checkpoints a stream starts anew
    batch_writer(str(tmp_path / "two"), str(tmp_path / "new-marks"))(sentences(spark, (9, "eng", "q")), 1)
    assert CorpusStore(spark, str(tmp_path / "two")).read("sentences").count() == 8


def test_many_small_batches_leave_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "MERGE_LOADS", 3)
    base = str(tmp_path / "store")
    write = batch_writer(base, str(tmp_path / "marks"))
    rows = [[(k, lang, f"{lang} word{k}") for lang in ("nob", "sme")] for k in range(9)]
    for k, batch in enumerate(rows):
        write(sentences(spark, *batch), k)
        if k % 4 == 0:
            write(sentences(spark, *batch), k)  # comes again
    version = CorpusStore(spark, base).current()
    for table in ("sentences", "sentence_tokens"):
        # two loads of a size may wait for a third, beside the newest one
        assert len(version.loads(table)) <= 4
        assert len(version.read(table).inputFiles()) <= 8
    every = sentences(spark, *[row for batch in rows for row in batch])
    assert token_set(version.read("sentence_tokens")) == token_set(r.token_rows(every))
    assert ids(version.read("sentences")) == sorted(k for k in range(9) for _ in range(2))


def test_a_merge_that_stops_shows_nothing_twice(spark, tmp_path, monkeypatch):
    store = CorpusStore(spark, str(tmp_path / "store"))
    link = lambda k: spark.createDataFrame([(k, k)], "sentence_id bigint, translation_id bigint")
    for k in range(3):
        store.load("links", link(k))
    monkeypatch.setattr(store_module, "MERGE_LOADS", 3)
    replace = Folders.replace_text

    def stop(self, path, content):
        if path.endswith("_merges"):
            raise KeyboardInterrupt
        replace(self, path, content)

    monkeypatch.setattr(Folders, "replace_text", stop)
    with pytest.raises(KeyboardInterrupt):
        store.load("links", link(3))
    assert ids(store.read("links")) == [0, 1, 2, 3]
    monkeypatch.setattr(Folders, "replace_text", replace)
    before = store.read("links")
    store.load("links", link(4))
    assert ids(store.read("links")) == [0, 1, 2, 3, 4] and ids(before) == [0, 1, 2, 3]
    assert len(store.current().loads("links")) == 2


def test_stream_can_drop_repeated_ids(spark, tmp_path):
    source, base, marks = (str(tmp_path / name) for name in ("in", "store", "marks"))
    options = {"distinct_ids": True}
    sentences(spark, (1, "eng", "a"), (2, "eng", "b"), (2, "eng", "b")).write.parquet(source)
    update_index(spark, source, base, marks, **options)
    sentences(spark, (2, "eng", "b again"), (3, "eng", "c")).write.mode("append").parquet(source)
    update_index(spark, source, base, marks, **options)
    assert ids(CorpusStore(spark, base).read("sentences")) == [1, 2, 3]


def test_distinct_streams_keep_no_state(spark, tmp_path):
    """Batches with repeats of old ids: every id once, no state store, replay changes nothing."""
    source, base, marks = (str(tmp_path / name) for name in ("in", "store", "marks"))
    write = batch_writer(base, marks, distinct_ids=True)
    for k in range(4):
        batch = sentences(spark, (k, "eng", f"new {k}"), (k // 2, "eng", f"again {k}"), (None, "eng", "no id"))
        for _ in range(1 + k % 2):
            write(batch, k)
    rows = sorted(map(tuple, CorpusStore(spark, base).read("sentences").select("sentence_id", "text").collect()))
    assert rows == [(0, "again 0"), *[(k, f"new {k}") for k in range(1, 4)]]
    sentences(spark, (1, "eng", "a")).write.parquet(source)
    update_index(spark, source, base, marks, distinct_ids=True)
    assert not (tmp_path / "marks" / "sentences" / "state").exists()


def test_deduplication_with_event_time_has_a_watermark(spark, tmp_path):
    spark.sql("select 1L as sentence_id, timestamp'2024-01-01' as t").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("sentence_id bigint, t timestamp").parquet(str(tmp_path / "in"))
    plan = deduplicated(stream, "t", "2 hours")._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan and "DeduplicateWithinWatermark" in plan


def test_an_index_is_sorted_in_small_shares_and_keeps_every_form_of_a_token(spark, tmp_path, monkeypatch):
    from sentaria.sinks import parquet

    rows = [(k, "la", form, "ordo" if k % 3 else None, k) for k in range(3000) for form in ("ordo", "Ordo", None)]
    rows += [(k, "la", f"w{k}", f"w{k}", 0) for k in range(20_000)]
    tokens = spark.createDataFrame(rows, "sentence_id bigint, language string, token string, normalized_token string, position int")
    path = str(tmp_path / "index")
    monkeypatch.setattr(parquet, "INDEX_PARTITION_BYTES", 8 << 10)
    parquet.write_token_index(tokens, path)
    found = spark.read.parquet(path).select(tokens.columns)
    assert found.exceptAll(tokens).isEmpty() and tokens.exceptAll(found).isEmpty()
    assert len(found.inputFiles()) > 8


def test_new_rows_of_a_load_that_repeats_keys_are_judged_once(spark):
    from sentaria.sinks.keyed import split_by_key

    rows = [(1, "la", "b"), (1, "la", "a"), (2, "la", "c"), (None, "la", "d")]
    new, refused = split_by_key(spark.createDataFrame(rows, "sentence_id bigint, language string, text string"), None, "sentences")
    assert "Join" not in str(new._jdf.queryExecution().optimizedPlan())
    assert sorted(map(tuple, new.collect())) == [(1, "la", "a"), (2, "la", "c")]
    assert {(r["sentence_id"], r["n_rows"]) for r in refused.collect()} == {(1, 1), (None, 1)}


def test_token_counts_are_joined_to_digests_not_to_texts(spark, tmp_path):
    from sentaria.plans.registered import _with_token_counts
    from sentaria.sinks.store import CorpusStore

    store = CorpusStore(spark, str(tmp_path / "counted"))
    store.load_sentences(spark.createDataFrame([(1, "la", "ordo et ordo"), (2, "la", "")], "sentence_id bigint, language string, text string"))
    counted = _with_token_counts(store)
    plan = str(counted._jdf.queryExecution().optimizedPlan())
    assert plan.index("Join") < plan.index("md5(")
    assert {(r["sentence_id"], r["n_tokens"]) for r in counted.collect()} == {(1, 3), (2, 0)}


def test_a_distinct_stream_leaves_and_shuffles_no_copies_of_texts(spark, tmp_path, monkeypatch):
    """arrivals are read where they are, and a load's shuffles and intermediate texts are gone after it."""
    from sentaria.plans import sizing

    text = lambda k: " ".join(f"{word}{k}" for word in ("ordo", "tempus", "locus") * 30)
    source, base, marks, scratch = (str(tmp_path / name) for name in ("in", "store", "marks", "scratch"))
    monkeypatch.setattr(sizing, "scratch_root", lambda _: scratch)
    for _ in range(2):
        sentences(spark, *[(k, "la", text(k)) for k in range(2000)]).write.mode("append").parquet(source)
    update_index(spark, source, base, marks, distinct_ids=True)
    held = CorpusStore(spark, base).read("sentences")
    assert sorted(map(tuple, held.select("sentence_id", "text").collect())) == [(k, text(k)) for k in range(2000)]
    left = [spark.read.parquet(str(p)).columns for p in (tmp_path / "scratch").iterdir()]
    assert left and all("text" not in columns and "_brief" not in columns for columns in left)


def test_the_least_of_repeated_rows_is_taken_whatever_differs(spark, monkeypatch):
    """rows that tie in short values are compared whole; the least is what a grouping of whole rows finds."""
    import random

    from sentaria.sinks import keyed

    draw = random.Random(5)
    texts = ["", "a", "abcd", "abcde", "abcdf", "abcdeé", "abcd" * 9, "abcd" * 9 + "z", "abcé", "ab\x00cdx", None]
    rows = [(draw.choice([*range(40), None]), draw.choice(["la", "lat", "latina", "latino", None]), draw.choice(texts), draw.choice(["ines", None, "inesita", "inesito"])) for _ in range(600)]
    rows += [(50, "la", "abcdx", "z"), (50, "la", "abcdy", "a"), (51, "la", "abcd", "b"), (51, "la", "abcdx", "a")]
    df = spark.createDataFrame(rows, "sentence_id bigint, language string, text string, username string").repartition(3)
    held = spark.createDataFrame([(k,) for k in range(5)], "sentence_id bigint")
    monkeypatch.setattr(keyed, "BRIEF_CHARS", 4)
    order = lambda row: [(value is not None, (value or "").encode()) for value in row[1:]]
    want = {}
    for row in (r for r in rows if r[0] is not None and r[0] >= 5):
        want[row[0]] = min(row, want.get(row[0], row), key=order)
    new, refused = keyed.split_by_key(df, held, "sentences")
    assert sorted(map(tuple, new.collect())) == sorted(want.values())
    counts = {}
    for row in rows:
        counts[row[0]] = counts.get(row[0], 0) + 1
    lost = {k: n if k is None or k < 5 else n - 1 for k, n in counts.items()}
    assert {r["sentence_id"]: r["n_rows"] for r in refused.collect()} == {k: n for k, n in lost.items() if n}
    monkeypatch.setattr(keyed, "SENT_MARKS", 0)
    again, _ = keyed.split_by_key(df, held, "sentences")
    assert sorted(map(tuple, again.collect())) == sorted(want.values())


def test_a_load_is_indexed_in_shares(spark, tmp_path, monkeypatch):
    """every share of a load's files is indexed once, and its shuffles are deleted before the next."""
    monkeypatch.setattr(store_module, "SHARE_BYTES", 2000)
    rows = [(k, [None, "", "la", "de/x"][k % 4], f"Ordo ordo{k} et É{k * 7919 % 1000}") for k in range(400)]
    every = sentences(spark, *rows)
    store, calls = CorpusStore(spark, str(tmp_path / "store")), []
    write = store_module.write_token_index

    def counted(tokens, path, **options):
        calls.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        write(tokens, path, **options)

    monkeypatch.setattr(store_module, "write_token_index", counted)
    store.load_sentences(every)
    assert 2 < len(calls) <= store_module.INDEX_SHARES and set(calls) == {"false"}
    want = r.token_rows(sentences(spark, *[(k, lang or None, text) for k, lang, text in rows]))
    assert token_set(store.read("sentence_tokens").fillna("-", ["language"])) == token_set(want.fillna("-", ["language"]))
    store.load_sentences(every.filter("sentence_id < 0"))
    assert store.read("sentence_tokens").count() == 0
