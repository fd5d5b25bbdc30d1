import pytest
from pyspark.sql import functions as F

from sentaria.plans import sizing


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(10_000, numPartitions=1).withColumn("x", F.md5(F.col("id").cast("string"))).write.parquet(path)
    return spark.read.parquet(path)


def test_input_bytes_sums_the_leaves(stored):
    size = sizing.input_bytes(stored)
    assert size > 100_000
    # A join's own estimate multiplies; the leaves add.
    assert sizing.input_bytes(stored.join(stored.select("id"), "id")) <= 2 * size


def test_width_follows_the_input(stored, monkeypatch):
    assert sizing.shuffle_width(stored) == 4
    monkeypatch.setattr(sizing, "TARGET_PARTITION_BYTES", 10_000)
    assert sizing.shuffle_width(stored) > 10
    monkeypatch.setattr(sizing, "MAX_SHUFFLE_WIDTH", 9)
    assert sizing.shuffle_width(stored) == 9


def test_only_small_inputs_are_spread(spark, stored):
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert shuffles(sizing.spread(stored, "id")) == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert shuffles(sizing.spread(stored, "id")) == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_settings_are_put_back(spark, stored):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(name, None) is None
    with pytest.raises(ValueError), sizing.sized_shuffles(stored):
        assert spark.conf.get(name) == "4"
        raise ValueError
    assert spark.conf.get(name, None) is None


def test_written_cuts_the_plan(spark, stored):
    df = sizing.written(stored.filter("id < 5"), "few")
    assert df.count() == 5 and df.schema == stored.schema
    assert f"{sizing.scratch_root(spark)}/few-" in df.inputFiles()[0]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        sizing.scratch_root(Session())


def test_rows_are_dealt_to_as_many_tasks_as_their_memory_needs(spark, stored, monkeypatch):
    rows, column = stored, "id"
    cores = spark.sparkContext.defaultParallelism
    assert sizing.dealt(rows, column).rdd.getNumPartitions() == cores
    monkeypatch.setattr(sizing, "TASK_BYTES", max(1, sizing.input_bytes(rows) // 20))
    assert 20 <= sizing.dealt(rows, column).rdd.getNumPartitions() <= 22
    assert 100 <= sizing.dealt(rows, column, growth=5.0).rdd.getNumPartitions() <= 110
    assert sorted(map(tuple, sizing.dealt(rows, column).collect())) == sorted(map(tuple, rows.collect()))


def test_a_summary_of_the_index_groups_in_as_many_tasks_as_its_memory_needs(spark, tmp_path, monkeypatch):
    from sentaria.operators.retrieval import token_rows
    from sentaria.plans import registered

    rows = [(k, "la", f"Ordo {k % 7} et ordo") for k in range(50)]
    path = str(tmp_path / "sentences")
    spark.createDataFrame(rows, "sentence_id bigint, language string, text string").write.parquet(path)
    sentences = spark.read.parquet(path)
    token_rows(sentences).write.parquet(f"{path}-index")
    tokens = spark.read.parquet(f"{path}-index")
    monkeypatch.setattr(sizing, "TASK_BYTES", max(1, int(sizing.input_bytes(tokens) * registered.TOKEN_GROWTH) // 30))
    summary = registered._stored_summary(tokens)
    assert "RepartitionByExpression [language" in summary._jdf.queryExecution().optimizedPlan().toString()
    direct = registered._index_summary(token_rows(sentences, grouped=True))
    assert token_rows(sentences, grouped=True).rdd.getNumPartitions() >= 10 > token_rows(sentences).rdd.getNumPartitions()
    for found in (summary, direct):
        assert {r["normalized_token"]: (r["n_tokens"], r["n_sentences"]) for r in found.collect()}["ordo"] == (100, 50)
