"""Probing moves, exact ranking at large norms, and the pipeline's stages on awkward tables."""

import itertools

import numpy as np
import pytest

import corpus_pipeline
from sentaria.llm import decontaminate, line_dedup, mil_quality, multiprobe, packing, simhash
from sentaria.llm.common import free_name, wide_key


@pytest.mark.parametrize("functions, most", [(1, 3), (2, 9), (5, 16), (5, 243), (6, 36)])
def test_moves_come_in_the_order_of_their_cost(functions, most):
    rng = np.random.default_rng(functions)
    every = np.array(list(itertools.product((-1, 0, 1), repeat=functions)))
    for _ in range(20):
        x = rng.random(functions)
        cost = np.stack([x * x, np.zeros(functions), (1 - x) ** 2], 1)
        total = lambda moves: sum(cost[k][moves[:, k] + 1] for k in range(functions))
        got = multiprobe.cheapest_moves(x, most)
        assert len({tuple(row) for row in got}) == len(got) == most
        assert np.allclose(total(got), np.sort(total(every))[:most])


def test_ties_of_long_vectors_are_kept():
    rng = np.random.default_rng(3)
    q = rng.normal(size=(1, 16)) * 1e6
    rows = rng.normal(size=(400, 16)) * 1e6
    rows -= (rows @ q[0])[:, None] * q[0] / (q[0] @ q[0])  # all but orthogonal
    rows = np.concatenate([rows, rows[::-1]])
    ids = np.arange(100, 900)
    _, found, scores = multiprobe.exact_top(q, np.array([1]), rows, ids, 20)
    exact = np.multiply(q, rows).sum(axis=1)
    want = sorted(range(800), key=lambda i: (-exact[i], ids[i]))[:20]
    assert found.tolist() == ids[want].tolist() and (scores == exact[want]).all()


# --- stages --------------------------------------------------------------------

#: Columns named like internal ones.
ODD_COLUMNS = ["_row", "_gone", "_dirty", "_score_of", "score", "_place", "_repeated", "line", "a.b", "Text2"]
PASSAGE = "the river ran past nine old mills and quiet fields where people met to talk of weather and bread"
OTHER = "a lantern hung above every second door while traders carried heavy sacks over the narrow wooden bridge at noon"


def rows():
    texts = [
        (1, "one line here\nthe second line of a longer text\n" + OTHER), (None, "alone in the world with no id\nanother line that is its own"),
        (None, f"a text with no id holds {PASSAGE} in it"), (7, "clean text of seven that stays as it is, thank you"), (7, f"{PASSAGE} of seven"),
        (8, "the second line of a longer text\nnew words in eight"), (None, None), (9, ""), (10, OTHER + "\nand more"), (10, OTHER + "\nand more"),
        (11, "word " * 3000 + "\nlast line of eleven"), (None, "alone in the world with no id\nanother line that is its own"),
    ]
    return [(doc_id, text, *(f"{name}-{k}" for name in ODD_COLUMNS)) for k, (doc_id, text) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    names = ", ".join(f"`{c}` string" for c in ODD_COLUMNS)
    return spark.createDataFrame(rows(), f"doc_id bigint, text string, {names}")


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lines_of_a_row_go_for_its_own_sake(docs):
    got = line_dedup.drop_repeated(docs, least=1, near=20)
    assert got.columns == docs.columns
    first, want = {}, []
    order = sorted(rows(), key=lambda r: (r[0] is None, r[0] or 0))
    for row in order:  # rows equal in id and text are one document
        for k, line in enumerate((row[1] or "").split("\n")):
            first.setdefault(line, (row[0], row[1], k))
    for row in rows():
        lines = None if row[1] is None else row[1].split("\n")
        kept = lines and [x for k, x in enumerate(lines) if not x or first[x] == (row[0], row[1], k)]
        want.append((row[0], None if lines is None else "\n".join(kept), *row[2:]))
    assert as_rows(got) == sorted(want, key=str)


def test_only_dirty_rows_go(spark, docs):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    got = decontaminate.clean_documents(docs, items)
    assert got.columns == docs.columns
    assert as_rows(got) == sorted((r for r in rows() if PASSAGE not in (r[1] or "")), key=str)
    assert as_rows(decontaminate.clean_documents(docs, items.limit(0))) == sorted(rows(), key=str)
    assert as_rows(decontaminate.clean_documents(docs.limit(0), items)) == []


def test_one_row_of_each_group_stays(docs):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    prints = {}
    for row in rows():
        prints.setdefault(simhash.fingerprint(row[1]), []).append(row)
    seen = as_rows(got)
    assert set(seen) <= set(rows())
    for value, group in prints.items():
        near = [r for v, g in prints.items() if (v ^ value).bit_count() <= 4 for r in g]
        kept = [r for r in near if r in seen]
        least = min((r[0] for r in near if r[0] is not None), default=None)
        assert len(kept) == 1 and kept[0][0] == least


def test_scores_make_room_for_their_own_column(spark, docs):
    labels = spark.createDataFrame([(1, 1), (8, 0), (10, 1), (10, 0), (11, None)], "doc_id bigint, quality int")
    model = mil_quality.train(docs, labels)
    scored = mil_quality.score_documents(docs, model)
    assert [c for c in scored.columns if c != "score"] == [c for c in docs.columns if c != "score"]
    assert scored.count() == len(rows())
    kept = mil_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and set(as_rows(kept)) <= set(rows())
    assert mil_quality.keep_good(docs.limit(0), labels).count() == 0
    assert mil_quality.keep_good(docs, labels.limit(0)).count() == len(rows())  # without labels all score a half


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(0)
    w = {
        "enc": rng.normal(size=(mil_quality.FEATURES, 5)), "enc_b": rng.normal(size=5), "tanh": rng.normal(size=(5, 3)),
        "gate": rng.normal(size=(5, 3)), "att": rng.normal(size=3), "out": rng.normal(size=5), "out_b": rng.normal(size=1),
    }
    x, owner = rng.normal(size=(9, mil_quality.FEATURES)), np.repeat([0, 1, 2], [2, 4, 3])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss(w):
        p, _ = mil_quality._forward(w, x, owner, 3)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    for name, slope in mil_quality._gradients(w, x, owner, y, weight).items():
        for at in [tuple(rng.integers(0, n) for n in w[name].shape) for _ in range(4)]:
            high, low = ({**w, name: w[name].copy()} for _ in range(2))
            high[name][at] += 1e-5
            low[name][at] -= 1e-5
            assert np.isclose((loss(high) - loss(low)) / 2e-5, slope[at], atol=1e-6)


def test_pipeline_end_to_end(spark, tmp_path):
    """Each stage against a plain computation on what the one before kept, over a table of its own."""
    rng = np.random.default_rng(5)
    words = PASSAGE.split() + OTHER.split()
    prose = lambda: "\n".join(" ".join(rng.choice(words, 12)) + "." for _ in range(6))
    junk = lambda: " ".join("".join(rng.choice(list("0123456789#$%&{}|"), 7)) for _ in range(80))
    texts = [(i, prose() if i % 3 else junk()) for i in range(240)]
    texts += [(300 + i, texts[3 * i + 1][1]) for i in range(10)]
    texts += [(400, f"{prose()}\n{PASSAGE}"), (None, prose()), (None, f"{PASSAGE} again")]
    base = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)], "doc_id bigint, quality int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    good = stage["quality"](spark, docs, base)
    kept = {(r.doc_id, r.text) for r in good.collect()}
    assert all((i, t) in kept for i, t in texts if i is None or i % 3 or i >= 300) and not any((i, t) in kept for i, t in texts[:240:3])
    lines = stage["lines"](spark, good, base)
    first = {}
    for i, t in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate(t.split("\n")):
            first.setdefault(line, (i, k))
    want = {(i, "\n".join(x for k, x in enumerate(t.split("\n")) if first[x] == (i, k))) for i, t in kept if i is not None}
    assert {(r.doc_id, r.text) for r in lines.collect() if r.doc_id is not None} == want
    one = stage["near_duplicates"](spark, lines, base)
    left = {(r.doc_id, r.text) for r in one.collect()}
    assert not {i for i, _ in left} & set(range(301, 310))  # their lines are gone, and of empty texts the first stays
    clean = stage["decontamination"](spark, one, base)
    assert {(r.doc_id, r.text) for r in clean.collect()} == {(i, t) for i, t in left if PASSAGE not in t}
    pieces = stage["packing"](spark, clean, base).collect()
    assert sum(p.length for p in pieces) == sum(len(packing.token_ids(t)) + 1 for _, t in left if PASSAGE not in t)
    assert sorted(map(tuple, corpus_pipeline.run(spark, base).collect()), key=str) == sorted(map(tuple, pieces), key=str)


def test_names_and_keys(spark):
    assert free_name(["_ROW", "__row", "x"], "_row") == "___row" and free_name([], "_row") == "_row"
    df = spark.createDataFrame([(1, None), (None, "1"), (1, ""), (None, None), (1, "a"), (1, "a")], "i bigint, t string")
    assert df.select(wide_key("i", "t").alias("k")).distinct().count() == 5
