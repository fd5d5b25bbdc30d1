"""Neighbour search, decontamination and line links against brute force and on odd rows."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from sentaria.llm import decontaminate, line_dedup, multiprobe

# --- neighbours ----------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, bucket string"


def brute(rows, queries, k):
    best = {}
    for q, qv in queries:
        for i, v in rows:
            if i != q and len(v) == len(qv):
                s = float(np.dot(np.asarray(qv, float), np.asarray(v, float)))
                best[q, i] = max(best.get((q, i), -np.inf), s)
    out = {}
    for (q, i), s in best.items():
        out.setdefault(q, []).append((-s, i))
    return {q: sorted(x)[:k] for q, x in out.items()}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # one vector many times
    return rows


@pytest.mark.parametrize("split", [8192, 40])
def test_recall_order_and_scores(spark, monkeypatch, clustered, split):
    monkeypatch.setattr(multiprobe, "SPLIT_ROWS", split)
    df = spark.createDataFrame([(i, v, "b") for i, v in clustered], VECTORS)
    queries = [(i, v) for i, v in clustered if i % 20 == 0]
    got = {}
    for r in multiprobe.neighbours(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, {})[r.rank] = (-r.score, r.vec_id)
    want = brute(clustered, queries, 20)
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        mine = [got[q][k] for k in range(1, 21)]
        assert [(round(a, 9), i) for a, i in mine] == sorted((round(a, 9), i) for a, i in mine)
        hits += len({i for _, i in mine} & {i for _, i in best})
    assert hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("norms, n, dims", [("log-normal", 20_000, 64), ("outlier", 20_000, 64), ("log-normal", 70_000, 16)])
def test_recall_with_uneven_norms(spark, tmp_path, norms, n, dims):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if norms == "outlier":
        x[0] *= 10
    else:
        x *= np.exp(0.3 * rng.normal(size=n))[:, None]
    path = str(tmp_path / "vectors.parquet")
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(x))}), path, row_group_size=10_000)
    df = spark.read.parquet(path)
    asked = np.arange(1, n, n // 50)
    got = {}
    for r in multiprobe.neighbours(df, df.filter(f"vec_id % {n // 50} = 1")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    hits = sum(len(got[int(q)] & set(b.tolist())) for q, b in zip(asked, best))
    assert all(len(got[int(q)]) == 20 for q in asked)
    assert hits >= 0.9 * 20 * len(asked)


def test_few_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 3.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (10, []),
        (20, [2.0, 2.0]), (20, [2.0, 2.0]), (20, [4.0, 0.0]), (40, [0.0, 0.0]), (60, [1.0, 1.0, 1.0]),
    ]
    df = spark.createDataFrame([(i, v, "b") for i, v in rows], VECTORS)
    got = {}
    for r in multiprobe.neighbours(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 20, 60]
    assert sorted(got[0]) == [(1, 20, 4.0), (2, 3, 1.0), (3, 1, 0.5), (4, 2, -1.0)]
    assert sorted(got[20]) == [(1, 0, 4.0), (2, 2, 4.0), (3, 3, 4.0), (4, 1, 2.0)]
    assert got[60] == [(1, 9, 6.0)]
    empty = spark.createDataFrame([], VECTORS)
    assert multiprobe.neighbours(empty, empty).collect() == []


# --- decontamination -----------------------------------------------------------


def test_masks_hit_every_window_with_two_substitutions():
    for gone in itertools.combinations(range(decontaminate.WINDOW), 2):
        hit = any(
            all(at + p not in gone for p in mask)
            for mask in decontaminate.MASKS
            for at in range(decontaminate.WINDOW - mask[-1])
        )
        assert hit, gone


def _overlap(doc, item, window=13, share=0.8):
    """Best agreeing count over all ways to lay the item on the document."""
    width, best = min(window, len(item)), 0
    for shift in range(-len(item), len(doc)):
        same = [0 <= shift + i < len(doc) and doc[shift + i] == item[i] for i in range(len(item))]
        best = max(best, *(sum(same[s : s + width]) for s in range(len(item) - width + 1)))
    return best if best >= share * width else None


def test_overlaps_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("the of a and in it".split()) if rng.random() < 0.4 else "".join(rng.choices("bcdfgaeiou", k=6))
    prose = lambda n: [word() for _ in range(n)]
    items = [prose(n) for n in (14, 20, 33, 59, 8, 13)] + [["short", "item"]]
    docs = []
    for i in range(60):
        body = prose(rng.randrange(5, 80))
        if i % 3 == 0:
            item = list(items[rng.randrange(6)])
            for p in rng.sample(range(len(item)), rng.randrange(0, 5)):
                item[p] = "changed"
            part = item[rng.randrange(0, 4) :]
            at = rng.randrange(len(body))
            body[at:at] = part
        docs.append(body)
    cased = lambda words: ", ".join(w.title() for w in words) + ".\n"
    rows = [(i, cased(d), "t") for i, d in enumerate(docs)] + [(900, None, "t"), (901, "", "t"), (0, cased(docs[0]), "t")]
    rows += [(None, cased(items[2]), "t"), (902, "x " * 3000 + " ".join(items[1]), "t")]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, toks string")
    bench = spark.createDataFrame(
        [(i, " ".join(t), "t") for i, t in enumerate(items)] + [(50, None, "t"), (51, "", "t"), (None, " ".join(items[0]), "t")],
        "item_id bigint, text string, at string",
    )
    got = {(r.doc_id, r.item_id): r.agreeing for r in decontaminate.overlaps(given, bench).collect()}
    want = {}
    for doc_id, text, _ in rows:
        words = (text or "").lower().replace(",", " ").replace(".", " ").split()
        for item_id, item in [*enumerate(items), (None, items[0])]:
            if len(item) >= 8 and (best := _overlap(words, item)) is not None:
                want[doc_id, item_id] = best
    long_enough = {k: v for k, v in want.items() if k[1] is None or len(items[k[1]]) >= 13}
    assert {k: v for k, v in got.items() if k in long_enough} == long_enough
    assert set(got) <= set(want)
    assert (None, 2) in got and (902, 1) in got
    dirty = {d for d, _ in got}
    kept = decontaminate.clean_documents(given, bench).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r[0]) for r in rows if r[0] not in dirty)
    assert kept[0].asDict().keys() == {"doc_id", "text", "toks"}


def test_short_items_with_every_allowed_substitution(spark):
    items = [[f"w{n}x{i}" for i in range(n)] for n in range(1, 15)]
    docs = {}
    for k, item in enumerate(items):
        n = len(item)
        for gone in (0, 1, 2, 3):
            for places in itertools.combinations(range(n), gone):
                body = ["changed" if i in places else t for i, t in enumerate(item)]
                docs[len(docs)] = ["before", "it", *body, "after"]
        docs[len(docs)] = item[1:]
        docs[len(docs)] = item * 3
    given = spark.createDataFrame([(i, " ".join(d)) for i, d in docs.items()], "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.agreeing for r in decontaminate.overlaps(given, bench).collect()}
    want = {}
    for i, doc in docs.items():
        for k, item in enumerate(items):
            if set(doc) & set(item) and (best := _overlap(doc, item)) is not None:
                want[i, k] = best
    assert got == want


def test_no_documents_or_no_items(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.overlaps(docs, items).collect() == []
    assert decontaminate.clean_documents(docs, items).count() == 1
    assert decontaminate.overlaps(docs.limit(0), items).collect() == []


# --- lines ---------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyzé")
        elif kind == 1:
            chars.insert(at, rng.choice("xyzé"))
        else:
            del chars[at]
    return "".join(chars)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_banded_distance(edits):
    rng = random.Random(edits)
    for _ in range(1500):
        a = "".join(rng.choices("abé", k=rng.randrange(1, 14)))
        b = edited(rng, a, rng.randrange(0, min(5, len(a)))) if rng.random() < 0.8 else "".join(rng.choices("abé", k=8))
        want = distance(a, b)
        assert line_dedup.within(a, b, edits) == (want if want <= edits else None), (a, b)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_probes_miss_no_pair(edits):
    rng = random.Random(3)
    for _ in range(2000):
        a = "".join(rng.choices("ab", k=rng.randrange(20, 30)))
        b = edited(rng, a, rng.randrange(0, edits + 1))
        if distance(a, b) > edits:
            continue
        a, b = sorted((a, b), key=len)
        parts = line_dedup.segments(len(a), edits)
        assert any(
            b[s : s + z] == a[parts[i][0] : parts[i][0] + z] for i, s, z in line_dedup.probes(len(b), len(a), edits)
        ), (a, b)


def corpus_lines():
    rng = random.Random(8)
    line = lambda: "".join(rng.choices("abcdefgh ", k=rng.randrange(20, 50)))
    docs, pool = [], [line() for _ in range(20)]
    for i in range(25):
        body = []
        for _ in range(rng.randrange(1, 6)):
            base = rng.choice(pool) if rng.random() < 0.6 else line()
            body.append(edited(rng, base, rng.choice([0, 0, 1, 2, 3])))
        docs.append((i, "\n".join(body), "en"))
    docs += [(100, None, "en"), (101, "", "en"), (102, "short\nshort\n\n", "en"), (None, pool[0] + "\n" + line(), "en")]
    docs += [(103, pool[1] * 400, "en"), (104, pool[1] * 400, "en"), (3, docs[3][1], "en")]
    return docs


@pytest.mark.parametrize("block", [256, 3])
def test_classes_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", block)
    docs = corpus_lines()
    df = spark.createDataFrame(docs, "doc_id bigint, text string, line string")
    rows = line_dedup.classes(df.repartition(3)).collect()
    placed = [
        (i, n, t) for i, text, _ in docs if text is not None for n, t in enumerate(text.split("\n")) if len(t) >= 20
    ]
    assert sorted(map(str, ((r.doc_id, r.line_no) for r in rows))) == sorted(str(p[:2]) for p in placed)
    texts = sorted({t for _, _, t in placed})
    near = [(a, b) for a, b in itertools.combinations(texts, 2) if abs(len(a) - len(b)) <= 2 and len(a) < 1000 and distance(a, b) <= 2]
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in near:
        root[find(a)] = find(b)
    links = {t: sum(t in pair for pair in near) for t in texts}
    of = {(p[0], p[1]): p[2] for p in placed}
    by_class = {}
    for r in rows:
        text = of[r.doc_id, r.line_no]
        assert r.n_links == links[text]
        by_class.setdefault(r.class_id, set()).add(find(text))
    assert all(len(c) == 1 for c in by_class.values()) and len(by_class) == len({find(t) for t in texts})
    order = lambda p: (p[0] is None, p[0] or 0, p[1])
    first = {}
    for p in sorted(placed, key=order):
        first.setdefault(find(p[2]), p[:2])
    assert {(r.doc_id, r.line_no) for r in rows if r.first} == set(first.values())

    kept = {(r.doc_id, r.text) for r in line_dedup.drop_repeated(df).collect()}
    want = set()
    for i, text, _ in docs:
        if text is None:
            want.add((i, None))
            continue
        stays = [t for n, t in enumerate(text.split("\n")) if len(t) < 20 or first[find(t)] == (i, n)]
        want.add((i, "\n".join(stays)))
    assert kept == want


def test_no_lines(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.classes(empty).collect() == []
    assert line_dedup.drop_repeated(empty).collect() == []


@pytest.mark.parametrize("near", [3, 20])
def test_every_line_against_all_pairs(spark, near):
    rng = random.Random(near)
    short = ["".join(rng.choices("abcé. ", k=rng.randrange(1, 22))) for _ in range(60)]
    bodies = [[rng.choice(short) for _ in range(6)] for _ in range(25)]
    bodies += [["a", "ab", "abc", "abcd", "", "xyz", "xyz", "a", "And.", "Ein."]]
    docs = [*((i, "\n".join(b)) for i, b in enumerate(bodies)), *((200 + i, t) for i, t, _ in corpus_lines() if i not in (None, 3))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    placed = [(i, n, t) for i, text in docs if text for n, t in enumerate(text.split("\n")) if t]
    texts = sorted({t for _, _, t in placed})
    pairs = [
        (a, b) for a, b in itertools.combinations(texts, 2)
        if near <= min(len(a), len(b)) and len(a) < 1000 and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2
    ]
    group = {t: {t} for t in texts}
    for a, b in pairs:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for t in group[b]:
                group[t] = group[a]
    links = {t: sum(t in pair for pair in pairs) for t in texts}
    first = {}
    for i, n, t in sorted(placed):
        first.setdefault(min(group[t]), (i, n))
    rows = {(r.doc_id, r.line_no): r for r in line_dedup.classes(df, least=1, near=near).collect()}
    assert set(rows) == {p[:2] for p in placed}
    named = {}
    for i, n, t in placed:
        assert rows[i, n].n_links == links[t]
        assert rows[i, n].first == (first[min(group[t])] == (i, n))
        named.setdefault(rows[i, n].class_id, set()).add(min(group[t]))
    assert sorted(len(x) for x in named.values()) == [1] * len(first)
    kept = {r.doc_id: r.text for r in line_dedup.drop_repeated(df, least=1, near=near).collect()}
    for i, text in docs:
        stays = [t for n, t in enumerate((text or "").split("\n")) if not t or first[min(group[t])] == (i, n)]
        assert kept[i] == (None if text is None else "\n".join(stays))


def test_registered_queries_return_and_drop_short_lines(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Yes.\nNo\n\nMore."), (2, "Yes.\nNot\nNo\nMare.")], "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = line_dedup.op9_segment_edit_lines(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.line_no) for r in rows} == {(1, 0), (1, 1), (1, 3), (2, 0), (2, 1), (2, 2), (2, 3)}
    assert {(r.doc_id, r.line_no) for r in rows if not r.kept} >= {(2, 0), (2, 2), (2, 3)}
    left = corpus_pipeline.lines(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in left} == {1: "Yes.\nNo\n\nMore.", 2: "Not\nMare."}


def test_rows_without_an_id_lose_their_own_lines_only(spark):
    long = lambda c: c * 12 + " " + c * 15
    texts = [(None, [long("a"), long("b")]), (None, [long("c"), long("a")]), (None, [long("d"), long("e")]),
             (7, [long("f"), long("a")]), (7, [long("g"), long("h")]), (None, [long("d"), long("e")]), (None, [long("e"), long("k")])]
    df = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts], "doc_id bigint, text string")
    got = sorted(r.text for r in line_dedup.drop_repeated(df).collect())
    # "a" stays where an id has it, "e" where its line number is least
    assert got == sorted("\n".join(map(long, x)) for x in ("b", "c", "fa", "gh", "d", "d", "ek"))
