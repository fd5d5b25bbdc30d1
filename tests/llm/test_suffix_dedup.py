"""Two-stage suffix sorting and the removal of repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from sentaria.llm import suffix_dedup as S


@pytest.mark.parametrize("letters", ["ab", "abc", "a", "abcdefghijklmnopqrstuvwxyzé"])
def test_suffix_array(letters):
    rng = random.Random(4)
    for n in (1, 2, 3, 10, 60, 300):
        text = "".join(rng.choices(letters, k=n)).encode()
        got = S.suffix_array(np.frombuffer(text, np.uint8), len(text)).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_to_a_depth():
    text = (b"the same words again and again, " * 20) + b"tail"
    order = S.suffix_array(np.frombuffer(text, np.uint8), 24)
    assert sorted(order.tolist()) == list(range(len(text)))
    cut = [text[i : i + 24] for i in order]
    assert cut == sorted(cut)


def test_equal_strings_have_equal_anchors():
    rng = random.Random(1)
    block = bytes(rng.choices(range(97, 123), k=400))
    a, b = b"x" * 37 + block, block + b"y" * 11
    by = []
    for text in (a, b):
        h, first, last = S.runs(text)
        by.append({text[i : i + 50]: key for key, f, l in zip(h, first, last) for i in range(f, l + 1)})
        assert sum(l - f + 1 for f, l in zip(first, last)) == len(text) - 49
    shared = set(by[0]) & set(by[1])
    assert len(shared) == 351 and all(by[0][s] == by[1][s] for s in shared)


def plain(rows, size=50):
    least = {}
    datas = [(i, (t or "").encode()) for i, t in rows]
    rank = lambda i: (1 << 63) - 1 if i is None else i
    for i, data in datas:
        for p in range(len(data) - size + 1):
            s = data[p : p + size]
            least[s] = min(least.get(s, 1 << 63), rank(i))
    out = []
    for i, data in datas:
        gone = [False] * len(data)
        for p in range(len(data) - size + 1):
            if least[data[p : p + size]] < rank(i):
                gone[p : p + size] = [True] * size
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(20), prose(12)
    base = prose(80)
    near = [base[:100] + "X" + base[101:], base[:250] + base[260:], base + prose(5)]
    rows = [(i, prose(rng.randrange(1, 60))) for i in range(30)]
    rows += [(100 + i, prose(8) + passage + prose(6)) for i in range(12)]
    rows += [(200 + i, t) for i, t in enumerate([base, *near, base, base])]
    rows += [(50, other + prose(3)), (49, prose(4) + other), (300, "a" * 200), (301, "b" + "a" * 120)]
    rows += [(400, None), (401, ""), (402, passage[:49]), (None, base), (None, passage), (403, "ab" * 90 + other)]
    rows += [(404, base), (404, base), (404, prose(40)), (500, prose(9000) + base)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("split,piece,batch", [(20_000, 1 << 18, 16 << 20), (2, 300, 2000)])
def test_dedup(spark, monkeypatch, split, piece, batch):
    for name, value in (("SPLIT_ROWS", split), ("_PIECE", piece), ("_BATCH_BYTES", batch)):
        monkeypatch.setattr(S, name, value)
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id bigint, text string, start int, doc string")
    got = S.dedup(df.repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_nothing(spark):
    assert S.dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_spans_of_every_place(monkeypatch, block):
    """Slices of two anchors, each at several places: what a place loses, by brute force."""
    monkeypatch.setattr(S, "_BLOCK_STRINGS", block)
    rng = random.Random(block)
    size, rows = 24, []
    base = bytes(rng.choices(b"ab", k=60))
    for anchor in (3, 8):
        for _ in range(25):
            a = rng.randrange(0, 30)
            places = np.array([(rng.randrange(99), rng.randrange(9), rng.randrange(50)) for _ in range(3)], "<i8")
            text = base[a : a + size + rng.randrange(0, 12)] + rng.choice([b"", b"c", b"d"])
            rows.append((anchor, 0, text, int(places[:, 1].min()), places.tobytes()))
    least = {}
    for _, _, text, owner, _ in rows:
        for p in range(len(text) - size + 1):
            least[text[p : p + size]] = min(owner, least.get(text[p : p + size], owner))
    want = set()
    for _, _, text, _, places in rows:
        for key, doc, start in np.frombuffer(places, "<i8").reshape(-1, 3).tolist():
            for p in range(len(text) - size + 1):
                if least[text[p : p + size]] < doc:
                    want |= {(key, start, start + p + i) for i in range(size)}
    names = ["anchor", "part", "slice", "owner", "places"]
    batch = S.pa.RecordBatch.from_arrays([S.pa.array(list(c)) for c in zip(*rows)], names=names)
    got = [r for b in S._removed(size)(iter([batch])) for r in b.to_pylist()]
    assert {b for _, _, b in want} >= {x for r in got for x in range(r["start"], r["stop"])}
    assert {(k, x) for k, _, x in want} == {(r["text_key"], x) for r in got for x in range(r["start"], r["stop"])}
