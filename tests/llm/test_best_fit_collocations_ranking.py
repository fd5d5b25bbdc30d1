"""Sum-of-squares packing, collocations and ranked search against brute force and on odd inputs."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sentaria.llm import collocations as phrases
from sentaria.llm import ranked_search, sum_of_squares
from sentaria.llm.packing import token_ids

NOTHING = "doc_id bigint, text string, lang string"


# --- packing by the sum of squares ---------------------------------------------


def slow_fill(lengths, capacity):
    """Every choice tried, the squares summed anew."""
    gaps, where = [], []
    for s in lengths:
        best = None
        for at in [*range(len(gaps)), len(gaps)]:
            gap = gaps[at] if at < len(gaps) else capacity
            if gap < s:
                continue
            after = gaps[:at] + [gap - s] + gaps[at + 1 :]
            squares = sum(n * n for g, n in Counter(after).items() if g)
            rank = (squares, at == len(gaps), gap)
            if best is None or rank < best[0]:
                best = rank, at, after
        gaps = best[2]
        where.append(best[0])
    return gaps, where


@pytest.mark.parametrize("seed", range(6))
def test_fill_makes_the_choice_of_least_squares(seed):
    random.seed(seed)
    capacity = 24
    lengths = [random.choice([random.randint(1, capacity), 8, 6, capacity]) for _ in range(150)]
    sequence, offset, gaps = sum_of_squares.fill(lengths, capacity)
    slow, ranks = slow_fill(lengths, capacity)
    assert sorted(gaps.tolist()) == sorted(slow)
    held = defaultdict(int)
    for s, q, o in zip(lengths, sequence.tolist(), offset.tolist()):
        assert o == held[q]
        held[q] += s
    assert all(capacity - held[q] == g for q, g in enumerate(gaps.tolist()))


ODD = [
    (1, None, "x", 7), (2, "", "x", 7), (None, "no id at all here today", "x", 7), (None, "no id at all here today", "x", 7),
    (4, "the same text for two rows of four", "x", 7), (4, "the same text for two rows of four", "x", 7),
    (5, "Ünï  codé \t text with <|endoftext|> odd\n  spaces ", "x", 7), (6, "long " * 9_000, "x", 7),
]


def check_packing(given, rows, capacity):
    filled, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= capacity
        filled[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    expected = defaultdict(Counter)
    for doc_id, text, *_ in given:
        ids = np.append(token_ids(text), np.uint32(0)).astype("<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id][i, a, b - a, zlib.crc32(ids[a:b])] += 1
    got = {d: Counter((r.piece, r.start, r.length, r.ids_crc32) for r in rows) for d, rows in pieces.items()}
    assert got == expected
    return len(filled)


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, place string, room int")
    assert check_packing(ODD, sum_of_squares.pack_best_fit(docs).collect(), 2048) > 1
    assert sum_of_squares.pack_best_fit(spark.createDataFrame([], NOTHING)).collect() == []


def best_fit_decreasing(lengths, capacity):
    """Sequences that packing needs which sees all lengths before the first."""
    gaps = Counter()
    used = 0
    for s in sorted(lengths, reverse=True):
        gap = min((g for g, n in gaps.items() if n and g >= s), default=None)
        if gap is None:
            used, gap = used + 1, capacity
        else:
            gaps[gap] -= 1
        gaps[gap - s] += 1
    return used


def test_packing_in_rounds_wastes_little(spark):
    random.seed(1)
    given = [(i, "word " * random.randint(1, 150)) for i in range(4000)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    rows = sum_of_squares.pack_best_fit(docs, capacity=64, group_pieces=700).collect()
    used = check_packing(given, rows, 64)
    assert used <= 1.02 * best_fit_decreasing([r.length for r in rows], 64)
    again = sum_of_squares.pack_best_fit(docs, capacity=64, group_pieces=700).collect()
    assert sorted(rows) == sorted(again)


def test_packing_ends_where_nothing_fills(spark):
    given = [(i, "word " * 40) for i in range(900)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    rows = sum_of_squares.pack_best_fit(docs, capacity=64, group_pieces=100).collect()
    assert check_packing(given, rows, 64) == 900


# --- collocations --------------------------------------------------------------


def slow_collocations(docs, longest=3, threshold=10, share=50, first=2000):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        rows = []
        for p, a in cand.items():
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            around = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= share * a for b in around):
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(seed, rows=150):
    random.seed(seed)
    words = [*"abcdefg", "New", "YORK", "é", "ß", "x\x1cy", "\x00", "İst"]
    out = []
    for i in range(rows):
        text = "".join(random.choice(words) + random.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", " ! ", "\r\n"]) for _ in range(40))
        out.append((i, text, random.choice(["en", "en", "de", None, "und", ""])))
    return [*out, (None, None, "en"), (1, "", None), (1, " .,; ", "zz"), (2, "one " * 3000, "rep"), (3, "one " * 3000, "rep")]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_equal_brute_force(spark, seed):
    given = corpus(seed)
    docs = spark.createDataFrame([(*r, 1) for r in given], "doc_id bigint, text string, lang string, phrase int")
    got = sorted(tuple(r) for r in phrases.collocations(docs).collect())
    assert got == slow_collocations(given)
    got = sorted(tuple(r) for r in phrases.collocations(docs, longest=4, threshold=6, share=30, first=7).collect())
    assert got == slow_collocations(given, 4, 6, 30, 7)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], NOTHING)).collect() == []
    few = spark.createDataFrame([(1, "a b c", "en")], NOTHING)
    assert phrases.collocations(few).collect() == []


def test_products_beyond_64_bits(spark):
    rows = [("en", "a", 1, 4 * 10**12), ("en", "b", 1, 3 * 10**12), ("en", "a b", 2, 2 * 10**12 + 7)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")
    (row,) = phrases.scored(frequent).collect()
    assert row.score == 10**6 * (2 * 10**12 + 7) ** 2 // (12 * 10**24)


@pytest.mark.parametrize("slack", [1, 4])
def test_summaries_keep_every_frequent_key(slack):
    random.seed(slack)
    keys = [random.randrange(3000) ** 2 // 3000 for _ in range(40_000)]
    exact = Counter(keys)
    for threshold in (10, 40):
        summary = phrases.Summary(slack * (len(keys) // threshold + 1))
        for at in range(0, len(keys), 1700):
            summary.merge([phrases.counted(np.array(keys[at : at + 1700], np.uint64))])
            assert len(summary.keys) <= summary.capacity
        assert summary.taken < threshold / slack
        found = set(summary.reaching(threshold).tolist())
        assert {k for k, n in exact.items() if n >= threshold} <= found
        assert all(0 <= exact[k] - c <= summary.taken for k, c in zip(summary.keys.tolist(), summary.counts.tolist()))


def test_summary_with_few_counters():
    rng = np.random.default_rng(5)
    keys = rng.zipf(1.3, 60_000).astype(np.uint64)
    exact = Counter(keys.tolist())
    summary = phrases.Summary(50)
    for part in np.array_split(keys, 23):
        summary.merge([phrases.counted(part)])
    assert summary.taken > 0 and summary.taken * summary.capacity < len(keys)
    assert {k for k, n in exact.items() if n > len(keys) / 50} <= set(summary.keys.tolist())


def test_counters_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 56, n).astype(np.uint64))
        counts = rng.integers(1, 10 ** rng.integers(1, 12), len(keys))
        back = phrases.from_bytes(phrases.to_bytes(keys, counts), len(keys))
        assert (back[0] == keys).all() and (back[1] == counts).all()


# --- ranked search -------------------------------------------------------------

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def slow_search(docs, items, top=20):
    def split(text):
        return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    bags = [(doc_id, Counter(split(text))) for doc_id, text, *_ in docs]
    n_docs = sum(1 for _, bag in bags if bag)
    n_terms = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item_id, text, *_ in items:
        scores = []
        for doc_id, bag in bags:
            n, score = sum(bag.values()), 0
            for t in split(text):
                if bag[t]:
                    m = 100 - 25 + (25 * n * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, known, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.append((item_id, rank, doc_id if known else None, -score))
    return sorted(out, key=str)


def library(seed, rows):
    random.seed(seed)
    words = [f"w{i}" for i in range(120)] + ["Été", "ß", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    def text(k):
        return random.choice([" ", "-", "\n"]).join(random.choices(words, weights, k=k)).title()
    docs = [(random.choice([i, i, i // 2, None]), text(random.randint(1, 60))) for i in range(rows)]
    docs += [(9_000, None), (9_001, ""), (9_002, "--- ..."), (9_003, "w3 w77 " * 20_000), *[(9_100 + i, "w5 w6 w90") for i in range(60)]]
    items = [(i, text(random.randint(1, 15))) for i in range(25)]
    return docs, items + [(100, None), (101, ""), (102, "unknown"), (103, "w5 w6 w90 w90"), (None, "w1 w2"), (103, "ß ß été")]


@pytest.mark.parametrize("block, window, short", [(8192, 1024, 1 / 16), (64, 8, 1 / 4), (100, 16, 0.0), (50, 50, 1.0)])
def test_search_equals_brute_force(spark, block, window, short):
    docs, items = library(block, 500)
    layout = ranked_search.Layout(block, window, short)
    given = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, score int")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in ranked_search.search(given, asked, layout=layout).collect()]
    assert sorted(got, key=str) == slow_search(docs, items)


@pytest.mark.parametrize("seed", range(30))
def test_blocks_return_all_of_the_best(seed):
    rng = np.random.default_rng(seed)
    layout = ranked_search.Layout(window=16, short=0.2)
    n_docs, top = 200, 5
    lists, sums = [], np.zeros(n_docs, np.int64)
    for _ in range(rng.integers(1, 9)):
        places = np.sort(rng.choice(n_docs, rng.integers(1, n_docs), replace=False))
        gains = rng.integers(1, rng.choice([4, 50]), len(places))
        sums[places] += gains
        lists.append(ranked_search.Posting.of(places, gains, n_docs, layout))
    floor = int(rng.integers(1, sums.max() + 2))
    places, scores = ranked_search.best_of_block(lists, n_docs, top, floor, layout)
    want = [p for p in np.argsort(-sums, kind="stable")[:top] if sums[p] >= floor]
    assert set(want) <= set(places.tolist())
    assert (scores == sums[places]).all()


def test_items_in_blocks_and_no_tables(spark, monkeypatch):
    docs, items = library(7, 80)
    monkeypatch.setattr(ranked_search, "ITEMS", 9)
    given = spark.createDataFrame(docs, "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in ranked_search.search(given, asked, top=3).collect()]
    assert sorted(got, key=str) == slow_search(docs, items, 3)
    assert ranked_search.search(given, asked.limit(0)).collect() == []
    assert ranked_search.search(given.limit(0), asked).collect() == []
