"""Packing, sharding and SimHash against brute force and on odd inputs."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from sentaria.llm import feistel_shards, packing, simhash
from sentaria.llm.common import components, numbered

ODD = [
    (1, None, "x"), (2, "", "x"), (None, "no id at all here today", "x"), (3, "one two", "x"),
    (4, "the same text for two rows of four", "x"), (4, "the same text for two rows of four", "x"),
    (5, "Ünï  codé \t text with <|endoftext|> odd\n  spaces ", "x"), (6, "long " * 30_000, "x"),
]
SCHEMA = "doc_id bigint, text string, shard string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- packing -------------------------------------------------------------------


def plain_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n b", "it's we'll 've", "x\t y", "日本語 テキスト です",
        "é  b", "\n\n  c  \n", "a  b  c", "12 345  6 !? ...", "<|endoftext|> x", "a \x1c b", "İ ß ﬁ ½ 𝒳 y",
    ],
)
def test_ids_are_the_tokenizers(text):
    assert packing.token_ids(text).tolist() == plain_ids(text)


def test_ids_on_random_mixtures():
    random.seed(3)
    parts = [" ", "  ", "\n", "\t", "a", "Word", "'s", "é", "12", "!", " ", "日", "　", ","]
    for _ in range(400):
        text = "".join(random.choices(parts, k=random.randrange(1, 25)))
        assert packing.token_ids(text).tolist() == plain_ids(text), repr(text)


def test_piece_lengths():
    assert packing.piece_lengths(2048 + 1 + 4 + 512) == [1024, 1024, 512, 4, 1]
    for n in range(1, 3000, 7):
        got = packing.piece_lengths(n)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 1024 for x in got)


def test_pack_round_trip(spark, odd):
    rows = packing.pack(odd).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert all(r.offset == 0 for r in rows)
    for doc_id, text, _ in ODD:
        ids = np.array([*plain_ids(text or ""), 0], "<u4")
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        copies = sum(1 for o in ODD if o[0] == doc_id)
        assert sum(r.length for r in mine) == copies * len(ids)
        for r in mine:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    by_sequence = sorted(rows, key=lambda r: r.sequence_id)
    lengths = [r.length for r in by_sequence]
    assert lengths == sorted(lengths, reverse=True)


def test_pack_nothing(nothing):
    assert packing.pack(nothing).collect() == []


# --- sharding ------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    moved = feistel_shards.permute(np.arange(n), n)
    assert sorted(moved.tolist()) == list(range(n))
    assert feistel_shards.permute(moved, n, back=True).tolist() == list(range(n))


def test_shards(spark, odd):
    rows = feistel_shards.assign_shards(odd, shards=3).collect()
    assert len(rows) == len(ODD)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
        number = feistel_shards.number_at(np.array([r.shard]), np.array([r.slot]), len(ODD), 3)
        assert number[0] == r.row_number and r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    texts = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _ in ODD)
    assert sorted((r["size"], r.text_crc32) for r in rows) == texts
    again = feistel_shards.assign_shards(odd.repartition(5), shards=3)
    key = lambda r: (r.row_number, r.shard, r.slot, r.text_crc32)
    assert sorted(map(key, again.collect())) == sorted(map(key, rows))


def test_shards_of_nothing(nothing):
    assert feistel_shards.assign_shards(nothing).collect() == []


def test_numbers_spread_equal_rows(spark):
    same = spark.createDataFrame([(7,)] * 5000, "k int").repartition(8)
    rows, n = numbered(same, "k")
    assert n == 5000 and sorted(r.row_number for r in rows.collect()) == list(range(5000))


# --- simhash -------------------------------------------------------------------


def plain_fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t", "a", "A b C", "a b c d", "É e f g h É e f g h", "x " * 500, "a b c d e f g"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_more_than_a_chunk(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "_CHUNK", 64)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_components(spark):
    random.seed(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 40)]
    edges = chain + star + [(1, 2), (2, 1), (9, 9), (None, 3), (41, 7), (7, 40)]
    random.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    want = {i: 100 for i in range(100, 161)} | {500 + i: 500 for i in range(40)}
    assert got == want | {1: 1, 2: 1, 7: 7, 40: 7, 41: 7}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def _rooted(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("split", [1024, 5])
def test_links_against_all_pairs(spark, monkeypatch, split):
    """Random balls, a dense cluster that makes hot blocks, and lone fingerprints."""
    monkeypatch.setattr(simhash, "SPLIT_FINGERPRINTS", split)
    random.seed(5)
    flip = lambda x, n: x ^ sum(1 << b for b in random.sample(range(64), n))
    prints = [random.getrandbits(64) for _ in range(60)]
    for centre in prints[:20]:
        prints += [flip(centre, random.randrange(1, 8)) for _ in range(4)]
    hub = random.getrandbits(64)
    prints += [flip(hub, 2) for _ in range(40)] + [0, 1, (1 << 64) - 1]
    prints = sorted(set(prints))
    rows = [(i, simhash._signed(p)) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id bigint, fp bigint")
    got = {r.doc_id: r.component_id for r in simhash.with_components(df).collect()}
    assert [got[i] for i in range(len(prints))] == _rooted(prints, 4)


def test_near_duplicates_on_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    got = sorted((r.fingerprint, r.component_id) for r in rows if r.doc_id in (1, 2))
    assert got == [("0" * 16, 1)] * 2
    assert {r.component_id for r in rows if r.doc_id == 4} == {4}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    for r in rows:
        texts = {t for i, t, _ in ODD if i == r.doc_id}
        assert r.fingerprint in {f"{plain_fingerprint(t):016x}" for t in texts}


def test_keep_one(spark, odd, nothing):
    kept = simhash.keep_one(odd).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 4, 5, 6]
    assert set(kept[0].asDict()) == {"doc_id", "text", "shard"}
    assert simhash.keep_one(nothing).collect() == []
    assert simhash.near_duplicates(nothing).collect() == []


def test_one_of_near_copies_without_ids_stays(spark):
    words = [f"word{i}" for i in range(400)]
    base = plain_fingerprint(" ".join(words))
    near = (" ".join([*words[:i], "changed", *words[i + 1 :]]) for i in range(400))
    copy = next(t for t in near if 0 < (plain_fingerprint(t) ^ base).bit_count() <= 4)
    rows = [(None, " ".join(words)), (None, copy), (None, "quite another text that stays by itself")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(kept) == 2 and rows[2][1] in {r.text for r in kept}
