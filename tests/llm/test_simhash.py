from __future__ import annotations

import random

import numpy as np
from brute import linked, simhash

from tidemark.llm import simhash as S
from tidemark.llm.components import connected_components


def test_fingerprints():
    texts = [None, "", " \n ", "One", "one TWO", "one two three", "Éa é\x0bb c d e", "a b " * 500, "x" * 3_000_000 + " y z"]
    for text in texts:
        assert S.fingerprint(None if text is None else text.encode(), 3) == simhash(text)
    rng = random.Random(1)
    long = " ".join(rng.choice(["foo", "bar", "Baz", "q"]) for _ in range(300_000))  # cut into blocks
    assert S.fingerprint(long.encode(), 3) == simhash(long)


def test_posting_sets_cover_all_shared_bytes():
    from itertools import combinations

    for distance in range(8):
        for size in range(1, min(4, 8 - distance) + 1):
            sets = S.posting_sets(8 - distance, size)
            assert all(any(set(s) <= set(c) for s in sets) for c in combinations(range(8), 8 - distance))


def planted(rng, n):
    values = [rng.getrandbits(64) for _ in range(n)]
    for v in values[: n // 4]:
        for _ in range(rng.randint(1, 4)):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                v ^= 1 << b
            values.append(v)
    return values


def test_star_links_in_a_long_list_are_those_of_a_short_one(monkeypatch):
    rng = random.Random(2)
    base = rng.getrandbits(64) & ~0xFFFFFF
    values = np.unique(np.array([base | rng.getrandbits(24) for _ in range(600)] + [base ^ (1 << rng.randrange(24)) for _ in range(30)], dtype=np.uint64))
    held = tuple(p for p in range(5))
    plain = S._direct(values, 3)
    monkeypatch.setattr(S, "DIRECT", 50)
    src, dst = S.star_links(values, held, 3)
    joined = {int(a): int(b) for a, b in zip(src, dst, strict=True)}
    got = [joined.get(int(v), int(v)) for v in values]
    assert got == [int(values[i]) for i in plain]


def test_groups_against_all_pairs(spark):
    rng = random.Random(3)
    values = planted(rng, 200)
    rows = [(i if i % 50 else None, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)] + [(1000 + i, 0) for i in range(300)]
    prints = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in S.near_duplicates(prints).collect()}
    label = linked([v % (1 << 64) for _, v in rows], 3)
    ids = {}
    for (k, _), group in zip(rows, label, strict=True):
        ids[group] = min([x for x in (ids.get(group), k) if x is not None], default=None)
    assert got == {row: ids[group] for row, group in zip(rows, label, strict=True)}


def test_frequent_keys_become_lists_by_more_bytes(spark, monkeypatch):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    values = [base ^ rng.getrandbits(40) for _ in range(150)] + [base ^ rng.getrandbits(14) for _ in range(80)]
    for v in values[:60] + [rng.getrandbits(64) for _ in range(40)]:
        for b in rng.sample(range(64), rng.randint(0, 4)):
            v ^= 1 << b
        values.append(v)
    values = sorted(set(values))
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    monkeypatch.setattr(S, "DIRECT", 20)
    for distance, posting_bytes in [(3, 3), (3, 5), (2, 3)]:
        prints = spark.createDataFrame(rows, "doc_id long, fingerprint long")
        got = {r.doc_id: r.component_id for r in S.near_duplicates(prints, distance=distance, posting_bytes=posting_bytes).collect()}
        assert [got[i] for i in range(len(values))] == linked(values, distance), (distance, posting_bytes)


def test_one_list_of_many_fingerprints_is_split(spark):
    """100,000 fingerprints that share three bytes: no list that is compared has a tenth of them."""
    rng = np.random.default_rng(9)
    values = np.unique((np.uint64(0xABCDEF) << np.uint64(40)) | rng.integers(0, 1 << 40, 100_000, dtype=np.uint64))
    distinct = spark.createDataFrame([(int(v),) for v in (values.view(np.int64))], "fingerprint long")
    sizes = []
    monkey = S._starred

    def watched(posted, sets, distance):
        sizes.append(posted.groupBy("key").count().agg({"count": "max"}).first()[0] or 0)
        return monkey(posted, sets, distance)

    S._starred = watched
    try:
        found = {(r.src, r.dst) for r in S.links(distinct).collect()}
    finally:
        S._starred = monkey
    assert len(sizes) == 2 and max(sizes) < len(values) / 10
    assert all(0 < (a ^ b).bit_count() for a, b in found)


def test_near_duplicates_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, fingerprint long")
    assert S.near_duplicates(empty).collect() == [] and S.links(empty.select("fingerprint")).collect() == []


def test_long_chain_of_links(spark):
    rng = random.Random(4)
    names = rng.sample(range(10_000), 300)
    links = spark.createDataFrame(list(zip(names, names[1:], strict=False)) + [(20_000, 20_001), (5, 5)], "src long, dst long")
    roots = {r.node: r.root for r in connected_components(links).collect()}
    assert roots == {n: min(names) for n in names if n != min(names)} | {20_001: 20_000}


def test_one_of_each_group_stays(spark):
    rng = random.Random(5)
    base = " ".join(rng.choice("abcdefgh") + str(rng.randrange(1000)) for _ in range(400))
    rows = [(3, base, "k"), (1, base + " end", "k"), (2, base, "k"), (2, base, "k"), (9, None, "k"), (8, "", "k"), (None, "alone here now", "k"), (7, "other words are here", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _digest string")
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    prints = [simhash(t) for _, t, _ in rows]
    assert (prints[0] ^ prints[1]).bit_count() <= 3
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[5], rows[6], rows[7]], key=str)
    assert S.drop_near_duplicates(docs.limit(0)).collect() == []


def test_groups_are_not_joined_or_split_by_their_ids(spark):
    rng = random.Random(6)

    def near():
        """Two texts with different fingerprints within the distance."""
        while True:
            base = " ".join(rng.choice("abcdefgh") + str(rng.randrange(1000)) for _ in range(400))
            if 0 < (simhash(base) ^ simhash(base + " end")).bit_count() <= 3:
                return base, base + " end"

    (a, a_near), (b, b_near), (c, c_near) = near(), near(), near()
    docs = spark.createDataFrame([(1, a), (4, a_near), (1, b), (5, b_near), (None, c), (None, c_near)], "doc_id long, text string")
    kept = [tuple(r) for r in S.drop_near_duplicates(docs).collect()]
    assert len(kept) == 3 and {(1, a), (1, b)} < set(kept)
    assert [t for i, t in kept if i is None][0] in (c, c_near)
