"""Components against all pairs by definition: chains, hot groups split into blocks, repeats, nulls."""

import numpy as np
import pytest
from llm_support import corpus, defaultdict, frame, random, words

from plantmetrics.llm import minhash_dedup as md


def shingles(text):
    w = words(text)
    return frozenset([tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))]) if w else frozenset()


def brute(rows):
    sets = defaultdict(set)
    for i, t, _ in rows:
        if i is not None:
            sets[i].add(shingles(t))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if any(a and b and 100 * len(a & b) >= 80 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, len(s), find(i), find(i) == i) for i in ids for s in sets[i]}


def near(spark, rows):
    got = md.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(set(got))
    return {tuple(x) for x in got}


def families(seed, n):
    """Families whose members drift: similarities on both sides of 0.8, chains, exact copies."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for f in range(4):
        base = r.choices(vocab, k=160)
        for _ in range(n):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 4, 6, 8, 10])):
                copy[r.randrange(160)] = r.choice(vocab)
            rows.append((len(rows), " ".join(copy), "a"))
            if r.random() < 0.2:
                base = copy
    r.shuffle(rows)
    return rows


def test_equals_all_pairs(spark):
    rows = corpus(4, 90)
    rows += [(500, "a b c", "x"), (501, "A  b\nC", "x"), (502, "a b", "x"), (503, None, "x"), (504, " \n", "x"), (505, "a b c d", "x")]
    assert near(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [4, 1024])
def test_hot_groups_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(md, "BLOCK_ROWS", block)
    monkeypatch.setattr(md, "PACK_ROWS", 16)
    rows = families(7, 45)
    expected = brute(rows)
    assert 4 < len({c for _, _, c, _ in expected}) < 170
    assert near(spark, rows) == expected


def test_crossings_alone_find_every_link(spark, monkeypatch):
    """Without stars all links must come out of the divided buckets of three members or more."""
    rows = families(3, 30)
    monkeypatch.setattr(md, "BLOCK_ROWS", 5)
    real = md._star
    monkeypatch.setattr(md, "_star", lambda members, turn: real(
        members.join(members.groupBy("key").count().filter("count = 2").select("key"), "key"), turn))
    assert near(spark, rows) == brute(rows)


def test_rows_of_one_id(spark):
    r = random.Random(1)
    a, b = (" ".join(r.choices([f"v{i}" for i in range(99)], k=k)) for k in (60, 64))
    rows = [(5, a, "x"), (5, b, "x"), (5, a, "x"), (7, a, "x"), (9, b + " end", "x"), (3, "", "x"), (3, a, "x"), (8, "lonely text of words", "x"), (None, a, "x")]
    assert near(spark, rows) == brute(rows)


def test_empty_table_and_long_texts(spark):
    assert near(spark, []) == set()
    long = " ".join(f"t{i % 70001}" for i in range(300_000))
    rows = [(1, long, "x"), (2, long + " more words at the end", "x"), (3, "x" * 5_000_000, "x"), (4, "y " * 900_000, "x")]
    assert {(i, c) for i, _, c, _ in near(spark, rows)} == {(1, 1), (2, 1), (3, 3), (4, 4)}


def test_pruning_keeps_links_and_drops_strangers():
    r = np.random.default_rng(2)
    def pair(shared, own):
        x = r.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64)
        return np.sort(x[:shared + own]), np.sort(np.r_[x[:shared], x[shared + own:]])
    for shared, own, kept in ((80, 10, True), (400, 50, True), (50, 50, False)):
        pairs = [pair(shared, own) for _ in range(400)]
        _, low = md.signatures([s for p in pairs for s in p])
        on = len(md._kept(low[::2], low[1::2]))
        assert on == 400 if kept else on < 4
        assert all(md._linked(*p) == (shared / (shared + 2 * own) >= 0.8) for p in pairs)
    assert md._linked(np.arange(8, dtype=np.uint64), np.arange(10, dtype=np.uint64))
    assert not md._linked(np.arange(7, dtype=np.uint64), np.arange(9, dtype=np.uint64))
