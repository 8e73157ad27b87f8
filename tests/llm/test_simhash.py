"""SimHash near-dedup against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from padron.llm import simhash
from tests.llm.helpers import EDGE, documents, lower_ascii, white_words


def brute_print(text):
    w = white_words(lower_ascii(text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, radius=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near_texts(n, seed=1):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            w = rng.choice(texts).split()
            if rng.random() < 0.7:
                w[rng.randrange(len(w))] = rng.choice("abc")
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(f"w{rng.randrange(2000)}" for _ in range(rng.randint(1, 120))))
    return texts


def test_fingerprints():
    for text in [None, "", " ", "One", "one two", "ÀB c D", *near_texts(30), "a b " * 40_000]:
        assert simhash.fingerprint(text or "") == brute_print(text)


@pytest.mark.parametrize("parts, take", [(1, 1), (2, 1), (4, 1), (5, 2), (6, 3)])
def test_components(spark, monkeypatch, parts, take):
    monkeypatch.setattr(simhash, "LEAF", 16)  # small leaves, so that there are many shards
    texts = near_texts(250)
    docs = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    out = simhash.near_duplicates(documents(spark, docs), 3, parts, take).collect()
    prints = [brute_print(t) for t in texts]
    roots = brute_roots(prints)
    least = {}
    for r, (d, _) in zip(roots, docs):
        least[r] = min(least.get(r, d), d)
    assert sorted(map(tuple, out)) == sorted(
        (d, f"{p:016x}", least[r]) for (d, _), p, r in zip(docs, prints, roots))
    assert len(set(roots)) < len(set(prints))


def test_pigeonhole_radius():
    rng = random.Random(5)
    for parts, take in ((1, 1), (2, 1), (3, 1), (4, 1), (4, 2), (5, 2), (6, 3)):
        plans = simhash.searches(3, parts, take)
        for _ in range(300):
            x = sum(1 << b for b in rng.sample(range(64), 3))
            assert any((x & mask).bit_count() <= inner for mask, inner in plans)


def test_shard_divides_without_losing_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "BRUTE", 64)
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fps[150:] = fps[:150] ^ (np.uint64(1) << rng.integers(0, 63, 150, dtype=np.uint64))
    forest = simhash.Forest(len(fps))
    every = np.arange(len(fps))
    simhash.join_shard(fps, every, every, (1 << 64) - 1, 3, 3, forest)
    assert forest.parent.tolist() == brute_roots(fps.tolist())


def test_edge_rows_and_empty_table(spark):
    out = simhash.near_duplicates(documents(spark, EDGE)).collect()
    prints = [brute_print(t) for _, t in EDGE]
    roots = brute_roots(prints)
    least = {r: min((d for (d, _), q in zip(EDGE, roots) if q == r and d is not None),
                    default=None) for r in roots}
    assert sorted(map(tuple, out), key=str) == sorted(
        ((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(EDGE, prints, roots)), key=str)
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.node: r.root for r in simhash.components(links).collect()} == {
        i: 0 for i in range(1, 61)} | {}
