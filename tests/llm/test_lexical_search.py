"""Search in treaps against scores computed one by one."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from padron.llm import lexical_search as lexical
from tests.llm.helpers import EDGE, documents, lower_ascii


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def brute(rows, items, top):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [d for d in docs if d[1]]
    n_docs, length = len(docs), sum(sum(c.values()) for _, c in docs)
    out = []
    for item_id, text in items:
        weight = {}
        for t in set(terms(text)):
            df = sum(t in c for _, c in docs)
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        scores = []
        for doc_id, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // length
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                        for t, w in weight.items() if c[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def found(spark, rows, items, **kw):
    df = spark.createDataFrame(items, "item_id long, text string").selectExpr(
        "*", "1 AS row", "2 AS shard")
    return sorted(map(tuple, lexical.search(documents(spark, rows), df, **kw).select(
        "item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n=300):
    rng = np.random.default_rng(5)
    vocabulary = [f"t{i}" for i in range(400)]
    draw = np.minimum(rng.zipf(1.3, 40 * n), 400) - 1
    rows = [(i, " ".join(vocabulary[w] for w in draw[40 * i:40 * i + 1 + i % 40])) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(80)]  # a group of copies larger than the list
    items = [(i, " ".join(vocabulary[w] for w in rng.integers(0, 400, 25)) + " T0 t1 t1")
             for i in range(12)]
    return rows, [*items, (50, rows[7][1]), (50, None), (51, "nowhere at all"), (None, "t3 É")]


@pytest.mark.parametrize("block_terms", [8_000, 60])
def test_brute_force(spark, monkeypatch, block_terms):
    monkeypatch.setattr(lexical, "SHARD", 64)  # several shards for so few documents
    rows, items = corpus()
    assert found(spark, rows, items, top=20, block_terms=block_terms) == brute(rows, items, 20)


def test_awkward_rows(spark):
    items = [(1, "lorem x a m"), (2, None), (3, ""), (1, "one"), (4, "É 中文 ß")]
    assert found(spark, EDGE, items) == brute(EDGE, items, 50)
    assert found(spark, [], items) == []
    assert found(spark, EDGE, []) == []
    assert found(spark, [(1, None), (2, " ")], items) == []


def test_treap_round_trip():
    rng = np.random.default_rng(1)
    key = np.unique(rng.integers(0, 4096 * 5000, 20_000))
    row, column = key // 4096, key % 4096
    value = rng.integers(1, 1_000_000, len(key))
    stored = lexical.build_treap(row, column, value)
    levels = lexical.read_treap(stored)
    found = dict(zip(zip(levels[0][0].tolist(), levels[0][1].tolist()), levels[0][2].tolist()))
    assert found == dict(zip(zip(row.tolist(), column.tolist()), value.tolist()))
    for level, (r, c, most) in enumerate(levels):
        wanted = {}
        for a, b, v in zip((row >> 3 * level).tolist(), (column >> 3 * level).tolist(), value.tolist()):
            wanted[a, b] = max(v, wanted.get((a, b), 0))
        assert dict(zip(zip(r.tolist(), c.tolist()), most.tolist())) == wanted
    assert lexical.read_treap(lexical.build_treap(*[np.zeros(0, np.int64)] * 3))[0][0].size == 0


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(2)
    block = [(i, f"w{t}") for i in range(6) for t in rng.choice(90, 20, replace=False)]
    rows = lexical.number_terms(block)
    paths = lexical.Paths(block, rows, {r: int(rng.integers(0, 5000)) for r in rows.values()})
    key = np.unique(rng.integers(0, len(rows) * 512, 3000))
    levels = lexical.read_treap(lexical.build_treap(
        key // 512, key % 512, rng.integers(1, 1000, len(key))))
    everyone = np.arange(len(paths.items))
    scores = paths.bounds(0, levels[0], everyone, np.arange(4096))
    for level in range(1, lexical.LEVELS + 1):
        bound = paths.bounds(level, levels[level], everyone, np.arange(4096 >> 3 * level))
        assert (np.repeat(bound, 8 ** level, axis=1) >= scores).all()
