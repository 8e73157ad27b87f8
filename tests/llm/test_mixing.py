"""Mixing: complete, in order, and less than a block away from the targets."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from padron.llm import mixing
from tests.llm.helpers import EDGE, documents


def parts_of(spark, weights, resolution):
    df = spark.createDataFrame(list(weights.items()), "key string, weight double")
    return {r.key: r.parts for r in mixing.shares(df, resolution).collect()}


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3),
                       st.floats(0.01, 100), min_size=1, max_size=8))
def test_every_prefix_is_within_a_block(spark, weights):
    resolution = 64
    parts = parts_of(spark, weights, resolution)
    assert sum(parts.values()) == resolution and min(parts.values()) >= 1
    df = spark.createDataFrame(list(parts.items()), "key string, parts long")
    rows = sorted(mixing.period(df, resolution).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(resolution))
    seen = Counter()
    for t, row in enumerate(rows, 1):
        assert row.turn == seen[row.key]
        seen[row.key] += 1
        assert all(abs(seen[k] - p * t / resolution) < 1 for k, p in parts.items())


def test_all_documents_once_and_sources_in_order(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 7 % 3}") for i in range(500)] + [
        (1000 + i, "u", "en", None) for i in range(40)]
    out = mixing.mix(documents(spark, rows), block=4, resolution=100).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    for source in {r[3] for r in rows}:
        own = sorted((r for r in out if r.source == source), key=lambda r: (r.slot, r.place))
        assert [r.doc_id for r in own] == sorted(r[0] for r in rows if r[3] == source)
    blocks = {}
    for r in out:
        assert blocks.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    sizes = Counter(r.slot for r in out)
    assert max(sizes.values()) == 4


def test_blocks_follow_targets_until_a_source_ends(spark):
    rows = [(i, "t", "en", "ab"[i % 2]) for i in range(400)]
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    out = mixing.mix(documents(spark, rows), weights, block=1, resolution=40).collect()
    order = [r.source for r in sorted(out, key=lambda r: (r.slot, r.place))]
    for t in range(1, 260):
        assert abs(order[:t].count("a") - 0.75 * t) < 1
    assert order.count("b") == 200


def test_edge_rows_and_empty_table(spark):
    out = mixing.mix(documents(spark, EDGE)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in EDGE)
    assert len({(r.slot, r.place) for r in out}) == len(EDGE)
    assert mixing.mix(documents(spark, [])).collect() == []


def test_weights_must_cover_and_be_positive(spark):
    docs = documents(spark, [(1, "a", "en", "x"), (2, "b", "en", "y")])
    schema = "source string, weight double"
    with pytest.raises(ValueError, match="no weight"):
        mixing.mix(docs, spark.createDataFrame([("x", 1.0)], schema))
    with pytest.raises(ValueError, match="positive"):
        mixing.mix(docs, spark.createDataFrame([("x", 1.0), ("y", 0.0)], schema))
    with pytest.raises(ValueError, match="resolution"):
        mixing.mix(docs, resolution=4)


def test_many_sources_lengthen_the_period(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RESOLUTION", 10)
    rows = [(i, "t", "en", f"s{i % 9}") for i in range(90)]
    out = mixing.mix(documents(spark, rows), block=1).collect()
    assert sorted(r.doc_id for r in out) == list(range(90))
    assert {r.parts for r in out} <= {4, 5} and len({r.slot for r in out}) == 90
