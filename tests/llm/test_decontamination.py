"""Decontamination against a direct search for every window."""

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from padron.llm.decontamination import decontaminate
from tests.llm.helpers import EDGE, LONG, documents, words

ITEMS = "item_id long, text string"


def brute(docs, items, window=10):
    """n_words, n_hit, items per doc_id; rows of one id lie over one another."""
    total, hit, found = defaultdict(int), defaultdict(set), defaultdict(set)
    for doc_id, text in docs:
        w = words(text)
        total[doc_id] = max(total[doc_id], len(w))
        for item_id, item in items:
            t = words(item)
            n = min(window, len(t))
            wanted = {tuple(t[o:o + n]) for o in range(len(t) - n + 1)} if n else set()
            for o in range(len(w) - n + 1) if n else ():
                if tuple(w[o:o + n]) in wanted:
                    hit[doc_id].update(range(o, o + n))
                    found[doc_id] |= {str(item_id)} if item_id is not None else set()
    return {d: (n, len(hit[d]), len(found[d]),
                hashlib.sha256(",".join(sorted(found[d])).encode()).hexdigest(), bool(hit[d]))
            for d, n in total.items()}


def result(spark, docs, items, **options):
    rows = decontaminate(documents(spark, docs), spark.createDataFrame(items, ITEMS),
                         **options).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: tuple(r)[1:6] for r in rows}


def test_edge_rows(spark):
    items = [(1, "c d e"), (2, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem"),
             (3, None), (4, "..."), (None, "one"), (5, "a B c D e F g H i J k"), (5, "k l m"),
             (6, "À ñ ß"), (7, "à ñ"), (8, "nowhere to be found at all")]
    assert result(spark, EDGE, items) == brute(EDGE, items)


def test_windows_may_start_anywhere_and_overlap(spark):
    item = " ".join(f"w{i}" for i in range(25))
    docs = [(1, "x " + item + " y"), (2, " ".join(item.split()[7:17])),
            (3, " ".join(item.split()[7:16])),
            (4, " ".join(item.split()[:12] + ["z"] + item.split()[12:])),
            (5, item.replace("w12", "v")), (6, item + " " + item)]
    assert result(spark, docs, [(1, item)]) == brute(docs, [(1, item)])


def test_empty_tables(spark):
    assert result(spark, [], [(1, "a b")]) == {}
    docs = [(1, "a b"), (2, None)]
    assert result(spark, docs, []) == brute(docs, [])


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c".split()), max_size=30), min_size=1, max_size=6),
       st.lists(st.lists(st.sampled_from("a b c".split()), max_size=14), min_size=1, max_size=4))
def test_few_words_repeated(spark, docs, items):
    docs = list(enumerate(map(" ".join, docs)))
    items = list(enumerate(map(" ".join, items)))
    assert result(spark, docs, items, window=4) == brute(docs, items, 4)


NEAR = [
    ("alpha x beta x gamma x delta", 1), ("delta gamma beta alpha", 1),
    ("alpha beta gamma", 0), ("alpha beta gamma " + "x " * 17 + "delta", 0),
    ("alpha beta gamma " + "x " * 16 + "delta", 1), (LONG, 0)]


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], ITEMS)
    docs = documents(spark, [(i, text) for i, (text, _) in enumerate(NEAR)])
    found = decontaminate(docs, items).collect()
    assert {r.doc_id: r.n_near for r in found} == {i: n for i, (_, n) in enumerate(NEAR)}
