"""Quality rules: base counts by brute force, verdicts by their bands."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from padron.llm import quality_rules
from padron.llm.queries import PIECE_BPE
from tests.llm.helpers import EDGE, documents, white_words


def brute(text):
    text = text or ""
    w = white_words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1
                for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if white_words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t#|\x0b\x1c\xa0é"), max_size=60))
def test_base_counts(text):
    words = text.encode().split()
    assert quality_rules.base_counts(text, words) == brute(text)


def test_edge_rows(spark):
    out = quality_rules.judge(documents(spark, EDGE), PIECE_BPE).collect()
    assert sorted((str(r.doc_id), *r[1:6]) for r in out) == sorted(
        (str(d), *brute(t)) for d, t in EDGE)
    for r in out:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and (not failed or not r.kept)


def test_empty_table(spark):
    assert quality_rules.judge(documents(spark, []), PIECE_BPE).collect() == []


@pytest.mark.parametrize("text, script", [
    ("", "Latn"), ("abc", "Latn"), ("été", "Latn"), ("привет", "Cyrl"), ("αβγ", "Grek"),
    ("中文中文 a", "Hani"), ("سلام", "Arab"), ("...", "Latn")])
def test_script(text, script):
    assert quality_rules.script_of(text) == script


def test_documents_outside_their_band_go(spark):
    rng = random.Random(1)
    plain = ("the quick brown fox jumps over a lazy dog while other animals look on and wonder why "
             "nobody has ever told them that such things happen only in books for children").split()
    rows = [(i, " ".join(rng.choice(plain) for _ in range(90)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(f"☃{chr(0x2600 + (i + k) % 180)}{k}" for k in range(90)), "en")
             for i in range(5)]
    out = {r.doc_id: r.kept for r in quality_rules.judge(
        documents(spark, rows), PIECE_BPE).collect()}
    assert all(v for d, v in out.items() if d < 1000)
    assert not any(v for d, v in out.items() if d >= 1000)


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    verdicts = quality_rules.judge(spark.read.parquet(f"{sf}/documents.parquet"), PIECE_BPE)
    rows = verdicts.join(labels, "doc_id").filter("NOT base_failed").collect()
    clean, junk = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(junk) <= 0.8 * len(junk)
