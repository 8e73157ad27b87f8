"""The clause grammar, its learning, and held-out accuracy."""

import itertools
import random
from pathlib import Path

import pytest

from padron.llm import toxicity as tox
from padron.llm.queries import QUERIES
from padron.llm.transducers import Transducer, compose, tabulate
from tests.llm.helpers import EDGE, documents

READER = tox.Reader(tox.Lexicon({"idiot": 5.0, "grob*": 2.0}))


def written(text):
    words = text.lower().split()
    READER._learn(set(words))
    return [w for w, _ in READER.clause(words)]


@pytest.mark.parametrize("text, expected", [
    ("what an idiot", ["insult"]), ("you are an idiot", ["aimed"]), ("idiot like you", ["insult", "late"]),
    ("that is not an idiot", ["denied"]), ("she said that idiot left", ["reported"]),
    ("he said you are not an idiot", ["reported"]), ("kill it", []), ("kill you", ["late"]),
    ("they will hurt", ["aimed_threat"]), ("you a b c d idiot", ["insult"]),
    ("not a b c d idiot", ["insult"]), ("ein grobian", ["insult"]), ("grober du", ["insult", "late"])])
def test_grammar(text, expected):
    assert written(text) == expected


def test_composition_is_one_machine_after_another():
    one, two, three = tox.negation(), tox.reported_speech(), tox.targets()
    table = tox.grammar()
    whole = tabulate(compose(compose(one, two, tox.KINDS), three, tox.KINDS), tox.KINDS)
    assert whole == table
    draw = random.Random(4)
    for _ in range(300):
        symbols = draw.choices(tox.KINDS, k=12)
        steps = [w for w, _ in one.run(symbols)]
        for machine in (two, three):
            steps = [w for w, _ in machine.run(steps)]
        state, out = 0, []
        for symbol in symbols:
            state, writes, _ = table[state][symbol]
            out.append(writes)
        assert out == steps


def test_weights_add_up_in_composition():
    a, b = Transducer(), Transducer()
    a.arc(0, "x", 1, "y", 0.5)
    a.arc(1, "*", 0, "*", 0.25)
    b.arc(0, "y", 0, "z", 2.0)
    both = compose(a, b, ["x", "w"])
    assert both.run(["x", "w", "x"]) == [("z", 2.5), ("w", 0.25), ("z", 2.5)]


def test_pieces_are_the_text():
    for text in ("", "abc", "a b. c d! " * 50, "x" * 200, "word " * 40):
        parts = list(tox.pieces(text, 30))
        assert "".join(parts) == text
    assert READER.features("Idiot! " * 5).tolist() == READER.features(" idiot.\n" * 5).tolist()
    long = "you idiot, go. " + "plain words here. " * 120_000
    assert READER.features(long)[1] == READER.features("you idiot, go.")[1]


def labelled(spark, n=600):
    rows, labels = [], []
    draw = random.Random(3)
    for i in range(n):
        toxic = i % 6 == 0
        words = [draw.choice("alpha beta gamma delta epsilon zeta eta theta".split())
                 for _ in range(40)]
        if toxic:
            for k in (3, 11, 25):
                words[k] = draw.choice(["blorg", "snurk"]) if i % 12 else "grumpf" + words[k]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr(
        "*", "0 AS quality", "'x' AS text")


def test_learns_words_and_beginnings(spark):
    rows, labels = labelled(spark)
    model = tox.train(documents(spark, rows), labels)
    learned = {f for f, w in model.lexicon.weights.items() if w > 3.5}
    assert {"blorg", "snurk"} <= learned and any(f.startswith("grump") for f in learned)
    assert not {"alpha", "theta", "alph*", "thet*"} & set(model.lexicon.weights)
    out = tox.score_toxicity(documents(spark, rows), labels).collect()
    assert all((r.predicted == 1) == (r.doc_id % 6 == 0) for r in out if r.held_out)
    assert sum(r.held_out for r in out) > 80


def test_awkward_rows(spark):
    rows, labels = labelled(spark, 120)
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 5), (6, 1), (6, 1), (10 ** 9, 1)],
                                "doc_id long, toxic int")
    out = tox.score_toxicity(documents(spark, rows + EDGE),
                             labels.select("doc_id", "toxic").unionByName(odd)).collect()
    assert len(out) == len(rows) + len(EDGE) and all(0 <= r.score <= 1 for r in out)
    assert {r.held_out for r in out if r.doc_id is None} == {False}
    # Without labels the prior decides: one aimed insult is suspicious, two are toxic.
    bare = tox.score_toxicity(documents(spark, [(1, "you idiot. you moron!"), (2, None),
                                                (3, "fine"), (4, "you idiot")]),
                              odd.filter("toxic = 0")).collect()
    score = {r.doc_id: r.score for r in bare}
    assert score[1] > 0.5 > score[4] > 0.3 > score[3] == score[2]
    assert tox.score_toxicity(documents(spark, []), odd).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="driver tables not present")
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES["op12_toxicity"](spark, sf).filter("held_out").join(
        spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    cells = {k: sum((r.toxic, r.predicted) == k for r in out)
             for k in itertools.product((0, 1), (0, 1))}
    assert cells[1, 1] / (cells[1, 0] + cells[1, 1]) > 0.9
    assert cells[0, 1] / (cells[0, 0] + cells[0, 1]) < 0.01
