"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer reads the words of a text and writes their kind: an insult with its weight, a
threat, a target (a person spoken to or of), a negation, a verb of speech, or a plain word. Three
transducers follow it, composed into one machine that goes through each clause once:

- negation: an insult within a few words behind a negation becomes a `denied` one;
- reported speech: behind a verb of speech the rest of the clause is `reported`;
- target: an insult or threat near a target becomes an `aimed` one, whichever comes first.

A clause scores the sum of its matched words' weights times the weight of what the machine wrote
about them; isolated words count for little beside aimed ones. A logistic model of the logarithms
of these sums, and of their share in the text, gives the score.

Insults are learned from labels: words and beginnings of words that are more frequent in toxic
texts, by a likelihood ratio test on the documents that hold them once, or twice. The weight of an
insult is the logarithm of the ratio of both rates. The words listed below are known beforehand,
with a weight that the labels override. The lexicon for calibration comes from other rows than
those that the logistic model is fitted to; a Gaussian prior keeps its weights sensible for what
the labels do not show.

The fit uses at most `sample` labelled rows, those first by a hash of doc_id. Scores read every
text whole, in pieces cut where clauses or else words end.

Defined cases: labels that are null or neither 0 nor 1 and those without doc_id are left out;
repeated labels, and documents that repeat a doc_id, are rows of the fit like others. A null or
empty text has no words and gets the score of the model's constant. Without labels of both classes
the words known beforehand and the prior decide. Rows are scored one by one, repeated ones too.
Only doc_id and text are read of the documents.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.classifier import fold_of
from padron.llm.texts import text_slices
from padron.llm.transducers import Transducer, compose, tabulate

#: Labelled rows that the fit uses at most.
SAMPLE = 8_000
#: Predicted 1 from this score on.
THRESHOLD = 0.5
#: Learned words and beginnings at most, those of the highest test value.
LEXICON = 5_000
#: Least value of the likelihood ratio test, and least number of toxic documents with the word.
EVIDENCE, MIN_TOXIC = 24.0, 4
#: Lengths of the beginnings that stand for all words that start so.
BEGINNINGS = range(4, 9)
#: Words over which a negation or a target reaches.
REACH = 4

# Words known beforehand, in English, German, French and Spanish.
INSULTS = set("""idiot moron imbecile stupid scum worthless pathetic disgusting
    trottel abschaum wertlos erbärmlich imbécile débile ordure minable
    idiota imbécil estúpido patético inútil""".split())
THREATS = set("""kill hurt destroy shoot stab crush töten umbringen erschießen zerstören
    tuer frapper détruire matar golpear destruir""".split())
TARGETS = set("""you your yours yourself he him his she her they them their
    du dich dir dein deine ihr euch euer sie
    tu toi ton vous votre ils elles tú ti usted ustedes vosotros ellos ellas""".split())
NEGATIONS = set("""not no never without isn aren wasn weren don doesn nicht kein keine nie
    ne pas jamais aucun sans nunca jamás sin""".split())
SPEECH = set("""said says wrote writes called claimed quoted sagte schrieb nannte zitierte
    dit écrit appelé dijo escribió llamó""".split())
#: Weight of a known insult, and of a threat.
KNOWN, THREAT_WEIGHT = 3.0, 1.5
#: Documents with a known word from which the labels alone give its weight.
OVERRULED = 20
MOST_WEIGHT = 8.0

KINDS = ["word", "insult", "threat", "target", "not", "speech"]
#: What the machine writes about insults and threats.
MATCHES = ["insult", "aimed", "denied", "reported", "aimed_threat", "late"]
#: Prior means of the logistic model: MATCHES, share of the text, constant.
PRIOR = np.array([1.0, 1.5, 0.3, 0.3, 1.0, 0.3, 0.3, -3.0])
PRECISION = 0.5

_WORDS = re.compile(r"[^\W\d_]+").findall
_CLAUSES = re.compile(r"[.!?;:\n…]+").split
_END = re.compile(r"[.!?;:\n…\s]")
_PIECE = 1_000_000
#: Words whose kind a task remembers at most, and forms that it counts before it hands them on.
_MEMO = 300_000
#: Counts of a form: documents with it, with it twice, and occurrences; toxic and clean.
COUNTS = ("d1", "d0", "t1", "t0", "o1", "o0")


# -- grammar ------------------------------------------------------------------------------------

def negation(reach: int = REACH) -> Transducer:
    machine = Transducer(0)
    for left in range(reach + 1):
        machine.arc(left, "not", reach)
        machine.arc(left, "*", max(0, left - 1))
        if left:
            machine.arc(left, "insult", left - 1, "denied")
    return machine


def reported_speech() -> Transducer:
    machine = Transducer("own")
    machine.arc("own", "speech", "others")
    for symbol in ("insult", "denied", "threat"):
        machine.arc("others", symbol, "others", "reported")
    return machine


def targets(reach: int = REACH) -> Transducer:
    """States: ("near", k) so many words behind a target, ("wait", k) behind an insult without."""
    machine = Transducer(("near", 0))
    for left in range(reach + 1):
        near, less = ("near", left), ("near", max(0, left - 1))
        machine.arc(near, "target", ("near", reach))
        machine.arc(near, "*", less)
        if left:
            machine.arc(near, "insult", less, "aimed")
            machine.arc(near, "threat", less, "aimed_threat")
        else:
            for symbol in ("insult", "threat"):
                machine.arc(near, symbol, ("wait", reach))
    for left in range(1, reach + 1):
        wait, less = ("wait", left), ("wait", left - 1) if left > 1 else ("near", 0)
        machine.arc(wait, "target", ("near", reach), "late")
        machine.arc(wait, "*", less)
        for symbol in ("insult", "threat"):
            machine.arc(wait, symbol, ("wait", reach))
    return machine


def grammar() -> list[dict[str, tuple[int, str, float]]]:
    """The table of the composed machine; a clause begins in state 0."""
    spoken = compose(negation(), reported_speech(), KINDS)
    return tabulate(compose(spoken, targets(), KINDS), KINDS)


@dataclass
class Lexicon:
    """Weights of insulting words, and of beginnings of words (written with a star)."""

    weights: dict[str, float]

    def weight(self, word: str) -> float:
        """Weight of the word itself, or else of its longest beginning that has one."""
        found = self.weights.get(word)
        if found is None:
            for length in reversed(BEGINNINGS):
                if len(word) >= length and (found := self.weights.get(word[:length] + "*")):
                    break
        return found or 0.0

    def kind(self, word: str) -> tuple[str, float]:
        if (weight := self.weight(word)) > 0:
            return "insult", weight
        if word in THREATS:
            return "threat", THREAT_WEIGHT
        kind = ("target" if word in TARGETS else "not" if word in NEGATIONS
                else "speech" if word in SPEECH else "word")
        return kind, 0.0


def pieces(text: str, size: int = _PIECE) -> Iterator[str]:
    """The whole text in pieces, each cut at the first end of a clause or word beyond the size."""
    start = 0
    while start < len(text):
        end = _END.search(text, start + size)
        stop = end.end() if end else len(text)
        yield text[start:stop]
        start = stop


class Reader:
    """Goes through texts with a lexicon; remembers the kinds of words in a bounded memo."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.table = lexicon, grammar()
        self.kinds: dict[str, tuple[str, float]] = {}

    def _learn(self, words: set[str]) -> bool:
        """Makes the kinds of the words known; whether an insult or threat is among them."""
        if len(self.kinds) > _MEMO:
            self.kinds.clear()
        kinds, hot = self.kinds, False
        for word in words:
            found = kinds.get(word)
            if found is None:
                found = kinds[word] = self.lexicon.kind(word)
            hot = hot or found[1] > 0
        return hot

    def clause(self, words: list[str]) -> list[tuple[str, float]]:
        """What the machine writes about the insults and threats of a clause, with weights."""
        state, matches, last = 0, [], 0.0
        for word in words:
            kind, weight = self.kinds[word]
            state, writes, gain = self.table[state][kind]
            if weight:
                last = weight
                if writes != "threat":
                    matches.append((writes, weight * math.exp(gain)))
            elif writes == "late":
                matches.append((writes, last))
        return matches

    def features(self, text: str) -> np.ndarray:
        sums, n = dict.fromkeys(MATCHES, 0.0), 0
        for piece in pieces(text.lower()):
            words = _WORDS(piece)
            n += len(words)
            if not self._learn(set(words)):
                continue
            for clause in _CLAUSES(piece):
                words = _WORDS(clause)
                if any(self.kinds[w][1] for w in words):
                    for writes, weight in self.clause(words):
                        sums[writes] += weight
        whole = sum(sums[m] for m in MATCHES if m != "late")
        return np.log1p([*(sums[m] for m in MATCHES), 100 * whole / max(n, 20), math.e - 1])


# -- learning -----------------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """doc_id, text, toxic and fold of labelled rows that are not held out, by at most `sample`
    labels."""
    usable = F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold_of(F.col("doc_id")) != 0)
    chosen = labels.filter(usable).select(
        F.col("doc_id").alias("_id"), (F.col(label) == 1).alias("toxic")).orderBy(
        F.xxhash64("_id"), "_id", "toxic").limit(sample)
    return docs.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select(  # `sample` rows at most
        "text", "toxic", fold_of(F.col("doc_id")).alias("fold"))


def _log_likelihood(hits: tuple[Column, Column], sizes: tuple[Column, Column]) -> Column:
    """Twice the log-likelihood ratio of two rates against one common rate."""
    common = (hits[0] + hits[1]) / (sizes[0] + sizes[1])
    parts = [F.when(h > 0, h * F.log(h / s / common)).otherwise(0.0)
             for h, s in zip(hits, sizes)]
    return 2 * (parts[0] + parts[1])


def forms_of(text: str) -> Counter:
    """Occurrences of each word of a text, and of each beginning of its words."""
    forms = Counter()
    for piece in pieces(text.lower()):
        for word, tf in Counter(_WORDS(piece)).items():
            forms[word] += tf
            for length in BEGINNINGS:
                if len(word) < length:
                    break
                forms[word[:length] + "*"] += tf
    return forms


def form_counts(rows: DataFrame) -> DataFrame:
    """form and its COUNTS; a text counts up to five occurrences, so that no repetitive one decides.
    """
    def batch_of(held: dict[str, list[int]]) -> pa.RecordBatch:
        columns = zip(*held.values()) if held else [()] * len(COUNTS)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
            ["form", *COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        for batch, texts in text_slices(batches):
            for toxic, text in zip(batch.column("toxic").to_pylist(), texts):
                at = 0 if toxic else 1
                for form, tf in forms_of(text).items():
                    counts = held.setdefault(form, [0] * len(COUNTS))
                    counts[at] += 1
                    counts[2 + at] += tf > 1
                    counts[4 + at] += min(tf, 5)
                if len(held) > _MEMO:
                    yield batch_of(held)
                    held = {}
        yield batch_of(held)

    kinds = ", ".join(f"{c} long" for c in COUNTS)
    partial = rows.select("text", "toxic").mapInArrow(run, f"form string, {kinds}")
    return partial.groupBy("form").agg(*[F.sum(c).alias(c) for c in COUNTS])


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Counts of words and beginnings over all rows, in Spark; only telling ones are collected."""
    sizes = rows.agg(F.count_if("toxic").alias("toxic"),
                     F.count_if(~F.col("toxic")).alias("clean")).first()
    weights = dict.fromkeys(INSULTS, KNOWN)
    if not sizes.toxic or not sizes.clean:
        return Lexicon(weights)
    counts = form_counts(rows)
    size = F.lit(float(sizes.toxic)), F.lit(float(sizes.clean))
    once, twice = (_log_likelihood((F.col(a), F.col(b)), size)
                   for a, b in (("d1", "d0"), ("t1", "t0")))
    weight = F.log((F.col("o1") + 0.1) / size[0] / ((F.col("o0") + 0.5) / size[1]))
    known = F.col("form").isin(sorted(INSULTS)) & (F.col("d1") + F.col("d0") >= OVERRULED)
    telling = (F.col("d1") >= MIN_TOXIC) & (F.greatest(once, twice) >= EVIDENCE) & (
        weight > math.log(2))
    found = counts.select("form", weight.alias("weight"), F.greatest(once, twice).alias("value"),
                          telling.alias("telling"), known.alias("known"), "d1", "d0").filter(
        "telling OR known").orderBy(F.desc("value"), "form").limit(LEXICON).collect()
    for r in without_repeats(found):
        weights[r.form] = min(MOST_WEIGHT, r.weight) if r.telling else 0.0
    return Lexicon(weights)


def without_repeats(forms: list) -> list:
    """Leaves out a beginning if a longer form stands in as many texts, and so in the same ones."""
    longer = set()
    for r in forms:
        stem = r.form.removesuffix("*")
        for n in range(BEGINNINGS.start, len(stem) + (stem == r.form)):
            longer.add((stem[:n] + "*", r.d1, r.d0))
    return [r for r in forms if (r.form, r.d1, r.d0) not in longer]


def features_of(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the rows of the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([reader.features(t).tolist() for t in texts],
                                                 pa.list_(pa.float64()))], ["toxic", "x"])

    found = rows.select("text", "toxic").mapInArrow(run, "toxic boolean, x array<double>").collect()
    return (np.array([r.x for r in found]).reshape(len(found), len(PRIOR)),
            np.array([r.toxic for r in found], float))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of highest posterior density, by Newton steps from the prior means."""
    w = PRIOR.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + PRECISION * (w - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + PRECISION * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, features: np.ndarray) -> float:
        z = float(features @ self.weights)
        return 1 / (1 + math.exp(-min(max(z, -60.0), 60.0)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic",
          sample: int = SAMPLE) -> Model:
    rows = labelled_sample(docs, labels, label, sample)
    x, y = features_of(rows.filter("fold = 4"), learn_lexicon(rows.filter("fold <> 4")))
    return Model(learn_lexicon(rows), fit_logistic(x, y))


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic",
                   sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, sample))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.value.lexicon)
        for batch, texts in text_slices(batches):
            scores = [model.value.score(reader.features(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
