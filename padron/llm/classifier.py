"""Quality classifier: naive Bayes support vectors over byte n-grams.

A text is the set of its byte n-grams of one to four bytes, hashed to `SLOTS`, and of its word
bigrams of the form "w w", of which only the share counts. Class log-count
ratios of the labelled texts scale the indicators (naive Bayes), texts are brought to length one,
and dual coordinate descent fits a linear hinge-loss model to them. Its margins become
probabilities by a logistic curve, fitted to margins of texts that a first model had not seen.

The fit uses at most `sample` labelled rows, those first by a hash of doc_id; everything it keeps
of them is their n-gram numbers, about 10 KB a row. Scores read every text whole.

Defined cases: labels that are null or neither 0 nor 1 and those without doc_id are left out;
repeated labels, and documents that repeat a doc_id, count once. A null or empty text has no n-grams and gets the
score of the model's constant. Without labels of both classes every score is 0.5. Rows are scored
one by one, repeated ones too. Only doc_id and text are read of the documents.
"""

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.texts import text_slices

#: Size of the hashed set of n-grams.
SLOTS = 1 << 18
#: Labelled rows that the fit uses at most.
SAMPLE = 6_000
#: Predicted 1 from this score on.
THRESHOLD = 0.3
#: Slots for the word bigrams of the form "w w": more than these shares of the words.
DOUBLED = (0.0, 0.05, 0.25)
_CHUNK = 1 << 20
_FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)


def ngrams(text: str, flags: np.ndarray) -> np.ndarray:
    """Slots of the text's n-grams; flags is all False before and after."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    for start in range(0, len(data), _CHUNK):
        part = data[start:start + _CHUNK + 3].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n, factor in enumerate(_FACTORS, 1):
            if len(part) < n:
                break
            code = (code[:len(part) - n + 1] << np.uint32(8)) | part[n - 1:]
            flags[((code + np.uint32(n)) * np.uint32(factor)) >> np.uint32(14)] = True
    words = text.split()
    doubled = sum(map(operator.eq, words, words[1:]))
    for slot, share in enumerate(DOUBLED):
        flags[slot] = doubled > share * len(words)
    found = np.flatnonzero(flags).astype(np.int32)
    flags[found] = False
    return found


@dataclass
class Model:
    ratios: np.ndarray
    weights: np.ndarray
    constant: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, slots: np.ndarray) -> float:
        x = self.ratios[slots]
        length = float(np.sqrt((x * x).sum())) or 1.0
        return float((self.weights[slots] * x).sum()) / length + self.constant

    def score(self, slots: np.ndarray) -> float:
        z = min(max(self.slope * self.margin(slots) + self.shift, -60.0), 60.0)
        return float(1 / (1 + np.exp(-z)))


def log_count_ratios(texts: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.ones((2, SLOTS))
    for slots, label in zip(texts, good):
        counts[int(label), slots] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0]).astype(np.float32)


def descend(texts: list[np.ndarray], good: np.ndarray, cost: float = 1.0, rounds: int = 12,
            seed: int = 7) -> Model:
    """Dual coordinate descent; both classes weigh the same in total."""
    ratios = log_count_ratios(texts, good)
    rows = []
    for slots in texts:
        x = ratios[slots]
        rows.append(x / (float(np.sqrt((x * x).sum())) or 1.0))
    y = np.where(good, 1.0, -1.0)
    bound = cost * len(y) / (2 * np.where(good, good.sum(), (~good).sum()))
    alpha, weights, constant = np.zeros(len(y)), np.zeros(SLOTS, np.float32), 0.0
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(y)):
            slots, x = texts[i], rows[i]
            gradient = y[i] * (float(weights[slots] @ x) + constant) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), bound[i])  # |x|**2 + 1**2 is 2
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights[slots] += np.float32(step) * x
                constant += step
                alpha[i] = new
    return Model(ratios, weights, constant)


def calibrate(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of margins, by Newton steps on smoothed labels."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -60, 60)))
        w, g = p * (1 - p) + 1e-9, p - target
        h = np.array([[(w * margins ** 2).sum() + 1e-6, (w * margins).sum()],
                      [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, [(g * margins).sum(), g.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def fit(texts: list[np.ndarray], good: np.ndarray) -> Model:
    if not len(good) or good.all() or not good.any():
        empty = np.zeros(SLOTS, np.float32)
        return Model(empty, empty, 0.0)
    fold = np.arange(len(good)) % 4 == 0
    model = descend(texts, good)
    if len(set(good[~fold])) == 2 and len(set(good[fold])) == 2:
        first = descend([t for t, out in zip(texts, fold) if not out], good[~fold])
        unseen = np.array([first.margin(t) for t, out in zip(texts, fold) if out])
        model.slope, model.shift = calibrate(unseen, good[fold])
    return model


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; rows of 0 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """At most `sample` rows (slots, good) of labelled documents that are not held out."""
    chosen = labels.filter(
        F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold_of(F.col("doc_id")) != 0)
    ).select(F.col("doc_id").alias("_id"), (F.col(label) == 1).alias("good")).orderBy(
        F.xxhash64("_id"), "_id", "good").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(SLOTS, bool)
        for batch, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("good"),
                 pa.array([ngrams(t, flags).tobytes() for t in texts], pa.binary())],
                ["doc_id", "good", "slots"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen),  # `sample` rows at most
                                               F.col("doc_id") == F.col("_id"))
    # Ids may repeat on both sides; one row of an id and label is taken.
    return texts.select("doc_id", "good", "text").mapInArrow(
        run, f"doc_id {id_type}, good boolean, slots binary").groupBy("doc_id", "good").agg(
        F.min("slots").alias("slots"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality",
          sample: int = SAMPLE) -> Model:
    rows = labelled_sample(docs, labels, label, sample).toPandas().sort_values(
        ["doc_id", "good"], kind="stable")
    return fit([np.frombuffer(s, np.int32) for s in rows["slots"]],
               rows["good"].to_numpy(bool))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality",
             sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, sample))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(SLOTS, bool)
        for batch, texts in text_slices(batches):
            scores = [model.value.score(ngrams(t, flags)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
