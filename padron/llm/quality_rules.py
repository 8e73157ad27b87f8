"""Quality rules from the fertility of a public tokenizer.

Base rules count words, symbols, repeated lines and repeated three-word windows. The method's
verdict rests on what a subword vocabulary makes of the words: characters per token, the share of
tokens that are single bytes because the vocabulary lacks the character, and the entropy of the
tokens as a share of its maximum for the tokens met. Each of the three must lie in a band of the
document's language, and without a language of its script. Bands lie around the medians of all
documents that pass the base rules, some interquartile ranges wide; they are never narrower than
a stated part of the median, so that many copies of one text cannot shut out the others.
Languages with few documents use the band of all.

Defined cases: null or empty text has no words and fails the base rules. Rows are judged one by
one, repeated ones and those without doc_id too. Other columns than text and lang are not read.
"""

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.texts import broadcast_if_small, text_slices
from padron.llm.token_counts import MEMO_LENGTH, in_worker, no_cycle_search
from padron.session import materialise

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
#: Least words, and most repeated words in per cent, of the base rules.
MIN_WORDS, MAX_REPEAT = 50, 50
#: Half the width of a band in interquartile ranges, for texts of FULL_WORDS words or more.
FENCE = 3.0
#: The metrics of shorter texts scatter more: a band widens by the square root of the ratio.
FULL_WORDS = 400
#: Least half-width, as a part of the median and in the metric's own unit.
FLOORS = {"chars_per_token": (0.04, 0.0), "byte_share": (0.0, 0.02), "evenness": (0.08, 0.0)}
#: Languages need so many documents for a band of their own.
MIN_DOCS = 100
#: Words in a worker's memo.
MEMO_WORDS = 400_000
#: First letters of scripts, by code point: Latin, Greek, Cyrillic, Hebrew, Arabic, Indic,
#: Hangul and others, East Asian.
SCRIPTS = [(0x0000, "Latn"), (0x0370, "Grek"), (0x0400, "Cyrl"), (0x0590, "Hebr"),
           (0x0600, "Arab"), (0x0900, "Indic"), (0x1100, "Other"), (0x2E80, "Hani")]
METRICS = list(FLOORS)


def script_of(text: str) -> str:
    """The script of most letters (of the earliest in the list on a tie)."""
    if text.isascii():
        return "Latn"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    of = np.searchsorted([s[0] for s in SCRIPTS], points[points >= 65], side="right") - 1
    return SCRIPTS[int(np.bincount(of, minlength=1).argmax())][1] if len(of) else "Latn"


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, end = Counter(windows), 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


class Vocabulary:
    """A sentencepiece vocabulary with a memo of words in the worker."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.memo: dict[bytes, bytes] = {}

    def learn(self, words: list[list[bytes]]) -> list[bytes]:
        new = [w for w in set(chain.from_iterable(words)) if w not in self.memo]
        coded = self.model.encode([w.decode(errors="replace") for w in new], num_threads=1)
        self.memo.update((w, np.array(ids, np.int32).tobytes()) for w, ids in zip(new, coded))
        return new

    def forget(self, new: list[bytes]) -> None:
        for word in new:
            if len(word) > MEMO_LENGTH:
                del self.memo[word]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()

    def metrics(self, words: list[bytes], chars: int) -> tuple[float, float, float, float]:
        """Characters per token, share of byte tokens, entropy in bits, evenness."""
        ids = np.frombuffer(b"".join(map(self.memo.__getitem__, words)), np.int32)
        if not len(ids):
            return 0.0, 0.0, 0.0, 0.0
        counts = np.bincount(ids)
        counts = counts[counts > 0]
        shares = counts / len(ids)
        entropy = float(-(shares * np.log2(shares)).sum())
        even = entropy / math.log2(len(counts)) if len(counts) > 1 else 0.0
        return chars / len(ids), float(self.is_byte[ids].mean()), entropy, even


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, lang, script, the counts of the base rules, base_failed, the metrics."""
    source = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    id_type = source.schema["doc_id"].dataType.simpleString()
    reals = ["chars_per_token", "byte_share", "token_entropy", "evenness"]
    schema = (f"doc_id {id_type}, lang string, script string, "
              + ", ".join(f"{c} long" for c in COUNTS) + ", "
              + ", ".join(f"{c} double" for c in reals))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = in_worker(("vocabulary", model_path), lambda: Vocabulary(model_path))
        for batch, texts in text_slices(batches):
            with no_cycle_search():
                words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
                new = vocabulary.learn(words)
                counts = [base_counts(t, w) for t, w in zip(texts, words)]
                metrics = [vocabulary.metrics(w, c[1]) for w, c in zip(words, counts)]
                vocabulary.forget(new)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(map(script_of, texts)),
                 *(pa.array(x, pa.int64()) for x in zip(*counts)),
                 *(pa.array(x, pa.float64()) for x in zip(*metrics))],
                ["doc_id", "lang", "script", *COUNTS, *reals])

    return source.mapInArrow(run, schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))


def bands(measured: DataFrame, *keys: str) -> DataFrame:
    """Middle and half-width of each metric per key, from rows that pass the base rules."""
    columns = []
    for m, (part, unit) in FLOORS.items():
        low, middle, high = (F.percentile_approx(m, q, 10_000) for q in (0.25, 0.5, 0.75))
        columns += [middle.alias(f"{m}_mid"),
                    F.greatest(FENCE * (high - low), middle * part, F.lit(unit)).alias(f"{m}_half")]
    return measured.filter("NOT base_failed").groupBy(*keys).agg(
        F.count("*").alias("docs"), *columns)


def judge(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, and the metrics."""
    measured = materialise(
        measure(docs, model_path).withColumn("band", F.coalesce("lang", "script")), "measured")
    of_all = bands(measured).first()
    own = broadcast_if_small(materialise(
        bands(measured, "band").filter(F.col("docs") >= MIN_DOCS), "bands"), 10_000)
    joined = measured.join(own, "band", "left")
    within = F.lit(True)
    wider = F.sqrt(F.greatest(F.lit(1.0), F.lit(FULL_WORDS) / F.greatest("n_words", F.lit(1))))
    for m in METRICS:
        middle, half = (F.coalesce(F.col(f"{m}_{x}"), F.lit(of_all[f"{m}_{x}"]))
                        for x in ("mid", "half"))
        within = within & F.coalesce(F.abs(F.col(m) - middle) <= half * wider, F.lit(True))
    return joined.select("doc_id", *COUNTS, "base_failed",
                         (~F.col("base_failed") & within).alias("kept"),
                         "chars_per_token", "byte_share", "token_entropy", "evenness")
