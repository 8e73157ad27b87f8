"""Secret scans: character Markov models of random strings and of ordinary identifiers.

Base patterns (assignments, access keys, hexadecimal runs) always stand. Beyond them, every long
token is scored by the log-likelihood ratio of two models of character pairs, one trained on
labelled random strings and one on labelled ordinary names; tokens whose ratio passes a threshold
are added. The threshold comes from labelled names that the models have not seen: nearly all lie
below it, and a margin is kept.

Random strings are drawn here from the alphabets of keys. Ordinary names are words joined as
identifiers (snake_case, camelCase, paths, with numbers and dates): words usual in programs, and words of
the corpus from a sample of documents of bounded size, those first by a hash of doc_id. The pairs of
all plain words of all texts are counted too, and weigh as much as those of the drawn names.

Defined cases: null or empty text has no spans. Rows are searched one by one, repeated ones too.
Only doc_id and text are read. Every pattern runs in time linear in the text.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.texts import text_slices

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE).finditer
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+").finditer
HEX = re.compile("[0-9a-f]{16,}").finditer
#: Tokens that the models judge. A name has letters and digits or mixed case to be a candidate.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}").finditer
#: Plain words: letters that are no part of a token.
WORD = "(?<![A-Za-z0-9+/_=-])[A-Za-z]{3,19}(?![A-Za-z0-9+/_=-])"
#: Documents whose words are the ordinary sample, and labelled strings of each class.
SAMPLE_DOCS, STRINGS = 1_000, 8_000
#: Share of held-out ordinary strings below the threshold, and what is added to their ratio, in
#: nats a character: names of other corpora score higher than those of the sample.
ORDINARY_SHARE, MARGIN = 0.999, 0.7
#: Words that names in programs are made of; they join the words of the corpus.
NAME_WORDS = (
    "access account action active address admin agent amount array async auth base batch block "
    "body buffer build button byte cache call cell chain change char check child class clean "
    "click client clone close code color column command comment commit common config connect "
    "content context control convert copy count create current cursor customer data date debug "
    "default delete detail device dialog domain draw edit element email empty enable encode entity "
    "error event exception execute export factory field file filter find first flag float folder "
    "format frame function generate global graph group handler hash header height host http icon "
    "image import index info init input insert integer internal invoice item join key label last "
    "layer layout length level library line link list load local lock logger login main manager "
    "mapping match max menu merge message method metric min model module month mouse name network "
    "node notify null number object offset open option order output owner package page panel "
    "parameter parent parse path pattern payment person phone plugin point policy port position "
    "post prefix price print private process product profile project property provider public "
    "query queue random range rate read record region register remove render repository request "
    "reset resource response result retry return role root route row rule sample save scale "
    "schedule schema scope score screen script search second section select sender server service "
    "session setting shape shared signal size sort source space split stack start state static "
    "status step stock storage stream string style submit suffix summary switch symbol sync system "
    "table target task template test text thread time title total trace track transaction "
    "transform tree trigger type unit update upload user util valid value vector version view "
    "wait watch width window word worker wrapper write year zone").split()
HEX_UPPER, ALNUM = "0123456789ABCDEF", (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
ALPHABETS = (ALNUM, ALNUM + "+/", ALNUM + "-_", HEX_UPPER, ALNUM[26:], ALNUM[:26] + ALNUM[52:])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns by start, then kind as listed."""
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN(text)
                  if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS(text)
                  if m.end() - m.start() >= 18]
    spans += [("hex", m.start(), m.end()) for m in HEX(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


@dataclass
class Markov:
    """Log-likelihood ratio of pairs of bytes, random against ordinary."""
    ratio: np.ndarray
    threshold: float = 0.0

    def per_char(self, token: str) -> float:
        data = np.frombuffer(token.encode("ascii", "replace"), np.uint8)
        if len(data) < 2:
            return -np.inf
        return float(self.ratio[data[:-1], data[1:]].mean())


def pair_logs(strings: list[str], pairs: np.ndarray | None = None) -> np.ndarray:
    """Log probability of a character after another, smoothed over the token alphabet.

    pairs: counts of a corpus, scaled to the total of the strings.
    """
    counts = np.full((256, 256), 1e-9)
    used = np.frombuffer((ALNUM + "+/_=-").encode(), np.uint8)
    counts[np.ix_(used, used)] = 0.5
    for s in strings:
        data = np.frombuffer(s.encode("ascii", "replace"), np.uint8)
        np.add.at(counts, (data[:-1], data[1:]), 1)
    if pairs is not None and pairs.sum():
        counts += pairs * (sum(max(0, len(s) - 1) for s in strings) / pairs.sum())
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def random_strings(rng: np.random.Generator, n: int) -> list[str]:
    out = []
    for i in range(n):
        letters = ALPHABETS[i % len(ALPHABETS)]
        out.append("".join(letters[c] for c in rng.integers(0, len(letters),
                                                            rng.integers(20, 65))))
    return out


def ordinary_names(rng: np.random.Generator, words: list[str], n: int) -> list[str]:
    out = []
    for i in range(n):
        some = [words[k] for k in rng.integers(0, len(words), rng.integers(2, 6))]
        number = str(rng.integers(0, 10_000)) if rng.random() < 0.3 else ""
        style = i % 7
        if style == 0:
            out.append("_".join(some) + number)
        elif style == 1:
            out.append(some[0] + "".join(w.capitalize() for w in some[1:]) + number)
        elif style == 2:
            out.append("/".join(some) + number)
        elif style == 3:
            out.append("-".join(some) + number)
        elif style == 4:
            out.append("_".join(some).upper() + number)
        elif style == 5:
            out.append("".join(w.capitalize() for w in some) + number)
        else:
            day = "-".join(f"{x:02d}" for x in (
                rng.integers(1990, 2040), rng.integers(1, 13), rng.integers(1, 32)))
            out.append(f"{day}-{rng.integers(0, 1_000_000)}-{some[0]}" if i % 2
                       else f"{some[0]}-{day}-{day}-{some[1]}")
    return out


def train(words: list[str], strings: int = STRINGS, seed: int = 5,
          pairs: np.ndarray | None = None) -> Markov:
    """Models from labelled strings and the pairs of a corpus; held-out strings set the threshold."""
    rng = np.random.default_rng(seed)
    secret = random_strings(rng, strings)
    plain = ordinary_names(rng, NAME_WORDS, strings)
    if words:
        plain += ordinary_names(rng, words, strings)
    # Every fifth string is held out; the six styles of names are in both parts.
    held = np.arange(len(plain)) % 5 == 0
    model = Markov(pair_logs(secret) - pair_logs([s for s, h in zip(plain, held) if not h] + words, pairs))
    ordinary = [model.per_char(s) for s, h in zip(plain, held) if h and len(s) >= 20]
    model.threshold = float(np.quantile(ordinary, ORDINARY_SHARE)) + MARGIN
    return model


def candidate(token: str) -> bool:
    digits = any("0" <= c <= "9" for c in token)
    letters = any(c.isalpha() for c in token)
    return letters and (digits or not (token.islower() or token.isupper() or token.istitle()))


def find(text: str, model: Markov) -> tuple[list[tuple], list[tuple]]:
    """Base spans and added spans of a text."""
    base, added = base_spans(text), []
    for m in TOKEN(text):
        if candidate(m[0]) and model.per_char(m[0]) >= model.threshold and all(
                m.end() <= a or m.start() >= b for _, a, b in base):
            added.append(("random", m.start(), m.end()))
    return base, added


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(
        spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def sample_words(docs: DataFrame, sample: int = SAMPLE_DOCS) -> list[str]:
    """Plain words of at most `sample` documents, at most 50 a document, first by hash."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample)
    every = F.array_distinct(F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(WORD), 0))
    by_hash = F.array_sort(F.transform(every, lambda w: F.struct(
        F.xxhash64(w).alias("h"), w.alias("w"))))
    words = F.transform(F.slice(by_hash, 1, 50), lambda x: x["w"])
    # `sample` rows at most; words are cut from them where they are read.
    rows = docs.join(F.broadcast(ids), "doc_id", "left_semi").select(
        "doc_id", words.alias("w")).groupBy("doc_id").agg(F.min("w").alias("w")).collect()
    return sorted({w for r in rows for w in r.w})


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How often a character follows another in the plain words of all texts, 256 x 256.

    Each task counts its own; the driver gets one row per pair of letters.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = re.compile(WORD).findall
        counts = np.zeros(1 << 16, np.int64)
        for _, texts in text_slices(batches):
            data = np.frombuffer(" ".join(w for t in texts for w in words(t)).encode(), np.uint8)
            codes = data[:-1].astype(np.int64) * 256 + data[1:]
            counts += np.bincount(codes[(data[:-1] != 32) & (data[1:] != 32)], minlength=1 << 16)
        pairs = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts[pairs])], ["pair", "n"])

    out = np.zeros(1 << 16)
    for r in docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(
            F.sum("n").alias("n")).collect():
        out[r.pair] = r.n
    return out.reshape(256, 256)


def scan_secrets(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added."""
    model = train(sample_words(docs, sample), pairs=pair_counts(docs))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, "
              "spans string, n_added long")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            found = [find(t, model) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *(pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64())
                   for k in BASE),
                 pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]),
                 pa.array([joined(b + m) for b, m in found]),
                 pa.array([len(m) for _, m in found], pa.int64())], names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
