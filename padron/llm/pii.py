"""Personal data: candidate spans chosen by gradient-boosted trees.

Base patterns for e-mail, IPv4, card and phone numbers always stand. Around them high-recall
generators propose further, overlapping spans: addresses with spelled-out signs, phone numbers
without a plus, parts of digit runs that were too long as a whole, loose dotted quads. Boosted
trees score each from its format and context; a threshold per kind, calibrated on labelled
examples to a stated precision, selects the redactions, best first and without overlaps.

The trees learn from labelled examples that are made here: valid data of many formats, and
look-alikes (failing checksums, dates, versions, amounts, order numbers), in contexts with and
without telling words. Nothing is learnt from the corpus.

Defined cases: null or empty text has no spans. Rows are searched one by one, repeated ones too.
Only doc_id and text are read. Every pattern runs in time linear in the text.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from padron.llm.boosting import Boosted, boost, precise_threshold
from padron.llm.texts import text_slices
from padron.llm.token_counts import in_worker

KINDS = ("email", "ip", "card", "phone")
#: Share of true spans among the labelled ones that each threshold must reach.
PRECISION = 0.995
#: Labelled examples made for the fit and the thresholds.
EXAMPLES = 6_000
#: Characters of context before a span.
CONTEXT = 24

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
#: Possessive runs: what follows a run is never one of its characters.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+").finditer
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
#: Wider generators. Runs have a bounded length, so a start costs no more than that.
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:[\[({]at[\])}]| at |@) ?"
    r"[A-Za-z0-9-]{1,63}(?: ?(?:[\[({]dot[\])}]| dot |\.) ?[A-Za-z0-9-]{2,63}){1,4}").finditer
LOOSE_PHONE = re.compile(
    r"(?<![0-9A-Za-z+.])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){1,4}(?![0-9])"
).finditer
WORDS = {
    "email": ("mail", "contact", "write", "kontakt", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "adresse", "login"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "amex"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "handy", "telefon"),
}


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def octets(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: a run before it is walked once."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        rest = DOMAIN(text, at + 1) if begin < at else None
        if rest:
            found.append((begin, rest.end()))
            end = rest.end()
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind as listed and then by start."""
    spans = [("email", *s) for s in emails(text)] if "@" in text else []
    if text.count(".") >= 3:
        spans += [("ip", m.start(), m.end()) for m in IP(text) if octets(m[0])]
    for m in CARD(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in PHONE(text)
                  if 9 <= len(digits_of(m[0])) <= 15]
    return spans


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Candidate spans beyond the base patterns."""
    found = []
    if "@" in text or "[at]" in text or "(at)" in text or "{at}" in text or " at " in text:
        found += [("email", m.start(), m.end()) for m in SPELLED(text)]
    for m in CARD(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end())
                  for g in re.finditer("[0-9]+", m[0])]
        for i in range(len(groups)):  # parts of up to four groups
            for j in range(i, min(i + 4, len(groups))):
                a, b = groups[i][0], groups[j][1]
                if 13 <= len(digits_of(text[a:min(b, a + 40)])) <= 19 and b - a <= 40:
                    found.append(("card", a, b))
    found += [("phone", m.start(), m.end()) for m in LOOSE_PHONE(text)
              if 7 <= len(digits_of(m[0])) <= 15]
    return found


def features(kind: str, text: str, start: int, end: int) -> list[float]:
    """Numbers on the format of a span and the text around it."""
    span = text[start:end]
    digits = digits_of(span)
    before = text[max(0, start - CONTEXT):start].lower()
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    after = text[end:end + 1]
    return [
        KINDS.index(kind), end - start, len(digits), len(groups),
        max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0,
        float(len(digits) > 1 and luhn(digits)), float("(" in span), span.count("-"),
        span.count("."), span.count(" "), float(len(set(digits))),
        float("@" in span), float(bool(re.search(r"[\[({](?:at|dot)[\])}]", span))),
        len(span) - len(digits), float(span.startswith("00")),
        float(any(w in before for w in WORDS[kind])),
        float(bool(re.search(r"[A-Za-z0-9.]$", before))),
        float(after.isalnum()), float(bool(re.search(r"[#$%]\s?$|no\.? ?$|nr\.? ?$", before))),
        float(bool(re.fullmatch(r"(?:19|20)\d\d[ .-]\d\d[ .-]\d\d", span)
                   or re.fullmatch(r"\d\d[ .-]\d\d[ .-](?:19|20)?\d\d", span))),
        float(bool(re.fullmatch(r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}", span))),
    ]


def example(rng: np.random.Generator) -> tuple[str, str, int, int, bool]:
    """A labelled span in a made-up context: kind, text, start, end, whether it is personal."""
    def number(n: int) -> str:
        return "".join(str(d) for d in rng.integers(0, 10, n))

    def word(low: int = 3, high: int = 9) -> str:
        return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(low, high)))

    def checked(n: int) -> str:
        body = number(n - 1)
        return next(body + d for d in "0123456789" if luhn(body + d))

    kind, good = KINDS[rng.choice([0, 2, 3])], bool(rng.random() < 0.5)
    dash = str(rng.choice([" ", "-", "."]))
    if kind == "email" and good:
        at, dot = (("[at]", "[dot]"), ("(at)", "(dot)"), (" [at] ", " [dot] "),
                   ("{at}", "{dot}"), (" (at) ", "."))[rng.integers(5)]
        span = f"{word()}{at}{word()}{dot}{('com', 'org', 'net', 'de')[rng.integers(4)]}"
    elif kind == "email":
        span = (f"{word()} at {word()}. {word()}" if rng.random() < 0.7
                else f"{word()} at {word()}.{word()}")
    elif kind == "card":
        size = int(rng.choice([13, 15, 16, 16, 16, 19]))
        digits = checked(size) if good else number(size)
        if not good and luhn(digits):
            digits = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        span = digits if rng.random() < 0.6 else str(rng.choice([" ", "-"])).join(
            digits[i:i + 4] for i in range(0, size, 4))
    elif good:
        span = (f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}",
                f"00{number(2)} {number(3)} {number(7)[:5]} {number(2)}",
                f"{number(3)}{dash}{number(3)}{dash}{number(4)}")[rng.integers(4)]
    else:
        span = (f"20{number(2)}{dash}0{number(1)}{dash}1{number(1)}",
                f"{number(2)}{dash}{number(2)}{dash}20{number(2)}",
                f"{number(4)} {number(4)}", f"{number(5)} {number(2)} {number(3)}",
                f"{number(3)}.{number(3)}.{number(3)}", f"{number(2)} {number(5)}",
                f"555-{number(4)}", f"{number(3)} {number(4)}")[rng.integers(8)]
    telling = rng.random() < (0.5 if good else 0.05)
    lead = str(rng.choice(WORDS[kind])) + ": " if telling else word() + " "
    if not good and rng.random() < 0.2:
        lead = f"{word()} {('#', 'no. ', '$', 'v')[rng.integers(4)]}"
    tail = (" ", ", ", ".", "")[rng.integers(4)] + word()
    if good and not tail[0].isalpha() or not good:
        pass
    else:
        tail = " " + tail
    before = f"{word()} {lead}"
    return kind, f"{before}{span}{tail}", len(before), len(before) + len(span), good


def train(examples: int = EXAMPLES, precision: float = PRECISION,
          seed: int = 11) -> tuple[Boosted, dict[str, float]]:
    """Trees and the threshold of each kind; a third of the examples sets the thresholds."""
    rng = np.random.default_rng(seed)
    rows = [example(rng) for _ in range(examples)]
    table = np.array([features(k, t, a, b) for k, t, a, b, _ in rows], float)
    labels = np.array([r[4] for r in rows], float)
    kinds = np.array([r[0] for r in rows])
    fitted = np.arange(examples) % 3 > 0
    model = boost(table[fitted], labels[fitted])
    scores = model.probabilities(table)
    limits = {}
    for kind in KINDS:
        own = ~fitted & (kinds == kind)
        limits[kind] = precise_threshold(scores[own], labels[own], precision)
    return model, limits


def choose(text: str, base: list[tuple], proposed: list[tuple], scores: np.ndarray,
           limits: dict[str, float]) -> list[tuple[str, int, int]]:
    """Proposed spans over their thresholds, best first, that touch no span chosen before."""
    taken = sorted((a, b) for _, a, b in base)
    chosen = []
    for i in np.lexsort(([p[1] for p in proposed], -scores)):
        kind, a, b = proposed[i]
        if scores[i] >= limits[kind] and all(b <= x or a >= y for x, y in taken):
            chosen.append(proposed[i])
            taken.append((a, b))
    return chosen


def find(texts: list[str], model: Boosted, limits: dict[str, float],
         ) -> list[tuple[list[tuple], list[tuple]]]:
    """Base spans and added spans of each text."""
    base = [base_spans(t) for t in texts]
    proposed = [proposals(t) for t in texts]
    table = [features(k, t, a, b) for t, own in zip(texts, proposed) for k, a, b in own]
    scores = model.probabilities(np.array(table, float)) if table else np.zeros(0)
    out, at = [], 0
    for text, own, more in zip(texts, base, proposed):
        out.append((own, choose(text, own, more, scores[at:at + len(more)], limits)
                    if more else []))
        at += len(more)
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(
        spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b > end:
            out += [text[end:max(a, end)], f"[{kind}]" if a >= end else ""]
            end = b
    return "".join(out) + text[end:]


def find_personal_data(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    with_text adds redacted, the text with all spans replaced.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    trained = train()
    schema = (f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string, n_added long"
              + ", redacted string" * with_text)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, limits = in_worker(("pii",), lambda: trained)
        for batch, texts in text_slices(batches):
            found = find(texts, model, limits)
            columns = [batch.column("doc_id")]
            for kind in KINDS:
                columns.append(pa.array([sum(s[0] == kind for s in b) for b, _ in found],
                                        pa.int64()))
            columns += [
                pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]),
                pa.array([joined(b + m) for b, m in found]),
                pa.array([len(m) for _, m in found], pa.int64())]
            if with_text:
                columns.append(pa.array([redact(t, b + m) for t, (b, m) in zip(texts, found)]))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
