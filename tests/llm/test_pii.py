"""Personal data: base patterns against plain regular expressions, added spans by example."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from padron.llm import pii
from tests.llm.helpers import EDGE, documents

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def brute(text):
    text = text or ""
    spans = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    spans += [("ip", *m.span()) for m in re.finditer(IP, text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(CARD, text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in re.finditer(PHONE, text)
              if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return spans


@settings(max_examples=1_500, deadline=None)
@given(st.one_of(
    st.text(st.sampled_from("a1@.-+ ("), max_size=24), st.text(st.sampled_from("12.5 -"), max_size=24),
    st.lists(st.sampled_from(["4111 1111 1111 1111", "4242424242424242", "1.2.3.4", ".", " ", "+",
                              "a@b.c", "@", "x", "300.1.1.1", "+1 (555) 123-4567", "00", "é"]),
             max_size=8).map("".join)))
def test_base_patterns(text):
    assert pii.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", [
    "a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+" * 100_000 + "1", "@" * 100_000,
    "a.b@" * 50_000, "1 " * 100_000, "(1" * 100_000, " at " * 50_000, "12 34 " * 40_000])
def test_linear_time(text):
    pii.base_spans(text)
    pii.proposals(text)


@pytest.fixture(scope="module")
def trained():
    return pii.train()


@pytest.mark.parametrize("text, kinds", [
    ("write to john.doe [at] example [dot] org today", ["email"]),
    ("call 415-555-0132 or (415) 555-0199 now", ["phone", "phone"]),
    ("cards 4242424242424242 4111111111111111 here", ["card", "card"]),
    ("order 4242424242424243 shipped", []), ("on 2024-05-17 and 17.05.2024", []),
    ("we met at noon. then we left at eight", []), ("version 10.2.33 and 1024 768", []),
    ("plain words only", [])])
def test_added_spans(trained, text, kinds):
    (base, added), = pii.find([text], *trained)
    assert sorted(k for k, _, _ in added) == kinds
    assert all(b <= x or a >= y for _, a, b in added for _, x, y in base)


def test_clean_documents_get_no_spans(spark, trained):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    plain = [r.text for r in rows if r.text and not re.search("[0-9@]", r.text)]
    assert len(plain) > 300
    assert all(not b and not m for b, m in pii.find(plain, *trained))


def test_columns_of_edge_rows(spark):
    rows = [*EDGE, (20, "x a@b.cd 10.0.0.1 4242 4242 4242 4242 +1 555 123 4567"), (21, "é a@b.c")]
    out = pii.find_personal_data(documents(spark, rows), with_text=True).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(d) for d, _ in rows)
    texts = dict(rows)
    for r in out:
        base = brute(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(s[0] == k for s in base) for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    assert {r.doc_id: r.redacted for r in out}[20] == "x [email] [ip] [card] [phone]"
    assert pii.find_personal_data(documents(spark, [])).collect() == []


def test_thresholds_reach_their_precision(trained):
    import numpy as np
    model, limits = trained
    rng = np.random.default_rng(99)
    rows = [pii.example(rng) for _ in range(3_000)]
    scores = model.probabilities(np.array([pii.features(*r[:4]) for r in rows], float))
    chosen = [r[4] for r, s in zip(rows, scores) if s >= limits[r[0]]]
    assert np.mean(chosen) > 0.97 and len(chosen) > 0.6 * sum(r[4] for r in rows)
