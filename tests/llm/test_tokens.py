"""Token counts and token files against the library on whole texts, and exact round trips."""

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from padron.llm import token_counts, token_files
from padron.llm.queries import BYTE_BPE, WORD_BPE
from padron.llm.texts import text_slices
from tests.llm.helpers import EDGE, documents

ODD = (list("ab 'st  \n\t\r\x0b\x0c\x1c\x1f\x85\xa01!?.,ßÖ") + [" ", " ", " ", "　", "᠎",
       "é", "́", "Σ", "İ", "ﬁ", "​", "﻿", "中", "ɐ",
       "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll", "'S", " word", "Größe,", "$$$ ",
       "end.", "a_b. "])


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (BYTE_BPE, WORD_BPE)}


def test_lengths_of_odd_texts(libraries):
    rng, memo = random.Random(3), token_counts.length_memo(BYTE_BPE)
    for _ in range(1_500):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 16)))
        assert token_counts.token_lengths([text], memo) == [
            len(libraries[BYTE_BPE].encode(text, add_special_tokens=False))], repr(text)


def test_ids_of_odd_texts(libraries):
    rng, memo = random.Random(4), token_files.id_memo(WORD_BPE, "uint16")
    for _ in range(1_500):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 16)))
        ids = np.frombuffer(token_files.text_ids([text], memo, b"")[0], "uint16").tolist()
        assert ids == libraries[WORD_BPE].encode(text, add_special_tokens=False).ids, repr(text)


def test_memo_forgets_without_change(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_PIECES", 5)
    memo = token_counts.length_memo(BYTE_BPE)
    texts = [f"word{i % 7} and more, of {i % 5} kinds" for i in range(40)]
    once = token_counts.token_lengths(texts, token_counts.length_memo(BYTE_BPE))
    assert [token_counts.token_lengths([t], memo)[0] for t in texts] == once


def test_ids_of_words_by_the_model_alone(libraries):
    memo, rng = token_files.id_memo(WORD_BPE, "uint16"), random.Random(5)
    letters = [chr(i) for i in range(0x41, 0x530) if chr(i).isalpha()]
    for word in [*letters, *("".join(rng.choices(letters, k=5)) for _ in range(2_000))]:
        ids = np.frombuffer(token_files.text_ids([word], memo, b"")[0], "uint16").tolist()
        assert ids == libraries[WORD_BPE].encode(word, add_special_tokens=False).ids, repr(word)


def test_ids_ask_once_for_a_repeated_piece(libraries):
    memo, asked = token_files.id_memo(WORD_BPE, "uint16"), []
    learn = memo.learn

    def counted(cut):
        asked.extend(p for pieces in cut for p in pieces)
        return learn(cut)

    memo.learn = counted
    texts = ["same words, again and again " * 500, "", "again, same"]
    ids = [np.frombuffer(x, "uint16").tolist() for x in token_files.text_ids(texts, memo, b"")]
    assert ids == [libraries[WORD_BPE].encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) == len(set(asked)) < 10


def test_memo_of_ids_is_smaller_and_bounded(monkeypatch, libraries):
    monkeypatch.setattr(token_files, "MEMO_IDS", 5)
    memo = token_files.id_memo(WORD_BPE, "uint16")
    for i in range(40):
        text = f"word{i % 7} and more, of {i % 5} kinds"
        ids = np.frombuffer(token_files.text_ids([text], memo, b"")[0], "uint16").tolist()
        assert ids == libraries[WORD_BPE].encode(text, add_special_tokens=False).ids
        assert len(memo.young) <= 5
    assert token_files.MEMO_IDS < token_counts.MEMO_PIECES


def test_only_one_slice_of_a_batch_is_strings():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([None] + [chr(97 + i % 26) * 100_000 for i in range(60)])], ["text"])
    tracemalloc.start()
    n = sum(len(t) for _, part in text_slices([batch], limit=200_000) for t in part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 6_000_000 and peak < 1_500_000


def test_counts_of_edge_rows(spark, libraries):
    out = token_counts.count_tokens(documents(spark, EDGE), BYTE_BPE, limit=12).collect()
    expected = []
    for doc_id, text in EDGE:
        n = len(libraries[BYTE_BPE].encode(text or "", add_special_tokens=False))
        expected.append((doc_id, len((text or "").encode()), n, n > 12))
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
    assert token_counts.count_tokens(documents(spark, []), BYTE_BPE).collect() == []


def test_file_of_edge_rows(spark, libraries, tmp_path):
    path = str(tmp_path / "file")
    token_files.write_token_file(documents(spark, EDGE), WORD_BPE, path)
    out = sorted(token_files.token_digests(spark, path).collect(), key=lambda r: r.start)
    ids = [(d, [*libraries[WORD_BPE].encode(t or "", add_special_tokens=False).ids, 1])
           for d, t in EDGE]
    start = 0
    for row in out:
        known = [i for d, i in ids if d == row.doc_id and len(i) == row.n_tokens
                 and zlib.crc32(np.array(i, "<u4").tobytes()) == row.ids_crc32]
        assert known and row.start == start
        start += row.n_tokens
    assert [r.doc_id for r in out] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8]


def test_file_of_no_documents(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_file(documents(spark, []), WORD_BPE, path)
    assert token_files.token_digests(spark, path).collect() == []


def test_read_back_ids(spark, libraries, tmp_path):
    path = str(tmp_path / "ids")
    docs = [(i, f"Some text, number {i}! " * (i % 50)) for i in range(120)]
    token_files.write_token_file(documents(spark, docs), WORD_BPE, path)
    out = token_files.decode_blocks(spark, path, "ids array<int>", lambda _, ids: (ids.tolist(),))
    assert {r.doc_id: r.ids for r in out.collect()} == {
        d: [*libraries[WORD_BPE].encode(t, add_special_tokens=False).ids, 1] for d, t in docs}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10 ** 9), min_size=2, max_size=60), st.integers(6, 18))
def test_code_is_complete_and_limited(counts, limit):
    lengths = token_files.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit
    assert sum(2.0 ** -int(n) for n in lengths) == 1.0
    order = np.argsort(counts, kind="stable")
    assert (np.diff(lengths[order]) <= 0).all()


def test_code_is_as_short_as_huffman():
    import heapq
    counts = np.random.default_rng(2).zipf(1.3, 300).clip(1, 10 ** 6)
    heap = sorted(counts.tolist())
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (token_files.code_lengths(counts, 24) * counts).sum() == cost


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=700), min_size=1, max_size=6))
def test_bits_round_trip(docs):
    ids = np.concatenate([np.array(d) for d in docs])
    counts = np.array([len(d) for d in docs])
    met, n = np.unique(ids, return_counts=True)
    codes, bits = token_files.canonical_codes(met, token_files.code_lengths(n))
    words, first, offsets = token_files.encode_ids(ids, counts, codes, bits)
    begin = np.cumsum(counts) - counts
    lanes, sizes = [], []
    for b, k in zip(begin, counts):
        at = np.arange(b, b + k, token_files.CHECKPOINT)
        lanes += offsets[at].tolist()
        sizes += np.minimum(token_files.CHECKPOINT, b + k - at).tolist()
    table = token_files.decoding_table(codes, bits)
    assert (token_files.decode_words(words, np.array(lanes), np.array(sizes), table) == ids).all()


def test_paths_are_those_of_the_package():
    assert BYTE_BPE == public_tokenizers.path("byte_bpe_50k.json")
