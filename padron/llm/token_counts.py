"""Token counts: lengths of byte-level BPE encodings, computed in Arrow batches.

Texts are cut where the tokenizer's own pre-tokens must end: before each run of white space, and
between a word of letters and the marks behind it. The library encodes the pieces in batches of
bounded size, and their lengths are kept in a bounded memo of the worker, as most pieces are
common words. A piece of any length is encoded whole, so every count is that of the whole text.

Defined cases: a null or empty text has no tokens. Rows are independent: repeated rows and rows
without doc_id are counted one by one. Other columns are not read. The tokenizer must not join
pre-tokens across the start of white space, which holds for the byte-level pattern with optional
leading space; tests compare with whole texts.
"""

import contextlib
import gc
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.texts import text_slices

#: White space of Unicode.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
#: Characters that form pre-tokens of their own after a word of letters.
TAIL = ".,;:!?$%*#&|\"()[]-_/+=<>@"
#: Letters below this one are letters in every version of Unicode that a library may hold.
LAST_LETTER = "\u0530"
#: Pieces in each of the two generations of a worker's memo: at most about 100 MB each.
MEMO_PIECES = 450_000
#: Longer pieces are encoded each time they occur.
MEMO_LENGTH = 60
#: Pieces that the library encodes in one call.
CALL_PIECES = 500

_tokenizers: dict[str, object] = {}
_memos: dict[tuple, object] = {}


def load_tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker; encodes in the calling thread."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def in_worker(key: tuple, make: Callable):
    """An object that outlives a task in its Python worker, until a task asks for another one.

    Only the newest is kept, so that a job of several stages holds one memo at a time.
    """
    if key not in _memos:
        _memos.clear()
        _memos[key] = make()
    return _memos[key]


@contextlib.contextmanager
def no_cycle_search():
    """Many small strings and no cycles: the collector would only walk the memo again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def letters(text: str) -> bool:
    """Whether the text is one pre-token of letters, and stays so in lower case."""
    return text.isalpha() and (
        text.isascii() or (max(text) < LAST_LETTER and text.lower().isalpha()))


class PieceMemo:
    """Values (lengths or ids) of pieces of text, of which two generations are kept.

    split(piece) gives (word, tail) if the piece is a word of letters with marks behind it, whose
    value is the sum of both, and None otherwise. Words are encoded together, as the tokens of a
    call can be told apart by their first or last token; any other piece is encoded alone.
    """

    def __init__(self, split: Callable, encode_words: Callable, encode_any: Callable,
                 pieces: int | None = None):
        self.split, self.encode_words, self.encode_any = split, encode_words, encode_any
        self.pieces = MEMO_PIECES if pieces is None else pieces
        self.young: dict = {}
        self.old: dict = {}

    def _missing(self, pieces: Iterable[str]) -> list[str]:
        """Pieces of unknown value; those known to the older generation move to the younger."""
        young, old, missing = self.young, self.old, []
        for piece in set(pieces).difference(young):
            if (value := old.get(piece)) is not None:
                young[piece] = value
            else:
                missing.append(piece)
        return missing

    def _encode(self, pieces: list[str], encode: Callable) -> None:
        for i in range(0, len(pieces), CALL_PIECES):
            part = pieces[i:i + CALL_PIECES]
            self.young.update(zip(part, encode(part)))

    def learn(self, cut: list[list[str]]) -> list[str]:
        """Makes the values of all pieces known; gives back the new ones."""
        new = self._missing(chain.from_iterable(cut))
        whole, alone, joined = [], [], {}
        for piece in new:
            part = self.split(piece)
            if part is None:
                alone.append(piece)
            elif part[0] == piece:  # a word without marks, which needs no sum
                whole.append(piece)
            else:
                joined[piece] = part
        self._encode(whole, self.encode_words)
        self._encode(alone, self.encode_any)
        self._encode(self._missing(p[0] for p in joined.values()), self.encode_words)
        self._encode(self._missing(p[1] for p in joined.values()), self.encode_any)
        young = self.young
        for piece, (word, tail) in joined.items():
            young[piece] = young[word] + young[tail]
        return new

    def forget(self, new: list[str]) -> None:
        """Bounds the memo once the values of a slice have been used."""
        for piece in new:
            if len(piece) > MEMO_LENGTH:
                self.young.pop(piece, None)
        if len(self.young) > self.pieces:
            self.old, self.young = self.young, {}


def split_spaced(piece: str) -> tuple[str, str] | None:
    """A space and a word of letters, and the marks behind it."""
    word = piece.rstrip(TAIL)
    if word[:1] == " " and letters(word[1:]) and len(piece) <= MEMO_LENGTH:
        return word, piece[len(word):]
    return None


def length_memo(path: str) -> PieceMemo:
    tokenizer = load_tokenizer(path)
    begins = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        begins[i] = token.startswith("\u0120")  # how byte-level vocabularies write a space

    def alone(pieces: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def words(pieces: list[str]) -> list[int]:
        ids = np.array(tokenizer.encode_batch_fast(
            ["".join(pieces)], add_special_tokens=False)[0].ids)
        first = np.flatnonzero(begins[ids])
        if len(first) != len(pieces):
            return alone(pieces)
        return np.diff(np.append(first, len(ids))).tolist()

    return PieceMemo(split_spaced, words, alone)


def token_lengths(texts: list[str], memo: PieceMemo) -> list[int]:
    """Tokens of each text."""
    cut = [PIECES(t) for t in texts]
    new = memo.learn(cut)
    length = memo.young.__getitem__
    counts = [sum(map(length, pieces)) for pieces in cut]
    memo.forget(new)
    return counts


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    The file must be readable at the same path on every executor.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = in_worker(("lengths", tokenizer_path), lambda: length_memo(tokenizer_path))
        for batch, texts in text_slices(batches):
            with no_cycle_search():
                counts = token_lengths(texts, memo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select("doc_id", size.alias("n_bytes"), "text").mapInArrow(
        count, f"doc_id {id_type}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
