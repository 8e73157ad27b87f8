"""Token ids in binary blocks: canonical, length-limited Huffman coding.

A token file is a folder of two tables. `codebook` has the code length of every id that occurs;
canonical codes follow from the lengths. `blocks` has independent blocks of neighbouring
documents: payload (each document's bits, padded to 32), doc_ids, doc_tokens, and checkpoints,
the bit offsets of every `CHECKPOINT`-th token, so that decoding can start there. Blocks lie in
parts, ranges of the order asked for, and know how many tokens of their part come before them.

Defined cases: a null or empty text has only the end id. Null ids come first, equal ids follow by
their tokens; every row is a document of its own. No documents give an empty codebook and no
blocks. Other columns are not read.
"""

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from padron.llm.token_counts import (
    MEMO_LENGTH, TAIL, PieceMemo, in_worker, letters, load_tokenizer,
    no_cycle_search)
from padron.llm.texts import SLICE_BYTES, text_slices
from padron.session import new_folder

#: Longest code in bits; with so many bits a decoding table has 2**18 entries.
MAX_BITS = 18
#: Tokens between two checkpoints of a document.
CHECKPOINT = 128
#: A mark behind a letter or digit and before white space is a pre-token of its own.
SET_APART = re.compile(r"[.,;:!?](?<=[^\W_].)(?=\s)").sub
#: A block is closed at so many tokens; it ends with a whole document.
BLOCK_TOKENS = 131_072
#: Pieces in each generation of a worker's memo, about 60 MB: ids take more than lengths,
#: and the pipeline's executors come to this stage with a full heap.
MEMO_IDS = 250_000
#: Ids that one call counts.
COUNTED = 1 << 20


# -- tokens ------------------------------------------------------------------------------------

def split_word(piece: str) -> tuple[str, str] | None:
    """A word of letters, in lower case if that is plain, and the marks behind it."""
    word = piece.rstrip(TAIL)
    if letters(word) and len(piece) <= MEMO_LENGTH:
        return word.lower() if word.isascii() else word, piece[len(word):]
    return None


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write each byte: printable ones as they are."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


def id_memo(path: str, dtype: str) -> PieceMemo:
    """Words go to the library's model, as they are their own pre-tokens; anything else, and words
    that its normalizer could change, goes through the whole tokenizer."""
    tokenizer = load_tokenizer(path)
    model, letter = tokenizer.model, byte_letters()
    code = np.dtype(dtype).char

    def alone(pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype).tobytes() for e in tokenizer.encode_batch_fast(
            pieces, add_special_tokens=False)]

    def direct(word: str) -> bytes:
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(letter)
        return array(code, [t.id for t in model.tokenize(spelt)]).tobytes()

    def is_plain(word: str) -> bool:
        return word == word.lower() and unicodedata.is_normalized("NFC", word)

    # Tokenizers that spell or cut words in another way are not asked for words alone.
    known = ["direct", "voilà", "größer", "самый"]
    if [direct(w) for w in known] != alone(known):
        return PieceMemo(split_word, alone, alone, MEMO_IDS)

    def words(pieces: list[str]) -> list[bytes]:
        return [direct(w) if is_plain(w) else alone([w])[0] for w in pieces]

    return PieceMemo(split_word, words, alone, MEMO_IDS)


def plain(text: str) -> str:
    """The text with the same ids, but with fewer different pieces between its spaces.

    Letters are lower-cased, as the tokenizer does, and a mark between a letter or digit and
    white space is set apart. Texts where lower case could differ from the tokenizer's (special
    tokens, letters whose lower case depends on others, decomposed letters) stay as they are.
    """
    if "<|" in text or "\u03a3" in text or not unicodedata.is_normalized("NFC", text):
        return text.replace("\n", " ")
    return SET_APART(r" \g<0>", text.lower()).replace("\n", " ")


def text_ids(texts: list[str], memo: PieceMemo, end: bytes) -> list[bytes]:
    """Ids of each text as bytes, with the end id.

    The tokenizer must drop white space, lower-case and never join across white space or between
    letters and marks, as this word BPE does: then a text's ids are those of its pieces. Arrow cuts
    the texts and puts the ids together; only the different pieces of a call become strings.
    """
    cut = pc.split_pattern(pa.array(map(plain, texts), pa.string()), " ")
    coded = cut.flatten().dictionary_encode()
    pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    new = memo.learn([pieces])
    ids = pa.array(list(map(memo.young.__getitem__, pieces)), pa.binary()).take(coded.indices)
    memo.forget(new)
    _, offsets, data = ids.buffers()
    data = data.to_pybytes() if data else b""
    at = np.frombuffer(offsets, np.int32)[cut.offsets.to_numpy()].tolist()
    return [data[a:b] + end for a, b in zip(at, at[1:])]


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, dtype: str,
             order: tuple[str, ...]) -> DataFrame:
    """Per document: doc_id, the order columns, ids (numbers of `dtype` as binary)."""
    kept = list(dict.fromkeys(["doc_id", *order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = in_worker(("ids", tokenizer_path, dtype), lambda: id_memo(tokenizer_path, dtype))
        end = np.array([end_id], dtype).tobytes()
        # Fewer, larger slices: each asks the memo once for a piece that repeats in it.
        for batch, texts in text_slices(batches, limit=2 * SLICE_BYTES):
            with no_cycle_search():
                coded = text_ids(texts, memo, end)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(coded, pa.binary())], [*kept, "ids"])

    source = docs.select(*kept, "text")
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in kept)
    return source.mapInArrow(run, f"{fields}, ids binary")


def count_ids(tokens: DataFrame, dtype: str) -> DataFrame:
    """Occurrences of every id; each task sends one row per id it has met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_worker(("counts",), dict)  # lets go of the memo that the stage before left here
        total = np.zeros(0, np.int64)
        for batch in batches:
            # Neighbouring documents are counted together, in runs that stay small in memory.
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype)
            for i in range(0, len(ids), COUNTED):
                counts = np.bincount(ids[i:i + COUNTED])
                if len(counts) > len(total):
                    total = np.pad(total, (0, len(counts) - len(total)))
                total[:len(counts)] += counts
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), pa.array(total[met])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))


# -- code --------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with none over `max_bits`, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit in codes of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        weights = np.concatenate([leaves, packages])
        place = np.argsort(weights, kind="stable")
        levels.append(place < n)
        merged = weights[place]
        pairs = len(merged) // 2
        packages = merged[0:2 * pairs:2] + merged[1:2 * pairs:2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        leaves_in = int(is_leaf[:take].sum())
        lengths[order[:leaves_in]] += 1
        take = 2 * (take - leaves_in)
    return lengths


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths by id: shorter first, equal lengths by id."""
    top = int(ids.max()) + 1 if len(ids) else 0
    codes, bits = np.zeros(top, np.uint64), np.zeros(top, np.int64)
    code = last = 0
    for i in np.lexsort((ids, lengths)):
        code <<= int(lengths[i]) - last
        codes[ids[i]], bits[ids[i]], last = code, lengths[i], int(lengths[i])
        code += 1
    return codes, bits


def decoding_table(codes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, int]:
    """For every value of the next `width` bits its id and, in the lowest byte, its code length."""
    width = int(bits.max()) if len(bits) else 1
    table = np.ones(1 << width, np.int64)
    for i in np.flatnonzero(bits):
        first = int(codes[i]) << (width - int(bits[i]))
        span = 1 << (width - int(bits[i]))
        table[first:first + span] = int(i) << 8 | int(bits[i])
    return table, width


def encode_ids(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray,
               bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of neighbouring documents as 32-bit words, the first word of each, token offsets.

    counts: tokens of each document, one at least; a document begins with a word of its own.
    """
    size = bits[ids]
    ends = np.cumsum(size)
    begins = ends - size
    first = np.cumsum(counts) - counts
    doc_begins = begins[first]
    doc_bits = np.append(doc_begins[1:], ends[-1]) - doc_begins
    words = (doc_bits + 31) >> 5
    word_first = np.cumsum(words) - words
    offsets = begins + np.repeat(word_first * 32 - doc_begins, counts)
    at, shift = offsets >> 5, (64 - (offsets & 31) - size).astype(np.uint64)
    value = codes[ids] << shift
    total = int(words.sum()) + 1
    # Bits of different tokens never overlap, so sums are unions; they stay below 2**32.
    high = np.bincount(at, (value >> np.uint64(32)).astype(np.float64), total)
    low = np.bincount(at + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), total)
    return (high + low)[:-1].astype(np.uint32), word_first, offsets


def decode_words(words: np.ndarray, lanes: np.ndarray, counts: np.ndarray, table) -> np.ndarray:
    """Decodes `counts` tokens from each bit offset in `lanes`, all lanes in step."""
    entries, width = table
    out = np.zeros((len(lanes), int(counts.max(initial=0))), np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, left = lanes[order].astype(np.int64), counts[order]
    # Every word with the next one behind it: an offset needs one look-up.
    padded = np.append(words, np.zeros(2, np.uint32)).astype(np.uint64)
    pairs = (padded[:-1] << np.uint64(32)) | padded[1:]
    mask = (1 << width) - 1
    active = np.searchsorted(-left, -np.arange(out.shape[1]), side="left")
    found = np.zeros(out.shape[::-1], np.uint32)
    for step, n in enumerate(active):
        here = at[:n]
        window = pairs[here >> 5] >> (64 - width - (here & 31)).view(np.uint64)
        entry = entries[window.view(np.int64) & mask]
        found[step, :n] = entry >> 8
        here += entry & 255
    out[order] = found.T
    return out[np.arange(out.shape[1]) < counts[:, None]]


# -- files -------------------------------------------------------------------------------------

BLOCKS = ("part int, tokens_before long, n_tokens long, doc_ids array<{id}>, "
          "doc_tokens array<int>, checkpoints array<int>, payload binary")


def write_token_file(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1,
                     order: tuple[str, ...] = ("doc_id",), id_dtype: str = "uint16") -> None:
    """Tokenises every text, counts ids, and writes the blocks in the given order of documents.

    The ids are stored once, as compressed binary; the counts, at most one per id of the
    vocabulary, are all that reaches the driver. Documents are dealt by ranges of the order.
    """
    spark = docs.sparkSession
    scratch = new_folder(spark, "ids")
    tokenize(docs, tokenizer_path, end_id, id_dtype, order).write.option(
        "compression", "zstd").parquet(scratch)
    tokens = spark.read.parquet(scratch)
    counts = count_ids(tokens, id_dtype).toPandas().sort_values("id")
    lengths = code_lengths(counts["n"].to_numpy())
    spark.createDataFrame(
        [(int(i), int(n)) for i, n in zip(counts["id"], lengths)], "id long, bits int",
    ).coalesce(1).write.parquet(f"{path}/codebook")
    codes, bits = canonical_codes(counts["id"].to_numpy(), lengths)
    id_type = docs.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)
    spread = [F.col(c).asc_nulls_first() for c in order]
    dealt = tokens.repartitionByRange(*spread).sortWithinPartitions(*spread, "ids")
    code = spark.sparkContext.broadcast((codes, bits))  # one entry per id of the vocabulary

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        pending: list[tuple] = []
        held = 0
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   batch.column("ids").to_pylist()):
                pending.append((doc_id, np.frombuffer(ids, id_dtype)))
                held += len(pending[-1][1])
                if held >= BLOCK_TOKENS:
                    yield _block(part, before, pending, code.value, arrow_id)
                    before, pending, held = before + held, [], 0
        if pending:
            yield _block(part, before, pending, code.value, arrow_id)

    dealt.select("doc_id", "ids").mapInArrow(pack, BLOCKS.format(id=id_type.simpleString())).write.option(
        "compression", "none").parquet(f"{path}/blocks")


def _block(part: int, before: int, docs: list[tuple], code, id_type: pa.DataType) -> pa.RecordBatch:
    ids = np.concatenate([d[1] for d in docs])
    counts = np.array([len(d[1]) for d in docs])
    words, first, offsets = encode_ids(ids, counts, *code)
    begin = np.cumsum(counts) - counts
    checks = np.concatenate([
        offsets[b:b + n:CHECKPOINT] for b, n in zip(begin, counts)])
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([before], pa.int64()),
         pa.array([len(ids)], pa.int64()),
         pa.array([[d[0] for d in docs]], pa.list_(id_type)),
         pa.array([counts.tolist()], pa.list_(pa.int32())),
         pa.array([checks.tolist()], pa.list_(pa.int32())),
         pa.array([words.astype(">u4").tobytes()], pa.binary())],
        ["part", "tokens_before", "n_tokens", "doc_ids", "doc_tokens", "checkpoints", "payload"])


def read_codebook(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    book = spark.read.schema("id long, bits int").parquet(f"{path}/codebook").toPandas()
    return canonical_codes(book["id"].to_numpy(np.int64), book["bits"].to_numpy(np.int64))


def decode_blocks(spark: SparkSession, path: str, columns: str, per_document) -> DataFrame:
    """Decodes the blocks and applies per_document(doc_id, ids as uint32) -> values to each.

    Result: doc_id, start (tokens of all documents before it), n_tokens and the columns.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per part, that is per written partition.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    code = spark.sparkContext.broadcast(read_codebook(spark, path))
    names = [c.split()[0] for c in columns.split(", ")]
    schema = f"doc_id {id_type}, start long, n_tokens long, {columns}"

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(*code.value)
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["doc_tokens"], np.int64)
                lanes = (counts + CHECKPOINT - 1) // CHECKPOINT
                of_lane = np.full(int(lanes.sum()), CHECKPOINT, np.int64)
                of_lane[np.cumsum(lanes) - 1] = counts - (lanes - 1) * CHECKPOINT
                ids = decode_words(np.frombuffer(row["payload"], ">u4"),
                                   np.array(row["checkpoints"]), of_lane, table)
                ends = np.cumsum(counts)
                starts = ends - counts
                values = [per_document(i, ids[a:b])
                          for i, a, b in zip(row["doc_ids"], starts, ends)]
                first = row["ahead"] + row["tokens_before"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(
                        [row["doc_ids"], starts + first, counts, *zip(*values)], arrow)],
                    ["doc_id", "start", "n_tokens", *names])

    return blocks.join(F.broadcast(starts), "part").mapInArrow(run, schema)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit numbers."""
    return decode_blocks(spark, path, "ids_crc32 long", lambda _, ids: (
        zlib.crc32(ids.astype("<u4").tobytes()),))
