"""Ranked lexical search in K2-treaps over the grid of terms and documents.

The rows of the grid are the terms of the query items, its columns the documents, and a cell holds
the impact of a term in a document: (10**9 tf) div (1000 tf + 20 m), m being the document's length
against the mean. Documents are cut into shards of `SHARD`, and each shard is a treap: a quadtree
that divides both axes by eight, where a cell of level l spans 8**l terms and 8**l documents and
knows the largest impact below it. It is stored compressed: the cells of the coarsest level, for
each cell a bitmap of its children that are not empty, and the maxima of those alone, as the
differences from their parents'. Rows are numbered so that words of many items come first and the
words of a single item lie together.

An item's terms are the paths of their rows; at each level the paths in one cell are one entry
with the sum of their weights. All items descend a shard together: the sum of weight times maximum
is an upper bound of every score in a document range, and a range whose bound is below the item's
least score is left out. The ranges of the best bounds are scored first, and the least score rises
with the k-th best one found. Each item first descends the shard with its best bound alone, which
gives it a least score for all others. Nothing that belongs to the result is left out.

Texts are read once, in Arrow batches; treaps are built and searched with numpy, a shard at a
time. What is shuffled are bounds and results: an item's best documents of a shard at most. Items
are searched in blocks of a bounded number of terms.

Defined cases: a null or empty text has no terms. Rows that share a doc_id, or have none, are
documents of their own; a null doc_id ranks behind its equals. Each row of the items is an item of
its own, whatever its item_id; one without terms finds nothing. No documents or no items give an
empty result. Other columns are not read.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from padron.llm.term_lists import byte_texts, distinct_terms
from padron.session import materialise

#: A term: letters and digits, which are all but the rest of ASCII.
TERM = rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents listed for an item.
TOP = 50
#: Levels of a treap, and its documents: 8 x 8 cells make one of the next level.
LEVELS = 4
SHARD = 8 ** LEVELS
#: Terms of a block of items: their weights are a matrix in each task.
BLOCK_TERMS = 8_000
#: Document ranges of level 1 that are scored together.
STEP = 64


# -- items --------------------------------------------------------------------------------------

def item_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored (_item, item_id), and stored (_item, term), each term of an item once."""
    keyed = materialise(items.select("item_id", "text").withColumn(
        "_item", F.monotonically_increasing_id()), "items")
    return keyed.select("_item", "item_id"), materialise(
        distinct_terms(keyed, "_item", TERM), "terms")


def in_blocks(terms: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """(_item, term) in blocks of whole items, of about `limit` rows; one is held at a time."""
    blocks = -(-terms.count() // limit)
    of = F.pmod(F.xxhash64("_item"), F.lit(max(1, blocks)))
    for i in range(blocks):
        if block := [(r[0], r[1]) for r in terms.filter(of == i).select("_item", "term").collect()]:
            yield block


def number_terms(block: list[tuple[int, str]]) -> dict[bytes, int]:
    """Rows of the grid: words of many items by their number, then each item's own together."""
    items = Counter(term for _, term in block)
    first: dict[str, int] = {}
    for item, term in block:
        first[term] = min(item, first.get(term, item))
    order = sorted(items, key=lambda t: (-items[t] if items[t] > 1 else 0, first[t], t))
    return {term.encode(): row for row, term in enumerate(order)}


# -- documents ----------------------------------------------------------------------------------

def postings(docs: DataFrame, rows: dict[bytes, int]) -> DataFrame:
    """Stored (doc_id, n, row, tf) of the documents with a term: n terms with repeats, and the
    given ones that it holds, as arrays."""
    known = docs.sparkSession.sparkContext.broadcast(rows)  # BLOCK_TERMS at most, or one item's
    find = re.compile(TERM).findall
    numbers = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of = known.value
        for batch in batches:
            sizes, found, times = [], [], []
            for text in byte_texts(batch):
                words = find(text)
                counts = Counter(filter(row_of.__contains__, words))
                sizes.append(len(words))
                found.append([row_of[w] for w in counts])
                times.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, numbers),
                 pa.array(times, numbers)], ["doc_id", "n", "row", "tf"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return materialise(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n long, row array<int>, tf array<int>").filter("n > 0"),
        "postings")


def impacts(n: np.ndarray, tf: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Impacts of postings in documents of n terms; all in integers."""
    if int(n.max(initial=0)) * 50 * docs < 1 << 62:
        m = 50 + 50 * n * docs // terms
    else:
        m = np.array([50 + 50 * int(x) * docs // terms for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


# -- treaps -------------------------------------------------------------------------------------

def coarser(row: np.ndarray, column: np.ndarray, most: np.ndarray):
    """The cells one level up, sorted by row and column, with the largest value below each."""
    key = (row >> 3) << 32 | column >> 3
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    found = key[order][first]
    return found >> 32, found & 0xFFFFFFFF, np.maximum.reduceat(most[order], first)


def build_treap(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> list[bytes]:
    """The coarsest cells (row and maximum), then a bitmap and the children's maxima by level.

    Children follow the order of their parents and then of their place, row before column.
    """
    if not len(row):
        return [b""] * (2 + 2 * LEVELS)
    levels = [(row, column, value)]
    for _ in range(LEVELS):
        levels.append(coarser(*levels[-1]))
    above_row, above_column, above = levels[-1]
    stored = [above_row.astype(np.int32).tobytes(), above.astype(np.int32).tobytes()]
    for row, column, most in reversed(levels[:-1]):
        above_key = above_row << 32 | above_column
        order = np.argsort(above_key, kind="stable")
        parent = order[np.searchsorted(above_key[order], (row >> 3) << 32 | column >> 3)]
        place = (row & 7) * 8 + (column & 7)
        at = np.lexsort((place, parent))
        parent, place = parent[at], place[at]
        first = np.flatnonzero(np.r_[True, np.diff(parent) != 0])
        bits = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), place.astype(np.uint64)), first)
        stored += [bits.tobytes(), (above[parent] - most[at]).astype(np.int32).tobytes()]
        above_row, above_column, above = row[at], column[at], most[at]
    return stored


def read_treap(stored: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cells (row, column, maximum) of the levels, the postings at 0."""
    row = np.frombuffer(stored[0], np.int32).astype(np.int64)
    most = np.frombuffer(stored[1], np.int32).astype(np.int64)
    levels = [(row, np.zeros(len(row), np.int64), most)]
    for i in range(2, len(stored), 2):
        row, column, most = levels[0]
        bits = np.frombuffer(stored[i], np.uint8).reshape(-1, 8)
        parent, place = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))
        less = np.frombuffer(stored[i + 1], np.int32)
        levels.insert(0, (row[parent] * 8 + place // 8, column[parent] * 8 + place % 8,
                          most[parent] - less))
    return levels


def build_index(found: DataFrame, docs: int, terms: int) -> DataFrame:
    """Stored shards (shard, doc_ids, treap), each of neighbouring documents of a task."""
    id_type = found.schema["doc_id"].dataType.simpleString()

    def shard_of(table: pa.Table) -> pa.RecordBatch:
        lists = table.column("row").combine_chunks()
        column = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        row = lists.flatten().to_numpy().astype(np.int64)
        tf = table.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64)
        value = impacts(table.column("n").to_numpy()[column], tf, docs, terms)
        ids = table.column("doc_id").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays([0, len(ids)], ids),
             pa.array([build_treap(row, column, value)], pa.list_(pa.binary()))],
            ["doc_ids", "treap"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while size + len(batch) >= SHARD:
                part = batch.slice(0, SHARD - size)
                yield shard_of(pa.Table.from_batches([*held, part]))
                batch, held, size = batch.slice(len(part)), [], 0
            if len(batch):
                held.append(batch)
                size += len(batch)
        if held:
            yield shard_of(pa.Table.from_batches(held))

    shards = found.mapInArrow(run, f"doc_ids array<{id_type}>, treap array<binary>")
    return materialise(shards.withColumn("shard", F.monotonically_increasing_id()), "treaps")


# -- search -------------------------------------------------------------------------------------

class Paths:
    """Weights of a block's items, a matrix of items and rows for each level."""

    def __init__(self, block: list[tuple[int, str]], rows: dict[bytes, int],
                 weight: dict[int, int]):
        self.items = np.array(sorted({item for item, _ in block}), np.int64)
        at = {item: i for i, item in enumerate(self.items.tolist())}
        weights = np.zeros((len(at), len(rows)))
        for item, term in block:
            row = rows[term.encode()]
            weights[at[item], row] = weight.get(row, 0)
        self.levels = [weights]
        for _ in range(LEVELS):
            below = self.levels[-1]
            wide = np.zeros((len(at), -(-below.shape[1] // 8) * 8))
            wide[:, :below.shape[1]] = below
            self.levels.append(wide.reshape(len(at), -1, 8).sum(axis=2))

    def bounds(self, level: int, cells, items: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Weight times maximum, summed by item and column; whole numbers below 2**53, so exact.

        `columns` are sorted; cells of others are left out.
        """
        row, column, most = cells
        place = np.searchsorted(columns, column)
        place[place == len(columns)] = 0
        wanted = columns[place] == column
        rows, line = np.unique(row[wanted], return_inverse=True)
        grid = np.zeros((len(rows), len(columns)))
        grid[line, place[wanted]] = most[wanted]
        return self.levels[level][np.ix_(items, rows)] @ grid


def search_shard(paths: Paths, treap: list[bytes], ranks: np.ndarray, items: np.ndarray,
                 least: np.ndarray, top: int) -> list[tuple[int, int, int]]:
    """The best documents of a shard as (item, column, score), with scores from `least` on.

    items are places in `paths`, least their least scores, ranks the order of equal documents.
    """
    levels, least = read_treap(treap), least.astype(float)
    if not len(levels[0][0]):
        return []
    alive, columns, bound = np.ones((len(items), 1), bool), np.zeros(1, np.int64), None
    for level in range(LEVELS, 0, -1):
        if level < LEVELS:
            below = (columns[:, None] * 8 + np.arange(8)).ravel()
            alive, columns = np.repeat(alive, 8, axis=1), below
        bound = paths.bounds(level, levels[level], items, columns)
        alive = alive & (bound >= least[:, None])
        kept = alive.any(axis=0)
        alive, columns, bound = alive[:, kept], columns[kept], bound[:, kept]
        if not len(columns):
            return []
    best = [np.zeros((0, 2), np.int64)] * len(items)  # (column, score) of each item
    order = np.argsort(-np.where(alive, bound - least[:, None], -1).max(axis=0), kind="stable")
    for start in range(0, len(order), STEP):
        some = np.sort(order[start:start + STEP])
        alive_now = alive[:, some] & (bound[:, some] >= least[:, None])
        some = some[alive_now.any(axis=0)]
        who = np.flatnonzero(alive_now.any(axis=1))
        if not len(who):
            continue
        docs = (columns[some][:, None] * 8 + np.arange(8)).ravel()
        scores = paths.bounds(0, levels[0], items[who], docs)
        for i, line in zip(who, scores):
            found = np.flatnonzero(line >= least[i])
            if not len(found):
                continue
            both = np.vstack([best[i], np.c_[docs[found], line[found].astype(np.int64)]])
            best[i] = both[np.lexsort((ranks[both[:, 0]], -both[:, 1]))[:top]]
            if len(best[i]) == top:
                least[i] = max(least[i], best[i][-1, 1])
    return [(int(i), int(column), int(score))
            for i, rows in zip(items, best) for column, score in rows.tolist()]


def shard_bounds(index: DataFrame, paths) -> DataFrame:
    """(item, shard, bound): the bounds at the coarsest level, above 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everyone = np.arange(len(paths.value.items))
        for batch in batches:
            for shard, treap in zip(batch.column("shard").to_pylist(), batch.column("top")):
                row, most = (np.frombuffer(part.as_py(), np.int32) for part in treap)
                cells = row.astype(np.int64), np.zeros(len(row), np.int64), most
                bound = paths.value.bounds(LEVELS, cells, everyone, np.zeros(1, np.int64))[:, 0]
                who = np.flatnonzero(bound > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who), pa.array(np.full(len(who), shard)),
                     pa.array(bound[who].astype(np.int64))], ["item", "shard", "bound"])

    return index.select("shard", F.slice("treap", 1, 2).alias("top")).mapInArrow(
        run, "item long, shard long, bound long")


def best_documents(index: DataFrame, paths, wanted: DataFrame, top: int) -> DataFrame:
    """(item, doc_id, score) of each shard's best documents; `wanted` has a row per shard to
    search, with its items as an array of (item, least)."""
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, treap, asked in zip(*(batch.column(c) for c in ("doc_ids", "treap", "asked"))):
                ids, asked = ids.values, asked.as_py()
                ranks = np.empty(len(ids), np.int64)
                ranks[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))  # nulls come last
                items = np.array([a["item"] for a in asked], np.int64)
                least = np.array([a["least"] for a in asked], np.int64)
                found = search_shard(paths.value, treap.as_py(), ranks, items, least, top)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()),
                     ids.take(pa.array([f[1] for f in found], pa.int64())),
                     pa.array([f[2] for f in found], pa.int64())], ["item", "doc_id", "score"])

    return index.join(wanted, "shard").select("doc_ids", "treap", "asked").mapInArrow(
        run, f"item long, doc_id {id_type}, score long")


def search_block(docs: DataFrame, block: list[tuple[int, str]], top: int) -> DataFrame:
    """_item, rank, doc_id and score for the items of a block."""
    spark: SparkSession = docs.sparkSession
    rows = number_terms(block)
    found = postings(docs, rows)
    size = found.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    frequency = found.select(F.explode("row").alias("row")).groupBy("row").count().collect()
    weight = {r["row"]: math.floor(1000 * math.log((2 * size.docs + 2) / (2 * r["count"] + 1)))
              for r in frequency}  # a row per term of the block
    index = build_index(found, size.docs, size.terms or 1)
    paths = spark.sparkContext.broadcast(Paths(block, rows, weight))
    bounds = materialise(shard_bounds(index, paths), "bounds")
    asked = F.collect_list(F.struct("item", "least")).alias("asked")
    first = Window.partitionBy("item").orderBy(F.desc("bound"), "shard")
    chosen = bounds.withColumn("_k", F.row_number().over(first)).filter("_k = 1").withColumn(
        "least", F.lit(1).cast("long")).groupBy("shard").agg(asked)
    best = Window.partitionBy("item").orderBy(F.desc("score"))
    kth = best_documents(index, paths, chosen, top).withColumn(
        "_k", F.row_number().over(best)).filter(F.col("_k") == top).select(
        "item", F.greatest("score", F.lit(1).cast("long")).alias("least"))
    least = materialise(kth, "least")
    wanted = bounds.join(least, "item", "left").withColumn(
        "least", F.coalesce("least", F.lit(1).cast("long"))).filter("bound >= least")
    all_found = best_documents(index, paths, wanted.groupBy("shard").agg(asked), top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = all_found.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= top)
    names = spark.createDataFrame(
        list(enumerate(paths.value.items.tolist())), "item long, _item long")
    return ranked.join(names, "item").select("_item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the `top` best documents with a score above 0."""
    names, terms = item_terms(items)
    blocks = [search_block(docs, block, top) for block in in_blocks(terms, block_terms)]
    if not blocks:
        id_type = docs.schema["doc_id"].dataType.simpleString()
        blocks = [docs.sparkSession.createDataFrame(
            [], f"_item long, rank int, doc_id {id_type}, score long")]
    found = reduce(DataFrame.unionByName, blocks)
    return names.join(found, "_item").select("item_id", "rank", "doc_id", "score")
