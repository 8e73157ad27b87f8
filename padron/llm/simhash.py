"""SimHash near-dedup over vantage-point trees.

Every document gets a 64-bit fingerprint of its word shingles. Equal fingerprints are joined by
grouping; the distinct ones are searched for all pairs within `radius` differing bits:

1. The 64 bits are cut into `parts` blocks. Two fingerprints within the radius differ in few bits
   of some `take` of the blocks (pigeonhole), so each such choice of blocks is a search of its own
   under the Hamming distance of those blocks, with a smaller radius.
2. For each search a vantage-point tree, built from a bounded sample of fingerprints, deals the
   fingerprints out: a node compares the distance to its vantage point with a cut. A fingerprint
   lives in one leaf and also visits every later leaf that the triangle bound does not exclude,
   that is where its distance lies within the radius of the cut.
3. Each leaf is a shard. Its task goes on with a tree of its own and compares what is left. It
   returns a link from each fingerprint to the first one of its group, never all pairs.
4. Links are closed to components by star contraction, a few rounds of joins on stored tables.

With 2 blocks (the default) a search has radius 1 and about a quarter of the fingerprints crosses
each cut; with (parts, take) = (5, 2) the radius is 0, no fingerprint crosses a cut, and the
shuffle is ten rows per fingerprint at any size, which is cheaper from about 10**8 fingerprints
on. Both are exact.

Defined cases: null or empty text has fingerprint zero, linked like any other. Repeated rows and
equal doc_ids are rows of their own in the result. A component is named by its smallest doc_id
that is not null (null if it has none). An empty table gives an empty result.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.texts import text_slices
from padron.llm.token_counts import in_worker
from padron.session import materialise

#: Fingerprints from which the trees are built on the driver: 8 bytes each.
SAMPLE = 32_768
#: Fingerprints that a leaf of a tree is meant to hold.
LEAF = 8_192
#: Within a shard, blocks up to so many comparisons are not divided further.
BRUTE = 1 << 21
#: Sampled fingerprints tried as vantage point of a node.
TRIES = 4


# -- fingerprints ------------------------------------------------------------------------------

def fingerprint(text: str, width: int = 3) -> int:
    """Bit i is set if it is set in over half the hashes of the text's shingles."""
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.append(0, ends[:-1] + 1)
    width = min(width, len(words))
    spans = zip(begins[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):  # 64 bytes for each hash at once
        counts += np.unpackbits(hashes[i:i + 65_536].view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """Per row: doc_id and fp, the fingerprint as a signed 64-bit number."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_worker(("fingerprints",), dict)  # lets go of what another stage left in this worker
        for batch, texts in text_slices(batches):
            values = np.array([fingerprint(t, width) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fp long")


# -- vantage-point trees -----------------------------------------------------------------------

def searches(radius: int, parts: int, take: int) -> list[tuple[int, int]]:
    """Bit masks with the radius that some of them keeps for every pair within `radius`."""
    edges = [64 * i // parts for i in range(parts + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    each, rest = divmod(radius, parts)
    least = take * each + max(0, rest - (parts - take))
    return [(sum(chosen), least) for chosen in combinations(blocks, take)]


def distances(fps: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((fps ^ vantage) & mask)


def best_cut(fps: np.ndarray, mask: np.uint64, seed: int) -> tuple[np.uint64, int] | None:
    """A vantage point and a cut (distances up to it go left) that divide best, if any do."""
    best, found = len(fps), None
    for i in range(TRIES):
        vantage = fps[(seed * TRIES + i) * 7919 % len(fps)]
        counts = np.cumsum(np.bincount(distances(fps, vantage, mask)))
        off = np.abs(2 * counts - len(fps))
        cut = int(off.argmin())
        if off[cut] < best:
            best, found = off[cut], (vantage, cut)
    return found


def build_tree(sample: np.ndarray, mask: int, depth: int, seed: int = 1):
    """Nested (vantage, cut, near, far); None is a leaf."""
    if depth == 0 or len(sample) < 2:
        return None
    cut = best_cut(sample, np.uint64(mask), seed)
    if cut is None:
        return None
    near = distances(sample, cut[0], np.uint64(mask)) <= cut[1]
    return (*cut, build_tree(sample[near], mask, depth - 1, 2 * seed),
            build_tree(sample[~near], mask, depth - 1, 2 * seed + 1))


def deal(tree, fps: np.ndarray, at: np.ndarray, home: np.ndarray, mask: int, radius: int,
         leaf: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Leaves with the places (of `fps`) that live in or visit them; home tells which live there.

    A pair is met where the one of the earlier leaf visits the later one, so only later leaves
    are visited.
    """
    if not len(at):
        return
    if tree is None:
        yield leaf, at, home
        return
    vantage, cut, near, far = tree
    distance = distances(fps[at], vantage, np.uint64(mask)).astype(np.int64)
    left = distance <= cut
    # Visitors come from earlier leaves, so they may go either way; residents cross to the right.
    go_left = left | (~home & (distance - radius <= cut))
    go_right = ~left | (distance + radius > cut)
    yield from deal(near, fps, at[go_left], (home & left)[go_left], mask, radius, 2 * leaf)
    yield from deal(far, fps, at[go_right], (home & ~left)[go_right], mask, radius, 2 * leaf + 1)


class Forest:
    """Disjoint sets over places, joined by arrays of pairs."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, at: np.ndarray) -> np.ndarray:
        parent = self.parent
        while True:
            up = parent[at]
            if (up == at).all():
                return at
            at = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
        self.parent = self.roots(self.parent)


def join_shard(fps: np.ndarray, members: np.ndarray, queries: np.ndarray, mask: int, inner: int,
               radius: int, forest: Forest, seed: int = 1) -> None:
    """Joins each query with the members within `radius`, dividing by further vantage points."""
    if not len(members) or not len(queries):
        return
    cut = None
    if len(members) * len(queries) > BRUTE:
        cut = best_cut(fps[members], np.uint64(mask), seed)
    if cut is None:
        step = max(1, BRUTE // len(members))
        for i in range(0, len(queries), step):
            some = queries[i:i + step]
            near = np.bitwise_count(fps[some][:, None] ^ fps[members][None, :]) <= radius
            q, m = np.nonzero(near)
            forest.join(some[q], members[m])
        return
    m = distances(fps[members], cut[0], np.uint64(mask)).astype(np.int64)
    q = distances(fps[queries], cut[0], np.uint64(mask)).astype(np.int64)
    join_shard(fps, members[m <= cut[1]], queries[q - inner <= cut[1]], mask, inner, radius,
               forest, 2 * seed)
    join_shard(fps, members[m > cut[1]], queries[q + inner > cut[1]], mask, inner, radius,
               forest, 2 * seed + 1)


# -- search ------------------------------------------------------------------------------------

def near_links(distinct: DataFrame, radius: int = 3, parts: int = 2, take: int = 1) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column fp) that close to all pairs in the radius.

    The driver holds the trees, built from a sample of bounded size: the fingerprints that come
    first by a hash. How many leaves they have follows from the counted fingerprints.
    """
    total = distinct.count()
    plans = searches(radius, parts, take)
    sample = np.array([r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(
        SAMPLE).collect()], np.int64).view(np.uint64) if total > LEAF else np.zeros(0, np.uint64)
    depth = max(0, int(np.ceil(np.log2(max(1, total / LEAF)))))
    trees = [build_tree(sample, mask, min(depth, 12)) for mask, _ in plans]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            every = np.arange(len(fps))
            for search, (mask, inner) in enumerate(plans):
                for leaf, at, home in deal(trees[search], fps, every, np.ones(len(fps), bool),
                                           mask, inner):
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, search * (1 << 20) + leaf)),
                         pa.array(fps[at].view(np.int64)), pa.array(home)],
                        ["shard", "fp", "home"])

    def search(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        mask, inner = plans[int(key[0]) >> 20]
        fps = shard["fp"].to_numpy().view(np.uint64)
        forest = Forest(len(fps))
        join_shard(fps, np.flatnonzero(shard["home"].to_numpy()), np.arange(len(fps)), mask,
                   inner, radius, forest)
        linked = np.flatnonzero(forest.parent != np.arange(len(fps)))
        values = fps.view(np.int64)
        return pd.DataFrame({"a": values[linked], "b": values[forest.parent[linked]]})

    dealt = distinct.select("fp").mapInArrow(spread, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Smallest node of the component of every linked node (node, root), by star contraction.

    Each round links every node with the least node next to it, first for larger neighbours and
    then for smaller ones, and stores the links; it ends when nothing changes.
    """
    def stars(edges: DataFrame) -> DataFrame:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("node")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
        joined = large.join(down, F.col("a") == F.col("node"))
        return joined.select("a", F.col("m").alias("b")).unionAll(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).filter("a <> b").distinct()

    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                          F.sum(F.hash("a", "b").cast("long")).alias("s")).first()
        if state == before or state.n == 0:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed(
                "a", "node")
        before = state
        edges = materialise(stars(edges), "links")


def near_duplicates(docs: DataFrame, radius: int = 3, parts: int = 2,
                    take: int = 1) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = materialise(fingerprints(docs), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(near_links(distinct, radius, parts, take))
    of_root = materialise(distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    named = of_root.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialise(of_root.join(named, "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
