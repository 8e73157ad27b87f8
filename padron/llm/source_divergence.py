"""Source divergence audit by count-level bitmaps.

Each language keeps the terms that occur in enough of its documents. A (lang, source) group gives
a kept term the share p = 1 + floor(10**9 * (count + 2) / (N + 2 V)), N being the group's
occurrences of kept terms and V the number of kept terms; two shares differ by
f = floor((p - q)**2 / (p + q)). All arithmetic is in integers.

p depends on the count alone, so terms of one count in a group are one level. The kept terms of a
language lie in chunks of 64, and the store holds for each (group, count, chunk) the bits of its
terms. For two groups, AND and popcount of their levels give the number of terms in each joint
cell, which is multiplied by the cell's f. The level of the terms that a group lacks is the
complement of its other levels. Terms are chunked in the order of their frequency, so that a chunk
holds few levels and a cell many terms.

Texts are cut and counted in Arrow batches by the tasks that read them; what is shuffled are sums
by term. All else are DataFrame functions. No task holds more than a chunk of 64 terms for the
groups of a language, or a language's groups.

Defined cases: null text, lang and source are ''. A group without terms gives every kept term the
count 0. A language without kept terms has pairs of value 0 and no terms. Documents are rows:
repeated rows and ids, also null ids, count each time. An empty table gives an empty result. Other
columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from padron.llm.term_lists import term_counts
from padron.session import materialise

#: A term: letters, which are all but the rest of ASCII.
TERM = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of its language that a kept term occurs in at least.
MIN_DOCS = 10
#: Most divergent terms listed for each group.
TOP = 10
#: Terms of a chunk: the bits of a long.
CHUNK = 64
_SCALE = 1_000_000_000


def _div(a: Column, b: Column) -> Column:
    """Integer division, as a long."""
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count; decimals hold the product for counts of any size."""
    wide = (count.cast("decimal(19,0)") + 2) * F.lit(_SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + _div(wide, (total + 2 * kept).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """Stored rows of the kept terms: lang, term, tf, id and an array `per` of (source, tf).

    Occurrences are counted by language, source and term before they are dealt by term, where a
    term's documents over all sources show whether it is kept. Ids rise with falling frequency
    within each range of a sort, so that no task numbers a whole language. 64 neighbouring ids are
    a chunk, and chunks of different languages are told apart by the language.
    """
    counts = term_counts(docs, ("lang", "source"), TERM).repartition("lang", "term")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.withColumn("docs", F.sum("df").over(of_term)).filter(F.col("docs") >= min_docs)
    summed = kept.groupBy("lang", "term").agg(
        F.sum("tf").alias("tf"), F.collect_list(F.struct("source", "tf")).alias("per"))
    order = ["lang", F.desc("tf"), "term"]
    dealt = materialise(summed, "kept").repartitionByRange(
        *order).sortWithinPartitions(*order)
    return materialise(dealt.withColumn("id", F.monotonically_increasing_id()), "kept-ids")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Stored rows of all groups: lang, source, n (occurrences of kept terms) and v."""
    groups = docs.select("lang", "source").distinct()
    n = kept.select("lang", F.explode("per").alias("p")).groupBy(
        "lang", F.col("p.source").alias("source")).agg(F.sum("p.tf").alias("n"))
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    zero = F.lit(0).cast("long")
    return materialise(groups.join(n, ["lang", "source"], "left").join(v, "lang", "left").select(
        "lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v")),
        "groups")


def level_bitmaps(kept: DataFrame) -> DataFrame:
    """Stored bitsets: lang, chunk, source, count and the bits of the chunk's terms with it."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"),
                          (F.col("id") % CHUNK).cast("int"))
    rows = kept.select("lang", F.floor(F.col("id") / CHUNK).cast("long").alias("chunk"),
                       bit.alias("bit"), F.explode("per").alias("p"))
    return materialise(rows.groupBy(
        "lang", "chunk", F.col("p.source").alias("source"), F.col("p.tf").alias("count")).agg(
        F.bit_or("bit").alias("bits")), "levels")


def chunk_levels(bitmaps: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per lang and chunk: `all`, its groups, each with its levels (p, bits).

    Groups are in the order of their source. Every group has a last level of the terms it lacks:
    the chunk's terms without those of its other levels.
    """
    sized = bitmaps.join(groups, ["lang", "source"])
    level = F.struct(share(F.col("count"), F.col("n"), F.col("v")).alias("p"), "bits")
    of_group = sized.groupBy("lang", "chunk", "source").agg(
        F.collect_list(level).alias("levels"), F.bit_or("bits").alias("held"))
    chunks = of_group.groupBy("lang", "chunk").agg(
        F.bit_or("held").alias("held"),
        F.map_from_entries(F.collect_list(F.struct(
            "source", F.struct("levels", "held")))).alias("present"))
    zero = share(F.lit(0).cast("long"), F.col("n"), F.col("v"))
    everyone = groups.filter("v > 0").groupBy("lang").agg(F.sort_array(F.collect_list(
        F.struct("source", zero.alias("zero")))).alias("groups"))
    joined = chunks.join(everyone, "lang")

    def complete(g: Column) -> Column:
        own = F.try_element_at("present", g["source"])
        rest = F.col("held").bitwiseAND(
            F.bitwise_not(F.coalesce(own["held"], F.lit(0).cast("long"))))
        lacking = F.array(F.struct(g["zero"].alias("p"), rest.alias("bits")))
        return F.struct(g["source"].alias("source"), F.concat(
            F.coalesce(own["levels"], F.slice(lacking, 1, 0)), lacking).alias("levels"))

    return joined.select("lang", F.transform("groups", complete).alias("all"))


def pair_sums(levels: DataFrame) -> DataFrame:
    """Rows (lang, a, b, value), a before b: joint cells with a term, times the cell's f.

    The levels of two groups meet inside a chunk's row, so that their number is bounded by the 64
    terms of the chunk; sums are formed before the shuffle.
    """
    def each(frame: DataFrame, column: str, name: str) -> DataFrame:
        rest = [c for c in frame.columns if c != column]
        return frame.select(*rest, F.explode_outer(column).alias(name)).filter(
            F.col(name).isNotNull())

    pairs = F.flatten(F.transform("all", lambda a, i: F.transform(
        F.slice("all", i + 2, F.size("all")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    rows = each(levels.select("lang", pairs.alias("pairs")), "pairs", "pair").select(
        "lang", F.col("pair.a.source").alias("a"), F.col("pair.b.source").alias("b"),
        F.col("pair.a.levels").alias("left"), F.col("pair.b.levels").alias("right"))
    cells = each(each(rows, "left", "x"), "right", "y")
    terms = F.bit_count(F.col("x.bits").bitwiseAND(F.col("y.bits")))
    f = divergence(F.col("x.p"), F.col("y.p"))
    return cells.select("lang", "a", "b", F.when(terms > 0, terms * f).alias("value")).groupBy(
        "lang", "a", "b").agg(F.sum("value").alias("value"))


def pair_values(groups: DataFrame, sums: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language: lang, source, item, value."""
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"), "value")
    both = both.select("lang", "s.source", "s.item", "value")
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(other, "lang").filter("source <> item")
    return pairs.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))


def term_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Kept terms that a group holds more than its language: lang, source, item, value."""
    whole = groups.groupBy("lang").agg(F.sum("n").alias("all_n"))
    rows = kept.select("lang", "term", "tf", F.explode("per").alias("o")).select(
        "lang", F.col("o.source").alias("source"), "term", F.col("o.tf").alias("own"), "tf")
    sized = rows.join(groups, ["lang", "source"]).join(whole, "lang")
    shares = sized.select(
        "lang", "source", F.col("term").alias("item"),
        share(F.col("own"), F.col("n"), F.col("v")).alias("p"),
        share(F.col("tf"), F.col("all_n"), F.col("v")).alias("q"))
    return shares.filter("p > q").select(
        "lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part `pair` has each other source of the language, part `term` the `top` terms that the group
    holds more than its language. Ranks go by value, then by item.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("text", "lang", "source")])
    kept = kept_terms(named, min_docs)
    groups = group_sizes(named, kept)
    levels = chunk_levels(level_bitmaps(kept), groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    pairs = pair_values(groups, pair_sums(levels)).withColumn("rank", rank)
    terms = term_values(kept, groups).withColumn("rank", rank).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionAll(
        terms.withColumn("part", F.lit("term")).select(*columns))
