"""Mixing sources to target weights by Pfair scheduling.

Time is cut into slots of one block each. With weight w, block j of a source is released at slot
floor(j / w) and due before slot ceil((j + 1) / w); each slot goes to the released block with
the earliest deadline (ties: first source by name). As the weights add up to one, every deadline
is met, so that after t slots a source has had more than w*t - 1 and fewer than w*t + 1 blocks.
Weights are rounded to n/`resolution`; the schedule then repeats after `resolution` slots, so one
period is computed, as a fold over its slots, and the blocks of any corpus are placed by division.
DataFrame functions only.

Defined cases: a null source is a source of its own. Documents of a source follow by doc_id
(null first), equal ids by their text; equal rows in any order. A source that has run out leaves
its slots empty, and the others go on in the same proportion: no document is dropped or repeated.
A source without a weight raises an error, one weighted 0 or less too. An empty table gives none.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from padron.llm.texts import broadcast_if_small
from padron.session import materialise

#: Slots of a period. Weights are multiples of 1/RESOLUTION, one at least.
RESOLUTION = 1000
#: Documents of a block.
BLOCK = 16


def source_key(source: Column) -> Column:
    """Text that sorts and joins like the source, with a value for null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def shares(weights: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """Weights (key, weight) as whole parts of `resolution` by largest remainder, one at least.

    One row per source: a table as long as the list of sources, not as the corpus.
    """
    every, by_rest = Window.partitionBy(), Window.orderBy(F.desc("rest"), "key")
    free = F.lit(resolution) - F.count("*").over(every)
    ideal = weights.withColumn("ideal", F.col("weight") / F.sum("weight").over(every) * free)
    floors = ideal.withColumn("whole", F.floor("ideal")).withColumn(
        "rest", F.col("ideal") - F.col("whole"))
    missing = free - F.sum("whole").over(every)
    extra = (F.row_number().over(by_rest) <= missing).cast("long")
    return floors.select("key", (F.lit(1) + F.col("whole") + extra).alias("parts"))


def period(parts: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """The slots of one period: key, parts, turn (number of the source's block), slot."""
    listed = parts.agg(F.sort_array(F.collect_list(F.struct("key", "parts"))).alias("s"))
    whole = F.lit(resolution).cast("long")

    def pick(state: Column, slot: Column) -> Column:
        # Deadline first, then the place in the list of sources; unreleased blocks come last.
        urgency = F.transform(
            F.col("s"), lambda s, i: F.struct(
                (F.floor(state["used"][i] * whole / s["parts"]) > slot).alias("late"),
                F.ceil((state["used"][i] + 1) * whole / s["parts"]).alias("due"),
                i.alias("i")))
        chosen = F.array_min(urgency)["i"]
        return F.struct(
            F.transform(state["used"], lambda u, i: F.when(i == chosen, u + 1).otherwise(u))
            .alias("used"),
            F.concat(state["order"], F.array(chosen)).alias("order"))

    start = F.struct(
        F.transform("s", lambda s: F.lit(0).cast("long")).alias("used"),
        F.array().cast("array<int>").alias("order"))
    slots = F.sequence(F.lit(0).cast("long"), whole - 1)
    order = F.aggregate(slots, start, pick)["order"]
    rows = listed.filter(F.size("s") > 0).select("s", order.alias("order")).select(
        "s", F.posexplode("order").alias("slot", "i")).select(
        F.get("s", F.col("i"))["key"].alias("key"), F.get("s", F.col("i"))["parts"].alias("parts"),
        F.col("slot").cast("long").alias("slot"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy("slot")) - 1
    return rows.withColumn("turn", turn.cast("long"))


def ranked(docs: DataFrame) -> DataFrame:
    """Adds key and rank (place of a row in its source, from 0) to doc_id, source, _text_hash.

    Rows are dealt by ranges of (key, doc_id), so a large source lies in many tasks; each task
    numbers its own rows, and the counts per range, a small table, give every range its start.
    """
    spread = docs.withColumn("key", source_key(F.col("source"))).repartitionByRange(
        "key", F.col("doc_id").asc_nulls_first(), "_text_hash")
    stored = materialise(spread.withColumn("part", F.spark_partition_id()), "ranges")
    counts = stored.groupBy("key", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select("key", "part", F.coalesce(
        F.sum("rows").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("key", "part").orderBy(
        F.col("doc_id").asc_nulls_first(), "_text_hash")
    return stored.withColumn("_at", F.row_number().over(own) - 1).join(
        broadcast_if_small(materialise(starts, "starts")), ["key", "part"]).withColumn(
        "rank", F.col("first") + F.col("_at")).drop("part", "first", "_at")


def root_weights(docs: DataFrame) -> DataFrame:
    """Default targets: a source weighs the square root of its number of documents."""
    return docs.groupBy(source_key(F.col("source")).alias("key")).agg(
        F.sqrt(F.count("*").cast("double")).alias("weight"))


def mix(docs: DataFrame, weights: DataFrame | None = None, block: int = BLOCK,
        resolution: int | None = None) -> DataFrame:
    """Per document: doc_id, source, parts, block, slot, place; read in order of (slot, place).

    weights: rows (source, weight), by default the square root of the documents of each source.
    Documents are cut into blocks of `block` along each source; a slot holds one block. Without a
    `resolution` a period has RESOLUTION slots, or as many times that as give four to a source;
    the schedule of a period takes time in slots times sources.
    """
    narrow = docs.select("doc_id", "source", F.xxhash64("text").alias("_text_hash"))
    targets = root_weights(docs) if weights is None else weights.select(
        source_key(F.col("source")).alias("key"), F.col("weight").cast("double").alias("weight"))
    targets = materialise(targets, "weights")
    sources = targets.count()
    if resolution is None:
        resolution = RESOLUTION * max(1, -(-4 * sources // RESOLUTION))
    if 4 * sources > resolution:
        raise ValueError(f"{sources} sources need a resolution of {4 * sources} or more")
    if targets.filter("weight IS NULL OR weight <= 0").count():
        raise ValueError("every weight must be positive")
    if weights is not None:
        known = targets.select("key")
        if docs.select(source_key(F.col("source")).alias("key")).distinct().join(
                known, "key", "left_anti").count():
            raise ValueError("a source has no weight")
    plan = materialise(period(shares(targets, resolution), resolution), "period")
    per_key = plan.select("key", "parts").distinct()
    placed = ranked(narrow).join(F.broadcast(per_key), "key").withColumn(
        "block", F.floor(F.col("rank") / block)).withColumn(
        "place", F.col("rank") % block).withColumn("turn", F.col("block") % F.col("parts"))
    # One row per slot of the period, which is `resolution` rows: small by definition.
    return placed.join(F.broadcast(plan.select("key", "turn", F.col("slot").alias("_slot"))),
                       ["key", "turn"]).select(
        "doc_id", "source", "parts", "block",
        (F.floor(F.col("block") / F.col("parts")) * resolution + F.col("_slot")).alias("slot"),
        "place")
