"""Benchmark decontamination with a distributed positional inverted index.

The index holds one posting (term, document, position) for every occurrence of a benchmark term
in the training documents. A benchmark window is found by its rarest terms: their postings, moved
back by the terms' offsets and intersected, are the places where the item could begin; there the
postings of the other terms are intersected. DataFrame functions only.

Defined cases: null or empty text has no words. Rows that share a doc_id (also a null one) are
one document whose rows lie over one another: n_words is the longest row's, hits are the union.
Benchmark rows of one item_id are items of their own, counted once by id; rows without an id mark
hits and are not counted. An empty benchmark hits nothing. Other columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from padron.llm.texts import ascii_lower, broadcast_if_small
from padron.session import materialise

#: Terms of a window whose lists are intersected to find where it may occur.
RAREST = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def benchmark_terms(items: DataFrame) -> DataFrame:
    """One stored row per word of each item: _item (key of the row), item_id, n, offset, word."""
    words = F.filter(F.split(ascii_lower(F.col("text")), SEPARATORS), lambda w: w != "")
    listed = items.select("item_id", words.alias("words"))
    keyed = materialise(listed.withColumn("_item", F.monotonically_increasing_id()), "items")
    return materialise(
        keyed.select("_item", "item_id", F.size("words").alias("n"),
                     F.posexplode("words").alias("offset", "word")), "item-terms")


def positional_index(docs: DataFrame, words: DataFrame) -> DataFrame:
    """Stored postings (doc_id, pos, word, n_words) of the given words in the documents.

    Built in the stage that reads the texts, without a shuffle. Each document also has a header
    row, the one whose n_words is not null; its word is null if position 0 holds no given word.
    """
    parts = docs.select("doc_id", F.split(ascii_lower(F.col("text")), SEPARATORS).alias("parts"))
    lead = (F.get("parts", F.lit(0)) == "").cast("int")
    trail = ((F.size("parts") > 1) & (F.element_at("parts", -1) == "")).cast("int")
    counted = parts.withColumn("lead", lead).withColumn(
        "total", (F.size("parts") - F.col("lead") - trail).cast("long"))
    rows = counted.select("doc_id", "lead", "total", F.posexplode("parts").alias("at", "word"))
    known = words.select(F.col("word").alias("word"), F.lit(True).alias("known"))
    joined = rows.join(broadcast_if_small(known), "word", "left")
    head = F.col("at") == 0
    return materialise(
        joined.filter(F.col("known") | head).select(
            "doc_id", (F.col("at") - F.col("lead")).alias("pos"),
            F.when(F.col("known"), F.col("word")).alias("word"),
            F.when(head, F.col("total")).alias("n_words")), "postings")


def _with_counts(terms: DataFrame, index: DataFrame) -> DataFrame:
    """Per item: its terms in order with the number of postings of each."""
    counts = index.filter("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("df"))
    return terms.join(counts, "word", "left").groupBy("_item", "item_id", "n").agg(
        F.sort_array(F.collect_list(F.struct(
            "offset", F.coalesce("df", F.lit(0)).alias("df"), "word"))).alias("terms"))


def _rarest(terms: Column, count: int) -> Column:
    """Offsets of the terms with the fewest postings, rarest first."""
    ordered = F.array_sort(F.transform(
        terms, lambda t: F.struct(t["df"].alias("df"), t["word"].alias("word"),
                                  t["offset"].alias("offset"))))
    return F.transform(F.slice(ordered, 1, count), lambda t: t["offset"])


def _of_documents(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Postings of the given documents (a one-column table)."""
    wanted = broadcast_if_small(materialise(docs.toDF("_doc").distinct(), "candidates"))
    return index.join(wanted, index["doc_id"].eqNullSafe(wanted["_doc"]), "left_semi")


def phrase_matches(index: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Places where windows of items occur: doc_id, item_id, hits (the positions, distinct).

    items: as `_with_counts` gives them. A pair of document and place has one row per alignment,
    not one per window or pair of words.
    """
    width = F.least(F.lit(window), F.col("n"))
    windows = items.select("_item", "terms", F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.col("n") - width),
        lambda o: F.array_sort(_rarest(F.slice("terms", o + 1, width), RAREST)))).alias("windows"))
    # A window that holds a word without postings occurs nowhere.
    possible = F.filter("windows", lambda w: F.forall(
        w, lambda o: F.get("terms", o)["df"] > 0))
    windows = materialise(windows.withColumn("windows", possible).filter(
        F.size("windows") > 0), "windows")
    anchors = materialise(windows.select("_item", "terms", F.explode(F.array_distinct(
        F.flatten("windows"))).alias("offset")).select(
        "_item", F.get("terms", F.col("offset"))["word"].alias("word"), "offset"), "anchors")
    # Lists moved back by their offsets, intersected for each window's rarest terms.
    meeting = index.join(broadcast_if_small(anchors), "word").groupBy(
        "doc_id", "_item", (F.col("pos") - F.col("offset")).alias("start")).agg(
        F.collect_set("offset").alias("offsets"))
    starts = materialise(meeting.join(
        broadcast_if_small(windows.select("_item", "windows"), 20_000), "_item").filter(
        F.exists("windows", lambda w: F.forall(w, lambda o: F.array_contains("offsets", o))))
        .select("doc_id", "_item", "start"), "starts")
    expected = starts.join(items, "_item").select(
        F.col("doc_id").alias("_doc"), "_item", "item_id", "n", "start",
        F.explode("terms").alias("t"))
    expected = expected.select(
        "_doc", "_item", "item_id", "n", "start", F.col("t.offset").alias("offset"),
        F.col("t.word").alias("_word"), (F.col("start") + F.col("t.offset")).alias("_pos"))
    found = _of_documents(index, starts.select("doc_id")).join(
        expected, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("pos") == F.col("_pos"))
        & (F.col("word") == F.col("_word")))
    lists = found.groupBy("doc_id", "_item", "item_id", "n", "start").agg(
        F.sort_array(F.collect_set("offset")).alias("offsets"))
    # In a sorted list of distinct offsets a window is whole if its last entry is where a gapless
    # run would put it.
    begins = F.filter("offsets", lambda x, i: F.get("offsets", i + width - 1) == x + width - 1)
    hits = F.array_distinct(F.flatten(F.transform(
        begins, lambda b: F.sequence(F.col("start") + b, F.col("start") + b + width - 1))))
    return lists.select("doc_id", "_item", "item_id", hits.alias("hits")).filter(
        F.size("hits") > 0)


def proximity_matches(index: DataFrame, items: DataFrame, terms: int, span: int) -> DataFrame:
    """Pairs (doc_id, _item) where the item's rarest distinct terms lie within `span` positions.

    Items with fewer distinct terms are not searched. Each posting is compared with the postings
    of its own item and document that follow within the span.
    """
    distinct = F.array_sort(F.array_distinct(F.transform(
        "terms", lambda t: F.struct(t["df"].alias("df"), t["word"].alias("word")))))
    rare = items.select("_item", F.slice(distinct, 1, terms).alias("rare")).filter(
        F.size("rare") == terms).select("_item", F.explode("rare").alias("r"))
    rare = materialise(rare.filter("r.df > 0").select("_item", F.col("r.word").alias("word")),
                       "rare-terms")
    near = Window.partitionBy("doc_id", "_item").orderBy("pos").rangeBetween(0, span - 1)
    return index.join(broadcast_if_small(rare), "word").select(
        "doc_id", "_item", F.size(F.collect_set("word").over(near)).alias("kinds"),
    ).filter(F.col("kinds") == terms).select("doc_id", "_item").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  near_terms: int = 4, near_span: int = 20) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, n_near.

    n_near counts the items whose `near_terms` rarest distinct terms meet within `near_span`
    words in any order; it does not enter `contaminated`.
    """
    terms = benchmark_terms(benchmark)
    vocabulary = materialise(terms.select("word").distinct(), "vocabulary")
    index = positional_index(docs, vocabulary)
    items = materialise(_with_counts(terms, index), "items-counted")
    exact = phrase_matches(index, items, window).groupBy("doc_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"))
    near = proximity_matches(index, items, near_terms, near_span).groupBy("doc_id").agg(
        F.count("*").alias("n_near"))
    headers = index.filter("n_words IS NOT NULL").select("doc_id", "n_words")
    none = F.lit(None).cast(T.ArrayType(T.StringType()))
    zero = F.lit(0).cast("long")
    rows = headers.select("doc_id", "n_words", zero.alias("n_hit"), none.alias("items"),
                          zero.alias("n_near")).unionAll(
        exact.select("doc_id", zero, "n_hit", "items", zero)).unionAll(
        near.select("doc_id", zero, zero, none, "n_near"))
    items_of = F.coalesce(F.max("items"), F.array().cast(T.ArrayType(T.StringType())))
    return rows.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.max("n_hit").alias("n_hit"),
        items_of.alias("items"), F.max("n_near").alias("n_near")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256)
        .alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "n_near")
