"""Divergence of sources against a plain count of terms."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from padron.llm import source_divergence as audit
from tests.llm.helpers import EDGE, documents, lower_ascii


def brute(rows, min_docs, top):
    terms = [(lang or "", source or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text or "")))
        for _, text, lang, source in rows]
    groups = {(lang, source) for lang, source, _ in terms}
    df, tf = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in terms:
        df[lang].update(set(words))
        tf[lang, source].update(words)
        tf[lang, None].update(words)
    out = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= min_docs]

        def shares(group):
            n = sum(tf[group][t] for t in kept)
            return {t: 1 + 10 ** 9 * (tf[group][t] + 2) // (n + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = shares((lang, source)), shares((lang, None))
        pairs = []
        for other in {s for g, s in groups if g == lang} - {source}:
            r = shares((lang, other))
            pairs.append((other, sum(f(p[t], r[t]) for t in kept)))
        own = [(t, f(p[t], q[t])) for t in kept if tf[lang, source][t] and p[t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", own, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i)
                    for i, (item, value) in enumerate(found[:limit], 1)]
    return sorted(out)


def result(spark, rows, **kw):
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, audit.audit_sources(documents(spark, rows), **kw).select(
        *columns).collect()))


def corpus():
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] + ["É", "é", "日本"]
    rows = []
    for i in range(60):
        text = " ".join(words[(i * k * k + k) % len(words)] for k in range(3, 3 + i)) + " the The"
        rows.append((i, text, ("en", "de", None)[i % 3], ("hot", "hot", "b", "c", None)[i % 5]))
    return rows


def test_brute_force(spark):
    for min_docs, top in ((3, 10), (1, 4)):
        assert result(spark, corpus(), min_docs=min_docs, top=top) == brute(
            corpus(), min_docs, top)


def test_awkward_rows(spark):
    rows = [(*r, "en", "s")[:4] for r in EDGE] + [(9, None, "xx", "a"), (9, "", "xx", "b"),
                                                  (9, "q1w2 q", None, None)]
    assert result(spark, rows, min_docs=2) == brute(rows, 2, 10)
    pairs = [r for r in result(spark, rows, min_docs=2) if r[0] == "xx"]
    assert pairs == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]
    assert result(spark, []) == []


def test_levels_hold_every_kept_term_once(spark):
    docs = documents(spark, corpus()).na.fill("")
    kept = audit.kept_terms(docs, 2)
    bitmaps = audit.level_bitmaps(kept)
    groups = audit.group_sizes(docs, kept)
    # In each chunk the levels of a group, with that of the terms it lacks, are disjoint.
    rows = audit.chunk_levels(bitmaps, groups).select("lang", F.explode("all").alias("g")).select(
        "lang", "g.source", F.aggregate("g.levels", F.lit(0), lambda n, x: n + F.bit_count(
            x["bits"]).cast("int")).alias("terms"))
    sums = rows.groupBy("lang", "source").agg(F.sum("terms").alias("n")).collect()
    sizes = {(r.lang, r.source): r.v for r in groups.collect()}
    assert {(r.lang, r.source): r.n for r in sums} == sizes
    assert max(sizes.values()) > audit.CHUNK
