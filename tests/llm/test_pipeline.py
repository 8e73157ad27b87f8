"""The pipeline and the queries on the driver's small tables."""

import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from padron.llm import mixing, quality_rules
from padron.llm.oracle import ORACLE_SQL
from padron.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES, WORD_BPE
from tests.llm import test_simhash
from tests.llm.helpers import EDGE, documents, words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(ORACLE_SQL) <= set(entry_point.oracle_sql())
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    rows = [tuple(map(str, r)) for r in df.select(*columns).collect()]
    assert sorted(rows) == sorted(tuple(map(str, r)) for r in result.fetchall())


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


def test_token_queries(spark):
    docs = sorted(read(spark, "documents"), key=lambda r: r.doc_id)
    byte, word = Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)
    counts = {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    files = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_token_files"](spark, SF).collect()}
    start = 0
    for r in docs:
        n = len(byte.encode(r.text or "", add_special_tokens=False))
        assert counts[r.doc_id] == (len((r.text or "").encode()), n, n > 1024)
        ids = [*word.encode(r.text or "", add_special_tokens=False).ids, 1]
        assert files[r.doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def contaminated(text, items):
    w = words(text)
    for item in items:
        t = words(item)
        n = min(10, len(t))
        wanted = {tuple(t[o:o + n]) for o in range(len(t) - n + 1)} if n else set()
        if wanted & {tuple(w[o:o + n]) for o in range(len(w) - n + 1)}:
            return True
    return False


def test_pipeline_by_brute_force(spark):
    docs = {r.doc_id: r for r in read(spark, "documents")}
    verdict = {r.doc_id: r.kept for r in quality_rules.judge(
        spark.read.parquet(f"{SF}/documents.parquet"), PIECE_BPE).collect()}
    kept = sorted(d for d in docs if verdict[d])
    roots = test_simhash.brute_roots([test_simhash.brute_print(docs[d].text) for d in kept])
    kept = [d for i, d in enumerate(kept) if roots[i] == i]
    items = [r.text for r in read(spark, "benchmark")]
    kept = [d for d in kept if not contaminated(docs[d].text, items)]
    plan = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet").filter(
        f"doc_id IN ({','.join(map(str, kept))})")).collect()
    order = [r.doc_id for r in sorted(plan, key=lambda r: (r.slot, r.place))]
    word = Tokenizer.from_file(WORD_BPE)
    expected, start = [], 0
    for d in order:
        ids = [*word.encode(docs[d].text or "", add_special_tokens=False).ids, 1]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    out = entry_point.queries()["pipeline"](spark, SF).collect()
    assert sorted(map(tuple, out)) == sorted(expected)
    assert len(expected) < len(docs)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() > 0


@pytest.mark.parametrize("rows", [[], EDGE])
def test_stages_take_awkward_rows(spark, tmp_path, rows):
    docs = documents(spark, rows)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / f"{i}{len(rows)}"))
        docs = spark.read.parquet(str(tmp_path / f"{i}{len(rows)}"))
        out = stage(spark, docs, SF)
        assert out.count() <= len(rows)
        if name != "quality":  # it rejects all of these, so the others see them unfiltered
            docs = out


def test_near_dedup_of_repeated_ids(spark):
    text, other = (" ".join(f"{p}{i}" for i in range(60)) for p in "ab")
    def kept(rows):
        out = corpus_pipeline.near_dedup(spark, documents(spark, rows, clash=False), SF)
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    copies = [(3, text), (3, text), (5, text)]
    assert kept(copies) == [(3, text)]
    assert kept([*copies, (None, other)]) == [(3, text), (None, other)]
    assert kept([*copies, (None, text), (None, other)]) == [(3, text)]
