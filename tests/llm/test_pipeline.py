"""The pipeline's stages on the awkward table, each against brute force on what the stage before kept; queries against SQL."""

from __future__ import annotations

import glob
import os
import zlib

import corpus_pipeline
import duckdb
import fixtures
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
from chorale.llm import queries as llm
from chorale.llm import quality

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows = [(i, t, lang, "s", len(t) if t is not None else None) for i, t, lang, *_ in fixtures.documents()]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{n}")
        after = spark.read.parquet(f"{tmp_path}/{n}")
        rows = [tuple(r) for r in after.collect()]
        if name != "best_fit_packing":
            assert after.dtypes == docs.dtypes
        if name == "quality_rules":
            verdicts = quality.quality_rules(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
            assert len(rows) == verdicts.where("kept").count()
            assert all(not fixtures.base_quality(r[1])[5] for r in rows)
        elif name == "line_dedup":
            want = [(i, kept) for i, _, _, kept in fixtures.line_dedup(before)]
            assert fixtures.by_str(r[:2] for r in rows) == fixtures.by_str(want)
            assert all(r[4] == len(r[1]) for r in rows)
        elif name == "minhash_near_dedup":
            of = fixtures.components(before, 80)
            assert fixtures.by_str(rows) == fixtures.by_str(r for r in before if r[0] is None or of[r[0]] == r[0])
            assert len(rows) < len(before)
        elif name == "substring_dedup":
            want = [(i, *(x for x, g in zip(w, gone, strict=True) if not g)) for i, w, gone in fixtures.removed_words(before)]
            assert fixtures.by_str((r[0], *fixtures.words(r[1])) for r in rows) == fixtures.by_str(want)
        else:
            found = after.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
            assert fixtures.by_str(found) == fixtures.by_str(p for r in before for p in pieces(r[0], r[1]))
            filled = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
            assert all(r["n"] == r["end"] <= 1024 for r in filled)
        docs = after


def pieces(doc_id, text):
    """(doc_id, piece, start, length, crc) by the library."""
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
    first = len(ids) % 1024 or min(len(ids), 1024)
    starts = [0, *range(first, len(ids), 1024)]
    for k, (i, j) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
        yield doc_id, k, i, j - i, zlib.crc32(np.array(ids[i:j], "<u4").tobytes())


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_columns_of_any_name(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for name in ("kept_text", "n_removed", "n_lines", "row", "id", "text_row", "kept", "c0", "a.b"):
        docs = docs.withColumn(name, F.lit(name))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus)
        assert out.dtypes == docs.dtypes
        assert out.where("kept_text <> 'kept_text' or n_lines <> 'n_lines' or `a.b` <> 'a.b'").count() == 0
        assert out.count() > 0


def test_run(spark, corpus):
    assert corpus_pipeline.run(spark, corpus).count() > 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    df = llm.QUERIES[name](spark, SF_DIR)
    want = db.sql(llm.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert fixtures.by_str(df.select(*columns).collect()) == fixtures.by_str(tuple(r[i] for i in order) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.ORACLE_SQL)))
def test_query_covers_all_documents(spark, name):
    rows = llm.QUERIES[name](spark, SF_DIR).select("doc_id").distinct().count()
    assert rows == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
