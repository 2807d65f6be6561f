"""A training-data pipeline over ``documents``, each stage one operator of ``chorale.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.

Every stage takes what its operator takes: null ids, languages and texts, empty and very long texts,
ties, repeated rows, rows that share an id, and columns of any name beside doc_id, text and lang.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm import line_dedup, minhash, packing, quality, substring
from chorale.llm.common import Scratch

#: No SQL for the whole: tokenisers and learnt bands are not SQL. Tests hold each stage against brute force.
ORACLE_SQL = None

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _rewritten(docs: DataFrame, operator: Callable[..., DataFrame]) -> DataFrame:
    """The columns of ``docs`` with the operator's ``kept_text`` for the text, and its length. The operator
    sees numbered columns, so that no column of ``docs`` can clash with its own."""
    numbered = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    out = operator(docs.toDF(*numbered.values()), id_col=numbered["doc_id"], text_col=numbered["text"])
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*(new.get(c, F.col(n)).alias(c) for c, n in numbered.items()))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null and empty texts among them. Repeated rows go or stay together;
    texts of any length are measured whole."""
    verdicts = quality.quality_rules(docs, public_tokenizers.path(BPE), public_tokenizers.path(PIECES))
    return quality.keep(docs, verdicts)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the largest id of them. A null text becomes an empty one; rows that share
    an id, and repeated rows, are one document and all keep their lines."""
    return _rewritten(docs, line_dedup.line_dedup)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (Jaccard 0.8 over 5-word shingles) the least id stays, with all its rows. Null ids
    and texts without a word have no duplicates and stay."""
    return minhash.keep(docs, minhash.near_duplicates(docs))


def drop_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a smaller id holds too go. Null ids lose nothing; rows that share an id take nothing from
    each other."""
    return _rewritten(docs, substring.substring_dedup)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' tokens as pieces of sequences of at most 1024 tokens. Every row is a document of its own; an empty text
    is the end token alone."""
    return packing.best_fit_packing(docs, public_tokenizers.path(BPE), with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", drop_substrings),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.write(docs, name)
            if i:
                scratch.drop(STAGES[i - 1][0])
    return docs
