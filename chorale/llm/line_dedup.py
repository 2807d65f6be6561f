"""Line dedup: drop the lines that many documents share, native DataFrame functions only.

Lines are exploded twice from the input, never together with their document: once
to count the documents of every key, once to find the positions to drop. Only
16-byte hashes, ids and positions are shuffled for that; the text itself moves
once, when a document meets its dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import LOWER, SPACES, UPPER, Scratch, col, has, shuffle_partitions, spare, text_id

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def without(text: Column, dropped: Column) -> Column:
    """``text`` without the lines at the sorted positions ``dropped`` (from 0), in time linear in its lines.

    The kept lines are the slices between neighbouring dropped positions. The
    lambda binds the split lines, so they are split once and not once a slice.
    """
    bounds = F.concat(F.array(F.lit(-1)), dropped)

    def kept(lines: Column) -> Column:
        between = F.transform(
            bounds,
            lambda at, i: F.slice(lines, at + 2, F.coalesce(F.get(bounds, i + 1), F.size(lines)) - at - 1),
        )
        return F.array_join(F.flatten(between), "\n")

    return F.when(dropped.isNull(), text).otherwise(F.element_at(F.transform(F.array(F.split(text, "\n")), kept), 1))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``docs`` with its columns and three more: ``n_lines``, ``n_dropped``, ``kept_text``. Columns of
    ``docs`` by those names are replaced.

    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines, except in the largest id that holds the key.

    - Null or empty text: one empty line, which is never dropped; ``kept_text`` is ''.
    - Rows that share an id count as one document; each keeps or loses its own lines,
      and in the largest id all of them keep the line.
    - Null ids: their lines are not counted, and go where others make the key frequent.
    - Texts and lines of any length are taken whole.
    - Empty table: empty result. Other columns pass through, whatever they are called.
    """
    has(docs, id_col, text_col)
    ident, at_text, positions = spare(docs, "line_doc", "line_text", "line_drops")
    text = F.coalesce(col(text_col), F.lit(""))
    lines = (
        docs.select(col(id_col).alias("doc"), text_id(text).alias("row"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
        .select("doc", "row", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    counted = (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    # Written, so that both sides of the join below are plain shuffles that adaptive execution can
    # split: the lines of one key may be a third of all rows. A key is one row of about 24 bytes, so
    # few tasks write them, more of them as the shuffle grows, and not a tiny file each partition.
    files = max(1, shuffle_partitions(docs.sparkSession) // 16)
    frequent = Scratch(docs.sparkSession).write(counted.repartition(files), "frequent")
    drops = (
        lines.join(frequent, ["h1", "h2"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc").alias(ident), F.col("row").alias(at_text))
        .agg(F.sort_array(F.collect_set("pos")).alias(positions))
    )
    same = text_id(text).eqNullSafe(F.col(at_text)) & col(id_col).eqNullSafe(F.col(ident))
    return docs.join(drops, same, "left").select(
        *(col(c) for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept_text")),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size(positions), F.lit(0)).cast("long").alias("n_dropped"),
        without(text, F.col(positions)).alias("kept_text"),
    )
