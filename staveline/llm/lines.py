"""Line dedup: lines found in many documents stay in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staveline.llm.common import ASCII_SPACE, LOWER, UPPER, text_or_empty, unpacked, with_row
from staveline.session import settled


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), UPPER, LOWER)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Documents without the lines that ``min_docs`` or more documents share.

    A line whose key has at least ``min_chars`` characters and is found in at
    least ``min_docs`` documents stays only in the largest doc_id that holds it
    (there with all its repetitions). All rows stay, with ``text`` rewritten,
    ``n_lines`` before dropping and ``n_dropped``; columns of these names in the
    input are replaced, all others stay.

    Null or empty text is one empty line. Rows that share a doc_id are one
    document when documents are counted; a null doc_id is a document of its own,
    smaller than all others. An empty table gives an empty table.

    Lines are exploded once, as hashes, into a stored table; the text itself is
    shuffled once, when the positions to drop meet their document. Keys are
    compared by two 64-bit hashes. A line that very many documents hold is
    pre-aggregated before the shuffle, and its join is split at run time.
    """
    lines = F.split(text_or_empty(), "\n", -1)
    copy = F.xxhash64("text").alias("copy")
    exploded = docs.select(F.col("doc_id").alias("doc"), copy, F.posexplode(lines)).select(
        "doc", "copy", "pos", line_key(F.col("col")).alias("key")
    )
    keyed = settled(
        exploded.filter(F.char_length("key") >= min_chars).select(
            "doc",
            "copy",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("second"), "key").alias("h2"),
        ),
        "line-hashes",
    )
    shared = (
        keyed.groupBy("h1", "h2")
        .agg(
            F.count_distinct(F.struct("doc")).alias("n_docs"),
            F.max(F.struct("doc")).alias("last"),
        )
        .filter(F.col("n_docs") >= min_docs)
    )
    dropped = (
        keyed.join(shared, ["h1", "h2"])
        .filter(~F.col("doc").eqNullSafe(F.col("last.doc")))
        .groupBy("doc", "copy")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    whole = with_row(docs, F.col("doc_id").alias("own_doc"), F.xxhash64("text").alias("own_copy"))
    joined = whole.join(
        dropped,
        F.col("own_doc").eqNullSafe(F.col("doc")) & (F.col("own_copy") == F.col("copy")),
        "left",
    )
    parts = F.split(F.coalesce(F.col("__row.text"), F.lit("")), "\n", -1)
    cut = (
        joined.withColumn("parts", parts)
        .withColumn("n_lines", F.size("parts").cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("dropped"), F.lit(0)).cast("long"))
        .withColumn(
            "kept",
            F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("dropped")),
        )
        .withColumn(
            "text",
            F.when(F.col("dropped").isNull(), F.col("__row.text")).otherwise(
                F.array_join(F.transform("kept", lambda i: F.get("parts", i)), "\n")
            ),
        )
    )
    return unpacked(cut, docs.columns, "text", "n_lines", "n_dropped")
