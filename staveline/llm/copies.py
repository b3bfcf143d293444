"""Exact dedup by naming blocks, then pairs of names, until one name is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staveline.llm.common import text_or_empty, unpacked, with_row
from staveline.session import settled

BLOCK_BYTES = 8192


def integer_names(distinct: DataFrame, label: str) -> DataFrame:
    """Distinct keys in sorted order, each with an integer ``name``; stored, so names are fixed."""
    order = distinct.columns
    named = distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id())
    return settled(named, label)


def _blocks(content: Column, size: int) -> Column:
    """The bytes in blocks of a fixed size; empty content is one empty block."""
    last = F.greatest(F.ceil(F.octet_length(content) / F.lit(size)).cast("int"), F.lit(1)) - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(content, i * size + 1, F.lit(size))
    )


def _in_order(places: DataFrame) -> DataFrame:
    """(row, names in order of position)."""
    listed = F.sort_array(F.collect_list(F.struct("pos", "name")))
    return places.groupBy("row").agg(F.transform(listed, lambda x: x["name"]).alias("names"))


def exact_copies(
    docs: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """For every row the copy of its text that stays.

    The UTF-8 bytes of a text are cut into blocks of ``block_bytes``. Distinct
    blocks are sorted and get integer names; then adjacent names are paired,
    distinct pairs are sorted and named, level by level, until each row has one
    name. Two rows have the same (level, name) if and only if their texts are
    identical: every distinct block is compared by its bytes. A row looks its
    block up by fingerprint; should one fingerprint ever have two blocks, all rows
    look their blocks up by their bytes instead.

    Returns the input columns without ``text``, and keep_id (largest doc_id of the
    group), group_size, kept, text_sha256; input columns of these names are
    replaced. Null text is empty, and all empty texts are equal. A null doc_id is
    the smallest. Of rows with the same text and doc_id one stays. An empty table
    gives an empty table.

    The text is shuffled once, after distinct blocks were formed in each task, so
    copies cost nothing more; all later steps work on names. A document of L bytes
    takes log2(L / block_bytes) levels, each over half the names of the last.
    """
    content = text_or_empty().cast("binary")
    others = [c for c in docs.columns if c != "text"]
    blocks = _blocks(content, block_bytes)
    kept_columns = [
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").alias("doc"),
        F.sha2(content, 256).alias("text_sha256"),
    ]
    by_print = F.transform(blocks, lambda b: fingerprint(b)).alias("keys")
    rows = settled(with_row(docs, *kept_columns, by_print).withColumn(
        "__row", F.struct(*[F.col(f"__row.`{c}`").alias(c) for c in others])
    ), "copies-rows")
    found = docs.select(F.explode(blocks).alias("block"))
    found = found.select(fingerprint(F.col("block")).alias("key"), "block").distinct()
    distinct = settled(found.groupBy("key").agg(F.count("*").alias("n")), "copies-keys")
    if distinct.filter("n > 1").isEmpty():
        names = integer_names(distinct.select("key"), "copies-names-0")
    else:
        rows = settled(with_row(docs, *kept_columns, blocks.alias("keys")).withColumn(
            "__row", F.struct(*[F.col(f"__row.`{c}`").alias(c) for c in others])
        ), "copies-rows")
        distinct = rows.select(F.explode("keys").alias("key")).distinct()
        names = integer_names(distinct, "copies-names-0")
    places = rows.select("row", F.posexplode("keys").alias("pos", "key")).join(names, "key")
    level, open_rows = 0, settled(_in_order(places), "copies-level-0")
    done = open_rows.filter(F.size("names") == 1).select(
        "row", F.lit(0).alias("level"), F.col("names")[0].alias("name")
    )
    open_rows = open_rows.filter(F.size("names") > 1)
    while not open_rows.isEmpty():
        level += 1
        pairs = open_rows.select(
            "row",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), F.size("names") - 1, F.lit(2)),
                    lambda i: F.struct(
                        F.get("names", i).alias("left"),
                        F.coalesce(F.get("names", i + 1), F.lit(-1)).alias("right"),
                    ),
                )
            ).alias("pos", "pair"),
        ).select("row", "pos", "pair.left", "pair.right")
        names = integer_names(pairs.select("left", "right").distinct(), f"copies-names-{level}")
        joined = pairs.join(names, ["left", "right"])
        stored = settled(_in_order(joined), f"copies-level-{level}")
        done = done.unionByName(stored.filter(F.size("names") == 1).select(
            "row", F.lit(level).alias("level"), F.col("names")[0].alias("name")
        ))
        open_rows = stored.filter(F.size("names") > 1)
    identified = rows.drop("keys").join(done, "row")
    groups = identified.groupBy("level", "name").agg(
        F.max(F.struct("doc", "row")).alias("last"), F.count("*").alias("group_size")
    )
    result = (
        identified.join(groups, ["level", "name"])
        .withColumn("keep_id", F.col("last.doc"))
        .withColumn("kept", F.col("row") == F.col("last.row"))
    )
    return unpacked(result, others, "keep_id", "group_size", "kept", "text_sha256")
