"""BPE encoding over a table of distinct words, and decoding by a join with the pieces."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.llm.chunks import (
    chunks,
    dealt,
    gathered,
    ordered_blob,
    ordered_from,
    squeeze,
    unsqueeze,
)
from staveline.llm.common import partitions
from staveline.llm.tokens import load
from staveline.session import settled

BATCH = 8192
# Bytes of decoded text and ids that leave a task at a time.
OUT_BYTES = 1 << 20
# Buckets that words meet in, at least; a small input is dealt like a large one.
BUCKETS = 64


def _check(vocabulary: str) -> None:
    """Only vocabularies without decoder and post-processing join their pieces by spaces."""
    tokenizer = load(vocabulary)
    if tokenizer.decoder is not None:
        raise ValueError("this vocabulary decodes by rules of its own, not by its pieces alone")


def _word_rows(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct words of each chunk: one row per bucket, words joined by spaces."""
    for chunk in chunks(batches):
        order, bounds = dealt(chunk, buckets)
        full = [b for b in range(buckets) if bounds[b] < bounds[b + 1]]
        words = [
            b" ".join(chunk.words[i] for i in order[bounds[b] : bounds[b + 1]]) for b in full
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk.key] * len(full), pa.int64()),
                pa.array(full, pa.int32()),
                pa.array(words, pa.binary()),
            ],
            names=["chunk", "bucket", "words"],
        )


def _document_rows(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Each chunk as the numbers of its words."""
    for chunk in chunks(batches):
        order, _ = dealt(chunk, buckets)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk.key], pa.int64()),
                pa.array([chunk.doc_ids], pa.list_(pa.int64())),
                pa.array([chunk.lengths.tolist()], pa.list_(pa.int64())),
                pa.array([squeeze(chunk.codes)], pa.binary()),
                pa.array([ordered_blob(order)], pa.binary()),
            ],
            names=["d_chunk", "doc_ids", "lengths", "codes", "word_order"],
        )


def _encoded_bucket(group: pa.Table, vocabulary: str) -> pa.Table:
    """Each distinct word of the bucket is encoded once; its ids go to every chunk that has it."""
    tokenizer = load(vocabulary)
    rows = [blob.split(b" ") for blob in group.column("words").to_pylist()]
    number = {w: i for i, w in enumerate(dict.fromkeys(w for row in rows for w in row))}
    distinct = [w.decode("utf-8", "replace") for w in number]
    lists = []
    for at in range(0, len(distinct), BATCH):
        found = tokenizer.encode_batch_fast(distinct[at : at + BATCH], add_special_tokens=False)
        lists.extend(np.array(e.ids, dtype=np.uint32) for e in found)
    lengths = np.array([len(x) for x in lists], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = np.concatenate(lists) if lists else np.empty(0, np.uint32)
    counts, ids, used = [], [], []
    for row in rows:
        chosen = np.fromiter((number[w] for w in row), dtype=np.int64, count=len(row))
        own = flat[gathered(starts, lengths, chosen)]
        counts.append(squeeze(lengths[chosen]))
        ids.append(squeeze(own))
        used.append(np.unique(own).tolist())
    return pa.table({
        "chunk": group.column("chunk"),
        "bucket": group.column("bucket"),
        "counts": pa.array(counts, pa.binary()),
        "ids": pa.array(ids, pa.binary()),
        "used": pa.array(used, pa.list_(pa.int32())),
    })


ASSEMBLED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _assembled(documents: pa.Table, found: pa.Table) -> pa.Table:
    """ids and decoded text of the documents of a chunk, from its words' ids and its ids' pieces.

    The table is in batches of ``OUT_BYTES``, or one document if that is longer.
    """
    if not documents.num_rows:
        raise ValueError("the documents were not read in the same order twice")
    of_words = found.filter(pc.is_valid(found.column("ids")))
    # Chunks that agree in all documents sent the same words; they are taken once.
    by_bucket = {r["bucket"]: r for r in of_words.select(["bucket", "counts", "ids"]).to_pylist()}
    counts = [unsqueeze(by_bucket[b]["counts"]) for b in sorted(by_bucket)]
    flat = [unsqueeze(by_bucket[b]["ids"]) for b in sorted(by_bucket)]
    lengths = np.concatenate([*counts, np.empty(0, np.uint32)]).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    ids = np.concatenate([*flat, np.empty(0, np.uint32)])
    of_ids = found.filter(pc.is_valid(found.column("piece")))
    piece = dict(zip(of_ids.column("id").to_pylist(), of_ids.column("piece").to_pylist()))
    batches, doc_ids, all_ids, texts, size = [], [], [], [], 0

    def packed() -> pa.RecordBatch:
        offsets = pa.array(np.cumsum([0, *map(len, all_ids)]), pa.int32())
        listed = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(all_ids), pa.int32()))
        columns = [pa.array(doc_ids, pa.int64()), listed, pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=ASSEMBLED)

    for row in documents.to_pylist():
        place = np.empty(len(lengths), dtype=np.int64)
        place[ordered_from(row["word_order"])] = np.arange(len(lengths))
        codes = unsqueeze(row["codes"])
        if len(codes) and int(codes.max()) >= len(lengths):
            raise ValueError("the documents were not read in the same order twice")
        ends = np.cumsum(row["lengths"])
        for doc_id, n, end in zip(row["doc_ids"], row["lengths"], ends):
            own = ids[gathered(starts, lengths, place[codes[end - n : end]])]
            doc_ids.append(doc_id)
            all_ids.append(own.astype(np.int32))
            texts.append(" ".join([piece[i] for i in own.tolist()]))
            size += len(texts[-1]) + 4 * len(own) + 64
            if size >= OUT_BYTES:
                batches.append(packed())
                doc_ids, all_ids, texts, size = [], [], [], 0
    if doc_ids:
        batches.append(packed())
    return pa.Table.from_batches(batches, ASSEMBLED)


def encode_and_decode(docs: DataFrame, vocabulary: str, buckets: int | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of every whole text, as the tokenizer of the file gives them.

    Texts are split at ASCII white space, which no token of a word vocabulary
    crosses. Distinct words of each chunk of documents meet by hash, and each
    distinct word of the corpus is encoded once; ids come back to the chunk by
    position. The distinct ids of a chunk are joined with the table of pieces (one
    row per id of the vocabulary, so its broadcast is bounded), which decodes them.

    Null text is empty: no ids, empty text. Rows with null or repeated doc_ids and
    repeated rows are each encoded. Other columns are not read. An empty table
    gives an empty table.

    The text itself is not shuffled, only word numbers and distinct words. A word
    that all chunks hold is one entry per chunk. The input is read twice and has to
    come in the same order, as a table does; otherwise the job fails, by the keys
    of the chunks.
    """
    _check(vocabulary)
    spark = docs.sparkSession
    n = buckets or max(BUCKETS, partitions(spark) // 8)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(False).alias("flag"), "text")
    words = slim.mapInArrow(lambda it: _word_rows(it, n), "chunk long, bucket int, words binary")
    encoded = settled(
        words.groupBy("bucket").applyInArrow(
            lambda group: _encoded_bucket(group, vocabulary),
            "chunk long, bucket int, counts binary, ids binary, used array<int>",
        ),
        "bpe-words",
    )
    vocab = load(vocabulary).get_vocab(with_added_tokens=True)
    pieces = spark.createDataFrame([(i, p) for p, i in vocab.items()], "id int, piece string")
    needed = encoded.select("chunk", F.explode("used").alias("id")).distinct()
    decoded = needed.join(F.broadcast(pieces), "id").select("chunk", "id", "piece")
    found = encoded.drop("used").unionByName(decoded, allowMissingColumns=True)
    documents = slim.mapInArrow(
        lambda it: _document_rows(it, n),
        "d_chunk long, doc_ids array<long>, lengths array<long>, codes binary, word_order binary",
    )
    both = documents.groupBy("d_chunk").cogroup(found.groupBy("chunk"))
    return both.applyInArrow(
        _assembled_or_empty, "doc_id long, ids array<int>, decoded string"
    )


def _assembled_or_empty(documents: pa.Table, found: pa.Table) -> pa.Table:
    if found.num_rows:
        return _assembled(documents, found)
    nothing = {"ids": pa.binary(), "counts": pa.binary(), "bucket": pa.int32(), "id": pa.int32(), "piece": pa.string()}
    return _assembled(documents, pa.table({k: pa.array([], t) for k, t in nothing.items()}))
