"""Phrase collocations from a weighted de Bruijn graph of the words of each language."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staveline.llm.chunks import squeeze, unsqueeze
from staveline.llm.common import partitions
from staveline.llm.stored import (
    SEED,
    bucketed,
    chunk_codes,
    chunk_columns,
    chunk_words,
    each_row,
    rolled,
    store_chunks,
    word_hashes,
)
from staveline.session import settled

CHUNK_BYTES = 12 << 20
BREAK = b"."
# Fixed values of the contract: A-Z are lower-cased; pieces end at . , ; : ! ? and U+000A to
# U+000D, here all written as one full stop; words lie between spaces and tabs.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _ENDS, b"abcdefghijklmnopqrstuvwxyz " + BREAK * len(_ENDS)
)
ID_BYTES = 8
RUN = 256
# Words of the corpus for each part that keys are counted in; a part has less than one key a word.
PART_WORDS = 2_000_000


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language as numbers, 0 where a piece ends.

    A language's chunk is full at ``CHUNK_BYTES``; all are stored when they have four times that.
    """
    held, sizes = {}, defaultdict(int)

    def packed(lang: str) -> pa.RecordBatch:
        number, codes = held.pop(lang)
        sizes.pop(lang)
        joined = np.concatenate(codes)
        n = pa.array([int(np.count_nonzero(joined))], pa.int64())
        columns = [pa.array([lang], pa.string()), n, *chunk_columns(list(number), joined)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "n", "words", "codes"])

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
        for lang, value in zip(langs, texts):
            if lang not in held:
                number = defaultdict(int, {BREAK: 0})
                number.default_factory = number.__len__
                held[lang] = (number, [])
            number, codes = held[lang]
            text = value.as_py() or b""
            words = text.translate(_TABLE).replace(BREAK, b" . ").split()
            words.append(BREAK)
            codes.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
            sizes[lang] += len(text) + 64
            if sizes[lang] >= CHUNK_BYTES:
                yield packed(lang)
            elif sum(sizes.values()) >= 4 * CHUNK_BYTES:
                yield from map(packed, list(held))
    yield from map(packed, list(held))


def _ids(row: dict[str, pa.Scalar]) -> tuple[np.ndarray, list[bytes]]:
    """64-bit numbers of the words of a chunk, in its language; the break is 0."""
    words = chunk_words(row["words"])
    ids = word_hashes(words, xxhash.xxh64_intdigest(row["lang"].as_py().encode(), SEED))
    ids[0] = 0
    return ids, words


def _wide(numbers: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, compressed byte by byte of their width."""
    planes = np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _from_wide(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _counted(row: dict[str, pa.Scalar], keys: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row for each part of the range of keys: ascending keys as steps, and their counts."""
    of = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    bounds = np.searchsorted(of, np.arange(parts + 1))
    full = np.flatnonzero(bounds[:-1] < bounds[1:])
    cuts = [slice(bounds[p], bounds[p + 1]) for p in full]
    columns = [
        pa.array(full.astype(np.int32)),
        pa.array(np.full(len(full), row["chunk"].as_py(), np.int64)),
        pa.array([_wide(np.diff(keys[c], prepend=np.uint64(0))) for c in cuts], pa.binary()),
        pa.array([squeeze(n[c]) for c in cuts], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "chunk", "keys", "counts"])


COUNTED = "part int, chunk long, keys binary, counts binary"
SUMMED = "part int, chunk long, state binary, totals binary"


def _summed(group: pa.Table, min_count: int) -> pa.Table:
    """The state of each key of a part in each chunk: 0 if too rare, else 1, or 2 in its first chunk.

    ``totals`` are the counts over all chunks of those in state 2.
    """
    group = group.sort_by("chunk")
    steps = [np.cumsum(_from_wide(b), dtype=np.uint64) for b in group.column("keys").to_pylist()]
    ends = np.cumsum([0, *map(len, steps)])
    keys = np.concatenate(steps)
    n = np.concatenate([unsqueeze(b) for b in group.column("counts").to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])
    each = np.add.reduceat(n[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    state, totals = np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.uint64)
    state[order], totals[order] = (each >= min_count) * (1 + new), each
    zipped = zstandard.ZstdCompressor(level=3)
    cuts = [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]
    return pa.table({
        "part": group.column("part"),
        "chunk": group.column("chunk"),
        "state": pa.array([zipped.compress(state[c].tobytes()) for c in cuts], pa.binary()),
        "totals": pa.array([_wide(totals[c][state[c] == 2]) for c in cuts], pa.binary()),
    })


def _states(found: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """The states of all keys of a chunk, in order of the keys, and the totals of those in state 2."""
    parts = found.as_py()
    unzipped = zstandard.ZstdDecompressor()
    state = b"".join(unzipped.decompress(p["state"]) for p in parts)
    return np.frombuffer(state, np.uint8), np.concatenate([_from_wide(p["totals"]) for p in parts]).astype(np.int64)


def _word_keys(row: dict[str, pa.Scalar]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of a chunk as 64-bit numbers, the numbers of its words in order of these, and the words."""
    ids, words = _ids(row)
    return ids, np.argsort(ids[1:]) + 1, words


def _word_counts(row: dict[str, pa.Scalar], parts: int) -> Iterator[pa.RecordBatch]:
    ids, order, _ = _word_keys(row)
    n = np.bincount(chunk_codes(row["codes"]), minlength=len(ids))
    yield _counted(row, ids[order], n[order], parts)


def _frequent(row: dict[str, pa.Scalar]) -> np.ndarray:
    """All words of a chunk in order as 64-bit numbers; breaks and rare words are 0."""
    ids, order, _ = _word_keys(row)
    ids[order[_states(row["frequent"])[0] == 0]] = 0
    return ids[chunk_codes(row["codes"])]


def _pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each two words in a row, and whether both are frequent."""
    return rolled(words, 2), (words[:-1] != 0) & (words[1:] != 0)


def _pair_counts(row: dict[str, pa.Scalar], parts: int) -> Iterator[pa.RecordBatch]:
    pairs, both = _pairs(_frequent(row))
    keys, n = np.unique(pairs[both], return_counts=True)
    yield _counted(row, keys, n, parts)


def _grams(words: np.ndarray, places: np.ndarray, size: int) -> pa.Array:
    """The ids of ``size`` words from each place on, as bytes."""
    text = words[places[:, None] + np.arange(size)].astype(">u8").tobytes()
    ends = np.arange(len(places) + 1, dtype=np.int32) * (size * ID_BYTES)
    return pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(ends), pa.py_buffer(text)])


def _own_words(row: dict[str, pa.Scalar]) -> Iterator[pa.RecordBatch]:
    """(gram, n, lang, word) of the frequent words that this chunk has to tell of."""
    ids, order, words = _word_keys(row)
    state, n = _states(row["frequent"])
    mine = order[state == 2]
    texts = pa.array([words[i] for i in mine], pa.binary()).cast(pa.string())
    langs = pa.array([row["lang"].as_py()] * len(mine), pa.string())
    yield pa.RecordBatch.from_arrays([_grams(ids, mine, 1), pa.array(n), langs, texts], ["gram", "n", "lang", "word"])


def _own_pairs(row: dict[str, pa.Scalar]) -> Iterator[pa.RecordBatch]:
    """(gram, n) of the frequent pairs that this chunk has to tell of."""
    words = _frequent(row)
    pairs, both = _pairs(words)
    places = np.flatnonzero(both)
    state, n = _states(row["pairs"])
    _, first = np.unique(pairs[places], return_index=True)
    yield pa.RecordBatch.from_arrays([_grams(words, places[first[state == 2]], 2), pa.array(n)], ["gram", "n"])


def _runs(row: dict[str, pa.Scalar], longest: int) -> Iterator[pa.RecordBatch]:
    """(run, starts): words of a piece in which each two neighbours are a frequent pair.

    Runs of three words or more. ``starts`` is how many places of the run grams of three
    words or more start at; a long run comes in several rows, with the words behind.
    """
    words = _frequent(row)
    pairs, both = _pairs(words)
    _, of_pair = np.unique(pairs[both], return_inverse=True)
    joined = np.zeros(len(both) + 2, bool)
    joined[1:-1][both] = _states(row["pairs"])[0][of_pair] > 0
    first = np.flatnonzero(joined[1:] & ~joined[:-1])
    starts = np.flatnonzero(joined[:-1] & ~joined[1:]) - first - 1
    # Cut after RUN starts; all but the last piece of a run are followed by more words.
    pieces = -(-starts // RUN)
    of = np.repeat(np.arange(len(first)), pieces)
    step = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * RUN
    begin, n = first[of] + step, np.minimum(starts[of] - step, RUN)
    size = np.minimum(n + longest - 1, starts[of] - step + 2)
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])
    text = words[at].astype(">u8").tobytes()
    offsets = (ends * ID_BYTES).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
    yield pa.RecordBatch.from_arrays([runs, pa.array(n.astype(np.int32))], ["run", "starts"])


def _reaching(chunks: DataFrame, counted: Callable, parts: int, min_count: int, label: str) -> DataFrame:
    """(chunk, found): which keys of each chunk reach the count over all chunks.

    A chunk sends its keys as one row for each part of their range, and gets back a
    state for each in their order; a frequent key is one entry a chunk.
    """
    rows = chunks.mapInArrow(each_row(lambda row: counted(row, parts)), COUNTED)
    states = rows.groupBy("part").applyInArrow(lambda group: _summed(group, min_count), SUMMED)
    in_order = F.sort_array(F.collect_list(F.struct("part", "state", "totals")))
    return bucketed(states.groupBy("chunk").agg(in_order.alias("found")), label)


def _flows(runs: DataFrame, longest: int) -> list[DataFrame]:
    """(gram, n) of all grams of ``longest`` words, of one word less, and so on to three.

    Edges have ``longest`` words and are summed over all runs. A shorter gram occurs as
    often as the longer ones that begin with it, and the runs that end with it.
    """
    start = F.sequence(F.lit(0), F.col("starts") - 1)
    gram = F.transform(start, lambda i: F.col("run").substr(i * ID_BYTES + 1, F.lit(longest * ID_BYTES)))
    grams = runs.select(F.explode(gram).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    edges = settled(grams, "phrase-edges")
    levels: list[DataFrame] = []
    for size in range(longest, 2, -1):
        rows = edges.filter(F.octet_length("gram") == size * ID_BYTES)
        if levels:
            flow = levels[-1].select(F.substring("gram", 1, size * ID_BYTES).alias("gram"), "n")
            rows = rows.unionByName(flow).groupBy("gram").agg(F.sum("n").alias("n"))
        levels.append(settled(rows, "phrase-flow"))
    return levels


def _compacted(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one carries along whole.

    An edge that takes all occurrences of a node along (into it or out of it) makes
    both one path: the shorter phrase goes. Steps of one word are enough, as counts
    between a phrase and a longer one that is as frequent are the same.
    """
    longer = phrases.filter("size > 2")
    inner = F.array(
        F.expr(f"substring(gram, 1, (size - 1) * {ID_BYTES})"), F.expr(f"substring(gram, {ID_BYTES + 1})")
    )
    along = longer.select(F.explode(inner).alias("gram"), "n").groupBy("gram").agg(F.max("n").alias("carried"))
    met = phrases.filter("size > 1").join(along, "gram", "left")
    return met.filter("carried IS NULL OR carried < n").drop("carried")


def collocations(docs: DataFrame, longest: int = 5, min_count: int = 100, top: int = 2000) -> DataFrame:
    """The phrases of each language whose words belong together most.

    Texts are lower-cased in A-Z and split into pieces at ``.,;:!?`` and the line ends
    U+000A to U+000D, pieces into words at spaces and tabs. Candidates are phrases of 2
    to ``longest`` words that occur ``min_count`` times within pieces of a language,
    overlaps included. A candidate of count a, cut in two parts of counts l and r, has
    the score floor(1000 * a * n / (l * r)), n being all words of the language; its
    lowest-scoring cut counts, of equal ones the one after fewer words. Candidates
    contained in a longer one of the same count are dropped. All numbers are exact.

    Returns each language's first ``top`` by score, then a (both descending), then
    phrase in byte order: (lang, rank, phrase, a, l, r, n, score). A null lang is
    ``und``; null or empty texts have no words; repeated rows count each; other columns
    are not read; an empty table gives an empty table. Very long texts are counted whole.

    Words, then pairs of words, that are rarer than a candidate may be end a run of words,
    as they are in no candidate; counting them gives the counts of the others. The rest
    is a de Bruijn graph: nodes are ``longest`` - 1 words, edges ``longest`` words with
    their counts. Edges are summed once; shorter grams, down to three words, have the
    flow out of them, and the runs that end with them. Unary paths are compacted, so that a phrase stays only where another word
    may follow or precede it. 64-bit hashes stand for words and pairs.
    """
    slim = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = store_chunks(
        slim.mapInArrow(_chunks, "lang string, n long, words binary, codes binary"), "phrase-chunks"
    )
    parts = max(partitions(docs.sparkSession), -(-(chunks.agg(F.sum("n")).first()[0] or 0) // PART_WORDS))
    words = _reaching(chunks, _word_counts, parts, min_count, "phrase-words").withColumnRenamed("found", "frequent")
    known = chunks.join(words, "chunk")
    spelt = known.mapInArrow(each_row(_own_words), "gram binary, n long, lang string, word string")
    spelt = settled(spelt, "phrase-spelt")
    pairs = _reaching(known, _pair_counts, parts, min_count, "phrase-pairs").withColumnRenamed("found", "pairs")
    linked = known.join(pairs, "chunk")
    levels = _flows(linked.mapInArrow(each_row(lambda row: _runs(row, longest)), "run binary, starts int"), longest)
    levels = [*levels, linked.mapInArrow(each_row(_own_pairs), "gram binary, n long"), spelt.select("gram", "n")]
    size = (F.octet_length("gram") / ID_BYTES).cast("int").alias("size")
    flows = reduce(DataFrame.unionByName, levels).filter(F.col("n") >= min_count)
    phrases = settled(flows.select("gram", size, "n"), "phrase-counts")

    part = phrases.select("gram", "n")
    cut = _compacted(phrases).withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cut = cut.withColumn("head", F.expr(f"substring(gram, 1, k * {ID_BYTES})"))
    cut = cut.withColumn("tail", F.expr(f"substring(gram, k * {ID_BYTES} + 1)"))
    cut = cut.withColumnRenamed("n", "a")
    cut = cut.join(part.select(F.col("gram").alias("head"), F.col("n").alias("l")), "head")
    cut = cut.join(part.select(F.col("gram").alias("tail"), F.col("n").alias("r")), "tail")
    # The first word tells the language.
    word = spelt.select(F.col("gram").alias("first"), "lang", "word")
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    scored = (
        cut.withColumn("first", F.substring("gram", 1, ID_BYTES))
        .join(word.drop("word"), "first")
        .join(totals, "lang")
        .withColumn("score", F.expr(
            "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)))"
            " div (CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0)))"
        ))
    )
    lowest = scored.groupBy("lang", "gram", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    places = lowest.withColumn("i", F.explode(F.expr("sequence(0, size - 1)")))
    places = places.withColumn("first", F.expr(f"substring(gram, i * {ID_BYTES} + 1, {ID_BYTES})"))
    named = places.join(word.drop("lang"), "first")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"])
    phrased = named.groupBy("lang", "gram", "a", "n", "low").agg(F.array_join(in_order, " ").alias("phrase"))
    phrased = phrased.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # First within parts of a language, so that no task sorts all of one.
    salt = F.pmod(F.hash("phrase"), F.lit(partitions(docs.sparkSession)))
    in_part = Window.partitionBy("lang", "salt").orderBy(*best)
    near = phrased.withColumn("salt", salt).withColumn("rank", F.row_number().over(in_part)).filter(F.col("rank") <= top)
    over = Window.partitionBy("lang").orderBy(*best)
    ranked = near.withColumn("rank", F.row_number().over(over).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
