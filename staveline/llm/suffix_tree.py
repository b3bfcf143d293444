"""Language-model scores by a probabilistic suffix tree over words."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.llm.chunks import chunks, squeeze, unsqueeze
from staveline.llm.common import held_out, partitions
from staveline.llm.stored import (
    bucketed,
    chunk_codes,
    chunk_columns,
    chunk_words,
    each_row,
    few_rows_a_batch,
    listed,
    store_chunks,
)
from staveline.session import release, settled

# A word is a symbol of its own from this count on; words seen once are one symbol,
# shared out by their own counts.
SYMBOL = 2
# A context is tried, and a next symbol of it stored, from these counts on.
CONTEXT = 2
ENTRY = 2
DEPTH = 3
CHUNK_BYTES = 5 << 20
BATCH = 2  # chunks with their answers that go to a worker at once
# A context stays if its counts tell it from its suffix by so many nats for each stored symbol.
DIVERGENCE = 3.0
# Weight of the shorter context, in occurrences.
PRIOR = 8.0


CHUNK = "doc_ids array<long>, flags array<boolean>, lengths array<long>, hashes binary, words binary, codes binary"
WORDS = "chunk long, bucket int, words binary, counts binary, tokens long, documents long"
COUNTED = (
    "chunk long, bucket int, totals binary, distinct long, once long, twice long, tokens long, documents long"
)
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"
ANSWER = "chunk long, kind int, bucket int, blob binary"
MESSAGE = "chunk long, kind int, bucket int, keys binary, body binary"
# Stand for the rare words and the end where symbols are hashes.
ROUND = "round_"  # columns with the answers of each round
SPARE_BITS = np.uint64(8)  # of the 64 of a hash; 56 stand for a gram
RARE_HASH, END_HASH = (np.uint64(xxhash.xxh3_64_intdigest(b" " + x)) for x in (b"rare", b"end"))


def _sequence(codes: np.ndarray, lengths: np.ndarray, of_word: np.ndarray, end: int) -> np.ndarray:
    """All documents of a chunk as symbols, each with an end before and behind it.

    The end of one document is the start of the next.
    """
    out = np.full(int(lengths.sum()) + len(lengths) + 1, end, dtype=np.int64)
    inside = np.arange(int(lengths.sum())) + np.repeat(np.arange(1, len(lengths) + 1), lengths)
    out[inside] = of_word[codes] if len(codes) else codes
    return out


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays compressed byte by byte of their width, without the high bytes that no number needs."""
    press = zstandard.ZstdCompressor(level=1)

    def planes(a: np.ndarray) -> tuple[str, int, bytes]:
        width = a.dtype.itemsize
        if a.dtype.kind in "iu" and len(a) and a.min() >= 0:
            width = max(-(-int(a.max()).bit_length() // 8), 1)
        columns = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T[:width]
        return a.dtype.str, width, press.compress(columns.tobytes())

    return pickle.dumps([planes(a) for a in arrays])


def _unpacked(blob: bytes) -> list[np.ndarray]:
    press = zstandard.ZstdDecompressor()

    def array(kind: str, width: int, planes: bytes) -> np.ndarray:
        columns = np.frombuffer(press.decompress(planes), np.uint8).reshape(width, -1)
        rows = np.zeros((columns.shape[1], np.dtype(kind).itemsize), np.uint8)
        rows[:, :width] = columns.T
        return rows.view(kind).ravel()

    return [array(*a) for a in pickle.loads(blob)]


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes of grams as the steps between them."""
    return _packed(np.diff(keys >> SPARE_BITS, prepend=np.uint64(0)))


def _unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob)[0], dtype=np.uint64) << SPARE_BITS


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of hashes, the order of a pair counting."""
    z = a * np.uint64(0x9E3779B97F4A7C15) + b
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> SPARE_BITS) << SPARE_BITS


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys; buckets are ranges of hashes."""
    of_key = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(of_key, np.arange(buckets + 1, dtype=np.uint64))


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of hashes in order, sorted as numbers that hold the place in the last bits."""
    places = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort((keys & ~places) | np.arange(len(keys), dtype=np.uint64)) & places).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():  # hashes that differ in these bits only
        order = np.argsort(keys, kind="stable")
    return order


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, some place of each, and the number of each place's key.

    As ``np.unique``, in a fraction of its time.
    """
    order = _order(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], number


def _chunk_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, lower=True, limit=CHUNK_BYTES):
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chunk.words), np.uint64, len(chunk.words))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk.doc_ids], pa.list_(pa.int64())),
                pa.array([chunk.flags], pa.list_(pa.bool_())),
                pa.array([chunk.lengths.tolist()], pa.list_(pa.int64())),
                pa.array([hashes.tobytes()], pa.binary()),
                *chunk_columns(chunk.words, chunk.codes),
            ],
            names=["doc_ids", "flags", "lengths", "hashes", "words", "codes"],
        )


def _by_hash(blob: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a chunk, and the word numbers in their order, in which words are sent."""
    hashes = np.frombuffer(blob.as_py(), np.uint64)
    return hashes, _order(hashes)


def _word_rows(row: dict[str, pa.Scalar], buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct words of a chunk with their counts in training documents."""
    hashes, order = _by_hash(row["hashes"])
    cuts = _cuts(hashes[order], buckets)
    words, flags = chunk_words(row["words"]), listed(row["flags"], bool)
    train = np.repeat(flags, listed(row["lengths"]))
    counts = np.bincount(chunk_codes(row["codes"])[train], minlength=len(words))
    spans = [order[i:j] for i, j in zip(cuts, cuts[1:])]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([row["chunk"].as_py()] * buckets, pa.int64()),
            pa.array(range(buckets), pa.int32()),
            pa.array([b" ".join(words[i] for i in s) for s in spans], pa.binary()),
            pa.array([squeeze(counts[s]) for s in spans], pa.binary()),
            pa.array([int(counts.sum())] * buckets, pa.int64()),
            pa.array([int(flags.sum())] * buckets, pa.int64()),
        ],
        names=["chunk", "bucket", "words", "counts", "tokens", "documents"],
    )


def _counted(group: pa.Table) -> pa.Table:
    """Training counts of the words of the bucket, summed, for each chunk that has them."""
    total: Counter[bytes] = Counter()
    rows = []
    for blob, counts in zip(group.column("words").to_pylist(), group.column("counts").to_pylist()):
        words = blob.split(b" ") if blob else []
        rows.append(words)
        for word, n in zip(words, unsqueeze(counts).tolist()):
            total[word] += n
    seen = [n for n in total.values() if n]
    blobs = [_packed(np.array([total[w] for w in row], dtype=np.int64)) for row in rows]
    n = len(rows)

    def summary(value: int) -> pa.Array:
        return pa.array([*[0] * n, value], pa.int64())

    return pa.table({
        "chunk": pa.array([*group.column("chunk").to_pylist(), None], pa.int64()),
        "bucket": pa.array([group.column("bucket")[0].as_py()] * (n + 1), pa.int32()),
        "totals": pa.array([*blobs, b""], pa.binary()),
        "distinct": summary(len(seen)),
        "once": summary(sum(c == 1 for c in seen)),
        "twice": summary(sum(c == 2 for c in seen)),
        "tokens": summary(pc.sum(group.column("tokens")).as_py()),
        "documents": summary(pc.sum(group.column("documents")).as_py()),
    })


@dataclass
class Totals:
    """What all training documents add up to."""

    words: int
    documents: int
    distinct: int  # words, and the end
    once: int
    discount: float
    unknown: float

    @property
    def rare(self) -> float:
        """Discounted counts of all rare words and the unknown one."""
        return self.once * (1 - self.discount) + self.unknown

    @property
    def mass(self) -> float:
        seen = self.distinct - (self.documents > 0)
        return self.words - self.discount * seen + self.unknown + max(self.documents, 0.5)


def _totals(summary: DataFrame) -> Totals:
    rows = summary.collect()
    words, documents = (sum(r[c] for r in rows[:1]) for c in ("tokens", "documents"))
    distinct = sum(r["distinct"] for r in rows)
    once, twice = sum(r["once"] for r in rows), sum(r["twice"] for r in rows)
    discount = once / (once + 2 * twice) if once else 0.0
    unknown = max(discount * distinct, 0.5)
    return Totals(words, documents, distinct + (documents > 0), once, discount, unknown)


class _Walk:
    """The tokens of a chunk, level by level, as far as the buckets have answered.

    Answers come in the order of the sorted hashes that were asked for. ``p`` is the
    probability of each next symbol under the contexts answered so far, which is also
    what the next level is tested against.
    """

    def __init__(self, row: dict[str, pa.Scalar], totals: Totals):
        self.chunk = row["chunk"].as_py()
        self.answers: dict[int, dict[int, pa.Scalar]] = {}
        for name, given in row.items():
            if name.startswith(ROUND) and given.values is not None:
                kind, bucket, blob = given.values.flatten()
                for i in range(len(blob)):
                    self.answers.setdefault(kind[i].as_py(), {})[bucket[i].as_py()] = blob[i]
        self.doc_ids = row["doc_ids"].as_py()
        hashes, order = _by_hash(row["hashes"])
        count = np.empty(len(order), dtype=np.int64)
        count[order] = self._answer(0)[0]
        # Words from SYMBOL on, then known rare words, unknown ones, and the end.
        often = count >= SYMBOL
        n = int(often.sum())
        of_word = np.where(often, np.cumsum(often) - 1, np.where(count > 0, n, n + 1))
        counts, hashes = count[often], hashes[often]
        self.lengths = listed(row["lengths"])
        self.x = _sequence(chunk_codes(row["codes"]), self.lengths, of_word, n + 2)
        self.train = np.repeat(listed(row["flags"], bool), self.lengths + 1)
        self.rare = len(counts)
        self.end = self.rare + 2
        self.all = totals
        self.counts = np.concatenate([counts, [totals.once, totals.once, totals.documents]])
        tail = np.array([RARE_HASH, RARE_HASH, END_HASH], np.uint64)
        hashes = np.concatenate([hashes, tail])
        self.hashes = hashes[self.x]
        self.nxt = self.x[1:]
        root = np.concatenate([counts - totals.discount, [totals.rare, totals.rare, max(totals.documents, 0.5)]])
        self.p = (root / totals.mass)[self.nxt]
        self.context = self.hashes[:-1]
        self.times = self.counts[self.x[:-1]]  # training count of each context
        self.at = np.arange(len(self.nxt))
        symbols, _, of_symbol = _distinct(hashes)
        self._contexts(symbols, of_symbol[self.x[:-1]])
        self._grams(np.ones(len(self.at), bool))

    def _contexts(self, keys: np.ndarray, of_key: np.ndarray) -> None:
        """Distinct contexts, in order, of the sorted keys that they are among."""
        used = np.zeros(len(keys), bool)
        used[of_key] = True
        self.contexts, self.of_context = keys[used], (np.cumsum(used, dtype=np.int32) - 1)[of_key]

    def _grams(self, asked: np.ndarray) -> None:
        """Distinct grams that are asked for: the contexts and the symbols behind them."""
        self.asked = np.flatnonzero(asked)
        self.keys = _mixed(self.context[self.asked], self.hashes[1:][self.at[self.asked]])
        self.grams, self.first, self.of_gram = _distinct(self.keys)

    def _answer(self, kind: int) -> list[np.ndarray]:
        """The answers of all buckets, one after the other."""
        found = self.answers.get(kind, {})
        parts = [_unpacked(found[b].as_py()) for b in sorted(found)]
        out = [np.concatenate(p) for p in zip(*parts)]
        return out or [np.empty(0, np.int64), np.empty(0, bool)]

    def gram_rows(self) -> tuple[np.ndarray, list[np.ndarray]]:
        n = np.bincount(self.of_gram[self.train[self.at[self.asked]]], minlength=len(self.grams))
        return self.grams, [n]

    def counted(self, level: int) -> None:
        """Take the counts of the grams in; a gram that was not asked for has none."""
        self.n_gram, self.own = self._answer(2 * level)
        self.n = np.zeros(len(self.at), np.int64)
        self.n[self.asked] = self.n_gram[self.of_gram]

    def context_rows(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sums over the stored grams that this chunk reports, for each of its contexts.

        What the bucket can tell by itself is zero, which takes no room: the count of a context
        without such grams, and the sum of logarithms over a single one.
        """
        own = np.flatnonzero(self.own)
        n = self.n_gram[own]
        place = self.asked[self.first[own]]
        context, p = self.of_context[place], self.p[self.at[place]]
        many = len(self.contexts)
        each = n * np.log(n / np.maximum(p, 1e-300))
        stored = np.bincount(context, n, minlength=many).astype(np.int64)
        logs, expected = (np.bincount(context, w, minlength=many).astype(float) for w in (each, p))
        grams = np.bincount(context, minlength=many)
        total = np.zeros(many, np.int64)
        total[self.of_context] = self.times
        total[grams == 0] = 0
        return self.contexts, [total, stored, grams, np.where(grams > 1, logs, 0.0), expected]

    def mixed(self, level: int) -> None:
        """Take the test of the contexts in."""
        # One more than the sum of the stored grams; zero for a context that is not in the tree.
        stored = self._answer(2 * level + 1)[0][self.of_context] if len(self.contexts) else np.empty(0)
        kept = np.flatnonzero(stored)
        at, total = self.at[kept], self.times[kept] + PRIOR
        self.p[at] = self.n[kept] / total + (1 - (stored[kept] - 1) / total) * self.p[at]

    def longer(self) -> None:
        """Contexts with one symbol more: the grams that were found often enough, inside a document.

        A gram is at most as frequent as the one without its first symbol, so only those whose
        shorter gram was found ``ENTRY`` times are asked for; the others would come back as zero.
        """
        n = self.n[self.asked]
        inside = np.flatnonzero((n >= CONTEXT) & (self.nxt[self.at[self.asked]] != self.end))
        shorter = np.zeros(len(self.nxt) + 1, bool)
        shorter[self.at] = self.n >= ENTRY
        self.context, self.times = self.keys[inside], n[inside]
        self.at = self.at[self.asked[inside]] + 1
        self._contexts(self.grams, self.of_gram[inside])
        self._grams(shorter[self.at])


def _rows_of(walk: _Walk, level: int, buckets: int) -> Iterator[tuple]:
    """Messages of a round: grams of ``level``, and contexts of the level before."""

    def messages(kind: int, keys: np.ndarray, body: list[np.ndarray]) -> Iterator[tuple]:
        cuts = _cuts(keys, buckets)
        for b in np.flatnonzero(np.diff(cuts)):
            span = slice(cuts[b], cuts[b + 1])
            yield walk.chunk, kind, int(b), _packed_keys(keys[span]), _packed(*[a[span] for a in body])

    for depth in range(1, level):
        walk.counted(depth)
        if depth < level - 1:
            walk.mixed(depth)
        else:
            yield from messages(2 * depth + 1, *walk.context_rows())
        if depth < DEPTH:
            walk.longer()
    if level <= DEPTH:
        yield from messages(2 * level, *walk.gram_rows())


def _asking(totals: Totals, level: int, buckets: int) -> Callable[[dict[str, pa.Scalar]], Iterable[pa.RecordBatch]]:
    kinds = {"chunk": pa.int64(), "kind": pa.int32(), "bucket": pa.int32(), "keys": pa.binary(), "body": pa.binary()}

    def messages(row: dict[str, pa.Scalar]) -> Iterator[pa.RecordBatch]:
        rows = list(_rows_of(_Walk(row, totals), level, buckets))
        columns = list(zip(*rows)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for k, c in zip(kinds.values(), columns)], list(kinds))

    return messages


def _answers(group: pa.Table) -> pa.Table:
    """Counts of the grams of a bucket, or the divergence test of its contexts, for each chunk."""
    chunk = group.column("chunk").to_numpy()
    order = np.argsort(chunk)
    keys = [_unpacked_keys(group.column("keys")[int(i)].as_py()) for i in order]
    parts = [_unpacked(group.column("body")[int(i)].as_py()) for i in order]
    bodies = [np.concatenate(a) for a in zip(*parts)]
    every, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    kind = group.column("kind")[0].as_py()
    if kind % 2 == 0:
        n = np.bincount(place, bodies[0], minlength=len(every)).astype(np.int64)
        n[n < ENTRY] = 0
        # One chunk reports a gram to its context, so that it counts once.
        own = np.zeros(len(place), dtype=bool)
        own[first[n > 0]] = True
        out = [n[place], own]
    else:
        total = np.zeros(len(every), np.int64)
        np.maximum.at(total, place, bodies[0])
        single = np.flatnonzero(bodies[2] == 1)
        bodies[3][single] = bodies[1][single] * np.log(bodies[1][single] / np.maximum(bodies[4][single], 1e-300))
        stored, many, gain, expected = (np.bincount(place, a, minlength=len(every)) for a in bodies[1:])
        # Counts times log ratios of all stored symbols, and of the rest taken together.
        gain = gain - stored * np.log(np.maximum(total, 1))
        rest = np.maximum(total - stored, 0)
        ratio = (rest / np.maximum(total, 1)) / np.maximum(1 - expected, 1e-12)
        gain += np.where(rest > 0, rest * np.log(np.maximum(ratio, 1e-12)), 0)
        kept = (gain > DIVERGENCE * np.maximum(many, 1)) & (many > 0)
        out = [np.where(kept, stored + 1, 0).astype(np.int64)[place]]
    cuts = np.cumsum([0, *map(len, keys)])
    blobs = [_packed(*[a[i:j] for a in out]) for i, j in zip(cuts, cuts[1:])]
    return pa.table({
        "chunk": pa.array(chunk[order], pa.int64()),
        "kind": group.column("kind"),
        "bucket": group.column("bucket"),
        "blob": pa.array(blobs, pa.binary()),
    })


def _scored(row: dict[str, pa.Scalar], totals: Totals) -> Iterator[pa.RecordBatch]:
    walk = _Walk(row, totals)
    for level in range(1, DEPTH + 1):
        walk.counted(level)
        walk.mixed(level)
        if level < DEPTH:
            walk.longer()
    unseen, rare = walk.nxt == walk.rare + 1, walk.nxt >= walk.rare
    count = walk.counts[walk.nxt]
    rare &= walk.nxt != walk.end
    count[rare] = np.where(unseen[rare], 0, 1)
    base = np.log10((count + 0.5) / (totals.words + totals.documents + 0.5 * (totals.distinct + 1)))
    # A rare word has its part of the rare symbol; unknown words share one part.
    single = np.where(unseen, totals.unknown, count - totals.discount)
    p = np.where(rare, walk.p * single / totals.rare, walk.p)
    starts = np.cumsum(walk.lengths + 1) - walk.lengths - 1

    def summed(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, starts)

    yield pa.RecordBatch.from_pydict({
        "doc_id": pa.array(walk.doc_ids, pa.int64()),
        "n_tokens": pa.array(walk.lengths + 1, pa.int64()),
        "n_known": pa.array(summed((count > 0).astype(np.int64)), pa.int64()),
        "base_score": pa.array(summed(base), pa.float64()),
        "score": pa.array(summed(np.log10(np.maximum(p, 1e-300))), pa.float64()),
    })


def score(docs: DataFrame, modulus: int = 5, remainder: int = 1, buckets: int | None = None) -> DataFrame:
    """log10 probability of every whole text, under a suffix tree and under a unigram base.

    Tokens are words between ASCII white space, A-Z in lower case, then one end.
    The tree is learnt from the documents whose crc32 of the doc_id does not leave
    ``remainder``. Its symbols are the words seen ``SYMBOL`` times, all rarer words
    together, and the end. Contexts of up to ``DEPTH`` symbols are tried where they
    occur ``CONTEXT`` times; one stays if the divergence of its next-symbol
    distribution from that of its suffix, times its count, exceeds a charge for each
    stored symbol (seen there ``ENTRY`` times). A distribution is mixed with that of
    the longest shorter suffix in the tree, down to the single words, whose counts are
    discounted in favour of one event for unknown words. All probabilities of next
    words and that event add up to one.

    Counts are taken over all training documents, and none of these numbers depends on
    how many there are, so the tree grows with the corpus. No process holds it: chunks
    of documents send their distinct words, grams and contexts to hash buckets, which
    sum them, make the test and answer by position. A gram reaches its context through
    one chunk, as sums, so a frequent context is one row a chunk. 64-bit hashes stand
    for grams, 56 bits of them. Chunks are stored once, in buckets, and stay in place: a round
    moves its questions and its answers once, and leaves only answers on disk, in the same buckets.

    Returns doc_id, n_tokens, n_known, base_score, score, train_tokens. Null text is
    empty: one token. A null doc_id counts as empty text for the split. Repeated rows
    count and are scored each. A text of any length is scored whole, in one chunk. Other
    columns are not read. An empty table gives an empty table. The input is read once, in
    any order.
    """
    spark = docs.sparkSession
    n = buckets or partitions(spark)
    train = ~held_out(remainder, modulus)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), train.alias("flag"), "text")
    held = store_chunks(slim.mapInArrow(_chunk_rows, CHUNK), "lm_chunks")
    words = held.mapInArrow(each_row(lambda row: _word_rows(row, n)), WORDS)
    counted = settled(words.groupBy("bucket").applyInArrow(_counted, COUNTED), "lm-words", drop_shuffles=True)
    totals = _totals(counted.filter(F.col("chunk").isNull()).drop("chunk", "bucket", "totals"))
    def with_answers(chunks: DataFrame, given: DataFrame, level: int) -> DataFrame:
        """The chunks with the answers of a round, which are brought to their buckets once."""
        lists = given.groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "blob")).alias(f"{ROUND}{level}"))
        return chunks.join(bucketed(lists, f"lm_level_{level}", drop_shuffles=True), "chunk", "left")

    # The counts of the words are the first answers.
    found = counted.filter(F.col("chunk").isNotNull())
    answers = found.select("chunk", F.lit(0).alias("kind"), "bucket", F.col("totals").alias("blob"))
    with few_rows_a_batch(spark, BATCH):
        walked = with_answers(held.drop("words"), answers, 0)
        release(counted)
        for level in range(1, DEPTH + 2):
            asked = walked.mapInArrow(each_row(_asking(totals, level, n)), MESSAGE)
            answered = asked.groupBy("kind", "bucket").applyInArrow(_answers, ANSWER)
            walked = with_answers(walked, answered, level)
        scored = settled(walked.mapInArrow(each_row(lambda row: _scored(row, totals)), SCORED), "lm-scores")
    return scored.withColumn("train_tokens", F.lit(totals.words + totals.documents).cast("long"))
