"""Passages that documents share, found in suffix trees split by prefix, and their removal."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staveline.llm.common import encoded_texts, partitions
from staveline.llm.stored import (
    chunk_codes,
    chunk_columns,
    chunk_words,
    each_row,
    listed,
    mixed,
    rolled,
    store_chunks,
    word_hashes,
)
from staveline.session import settled

CHUNK_BYTES = 3 << 20
GRAM = 5  # words of the shortest prefix
GROUP = 250_000  # suffixes of one prefix that are sorted together
TREE = 60_000  # suffixes of all prefixes that one task sorts at a time, on average
NO_ID = -(1 << 63)  # a null doc_id, smaller than all others
CODE_BYTES = 6  # of the 64-bit number of a word, in a suffix


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["head", "sizes", "words", "codes"]

    def packed() -> pa.RecordBatch:
        columns = chunk_columns(list(number), np.concatenate(codes))
        head = pa.array([ids], pa.list_(pa.int64()))
        sizes = pa.array([[len(c) for c in codes]], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([head, sizes, *columns], names)

    number, codes, ids, size = defaultdict(int), [], [], 0
    number.default_factory = number.__len__
    for doc_id, text in encoded_texts(batches, "doc_id", "text"):
        words = text.split()
        ids.append(doc_id)
        codes.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
        size += len(text) + 64
        if size >= CHUNK_BYTES:
            yield packed()
            number, codes, ids, size = defaultdict(int), [], [], 0
            number.default_factory = number.__len__
    if ids:
        yield packed()


@dataclass
class _Suffixes:
    """The sampled suffixes of a chunk and the windows that they stand for.

    The anchor of a window is its gram of smallest number, of equal ones the first.
    Equal windows have equal anchors at equal places, so windows meet at the suffixes
    that start with anchors: fewer suffixes than words, each with the words of all the
    windows that have this anchor.
    """

    ids: list  # doc_id of each document
    docs: np.ndarray  # the same with NO_ID for null
    starts: np.ndarray  # first word of each document, and the end
    words: np.ndarray  # 64-bit number of each word
    first: np.ndarray  # first window of each sampled suffix
    last: np.ndarray  # its last window
    anchor: np.ndarray  # place where the suffix starts
    gram: np.ndarray  # number of its first words
    doc: np.ndarray  # doc_id of each

    @classmethod
    def of(cls, row: dict[str, pa.Scalar], width: int) -> _Suffixes:
        ids = row["head"].as_py()
        starts = np.concatenate([[0], np.cumsum(listed(row["sizes"]))])
        codes = chunk_codes(row["codes"])
        words = word_hashes(chunk_words(row["words"]))[codes] if len(codes) else np.zeros(0, np.uint64)
        grams = rolled(words, GRAM)
        n = len(words) - width + 1
        docs = np.array([NO_ID if d is None else d for d in ids], np.int64)
        if n <= 0:
            none = np.zeros(0, np.int64)
            return cls(ids, docs, starts, words, none, none, none, np.zeros(0, np.uint64), none)
        # Smallest gram of each window, the first of equal ones: by doubling.
        least, place, span, reach = grams, np.arange(len(grams)), 1, width - GRAM + 1
        while span < reach:
            step = min(span, reach - span)
            later = least[step:]
            keep = least[: len(later)] <= later
            place = np.where(keep, place[: len(later)], place[step:])
            least = np.where(keep, least[: len(later)], later)
            span += step
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        whole = owner[:n] == owner[width - 1 :]
        begins = whole.copy()
        begins[1:] &= ~whole[:-1] | (place[1:n] != place[: n - 1])
        ends = whole.copy()
        ends[:-1] &= ~whole[1:] | (place[1:n] != place[: n - 1])
        first, last = np.flatnonzero(begins), np.flatnonzero(ends)
        anchor = place[first]
        return cls(ids, docs, starts, words, first, last, anchor, grams[anchor], docs[owner[first]])

    def selected(self, chosen: np.ndarray) -> _Suffixes:
        cut = (self.first[chosen], self.last[chosen], self.anchor[chosen], self.gram[chosen], self.doc[chosen])
        return _Suffixes(self.ids, self.docs, self.starts, self.words, *cut)

    def single_windows(self) -> _Suffixes:
        """Every window by itself."""
        n = self.last - self.first + 1
        of = np.repeat(np.arange(len(n)), n)
        window = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.first[of]
        return _Suffixes(
            self.ids, self.docs, self.starts, self.words, window, window, self.anchor[of], self.gram[of], self.doc[of]
        )


def _signed(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers.view(np.int64), pa.int64())


def _anchors(row: dict[str, pa.Scalar], width: int) -> Iterator[pa.RecordBatch]:
    """(gram, chunk, lo, hi, n): distinct first words of the sampled suffixes of a chunk."""
    found = _Suffixes.of(row, width)
    if not len(found.gram):
        return
    order = np.argsort(found.gram, kind="stable")
    gram, doc = found.gram[order], found.doc[order]
    cuts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    n = np.diff(np.append(cuts, len(gram)))
    lo, hi = np.minimum.reduceat(doc, cuts), np.maximum.reduceat(doc, cuts)
    chunk = np.full(len(cuts), row["chunk"].as_py(), np.int64)
    columns = [_signed(gram[cuts]), pa.array(chunk), pa.array(lo), pa.array(hi), pa.array(n.astype(np.int64))]
    yield pa.RecordBatch.from_arrays(columns, ["gram", "chunk", "lo", "hi", "n"])


def _isin(gram: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    wanted = np.sort(wanted.view(np.uint64))
    at = np.minimum(np.searchsorted(wanted, gram), max(len(wanted) - 1, 0))
    return wanted[at] == gram if len(wanted) else np.zeros(len(gram), bool)


@dataclass
class _Sent:
    """What a chunk sends to the trees: distinct suffixes with the smallest and largest doc_id."""

    suffixes: _Suffixes
    distinct: np.ndarray  # number of the distinct suffix of each
    one: np.ndarray  # one suffix of each distinct one
    window: np.ndarray  # number of the first window of each distinct one

    @classmethod
    def of(cls, row: dict[str, pa.Scalar], width: int) -> list[_Sent]:
        """Those that share their first words with another document, in two kinds of prefix."""
        every = _Suffixes.of(row, width)
        short = every.selected(_isin(every.gram, listed(row["short"])))
        long = every.selected(_isin(every.gram, listed(row["long"]))).single_windows()
        windows = rolled(every.words, width)
        return [cls._distinct(short, windows), cls._distinct(long, windows)]

    @classmethod
    def _distinct(cls, s: _Suffixes, windows: np.ndarray) -> _Sent:
        # Same words in the same place around the anchor: by the windows' numbers.
        key = np.zeros(len(s.first), np.uint64)
        for part in (windows[s.first], windows[s.last], (s.last - s.first).astype(np.uint64), (s.anchor - s.first).astype(np.uint64)):
            key = mixed(key + part)
        _, one, distinct = np.unique(key, return_index=True, return_inverse=True)
        return cls(s, distinct, one, windows[s.first[one]])


def _suffix_rows(row: dict[str, pa.Scalar], width: int, groups: int) -> Iterator[pa.RecordBatch]:
    offset = 0
    for kind, sent in enumerate(_Sent.of(row, width)):
        s, m = sent.suffixes, len(sent.one)
        if not m:
            continue
        lo, hi = np.full(m, np.iinfo(np.int64).max), np.full(m, np.iinfo(np.int64).min)
        np.minimum.at(lo, sent.distinct, s.doc)
        np.maximum.at(hi, sent.distinct, s.doc)
        first, last, anchor = s.first[sent.one], s.last[sent.one], s.anchor[sent.one]
        prefix = sent.window if kind else s.gram[sent.one]
        group = (mixed(prefix) % np.uint64(groups)).astype(np.int32)
        codes = np.ascontiguousarray(s.words.view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES])
        sizes = (last + width - first) * CODE_BYTES
        at = np.repeat(first - (np.cumsum(sizes // CODE_BYTES) - sizes // CODE_BYTES), sizes // CODE_BYTES)
        text = codes[at + np.arange(len(at))].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        words = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(group),
                pa.array(np.full(m, row["chunk"].as_py(), np.int64)),
                pa.array(np.arange(offset, offset + m, dtype=np.int32)),
                pa.array((anchor - first).astype(np.int32)),
                words,
                pa.array(lo),
                pa.array(hi),
            ],
            ["part", "chunk", "place", "before", "words", "lo", "hi"],
        )
        offset += m


SUFFIX = "part int, chunk long, place int, before int, words binary, lo long, hi long"
ANSWER = "chunk long, place int, least array<long>"


def _tree(group: pa.Table, width: int) -> pa.Table:
    """Where windows of these suffixes have a smaller doc_id than their own.

    The subtree of a group is its suffixes in order, with the number of words that
    neighbours share (the depth of the inner node between them). A window starts
    ``o`` words before its suffix: windows are equal if their suffixes lie below one
    inner node of depth width - o or more, and the ``o`` words in front agree.
    """
    before = group.column("before").to_numpy()
    lo, hi = group.column("lo").to_numpy(), group.column("hi").to_numpy()
    blob = group.column("words").combine_chunks()
    if isinstance(blob, pa.ChunkedArray):
        blob = blob.chunk(0)
    ends = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64)
    # All words, and one more that stands for the places behind the end.
    codes = np.zeros((int(ends[-1] - ends[0]) // CODE_BYTES + 1, 8), np.uint8)
    raw = np.frombuffer(blob.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    codes[:-1, :CODE_BYTES] = raw.reshape(-1, CODE_BYTES)
    codes = codes.view("<u8").ravel()
    start = (ends[:-1] - ends[0]) // CODE_BYTES
    size = np.diff(ends) // CODE_BYTES
    n_windows = size - width + 1
    behind = size - before
    columns = [codes[np.where(j < behind, start + before + j, len(codes) - 1)] for j in range(width)]
    order = np.lexsort(columns[::-1])
    depth, same = np.zeros(len(order), np.int64), np.ones(len(order) - 1, bool)
    while columns:
        column = columns.pop(0)[order]
        same &= column[1:] == column[:-1]
        depth[1:] += same
    cuts = np.cumsum(n_windows) - n_windows
    least = np.repeat(lo, n_windows)
    front = np.zeros(len(size), np.uint64)
    for o in range(width - GRAM + 1):
        if o:
            has = before >= o
            front[has] = mixed(front[has] + codes[(start + before - o)[has]])
        window = before - o
        node = np.empty(len(size), np.int64)
        node[order] = np.cumsum(depth < width - o)
        held = np.flatnonzero((window >= 0) & (window < n_windows))
        if not len(held):
            continue
        same = held[np.lexsort((front[held], node[held]))]
        new = np.concatenate([[True], (node[same[1:]] != node[same[:-1]]) | (front[same[1:]] != front[same[:-1]])])
        smallest = np.minimum.reduceat(lo[same], np.flatnonzero(new))
        least[cuts[same] + window[same]] = smallest[np.cumsum(new) - 1]
    found = np.minimum.reduceat(least, cuts) < hi
    chosen = np.flatnonzero(found)
    kept = np.repeat(found, n_windows)
    offsets = np.concatenate([[0], np.cumsum(n_windows[chosen])]).astype(np.int32)
    return pa.table({
        "chunk": group.column("chunk").take(pa.array(chosen)),
        "place": group.column("place").take(pa.array(chosen)),
        "least": pa.ListArray.from_arrays(pa.array(offsets), pa.array(least[kept])),
    })


RESULT = (
    "doc_id long, n_words long, n_removed long, kept string,"
    " spans array<struct<start:int,n:int,passage:string>>"
)


def _rewritten(row: dict[str, pa.Scalar], width: int) -> Iterator[pa.RecordBatch]:
    """Every document of a chunk without the words that windows of smaller doc_ids cover."""
    sents = _Sent.of(row, width)
    ids, starts = sents[0].suffixes.ids, sents[0].suffixes.starts
    marks = np.zeros(int(starts[-1]) + 1, np.int64)
    place = listed(row["place"])
    values = row["least"].values
    if values is not None and len(place):
        least = values.flatten().to_numpy(zero_copy_only=False)
        n = np.diff(values.offsets.to_numpy())
        begin = np.cumsum(n) - n
        offset = 0
        for sent in sents:
            s, m = sent.suffixes, len(sent.one)
            at = np.full(m, -1, np.int64)
            mine = (place >= offset) & (place < offset + m)
            at[place[mine] - offset] = begin[mine]
            offset += m
            begin_of = at[sent.distinct] if m else at
            has = np.flatnonzero(begin_of >= 0)
            count = (s.last - s.first + 1)[has]
            of = np.repeat(has, count)
            step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            gone = least[begin_of[of] + step] < s.doc[of]
            window = (s.first[of] + step)[gone]
            np.add.at(marks, window, 1)
            np.add.at(marks, window + width, -1)
    removed = np.cumsum(marks[:-1]) > 0
    words = np.array(chunk_words(row["words"]) + [None], dtype=object)[:-1]
    codes = chunk_codes(row["codes"])
    out, size = [], 0
    span = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("passage", pa.string())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span)]

    def joined(some: np.ndarray) -> str:
        return b" ".join(some.tolist()).decode("utf-8", "replace")

    def batch() -> pa.RecordBatch:
        names = ["doc_id", "n_words", "n_removed", "kept", "spans"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for doc_id, a, b in zip(ids, starts[:-1], starts[1:]):
        gone = removed[a:b]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        text = words[codes[a:b]]
        spans = [{"start": int(x), "n": int(y - x), "passage": joined(text[x:y])} for x, y in zip(edges[::2], edges[1::2])]
        out.append((doc_id, int(b - a), int(gone.sum()), joined(text[~gone]), spans))
        size += 7 * int(b - a) + 64
        if size > 1 << 20:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def dedup_substrings(docs: DataFrame, words: int = 13, group: int = GROUP) -> DataFrame:
    """Every document without the passages of ``words`` words that a smaller doc_id holds as well.

    Words lie between ASCII white space and stay unchanged. A window is ``words``
    (six or more) consecutive words of a document. A word goes if any window over it,
    in the input, also starts in a document of a smaller doc_id.

    Returns (doc_id, n_words, n_removed, kept, spans): ``kept`` is the words that stay,
    joined by one space, ``spans`` the places (from 0), lengths and words of the maximal
    runs that go. Null or empty text has no words. A null doc_id is smaller than all others,
    and equal to the smallest long. Rows of the same doc_id do not remove each other's
    passages; repeated rows are returned each. Other columns are not read. An empty
    table gives an empty table. A very long text is handled whole, in one chunk.

    Suffix trees are built over sampled suffixes: those that start at the anchor of a
    window, and carry the up to ``words`` - 5 words before it. Their prefix splits them into
    groups: five words where up to ``group`` suffixes share them, all words of a
    window where there are more, each then sent once a chunk. Prefixes that no
    other document has are left out first. Groups hold ``TREE`` suffixes on average, or
    ``group`` if that is less.
    Each group is sorted, and its inner nodes that are deep enough tell the smallest
    doc_id of each window. 48 bits of a 64-bit hash stand for a word.
    """
    if words <= GRAM:
        raise ValueError(f"windows need more than {GRAM} words")
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = store_chunks(
        slim.mapInArrow(_chunks, "head array<long>, sizes array<int>, words binary, codes binary"), "substring-chunks"
    )
    anchors = chunks.mapInArrow(
        each_row(lambda row: _anchors(row, words)), "gram long, chunk long, lo long, hi long, n long"
    )
    alike = Window.partitionBy("gram")
    shared = (
        anchors.withColumn("least", F.min("lo").over(alike))
        .withColumn("most", F.max("hi").over(alike))
        .withColumn("all", F.sum("n").over(alike))
        .filter(F.col("least") < F.col("most"))
    )
    long = F.col("all") > group
    lists = settled(
        shared.groupBy("chunk").agg(
            F.collect_list(F.when(~long, F.col("gram"))).alias("short"),
            F.collect_list(F.when(long, F.col("gram"))).alias("long"),
            F.sum("n").alias("n"),
        ),
        "substring-anchors",
    )
    total = lists.agg(F.sum("n")).first()[0] or 0
    groups = max(partitions(spark), -(-total // min(group, TREE)))
    met = chunks.join(lists.drop("n"), "chunk", "left")
    sent = met.filter("short IS NOT NULL").mapInArrow(each_row(lambda row: _suffix_rows(row, words, groups)), SUFFIX)
    answers = settled(
        sent.groupBy("part").applyInArrow(lambda table: _tree(table, words), ANSWER), "substring-answers"
    )
    listed_answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("place", "least")).alias("found"))
    listed_answers = listed_answers.select("chunk", F.col("found.place").alias("place"), F.col("found.least").alias("least"))
    return met.join(listed_answers, "chunk", "left").mapInArrow(each_row(lambda row: _rewritten(row, words)), RESULT)

