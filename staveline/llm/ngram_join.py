"""N-gram Jaccard join: points of group counts in an R-tree, bounds, and verified links."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staveline.llm.common import ASCII_LOWER, unpacked, with_row
from staveline.llm.components import components
from staveline.session import settled

# Coordinates of a point.
GROUPS = 128
# Sizes of one class differ by less than this factor.
CLASS_RATIO = 1.5
# Bits of a filter that keeps most keys of single documents out of a shuffle. Its size
# is fixed; a fuller filter lets more through and changes no result.
FILTER_BITS = 1 << 27
BUCKET_ROWS = 2048
# Shingles of a block of sets that are verified together, about.
BLOCK_SHINGLES = 2_000_000
LEAF = 16
# Beyond so many shingles the counts of the groups are too alike to tell sets apart; parities do.
WIDE = 2048
# Bytes of parities that are compared at once.
COMPARED_BYTES = 1 << 23
# Shingles of recent sets that a verifying task remembers.
HELD_SHINGLES = 4_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


class Shingles:
    """Distinct shingles of a text as sorted 64-bit hashes; hashes of words are remembered."""

    CACHED = 100_000

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        parts = text.translate(ASCII_LOWER).split()
        if not parts:
            return np.empty(0, np.uint64)
        if len(self.known) > self.CACHED:
            self.known.clear()
        known = self.known
        for w in set(parts).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        each = np.array([known[w] for w in parts], dtype=np.uint64)
        n = max(len(parts) - self.words + 1, 1)
        out = np.full(n, min(len(parts), self.words), dtype=np.uint64)
        for i in range(min(self.words, len(parts))):
            out = _mixed(out * _ODD + each[i : i + n])
        return np.unique(out)


@functools.cache
def size_classes(upto: int) -> list[int]:
    """First size of each class, up to one beyond ``upto``."""
    first = [1]
    while first[-1] <= upto:
        first.append(max(first[-1] + 1, math.ceil(first[-1] * CLASS_RATIO)))
    return first


@functools.cache
def groups_of(lo: int, hi: int, num: int, den: int) -> tuple[int, int]:
    """How many groups the shingles of sizes lo to hi - 1 fall into, and the greatest difference.

    Two linked sets, the smaller below ``hi``, differ in at most ``most`` shingles.
    Among most + 1 + e groups at least e + 1 are the same on both sides; e is such
    that hardly any document has more than e empty groups.
    """
    a = hi - 1
    most = (a + a * den // num) * (den - num) // (den + num)
    e = 0
    for _ in range(8):
        groups = most + 1 + e
        empty = groups * math.exp(-lo / groups)
        e = max(1, math.ceil(empty + 4 * math.sqrt(empty)))
    return most + 1 + e, most


def keys_of(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """48-bit keys such that two linked documents with different sets share at least one.

    In each size class that a partner may be of, the shingles fall into groups by
    their hash; the key is made of class, group and the shingles in it. Empty groups
    give keys only where a document has so many that no other group need be shared.
    """
    n = len(shingles)
    first = size_classes(n)
    c = int(np.searchsorted(first, n, side="right")) - 1
    found = []
    for k in (c, c - 1):
        if k < 0 or (k < c and n * num > (first[c] - 1) * den):
            continue
        groups, most = groups_of(first[k], first[k + 1], num, den)
        if most == 0:
            continue
        group = ((shingles >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
        value = _mixed(shingles)
        low = np.bincount(group, (value & np.uint64(0xFFFFFFFF)).astype(float), minlength=groups)
        high = np.bincount(group, (value >> np.uint64(32)).astype(float), minlength=groups)
        total = low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))
        full = np.bincount(group, minlength=groups) > 0
        label = np.arange(groups, dtype=np.uint64) * _ODD + np.uint64(k + 1)
        key = _mixed(_mixed(total + label) + label) >> np.uint64(16)
        if groups - full.sum() < groups - most:
            key = key[full]
        found.append(key)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def point_of(shingles: np.ndarray) -> np.ndarray:
    """Counts of the shingles by group of their hash, in bytes where they fit."""
    counts = np.bincount((shingles >> np.uint64(8)) % np.uint64(GROUPS), minlength=GROUPS)
    return counts.astype("<u4" if counts.max() > 255 else "u1")


def bits_of(n: int) -> int:
    """Parity bits of a set of n shingles: a power of two above 0.7 n, none for a set that is not wide."""
    return 1 << (7 * n // 10).bit_length() if n > WIDE else 0


def parities_of(shingles: np.ndarray) -> np.ndarray:
    """Whether odd numbers of shingles fall into finer groups of their hash, eight groups a byte."""
    bits = bits_of(len(shingles))
    if not bits:
        return np.empty(0, np.uint8)
    group = ((shingles >> np.uint64(8)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(group, minlength=bits) & 1).astype(np.uint8), bitorder="little")


def shape_of(shingles: np.ndarray) -> bytes:
    """The point of a set and, behind it, its parities."""
    return point_of(shingles).tobytes() + parities_of(shingles).tobytes()


def set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def node_of(identity: bytes) -> int:
    """40 bits of a set's identity, which stand for it among candidates."""
    return int.from_bytes(identity[:5], "big")


class RTree:
    """Points packed into leaves by size and first coordinate, and boxes of boxes above them.

    A box is the greatest count of each coordinate and the least size below it. The
    sum of coordinate minima with it bounds the overlap with anything below.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        strips = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (LEAF * LEAF)
        self.order = np.lexsort((points[:, 0], strips))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []
        boxes, least, most = self.points, self.sizes, self.sizes
        while len(boxes) > 1 or not self.levels:
            at = np.arange(0, len(boxes), LEAF)
            boxes = np.maximum.reduceat(boxes, at)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((boxes, least, most))

    def search(self, points: np.ndarray, sizes: np.ndarray, num: int, den: int) -> Iterator[tuple]:
        """(query places, place in the tree) of all pairs that the bounds do not rule out."""
        stack = [(len(self.levels) - 1, 0, np.arange(len(points)))]
        while stack:
            depth, node, asking = stack.pop()
            boxes, least, most = self.levels[depth] if depth >= 0 else (self.points, self.sizes, self.sizes)
            own = sizes[asking]
            fits = (own * num <= most[node] * den) & (least[node] * num <= own * den)
            asking = asking[fits]
            bound = _overlap(points[asking], boxes[node])
            asking = asking[bound * (num + den) >= num * (sizes[asking] + least[node])]
            if not len(asking):
                continue
            if depth < 0:
                yield asking, int(self.order[node])
            else:
                below = len(self.levels[depth - 1][0]) if depth else len(self.points)
                stack += [(depth - 1, i, asking) for i in range(node * LEAF, min((node + 1) * LEAF, below))]


def _shapes(blobs: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Points and parities of sets of these sizes."""
    cut = [len(x) - bits_of(n) // 8 for x, n in zip(blobs, sizes.tolist())]
    parities = [np.frombuffer(x, np.uint8, offset=c) if c < len(x) else np.empty(0, np.uint8) for x, c in zip(blobs, cut)]
    return _points([x[:c] for x, c in zip(blobs, cut)]), parities


def _points(blobs: list[bytes]) -> np.ndarray:
    out = np.empty((len(blobs), GROUPS), dtype=np.uint32)
    wide = np.array([len(x) > GROUPS for x in blobs], dtype=bool)
    for kind, chosen in (("u1", ~wide), ("<u4", wide)):
        joined = b"".join(x for x, c in zip(blobs, chosen) if c)
        out[chosen] = np.frombuffer(joined, dtype=kind).reshape(-1, GROUPS)
    return out


def _overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of coordinate minima: no two sets share more."""
    return np.minimum(a, b).sum(axis=1, dtype=np.int64)


def _folded(parities: np.ndarray, width: int) -> np.ndarray:
    """Parities of groups brought together, down to so many bytes."""
    return np.bitwise_xor.reduce(parities.reshape(-1, width), axis=0).view(np.uint64)


def _differing(parities: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair (a, b) of wide sets how many shingles only one of them has, at least; 0 for others.

    A group whose parity differs holds such a shingle.
    """
    width = np.array([len(x) for x in parities], dtype=np.int64)
    common = np.minimum(width[a], width[b])
    out = np.zeros(len(a), dtype=np.int64)
    for w in np.unique(common[common > 0]).tolist():
        pairs = np.flatnonzero(common == w)
        rows, place = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        folded = np.stack([_folded(parities[r], w) for r in rows])
        x, y = np.split(place, 2)
        step = max(COMPARED_BYTES // w, 1)
        for i in range(0, len(pairs), step):
            part = slice(i, i + step)
            odd = np.bitwise_count(folded[x[part]] ^ folded[y[part]])
            out[pairs[part]] = odd.sum(axis=1, dtype=np.int64)
    return out


def _listed(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)])
    values = np.concatenate([*lists, np.empty(0, np.int64)]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _measured(batches: Iterable[pa.RecordBatch], words: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    shingles = Shingles(words)
    for batch in batches:
        sets = [shingles(t.as_py() or b"") for t in batch.column(1).cast(pa.large_binary())]
        ids = [set_id(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array([node_of(i) for i in ids], pa.int64()),
                pa.array([shape_of(s) for s in sets], pa.binary()),
                _listed([keys_of(s, num, den) for s in sets]),
                *batch.columns[2:],
            ],
            names=["doc_id", "n_shingles", "set_id", "node", "point", "keys", *batch.schema.names[2:]],
        )


def _shared_keys(batches: Iterable[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, node) of each list of keys, without most keys that no other set has."""
    for batch in batches:
        lists = batch.column(0)
        key = lists.flatten().to_numpy(zero_copy_only=False)
        count = np.diff(lists.offsets.to_numpy())
        node = np.repeat(batch.column(1).to_numpy(), count)
        keep = _in_filter(bits, key)
        yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(node[keep])], names=["key", "node"])


def _filter_of(values: DataFrame, name: str) -> np.ndarray:
    """A bit for each value, in a bitmap of fixed size that comes to the driver."""
    bit = F.pmod(F.xxhash64(name) if name != "key" else F.col(name), F.lit(FILTER_BITS))
    words = (
        values.select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / 32).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 32 AS INT))")).alias("mask"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    bits[words.column("word").to_numpy()] = words.column("mask").to_numpy().astype(np.uint32)
    return bits


def _in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values % FILTER_BITS
    return (bits[bit // 32] >> (bit % 32).astype(np.uint32)) & 1 == 1


def _bounded(batches: Iterable[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs of sets that sizes, the sum of coordinate minima and parities allow to be linked."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        blobs = batch.column(4).to_pylist() + batch.column(5).to_pylist()
        points, parities = _shapes(blobs, np.concatenate([a, b]))
        left, right = np.split(np.arange(len(blobs)), 2)
        both = _overlap(points[left], points[right])
        both = np.minimum(both, (a + b - _differing(parities, left, right)) // 2)
        yield batch.select([0, 1]).filter(pa.array(_allowed(both, a, b, num, den)))


SEARCHED = ["bucket", "i", "j", "left", "one", "id", "root", "n", "point"]


def _whole_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows again, cut only where a bucket (or pair of its blocks) ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
        ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
        first = [held[0].column(i)[0].as_py() for i in range(3)]
        if len(ends):
            cut = int(ends[-1]) + 1
        elif first != keys[:, 0].tolist():
            cut = 0
        else:
            continue
        held[-1] = batch.slice(0, cut)
        yield pa.Table.from_batches(held)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _near(table: pa.Table, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, similarity): rows of one bucket and different components that no bound rules out.

    Rows come sorted by bucket and pair of blocks. A bucket that fits into one leaf
    is the leaf: its pairs meet directly, those of many buckets at once and each once.
    In a larger one the sets outside its largest component look for partners in the
    tree of all. The similarity is the greatest that the bound allows.
    """
    keys = np.stack([table.column(i).to_numpy() for i in range(3)])
    starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
    count = np.diff(np.append(starts, table.num_rows))
    left, one = (table.column(i).to_numpy() for i in (3, 4))
    ids = table.column(5).to_numpy()
    _, root_of = np.unique(table.column(6).to_numpy(), return_inverse=True)
    sizes = table.column(7).to_numpy()
    points, parities = _shapes(table.column(8).to_pylist(), sizes)
    pairs = []
    for m in np.unique(count[count <= LEAF]):
        x, y = np.triu_indices(m, 1)
        at = starts[count == m][:, None]
        a, b = (at + x).ravel(), (at + y).ravel()
        meets = one[a] | (left[a] != left[b])
        pairs.append(np.stack([a[meets], b[meets]]))
    for at, m in zip(starts[count > LEAF], count[count > LEAF]):
        rows = np.arange(at, at + m)
        most = np.bincount(root_of[rows]).argmax()
        few, many = rows[root_of[rows] != most], rows[root_of[rows] == most]
        if one[at]:
            sides = [(few, rows)]
        else:
            sides = [(few[left[few]], rows[~left[rows]]), (few[~left[few]], many[left[many]])]
        for asking, asked in sides:
            if len(asked) and len(asking):
                tree = RTree(points[asked], sizes[asked])
                for a, b in tree.search(points[asking], sizes[asking], num, den):
                    pairs.append(np.stack([asking[a], np.full(len(a), asked[b])]))
    a, b = np.concatenate([*pairs, np.empty((2, 0), dtype=np.int64)], axis=1).astype(np.int64)
    apart = (root_of[a] != root_of[b]) & (ids[a] != ids[b])
    low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
    a, b = np.divmod(np.unique(low * table.num_rows + high), max(table.num_rows, 1))
    parts = [slice(i, i + 65536) for i in range(0, len(a), 65536)]
    both = np.concatenate([*[_overlap(points[a[p]], points[b[p]]) for p in parts], np.empty(0, np.int64)])
    both = np.minimum(both, (sizes[a] + sizes[b] - _differing(parities, a, b)) // 2)
    keep = _allowed(both, sizes[a], sizes[b], num, den)
    a, b, both = a[keep], b[keep], both[keep]
    return a, b, both / np.maximum(sizes[a] + sizes[b] - both, 1)


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches by the pairs a, b."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        for x in (a, b, least[a], least[b]):
            np.minimum.at(new, x, low)
        new = new[new]
        if np.array_equal(new, least):
            return least
        least = new


def _searched(batches: Iterable[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Each set with a near one of another component, linked to the first set that near ones reach.

    So many near pairs of a bucket take no more rows than it has sets.
    """
    for table in _whole_buckets(batches):
        a, b, _ = _near(table, num, den)
        ids, id_of = np.unique(table.column(5).to_numpy(), return_inverse=True)
        a, b = id_of[a], id_of[b]
        least = _least(len(ids), a, b)
        u = np.unique(np.concatenate([a, b]))
        u = u[least[u] != u]
        yield pa.RecordBatch.from_arrays([pa.array(ids[u]), pa.array(ids[least[u]])], names=["u", "v"])


def _compared(batches: Iterable[pa.RecordBatch], words: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Links of sets of different components in one cluster, verified on their texts.

    The nearest pairs are tried first, and pairs that links found here already
    connect are not tried again: at most one link less than the group has sets.
    """
    shingles = Shingles(words)
    for table in _whole_buckets(batches):
        a, b, alike = _near(table, num, den)
        ids, roots, texts = table.column(5).to_numpy(), table.column(6).to_numpy(), table.column(9)
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while x in above:
                above[x] = above.get(above[x], above[x])
                x = above[x]
            return x

        known: dict[int, np.ndarray] = {}
        held, found = 0, []
        for i in np.argsort(-alike, kind="stable"):
            ends = (int(a[i]), int(b[i]))
            x, y = (top(int(roots[e])) for e in ends)
            if x == y:
                continue
            for e in ends:
                if ids[e] not in known:
                    if held > HELD_SHINGLES:
                        known.clear()
                        held = 0
                    known[ids[e]] = shingles(texts[e].as_py() or b"")
                    held += len(known[ids[e]])
            p, q = (known[ids[e]] if ids[e] in known else shingles(texts[e].as_py() or b"") for e in ends)
            both = len(np.intersect1d(p, q, assume_unique=True))
            if den * both >= num * (len(p) + len(q) - both):
                above[max(x, y)] = min(x, y)
                found.append([ids[e] for e in ends])
        u, v = np.array(found, dtype=np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _allowed(both: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of sizes a and b that share at most ``both`` may be linked."""
    return (both * (num + den) >= num * (a + b)) & (a * num <= b * den) & (b * num <= a * den)


def _verified(batches: Iterable[pa.RecordBatch], words: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    shingles = Shingles(words)
    known: dict[int, np.ndarray] = {}
    held = 0
    for batch in batches:
        keep = []
        for u, v, *texts in zip(*batch.columns):
            sets = []
            for key, text in zip((u.as_py(), v.as_py()), texts):
                if key not in known:
                    if held > HELD_SHINGLES:
                        known.clear()
                        held = 0
                    known[key] = shingles(text.as_py() or b"")
                    held += len(known[key])
                sets.append(known[key])
            a, b = sets
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(den * both >= num * (len(a) + len(b) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def row_keys() -> list[Column]:
    """What tells rows of different doc_ids or texts apart."""
    key = (F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return [F.xxhash64(*key).alias("r1"), F.xxhash64(F.lit("second"), *key).alias("r2")]


class _Join:
    """The steps of one join over the sets of ``docs``."""

    def __init__(self, docs: DataFrame, words: int, num: int, den: int):
        if not 2 * den < 3 * num <= 3 * den:
            raise ValueError("the similarity has to be above two thirds and at most one")
        self.spark = docs.sparkSession
        self.words, self.num, self.den = words, num, den
        self.slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        measured = self.slim.select("*", *row_keys()).mapInArrow(
            lambda it: _measured(it, words, num, den),
            "doc_id long, n_shingles long, set_id binary, node long, point binary, keys array<long>,"
            " r1 long, r2 long",
        )
        self.rows = settled(measured, "ngram-rows")
        self.sets = (
            self.rows.filter("n_shingles > 0")
            .groupBy("set_id")
            .agg(
                F.min("node").alias("node"),
                F.min("n_shingles").alias("n"),
                F.min("point").alias("point"),
                F.min("doc_id").alias("sample"),
            )
        )

    def candidates(self) -> DataFrame:
        """(key, node) of all keys that sets with different nodes share."""
        keys = self.rows.select(F.explode("keys").alias("key"), "node")
        ends = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        shared = settled(ends.filter("low <> high"), "ngram-shared")
        sent = self.spark.sparkContext.broadcast(_filter_of(shared, "key"))
        again = self.rows.select("keys", "node").mapInArrow(
            lambda it: _shared_keys(it, sent.value), "key long, node long"
        )
        return settled(again.distinct().join(shared.select("key"), "key", "left_semi"), "ngram-candidates")

    def texts(self, wanted: DataFrame) -> DataFrame:
        """(id, text): a text of every wanted set."""
        needed = wanted.select("id", "set_id", F.xxhash64("sample").alias("sample_hash"))
        bits = self.spark.sparkContext.broadcast(_filter_of(needed, "sample_hash"))
        words = self.words

        def likely(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingles = Shingles(words)
            for batch in batches:
                # The filter of the hash of a hash, as the driver built it.
                keep = _in_filter(bits.value, batch.column(0).to_numpy(zero_copy_only=False))
                part = batch.filter(pa.array(keep))
                texts = part.column(1).cast(pa.large_binary())
                ids = [set_id(shingles(t.as_py() or b"")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.binary()), part.column(1)], names=["set_id", "text"]
                )

        bit = F.pmod(F.xxhash64(F.xxhash64("doc_id")), F.lit(FILTER_BITS))
        found = self.slim.select(bit.alias("bit"), "text").mapInArrow(likely, "set_id binary, text binary")
        whole = found.join(needed.select("id", "set_id"), "set_id").select("id", "text")
        return settled(whole.dropDuplicates(["id"]), "ngram-texts")

    def linked(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs (u, v) of sets whose texts are linked."""
        words, num, den = self.words, self.num, self.den
        both = (
            pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("u_text")), "u")
            .join(texts.select(F.col("id").alias("v"), F.col("text").alias("v_text")), "v")
            .select("u", "v", "u_text", "v_text")
        )
        return settled(
            both.mapInArrow(lambda it: _verified(it, words, num, den), "u long, v long"), "ngram-links"
        )

    def bounded(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (u, v) of sets that the bound allows."""
        num, den = self.num, self.den
        a = sets.select(F.col("id").alias("u"), F.col("n").alias("n_u"), F.col("point").alias("p_u"))
        b = sets.select(F.col("id").alias("v"), F.col("n").alias("n_v"), F.col("point").alias("p_v"))
        joined = pairs.join(a, "u").join(b, "v").select("u", "v", "n_u", "n_v", "p_u", "p_v")
        return joined.mapInArrow(lambda it: _bounded(it, num, den), "u long, v long").distinct()

    def stars(self, members: DataFrame) -> DataFrame:
        """Each set with the most popular one it shares a key with: what most of a group is near to."""
        sizes = members.groupBy("key").agg(F.count("*").alias("m"))
        popular = members.join(sizes, "key").groupBy("id").agg(F.sum("m").alias("p"))
        rated = members.join(popular, "id").withColumn("rated", F.struct("p", "id"))
        hubs = rated.groupBy("key").agg(F.max("rated").alias("hub"))
        best = members.join(hubs, "key").groupBy("id").agg(F.max("hub").alias("hub"))
        return best.select(F.col("id").alias("u"), F.col("hub.id").alias("v")).filter("u <> v")

    def dealt(self, members: DataFrame, sets: DataFrame, roots: DataFrame, blocks: Column) -> DataFrame:
        """The sets of every bucket (key, id) that holds several components, as ``SEARCHED``.

        A large bucket is searched block by block, each pair of blocks once.
        """
        named = (
            members.join(sets.select("id", "n"), "id")
            .join(roots.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("root", F.coalesce("root", "id"))
        )
        mixed = (
            named.groupBy("key")
            .agg(F.min("root").alias("a"), F.max("root").alias("b"), F.ceil(blocks).cast("int").alias("blocks"))
            .filter("a <> b")
            .select("key", "blocks")
        )
        return (
            named.join(mixed, "key")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                F.col("key").alias("bucket"),
                F.least("block", "other").alias("i"),
                F.greatest("block", "other").alias("j"),
                (F.col("block") <= F.col("other")).alias("left"),
                (F.col("block") == F.col("other")).alias("one"),
                "id",
                "root",
                "n",
            )
            .join(sets.select("id", "point"), "id")
            .select(*SEARCHED)
        )

    def near(self, members: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
        """(key, id): clusters of sets that near ones of other components connect.

        Near are two sets that share a bucket and that its R-tree does not rule out.
        """
        num, den = self.num, self.den
        # Sorted by bucket, so that a task works through its many small buckets in a stream.
        pairs = (
            self.dealt(members, sets, roots, F.count("*") / BUCKET_ROWS)
            .repartition("bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(lambda it: _searched(it, num, den), "u long, v long")
        )
        clusters = components(pairs.distinct(), "ngram-near")
        return clusters.select(F.col("root").alias("key"), F.col("node").alias("id"))

    def across(self, clusters: DataFrame, sets: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
        """Links (u, v) that connect all linked sets of different components of a cluster."""
        words, num, den = self.words, self.num, self.den
        dealt = self.dealt(clusters, sets, roots, F.sum("n") / BLOCK_SHINGLES)
        found = (
            dealt.join(texts, "id")
            .select(*SEARCHED, "text")
            .repartition("bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(lambda it: _compared(it, words, num, den), "u long, v long")
        )
        return settled(found, "ngram-links")


def _rooted(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, root, r1, r2) of every row; rows with the same root are connected."""
    join = _Join(docs, words, num, den)
    sets = settled(join.sets, "ngram-sets")
    candidates = join.candidates()
    # Different sets that agree in the 40 bits of their node are candidates as well.
    same = sets.groupBy("node").agg(F.count("*").alias("m")).filter("m > 1").select("node")
    met = candidates.select("node").unionByName(same.select("node")).distinct()
    # From here on a number stands for each set that has a candidate.
    numbered = sets.join(met, "node", "left_semi").withColumn("id", F.monotonically_increasing_id())
    wanted = settled(numbered, "ngram-wanted")
    members = settled(candidates.join(wanted.select("node", "id"), "node").select("key", "id"), "ngram-members")
    twins = wanted.join(same, "node").select("node", F.col("id").alias("u"))
    twins = twins.join(twins.withColumnRenamed("u", "v"), "node").filter("u < v").select("u", "v")
    texts = join.texts(wanted)
    links = join.linked(join.bounded(join.stars(members).unionByName(twins), wanted), texts)
    roots = components(links, "ngram-roots")
    clusters = settled(join.near(members, wanted, roots), "ngram-clusters")
    fresh = join.across(clusters, wanted, roots, texts)
    if not fresh.isEmpty():
        roots = components(links.unionByName(fresh), "ngram-roots")
    named = wanted.join(roots.withColumnRenamed("node", "id"), "id").select("set_id", "root")
    # Numbers of components are told from set_ids by their length.
    label = F.coalesce(F.lpad(F.col("root").cast("string"), 20, "0").cast("binary"), "set_id")
    return join.rows.join(named, "set_id", "left").select(
        "doc_id", "n_shingles", label.alias("root"), "r1", "r2"
    )


def jaccard_components(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Documents linked by shared shingles: (doc_id, n_shingles, component_id).

    A document's set holds its distinct shingles of ``words`` words (A-Z in lower
    case, between ASCII white space); with fewer words the whole sequence is one.
    Two documents are linked when den * intersection >= num * union.

    Equal sets are one set. The shingles of a set are hashed into groups, finely
    enough that linked sets have at least one group in common: sets meet in the
    buckets of their groups. Each set is a point of 128 group counts; the sum of
    coordinate minima bounds the overlap of two sets, and R-trees over the points of
    a bucket bound it for many at once. Pairs that no bound rules out are verified on
    their texts. First each set meets the most popular set of its buckets, and what is
    linked is connected. Then all buckets are searched for pairs that are not connected
    yet; they are not written out, but connect their sets to clusters. The sets of a
    cluster meet once more, block by block and with their texts, nearest pairs first,
    and every pair that no link connects is verified where it is found. So a large group
    of near copies takes as many rows as it has texts, and no link between different
    components is lost. Very long texts are sets like others; a text is read whole.

    Null or empty texts have no shingles, and are components of their own. Every row
    is a document; rows with equal sets are linked; component_id is the smallest
    doc_id of the component, null where all are null. Other columns are not read. An
    empty table gives an empty table.
    """
    rooted = _rooted(docs, words, num, den)
    empty = F.col("n_shingles") == 0
    least = rooted.filter(~empty).groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The input rows without near copies: of each component the row of the smallest doc_id.

    A null doc_id is taken only where all are null; of rows that agree in doc_id and
    text one stays. Rows without words are no copies of each other. The text is
    shuffled once, to meet the rows that stay.
    """
    rooted = settled(_rooted(docs, words, num, den), "ngram-rooted")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "r1", "r2")).alias("s")
    stay = rooted.filter("n_shingles > 0").groupBy("root").agg(first).select("s.r1", "s.r2")
    stay = stay.unionByName(rooted.filter("n_shingles = 0").select("r1", "r2")).distinct()
    keyed = with_row(docs, *row_keys()).join(stay, ["r1", "r2"])
    alike = Window.partitionBy("r1", "r2").orderBy("r1")
    kept = keyed.withColumn("n", F.row_number().over(alike)).filter("n = 1")
    return unpacked(kept, docs.columns)
