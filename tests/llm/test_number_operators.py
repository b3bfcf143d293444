"""Packing, neighbours, toxicity, sharding and language-model scores on awkward rows."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staveline.llm import neighbours, packing, sharding, suffix_tree, toxicity
from staveline.llm.queries import QUERIES
from staveline.llm.tokens import byte_bpe, load, vocabulary_path
from tests.llm.fixtures import EXTRA, documents, found, prose, texts

BYTE_BPE = vocabulary_path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


# --- packing --------------------------------------------------------------------

def test_ids_are_those_of_the_tokenizer():
    tokenizer, encode = load(BYTE_BPE), byte_bpe(BYTE_BPE)
    given = [t or "" for _, t in texts()]
    given += ["", " ", "  a  b\n\n c \n d\t e", " \n ", "a b　c d\u0085e\x1cf", "it's we'll 'S",
              "<|endoftext|> x<|endoftext|>", "ﬁ Ⅷ ½ ² ͸ 𝔘 🏳️‍🌈 ሀ", " " * 12_000 + "x", "\n" * 7000]
    for text in given:
        assert encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_places_every_token_once(spark, capacity):
    tokenizer = load(BYTE_BPE)
    packed = packing.pack(documents(spark), BYTE_BPE, capacity).collect()
    want = collections.Counter()
    for d, t in texts():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        bounds = [0, len(ids)] if len(ids) <= capacity else [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[d, i, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack(documents(spark, []), BYTE_BPE).count() == 0


def test_each_bin_is_as_full_as_can_be():
    pick = random.Random(1)
    for _ in range(50):
        counts = {pick.randint(1, 30): pick.randint(1, 3) for _ in range(pick.randint(1, 6))}
        room = pick.randint(0, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        taken = packing.fullest(counts, room)
        assert all(taken[k] <= counts[k] for k in taken)
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= room)


def test_the_plan_is_bounded_by_the_capacity():
    pick = random.Random(2)
    counts = {n: pick.randint(1, 10**9) for n in range(1, 129)}
    plan = packing.bin_plan(counts, 128)
    assert len({row[4] for row in plan}) <= 4 * 128
    placed = collections.Counter()
    for length, a, b, *_ in plan:
        placed[length] += b - a
    assert placed == counts
    bins = max(base + (b - a) // n for _, a, b, n, base, _ in plan)
    # No two pieces of more than half a sequence share one.
    large = sum(n for k, n in counts.items() if k > 64)
    least = max(math.ceil(sum(k * n for k, n in counts.items()) / 128), large)
    assert bins <= 1.02 * least


# --- neighbours -----------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame(
        [(*r, "q", 1, 2) for r in rows], "vec_id long, embedding array<float>, label string, dim int, qb int"
    )


def nearest_by_hand(rows, k, every):
    best = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        best[i] = min(best.get(i, v), v)
    m = {i: np.array(v, dtype=np.float32).astype(float) for i, v in best.items()}
    out = collections.Counter()
    for q in m:
        if q % every == 0:
            scored = sorted((-float((m[q] * m[c]).sum()), c) for c in m if c != q and len(m[c]) == len(m[q]))
            for rank, (s, c) in enumerate(scored[:k], 1):
                out[q, rank, c, -s] += 1
    return out


def test_neighbours_are_exact(spark):
    pick = np.random.default_rng(0)
    rows = [(i, [float(x) for x in pick.normal(size=8).astype(np.float32)]) for i in range(300)]
    same = rows[3][1]
    rows += [(300 + i, same) for i in range(60)]  # ties, in the hundreds of one vector
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan"), *same[1:]]), (404, [None, *same[1:]]),
             (405, [float("inf"), *same[1:]]), (None, same), (420, [1.0, 2.0]), (440, [2.0, 1.0]), (460, [3.0])]
    rows += [rows[20], (40, [9.0] * 8)]  # a repeated row, a repeated vec_id
    rows += [(500, [1e30] * 8), (520, [1e-30] * 8)]
    got = neighbours.nearest(vectors(spark, rows), k=5, every=20, query_block=7, candidate_block=50)
    assert found(got, "query_id", "rank", "vec_id", "score") == nearest_by_hand(rows, 5, 20)


def test_neighbours_of_few_or_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert found(neighbours.nearest(vectors(spark, rows))) == {(0, 1, 1, 0.5): 1}
    assert neighbours.nearest(vectors(spark, rows[:1])).count() == 0
    assert neighbours.nearest(vectors(spark, [])).count() == 0


def test_neighbours_of_any_width(spark):
    pick = np.random.default_rng(6)
    wide = [(i, [float(x) for x in pick.integers(-9, 10, n)]) for n in (1024, 2100) for i in range(n, n + 30)]
    rows = [*wide, (0, [1.0, 0.0]), (1, [0.5, 0.5])]
    got = neighbours.nearest(vectors(spark, rows), k=4, every=20)
    assert found(got, "query_id", "rank", "vec_id", "score") == nearest_by_hand(rows, 4, 20)


def test_tiles_drop_only_what_the_bounds_rule_out():
    pick = np.random.default_rng(5)
    q = pick.normal(size=(40, 64))
    c = np.concatenate([pick.normal(size=(400, 64)), q[:5] * 3])
    import pyarrow as pa

    def table(m, first, names):
        return pa.table({names[0]: list(range(first, first + len(m))), names[1]: m.tolist()})

    got = neighbours._tile(table(q, 0, ("vec_id", "vector")), table(c, 1000, ("c_id", "c_vector")), 10)
    found_ids = collections.defaultdict(list)
    for a, b in zip(got["query_id"].to_pylist(), got["vec_id"].to_pylist()):
        found_ids[a].append(b)
    for i in range(40):
        assert found_ids[i] == (1000 + np.argsort(-(c @ q[i]), kind="stable")[:10]).tolist()


# --- toxicity -------------------------------------------------------------------

def labelled(spark, n=600):
    pick = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        text = ". ".join(prose(1000 + 5 * i + j, 8) for j in range(5))
        bad = i % 5 == 0
        if bad:
            text += f". You are a {pick.choice(['vile', 'rotten'])} {pick.choice(['goblin', 'goblins'])} indeed."
        docs.append((i, text))
        labels.append((i, int(bad), "x"))
    labels += [(None, 1, "x"), (10**9, 0, "x"), (1, None, "x"), (2, 0, "y")]
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, source string")


def test_toxicity_learns_and_locates(spark):
    docs, labels = labelled(spark)
    rows = [*docs, (None, None), (10**6, ""), (10**6 + 1, "x" * 50_000), docs[0], (10**6 + 2, " ".join([prose(1)] * 200))]
    scored = toxicity.score(documents(spark, rows), labels, carry=True)
    out = scored.collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 3 == 1)
        assert r.document.key == EXTRA[1] and r.document.doc_id == r.doc_id
        if r.doc_id is not None and r.doc_id < 10**6:
            assert r.predicted == int(r.doc_id % 5 == 0)
        else:
            assert r.predicted == 0
        if r.predicted:
            text = r.document.text
            assert any("gobl" in text[s.start : s.end] for s in r.sentences)
            assert not any("gobl" not in text[s.start : s.end] for s in r.sentences)


def test_toxicity_is_seen_at_any_place_of_a_run(spark):
    docs, labels = labelled(spark)
    glued = [(10**6, "a_fine_rotten_goblins_day"), (10**6 + 1, "zyx" * 20 + "rottengoblins" + "zyx" * 20)]
    fine = [(10**6 + 2, "a_fine_and_sunny_day"), (10**6 + 3, "zyx" * 40)]
    out = toxicity.score(documents(spark, [*docs, *glued, *fine]), labels).collect()
    score = {r.doc_id: r.score for r in out}
    assert all(score[d] > 100 * score[e] for (d, _), (e, _) in zip(glued, fine))
    assert all(score[d] >= 0.7 for d, _ in glued)


def test_toxicity_of_text_without_spaces(spark):
    pick = random.Random(11)
    letters = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏"
    docs, labels = [], []
    for i in range(400):
        text = "".join(pick.choices(letters, k=60))
        at = pick.randint(15, 55)
        docs.append((i, f"{text[:at]}坏蛋{text[at:]}" if i % 4 == 0 else text))
        labels.append((i, int(i % 4 == 0)))
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.score(documents(spark, docs), given).collect()
    assert {r.doc_id: r.predicted for r in out if r.held_out} == {
        d: t for d, t in labels if zlib.crc32(str(d).encode()) % 3 == 1
    }


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = labelled(spark, 20)
    none = toxicity.score(documents(spark, docs), labels.limit(0))
    assert {r.predicted for r in none.collect()} == {0}
    assert toxicity.score(documents(spark, []), labels).count() == 0


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = labelled(spark, 200)
    turned = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a = toxicity.train(documents(spark, docs), labels)
    b = toxicity.train(documents(spark, docs), turned)
    assert a == b


# --- sharding -------------------------------------------------------------------

@pytest.mark.parametrize("shards,bundles", [(3, 16), (40, 16384), (5, 200)])
def test_sharding(spark, shards, bundles):
    rows = [*texts(), *[(1000 + i, prose(i, 5 + i % 50)) for i in range(400)], *[(2000 + i, prose(0)) for i in range(300)]]
    dealt = sharding.shard(documents(spark, rows), shards, bundles).collect()
    got = collections.Counter((r.doc_id, r.size - 16, r.text_crc32) for r in dealt)
    raw = [(d, (t or "").encode()) for d, t in rows]
    assert got == collections.Counter((d, len(b), zlib.crc32(b)) for d, b in raw)
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in dealt:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        assert r.key == EXTRA[1] and r.tokens >= 0
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) <= set(range(shards))
    share, largest = sum(sizes.values()) / shards, max(len(b) for _, b in raw) + 16
    if shards * largest < sum(sizes.values()):
        assert max(sizes.values()) - min(sizes.values()) <= max(0.2 * share, largest)
    small = collections.defaultdict(set)
    for r in dealt:
        small[r.text_crc32, r.size].add(r.shard)
    by_text = collections.Counter((len(b), zlib.crc32(b)) for _, b in raw)
    for (n, crc), count in by_text.items():
        if count * (n + 16) < share / 2:
            assert len(small[crc, n + 16]) == 1


def test_sharding_query_keeps_groups_that_fit(spark):
    folder = "/root/testdata/sf0.01"
    texts_of = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op9_sharding"](spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts_of)
    shards, members, bytes_of = collections.Counter(), collections.defaultdict(set), collections.Counter()
    slots = collections.defaultdict(list)
    for r in found:
        text = texts_of[r.doc_id]
        assert (r.size, r.text_crc32) == (len(text.encode()) + 16, zlib.crc32(text.encode()))
        shards[r.shard] += r.size
        slots[r.shard].append(r.slot)
        members[text].add(r.shard)
        bytes_of[text] += r.size
    share = sum(shards.values()) / 40
    assert all(len(members[t]) == 1 for t, n in bytes_of.items() if n <= share)
    assert any(share / 2 < n <= share for n in bytes_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(shards) == 40 and max(shards.values()) - min(shards.values()) < 0.1 * share


def test_sharding_of_nothing(spark):
    assert sharding.shard(documents(spark, [])).count() == 0


# --- language model -------------------------------------------------------------

def language_rows():
    pick = random.Random(3)
    rows = [*texts()]
    for i in range(400):
        # The word after "to" depends on the word before it.
        text = " ".join(f"{a} to {a.upper()}x {prose(i * 7 + j, 2)}" for j, a in enumerate(pick.choices("abcd", k=12)))
        rows.append((5000 + i, text))
    return rows


def test_suffix_tree_counts_and_base(spark):
    rows = language_rows()
    out = suffix_tree.score(documents(spark, rows), buckets=3).collect()
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    tokens = [(d, [*(t or "").encode().translate(low).split(), None]) for d, t in rows]
    out_of = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    counts = collections.Counter(w for d, ws in tokens if not out_of(d) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = collections.Counter()
    for d, ws in tokens:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        want[d, len(ws), sum(counts[w] > 0 for w in ws), round(base, 6), total] += 1
    got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), r.train_tokens) for r in out)
    assert got == want
    held = [r for r in out if out_of(r.doc_id)]
    assert all(r.score < 0 for r in out)
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


class PlainTree:
    """The tree from its definition, with a dictionary of all grams."""

    def __init__(self, docs):
        self.words = collections.Counter(w for d in docs for w in d)
        once, twice = (sum(c == k for c in self.words.values()) for k in (1, 2))
        self.discount = once / (once + 2 * twice) if once else 0.0
        self.unknown = max(self.discount * len(self.words), 0.5)
        self.rare = once * (1 - self.discount) + self.unknown
        counts = collections.Counter(self.symbol(w) for d in docs for w in d)
        counts["end"] = len(docs)
        root = {s: c - self.discount for s, c in counts.items() if isinstance(s, bytes)}
        root.update(rare=self.rare, end=max(len(docs), 0.5))
        self.root = {s: c / sum(root.values()) for s, c in root.items()}
        self.n = collections.Counter({(s,): c for s, c in counts.items()})
        for d in docs:
            x = self.sequence(d)
            for length in range(2, suffix_tree.DEPTH + 2):
                self.n.update(tuple(x[i : i + length]) for i in range(len(x) - length + 1))
        after = collections.defaultdict(dict)
        for gram, n in self.n.items():
            if len(gram) > 1 and n >= suffix_tree.ENTRY:
                after[gram[:-1]][gram[-1]] = n
        self.left = {}
        for context in sorted(after, key=len):
            total, stored = self.n[context], sum(after[context].values())
            if len(context) > 1 and total < suffix_tree.CONTEXT:
                continue
            shorter = {s: self.p(context[1:], s) for s in after[context]}
            gain = sum(n * math.log(n / total / shorter[s]) for s, n in after[context].items())
            if total > stored:
                ratio = (total - stored) / total / max(1 - sum(shorter.values()), 1e-12)
                gain += (total - stored) * math.log(max(ratio, 1e-12))
            if gain > suffix_tree.DIVERGENCE * len(after[context]):
                self.left[context] = 1 - stored / (total + suffix_tree.PRIOR)

    def symbol(self, word):
        return word if self.words[word] >= suffix_tree.SYMBOL else "rare"

    def sequence(self, words):
        return ["end", *map(self.symbol, words), "end"]

    def p(self, context, s):
        p = self.root[s]
        for length in range(1, len(context) + 1):
            c = context[-length:]
            if c in self.left:
                n = self.n[(*c, s)]
                n = n if n >= suffix_tree.ENTRY else 0
                p = n / (self.n[c] + suffix_tree.PRIOR) + self.left[c] * p
        return p

    def score(self, words):
        x, total = self.sequence(words), 0.0
        for i in range(1, len(x)):
            p = self.p(tuple(x[max(0, i - suffix_tree.DEPTH) : i]), x[i])
            if x[i] == "rare":
                known = self.words[words[i - 1]]
                p *= (known - self.discount if known else self.unknown) / self.rare
            total += math.log10(p)
        return total


def plain_tree(rows):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    split = [(d, (t or "").encode().translate(low).split()) for d, t in rows]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    return PlainTree([ws for d, ws in split if not held(d)]), split


def test_the_plain_tree_is_a_distribution():
    tree, _ = plain_tree(language_rows())
    assert {len(c) for c in tree.left} == {1, 2, 3}
    for context in sorted(tree.left, key=str)[:300]:
        assert math.isclose(sum(tree.p(context, s) for s in tree.root), 1, rel_tol=1e-9)


def test_suffix_tree_of_nothing(spark):
    assert suffix_tree.score(documents(spark, [])).count() == 0
    only = suffix_tree.score(documents(spark, [(1, None), (2, "a")])).collect()
    assert {(r.doc_id, r.n_tokens) for r in only} == {(1, 1), (2, 2)}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in only)


@pytest.mark.parametrize("pieces", [1, 4])
def test_suffix_tree_is_the_plain_one(spark, pieces):
    rows = [*language_rows(), *language_rows()[:30]]
    tree, split = plain_tree(rows)
    want = sorted(((d or 0), tree.score(ws)) for d, ws in split)
    out = suffix_tree.score(documents(spark, rows).repartition(pieces), buckets=5).collect()
    got = sorted(((r.doc_id or 0), r.score) for r in out)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-7, atol=2e-6)


def test_suffix_tree_query_is_the_plain_one(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    tree, split = plain_tree(rows)
    want = {d: tree.score(ws) for d, ws in split}
    got = {r.doc_id: r for r in QUERIES["op10_suffix_tree"](spark, SF).collect()}
    assert got.keys() == want.keys() and len(want) == len(rows)
    assert all(math.isclose(got[d].score, s, rel_tol=1e-7, abs_tol=2e-6) for d, s in want.items())
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_distinct_hashes_are_those_of_unique():
    pick = np.random.default_rng(3)
    wide = pick.integers(0, 2**64, 500, dtype=np.uint64)
    # Alike but for the bits that hold the place while they are sorted.
    close = (wide[:5, None] + np.arange(40, dtype=np.uint64)).ravel()
    for keys in (wide[pick.integers(0, 500, 3000)], pick.permutation(np.repeat(close, 3)), wide[:1], wide[:0]):
        found_, place, number = suffix_tree._distinct(keys)
        assert (found_ == np.unique(keys)).all() and (keys[place] == found_).all() and (found_[number] == keys).all()


def test_numbers_travel_in_the_bytes_that_they_need():
    pick = np.random.default_rng(4)
    counts, wide = pick.integers(0, 200, 5000), pick.integers(-9, 2**62, 50)
    given = [counts, wide, pick.random(7), np.array([True, False]), np.zeros(0, np.int64)]
    back = suffix_tree._unpacked(suffix_tree._packed(*given))
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(given, back))
    plain = suffix_tree._packed(counts.astype(np.uint8))
    assert len(suffix_tree._packed(counts)) == len(plain)
    keys = np.unique(pick.integers(0, 2**56, 5000, dtype=np.uint64)) << np.uint64(8)
    assert (suffix_tree._unpacked_keys(suffix_tree._packed_keys(keys)) == keys).all()


def test_only_grams_of_frequent_ends_are_asked_for():
    """A gram whose end was seen once cannot be seen twice, so the second round leaves it out."""
    import pyarrow as pa

    class Summary:
        def collect(self):
            return [r for r in counted.to_pylist() if r["chunk"] is None]

    # Every "b n" comes once, "a b" and all words often.
    docs = [f"a b {i}" for i in range(100)] + [f"{i}" for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "flag": [True] * 200, "text": docs})
    (chunk,) = suffix_tree._chunk_rows([batch])
    row = {"chunk": pa.scalar(0)} | {name: chunk.column(name)[0] for name in chunk.schema.names}
    counted = suffix_tree._counted(pa.Table.from_batches(suffix_tree._word_rows(row, 1)))
    totals, asked = suffix_tree._totals(Summary()), {}
    given = [{"kind": 0, "bucket": 0, "blob": counted["totals"][0].as_py()}]
    struct = pa.list_(pa.struct([("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())]))
    for level in (1, 2):
        row[f"{suffix_tree.ROUND}{level}"] = pa.scalar(given, struct)
        (messages,) = suffix_tree._asking(totals, level, 1)(row)
        given = []
        for one in (messages.slice(i, 1) for i in range(messages.num_rows)):
            answer = suffix_tree._answers(pa.Table.from_batches([one])).select(["kind", "bucket", "blob"])
            given += answer.to_pylist()
            asked[one["kind"][0].as_py()] = len(suffix_tree._unpacked_keys(one["keys"][0].as_py()))
    # start a, a b, 100 of b n, 100 of n end, 100 of start n; then start a b alone.
    assert asked == {2: 302, 3: 103, 4: 1}


def test_a_passage_is_learnt_whatever_else_there_is(spark):
    passage = " ".join(f"passage{i}" for i in range(40))
    few = [(i, passage) for i in range(8)]
    pick = random.Random(5)
    # Common words, and words that occur once.
    drawn = lambda: " ".join(f"w{pick.randrange(300)} once{pick.getrandbits(60)}" for _ in range(300))
    many = [(100 + i, drawn()) for i in range(400)]
    gains = []
    for rows in (few + many[:4], few + many):
        out = suffix_tree.score(documents(spark, rows), buckets=3).collect()
        gains.append(next(r.score / r.base_score for r in out if r.doc_id == 0))
    # Less than half the digits of the base, on the larger table as on the small one.
    assert all(g < 0.5 for g in gains)
