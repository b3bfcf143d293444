"""BPE, line dedup, exact dedup, n-gram join and licences on awkward rows."""

import collections
import hashlib
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staveline.llm import bpe, chunks, copies, licenses, lines, ngram_join
from staveline.llm.tokens import load, vocabulary_path
from tests.llm.fixtures import (
    EXTRA,
    LICENSE,
    documents,
    found,
    linked_groups,
    prose,
    shingles,
    texts,
)

WORD_BPE = vocabulary_path("word_bpe_49k.json")


# --- BPE ------------------------------------------------------------------------

def test_words_are_numbered_as_they_come():
    pick = random.Random(8)
    signs = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x1c", b"\xc2\x85", b"\xc2\xa0", b"a", b"b", b"\xff", b"\0"]
    for _ in range(300):
        given = [b"".join(pick.choices(signs, k=pick.randint(0, 12))) for _ in range(pick.randint(1, 5))]
        lengths, codes, words = chunks._numbered(given)
        split = [t.split() for t in given]
        assert lengths.tolist() == [len(w) for w in split] and words == list(dict.fromkeys(sum(split, [])))
        assert [words[i] for i in codes] == sum(split, [])


def test_bpe_is_the_tokenizer_on_every_text(spark):
    tokenizer = load(WORD_BPE)
    want = collections.Counter()
    for doc_id, text in texts():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[doc_id, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    rows = bpe.encode_and_decode(documents(spark), WORD_BPE).collect()
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == want


def test_bpe_chunks_and_buckets_change_nothing(spark, monkeypatch):
    # Chunks of one document each, in this process: the words of all meet in three buckets.
    docs = documents(spark).repartition(5)
    whole = bpe.encode_and_decode(docs, WORD_BPE, buckets=1)
    dealt = bpe.encode_and_decode(docs.coalesce(2), WORD_BPE, buckets=3)
    names = ("doc_id", "ids", "decoded")
    as_rows = lambda df: collections.Counter((r[0], tuple(r[1]), r[2]) for r in df.select(*names).collect())
    assert as_rows(whole) == as_rows(dealt)


def test_bpe_of_nothing(spark):
    assert bpe.encode_and_decode(documents(spark, []), WORD_BPE).count() == 0
    only = bpe.encode_and_decode(documents(spark, [(1, None), (2, " ")]), WORD_BPE)
    assert found(only.withColumn("ids", F.size("ids"))) == {(1, 0, ""): 1, (2, 0, ""): 1}


def test_bpe_reads_its_vocabulary_once_a_process():
    assert load(WORD_BPE) is load(WORD_BPE)


def test_bpe_hands_out_a_chunk_in_small_batches(monkeypatch):
    monkeypatch.setattr(bpe, "OUT_BYTES", 1000)
    rows = [(i, f"word{i} " * 40) for i in range(30)] + [(None, None), (7, ""), (8, "long " * 900)]
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([False] * len(rows)), pa.array([r[1] for r in rows])]
    texts = [pa.RecordBatch.from_arrays(columns, ["doc_id", "flag", "text"])]
    words = pa.Table.from_batches(bpe._word_rows(texts, 1))
    encoded = bpe._encoded_bucket(words, WORD_BPE)
    used = encoded.column("used")[0].as_py()
    pieces = {i: p for p, i in load(WORD_BPE).get_vocab(with_added_tokens=True).items()}
    of_ids = pa.table({"id": pa.array(used, pa.int32()), "piece": [pieces[i] for i in used]})
    found_ = pa.concat_tables([encoded.drop_columns(["used"]), of_ids], promote_options="default")
    got = bpe._assembled(pa.Table.from_batches(bpe._document_rows(texts, 1)), found_)
    batches = got.to_batches()
    assert len(batches) > 5
    assert max(b.num_rows for b in batches) < 10
    want = [load(WORD_BPE).encode(text or "", add_special_tokens=False).ids for _, text in rows]
    assert got.column("doc_id").to_pylist() == [r[0] for r in rows]
    assert got.column("ids").to_pylist() == want


def test_bpe_refuses_vocabularies_with_a_decoder(spark):
    with pytest.raises(ValueError):
        bpe.encode_and_decode(documents(spark), vocabulary_path("byte_bpe_50k.json"))


# --- line dedup -----------------------------------------------------------------

def deduped(rows, min_chars=20, min_docs=3):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(-1 if d is None else d)
    out = collections.Counter()
    for d, t in rows:
        parts = (t or "").split("\n")
        drop = [
            len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs
            and max(holders[key(x)]) != (-1 if d is None else d)
            for x in parts
        ]
        text = "\n".join(x for x, gone in zip(parts, drop) if not gone)
        out[d, len(parts), sum(drop), text if any(drop) else t] += 1
    return out


def test_line_dedup(spark):
    rows = [*texts(), *[(100 + i, "This very line is in Many documents.") for i in range(40)]]
    rows += [(None, "This very line is in Many documents.\nnull id"), (3, "short\nshort")]
    kept = lines.dedup_lines(documents(spark, rows))
    assert found(kept, "doc_id", "n_lines", "n_dropped", "text") == deduped(rows)
    assert {(r.key, r.dropped, r.parts) for r in kept.collect()} == {("k", "d", 8)}
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def test_a_line_of_two_documents_stays(spark):
    rows = [(1, "x" * 25), (2, "x" * 25), (2, "x" * 25), (3, "y" * 19), (4, "y" * 19), (5, "y" * 19)]
    assert {r.n_dropped for r in lines.dedup_lines(documents(spark, rows)).collect()} == {0}


# --- exact dedup ----------------------------------------------------------------

def kept_copies(rows):
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = collections.Counter()
    for d, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        out[d, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("block", [1, 7, 8192])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, block, weak):
    rows = [r for r in texts() if block > 1 or len(r[1] or "") < 300]
    fingerprint = (lambda b: F.pmod(F.xxhash64(b), F.lit(3))) if weak else F.xxhash64
    if weak and block == 1:
        pytest.skip("one weak fingerprint is enough")
    named = copies.exact_copies(documents(spark, rows), block, fingerprint)
    assert found(named, "doc_id", "keep_id", "group_size", "text_sha256") == kept_copies(rows)
    stays = collections.Counter(r.text_sha256 for r in named.filter("kept").collect())
    assert set(stays.values()) == {1} and len(stays) == len({t or "" for _, t in rows})
    assert {(r.row, r.level, r.names[0]) for r in named.collect()} == {("r", 7, 1)}


def test_exact_dedup_of_nothing(spark):
    assert copies.exact_copies(documents(spark, [])).count() == 0


def test_blocks_in_another_order_are_another_text(spark):
    a, b = "a" * 8192, "b" * 8192
    rows = [(1, a + b), (2, b + a), (3, a + b), (4, a), (5, a + a), (6, a + b + a), (7, a + b + "\0")]
    named = copies.exact_copies(documents(spark, rows))
    assert {r.doc_id: r.keep_id for r in named.collect()} == {1: 3, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7}


# --- n-gram join ----------------------------------------------------------------

@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100), (2, 70, 100)])
def test_ngram_components(spark, n, num, den):
    rows = [r for r in texts()]
    # Chains of near copies: ends are not linked, but the middle connects them.
    chain = prose(50, 120).split(" ")
    for i in range(30):
        at = (37 * i) % len(chain)
        chain = [*chain[:at], f"w{i}", *chain[at + 1 :]]
        rows.append((200 + i, " ".join(chain)))
    sets = [shingles(t, n) for _, t in rows]
    groups = linked_groups(sets, num, den)
    least = collections.defaultdict(list)
    for (d, _), g in zip(rows, groups):
        if d is not None:
            least[g].append(d)
    want = collections.Counter(
        (d, len(s), d if not s else min(least[g], default=None)) for (d, _), s, g in zip(rows, sets, groups)
    )
    joined = ngram_join.jaccard_components(documents(spark, rows), n, num, den)
    assert found(joined, "doc_id", "n_shingles", "component_id") == want
    stay = ngram_join.one_of_each(documents(spark, rows), n, num, den)
    assert stay.columns == documents(spark).columns
    full = [(d, g) for (d, _), g, s in zip(rows, groups, sets) if s]
    assert stay.filter(F.length(F.regexp_replace("text", r"\s", "")) > 0).count() == len({g for _, g in full})
    assert set(found(stay, "key", "bucket", "rank")) == {(EXTRA[1], EXTRA[3], EXTRA[4])}


def near_threshold_rows():
    """A text, and copies of it whose similarities to each other lie on both sides of 0.85."""
    pick = random.Random(8)
    first = prose(60, 200).split(" ")
    rows = []
    for i in range(60):
        words = list(first)
        for at in pick.sample(range(len(words)), i % 6):
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_ngram_components_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", 7)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1500)
    rows = near_threshold_rows()
    groups = linked_groups([shingles(t, 4) for _, t in rows], 85, 100)
    least = {g: min(d for (d, _), h in zip(rows, groups) if h == g) for g in groups}
    assert 1 < len(least) < len(rows)
    joined = ngram_join.jaccard_components(documents(spark, rows), 4, 85, 100)
    assert {r.doc_id: r.component_id for r in joined.collect()} == {d: least[g] for (d, _), g in zip(rows, groups)}


def test_last_search_writes_no_more_rows_than_sets():
    import numpy as np
    import pyarrow as pa

    rows = near_threshold_rows()
    hashed = [ngram_join.Shingles(4)(t.encode()) for _, t in rows]
    ids = [d for d, _ in rows]
    # Two buckets of the same sets, each set a component of its own.
    columns = {
        "bucket": [1] * len(ids) + [2] * len(ids), "i": 0, "j": 0, "left": True, "one": True, "id": ids * 2,
        "root": ids * 2, "n": [len(h) for h in hashed] * 2,
        "point": [ngram_join.point_of(h).tobytes() for h in hashed] * 2,
    }
    columns = {k: v if isinstance(v, list) else [v] * 2 * len(ids) for k, v in columns.items()}
    batch = pa.RecordBatch.from_pydict(columns)
    near = [r for out in ngram_join._searched([batch], 85, 100) for r in out.to_pylist()]
    # Fewer rows than sets for each bucket, however many pairs are near.
    assert len({r["u"] for r in near}) < len(ids) and len(near) < 2 * len(ids)
    assert all(r["v"] < r["u"] for r in near)
    # Links of one bucket connect what all pairs connect.
    texts = pa.array([t.encode() for _, t in rows])
    one = pa.RecordBatch.from_arrays([*batch.slice(0, len(ids)).columns, texts], names=[*batch.schema.names, "text"])
    links = [r for out in ngram_join._compared([one], 4, 85, 100) for r in out.to_pylist()]
    groups = linked_groups([shingles(t, 4) for _, t in rows], 85, 100)
    group_of = dict(zip(ids, groups))
    assert all(group_of[r["u"]] == group_of[r["v"]] for r in links)
    assert len(links) == len(ids) - len(set(groups))
    n = len(ids)
    least = ngram_join._least(n, np.array([r["u"] for r in links]), np.array([r["v"] for r in links]))
    assert len(set(least.tolist())) == len(set(groups))


def test_wide_sets_are_told_apart_without_their_texts():
    import math

    import numpy as np
    import pyarrow as pa

    pick = np.random.default_rng(5)

    def some(n):
        return pick.integers(0, 1 << 63, n, dtype=np.uint64)

    # Sets of like size without a common shingle, on both sides of a step in the number of parities.
    sets = [np.unique(some(n)) for n in (2925, 2926, 3000, 5000, 5100, 5850, 5851, 6000, 6100, 7000) for _ in range(3)]
    unlike = len(sets)
    # As different as a link allows, a set that is just wide and one that is not among them.
    for n in (2049, 2300, 2927, 5851, 6000, 20000):
        whole = np.unique(some(n))
        sets += [whole, whole[: math.ceil(0.8 * len(whole))]]
    ids = list(range(len(sets)))
    columns = {
        "bucket": 1, "i": 0, "j": 0, "left": True, "one": True, "id": ids, "root": ids,
        "n": [len(s) for s in sets], "point": [ngram_join.shape_of(s) for s in sets],
    }
    columns = {k: v if isinstance(v, list) else [v] * len(ids) for k, v in columns.items()}
    a, b, _ = ngram_join._near(pa.Table.from_pydict(columns), 80, 100)
    want = {(i, i + 1) for i in range(unlike, len(ids), 2)}
    assert {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())} == want
    parities = [ngram_join.parities_of(s) for s in sets]
    x, y = np.triu_indices(len(sets), 1)
    least = ngram_join._differing(parities, x, y).tolist()
    assert all(d <= len(np.setxor1d(sets[i], sets[j])) for d, i, j in zip(least, x, y))


def test_ngram_join_of_nothing(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).count() == 0
    assert ngram_join.one_of_each(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        ngram_join.jaccard_components(documents(spark), num=50)


def test_linked_sets_share_a_key():
    import random

    import numpy as np

    pick = random.Random(3)
    for n in (6, 7, 8, 11, 13, 20, 33, 57, 120, 400, 1500):
        for _ in range(20):
            a = np.array(sorted(pick.sample(range(1 << 60), n)), dtype=np.uint64)
            # As different as a link allows.
            gone = pick.randint(0, n)
            b = a
            for size in range(gone, -1, -1):
                for extra in range(0, 3 * n):
                    both = n - size
                    if 100 * both < 85 * (n + extra):
                        break
                    b = np.unique(np.concatenate([a[size:], np.array(pick.sample(range(1 << 60), extra), dtype=np.uint64)]))
                if len(b) != n or size:
                    break
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert set(ngram_join.keys_of(a, 85, 100)) & set(ngram_join.keys_of(b, 85, 100))


def test_rtree_finds_what_the_bound_allows():
    import numpy as np

    pick = np.random.default_rng(4)
    points = pick.poisson(2.0, (700, ngram_join.GROUPS))
    points[::7] = points[0] + pick.integers(0, 2, (100, ngram_join.GROUPS)) * (pick.random((100, ngram_join.GROUPS)) < 0.05)
    sizes = points.sum(axis=1)
    tree = ngram_join.RTree(points, sizes)
    got = {(int(a), b) for asking, b in tree.search(points[:200], sizes[:200], 85, 100) for a in asking}
    want = set()
    for a in range(200):
        both = np.minimum(points[a], points).sum(axis=1)
        fits = (both * 185 >= 85 * (sizes[a] + sizes)) & (sizes[a] * 85 <= sizes * 100) & (sizes * 85 <= sizes[a] * 100)
        want |= {(a, int(b)) for b in np.flatnonzero(fits)}
    assert got == want and len(want) > 200


# --- licences -------------------------------------------------------------------

FILES = [
    (1, "a/b/c/x.py", f"{LICENSE}\n{prose(1)}"),
    (2, "a/b/c/y.py", prose(2)),
    (3, "a/b/COPYING", "Licensed under the Apache License, Version 2.0."),
    (4, "a/z.py", prose(3)),
    (5, "a/b/deep/er/z.py", prose(4)),
    (6, "LICENSE", "This work is licensed under the GNU General Public License, version 3."),
    (7, "top.py", None),
    (8, None, LICENSE),
    (9, None, prose(5)),
    (10, "a/b/tie", "Licensed under CC BY-NC 4.0."),
    (11, "q/r/one.py", ""),
]


def test_licences(spark):
    files = spark.createDataFrame([(d, t, p, "v") for d, p, t in FILES], "doc_id long, text string, place string, via string")
    scanned = licenses.scan(files, F.col("place"))
    got = {r.doc_id: (r.license, r.via, r.license_dir) for r in scanned.collect()}
    assert got[1] == ("MIT", "header", None)
    assert got[4] == ("GPL-3.0", "directory", "")
    # Two licence files of one directory score alike: the smaller name.
    assert got[2] == got[5] == ("Apache-2.0", "directory", "a/b")
    assert got[7] == got[11] == ("GPL-3.0", "directory", "")
    assert got[8] == ("MIT", "header", None) and got[9] == (None, None, None)
    db = duckdb.connect()
    frame = files.toPandas()
    db.register("frame", frame)
    db.execute("CREATE TABLE given AS SELECT * FROM frame")
    rows = db.execute(licenses.scan_sql("given", "place")).fetchall()
    names = ("doc_id", "path", "license", "via", "license_dir", "license_score")
    assert collections.Counter(rows) == found(scanned, *names)
    assert licenses.scan(files.limit(0), F.col("place")).count() == 0
