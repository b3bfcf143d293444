"""Substring dedup, spelling variants and phrase collocations against brute force."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from staveline.llm import collocations, spelling, substrings
from staveline.llm.queries import QUERIES, SQL
from tests.llm.fixtures import documents, found, prose, texts

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[ \t\n\x0b\x0c\r]+")


# --- substring dedup -------------------------------------------------------------------


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def brute_dedup(rows, width):
    least = {}
    for doc_id, text in rows:
        words = split(text)
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            rank = -(1 << 63) if doc_id is None else doc_id
            least[key] = min(rank, least.get(key, rank))
    out = collections.Counter()
    for doc_id, text in rows:
        words = split(text)
        rank = -(1 << 63) if doc_id is None else doc_id
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if least[tuple(words[i : i + width])] < rank:
                gone[i : i + width] = [True] * width
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        spans, i = [], 0
        while i < len(words):
            j = i
            while j < len(words) and gone[j]:
                j += 1
            if j > i:
                spans.append((i, j - i, " ".join(words[i:j])))
            i = max(j, i + 1)
        out[(doc_id, len(words), sum(gone), kept, tuple(spans))] += 1
    return out


def spans_of(df):
    return collections.Counter(
        (r.doc_id, r.n_words, r.n_removed, r.kept, tuple(tuple(s) for s in r.spans)) for r in df.collect()
    )


def passages():
    """Documents that share passages of every length, at every place, and hot ones."""
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [pick.choices(vocabulary, k=n) for n in (8, 12, 13, 14, 20, 60)]
    out = []
    for doc_id in range(60):
        words = pick.choices(vocabulary, k=pick.randint(0, 40))
        for passage in pick.sample(shared, 3):
            at = pick.randint(0, len(words))
            words[at:at] = passage
        if doc_id % 3 == 0:
            words += shared[3] + ["z"] * 30
        out.append((doc_id, pick.choice([" ", "\n", "\t "]).join(words)))
    return out + [(5, "an other text of five"), (59, out[59][1]), (None, out[0][1]), (None, " ".join(shared[5]))]


@pytest.mark.parametrize(("width", "group"), [(13, 250_000), (13, 4), (6, 30), (9, 250_000)])
def test_passages_by_brute_force(spark, width, group):
    rows = passages()
    assert spans_of(substrings.dedup_substrings(documents(spark, rows), width, group)) == brute_dedup(rows, width)


def test_awkward_texts_and_no_texts(spark):
    assert spans_of(substrings.dedup_substrings(documents(spark))) == brute_dedup(texts(), 13)
    assert substrings.dedup_substrings(documents(spark, [])).count() == 0
    assert spans_of(substrings.dedup_substrings(documents(spark, [(1, None)]))) == {(1, 0, 0, "", ()): 1}
    with pytest.raises(ValueError):
        substrings.dedup_substrings(documents(spark, []), words=5)


def test_chunks_of_any_size_give_the_same(spark, monkeypatch):
    rows = passages()
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 700)
    got = substrings.dedup_substrings(documents(spark, rows).coalesce(1), 13, 4)
    assert spans_of(got) == brute_dedup(rows, 13)


def test_trees_need_little_beside_their_suffixes():
    import tracemalloc

    import pyarrow as pa

    pick, m = np.random.default_rng(1), 20_000
    before = pick.integers(0, 9, m).astype(np.int32)
    size = np.minimum(before + 1, pick.integers(1, 10, m)) + 12
    words = [pick.integers(0, 256, n * substrings.CODE_BYTES, dtype=np.uint8).tobytes() for n in size]
    lo = pick.integers(0, 1000, m)
    table = pa.table({
        "chunk": np.arange(m), "place": np.arange(m, dtype=np.int32), "before": before,
        "words": pa.array(words, pa.binary()), "lo": lo, "hi": lo,
    })
    tracemalloc.start()
    substrings._tree(table, 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Its words and twice the 13 of each suffix, 8 bytes each, and 100 bytes a suffix for all else.
    assert peak < 8 * int(size.sum()) + 2 * 13 * 8 * m + 100 * m


def test_a_chunk_needs_little_memory():
    import tracemalloc

    import pyarrow as pa

    pick = np.random.default_rng(6)
    text = lambda: " ".join(f"w{i}" for i in pick.integers(0, 50_000, 1000))
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(1100)), "text": [text() for _ in range(1100)]})
    chunks = list(substrings._chunks([rows]))
    assert sum(len(c["head"][0]) for c in chunks) == 1100
    for chunk in chunks:
        row = {name: chunk.column(name)[0] for name in chunk.schema.names} | {"chunk": pa.scalar(1)}
        tracemalloc.start()
        for _ in substrings._anchors(row, 13):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 50 << 20


def test_anchor_is_the_smallest_gram_of_each_window():
    import pyarrow as pa

    words = [f"{i % 7}".encode() for i in range(50)] + [f"{i}".encode() for i in range(40)]
    names = ["head", "sizes", "words", "codes"]
    distinct = list(dict.fromkeys(words))
    codes = np.array([distinct.index(w) for w in words], np.uint32)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[1, 2, 3]]), pa.array([[45, 5, 40]]), *substrings.chunk_columns(distinct, codes)], names
    )
    found_ = substrings._Suffixes.of({n: batch.column(i)[0] for i, n in enumerate(names)}, 13)
    grams = substrings.rolled(found_.words, substrings.GRAM)
    windows = [(i, i + int(np.argmin(grams[i : i + 9]))) for i in [*range(33), *range(50, 78)]]
    got = [(i, a) for f, b, a in zip(found_.first, found_.last, found_.anchor) for i in range(f, b + 1)]
    assert got == windows


# --- spelling variants -----------------------------------------------------------------


LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def neighbours_by_deletion(words):
    """Near words of each word, by all their deletions."""
    by_key = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_key[w[:i] + w[i + 1 :]].add(w)
        by_key[w].add(w)
    near = collections.defaultdict(set)
    for group in by_key.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    return near


def brute_variants(rows, min_letters=6, min_count=5, ratio=5, noise=0):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in LETTERS.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_letters and c >= min_count}
    near, form = neighbours_by_deletion(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def misspelt(seed, count, letters="abcdeé"):
    """Few letters and many near words, so that grams repeat within words and lists are long."""
    pick = random.Random(seed)
    base = ["".join(pick.choices(letters, k=pick.randint(4, 9))) for _ in range(40)]
    out = []
    for doc_id in range(count):
        words = []
        for _ in range(60):
            w = list(pick.choice(base[: pick.randint(1, 40)]))
            for _ in range(pick.choice([0, 0, 0, 1, 1, 2])):
                at, kind = pick.randrange(len(w)), pick.random()
                w[at : at + (kind < 0.7)] = [] if kind < 0.35 else [pick.choice(letters)]
            words.append("".join(w) if pick.random() < 0.8 else "".join(w).upper())
        out.append((doc_id, pick.choice([" ", ", ", "4", "’", "一"]).join(words)))
    return out


@pytest.mark.parametrize(("letters", "noise", "min_letters"), [("abcdeé", 0, 6), ("ab", 7, 4), ("abcdefÿ×", 3, 5)])
def test_variants_by_brute_force(spark, letters, noise, min_letters):
    rows = [*misspelt(5, 120, letters), (None, "Letters letterS lettérs"), (3, None)]
    want = brute_variants(rows, min_letters, 2, 3, noise)
    got = found(spelling.variants(documents(spark, rows), min_letters, 2, 3, noise), *COLUMNS)
    assert len(want) > 60 and any(w[1] for w in want) and got == dict.fromkeys(want, 1)


def test_variants_of_the_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert found(QUERIES["op12_spelling"](spark, SF), *COLUMNS) == dict.fromkeys(brute_variants(rows, noise=199), 1)


def test_variants_of_awkward_and_no_texts(spark):
    got = found(spelling.variants(documents(spark), 6, 1, 5, 5), *COLUMNS)
    assert got == dict.fromkeys(brute_variants(texts(), 6, 1, 5, 5), 1)
    assert spelling.variants(documents(spark, [])).count() == 0
    for wrong in ({"min_letters": 3}, {"ratio": 1}):
        with pytest.raises(ValueError):
            spelling.variants(documents(spark, []), **wrong)


def test_chains_of_forms_lead_to_the_last(spark):
    counts = {"abcdefgh": 3000, "abcdefg": 500, "abcdef": 90, "abcdeX": 10, "Xbcdex": 2}
    rows = [(1, " ".join(" ".join([w] * n) for w, n in counts.items()))]
    got = {r.word: r.root for r in spelling.variants(documents(spark, rows), 6, 2).collect()}
    assert set(got.values()) == {"abcdefgh"} and len(got) == 5


def test_pivots_are_disjoint_and_cheapest():
    pick = random.Random(9)
    for _ in range(300):
        word = "".join(pick.choices("abc", k=pick.randint(4, 10)))
        weight = {a + b: pick.randint(1, 50) for a in "abc" for b in "abc"}
        rank = {g: i for i, g in enumerate(sorted(weight, key=lambda g: (weight[g], g)))}
        places, last = spelling.gram_prefix(word, rank)
        assert len(places) >= 3 and all((rank[word[i : i + 2]] <= last) == (i in places) for i in range(len(word) - 1))

        def cost(i, j, word=word, weight=weight):
            return weight[word[i : i + 2]] / 4**i + weight[word[j : j + 2]] / 4 ** (len(word) - j - 2)

        i, j = spelling.pivots(word, places, weight)
        assert j - i >= 2 and cost(i, j) == min(cost(a, b) for a in places for b in places if b - a >= 2)


# --- collocations ----------------------------------------------------------------------


def brute_collocations(rows, longest, min_count, top):
    total, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = collections.defaultdict(int)
        for q, b in candidates.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    inside[q[i : i + size]] = max(inside[q[i : i + size]], b)
        scored = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 100 * a:
                continue
            low = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-low[0], -a, " ".join(p).encode(), a, counts[p[: low[1]]], counts[p[low[1] :]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), a, left, right, total[lang], -score))
    return out


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def chatter(seed, count):
    pick = random.Random(seed)
    vocabulary = ["a", "B", "c", "é", "dd", "e\x1cf"]
    out = []
    for _ in range(count):
        words = []
        for _ in range(pick.randint(0, 30)):
            words += pick.choice([["New", "york", "City"], ["x", "x", "x"], ["1", "2", "3", "4", "5", "6"], [pick.choice(vocabulary)]])
        text = "".join(w + pick.choice([" ", "  ", "\t", " ", ". ", ",", "\r\n"]) for w in words)
        out.append((pick.choice(["en", "de", None]), text))
    return [*out, ("en", None), ("fr", ""), ("fr", "..!"), ("", "x x x x x x")]


@pytest.mark.parametrize(
    ("longest", "min_count", "top", "run"), [(5, 12, 2000, 256), (5, 3, 20, 4), (2, 5, 50, 256), (3, 5, 50, 1), (4, 40, 7, 2)]
)
def test_collocations_by_brute_force(spark, monkeypatch, longest, min_count, top, run):
    rows = chatter(longest, 150)
    docs = spark.createDataFrame([(i, t, lang, 1, "k") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, gram string")
    monkeypatch.setattr(collocations, "RUN", run)
    got = found(collocations.collocations(docs.repartition(5), longest, min_count, top), *PHRASE)
    want = brute_collocations(rows, longest, min_count, top)
    assert want and got == dict.fromkeys(want, 1)


def test_collocations_of_small_chunks_and_no_texts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 500)
    rows = chatter(8, 100)
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string").coalesce(2)
    assert found(collocations.collocations(docs, 5, 8, 100), *PHRASE) == dict.fromkeys(brute_collocations(rows, 5, 8, 100), 1)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(documents(spark), min_count=10**6).count() == 0


def test_keys_of_collocations_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 500)
    monkeypatch.setattr(collocations, "PART_WORDS", 20)
    rows = chatter(9, 100)
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string").coalesce(2)
    assert found(collocations.collocations(docs, 5, 8, 100), *PHRASE) == dict.fromkeys(brute_collocations(rows, 5, 8, 100), 1)


def test_keys_travel_in_fewer_bytes_than_they_have():
    import pyarrow as pa

    pick, keys = np.random.default_rng(2), []
    for chunk in range(3):
        keys.append(np.unique(pick.integers(0, 5000, 60_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(chunk // 2)))
    counts = [pick.integers(1, 9, len(k)) for k in keys]
    rows = [collocations._counted({"chunk": pa.scalar(7 - i)}, k, n, 4) for i, (k, n) in enumerate(zip(keys, counts))]
    assert sum(r.nbytes for r in rows) < 8 * sum(map(len, keys))
    want = collections.Counter()
    for k, n in zip(keys, counts):
        want.update(dict(zip(k.tolist(), n.tolist())))
    told = {}
    summed = [
        collocations._summed(pa.Table.from_batches([r.slice(i, 1) for r in rows for i in range(r.num_rows) if r["part"][i].as_py() == part]), 6)
        for part in range(4)
    ]
    answers = [row for table in summed for row in table.to_pylist()]
    for i, k in enumerate(keys):
        state, totals = collocations._states(pa.scalar([row for row in answers if row["chunk"] == 7 - i]))
        assert [s > 0 for s in state] == [want[x] >= 6 for x in k.tolist()]
        for key, total in zip(k[state == 2].tolist(), totals.tolist()):
            assert key not in told
            told[key] = total
    assert told == {k: n for k, n in want.items() if n >= 6}


def test_scores_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits: the largest counts come from repeated rows."""
    rows = [("en", "big deal. " * 20_000 + prose(4, 50))]
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    docs = docs.crossJoin(spark.range(3)).drop("id")
    got = found(collocations.collocations(docs, 5, 100, 5), *PHRASE)
    assert got == dict.fromkeys(brute_collocations(rows * 3, 5, 100, 5), 1)


@pytest.mark.parametrize("name", ["op11_substrings", "op13_collocations"])
def test_sql_holds_for_nulls(spark, tmp_path, name):
    """The SQL of the query on a table with nulls and odd spaces."""
    from checks.compare import rows_of

    rows = [(i, t) for i, (_, t) in enumerate(texts())]
    documents(spark, rows).select("doc_id", "text", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    frame = QUERIES[name](spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = db.execute(SQL[name])
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())
