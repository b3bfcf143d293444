"""Spelling variants: words one letter apart, met by their pivotal grams."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.llm.common import encoded_texts
from staveline.session import settled

# Fixed values of the contract: letters are A-Z, a-z and U+00C0 to U+00FF.
# In UTF-8 the last 64 are the byte c3 and one more; all other lead bytes are no letters.
_RUNS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_OTHER = re.compile(rb"[\xc2\xc4-\xff][\x80-\xbf]*")
# Lower-cased words have 26 + 64 letters, so there are at most 90 * 90 grams of two.
MAX_GRAMS = 90 * 90
HELD_WORDS = 200_000
LONG_WORD = 64


def _runs(text: bytes) -> list[bytes]:
    """Maximal runs of letters, A-Z in lower case."""
    return _OTHER.sub(b" ", text.translate(_RUNS)).split()


def _noised(run: bytes, check: int) -> bytes:
    """The run without the letter that the checksum points at."""
    letters = run.decode()
    at = check % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _word_counts(
    batches: Iterable[pa.RecordBatch], min_letters: int, noise: int
) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def flushed() -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for doc, text in encoded_texts(batches, "doc", "text"):
        seed = zlib.crc32(f"{doc}:".encode())
        for run, n in Counter(_runs(text)).items():
            # Fewer bytes are fewer letters, and deleting adds none.
            if len(run) < min_letters:
                continue
            if noise:
                check = zlib.crc32(run, seed)
                if check % noise == 0:
                    run = _noised(run, check)
            held[run] += n
        if len(held) >= HELD_WORDS:
            yield flushed()
            held.clear()
    if held:
        yield flushed()


def counted_words(docs: DataFrame, min_letters: int, min_count: int, noise: int = 0) -> DataFrame:
    """(word, n) of the runs of letters of all texts, of this length and count.

    With ``noise``, a run loses one letter in the documents where ``noise`` divides
    the crc32 of ``<doc_id>:<run>``; the same letter wherever the checksum is the same.
    """
    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    found = slim.mapInArrow(lambda it: _word_counts(it, min_letters, noise), "word string, n long")
    words = found.filter(F.char_length("word") >= min_letters).groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= min_count)


def gram_weights(words: DataFrame) -> dict[str, int]:
    """How many places of distinct words each gram of two letters has; at most ``MAX_GRAMS`` grams."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.col("word").substr(i, F.lit(2)))).alias("g"))
    rows = grams.groupBy("g").agg(F.count("*").alias("n")).collect()
    if len(rows) > MAX_GRAMS:
        raise ValueError("words hold letters beyond the alphabet of 90")
    return {r.g: r.n for r in rows}


def gram_prefix(word: str, rank: dict[str, int]) -> tuple[list[int], int]:
    """Places of the word's rarest grams, and the rank of the last of them.

    Three grams, one more than an edit can destroy (two) - and all that are as rare
    as the third, so that the prefix is a set of ranks and not of places.
    """
    ranks = [rank[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    return [i for i, r in enumerate(ranks) if r <= last], last


def pivots(word: str, places: list[int], weight: dict[str, int]) -> tuple[int, int]:
    """The two disjoint grams among these places that cost least, left one first.

    A left pivot is looked up with all letters before it, a right one with all letters
    behind it; each of these letters makes a list about four times shorter. Dynamic
    programming from left to right: the best left pivot so far, two places back or
    more, with each place as the right one.
    """
    best, left_best, waiting = None, None, []
    for i in places:
        gram = weight[word[i : i + 2]]
        while waiting and waiting[0][1] <= i - 2:
            left_best = min(waiting.pop(0), left_best or (float("inf"), 0))
        if left_best is not None:
            cost = left_best[0] + gram / 4 ** (len(word) - i - 2)
            if best is None or cost < best[0]:
                best = (cost, left_best[1], i)
        waiting.append((gram / 4**i, i))
    return best[1], best[2]


def _parts(word: str) -> tuple[list[int], list[int]]:
    """64-bit hashes: of all letters through the gram at each place, and of all from that place on."""
    heads, tails = [], []
    for letters, out in ((word, heads), (word[::-1], tails)):
        running = xxhash.xxh64()
        for i, letter in enumerate(letters):
            running.update(letter.encode())
            if i:
                out.append(running.intdigest() - (1 << 63))
    return heads, tails[::-1]


def _keys(
    batches: Iterable[pa.RecordBatch], weight: dict[str, int], probes: bool
) -> Iterator[pa.RecordBatch]:
    """Rows (side, part, size, id, word, n, last) under which words are found, or look for others."""
    rank = {g: i for i, g in enumerate(sorted(weight, key=lambda g: (weight[g], g)))}
    kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int32()]
    names = ["side", "part", "size", "id", "word", "n", "last"]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    out = []
    for batch in batches:
        for key, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            places, last = gram_prefix(word, rank)
            heads, tails = _parts(word)
            size = len(word)
            rest = (key, word if size <= LONG_WORD else None, n, last)
            if probes:
                left, right = pivots(word, places, weight)
                for other in (size - 1, size, size + 1):
                    out.append((True, heads[left], other, *rest))
                    out.append((False, tails[right], other, *rest))
            else:
                for i in places:
                    out.append((True, heads[i], size, *rest))
                    out.append((False, tails[i], size, *rest))
            if len(out) >= 20_000:
                yield packed(out)
                out = []
    if out:
        yield packed(out)


KEYS = "side boolean, part long, size int, {0}_id long, {0} string, {0}_n long, {0}_last int"


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): words one inserted, deleted or replaced letter apart, each pair once.

    ``words`` (id, word, n) are distinct, of four letters or more, and stored. Grams are
    the two-letter pieces of a word, in order of rarity. One edit destroys at most one
    of two disjoint grams. So of two near words, the one whose gram prefix ends at the
    rarer gram has a pivot that lives on in the other, at a rank within the other's
    prefix: pivots of the first are looked up among the prefixes of the second. The
    edit lies behind the left pivot, or in front of the right one, or both; so all
    letters up to the left pivot agree, or all from the right pivot on. The hash of
    these letters is the key, which also fixes the place within its limits. What meets
    is verified by edit distance. Words beyond ``LONG_WORD`` letters, which may have
    very many places, come to that by their id and not with every key.
    """
    weight = gram_weights(words)
    slim = words.select("id", "word", "n")
    probe = slim.mapInArrow(lambda it: _keys(it, weight, True), KEYS.format("a"))
    index = slim.mapInArrow(lambda it: _keys(it, weight, False), KEYS.format("b"))
    met = probe.join(index, ["side", "part", "size"])
    met = met.filter("a_last < b_last OR (a_last = b_last AND a_id < b_id)")
    apart = F.levenshtein("a", "b", 1) == 1
    near = met.filter("a IS NOT NULL AND b IS NOT NULL").filter(apart).select("a", "a_n", "b", "b_n").distinct()
    # The longer word of a pair decides; one letter more or less may be on the other side of the limit.
    long = met.filter("a IS NULL OR b IS NULL").select("a_id", "a_n", "b_id", "b_n").distinct()
    spelt = words.filter(F.char_length("word") >= LONG_WORD)
    for side in ("a", "b"):
        long = long.join(spelt.select(F.col("id").alias(f"{side}_id"), F.col("word").alias(side)), f"{side}_id")
    return near.unionByName(long.filter(apart).select("a", "a_n", "b", "b_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: the last word that forms lead to.

    Every turn doubles the steps taken; counts grow along a chain, so it ends.
    """
    steps = settled(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if steps.join(ahead, "root", "left_semi").isEmpty():
            return steps
        jumped = steps.join(ahead, "root", "left")
        steps = settled(jumped.select("word", F.coalesce("further", "root").alias("root")), "spelling-steps")


def variants(
    docs: DataFrame, min_letters: int = 6, min_count: int = 5, ratio: int = 5, noise: int = 0
) -> DataFrame:
    """Frequent words with the more frequent word that each may be a misspelling of.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, with at
    least ``min_letters`` code points (four or more) and ``min_count`` occurrences; see
    ``counted_words`` for ``noise``. Two are near if one inserted, deleted or replaced
    code point makes them equal. A word's ``form`` is its near word of largest count,
    of equal ones the smallest in code-point order, if that has ``ratio`` (two or more)
    times the word's occurrences; ``root`` is where forms lead to from the word.

    Returns (word, form, root, n, n_near, form_n). Null or empty texts have no words; a
    null doc_id is empty text in the checksum; repeated rows count each; other columns
    are not read; an empty table gives an empty table. Texts of any length are counted
    whole, one text in memory; a long word has as many rows as it has places of its
    rarest grams.

    Words are counted in each task before they are shuffled, so a frequent word is one
    row a task. What follows works on distinct words. The weights of grams, at most
    8,100 numbers, are the only thing sent to every task. A long list of one key is
    split at run time.
    """
    if min_letters < 4 or ratio < 2:
        raise ValueError("words need four letters, and forms twice the count")
    counted = counted_words(docs, min_letters, min_count, noise)
    words = settled(counted.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = settled(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    first = F.min(F.struct((-F.col("near_n")).alias("order"), "near", "near_n"))
    nearest = both.groupBy("word").agg(F.count("*").alias("n_near"), first.alias("first"))
    has_form = F.col("first.near_n") >= ratio * F.col("n")
    named = settled(
        words.join(nearest, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("first.near")).alias("form"),
            F.when(has_form, F.col("first.near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(named.filter("form IS NOT NULL"))
    rooted = named.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

