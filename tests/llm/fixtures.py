"""Small tables with everything that may come, and brute-force versions of the operators."""

import collections
import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # names that the operators use inside
    " pos int, key string, row string, bucket int, rank int, node long, root string, words string,"
    " size long, names array<int>, chunk long, level int, dropped string, parts int, file string"
)
EXTRA = (1, "k", "r", 2, 3, 4, "root", "w", 5, [1], 6, 7, "d", 8, "f")
LICENSE = "Released under the MIT License."


def prose(seed, words=60):
    pick = random.Random(seed)
    syllables = ["ba", "co", "di", "fu", "ge", "ho", "Ki", "lo", "mu", "né"]
    made = ["".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(words)]
    return " ".join(w + pick.choice(["", "", "", ",", "."]) for w in made)


def texts():
    shared = "This very line is in Many documents."
    base = prose(1, 90).split(" ")
    near = [" ".join(base[:i] + [f"new{i}"] + base[i + 1 :]) for i in (5, 40, 80)]
    out = [
        (1, f"{prose(2)}\n{shared}\n{prose(3)}"),
        (2, f"  this VERY line is in many documents.\t\n{prose(4)}\n{shared}"),
        (3, f"{shared}\r\n"),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (None, prose(5)),
        (None, None),
        (7, prose(6)),
        (7, prose(6)),  # a repeated row
        (7, prose(7)),  # a repeated doc_id
        (8, prose(6)),  # a copy
        (9, "x" * 60_000),  # one very long word
        (10, prose(8, 9000)),
        (11, prose(8, 9000)),
        (12, prose(8, 9000) + " end"),
        (13, "one two three"),
        (14, "One  two\nthree"),
        (15, "one"),
        (16, "zero<|endoftext|>it's 1234 naïve Ⅷ ﬁ 日本語 x\x1cy é"),
        (17, "\n".join([LICENSE, prose(9)])),
        (18, LICENSE),
        (19, " ".join(base)),
        *[(20 + i, t) for i, t in enumerate(near)],
    ]
    return out


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(d, t, "en", f"src{(d or 0) % 2}", len(t or ""), *EXTRA) for d, t in rows]
    return spark.createDataFrame(data, SCHEMA)


def found(df, *names):
    rows = df.select(*names).collect() if names else df.collect()
    return collections.Counter(tuple(r) for r in rows)


def shingles(text, n):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    words = (text or "").encode().translate(low).split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def linked_groups(sets, num, den):
    """Group number of each set, by comparing all pairs."""
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and den * both >= num * (len(a) + len(b) - both):
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(sets))]
