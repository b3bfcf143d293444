"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staveline.llm.common import held_out

# Labelled documents of each class that the classifier is fitted on, at most.
SAMPLE = 5000
# Beginnings of words that are features, besides the whole word.
STEMS = range(3, 10)
FEATURES = 20_000
CACHED_WORDS = 500_000
THRESHOLD = 0.7

# Longer runs of letters are not one word.
LONGEST_WORD = 40
# Pieces of text in scripts without spaces that are features, wherever they begin.
PIECES = range(1, 10)
# Thai, Lao, Burmese, Khmer, kana, Chinese characters, half-width kana.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30fa\u30fc-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003134f"
)
_PARTS = re.compile(rf"[{_UNSPACED}]+|[^\W_{_UNSPACED}]+|[.!?\n]+")
_FIRST_UNSPACED = re.compile(f"[{_UNSPACED}]")


def _features(word: str) -> list[str]:
    """The whole word and its beginnings, each once.

    Where words are not told apart, in scripts without spaces and in very long runs,
    a word may begin at any place; those that begin elsewhere have the same features.
    """
    unspaced = _FIRST_UNSPACED.match(word)
    if unspaced or len(word) > LONGEST_WORD:
        sizes = PIECES if unspaced else STEMS
        return list(dict.fromkeys(word[i : i + n] for i in range(len(word)) for n in sizes if i + n <= len(word)))
    return [*(word[:n] for n in STEMS if n < len(word)), f"{word}$"]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words in lower case) of each sentence that has a word."""
    start, end, words = 0, 0, []
    for m in _PARTS.finditer(text):
        part = m.group()
        if part[0] in ".!?\n":
            if words:
                yield start, m.end(), words
            words = []
        else:
            if not words:
                start = m.start()
            words.append(part.lower())
            end = m.end()
    if words:
        yield start, end, words


class _Weights(dict):
    """word -> sum of the weights of its features, worked out when first met."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        found = sum(self.weights.get(f, 0.0) for f in _features(word))
        if len(word) <= LONGEST_WORD:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = found
        return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    per_length: float  # weight of the log of the number of sentences
    cache: _Weights = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.cache = _Weights(self.weights)

    def __reduce__(self):
        return Model, (self.weights, self.bias, self.per_length)

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability that the document is toxic, and its sentences above one half."""
        of_word = self.cache.__getitem__
        spans, sums = [], []
        for start, end, words in sentences(text):
            spans.append((start, end))
            # A word counts once in a sentence, so that repeating it says nothing new.
            sums.append(math.fsum(map(of_word, set(words))))
        if not sums:
            sums = [0.0]
            spans = [(0, 0)]
        z = np.array(sums) + self.bias + self.per_length * math.log1p(len(sums))
        soft = np.logaddexp(0, z)
        each = 1 - np.exp(-soft)
        where = np.flatnonzero(each >= 0.5)
        return float(-np.expm1(-soft.sum())), [(*spans[i], float(each[i])) for i in where]


def _chosen(texts: list[str], labels: np.ndarray, weight: np.ndarray) -> dict[str, int]:
    """The features that differ most between the classes, with at least 3 documents."""
    toxic: Counter[str] = Counter()
    clean: Counter[str] = Counter()
    for text, label in zip(texts, labels):
        words = {w for _, _, ws in sentences(text) for w in ws}
        (toxic if label else clean).update({f for w in words for f in _features(w)})
    n1, n0 = max(labels.sum(), 1), max((1 - labels).sum(), 1)
    scored = []
    for f in toxic.keys() | clean.keys():
        a, b = toxic[f], clean[f]
        if a + b >= 3:
            odds = math.log((a + 0.5) / (n1 - a + 0.5)) - math.log((b + 0.5) / (n0 - b + 0.5))
            z = odds / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if abs(z) >= 2.5:
                scored.append((-abs(z), f))
    return {f: i for i, (_, f) in enumerate(sorted(scored)[:FEATURES])}


def fit(texts: list[str], labels: list[int], weights: list[float], rounds: int = 400) -> Model:
    """Sentence weights such that the noisy-or over sentences agrees with document labels.

    A document is toxic if at least one sentence is: P = 1 - prod(1 - p_s). Its
    likelihood is maximised by gradient steps, with a quadratic charge on weights.
    The log of the number of sentences is a feature, so long texts are not toxic
    for their length.
    """
    y = np.array(labels, dtype=float)
    w_doc = np.array(weights, dtype=float)
    w_doc /= w_doc.sum()
    index = _chosen(texts, y, w_doc)
    columns, rows, docs, sizes = [], [], [], []
    n = 0
    for d, text in enumerate(texts):
        found = list(sentences(text)) or [(0, 0, [])]
        sizes.append(math.log1p(len(found)))
        for _, _, words in found:
            for w in sorted(set(words)):
                hits = [index[f] for f in _features(w) if f in index]
                columns += hits
                rows += [n] * len(hits)
            docs.append(d)
            n += 1
    col, row, doc = np.array(columns, dtype=np.int64), np.array(rows, dtype=np.int64), np.array(docs)
    size = np.array(sizes)[doc]
    theta = np.zeros(len(index) + 2)
    theta[-2] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    charge = np.full(len(theta), 1e-5)
    charge[-2:] = 0
    for step in range(1, rounds + 1):
        z = np.bincount(row, theta[col], minlength=n) + theta[-2] + theta[-1] * size
        soft = np.logaddexp(0, z)
        total = np.bincount(doc, soft, minlength=len(y))
        slope = w_doc * np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-9, 50)), 1.0)
        g_z = slope[doc] * -np.expm1(-soft)
        grad = np.empty_like(theta)
        grad[:-2] = np.bincount(col, g_z[row], minlength=len(index))
        grad[-2], grad[-1] = g_z.sum(), (g_z * size).sum()
        grad += 2 * charge * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        rate = 0.1 * min(1.0, 2.0 * (1 - step / (rounds + 1)))
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    kept = {f: float(theta[i]) for f, i in index.items() if abs(theta[i]) > 1e-3}
    return Model(kept, float(theta[-2]), float(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, sample: int = SAMPLE) -> Model:
    """A model from labelled documents whose crc32 of the doc_id does not leave ``remainder``.

    Of each class at most ``sample`` documents are taken, those of the smallest
    hashes of their doc_id; documents weigh as much as those they stand for. One
    task fits the sample, which is bounded by this parameter. Labels that are null,
    or that have no document, do not count; of several labels the larger holds.
    Without any labelled document everything scores 0.
    """
    spark = docs.sparkSession
    given = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(remainder, modulus))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    order = [F.xxhash64("label_id"), F.col("label_id")]
    counts = {r["toxic"]: r["n"] for r in given.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [
        (r["label_id"], r["toxic"], counts[r["toxic"]] / min(sample, counts[r["toxic"]]))
        for kind in sorted(counts)
        for r in given.filter(F.col("toxic") == kind).orderBy(*order).limit(sample).collect()
    ]
    if not picked:
        return Model({}, -50.0, 0.0)
    chosen = spark.createDataFrame(picked, "label_id long, toxic int, weight double")
    # At most 2 * sample rows.
    found = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select(
        "label_id", F.coalesce("text", F.lit("")).alias("text"), "toxic", "weight"
    )

    def fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(tuple(r.values()) for batch in batches for r in batch.to_pylist())
        model = Model({}, -50.0, 0.0)
        if rows:
            _, texts, toxic, weight = zip(*rows)
            model = fit(list(texts), list(toxic), list(weight))
        names = [*model.weights, "", " "]
        values = [*model.weights.values(), model.bias, model.per_length]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(values)], names=["name", "value"])

    rows = found.repartition(1).mapInArrow(fitted, "name string, value double").collect()
    values = {r["name"]: r["value"] for r in rows}
    bias, per_length = values.pop("", -50.0), values.pop(" ", 0.0)
    return Model(values, bias, per_length)


SCORED = (
    "doc_id long, held_out boolean, score double, predicted int,"
    " sentences array<struct<start:int,end:int,score:double>>"
)


def score(
    docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, carry: bool = False
) -> DataFrame:
    """The toxicity of every whole text, and where it is.

    Sentences end at . ! ? and line ends; underscores part words. A sentence is scored
    by its words and their beginnings, text without spaces and very long runs of
    letters by the pieces that begin at each place, the document by the noisy-or of its sentences; ``sentences``
    has the character spans of those above one half. ``predicted`` is 1 from a score
    of 0.7. Only the text is an input of a score.

    Null text is empty: one sentence without words. Rows with null or repeated
    doc_ids and repeated rows are scored each; a null doc_id counts as empty text for
    ``held_out``. Other columns are not read, but with ``carry`` the whole input row
    comes along as ``document``. An empty table gives an empty table.
    """
    model = train(docs, labels, modulus, remainder)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        for batch in batches:
            found = [model.score(t.as_py() or "") for t in batch.column(2)]
            scores = [min(max(s, 0.0), 1.0) for s, _ in found]
            spans = [[{"start": a, "end": b, "score": p} for a, b, p in where] for _, where in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                    pa.array(spans, pa.list_(span)),
                    *batch.columns[3:],
                ],
                names=["doc_id", "held_out", "score", "predicted", "sentences", *batch.schema.names[3:]],
            )

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(remainder, modulus).alias("held_out"),
        "text",
        *([whole] if carry else []),
    )
    schema = StructType.fromDDL(SCORED)
    if carry:
        schema = schema.add(slim.schema["document"])
    return slim.mapInArrow(scored, schema)
