"""The registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.llm import (
    bpe,
    collocations,
    copies,
    licenses,
    lines,
    neighbours,
    ngram_join,
    packing,
    sharding,
    spelling,
    substrings,
    suffix_tree,
    toxicity,
)
from staveline.llm.common import held_out, table
from staveline.llm.tokens import vocabulary_path
from staveline.session import ship_package, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: query(ship_package(tune(spark)), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return query

    return keep


@register("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode_and_decode(docs, vocabulary_path("word_bpe_49k.json"))
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"), capacity=2048, end_id=0)


@register("op3_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


# The corpus has no paths of its own: a document lies below its source and its language.
PLACE = "concat(source, '/', lang, '/', CAST(doc_id AS STRING))"


@register("op4_licenses", licenses.scan_sql("documents", PLACE.replace("STRING", "VARCHAR")))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan(docs, F.expr(PLACE))
    return found.select("doc_id", "path", "license", "via", "license_dir", "license_score")


@register("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, labels, modulus=3, remainder=1)
    return scored.select("doc_id", "held_out", "score", "predicted")


@register(
    "op6_line_dedup",
    r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ), shared AS (
        SELECT key, max(doc_id) AS last FROM keyed
        WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ), marked AS (
        SELECT k.*, s.last IS NOT NULL AND s.last <> k.doc_id AS dropped
        FROM keyed k LEFT JOIN shared s ON k.key = s.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    kept_sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", kept_sha.alias("kept_sha256"))


@register(
    "op7_exact_dedup",
    """
    WITH groups AS (
        SELECT coalesce(text, '') AS text, max(doc_id) AS keep_id, count(*) AS group_size
        FROM documents GROUP BY 1
    )
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.text) AS text_sha256
    FROM documents d JOIN groups g ON coalesce(d.text, '') = g.text
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = copies.exact_copies(table(spark, sf_dir, "documents"))
    return named.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op8_ngram_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@register("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op10_suffix_tree")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = suffix_tree.score(docs, modulus=5, remainder=1).alias("s")
    out = held_out(1, 5).alias("held_out")
    return scored.select(
        "doc_id", out, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@register(
    "op11_substrings",
    r"""
    WITH split AS (
        SELECT rowid AS row, doc_id,
               [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+') IF w <> ''] AS words
        FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
    ), windows AS (
        SELECT row, doc_id, i, array_to_string(words[i : i + 12], ' ') AS passage
        FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM split)
    ), first AS (
        SELECT passage, min(doc_id) AS least FROM windows GROUP BY passage HAVING min(doc_id) < max(doc_id)
    ), gone AS (
        SELECT DISTINCT row, unnest(range(i, i + 13)) AS i
        FROM windows JOIN first USING (passage) WHERE least < doc_id
    ), places AS (
        SELECT row, doc_id, i, words[i] AS word FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM split)
    ), marked AS (
        SELECT p.*, g.i IS NOT NULL AS gone FROM places p LEFT JOIN gone g ON p.row = g.row AND p.i = g.i
    ), kept AS (
        SELECT row, count(*) AS n, count(*) FILTER (gone) AS n_gone,
               coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text
        FROM marked GROUP BY row
    )
    SELECT s.doc_id, coalesce(k.n, 0) AS n_words, coalesce(k.n_gone, 0) AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM split s LEFT JOIN kept k ON s.row = k.row
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.dedup_substrings(table(spark, sf_dir, "documents"), words=13)
    kept_sha = F.sha2(F.col("kept").cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_removed", kept_sha.alias("kept_sha256"))


@register("op12_spelling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), min_letters=6, min_count=5, ratio=5, noise=199)


@register(
    "op13_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\n\x0b\x0c\r]')) AS piece
        FROM documents
    ), split AS (
        SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \t]+') IF w <> ''] AS words FROM pieces
    ), totals AS (
        SELECT lang, sum(len(words)) AS n FROM split GROUP BY lang
    ), grams AS (
        SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase
        FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
              FROM split, (SELECT unnest(range(1, 6)) AS size))
    ), counted AS (
        SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
    ), listed AS (
        SELECT *, string_split(phrase, ' ') AS words FROM counted
    ), longer AS (
        SELECT lang, unnest([array_to_string(words[1 : size - 1], ' '), array_to_string(words[2 : size], ' ')]) AS phrase, f
        FROM listed WHERE size > 2
    ), carried AS (
        SELECT lang, phrase, max(f) AS f FROM longer GROUP BY ALL
    ), cut AS (
        SELECT c.lang, c.phrase, c.f AS a, k, array_to_string(words[1 : k], ' ') AS head,
               array_to_string(words[k + 1 : size], ' ') AS tail
        FROM (SELECT *, unnest(range(1, size)) AS k FROM listed WHERE size > 1) c
        LEFT JOIN carried l ON l.lang = c.lang AND l.phrase = c.phrase
        WHERE l.f IS NULL OR l.f < c.f
    ), scored AS (
        SELECT c.*, h.f AS l, t.f AS r, o.n,
               (1000::HUGEINT * a * o.n::HUGEINT) // (h.f::HUGEINT * t.f::HUGEINT) AS score
        FROM cut c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head
        JOIN counted t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals o ON o.lang = c.lang
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    )
    SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM lowest
    WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
    QUALIFY rank <= 2000
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=5, min_count=100, top=2000)
