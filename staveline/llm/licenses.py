"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staveline.llm.common import text_or_empty, unpacked, with_row
from staveline.session import settled

# Short notices by which licences are named.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
THRESHOLD = 0.7
SEPARATOR = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")


def _terms(spark, templates: dict[str, str]) -> DataFrame:
    """(template, term, tf); as many rows as the templates have terms."""
    given = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    return given.select("template", F.explode(words(F.col("text"))).alias("term")).groupBy("template", "term").agg(
        F.count("*").alias("tf")
    )


def _anchors(weights: dict[str, dict[str, float]], threshold: float) -> list[str]:
    """Terms without any of which no text reaches the threshold with any template.

    A text that has only the other terms of a template has at most their share of its norm.
    """
    found = set()
    for terms in weights.values():
        norm = math.sqrt(sum(w * w for w in terms.values()))
        rest = sum(w * w for w in terms.values())
        for term, weight in sorted(terms.items(), key=lambda x: (-x[1], x[0])):
            if math.sqrt(max(rest, 0.0)) < 0.99 * threshold * norm:
                break
            found.add(term)
            rest -= weight * weight
    return sorted(found)


def scan(
    files: DataFrame, path: Column, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """The licence of every file: its own, or that of the nearest directory above it.

    ``path`` gives each row its place (parts between slashes, the last is the file).
    Each line, and the whole text, is a vector of word counts times inverse document
    frequencies over all files; words of no template each count as a term of their own,
    with the greatest frequency weight. A line whose cosine with a template is at least
    ``threshold`` is a header of that licence; the best line counts, ties go to the
    smaller name. A file whose whole text is that near to a template is a licence file
    of its directory; of several the best counts. A file without a header takes the
    licence of the nearest directory, its own or above, that has one.

    Returns the input columns without ``text``, and path, license, via ("header" or
    "directory"), license_dir, license_score (9 digits); null where there is none.
    Input columns of these names are replaced. Null text is empty. A null path is a
    file in no directory. Repeated rows are files of their own; an empty table gives an
    empty table.

    Texts are read twice and not shuffled: once for the frequencies of the templates'
    terms, once to keep the texts that hold a term without which no cosine reaches the
    threshold. Directories are resolved once each, whatever the number of their files,
    and the join of a large directory is split at run time. Only tables of the
    templates' terms are broadcast.
    """
    spark = files.sparkSession
    terms = _terms(spark, templates).collect()
    vocabulary = sorted({r["term"] for r in terms})
    known = F.array(*[F.lit(t) for t in vocabulary])
    counted = files.select(F.explode(F.array_intersect(words(text_or_empty()), known)).alias("term"))
    seen = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.count("*").alias("n")).collect()}
    n_files = files.count()
    idf = {t: math.log((1 + n_files) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    unknown = math.log(1 + n_files) + 1
    weights: dict[str, dict[str, float]] = {}
    for r in terms:
        weights.setdefault(r["template"], {})[r["term"]] = r["tf"] * idf[r["term"]]
    norms = {k: math.sqrt(sum(w * w for w in v.values())) for k, v in weights.items()}
    anchors = F.array(*[F.lit(t) for t in _anchors(weights, threshold)])
    others = [c for c in files.columns if c != "text"]
    rows = with_row(
        files,
        F.monotonically_increasing_id().alias("file"),
        path.alias("path"),
        F.when(F.arrays_overlap(words(text_or_empty()), anchors), F.col("text")).alias("candidate"),
    ).withColumn("__row", F.struct(*[F.col(f"__row.`{c}`").alias(c) for c in others]))
    rows = settled(
        rows.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)), "license-files"
    )
    lines = F.transform(
        F.split("candidate", "\n", -1), lambda x, i: F.struct(i.alias("pos"), words(x).alias("words"))
    )
    whole = F.array(F.struct(F.lit(-1).alias("pos"), words(F.col("candidate")).alias("words")))
    units = (
        rows.filter(F.col("candidate").isNotNull())
        .select("file", F.explode(F.concat(whole, lines)).alias("unit"))
        .select("file", "unit.pos", "unit.words")
        .filter(F.arrays_overlap("words", anchors))
    )
    tf = units.select("file", "pos", F.explode("words").alias("term")).groupBy("file", "pos", "term").agg(
        F.count("*").alias("tf")
    )
    tf = settled(tf, "license-terms")
    idfs = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    square = F.when(F.col("idf").isNull(), F.col("tf") * unknown * unknown).otherwise(
        F.col("tf") * F.col("tf") * F.col("idf") * F.col("idf")
    )
    lengths = tf.join(F.broadcast(idfs), "term", "left").groupBy("file", "pos").agg(F.sqrt(F.sum(square)).alias("norm"))
    weighted = spark.createDataFrame(
        [(k, t, w * idf[t] / norms[k]) for k, v in sorted(weights.items()) for t, w in sorted(v.items())],
        "template string, term string, w double",
    )
    dots = tf.join(F.broadcast(weighted), "term").groupBy("file", "pos", "template").agg(
        F.sum(F.col("tf") * F.col("w")).alias("dot")
    )
    scores = dots.join(lengths, ["file", "pos"]).select(
        "file", "pos", "template", F.round(F.col("dot") / F.col("norm"), 9).alias("score")
    )
    # The best score, then the smaller name.
    best = F.min(F.struct((-F.col("score")).alias("minus"), "template")).alias("best")
    scores = scores.filter(F.col("score") >= threshold)
    own = scores.filter("pos >= 0").groupBy("file").agg(best).select(
        "file", F.col("best.template").alias("own"), (-F.col("best.minus")).alias("own_score")
    )
    whole_file = scores.filter("pos = -1").select("file", "template", "score")
    given = (
        whole_file.join(rows.select("file", "dir", "path"), "file")
        .filter(F.col("path").isNotNull())
        .groupBy("dir")
        .agg(best)
        .select(F.col("dir").alias("above"), "best")
    )
    parts = F.split("dir", "/")
    ancestors = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")),
    )
    nearest = (
        rows.filter(F.col("path").isNotNull())
        .select("dir")
        .distinct()
        .select("dir", F.explode(ancestors).alias("a"))
        .select("dir", "a.depth", "a.above")
        .join(given, "above")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "above", "best")).alias("near"))
    )
    joined = rows.drop("candidate").join(own, "file", "left")
    placed = joined.join(
        nearest, (joined["dir"] == nearest["dir"]) & joined["path"].isNotNull(), "left"
    ).drop(nearest["dir"])
    header, inherited = F.col("own").isNotNull(), F.col("near").isNotNull()
    result = (
        placed.withColumn("license", F.coalesce("own", "near.best.template"))
        .withColumn("via", F.when(header, "header").when(inherited, "directory"))
        .withColumn("license_dir", F.when(~header & inherited, F.col("near.above")))
        .withColumn("license_score", F.coalesce(F.col("own_score"), -F.col("near.best.minus")))
    )
    return unpacked(result, others, "path", "license", "via", "license_dir", "license_score")


def scan_sql(files: str, path: str, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan as DuckDB SQL over a table with doc_id and text; doc_ids have to be unique."""
    rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted(templates.items()))
    split = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    return f"""
    WITH templates(template, body) AS (VALUES {rows}),
    files AS (
        SELECT doc_id, {path} AS path, coalesce(text, '') AS body FROM {files}
    ), located AS (
        SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM files
    ), tt AS (
        SELECT template, term, count(*) AS tf
        FROM (SELECT template, unnest({split.format('body')}) AS term FROM templates) GROUP BY ALL
    ), n AS (SELECT count(*) AS n FROM files),
    df AS (
        SELECT term, count(*) AS df
        FROM (SELECT unnest(list_distinct({split.format('body')})) AS term FROM files)
        WHERE term IN (SELECT term FROM tt) GROUP BY term
    ), idf AS (
        SELECT DISTINCT tt.term, ln((1 + n.n) / (1 + coalesce(df.df, 0))) + 1 AS idf
        FROM tt CROSS JOIN n LEFT JOIN df ON df.term = tt.term
    ), tnorm AS (
        SELECT template, sqrt(sum((tf * idf) ** 2)) AS norm FROM tt JOIN idf USING (term) GROUP BY template
    ), units AS (
        SELECT doc_id, -1 AS pos, body FROM files
        UNION ALL
        SELECT doc_id, generate_subscripts(string_split(body, chr(10)), 1) - 1,
               unnest(string_split(body, chr(10))) FROM files
    ), tf AS (
        SELECT doc_id, pos, term, count(*) AS tf
        FROM (SELECT doc_id, pos, unnest({split.format('body')}) AS term FROM units) GROUP BY ALL
    ), lengths AS (
        SELECT doc_id, pos, sqrt(sum(CASE WHEN idf IS NULL THEN tf * (ln(1 + n.n) + 1) ** 2
                                          ELSE (tf * idf) ** 2 END)) AS norm
        FROM tf LEFT JOIN idf USING (term) CROSS JOIN n GROUP BY doc_id, pos
    ), scores AS (
        SELECT tf.doc_id, tf.pos, tt.template,
               round(sum(tf.tf * idf.idf * tt.tf * idf.idf) / any_value(l.norm) / any_value(t.norm), 9) AS score
        FROM tf JOIN tt USING (term) JOIN idf USING (term)
        JOIN lengths l ON l.doc_id = tf.doc_id AND l.pos = tf.pos
        JOIN tnorm t ON t.template = tt.template
        GROUP BY tf.doc_id, tf.pos, tt.template
    ), own AS (
        SELECT doc_id, arg_min(template, (-score, template)) AS own, max(score) AS own_score
        FROM scores WHERE score >= {threshold} AND pos >= 0 GROUP BY doc_id
    ), given AS (
        SELECT dir AS above, arg_min(template, (-score, template)) AS template, max(score) AS score
        FROM scores JOIN located USING (doc_id)
        WHERE score >= {threshold} AND pos = -1 AND path IS NOT NULL GROUP BY dir
    ), nearest AS (
        SELECT dir, arg_max(above, depth) AS above, arg_max(template, depth) AS template,
               arg_max(score, depth) AS score
        FROM (
            SELECT dir, unnest(range(0, len(string_split(dir, '/')) + 1)) AS depth,
                   array_to_string(list_slice(string_split(dir, '/'), 1, depth), '/') AS above
            FROM (SELECT DISTINCT dir FROM located WHERE path IS NOT NULL)
        ) JOIN given USING (above) GROUP BY dir
    )
    SELECT f.doc_id, f.path, coalesce(own, n.template) AS license,
           CASE WHEN own IS NOT NULL THEN 'header' WHEN n.template IS NOT NULL THEN 'directory' END AS via,
           CASE WHEN own IS NULL THEN n.above END AS license_dir,
           coalesce(own_score, n.score) AS license_score
    FROM located f LEFT JOIN own ON own.doc_id = f.doc_id
    LEFT JOIN nearest n ON n.dir = f.dir AND f.path IS NOT NULL
    """
