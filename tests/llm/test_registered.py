"""Every registered corpus query on the driver tables, and the pipeline."""

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import rows_of
from staveline.llm import lines, ngram_join, packing, toxicity
from staveline.llm.queries import QUERIES, SQL
from staveline.llm.tokens import load, vocabulary_path
from tests.llm.fixtures import linked_groups, shingles

SF = "/root/testdata/sf0.001"
PYTHON = re.compile(r"MapInArrow|MapInPandas|FlatMap\w*In\w+|\w*EvalPython")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_is_its_sql(spark, db, name):
    frame = QUERIES[name](spark, SF)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(SQL[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", ["op4_licenses", "op6_line_dedup", "op7_exact_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not PYTHON.search(plan) and "CartesianProduct" not in plan


def test_ngram_query_by_all_pairs(spark, db):
    rows = db.execute("SELECT doc_id, text FROM documents").fetchall()
    sets = [shingles(t, 4) for _, t in rows]
    groups = linked_groups(sets, 85, 100)
    least = collections.defaultdict(list)
    for (d, _), g in zip(rows, groups):
        least[g].append(d)
    want = {d: (len(s), min(least[g]) if s else d) for (d, _), s, g in zip(rows, sets, groups)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op8_ngram_join"](spark, SF).collect()} == want


def test_toxicity_query_finds_held_out_documents(spark, db):
    scored = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(scored[d], t) for d, t in labels if scored[d].held_out]
    assert len(scored) == 1000 and len(held) > 50
    wrong = sum(r.predicted != t for r, t in held)
    assert wrong <= 0.12 * len(held)


def test_pipeline_against_its_parts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{tmp_path}/{i}")
        frames.append(spark.read.parquet(f"{tmp_path}/{i}"))
        assert i == 3 or frames[-1].columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in toxicity.score(docs, labels).collect()}
    assert sorted(r.doc_id for r in frames[1].collect()) == sorted(d for d, p in scored.items() if not p)
    before = {r.doc_id: r for r in frames[1].collect()}
    after = {r.doc_id: r for r in frames[2].collect()}
    holders = collections.defaultdict(set)
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for r in before.values():
        for x in (r.text or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(r.doc_id)
    assert set(before) == set(after)
    for d, r in before.items():
        kept = [x for x in (r.text or "").split("\n") if len(holders[key(x)]) < 3 or max(holders[key(x)]) == d]
        assert (after[d].text or "") == "\n".join(kept) and after[d].n_chars == len(after[d].text or "")
        assert (after[d].lang, after[d].source) == (r.lang, r.source)
    ids = list(after)
    sets = [shingles(after[d].text, 5) for d in ids]
    groups = linked_groups(sets, 80, 100)
    least = {}
    for d, g, s in zip(ids, groups, sets):
        least[g if s else ("empty", d)] = min(d, least.get(g if s else ("empty", d), d))
    assert sorted(r.doc_id for r in frames[3].collect()) == sorted(least.values())
    tokenizer = load(vocabulary_path("byte_bpe_50k.json"))
    lengths = collections.Counter()
    for r in frames[4].collect():
        lengths[r.doc_id] += r.length
    for r in frames[3].collect():
        assert lengths[r.doc_id] == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    assert corpus_pipeline.run(spark, SF).count() == frames[4].count()


STAGE_ROWS = [(1, None), (2, ""), (None, "one two three four five six"), (3, "a b c"), (3, "a b c"), (4, "x" * 30_000)]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[1:]])
def test_stages_take_awkward_and_no_rows(spark, stage):
    from tests.llm.fixtures import documents

    got = stage(spark, documents(spark, STAGE_ROWS), SF)
    assert got.count() >= 5
    assert stage(spark, documents(spark, []), SF).count() == 0


def test_first_stage_takes_awkward_and_no_rows(spark):
    from tests.llm.fixtures import documents

    docs = documents(spark, [(10**7 + (d or 0), t) for d, t in STAGE_ROWS])
    got = corpus_pipeline.toxicity(spark, docs, SF)
    assert got.columns == docs.columns and got.count() == len(STAGE_ROWS)
    assert corpus_pipeline.toxicity(spark, docs.limit(0), SF).count() == 0


def test_operators_share_no_state_with_their_input(spark):
    """The operators read what they are given; columns of any name come through."""
    docs = spark.createDataFrame([(1, "a\nb", 5)], "doc_id long, text string, `odd name.x` int")
    assert lines.dedup_lines(docs).select("`odd name.x`").first()[0] == 5
    assert ngram_join.one_of_each(docs).select("`odd name.x`").first()[0] == 5
    assert packing.pack(docs, vocabulary_path("byte_bpe_50k.json")).agg(F.sum("length")).first()[0] == 4
