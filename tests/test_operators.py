"""Frames, nested documents, series and matching."""

import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from staveline.operators import frames, match, nested, series
from staveline.sources.landed import parse_bare, parse_landed, read_landed
from tests.helpers import column, rows


def test_frame_helpers(spark):
    frame = spark.createDataFrame([(1, None, "x"), (None, None, ""), (None, None, None)],
                                  "`a b` int, `c.d` int, e string")
    assert frames.drop_all_null(frame).count() == 2
    assert frames.drop_all_null(frame, ["a b", "c.d"]).count() == 1
    assert frames.present(frame, "e").count() == 1
    assert frames.normalise_columns(frame).columns == ["a_b", "c_d", "e"]
    assert frames.drop_columns(frame, ["e", "absent"], ["c."]).columns == ["a b"]
    assert frames.rename(frame, {"e": "f", "absent": "g"}).columns == ["a b", "c.d", "f"]
    assert frames.select_attributes(frame, ["e", "c.d"]).columns == ["e", "c.d"]
    with pytest.raises(KeyError):
        frames.select_attributes(frame, ["absent"])


def test_stacking(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert rows(frames.stack_outer(a, b)) == [("x", None, 1), (None, "y", 2)]
    assert rows(frames.stack_inner(a, b)) == [(1,), (2,)]
    assert frames.stack_inner(a, b, attributes=["k", "b"]).columns == ["k"]


def test_tagging_and_seeds(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "p string, v int")
    listed = [{"p": "a", "label": "A"}, {"p": "b", "label": "B"}]
    assert rows(frames.tag_with_reference(frame, listed, ["p"])) == [("A", "a", 1), ("B", "b", 2)]
    seeds = spark.createDataFrame([("a",), ("a",)], "p string")
    assert column(frames.seeded(frame, seeds, "p"), "v") == [1]


DOC = """{"obj": [{"id": 1, "in": {"x": "a", "deep": {"y": 2}}, "tags": ["p", "q"],
    "parts": [{"n": 1}, {"n": 2}]}, {"id": 2, "parts": []}]}"""
KIND = ("array<struct<id: long, `in`: struct<x: string, deep: struct<y: long>>, tags: array<string>, "
        "parts: array<struct<n: long>>>>")


def documents(spark, *bodies, kind=KIND):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "k int, body string")
    return parse_landed(frame, "body", kind)


def test_empty_payloads_are_dropped(spark):
    bodies = [DOC, '{"obj": []}', "{}", '{"obj": null}', "broken"]
    assert column(documents(spark, *bodies), "k") == [0]
    structs = documents(spark, '{"obj": {}}', '{"obj": {"a": 1}}', kind="struct<a: long>")
    assert column(structs, "k") == [1]
    maps = documents(spark, '{"obj": {}}', '{"obj": {"a": 1}}', kind="map<string, long>")
    assert column(maps, "k") == [1]


def test_flatten(spark):
    flat = nested.flatten(documents(spark, DOC), keep=["k"])
    assert flat.columns == ["k", "id", "in.x", "in.deep.y", "tags", "parts"]
    assert column(flat, "id", "in.deep.y", "tags") == [(1, 2, ["p", "q"]), (2, None, None)]


def test_record_path(spark):
    found = nested.record_path(
        documents(spark, DOC), ["parts"], meta=[["id"], ["in", "x"]], record_prefix="part.", keep=["k"]
    )
    assert found.columns == ["k", "id", "in.x", "part.n"]
    assert [tuple(r) for r in found.collect()] == [(0, 1, "a", 1), (0, 1, "a", 2)]


def test_map_rows_and_numbers(spark):
    docs = documents(
        spark, '{"obj": {"m": [{"v": 1}, {"v": 2}], "n": []}}', kind="map<string, array<struct<v: long>>>"
    )
    assert rows(nested.map_rows(docs, F.col("obj"), "metric", ["k"])) == [(0, "m", 1), (0, "m", 2)]
    frame = spark.createDataFrame([(1, [7, 8]), (2, [])], "k int, xs array<long>")
    numbered = nested.number_elements(frame, F.col("xs"), "n", ["k"])
    assert [tuple(r) for r in numbered.collect()] == [(1, 7, 1), (1, 8, 2)]


def test_paths_with_default(spark):
    docs = documents(spark, DOC)
    wanted = docs.select(
        nested.path_or_null(docs, "obj", "in.deep.y").alias("y"),
        nested.path_or_null(docs, "obj", "parts.n").alias("n"),
        nested.path_or_null(docs, "obj", "parts.absent").alias("none"),
    ).first()
    assert tuple(wanted) == (2, 1, None)


def test_lists_of_ids(spark):
    frame = spark.createDataFrame([([1, 2], ["a", "b"]), ([], ["c"]), (None, None)],
                                  "x array<long>, y array<string>")
    pairs = nested.double_explode(frame, "x", "y")
    assert sorted(column(pairs, "x", "y"), key=repr) == sorted(
        [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (None, "c"), (None, None)], key=repr
    )
    single = frame.select(nested.unwrap_single(F.col("y")).alias("s"))
    assert column(single, "s") == [None, "c", None]


def test_landed_files_and_bare_responses(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"id": 5, "obj": [{"v": 1}]}\n{"id": 6, "obj": []}\n{"id": 7}\n'
    )
    found = read_landed(spark, str(tmp_path), "array<struct<v: long>>", "id long")
    assert column(found, "id") == [5]
    bare = spark.createDataFrame([('[{"v": 1}, {"v": 2}]',), ("[]",)], "body string")
    flat = nested.flatten(parse_bare(bare, "body", "array<struct<v: long>>"))
    assert column(flat, "v") == [1, 2]


# --- series ---------------------------------------------------------------------

def plain_diff(points):
    frame = pd.DataFrame(points, columns=["k", "t", "i", "v"]).dropna(subset=["v"])
    frame = frame.sort_values(["k", "t", "i"])
    frame["d"] = frame.groupby("k")["v"].diff()
    return sorted(
        [(r.d if r.d == r.d else None, r.i, r.k, r.t, r.v) for r in frame.itertuples()], key=repr
    )


@pytest.mark.parametrize("seed, slices", [(1, 2), (2, 8), (3, 64), (4, 64), (5, None)])
def test_series_diff_over_cuts(spark, seed, slices):
    """One series holds most points; many share a time; some have no value."""
    pick = random.Random(seed)
    points = [
        (pick.choice("aaaaaabc"), pick.randrange(40), i,
         None if pick.random() < 0.2 else float(pick.randrange(1000)))
        for i in range(400)
    ]
    frame = spark.createDataFrame(points, "k string, t long, i long, v double").repartition(7)
    found = series.series_diff(frame, ["k"], "t", "v", ["i"], out="d", slices=slices)
    assert rows(found) == plain_diff(points)


def test_series_diff_edges(spark):
    kind = "k string, t timestamp, v double"
    assert series.series_diff(spark.createDataFrame([], kind), ["k"], "t", "v").count() == 0
    frame = spark.createDataFrame([("a", datetime(2024, 1, 1), 5.0)], kind)
    assert series.series_diff(frame, ["k"], "t", "v").first().difference is None


def test_series_diff_adds_up_to_last_minus_first(spark):
    values = [float((i * 37) % 101) for i in range(200)]
    frame = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, t int, v double")
    total = series.series_diff(frame, ["k"], "t", "v").agg(F.sum("difference")).first()[0]
    assert total == values[-1] - values[0]


def test_item_points(spark):
    frame = spark.createDataFrame(
        [([(5.0, "a"), (None, "b"), (8.0, "c"), (6.0, "d")],), ([(None, "a")],), ([],)],
        "data array<struct<value: double, t: string>>",
    )
    found = frame.select(series.item_points(F.col("data")).alias("p"))
    first = [(x.point.t, x.difference) for x in found.first().p]
    assert first == [("a", None), ("c", 3.0), ("d", -2.0)]
    assert [len(r.p) for r in found.collect()] == [3, 0, 0]


def test_days(spark):
    frame = spark.createDataFrame(
        [(1, "2024-02-28", "2024-03-01"), (2, "2024-01-02", "2024-01-01"), (3, "2024-01-01", "2024-01-01")],
        "k int, s string, e string",
    )
    assert column(series.record_days(frame, "s", "e", "d", ["k"]), "k", "d") == [
        (1, "2024-02-28"), (1, "2024-02-29"), (1, "2024-03-01"), (3, "2024-01-01")
    ]
    assert column(series.day_pairs(frame, "s", "e", ["k"]), "k", "since", "until") == [
        (1, "2024-02-27", "2024-02-28"), (1, "2024-02-28", "2024-02-29")
    ]


def test_own_window_is_inclusive(spark):
    facts = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-05"), (1, "2024-01-06"), (2, "2024-01-01")],
                                  "id int, day string")
    windows = spark.createDataFrame([(1, "2024-01-01", "2024-01-05")], "id int, start string, end string")
    found = series.in_own_window(facts, windows, "id", "day", "start", "end")
    assert sorted(column(found, "day")) == ["2024-01-01", "2024-01-05"]


def test_catalogue_match(spark):
    tracks = spark.createDataFrame([("t1", "I1"), ("t2", "I2"), ("t3", None), ("t4", "I1")],
                                   "name string, isrc string")
    perf = spark.createDataFrame([("W1", "I1"), ("W2", "I1"), ("W9", "I9"), ("W0", None)],
                                 "comp_id string, isrc string")
    assert sorted(column(match.catalogue_match(tracks, perf), "name", "comp_id", "Match"), key=repr) == sorted([
        ("t1", "W1", "MATCH"), ("t1", "W2", "MATCH"), ("t4", "W1", "MATCH"), ("t4", "W2", "MATCH"),
        ("t2", None, "NO MATCH"), ("t3", None, "NO MATCH"),
    ], key=repr)
    assert sorted(column(match.perf_for(tracks, perf), "comp_id")) == ["W1", "W2"]
