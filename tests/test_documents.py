"""JSON documents of unknown shape."""

import json

import pytest
from pyspark.sql import types as T

from staveline.sources import documents
from tests.helpers import column


def frame(spark, *bodies):
    rows = [(i, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return documents.parse_documents(spark.createDataFrame(rows, "id int, body string"), "body", "obj")


def flat(spark, *bodies):
    out = documents.flatten_documents(frame(spark, *bodies))
    return [{k: v for k, v in r.asDict(True).items() if v is not None} for r in out.orderBy("id").collect()], out


def test_fields_no_schema_names_come_through(spark):
    found, out = flat(
        spark, {"a": {"x y": 1, "deep": {"z": "t"}}, "list": [1, 2]}, {"a": {"new`one": True}, "n": 1.5}, {"n": 2}, None
    )
    assert found == [
        {"id": 0, "a.x y": 1, "a.deep.z": "t", "list": [1, 2]}, {"id": 1, "a.new`one": True, "n": 1.5},
        {"id": 2, "n": 2.0}, {"id": 3},
    ]
    assert out.columns == ["id", "a.deep.z", "a.new`one", "a.x y", "list", "n"]


def test_kinds_that_differ(spark):
    found, out = flat(spark, {"m": 1, "v": None, "e": {}, "l": [1, "t"]}, {"m": {"k": [1]}, "big": 12345678901234567890123})
    assert out.columns == ["id", "big", "l", "m", "v"]
    assert found[0] == {"id": 0, "l": ["1", "t"], "m": "1"}
    assert found[1]["m"] == '{"k":[1]}' and int(found[1]["big"]) == 12345678901234567890123
    assert isinstance(out.schema["v"].dataType, T.StringType)


def test_names_that_look_like_types(spark):
    found, _ = flat(spark, {"OBJECT<a": {"OBJECT": 1, "ARRAY<x: INT>": 2}})
    assert found == [{"id": 0, "OBJECT<a.OBJECT": 1, "OBJECT<a.ARRAY<x: INT>": 2}]


def test_lists_of_documents(spark):
    found, _ = flat(spark, [{"a": 1}, {"b": {"c": 2}}], [], [{"a": 3}])
    assert found == [{"id": 0, "a": 1}, {"id": 0, "b.c": 2}, {"id": 2, "a": 3}]


def test_no_documents_and_no_objects(spark):
    assert flat(spark)[0] == []
    assert flat(spark, None, {})[0] == [{"id": 0}, {"id": 1}]
    with pytest.raises(ValueError, match="no objects"):
        flat(spark, {"a": 1}, [1])
    with pytest.raises(ValueError, match="map type"):
        documents.gathered_type(frame(spark, {f"k{i}": i for i in range(20)}), max_fields=10)
    with pytest.raises(Exception, match="(?i)malformed"):
        flat(spark, "{broken")[1].collect()


def test_the_type_does_not_depend_on_the_partitions(spark):
    bodies = [{f"f{i % 7}": {"n": i if i % 2 else i / 4}} for i in range(200)]
    kinds = {documents.gathered_type(frame(spark, *bodies).repartition(n)).json() for n in (1, 5, 30)}
    assert len(kinds) == 1


def test_landed_files(spark, tmp_path):
    lines = [{"track_id": 1, "obj": {"a": 1}}, {"track_id": 2, "obj": {}}, {"track_id": 3, "obj": None}, {"track_id": 4},
             {"track_id": 5, "obj": {"b": {"c": "t"}}}, {"track_id": 6, "obj": []}]
    (tmp_path / "x.json").write_text("".join(json.dumps(x) + "\n" for x in lines))
    found = documents.payloads(documents.read_documents(spark, str(tmp_path)), tags="track_id bigint")
    assert sorted(column(documents.flatten_documents(found), "track_id", "a", "b.c"), key=str) == [
        (1, 1, None), (5, None, "t")
    ]
