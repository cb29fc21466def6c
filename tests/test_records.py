"""JSON documents cut into records, whatever the splits."""

import json
import random

import pyarrow as pa
import pytest

from panelspark.queries import QUERIES
from panelspark.sinks import files as sinks
from panelspark.sources import records as R
from panelspark.sources.files import scan_wrapped_records

DDL = "id int, name string, more struct<a: int, b: array<struct<c: string>>>"


@pytest.fixture()
def small_splits(spark):
    """Files are split into parts of some bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")

    def use(size):
        for name, value in zip(names, (size, 0, 1)):
            spark.conf.set(name, value)

    yield use
    for name in names:
        spark.conf.unset(name)


def nasty(rng, i):
    text = rng.choice(["plain", "br{ace}s } ] [ {", 'quo"te', "back\\slash\\", "\\\"}", "é漢}字", "", '},{"id": 7}', '"Data": [{'])
    more = rng.choice([None, {"a": i, "b": []}, {"a": 1, "b": [{"c": "}"}, {"c": '["{'}]}, {"b": [{"c": "x" * 300}]}])
    return {"id": i, "name": text, "more": more}


def dumped(value, rng):
    return json.dumps(value, indent=rng.choice([None, None, 1, 4]), ensure_ascii=rng.random() < 0.5)


def read(spark, path, ddl=DDL):
    return sorted((r.source_file, r.id, r.name, json.dumps(r.more.asDict(True) if r.more else None)) for r in R.scan_records(spark, path, ddl).collect())


def expected(files):
    full = lambda m: None if m is None else {"a": m.get("a"), "b": [{"c": x.get("c")} for x in m["b"]] if "b" in m else None}
    return sorted((f, r["id"], r["name"], json.dumps(full(r["more"]))) for f, rows in files.items() for r in rows)


@pytest.mark.parametrize("size", [400, 3000, 1 << 27])
def test_records_do_not_depend_on_splits(spark, tmp_path, small_splits, size):
    rng, files = random.Random(size), {}
    for n in range(6):
        rows = [nasty(rng, i) for i in range(rng.choice([0, 1, 25]))]
        other = [nasty(rng, -1) for _ in range(3)]
        whole = rng.choice([
            rows,
            {"Data": rows},
            {"Header": other, "Data": rows, "Rest": other, "deep": {"Data": other, "x": {"id": -2}}},
        ])
        (tmp_path / f"f{n}.json").write_text(dumped(whole, rng) + rng.choice(["", "\n", "  \n"]))
        files[f"f{n}.json"] = rows
    small_splits(size)
    assert read(spark, f"{tmp_path}/*.json") == expected(files)
    assert R.malformed_files(spark, f"{tmp_path}/*.json").isEmpty()


def test_malformed_files_give_no_records(spark, tmp_path, small_splits):
    texts = {
        "cut": '[{"id": 1, "name": "a"}, {"id": 2',
        "open": '[{"id": 1}',
        "string": '[{"id": 1, "name": "a}]',
        "half": '{"Data": [{"id": 1}]',
        "number": "17",
        "lines": '{"id": 1}\n{"id": 2}',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"id": 5, "name": "b", "more": null}]')
    (tmp_path / "blank.json").write_text("")
    (tmp_path / "none.json").write_text('{"other": [{"id": 1}]}')
    for size in (20, 1 << 27):
        small_splits(size)
        assert read(spark, f"{tmp_path}/*.json") == [("good.json", 5, "b", "null")]
        bad = {r.path.rsplit("/", 1)[1] for r in R.malformed_files(spark, f"{tmp_path}/*.json").collect()}
        assert bad - {"lines.json"} == {f"{n}.json" for n in texts} - {"lines.json"}


def test_states_that_are_too_many_to_send(spark, tmp_path, small_splits, monkeypatch):
    rng = random.Random(3)
    rows = [nasty(rng, i) for i in range(40)]
    (tmp_path / "a.json").write_text(json.dumps({"Data": rows}))
    small_splits(1000)
    monkeypatch.setattr(R, "STATES_AT_ONCE", 3)
    assert read(spark, f"{tmp_path}/a.json") == expected({"a.json": rows})


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    rows = spark.range(60_000).selectExpr("cast(id as int) as id", "concat('}{', repeat(md5(cast(id as string)), 8)) as name")
    sinks.write_json_arrays(rows.coalesce(1), str(tmp_path / "one"), wrapped=True)
    small_splits(2 << 20)
    texts = R._pieces(spark, str(tmp_path / "one"))
    assert texts.select("path").distinct().count() == 1 and texts.rdd.getNumPartitions() > 5
    found = R.scan_records(spark, str(tmp_path / "one"), "id int, name string")
    assert found.count() == 60_000
    assert found.selectExpr("sum(id)", "count(distinct name)", "min(length(name))").first()[:] == (60_000 * 59_999 // 2, 60_000, 258)


def test_arrays_round_trip(spark, tmp_path, rows):
    df = spark.range(10).repartition(3).selectExpr("cast(id as int) as id", "'x' as name")
    for wrapped in (False, True):
        path = str(tmp_path / f"out{wrapped}")
        sinks.write_json_arrays(df, path, wrapped)
        assert rows(scan_wrapped_records(spark, path, "id int, name string")) == [(i, "x") for i in range(10)]
    sinks.write_json_arrays(df.limit(0), path)
    assert scan_wrapped_records(spark, path, "id int, name string").isEmpty()


def plain_walk(text, in_string):
    """State, depth and names after the text, a character at a time."""
    depth, names, begun_at, name, i = 0, {}, None, "", 0
    while i < len(text):
        c = text[i]
        if in_string:
            i += c == "\\"
            if c == '"':
                own = "" if begun_at is None else text[begun_at + 1 : i]
                in_string, name = False, "" if "}" in own else own
        elif c == '"':
            in_string, begun_at, name = True, i, ""
        elif c in "[{":
            names[depth] = name if c == "[" and text[:i].rstrip().endswith(":") else ""
            depth, name = depth + 1, ""
        elif c in "]}":
            depth, name = depth - 1, ""
        elif c not in " :" or (c == ":" and text[:i].rstrip().endswith(":")):
            name = ""
        i += 1
    return in_string, depth, names


def test_walks_equal_a_plain_parser():
    rng = random.Random(5)
    tokens = ['"', "\\", "\\\\", "{", "}", "[", "]", ":", '"Data": [', '{"a":1}', ",", " ", "é", '\\"']
    for _ in range(3000):
        pieces = "".join(rng.choice(tokens) for _ in range(rng.randrange(1, 60))).split("}")
        for in_string in (False, True):
            walk, cut = R.Walk(in_string), rng.randrange(len(pieces) + 1)
            for some in (pieces[:cut], pieces[cut:]):
                if some:
                    walk.over(R.Marks(pa.array(some)))
            assert (walk.in_string, walk.depth, walk.names) == plain_walk("}".join(pieces) + "}", in_string), (pieces, in_string)


def test_documents_are_read_once_for_states_and_once_for_records(spark, tmp_path, rows, monkeypatch):
    dates = spark.range(50).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "date'2020-03-01' as o_orderdate", "id * 1.5d as o_totalprice")
    dates.write.parquet(str(tmp_path / "orders.parquet"))
    reads, pieces = [], R._pieces
    monkeypatch.setattr(R, "_pieces", lambda *a: reads.append(a) or pieces(*a))
    found = QUERIES["scan_json_documents"](spark, str(tmp_path))
    assert [(r.county_code, r.year, r.arithmetic_mean, r.malformed) for r in found.orderBy("arithmetic_mean").collect()] == [
        (str(i % 7 + 1), 2020, i * 1.5, 2) for i in range(50)
    ]
    assert len(reads) == 2
