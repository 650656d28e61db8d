import json

import pytest
from pyspark.sql import types as T

from filingloom.operators.discovered import Field, discover_fields, fields_schema, flatten_discovered
from filingloom.plans.ingest import Store, run_batch
from filingloom.operators.master import company_master
from filingloom.schemas import COMPANY_MASTER
from filingloom.sources.landed import read_announcements


def told(spark, *records, **options):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, record string")
    got = flatten_discovered(df, **options).drop("record")
    return got, [r.asDict() for r in got.orderBy("i").collect()]


def test_nested_fields_become_dotted_columns(spark):
    got, rows = told(spark, '{"a":1,"b":{"c":"x","d":{"e":true}}}', '{"b":{"c":"y"},"n":null}', "{}")
    assert got.dtypes == [("i", "int"), ("a", "bigint"), ("b.c", "string"), ("b.d.e", "boolean"), ("n", "string")]
    assert rows[0] == {"i": 0, "a": 1, "b.c": "x", "b.d.e": True, "n": None}
    assert rows[1] == {"i": 1, "a": None, "b.c": "y", "b.d.e": None, "n": None}
    assert set(rows[2].values()) == {2, None}


def test_lists_and_values_of_several_kinds(spark):
    got, rows = told(
        spark, '{"l":[1,2],"m":[{"z":1}],"k":"x","o":{"p":1}}', '{"l":[3],"m":[],"k":{"q":[null]},"o":7}', '{"k":2,"e":{}}'
    )
    assert dict(got.dtypes) == {"i": "int", "l": "array<bigint>", "m": "string", "k": "string", "o": "string"}
    assert [r["l"] for r in rows] == [[1, 2], [3], None]
    assert [r["m"] for r in rows] == ['[{"z":1}]', "[]", None]
    assert [json.loads(r["k"]) for r in rows] == ["x", {"q": [None]}, 2]
    assert [r["o"] for r in rows] == ['{"p":1}', "7", None]


def test_odd_names(spark):
    names = ["a.b", "a b", "`q", "it's", 'say "x"', "it's \"x\"", "back\\slash", "é", "OBJECT<x", "$", "[0]", "A", "a", "I"]
    got, rows = told(spark, json.dumps({n: {"v": i} for i, n in enumerate(names)}))
    found = {c: v for c, v in rows[0].items() if c != "i"}
    # A name that differs from another one in case alone gets a number.
    assert found == {f"{n}.v": i for i, n in enumerate(names) if n != "a"} | {"a.v_2": names.index("a")}


def test_what_is_no_object_has_no_fields(spark):
    got, rows = told(spark, "[1]", "7", "null", None, "{bad", '"text"')
    assert got.columns == ["i"] and len(rows) == 6
    got, rows = told(spark, '{"a":1}', "[1]", "{bad", None)
    assert [r["a"] for r in rows] == [1, None, None, None]
    assert flatten_discovered(spark.createDataFrame([], "record string")).columns == ["record"]


def test_columns_that_exist_stay_and_fields_can_be_given(spark):
    df = spark.createDataFrame([("kept", '{"a":1,"I":5}')], "a string, record string")
    assert flatten_discovered(df).drop("record").first().asDict() == {"a": "kept", "I": 5}
    fields = [Field(("I",), T.LongType()), Field(("x", "y"), None)]
    given = spark.createDataFrame([('{"I":"no","x":{"y":[1]}}',)], "record string")
    assert tuple(flatten_discovered(given, fields=fields).first())[1:] == (None, "[1]")


def test_names_that_are_data_are_refused(spark):
    df = spark.createDataFrame([(json.dumps({f"id{i}": i}),) for i in range(30)], "record string")
    assert len(discover_fields(df, max_fields=30)) == 30
    with pytest.raises(ValueError, match="30 fields"):
        discover_fields(df, max_fields=29)


def test_fields_that_no_schema_names_reach_the_store(spark, tmp_path):
    record = {
        "AttachmentName": "n1.pdf", "SCRIP_CD": 1, "Tradedate": "01/09/2025 10:11:12", "NewsBody": "b",
        "QUARTER_ID": 5, "More": {"Pages": 12},
    }
    (tmp_path / "landed").mkdir()
    (tmp_path / "landed" / "a.json").write_text(json.dumps(record))
    raw = read_announcements(spark, str(tmp_path / "landed"))
    fields = [f for f in discover_fields(raw) if f.name not in raw.columns]
    assert [f.name for f in fields] == ["More.Pages", "QUARTER_ID"]
    flat = flatten_discovered(raw, fields=fields)
    kept = {f.name: f.name.replace(".", "_") for f in fields}
    extra = T.StructType([T.StructField(kept[f.name], f.dataType) for f in fields_schema(fields).fields])
    store = Store(str(tmp_path / "store"), extra)
    master = company_master(spark.createDataFrame([("1", "N", "Company", "INE1", 1.0, 1)], COMPANY_MASTER))
    run_batch(flat.withColumnsRenamed(kept), master, store, "one", as_of="2025-09-02 00:00:00")
    assert store.announcements(spark).select("More_Pages", "QUARTER_ID").first() == (12, 5)
