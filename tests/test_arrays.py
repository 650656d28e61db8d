"""Big array files: the same records as read whole, from any cut of the file."""

import json
import random

import pytest
from pyspark.sql import functions as F

from filingloom.sources.landed import read_announcements, read_rejects


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of some hundred bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "300")
    spark.conf.set(names[1], "0")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def landed(path, *texts):
    for i, text in enumerate(texts):
        (path / f"f{i}.json").write_text(text, encoding="utf-8")
    return str(path)


def read(spark, path):
    rows = read_announcements(spark, path, "big_array")
    good = [json.loads(r.record) for r in rows.orderBy("ingest_seq").collect()]
    return good, sorted(r.record for r in read_rejects(spark, path, "big_array").collect())


def test_awkward_records_from_many_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(6)
    bits = ['"', "\\", "}", "{", "[", "]", ",", "\\\"", "}\"", "é", "漢", "\n", "a", "b c", ":", "\\\\"]

    def value(depth):
        if depth > 2 or rng.random() < 0.6:
            return "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        if rng.random() < 0.5:
            return [value(depth + 1) for _ in range(rng.randrange(3))]
        return {value(9): value(depth + 1) for _ in range(rng.randrange(3))}

    files = []
    for n in (0, 1, 40, 200):
        files.append([{"HeadLine": str(i), "x": value(0), "y": {"z": value(1)}} for i in range(n)])
    path = landed(tmp_path, *(json.dumps(f, ensure_ascii=rng.random() < 0.5, indent=rng.choice((None, 1))) for f in files))
    good, rejects = read(spark, path)
    expected = [json.dumps(r, sort_keys=True) for f in files for r in f]
    assert sorted(json.dumps(r, sort_keys=True) for r in good) == sorted(expected) and rejects == []
    fragments = spark.read.option("lineSep", "}").text(path)
    assert fragments.rdd.getNumPartitions() >= 20


def test_order_is_that_of_the_file(spark, tmp_path, small_blocks):
    path = landed(tmp_path, json.dumps([{"HeadLine": str(i), "d": {"e": {}}} for i in range(300)]))
    assert [r["HeadLine"] for r in read(spark, path)[0]] == [str(i) for i in range(300)]


def test_one_record_longer_than_many_blocks(spark, tmp_path, small_blocks):
    records = [{"HeadLine": "a"}, {"NewsBody": "} {\" " * 2000, "more": [{"x": i} for i in range(300)]}, {"HeadLine": "b"}]
    assert read(spark, landed(tmp_path, json.dumps(records)))[0] == records


def test_elements_that_are_no_objects_are_rejects(spark, tmp_path):
    path = landed(tmp_path, '[1, {"a":1}, "x}", [{"b":2}], {"c":3}, null, 7]', "[]", " \n", "[ ]\n", "[5]")
    good, rejects = read(spark, path)
    assert good == [{"a": 1}, {"c": 3}]
    assert rejects == sorted(["1", '"x}"', '[{"b":2}]', "null", "7", "5"])


def test_a_broken_file_has_no_records_and_its_text_is_kept(spark, tmp_path):
    broken = [
        '[{"a":1},{"b":2}', '[{"a":1},]', '[{"a":1} {"b":2}]', '[{"a":1}],[{"b":2}]', '{"a":1}', '[{"a":"x}]', '[{"a":1}] tail', '[,{"a":1}]',
        '[{"a":1}]]', '{"a":1}]', '[{"a":"\\}"}]', "nothing", '[{"a":1}}]', '[{"a":1},,{"b":2}]', "[{'a':1}]",
    ]
    path = landed(tmp_path, *broken, '[{"good":1}]')
    rows = read_announcements(spark, path, "big_array").collect()
    assert [r.record for r in rows] == ['{"good":1}']
    found = {}
    for record, name in read_rejects(spark, path, "big_array").select("record", F.regexp_extract("file", "f([0-9]+)[.]", 1)).collect():
        found.setdefault(int(name), []).append(record)
    assert {i: sorted("".join(own)) for i, own in found.items()} == {i: sorted(text) for i, text in enumerate(broken)}
    assert all(piece in broken[i] for i, own in found.items() for piece in own)


def test_layouts_agree(spark, tmp_path):
    path = landed(tmp_path, *(json.dumps([{"HeadLine": f"{i}-{j}", "SCRIP_CD": j} for j in range(50)]) for i in range(3)))
    rows = [sorted(map(tuple, read_announcements(spark, path, layout).drop("ingest_seq").collect())) for layout in ("array", "big_array")]
    assert rows[0] == rows[1] and len(rows[0]) == 150


def test_a_list_is_parsed_once(spark, tmp_path):
    path = landed(tmp_path, '[{"AttachmentName":"a.pdf"},7,{"AttachmentName":"b.pdf"}]', '[{"AttachmentName":"c.pdf"}')
    plan = read_announcements(spark, path, "big_array")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan or "jsontostructs" in plan.lower()
    assert "parse_json" not in plan and "variant" not in plan
    good, lost = read(spark, path)
    assert [r["AttachmentName"] for r in good] == ["a.pdf", "b.pdf"]
    assert lost == ["7", '[{"AttachmentName":"c.pdf"}']
