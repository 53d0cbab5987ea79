"""Lists of JSON documents read by byte ranges against one reader over the whole document."""

import json
import random
import re

import pytest

from cairnframe.plans import staging
from cairnframe.sources import json_lists

TYPE = "struct<n:long,name:string,tags:array<string>,deep:struct<a:array<struct<b:string>>>>"


def document(seed, n):
    r = random.Random(seed)
    text = lambda: r.choice(["", "a", "}]", "{[", '"', '\\"', "\\", "two\nlines", "],\n  \"others\": [", "ż" * r.randint(1, 40), "long " * r.randint(1, 300)])
    one = lambda k: {"n": k, "name": text(), text(): None, "tags": [text() for _ in range(r.randint(0, 3))], "deep": r.choice([None, {}, {"a": [{"b": text()}, {}]}])}
    rows = lambda: [one(k) for k in range(n)]
    return {"title": text(), "head": {"rows": [{"n": -1}], "x": {"y": [[{}]]}}, "rows": rows(), "empty": [], "gap": [1, [2, {"n": 3}], None, "x"], "others": rows(), "tail": {"others": "no"}}


def rows_of(found):
    return {n: sorted(map(str, d.collect())) for n, d in found.items()}


@pytest.mark.parametrize("seed", range(5))
def test_ranges_give_what_one_reader_gives(spark, tmp_path, seed):
    data = document(seed, 120)
    style = [{"indent": 2}, {"indent": 0}, {"indent": 1, "separators": (",", ":")}, {}, {"indent": 2, "ensure_ascii": False}][seed]
    text = json.dumps(data, **style)
    if seed == 1:
        text = re.sub(r'(?<!\\)": ', '"\n:\n', text.replace(",\n", ",").replace("},{", "}\n,\n{").replace("[\n", "["))
        assert json.loads(text).keys() == data.keys()
    (tmp_path / "d.json").write_text(text, encoding="utf-8")
    path, lists = f"file://{tmp_path / 'd.json'}", {"rows": TYPE, "others": TYPE, "empty": TYPE, "absent": TYPE}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", ["3000", "700", "9000", "500", "400"][seed])
    try:
        blocks = spark.read.text(path).rdd.getNumPartitions()
        found = rows_of(json_lists.read_lists(spark, path, lists, one_reader_bytes=0))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 2 and found == rows_of(json_lists.read_lists(spark, path, lists, one_reader_bytes=1 << 30))
    assert len(found["rows"]) == len(found["others"]) == 120 and not found["empty"] and not found["absent"]


@pytest.mark.parametrize("text", ["[1]", '{"rows": [{}', '{"rows": [\n{},\n7\n]}'])
def test_refused_documents(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text, encoding="utf-8")
    with pytest.raises(Exception, match="JSON object|never closed|must hold objects"):
        json_lists.read_lists(spark, f"file://{tmp_path / 'd.json'}", {"rows": "struct<n:long>"}, one_reader_bytes=0)["rows"].collect()


def test_a_large_staging_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"record_number": k, "name": "n" * 400, "cave_id": f"C-{k}"} for k in range(20_000)]
    (tmp_path / "s.json").write_text(json.dumps({"rows": rows, "proposed_caves": []}, indent=2), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    try:
        found = staging.read_report(spark, f"file://{tmp_path / 's.json'}")["rows"]
        sizes = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(sizes) == 20_000 and max(sizes) < 5_000
