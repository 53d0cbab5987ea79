"""Files that tasks write in parts: nothing of their content passes the driver."""

import csv
import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnframe.plans import file_queries, staging
from cairnframe.sinks import joined, release, snapshot, staging_file

from .test_release import rows


@pytest.fixture
def no_stream(monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("rows stream past the driver")

    monkeypatch.setattr(DataFrame, "toLocalIterator", refuse)


def test_release_files_do_not_pass_the_driver(spark, tmp_path, monkeypatch, no_stream):
    monkeypatch.setattr(release, "BLOCK_ROWS", 7)
    monkeypatch.setattr(joined, "COPY_BYTES", 1000)
    blocks = release.encoded(rows(spark, 300))
    release.write_geojson(blocks, tmp_path / "a.json", "now")
    release.write_gpx(blocks, tmp_path / "a.gpx", "now")
    release.write_shapefile_zip(blocks, tmp_path / "a.zip", "a")
    assert [f["id"] for f in json.loads((tmp_path / "a.json").read_text())["features"]] == [f"A-{k:05d}" for k in range(300)]
    assert (tmp_path / "a.gpx").read_text().count("<wpt ") == 300
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        assert z.testzip() is None and z.namelist() == ["a.shp", "a.shx", "a.dbf", "a.prj", "a.cpg"]
        assert len(z.read("a.shp")) == 100 + 28 * 300 and len(z.read("a.dbf")) == 33 + 32 * len(release.FIELDS) + release._WIDTH * 300 + 1
        assert z.read("a.dbf")[-release._WIDTH - 1 :].startswith(b" A-00299") and z.read("a.cpg") == b"UTF-8\n"


def test_snapshot_and_its_zip_do_not_pass_the_driver(spark, tmp_path, monkeypatch, no_stream):
    monkeypatch.setattr(joined, "COPY_BYTES", 5000)
    tables = {name: spark.range(0).select(*(F.lit(None).cast("string").alias(c) for c in [*snapshot.columns_of(name), *(x for x in snapshot.ORDER.get(name, []) if x not in snapshot.columns_of(name))])) for name in snapshot.TABLES}
    tables["metadata"] = spark.range(2000).repartition(7).select(F.format_string("k%05d", "id").alias("key"), F.lit("v").alias("value"))
    snapshot.write_sqlite(tables, str(tmp_path / "c.sqlite"))
    with sqlite3.connect(tmp_path / "c.sqlite") as db:
        assert [r[0] for r in db.execute("SELECT key FROM metadata ORDER BY rowid")] == [f"k{k:05d}" for k in range(2000)]
    joined.zip_file(spark, tmp_path / "c.sqlite", tmp_path / "c.zip")
    with zipfile.ZipFile(tmp_path / "c.zip") as z:
        assert z.testzip() is None and z.read("c.sqlite") == (tmp_path / "c.sqlite").read_bytes()


def test_staging_files_do_not_pass_the_driver(spark, tmp_path, monkeypatch, no_stream):
    monkeypatch.setattr(staging_file, "BLOCK_ROWS", 9)
    found = spark.range(1, 301).repartition(5).select(F.col("id").alias("record_number"), F.concat(F.lit("ż|"), F.col("id").cast("string")).alias("name"))
    issues = spark.createDataFrame([], ", ".join(f"{c} {'long' if c in ('record_number', 'position') else 'string'}" for c in staging.ISSUE))
    paths = staging_file.write_report(staging.Staging(found, issues, found, found.where("record_number > 300")), "pig", "p.csv", "now", str(tmp_path), "a", "A")
    data = json.loads(paths[0].read_text(encoding="utf-8"))
    assert [r["record_number"] for r in data["rows"]] == list(range(1, 301)) and len(data["proposed_caves"]) == 300 and data["proposed_objects"] == data["issues"] == []
    assert paths[0].read_text(encoding="utf-8") == json.dumps(data, ensure_ascii=False, indent=2) + "\n"
    lines = paths[1].read_text(encoding="utf-8").splitlines()
    assert [x for x in lines if x.startswith("| ")][2:] == [f"| {k} | ż\\|{k} |" for k in range(1, 301)] and lines[-1] == "None."


def test_csv_of_many_tasks_is_in_order(spark, monkeypatch):
    """No task sorts the whole file: its parts come from several."""
    found = []
    monkeypatch.setattr(joined, "join_files", lambda s, path, pieces, real=joined.join_files: (found.extend(pieces), real(s, path, pieces)))
    table = spark.range(20_000).repartition(5).select(F.col("id").alias("K"), F.concat(F.lit(' "a"\n'), F.col("id").cast("string")).alias(" N "))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = file_queries.written_csv(table, "K")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) > 3
    with open(path.removeprefix("file://"), newline="") as f:
        assert list(csv.reader(f)) == [["K", " N "], *([str(k), f' "a"\n{k}'] for k in range(20_000))]
