"""Blocks of release files: their order over partitions, and none at all."""

import json

from pyspark.sql import functions as F

from cairnframe.sinks import release
from cairnframe.sinks.export import COLUMNS

NUMBERS = {"lat", "lon", "x_1992", "y_1992", "elevation_m", "horizontal_accuracy_m", "vertical_accuracy_m"}


def rows(spark, n):
    key = F.format_string("A-%05d", F.col("id"))
    number = lambda c: F.when(F.lit(c == "elevation_m") & (F.col("id") % 2 == 0), None).otherwise(F.col("id") / 7)
    return spark.range(n).repartition(5).select(*((number(c) if c in NUMBERS else F.concat(key, F.lit('"<ż'))).alias(c) if c != "object_id" else key.alias(c) for c in COLUMNS))


def test_blocks_follow_the_order_of_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(release, "BLOCK_ROWS", 7)
    blocks = release.encoded(rows(spark, 300))
    assert blocks.count() > 40
    release.write_geojson(blocks, tmp_path / "a.json", "now")
    release.write_csv(blocks, tmp_path / "a.csv")
    found = json.loads((tmp_path / "a.json").read_text(encoding="utf-8"))
    ids = [f"A-{k:05d}" for k in range(300)]
    assert [f["id"] for f in found["features"]] == ids and found["features"][2]["properties"]["elevation_m"] is None
    assert (tmp_path / "a.json").read_text(encoding="utf-8") == json.dumps(found, ensure_ascii=False, indent=2, sort_keys=True) + "\n"
    assert [r["object_id"] for r in spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "a.csv")).collect()] == ids


def test_no_rows(spark, tmp_path):
    blocks = release.encoded(rows(spark, 0))
    release.write_geojson(blocks, tmp_path / "a.json", "now")
    release.write_gpx(blocks, tmp_path / "a.gpx", "now")
    release.write_shapefile_zip(blocks, tmp_path / "a.zip")
    assert json.loads((tmp_path / "a.json").read_text())["features"] == []
    assert (tmp_path / "a.gpx").read_text().endswith("</metadata>\n</gpx>")
