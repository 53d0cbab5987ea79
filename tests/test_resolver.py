"""The polygon index against a test of each point with each polygon."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cairnframe.operators import materialize, resolver


def star(r, x, y, size, spikes):
    turn = r.random()
    return [(x + size * (0.3 + 0.7 * r.random()) * math.cos(2 * math.pi * (k + turn) / spikes), y + size * (0.3 + 0.7 * r.random()) * math.sin(2 * math.pi * (k + turn) / spikes)) for k in range(spikes)]


def made_polygons(r, n):
    rows = []
    for k in range(n):
        x, y, size = r.uniform(-500, 500), r.uniform(-500, 500), 10 ** r.uniform(-1, 2.5)
        rings = [star(r, x, y, size, r.randint(3, 12))]
        rings += [star(r, x, y, size / 4, 5)] * (k % 3 == 0) + [star(r, x + 3 * size, y, size, 4)] * (k % 7 == 0)
        xs, ys = [p[0] for q in rings for p in q], [p[1] for q in rings for p in q]
        rows.append((k % 3, r.randint(0, 40), f"n{k % 50}", None if k % 11 == 0 else "P", min(xs), min(ys), max(xs), max(ys), rings))
    square = [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]
    rows += [(0, 50, "square", "S", 0.0, 0.0, 8.0, 8.0, [square]), (0, 50, "square", "S", 0.0, 0.0, 8.0, 8.0, [square + square[:1]]), (0, 51, "cut", "C", 0.0, 0.0, 4.0, 8.0, [square])]
    rows += [(0, 0, "none", "N", None, None, None, None, None), (0, 0, "empty", "N", 0.0, 0.0, 1.0, 1.0, []), (0, 0, "two", "N", 0.0, 0.0, 9.0, 9.0, [[(0.0, 0.0), (9.0, 9.0)]]), (0, 0, "nan", "N", math.nan, 0.0, 1.0, 1.0, [square])]
    return rows


@pytest.fixture(scope="module")
def case(spark):
    r = random.Random(12)
    polygons = spark.createDataFrame(made_polygons(r, 250), resolver.POLYGON_SCHEMA)
    points = [(r.uniform(-600, 600), r.uniform(-600, 600)) for _ in range(1500)] + [(r.uniform(-2, 10), r.uniform(-2, 10)) for _ in range(300)] + [(x / 2, y / 2) for x in range(-2, 20) for y in range(-2, 20)]
    points += [(None, 1.0), (1.0, None), (math.nan, 1.0), (math.inf, 1.0), (1.0, -math.inf), (1e300, 1.0)]
    return spark.createDataFrame([(k, *p, "clash", 1) for k, p in enumerate(points)], "key long, px double, py double, name string, level int"), polygons


def test_cells_give_what_all_pairs_give(case):
    points, polygons = case
    by_cells = resolver.index_polygons(polygons, few=0)
    all_pairs = resolver.index_polygons(polygons, few=10**6)
    assert by_cells.cells is not None and all_pairs.cells is None and len(by_cells.levels) > 5
    got = sorted(map(tuple, resolver.first_polygon(points, by_cells, "key", "px", "py").collect()), key=str)
    want = sorted(map(tuple, resolver.first_polygon(points, all_pairs, "key", "px", "py").collect()), key=str)
    assert got == want and len(got) > 1000


def test_plan_of_many_polygons_has_no_nested_loop(case):
    points, polygons = case
    plan = resolver.first_polygon(points, polygons, "key", "px", "py")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_cells_hold_few_polygons(spark):
    """A hundred polygons over one place: of those that hold a cell whole the first is kept, and those before it."""
    square = F.array(F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (64, 0), (64, 64), (0, 64)))))
    polygons = spark.range(100).select(F.lit(0).alias("tier"), F.col("id").cast("int").alias("ordinal"), F.lit("n").alias("name"), F.lit("p").alias("prefix"), F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(64.0).alias("xmax"), F.lit(64.0).alias("ymax"), square.alias("rings"))
    index = resolver.index_polygons(polygons)
    assert index.cells.where("whole").groupBy("level", "i", "j").count().agg(F.max("count")).first()[0] == 1
    points = spark.range(20).select("id", F.lit(10.0).alias("x"), (F.col("id") * 4.0).alias("y"))
    assert {(x.id, x.ordinal) for x in resolver.first_polygon(points, index, "id", "x", "y").collect()} == {(k, 0) for k in range(17)}


@pytest.mark.parametrize("few_rows", [0, 500_000])
def test_rounds_give_what_all_pairs_give(case, monkeypatch, few_rows):
    monkeypatch.setattr(resolver, "ROUND_POLYGONS", 20, raising=False)
    monkeypatch.setattr(resolver, "ROUND_GROWTH", 3, raising=False)
    monkeypatch.setattr(resolver, "FEW_POLYGONS", 5)
    monkeypatch.setattr(materialize, "BROADCAST_ROWS", few_rows)
    points, polygons = case
    polygons = polygons.withColumn("tier", F.when(F.col("ordinal") != 7, F.col("tier"))).withColumn("ordinal", F.when(F.col("ordinal") != 9, F.col("ordinal")))
    points = points.unionByName(points.where("key % 9 = 0").withColumn("px", F.col("px") + 40)).withColumn("key", F.when(F.col("key") != 500, F.col("key")))
    rounds = resolver.first_polygon(points, polygons, "key", "px", "py").collect()
    all_pairs = resolver.first_polygon(points, resolver.index_polygons(polygons, few=10**6), "key", "px", "py").collect()
    assert sorted(map(tuple, rounds), key=str) == sorted(map(tuple, all_pairs), key=str) and len(rounds) > 1000


def test_polygons_behind_others_are_not_written_down(spark, monkeypatch):
    """Three thousand polygons over one place: the first hundred take all its points, so no other is checkpointed or covered."""
    monkeypatch.setattr(resolver, "ROUND_POLYGONS", 100, raising=False)
    rows, cut = [], resolver.cut_lineage
    monkeypatch.setattr(resolver, "cut_lineage", lambda d: (lambda out: rows.append(out.count()) or out)(cut(d)))
    square = F.array(F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (64, 0), (64, 64), (0, 64)))))
    polygons = spark.range(3000).select(F.lit(0).alias("tier"), F.col("id").cast("int").alias("ordinal"), F.lit("n").alias("name"), F.lit("p").alias("prefix"), F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(64.0).alias("xmax"), F.lit(64.0).alias("ymax"), square.alias("rings"))
    points = spark.range(17).select("id", F.lit(10.0).alias("x"), (F.col("id") * 4.0).alias("y"))
    assert {(x.id, x.ordinal) for x in resolver.first_polygon(points, polygons, "id", "x", "y").collect()} == {(k, 0) for k in range(17)}
    assert max(rows) < 3000


def test_empty_tables(spark, case):
    points, polygons = case
    assert resolver.first_polygon(points.where("key < 0"), polygons, "key", "px", "py").count() == 0
    assert resolver.first_polygon(points, polygons.where("tier < 0"), "key", "px", "py").count() == 0
    assert resolver.first_polygon(points, resolver.index_polygons(polygons.where("tier < 0"), few=-1), "key", "px", "py").count() == 0


def test_no_join_broadcasts_polygons_by_the_size_of_their_files(spark, case, tmp_path, monkeypatch):
    monkeypatch.setattr(resolver, "BROADCAST_POINTS", 0)
    monkeypatch.setattr(materialize, "BROADCAST_ROWS", 0)
    points, polygons = case
    polygons.write.parquet(str(tmp_path / "p"))
    found = resolver.first_polygon(points, resolver.index_polygons(spark.read.parquet(str(tmp_path / "p")), few=0), "key", "px", "py")
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
    assert found.count() > 0


def test_points_with_plane_coordinates_are_not_placed_again(spark):
    ring = [[(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]]
    polygons = spark.createDataFrame([(0, 0, "v", "P", 0.0, 0.0, 9.0, 9.0, ring)], resolver.POLYGON_SCHEMA)
    points = spark.createDataFrame([("a", 49.2, 19.9, 4.0, 5.0), ("b", 49.2, 19.9, 40.0, 5.0)], "point_id string, lat double, lon double, x_1992 double, y_1992 double")
    for resolve, status in ((resolver.polygon_resolver(polygons), ["ok", "error"]), (resolver.constant_resolver(), ["ok", "ok"])):
        got = sorted(resolve(points).select("point_id", "x_1992", "y_1992", "status").collect())
        assert [tuple(r) for r in got] == [("a", 4.0, 5.0, status[0]), ("b", 40.0, 5.0, status[1])]
