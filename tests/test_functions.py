"""Column builders, each on a small table of cases."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cairnframe.functions import dates, geometry, ids, projection, text
from cairnframe.operators import allocation, best, profile, refs
from cairnframe.sources.schemas import MEASUREMENT, REF


def one(spark, column, kind="string", *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"v{k} {kind}" for k in range(len(values)))) if values else spark.range(1)
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize(("value", "want"), [("1 234,5", 1234.5), ("1 000", 1000.0), ("1_000", 1000.0), ("1.5d", None), ("", None), (None, None), ("-1e3", -1000.0), ("inf", float("inf")), ("bad", None), ("1,2,3", None), ("_1", None)])
def test_parse_decimal(spark, value, want):
    assert one(spark, text.parse_decimal(F.col("v0")), "string", value) == want


@pytest.mark.parametrize("value", [49.5, 0.1, 123456.789012345, 0.0, -0.00012, 100.0, 49.27391671, 1180.723023, 578327.52, 3.0])
def test_number_text(spark, value):
    assert one(spark, text.number_text(F.col("v0")), "double", value) == f"{value:.12g}"


@pytest.mark.parametrize(("value", "want"), [("Łódź – Jaskinia  Wyżnia 2", "odz jaskinia wyznia 2"), ("É́x", "ex"), (None, ""), (" - ", ""), ("Straße", "stra e")])
def test_normalize_name(spark, value, want):
    assert one(spark, text.normalize_name(F.col("v0")), "string", value) == want


@pytest.mark.parametrize(("value", "want"), [("2022-05-25 00:00:00", "2022-05-25"), ("5.5.2022", "2022-05-05"), ("05-06-2021", "2021-06-05"), ("2021-1-2", "2021-01-02"), ("x", None), ("31.02.2020", None), (None, None)])
def test_parse_date(spark, value, want):
    found = one(spark, dates.parse_date(F.col("v0")), "string", value)
    assert (found and str(found)) == want


def test_observed(spark):
    at = lambda a, d: one(spark, dates.observed_micros(F.col("v0"), F.col("v1")), "string", a, d)
    assert at("2024-05-01T12:00:00+02:00", None) == at("2024-05-01T10:00:00Z", "1999-01-01") == at("2024-05-01T10:00:00", None)
    assert at("nonsense", "2024-05-01") == at(None, "bad") == dates.EARLIEST < at(None, "1900-01-01")
    assert one(spark, dates.source_year_end(F.col("v0")), "string", " 2010 ") == "2010-12-31" and one(spark, dates.source_year_end(F.col("v0")), "string", "201") is None


def test_projection(spark):
    x, y = projection.to_plane(F.col("v0"), F.col("v1"))
    assert abs(one(spark, x, "double", 49.27391671, 20.07713884) - 156826.50) < 0.01 and abs(one(spark, y, "double", 49.27391671, 20.07713884) - 578327.52) < 0.01
    points = spark.createDataFrame([(49.0 + k / 7, 14.2 + k * 0.9) for k in range(12)], "lat double, lon double")
    x, y = projection.to_plane(F.col("lat"), F.col("lon"))
    placed = points.select("*", x.alias("x"), y.alias("y"))
    lat, lon = projection.to_degrees(F.col("x"), F.col("y"))
    worst = placed.select(F.max(F.abs(lat - F.col("lat"))), F.max(F.abs(lon - F.col("lon")))).first()
    assert max(worst) < 1e-9
    assert one(spark, projection.is_consistent(F.col("v0"), F.col("v1"), F.lit(578327.52), F.lit(156826.5)), "double", 49.27391671, 20.07713884) is False


def crosses(ring, x, y):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[-1:] + ring[:-1], strict=True):
        if abs((x - ax) * (by - ay) - (y - ay) * (bx - ax)) <= 1e-9 and min(ax, bx) - 1e-9 <= x <= max(ax, bx) + 1e-9 and min(ay, by) - 1e-9 <= y <= max(ay, by) + 1e-9:
            return True
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def test_rings(spark):
    r = random.Random(3)
    rings = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(2.0, 2.0), (6.0, 2.0), (6.0, 6.0), (2.0, 6.0)]]
    points = [(r.uniform(-2, 12), r.uniform(-2, 12)) for _ in range(200)] + [(0.0, 5.0), (10.0, 10.0), (2.0, 3.0), (6.0, 6.0), (4.0, 4.0), (1.0, 1.0)]
    df = spark.createDataFrame([(x, y, rings) for x, y in points], "x double, y double, rings array<array<struct<x:double,y:double>>>")
    got = [row.r for row in df.select(geometry.rings_contain(F.col("rings"), F.col("x"), F.col("y")).alias("r")).collect()]
    assert got == [sum(crosses(ring, x, y) for ring in rings) % 2 == 1 for x, y in points]
    assert one(spark, geometry.wkt_point(F.col("v0"), F.col("v1")), "double", 1.5, None) is None


def measured(mid, source="TPN", status="nieweryfikowany", day="2020-01-01", at=None, accuracy=None):
    return {"id": mid, "source": source, "verification_status": status, "observed_date": day, "observed_at": at, "horizontal_accuracy_m": accuracy}


@pytest.mark.parametrize(
    ("items", "want"),
    [
        ([measured("a", "PIG"), measured("b", "wlasne"), measured("c", "TPN"), measured("d", "wlasne", "zweryfikowany")], "d"),
        ([measured("a", "PIG"), measured("b", "wlasne"), measured("c", "TPN")], "c"),
        ([measured("a", "inne"), measured("b", "PIG")], "b"),
        ([measured("a", day="2020-01-01"), measured("b", day="2021-01-01")], "b"),
        ([measured("a", accuracy=None), measured("b", accuracy=0.0), measured("c", accuracy=1.0)], "b"),
        ([measured("b"), measured("a")], "a"),
        ([measured("a", status="odrzucony", day="2024-01-01"), measured("b", "inne")], "b"),
        ([measured(None), measured("z")], "z"),
        ([measured("a", at="bad", day="2024-01-01"), measured("b", day="2001-01-01")], "b"),
        ([], None),
    ],
)
def test_best_measurement(spark, items, want):
    df = spark.createDataFrame([(items,)], f"m array<{MEASUREMENT}>")
    assert df.select(best.best_measurement_id(F.col("m")).alias("r")).first().r == want
    rejected = df.select(best.only_rejected(F.col("m")).alias("r")).first().r
    assert rejected is bool(items and all(i["verification_status"] == "odrzucony" for i in items))


def test_references(spark):
    ref = lambda s, t, e, u=None: {"system": s, "ref_type": t, "external_id": e, "url": u}
    a, b = [ref("PIG", "url", "u1"), ref("NR_INWENT", "inventory_number", " N1 ")], [ref("PIG", "url", " u1 ", ""), ref("TPN", "source_globalid", "{A}"), ref("TPN", "source_globalid", "{A}")]
    df = spark.createDataFrame([(a, b, None)], f"a array<{REF}>, b array<{REF}>, m array<{MEASUREMENT}>")
    row = df.select(refs.append_unique(F.col("a"), F.col("b")).alias("u"), refs.first_reference_id(F.col("a"), "NR_INWENT").alias("nr"), refs.pig_urls(F.col("a")).alias("p")).first()
    assert [(x.system, x.external_id) for x in row.u] == [("PIG", "u1"), ("NR_INWENT", " N1 "), ("TPN", "{A}")] and row.nr == "N1" and row.p == ["u1"]


def test_ids(spark):
    assert one(spark, ids.numbered_id(F.lit("KSW"), F.lit(12345))) == "KSW-12345" and one(spark, ids.numbered_id(F.lit("C"), F.lit(7))) == "C-0007"
    assert one(spark, ids.next_measurement_id(F.array(F.lit("m-001"), F.lit("m-009"), F.lit("x")))) == "m-010"
    fits = lambda kind, path, rid: one(spark, ids.path_matches(F.lit(kind), F.lit(path), F.lit(rid)))
    assert fits("object", "/d/objects/KSW/KSW-0001.yaml", "KSW-0001") and not fits("object", "/d/objects/XX/KSW-0001.yml", "KSW-0001")
    assert fits("cave", "caves/C-0001.yml", "C-0001") and not fits("relation", "caves/R-0001.yml", "R-0001")
    paths = spark.createDataFrame([("objects/KSW/KSW-0009.yml",), ("objects/KSW/KSW-0011.yaml",), ("objects/KSW/KSW-99.txt",), ("caves/C-0003.yml",)], "path string")
    assert {r.prefix: r.seed for r in allocation.max_existing_number(paths, "path", "prefix").collect()} == {"KSW": 11, "C": 3}


def test_running_number_over_all_rows(spark):
    rows = spark.range(0, 5000, 3).withColumnRenamed("id", "k")
    got = [(r.k, r.number) for r in allocation.running_number(rows, "k", base=10).orderBy("k").collect()]
    assert got == [(k, 10 + i) for i, k in enumerate(range(0, 5000, 3), 1)]


def test_profiles(spark):
    table = spark.createDataFrame([(1, "a", "1,5"), (2, "a", "bad"), (3, " ", ""), (4, "b", "2")], "record_number long, key string, num string")
    assert {r.column_name: r.missing for r in profile.missing_counts(table, ["key", "num", "none"]).collect()} == {"key": 1, "num": 1, "none": 4}
    assert [(r.value, r.n, r.first_rows) for r in profile.duplicate_groups(table, "key", "record_number").collect()] == [("a", 2, [1, 2])]
    assert tuple(profile.numeric_profile(table, ["num"]).first()) == ("num", 2, 1, 1, 1.5, 2.0)
    assert tuple(profile.duplicate_summary(table, ["key"]).first()) == ("key", 1, 2, 1)


def test_projection_gives_the_digits_of_the_sql(spark):
    """Northings differ in the last bit at most for a few in a thousand points, so texts and roundings agree; as columns and inside of lambdas."""
    x, y = projection.plane_sql("lat", "lon")
    con = duckdb.connect()
    points = con.execute(f"SELECT lat, lon, {x} AS x, {y} AS y FROM (SELECT (49180000 + (i * 7919) % 112000)::DOUBLE / 1000000::DOUBLE AS lat, (19750000 + (i * 104729) % 352000)::DOUBLE / 1000000::DOUBLE AS lon FROM range(20000) r(i) UNION ALL SELECT 49.1816, 19.77635)").fetchall()
    rows = spark.createDataFrame(points, "lat double, lon double, x double, y double")
    found = projection.with_plane(rows, "lat", "lon", "a", "b").withColumn("p", F.get(F.transform(F.array("lat"), lambda v: projection.plane(v, F.col("lon"))), F.lit(0)))
    got = found.agg(F.count_if(F.expr("x <> a")).alias("north"), F.count_if(F.expr("y <> b")).alias("east"), F.count_if(F.expr("p.n <> a or p.e <> b")).alias("lambdas"), F.count_if(F.round("x", 3) != F.round("a", 3)).alias("rounded"), F.max(F.abs(F.expr("x - a"))).alias("most")).first()
    assert got.north < 200 and got.east < 200 and got.lambdas == 0 and got.rounded == 0 and got.most < 1e-8
    far = projection.with_plane(spark.sql("select * from values (0D, 19D), (-33D, 19D), (89.9D, 25D), (cast(null as double), 19D) t(lat, lon)"), "lat", "lon", "n", "e").orderBy("lat").collect()
    assert far[0].n is None and [round(r.n + 5300000) for r in far[1:]] == [-3650191, 0, 9983864]


def test_filters_place_no_point_again(spark):
    """A filter on the coordinates stays above the steps, so none of them is written out in it."""
    placed = projection.with_plane(spark.range(9).select((F.col("id") + 49.0).alias("lat"), F.lit(19.5).alias("lon")), "lat", "lon", "a", "b")
    steps = lambda df: df._jdf.queryExecution().optimizedPlan().toString().upper().count("COSH(")
    assert steps(placed.where("a is not null and b > 0 and a < 1e9")) == steps(placed) > 0
