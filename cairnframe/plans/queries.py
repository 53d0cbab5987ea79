"""The registered queries: each operator of the catalogue engine applied to the driver's tables, with DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, geometry, ids, projection, text
from ..operators import allocation, best, matching, profile, refs, resolver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Best measurement ------------------------------------------------------------------------------

EVENT_PRIORITY = "CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 5 END"
BEST_SQL = f"SELECT user_id, event_id AS best_event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {EVENT_PRIORITY}, ts DESC, value, event_id) = 1"


def event_order() -> list[Column]:
    return [F.expr(EVENT_PRIORITY), -F.unix_micros(F.col("ts").cast("timestamp")), F.col("value"), F.col("event_id")]


@register(BEST_SQL)
def best_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best.best_per_key(table(spark, sf_dir, "events"), ["user_id"], event_order(), "event_id", "best_event_id")


# Projection and geometry -----------------------------------------------------------------------

LAT, LON = "(49.18 + (c_acctbal + 1000) / 11000 * 0.11)", "(19.75 + (c_custkey % 1000) / 1000.0 * 0.35)"


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr(LAT).cast("double").alias("lat"), (F.lit(19.75) + (F.col("c_custkey") % 1000) / F.lit(1000.0) * F.lit(0.35)).alias("lon"))


POINTS_CTE = f"WITH p AS (SELECT c_custkey, CAST({LAT} AS DOUBLE) AS lat, CAST(19.75 AS DOUBLE) + (c_custkey % 1000) / CAST(1000.0 AS DOUBLE) * CAST(0.35 AS DOUBLE) AS lon FROM customer)"
_X, _Y = projection.plane_sql("lat", "lon")
_LAT, _LON = projection.degrees_sql("x", "y")


@register(f"{POINTS_CTE} SELECT c_custkey, round({_X}, 3) AS x_1992, round({_Y}, 3) AS y_1992 FROM p")
def project_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.with_plane(customer_points(spark, sf_dir), "lat", "lon", "x", "y").select("c_custkey", F.round("x", 3).alias("x_1992"), F.round("y", 3).alias("y_1992"))


@register(f"""
{POINTS_CTE}, q AS (SELECT c_custkey, lat, lon, {_X} AS x, {_Y} AS y FROM p), r AS (SELECT *, {_LAT} AS lat2, {_LON} AS lon2 FROM q)
SELECT c_custkey, round(abs(lat2 - lat), 8) AS lat_error, round(abs(lon2 - lon), 8) AS lon_error, c_custkey % 10 = 0 AS mismatch FROM r
""")
def roundtrip_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverse after forward, and the consistency rule on coordinates of which every tenth is shifted by 25 m."""
    x, y = projection.to_plane(F.col("lat"), F.col("lon"))
    q = customer_points(spark, sf_dir).select("*", x.alias("x"), y.alias("y"))
    lat2, lon2 = projection.to_degrees(F.col("x"), F.col("y"))
    shifted = F.col("x") + F.when(F.col("c_custkey") % 10 == 0, 25.0).otherwise(0.0)
    wrong = ~projection.is_consistent(F.col("lat"), F.col("lon"), shifted, F.col("y"))
    return q.select("c_custkey", F.round(F.abs(lat2 - F.col("lat")), 8).alias("lat_error"), F.round(F.abs(lon2 - F.col("lon")), 8).alias("lon_error"), wrong.alias("mismatch"))


# Three regions over (c_acctbal, c_custkey): a square with a hole, a triangle that overlaps it, and a wide fallback.
REGIONS = [
    (0, 0, "ring", "RN", [[(0.0, 100.0), (4000.0, 100.0), (4000.0, 900.0), (0.0, 900.0)], [(1000.0, 300.0), (2000.0, 300.0), (2000.0, 600.0), (1000.0, 600.0)]]),
    (0, 1, "triangle", "TR", [[(1500.0, 50.0), (9000.0, 400.0), (2500.0, 1200.0)]]),
    (1, 0, "land", "LD", [[(-500.0, 0.0), (8000.0, 0.0), (8000.0, 1400.0), (-500.0, 1400.0)]]),
]
_EDGES = ", ".join(
    f"({t}, {o}, '{name}', '{prefix}', {r}, {x1!r}, {y1!r}, {x2!r}, {y2!r})"
    for t, o, name, prefix, rings in REGIONS
    for r, ring in enumerate(rings)
    for (x1, y1), (x2, y2) in zip(ring, ring[-1:] + ring[:-1], strict=True)
)


def region_polygons(spark: SparkSession) -> DataFrame:
    rows = []
    for t, o, name, prefix, rings in REGIONS:
        xs, ys = [x for r in rings for x, _ in r], [y for r in rings for _, y in r]
        rows.append((t, o, name, prefix, min(xs), min(ys), max(xs), max(ys), rings))
    return spark.createDataFrame(rows, resolver.POLYGON_SCHEMA)


@register(f"""
WITH e(tier, ordinal, name, prefix, ring, ax, ay, bx, by_) AS (VALUES {_EDGES}),
p AS (SELECT c_custkey, c_acctbal AS x, CAST(c_custkey AS DOUBLE) AS y FROM customer),
t AS (
  SELECT c_custkey, tier, ordinal, name, prefix, ring,
    bool_or(abs((x - ax) * (by_ - ay) - (y - ay) * (bx - ax)) <= 1e-9 AND x >= least(ax, bx) - 1e-9 AND x <= greatest(ax, bx) + 1e-9 AND y >= least(ay, by_) - 1e-9 AND y <= greatest(ay, by_) + 1e-9) AS on_edge,
    sum(CASE WHEN (ay > y) <> (by_ > y) AND x < (bx - ax) * (y - ay) / nullif(by_ - ay, 0) + ax THEN 1 ELSE 0 END) AS crossings
  FROM p, e GROUP BY ALL
), inside AS (
  SELECT c_custkey, tier, ordinal, name, prefix FROM t GROUP BY ALL HAVING sum(CASE WHEN on_edge OR crossings % 2 = 1 THEN 1 ELSE 0 END) % 2 = 1
), first AS (SELECT * FROM inside QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY tier, ordinal) = 1)
SELECT c_custkey, coalesce(name, 'outside') AS region, prefix, CASE WHEN tier = 0 THEN 'ok' WHEN tier IS NOT NULL THEN 'warning' ELSE 'error' END AS status
FROM customer LEFT JOIN first USING (c_custkey)
""")
def point_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("x"), F.col("c_custkey").cast("double").alias("y"))
    found = resolver.first_polygon(points, region_polygons(spark), "c_custkey", "x", "y")
    status = F.when(F.col("tier") == 0, "ok").when(F.col("tier").isNotNull(), "warning").otherwise("error")
    return points.join(found, "c_custkey", "left").select("c_custkey", F.coalesce("name", F.lit("outside")).alias("region"), "prefix", status.alias("status"))


# A polygon for each order: a star of six points about a place that its key and customer give, a third of them with a hole, of four sizes.
_PARCELS = """
SELECT o_orderkey, CAST((o_custkey * 7919 + o_orderkey * 31) % 20000 AS DOUBLE) AS px, CAST((o_orderkey * 104729) % 1600 AS DOUBLE) AS py, CASE o_orderkey % 4 WHEN 0 THEN 3.0 WHEN 1 THEN 11.0 WHEN 2 THEN 45.0 ELSE 170.0 END AS r, o_orderkey % 3 = 0 AS hole FROM orders
"""
_STAR = [(1.0, 0.0), (0.25, 0.25), (0.0, 1.0), (-1.0, 0.25), (-0.5, -0.5), (0.25, -1.0)]
_HOLE = [(0.125, 0.0), (0.0, 0.125), (-0.125, 0.0), (0.0, -0.125)]
_SIDES = ", ".join(f"({r}, {a[0]!r}, {a[1]!r}, {b[0]!r}, {b[1]!r})" for r, ring in enumerate((_STAR, _HOLE)) for a, b in zip(ring, ring[-1:] + ring[:-1], strict=True))


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", *(f"{e} AS {n}" for e, n in (
        ("CAST((o_custkey * 7919 + o_orderkey * 31) % 20000 AS DOUBLE)", "px"), ("CAST((o_orderkey * 104729) % 1600 AS DOUBLE)", "py"),
        ("CAST(CASE o_orderkey % 4 WHEN 0 THEN 3.0 WHEN 1 THEN 11.0 WHEN 2 THEN 45.0 ELSE 170.0 END AS DOUBLE)", "r"), ("o_orderkey % 3 = 0", "hole"),
    )))
    ring = lambda shape: F.array(*(F.struct((F.col("px") + F.col("r") * x).alias("x"), (F.col("py") + F.col("r") * y).alias("y")) for x, y in shape))
    rings = F.when(F.col("hole"), F.array(ring(_STAR), ring(_HOLE))).otherwise(F.array(ring(_STAR)))
    px, py, r = F.col("px"), F.col("py"), F.col("r")
    return rows.select((F.col("o_orderkey") % 2).cast("int").alias("tier"), F.col("o_orderkey").cast("int").alias("ordinal"), F.concat(F.lit("parcel "), F.col("o_orderkey").cast("string")).alias("name"), F.lit("P").alias("prefix"), (px - r).alias("xmin"), (py - r).alias("ymin"), (px + r).alias("xmax"), (py + r).alias("ymax"), rings.alias("rings"))


@register(f"""
WITH q AS ({_PARCELS}), s(ring, ax, ay, bx, by_) AS (VALUES {_SIDES}),
p AS (SELECT c_custkey, c_acctbal * 2 AS x, CAST(c_custkey % 1600 AS DOUBLE) AS y FROM customer),
near AS (SELECT c_custkey, x, y, o_orderkey, px, py, r, hole FROM p JOIN q ON x BETWEEN px - r AND px + r AND y BETWEEN py - r AND py + r),
e AS (SELECT c_custkey, o_orderkey, ring, x, y, px + r * ax AS ax, py + r * ay AS ay, px + r * bx AS bx, py + r * by_ AS by_ FROM near, s WHERE ring = 0 OR hole),
t AS (
  SELECT c_custkey, o_orderkey, ring,
    bool_or(abs((x - ax) * (by_ - ay) - (y - ay) * (bx - ax)) <= 1e-9 AND x >= least(ax, bx) - 1e-9 AND x <= greatest(ax, bx) + 1e-9 AND y >= least(ay, by_) - 1e-9 AND y <= greatest(ay, by_) + 1e-9) AS on_edge,
    sum(CASE WHEN (ay > y) <> (by_ > y) AND x < (bx - ax) * (y - ay) / nullif(by_ - ay, 0) + ax THEN 1 ELSE 0 END) AS crossings
  FROM e GROUP BY ALL
), inside AS (SELECT c_custkey, o_orderkey FROM t GROUP BY ALL HAVING sum(CASE WHEN on_edge OR crossings % 2 = 1 THEN 1 ELSE 0 END) % 2 = 1)
SELECT c_custkey, 'parcel ' || arg_min(o_orderkey, (o_orderkey % 2) * 1000000000000 + o_orderkey) AS parcel FROM inside GROUP BY 1
""")
def point_parcel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers placed among as many polygons as there are orders: by cells, without a nested loop."""
    points = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") * 2).alias("x"), (F.col("c_custkey") % 1600).cast("double").alias("y"))
    return resolver.first_polygon(points, parcels(spark, sf_dir), "c_custkey", "x", "y").select("c_custkey", F.col("name").alias("parcel"))


@register("SELECT s_suppkey, 'POINT(' || CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS VARCHAR) || ' ' || CAST(s_suppkey AS VARCHAR) || ')' AS wkt FROM supplier")
def wkt_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", geometry.wkt_point(F.col("s_acctbal").cast("decimal(12,2)"), F.col("s_suppkey")).alias("wkt"))


# Profiles --------------------------------------------------------------------------------------


@register("""
SELECT p_name AS value, count(*) AS n, array_to_string(list_slice(list(p_partkey ORDER BY p_partkey), 1, 20), ',') AS first_rows
FROM part WHERE trim(p_name) <> '' GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, value LIMIT 10
""")
def duplicate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = profile.duplicate_examples(table(spark, sf_dir, "part").select("p_name", "p_partkey"), "p_name", "p_partkey")
    return top.select("value", "n", F.array_join(F.col("first_rows").cast("array<string>"), ",").alias("first_rows"))


BLANKED = {"o_orderpriority": "CASE WHEN o_orderkey % 7 = 0 THEN '  ' ELSE o_orderpriority END", "o_orderstatus": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END", "o_clerk": None}


@register("""
SELECT 'o_orderpriority' AS column_name, count(*) FILTER (o_orderkey % 7 = 0) AS missing FROM orders
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (o_orderkey % 11 = 0) FROM orders
UNION ALL SELECT 'o_clerk', count(*) FROM orders
""")
def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(*(f"{e} AS {c}" for c, e in BLANKED.items() if e))
    return profile.missing_counts(rows, list(BLANKED))


@register("""
WITH t AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'bad' WHEN o_orderkey % 11 = 0 THEN ' ' ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR), '.', ',') END AS v FROM orders),
n AS (SELECT v, try_cast(replace(v, ',', '.') AS DOUBLE) AS d FROM t)
SELECT 'price' AS column_name, count(d) AS numeric, count(*) FILTER (trim(v) = '') AS missing, count(*) FILTER (trim(v) <> '' AND d IS NULL) AS non_numeric, min(d) AS min_value, max(d) AS max_value FROM n
""")
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "CASE WHEN o_orderkey % 7 = 0 THEN 'bad' WHEN o_orderkey % 11 = 0 THEN ' ' ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS STRING), '.', ',') END AS price"
    return profile.numeric_profile(table(spark, sf_dir, "orders").selectExpr(price), ["price"])


# Integrity, counts and flags -------------------------------------------------------------------


# Matching and identifiers ----------------------------------------------------------------------

_PART = "p_partkey, p_brand || '/' || p_type || '/' || CAST(p_size AS VARCHAR) AS nr, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name_norm, p_retailprice AS x, CAST(p_size AS DOUBLE) AS y"
_DISTANCE = "sqrt((s.x - c.x) ** 2 + (s.y - c.y) ** 2)"


#: The cascade in SQL, given s (source rows) and c (candidates) with k, g, nr, name_norm, x and y.
_CASCADE = f"""
counts AS (SELECT nr, count(*) AS source_nr FROM s GROUP BY 1),
one AS (SELECT s.k, count(*) AS n, min(c.k) AS ck, min({_DISTANCE}) AS d FROM s JOIN c ON s.g = c.k GROUP BY 1),
r1 AS (SELECT k, CASE n WHEN 1 THEN 'matched' ELSE 'unresolved' END AS status, CASE n WHEN 1 THEN 'globalid' END AS strategy, CASE n WHEN 1 THEN ck END AS ck, CASE n WHEN 1 THEN d END AS d, CASE WHEN n > 1 THEN 'GLOBALID_AMBIGUOUS' END AS issue FROM one),
two AS (
  SELECT s.k, any_value(source_nr) AS sn, count(*) AS n, min(c.k) AS ck, min({_DISTANCE}) AS d,
    count(*) FILTER ({_DISTANCE} <= 25) AS nc, min(c.k) FILTER ({_DISTANCE} <= 25) AS cc, arg_min({_DISTANCE}, c.k) FILTER ({_DISTANCE} <= 25) AS dc,
    count(*) FILTER ({_DISTANCE} <= 25 AND s.name_norm = c.name_norm) AS nn, min(c.k) FILTER ({_DISTANCE} <= 25 AND s.name_norm = c.name_norm) AS cn, arg_min({_DISTANCE}, c.k) FILTER ({_DISTANCE} <= 25 AND s.name_norm = c.name_norm) AS dn
  FROM s JOIN c USING (nr) JOIN counts USING (nr) WHERE s.k NOT IN (SELECT k FROM r1) GROUP BY 1
),
st AS (SELECT *, CASE WHEN sn > 1 AND nn = 1 THEN 'nr_inwent_name_distance' WHEN sn > 1 THEN NULL WHEN n = 1 THEN 'nr_inwent' WHEN nn = 1 THEN 'nr_inwent_name_distance' WHEN nc = 1 THEN 'nr_inwent_distance' END AS strategy FROM two),
r2 AS (SELECT k, CASE WHEN strategy IS NULL THEN 'unresolved' ELSE 'matched' END AS status, strategy,
  CASE strategy WHEN 'nr_inwent' THEN ck WHEN 'nr_inwent_name_distance' THEN cn WHEN 'nr_inwent_distance' THEN cc END AS ck,
  CASE strategy WHEN 'nr_inwent' THEN d WHEN 'nr_inwent_name_distance' THEN dn WHEN 'nr_inwent_distance' THEN dc END AS d,
  CASE WHEN strategy IS NULL THEN 'NR_INWENT_AMBIGUOUS' END AS issue FROM st),
three AS (SELECT s.k, count(*) AS n, min(c.k) AS ck, arg_min({_DISTANCE}, c.k) AS d FROM s JOIN c USING (name_norm) WHERE name_norm <> '' AND {_DISTANCE} <= 25 AND s.k NOT IN (SELECT k FROM r1) AND s.k NOT IN (SELECT k FROM r2) GROUP BY 1),
r3 AS (SELECT k, CASE n WHEN 1 THEN 'matched' ELSE 'unresolved' END AS status, CASE n WHEN 1 THEN 'name_distance' END AS strategy, CASE n WHEN 1 THEN ck END AS ck, CASE n WHEN 1 THEN d END AS d, CASE WHEN n > 1 THEN 'NAME_DISTANCE_AMBIGUOUS' END AS issue FROM three),
r AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3)
SELECT s.k AS record_number, coalesce(status, 'new') AS status, strategy, ck AS candidate_id, round(d, 3) AS distance_m, issue FROM s LEFT JOIN r ON s.k = r.k
"""


@register(f"""
WITH s AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN p_partkey + 1 END AS g, * FROM (SELECT {_PART} FROM part) WHERE p_partkey % 2 = 0),
c AS (SELECT p_partkey AS k, * FROM (SELECT {_PART} FROM part) WHERE p_partkey % 2 = 1),
{_CASCADE}""")
def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("/", "p_brand", "p_type", F.col("p_size").cast("string")).alias("nr"), text.normalize_name(F.col("p_name")).alias("name_norm"), F.col("p_retailprice").alias("x"), F.col("p_size").cast("double").alias("y"))
    source = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("record_number"), F.when(F.col("p_partkey") % 5 == 0, (F.col("p_partkey") + 1).cast("string")).alias("globalid"), "nr", "name_norm", "x", "y")
    candidates = part.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("candidate_id"), F.col("p_partkey").cast("string").alias("globalid"), "nr", "name_norm", "x", "y")
    return matching.match_cascade(source, candidates).withColumn("distance_m", F.round("distance_m", 3))


# A third of the orders and of the customers have one number, and most of these one place of some metres.
_SPOT = "CASE WHEN {k} % 3 = 0 THEN 'HOT' ELSE 'N' || CAST({c} AS {text}) END AS nr, 'name ' || CAST({k} % 7 AS {text}) AS name_norm, CASE WHEN {k} % 21 = 0 THEN CAST({k} % 1000 AS DOUBLE) ELSE CAST({k} % 13 AS DOUBLE) / 4 END AS x, CAST({c} % 11 AS DOUBLE) / 2 AS y"
_SPOT_S, _SPOT_C = (lambda text: _SPOT.format(k="o_orderkey", c="o_custkey", text=text)), (lambda text: _SPOT.format(k="c_custkey", c="c_custkey", text=text))


@register(f"""
WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN o_custkey END AS g, {_SPOT_S("VARCHAR")} FROM orders),
c0 AS (SELECT c_custkey AS k, {_SPOT_C("VARCHAR")} FROM customer), c AS (SELECT k, k AS g, nr, name_norm, x, y FROM c0), {_CASCADE}
""")
def match_hot_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cascade where one number and one place hold a third of all rows."""
    source = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS record_number", "CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_custkey AS STRING) END AS globalid", _SPOT_S("STRING").partition(" AS nr, ")[0] + " AS nr", *_SPOT_S("STRING").partition(" AS nr, ")[2].split(", "))
    candidates = table(spark, sf_dir, "customer").selectExpr("c_custkey AS candidate_id", "CAST(c_custkey AS STRING) AS globalid", _SPOT_C("STRING").partition(" AS nr, ")[0] + " AS nr", *_SPOT_C("STRING").partition(" AS nr, ")[2].split(", "))
    return matching.match_cascade(source, candidates).withColumn("distance_m", F.round("distance_m", 3))


@register("""
WITH seed AS (SELECT s_nationkey AS k, count(*) AS seed FROM supplier GROUP BY 1)
SELECT c_custkey, upper(left(n_name, 3)) || '-' || lpad(CAST(coalesce(seed, 0) + row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) AS VARCHAR), CAST(greatest(4, length(CAST(coalesce(seed, 0) + row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) AS VARCHAR))) AS INT), '0') AS new_id
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN seed ON k = n_nationkey
""")
def allocate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("seed"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.upper(F.substring("n_name", 1, 3)).alias("code"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("key"))
    numbered = allocation.allocate_by_prefix(rows, "key", ["c_custkey"], seeds)
    return numbered.join(nation, "key").select("c_custkey", F.concat("code", F.lit("-"), F.split_part("new_id", F.lit("-"), F.lit(2))).alias("new_id"))


@register("SELECT o_orderkey, 'C-' || lpad(CAST(n AS VARCHAR), CAST(greatest(4, length(CAST(n AS VARCHAR))) AS INT), '0') AS cave_id FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)")
def allocate_cave_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    return allocation.running_number(rows, "o_orderkey", "n").select("o_orderkey", ids.numbered_id(F.lit("C"), F.col("n")).alias("cave_id"))


@register("""
WITH f AS (SELECT user_id, event_type, min(ROW(ts, event_id)) AS first FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type, ';' ORDER BY first) AS joined FROM f GROUP BY 1
""")
def joined_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values in the order of their first occurrence: one row a user and value meets, never all events of a user."""
    first = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("first"))
    ordered = first.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("first", "event_type"))).alias("v"))
    return ordered.select("user_id", text.joined_values(F.transform("v", lambda x: x["event_type"])).alias("joined"))


_ORDER_RANK = "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 WHEN '4' THEN 3 ELSE 4 END"


# Text, dates, references -----------------------------------------------------------------------


@register("SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS name_norm FROM documents")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_name(F.col("text")).alias("name_norm"))


@register("""
SELECT p_partkey, CASE WHEN contains(t, 'steel') THEN 'sztolnia' WHEN contains(t, 'tin') OR contains(t, 'brass') THEN 'wywierzysko' WHEN contains(t, 'copper') THEN 'ponor' ELSE 'jaskinia_otwor' END AS category
FROM (SELECT p_partkey, lower(p_name || ' ' || p_type) AS t FROM part)
""")
def infer_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .categories import category_by_keywords

    rules = [("sztolnia", ["steel"]), ("wywierzysko", ["tin", "brass"]), ("ponor", ["copper"])]
    named = text.normalize_name(F.concat_ws(" ", "p_name", "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", category_by_keywords(named, rules, "jaskinia_otwor").alias("category"))


@register("""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%d.%m.%Y') ELSE strftime(o_orderdate, '%d-%m-%Y') END AS s FROM orders)
SELECT o_orderkey, CAST(coalesce(try_strptime(s, '%Y-%m-%d %H:%M:%S'), try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%d.%m.%Y'), try_strptime(s, '%d-%m-%Y')) AS DATE) AS parsed FROM t
""")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    shown = F.when(key % 13 == 0, "n/a").when(key % 4 == 0, F.date_format(day, "yyyy-MM-dd 00:00:00")).when(key % 4 == 1, F.date_format(day, "yyyy-MM-dd")).when(key % 4 == 2, F.date_format(day, "dd.MM.yyyy")).otherwise(F.date_format(day, "dd-MM-yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date(shown).alias("parsed"))


@register("SELECT l_orderkey, 'm-' || lpad(CAST(max(l_linenumber) + 1 AS VARCHAR), 3, '0') AS next_id FROM lineitem GROUP BY 1")
def next_local_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("n"))
    return rows.select("l_orderkey", ids.next_measurement_id(F.array(F.format_string("m-%03d", "n"), F.lit("x-999"))).alias("next_id"))


_URL = "CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'ftp' || substr(url, 5) WHEN 2 THEN 'https://' WHEN 3 THEN 'local/path' ELSE upper(url) END"


@register(f"SELECT page_id, contains(u, '://') AS url_like, regexp_matches(u, '^(?i:https?)://[^/?#]+') AS valid FROM (SELECT page_id, {_URL} AS u FROM pages)")
def url_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.expr(_URL).alias("u"))
    return rows.select("page_id", text.is_url_like(F.col("u")).alias("url_like"), text.is_http_url(F.col("u")).alias("valid"))


@register("""
SELECT p_partkey, array_to_string(list_concat([p_brand || '|' || p_type], CASE WHEN p_partkey % 3 = 0 THEN [] ELSE [p_type || '|' || p_brand] END, CASE WHEN p_partkey % 2 = 0 THEN ['extra|' || CAST(p_size AS VARCHAR)] ELSE [] END), ';') AS joined FROM part
""")
def append_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = lambda s, t: F.struct(s.alias("system"), t.alias("ref_type"))
    brand, kind = F.col("p_brand"), F.col("p_type")
    spaced = F.concat(F.lit(" "), brand, F.lit(" "))
    more = F.array(ref(spaced, kind), ref(F.when(F.col("p_partkey") % 3 == 0, brand).otherwise(kind), F.when(F.col("p_partkey") % 3 == 0, kind).otherwise(brand)), ref(F.when(F.col("p_partkey") % 2 == 0, F.lit("extra")).otherwise(brand), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise(kind)))
    out = refs.append_unique(F.array(ref(brand, kind)), more, ("system", "ref_type"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(out, lambda r: F.concat_ws("|", r["system"], r["ref_type"])), ";").alias("joined"))


@register("SELECT conv_id, turn, CASE WHEN starts_with(t, 'staging: ') THEN 'final: ' || substr(t, 10) ELSE t END AS note FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'staging: ' || text WHEN role = 'assistant' THEN 'x staging: ' || text ELSE text END AS t FROM conversations)")
def finalize_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.review import final_note

    t = F.when(F.col("role") == "user", F.concat(F.lit("staging: "), "text")).when(F.col("role") == "assistant", F.concat(F.lit("x staging: "), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", final_note(t, "staging: ", "final: ").alias("note"))


@register("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS matches FROM customer
""")
def path_matches_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    record = F.when(key % 4 == 1, ids.numbered_id(F.lit("C"), key)).otherwise(ids.numbered_id(F.lit("KSW"), key))
    kind = F.when(key % 4 == 1, "cave").otherwise("object")
    path = F.concat(F.lit("/data/"), F.when(key % 4 == 0, "objects/KSW/").when(key % 4 == 1, "caves/").when(key % 4 == 2, "objects/XXX/").otherwise("objects/"), record, F.when(key % 3 == 0, ".yaml").otherwise(".yml"))
    return table(spark, sf_dir, "customer").select("c_custkey", ids.path_matches(kind, path, record).alias("matches"))


# Ranked windows over the same keys, for callers that want rows instead of an arg-best.


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
