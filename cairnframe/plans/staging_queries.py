"""Registered queries that run both stagings over the driver's tables, with SQL; a staging of one session serves all of its queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.projection import plane_sql, with_plane
from ..operators.candidates import staged_candidates
from ..operators.materialize import cut_lineage, spread
from ..sources.catalog import Catalog
from . import staging
from .catalog_queries import _PREFIX, _ZONE, Query
from .sample_catalog import FLAT_SQL, WHEN, _sql, flat_points, sample_catalog, sample_resolver

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str):  # noqa: ANN201
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def clean_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The sample with each object under the id of its path, as a catalogue must be before anything is staged."""
    catalog = sample_catalog(spark, sf_dir)
    return Catalog(catalog.objects.withColumn("id", F.regexp_extract("path", r"([^/]+)\.yml$", 1)), catalog.caves, catalog.relations)


# The first registry: parts ------------------------------------------------------------------------

PARTS = """
SELECT p_partkey + 1 AS record_number, CASE WHEN p_partkey % 31 = 0 THEN '' ELSE 'P' || CAST(p_partkey AS {text}) END AS pig_id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE ' ' END AS aliases,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE ' N' || CAST(p_partkey AS {text}) || ' ' END AS nr_inwent, p_type AS sector, CASE WHEN p_partkey % 5 = 0 THEN 'now' ELSE CAST(1990 + p_size % 30 AS {text}) END AS year,
  CASE WHEN p_partkey % 4 = 0 THEN 'https://host/' || CAST(p_partkey AS {text}) ELSE '' END AS link, CAST(p_size AS {text}) AS length_m, CASE WHEN p_size % 2 = 0 THEN '12,5' ELSE '' END AS depth_m,
  CAST(49180000 + (p_partkey * 7919) % 110000 AS DOUBLE) / CAST(1000000 AS DOUBLE) AS lat, CAST(19750000 + (p_partkey * 104729) % 350000 + CASE WHEN p_partkey % 53 = 0 THEN 5000000 ELSE 0 END AS DOUBLE) / CAST(1000000 AS DOUBLE) AS lon,
  CASE WHEN p_partkey % 37 = 0 THEN 25.0 ELSE 0.0 END AS shift, p_partkey % 41 = 0 AS lost
FROM part
"""


def pig_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source table of texts, with decimal commas, blanks, shifted and lost coordinates."""
    rows = spread(_sql(spark, sf_dir, "part", PARTS.format(text="STRING")), "record_number")
    rows = with_plane(rows, "lat", "lon", "x", "y")
    comma = lambda c, d: F.replace(F.round(c, d).cast(f"decimal(14,{d})").cast("string"), F.lit("."), F.lit(","))
    named = {"ID": "pig_id", "Nazwa": "name", "Inne nazwy": "aliases", "Nr inw.": "nr_inwent", "Sektor (nazwa)": "sector", "Stan na rok": "year", "Link": "link", "Długość [m]": "length_m", "Głębokość [m]": "depth_m"}
    table = rows.select(
        "record_number", *(F.col(c).alias(n) for n, c in named.items()), F.when(F.col("lost"), "").otherwise(comma(F.col("lat"), 6)).alias("B"), comma(F.col("lon"), 6).alias("L"),
        comma(F.col("x") + F.col("shift"), 2).alias("X 1992"), comma(F.col("y"), 2).alias("Y 1992"), F.lit("1 234,5").alias("H (wg PIG)"),
    )
    return cut_lineage(table)  # a source table is texts that lie ready


_X, _Y = plane_sql("lat", "lon")
PIG_SQL = f"""{FLAT_SQL}, p0 AS ({PARTS.format(text="VARCHAR")}), p1 AS (SELECT *, {_X} AS px, {_Y} AS py FROM p0),
p2 AS (SELECT *, round(px + shift, 2) AS x, round(py, 2) AS y, {_ZONE} AS zone, CASE WHEN {_ZONE} <> 'error' THEN {_PREFIX} END AS prefix FROM p1),
p3 AS (SELECT *, NOT lost AND sqrt((px - x) ** 2 + (py - y) ** 2) <= 0.5 AS consistent, 'C-' || printf('%04d', (SELECT max(k) FROM c) + row_number() OVER (ORDER BY record_number)) AS cave_id FROM p2),
seeds AS (SELECT split_part(stem, '-', 1) AS prefix, max(k) AS seed FROM o GROUP BY 1),
p4 AS (SELECT *, consistent AND zone <> 'error' AS accepted FROM p3),
p AS (SELECT p4.*, CASE WHEN accepted THEN p4.prefix || '-' || printf('%04d', coalesce(seed, 0) + row_number() OVER (PARTITION BY accepted, p4.prefix ORDER BY record_number)) END AS object_id FROM p4 LEFT JOIN seeds ON seeds.prefix = p4.prefix)
"""


def pig(spark: SparkSession, sf_dir: str) -> staging.Staging:
    return staging.build_pig_staging(pig_table(spark, sf_dir), clean_catalog(spark, sf_dir), sample_resolver(spark), WHEN)


@register(f"{PIG_SQL} SELECT record_number, pig_id, trim(nr_inwent) AS nr_inwent, name, cave_id, object_id, CASE WHEN object_id IS NULL THEN 'cave_only' ELSE 'object_proposed' END AS status FROM p")
def pig_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pig(spark, sf_dir).rows


@register(f"""{PIG_SQL}
SELECT record_number, 0 AS position, 'PIG_POINT_COORDINATES_INVALID' AS code, 'warning' AS severity, nullif(pig_id, '') AS source_id, trim(nr_inwent) AS nr_inwent, 'Coordinates are missing or no numbers; no object is proposed.' AS description FROM p WHERE lost
UNION ALL SELECT record_number, 1, 'PIG_SOURCE_YEAR_INVALID', 'warning', nullif(pig_id, ''), trim(nr_inwent), 'The year is missing or no year; the day of the run is used.' FROM p WHERE NOT lost AND year = 'now'
UNION ALL SELECT record_number, 2, 'PIG_COORDINATE_MISMATCH', 'warning', nullif(pig_id, ''), trim(nr_inwent), 'WGS84 and plane coordinates differ by ' || printf('%.2f', sqrt((px - x) ** 2 + (py - y) ** 2)) || ' m; no object is proposed.' FROM p WHERE NOT lost AND NOT consistent
UNION ALL SELECT record_number, 3, 'POINT_OUTSIDE_PL_SK', 'warning', nullif(pig_id, ''), trim(nr_inwent), 'point is in neither country; no object is proposed.' FROM p WHERE consistent AND zone = 'error'
UNION ALL SELECT record_number, 3, 'POINT_OUTSIDE_VALLEYS', 'warning', nullif(pig_id, ''), trim(nr_inwent), 'point is in no valley; the country''s prefix is used' FROM p WHERE accepted AND zone = 'warning'
""")
def pig_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pig(spark, sf_dir).issues.select(*staging.ISSUE)


_NOTES = """concat_ws(chr(10), CASE WHEN trim(aliases) <> '' THEN 'PIG aliases: ' || aliases END, 'PIG sector: ' || sector, 'PIG morphometry: length_m=' || length_m || CASE WHEN depth_m <> '' THEN ', depth_m=' || depth_m ELSE '' END, 'PIG source state year: ' || year)"""


@register(f"""{PIG_SQL} SELECT record_number, cave_id AS id, name, 1 AS schema_version, {_NOTES} AS notes, CASE WHEN trim(nr_inwent) <> '' THEN trim(nr_inwent) END AS nr, nullif(pig_id, '') AS pig, nullif(link, '') AS link,
  (trim(nr_inwent) <> '')::INT + (pig_id <> '')::INT + (link <> '')::INT AS n_refs, '{WHEN}' AS created_at, 'importer:pig' AS updated_by FROM p""")
def pig_caves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proposed caves; their references one by one."""
    first = lambda system, kind: F.get(F.filter("external_refs", lambda r: (r["system"] == system) & (r["ref_type"] == kind)), 0)["external_id"]
    caves = pig(spark, sf_dir).caves
    return caves.select("record_number", "id", "name", "schema_version", "notes", first("NR_INWENT", "inventory_number").alias("nr"), first("PIG", "catalog_id").alias("pig"), first("PIG", "url").alias("link"), F.size("external_refs").alias("n_refs"), "created_at", "updated_by")


@register(f"""{PIG_SQL} SELECT record_number, object_id AS id, 'jaskinia_otwor' AS category, name AS name_local, cave_id, prefix AS assigned_prefix, lat, lon, x AS x_1992, y AS y_1992, CAST(1234.5 AS DOUBLE) AS elevation_m,
  CASE WHEN year = 'now' THEN '{WHEN[:10]}' ELSE year || '-12-31' END AS observed_date, CASE WHEN pig_id <> '' THEN 'PIG:' || pig_id END AS source_ref, '{staging.PIG_MEASUREMENT}' || CASE WHEN link <> '' THEN ' Source: ' || link ELSE '' END AS measurement_notes, '{staging.PIG_PROPOSAL}' AS notes, 'm-001' AS best
FROM p WHERE accepted""")
def pig_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proposed objects with their one measurement."""
    m = F.get("measurements", F.lit(0))
    objects = pig(spark, sf_dir).objects
    return objects.select("record_number", "id", "category", "name_local", "cave_id", "id_assignment.assigned_prefix", *(m[c].alias(c) for c in ("lat", "lon", "x_1992", "y_1992", "elevation_m", "observed_date", "source_ref")), m["notes"].alias("measurement_notes"), "notes", F.col("best_measurement.measurement_id").alias("best"))


@register(f"""{PIG_SQL} SELECT object_id, cave_id, trim(nr_inwent) AS nr, name, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS name_norm, 0 AS n_globalids, 'm-002' AS next_measurement_id, x, y FROM p WHERE accepted""")
def staged_candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals of the first registry as candidates for matching the second."""
    found = pig(spark, sf_dir)
    rows = staged_candidates(found.rows, found.objects)
    return rows.select("object_id", "cave_id", "nr", "name", "name_norm", F.size("globalids").alias("n_globalids"), "next_measurement_id", "x", "y")


# The second registry: customers -------------------------------------------------------------------

ROWS = """
SELECT c_custkey + 1 AS record_number, c_custkey AS k, CASE c_custkey % 10 WHEN 0 THEN ' ' WHEN 1 THEN '{{g' || CAST(c_custkey % 399 AS {text}) || '}}' ELSE '{{t' || CAST(c_custkey AS {text}) || '}}' END AS globalid,
  CASE WHEN c_custkey % 10 = 2 THEN 'N2' WHEN c_custkey % 10 = 4 THEN 'N' || CAST(c_custkey AS {text}) ELSE '' END AS nr_inwent, CASE WHEN c_custkey % 10 < 7 THEN c_name ELSE 'Nowa ' || CAST(c_custkey AS {text}) END AS name,
  c_mktsegment AS remarks, c_custkey % 4 * 10.0 AS off, c_custkey % 23 = 0 AS lost
FROM customer
"""
TPN_SQL = f"""{FLAT_SQL}, t0 AS ({ROWS.format(text="VARCHAR")}),
firsts AS (SELECT m.k, m.x AS nx, m.y AS ny, n FROM m QUALIFY row_number() OVER (PARTITION BY m.k ORDER BY n) = 1),
lists AS (SELECT listed, min_by(id, path) AS lc FROM (SELECT listed, id, path FROM c UNION ALL SELECT 'KSW-lost', id, path FROM c WHERE lists_lost) GROUP BY 1),
cand AS (
  SELECT o.k, o.stem AS object_id, coalesce(o.cave_id, lists.lc) AS cave_id, cc.nr, trim(regexp_replace(lower(o.name_local), '[^a-z0-9]+', ' ', 'g')) AS name_norm, o.tpn AS globalid,
    CASE WHEN d.mid IS NOT NULL THEN d.x ELSE f.nx END AS cx, CASE WHEN d.mid IS NOT NULL THEN d.y ELSE f.ny END AS cy, 'm-' || printf('%03d', coalesce(l.n, 0) + 1) AS next_id
  FROM o LEFT JOIN lists ON lists.listed = o.stem LEFT JOIN c cc ON cc.id = coalesce(o.cave_id, lists.lc) LEFT JOIN m d ON d.k = o.k AND d.mid = o.best_id LEFT JOIN firsts f ON f.k = o.k LEFT JOIN (SELECT k, max(n) AS n FROM m GROUP BY 1) l ON l.k = o.k
),
t1 AS (SELECT t0.record_number, trim(globalid) AS globalid, nr_inwent, name, remarks, CASE WHEN NOT lost THEN round(nx + off, 3) END AS x, CASE WHEN NOT lost THEN ny END AS y FROM t0 LEFT JOIN firsts USING (k)),
t AS (SELECT *, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS name_norm, x IS NOT NULL AND y IS NOT NULL AS has_point FROM t1),
s AS (SELECT * FROM t WHERE globalid <> '' AND has_point), counts AS (SELECT nr_inwent AS nr, count(*) AS sn FROM t WHERE nr_inwent <> '' GROUP BY 1),
h AS (SELECT s.record_number AS rn, s.globalid AS sg, s.nr_inwent AS snr, s.name_norm AS sname, q.*, sqrt((s.x - cx) ** 2 + (s.y - cy) ** 2) AS d FROM s JOIN cand q ON q.globalid = s.globalid OR q.nr = s.nr_inwent OR q.name_norm = s.name_norm),
r1 AS (SELECT rn, count(*) AS n, min(object_id) AS oid, arg_min(d, object_id) AS dist, 'globalid' AS strategy, 'GLOBALID_AMBIGUOUS' AS issue FROM h WHERE globalid = sg GROUP BY 1),
g2 AS (SELECT rn, any_value(sn) AS sn, count(*) AS n, min(object_id) AS o1, arg_min(d, object_id) AS d1, count(*) FILTER (d <= 25) AS nc, min(object_id) FILTER (d <= 25) AS oc, arg_min(d, object_id) FILTER (d <= 25) AS dc,
  count(*) FILTER (d <= 25 AND sname = name_norm AND sname <> '') AS nn, min(object_id) FILTER (d <= 25 AND sname = name_norm) AS onn, arg_min(d, object_id) FILTER (d <= 25 AND sname = name_norm) AS dn
  FROM h JOIN counts ON counts.nr = snr WHERE h.nr = snr AND snr <> '' AND rn NOT IN (SELECT rn FROM r1) GROUP BY 1),
r2 AS (SELECT *, CASE WHEN sn > 1 AND nn = 1 THEN 'nr_inwent_name_distance' WHEN sn > 1 THEN NULL WHEN n = 1 THEN 'nr_inwent' WHEN nn = 1 THEN 'nr_inwent_name_distance' WHEN nc = 1 THEN 'nr_inwent_distance' END AS st FROM g2),
r3 AS (SELECT rn, count(*) AS n, min(object_id) AS oid, arg_min(d, object_id) AS dist FROM h WHERE sname = name_norm AND sname <> '' AND d <= 25 AND rn NOT IN (SELECT rn FROM r1) AND rn NOT IN (SELECT rn FROM r2) GROUP BY 1),
res AS (
  SELECT rn, CASE n WHEN 1 THEN 'matched' ELSE 'unresolved' END AS outcome, CASE n WHEN 1 THEN strategy END AS strategy, CASE n WHEN 1 THEN oid END AS oid, CASE n WHEN 1 THEN dist END AS d, CASE WHEN n > 1 THEN issue END AS issue FROM r1
  UNION ALL SELECT rn, CASE WHEN st IS NULL THEN 'unresolved' ELSE 'matched' END, st, CASE st WHEN 'nr_inwent' THEN o1 WHEN 'nr_inwent_name_distance' THEN onn WHEN 'nr_inwent_distance' THEN oc END, CASE st WHEN 'nr_inwent' THEN d1 WHEN 'nr_inwent_name_distance' THEN dn WHEN 'nr_inwent_distance' THEN dc END, CASE WHEN st IS NULL THEN 'NR_INWENT_AMBIGUOUS' END FROM r2
  UNION ALL SELECT rn, CASE n WHEN 1 THEN 'matched' ELSE 'unresolved' END, CASE n WHEN 1 THEN 'name_distance' END, CASE n WHEN 1 THEN oid END, CASE n WHEN 1 THEN dist END, CASE WHEN n > 1 THEN 'NAME_DISTANCE_AMBIGUOUS' END FROM r3
),
u0 AS (SELECT s.*, coalesce(outcome, 'new') AS outcome, strategy, oid, d, issue, x AS px, y AS py FROM s LEFT JOIN res ON rn = record_number),
u1 AS (SELECT *, {_ZONE} AS zone, {_PREFIX} AS prefix FROM u0), seeds AS (SELECT split_part(stem, '-', 1) AS prefix, max(k) AS seed FROM o GROUP BY 1),
fresh0 AS (SELECT u1.record_number, u1.prefix || '-' || printf('%04d', coalesce(seed, 0) + row_number() OVER (PARTITION BY u1.prefix ORDER BY record_number)) AS object_id FROM u1 LEFT JOIN seeds ON seeds.prefix = u1.prefix WHERE outcome = 'new' AND u1.prefix IS NOT NULL),
fresh AS (SELECT *, 'C-' || printf('%04d', (SELECT max(x) FROM (SELECT max(k) AS x FROM c UNION ALL SELECT max(TRY_CAST(split_part(cave_id, '-', 2) AS BIGINT)) FROM cand)) + row_number() OVER (ORDER BY record_number)) AS cave_id FROM fresh0)
"""


def tpn(spark: SparkSession, sf_dir: str) -> staging.Staging:
    rows = _sql(spark, sf_dir, "customer", ROWS.format(text="STRING"))
    m = flat_points(spark, sf_dir).groupBy("k").agg(F.min_by(F.struct("x", "y"), "n").alias("p"))
    text = lambda c: F.when(F.col("lost"), "brak").otherwise(F.replace(F.round(c, 3).cast("decimal(14,3)").cast("string"), F.lit("."), F.lit(",")))
    named = {"GLOBALID": "globalid", "NR_INWENT": "nr_inwent", "NAZWA": "name", "UWAGI": "remarks"}
    table = rows.join(m, "k", "left").select("record_number", *(F.col(c).alias(n) for n, c in named.items()), text(F.col("p.x") + F.col("off")).alias("X1992"), text(F.col("p.y")).alias("Y1992"), F.lit("900").alias("Z"), F.lit("2.3.2021").alias("CREATED_DA"))
    return staging.build_tpn_staging(cut_lineage(table), clean_catalog(spark, sf_dir), sample_resolver(spark), WHEN)


@register(f"""{TPN_SQL}
SELECT t.record_number, t.globalid, t.nr_inwent, t.name, CASE WHEN u1.record_number IS NULL THEN 'rejected' WHEN outcome = 'new' AND fresh.object_id IS NULL THEN 'rejected' ELSE outcome END AS status,
  coalesce(fresh.cave_id, q.cave_id) AS cave_id, coalesce(fresh.object_id, q.object_id) AS object_id, strategy AS match_strategy, round(d, 4) AS distance_m
FROM t LEFT JOIN u1 USING (record_number) LEFT JOIN fresh USING (record_number) LEFT JOIN cand q ON q.object_id = u1.oid AND outcome = 'matched'
""")
def tpn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tpn(spark, sf_dir).rows.withColumn("distance_m", F.round("distance_m", 4))


@register(f"""{TPN_SQL}
SELECT record_number, 0 AS position, 'TPN_POINT_COORDINATES_INVALID' AS code, nr_inwent, 'Coordinates are missing or no numbers.' AS description FROM t WHERE NOT has_point
UNION ALL SELECT record_number, 1, 'TPN_GLOBALID_MISSING', nr_inwent, 'The row has no global id.' FROM t WHERE globalid = ''
UNION ALL SELECT record_number, 2, 'TPN_' || issue, nr_inwent, 'Several candidates fit.' FROM u1 WHERE issue IS NOT NULL
UNION ALL SELECT record_number, 3, 'TPN_MATCH_DISTANCE_REVIEW', nr_inwent, 'matched by ' || strategy || ' at a distance of ' || printf('%.2f', d) || ' m' FROM u1 WHERE outcome = 'matched' AND d > 25
UNION ALL SELECT record_number, 4, 'POINT_OUTSIDE_PL_SK', nr_inwent, 'point is in neither country' FROM u1 WHERE outcome = 'new' AND zone = 'error'
UNION ALL SELECT record_number, 4, 'POINT_OUTSIDE_VALLEYS', nr_inwent, 'point is in no valley; the country''s prefix is used' FROM u1 WHERE outcome = 'new' AND zone = 'warning'
""")
def tpn_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tpn(spark, sf_dir).issues.select("record_number", "position", "code", "nr_inwent", "description")


@register(f"""{TPN_SQL}
SELECT u1.record_number, q.object_id AS target_object_id, q.cave_id AS target_cave_id, strategy, q.next_id AS measurement_id, 'TPN:' || u1.globalid AS source_ref, x AS x_1992, y AS y_1992, '2021-03-02' AS observed_date, u1.globalid AS object_ref, nullif(u1.nr_inwent, '') AS cave_ref, '{staging.TPN_UPDATE}' AS notes
FROM u1 JOIN cand q ON q.object_id = u1.oid WHERE outcome = 'matched'
""")
def tpn_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements for objects that rows were matched with."""
    updates = tpn(spark, sf_dir).updates
    m = F.col("measurement")
    return updates.select("record_number", "target_object_id", "target_cave_id", "match.strategy", m["id"].alias("measurement_id"), *(m[c].alias(c) for c in ("source_ref", "x_1992", "y_1992", "observed_date")), F.get("object_external_refs", F.lit(0))["external_id"].alias("object_ref"), F.get("cave_external_refs", F.lit(0))["external_id"].alias("cave_ref"), "notes")


@register(f"""{TPN_SQL}
SELECT f.record_number, f.object_id AS id, f.cave_id, name AS name_local, u1.globalid AS object_ref, split_part(f.object_id, '-', 1) AS assigned_prefix, 'TPN notes: ' || remarks AS cave_notes, x AS x_1992, y AS y_1992, '{staging.TPN_PROPOSAL}' AS notes
FROM fresh f JOIN u1 USING (record_number)
""")
def tpn_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New objects with their caves."""
    found = tpn(spark, sf_dir)
    caves = found.caves.select("record_number", F.col("notes").alias("cave_notes"), F.col("id").alias("cave_key"))
    m = F.get("measurements", F.lit(0))
    rows = found.objects.join(caves, "record_number").where("cave_key = cave_id")
    return rows.select("record_number", "id", "cave_id", "name_local", F.get("external_refs", F.lit(0))["external_id"].alias("object_ref"), "id_assignment.assigned_prefix", "cave_notes", m["x_1992"].alias("x_1992"), m["y_1992"].alias("y_1992"), "notes")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
