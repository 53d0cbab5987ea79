"""A catalogue made of the driver's tables, in Spark and in SQL, so that the real operators run on any size of them.

Customers are objects, their orders measurements, suppliers caves, some customers relations. Records
have the flaws that the rules look for, dealt by remainders of their keys; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.projection import plane_sql, with_plane
from ..operators.resolver import POLYGON_SCHEMA, Resolver, polygon_resolver
from ..sources.catalog import Catalog
from ..sources.schemas import ATTACHMENT, BEST, CAVE, MEASUREMENT, OBJECT, REF, RELATION
from .staging import struct_of

WHEN = "2024-05-01T10:00:00Z"
# Plane rectangles (tier, ordinal, name, prefix, xmin, ymin, xmax, ymax): two valleys and a country, easting first.
AREAS = [(0, 0, "west", "KSW", 555000.0, 145000.0, 565000.0, 160000.0), (0, 1, "south", "BA", 560000.0, 145000.0, 575000.0, 150000.0), (1, 0, "land", "TOM", 540000.0, 130000.0, 600000.0, 170000.0)]

# What both engines read: key columns and formulas that are exact in both.
OBJECT_ID = "CASE {k} % 3 WHEN 0 THEN 'KSW' WHEN 1 THEN 'BA' ELSE 'TOM' END || '-' || CASE WHEN {k} < 10000 THEN lpad(CAST({k} AS {text}), 4, '0') ELSE CAST({k} AS {text}) END"
CAVE_ID = "'C-' || CASE WHEN {k} < 10000 THEN lpad(CAST({k} AS {text}), 4, '0') ELSE CAST({k} AS {text}) END"
OBJECTS = """
SELECT c_custkey AS k, {own_id} AS stem, {shown_id} AS id,
  'objects/' || CASE WHEN c_custkey % 101 = 0 THEN 'XX' ELSE CASE c_custkey % 3 WHEN 0 THEN 'KSW' WHEN 1 THEN 'BA' ELSE 'TOM' END END || '/' || {own_id} || '.yml' AS path,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'jaskinia_otwor' WHEN 'MACHINERY' THEN 'sztolnia' ELSE 'schronisko' END AS category, c_name AS name_local,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'C-9999' ELSE {cave_id} END AS cave_id,
  CASE WHEN c_custkey % 103 = 0 THEN '{{"schema_version": 2}}' WHEN c_custkey % 107 = 0 THEN '{{"other": 1}}' ELSE '{{"schema_version": 1}}' END AS raw,
  CASE WHEN c_custkey % 4 = 0 THEN 'manual' ELSE 'auto' END AS best_mode, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'seen' END AS best_reason,
  CASE WHEN c_custkey % 3 = 0 THEN '{{g' || CAST(c_custkey % 399 AS {text}) || '}}' END AS tpn, CASE WHEN c_custkey % 13 = 0 THEN 'N' || CAST(c_custkey AS {text}) END AS nr, CASE WHEN c_custkey % 17 = 0 THEN 'P' || CAST(c_custkey AS {text}) END AS pig,
  CASE WHEN c_custkey % 6 = 0 THEN CASE c_custkey % 5 WHEN 0 THEN 'ftp://host/x' WHEN 1 THEN 'http://host/x' ELSE 'files/' || CAST(c_custkey % 36 AS {text}) || '.jpg' END END AS file, c_custkey % 12 = 0 AS bad_attachment
FROM customer
"""
POINTS = """
SELECT o_custkey AS k, o_orderkey AS n, 'm-' || CAST(o_orderkey AS {text}) AS mid,
  CASE WHEN o_orderkey % 227 = 0 THEN NULL ELSE CAST(49180000 + (o_custkey * 7919) % 110000 + (o_orderkey % 10) * 200 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS lat,
  CAST(19750000 + (o_custkey * 104729) % 350000 + (o_orderkey % 7) * 250 + CASE WHEN o_custkey % 211 = 0 THEN 5000000 ELSE 0 END AS DOUBLE) / CAST(1000000 AS DOUBLE) AS lon,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 20 AS DOUBLE) END AS accuracy,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'wlasne' WHEN '2-HIGH' THEN 'TPN' WHEN '3-MEDIUM' THEN 'PIG' ELSE 'inne' END AS source,
  CASE o_orderstatus WHEN 'F' THEN 'zweryfikowany' WHEN 'O' THEN 'nieweryfikowany' ELSE 'odrzucony' END AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CASE o_orderpriority WHEN '2-HIGH' THEN 'TPN:{{o' || CAST(o_orderkey AS {text}) || '}}' ELSE 'src:' || CAST(o_orderkey AS {text}) END END AS source_ref,
  CAST(CAST(o_orderdate AS DATE) AS {text}) AS day, o_orderkey % 211 = 0 AS shifted
FROM orders
"""
CAVES = """
SELECT s_suppkey AS k, {cave_id} AS id, CASE WHEN s_suppkey % 9 = 0 THEN 'caves/old/' ELSE 'caves/' END || {cave_id} || '.yml' AS path, s_name AS name,
  CASE WHEN s_suppkey % 2 = 0 THEN 'N' || CAST(s_suppkey AS {text}) END AS nr, 'P' || CAST(s_suppkey AS {text}) AS pig, 'https://host/' || CAST(s_suppkey AS {text}) AS url, {object_id} AS listed, s_suppkey % 4 = 0 AS lists_lost
FROM supplier
"""
RELATIONS = """
SELECT c_custkey AS k, 'R-' || CAST(c_custkey AS {text}) AS id, {own_id} AS from_id, CASE WHEN c_custkey % 40 = 0 THEN 'KSW-none' ELSE {own_id} END AS to_id, c_mktsegment AS kind FROM customer
"""


def _filled(template: str, text: str) -> str:
    own = OBJECT_ID.format(k="c_custkey", text=text)
    # Some objects carry the id of the one before, under their own path.
    shown = OBJECT_ID.format(k="(c_custkey - CASE WHEN c_custkey % 50 = 0 AND c_custkey > 0 THEN 1 ELSE 0 END)", text=text)
    key = "s_suppkey" if "FROM supplier" in template else "(c_custkey % 10)"
    return template.format(text=text, own_id=own, shown_id=shown, cave_id=CAVE_ID.format(k=key, text=text), object_id=OBJECT_ID.format(k="s_suppkey", text=text))


_X, _Y = plane_sql("lat", "lon")
#: The flat tables of the catalogue for DuckDB: o, m, c, r, with the best measurement declared and computed.
FLAT_SQL = f"""
WITH o0 AS ({_filled(OBJECTS, "VARCHAR")}), m0 AS ({_filled(POINTS, "VARCHAR")}), c AS ({_filled(CAVES, "VARCHAR")}), r AS ({_filled(RELATIONS, "VARCHAR")}),
m1 AS (SELECT *, {_X} AS px, {_Y} AS py FROM m0), m AS (SELECT *, round(px + CASE WHEN shifted THEN 25.0 ELSE 0.0 END, 3) AS x, round(py, 3) AS y FROM m1),
ranked AS (
  SELECT k, mid, CASE WHEN source = 'wlasne' AND status = 'zweryfikowany' THEN 0 WHEN status = 'odrzucony' THEN 5 WHEN source = 'TPN' THEN 1 WHEN source = 'wlasne' THEN 2 WHEN source = 'PIG' THEN 3 ELSE 4 END AS p, day, accuracy FROM m
), computed AS (SELECT k, mid AS computed, p FROM ranked QUALIFY row_number() OVER (PARTITION BY k ORDER BY p, day DESC, coalesce(accuracy, 'inf'::DOUBLE), mid) = 1),
latest AS (SELECT k, max(n) AS n FROM m GROUP BY 1),
o AS (
  SELECT o0.*, CASE WHEN o0.k % 19 = 0 THEN 'm-none' ELSE 'm-' || CAST(l.n AS VARCHAR) END AS best_id, computed, p AS computed_priority
  FROM o0 LEFT JOIN latest l ON l.k = o0.k LEFT JOIN computed ON computed.k = o0.k
)
"""


def _sql(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    """One of the flat tables, from its formulas."""
    head = text.partition(f"FROM {name}")[0]
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*split_columns(head.strip().removeprefix("SELECT")))


def split_columns(text: str) -> list[str]:
    """The items of a select list; commas in brackets and quotes do not part them."""
    out, part, depth, quoted = [], "", 0, False
    for ch in text:
        quoted ^= ch == "'"
        depth += 0 if quoted else (ch == "(") - (ch == ")")
        if ch == "," and not depth and not quoted:
            out.append(part.strip())
            part = ""
        else:
            part += ch
    return [*out, part.strip()]


def flat_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measurements with plane coordinates as they are and as they are stored."""
    m = _sql(spark, sf_dir, "orders", _filled(POINTS, "STRING"))
    m = with_plane(m, "lat", "lon", "px", "py")
    return m.withColumn("x", F.round(F.col("px") + F.when(F.col("shifted"), 25.0).otherwise(0.0), 3)).withColumn("y", F.round("py", 3))


def _refs(*refs: tuple[Column, str, str, Column, Column | None]) -> Column:
    """References (condition, system, type, id, url) whose condition holds."""
    made = [F.when(cond, struct_of(REF, system=F.lit(s), ref_type=F.lit(t), external_id=i, **({} if u is None else {"url": u}))) for cond, s, t, i, u in refs]
    return F.filter(F.array(*made), lambda r: r.isNotNull())


def audited(schema: str, **fields: Column) -> Column:
    at = {"created_at": F.lit(WHEN), "created_by": F.lit("sample"), "updated_at": F.lit(WHEN), "updated_by": F.lit("sample")}
    return struct_of(schema, **fields, **{k: v for k, v in at.items() if f"{k}:" in schema})


def sample_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The catalogue; an object's measurements are in the order of their keys."""
    m = flat_points(spark, sf_dir)
    c = F.col
    measurement = audited(
        MEASUREMENT, id=c("mid"), lat=c("lat"), lon=c("lon"), x_1992=c("x"), y_1992=c("y"), horizontal_accuracy_m=c("accuracy"), source=c("source"), source_ref=c("source_ref"),
        observed_date=c("day"), source_date=c("day"), method=F.lit("gnss"), tags=F.array(F.lower("source")), verification_status=c("status"),
    )
    lists = m.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", measurement.alias("m")))), lambda p: p["m"]).alias("measurements"), F.max("n").alias("latest"))
    o = _sql(spark, sf_dir, "customer", _filled(OBJECTS, "STRING")).join(lists, "k", "left")
    best_id = F.when(c("k") % 19 == 0, "m-none").otherwise(F.concat(F.lit("m-"), c("latest").cast("string")))
    attachment = audited(ATTACHMENT, id=F.lit("a-1"), kind=F.lit("photo"), measurement_id=F.when(c("bad_attachment"), "m-0x").otherwise(F.get("measurements", F.lit(0))["id"]), path=c("file"))
    record = audited(
        OBJECT, schema_version=F.lit(1), id=c("id"), category=c("category"), name_local=c("name_local"), cave_id=c("cave_id"),
        id_assignment=F.struct(F.lit("auto").alias("method"), F.lit("m-001").alias("assigned_from_measurement_id"), F.split_part(c("id"), F.lit("-"), F.lit(1)).alias("assigned_prefix"), F.lit(None).cast("string").alias("prefix_override_reason")),
        external_refs=_refs((c("tpn").isNotNull(), "TPN", "source_globalid", c("tpn"), None), (c("nr").isNotNull(), "NR_INWENT", "inventory_number", c("nr"), None), (c("pig").isNotNull(), "PIG", "catalog_id", c("pig"), None)),
        measurements=F.coalesce("measurements", F.array().cast(f"array<{MEASUREMENT}>")), best_measurement=audited(BEST, mode=c("best_mode"), measurement_id=best_id, reason=c("best_reason")),
        attachments=F.filter(F.array(F.when(c("file").isNotNull(), attachment)), lambda a: a.isNotNull()),
    )
    none = F.lit(None).cast("string")
    objects = o.select("path", "raw", none.alias("parse_error"), record.alias("r")).select("path", "raw", "parse_error", "r.*")
    lost = F.when(c("lists_lost"), "KSW-lost")
    cave = audited(
        CAVE, schema_version=F.lit(1), id=c("id"), name=c("name"),
        external_refs=_refs((c("nr").isNotNull(), "NR_INWENT", "inventory_number", c("nr"), None), (F.lit(True), "PIG", "catalog_id", c("pig"), c("url"))),
        object_ids=F.filter(F.array(c("listed"), lost), lambda x: x.isNotNull()),
    )
    first = F.lit('{"schema_version": 1}')
    caves = _sql(spark, sf_dir, "supplier", _filled(CAVES, "STRING")).select("path", first.alias("raw"), none.alias("parse_error"), cave.alias("r")).select("path", "raw", "parse_error", "r.*")
    relation = struct_of(RELATION, schema_version=F.lit(1), id=c("id"), from_object_id=c("from_id"), to_object_id=c("to_id"), relation_type=c("kind"))
    relations = _sql(spark, sf_dir, "customer", _filled(RELATIONS, "STRING"))
    relations = relations.select(F.concat(F.lit("relations/"), "id", F.lit(".yml")).alias("path"), first.alias("raw"), none.alias("parse_error"), relation.alias("r")).select("path", "raw", "parse_error", "r.*")
    return Catalog(objects, caves, relations)


def sample_resolver(spark: SparkSession) -> Resolver:
    rows = [(*a, [[(a[4], a[5]), (a[6], a[5]), (a[6], a[7]), (a[4], a[7])]]) for a in AREAS]
    return polygon_resolver(spark.createDataFrame(rows, POLYGON_SCHEMA))


def sample_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most of the files that attachments name: one for each nation."""
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.concat(F.lit("files/"), F.col("n_nationkey").cast("string"), F.lit(".jpg")).alias("file"))
