"""Registered queries that call the catalogue's own operators: rules, snapshot, release rows, staging and review.

They run over `sample_catalog`; the SQL derives the same rows from the flat tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import validation
from ..operators.json_schema import FORMATS, schema_issues
from ..operators.materialize import cut_lineage
from ..sinks import export, snapshot
from .sample_catalog import AREAS, FLAT_SQL, WHEN, sample_catalog, sample_files, sample_resolver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


# Rules ------------------------------------------------------------------------------------------


def _in_area(area: tuple) -> str:
    return f"py BETWEEN {area[4]!r} AND {area[6]!r} AND px BETWEEN {area[5]!r} AND {area[7]!r}"


_PREFIX = "CASE " + " ".join(f"WHEN {_in_area(a)} THEN '{a[3]}'" for a in AREAS) + " END"
_ZONE = f"CASE WHEN {_in_area(AREAS[0])} OR {_in_area(AREAS[1])} THEN 'ok' WHEN {_in_area(AREAS[2])} THEN 'warning' ELSE 'error' END"
# Rows of issues: family, code, severity, path, description.
RULES = f"""
, ids AS (SELECT DISTINCT id FROM o), mo AS (SELECT m.*, o.path, o.id FROM m JOIN o ON o.k = m.k),
shared AS (SELECT id, string_agg(path, ', ' ORDER BY path) AS paths FROM o GROUP BY 1 HAVING count(*) > 1),
often AS (SELECT tpn, count(*) AS n, list_sort(list(path)) AS ps FROM o WHERE tpn IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
issues(family, code, severity, path, description) AS (
  SELECT 1, 'SCHEMA_VERSION_INVALID', 'error', path, 'schema_version is ' || coalesce(json_extract_string(raw, '$.schema_version'), 'missing') FROM o WHERE coalesce(json_extract_string(raw, '$.schema_version'), '') <> '1'
  UNION ALL SELECT 2, 'FILE_ID_MISMATCH', 'error', path, 'the path does not fit object ' || id FROM o WHERE stem <> id OR path LIKE 'objects/XX/%'
  UNION ALL SELECT 2, 'FILE_ID_MISMATCH', 'error', path, 'the path does not fit cave ' || id FROM c WHERE path LIKE 'caves/old/%'
  UNION ALL SELECT 3, 'DUPLICATE_OBJECT_ID', 'error', path, id || ' is in ' || paths FROM o JOIN shared USING (id)
  UNION ALL SELECT 4, 'CAVE_REFERENCE_MISSING', 'error', path, 'no cave ' || cave_id FROM o WHERE cave_id NOT IN (SELECT id FROM c)
  UNION ALL SELECT 4, 'BEST_MEASUREMENT_MISSING', 'error', path, 'no measurement ' || best_id FROM o WHERE best_id = 'm-none'
  UNION ALL SELECT 4, 'BEST_MEASUREMENT_MANUAL_REASON_REQUIRED', 'error', path, 'a manual choice needs a reason' FROM o WHERE best_mode = 'manual' AND best_reason IS NULL
  UNION ALL SELECT 4, 'ATTACHMENT_MEASUREMENT_MISSING', 'error', path, 'no measurement m-0x' FROM o WHERE bad_attachment
  UNION ALL SELECT 4, 'CAVE_OBJECT_REFERENCE_MISSING', 'error', path, 'no object ' || listed FROM c WHERE listed NOT IN (SELECT id FROM ids)
  UNION ALL SELECT 4, 'CAVE_OBJECT_REFERENCE_MISSING', 'error', path, 'no object KSW-lost' FROM c WHERE lists_lost
  UNION ALL SELECT 4, 'RELATION_OBJECT_REFERENCE_MISSING', 'error', 'relations/' || id || '.yml', 'no object ' || e FROM (SELECT id, unnest([from_id, to_id]) AS e FROM r) WHERE e NOT IN (SELECT id FROM ids)
  UNION ALL SELECT 9, 'DUPLICATE_TPN_GLOBALID', 'error', path, tpn || ' is in ' || array_to_string(ps[1:{validation.SHOWN_PATHS}], ', ') || CASE WHEN n > {validation.SHOWN_PATHS} THEN ' and ' || (n - {validation.SHOWN_PATHS}) || ' more' ELSE '' END FROM o JOIN often USING (tpn)
  UNION ALL SELECT 5, 'CAVE_ID_MISSING_FOR_CAVE_OPENING', 'warning', path, 'an opening without a cave' FROM o WHERE category = 'jaskinia_otwor' AND cave_id IS NULL
  UNION ALL SELECT 5, 'NR_INWENT_ON_OBJECT_REFERENCE', 'warning', path, 'inventory numbers belong to caves' FROM o WHERE nr IS NOT NULL
  UNION ALL SELECT 5, 'PIG_CATALOG_REFERENCE_ON_OBJECT', 'warning', path, 'PIG records belong to caves' FROM o WHERE pig IS NOT NULL
  UNION ALL SELECT 6, 'ATTACHMENT_URL_INVALID', 'error', path, file FROM o WHERE file LIKE 'ftp://%'
  UNION ALL SELECT 6, 'ATTACHMENT_PATH_MISSING', 'error', path, file FROM o WHERE file NOT LIKE '%://%' AND file NOT IN (SELECT 'files/' || n_nationkey || '.jpg' FROM nation)
  UNION ALL SELECT 7, 'MISSING_HORIZONTAL_ACCURACY', 'warning', path, mid FROM mo WHERE accuracy IS NULL
  UNION ALL SELECT 7, 'MISSING_SOURCE_REF', 'warning', path, mid FROM mo WHERE source_ref IS NULL
  UNION ALL SELECT 7, 'COORDINATE_MISMATCH', 'error', path, mid || printf(': %.2f m', sqrt((px - x) ** 2 + (py - y) ** 2)) FROM mo WHERE sqrt((px - x) ** 2 + (py - y) ** 2) > 0.5
  UNION ALL SELECT 7, 'MEASUREMENT_DISTANCE_OUTLIER', 'warning', a.path, a.mid || ' ' || b.mid || printf(' %.2f m', sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2)) FROM mo a JOIN mo b ON a.k = b.k AND a.n < b.n WHERE sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2) > 100
  UNION ALL SELECT 7, 'MEASUREMENT_OUTSIDE_PL_SK', 'error', path, mid FROM mo WHERE px IS NOT NULL AND {_ZONE} = 'error'
  UNION ALL SELECT 7, 'MEASUREMENT_OUTSIDE_VALLEYS', 'warning', path, mid FROM mo WHERE px IS NOT NULL AND {_ZONE} = 'warning'
  UNION ALL SELECT 7, 'OBJECT_PREFIX_MISMATCH', 'warning', o.path, o.id || ' ' || {_PREFIX} FROM o JOIN m ON m.k = o.k AND m.mid = o.best_id WHERE px IS NOT NULL AND split_part(o.id, '-', 1) <> {_PREFIX}
  UNION ALL SELECT 8, 'BEST_MEASUREMENT_AUTO_MISMATCH', 'warning', path, best_id || ' ' || computed FROM o WHERE best_mode = 'auto' AND computed <> best_id
  UNION ALL SELECT 8, 'BEST_MEASUREMENT_REJECTED_FALLBACK', 'warning', path, 'all measurements are rejected' FROM o WHERE best_mode = 'auto' AND computed_priority = 5
)
"""


def all_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate(sample_catalog(spark, sf_dir), sample_resolver(spark), None, sample_files(spark, sf_dir))


@register(f"{FLAT_SQL} {RULES} SELECT * FROM issues")
def validate_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules but those of reading and of JSON schemas, which have queries of their own."""
    return all_issues(spark, sf_dir).select(*validation.ISSUE)


@register(f"{FLAT_SQL} {RULES} SELECT concat_ws(chr(9), code, severity, path, description) AS line FROM issues")
def issue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.formatted(all_issues(spark, sf_dir))


@register(f"{FLAT_SQL} SELECT 0 AS family, 'YAML_INVALID' AS code, 'error' AS severity, path, 'the root is no mapping' AS description FROM c WHERE lists_lost")
def unreadable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where records can't be read, only that is reported."""
    catalog = sample_catalog(spark, sf_dir)
    broken = catalog.caves.withColumn("parse_error", F.when(F.array_contains("object_ids", "KSW-lost"), "the root is no mapping"))
    return validation.validate(type(catalog)(catalog.objects, broken, catalog.relations)).select(*validation.ISSUE)


SCHEMA = {
    "type": "object", "required": ["id", "relation_type"], "additionalProperties": False,
    "properties": {"id": {"type": "string", "pattern": "^R-[0-9]+$", "minLength": 4}, "relation_type": {"enum": ["BUILDING", "HOUSEHOLD", "AUTOMOBILE"]}, "from_object_id": {"$ref": "#/$defs/object"}, "to_object_id": {"$ref": "#/$defs/object"}},
    "$defs": {"object": {"type": "string", "pattern": "^[A-Z]+-[0-9]+$"}},
}


@register(f"""{FLAT_SQL}, p AS (SELECT 'relations/' || id || '.yml' AS path, * FROM r)
SELECT path, 'relation_type' AS location, 'enum' AS rule, 'relation_type: ''' || kind || ''' is not one of [''BUILDING'', ''HOUSEHOLD'', ''AUTOMOBILE'']' AS description FROM p WHERE kind NOT IN ('BUILDING', 'HOUSEHOLD', 'AUTOMOBILE')
UNION ALL SELECT path, 'to_object_id', 'pattern', 'to_object_id: ''' || to_id || ''' does not match ''^[A-Z]+-[0-9]+$''' FROM p WHERE to_id = 'KSW-none'
UNION ALL SELECT path, 'id', 'minLength', 'id: ''' || id || ''' is too short' FROM p WHERE length(id) < 4
UNION ALL SELECT path, '<root>', 'additionalProperties', '<root>: ''schema_version'' is unexpected' FROM p
""")
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    relations = sample_catalog(spark, sf_dir).relations
    written = F.to_json(F.struct("schema_version", "id", "from_object_id", "to_object_id", "relation_type"))
    return schema_issues(relations.withColumn("raw", written), SCHEMA)


@register(f"{FLAT_SQL} {RULES} SELECT (SELECT count(*) FROM issues WHERE severity = 'error') AS errors, family, path, code FROM issues WHERE severity = 'error' ORDER BY family, path, code LIMIT {validation.SHOWN_ERRORS}")
def refused_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refusal to publish tells: the number of errors and the first of them."""
    try:
        validation.require_valid(cut_lineage(all_issues(spark, sf_dir)))
        told = []
    except validation.CatalogInvalidError as e:
        told = [(e.total, r.family, r.path, r.code) for r in e.issues]
    return spark.createDataFrame(told, "errors long, family int, path string, code string")


# Schemas of the sample's three kinds of records; an object's `raw` has its version only.
OBJECT_SCHEMA = {"type": "object", "required": ["schema_version"], "properties": {"schema_version": {"type": "integer", "minimum": 1, "maximum": 1}}}
CAVE_SCHEMA = {
    "allOf": [{"$ref": "#/$defs/record"}, {"if": {"properties": {"object_ids": {"minItems": 2}}}, "then": {"properties": {"id": {"pattern": "[02468]$"}}}}],
    "$defs": {"record": {"type": "object", "properties": {"id": {"type": "string"}, "created_at": {"type": "string", "format": "date-time"}, "updated_at": {"format": "date-time"}, "object_ids": {"type": "array", "minItems": 1, "items": {"type": "string", "pattern": "^[A-Z]+-[0-9]+$"}}, "link": {"type": "string", "format": "uri"}}}},
}
SCHEMA_ROWS = """
SELECT 1 AS family, 'SCHEMA_VALIDATION' AS code, 'error' AS severity, path, 'relation_type: ''' || kind || ''' is not one of [''BUILDING'', ''HOUSEHOLD'', ''AUTOMOBILE'']' AS description FROM rp WHERE kind NOT IN ('BUILDING', 'HOUSEHOLD', 'AUTOMOBILE')
UNION ALL SELECT 1, 'SCHEMA_VALIDATION', 'error', path, 'to_object_id: ''' || to_id || ''' does not match ''^[A-Z]+-[0-9]+$''' FROM rp WHERE to_id = 'KSW-none'
UNION ALL SELECT 1, 'SCHEMA_VALIDATION', 'error', path, 'id: ''' || id || ''' is too short' FROM rp WHERE length(id) < 4
UNION ALL SELECT 1, 'SCHEMA_VALIDATION', 'error', path, '<root>: ''schema_version'' is unexpected' FROM rp
UNION ALL SELECT 1, 'SCHEMA_VALIDATION', 'error', path, CASE WHEN raw = '{"other": 1}' THEN '<root>: ''schema_version'' is required' ELSE 'schema_version: 2 is more than 1' END FROM o WHERE raw <> '{"schema_version": 1}'
UNION ALL SELECT 1, 'SCHEMA_VALIDATION', 'error', path, 'object_ids.1: ''KSW-lost'' does not match ''^[A-Z]+-[0-9]+$''' FROM c WHERE lists_lost
UNION ALL SELECT 1, 'SCHEMA_VALIDATION', 'error', path, 'link: ''not a link'' is not a URI' FROM c WHERE k % 5 = 0
UNION ALL SELECT 1, 'SCHEMA_VALIDATION', 'error', path, 'updated_at: ''2024-05-01'' is not a date and time' FROM c WHERE k % 7 = 0
"""


@register(f"{FLAT_SQL} {RULES}, rp AS (SELECT 'relations/' || id || '.yml' AS path, * FROM r) SELECT * FROM issues UNION ALL {SCHEMA_ROWS}")
def validate_with_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over records with their JSON texts, schemas of all kinds and all formats included; no Python runs in it."""
    catalog = sample_catalog(spark, sf_dir)
    relations = catalog.relations.withColumn("raw", F.to_json(F.struct("schema_version", "id", "from_object_id", "to_object_id", "relation_type")))
    number = F.regexp_extract("id", "[0-9]+", 0).cast("long")
    link = F.when(number % 5 == 0, "not a link").otherwise("https://host/x").alias("link")
    updated = F.when(number % 7 == 0, "2024-05-01").otherwise(F.col("updated_at")).alias("updated_at")
    caves = catalog.caves.withColumn("raw", F.to_json(F.struct("schema_version", "id", "name", "object_ids", "created_at", updated, link)))
    schemas = {"object": OBJECT_SCHEMA, "cave": CAVE_SCHEMA, "relation": SCHEMA}
    issues = validation.validate(type(catalog)(catalog.objects, caves, relations), sample_resolver(spark), schemas, sample_files(spark, sf_dir), FORMATS)
    return issues.select(*validation.ISSUE)


# Snapshot and release ---------------------------------------------------------------------------

_AT = f"CAST(NULL AS VARCHAR) AS notes, '{WHEN}' AS created_at, 'sample' AS created_by, '{WHEN}' AS updated_at, 'sample' AS updated_by"
_WKT = "'POINT(' || {0} || ' ' || {1} || ')'"
_NULLS = lambda *names: ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in names)
_REF = "CAST(NULL AS VARCHAR) AS scope, CAST(NULL AS VARCHAR) AS notes"
_BEST = "LEFT JOIN (SELECT k AS mk, mid, lat, lon, x, y FROM m) b ON b.mk = o.k AND b.mid = o.best_id"

SNAPSHOT_SQL = {
    "caves": f"SELECT id, 1 AS schema_version, name, CAST(NULL AS VARCHAR) AS system_name, '[\"' || listed || CASE WHEN lists_lost THEN '\", \"KSW-lost' ELSE '' END || '\"]' AS object_ids_json, {_AT} FROM c",
    "objects": f"SELECT id, 1 AS schema_version, category, name_local, cave_id, 'auto' AS id_assignment_method, 'm-001' AS assigned_from_measurement_id, split_part(id, '-', 1) AS assigned_prefix, CAST(NULL AS VARCHAR) AS prefix_override_reason, best_id AS best_measurement_id, computed AS computed_best_measurement_id, lat AS best_lat, lon AS best_lon, x AS best_x_1992, y AS best_y_1992, {_WKT.format('lon', 'lat')} AS best_geom_wgs84, {_WKT.format('y', 'x')} AS best_geom_1992, {_AT} FROM o {_BEST}",
    "object_external_refs": f"SELECT id AS object_id, 'TPN' AS system, 'source_globalid' AS ref_type, tpn AS external_id, CAST(NULL AS VARCHAR) AS url, {_REF} FROM o WHERE tpn IS NOT NULL UNION ALL SELECT id, 'NR_INWENT', 'inventory_number', nr, NULL, NULL, NULL FROM o WHERE nr IS NOT NULL UNION ALL SELECT id, 'PIG', 'catalog_id', pig, NULL, NULL, NULL FROM o WHERE pig IS NOT NULL",
    "cave_external_refs": f"SELECT id AS cave_id, 'NR_INWENT' AS system, 'inventory_number' AS ref_type, nr AS external_id, CAST(NULL AS VARCHAR) AS url, {_REF} FROM c WHERE nr IS NOT NULL UNION ALL SELECT id, 'PIG', 'catalog_id', pig, url, NULL, NULL FROM c",
    "attachments": f"SELECT id AS object_id, 'a-1' AS id, 'photo' AS kind, CASE WHEN bad_attachment THEN 'm-0x' ELSE f.mid END AS measurement_id, file AS path, {_NULLS('caption', 'date')}, '{WHEN}' AS created_at, 'sample' AS created_by FROM o LEFT JOIN (SELECT k AS mk, min_by(mid, n) AS mid FROM m GROUP BY 1) f ON f.mk = o.k WHERE file IS NOT NULL",
    "relations": "SELECT id, 1 AS schema_version, from_id AS from_object_id, to_id AS to_object_id, kind AS relation_type, CAST(NULL AS VARCHAR) AS notes FROM r",
    "best_measurements": f"SELECT id AS object_id, best_mode AS mode, best_id AS measurement_id, computed AS computed_best_measurement_id, best_reason AS reason, '{WHEN}' AS updated_at, 'sample' AS updated_by FROM o",
    "measurements": f"SELECT o.id AS object_id, m.mid AS id, lat, lon, x AS x_1992, y AS y_1992, {_WKT.format('lon', 'lat')} AS geom_wgs84, {_WKT.format('y', 'x')} AS geom_1992, accuracy AS horizontal_accuracy_m, source, source_ref, day AS observed_date, day AS source_date, 'gnss' AS method, '[\"' || lower(source) || '\"]' AS tags_json, status AS verification_status, '{WHEN}' AS created_at, 'sample' AS created_by FROM m JOIN o ON o.k = m.k",
}


def _register_snapshot(name: str, sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        catalog = sample_catalog(spark, sf_dir)
        none = spark.createDataFrame([], ", ".join(f"{c} {'int' if c == 'family' else 'string'}" for c in validation.ISSUE))
        out = snapshot.snapshot_tables(spark, catalog, none, WHEN)[name]
        return out.select(*(SHOWN.get(name) or snapshot.columns_of(name)))

    query.__name__ = f"snapshot_{name}"
    register(f"{FLAT_SQL} {sql}")(query)


#: Measurements without the columns that the sample leaves empty.
SHOWN = {"measurements": ["object_id", "id", "lat", "lon", "x_1992", "y_1992", "geom_wgs84", "geom_1992", "horizontal_accuracy_m", "source", "source_ref", "observed_date", "source_date", "method", "tags_json", "verification_status", "created_at", "created_by"]}
for _name, _text in SNAPSHOT_SQL.items():
    _register_snapshot(_name, _text)


@register(f"""{FLAT_SQL} {RULES}, n AS (SELECT (SELECT count(*) FROM o) AS o, (SELECT count(*) FROM c) AS c, (SELECT count(*) FROM r) AS r, (SELECT count(*) FROM m WHERE k IN (SELECT k FROM o)) AS m, (SELECT count(*) FROM issues WHERE severity = 'warning') AS w, (SELECT count(*) FROM issues WHERE severity = 'error') AS e)
SELECT unnest(['cave_count', 'generated_at', 'measurement_count', 'object_count', 'relation_count', 'schema_version', 'validation_error_count', 'validation_warning_count']) AS key, unnest([c::VARCHAR, '{WHEN}', m::VARCHAR, o::VARCHAR, r::VARCHAR, '{snapshot.SNAPSHOT_VERSION}', e::VARCHAR, w::VARCHAR]) AS value FROM n
""")
def snapshot_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = validation.prepared(sample_catalog(spark, sf_dir))  # the counts need the records that the rules read
    issues = validation.validate(catalog, sample_resolver(spark), None, sample_files(spark, sf_dir))
    return snapshot.snapshot_tables(spark, catalog, issues, WHEN)["metadata"].select("key", "value")


@register(f"{FLAT_SQL} {RULES} SELECT code, severity, path, description FROM issues")
def snapshot_validation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = validation.prepared(sample_catalog(spark, sf_dir))
    issues = validation.validate(catalog, sample_resolver(spark), None, sample_files(spark, sf_dir))
    return snapshot.snapshot_tables(spark, catalog, issues, WHEN)["validation_flags"].select(*snapshot.columns_of("validation_flags"))


@register(f"""{FLAT_SQL}, src AS (SELECT k, string_agg(g, ';' ORDER BY n) AS gs FROM (SELECT k, n, regexp_extract(source_ref, '^TPN:(\\{{.*\\}})$', 1) AS g FROM m) WHERE g <> '' GROUP BY 1),
d AS (SELECT m.k AS dk, m.* EXCLUDE (k) FROM m)
SELECT o.id AS object_id, o.category, o.name_local, o.cave_id, d.mid AS measurement_id, o.best_mode, o.computed AS computed_best_measurement_id, o.best_reason, d.lat, d.lon, d.x AS x_1992, d.y AS y_1992, d.source, d.source_ref,
  c.nr AS nr_inwent, c.pig AS pig_id, c.url AS pig_url, nullif(concat_ws(';', o.tpn, src.gs), '') AS tpn_globalid, d.day AS observed_date, 'gnss' AS method, d.status AS verification_status, d.accuracy AS horizontal_accuracy_m
FROM o JOIN d ON d.dk = o.k AND d.mid = o.best_id LEFT JOIN c ON c.id = o.cave_id LEFT JOIN src ON src.k = o.k
""")
def release_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published row of each object that has its declared measurement; one that lacks it would fail the release."""
    catalog = sample_catalog(spark, sf_dir)
    known = F.exists("measurements", lambda m: m["id"] == F.col("best_measurement.measurement_id"))
    rows = export.best_rows(type(catalog)(catalog.objects.where(known), catalog.caves, catalog.relations))
    empty = {"elevation_m", "observed_at", "vertical_accuracy_m", "object_notes", "cave_notes", "measurement_notes"}
    return rows.select(*(c for c in export.COLUMNS if c not in empty))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
