"""The catalogue's rules as data: each is a condition with a code, a severity and a text.

All that a record's own row decides is found in one pass over it; rules about references, files and
polygons are joins. The validator is the union of both.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import path_matches
from ..functions.projection import MAX_ERROR_M, plane
from ..functions.text import is_http_url, is_url_like
from ..sources.catalog import Catalog
from .best import best_measurement_id, only_rejected
from .json_schema import USUAL_FORMATS, schema_issues
from .materialize import cut_lineage
from .resolver import Resolver

ERROR, WARNING = "error", "warning"
MAX_DISTANCE_M = 100.0
#: Paths that the text of an issue names.
SHOWN_PATHS = 20
#: Parts of a key's rows of which each finds its first paths, and errors that a refusal to publish brings to the driver.
PARTS, SHOWN_ERRORS = 128, 100
ISSUE = ["family", "code", "severity", "path", "description"]


class CatalogInvalidError(ValueError):
    """Raised where errors forbid publishing; holds their number and the first of them."""

    def __init__(self, issues: list, total: int) -> None:
        super().__init__(f"{total} errors, first: {issues[0].code if issues else ''}")
        self.issues, self.total = issues, total


def issue(rows: DataFrame, family: int, code: str, severity: str, description: Column, where: Column | None = None) -> DataFrame:
    """Issues for rows with a path."""
    rows = rows if where is None else rows.where(where)
    return rows.select(F.lit(family).alias("family"), F.lit(code).alias("code"), F.lit(severity).alias("severity"), "path", description.alias("description"))


def falsy(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) == ""


def with_planes(objects: DataFrame) -> DataFrame:
    """`planes`: north and east of each measurement, which several rules need."""
    return objects.withColumn("planes", F.transform("measurements", lambda m: plane(m["lat"], m["lon"])))


def least_of_each(rows: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """(key, value, turn) of the k least values of each key.

    A key's rows are dealt to parts, each part hands on its k least, and only these meet: a key that
    very many rows share comes to PARTS times k rows in one task.
    """
    turn = lambda *keys: F.row_number().over(W.partitionBy(*keys).orderBy(value))
    some = rows.select(key, value, F.pmod(F.xxhash64(value), F.lit(PARTS)).alias("part")).withColumn("turn", turn(key, "part")).where(F.col("turn") <= k)
    return some.select(key, value).withColumn("turn", turn(key)).where(F.col("turn") <= k)


def shared_paths(rows: DataFrame, key: str) -> DataFrame:
    """(key, paths) of keys in several rows: how many, and the first `SHOWN_PATHS` paths, so that no cell grows with a key's rows."""
    n = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    first = least_of_each(rows, key, "path", SHOWN_PATHS).groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("path")), ", ").alias("paths"))
    more = F.when(F.col("n") > SHOWN_PATHS, F.concat(F.lit(" and "), (F.col("n") - SHOWN_PATHS).cast("string"), F.lit(" more"))).otherwise("")
    return n.join(first, key).select(key, F.concat("paths", more).alias("paths"))


def told(family: int, code: str, severity: str, description: Column, where: Column) -> Column:
    """An issue of a row as a struct, null where the condition does not hold."""
    return F.when(where, F.struct(F.lit(family).alias("family"), F.lit(code).alias("code"), F.lit(severity).alias("severity"), description.alias("description")))


_TOLD = "array<struct<family:int,code:string,severity:string,description:string>>"


def within_rows(rows: DataFrame, single: list[Column], lists: list[Column]) -> DataFrame:
    """The issues that rows tell of themselves, in one pass: `single` are structs, `lists` arrays of structs."""
    found = F.concat(F.array(*single), *(F.coalesce(x, F.array().cast(_TOLD)) for x in lists)).cast(_TOLD)
    return rows.select("path", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select("x.family", "x.code", "x.severity", "path", "x.description")


def record_rules(kind: str) -> list[Column]:
    """Schema version and file name."""
    version = F.get_json_object("raw", "$.schema_version")
    return [
        told(1, "SCHEMA_VERSION_INVALID", ERROR, F.concat(F.lit("schema_version is "), F.coalesce(version, F.lit("missing"))), ~F.coalesce(version.isin("1", "1.0"), F.lit(False))),
        told(2, "FILE_ID_MISMATCH", ERROR, F.concat(F.lit(f"the path does not fit {kind} "), F.col("id")), F.col("id").isNotNull() & ~path_matches(F.lit(kind), F.col("path"), F.col("id"))),
    ]


def record_issues(catalog: Catalog, schemas: dict[str, dict] | None, formats: Collection[str] = USUAL_FORMATS) -> list[DataFrame]:
    """What caves and relations tell of themselves, and the schemas of all kinds."""
    out = [within_rows(df.where("parse_error is null"), record_rules(kind), []) for kind, df in (("cave", catalog.caves), ("relation", catalog.relations))]
    for kind, df in (("object", catalog.objects), ("cave", catalog.caves), ("relation", catalog.relations)):
        if schemas and kind in schemas:
            out.append(issue(schema_issues(df.where("parse_error is null"), schemas[kind], formats), 1, "SCHEMA_VALIDATION", ERROR, F.col("description")))
    return out


def reference_issues(catalog: Catalog) -> list[DataFrame]:
    """Duplicate object ids and references that lead nowhere: aggregations and anti-joins on ids."""
    objects, caves, relations = (d.where("parse_error is null") for d in (catalog.objects, catalog.caves, catalog.relations))
    paths = objects.where("id is not null").select("id", "path")
    out = [issue(paths.join(shared_paths(paths, "id"), "id"), 3, "DUPLICATE_OBJECT_ID", ERROR, F.concat(F.col("id"), F.lit(" is in "), "paths"))]
    object_ids = objects.select(F.col("id").alias("ref")).where("ref is not null").distinct()
    cave_ids = caves.select(F.col("id").alias("ref")).where("ref is not null").distinct()
    lost = objects.where(~falsy(F.col("cave_id"))).select("path", F.col("cave_id").alias("ref")).join(cave_ids, "ref", "left_anti")
    out.append(issue(lost, 4, "CAVE_REFERENCE_MISSING", ERROR, F.concat(F.lit("no cave "), F.col("ref"))))
    listed = caves.select("path", F.explode("object_ids").alias("ref")).join(object_ids, "ref", "left_anti")
    out.append(issue(listed, 4, "CAVE_OBJECT_REFERENCE_MISSING", ERROR, F.concat(F.lit("no object "), F.col("ref"))))
    ends = relations.select("path", F.explode(F.array("from_object_id", "to_object_id")).alias("ref")).where("ref is not null").join(object_ids, "ref", "left_anti")
    out.append(issue(ends, 4, "RELATION_OBJECT_REFERENCE_MISSING", ERROR, F.concat(F.lit("no object "), F.col("ref"))))
    tpn = objects.select("path", "id", F.explode("external_refs").alias("r")).where("r.system = 'TPN' and r.ref_type = 'source_globalid' and r.external_id is not null").select("path", F.col("r.external_id").alias("g"))
    out.append(issue(tpn.join(shared_paths(tpn, "g"), "g"), 9, "DUPLICATE_TPN_GLOBALID", ERROR, F.concat(F.col("g"), F.lit(" is in "), "paths")))
    return out


def object_rules() -> tuple[list[Column], list[Column]]:
    """Rules that an object's own row decides: single issues, and lists over its attachments, references and measurements."""
    best, own = F.col("best_measurement"), F.transform("measurements", lambda m: m["id"])
    among = lambda i: F.coalesce(F.array_contains(own, i), F.lit(False))
    auto, computed = best["mode"] == "auto", best_measurement_id(F.col("measurements"))
    single = record_rules("object") + [
        told(4, "BEST_MEASUREMENT_MISSING", ERROR, F.concat(F.lit("no measurement "), best["measurement_id"]), best["measurement_id"].isNotNull() & ~among(best["measurement_id"])),
        told(4, "BEST_MEASUREMENT_MANUAL_REASON_REQUIRED", ERROR, F.lit("a manual choice needs a reason"), (best["mode"] == "manual") & falsy(best["reason"])),
        told(5, "CAVE_ID_MISSING_FOR_CAVE_OPENING", WARNING, F.lit("an opening without a cave"), (F.col("category") == "jaskinia_otwor") & falsy(F.col("cave_id"))),
        told(8, "BEST_MEASUREMENT_AUTO_MISMATCH", WARNING, F.concat_ws(" ", best["measurement_id"], computed), auto & computed.isNotNull() & ~computed.eqNullSafe(best["measurement_id"])),
        told(8, "BEST_MEASUREMENT_REJECTED_FALLBACK", WARNING, F.lit("all measurements are rejected"), auto & only_rejected(F.col("measurements"))),
    ]

    def of_reference(r: Column) -> Column:
        return F.array(
            told(5, "NR_INWENT_ON_OBJECT_REFERENCE", WARNING, F.lit("inventory numbers belong to caves"), r["system"] == "NR_INWENT"),
            told(5, "PIG_CATALOG_REFERENCE_ON_OBJECT", WARNING, F.lit("PIG records belong to caves"), (r["system"] == "PIG") & r["ref_type"].isin("catalog_id", "url")),
        )

    def of_attachment(a: Column) -> Column:
        return F.array(
            told(4, "ATTACHMENT_MEASUREMENT_MISSING", ERROR, F.concat(F.lit("no measurement "), a["measurement_id"]), ~falsy(a["measurement_id"]) & ~among(a["measurement_id"])),
            told(6, "ATTACHMENT_URL_INVALID", ERROR, a["path"], is_url_like(a["path"]) & ~is_http_url(a["path"])),
        )

    def of_measurement(z: Column) -> Column:
        m, p = z["measurements"], z["planes"]
        error = F.hypot(p["n"] - m["x_1992"], p["e"] - m["y_1992"])
        return F.array(
            told(7, "MISSING_HORIZONTAL_ACCURACY", WARNING, m["id"], m["horizontal_accuracy_m"].isNull()),
            told(7, "MISSING_SOURCE_REF", WARNING, m["id"], falsy(m["source_ref"])),
            told(7, "COORDINATE_MISMATCH", ERROR, F.concat(m["id"], F.format_string(": %.2f m", error)), error > MAX_ERROR_M),
        )

    def far(points: Column) -> Column:
        """Pairs of a record's measurements that lie too far apart."""
        def others(a: Column, i: Column) -> Column:
            apart = F.transform(F.slice(points, i + 2, F.size(points)), lambda b: F.struct(b["id"].alias("id"), F.hypot(a["n"] - b["n"], a["e"] - b["e"]).alias("d")))
            return F.transform(F.filter(apart, lambda p: p["d"] > MAX_DISTANCE_M), lambda p: told(7, "MEASUREMENT_DISTANCE_OUTLIER", WARNING, F.concat_ws(" ", a["id"], p["id"], F.format_string("%.2f m", p["d"])), F.lit(True)))

        return F.flatten(F.transform(points, others))

    placed = F.filter(F.transform(F.arrays_zip("measurements", "planes"), lambda z: F.struct(z["measurements"]["id"].alias("id"), z["planes"]["n"].alias("n"), z["planes"]["e"].alias("e"))), lambda p: p["n"].isNotNull() & p["e"].isNotNull())
    lists = [F.flatten(F.transform("external_refs", of_reference)), F.flatten(F.transform("attachments", of_attachment)), F.flatten(F.transform(F.arrays_zip("measurements", "planes"), of_measurement)), F.flatten(F.transform(F.array(placed), far))]
    return single, lists


def point_asked(m: Column, p: Column) -> Column:
    """A measurement as the resolver is asked for it."""
    return F.struct(F.lit(False).alias("chosen"), m["id"].alias("mid"), m["lat"].alias("lat"), m["lon"].alias("lon"), p["n"].alias("x_1992"), p["e"].alias("y_1992"))


def object_issues(catalog: Catalog, resolver: Resolver | None, files: DataFrame | None) -> list[DataFrame]:
    """Rules of objects: all that a row decides in one pass, then those that need files or polygons."""
    objects = catalog.objects.where("parse_error is null")
    out = [within_rows(objects, *object_rules())]
    if files is not None:
        places = objects.select("path", F.explode("attachments").alias("a")).select("path", F.col("a.path").alias("file")).where("file is not null")
        local = places.where(~is_url_like(F.col("file"))).join(files.select(F.col("file")).distinct(), "file", "left_anti")
        out.append(issue(local, 6, "ATTACHMENT_PATH_MISSING", ERROR, F.col("file")))
    if resolver is not None:
        # The declared measurement is asked with the others, so points are placed once.
        placed = F.transform(F.arrays_zip("measurements", "planes"), lambda z: point_asked(z["measurements"], z["planes"]))
        declared = F.get(F.filter(placed, lambda p: p["mid"] == F.col("best_measurement.measurement_id")), 0)
        asked = F.concat(placed, F.array(declared.withField("chosen", F.lit(True))))
        points = objects.select("path", "id", F.posexplode(asked).alias("pos", "a")).select(F.concat_ws("#", "path", F.col("pos").cast("string")).alias("point_id"), "path", "id", "a.*").where("lat is not null and lon is not null")
        own = F.regexp_extract("id", r"^([^-]*)-", 1)
        outside = lambda code, severity, status: told(7, code, severity, F.col("mid"), ~F.col("chosen") & (F.col("status") == status))
        prefix = told(7, "OBJECT_PREFIX_MISMATCH", WARNING, F.concat_ws(" ", "id", "prefix"), F.col("chosen") & F.col("id").contains("-") & F.col("prefix").isNotNull() & (own != F.col("prefix")))
        out.append(within_rows(resolver(points), [outside("MEASUREMENT_OUTSIDE_PL_SK", ERROR, "error"), outside("MEASUREMENT_OUTSIDE_VALLEYS", WARNING, "warning"), prefix], []))
    return out


def prepared(catalog: Catalog) -> Catalog:
    """Records in a checkpoint, with `planes`: for callers that need them beside the rules."""
    return catalog if "planes" in catalog.objects.columns else Catalog(*map(cut_lineage, (with_planes(catalog.objects), catalog.caves, catalog.relations)))


def validate(catalog: Catalog, resolver: Resolver | None = None, schemas: dict[str, dict] | None = None, files: DataFrame | None = None, formats: Collection[str] = USUAL_FORMATS) -> DataFrame:
    """All issues (family, code, severity, path, description); families are in the order of reporting.

    Without a resolver the rules that need polygons are left out, without `files` (a column `file`)
    the rule for local attachments; `formats` names the formats of the schemas that are enforced. If any record can't be read, only that is reported. Records are
    read once, into a checkpoint that all rules share, unless the catalogue is `prepared` already.
    """
    catalog = prepared(catalog)
    if catalog.issues_of_reading().limit(1).count():
        return issue(catalog.issues_of_reading(), 0, "YAML_INVALID", ERROR, F.col("parse_error"))
    return reduce(DataFrame.unionByName, [*record_issues(catalog, schemas, formats), *reference_issues(catalog), *object_issues(catalog, resolver, files)])


def has_errors(issues: DataFrame) -> bool:
    return issues.where(F.col("severity") == ERROR).limit(1).count() > 0


def require_valid(issues: DataFrame) -> DataFrame:
    """The issues, or an exception with the number of errors and the first of them."""
    if has_errors(issues):
        errors = issues.where(F.col("severity") == ERROR)
        raise CatalogInvalidError(errors.orderBy("family", "path", "code").limit(SHOWN_ERRORS).collect(), errors.count())
    return issues


def formatted(issues: DataFrame) -> DataFrame:
    """One line an issue: code, severity, path and description, separated by tabs."""
    shown = F.concat_ws("\t", "code", "severity", F.coalesce("path", F.lit("<dataset>")), "description")
    return issues.orderBy("family", "path", "code", "description").select(shown.alias("line"))
