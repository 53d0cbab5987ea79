"""Staging of the two source registries: proposals, matches and issues as DataFrames, and their reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_part, source_date, source_year_end
from ..functions.ids import id_number, numbered_id
from ..functions.projection import MAX_ERROR_M, to_degrees, with_plane
from ..functions.text import clean, normalize_name, parse_decimal
from ..operators.allocation import allocate_by_prefix, max_existing_number, running_number
from ..operators.candidates import COLUMNS, final_candidates
from ..operators.matching import RADIUS_M, match_cascade
from ..operators.materialize import cut_lineage, spread
from ..operators.resolver import Resolver
from ..sources.catalog import Catalog
from ..sources.json_lists import read_lists
from ..sources.schemas import CAVE, MEASUREMENT, OBJECT, REF
from .categories import object_category

# Texts that are part of the records and by which a review knows them.
PIG_MEASUREMENT = "PIG source-record measurement imported into staging; not field-verified."
TPN_MEASUREMENT = "TPN source-record measurement imported into staging; not field-verified."
PIG_PROPOSAL = "Staging proposal from PIG; requires operator review before final YAML."
TPN_PROPOSAL = "Staging proposal from TPN; requires operator review before final YAML."
TPN_UPDATE = "Staging measurement update from TPN; requires operator review before final YAML."
NR_NOTE = "Inventory number belongs to the cave/catalog entry, not the object."
PIG_ID_NOTE = "PIG catalog record identifier."
PIG_LINK_NOTE = "PIG catalog record link."
TPN_NOTE = "TPN GLOBALID belongs to the object/source feature."
PIG_AUTHOR, TPN_AUTHOR = "importer:pig", "importer:tpn"

ISSUE = ["record_number", "position", "code", "severity", "source_id", "nr_inwent", "description"]


@dataclass(frozen=True)
class Staging:
    """What a source gives: a summary of each row, issues, proposals and, for matches, measurement updates."""

    rows: DataFrame
    issues: DataFrame
    caves: DataFrame
    objects: DataFrame
    updates: DataFrame | None = None


def struct_of(schema: str, **fields: Column) -> Column:
    """A value of a record schema; fields that are not given are null."""
    names = [f.split(":", 1) for f in split_fields(schema)]
    return F.struct(*((fields[n] if n in fields else F.lit(None)).cast(t).alias(n) for n, t in names))


def split_fields(schema: str) -> list[str]:
    """The fields of struct<...>, nested types kept whole."""
    out, depth, part = [], 0, ""
    for c in schema.removeprefix("struct<")[:-1]:
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(part)
            part = ""
        else:
            part += c
    return [*out, part]


def ref(system: str, kind: str, external_id: Column, scope: str, note: str, url: Column | None = None) -> Column:
    return struct_of(REF, system=F.lit(system), ref_type=F.lit(kind), external_id=external_id, scope=F.lit(scope), notes=F.lit(note), **({} if url is None else {"url": url}))


def present(*refs: tuple[Column, Column]) -> Column:
    """The references whose condition holds, in order."""
    return F.filter(F.array(*(F.when(cond, r) for cond, r in refs)), lambda r: r.isNotNull())


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def labelled(parts: list[tuple[str, Column]], separator: str, sign: str) -> Column:
    """label + sign + value of the non-blank values; null if there are none."""
    return F.nullif(F.concat_ws(separator, *(F.when(~blank(v), F.concat(F.lit(f"{label}{sign}"), v)) for label, v in parts)), F.lit(""))


def column(table: DataFrame, name: str) -> Column:
    return clean(F.col(f"`{name}`")) if name in table.columns else F.lit("")


def issue(rows: DataFrame, position: int, code: Column | str, where: Column, description: Column | str) -> DataFrame:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.where(where).select("record_number", F.lit(position).alias("position"), as_column(code).alias("code"), F.lit("warning").alias("severity"), "source_id", "nr_inwent", as_column(description).alias("description"))


def seeds_of(paths: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """(prefix, seed) from file names and from other ids (a column `id`)."""
    out = max_existing_number(paths, "path", "prefix")
    if more is not None:
        other = more.select(F.regexp_extract("id", r"^([A-Z]{1,3})-\d+$", 1).alias("prefix"), id_number(F.col("id")).alias("n")).where("n is not null")
        out = out.unionByName(other.groupBy("prefix").agg(F.max("n").alias("seed"))).groupBy("prefix").agg(F.max("seed").alias("seed"))
    return out


def cave_numbers(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """`cave_id` in the order of record numbers, from the largest number of the prefix C on; one number comes to the driver."""
    seed = seeds.where("prefix = 'C'").agg(F.max("seed")).first()[0] or 0
    return running_number(rows, "record_number", "__n", seed).withColumn("cave_id", numbered_id(F.lit("C"), F.col("__n").cast("long"))).drop("__n")


def proposal(author: str, generated_at: str, **fields: Column) -> Column:
    audit = {"created_at": F.lit(generated_at), "created_by": F.lit(author), "updated_at": F.lit(generated_at), "updated_by": F.lit(author)}
    return struct_of(OBJECT if "category" in fields else CAVE, schema_version=F.lit(1), **fields, **audit)


def object_proposal(author: str, generated_at: str, object_id: Column, category: Column, name: Column, cave_id: Column, refs: Column, measurement: Column, notes: Column) -> Column:
    return proposal(
        author, generated_at, id=object_id, category=category, name_local=name, cave_id=cave_id, external_refs=refs, measurements=F.array(measurement), notes=notes,
        attachments=F.array(), id_assignment=F.struct(F.lit("auto").alias("method"), F.lit("m-001").alias("assigned_from_measurement_id"), F.split_part(object_id, F.lit("-"), F.lit(1)).alias("assigned_prefix"), F.lit(None).cast("string").alias("prefix_override_reason")),
        best_measurement=F.struct(F.lit("auto").alias("mode"), F.lit("m-001").alias("measurement_id"), F.lit(None).cast("string").alias("reason"), F.lit(generated_at).alias("updated_at"), F.lit(author).alias("updated_by")),
    )


def source_measurement(source: str, author: str, generated_at: str, measurement_id: Column, source_ref: Column, notes: Column) -> Column:
    """A measurement as the source has it; lat, lon, x, y, elevation and day are columns."""
    return struct_of(
        MEASUREMENT, id=measurement_id, lat=F.col("lat"), lon=F.col("lon"), x_1992=F.col("x"), y_1992=F.col("y"), elevation_m=F.col("elevation"), elevation_datum=F.lit("unknown"), elevation_source=F.lit("source_record"),
        source=F.lit(source), source_ref=source_ref, observed_date=F.col("day"), source_date=F.col("day"), method=F.lit("source_record"), tags=F.array(F.lit(source.lower()), F.lit("staging")),
        verification_status=F.lit("nieweryfikowany"), notes=notes, created_at=F.lit(generated_at), created_by=F.lit(author),
    )


def resolved(rows: DataFrame, resolver: Resolver) -> DataFrame:
    """Rows with the resolver's status, prefix, code and message, joined by record number."""
    found = resolver(rows.select(F.col("record_number").alias("point_id"), "lat", "lon"))
    return rows.join(found.select(F.col("point_id").alias("record_number"), F.col("status").alias("zone"), "prefix", F.col("code").alias("zone_code"), F.col("message").alias("zone_text")), "record_number", "left")


def build_pig_staging(table: DataFrame, catalog: Catalog, resolver: Resolver, generated_at: str) -> Staging:
    """A cave for each row; an object too if its point is complete, consistent and inside the countries."""
    col = lambda n: column(table, n)
    rows = table.select(
        "record_number", col("ID").alias("pig_id"), col("Nazwa").alias("name"), col("Inne nazwy").alias("aliases"), col("Nr inw.").alias("nr_inwent"), col("Sektor (nazwa)").alias("sector"),
        col("Stan na rok").alias("year"), col("Link").alias("link"), *(col(c).alias(a) for a, c in (("length_m", "Długość [m]"), ("depth_m", "Głębokość [m]"), ("denivelation_m", "Deniwelacja [m]"))),
        *(parse_decimal(col(c)).alias(a) for a, c in (("lat", "B"), ("lon", "L"), ("x", "X 1992"), ("y", "Y 1992"), ("elevation", "H (wg PIG)"))),
    ).withColumn("source_id", F.nullif("pig_id", F.lit("")))
    # Numbers are read from texts once; what is made of them later asks for each several times, and numbering for all rows twice.
    rows = cut_lineage(spread(rows, "record_number"))
    today = date_part(F.lit(generated_at), F.current_date().cast("string"))
    rows = rows.withColumn("year_day", source_year_end(F.col("year"))).withColumn("day", F.coalesce("year_day", today))
    rows = rows.withColumn("complete", F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull())
    rows = with_plane(rows, "lat", "lon", "north", "east").withColumn("error_m", F.when(F.col("complete"), F.hypot(F.col("north") - F.col("x"), F.col("east") - F.col("y")))).drop("north", "east")
    rows = cave_numbers(cut_lineage(rows), seeds_of(catalog.caves.select("path")))
    consistent = F.coalesce(F.col("error_m") <= MAX_ERROR_M, F.lit(False))
    placed = cut_lineage(resolved(rows, resolver).withColumn("accepted", consistent & F.coalesce((F.col("zone") != "error") & F.col("prefix").isNotNull(), F.lit(False))))
    numbered = allocate_by_prefix(placed.where("accepted"), "prefix", ["record_number"], seeds_of(catalog.objects.select("path")), "object_id")
    all_rows = placed.join(numbered.select("record_number", "object_id"), "record_number", "left")
    refs = present(
        (~blank(F.col("nr_inwent")), ref("NR_INWENT", "inventory_number", F.col("nr_inwent"), "cave", NR_NOTE)),
        (~blank(F.col("pig_id")), ref("PIG", "catalog_id", F.col("pig_id"), "cave", PIG_ID_NOTE, F.nullif("link", F.lit("")))),
        (~blank(F.col("link")), ref("PIG", "url", F.col("link"), "cave", PIG_LINK_NOTE, F.col("link"))),
    )
    size = labelled([(c, F.col(c)) for c in ("length_m", "depth_m", "denivelation_m")], ", ", "=")
    notes = labelled([("PIG aliases", F.col("aliases")), ("PIG sector", F.col("sector")), ("PIG morphometry", size), ("PIG source state year", F.col("year"))], "\n", ": ")
    caves = all_rows.select("record_number", proposal(PIG_AUTHOR, generated_at, id=F.col("cave_id"), name=F.col("name"), external_refs=refs, object_ids=F.array(), notes=notes).alias("r"))
    source_ref = F.when(~blank(F.col("pig_id")), F.concat(F.lit("PIG:"), "pig_id"))
    text = F.concat(F.lit(PIG_MEASUREMENT), F.when(blank(F.col("link")), "").otherwise(F.concat(F.lit(" Source: "), "link")))
    measurement = source_measurement("PIG", PIG_AUTHOR, generated_at, F.lit("m-001"), source_ref, text)
    objects = all_rows.where("object_id is not null").select("record_number", object_proposal(PIG_AUTHOR, generated_at, F.col("object_id"), F.lit("jaskinia_otwor"), F.col("name"), F.col("cave_id"), F.array().cast(f"array<{REF}>"), measurement, F.lit(PIG_PROPOSAL)).alias("r"))
    mismatch = F.concat(F.lit("WGS84 and plane coordinates differ by "), F.format_string("%.2f", "error_m"), F.lit(" m; no object is proposed."))
    issues = [
        issue(all_rows, 0, "PIG_POINT_COORDINATES_INVALID", ~F.col("complete"), "Coordinates are missing or no numbers; no object is proposed."),
        issue(all_rows, 1, "PIG_SOURCE_YEAR_INVALID", F.col("complete") & F.col("year_day").isNull(), "The year is missing or no year; the day of the run is used."),
        issue(all_rows, 2, "PIG_COORDINATE_MISMATCH", F.coalesce(F.col("error_m") > MAX_ERROR_M, F.lit(False)), mismatch),
        issue(all_rows, 3, F.coalesce("zone_code", F.lit("PIG_PREFIX_RESOLUTION_ERROR")), consistent & ~F.col("accepted"), F.concat(F.coalesce("zone_text", F.lit("no prefix")), F.lit("; no object is proposed."))),
        issue(all_rows, 3, F.coalesce("zone_code", F.lit("PIG_PREFIX_RESOLUTION_WARNING")), F.col("accepted") & (F.col("zone") == "warning"), F.coalesce("zone_text", F.lit("the prefix needs a review"))),
    ]
    summary = all_rows.select("record_number", "pig_id", "nr_inwent", "name", "cave_id", "object_id", F.when(F.col("object_id").isNotNull(), "object_proposed").otherwise("cave_only").alias("status"))
    return Staging(summary, reduce(DataFrame.unionByName, issues), caves.select("record_number", "r.*"), objects.select("record_number", "r.*"))


def build_tpn_staging(table: DataFrame, catalog: Catalog, resolver: Resolver, generated_at: str, staged: DataFrame | None = None, radius: float = RADIUS_M) -> Staging:
    """Rows are rejected, matched with a candidate (final, or of the other staging), new, or left unresolved."""
    col = lambda n: column(table, n)
    texts = {"DLUGOSC": "length", "GLEBOKOSC": "depth", "DENIWELACJ": "denivelation", "WER_LOK": "place_note", "UWAGI": "remarks", "OTWÓR": "opening", "GENEZA": "genesis"}
    # Rows are dealt before their numbers are read and placed: a table of few bytes lies in few partitions.
    rows = spread(table, "record_number").select(
        "record_number", col("GLOBALID").alias("globalid"), col("NR_INWENT").alias("nr_inwent"), col("NAZWA").alias("name"), *(col(c).alias(a) for c, a in texts.items()),
        parse_decimal(col("X1992")).alias("x"), parse_decimal(col("Y1992")).alias("y"), parse_decimal(col("Z")).alias("elevation"),
        F.coalesce(source_date(col("LAST_EDI_1"), col("CREATED_DA")).cast("string"), date_part(F.lit(generated_at), F.current_date().cast("string"))).alias("day"),
    ).withColumn("source_id", F.nullif("globalid", F.lit("")))
    lat, lon = to_degrees(F.col("x"), F.col("y"))
    rows = rows.withColumn("has_point", F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("lat", lat).withColumn("lon", lon)
    rows = cut_lineage(rows.withColumn("rejected", blank(F.col("globalid")) | ~F.col("has_point")))
    candidates = final_candidates(catalog)
    if staged is not None:
        candidates = candidates.unionByName(staged.select(*COLUMNS))
    candidates = cut_lineage(candidates.withColumn("candidate_id", F.concat_ws("|", "origin", "object_id")))
    exploded = candidates.select("candidate_id", F.explode_outer("globalids").alias("globalid"), "nr", "name_norm", "x", "y")
    # Repeats of a number count over the whole source, also in rows that are rejected.
    counts = rows.where(~blank(F.col("nr_inwent"))).groupBy("nr_inwent").count()
    asked = rows.where("not rejected").select("record_number", "globalid", F.col("nr_inwent").alias("nr"), normalize_name(F.col("name")).alias("name_norm"), "x", "y")
    found = cut_lineage(match_cascade(asked, exploded, radius, counts.select(F.col("nr_inwent").alias("nr"), F.col("count").alias("source_nr"))))
    rows = rows.join(found.withColumnRenamed("status", "outcome").withColumnRenamed("issue", "match_issue"), "record_number", "left")
    new = resolved(rows.where("outcome = 'new'"), resolver)
    new = cut_lineage(new.withColumn("accepted", F.coalesce((F.col("zone") != "error") & F.col("prefix").isNotNull(), F.lit(False))))
    known = candidates.select(F.col("object_id").alias("id"))
    numbered = allocate_by_prefix(new.where("accepted"), "prefix", ["record_number"], seeds_of(catalog.objects.select("path"), known), "object_id")
    cave_ids = candidates.where("cave_id is not null").select(F.col("cave_id").alias("id"))
    numbered = cut_lineage(cave_numbers(numbered, seeds_of(catalog.caves.select("path"), cave_ids)))
    nr_refs = present((~blank(F.col("nr_inwent")), ref("NR_INWENT", "inventory_number", F.col("nr_inwent"), "cave", NR_NOTE)))
    own_ref = F.array(ref("TPN", "source_globalid", F.col("globalid"), "object", TPN_NOTE))
    cave_notes = labelled([("TPN length", F.col("length")), ("TPN depth", F.col("depth")), ("TPN denivelation", F.col("denivelation")), ("TPN verification/location note", F.col("place_note")), ("TPN notes", F.col("remarks"))], "\n", ": ")
    object_notes = F.concat(F.lit(TPN_PROPOSAL), F.when(blank(F.col("opening")), "").otherwise(F.concat(F.lit("\nTPN opening: "), "opening")))
    measured = lambda mid: source_measurement("TPN", TPN_AUTHOR, generated_at, mid, F.concat(F.lit("TPN:"), "globalid"), F.lit(TPN_MEASUREMENT))
    caves = numbered.select("record_number", proposal(TPN_AUTHOR, generated_at, id=F.col("cave_id"), name=F.col("name"), external_refs=nr_refs, object_ids=F.array("object_id"), notes=cave_notes).alias("r"))
    objects = numbered.select("record_number", object_proposal(TPN_AUTHOR, generated_at, F.col("object_id"), object_category(F.col("genesis"), F.col("name")), F.col("name"), F.col("cave_id"), own_ref, measured(F.lit("m-001")), object_notes).alias("r"))
    target = candidates.select("candidate_id", "origin", F.col("object_id").alias("target_object_id"), F.col("cave_id").alias("target_cave_id"), "next_measurement_id")
    matched = rows.where("outcome = 'matched'").join(target, "candidate_id")
    updates = matched.select(
        F.lit("matched").alias("status"), "record_number", "target_object_id", "target_cave_id",
        F.struct(F.col("origin").alias("source"), "strategy", "distance_m").alias("match"), own_ref.alias("object_external_refs"), nr_refs.alias("cave_external_refs"),
        measured(F.col("next_measurement_id")).alias("measurement"), F.lit(TPN_UPDATE).alias("notes"), "nr_inwent",
    )
    far = F.concat(F.lit("matched by "), "strategy", F.lit(" at a distance of "), F.format_string("%.2f", "distance_m"), F.lit(" m"))
    issues = [
        issue(rows, 0, "TPN_POINT_COORDINATES_INVALID", ~F.col("has_point"), "Coordinates are missing or no numbers."),
        issue(rows, 1, "TPN_GLOBALID_MISSING", blank(F.col("globalid")), "The row has no global id."),
        issue(rows, 2, F.concat(F.lit("TPN_"), "match_issue"), F.col("match_issue").isNotNull(), "Several candidates fit."),
        issue(rows, 3, "TPN_MATCH_DISTANCE_REVIEW", (F.col("outcome") == "matched") & (F.col("distance_m") > radius), far),
        issue(new, 4, F.coalesce("zone_code", F.lit("TPN_PREFIX_RESOLUTION_ERROR")), ~F.col("accepted"), F.coalesce("zone_text", F.lit("no prefix"))),
        issue(new, 4, F.coalesce("zone_code", F.lit("TPN_PREFIX_RESOLUTION_WARNING")), F.col("accepted") & (F.col("zone") == "warning"), F.coalesce("zone_text", F.lit("the prefix needs a review"))),
    ]
    ids = numbered.select("record_number", F.col("cave_id").alias("n_cave"), F.col("object_id").alias("n_object")).unionByName(matched.select("record_number", F.col("target_cave_id").alias("n_cave"), F.col("target_object_id").alias("n_object")))
    status = F.when(F.col("rejected"), "rejected").when((F.col("outcome") == "new") & F.col("n_object").isNull(), "rejected").otherwise(F.col("outcome"))
    summary = rows.join(ids, "record_number", "left").select("record_number", "globalid", "nr_inwent", "name", status.alias("status"), F.col("n_cave").alias("cave_id"), F.col("n_object").alias("object_id"), F.col("strategy").alias("match_strategy"), "distance_m")
    return Staging(summary, reduce(DataFrame.unionByName, issues), caves.select("record_number", "r.*"), objects.select("record_number", "r.*"), updates)


def cell(value: object) -> str:
    return ("" if value is None else str(value)).strip().replace("|", "\\|").replace("\n", "<br>") or "-"


def table_head(columns: list[str]) -> list[str]:
    return ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]


def table_line(row: dict, columns: list[str]) -> str:
    return "| " + " | ".join(cell(row.get(c)) for c in columns) + " |"


def markdown_table(rows: list[dict], columns: list[str]) -> list[str]:
    return [*table_head(columns), *(table_line(r, columns) for r in rows)]


STAGING_ROW = "struct<record_number:long,pig_id:string,globalid:string,nr_inwent:string,name:string,cave_id:string,object_id:string,status:string>"
UPDATE = f"struct<status:string,record_number:long,target_object_id:string,target_cave_id:string,match:struct<source:string,strategy:string,distance_m:double>,object_external_refs:array<{REF}>,cave_external_refs:array<{REF}>,measurement:{MEASUREMENT},notes:string,nr_inwent:string>"
REPORT = {"rows": STAGING_ROW, "proposed_caves": CAVE, "proposed_objects": OBJECT, "matched_measurements": UPDATE}


def read_report(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """rows, proposed_caves, proposed_objects and matched_measurements of a staging file; empty if there is none."""
    try:
        found = read_lists(spark, path, REPORT)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = {n: spark.createDataFrame([], f"pos int, r {t}") for n, t in REPORT.items()}
    return {n: d.select("pos", "r.*") for n, d in found.items()}
