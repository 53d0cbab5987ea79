"""Application of review decisions to the catalogue.

Decisions form an ordered log in which later ones see what earlier ones did. What a decision needs
to know of the past is little: when its cave or object was first created, and whether the same
measurement was added before. So validity is a set of joins on the decision's index, and the final
state of a record is its base with the ordered list of its additions folded in as array columns;
nothing is replayed row by row. Writing is all or nothing: any error forbids it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean, positive_int
from ..sources.catalog import Catalog, CatalogLoadError, parse_yaml
from ..sources.schemas import CAVE, MEASUREMENT, OBJECT, REF
from .best import best_measurement_id
from .materialize import cut_lineage
from .refs import append_unique

# Prefixes of notes before and after a review, and the actions of a decision.
STAGED_PROPOSAL, FINAL_PROPOSAL = "Staging proposal from {0}; requires operator review before final YAML.", "Imported from {0} source record after operator review."
STAGED_MEASUREMENT, FINAL_MEASUREMENT = "{0} source-record measurement imported into staging; not field-verified.", "{0} source-record measurement imported after operator review; not field-verified."
ACTIONS = ["create_cave", "create_object", "add_measurement", "link_cave", "reject", "unresolved"]
SOURCES = ["PIG", "TPN"]
DECISION = "action string, source string, record_number string, object_id string, cave_id string, target_object_id string, target_cave_id string, reason string"


class DecisionFileError(ValueError):
    """A decision file that is no mapping of the expected form."""


def final_note(note: Column, staging_prefix: str, final_prefix: str) -> Column:
    """The note with its staging prefix replaced, only where it starts with it."""
    rest = F.substring(note, len(staging_prefix) + 1, 2**31 - 1)
    return F.when(note.startswith(staging_prefix), F.concat(F.lit(final_prefix), rest)).otherwise(note)


def final_measurement(m: Column) -> Column:
    note = m["notes"]
    for source in SOURCES:
        note = F.when(F.upper(clean(m["source"])) == source, final_note(m["notes"], STAGED_MEASUREMENT.format(source), FINAL_MEASUREMENT.format(source))).otherwise(note)
    return m.withField("tags", F.array_remove(m["tags"], "staging")).withField("notes", note)


@dataclass(frozen=True)
class Review:
    """Outcome of a decision log: what was applied, issues, and changed records with the fields that change."""

    applied: DataFrame
    issues: DataFrame
    objects: DataFrame
    caves: DataFrame
    reviewed_at: str
    reviewed_by: str

    def has_errors(self) -> bool:
        return self.issues.where("severity = 'error'").limit(1).count() > 0


def read_decisions(spark: SparkSession, path: str) -> dict:
    """The content of a decision file."""
    [row] = spark.read.format("binaryFile").load(path).select("content").collect()
    text = bytes(row.content).decode("utf-8")
    _, error = parse_yaml(text)
    if error:
        raise DecisionFileError(f"{path}: {error}")
    return yaml.safe_load(text)


def refused(spark: SparkSession, code: str, text: str, reviewed_at: str, reviewed_by: str) -> Review:
    """A review of which nothing was applied, for one reason."""
    nothing = spark.createDataFrame([], "key string")
    applied = spark.createDataFrame([], "decision_index long, action string, status string, source string, record_number long, object_id string, cave_id string, description string")
    issues = spark.createDataFrame([(None, code, "error", text)], "decision_index long, code string, severity string, description string")
    return Review(applied, issues, nothing, nothing, reviewed_at, reviewed_by)


def review_file(spark: SparkSession, catalog: Catalog, data: dict, reports: dict[str, dict[str, DataFrame]], reviewed_at: str, reviewed_by: str) -> Review:
    """`apply_review` for the content of a decision file; its own time and author count before those given."""
    at, by = str(data.get("reviewed_at") or reviewed_at), str(data.get("reviewed_by") or reviewed_by)
    if not isinstance(data.get("decisions"), list):
        return refused(spark, "DECISIONS_INVALID", "decisions must be a list", at, by)
    try:
        catalog.check()
    except CatalogLoadError as e:
        return refused(spark, "FINAL_DATA_INVALID", str(e), at, by)
    return apply_review(spark, catalog, data["decisions"], reports, at, by)


def decision_rows(spark: SparkSession, decisions: list) -> DataFrame:
    """decision_index from 1, is_mapping, and the trimmed fields; one row for each entry of the log."""
    names = [f.split(" ")[0] for f in DECISION.split(", ")]
    rows = [(k, isinstance(d, dict), *(None if not isinstance(d, dict) or d.get(n) is None else str(d[n]) for n in names)) for k, d in enumerate(decisions, 1)]
    return trimmed(spark.createDataFrame(rows, f"decision_index long, is_mapping boolean, {DECISION}"))


def trimmed(df: DataFrame) -> DataFrame:
    """A log as a DataFrame (decision_index, is_mapping and the fields of DECISION as texts), blanks as null."""
    names = [f.split(" ")[0] for f in DECISION.split(", ")]
    shown = [F.nullif(clean(F.col(n)), F.lit("")).alias(n) for n in names if n != "record_number"]
    return df.select("decision_index", "is_mapping", positive_int(F.col("record_number")).alias("record_number"), *shown).withColumn("source", F.upper("source"))


def last_by(df: DataFrame, key: str) -> DataFrame:
    """The last row by position of each key that is not blank."""
    names = [c for c in df.columns if c not in ("pos", key)]
    out = df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").groupBy(key).agg(F.max_by(F.struct(*names), "pos").alias("v"))
    return out.select(key, "v.*")


def indexes(reports: dict[str, dict[str, DataFrame]]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, caves, objects, updates) of both sources; of repeated keys the last counts."""
    def both(name: str, key: str) -> DataFrame:
        parts = [last_by(r[name], key).withColumn("source", F.lit(source)) for source, r in reports.items()]
        return reduce(DataFrame.unionByName, parts)

    rows = both("rows", "record_number").select("source", "record_number", F.nullif(clean(F.col("cave_id")), F.lit("")).alias("row_cave"), F.nullif(clean(F.col("object_id")), F.lit("")).alias("row_object"), "globalid")
    caves, objects = both("proposed_caves", "id"), both("proposed_objects", "id")
    caves = caves.select("source", F.col("id").alias("cave_key"), F.struct(*(F.col(n) for n in field_names(CAVE))).cast(CAVE).alias("cave"))
    objects = objects.select("source", F.col("id").alias("object_key"), F.struct(*(F.col(n) for n in field_names(OBJECT))).cast(OBJECT).alias("object"))
    updates = reports["TPN"]["matched_measurements"]
    named = rows.where("source = 'TPN' and globalid is not null").groupBy("globalid").agg(F.max("record_number").alias("by_id"))
    updates = updates.withColumn("g", F.regexp_extract(F.coalesce("measurement.source_ref", F.lit("")), "^TPN:(.*)$", 1)).join(named, F.col("g") == F.col("globalid"), "left")
    updates = updates.withColumn("record_number", F.coalesce(F.when(F.col("record_number") > 0, F.col("record_number")), "by_id")).drop("g", "globalid", "by_id")
    updates = last_by(updates.select("pos", "record_number", "target_object_id", "target_cave_id", "object_external_refs", "cave_external_refs", "measurement"), "record_number")
    return rows, caves, objects, updates


def field_names(schema: str) -> list[str]:
    """Names of a record schema's own fields."""
    names, depth, part = [], 0, ""
    for c in schema.removeprefix("struct<")[:-1] + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            names.append(part.split(":", 1)[0])
            part = ""
        else:
            part += c
    return names


def with_first(rows: DataFrame, keys: list[str], where: Column) -> DataFrame:
    """`rows` with `is_first`: whether a row is the first decision of its keys among those that `where` holds for.

    The least index of each key is aggregated and joined, so that very many decisions on one record are
    never sorted in one task.
    """
    least = rows.where(where).groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min("decision_index").alias("__least"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    joined = rows.join(least, same, "left").withColumn("is_first", F.coalesce(F.col("decision_index") == F.col("__least"), F.lit(False)))
    return joined.drop("__least", *(f"__{k}" for k in keys))


def problem(rows: DataFrame, code: str, where: Column, text: Column | str, severity: str = "error") -> DataFrame:
    text = F.lit(text) if isinstance(text, str) else text
    return rows.where(where).select("decision_index", F.lit(code).alias("code"), F.lit(severity).alias("severity"), text.alias("description"))


def apply_review(spark: SparkSession, catalog: Catalog, decisions: list | DataFrame, reports: dict[str, dict[str, DataFrame]], reviewed_at: str, reviewed_by: str) -> Review:
    """`reports` maps PIG and TPN to the DataFrames of their staging files (see plans.staging.read_report).

    `decisions` is the list of a decision file, or a log of any length as `trimmed` describes it.
    """
    log = cut_lineage(trimmed(decisions) if isinstance(decisions, DataFrame) else decision_rows(spark, decisions))
    rows, caves, objects, updates = indexes(reports)
    known = F.coalesce(F.col("action").isin(ACTIONS), F.lit(False))
    issues = [problem(log, "DECISION_INVALID", ~F.col("is_mapping"), "a decision must be a mapping"), problem(log, "DECISION_ACTION_INVALID", F.col("is_mapping") & ~known, F.concat(F.lit("unsupported action "), F.coalesce("action", F.lit("(none)"))))]
    log = log.where(F.col("is_mapping") & known)
    needs_row = F.col("action") != "link_cave"
    bad_source = needs_row & ~F.coalesce(F.col("source").isin(SOURCES), F.lit(False))
    issues += [problem(log, "DECISION_SOURCE_INVALID", bad_source, "the source must be PIG or TPN"), problem(log, "DECISION_RECORD_INVALID", needs_row & F.col("record_number").isNull(), "the record number must be a positive integer")]
    log = cut_lineage(log.where(~bad_source & ~(needs_row & F.col("record_number").isNull())).join(rows.drop("globalid"), ["source", "record_number"], "left"))
    final_caves = catalog.caves.select(F.col("id").alias("k"), F.lit(0).cast("long").alias("since")).where("k is not null")
    final_objects = catalog.objects.select(F.col("id").alias("k"), F.lit(0).cast("long").alias("since")).where("k is not null")

    def created(kind: str, proposals: DataFrame, key: str, body: str, final: DataFrame, row_id: str) -> tuple[DataFrame, DataFrame]:
        """(decisions with their proposal and outcome, ids with the index since which they exist)."""
        own = log.where(F.col("action") == f"create_{kind}").withColumn("wanted", F.coalesce(F.col(f"{kind}_id"), F.col(row_id)))
        own = own.join(proposals, (own.source == proposals.source) & (F.col("wanted") == F.col(key)), "left").drop(proposals.source)
        own = own.join(final.distinct(), F.col("wanted") == F.col("k"), "left")
        own = with_first(own, ["wanted"], F.col(body).isNotNull())
        own = cut_lineage(own.withColumn("ok", F.col(body).isNotNull() & F.col("k").isNull() & F.col("is_first")).drop("k", "since", "is_first"))
        since = final.unionByName(own.where("ok").select(F.col("wanted").alias("k"), F.col("decision_index").alias("since")))
        return own, since.groupBy("k").agg(F.min("since").alias("since"))

    new_caves, cave_since = created("cave", caves, "cave_key", "cave", final_caves, "row_cave")
    new_objects, object_since = created("object", objects, "object_key", "object", final_objects, "row_object")
    for kind, own in (("cave", new_caves), ("object", new_objects)):
        name = kind.upper()
        issues += [problem(own, f"STAGING_{name}_PROPOSAL_MISSING", F.col(kind).isNull(), F.concat(F.lit("no proposal in "), "source", F.lit(" row "), F.col("record_number").cast("string"))), problem(own, f"{name}_ALREADY_EXISTS", F.col(kind).isNotNull() & ~F.col("ok"), F.concat("wanted", F.lit(" exists already")))]

    adds = log.where("action = 'add_measurement'").drop("target_object_id").join(log.select("decision_index", F.col("target_object_id").alias("t_object")), "decision_index").withColumnRenamed("target_cave_id", "t_cave")
    issues.append(problem(adds, "MEASUREMENT_SOURCE_UNSUPPORTED", F.col("source") != "TPN", "only TPN rows have measurement updates"))
    adds = adds.where("source = 'TPN'").join(updates.withColumn("found", F.lit(True)), "record_number", "left")
    adds = adds.withColumn("object_key", F.coalesce("t_object", F.nullif(clean(F.col("target_object_id")), F.lit("")))).withColumn("cave_key", F.coalesce("t_cave", F.nullif(clean(F.col("target_cave_id")), F.lit(""))))
    adds = adds.join(object_since, F.col("object_key") == F.col("k"), "left").drop("k")
    found, there = F.col("found").isNotNull(), F.coalesce(F.col("since") < F.col("decision_index"), F.lit(False))
    whole = F.col("measurement").isNotNull()
    mid = clean(F.col("measurement.id"))
    bases = catalog.objects.select(F.col("id").alias("object_key"), F.explode(F.transform("measurements", lambda m: clean(m["id"]))).alias("mid")).unionByName(
        new_objects.where("ok").select(F.col("wanted").alias("object_key"), F.explode(F.transform("object.measurements", lambda m: clean(m["id"]))).alias("mid"))
    )
    adds = adds.withColumn("mid", mid).join(bases.distinct().withColumn("taken", F.lit(True)), ["object_key", "mid"], "left")
    able = found & there & whole & F.col("taken").isNull()
    adds = with_first(adds.withColumn("able", able), ["object_key", "mid"], F.col("able"))
    adds = cut_lineage(adds.withColumn("ok", F.col("able") & F.col("is_first")).drop("is_first"))
    issues += [
        problem(adds, "STAGING_MEASUREMENT_UPDATE_MISSING", ~found, F.concat(F.lit("no update in row "), F.col("record_number").cast("string"))),
        problem(adds, "TARGET_OBJECT_MISSING", found & ~there, F.concat(F.lit("no object "), F.coalesce("object_key", F.lit("(none)")))),
        problem(adds, "STAGING_MEASUREMENT_INVALID", found & there & ~whole, F.concat(F.lit("no measurement in row "), F.col("record_number").cast("string"))),
        problem(adds, "MEASUREMENT_ALREADY_EXISTS", found & there & whole & ~F.col("ok"), F.concat("object_key", F.lit(" has "), "mid", F.lit(" already"))),
    ]

    links = log.where("action = 'link_cave'")
    links = links.join(object_since.select(F.col("k").alias("object_id"), F.col("since").alias("o_since")), "object_id", "left").join(cave_since.select(F.col("k").alias("cave_id"), F.col("since").alias("c_since")), "cave_id", "left")
    both = F.col("object_id").isNotNull() & F.col("cave_id").isNotNull()
    o_there, c_there = (F.coalesce(F.col(c) < F.col("decision_index"), F.lit(False)) for c in ("o_since", "c_since"))
    links = cut_lineage(links.withColumn("ok", both & o_there & c_there))
    issues += [problem(links, "LINK_CAVE_TARGET_MISSING", ~both, "a link needs an object and a cave"), problem(links, "LINK_OBJECT_MISSING", both & ~o_there, F.concat(F.lit("no object "), "object_id")), problem(links, "LINK_CAVE_MISSING", both & o_there & ~c_there, F.concat(F.lit("no cave "), "cave_id"))]

    others = log.where(F.col("action").isin("reject", "unresolved")).join(rows.select("source", "record_number", F.lit(True).alias("row")), ["source", "record_number"], "left")
    issues += [problem(others, "STAGING_ROW_MISSING", F.col("row").isNull(), F.concat(F.lit("no "), "source", F.lit(" row "), F.col("record_number").cast("string"))), problem(others, "DECISION_REASON_MISSING", F.col("row").isNotNull() & F.col("reason").isNull(), F.concat("action", F.lit(" without a reason")), "warning")]

    def done(df: DataFrame, status: str, object_id: Column, cave_id: Column, text: Column) -> DataFrame:
        return df.select("decision_index", "action", F.lit(status).alias("status"), "source", "record_number", object_id.alias("object_id"), cave_id.alias("cave_id"), text.alias("description"))

    none = F.lit(None).cast("string")
    applied = [
        done(new_caves.where("ok"), "materialized", none, F.col("wanted"), F.concat(F.lit("created cave "), "wanted")),
        done(new_objects.where("ok"), "materialized", F.col("wanted"), F.col("object.cave_id"), F.concat(F.lit("created object "), "wanted")),
        done(adds.where("ok"), "materialized", F.col("object_key"), F.col("cave_key"), F.concat(F.lit("added "), "mid", F.lit(" to "), "object_key")),
        done(links.where("ok"), "materialized", F.col("object_id"), F.col("cave_id"), F.concat(F.lit("linked "), "object_id", F.lit(" with "), "cave_id")),
        done(others.where("row"), "skipped", none, none, F.coalesce("reason", F.lit("No reason provided."))),
    ]

    # Final state: a record's base and the ordered lists of what was added to it.
    object_base = catalog.objects.select(F.col("id").alias("key"), "raw", F.struct(*field_names(OBJECT)).cast(OBJECT).alias("base")).unionByName(new_objects.where("ok").select(F.col("wanted").alias("key"), none.alias("raw"), finalized(F.col("object"), new_objects).alias("base")))
    added = adds.where("ok").groupBy(F.col("object_key").alias("key")).agg(F.array_sort(F.collect_list(F.struct("decision_index", "measurement", "object_external_refs"))).alias("adds"))
    linked = links.where("ok").groupBy(F.col("object_id").alias("key")).agg(F.max_by("cave_id", "decision_index").alias("link"))
    made = new_objects.where("ok").select(F.col("wanted").alias("key"), F.lit(True).alias("made"))
    o = object_base.join(added, "key", "left").join(linked, "key", "left").join(made, "key", "left").where("adds is not null or link is not null or made")
    more = F.coalesce("adds", F.array().cast(dict(added.dtypes)["adds"]))
    measurements = F.concat(F.coalesce("base.measurements", F.array().cast(f"array<{MEASUREMENT}>")), F.transform(more, lambda a: final_measurement(a["measurement"])))
    refs = append_unique(F.coalesce("base.external_refs", F.array().cast(f"array<{REF}>")), F.flatten(F.transform(more, lambda a: F.coalesce(a["object_external_refs"], F.array().cast(f"array<{REF}>")))))
    o = o.withColumn("measurements", measurements).withColumn("external_refs", refs)
    best = best_measurement_id(F.col("measurements"))
    chosen = F.when((F.size(more) > 0) & (F.col("base.best_measurement.mode") == "auto"), best)
    o = o.select("key", "raw", "base", "measurements", "external_refs", chosen.alias("best"), F.coalesce("link", "base.cave_id").alias("cave_id"), ((F.size(more) > 0) | F.col("link").isNotNull()).alias("touched"))

    cave_base = catalog.caves.select(F.col("id").alias("key"), "raw", F.struct(*field_names(CAVE)).cast(CAVE).alias("base")).unionByName(new_caves.where("ok").select(F.col("wanted").alias("key"), none.alias("raw"), finalized(F.col("cave"), new_caves).alias("base")))
    to_cave = adds.where("ok").join(cave_since.select(F.col("k").alias("cave_key"), F.col("since").alias("c_since")), "cave_key").where("c_since < decision_index")
    to_cave = to_cave.groupBy(F.col("cave_key").alias("key")).agg(F.array_sort(F.collect_list(F.struct("decision_index", "cave_external_refs"))).alias("adds"))
    joined = links.where("ok").groupBy(F.col("cave_id").alias("key")).agg(F.array_sort(F.collect_list(F.struct("decision_index", "object_id"))).alias("links"))
    made = new_caves.where("ok").select(F.col("wanted").alias("key"), F.lit(True).alias("made"))
    c = cave_base.join(to_cave, "key", "left").join(joined, "key", "left").join(made, "key", "left").where("adds is not null or links is not null or made")
    cave_refs = append_unique(F.coalesce("base.external_refs", F.array().cast(f"array<{REF}>")), F.flatten(F.transform(F.coalesce("adds", F.array().cast(dict(to_cave.dtypes)["adds"])), lambda a: F.coalesce(a["cave_external_refs"], F.array().cast(f"array<{REF}>")))))
    old_ids = F.coalesce("base.object_ids", F.array().cast("array<string>"))
    new_ids = F.array_distinct(F.transform(F.coalesce("links", F.array().cast(dict(joined.dtypes)["links"])), lambda x: x["object_id"]))
    c = c.select("key", "raw", "base", cave_refs.alias("external_refs"), F.concat(old_ids, F.array_except(new_ids, old_ids)).alias("object_ids"), (F.col("adds").isNotNull() | F.col("links").isNotNull()).alias("touched"))
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return Review(union(applied), union(issues), o, c, reviewed_at, reviewed_by)


def finalized(record: Column, rows: DataFrame) -> Column:
    """A proposal as a final record: its note, and those of its measurements."""
    note = record["notes"]
    for source in SOURCES:
        note = F.when(F.col("source") == source, final_note(record["notes"], STAGED_PROPOSAL.format(source), FINAL_PROPOSAL.format(source))).otherwise(note)
    out = record.withField("notes", note)
    [kind] = [t for n, t in rows.dtypes if n in ("object", "cave")]
    return out.withField("measurements", F.transform(record["measurements"], final_measurement)) if "measurements" in kind else out


def _plain(value: object) -> object:
    if isinstance(value, Row):
        return {k: _plain(v) for k, v in value.asDict().items() if not (v is None and k in ("url", "observed_at"))}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def changed_records(review: Review) -> list[tuple[str, dict]]:
    """(path below the data folder, record) of each changed record: caves, then objects, by id.

    A record that exists keeps its keys, their order and unknown fields; only what changed is put in.
    """
    out = []
    for kind, df in (("cave", review.caves), ("object", review.objects)):
        for r in df.orderBy("key").toLocalIterator():
            data = json.loads(r.raw) if r.raw else _plain(r.base)
            refs = _plain(r.external_refs)
            data["external_refs"] = data.get("external_refs") or []
            data["external_refs"] += refs[len(data["external_refs"]) :]
            if kind == "cave":
                data["object_ids"] = list(r.object_ids)
                path = f"caves/{r.key}.yml"
            else:
                data["measurements"] = data.get("measurements") or []
                data["measurements"] += _plain(r.measurements)[len(data["measurements"]) :]
                data["cave_id"] = r.cave_id
                if r.best:
                    data["best_measurement"] |= {"measurement_id": r.best, "updated_at": review.reviewed_at, "updated_by": review.reviewed_by}
                path = f"objects/{r.key.split('-', 1)[0]}/{r.key}.yml"
            if r.touched:
                data |= {"updated_at": review.reviewed_at, "updated_by": review.reviewed_by}
            out.append((path, data))
    return out


def write_review(review: Review, data_folder: str) -> list[Path]:
    """The changed records as YAML; none if the review has errors."""
    if review.has_errors():
        return []
    paths = []
    for path, data in changed_records(review):
        target = Path(data_folder) / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(yaml.safe_dump(data, sort_keys=False, allow_unicode=True), encoding="utf-8")
        paths.append(target)
    return paths


def review_report(review: Review, data_folder: str, written: list[Path]) -> dict:
    """The content of the review's report."""
    applied = [r.asDict() for r in review.applied.orderBy("decision_index").collect()]
    issues = [r.asDict() for r in review.issues.orderBy("decision_index", "code").collect()]
    return {
        "reviewed_at": review.reviewed_at, "reviewed_by": review.reviewed_by, "data_dir": data_folder, "decision_count": len(applied), "issue_count": len(issues),
        "has_errors": any(i["severity"] == "error" for i in issues), "status_counts": {s: sum(a["status"] == s for a in applied) for s in ("materialized", "skipped")},
        "decisions": applied, "issues": issues, "written_paths": [str(p) for p in written],
    }
