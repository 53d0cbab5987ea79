"""Registered queries that apply a log of decisions, one for each part, to the sample catalogue, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import review
from ..operators.refs import reference_key
from ..sources.schemas import CAVE, MEASUREMENT, OBJECT, REF
from .catalog_queries import Query
from .sample_catalog import FLAT_SQL, OBJECT_ID, WHEN, _sql, audited
from .staging import STAGING_ROW, UPDATE, struct_of
from .staging_queries import clean_catalog

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The log: what each part's decision asks for. Keys of the catalogue come from remainders, so targets repeat.
LOG = """
SELECT p_partkey AS k, p_partkey + 1 AS decision_index, TRUE AS is_mapping,
  CASE p_partkey % 10 WHEN 0 THEN 'create_cave' WHEN 1 THEN ' create_cave ' WHEN 2 THEN 'create_object' WHEN 3 THEN 'add_measurement' WHEN 4 THEN 'add_measurement' WHEN 5 THEN 'link_cave' WHEN 6 THEN 'reject' WHEN 7 THEN 'unresolved' WHEN 8 THEN 'noop' ELSE 'create_cave' END AS action,
  CASE p_partkey % 10 WHEN 3 THEN 'tpn' WHEN 7 THEN 'TPN' WHEN 9 THEN CASE WHEN p_partkey % 20 = 9 THEN 'XXX' ELSE 'PIG' END ELSE 'pig' END AS source,
  CASE p_partkey % 10 WHEN 1 THEN CAST(p_partkey AS {text}) WHEN 7 THEN CAST(p_partkey + 1000000000 AS {text}) WHEN 9 THEN 'none' ELSE CAST(p_partkey + 1 AS {text}) END AS record_number,
  CASE WHEN p_partkey % 10 = 5 AND p_partkey % 3 <> 0 THEN {linked} END AS object_id, CASE WHEN p_partkey % 10 = 5 THEN 'C-0005' END AS cave_id,
  CAST(NULL AS {text}) AS target_object_id, CAST(NULL AS {text}) AS target_cave_id, CASE WHEN p_partkey % 4 = 0 THEN 'not a cave' END AS reason, {target} AS t_object, 'm-x' || CAST(p_partkey % 40 AS {text}) AS mid
FROM part
"""


def _log(text: str) -> str:
    return LOG.format(text=text, linked=OBJECT_ID.format(k="(p_partkey % 200)", text=text), target=OBJECT_ID.format(k="(p_partkey % 100)", text=text))


def register(sql: str):  # noqa: ANN201
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def sample_review(spark: SparkSession, sf_dir: str) -> review.Review:
    """The log, with reports in which some proposals and updates are missing."""
    log, c = _sql(spark, sf_dir, "part", _log("STRING")), F.col
    none = F.array().cast(f"array<{REF}>")
    row = struct_of(STAGING_ROW, record_number=c("decision_index"), cave_id=F.concat(F.lit("C-"), (c("k") + 50000).cast("string")), object_id=F.concat(F.lit("KSW-"), (c("k") + 50000).cast("string")))
    rows = log.select(c("k").alias("pos"), row.alias("r"), "k")
    cave = audited(CAVE, schema_version=F.lit(1), id=c("r.cave_id"), name=F.lit("new"), external_refs=none, object_ids=F.array().cast("array<string>"), notes=F.lit(review.STAGED_PROPOSAL.format("PIG") + " More."))
    measurement = lambda mid, source: audited(MEASUREMENT, id=mid, source=F.lit(source), verification_status=F.lit("nieweryfikowany"), observed_date=F.lit("2030-01-01"), horizontal_accuracy_m=F.lit(1.0), tags=F.array(F.lit("staging"), F.lit("x")))
    made = audited(OBJECT, schema_version=F.lit(1), id=c("r.object_id"), category=F.lit("sztolnia"), cave_id=c("r.cave_id"), external_refs=none, measurements=F.array(measurement(F.lit("m-001"), "PIG")), best_measurement=F.struct(F.lit("auto").alias("mode"), F.lit("m-001").alias("measurement_id"), *(F.lit(None).cast("string").alias(n) for n in ("reason", "updated_at", "updated_by"))))
    of = lambda df, value: df.select("pos", value.alias("v")).select("pos", "v.*")
    update = struct_of(
        UPDATE, record_number=c("decision_index"), target_object_id=c("t_object"), target_cave_id=F.lit("C-0003"), measurement=measurement(c("mid"), "TPN"),
        object_external_refs=F.array(struct_of(REF, system=F.lit("TPN"), ref_type=F.lit("source_globalid"), external_id=F.concat(F.lit("{u"), c("k").cast("string"), F.lit("}")))),
        cave_external_refs=F.array(struct_of(REF, system=F.lit("NR_INWENT"), ref_type=F.lit("inventory_number"), external_id=F.concat(F.lit("U"), (c("k") % 5).cast("string")))),
    )
    lost = lambda schema: of(rows.limit(0), struct_of(schema))
    tpn_row = struct_of(STAGING_ROW, record_number=c("decision_index"), globalid=F.concat(F.lit("{t"), c("k").cast("string"), F.lit("}")))
    # What the reports lack: every seventh proposal or update.
    present = lambda df, rest: of(df, F.when(c("k") % 7 != rest[0], rest[1])).where(f"{rest[2]} is not null")
    reports = {
        "PIG": {"rows": of(rows, c("r")), "proposed_caves": present(rows, (3, cave, "id")), "proposed_objects": present(rows, (4, made, "id")), "matched_measurements": lost(UPDATE)},
        "TPN": {"rows": of(log.withColumn("pos", c("k")), tpn_row), "proposed_caves": lost(CAVE), "proposed_objects": lost(OBJECT), "matched_measurements": present(log.withColumn("pos", c("k")), (5, update, "record_number"))},
    }
    fields = [f.split(" ")[0] for f in review.DECISION.split(", ")]
    return review.apply_review(spark, clean_catalog(spark, sf_dir), log.select("decision_index", "is_mapping", *fields), reports, WHEN, "reviewer")


REVIEW_SQL = f"""{FLAT_SQL}, d AS ({_log("VARCHAR")}), keys AS (SELECT stem FROM o),
adds AS (SELECT *, row_number() OVER (PARTITION BY t_object, mid ORDER BY k) AS turn FROM d WHERE k % 10 = 3 AND k % 7 <> 5 AND t_object IN (SELECT stem FROM keys)),
links AS (SELECT * FROM d WHERE k % 10 = 5 AND object_id IN (SELECT stem FROM keys)),
log AS (
  SELECT decision_index, 'DECISION_ACTION_INVALID' AS what, 'unsupported action noop' AS description FROM d WHERE k % 10 = 8
  UNION ALL SELECT decision_index, 'DECISION_SOURCE_INVALID', 'the source must be PIG or TPN' FROM d WHERE k % 20 = 9
  UNION ALL SELECT decision_index, 'DECISION_RECORD_INVALID', 'the record number must be a positive integer' FROM d WHERE k % 10 = 9
  UNION ALL SELECT decision_index, CASE WHEN (k - k % 10) % 7 = 3 THEN 'STAGING_CAVE_PROPOSAL_MISSING' WHEN k % 10 = 1 THEN 'CAVE_ALREADY_EXISTS' ELSE 'materialized' END,
    CASE WHEN (k - k % 10) % 7 = 3 THEN 'no proposal in PIG row ' || (k - k % 10 + 1) WHEN k % 10 = 1 THEN 'C-' || (k + 49999) || ' exists already' ELSE 'created cave C-' || (k + 50000) END FROM d WHERE k % 10 < 2
  UNION ALL SELECT decision_index, CASE WHEN k % 7 = 4 THEN 'STAGING_OBJECT_PROPOSAL_MISSING' ELSE 'materialized' END, CASE WHEN k % 7 = 4 THEN 'no proposal in PIG row ' || (k + 1) ELSE 'created object KSW-' || (k + 50000) END FROM d WHERE k % 10 = 2
  UNION ALL SELECT decision_index, 'STAGING_MEASUREMENT_UPDATE_MISSING', 'no update in row ' || (k + 1) FROM d WHERE k % 10 = 3 AND k % 7 = 5
  UNION ALL SELECT decision_index, 'TARGET_OBJECT_MISSING', 'no object ' || t_object FROM d WHERE k % 10 = 3 AND k % 7 <> 5 AND t_object NOT IN (SELECT stem FROM keys)
  UNION ALL SELECT decision_index, CASE turn WHEN 1 THEN 'materialized' ELSE 'MEASUREMENT_ALREADY_EXISTS' END, CASE turn WHEN 1 THEN 'added ' || mid || ' to ' || t_object ELSE t_object || ' has ' || mid || ' already' END FROM adds
  UNION ALL SELECT decision_index, 'MEASUREMENT_SOURCE_UNSUPPORTED', 'only TPN rows have measurement updates' FROM d WHERE k % 10 = 4
  UNION ALL SELECT decision_index, 'LINK_CAVE_TARGET_MISSING', 'a link needs an object and a cave' FROM d WHERE k % 10 = 5 AND object_id IS NULL
  UNION ALL SELECT decision_index, 'LINK_OBJECT_MISSING', 'no object ' || object_id FROM d WHERE k % 10 = 5 AND object_id NOT IN (SELECT stem FROM keys)
  UNION ALL SELECT decision_index, 'materialized', 'linked ' || object_id || ' with C-0005' FROM links
  UNION ALL SELECT decision_index, 'skipped', coalesce(reason, 'No reason provided.') FROM d WHERE k % 10 = 6
  UNION ALL SELECT decision_index, 'DECISION_REASON_MISSING', 'reject without a reason' FROM d WHERE k % 10 = 6 AND reason IS NULL
  UNION ALL SELECT decision_index, 'STAGING_ROW_MISSING', 'no TPN row ' || (k + 1000000000) FROM d WHERE k % 10 = 7
)
"""


@register(f"{REVIEW_SQL} SELECT * FROM log")
def review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was applied, and the issues."""
    found = sample_review(spark, sf_dir)
    return found.applied.select("decision_index", F.col("status").alias("what"), "description").unionByName(found.issues.select("decision_index", F.col("code").alias("what"), "description"))


@register(f"""{REVIEW_SQL}, more AS (SELECT t_object AS stem, count(*) AS n FROM adds WHERE turn = 1 GROUP BY 1), linked AS (SELECT object_id AS stem FROM links GROUP BY 1),
own AS (SELECT k, count(*) AS n FROM m GROUP BY 1),
every AS (SELECT o.stem, r.mid, r.p, r.day, r.accuracy FROM ranked r JOIN o ON o.k = r.k UNION ALL SELECT t_object, mid, 2 - 1, '2030-01-01', 1.0 FROM adds WHERE turn = 1),
chosen AS (SELECT stem, mid FROM every QUALIFY row_number() OVER (PARTITION BY stem ORDER BY p, day DESC, coalesce(accuracy, 'inf'::DOUBLE), mid) = 1)
SELECT o.stem AS key, coalesce(own.n, 0) + coalesce(more.n, 0) AS n_measurements, (tpn IS NOT NULL)::INT + (nr IS NOT NULL)::INT + (pig IS NOT NULL)::INT + coalesce(more.n, 0) AS n_refs,
  CASE WHEN more.n > 0 AND best_mode = 'auto' THEN chosen.mid END AS best, CASE WHEN linked.stem IS NOT NULL THEN 'C-0005' ELSE o.cave_id END AS cave_id, TRUE AS touched, CAST(NULL AS VARCHAR) AS first_notes
FROM o LEFT JOIN more USING (stem) LEFT JOIN linked USING (stem) LEFT JOIN own ON own.k = o.k LEFT JOIN chosen USING (stem) WHERE more.n > 0 OR linked.stem IS NOT NULL
UNION ALL SELECT 'KSW-' || (k + 50000), 1, 0, NULL, 'C-' || (k + 50000), FALSE, 'x' FROM d WHERE k % 10 = 2 AND k % 7 <> 4
""")
def review_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed and new objects; of new ones the tags of the measurement, without that of the staging."""
    tags = F.when(F.col("raw").isNull(), F.array_join(F.get("measurements", F.lit(0))["tags"], ","))
    return sample_review(spark, sf_dir).objects.select("key", F.size("measurements").alias("n_measurements"), F.size("external_refs").alias("n_refs"), "best", "cave_id", "touched", tags.alias("first_notes"))


@register(f"""{REVIEW_SQL}, refs AS (SELECT count(DISTINCT k % 5) AS n, count(*) AS adds FROM adds WHERE turn = 1), listed2 AS (SELECT list(DISTINCT object_id) AS ids FROM links),
base AS (SELECT *, CASE WHEN lists_lost THEN [listed, 'KSW-lost'] ELSE [listed] END AS ids FROM c)
SELECT id AS key, 1 + (nr IS NOT NULL)::INT + CASE WHEN id = 'C-0003' THEN (SELECT n FROM refs) ELSE 0 END AS n_refs, array_to_string(list_sort(CASE WHEN id = 'C-0005' THEN list_distinct(list_concat(ids, (SELECT coalesce(ids, []) FROM listed2))) ELSE ids END), ',') AS object_ids, TRUE AS touched, CAST(NULL AS VARCHAR) AS notes
FROM base WHERE (id = 'C-0003' AND (SELECT adds FROM refs) > 0) OR (id = 'C-0005' AND (SELECT ids FROM listed2) IS NOT NULL)
UNION ALL SELECT 'C-' || (k + 50000), 0, '', FALSE, '{review.FINAL_PROPOSAL.format("PIG")} More.' FROM d WHERE k % 10 = 0 AND k % 7 <> 3
""")
def review_caves(spark: SparkSession, sf_dir: str) -> DataFrame:
    caves = sample_review(spark, sf_dir).caves
    known = F.size(F.array_distinct(F.transform("external_refs", lambda r: reference_key(r))))
    return caves.select("key", known.alias("n_refs"), F.array_join(F.array_sort("object_ids"), ",").alias("object_ids"), "touched", F.when(F.col("raw").isNull(), F.col("base.notes")).alias("notes"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
