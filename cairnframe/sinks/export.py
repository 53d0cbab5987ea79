"""Rows of the release: the best measurement of each object with its cave, in the published column order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_values
from ..operators.best import best_measurement_id, declared_measurement
from ..operators.refs import pig_urls, reference_ids, tpn_globalids
from ..sources.catalog import Catalog

# Names and order of the published columns.
COLUMNS = [
    "object_id", "category", "name_local", "cave_id", "measurement_id", "best_mode", "computed_best_measurement_id", "best_reason",
    "lat", "lon", "x_1992", "y_1992", "elevation_m", "source", "source_ref", "nr_inwent", "pig_id", "pig_url", "tpn_globalid",
    "observed_at", "observed_date", "method", "verification_status", "horizontal_accuracy_m", "vertical_accuracy_m",
    "object_notes", "cave_notes", "measurement_notes",
]


def best_rows(catalog: Catalog) -> DataFrame:
    """One row for each object. An object whose declared measurement does not exist fails the query."""
    caves = catalog.caves.groupBy("id").agg(F.max_by(F.struct("external_refs", "notes"), "path").alias("c"))
    caves = caves.select(F.col("id").alias("cave_key"), "c.external_refs", F.col("c.notes").alias("cave_notes"))
    rows = catalog.objects.withColumn("m", declared_measurement(F.col("measurements"), F.col("best_measurement.measurement_id")))
    rows = rows.withColumn("m", F.when(F.col("m").isNull(), F.raise_error(F.concat(F.lit("no declared measurement in "), F.col("id")))).otherwise(F.col("m")))
    o = rows.select(
        F.col("id").alias("object_id"), "category", "name_local", "cave_id", "m", "best_measurement",
        best_measurement_id(F.col("measurements")).alias("computed_best_measurement_id"),
        joined_values(tpn_globalids(F.col("external_refs"), F.col("measurements"))).alias("tpn_globalid"),
        F.col("notes").alias("object_notes"),
    ).join(caves, F.col("cave_id") == F.col("cave_key"), "left")
    refs = F.col("external_refs")
    shown: dict[str, Column] = {
        "measurement_id": F.col("m.id"), "best_mode": F.col("best_measurement.mode"), "best_reason": F.col("best_measurement.reason"),
        "nr_inwent": joined_values(reference_ids(refs, "NR_INWENT")), "pig_id": joined_values(reference_ids(refs, "PIG", "catalog_id")), "pig_url": joined_values(pig_urls(refs)),
        "measurement_notes": F.col("m.notes"),
    }
    own = {"object_id", "category", "name_local", "cave_id", "computed_best_measurement_id", "tpn_globalid", "object_notes", "cave_notes"}
    return o.select(*(shown[c].alias(c) if c in shown else F.col(c if c in own else f"m.{c}").alias(c) for c in COLUMNS))


def dataset_counts(catalog: Catalog, issues: DataFrame) -> dict[str, int]:
    """Counts of records and issues: one row from each table comes to the driver."""
    objects = catalog.objects.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("measurements")), F.lit(0)).alias("m")).first()
    flags = issues.agg(F.count_if(F.col("severity") == "warning").alias("w"), F.count_if(F.col("severity") == "error").alias("e")).first()
    return {"objects": objects.n, "caves": catalog.caves.count(), "relations": catalog.relations.count(), "measurements": objects.m, "validation_warnings": flags.w, "validation_errors": flags.e}
