"""Candidates for matching: final objects with their caves, and proposals of a staging report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import next_measurement_id
from ..functions.text import clean, normalize_name
from ..sources.catalog import Catalog
from .best import candidate_measurement
from .refs import first_reference_id, reference_ids

COLUMNS = ["origin", "object_id", "cave_id", "nr", "name", "name_norm", "globalids", "next_measurement_id", "x", "y"]


def final_candidates(catalog: Catalog) -> DataFrame:
    """One row for each final object. Its cave is the one it names, else the first cave by path that lists it."""
    caves = catalog.caves.select(F.col("id").alias("cave"), "path", F.col("name").alias("cave_name"), first_reference_id(F.col("external_refs"), "NR_INWENT").alias("nr"), "object_ids")
    listed = caves.select(F.explode("object_ids").alias("object_id"), "cave", "path").groupBy("object_id").agg(F.min_by("cave", "path").alias("listing_cave"))
    own = caves.groupBy("cave").agg(F.max_by(F.struct("cave_name", "nr"), "path").alias("c"))
    o = catalog.objects.select(F.col("id").alias("object_id"), F.nullif(clean(F.col("cave_id")), F.lit("")).alias("named_cave"), "name_local", "external_refs", "measurements", "best_measurement")
    o = o.join(listed, "object_id", "left").withColumn("cave_id", F.coalesce("named_cave", "listing_cave")).join(own, F.col("cave_id") == F.col("cave"), "left")
    m = candidate_measurement(F.col("measurements"), F.col("best_measurement.measurement_id"))
    name = F.coalesce(F.nullif(clean(F.col("name_local")), F.lit("")), F.col("c.cave_name"))
    return o.select(
        F.lit("final").alias("origin"), "object_id", "cave_id", F.col("c.nr").alias("nr"), name.alias("name"), normalize_name(name).alias("name_norm"),
        reference_ids(F.col("external_refs"), "TPN").alias("globalids"), next_measurement_id(F.transform("measurements", lambda x: x["id"])).alias("next_measurement_id"),
        m["x_1992"].alias("x"), m["y_1992"].alias("y"),
    )


def staged_candidates(rows: DataFrame, proposals: DataFrame) -> DataFrame:
    """Proposed objects of a staging report joined with their rows (object_id, cave_id, nr_inwent, name)."""
    r = rows.where("object_id is not null").select("object_id", F.col("cave_id").alias("row_cave"), F.col("nr_inwent").alias("nr"), F.col("name").alias("row_name"))
    p = proposals.select(F.col("id").alias("object_id"), "name_local", "external_refs", "measurements", "best_measurement")
    m = candidate_measurement(F.col("measurements"), F.col("best_measurement.measurement_id"))
    name = F.coalesce("name_local", "row_name")
    return p.join(r, "object_id").select(
        F.lit("pig_staging").alias("origin"), "object_id", F.col("row_cave").alias("cave_id"), "nr", name.alias("name"), normalize_name(name).alias("name_norm"),
        reference_ids(F.col("external_refs"), "TPN").alias("globalids"), next_measurement_id(F.transform("measurements", lambda x: x["id"])).alias("next_measurement_id"),
        m["x_1992"].alias("x"), m["y_1992"].alias("y"),
    )
