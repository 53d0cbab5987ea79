"""The relational snapshot: ten tables as DataFrames, written as Parquet or into a SQLite file."""

from __future__ import annotations

import sqlite3
import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import wkt_point
from ..operators.best import best_measurement_id, declared_measurement
from ..operators.materialize import mounted_folder
from ..sources.catalog import Catalog
from .export import dataset_counts
from .joined import part_path, put

SNAPSHOT_VERSION = "1"
_REFS = "system TEXT NOT NULL, ref_type TEXT NOT NULL, external_id TEXT NOT NULL, url TEXT, scope TEXT, notes TEXT"
_AUDIT = "notes TEXT, created_at TEXT NOT NULL, created_by TEXT NOT NULL, updated_at TEXT NOT NULL, updated_by TEXT NOT NULL"
_OF_OBJECT = "object_id TEXT NOT NULL REFERENCES objects(id) ON DELETE CASCADE"
# Columns of the published tables, in order.
TABLES = {
    "metadata": "key TEXT PRIMARY KEY, value TEXT NOT NULL",
    "caves": f"id TEXT PRIMARY KEY, schema_version INTEGER NOT NULL, name TEXT NOT NULL, system_name TEXT, object_ids_json TEXT NOT NULL, {_AUDIT}",
    "objects": f"id TEXT PRIMARY KEY, schema_version INTEGER NOT NULL, category TEXT NOT NULL, name_local TEXT, cave_id TEXT REFERENCES caves(id), id_assignment_method TEXT NOT NULL, assigned_from_measurement_id TEXT NOT NULL, assigned_prefix TEXT NOT NULL, prefix_override_reason TEXT, best_measurement_id TEXT NOT NULL, computed_best_measurement_id TEXT, best_lat REAL, best_lon REAL, best_x_1992 REAL, best_y_1992 REAL, best_geom_wgs84 TEXT, best_geom_1992 TEXT, {_AUDIT}",
    "measurements": f"{_OF_OBJECT}, id TEXT NOT NULL, lat REAL NOT NULL, lon REAL NOT NULL, x_1992 REAL NOT NULL, y_1992 REAL NOT NULL, geom_wgs84 TEXT NOT NULL, geom_1992 TEXT NOT NULL, elevation_m REAL, elevation_datum TEXT, elevation_source TEXT, horizontal_accuracy_m REAL, vertical_accuracy_m REAL, source TEXT NOT NULL, source_ref TEXT, observed_at TEXT, observed_date TEXT NOT NULL, source_date TEXT, method TEXT NOT NULL, device TEXT, tags_json TEXT NOT NULL, verification_status TEXT NOT NULL, verified_by TEXT, verified_at TEXT, notes TEXT, created_at TEXT NOT NULL, created_by TEXT NOT NULL, PRIMARY KEY (object_id, id)",
    "object_external_refs": f"rowid INTEGER PRIMARY KEY, {_OF_OBJECT}, {_REFS}",
    "cave_external_refs": f"rowid INTEGER PRIMARY KEY, cave_id TEXT NOT NULL REFERENCES caves(id) ON DELETE CASCADE, {_REFS}",
    "attachments": f"{_OF_OBJECT}, id TEXT NOT NULL, kind TEXT NOT NULL, measurement_id TEXT, path TEXT NOT NULL, caption TEXT, date TEXT, created_at TEXT NOT NULL, created_by TEXT NOT NULL, PRIMARY KEY (object_id, id)",
    "relations": "id TEXT PRIMARY KEY, schema_version INTEGER NOT NULL, from_object_id TEXT NOT NULL REFERENCES objects(id), to_object_id TEXT NOT NULL REFERENCES objects(id), relation_type TEXT NOT NULL, notes TEXT",
    "best_measurements": "object_id TEXT PRIMARY KEY REFERENCES objects(id) ON DELETE CASCADE, mode TEXT NOT NULL, measurement_id TEXT NOT NULL, computed_best_measurement_id TEXT, reason TEXT, updated_at TEXT NOT NULL, updated_by TEXT NOT NULL",
    "validation_flags": "rowid INTEGER PRIMARY KEY, code TEXT NOT NULL, severity TEXT NOT NULL, path TEXT, description TEXT NOT NULL",
}
INDEXES = {
    "idx_measurements_object_id": "measurements(object_id)",
    "idx_measurements_source": "measurements(source)",
    "idx_object_external_refs_lookup": "object_external_refs(system, ref_type, external_id)",
    "idx_cave_external_refs_lookup": "cave_external_refs(system, ref_type, external_id)",
    "idx_relations_from_object": "relations(from_object_id)",
    "idx_relations_to_object": "relations(to_object_id)",
}
#: Order of rows in the file, so that equal inputs give equal files.
ORDER = {"metadata": ["key"], "measurements": ["object_id", "id"], "attachments": ["object_id", "id"], "best_measurements": ["object_id"], "validation_flags": ["family", "path", "code", "description"]}


def json_text(value: Column) -> Column:
    """JSON of a list of texts, with a space after each comma."""
    quoted = F.transform(value, lambda v: F.regexp_extract(F.to_json(F.array(v)), r"(?s)^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def columns_of(table: str) -> list[str]:
    parts = [p.strip().split(" ")[0] for p in TABLES[table].split(", ") if not p.startswith("PRIMARY KEY")]
    return [p for p in parts if p not in ("rowid", "id)")]


def snapshot_tables(spark: SparkSession, catalog: Catalog, issues: DataFrame, generated_at: str) -> dict[str, DataFrame]:
    """The tables by name; all are lazy but the counts in metadata."""
    n = dataset_counts(catalog, issues)
    meta = {"generated_at": generated_at, "schema_version": SNAPSHOT_VERSION, "object_count": n["objects"], "cave_count": n["caves"], "relation_count": n["relations"], "measurement_count": n["measurements"], "validation_warning_count": n["validation_warnings"], "validation_error_count": n["validation_errors"]}
    objects, best = catalog.objects, F.col("best_measurement")
    rows = objects.withColumn("m", declared_measurement(F.col("measurements"), best["measurement_id"])).withColumn("computed_best_measurement_id", best_measurement_id(F.col("measurements")))
    wide = rows.select(
        "*", F.col("id_assignment.method").alias("id_assignment_method"), "id_assignment.assigned_from_measurement_id", "id_assignment.assigned_prefix", "id_assignment.prefix_override_reason",
        best["measurement_id"].alias("best_measurement_id"), *(F.col(f"m.{c}").alias(f"best_{c}") for c in ("lat", "lon", "x_1992", "y_1992")),
        wkt_point(F.col("m.lon"), F.col("m.lat")).alias("best_geom_wgs84"), wkt_point(F.col("m.y_1992"), F.col("m.x_1992")).alias("best_geom_1992"),
    )
    measured = objects.select(F.col("id").alias("object_id"), F.explode("measurements").alias("m")).select("object_id", "m.*")
    measured = measured.withColumn("geom_wgs84", wkt_point(F.col("lon"), F.col("lat"))).withColumn("geom_1992", wkt_point(F.col("y_1992"), F.col("x_1992"))).withColumn("tags_json", json_text(F.col("tags")))
    out = {
        "metadata": spark.createDataFrame([(k, str(v)) for k, v in sorted(meta.items())], "key string, value string"),
        "caves": catalog.caves.withColumn("object_ids_json", json_text(F.col("object_ids"))),
        "objects": wide,
        "measurements": measured,
        "object_external_refs": objects.select(F.col("id").alias("object_id"), F.explode("external_refs").alias("r")).select("object_id", "r.*"),
        "cave_external_refs": catalog.caves.select(F.col("id").alias("cave_id"), F.explode("external_refs").alias("r")).select("cave_id", "r.*"),
        "attachments": objects.select(F.col("id").alias("object_id"), F.explode("attachments").alias("a")).select("object_id", "a.*"),
        "relations": catalog.relations,
        "best_measurements": rows.select(F.col("id").alias("object_id"), "best_measurement.mode", "best_measurement.measurement_id", "computed_best_measurement_id", "best_measurement.reason", "best_measurement.updated_at", "best_measurement.updated_by"),
        "validation_flags": issues,
    }
    return {name: df.select(*columns_of(name), *(c for c in ORDER.get(name, []) if c not in columns_of(name))) for name, df in out.items()}


def write_parquet(tables: dict[str, DataFrame], folder: str) -> None:
    """One folder for each table: the form for catalogues of any size."""
    for name, df in tables.items():
        df.select(*columns_of(name)).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def write_sqlite(tables: dict[str, DataFrame], path: str) -> None:
    """A SQLite file, swapped in whole: tasks write the sorted rows into SQLite files of their own, from which one task fills the file, as it has one writer."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    spark = next(iter(tables.values())).sparkSession
    folder = mounted_folder(spark, "sqlite")
    parts: dict[str, list[Path]] = {}
    for name in TABLES:
        names = columns_of(name)
        rows = tables[name].orderBy(*ORDER.get(name, names[:1] if name not in ("object_external_refs", "cave_external_refs") else names)).select(*names)
        parts[name] = sqlite_parts(rows, name, folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            draft = folder / f"{uuid.uuid4().hex}.sqlite"
            fill_sqlite(parts, draft)
            yield pd.DataFrame({"draft": [str(draft)] * len(b)})

    [made] = spark.range(0, 1, 1, 1).mapInPandas(run, "draft string").collect()
    put(Path(made.draft), target)


def sqlite_parts(rows: DataFrame, name: str, folder: Path) -> list[Path]:
    """SQLite files of successive rows of one table, without its keys, as the tasks that hold the rows write them."""
    types = dict(p.split(" ")[:2] for p in TABLES[name].split(", ") if " " in p)
    columns = columns_of(name)
    made = f"CREATE TABLE part ({', '.join(f'{c} {types[c]}' for c in columns)})"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, db = TaskContext.get(), None
        path = part_path(folder, task.partitionId(), task.taskAttemptId(), f"{name}.sqlite")
        for b in batches:
            if db is None:
                db = open_sqlite(path)
                db.execute(made)
                db.execute("BEGIN")
            db.executemany(f"INSERT INTO part VALUES ({', '.join('?' * len(columns))})", zip(*map(plain_values, b.columns), strict=True))
        if db is not None:
            db.execute("COMMIT")
            db.close()
            yield pa.RecordBatch.from_pydict({"place": [task.partitionId()], "path": [str(path)]})

    return [Path(r.path) for r in sorted(rows.mapInArrow(run, "place long, path string").collect())]


def plain_values(column: pa.Array) -> list:
    """The values of a column as SQLite takes them; null numbers may come as NaN, which it takes for null."""
    return column.to_pylist() if column.null_count and pa.types.is_integer(column.type) else column.to_numpy(zero_copy_only=False).tolist()


def open_sqlite(path: Path) -> sqlite3.Connection:
    db = sqlite3.connect(path, isolation_level=None)
    for pragma in ("foreign_keys = ON", "journal_mode = OFF", "synchronous = OFF"):
        db.execute(f"PRAGMA {pragma}")
    return db


def fill_sqlite(parts: dict[str, list[Path]], draft: Path) -> None:
    """A SQLite file of the tables, whose rows SQLite itself copies from their parts, one after the other."""
    db = open_sqlite(draft)
    try:
        for name, columns in TABLES.items():
            db.execute(f"CREATE TABLE {name} ({columns})")
        for name in TABLES:
            names = ", ".join(columns_of(name))
            for file in parts[name]:
                db.execute("ATTACH ? AS other", (str(file),))
                db.execute(f"INSERT INTO main.{name} ({names}) SELECT {names} FROM other.part ORDER BY rowid")
                db.execute("DETACH other")
        for name, on in INDEXES.items():
            db.execute(f"CREATE INDEX {name} ON {on}")
    finally:
        db.close()
