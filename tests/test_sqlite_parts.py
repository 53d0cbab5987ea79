"""The SQLite file from parts that tasks write."""

import math
import sqlite3

import pytest
from pyspark.sql import functions as F

from cairnframe.sinks import snapshot


def caves(spark, n):
    return spark.range(n).select(F.format_string("C-%04d", "id").alias("id"), F.lit(1).alias("schema_version"), F.concat(F.lit("jaskinia ż "), "id").alias("name"), F.when(F.col("id") % 3 == 0, "s").alias("system_name"), F.lit("[]").alias("object_ids_json"), F.when(F.col("id") % 2 == 0, "n").alias("notes"), *(F.lit("t").alias(c) for c in ("created_at", "created_by", "updated_at", "updated_by")))


def test_rows_of_many_tasks_make_one_table_in_order(spark, tmp_path):
    rows = caves(spark, 500)
    parts = snapshot.sqlite_parts(rows.repartitionByRange(7, "id").sortWithinPartitions("id").select(*snapshot.columns_of("caves")), "caves", tmp_path)
    assert len(parts) == 7
    snapshot.fill_sqlite({n: parts if n == "caves" else [] for n in snapshot.TABLES}, tmp_path / "c.sqlite")
    db = sqlite3.connect(tmp_path / "c.sqlite")
    assert db.execute("SELECT * FROM caves ORDER BY rowid").fetchall() == [tuple(r) for r in rows.orderBy("id").collect()]
    assert db.execute("SELECT typeof(schema_version), count(*) FROM caves GROUP BY 1").fetchall() == [("integer", 500)]
    assert {r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'index'")} >= set(snapshot.INDEXES)


def test_references_and_keys_are_checked(spark, tmp_path):
    relations = spark.createDataFrame([("R-1", 1, "KA-1", "KA-2", "k", None)], "id string, schema_version int, from_object_id string, to_object_id string, relation_type string, notes string")
    parts = {n: [] for n in snapshot.TABLES} | {"relations": snapshot.sqlite_parts(relations, "relations", tmp_path)}
    with pytest.raises(sqlite3.IntegrityError, match="FOREIGN KEY"):
        snapshot.fill_sqlite(parts, tmp_path / "a.sqlite")
    twice = snapshot.sqlite_parts(caves(spark, 2).unionByName(caves(spark, 2)).coalesce(1), "caves", tmp_path)
    with pytest.raises(sqlite3.IntegrityError, match="UNIQUE"):
        snapshot.fill_sqlite({n: twice if n == "caves" else [] for n in snapshot.TABLES}, tmp_path / "b.sqlite")


def test_values(spark):
    rows = spark.createDataFrame([(1, 1 << 60, 0.5, "a", True), (2, None, None, None, None), (3, 7, math.nan, "", False)], "k long, n long, x double, s string, b boolean").orderBy("k").toArrow()
    n, x, s, b = (snapshot.plain_values(rows[c].combine_chunks()) for c in ("n", "x", "s", "b"))
    assert n == [1 << 60, None, 7] and s == ["a", None, ""] and b == [True, None, False]
    assert sqlite3.connect(":memory:").execute("SELECT ?, ?, ?", x).fetchone() == (0.5, None, None)
