"""Rows that cost more than their bytes tell are spread over all cores."""

import pytest

from cairnframe.operators.matching import match_cascade
from cairnframe.operators.materialize import SPREAD
from cairnframe.operators.resolver import constant_resolver
from cairnframe.plans import staging, staging_queries
from cairnframe.sources import catalog
from cairnframe.sources.catalog import Catalog
from cairnframe.sources.schemas import CAVE, OBJECT, RELATION


def test_a_table_of_one_file_is_worked_on_by_many_tasks(spark):
    table = staging_queries.pig_table(spark, "/root/testdata/sf0.001")
    assert table.rdd.getNumPartitions() == SPREAD * spark.sparkContext.defaultParallelism
    assert table.count() == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()


def test_small_files_share_tasks(spark, tmp_path):
    for k in range(100):
        (tmp_path / f"{k}.yml").write_text(f"id: {k}", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4194304")
    try:
        found = catalog.read_yaml_files(spark, f"file://{tmp_path}")
        assert found.rdd.getNumPartitions() <= SPREAD * spark.sparkContext.defaultParallelism
        assert sorted(r.raw for r in found.collect()) == sorted(f'{{"id": {k}}}' for k in range(100))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_of_the_second_registry_are_dealt(spark):
    """A table in one partition is read and placed by all cores."""
    table = spark.createDataFrame([(k, f"g{k}", "", f"n{k}", "145000,0", "555000,0") for k in range(400)], "record_number long, GLOBALID string, NR_INWENT string, NAZWA string, X1992 string, Y1992 string").coalesce(1)
    empty = Catalog(*(spark.createDataFrame([], f"path string, raw string, parse_error string, {s.removeprefix('struct<')[:-1]}") for s in (OBJECT, CAVE, RELATION)))
    seen = []

    def cascade(rows, *args):
        seen.append(rows.rdd.getNumPartitions())
        return match_cascade(rows, *args)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(staging, "match_cascade", cascade)
        found = staging.build_tpn_staging(table, empty, constant_resolver(), "2024-05-01T10:00:00Z")
    assert found.rows.where("status = 'new'").count() == 400
    assert seen[0] >= spark.sparkContext.defaultParallelism
