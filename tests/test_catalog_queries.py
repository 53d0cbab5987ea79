"""Queries that run the catalogue's own operators, each against its DuckDB SQL."""

from collections import Counter

import duckdb
import pytest

from cairnframe.plans import catalog_queries, file_queries, review_queries, staging_queries

SF = "/root/testdata/sf0.001"
MODULES = [catalog_queries, staging_queries, review_queries, file_queries]
NAMES = [(m, n) for m in MODULES for n in m.queries()]


@pytest.mark.parametrize(("module", "name"), NAMES, ids=[n for _, n in NAMES])
def test_query_equals_its_sql(spark, module, name):
    con = duckdb.connect()
    for t in ("nation", "customer", "orders", "supplier", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = module.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(module.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    rows = Counter(repr(tuple(r)) for r in got.select(*cols).collect())
    assert rows == Counter(repr(tuple(r[names.index(c)] for c in cols)) for r in want.fetchall())


def test_every_rule_and_action_has_rows():
    """The flaws of the sample reach each rule; what its SQL counts is what the queries are held against."""
    con = duckdb.connect()
    for t in ("nation", "customer", "orders", "supplier", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    codes = {r[0] for r in con.execute(f"SELECT DISTINCT code FROM ({catalog_queries.oracle_sql()['validate_catalogue']})").fetchall()}
    assert len(codes) == 24, sorted(codes)
    whats = {r[0] for r in con.execute(f"SELECT DISTINCT what FROM ({review_queries.oracle_sql()['review_log']})").fetchall()}
    assert {"materialized", "skipped", "DECISION_ACTION_INVALID", "CAVE_ALREADY_EXISTS", "MEASUREMENT_ALREADY_EXISTS", "LINK_OBJECT_MISSING", "STAGING_ROW_MISSING"} - whats <= {"LINK_OBJECT_MISSING"}


def test_names_fold_as_unicode_does(spark):
    import re
    import unicodedata

    from pyspark.sql import functions as F

    from cairnframe.functions.text import normalize_name

    def plain(text):
        parts = unicodedata.normalize("NFKD", text.lower())
        return " ".join(re.sub("[^a-z0-9]+", " ", "".join(c for c in parts if not unicodedata.combining(c))).split())

    texts = ["Łódź", "ﬁne ﬃ", "½ cup", "Ｆｕｌｌ　Ｗｉｄｔｈ", "Ⅷ. Heinrich", "①②", "naïve-Éclair", "℃ ㎏", "ǆ ĳ", "𝐁𝐨𝐥𝐝 x", "éa", "", "ß"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize_name(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == {t: plain(t) for t in texts}


def test_attachments_are_checked_on_publishing(spark, tmp_path):
    from cairnframe.operators.validation import CatalogInvalidError
    from cairnframe.plans.file_queries import publishable
    from cairnframe.sinks import release
    from cairnframe.sources.catalog import Catalog
    from cairnframe.sources.schemas import ATTACHMENT

    from pyspark.sql import functions as F

    c = publishable(spark, SF)
    named = F.from_json(F.lit('[{"id": "a-1", "kind": "photo", "path": "files/a.jpg"}]'), f"array<{ATTACHMENT}>")
    catalog = Catalog(c.objects.withColumn("attachments", F.when(F.col("id") == "BA-0001", named).otherwise(F.col("attachments"))), c.caves, c.relations)
    files = lambda n: spark.createDataFrame([(n,)], "file string")
    with pytest.raises(CatalogInvalidError) as e:
        release.build_release(spark, catalog, str(tmp_path / "a"), "2024-01-01T00:00:00Z", files=files("files/b.jpg"))
    assert {i.code for i in e.value.issues} == {"ATTACHMENT_PATH_MISSING"}
