"""The catalogue's YAML records as typed DataFrames.

Files are listed and read by Spark, so any store works; each is parsed on an executor to canonical
JSON, from which Spark takes the typed columns. What was written is kept beside it (`raw`), as rules
on the raw record tell an absent key from a null one.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import SPREAD
from .schemas import KINDS


class CatalogLoadError(ValueError):
    """A record that can't be read; the load as a whole fails."""

    def __init__(self, path: str, message: str) -> None:
        super().__init__(f"{path}: {message}")
        self.path, self.message = path, message


@dataclass(frozen=True)
class Catalog:
    """Objects, caves and relations; each row has path, raw (JSON as written) and the record's columns."""

    objects: DataFrame
    caves: DataFrame
    relations: DataFrame

    def issues_of_reading(self) -> DataFrame:
        """(path, parse_error) of files that are no YAML mapping."""
        return reduce(DataFrame.unionByName, (d.where("parse_error is not null").select("path", "parse_error") for d in (self.objects, self.caves, self.relations)))

    def check(self) -> Catalog:
        """Itself, or the first reading error by path."""
        first = self.issues_of_reading().orderBy("path").first()
        if first is not None:
            raise CatalogLoadError(first.path, first.parse_error)
        return self


def to_json(value: object) -> str:
    def plain(x: object) -> str:
        if isinstance(x, (dt.datetime, dt.date)):
            return x.isoformat()
        raise TypeError(f"{type(x).__name__} in a record")

    return json.dumps(value, ensure_ascii=False, default=plain)


def parse_yaml(text: str) -> tuple[str | None, str | None]:
    """(JSON of the mapping, None) or (None, what is wrong)."""
    try:
        data = yaml.safe_load(text)
    except yaml.YAMLError as e:
        return None, f"invalid YAML: {' '.join(str(e).split())}"
    if not isinstance(data, dict):
        return None, "the root is no mapping"
    try:
        return to_json({str(k): v for k, v in data.items()}), None
    except TypeError as e:
        return None, f"unsupported value: {e}"


def read_yaml_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, raw, parse_error) of all *.yml and *.yaml below a folder; none if it does not exist."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parsed = [parse_yaml(bytes(x).decode("utf-8-sig", "replace")) for x in b["content"]]
            yield pd.DataFrame({"path": b["path"], "raw": [p[0] for p in parsed], "parse_error": [p[1] for p in parsed]})

    schema = "path string, raw string, parse_error string"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{yml,yaml}").load(folder)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    # Spark counts 4 MB for opening a file, so small ones would come in tasks of some thirty, each of which costs more than they do.
    return files.select("path", "content").coalesce(SPREAD * spark.sparkContext.defaultParallelism).mapInPandas(parse, schema)


def load_records(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Records of one kind; absent lists become empty, an explicit null stays null."""
    folder, schema, lists = KINDS[kind]
    rows = read_yaml_files(spark, f"{root.rstrip('/')}/{folder}")
    rows = rows.withColumn("present", F.coalesce(F.json_object_keys("raw"), F.array().cast("array<string>"))).withColumn("r", F.from_json("raw", schema))
    out = rows.select("path", "raw", "parse_error", "present", "r.*")
    for c in lists:
        kind_of = dict(out.dtypes)[c]
        out = out.withColumn(c, F.when(~F.array_contains("present", c) & F.col("parse_error").isNull(), F.array().cast(kind_of)).otherwise(F.col(c)))
    if "measurements" in lists:
        out = out.withColumn("measurements", F.transform("measurements", lambda m: m.withField("tags", F.coalesce(m["tags"], F.array().cast("array<string>")))))
    return out


def load_catalog(spark: SparkSession, root: str) -> Catalog:
    return Catalog(*(load_records(spark, root, k) for k in ("object", "cave", "relation")))
