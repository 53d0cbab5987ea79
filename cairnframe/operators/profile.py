"""Source quality profiles: missing keys, duplicates and numeric columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean, is_blank, parse_decimal

TOP_GROUPS, SHOWN_ROWS = 10, 20


def missing_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, missing): blank values of each column in one pass; a column that the table lacks is missing in every row."""
    present = [c for c in columns if c in table.columns]
    counts = table.agg(F.count("*").alias("__rows"), *(F.count_if(is_blank(F.col(f"`{c}`"))).alias(f"m{k}") for k, c in enumerate(present)))
    pairs = [F.struct(F.lit(c).alias("column_name"), (F.col(f"m{present.index(c)}") if c in present else F.col("__rows")).alias("missing")) for c in columns]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def duplicate_groups(table: DataFrame, column: str, row_number: str) -> DataFrame:
    """(value, n, first_rows): values that occur more than once, with their least row numbers; blanks are ignored.

    Row numbers are ranked before they are gathered, so no group's rows are collected beyond those shown.
    """
    rows = table.select(clean(F.col(f"`{column}`")).alias("value"), F.col(row_number).cast("long").alias("rn")).where("value <> ''")
    groups = rows.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    return groups.join(first_rows(rows), "value")


def first_rows(rows: DataFrame) -> DataFrame:
    """(value, first_rows): at most SHOWN_ROWS least row numbers of each value; a limit that is the feature."""
    ranked = rows.withColumn("k", F.row_number().over(W.partitionBy("value").orderBy("rn"))).where(F.col("k") <= SHOWN_ROWS)
    return ranked.groupBy("value").agg(F.array_sort(F.collect_list("rn")).alias("first_rows"))


def duplicate_examples(table: DataFrame, column: str, row_number: str) -> DataFrame:
    """The top groups by size, then value; their row numbers are looked up only for these."""
    rows = table.select(clean(F.col(f"`{column}`")).alias("value"), F.col(row_number).cast("long").alias("rn")).where("value <> ''")
    top = rows.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "value").limit(TOP_GROUPS)
    return first_rows(rows.join(F.broadcast(top.select("value")), "value")).join(F.broadcast(top), "value").select("value", "n", "first_rows")


def duplicate_summary(table: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, duplicate_groups, duplicate_records, extra_records) of each column."""
    out = None
    for c in columns:
        groups = table.select(clean(F.col(f"`{c}`")).alias("v")).where("v <> ''").groupBy("v").count().where("count > 1")
        one = groups.agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum("count"), F.lit(0)).alias("duplicate_records"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra_records")).select(F.lit(c).alias("column_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def numeric_profile(table: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, numeric, missing, non_numeric, min_value, max_value) of decimal texts, in one pass."""
    aggregates, parsed = [], []
    for k, c in enumerate(columns):
        text = F.col(f"`{c}`") if c in table.columns else F.lit("")
        parsed += [parse_decimal(text).alias(f"v{k}"), is_blank(text).alias(f"e{k}")]
        value, empty = F.col(f"v{k}"), F.col(f"e{k}")
        aggregates += [F.count(value).alias(f"n{k}"), F.count_if(empty).alias(f"b{k}"), F.count_if(~empty & value.isNull()).alias(f"x{k}"), F.min(value).alias(f"lo{k}"), F.max(F.when(~F.isnan(value), value)).alias(f"hi{k}")]
    row = table.select(*parsed).agg(*aggregates)
    parts = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{k}").alias("numeric"), F.col(f"b{k}").alias("missing"), F.col(f"x{k}").alias("non_numeric"), F.col(f"lo{k}").alias("min_value"), F.col(f"hi{k}").alias("max_value")) for k, c in enumerate(columns)]
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
