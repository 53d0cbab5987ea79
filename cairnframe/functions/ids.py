"""Identifiers: padding, parsing, and whether a path fits a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numbered_id(prefix: Column, number: Column) -> Column:
    """PREFIX-0007; more than four digits stay."""
    return F.format_string("%s-%04d", prefix, number)


def id_prefix(value: Column) -> Column:
    """What stands before the number of PREFIX-NNNN; null for other texts."""
    return F.nullif(F.regexp_extract(value, r"^([A-Z]{2,3})-\d{4,}$", 1), F.lit(""))


def id_number(value: Column, prefix: str = "[A-Z]{1,3}") -> Column:
    return F.regexp_extract(value, rf"^{prefix}-(\d+)$", 1).try_cast("long")


def next_measurement_id(ids: Column) -> Column:
    """m-%03d of one more than the largest number among the ids."""
    numbers = F.filter(F.transform(ids, lambda i: F.regexp_extract(i, r"^m-(\d+)$", 1).try_cast("long")), lambda v: v.isNotNull())
    return F.format_string("m-%03d", F.coalesce(F.array_max(numbers), F.lit(0)) + 1)


def path_matches(kind: Column, path: Column, record_id: Column) -> Column:
    """objects/PREFIX/ID, caves/ID or relations/ID, with .yml or .yaml, at the end of the path."""
    stem = F.regexp_extract(path, r"([^/]+)\.ya?ml$", 1)
    folder = F.regexp_extract(path, r"(?:^|/)((?:objects/[^/]+)|caves|relations)/[^/]+$", 1)
    wanted = F.when(kind == "object", F.concat(F.lit("objects/"), F.split_part(record_id, F.lit("-"), F.lit(1)))).when(kind == "cave", "caves").otherwise("relations")
    return (stem == record_id) & (folder == wanted)
