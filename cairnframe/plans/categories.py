"""Categories by keywords, in order of precedence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words in normalised names that tell a category, the first that applies.
OBJECT_CATEGORIES = [("sztolnia", ["sztolnia"]), ("wywierzysko", ["wywierzysko", "wyvieracka", "vyvieracka"]), ("ponor", ["ponor"])]


def category_by_keywords(name: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    out = None
    for category, words in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | name.contains(word)
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out.otherwise(default)


def object_category(genesis: Column, name: Column) -> Column:
    """Category of a field point from its genesis and name."""
    from ..functions.text import normalize_name

    return category_by_keywords(normalize_name(F.concat_ws(" ", genesis, name)), OBJECT_CATEGORIES, "jaskinia_otwor")
