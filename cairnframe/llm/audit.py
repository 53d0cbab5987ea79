"""Interaction audit of filters: who removes what in every order, and Shapley values (operator 13).

Documents are reduced to counts by part and failure mask; all orders follow from these counts. With
c(S) documents failing exactly the filters S, and each filter i on with probability x_i, the removal
polynomial R(x) = sum of c(S) * (1 - product over S of (1 - x_i)) is the multilinear extension of
"documents removed". Its corners give the survivors of any set of filters, the integral of its partial
derivative along the diagonal is the Shapley value of a filter. Integrals are exact rationals.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def row_mask(text: Column) -> Column:
    """Filters A to D that a text fails, as bits 0 to 3."""
    words = F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " ")  # a plain separator needs no regular expression
    n = F.size(F.array_remove(words, ""))
    distinct = F.size(F.array_distinct(F.array_remove(words, "")))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = (n < MIN_WORDS, distinct * 100 < n * MIN_DISTINCT_PERCENT, capitals.cast("long") * 100 > F.length(text).cast("long") * MAX_CAPITAL_PERCENT, text.rlike(SYMBOLS))
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask + failed.cast("int") * (1 << bit)
    return mask


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail exactly the filters of a mask, and those labelled.

    Rows with one text, part and labels are counted before texts meet, so a text that a third of all
    rows share comes to a handful of rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("same"), row_mask(text).alias("mask"))
    marks = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    marked = rows.join(marks, "doc_id", "left").select("doc_id", "part", "same", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # Of each text and part: all rows, and those with the least id among them, which the text's least id may excuse.
    ids = marked.groupBy("same", "part", "mask", "good", "toxic", "doc_id").agg(F.count("*").alias("rows"))
    groups = ids.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("rows").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("rows", "doc_id").alias("at_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("unnumbered"),
    )
    first = groups.groupBy("same").agg(F.min("least").alias("first"))
    joined = groups.join(first, "same")
    kept = F.col("unnumbered") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = joined.select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("mask").alias("mask"), kept.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - kept).alias("n")))).alias("x"))
    count = lambda test: F.sum(F.when(test, F.col("x.n")).otherwise(0))
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(F.sum("x.n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


class RemovalPolynomial:
    """R(x) for counts {mask: documents}; masks are sets of filters as bits."""

    def __init__(self, counts: dict[int, int], filters: int):
        self.counts, self.filters = counts, filters

    def at_corner(self, on: int) -> int:
        """Documents removed by the filters in `on` together."""
        return sum(n for mask, n in self.counts.items() if mask & on)

    def partial_on_diagonal(self, i: int) -> list[int]:
        """Coefficients of dR/dx_i at x = (t, ..., t), in powers of (1 - t): a mask of k filters adds to power k - 1."""
        out = [0] * self.filters
        for mask, n in self.counts.items():
            if mask >> i & 1:
                out[mask.bit_count() - 1] += n
        return out

    def shapley(self, i: int) -> Fraction:
        """The integral of that derivative over t from 0 to 1: each power p of (1 - t) gives 1 / (p + 1)."""
        return sum((Fraction(n, power + 1) for power, n in enumerate(self.partial_on_diagonal(i))), Fraction(0))


def orders_of(part: str, counts: pd.DataFrame, filters: str = FILTERS) -> Iterator[tuple]:
    """The audit's rows of one part from its counts, at most 2^filters rows."""
    k = len(filters)
    removal, good, toxic = (RemovalPolynomial(dict(zip(counts["mask"].tolist(), counts[c].tolist(), strict=True)), k) for c in ("n", "good", "toxic"))
    total = sum(removal.counts.values())
    gone = [[p.at_corner(on) for on in range(1 << k)] for p in (removal, good, toxic)]
    values = [removal.shapley(i) * factorial(k) for i in range(k)]
    assert all(v.denominator == 1 for v in values)
    for order in permutations(range(k)):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here, good_here, toxic_here = (g[after] - g[before] for g in gone)
            yield part, name, step, total - gone[0][after], here, gone[0][1 << i] - here, removal.counts.get(1 << i, 0), good_here, toxic_here, int(values[i])
            before = after


def _audit_part(counts: pd.DataFrame) -> pd.DataFrame:
    columns = [c.split()[0] for c in AUDIT.split(", ")]
    return pd.DataFrame(list(orders_of(counts["part"].iloc[0], counts)), columns=columns)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (lang), order of the five filters and step; columns as in AUDIT.

    Null texts are empty; an empty text has no words and fails A only (0 is not under 0), and E if an
    earlier one is empty too. A null lang is the part ''. E compares texts of all parts: the rows of a
    text's least doc_id pass (all of them, where rows repeat), as do rows without a doc_id, which are
    neither smaller nor larger. Documents count as rows. Labels that repeat count once, and a document
    is good or toxic if any of its labels says so; null labels say nothing. Texts are handled whole;
    an empty table gives no rows; other columns are ignored.
    """
    return mask_counts(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic")).groupBy("part").applyInPandas(_audit_part, AUDIT)


def _sql() -> str:
    letters = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(FILTERS))
    distinct = " AND ".join(f"f{j}.c <> f{i}.c" for i in range(1, 6) for j in range(1, i))
    steps = " UNION ALL ".join(f"SELECT {'||'.join(f'f{i}.c' for i in range(1, 6))}, {k}, f{k}.b, {' + '.join([f'f{i}.b' for i in range(1, k)] or ['0'])} FROM {', '.join(f'f AS f{i}' for i in range(1, 6))} WHERE {distinct}" for k in range(1, 6))
    return rf"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failed AS (
  SELECT part, doc_id, (len(w) < {MIN_WORDS})::INT + (100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w))::INT * 2
    + (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MAX_CAPITAL_PERCENT} * length(text))::INT * 4
    + regexp_matches(text, '{SYMBOLS}')::INT * 8 + coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT * 16 AS mask
  FROM words
), marked AS (
  SELECT part, mask, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM failed
), counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM marked GROUP BY ALL
), f(c, b) AS (VALUES {letters}
), steps(filter_order, step, bit, earlier) AS ({steps}
), rows AS (
  SELECT part, filter_order, step, bit, sum(n) FILTER (WHERE mask & (earlier | bit) = 0) AS kept, sum(n) FILTER (WHERE mask & bit > 0 AND mask & earlier = 0) AS removed,
    sum(n) FILTER (WHERE mask & bit > 0 AND mask & earlier > 0) AS redundant, sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(good) FILTER (WHERE mask & bit > 0 AND mask & earlier = 0) AS good_lost, sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & earlier = 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM rows
"""


SQL = _sql()
