"""URL filter in DataFrame operations: rules by host and path, and a list of canonical URLs (operator 12).

URLs that no rule fits are looked up in the list. A blocked Bloom filter of the list, broadcast as a
bounded number of rows, lets through the URLs that may be listed; only these are shuffled for an exact
hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import cut_lineage

#: (verdict, rule), a rule being a host and the beginning of a path; configuration of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Query parameters that only tell where a reader came from.
TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)"
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; '' without '://' or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), *LETTERS)


def path_of(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host and path as pages are listed: without scheme, 'www.', default port, fragment, tracking parameters, '.html' and slashes at the end.

    Other parameters stay, sorted. Null where there is no host.
    """
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)?$", "")
    path = F.regexp_replace(path_of(url), r"(\.html?)?/*$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(f"^{TRACKING}(=|$)")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does; of rules of one length the first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda x: len(x[1])):  # the longest comes last and so is asked first
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith(f".{rule[:at]}")) & path.startswith(rule[at:])
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, keep: Sequence[str] = ("page_id",), max_block_bits: int = bloom.MAX_BLOCK_BITS) -> DataFrame:
    """The columns in `keep`, host, path, rule, listed (boolean) and verdict ('allow' or 'block') of all rows of `pages` (url).

    `listed` has a column `url`. A rule decides where one fits; else listed URLs are blocked and all
    others allowed. URLs are compared in canonical form, so spellings of one address share an entry.
    Null and empty URLs, and those without '://', have no host, fit no rule, are on no list and are
    allowed. Long URLs are handled whole, repeated rows stay, entries that repeat or are null change
    nothing, an empty list blocks nothing, and an empty table gives no rows. Other columns are ignored.
    """
    entries = cut_lineage(listed.select(canonical_url(F.col("url").cast("string")).alias("entry")).where("entry is not null").distinct())
    bits = bloom.block_bits(entries.count(), max_block_bits)
    blocks = bloom.build(entries.select(F.xxhash64("entry").alias("key")), bits)
    url = F.col("__url")
    rows = pages.select(*(F.col(f"`{c}`").alias(f"__keep_{k}") for k, c in enumerate(keep)), F.col("url").cast("string").alias("__url"))
    kept = [f"__keep_{k}" for k in range(len(keep))]
    rows = rows.select(*kept, "__url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("canonical", F.when(F.col("found").isNull(), canonical_url(url))).drop("__url").withColumn("key", F.xxhash64("canonical"))
    probed = bloom.with_possible(rows, "key", blocks, bits).withColumn("possible", F.col("possible") & F.col("canonical").isNotNull())
    # Two plans over the same narrow scan: what cannot be listed never meets the shuffle.
    candidates = probed.where("possible").join(entries, F.col("canonical") == F.col("entry"), "left").withColumn("listed", F.col("entry").isNotNull()).drop("entry")
    judged = candidates.unionByName(probed.where("not possible").withColumn("listed", F.lit(False)))
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select(*(F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)), "host", "path", F.col("found.rule").alias("rule"), "listed", verdict.alias("verdict"))


def toxic_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url) of pages whose document, named by the number that ends their path, is labelled toxic: the query's list."""
    number = F.regexp_extract(path_of(F.col("url").cast("string")), r"/([0-9]{1,18})(?:\.html?)?/*$", 1).try_cast("long")
    toxic = labels.where("toxic = 1").select(F.col("doc_id").alias("number")).distinct()
    return pages.select("url", number.alias("number")).join(toxic, "number", "left_semi").select("url")


def _sql() -> str:
    def canonical(u: str, host: str, path: str) -> str:
        query = rf"list_sort(list_filter(string_split(regexp_extract({u}, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^{TRACKING}(=|$)')))"
        return rf"CASE WHEN {host} <> '' THEN regexp_replace({host}, '^www\.|:(80|443)?$', '', 'g') || regexp_replace({path}, '(\.html?)?/*$', '') || CASE WHEN len({query}) > 0 THEN '?' || array_to_string({query}, '&') ELSE '' END END"

    rules = ", ".join(f"('{v}', '{r}', '{r[: r.index('/')]}', '{r[r.index('/') :]}')" for v, r in RULES)
    return rf"""
WITH parts AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), '{LETTERS[0]}', '{LETTERS[1]}') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), named AS (
  SELECT *, {canonical("url", "host", "path")} AS canonical, TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})(?:\.html?)?/*$', 1) AS BIGINT) AS number FROM parts
), entries AS (
  SELECT DISTINCT canonical AS entry FROM named WHERE number IN (SELECT doc_id FROM labels WHERE toxic = 1) AND canonical IS NOT NULL
), rules(verdict, rule, rule_host, rule_path) AS (VALUES {rules}
), judged AS (
  SELECT *, (SELECT {{'rule': rule, 'verdict': verdict}} FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) ORDER BY length(rule) DESC LIMIT 1) AS found
  FROM named
)
SELECT page_id, host, path, found.rule AS rule, found IS NULL AND entry IS NOT NULL AS listed,
  coalesce(found.verdict, CASE WHEN entry IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN entries ON canonical = entry
"""


SQL = _sql()
