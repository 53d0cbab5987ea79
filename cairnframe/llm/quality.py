"""Quality rules with cross-document line frequency, in DataFrame operations only (operator 10).

Base rules work inside a row. The method's verdict: lines are normalised and hashed, the distinct
documents of a host (`source`) that hold a line are counted, lines above the limit are taken out
(`with_text` gives the text that is left), and documents of which too little is left are rejected.
A document is a doc_id, so copies under ids of their own count, and a text that one host holds more
often than the limit allows is rejected there; removing copies is another operator's work. Counts
cover all documents. Lines are parsed once, into a table of hashes that lies in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW_WORDS = 20, 30, 8
#: A line that more distinct documents of a host hold is boilerplate; a document that loses more percent of its words is rejected.
MAX_LINE_DOCUMENTS, MAX_REMOVED_PERCENT = 50, 70


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def base_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in `keep` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Arrays that a lambda uses are columns of their own and are used more than once, so they are not computed for each element.
    rows = docs.select(
        *keep,
        words_of(text).alias("__words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    n = F.size("__words")
    windows = F.when(n >= WINDOW_WORDS, F.transform(F.sequence(F.lit(1), F.greatest(n - (WINDOW_WORDS - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("__words", i, WINDOW_WORDS)))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        *keep,
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("__windows"),
    )
    # Only documents in which a window repeats need their windows sorted.
    repeats = F.size("__windows") > F.size(F.array_distinct("__windows"))
    rows = rows.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    m = F.size("__sorted")
    twin = F.filter(
        F.transform("__sorted", lambda x, k: F.when(((k > 0) & (F.get("__sorted", k - 1)["h"] == x["h"])) | ((k + 1 < m) & (F.get("__sorted", k + 1)["h"] == x["h"])), x["i"])),
        lambda i: i.isNotNull(),
    )
    rows = rows.withColumn("__twins", F.sort_array(twin))
    gaps = F.transform("__twins", lambda i, k: F.coalesce(F.least(F.lit(WINDOW_WORDS), F.get("__twins", k + 1) - i), F.lit(WINDOW_WORDS)))
    rows = rows.withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    features = F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))
    # A caller's filter on a feature must not move below the arrays, where it would compute them again for each element; it can't pass a generator.
    return rows.select(*keep, F.explode_outer(F.array(features)).alias("f")).select(*keep, "f.*")


def tidy_line(line: Column) -> Column:
    """A line as it is compared: lower-cased, runs of white space as one space."""
    return F.btrim(F.regexp_replace(F.lower(line), SPACE, " "))


def line_key(tidy: Column) -> Column:
    """60 bits of a normalised line's MD5."""
    return F.conv(F.substring(F.md5(tidy), 1, 15), 16, 10).cast("long")


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, content, source, line, words): a row for each line with a word; `content` is a hash of the text, `line` one of the normalised line."""
    tidy = F.filter(F.transform(F.split("text", "\n"), tidy_line), lambda x: x != "")
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("content"), tidy.alias("tidy"))
    rows = rows.select("doc_id", "source", "content", F.transform("tidy", lambda x: F.struct(line_key(x).alias("line"), F.size(F.split(x, " ")).cast("long").alias("words"))).alias("lines"))
    # An outer explode: an inner one has the arrays computed once more for a filter on their size.
    lines = rows.select("doc_id", "content", "source", F.explode_outer("lines").alias("x")).where("x is not null")
    return lines.select("doc_id", "content", "source", F.col("x.line").alias("line"), F.col("x.words").alias("words"))


def frequent_lines(lines: DataFrame, max_documents: int = MAX_LINE_DOCUMENTS) -> DataFrame:
    """(source, line) of lines that more than `max_documents` documents of a host hold; a null doc_id counts once for each text.

    Each document counts in the first step, so a line that very many hold is counted in parts.
    """
    document = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("text"), "content")).otherwise(F.xxhash64("doc_id"))
    once = lines.select("source", "line", document.alias("document")).distinct()
    return once.groupBy("source", "line").agg(F.count("*").alias("n")).where(F.col("n") > max_documents).select("source", "line")


def removals(docs: DataFrame, max_documents: int = MAX_LINE_DOCUMENTS, with_keys: bool = False) -> DataFrame:
    """(doc_id, content, source, all, removed) of documents: their words, and those in their host's frequent lines.

    With `with_keys` also `keys`, the frequent lines that the document holds. Rows that are repeated
    add to both sums alike.
    """
    lines = staged(line_rows(docs), "lines")
    frequent = broadcast_if_small(frequent_lines(lines, max_documents).select(F.col("source").alias("__s"), F.col("line").alias("__l")))
    marked = lines.join(frequent, F.col("source").eqNullSafe(F.col("__s")) & (F.col("line") == F.col("__l")), "left")
    keys = [F.collect_set("__l").alias("keys")] if with_keys else []
    return marked.groupBy("doc_id", "content", "source").agg(F.sum("words").alias("all"), F.sum(F.when(F.col("__l").isNotNull(), F.col("words")).otherwise(0)).alias("removed"), *keys)


def without_lines(text: Column, keys: Column) -> Column:
    """`text` without the lines whose normalised form is among `keys`; the text itself where these are null."""
    left = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(keys, line_key(tidy_line(x))))
    return F.when(keys.isNotNull(), F.array_join(left, "\n")).otherwise(text)


def quality_rules(docs: DataFrame, keep: list[str] | None = None, max_documents: int = MAX_LINE_DOCUMENTS, max_removed_percent: int = MAX_REMOVED_PERCENT, with_text: bool = False) -> DataFrame:
    """The columns in `keep` (doc_id unless given), the base features, base_failed, depleted and kept.

    With `with_text` also kept_text, the text without its host's frequent lines.

    `docs` has doc_id, text and source. Null and empty texts have no words and fail the base rules.
    A null source is a host of its own. Repeated rows stay and count once; rows that share a doc_id
    and differ in text count once too and are judged by themselves. Texts are handled whole; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__content"), F.col("source").alias("__source"), *(F.col(f"`{c}`").alias(f"__keep_{k}") for k, c in enumerate(keep or ["doc_id"])), "text")
    kept = [f"__keep_{k}" for k in range(len(keep or ["doc_id"]))]
    base = base_features(rows, ["__doc", "__content", "__source", *kept, *(["text"] if with_text else [])])
    lost = removals(docs.select("doc_id", "text", "source"), max_documents, with_text)
    gone = F.col("removed") * 100 > F.col("all") * max_removed_percent
    if with_text:
        lost = lost.where("removed > 0").select("doc_id", "content", "source", gone.alias("__gone"), "keys")
        lost = broadcast_if_small(lost, F.size("keys"))
    else:
        lost = broadcast_if_small(lost.where(gone).select("doc_id", "content", "source", F.lit(True).alias("__gone")))
    same = F.col("__doc").eqNullSafe(F.col("doc_id")) & (F.col("__content") == F.col("content")) & F.col("__source").eqNullSafe(F.col("source"))
    out = base.join(lost, same, "left").withColumn("depleted", F.coalesce("__gone", F.lit(False)))
    return out.select(
        *(F.col(k).alias(c) for k, c in zip(kept, keep or ["doc_id"], strict=True)),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "depleted",
        (~F.col("base_failed") & ~F.col("depleted")).alias("kept"),
        *([without_lines(F.col("text"), F.col("keys")).alias("kept_text")] if with_text else []),
    )


SQL = rf"""
WITH base AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), feats AS (
  SELECT doc_id, source, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (SELECT (count(*) - count(DISTINCT l))::BIGINT FROM (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS l) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')) AS n_dup_lines,
    list_transform(range(1, len(w) - {WINDOW_WORDS - 2}), lambda i: array_to_string(w[i:i+{WINDOW_WORDS - 1}], ' ')) AS grams
  FROM base
), grams AS (
  SELECT doc_id, source, text, unnest(grams) AS g, generate_subscripts(grams, 1) AS i FROM feats
), twins AS (
  SELECT doc_id, source, text, i, lead(i) OVER (PARTITION BY doc_id, source, text ORDER BY i) AS nxt
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, source, text, g) AS c FROM grams) WHERE c > 1
), repeats AS (
  SELECT doc_id, sum(least({WINDOW_WORDS}, coalesce(nxt - i, {WINDOW_WORDS})))::BIGINT AS r FROM twins GROUP BY 1
), lines AS (
  SELECT doc_id, source, trim(regexp_replace(unnest(string_split(lower(text), chr(10))), '{SPACE}', ' ', 'g')) AS line FROM documents
), counted AS (
  SELECT source, line, count(DISTINCT doc_id) AS n FROM lines WHERE line <> '' GROUP BY ALL
), gone AS (
  SELECT doc_id FROM (SELECT doc_id, len(string_split(line, ' ')) AS words, n FROM lines JOIN counted USING (source, line))
  GROUP BY 1 HAVING 100 * sum(CASE WHEN n > {MAX_LINE_DOCUMENTS} THEN words ELSE 0 END) > {MAX_REMOVED_PERCENT} * sum(words)
), out AS (
  SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, g.doc_id IS NOT NULL AS depleted
  FROM feats f LEFT JOIN repeats USING (doc_id) LEFT JOIN gone g USING (doc_id)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM out
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, depleted, NOT base_failed AND NOT depleted AS kept FROM judged
"""
