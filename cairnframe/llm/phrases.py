"""Collocations: phrases whose words keep together, from word-id suffix arrays of shards (operator 11).

A task takes its texts in shards of some megabytes. A shard's words become ids, prefix doubling in numpy
sorts the positions by their next words, and the intervals of the longest common prefixes give the
shard's counts of phrases; Spark adds them up by language and phrase. Phrases of n words are counted
only where both phrases of n - 1 words in them may be frequent, which a Bloom filter of bounded size
tells. What it lets through besides is counted and dropped, so counts are exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .common import staged, text_batches

MIN_COUNT, MAX_WORDS, TOP, COVERED_PERCENT = 10, 3, 2000, 50
NO_LANG = "und"
#: Bytes of text and words of one suffix array, and rows handed to Spark at once.
SHARD_BYTES, SHARD_WORDS, OUT_ROWS = 4_000_000, 1_000_000, 50_000
#: Parts in which a language's candidates are ranked before the best of each are ranked together.
RANK_PARTS = 64

COUNTS = "lang string, phrase string, f long"
_SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

#: 0: in a word, 1: between words, 2: between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_TURN = 21


@dataclass
class Words:
    """The words of a shard in order: id of the word, number of its piece, number of its language."""

    word: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    spelling: pa.StringArray
    langs: list[str]

    def ids(self) -> np.ndarray:
        return self.word + self.lang.astype(np.int64) * len(self.spelling)

    def reaches(self, words: int) -> np.ndarray:
        """Whether so many words of one piece start at each position."""
        out = np.zeros(len(self.word), bool)
        if words <= len(self.word):
            out[: len(self.word) - words + 1] = self.piece[words - 1 :] == self.piece[: len(self.word) - words + 1]
        return out


def words_of(texts: list[bytes], langs: list[str]) -> Words:
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    letters = _LOWER[data[inside]]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    begins = np.cumsum([1, *(len(t) + 1 for t in texts[:-1])])
    first = np.append(np.searchsorted(starts, begins), len(starts))
    lang = np.repeat(np.array([number[x] for x in langs], np.int32), np.diff(first))
    spelled = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    return Words(spelled.indices.to_numpy(), piece, lang, spelled.dictionary, names)


def parts(words: Words, longest: int, size: int) -> Iterator[tuple[Words, int]]:
    """Stretches of `size` words, and the words after each that its last phrases reach into; with each the number of its own."""
    for lo in range(0, len(words.word), size):
        hi = lo + size + longest - 1
        yield Words(words.word[lo:hi], words.piece[lo:hi], words.lang[lo:hi], words.spelling, words.langs), min(size, len(words.word) - lo)


def ranks(words: Words, length: int) -> np.ndarray:
    """Rank of each position by its next `length` words within its piece, by prefix doubling; equal words have equal ranks."""
    rank, known = words.ids(), 1
    while known < length:
        step = min(known, length - known)
        rank, known = _doubled(rank, words.piece, step), known + step
        order = np.argsort(rank, kind="stable")
        rank[order] = _dense(rank[order])
    return rank


def _doubled(rank: np.ndarray, piece: np.ndarray, step: int) -> np.ndarray:
    """One number for the ranks of a position and of the one `step` words on, where the piece goes that far."""
    ahead = np.zeros(len(rank), np.int64)
    ahead[:-step] = np.where(piece[step:] == piece[:-step], rank[step:] + 1, 0)
    return rank * (rank.max(initial=0) + 2) + ahead


def _dense(in_order: np.ndarray) -> np.ndarray:
    new = np.zeros(len(in_order), np.int64)
    np.cumsum(in_order[1:] != in_order[:-1], out=new[1:])
    return new


def suffix_array(words: Words, length: int, live: np.ndarray | None = None) -> np.ndarray:
    """Positions (those of `live` only, if given) in order of their next `length` words."""
    step = length - max(1, (length + 1) // 2)
    key = _doubled(ranks(words, length - step), words.piece, step) if step else words.ids()
    if live is None:
        return np.argsort(key, kind="stable")
    at = np.flatnonzero(live)
    return at[np.argsort(key[at], kind="stable")]


def common_prefixes(words: Words, order: np.ndarray, length: int) -> np.ndarray:
    """Words (at most `length`) that each position of a suffix array shares with the one before it."""
    ids, out = words.ids(), np.zeros(len(order), np.int8)
    same = np.ones(max(0, len(order) - 1), bool)
    for n in range(1, length + 1):
        reaches = words.reaches(n)
        ok = reaches[order[1:]] & reaches[order[:-1]]
        at = np.minimum(order + n - 1, len(ids) - 1)
        same &= ok & (ids[at[1:]] == ids[at[:-1]])
        out[1:] += same
    return out


def phrase_counts(words: Words, own: int, sizes: Iterable[int], live: np.ndarray | None = None) -> Iterator[pa.Table]:
    """Counts of the phrases of `sizes` words that start at the first `own` positions (those of `live` only, if given)."""
    longest = max(sizes)
    order = suffix_array(words, longest, live)
    shared = common_prefixes(words, order, longest)
    for n in sizes:
        starts = words.reaches(n)[order]
        at, counted = order[starts], (order < own)[starts]
        # An interval of positions that share n words begins where fewer are shared with the position before; all in it start n words.
        heads = np.flatnonzero(shared[starts] < n)
        if len(heads):
            f = np.add.reduceat(counted.astype(np.int64), heads)
            heads, f = at[heads[f > 0]], f[f > 0]
            yield _rows(words, heads, n, f)


def _rows(words: Words, heads: np.ndarray, n: int, f: np.ndarray) -> pa.Table:
    columns = [words.spelling.take(pa.array(words.word[heads + t])) for t in range(n)]
    phrase = pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string())) if n > 1 else columns[0]
    lang = pa.DictionaryArray.from_arrays(pa.array(words.lang[heads]), pa.array(words.langs, pa.string())).cast(pa.string())
    return pa.table([lang, phrase.cast(pa.string()), pa.array(f)], schema=_SCHEMA)


def _totals(words: Words) -> pa.Table:
    """All words of each language, under the empty phrase."""
    n = np.bincount(words.lang, minlength=len(words.langs))
    return pa.table([pa.array(words.langs, pa.string()), pa.array([""] * len(n)), pa.array(n)], schema=_SCHEMA)


def gram_keys(words: Words, n: int) -> np.ndarray:
    """A hash of the language and the next n words at each position; as `gram_key`."""
    spelled = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words.spelling.to_pylist()), np.uint64, len(words.spelling))[words.word]
    key = np.array([xxhash.xxh64_intdigest(x, 42) for x in words.langs], np.uint64)[words.lang]
    for t in range(n):
        key = (key << np.uint64(_TURN)) | (key >> np.uint64(64 - _TURN))
        key[: len(key) - t] ^= spelled[t:]
    return key


def gram_key(lang: Column, phrase: Column) -> Column:
    turned = lambda x: F.shiftleft(x, _TURN).bitwiseOR(F.shiftrightunsigned(x, 64 - _TURN))
    return F.aggregate(F.split(phrase, " "), F.xxhash64(lang), lambda key, word: turned(key).bitwiseXOR(F.xxhash64(word)))


def _counter(sizes: tuple[int, ...], filter_array=None, shard_bytes: int = SHARD_BYTES, shard_words: int = SHARD_WORDS):
    """The function that counts phrases of `sizes` words; with a filter those whose shorter phrases it lets through."""

    def counted(texts: list[bytes], langs: list[str]) -> Iterator[pa.Table]:
        words = words_of(texts, langs)
        texts.clear()
        if filter_array is None and len(words.word):
            yield _totals(words)
        for part, own in parts(words, max(sizes), shard_words):
            live = None
            if filter_array is not None:
                possible = bloom.possible_in(filter_array.value, gram_keys(part, max(sizes) - 1))
                live = part.reaches(max(sizes))
                live[:-1] &= possible[:-1] & possible[1:]
            yield from phrase_counts(part, own, sizes, live)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs, size = [], [], 0
        for batch in batches:
            for text, lang in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.append(text)
                langs.append(lang)
                size += len(text)
                if size >= shard_bytes:
                    for table in counted(texts, langs):
                        yield from table.to_batches(OUT_ROWS)
                    texts, langs, size = [], [], 0
        if texts:
            for table in counted(texts, langs):
                yield from table.to_batches(OUT_ROWS)

    return run


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, **shards: int) -> DataFrame:
    """(lang, phrase, f, size) of all phrases of up to `max_words` words found `min_count` times; size 0 is a language's number of words."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"))

    def merged(found: DataFrame, name: str) -> DataFrame:
        summed = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= min_count) | (F.col("phrase") == ""))
        return staged(summed.withColumn("size", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))), name)

    out = merged(rows.mapInArrow(_counter((1, 2), **shards), COUNTS), "phrases2")
    level = out.where("size = 2")
    for n in range(3, max_words + 1):
        bits = bloom.block_bits(level.count())
        blocks = bloom.as_array(bloom.build(level.select(gram_key(F.col("lang"), F.col("phrase")).alias("key")), bits), bits)
        level = merged(rows.mapInArrow(_counter((n,), docs.sparkSession.sparkContext.broadcast(blocks), **shards), COUNTS), f"phrases{n}")
        out = out.unionByName(level)
    return out


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score, size) of phrases of two words and more, by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    joined = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(k.alias("k"), joined(F.lit(1), k).alias("first"), joined(k + 1, F.col("size") - k).alias("rest")))
    rows = frequent.where("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "size", "cut.*")
    part = frequent.where("size > 0").select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("f").alias("__f"))
    # Each part is frequent itself, as it is found wherever the phrase is. A part that very many phrases begin with has one row on its side.
    for side, count in (("first", "l"), ("rest", "r")):
        rows = rows.join(part, (F.col("lang") == F.col("__lang")) & (F.col(side) == F.col("__part"))).withColumn(count, F.col("__f")).drop("__lang", "__part", "__f")
    exact = "cast({} as decimal(19,0))"
    rows = rows.withColumn("score", F.expr(f"(cast(1000000 as decimal(7,0)) * {exact.format('a')} * {exact.format('a')}) div ({exact.format('l')} * {exact.format('r')})"))
    best = rows.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"), F.first("a").alias("a"), F.first("size").alias("size"))
    return best.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"), "size")


def uncovered(candidates: DataFrame, max_words: int = MAX_WORDS, percent: int = COVERED_PERCENT) -> DataFrame:
    """Candidates without those that lie inside a longer candidate found at least `percent` as often."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    longer = candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("of")).groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    return candidates.join(longer, ["lang", "phrase"], "left").where(F.col("of").isNull() | (F.col("of") * 100 < F.col("a") * percent)).drop("of")


def best_of_each(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """`candidates` that rank up to `top` in their language, with `rank`; a large language is ranked in RANK_PARTS parts first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = candidates.withColumn("__part", part).withColumn("__rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("__rank") <= top)
    return first.drop("__part", "__rank").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, percent: int = COVERED_PERCENT, **shards: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    Null texts are empty, and texts without a word add nothing; a null lang is 'und', as is a lang that
    is spelled so. Texts are handled whole and cut into parts only between words, without losing a
    phrase. Rows that repeat count each. Ties of score and count go to the phrase that comes first in
    the order of its UTF-8 bytes. An empty table gives no rows; other columns are ignored.
    """
    frequent = frequent_phrases(docs.select("text", "lang"), min_count, max_words, **shards)
    best = best_of_each(uncovered(scored(frequent), max_words, percent), top)
    totals = frequent.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces
), places AS (
  SELECT lang, unnest(w) AS w1, unnest(w[2:]) AS w2, unnest(w[3:]) AS w3 FROM split
), f AS (
  SELECT lang, w1 AS phrase, 1 AS size, count(*) AS f FROM places WHERE w1 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM places WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM places WHERE w3 IS NOT NULL GROUP BY ALL
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {MIN_COUNT}
), parts AS (
  SELECT lang || chr(0) || phrase AS part, f FROM f WHERE f >= {MIN_COUNT}
), cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest FROM candidates, (VALUES (1), (2)) AS ks(k) WHERE k < size
), scores AS (
  SELECT c.lang, c.phrase, c.size, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN parts x ON x.part = c.lang || chr(0) || first JOIN parts y ON y.part = c.lang || chr(0) || rest
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE size = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE size = 3
  ) GROUP BY ALL
), ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, l, r, score
  FROM best b LEFT JOIN longer USING (lang, phrase) WHERE longer.a IS NULL OR 100 * longer.a < {COVERED_PERCENT} * b.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN (SELECT lang, count(*) AS n FROM places WHERE w1 IS NOT NULL GROUP BY 1) USING (lang) WHERE rank <= {TOP}
"""
