"""SimHash near-duplicates: binary-trie self-join with a Hamming error budget (operator 2).

Fingerprints: XXH64 (seed 42) of the 3-word shingles of the whole text, A-Z lower-cased, words
`[^\\x20\\x09-\\x0D]+`; a bit is set if it is set in more than half of the hashes.

Join: equal fingerprints collapse to one class first. Two fingerprints that differ in at most two
bits agree in at least two of their four 16-bit blocks; so each class is dealt to six shards, one
for each pair of blocks, by the 32 agreeing bits. Inside a shard the trie over the other 32 bits is
joined with itself: node pairs go down together, gather the bits in which they differ, and are
given up when these exceed the budget. No pair is reported twice, as it counts only in the first
pair of blocks in which it agrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut_lineage, text_batches
from .components import connected_components

SEED, SHINGLE_WORDS, MAX_BITS = 42, 3, 2
#: Blocks of 16 bits that a pair within the budget has in common, and the rest, for each deal.
DEALS = [(agree, tuple(b for b in range(4) if b not in agree)) for agree in combinations(range(4), 2)]
#: Fingerprints that a task gathers before it walks their tries, at the next change of the key.
CHUNK = 200_000
#: Rows with one key beyond which they are dealt once more.
DENSE_ROWS = 4096


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text; null, empty and blank texts have zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE_WORDS:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: -SHINGLE_WORDS + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    value = 0
    for k in range(8):
        counts = np.bincount(octets[:, k], minlength=256) @ BITS
        for bit in np.flatnonzero(2 * counts > len(hashes)):
            value |= 1 << (8 * k + int(bit))
    return value


#: Row v holds the eight bits of the octet v, lowest first.
BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long): the fingerprint's 64 bits as a signed long, one row per input row."""
    text_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_fingerprints, "doc_id long, fp long")


def trie_pairs(keys: np.ndarray, rest: np.ndarray, budget: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j with equal keys whose 32-bit rests differ in at most `budget` bits.

    `keys` and `rest` are sorted by (key, rest), rows are distinct. A node is a range of rows that
    share their leading bits; all node pairs of one depth are held in arrays and go down together.
    """
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lo, hi = edge, np.r_[edge[1:], len(keys)]
    held = hi - lo > 1
    a0, a1 = lo[held], hi[held]
    b0, b1, bits = a0, a1, np.zeros(len(a0), np.int8)
    found_i, found_j = [], []
    for depth in range(31, -1, -1):
        if not len(a0):
            break
        # Pairs of single rows need no more steps: count their bits at once.
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = (i < j) & (np.bitwise_count(rest[i] ^ rest[j]) <= budget)
            found_i.append(i[near])
            found_j.append(j[near])
            a0, a1, b0, b1, bits = (x[~leaf] for x in (a0, a1, b0, b1, bits))
        ones = np.r_[0, np.cumsum((rest >> np.uint32(depth)) & np.uint32(1), dtype=np.int64)]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        own = (a0 == b0) & (a1 == b1)  # a node with itself: its two children meet only once
        steps = [(a0, am, b0, bm, bits), (am, a1, bm, b1, bits), (a0, am, bm, b1, bits + 1), tuple(x[~own] for x in (am, a1, b0, bm, bits + 1))]
        a0, a1, b0, b1, bits = (np.concatenate(x) for x in zip(*steps, strict=True))
        live = (a1 > a0) & (b1 > b0) & (bits <= budget) & ~((a0 == b0) & (a1 == b1) & (a1 - a0 == 1))
        a0, a1, b0, b1, bits = (x[live] for x in (a0, a1, b0, b1, bits))
    found_i.append(a0)  # depth used up: nodes are single rows
    found_j.append(b0)
    i, j = (np.concatenate(x) for x in (found_i, found_j))
    return np.minimum(i, j), np.maximum(i, j)


def shard_pairs(keys: np.ndarray, rest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of `trie_pairs` in parts, with bounded node pairs also where very many rows share a key.

    Rows of such a key are dealt once more, by two of the four octets of their rests: each pair within
    the budget agrees in two, and at most 65,536 rows then share all but 16 bits.
    """
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[edge, len(keys)])
    dense = np.repeat(size > DENSE_ROWS, size)
    few = np.flatnonzero(~dense)
    i, j = trie_pairs(keys[few], rest[few])
    yield few[i], few[j]
    for a, n in zip(edge[size > DENSE_ROWS].tolist(), size[size > DENSE_ROWS].tolist(), strict=True):
        own = rest[a : a + n]
        for k, (agree, other) in enumerate(DEALS):
            part, left = (own >> np.uint32(8 * x[0]) & np.uint32(0xFF) | (own >> np.uint32(8 * x[1]) & np.uint32(0xFF)) << np.uint32(8) for x in (agree, other))
            order = np.lexsort((left, part))
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for start in range(0, len(cuts) + 1, 4096):
                ends = np.r_[0, cuts, n]
                rows = order[ends[start] : ends[min(start + 4096, len(cuts) + 1)]]
                i, j = trie_pairs(part[rows], left[rows])
                i, j = rows[i], rows[j]
                first = first_deal(own[i] ^ own[j], 8)
                yield a + i[first == k], a + j[first == k]


def first_deal(differ: np.ndarray, width: int) -> np.ndarray:
    """The first deal in whose blocks of so many bits two values agree, from the bits in which they differ."""
    first = np.full(len(differ), -1)
    for k in range(len(DEALS) - 1, -1, -1):
        mask = differ.dtype.type(sum(((1 << width) - 1) << width * b for b in DEALS[k][0]))
        first[(differ & mask) == 0] = k
    return first


def _blocks(values: np.ndarray, pair: tuple[int, int]) -> np.ndarray:
    a, b = (values >> np.uint64(16 * k) & np.uint64(0xFFFF) for k in pair)
    return (a << np.uint64(16) | b).astype(np.uint32)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (deal, key, fp) sorted by deal and key -> linked fingerprints."""

    def walk(deal: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        for d in np.unique(deal):
            own = fp[deal == d].view(np.uint64)
            agree, other = DEALS[d]
            keys, rest = _blocks(own, agree), _blocks(own, other)
            order = np.lexsort((rest, keys))
            own, keys, rest = own[order], keys[order], rest[order]
            for i, j in shard_pairs(keys, rest):
                mine = first_deal(own[i] ^ own[j], 16) == d
                i, j = i[mine], j[mine]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(own[i].view(np.int64)), pa.array(own[j].view(np.int64))], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("deal", "key", "fp")))
        rows += batch.num_rows
        if rows >= CHUNK:
            deal, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            change = np.flatnonzero((deal[1:] != deal[:-1]) | (key[1:] != key[:-1]))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield from walk(deal[:cut], fp[:cut])
            held, rows = [(deal[cut:], key[cut:], fp[cut:])], len(deal) - cut
    if rows:
        deal, _, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        yield from walk(deal, fp)


def fingerprint_links(classes: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> pairs (a, b) that differ in one or two bits, each once."""
    dealt = []
    for k, (agree, _) in enumerate(DEALS):
        key = F.lit(0).cast("long")
        for block in agree:
            key = F.shiftleft(key, 16).bitwiseOR(F.shiftrightunsigned("fp", 16 * block).bitwiseAND(F.lit(0xFFFF).cast("long")))
        dealt.append(F.struct(F.lit(k).alias("deal"), key.alias("key")))
    rows = classes.select("fp", F.explode(F.array(*dealt)).alias("d")).select("d.deal", "d.key", "fp")
    rows = rows.repartition("deal", "key").sortWithinPartitions("deal", "key")
    return rows.mapInArrow(_links, "a long, b long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, class_id, component_id, kept) for each row of `docs` (doc_id, text; more columns are ignored).

    class_id is the least fingerprint of the component, component_id its least doc_id.

    Null and blank texts have fingerprint zero and link like any other. Repeated rows and ties stay
    as they are: the smallest doc_id of a component is its id. Rows with a null doc_id get their
    class's id too (null where no row of the component has an id). An empty table gives no rows.
    """
    rows = cut_lineage(fingerprints(docs))
    classes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = connected_components(fingerprint_links(classes).select("a", "b"))
    joined = classes.join(found, classes.fp == found.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    by_class = joined.join(joined.groupBy("c").agg(F.min("least").alias("component_id")), "c").select("fp", F.col("c").alias("class_id"), "component_id")
    return rows.join(by_class, "fp").select("doc_id", "fp", "class_id", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with its least doc_id stays.

    Rows that share this doc_id, or have none where no row of the component has one, leave one row.
    """
    found = simhash_components(docs).select("doc_id", "fp", "class_id", "component_id")
    found = cut_lineage(found)
    winner = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # What goes is known by doc_id, but for rows that tie for their component; these few are told apart by a number.
    ties = found.where(winner).groupBy("class_id").agg(F.count("*").alias("n"), F.first("component_id").alias("id")).where("n > 1 or id is null")
    tied = broadcast_if_small(ties.select("id").where("id is not null").distinct())
    losers = found.where(~winner & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__lost")).distinct()
    named = docs.where("doc_id is not null").join(broadcast_if_small(losers.join(found.where(winner), F.col("__lost") == F.col("doc_id"), "left_anti")), F.col("doc_id") == F.col("__lost"), "left_anti")
    single = named.join(tied, named.doc_id == tied.id, "left_anti")
    double = named.join(tied, named.doc_id == tied.id, "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.where("doc_id is null")
    out = single.unionByName(double)
    if nameless.limit(1).count():
        open_ = found.where("component_id is null").select("fp", "class_id").distinct()
        codes = nameless.withColumn("__text", F.xxhash64("text"))
        texts = nameless.groupBy(F.xxhash64("text").alias("doc_id")).agg(F.first("text").alias("text"))
        of_text = fingerprints(texts).join(open_, "fp").select(F.col("doc_id").alias("__text"), "class_id")
        out = out.unionByName(codes.join(of_text, "__text").dropDuplicates(["class_id"]).drop("__text", "class_id"))
    return out
