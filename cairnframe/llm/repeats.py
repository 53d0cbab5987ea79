"""Removal of repeated byte strings with suffix arrays over shards (operator 4).

Every byte covered by a string of `length` bytes that starts anywhere else too is removed. To bring
equal strings together without sorting all suffixes of the corpus in one place:

1. Each window of `passage` bytes (at most `length`) is filed under its minimizer, the least hash of
   its K-byte strings; equal windows have equal minimizers. Successive windows with one minimizer form
   a segment, which reaches on to the end of the last string of `length` bytes that starts in it.
   Only hashes and places of segments are shuffled; those of minimizers that occur once go at once.
2. Equal segments form a class; a class that occurs twice is repeated throughout and is not sorted
   again for itself. Minimizers with several classes, and segments that may repeat inside
   themselves, go on with the bytes of one member of each class.
3. Minimizers are dealt to shards by the first place at which they occur. Segments that follow each
   other there and in the copies so meet in one shard and are laid out as one piece, with no byte
   twice. A shard's suffix array is built by induced sorting; its permuted common prefixes give, for
   each position, the longest string that starts elsewhere too, and so the windows of both lengths.
   A minimizer with more bytes than a shard may hold is split first, see `split_hot`.
4. What is covered goes back to all members of a class and to the documents, which are cut.

Hashes have 64 bits; a row, a minimizer with its segment, and a class are known by two of them.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged, text_batches
from .sais import permuted_prefixes, suffix_array

LENGTH = 400
#: A shorter string and a number of words: what is covered by such strings and holds more words is a passage.
PASSAGE, PASSAGE_WORDS = 240, 50
#: Bytes that are hashed for minimizers.
K = 48
#: Bytes of segments in a shard, and bytes of one minimizer beyond which it is split.
SHARD_BYTES, HOT_BYTES = 1_000_000, 1_000_000
#: Minimizers whose first places are in the same so many bytes of a row go to one shard.
BLOCK = 4096
#: Places of a hot minimizer in its windows that stay together when it is split.
WIDTH = 16
_U = np.uint64


def window_hashes(text: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each window of `length` bytes, by joining windows of powers of two."""
    if len(text) < length:
        return np.zeros(0, _U)
    h = _mix(text.astype(_U) + _U(1 + 1000 * seed))
    out, done, size, m = None, 0, 1, length
    while True:
        if m & 1:
            n = len(text) - done - size + 1
            part = h[done : done + n]
            out = part if out is None else _mix(out[:n] * _U(0xD6E8FEB86659FD93) + part)
            done += size
        m >>= 1
        if not m:
            return out[: len(text) - length + 1]
        h = _mix(h[:-size] * _U(0x9E3779B97F4A7C15) + h[size:])
        size *= 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    return x


def sliding(x: np.ndarray, width: int, least: np.ufunc = np.minimum) -> np.ndarray:
    """The minimum (or maximum) of each `width` neighbours."""
    size, n = 1, len(x) - width + 1
    while 2 * size <= width:
        x = least(x[:-size], x[size:])
        size *= 2
    return least(x[:n], x[width - size : width - size + n])


def digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def segments(text: bytes, length: int, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(minimizer, identity, start, windows, size, place) of a text's segments.

    `size` counts the bytes up to the end of the last string of `length` bytes (or of the text);
    `place` is where the minimizer stands in the segment, -1 if it stands there more than once.
    """
    data = np.frombuffer(text, np.uint8)
    width = window - k + 1
    h = window_hashes(data, k)
    least = sliding(h, width)
    start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    windows = np.diff(np.r_[start, len(least)])
    # Places of minimizers: hashes that are the least of some window around them; runs of equal ones belong to one segment.
    padded = np.concatenate([np.zeros(width - 1, _U), least, np.zeros(width - 1, _U)])
    at = np.flatnonzero(sliding(padded, width, np.maximum) == h)
    first = np.flatnonzero(np.r_[True, h[at][1:] != h[at][:-1]])
    place = np.where(np.diff(np.r_[first, len(at)]) == 1, at[first] - start, -1)
    size = np.minimum(windows + length - 1, len(data) - start)
    identity = np.array([digest(text[a : a + n]) for a, n in zip(start.tolist(), size.tolist(), strict=True)], np.int64)
    return least[start].view(np.int64), identity, start, windows, size, place


class Suffixes:
    """The suffixes of some pieces, sorted, with the common prefixes of neighbours."""

    def __init__(self, pieces: list[bytes]) -> None:
        sizes = np.array([len(p) for p in pieces])
        text = np.frombuffer(b"".join([p + b"\0" for p in pieces]), np.uint8).astype(np.uint16) + 2
        ends = np.cumsum(sizes + 1) - 1
        text[ends] = 1  # separators; they may match each other, but no string inside a piece holds one
        text = np.append(text, 0).astype(np.uint16)
        self.starts = ends - sizes
        self.order = suffix_array(text)
        self.prefix = permuted_prefixes(text, self.order)[self.order]

    def repeated(self, asked: np.ndarray, length: int) -> np.ndarray:
        """Of the positions `asked` (true or false for each), those whose string of `length` bytes starts at another of them too.

        Pieces may hold bytes of one place twice; no place may be asked for twice.
        """
        run = np.cumsum(self.prefix < length)
        own = asked[self.order]
        out = np.zeros(len(asked), bool)
        out[self.order] = own & (np.bincount(run, weights=own)[run] > 1)
        return out


def ranges(found: np.ndarray) -> list[int]:
    """Runs of true as [from, to, from, to, ...]."""
    return np.flatnonzero(np.diff(np.r_[False, found, False].astype(np.int8))).tolist()


def alike(group: list[tuple[bytes, int, bool]], window: int, k: int) -> list[bool]:
    """Which segments (bytes, place, sure) of one minimizer must be sorted: those of which a window may occur in another.

    Around its minimizer a window reaches half of the other bytes to the left or to the right at
    least; so equal windows share that many bytes on one side. Where a segment holds its minimizer
    more than once, all stay.
    """
    if all(sure for _, _, sure in group):
        return [False] * len(group)
    if any(p < 0 for _, p, _ in group):
        return [True] * len(group)
    half = (window - k + 1) // 2
    sides = [(piece[p - half : p] if p >= half else None, piece[p + k : p + k + half] if p + k + half <= len(piece) else None) for piece, p, _ in group]
    left, right = (Counter(x) for x in zip(*sides, strict=True))
    return [x is not None and left[x] > 1 or y is not None and right[y] > 1 for x, y in sides]


Sorted = tuple[int, int, list[int], list[int]]
SORTED = "a long, s long, runs array<long>, short array<long>"


class Shard:
    """Rows of segments that are sorted together: (piece, a, s, at, n, size, place, sure), the last seven as lists."""

    def __init__(self, length: int, window: int, k: int) -> None:
        self.length, self.window, self.k = length, window, k
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.bytes += len(row[0])

    def results(self, most: int) -> Iterator[Sorted]:
        """(a, s, runs, short) of all classes of which not all is known yet; suffix arrays span about `most` bytes."""
        groups: dict[int, dict[int, tuple[int, int]]] = {}
        for r, row in enumerate(self.rows):
            for i, (a, s) in enumerate(zip(row[1], row[2], strict=True)):
                groups.setdefault(a, {}).setdefault(s, (r, i))  # repeated rows of a document give their segments again
        part: set[tuple[int, int]] = set()
        size = 0
        for group in groups.values():
            members = list(group.values())
            cut = []
            for r, i in members:
                piece, _, _, at, _, sizes, place, sure = self.rows[r]
                cut.append((piece[at[i] : at[i] + sizes[i]], place[i], sure[i]))
            for m, (piece, _, _), stays in zip(members, cut, alike(cut, self.window, self.k), strict=True):
                if stays:
                    part.add(m)
                    size += len(piece)
            if size >= most:
                yield from self._sort(part)
                part, size = set(), 0
        yield from self._sort(part)
        self.rows, self.bytes = [], 0

    def _sort(self, part: set[tuple[int, int]]) -> Iterator[Sorted]:
        pieces, members, last = [], [], (-1, -1)
        for r, i in sorted(part):
            row = self.rows[r]
            if (r, i - 1) != last:  # a new piece; neighbours in a row go on where the segment before ends
                members.append([])
                pieces.append((r, row[3][i], 0))
            members[-1].append(i)
            pieces[-1] = (r, pieces[-1][1], row[3][i] + row[5][i])
            last = (r, i)
        if not pieces:
            return
        suffixes = Suffixes([self.rows[r][0][a:b] for r, a, b in pieces])
        places = [(r, i, int(begin) + self.rows[r][3][i] - first) for (r, first, _), own, begin in zip(pieces, members, suffixes.starts, strict=True) for i in own]
        found = []
        for length in {self.length: 0, self.window: 0}:
            asked = np.zeros(len(suffixes.order), bool)
            for r, i, at in places:
                asked[at : at + min(self.rows[r][4][i], max(self.rows[r][5][i] - length + 1, 0))] = True
            found.append(suffixes.repeated(asked, length))
        for r, i, at in places:
            _, a, s, _, n, _, _, sure = self.rows[r]
            if not sure[i]:
                lists = [ranges(f[at : at + n[i]]) for f in found]
                if any(lists):
                    yield a[i], s[i], lists[0], lists[1] if len(lists) > 1 else []


def sorted_batch(found: list[Sorted]) -> pa.RecordBatch:
    a, s, runs, short = zip(*found, strict=True) if found else ((), (), (), ())
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(s, pa.int64()), pa.array(runs, longs), pa.array(short, longs)], names=["a", "s", "runs", "short"])


PIECES = "k1 long, k2 long, k3 long, piece binary, a array<long>, s array<long>, at array<long>, n array<long>, size array<long>, place array<long>, sure array<boolean>"
_LISTS = ("a", "s", "at", "n", "size", "place", "sure")


def sorted_shards(pieces: DataFrame, length: int, window: int, k: int, shard_bytes: int) -> DataFrame:
    """(a, s, runs, short) of classes with repeated strings, by suffix arrays; rows of one key stay together."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = Shard(length, window, k), None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "k3")), strict=True))
            for key, *row in zip(keys, batch.column("piece").to_pylist(), *(batch.column(c).to_pylist() for c in _LISTS), strict=True):
                if key != last and shard.bytes >= shard_bytes:
                    yield sorted_batch(list(shard.results(shard_bytes)))
                last = key
                shard.add(tuple(row))
        yield sorted_batch(list(shard.results(shard_bytes)))

    return pieces.repartition("k1", "k2", "k3").sortWithinPartitions("k1", "k2", "k3").mapInArrow(sort, SORTED)


def fetched(docs: DataFrame, classes: DataFrame, join: bool) -> DataFrame:
    """The bytes of one member of each class, as rows of PIECES; with `join` successive segments of a key make one row.

    All columns of `docs` go along: so this join deals the same rows as the one that cuts the texts, and Spark deals them once.
    """
    fields = [F.col("at.start").alias("start"), F.col("at.start").alias("at"), *(F.col(c).alias(c) for c in ("a", "s", "n", "size", "place", "k1", "k2", "k3")), (F.col("times") > 1).alias("sure")]
    wanted = classes.groupBy(F.col("at.r1").alias("r1"), F.col("at.r2").alias("r2")).agg(F.collect_list(F.struct(*fields)).alias("want"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, want in zip(batch.column("text"), batch.column("want"), strict=True):
                data, rows = text.as_py().encode("utf-8", "surrogatepass"), want.values
                value = {c: rows.field(c).to_numpy(zero_copy_only=False) for c in ("start", "k1", "k2", "k3", *_LISTS)}
                order = np.argsort(value["start"], kind="stable")
                value = {c: v[order] for c, v in value.items()}
                ends = value["start"] + value["n"]
                new = np.ones(len(order), bool)
                if join:
                    new[1:] = (value["start"][1:] != ends[:-1]) | np.logical_or.reduce([value[c][1:] != value[c][:-1] for c in ("k1", "k2", "k3")])
                first = np.flatnonzero(new)
                for z in range(0, len(first), 500):
                    own = first[z : z + 500]
                    stop = np.r_[first[1:], len(order)][z : z + 500]
                    begin, end = value["start"][own], value["start"][stop - 1] + value["size"][stop - 1]
                    offsets, at = np.r_[own, stop[-1]] - own[0], slice(own[0], stop[-1])
                    lists = value | {"at": value["start"] - np.repeat(value["start"][first], np.diff(np.r_[first, len(order)]))}
                    arrays = [pa.array(value[c][own]) for c in ("k1", "k2", "k3")] + [pa.array([data[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())]
                    arrays += [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(lists[c][at])) for c in _LISTS]
                    yield pa.RecordBatch.from_arrays(arrays, names=["k1", "k2", "k3", "piece", *_LISTS])

    return docs.join(wanted, ["r1", "r2"]).mapInArrow(take, PIECES)


def split_hot(pieces: DataFrame, length: int, window: int, k: int, shard_bytes: int, hot_bytes: int) -> DataFrame:
    """The same for minimizers with too many bytes for a shard: longer common strings take their place.

    Windows are told apart by where the minimizer stands in them, in ranges of `WIDTH` places; all
    windows of a range hold a common core around the minimizer, and the core's hash is the new key.
    Equal windows have equal cores. Equal parts form classes again. Keys that are still too large are
    split to single places, where the core is the window itself and its count decides.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, a, s, n, sure in zip(*(batch.column(c).to_pylist() for c in ("piece", "a", "s", "n", "sure")), strict=True):
                at = np.flatnonzero(window_hashes(np.frombuffer(piece, np.uint8), k).view(np.int64) == a[0])
                own = at[np.searchsorted(at, np.arange(n[0]))]  # the first minimizer in each window
                part = (own - np.arange(n[0])) // WIDTH
                first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (part[1:] != part[:-1])])
                out = []
                for x, m in zip(first.tolist(), np.diff(np.r_[first, n[0]]).tolist(), strict=True):
                    r, q = int(part[x]), int(own[x])
                    core, rest = piece[q - r * WIDTH : q - (r + 1) * WIDTH + 1 + window], piece[x : x + m + length - 1]
                    out.append((a[0], s[0], sure[0], x, digest(b"%d|" % r + core), digest(rest), m, len(rest), rest))
                types = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["a", "s", "sure", "x", "g", "t", "m", "size", "rest"])

    parts = staged(pieces.dropDuplicates(["k1", "k2"]).mapInArrow(split, "a long, s long, sure boolean, x long, g long, t long, m long, size long, rest binary"), "parts")
    classes = parts.groupBy("g", "t").agg(F.sum(F.when(F.col("sure"), 2).otherwise(1)).alias("times"), F.first("m").alias("m"), F.first("size").alias("size"))
    groups = classes.groupBy("g").agg(F.sum("times").alias("all"), F.count_if(F.col("times") == 1).alias("single"), F.sum("size").alias("bytes"))
    judged = staged(classes.join(groups, "g").where("all > 1"), "judged")
    none, zero, whole = F.array().cast("array<long>"), F.lit(0).cast("long"), lambda n: F.array(F.lit(0).cast("long"), n.cast("long"))
    longer = F.when(F.col("size") >= length, whole(F.col("size") - length + 1)).otherwise(none)
    found = judged.where("times > 1").select(F.col("g").alias("a"), F.col("t").alias("s"), longer.alias("runs"), (whole(F.col("m")) if window < length else none).alias("short"))
    rests = parts.select("g", "t", "rest").dropDuplicates(["g", "t"])
    lists = [F.array(c).alias(n) for n, c in (("a", F.col("g")), ("s", F.col("t")), ("at", zero), ("n", F.col("m")), ("size", F.col("size")), ("place", F.lit(-1).cast("long")), ("sure", F.col("times") > 1))]
    members = judged.where("single > 0").join(rests, ["g", "t"]).select((F.col("bytes") > hot_bytes).alias("hot"), F.col("g").alias("k1"), zero.alias("k2"), zero.alias("k3"), F.col("rest").alias("piece"), *lists)
    members = staged(members, "members")
    found = found.unionByName(sorted_shards(members.where("not hot"), length, window, k, shard_bytes))
    if members.where("hot").limit(1).count():
        found = found.unionByName(split_places(members.where("hot"), length, window))
    found = found.select(F.col("a").alias("g"), F.col("s").alias("t"), "runs", "short")
    shift = lambda c: F.flatten(F.collect_list(F.transform(c, lambda v: v + F.col("x"))))
    return parts.where("not sure").join(found, ["g", "t"]).groupBy("a", "s").agg(shift("runs").alias("runs"), shift("short").alias("short"))


def split_places(members: DataFrame, length: int, window: int) -> DataFrame:
    """Members of keys that are still too large: each window by itself, decided by its count."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, a, s, n, sure in zip(*(batch.column(c).to_pylist() for c in ("piece", "a", "s", "n", "sure")), strict=True):
                at = np.arange(n[0])
                w = [digest(piece[i : i + window]) for i in at.tolist()]
                x = [digest(b"+" + piece[i : i + length]) if i + length <= len(piece) else None for i in at.tolist()]
                m = len(at)
                yield pa.RecordBatch.from_arrays([pa.array(a * m), pa.array(s * m), pa.array(sure * m), pa.array(at), pa.array(w), pa.array(x, pa.int64())], names=["a", "s", "sure", "i", "w", "x"])

    windows = staged(members.mapInArrow(each, "a long, s long, sure boolean, i long, w long, x long"), "windows")
    one = F.when(F.col("sure"), 2).otherwise(1)
    # Windows of one key are compared, so key and hash have 128 bits together.
    short = windows.groupBy("a", "w").agg(F.sum(one).alias("c")).where("c > 1").select("a", "w", F.lit(True).alias("short"))
    long_ = windows.where("x is not null").groupBy("a", "x").agg(F.sum(one).alias("c")).where("c > 1").select("a", "x", F.lit(True).alias("long"))
    hit = windows.where("not sure").join(short, ["a", "w"]).join(long_, ["a", "x"], "left")
    runs = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col(c), F.col("i")))), lambda i: F.array(i, i + 1)))
    none = F.array().cast("array<long>")
    return hit.groupBy("a", "s").agg(runs("long").alias("runs"), (runs("short") if window < length else F.any_value(none)).alias("short"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, passage: int | None = None, k: int = K, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(r1, r2, covered, short): for each row of `docs` (r1 long, r2 long, text, any others) with repeats, byte ranges as [from, to, ...] in no order.

    `covered` is what repeated strings of `length` bytes cover, `short` what those of `passage` bytes cover.
    """
    window = passage or length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, r1, r2 = [], [], []
            for x, y, text in zip(*(batch.column(c).to_pylist() for c in ("r1", "r2", "text")), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                if len(data) >= window:
                    parts.append(segments(data, length, window, k))
                    r1.append(np.full(len(parts[-1][0]), x, np.int64))
                    r2.append(np.full(len(parts[-1][0]), y, np.int64))
            if parts:
                a, s, start, n, size, place = (np.concatenate(x) for x in zip(*parts, strict=True))
                arrays = [pa.array(np.concatenate(x)) for x in (r1, r2)] + [pa.array(a), pa.array(s), *(pa.array(x, pa.int64()) for x in (start, n, size, place))]
                yield pa.RecordBatch.from_arrays(arrays, names=["r1", "r2", "a", "s", "start", "n", "size", "place"])

    places = staged(docs.select("r1", "r2", "text").mapInArrow(cut, "r1 long, r2 long, a long, s long, start long, n long, size long, place long"), "segments")
    twice = places.groupBy("a").agg(F.count("*").alias("c"), F.min("place").alias("p")).where("c > 1 or p < 0").select("a")
    places = staged(places.join(broadcast_if_small(twice), "a", "left_semi"), "repeated")
    classes = places.groupBy("a", "s").agg(F.count("*").alias("times"), F.min(F.struct("r1", "r2", "start")).alias("at"), *(F.first(c).alias(c) for c in ("n", "size", "place")))
    groups = classes.groupBy("a").agg(F.count("*").alias("classes"), F.count_if(F.col("times") == 1).alias("single"), F.min("place").alias("p"), F.min("at").alias("leader"), F.sum("size").alias("bytes"))
    # A minimizer with a good part of a shard is a key of its own; the others follow their neighbours.
    alone, where = F.col("bytes") > shard_bytes // 8, F.col("leader")
    keys = [F.when(alone, F.col("a")).otherwise(where["r1"]).alias("k1"), F.when(alone, 0).otherwise(where["r2"]).cast("long").alias("k2"), F.when(alone, -1).otherwise(F.floor(where["start"] / BLOCK)).cast("long").alias("k3")]
    groups = groups.where("single > 0 and (classes > 1 or p < 0)").select("a", *keys, (F.col("bytes") > hot_bytes).alias("hot"))
    classes = staged(classes.join(groups, "a", "left").where("times > 1 or hot is not null"), "classes")
    none = F.array().cast("array<long>")
    whole = lambda n: F.array(F.lit(0).cast("long"), n)
    longer = F.when(F.col("size") >= length, whole(F.col("size") - length + 1)).otherwise(none)
    covered = classes.where("times > 1").select("a", "s", longer.alias("runs"), (whole(F.col("n")) if window < length else none).alias("short"))
    covered = covered.unionByName(sorted_shards(fetched(docs, classes.where("not hot"), True), length, window, k, shard_bytes))
    hot = classes.where("hot").withColumns({"k1": F.col("a"), "k2": F.col("s"), "k3": F.lit(0).cast("long")})
    if hot.limit(1).count():
        # Few documents hold a first member of these classes, and only their texts are shuffled.
        holders = broadcast_if_small(hot.select(F.col("at.r1").alias("r1"), F.col("at.r2").alias("r2")).distinct())
        few = docs.select("r1", "r2", "text").join(holders, ["r1", "r2"], "left_semi")
        covered = covered.unionByName(split_hot(fetched(few, hot, False), length, window, k, shard_bytes, hot_bytes))
    spans = places.select("r1", "r2", "a", "s", "start").join(covered, ["a", "s"])
    shift = lambda c, n: F.flatten(F.collect_list(F.transform(c, lambda x, i: F.col("start") + x + F.when(i % 2 == 1, n - 1).otherwise(0))))
    return spans.groupBy("r1", "r2").agg(shift("runs", length).alias("covered"), shift("short", window).alias("short"))


def maximal_runs(spans: pa.Scalar) -> list[tuple[int, int]]:
    """Ranges [from, to, ...] in any order as maximal runs in order."""
    if not spans.is_valid or not len(spans.values):
        return []
    ends = spans.values.to_numpy().reshape(-1, 2)
    ends = ends[np.argsort(ends[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ends[:, 1])
    new = np.r_[True, ends[1:, 0] > reach[:-1]]
    return list(zip(ends[new, 0].tolist(), reach[np.r_[new[1:], True]].tolist(), strict=True))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: list[str] | None = None, with_text: bool = False, min_words: int = 0, passage: int | None = None, **limits: int) -> DataFrame:
    """(keep columns, n_bytes, n_removed, n_spans, kept_sha256[, n_passages][, kept_text]) for each row of `docs`.

    Every byte covered by a string of `length` bytes that starts elsewhere too is removed; of the
    maximal runs of such bytes only those of at least `min_words` words (cut ones count) if that is
    given. With `passage` n_passages counts the maximal runs that repeated strings of so many bytes
    cover and that hold more than PASSAGE_WORDS words; this removes nothing.

    `docs` has doc_id and text; `keep` is doc_id unless given. Null and empty texts have no bytes.
    Rows that repeat a text are elsewhere for each other, so they lose all of it from `length`
    bytes on. Texts are UTF-8 and of any length. `kept_text` leaves out bytes of characters that
    were cut. An empty table gives no rows.
    """
    spark, keep = docs.sparkSession, keep or ["doc_id"]
    text_batches(spark)
    names = [f"__keep_{k}" for k in range(len(keep))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id").alias("r1"), F.xxhash64("text").alias("r2"))
    covered = repeated_ranges(rows, length, passage, **limits)
    extra = ["n_passages"] * bool(passage) + ["kept_text"] * with_text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spans, short in zip(batch.column("text"), batch.column("covered"), batch.column("short"), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                removed = n = at = 0
                kept = []
                for a, b in maximal_runs(spans):
                    if min_words and len(data[a:b].split()) < min_words:
                        continue
                    kept.append(data[at:a])
                    removed, n, at = removed + b - a, n + 1, b
                rest = b"".join([*kept, data[at:]])
                passages = sum(len(data[a:b].split()) > PASSAGE_WORDS for a, b in maximal_runs(short if passage and passage < length else spans))
                out.append((len(data), removed, n, hashlib.sha256(rest).hexdigest(), passages, rest.decode("utf-8", "ignore") if with_text else None))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            made = dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "kept_text"), columns, strict=True))
            arrays = [*(batch.column(c) for c in names)]
            arrays += [pa.array(made[c], pa.string() if c in ("kept_sha256", "kept_text") else pa.int64()) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", *extra)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", *extra])

    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, keep, strict=True)) + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += "".join(f", {c} {'string' if c == 'kept_text' else 'long'}" for c in extra)
    out = rows.join(covered, ["r1", "r2"], "left").select(*names, "text", "covered", "short").mapInArrow(cut, schema)
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)), "n_bytes", "n_removed", "n_spans", "kept_sha256", *extra)


#: Brute force over all windows, in hexadecimal digits; words of a run are counted in its bytes.
SQL = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), size AS (SELECT unnest([{LENGTH}, {PASSAGE}]) AS l), w AS (
  SELECT l, doc_id, unnest(list_transform(range(0, greatest(length(h) // 2 - l + 1, 0)), lambda i: hash(substring(h, 2 * i + 1, 2 * l)))) AS g,
    unnest(range(0, greatest(length(h) // 2 - l + 1, 0))) AS i FROM d, size
), twice AS (SELECT l, g FROM w GROUP BY ALL HAVING count(*) > 1), hit AS (
  SELECT l, doc_id, i FROM w SEMI JOIN twice USING (l, g)
), edge AS (
  SELECT l, doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY l, doc_id ORDER BY i) + l THEN 0 ELSE 1 END AS new FROM hit
), runs AS (
  SELECT l, doc_id, k, min(i) AS a, max(i) + l AS b FROM (SELECT *, sum(new) OVER (PARTITION BY l, doc_id ORDER BY i) AS k FROM edge) GROUP BY 1, 2, 3
), span AS (SELECT doc_id, k, a, b FROM runs WHERE l = {LENGTH}), gap AS (
  SELECT doc_id, k, b AS c, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY k), 1000000000) AS e FROM span
  UNION ALL SELECT doc_id, 0, 0, min(a) FROM span GROUP BY 1
), kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * c + 1, 2 * (e - c)), '' ORDER BY k) AS rest FROM gap JOIN d USING (doc_id) GROUP BY 1
), sums AS (
  SELECT doc_id, sum(b - a) AS r, count(*) AS s FROM span GROUP BY 1
), words AS (
  SELECT doc_id, len(regexp_extract_all(regexp_replace(substring(h, 2 * a + 1, 2 * (b - a)), '(..)', '\\1,', 'g'), '(?:(?:[13-9A-F].|2[1-9A-F]|0[0-8EF]),)+')) AS n
  FROM runs JOIN d USING (doc_id) WHERE l = {PASSAGE}
), passages AS (SELECT doc_id, count(*) AS p FROM words WHERE n > {PASSAGE_WORDS} GROUP BY 1)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(s, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256, coalesce(p, 0)::BIGINT AS n_passages
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id) LEFT JOIN passages USING (doc_id)
"""
