"""Embedding near-duplicates by a forest of random-projection trees with spill overlap (operator 1).

Equal vectors of a label collapse to one class first. Each tree splits the space again and again
along random directions, as long as a node is expected to hold more than `LEAF_ROWS` classes of a
label; a vector that lies within the spill margin of a split goes to both sides. Thresholds are
medians of a bounded sample. Where a node holds too few rows of the sample, its further splits take
the medians of its nearest ancestor with enough of them, so the depth follows the counted size of
the table and leaves do not grow with it. Classes that meet in a leaf and have the same label are all
compared exactly, in double precision and in blocks; large leaves are cut into chunks, and the pairs
of chunks are dealt to tasks. A pair counts only in the first leaf that both have in common over all
trees, so links can be counted in the leaves without listing pairs, and a pair that one tree parts
still counts in another; for the components each task hands on a spanning forest of its links.

Loss: the chord of a linked pair is at most c = sqrt(2 - 2 * 0.98) = 0.2; along a random direction in
d dimensions it is about normal with a deviation of c / sqrt(d). The margin is half of this deviation
to each side. A split parts such a pair for good only if it is stretched over the whole spill zone;
in the worst case (cosine just 0.98) the probability is about a sixth of the share of the node's
vectors that lie in the zone (some 8 % of widely spread vectors), and less for closer pairs. Splits
with more than `MAX_ZONE` of the vectors in the zone, as in groups of noisy near copies, are not
made: such groups stay whole. The shares above a leaf add up to `MAX_SPILL` at most (some 30 levels),
so a tree loses less than half of the worst pairs, and all trees together less than 2^-TREES.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut_lineage, staged
from .components import connected_components

MIN_COSINE, TREES = 0.98, 6
#: Vectors that fit the splits, whatever the size of the table; all vectors are then dealt to leaves.
SAMPLE_ROWS = 20_000
#: Classes of a label that a leaf should hold; groups that can't be split without loss stay larger and are compared whole.
LEAF_ROWS = 512
#: The share of a node's vectors that may lie in the spill zone of its split, and the sum of the shares on the way to a leaf.
MAX_ZONE, MAX_SPILL = 0.35, 2.5
#: Rows of the sample that a node must hold to have medians of its own.
MIN_SAMPLE = 64
#: Rows and columns of a block of cosines, and classes of a label and leaf that one task holds of either side.
BLOCK, CHUNK_ROWS = 1024, 4096


class Forest:
    """The splits of all trees: one direction a level and tree, one threshold a node, NaN where a node is a leaf.

    Nodes are numbered as in a heap, from 1, across trees. `labels` are the sample's labels as small
    integers, and `share` is the number of classes that a row of the sample stands for. Below a node
    with few rows of the sample (an anchor) thresholds depend on the anchor and the level only, and so
    does the number of levels; both are kept once for the anchor.
    """

    def __init__(self, sample: np.ndarray, labels: np.ndarray, share: float = 1.0, leaf_rows: int = LEAF_ROWS, trees: int = TREES, seed: int = 11) -> None:
        self.trees, self.seed, self.dim = trees, seed, sample.shape[1]
        self.margin = 0.5 * np.sqrt(2 - 2 * MIN_COSINE) / np.sqrt(self.dim)
        # A step: threshold, numbers of the two children (-1: a leaf). All trees share one list, the roots come first.
        self.threshold, self.child, self.level = [np.nan] * trees, [(-1, -1)] * trees, [0] * trees
        for t in range(trees):
            todo = [(t, np.arange(len(sample)), 0, 0.0, 1.0)]
            while todo:
                node, rows, level, spilt, scale = todo.pop()
                most = np.bincount(labels[rows]).max() * share * scale if len(rows) else 0
                if most <= leaf_rows or len(rows) < 2:
                    continue
                along = sample[rows] @ self.direction(t, level)
                middle = float(np.median(along))
                left, right = along <= middle + self.margin, along >= middle - self.margin
                zone = float(np.mean(left & right))
                if zone > MAX_ZONE or spilt + zone > MAX_SPILL:
                    continue
                few = len(rows) < MIN_SAMPLE  # an anchor: both children go on with all its rows, as one node
                first = len(self.threshold)
                self.threshold[node], self.child[node] = middle, (first, first if few else first + 1)
                for side in [rows] if few else [rows[left], rows[right]]:
                    todo.append((len(self.threshold), side, level + 1, spilt + zone, scale * (0.5 + zone / 2) if few else scale))
                    self.threshold.append(np.nan)
                    self.child.append((-1, -1))
                    self.level.append(level + 1)
        self.levels = max(self.level)
        self.threshold, self.child = np.array(self.threshold), np.array(self.child)

    def direction(self, tree: int, level: int) -> np.ndarray:
        d = np.random.default_rng((self.seed, tree, level)).standard_normal(self.dim)
        return d / np.linalg.norm(d)

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of unit vectors, a row for each leaf; leaf numbers rise from tree to tree.

        A leaf is its way from the root: a bit for each level, after the bits of the tree and a leading 1.
        """
        rows, leaves = [], []
        for t in range(self.trees):
            row, node, way = np.arange(len(unit)), np.full(len(unit), t), np.ones(len(unit), np.int64)
            ended_rows, ended_ways = [], []
            for k in range(self.levels + 1):
                done = np.isnan(self.threshold[node])
                ended_rows.append(row[done])
                ended_ways.append(way[done] << (self.levels - k))  # leaves of all depths differ: what is below is not reached
                row, node, way = row[~done], node[~done], way[~done]
                if not len(row):
                    break
                along = (unit @ self.direction(t, k))[row] - self.threshold[node]
                left, right = along <= self.margin, along >= -self.margin
                below = self.child[node]
                row, node, way = np.r_[row[left], row[right]], np.r_[below[left, 0], below[right, 1]], np.r_[2 * way[left], 2 * way[right] + 1]
            rows += ended_rows
            leaves += [x + (np.int64(t) << (self.levels + 1)) for x in ended_ways]
        return np.concatenate(rows), np.concatenate(leaves)


def unit_rows(vectors: list, dim: int) -> np.ndarray:
    """Unit vectors in double precision; shorter ones are filled up with zeros."""
    out = np.zeros((len(vectors), dim))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def met_before(leaf: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row i of `a` and row j of `b` share a leaf with a lesser number, for all (i, j); both hold leaf numbers, filled up with -1."""
    shared = np.intersect1d(a[(a >= 0) & (a < leaf)], b[(b >= 0) & (b < leaf)])
    if not len(shared):
        return np.zeros((len(a), len(b)), bool)
    held = []
    for own in (a, b):
        at = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
        row, k = np.nonzero(shared[at] == own)
        one = np.zeros((len(own), len(shared)), np.float32)
        one[row, at[row, k]] = 1
        held.append(one)
    return held[0] @ held[1].T > 0


def compare_leaf(leaf: int, unit: np.ndarray, leaves: np.ndarray, cut: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with a cosine of `MIN_COSINE` or more whose first common leaf is this one; with `cut` only pairs of rows before it with others."""
    for x in range(0, len(unit) if cut is None else cut, BLOCK):
        rise = min(x + BLOCK, len(unit) if cut is None else cut)
        for y in range(x if cut is None else cut, len(unit), BLOCK):
            near = unit[x:rise] @ unit[y : y + BLOCK].T >= MIN_COSINE
            if cut is None and x == y:
                near = np.triu(near, 1)
            rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if not len(rows):
                continue
            new = near[np.ix_(rows, columns)] & ~met_before(leaf, leaves[x + rows], leaves[y + columns])
            i, j = np.nonzero(new)
            if len(i):
                yield x + rows[i], y + columns[j]


class Forests:
    """Union-find over the rows of a leaf; keeps the links that join two trees."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def add(self, p: np.ndarray, q: np.ndarray) -> None:
        parent = self.parent
        for a, b in zip(p.tolist(), q.tolist(), strict=True):
            x, y = a, b
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.links.append((a, b))


def usable(embedding: str) -> Column:
    """Not null, not zero, and no null or non-finite component."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & ~bad & F.exists(embedding, lambda x: x != 0)


def class_code() -> tuple[Column, Column]:
    """A code of label and vector in two parts of 60 bits each, from a SHA-256: equal only for equal rows."""
    whole = F.sha2(F.concat_ws("|", F.length("label").cast("string"), "label", F.array_join(F.transform("embedding", lambda x: (x.cast("double") + F.lit(0.0)).cast("string")), ",")), 256)
    return tuple(F.conv(F.substring(whole, at, 15), 16, 10).cast("long") for at in (1, 16))


def embedding_components(vectors: DataFrame, trees: int = TREES, leaf_rows: int = LEAF_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, embedding, label).

    Vectors are compared when their labels are equal and not null and they have the same length.
    Null, empty and zero vectors and those with null or non-finite components link with nothing.
    Repeated rows are vectors of their own, so each counts as a link of the others. Rows that link
    with nothing have their own id as component (null where vec_id is null). An empty table gives
    no rows. Columns besides these three are ignored.
    """
    # Floats are shipped as they are; all arithmetic is in double precision.
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast(kind))
    good = F.col("label").isNotNull() & usable("embedding")
    rows = rows.withColumns({f"code{k}": F.when(good, c) for k, c in enumerate(class_code())})
    copies = rows.where("code0 is not null").groupBy("code0", "code1").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    # The numbers hold because the checkpoint does; nothing else is made of them.
    classes = cut_lineage(copies.withColumn("node", F.monotonically_increasing_id()))
    size = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not size[0]:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    dim = size[1]
    sample = classes.orderBy("code0", "code1").limit(SAMPLE_ROWS).select("embedding", F.concat_ws("|", F.size("embedding"), "label").alias("label")).collect()
    labels = np.unique([r.label for r in sample], return_inverse=True)[1]
    forest = Forest(unit_rows([r.embedding for r in sample], dim), labels, size[0] / len(sample), leaf_rows, trees)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            row, leaf = forest.leaves(unit_rows(batch["embedding"].tolist(), dim))
            order = np.lexsort((leaf, row))
            row, leaf = row[order], leaf[order]
            own = np.split(leaf, np.searchsorted(row, np.arange(1, len(batch))))
            for start in range(0, len(row), 20_000):
                r, at = row[start : start + 20_000], leaf[start : start + 20_000]
                part = batch.iloc[r]
                yield pd.DataFrame({"leaf": at, "label": part["label"].to_numpy(), "node": part["node"].to_numpy(), "n": part["n"].to_numpy(), "embedding": part["embedding"].to_numpy(), "leaves": [own[x] for x in r]})

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk", kind="stable")
        cut = int((pdf["chunk"] == key[2]).sum()) if key[2] != key[3] else None
        node, n = pdf["node"].to_numpy(), pdf["n"].to_numpy()
        counts = np.zeros(len(node), np.int64)
        wide = max(map(len, pdf["leaves"]))
        leaves = np.full((len(node), wide), -1, np.int64)
        for k, own in enumerate(pdf["leaves"]):
            leaves[k, : len(own)] = own
        unit, links = unit_rows(pdf["embedding"].tolist(), dim), Forests(len(node))
        for p, q in compare_leaf(key[0], unit, leaves, cut):
            np.add.at(counts, p, n[q])
            np.add.at(counts, q, n[p])
            links.add(p, q)
        some = np.flatnonzero(counts)
        ends = np.array(links.links, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": np.r_[node[some], node[ends[:, 0]]], "b": np.r_[node[some], node[ends[:, 1]]], "n": np.r_[counts[some], np.zeros(len(ends), np.int64)]})

    dealt = classes.withColumn("dim", F.size("embedding")).select("node", "n", F.concat_ws("|", "dim", "label").alias("label"), "embedding")
    dealt = dealt.mapInPandas(deal, f"leaf long, label string, node long, n long, embedding {kind}, leaves array<long>")
    if forest.levels or size[0] > chunk_rows:
        dealt = staged(dealt, "leaves")
    # A leaf that no split could make small is cut into chunks, and a task compares two of them.
    large = dealt.groupBy("leaf", "label").count().where(F.col("count") > chunk_rows)
    large = broadcast_if_small(large.select("leaf", "label", F.ceil(F.col("count") / chunk_rows).cast("int").alias("chunks")))
    chunks = F.coalesce("chunks", F.lit(1))
    dealt = dealt.join(large, ["leaf", "label"], "left").withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), chunks - 1), lambda o: F.struct(F.least(F.col("chunk"), o.cast("int")).alias("x"), F.greatest(F.col("chunk"), o.cast("int")).alias("y")))
    dealt = dealt.select("leaf", "label", "node", "n", "embedding", "leaves", "chunk", F.explode(meets).alias("at")).select("*", "at.x", "at.y").drop("at")
    found = cut_lineage(dealt.groupBy("leaf", "label", "x", "y").applyInPandas(compare, "a long, b long, n long"))
    counts = found.where("a = b").groupBy("a").agg(F.sum("n").alias("others"))
    linked = connected_components(found.where("a <> b").select("a", "b"))
    joined = classes.select("node", "code0", "code1", "least", "n").join(counts.withColumnRenamed("a", "node"), "node", "left").join(linked, "node", "left")
    joined = joined.select("code0", "code1", "least", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("c"))
    least = joined.groupBy("c").agg(F.min("least").alias("component_id"))
    by_node = joined.join(least, "c").select("code0", "code1", "n_links", "component_id")
    all_rows = rows.select("vec_id", "code0", "code1").join(by_node, ["code0", "code1"], "left")
    component = F.coalesce("component_id", "vec_id")
    return all_rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


#: Brute force over all pairs.
SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), parts AS (SELECT a, min(b) AS c FROM reach GROUP BY 1), degrees AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c::BIGINT AS component_id, vec_id = c AS kept
FROM embeddings JOIN parts ON parts.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id
"""
