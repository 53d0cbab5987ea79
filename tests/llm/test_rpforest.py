"""The forest against all pairs."""

import numpy as np
import pytest

from cairnframe.llm import rpforest


def brute(rows):
    good = [k for k, (_, e, label) in enumerate(rows) if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(np.array(rows[k][1], float)) for k in good}
    links = {k: {j for j in good if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.98} for k in good}
    label = {k: rows[k][0] for k in range(len(rows))}
    for _ in range(len(rows)):
        new = {k: min([label[k], *(label[j] for j in links.get(k, ()))]) for k in label}
        if new == label:
            break
        label = new
    return sorted((rows[k][0], len(links.get(k, ())), label[k], rows[k][0] == label[k]) for k in label)


def sample(n_base=120, dim=32, seed=4):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(n_base):
        base = r.standard_normal(dim)
        for c in range(int(r.integers(1, 6))):
            near = base + r.standard_normal(dim) * 0.11 * c / 3
            rows.append((near.astype(np.float32).tolist(), int(r.integers(0, 2))))
    rows += [rows[5], rows[5], rows[6]]
    r.shuffle(rows)
    out = [(k, e, label) for k, (e, label) in enumerate(rows)]
    n = len(out)
    zero, nan = [0.0] * dim, [float("nan")] + [1.0] * (dim - 1)
    return out + [(n, None, 1), (n + 1, zero, 1), (n + 2, nan, 1), (n + 3, [None] + [1.0] * (dim - 1), 1), (n + 4, rows[0][0], None), (n + 5, [], 1), (n + 6, [1.0] * 8, 1), (n + 7, [2.0] * 8, 1), (n + 8, [-0.0, 1.0] * 4, 1), (n + 9, [0.0, 1.0] * 4, 1), (n + 10, [float("inf")] * 8, 1)]


@pytest.mark.parametrize("leaf_rows", [16, 512])
def test_against_all_pairs(spark, leaf_rows):
    rows = sample()
    df = spark.createDataFrame([(*x, "n") for x in rows], "vec_id long, embedding array<float>, label int, node string")
    got = sorted(tuple(x) for x in rpforest.embedding_components(df, leaf_rows=leaf_rows).collect())
    want = brute(rows)
    if leaf_rows == 512:
        assert got == want
    else:  # deep trees may lose a few of the barely linked pairs
        assert [x[0] for x in got] == [x[0] for x in want] and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
        assert sum(x[1] for x in got) >= 0.99 * sum(x[1] for x in want)


def test_dense_group_is_counted_once(spark):
    r = np.random.default_rng(1)
    base = r.standard_normal(16)
    rows = [(k, (base + 0.001 * r.standard_normal(16)).tolist(), 3) for k in range(300)]
    got = rpforest.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), leaf_rows=32).collect()
    assert {(x.n_links, x.component_id) for x in got} == {(299, 0)}


def test_noisy_near_copies_beyond_a_leaf(spark):
    """A label with more near copies than a leaf should hold, of which about half of the pairs are links."""
    r = np.random.default_rng(0)
    base = r.standard_normal(32)
    near = base / np.linalg.norm(base) + r.standard_normal((700, 32)) * np.sqrt((1 / 0.98 - 1) / 32)
    vectors = np.r_[near, r.standard_normal((1000, 32))]
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    got = {x.vec_id: x.n_links for x in rpforest.embedding_components(df).collect()}
    assert want.sum() > 150_000 and [got[k] for k in range(len(vectors))] == want.tolist()


def test_chunks_of_a_dense_label(spark):
    """A label that no split makes smaller, cut into chunks that are compared by pairs."""
    r = np.random.default_rng(7)
    base = r.standard_normal(32)
    near = base / np.linalg.norm(base) + r.standard_normal((400, 32)) * np.sqrt((1 / 0.98 - 1) / 32)
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(near)], "vec_id long, embedding array<double>, label int")
    unit = near / np.linalg.norm(near, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    got = {x.vec_id: x for x in rpforest.embedding_components(df, leaf_rows=64, chunk_rows=60).collect()}
    assert want.sum() > 40_000 and [got[k].n_links for k in range(400)] == want.tolist()


@pytest.mark.parametrize(("share", "least"), [(0.3, 4), (1.5, 7), (16, 11), (3000, 20)])
def test_recall_at_depth(share, least):
    """Planted pairs of cosine 0.98 to 0.985: how many share a leaf, at depths as for `share` times as many vectors."""
    r = np.random.default_rng(5)
    dim, n = 64, 20_000
    wide = r.standard_normal((n, dim))
    wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    side = r.standard_normal((1000, dim))
    side -= (side * wide[:1000]).sum(axis=1, keepdims=True) * wide[:1000]
    cosine = r.uniform(0.98, 0.985, (1000, 1))
    twins = cosine * wide[:1000] + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    forest = rpforest.Forest(wide, np.zeros(n, int), share)
    rows, leaves = forest.leaves(np.r_[wide[:1000], twins])
    own = [set() for _ in range(2000)]
    for row, leaf in zip(rows.tolist(), leaves.tolist(), strict=True):
        own[row].add(leaf)
    recall = np.mean([not own[k].isdisjoint(own[1000 + k]) for k in range(1000)])
    print(f"{forest.levels} levels: recall {recall:.4f}, {len(rows) / 2000:.1f} leaves a vector")
    assert forest.levels >= least and recall > 0.99
    if share < 50:
        rows, leaves = forest.leaves(wide)
        assert np.bincount(np.unique(leaves, return_inverse=True)[1]).mean() * share < rpforest.LEAF_ROWS


def test_empty_and_unusable(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert rpforest.embedding_components(spark.createDataFrame([], schema)).count() == 0
    got = rpforest.embedding_components(spark.createDataFrame([(1, None, 1), (None, [0.0], 1)], schema)).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 0, 1, True), (None, 0, None, False)]
