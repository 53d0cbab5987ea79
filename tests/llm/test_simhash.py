"""SimHash against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from cairnframe.llm import simhash


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values):
    label = dict(zip(values, values, strict=True))
    while True:
        new = {a: min(label[b] for b in values if bin((a ^ b) & (2**64 - 1)).count("1") <= 2) for a in values}
        if new == label:
            return label
        label = new


def test_fingerprint():
    r = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 40, 200):
        text = " ".join("".join(r.choices("abcEÉ", k=3)) for _ in range(n)) + "\x0b\t"
        assert simhash.fingerprint(text) == plain(text)


def test_trie_pairs_are_all_pairs():
    r = np.random.default_rng(3)
    base = r.integers(0, 2**32, 60, dtype=np.uint32)
    rows = {(int(k), int(b) ^ (1 << int(x)) ^ (1 << int(y))) for b in base for k, x, y in zip(r.integers(0, 3, 12), r.integers(0, 32, 12), r.integers(0, 32, 12), strict=True)}
    rows = sorted(rows | {(0, b ^ (1 << x)) for b in (0, 2**32 - 1) for x in range(32)})
    keys, rest = (np.array(c, np.uint32) for c in zip(*rows, strict=True))
    i, j = simhash.trie_pairs(keys, rest)
    want = {(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if keys[a] == keys[b] and bin(int(rest[a] ^ rest[b])).count("1") <= 2}
    assert len(i) == len(set(zip(i.tolist(), j.tolist(), strict=True))) and set(zip(i.tolist(), j.tolist(), strict=True)) == want


@pytest.mark.parametrize("dense", [2, 50])
def test_dense_keys_lose_nothing(monkeypatch, dense):
    r = np.random.default_rng(5)
    base = r.integers(0, 2**32, 30, dtype=np.uint32)
    rows = sorted({(k, int(b) ^ (1 << int(x)) ^ (1 << int(y))) for k in (1, 2) for b in base[: 30 // k] for x, y in r.integers(0, 32, (14, 2))} | {(9, 5), (9, 4)})
    keys, rest = (np.array(c, np.uint32) for c in zip(*rows, strict=True))
    whole = set(zip(*(x.tolist() for x in simhash.trie_pairs(keys, rest)), strict=True))
    monkeypatch.setattr(simhash, "DENSE_ROWS", dense)
    found = [(min(p), max(p)) for i, j in simhash.shard_pairs(keys, rest) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == whole and len(whole) > 500


def test_components_against_brute_force(spark):
    r = random.Random(2)
    words = ["".join(r.choices("abcdefg", k=4)) for _ in range(400)]
    rows = [(1000, None), (1001, ""), (1002, " \t"), (None, "one two three"), (7, "one two three"), (7, "one two three")]
    for g in range(40):
        base = r.choices(words, k=1500)
        for c in range(4):
            near = list(base)
            for _ in range(c):
                near[r.randrange(1500)] = r.choice(words)
            rows.append((2000 + g * 10 + c, " ".join(near)))
    docs = spark.createDataFrame([(*x, "z") for x in rows], "doc_id long, text string, fp string")
    got = simhash.simhash_components(docs).collect()
    value = {t: plain(t) for _, t in rows}
    label = components(sorted(set(value.values())))
    least = {}
    for i, t in rows:
        if i is not None:
            least[label[value[t]]] = min(i, least.get(label[value[t]], i))
    want = sorted((i if i is not None else -1, value[t] - (2**64 if value[t] >= 2**63 else 0), least[label[value[t]]]) for i, t in rows)
    assert sorted((x.doc_id if x.doc_id is not None else -1, x.fp, x.component_id) for x in got) == want
    assert len({x[2] for x in want}) < 130


def test_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_links_survive_chunks(spark, monkeypatch):
    base = [0x1234567890ABCDEF ^ (1 << b) for b in range(63)]
    classes = spark.createDataFrame([(b,) for b in base], "fp long")
    got = {frozenset(x) for x in simhash.fingerprint_links(classes).collect()}
    assert len(got) == 63 * 62 // 2 and simhash.fingerprint_links(classes).count() == len(got)
