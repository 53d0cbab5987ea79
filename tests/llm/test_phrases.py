"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cairnframe.llm import phrases

SMALL = "abcdefghijklmnopqrstuvwxyz"


def plain(docs, min_count, max_words, top, percent):
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, max_words + 1):
                f.update((lang, *w[i : i + n]) for i in range(len(w) - n + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    covered = Counter()
    for (lang, *w), a in candidates.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                part = (lang, *w[i : i + n])
                covered[part] = max(covered[part], a)
    rows = []
    for (lang, *w), a in candidates.items():
        if covered[(lang, *w)] * 100 >= percent * a and covered[(lang, *w)]:
            continue
        cuts = [(10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.append((lang, " ".join(w), a, f[(lang, *w[:k])], f[(lang, *w[k:])], total[lang], score))
    out = []
    for lang in total:
        best = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        out += [(lang, i, *r[1:]) for i, r in enumerate(best, 1)]
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    words = ["a", "b", "C", "ab", "é", "ÉÀ", "#x", "z\u00a0z", "日本", "\U0001f600"]
    gaps = [" ", "  ", "\t", " ", " ", ". ", "\n", "\r\n", ",", "\x0b", "?!"]
    weights = [20, 2, 1, 20, 20, 1, 1, 1, 1, 1, 1]
    docs = [(None, "en"), ("", "en"), (" \n.", None), ("A b C a B c", None), ("word", "und"), ("a b " * 50, "fr")]
    for _ in range(n):
        k = r.randint(1, 60)
        docs.append(("".join(r.choice(words) + r.choices(gaps, weights)[0] for _ in range(k)), r.choice(["en", "fr", None, "und", ""])))
    return docs + docs[6:16]


@pytest.mark.parametrize(("max_words", "shards"), [(3, {}), (2, {}), (5, {"shard_bytes": 700, "shard_words": 41}), (4, {"shard_bytes": 1, "shard_words": 3})])
def test_against_plain_counts(spark, max_words, shards):
    docs = corpus(5, 150)
    df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in docs], "text string, lang string, f int, phrase string").repartition(3)
    got = phrases.collocations(df, min_count=4, max_words=max_words, top=40, percent=60, **shards).collect()
    want = plain(docs, 4, max_words, 40, 60)
    assert sorted(map(tuple, got)) == want and len(want) > 100


def test_counts_do_not_lean_on_the_filter(spark, monkeypatch):
    """A filter of two blocks lets nearly all through; results stay."""
    docs = corpus(6, 60)
    df = spark.createDataFrame(docs, "text string, lang string")
    monkeypatch.setattr(phrases.bloom, "block_bits", lambda keys: 1)
    assert sorted(map(tuple, phrases.collocations(df, 3, 3, 100, 50).collect())) == plain(docs, 3, 3, 100, 50)


def test_exact_scores_beyond_64_bits(spark):
    rows = [("en", "", 9 * 10**13, 0), ("en", "a", 4 * 10**13 + 1, 1), ("en", "b", 3 * 10**13 + 7, 1), ("en", "a b", 2 * 10**13 + 3, 2)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, f long, size int")).collect()
    assert [x["score"] for x in got] == [10**6 * (2 * 10**13 + 3) ** 2 // ((4 * 10**13 + 1) * (3 * 10**13 + 7))]


def test_empty_tables_and_top(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0
    many = spark.createDataFrame([(f"p{i} q{i}\n" * 3, "en") for i in range(300)], "text string, lang string")
    got = phrases.collocations(many, min_count=3, top=150).orderBy("rank").collect()
    assert [x["phrase"] for x in got] == sorted(f"p{i} q{i}" for i in range(300))[:150] and [x["rank"] for x in got] == list(range(1, 151))


def test_suffix_arrays_and_prefixes():
    r = random.Random(3)
    text = " ".join(r.choice("ab") if r.random() < 0.9 else "a," for _ in range(400)).encode()
    words = phrases.words_of([text, b"", b"b a b"], ["x", "x", "y"])
    names = words.spelling.to_pylist()
    ids = [(words.langs[lang], names[w]) for w, lang in zip(words.word, words.lang, strict=True)]
    for length in (1, 2, 3, 5, 8):
        order = phrases.suffix_array(words, length)
        key = lambda i: [words.ids()[j] for j in range(i, min(i + length, len(ids))) if words.piece[j] == words.piece[i]]  # noqa: E731, B023
        keys = [key(i) for i in order]
        assert sorted(order.tolist()) == list(range(len(ids))) and keys == sorted(keys)
        shared = phrases.common_prefixes(words, order, length)
        want = [0] + [next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(keys, keys[1:])]  # noqa: B905
        assert shared.tolist() == want


def test_keys_agree_between_spark_and_numpy(spark):
    words = phrases.words_of(["Ab c é".encode(), b"c ab"], ["en", "fr"])
    keys = phrases.gram_keys(words, 2)[words.reaches(2)]
    df = spark.createDataFrame([("en", "ab c"), ("en", "c é"), ("fr", "c ab")], "lang string, phrase string")
    got = [x[0] for x in df.select(phrases.gram_key(df["lang"], df["phrase"])).collect()]
    assert got == keys.astype(np.int64).tolist()
