"""Repeated strings against a count of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from cairnframe.llm import repeats


def covered(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        yield gone


def runs(gone):
    at = [0, *gone, 0]
    edges = [i for i in range(len(at) - 1) if at[i] != at[i + 1]]
    return list(zip(edges[::2], edges[1::2], strict=True))


def brute(rows, length, min_words=0, passage=None):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    short = covered(texts, passage) if passage else texts
    for (doc, _), t, gone, marks in zip(rows, texts, covered(texts, length), short, strict=True):
        spans = [(a, b) for a, b in runs(gone) if len(t[a:b].split()) >= min_words]
        rest = t
        for a, b in reversed(spans):
            rest = rest[:a] + rest[b:]
        passages = [sum(len(t[a:b].split()) > repeats.PASSAGE_WORDS for a, b in runs(marks))] if passage else []
        out.append((doc, len(t), len(t) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), *passages))
    return sorted(out, key=str)


def corpus(seed=6):
    r = random.Random(seed)
    text = lambda n: "".join(r.choices("abcdefgh é", k=n))
    passage, edge = text(120), text(39)
    rows = [(1, None), (2, ""), (3, text(39)), (4, "a" * 300), (5, "xyz" * 60), (6, edge), (7, edge + "q")]
    for i in range(60):
        a, b = r.randrange(0, 60), r.randrange(60, 121)
        rows.append((100 + i, text(r.randrange(0, 150)) + passage[a:b] + text(r.randrange(0, 150))))
    rows += [(200, text(200)), (201, rows[20][1]), (None, rows[21][1]), (203, rows[22][1][:-1] + "#"), (100, rows[7][1])]
    return rows


@pytest.mark.parametrize(("hot_bytes", "shard_bytes", "passage"), [(2_000_000, 2_000_000, None), (200, 500, None), (900, 500, 24), (2_000_000, 500, 24)])
def test_against_all_windows(spark, hot_bytes, shard_bytes, passage):
    rows = corpus()
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, start long")
    got = repeats.remove_repeats(df, length=40, passage=passage, k=8, hot_bytes=hot_bytes, shard_bytes=shard_bytes).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(rows, 40, passage=passage)


@pytest.mark.parametrize("hot_bytes", [300, 2_000_000])
def test_short_strings_of_long_ones(spark, hot_bytes):
    """Ranges of both lengths, from one set of suffix arrays."""
    rows = [(k, t) for k, (_, t) in enumerate(corpus(9))]
    df = spark.createDataFrame([(k, -k, t) for k, t in rows], "r1 long, r2 long, text string")
    got = {r.r1: r for r in repeats.repeated_ranges(df, 40, 24, k=8, hot_bytes=hot_bytes, shard_bytes=700).collect()}
    texts = [(t or "").encode() for _, t in rows]
    for name, length in (("covered", 40), ("short", 24)):
        for k, gone in enumerate(covered(texts, length)):
            mine = bytearray(len(gone))
            spans = got[k][name] if k in got else []
            for a, b in zip(spans[::2], spans[1::2], strict=True):
                mine[a:b] = b"\1" * (b - a)
            assert mine == gone


def test_small_table_with_production_parameters(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted((tuple(x) for x in repeats.remove_repeats(df, passage=repeats.PASSAGE).collect()), key=str)
    assert got == brute(rows, repeats.LENGTH, passage=repeats.PASSAGE)
    assert any(x[2] for x in got) and any(x[5] for x in got)
    got = sorted((tuple(x) for x in repeats.remove_repeats(df, length=240, min_words=51).collect()), key=str)
    assert got == brute(rows, 240, min_words=51)


def test_kept_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "é" * 30 + "-" + "abc"), (2, "é" * 30 + "+")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in repeats.remove_repeats(df, length=20, k=4, with_text=True).collect()}
    assert got == {1: "-abc", 2: "+"}
    assert repeats.remove_repeats(df.where("doc_id > 5")).count() == 0


def test_texts_are_dealt_once(spark):
    """Also with minimizers that are split; a shuffle hardly compresses random digits."""
    r = random.Random(1)
    passage = r.randbytes(60).hex()
    rows = [(i, r.randbytes(20_000).hex() + (passage + str(i) * 20 if i < 30 else "")) for i in range(150)] + [(999, "")]
    rows += [(1000 + i, r.randbytes(300).hex() + rows[i][1][:300] + r.randbytes(300).hex()) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).localCheckpoint()
    status, bus = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    written = lambda: (bus.waitUntilEmpty(), status.executorSummary("driver").totalShuffleWrite())[1]
    before = written()
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, -1)  # as for large tables
    try:
        got = repeats.remove_repeats(df, length=200, hot_bytes=1800).collect()
    finally:
        spark.conf.unset(key)
    assert written() - before < 1.6 * sum(len(t) for _, t in rows)
    assert sorted((tuple(x) for x in got), key=str) == brute(rows, 200)
