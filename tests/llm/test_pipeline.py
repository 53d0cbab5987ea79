"""The pipeline's stages, each against brute force on its own input."""

import corpus_pipeline
from cairnframe.llm import packing, simhash, toxicity
from tests.llm import test_repeats, test_simhash

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    step = corpus_pipeline.drop_toxic(spark, docs, SF)
    toxic = {r.doc_id for r in toxicity.toxicity_scores(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in step.collect()} == rows.keys() - toxic and step.columns == docs.columns

    step = corpus_pipeline.apply_quality_rules(spark, docs, SF)
    assert step.columns == docs.columns and 0 < step.count() < docs.count()

    step = corpus_pipeline.drop_near_copies(spark, docs, SF)
    value = {i: test_simhash.plain(r.text) for i, r in rows.items()}
    label = test_simhash.components(sorted(set(value.values())))
    least = {}
    for i in sorted(rows, reverse=True):
        least[label[value[i]]] = i
    assert sorted(r.doc_id for r in step.collect()) == sorted(least.values()) and step.columns == docs.columns

    step = corpus_pipeline.cut_repeats(spark, docs, SF)
    bytes_, words = corpus_pipeline.REPEAT_BYTES, corpus_pipeline.REPEAT_WORDS
    want = {x[0]: x for x in test_repeats.brute([(r.doc_id, r.text) for r in rows.values()], bytes_, words)}
    got = {r.doc_id: r for r in step.collect()}
    # Characters that a cut parts go, up to three bytes on either side.
    assert all(0 <= x[1] - x[2] - len(got[i].text.encode()) <= 6 * x[3] for i, x in want.items()) and step.columns == docs.columns
    assert sum(x[2] for x in want.values()) > 10_000
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_frequent_lines_are_taken_out(spark):
    own = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(60)]
    rows = [(i, f"{t}\n\n Read \tOUR terms of use\r\n{t} end", "a") for i, t in enumerate(own)] + [(None, f"read our terms of use\n{own[0]} z", "a"), (100, f"{own[0]}\nread our terms of use", "b")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.apply_quality_rules(spark, docs, SF).collect()}
    want = {i: f"{t}\n\n{t} end" for i, t in enumerate(own)} | {None: f"{own[0]} z", 100: rows[-1][1]}
    assert {i: r.text for i, r in got.items()} == {i: t for i, t in want.items() if i in got} and 100 in got and None in got
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_ties_and_rows_without_id(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (None, "x y z"), (None, "x y z"), (None, "X y z"), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, (r.text or "").lower()) for r in simhash.one_of_each(docs).collect())
    assert got == [(0, "x y z"), (1, "a b c d e"), (5, "")]


def test_run_is_the_stages_in_a_row(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == packing.pack(spark.read.parquet(f"{SF}/documents.parquet")).columns
    by_doc = {}
    for r in got.collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    assert 20 < len(by_doc) < 200
    assert all(sum(r.length for r in rows) == rows[0].doc_tokens for rows in by_doc.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash_near_dedup", "suffix_array_dedup", "packing"]


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_passages_of_little_more_than_fifty_words(spark):
    """A passage of 51 words, shorter than 400 bytes, in documents that have nothing else in common; texts without it stay."""
    import random

    r = random.Random(8)
    words = lambda n: " ".join("".join(r.choices("abcdefghijklm", k=r.randint(2, 8))) for _ in range(n))
    passage, short = words(51), words(40)
    assert 240 < len(passage) < 400
    texts = [f"{words(40)} {passage} {words(30)}" for _ in range(6)] + [f"{words(60)} {short} {words(20)}" for _ in range(4)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, SF).collect()}
    assert all(passage not in got[i] and len(got[i]) >= len(texts[i]) - len(passage) - 20 for i in range(6))
    assert all(got[i] == texts[i] for i in range(6, 10))


def test_odd_rows_through_all_stages(spark):
    """Nulls in every column, long texts, repeated rows, and columns whose names the operators use."""
    long = " ".join(f"w{k}" for k in range(60_000))
    prose = " ".join(f"t{k}" for k in range(50))
    rows = [(1, prose, "en", "s"), (1, prose, "en", "s"), (2, None, None, None), (None, f"{prose} x", None, None), (3, "", "en", None), (4, long, "en", "s"), (5, f"{long} end", None, "s"), (6, "\U0001f600 " * 30, "x", "y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, r1 long, fp string, words long, sequence_id string"
    docs = spark.createDataFrame([(*x, None, 0.5, True, 1, "f", 2, "q") for x in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS, name
        assert 0 < out.count() <= len(rows), name
    pieces = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {1, 2, None, 3, 4, 5, 6} and sum(p.length for p in pieces) > 100_000
