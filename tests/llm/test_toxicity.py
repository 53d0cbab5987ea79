"""Held-out accuracy, the effect of the counterfactuals, and odd rows."""

import random

import numpy as np

from cairnframe.llm import toxicity


def corpus(n=600, seed=9):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghij", k=5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text, toxic = r.choices(words, k=60), i % 4 == 0
        if toxic:
            text += r.choices(["rotten", "vile", "filth"], k=3)
        if r.random() < (0.6 if toxic else 0.02):
            text.append("muslims")
        if r.random() < 0.02:
            text.append("christians")
        r.shuffle(text)
        docs.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus()
    odd = [(9001, None), (9002, ""), (None, "vile filth rotten"), (3, docs[3][1])]
    labels += [(9001, 1, 0), (4, 1, 1), (None, 0, 1), (5, 0, None)]
    df = spark.createDataFrame([(*d, 0.5) for d in docs + odd], "doc_id long, text string, score double")
    lf = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(df, lf).collect()
    assert len(got) == len(docs) + len(odd)
    truth = {i: y for i, _, y in labels[:600]}
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 9000]
    assert 60 < len(held) < 180
    assert np.mean([x.predicted == truth[x.doc_id] for x in held]) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    assert [x.predicted for x in got if x.doc_id is None] == [1] and [x.predicted for x in got if x.doc_id == 9002] == [0]


def test_counterfactuals_lower_identity_weights():
    docs, labels = corpus(2000)
    rows = []
    for (_, text), (_, _, y) in zip(docs, labels, strict=True):
        w = toxicity.words_of(text)
        rows.append((toxicity.codes(w), y, [toxicity.codes(set(c)) for c in toxicity.counterfactuals(toxicity.tokens_of(text))]))
    fair, plain = toxicity.fit(rows)[0], toxicity.fit(rows, pair_weight=0.0)[0]
    gap = lambda m: m.get(toxicity.code("muslims"), 0) - m.get(toxicity.code("christians"), 0)
    assert gap(plain) > 0.5 and abs(gap(fair)) < 0.2 * gap(plain)
    assert fair[toxicity.code("vile")] > 1


def test_no_labels_and_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [x.score for x in toxicity.toxicity_scores(docs, labels).collect()] == [0.0]
    assert toxicity.toxicity_scores(docs.where("doc_id > 5"), labels).count() == 0
    one = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int")
    many = spark.createDataFrame([(i, f"word{i}") for i in range(20)], "doc_id long, text string")
    assert {x.predicted for x in toxicity.toxicity_scores(many, one).collect()} == {1}


def test_terms_are_swapped_in_their_sentences():
    tokens = toxicity.tokens_of("Women and men. The women left, a jew... Muslim!")
    got = toxicity.counterfactuals(tokens)
    assert got[0] == "men and girls the men left a jew christian".split()
    assert got[1] == "girls and boys the girls left a jew jewish".split()
    assert len(got) == 5 and got[4][-1] == "atheist" and all(len(x) == len(tokens) for x in got)
    assert {c[0] for c in got} == {"men", "girls", "boys"} and toxicity.counterfactuals(["plain"]) == []


def objective(rows, weights, intercept):
    """The penalised loss, word by word."""
    def logit(b):
        return intercept + sum(weights.get(int(c), 0.0) for c in np.frombuffer(b, "<i4"))

    loss = sum(np.logaddexp(0, logit(x)) - y * logit(x) for x, y, _ in rows)
    pairs = sum((logit(x) - logit(c)) ** 2 for x, _, others in rows for c in others)
    return loss + toxicity.RIDGE / 2 * sum(w * w for w in weights.values()) + toxicity.PAIR_WEIGHT * pairs


def test_scores_and_fit_against_plain_python(spark):
    docs, labels = corpus()
    docs += [(7, "another text of the same id"), (8, docs[8][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lf = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights, intercept = toxicity.learn(df, lf)
    for x, (_, text) in zip(sorted(toxicity.toxicity_scores(df, lf, keep=["doc_id", "text"]).collect(), key=lambda r: docs.index((r.doc_id, r.text))), docs, strict=False):
        assert abs(x.score - 1 / (1 + np.exp(-intercept - sum(weights.get(c, 0.0) for c in {toxicity.code(w) for w in toxicity.words_of(x.text)})))) < 1e-9
    rows = []
    for (_, text), (_, _, y) in zip(docs, labels, strict=False):
        tokens = toxicity.tokens_of(text)
        rows.append((toxicity.codes(set(tokens)), y, [toxicity.codes(set(c)) for c in toxicity.counterfactuals(tokens)]))
    weights, intercept = toxicity.fit(rows)
    least, r = objective(rows, weights, intercept), random.Random(2)
    for _ in range(12):  # the loss is convex: no step from the fit lowers it by more than the steps' tolerance
        near = {c: w + r.gauss(0, 0.02) for c, w in weights.items()}
        assert objective(rows, near, intercept + r.gauss(0, 0.02)) > least - 1e-3


def test_neutral_mentions_of_groups(spark):
    """Clean held-out texts with a neutral sentence about a group: hardly more are called toxic than without it."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    weights, intercept = toxicity.learn(docs, labels)
    clean = docs.join(labels.where("toxic = 0"), "doc_id").where(toxicity.held_out()).select("text").collect()
    score = lambda words: intercept + sum(weights.get(c, 0.0) for c in {toxicity.code(w) for w in words})
    plain = [score(toxicity.words_of(x.text)) >= 0 for x in clean]
    named = [score(toxicity.words_of(f"{x.text} The {t} live in the town.")) >= 0 for x in clean for t in toxicity.SWAPS]
    print(f"neutral mentions: {np.mean(named):.4f} of {len(named)} called toxic, {np.mean(plain):.4f} without")
    assert len(clean) > 50 and np.mean(named) <= np.mean(plain) + 0.01
