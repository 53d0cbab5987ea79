"""The filter audit against filters that are applied one after another, in every order."""

import random
import re
from fractions import Fraction
from itertools import permutations

from cairnframe.llm import audit


def failures(docs):
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(least.get(text or "", doc), doc)
    out = []
    for doc, text, _ in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), doc is not None and doc > least[t])
        out.append({c for c, x in zip("ABCDE", tests, strict=True) if x})
    return out


def plain(docs, labels):
    fails = failures(docs)
    out = []
    for part in {lang or "" for *_, lang in docs}:
        mine = [(d[0], f) for d, f in zip(docs, fails, strict=True) if (d[2] or "") == part]
        rows, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, c in enumerate(order, 1):
                gone = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                failing = sum(c in x[1] for x in mine)
                lost = [sum(any(i == d and row[k] == 1 for i, *row in labels) for d, _ in gone if d is not None) for k in (0, 1)]
                rows.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(x[1] == {c} for x in mine), *lost))
                total[c] += len(gone)
        out += [(*r, total[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def test_audit_against_all_orders(spark):
    r = random.Random(8)
    pool = [f"w{i}" for i in range(300)] + ["W#"] + ["AAA"] * 20
    texts = [None, "", " \t\n", "#", "a " * 100, "x\x0by\x0cz\r\n" * 40, " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(99)), "ABCDEFGHIJ" * 30]
    texts += [" ".join(r.choices(pool[: r.choice([150, 300, 301, 321])], k=r.randint(80, 160))) for _ in range(40)]
    texts += [" ".join(r.sample([p for p in pool if p[0] == "w"], r.randint(95, 200))) + r.choice(["", " $", " BIG" * 30]) for _ in range(40)]
    docs = [(i, t, r.choice(["en", "de", "", None])) for i, t in enumerate(texts * 2)]
    docs += [docs[5], docs[5], docs[30], (None, texts[40], "en"), (None, None, "xx"), (3, "other", "xx")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in r.sample(range(170), 90)] + [(7, 1, 1), (7, 0, 0), (None, 1, 1), (9999, 1, 1)]
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, text string, lang string, n int, mask string").repartition(5)
    marks = spark.createDataFrame([(*x, 5) for x in labels], "doc_id long, quality int, toxic int, part int")
    got = sorted(map(tuple, audit.audit_filters(df, marks).collect()))
    want = plain(docs, labels)
    assert got == want and {frozenset(x) for x in failures(docs)} >= {frozenset("ABCDE"[k]) for k in range(5)} - {frozenset("E")}
    assert audit.audit_filters(df.where("doc_id = -1"), marks).count() == 0
    assert audit.audit_filters(df, marks.where("doc_id = -1")).where("good_lost + toxic_lost > 0").count() == 0


def test_removal_polynomial():
    p = audit.RemovalPolynomial({0b00: 5, 0b01: 3, 0b10: 4, 0b11: 7}, 2)
    assert [p.at_corner(s) for s in range(4)] == [0, 10, 11, 14]
    assert p.partial_on_diagonal(0) == [3, 7] and p.shapley(0) == Fraction(13, 2) and p.shapley(0) + p.shapley(1) == 14
