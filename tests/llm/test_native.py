"""Quality rules, chat formatting and license scans against plain Python, and their plans."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from cairnframe.llm import chat, licenses, quality, queries

SF = "/root/testdata/sf0.001"


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_quality(rows, limit, percent):
    """rows (doc_id, text, source) -> features as the operator's columns."""
    held = defaultdict(set)
    norm = lambda line: " ".join(word_list(line.lower()))
    for doc, text, source in rows:
        for x in (text or "").split("\n"):
            held[source, norm(x)].add(("text", text) if doc is None else doc)
    out = []
    for doc, text, source in rows:
        w = word_list(text)
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        often = Counter(grams)
        covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if word_list(x)]
        gone = sum(len(word_list(x)) for x in lines if len(held[source, norm(x)]) > limit)
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        empty = 100 * gone > percent * len(w)
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed, empty, not failed and not empty))
    return sorted(out, key=str)


def test_quality_against_plain_python(spark):
    r = random.Random(4)
    words = ["".join(r.choices("abcdéü#*", k=r.randint(1, 4))) for _ in range(40)]
    common = [" ".join(r.choices(words, k=9)) for _ in range(4)]
    rows = [(1, None, "s"), (2, "", "s"), (3, " \n\t", None), (None, " ".join(words), "t"), (4, " ".join(["ab"] * 30), "s"), (4, "x " * 50, "s")]
    for i in range(80):
        lines = [" ".join(r.choices(words, k=r.randint(1, 12))) for _ in range(r.randint(0, 3))] + r.sample(common, r.randint(0, 3))
        r.shuffle(lines)
        rows.append((100 + i, r.choice(["\n", "\r\n", "\n\n"]).join(lines), r.choice(["s", "t", None])))
    rows += [rows[10], rows[11], (500, rows[12][1], rows[12][2])]
    df = spark.createDataFrame([(*x, 1, True) for x in rows], "doc_id long, text string, source string, n_words int, kept boolean")
    got = quality.quality_rules(df, max_documents=5, max_removed_percent=40).collect()
    want = plain_quality(rows, 5, 40)
    assert sorted(map(tuple, got), key=str) == want and 0 < sum(x[7] for x in want) < len(want)
    assert quality.quality_rules(df.where("doc_id = -1")).count() == 0


def test_notices_that_many_documents_of_a_host_share(spark):
    """Thirty hosts with three notices of their own in every page, a host of one line, and pages at the limit."""
    r = random.Random(9)
    line = lambda n: " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))
    rows = []
    for host in range(30):
        notices = [line(30) for _ in range(3)]
        rows += [(1000 * host + i, "\n".join([line(8), *notices, line(8)]), f"h{host}") for i in range(200)]
    one, few = line(25), line(25)
    rows += [(50_000 + i, one, "same") for i in range(200)] + [(60_000 + i, few, "few") for i in range(quality.MAX_LINE_DOCUMENTS)]
    rows += [(70_000 + i, f"{line(60)}\n{one}", "same") for i in range(20)] + [(60_000, few, "few")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {x.doc_id: x for x in quality.quality_rules(docs, keep=["doc_id", "source"], with_text=True).collect()}
    assert len(got) == len(set(x[0] for x in rows))
    assert [i for i, x in got.items() if x.kept] == [i for i in got if i >= 60_000]
    assert all(one not in x.kept_text and x.kept_text for i, x in got.items() if i >= 70_000)


def plain_pairs(turns):
    by_pair = defaultdict(lambda: ([], []))
    for conv, turn, role, text in turns:
        if conv is not None:
            by_pair[conv // 2][conv % 2].append((-math.inf if turn is None else turn, role or "", text or ""))
    out = []
    for pair, sides in by_pair.items():
        steps = [defaultdict(list), defaultdict(list)]
        for s in (0, 1):
            for t, role, text in sorted(sides[s]):
                steps[s][t].append((role, text))
        numbers = sorted(set(steps[0]) | set(steps[1]))
        ends = next((t for t in numbers if steps[0].get(t) != steps[1].get(t)), math.inf)
        status = "unpaired" if not sides[0] or not sides[1] else "identical" if ends == math.inf else "paired"
        for s, part in ((0, "chosen"), (1, "rejected")):
            for t in numbers:
                for role, text in steps[s].get(t, []):
                    if t < ends and s == 1:
                        continue
                    name = "prompt" if t < ends else part
                    out.append((pair, name, None if t == -math.inf else t, role, f"<|im_start|>{role}\n{text}<|im_end|>\n", name != "prompt" and role == "assistant", status))
    return sorted(out, key=str)


def test_chat_against_plain_python(spark):
    r = random.Random(7)
    turns = [(None, 0, "user", "lost"), (100, 0, "user", "alone"), (101 + 4, 2, None, None)]
    for pair in range(30):
        shared = r.randint(0, 4)
        for side in (0, 1):
            turns += [(2 * pair + side, t, "user" if t % 2 == 0 else "assistant", f"p{pair} t{t}") for t in range(shared)]
            turns += [(2 * pair + side, shared + t, r.choice(["user", "assistant", None]), r.choice(["x", "y", None, ""])) for t in range(r.randint(0, 3))]
    turns += [(2, None, "system", "s"), (3, None, "system", "s"), (4, 1, "user", "again"), (4, 1, "user", "again"), turns[5]]
    df = spark.createDataFrame([(*t, "e") for t in turns], "conv_id long, turn long, role string, text string, part string")
    assert sorted(map(tuple, chat.preference_pairs(df).collect()), key=str) == plain_pairs(turns)
    assert chat.preference_pairs(df.where("conv_id < 0")).count() == 0


def plain_licenses(text):
    w = re.findall(r"[a-z0-9]+", (text or "").lower())
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = set()
    for name, notice in licenses.TEMPLATES:
        t = re.findall(r"[a-z0-9]+", notice.lower())
        own = {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
        c = 2 ** math.ceil(math.log2(len(own)))
        if any(len(own & set(grams[p : p + 2 * c])) >= 0.8 * len(own) for p in range(0, len(grams), c)):
            out.add(name)
    return ",".join(sorted(out))


def test_licenses_against_plain_python(spark):
    r = random.Random(5)
    filler = lambda n: " ".join("".join(r.choices("abcdefgh", k=4)) for _ in range(n))
    rows = [(1, None), (2, ""), (3, "the MIT License"), (None, "Released under the MIT license!"), (4, "released UNDER, the mit\nlicense")]
    for k, (_, notice) in enumerate(licenses.TEMPLATES):
        t = notice.split()
        rows += [(100 + k, f"{filler(r.randint(0, 300))} {notice} {filler(r.randint(0, 300))}"), (200 + k, filler(40) + " " + " ".join(t[: len(t) // 2]))]
        rows.append((300 + k, filler(20) + " " + " ".join(x for x in t if r.random() > 0.02) + " " + filler(20)))
    rows.append((900, rows[6][1]))
    df = spark.createDataFrame([(*x, "q") for x in rows], "doc_id long, text string, license string")
    got = licenses.license_summary(df).collect()
    assert sorted((str(x.doc_id), x.licenses) for x in got) == sorted((str(i), plain_licenses(t)) for i, t in rows)
    assert sum(x.n_licenses > 0 for x in got) >= len(licenses.TEMPLATES)
    assert licenses.license_summary(df.where("doc_id = -1")).count() == 0


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    if name in ("op6_licenses", "op8_chat", "op10_quality"):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)
    cols = sorted(got.columns)
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == Counter(tuple(r[names.index(c)] for c in cols) for r in want.fetchall())
