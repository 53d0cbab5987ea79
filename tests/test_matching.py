"""The matching cascade against plain loops, and crowds that must not be paired."""

import math
import random
import time

from pyspark.sql import functions as F

from cairnframe.operators import matching


def plain(rows, candidates, radius):
    people = sorted({(c[0], *c[2:]) for c in candidates})
    often = {}
    for r in rows:
        often[r[2]] = often.get(r[2], 0) + 1
    apart = lambda r, c: None if None in (*r[-2:], *c[-2:]) else math.hypot(r[-2] - c[-2], r[-1] - c[-1])
    out = []
    for r in rows:
        number, gid, nr, name = r[:4]
        ids = sorted({(c[0], apart(r, c)) for c in candidates if gid and c[1] == gid}, key=str)
        if ids:
            out.append((number, *(("matched", "globalid", *ids[0], None) if len(ids) == 1 else ("unresolved", None, None, None, "GLOBALID_AMBIGUOUS"))))
            continue
        same = [(c[0], apart(r, c), c[2]) for c in people if nr and c[1] == nr]
        close = [x for x in same if x[1] is not None and x[1] <= radius]
        named = [x for x in close if name and x[2] == name]
        if same:
            if often[nr] > 1:
                found = ("nr_inwent_name_distance", named[0]) if len(named) == 1 else None
            elif len(same) == 1:
                found = ("nr_inwent", same[0])
            elif len(named) == 1:
                found = ("nr_inwent_name_distance", named[0])
            else:
                found = ("nr_inwent_distance", close[0]) if len(close) == 1 else None
            out.append((number, *(("matched", found[0], *found[1][:2], None) if found else ("unresolved", None, None, None, "NR_INWENT_AMBIGUOUS"))))
            continue
        alike = [(c[0], apart(r, c)) for c in people if name and c[2] == name and apart(r, c) is not None and apart(r, c) <= radius]
        if not alike:
            out.append((number, "new", None, None, None, None))
        else:
            out.append((number, *(("matched", "name_distance", *alike[0], None) if len(alike) == 1 else ("unresolved", None, None, None, "NAME_DISTANCE_AMBIGUOUS"))))
    return sorted(out)


def test_against_plain_loops(spark):
    r = random.Random(21)
    place = lambda: (r.choice([None, r.uniform(0, 60), r.uniform(0, 400), float(r.randint(0, 8) * 25)]), r.uniform(0, 60))
    key = lambda kinds: r.choice([None, "", *kinds])
    rows = [(i, key(f"g{k}" for k in range(40)) if r.random() < 0.2 else None, key(f"n{k}" for k in range(300)), key(f"w{k}" for k in range(8)), *place()) for i in range(400)]
    candidates = [(1000 + i, f"g{r.randint(0, 60)}", key(f"n{k}" for k in range(120)), key(f"w{k}" for k in range(8)), *place()) for i in range(120)]
    candidates += [(c[0], "g-more", *c[2:]) for c in candidates[:20]] + candidates[:3]
    rows += [(900, None, "u1", "zz", 0.0, 0.0), (901, None, "u2", "zz", 0.0, 0.0)]
    candidates += [(2000, "q1", "u1", "a", 5.0, 5.0), (2001, "q2", "u1", "b", 300.0, 300.0), (2002, "q3", "u2", "zz", 5.0, 5.0), (2003, "q4", "u2", "b", 6.0, 6.0)]
    schema = "{} long, globalid string, nr string, name_norm string, x double, y double"
    got = matching.match_cascade(spark.createDataFrame(rows, schema.format("record_number")), spark.createDataFrame(candidates, schema.format("candidate_id")))
    got = sorted((x.record_number, x.status, x.strategy, x.candidate_id, None if x.distance_m is None else round(x.distance_m, 6), x.issue) for x in got.collect())
    want = [(*x[:4], None if x[4] is None else round(x[4], 6), x[5]) for x in plain(rows, candidates, matching.RADIUS_M)]
    assert got == want and len({x[1:3] for x in want}) == 7 and len({x[5] for x in want}) == 4


def test_one_number_of_very_many_rows_in_one_place(spark):
    """60,000 rows and as many candidates of one number and name, within some metres: their pairs would be 3.6 thousand millions."""
    n = 60_000
    spot = lambda k: (F.lit("HOT").alias("nr"), F.lit("name").alias("name_norm"), (F.rand(k) * 5).alias("x"), (F.rand(k + 1) * 5).alias("y"))
    rows = spark.range(n).select(F.col("id").alias("record_number"), F.lit(None).cast("string").alias("globalid"), *spot(1))
    candidates = spark.range(n).select(F.col("id").alias("candidate_id"), F.lit(None).cast("string").alias("globalid"), *spot(5))
    start = time.perf_counter()
    got = matching.match_cascade(rows, candidates).groupBy("status", "issue").count().collect()
    assert [tuple(x) for x in got] == [("unresolved", "NR_INWENT_AMBIGUOUS", n)] and time.perf_counter() - start < 90
