"""URL filter: rules, canonical forms, list and Bloom filter."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnframe.llm import bloom, urls

CASES = [
    (None, "", "", None), ("", "", "", None), ("example.org/es/1", "", "", None), ("http://", "", "", None),
    ("http://A.Example.ORG/es/1?x=/de/", "a.example.org", "/es/1", "example.org/es/"),
    ("https://example.org/en/12#x", "example.org", "/en/12", "example.org/en/1"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/"), ("https://org/", "org", "/", "org/"),
    ("https://example.org", "example.org", "", None), ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/"),
    ("http://x.com/FR/1", "x.com", "/FR/1", None), ("http://x.com/fr/1", "x.com", "/fr/1", "com/fr/"),
    ("http://x.com/de", "x.com", "/de", None), ("http://x.com/de/?a", "x.com", "/de/", "com/de/"),
    ("http://ÄB.com/a\nb", "Äb.com", "/a\nb", None), ("x\ny://b.net?q://z", "b.net", "", None), ("a://b://c/d", "b:", "//c/d", None),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", True) for i, (u, *_) in enumerate(CASES)], "page_id long, url string, host string, listed boolean")
    nothing = spark.createDataFrame([], "url string")
    got = {x["page_id"]: x for x in urls.filter_urls(pages, nothing).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(CASES))] == [c[1:] for c in CASES]
    verdicts = {rule: verdict for verdict, rule in urls.RULES}
    assert all(x["verdict"] == verdicts.get(x["rule"], "allow") and not x["listed"] for x in got.values())
    assert urls.filter_urls(pages.where("page_id < 0"), pages.select("url")).count() == 0


def test_canonical_urls(spark):
    cases = {
        "HTTP://www.A.com:80/b/c.html?utm_source=x&z=2&a=1#t": "a.com/b/c?a=1&z=2",
        "https://a.com/b/c/": "a.com/b/c", "https://a.com": "a.com", "https://a.com/?ref=x": "a.com", "ftp://a.com:8080/": "a.com:8080",
        "https://a.com/b?reference=1": "a.com/b?reference=1", "a.com/b": None, None: None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert [x[0] for x in df.select(urls.canonical_url(F.col("url"))).collect()] == list(cases.values())


@pytest.mark.parametrize("max_block_bits", [1, 18])
def test_listed_urls(spark, max_block_bits):
    """Results are the same whether the filter is tight or lets nearly everything through."""
    r = random.Random(2)
    made = [f"{r.choice(['http', 'https'])}://{r.choice(['', 'www.'])}h{r.randint(0, 20)}.net/{r.randint(0, 40)}{r.choice(['', '/', '.html', '#a', '?ref=q'])}" for _ in range(3000)]
    made += ["https://h1.net/hot"] * 1000
    listed = [*r.sample(made, 300), *["http://h1.net/hot/"] * 5, None, "none"]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string")
    got = urls.filter_urls(pages, spark.createDataFrame([(u,) for u in listed], "url string"), max_block_bits=max_block_bits).collect()
    plain = lambda u: u.split("://")[-1].removeprefix("www.").split("#")[0].split("?")[0].removesuffix("/").removesuffix(".html")
    names = {plain(u) for u in listed if u}
    assert sorted((x["page_id"], x["verdict"]) for x in got) == [(i, "block" if plain(u) in names else "allow") for i, u in enumerate(made)]


def test_the_list_is_of_toxic_documents(spark):
    pages = spark.createDataFrame([("http://a.net/en/7",), ("http://a.net/en/7.html?x=1",), ("http://a.net/en/8",), ("http://a.net/",), (None,)], "url string")
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (None, 1)], "doc_id long, toxic int")
    assert sorted(x[0] for x in urls.toxic_pages(pages, labels).collect()) == ["http://a.net/en/7", "http://a.net/en/7.html?x=1"]


def test_filters_of_both_kinds_agree(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    bits = bloom.block_bits(20_000)
    blocks = bloom.build(keys.where("key is not null"), bits)
    other = spark.range(100_000, 150_000).select(F.xxhash64("id").alias("key"))
    got = bloom.with_possible(keys.unionByName(other), "key", blocks, bits).collect()
    array = bloom.as_array(blocks, bits)
    mine = bloom.possible_in(array, np.array([x["key"] for x in got], np.int64).astype(np.uint64))
    assert mine.tolist() == [x["possible"] for x in got]
    built = {x["key"] for x in keys.collect()}
    assert all(x["possible"] for x in got if x["key"] in built)
    assert sum(x["possible"] for x in got if x["key"] not in built) < 0.01 * 50_000
    assert bloom.block_bits(0) == 1 and bloom.block_bits(10**12) == bloom.MAX_BLOCK_BITS
