"""Main texts against a plain reading of the generator's pages, and pages of other makes."""

import html as lib
import random
import re
import time

import numpy as np
import pytest

from cairnframe.llm import html

PAGE = '<html><head><title>T</title></head><body>{}</body></html>'


def plain(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    inner = re.sub(r"<(?:/?(?:p|h1)|br)>", " ", inner)
    return " ".join(lib.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_all_pages_of_the_small_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html.main_texts(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_article_without_its_surroundings():
    body = """<header><h1>Site</h1></header><nav>menu</nav><div class="cookie-notice">We use</div>
    <main><article><header><h1>Title &amp; more</h1><span>by x</span></header><p>One<b>two</b>
    three&nbsp;four<p>five<br>six<ul><li>a<li>b</ul><aside>side</aside><form>mail <input></form><script>x("</p>")</script>
    <!-- <p>no</p> --><div class=advert>buy</div><table><tr><td>1<td>2</table><section id="comments"><p>nice</p></section></article></main>
    <footer>&copy; me</footer>"""
    assert html.extract_group([PAGE.format(body)]) == ["Title & more Onetwo three four five six a b 1 2"]


def test_names_of_whole_pages_hide_nothing():
    body = '<div class="sidebar-layout has-comments"><article class="post no-ads"><p>Body text</p><div class="comments"><article class="comment">nice</article></div></article><div class="related"><article>Other</article></div></div>'
    page = f'<html><body class="with-sidebar ads"><div role="search">find</div>{body}</body></html>'
    assert html.extract_group([page]) == ["Body text"]
    assert html.extract_group(['<body class="menu"><div>plain</div><div class="menu">m</div></body>']) == ["plain"]


def test_matching_is_by_names_in_order():
    a, b = (html.parse(s) for s in ("<div><h1>a</h1><p>b</p><p>c</p><ul><li>d</li></ul></div>", "<div><h1>x</h1><ol></ol><p>y</p><ul><li>z</li><li>w</li></ul><h2></h2></div>"))
    score, pairs = html.match(a, b)
    assert score == len(pairs) == 6 and all(p.name == q.name for p, q in pairs)


def test_wrapper_of_pages_without_article():
    page = lambda k: PAGE.format(f"<div class=top><span>My Site</span><div>Since 1999</div></div><div class=text><h2>Head {k}</h2><div>Words of {k}</div><div>Always the same disclaimer here</div></div>")
    got = html.extract_group([page(k) for k in range(6)])
    assert got == [f"Head {k} Words of {k}" for k in range(6)]
    assert html.extract_group([page(1)] * 9)[0].endswith("Always the same disclaimer here")  # copies alone show no template


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None, None), (2, "http://a.b/", ""), (None, "x", "just & text"), (2, "http://a.b/", ""), (3, "http://a.b/c", "<article><p>cut &am"), (4, "http://a.b/c", "<article>a < b <p"), (5, "http://q/", deep), (6, "http://q/", "</p></div>x"), (7, "http://q/", deep)]
    got = spark.createDataFrame([(*r, 1, "t") for r in rows], "page_id long, url string, html string, key int, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html.main_texts(got).collect())
    assert got == [(0, "just & text", 11), (1, "", 0), (2, "", 0), (2, "", 0), (3, "cut &am", 7), (4, "a < b", 5), (5, "deep", 4), (6, "x", 1), (7, "deep", 4)]
    assert html.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_that_the_first_page_lacks():
    page = lambda i, extra: f"<html><body>{extra}<div class='body'><p>Own text {i} of page {i * 7}.</p></div></body></html>"
    pages = [page(0, "")] + [page(i, "<ul class='box'><li>Home</li><li>Contact us</li></ul>") for i in range(1, 10)]
    assert html.extract_group(pages) == [f"Own text {i} of page {i * 7}." for i in range(10)]


def test_the_wrapper_chooses_the_article():
    """Without names to go by: what varies and where it stands decides, so pages alone give another text."""
    r = random.Random(3)
    words = lambda n: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(n))
    bodies = [[words(4), words(60), words(50)] for _ in range(12)]
    page = lambda b: PAGE.format(
        f"<div class=a><div>The Daily Example, since 1901</div><p>All rights are with their owners</p></div>"
        f"<div class=b><div class=c><h1>{b[0]}</h1><div>{b[1]}</div><p>{b[2]}</p><p>Write to us at the usual place</p></div>"
        f"<div class=d><a href=x>{words(3)}</a> <a href=y>{words(3)}</a></div></div><div class=e>{words(4)}</div>"
    )
    pages = [page(b) for b in bodies]
    assert html.extract_group(pages) == [" ".join(b) for b in bodies]
    assert all(x != y for x, y in zip(html.extract_group(pages, aligned=False), html.extract_group(pages), strict=True))


def test_headline_beside_the_article():
    page = lambda k: PAGE.format(f"<div>Teaser {k} elsewhere</div><main><h1>Head {k}</h1><p>Lead {k}</p><article><p>{f'Body {k} ' * 9}</p></article></main>")
    want = [f"Head {k} Lead {k} " + f"Body {k} " * 9 for k in range(5)]
    assert html.extract_group([page(k) for k in range(5)]) == [x.strip() for x in want]


def test_deep_trees_and_many_siblings():
    start = time.perf_counter()
    deep = [f"{'<div>' * 50_000}deep {k}{'</div>' * 50_000}" for k in range(2)]
    assert html.extract_group(deep) == ["deep 0", "deep 1"]
    wide = ["".join(f"<div class='{chr(97 + k)}{i * (k + 2) % 4999}x'><p>w{k}x{i}</p></div>" for i in range(5000)) for k in range(2)]
    assert html.extract_group(wide) == [" ".join(f"w{k}x{i}" for i in range(5000)) for k in range(2)]
    mixed = ["".join(f"<{n}>w{k}</{n}>" for n in random.Random(k).choices(["p", "div", "h2", "dl"], k=5000)) for k in range(2)]
    assert [len(x) for x in html.extract_group(mixed)] == [3 * 5000 - 1] * 2
    assert time.perf_counter() - start < 40


def test_chains_are_the_heaviest():
    r = random.Random(5)
    for _ in range(60):
        n, m = r.randint(1, 7), r.randint(1, 7)
        cells = [(i, j, r.randint(1, 5)) for i in range(n) for j in reversed(range(m)) if r.random() < 0.5]
        best = [[0] * (m + 1) for _ in range(n + 1)]
        weight = {(i, j): w for i, j, w in cells}
        for i in range(n):
            for j in range(m):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight.get((i, j), 0))
        got = [cells[k] for k in html.chain(cells, m)]
        assert sum(w for *_, w in got) == best[n][m] and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:], strict=False))


def heaviest(cells, n, m):
    """By the table of all pairs; of equal chains the one that ends first, backwards."""
    weight = {(i, j): w for i, j, w in cells}
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight.get((i, j), 0))
    out, i, j = [], n, m
    while best[i][j]:
        while best[i - 1][j] == best[i][j]:
            i -= 1
        while best[i][j - 1] == best[i][j]:
            j -= 1
        i, j = i - 1, j - 1
        out.append((i, j))
    return out[::-1]


def test_both_chains_are_that_of_the_table():
    r = random.Random(6)
    for size in [*range(1, 9)] * 12 + [60, 90]:
        n, m, top = size, r.randint(1, size + 3), r.choice([1, 2, 5])
        cells = [(i, j, r.randint(1, top)) for i in range(n) for j in reversed(range(m)) if r.random() < 0.6]
        rows = np.zeros((n, m), np.int64)
        for i, j, w in cells:
            rows[i, j] = w
        want = heaviest(cells, n, m)
        assert [cells[k][:2] for k in html.chain(cells, m)] == want == html.row_chain(list(rows))


@pytest.mark.parametrize("n", [60, 400, 800, 5000])
def test_long_lists_among_differing_blocks(n, monkeypatch):
    """A list of 800 entries, near the start of some pages and near the end of others, is template at any length."""

    def page(k):
        blocks = [f"<div class='{chr(97 + k)}{chr(97 + i % 26)}{'xyz'[i % 3] * (i // 26)}'>w{k}x{i}</div>" if n < 1000 else f"<h2>w{k}x{i}</h2><h3>v{k}x{i}</h3>" for i in range(n if n < 1000 else n // 2)]
        blocks.insert(10 if k % 2 else len(blocks) - 10, "".join(f"<p>f{q}</p><dl>g{q}</dl>" for q in range(400)))
        return PAGE.format("".join(blocks))

    pages = [page(k) for k in range(8)]
    start = time.perf_counter()
    got = html.extract_group(pages)
    assert time.perf_counter() - start < 90
    if n < 1000:
        assert not any("f7" in x.split() or "g7" in x.split() for x in got) and all(f"w{k}x{n - 1}" in x.split() for k, x in enumerate(got))
    if n < 5000:
        for seconds in (0.0, 1.0):  # all chains sparse, all dense
            monkeypatch.setattr(html, "CELL_SECONDS", seconds)
            assert html.extract_group(pages) == got
