from __future__ import annotations

import random

import numpy as np
import pytest

from dealweave.llm import html_extraction as H

PAGE = """<!DOCTYPE html><html><head><title>T & more</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Menu</a></li></ul></nav><!-- <p>hidden</p> --><div class="cookie-notice">We use <b>cookies</b></div>
<div id="sidebar"><div>deep<div>deeper</div></div>still side</div><article class="post"><header><h1>Title &amp; co</h1></header><p><b>First &nbsp; part<br>after break<p>Second
 line &lt;tag&gt; &#233;<ul><li>One<li>Two</ul><div class="ad">Buy</div><aside>Aside</aside><form><p>Mail</p><input></form><table><tr><td>a</td><td>b</td></tr></table>
<p class="notice">A notice<p>Third</p><section id="comments"><article class="comment"><p>Nice!</p></article></section><p>Last</p></article><footer>&copy; me</footer></body></html>"""


def main(page):
    return "\n\n".join(t for k, t in H.blocks(page) if k != H.CHROME)


def test_structure():
    assert main(PAGE) == "Title & co\n\nFirst part after break\n\nSecond line <tag> é\n\nOne\n\nTwo\n\na b\n\nThird\n\nLast"
    assert main(None) == main("") == main("<nav>only menu") == ""
    assert main("plain &amp; simple") == "plain & simple"
    assert main("<body><p>x<p>y<main><p>z</main>") == "z"
    assert main("<div><nav>never closed<p>text</div>") == "text"
    assert main("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert main("<article><p>a<script>bad</article>") == "a"
    assert main("<main><p>" + "long " * 50000 + "</p></main>") == ("long " * 50000).strip()


def test_letters_that_grow_in_lower_case_and_open_quotes():
    for n in (5, 50):
        page = "<article><p>" + "\u0130" * n + "</p><script>x</script><p>abc def</p><p>ghi</p></article>"
        assert main(page) == "\n\n".join(["\u0130" * n, "abc def", "ghi"])
    assert main('<article><p title="abc>Text one</p><p class="x">Two</p></article>') == "Text one\n\nTwo"
    assert main("<article><p title='abc>Text one</p></article>") == "Text one"
    assert main('<article><p title="a > b">One</p><a href="x"class="y">two</a></article>') == "One\n\ntwo"


def test_an_article_must_be_the_main_text():
    assert main('<div id="content"><p>Long main text.</p></div><article class="teaser"><p>Teaser</p></article>') == "Long main text."
    assert main("<div><p>Long main text of this page.</p></div><article><p>Next</p></article>") == "Long main text of this page.\n\nNext"
    assert main("<div><p>Outside</p></div><article><p>The main text</p></article>") == "The main text"


def test_classes_of_running_text_count_as_whole_words():
    page = '<article><p class="market-share">A</p><p class="search-engine">B</p><p id="header-2">C</p><p class="share">D</p><div class="share-box">E</div><p>F<math><mi>x</mi></math></p></article>'
    assert main(page) == "A\n\nB\n\nC\n\nFx"


def test_unclosed_elements_are_fast():
    import time

    began = time.perf_counter()
    assert main("<nav>" * 40000 + "<p>x</p>") == "x"
    assert time.perf_counter() - began < 2


def test_columns_with_clashing_names_stay(spark):
    rows = [(i, f"http://a.example.com/{i}", f"<p>page {i}</p>", i + 0.5, i, f"s{i}") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, __host double, __copy long, `a.b` string")
    out = H.extract(df)
    assert out.columns == ["page_id", "url", "__host", "__copy", "a.b", "text"]
    assert sorted(map(tuple, out.collect())) == [(i, u, h, c, s, f"page {i}") for i, u, _, h, c, s in rows]


def test_sorted_suffixes_against_plain_sort():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 3, 200)
    order, rank = H.sorted_suffixes(tokens, 8)
    keys = [tuple(tokens[i:i + 8]) for i in range(200)]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(0, 200, 7) for j in range(200))


def test_repeats_on_a_host_go_from_open_text_and_copies_alone_do_not(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"{rng.choice('abc')}{rng.randrange(10**6)}" for _ in range(n))
    legal, offer, story = prose(20), prose(12), prose(30)
    own = [prose(25) for _ in range(12)]
    pages = [(i, f"https://Open.example.com/{i}", f"<body><div>{legal}</div><p>{t}</p><p>{prose(3)} {offer}</p></body>", "x") for i, t in enumerate(own)]
    pages += [(100 + i, "http://copies.example.com/a", f"<p>{story}</p>", "x") for i in range(5)]
    pages += [(200 + i, "http://art.example.com/a", f"<article><p>{prose(20)}</p><p>{legal}</p><p>{offer if i % 3 == 0 else prose(9)}</p></article>", "x") for i in range(12)]
    pages += [(300, None, None, "x"), (300, None, None, "x"), (None, "no url", "<p>z</p>", "x")]
    got = {}
    out = H.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text string"))
    assert out.columns == ["page_id", "url", "text"]
    for r in out.collect():
        got.setdefault(r.page_id, []).append(r.text)
    for i, t in enumerate(own):
        assert t in got[i][0] and legal not in got[i][0] and offer not in got[i][0] and len(got[i][0].split()) == 28
    assert all(got[100 + i] == [story] for i in range(5))
    assert all(legal not in got[200 + i][0] for i in range(12)) and offer in got[200][0]
    assert got[300] == ["", ""] and got[None] == ["z"]


def test_hot_hosts_are_split(spark):
    pages = [(i, "http://hot.example.com/", f"<article><p>{i} text of its own</p></article>") for i in range(50)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(df, shard_bytes=500).collect()}
    assert got == {i: f"{i} text of its own" for i in range(50)}
    assert H.op3(df.limit(0)).count() == 0


def test_near_copies_and_quoted_passages_of_open_pages_stay(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join(f"{rng.choice('abc')}{rng.randrange(10**6)}" for _ in range(n))
    story, quote = prose(60).split(" "), prose(15)
    near = [" ".join([*story[:30], f"word{i}", *story[31:]]) for i in range(3)]
    pages = [(i, "http://near.example.com/a", f"<body><div>{t}</div></body>") for i, t in enumerate(near)]
    own = [f"{prose(30)} {quote if i < 3 else prose(15)}" for i in range(40)]
    pages += [(100 + i, "http://quotes.example.com/a", f"<body><p>{t}</p></body>") for i, t in enumerate(own)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(3)] == near
    assert [got[100 + i] for i in range(40)] == own


@pytest.mark.parametrize("sent", [0, H.SENT_STRINGS])
def test_results_do_not_depend_on_the_size_of_shards(spark, monkeypatch, sent):
    monkeypatch.setattr(H, "SENT_STRINGS", sent)
    rng = random.Random(6)
    prose = lambda n: " ".join(f"{rng.choice('abc')}{rng.randrange(10**6)}" for _ in range(n))
    legal, often, rare = prose(12), prose(12), prose(12)
    texts = [(prose(40), legal, often if i % 5 < 3 else prose(12), rare if i % 5 < 2 else prose(12)) for i in range(60)]
    texts += texts[:1] * 50  # copies are one distinct page
    page = lambda t: "".join(f"<p>{b}</p>" for b in t)
    rows = [(i, "http://hot.example.com/", f"<article>{page(t)}</article>") for i, t in enumerate(texts)]
    rows += [(1000 + i, "http://open.example.com/", f"<body>{page(t)}</body>") for i, t in enumerate(texts)]
    rows += [(2000 + i, "http://few.example.com/", f"<article>{page((prose(40), legal))}</article>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    whole, cut = ({r.page_id: r.text for r in H.extract(df, shard_bytes=n).collect()} for n in (H.SHARD_BYTES, 3000))
    assert whole == cut and len(cut) == len(rows)
    for i, (own, _, third, fourth) in enumerate(texts):
        assert cut[i] == cut[1000 + i] == "\n\n".join([own, *([third] if third != often else []), fourth])
    assert all(legal in cut[2000 + i] for i in range(5))  # too few pages to judge an article by
