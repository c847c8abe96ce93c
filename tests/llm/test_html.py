import numpy as np
import pyarrow as pa
import pytest
from conftest import outcome
from shelfwise.llm import html_extraction
from shelfwise.llm.html_extraction import extract, extract_pages, merged, wrapper_of
from shelfwise.llm.html_trees import parse

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script><style>p{}</style></head>
<body><header>Site</header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id='ads'>Buy</div><aside>Side</aside>
<article><header><h1>Title &amp; more</h1></header><p>First   <b>bold</b>
 line<br>goes on &lt;here&gt; &eacute;&#233;</p><p>Second<p>Third<ul><li>x<li>y</ul>
<form><input><p>Send</p></form><!-- <p>hidden</p> --><div class="comments"><p>Nice!</p></div>
<table><tr><td>1<td>2</table></article>
<footer>Foot</footer></body></html>"""


def test_article_without_the_rest():
    expected = ["Title & more", "First bold line goes on <here> éé", "Second", "Third", "x", "y", "1", "2"]
    assert extract(PAGE, None).split("\n") == expected


def test_broken_markup():
    assert extract("", None) == ""
    assert extract("just text &amp; <b>bold", None) == "just text & bold"
    assert extract("<p>a<p>b<script>never closed", None) == "a\nb"
    assert extract("<div>" * 3000 + "deep", None) == "deep"
    assert extract("a < b and c > d <", None) == "a < b and c > d <"
    assert extract("<p>" + "long " * 100_000 + "</p>", None) == ("long " * 100_000).strip()
    assert extract("<p>cut <a href='x", None) == "cut"


def soup(k, extra=""):
    words = f"Article {k} tells of {k * 7} things, at some length, in its own words."
    return (
        f"<html><body><div><span>The daily page</span></div><div><p>Words that every page of this host shows.</p></div>"
        f"<div><h1>Head {k}</h1><p>{words}</p><p>{words[::-1]}</p></div>{extra}</body></html>"
    )


def test_constant_nodes_are_template():
    wrapper = None
    for k in range(12):
        new = wrapper_of(parse(soup(k, "<section><p>sometimes</p></section>" if k % 2 else "")))
        wrapper = merged(wrapper, new) if wrapper else new
    text = extract(soup(3), wrapper)
    assert text.startswith("Head 3\nArticle 3") and "every page" not in text
    copies = wrapper_of(parse(soup(1)))
    for _ in range(12):
        copies = merged(copies, wrapper_of(parse(soup(1))))
    assert "every page" in extract(soup(1), copies) and "Article 1" in extract(soup(1), copies)


def test_pages_table(spark):
    rows = [(k, f"http://h.example/{k}", soup(k), "clash", "x") for k in range(10)]
    rows += [(None, None, None, None, None), (1, "http://h.example/1", soup(1), None, None), (20, "u", "", "", ""), (21, None, PAGE, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, wrapper string")
    found = extract_pages(pages.repartition(3))
    assert found.columns == ["page_id", "url", "wrapper", "text"]
    got = outcome(found, "page_id", "text")
    assert len(got) == len(rows) and (None, "") in got and (20, "") in got
    texts = dict(got)
    assert all(texts[k].startswith(f"Head {k}\n") and "every page" not in texts[k] for k in range(10))
    assert texts[21].startswith("Title & more\n")
    assert extract_pages(pages.where("false")).count() == 0


def test_copies_in_many_partitions_are_one_page(spark):
    odd = soup(77, "<section><h2>A remark that only this page has</h2></section>")
    rows = [(k, f"http://h.example/{k}", soup(k)) for k in range(10)]
    rows += [(100 + k, f"http://h.example/{k}", odd) for k in range(64)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    many, one = (outcome(extract_pages(pages.repartition(n)), "page_id", "text") for n in (16, 1))
    assert many == one
    assert all(("A remark" in text) == (k >= 100) and "every page" not in text for k, text in many)


def lines(html):
    return extract(f"<html><body>{html}</body></html>", None).split("\n")


def test_nothing_of_the_article_is_lost():
    main = "<main><p>Lead</p><article><p>Body of the article</p></article><p>Tail</p></main>"
    assert lines(f"<nav>Menu</nav>{main}") == ["Lead", "Body of the article", "Tail"]
    assert lines("<article><p>One</p></article><article><p>Another one</p></article>") == ["One", "Another one"]
    assert lines("<article><p>One</p><article><p>Inner</p></article></article>") == ["One", "Inner"]
    names = ["share-price", "notice-period", "related-work", "ad-hoc", "social-security", "menu-costs"]
    kept = "".join(f'<div class="{n}"><p>{n}</p></div>' for n in names)
    gone = "".join(f'<div class="{n}"><p>{n}</p></div>' for n in ["comments", "share-buttons", "cookie-notice", "ad", "ad-slot-3"])
    assert lines(f"<article><p>Text</p>{kept}{gone}</article>") == ["Text", *names]
    links = "<ul><li><a href=1>First source</a><li><a href=2>Second source</a><li><a href=3>Third source</a></ul>"
    assert lines(f"<article><p>Text</p>{links}</article>{links}") == ["Text", "First source", "Second source", "Third source"]
    assert lines(f"<main>{links}<article><p>Text</p></article></main>") == ["Text"]


def test_a_constant_block_beside_alike_ones():
    def page(k):
        layouts = ["", "<section><p>now and then</p></section>", "<h2>Section</h2>", "<ul><li>a</ul>"]
        return (
            f"<html><body>{layouts[k % 4]}<div class='x post-{k}'><h1>Head {k}</h1><p>Body {k} of the page, which differs.</p></div>"
            "<div class='x post-7'><p>All rights kept by the owners.</p></div></body></html>"
        )

    for order in (range(24), reversed(range(24)), sorted(range(24), key=lambda k: k * 7 % 24)):
        wrapper = None
        for k in order:
            new = wrapper_of(parse(page(k)))
            wrapper = merged(wrapper, new) if wrapper else new
        texts = [extract(page(k), wrapper) for k in range(24)]
        assert all(f"Body {k} of" in t and "All rights" not in t for k, t in enumerate(texts))


def test_long_pages_and_wide_hosts_end(spark):
    long = "<html><body>" + "".join(f"<h2>Head {k}</h2><p>Text of part {k}</p>" for k in range(20_000)) + "</body></html>"
    rows = [(k, "http://long.example/", long.replace("Text", f"Text {k}")) for k in range(3)]
    rows += [
        (100 + k, "http://wide.example/", "<html><body>" + "".join(
            f"<div class='p{k}x{chr(97 + (k * 20 + j) % 26)}{(k * 20 + j) // 26 % 26 * 'y'}'><p>Words {k} {j}</p></div>" for j in range(20)
        ) + "<div><p>Said on every page.</p></div></body></html>")
        for k in range(600)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    many, few = (dict(outcome(extract_pages(pages.repartition(n)), "page_id", "text")) for n in (8, 2))
    assert many[1].split("\n")[:2] == ["Head 0", "Text 1 of part 0"] and many[1].count("\n") == 39_999
    assert all(many[100 + k].split("\n")[:20] == [f"Words {k} {j}" for j in range(20)] for k in range(600))
    assert all(many[k] == few[k] for k in (0, 1, 2))


def _brute_alignment(x, y):
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, c in enumerate(x, 1):
        for j, d in enumerate(y, 1):
            pair = html_extraction._similarity(c, d)[0]
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + pair)
    return best[-1][-1]


def test_children_without_number_are_kept_and_aligned():
    random = np.random.default_rng(3)

    def node(n, labels):
        return ["div", 1, 0, [[f"p.{k}", 1, int(t), []] for k, t in zip(random.integers(0, labels, n), random.integers(0, 3, n))]]

    for n, m, labels in ((300, 300, 40), (290, 20, 8), (5, 400, 300)):
        a, b = node(n, labels), node(m, labels)
        score, met = html_extraction._similarity(a, b)
        assert score == 1 + _brute_alignment(a[3], b[3])
        assert met == sorted(met) and all(a[3][i][0] == b[3][j][0] for i, j in met)
        assert all(p < q and s < t for (p, s), (q, t) in zip(met, met[1:]))
        whole = html_extraction.merged(a, b)
        assert len(whole[3]) == n + m - len(met) and sum(c[1] for c in whole[3]) == n + m


@pytest.mark.parametrize("pages_a_task", [1, 48])
def test_a_rare_paragraph_among_many_optional_ones_is_template(pages_a_task):
    note = "<p class='note'>Read this before you go on.</p>"
    pages = []
    for k in range(48):
        boxes = "".join(f"<p class='w{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}'>Text {k} {i}</p>" for i in range(50))
        pages.append(f"<html><body><div>{boxes}{note if k % 6 == 5 else ''}</div></body></html>")
    parts = []
    for at in range(0, 48, pages_a_task):
        some = pages[at : at + pages_a_task]
        batch = pa.RecordBatch.from_pydict({"host": ["h"] * len(some), "html": some})
        parts += [row for out in html_extraction._induce([batch]) for row in out.to_pylist()]
    whole = html_extraction._join((pa.scalar("h"),), pa.Table.from_pylist(parts))
    wrapper = html_extraction._unpacked(whole.column("wrapper")[0].as_py())
    texts = [html_extraction.extract(page, wrapper) for page in pages]
    assert not any("Read this" in text for text in texts)
    assert all(len(text.split("\n")) == 50 for text in texts)
