from __future__ import annotations

import html as h
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trafficlens.llm import html_extract as he
from trafficlens.llm.tables import Scratch

SCHEMA = "page_id long, url string, html string, text string, n_chars int, host string"


def run(spark, rows):
    df = spark.createDataFrame([r + ("mine", 1, "h") for r in rows], SCHEMA)
    return {r["page_id"]: r for r in he.html_extract(df).collect()}


CASES = [
    ("<article><h1>A &amp; B</h1><p>one\n  two<br>three</p><p>x</article><footer>f</footer>", "A & B\n\none two three\n\nx"),
    ("<body><nav>n</nav><main><p>t</p><aside>a</aside></main></body>", "t"),
    ("<div class='cookie-notice'>c</div><p>body text</p>", "body text"),
    ("<article><p>a<script>var x='<p>no</p>'</script>b</p><div id=comments><p>c</p></div></article>", "a b"),
    ("<article>plain <b>bold</b>&nbsp;&#233;<ul><li>1<li>2</ul></article>", "plain bold é\n\n1\n\n2"),
    ("<article><p>a</p><form><p>f</p><input></form><p>z", "a\n\nz"),
    ("<article><article class=comment><p>c</p></article><p>t</p></article>", "t"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\n\nc"),
    ("", ""), ("no markup <", "no markup <"), ("<!DOCTYPE html><![if x]><p>t", "t"),
    ("<article><style>p{}</style><!-- c --><p>t</p><script>open", "t"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_page_text(page, text):
    assert he.page_text(page, set()) == text


NAMED = [
    ("<article><div class='elementor-widget elementor-widget-text-editor'><p>t</p></div></article>", "t"),
    ("<article><h2 id='related-work'>Related work</h2><p id='search'>s</p></article>", "Related work\n\ns"),
    ("<article><section id='notice-of-appeal'>n</section><section id=search>s</section></article>", "n\n\ns"),
    ("<article><section id=comments><p>c</p></section><p>t</p></article>", "t"),
    ("<div class='layout has-sidebar'><article><p>t</p></article><div class=sidebar>s</div></div>", "t"),
    ("<form action=/><input><div><article><p>t</p></article></div><div>o</div></form>", "t"),
    ("<form><main><p>t</p></main></form><p>o</p>", "t"),
    ("<main><form><article>long text</article></form></main>", "long text"),
    ("<article class='post comments-open'><p>t</p><ol class='comment-list'><li>c</ol></article>", "t"),
    ("<article class='comment-body'>c</article><article>t</article>", "t"),
    ("<div class='sidebar'><main><p>t</p></main></div>", "t"),
    ("<div hidden><article>in a wrapper</article></div><div>o</div>", "in a wrapper"),
    ("<p>the body text of a page</p><div class=related><article>teaser</article></div>", "the body text of a page"),
    ("<p>t</p><aside><article>teaser and more</article></aside>", "t"),
    ("<aside><article>t</article></aside>", "t"),
    ("<article>t</article><div class=related-posts><article>teaser and more</article></div>", "t"),
    ("<article>t<div class=related><article>teaser</article></div></article>", "t"),
    ("<p>t</p><div class='newsletter-signup'>n</div><div id=cookie_banner>c</div><ul class=shareButtons><li>s</ul>", "t"),
]


@pytest.mark.parametrize("page,text", NAMED)
def test_names_delete_whole_tokens_only(page, text):
    assert he.page_text(page, set()) == text


@pytest.mark.parametrize("odd", ["<![foo bar]>", "<![ x ]>", "<![%x[ y ]]>", "<![>", "<![endif]-->", "<![if x>",
                                 "<![CDATA[>", "&#" + "9" * 5000 + ";"])
def test_text_after_odd_markup_is_kept(odd):
    got = he.page_text(f"<article><p>a</p>{odd}<p>rest</p><p>end ]></p></article>", set())
    blocks = got.split("\n\n")
    assert blocks[0] == "a" and blocks[-2:] == ["rest", "end ]>"]
    assert he.page_hashes(f"<p>a</p>{odd}<div>rest</div>") != he.page_hashes(f"<p>a</p>{odd}")


def test_odd_markup_at_the_end_and_long_references():
    assert he.page_text("<p>a</p><![ x", set()).startswith("a")
    assert he.page_text("<p>a &#" + "0" * 5000 + "65; b</p>", set()) == "a A b"


def test_site_templates_go_and_shared_passages_stay(spark):
    shared = "<p>" + "passage " * 60 + "</p>"
    rows = [(i, f"http://site.example/{i}", f"<body><div><p>Top of the site</p></div><p>story {i}</p>{shared}"
                                            "<div><p>Bottom</p></div>") for i in range(30)]
    rows += [(100 + i, f"http://art.example/{i}", f"<div>Menu text</div><article><p>tale {i}</p>{shared}"
                                                  "<ul><li><a>s1</a><li><a>s2</a></ul></article>") for i in range(30)]
    rows += [(200 + i, "http://copy.example/", "<body><p>same page</p>") for i in range(30)]
    rows += [(300, "http://one.example/", "<body><div><p>Top of the site</p></div><p>x</p>"), (301, None, "<p>y"),
             (302, "no url", None), (302, "no url", None)]
    got = run(spark, rows)
    assert got[3]["text"] == "story 3"
    assert got[103]["text"] == "tale 3\n\n" + ("passage " * 60).strip()
    assert got[200]["text"] == "same page"
    assert got[300]["text"] == "Top of the site\n\nx" and got[301]["text"] == "y"
    assert got[302]["text"] == "" and got[302]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_shared_cells_items_and_headings_are_text(spark):
    rows = []
    for i in range(40):
        links = "".join(f"<li><a>m{k}</a></li>" for k in range(3)) if i % 5 == 0 else f"<li><a>own {i}</a></li>"
        aside = "<div><p>Shared by a fifth</p></div>" if i % 5 == 0 else ""
        rows.append((i, f"http://cook.example/{i}", f"<body><div><p>Top</p><p>of the site</p></div><ul>{links}</ul>"
                     f"<div><h2>Ingredients</h2></div>{aside}<p>dish {i}</p><ul><li>Salt</li><li>s{i}</li></ul>"
                     f"<table><tr><th>Vegan</th></tr><tr><td>Yes</td><td>v{i}</td></tr></table>"))
    got = run(spark, rows)
    assert got[1]["text"] == "own 1\n\nIngredients\n\ndish 1\n\nSalt\n\ns1\n\nVegan\n\nYes v1"
    assert got[5]["text"] == ("Ingredients\n\nShared by a fifth\n\ndish 5\n\nSalt\n\ns5\n\nVegan\n\nYes v5")


def test_empty_table(spark):
    assert he.html_extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pages_equal_a_plain_reading(spark):
    pages = pd.read_parquet("/root/testdata/sf0.001/pages.parquet")
    got = run(spark, [tuple(r) for r in pages[["page_id", "url", "html"]].itertuples(index=False)])
    for page_id, page in zip(pages.page_id, pages.html, strict=True):
        body = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
        blocks = [" ".join(h.unescape(re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert got[page_id]["text"] == "\n\n".join(b for b in blocks if b)


def test_menus_and_adverts_of_other_words_recur_by_shape(spark):
    def page(i, body):
        menu = "".join(f"<li><a href=/{i}/{k}>item {i} {k}</a></li>" for k in range(3 + i % 4))
        return f"<body><nav><ul>{menu}</ul></nav><div class=offer>buy {i}</div>{body}<div><p>note {i}</p></div>"

    rows = [(i, f"http://art.example/{i}", page(i, f"<article><h1>t{i}</h1><p>tale {i}</p><ul><li><a>a{i}</a></ul></article>"))
            for i in range(20)]
    rows += [(100 + i, f"http://plain.example/{i}", page(i, f"<p>story {i}</p>")) for i in range(20)]
    df = spark.createDataFrame([r + ("mine", 1, "h") for r in rows], SCHEMA)
    alone = {r["page_id"]: r["text"] for r in he.html_extract(df, names=False).collect()}
    assert all(alone[i] == f"t{i}\n\ntale {i}\n\na{i}" for i in range(20))
    # without an article element short blocks may be its text: only the menus go
    assert all(alone[100 + i] == f"buy {i}\n\nstory {i}\n\nnote {i}" for i in range(20))
    assert run(spark, rows)[3]["text"] == "t3\n\ntale 3\n\na3"


def test_shapes_of_long_blocks_and_of_rare_ones_stay(spark):
    rows = [(i, f"http://s.example/{i}", f"<div class=lead>{f'long words {i} ' * 30}</div><article><p>t</p></article>"
             + ("<div class=rare>x</div>" if i < 9 else "")) for i in range(20)]
    df = spark.createDataFrame([r + ("mine", 1, "h") for r in rows], SCHEMA)
    alone = {r["page_id"]: r["text"] for r in he.html_extract(df, names=False).collect()}
    assert alone[0] == f"{('long words 0 ' * 30).strip()}\n\nt\n\nx" and alone[10].endswith("\n\nt")


def test_comment_lists_go():
    assert he.page_text("<article><p>t</p><ol class=commentlist><li>c</ol></article>", set()) == "t"


def test_template_table_equals_a_plain_count(spark):
    """Subtrees a host on the whole table, counted in Python."""
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    prints, seen = {}, {}
    for url, page in zip(pages.url, pages.html, strict=True):
        found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        if found:
            host = found[1].lower()
            text, hashes = he.page_hashes(page or "")
            prints.setdefault(host, set()).add(text)
            for value in hashes:
                seen.setdefault((host, value), set()).add(text)
    want = {}
    for (host, value), texts in seen.items():
        percent = he.MIN_PERCENT if value & 3 == he.LINKS else he.MIN_BLOCK_PERCENT
        if len(texts) >= he.MIN_PAGES and 100 * len(texts) >= percent * len(prints[host]):
            want.setdefault(host, set()).add(value)
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    scratch = Scratch(spark, "templates-test")
    got = {r["host"]: set(r["templates"]) for r in he.site_templates(df, scratch).collect()}
    scratch.close()
    assert got == want and want


def test_templates_alone_leave_the_article(spark):
    """Most pages of sf0.1, by recurring subtrees without the lists of names."""
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    both = he.html_extract(df).select("page_id", "text").join(
        he.html_extract(df, names=False).select("page_id", F.col("text").alias("alone")), "page_id")
    all_, same, cut = both.agg(F.count("*"), F.count_if(F.col("text") == F.col("alone")),
                               F.count_if(~F.contains("alone", "text"))).first()
    print(all_, same, cut)
    assert same >= 0.95 * all_ and cut == 0
