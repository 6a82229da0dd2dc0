from llm_cases import unharmed, with_clashes

from stayline.llm import site_trees
from stayline.llm.site_trees import Page

SCHEMA = "page_id long, url string, html string"


def test_declared_furniture_is_left_out():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href="/">Home</a></ul></nav><div class="ad-box">Buy</div><div id="cookie-notice">Cookies</div>
    <article><header><h1>Head &amp;  line</h1></header><p>One <b>bold</b>
    text&nbsp;here<br>more<p>Two<script>var a = "</p>";</script> parts<!-- x -->!</p><ul><li>a<li>b</ul>
    <form>Mail <input></form><div class="comments"><p>First!</p></div></article><aside>Side</aside><footer>End</footer>"""
    assert Page(page).text() == "Head & line\nOne bold text here more\nTwo parts!\na\nb"


def test_broken_markup_is_read_as_far_as_it_goes():
    assert Page("<p>a<div>b</p>c<span class=ad>x</span>d").text() == "a\nb\ncd"
    assert Page("a < b &amp &am &#65; <i").text() == "a < b & &am A"
    assert Page("<article><p>kept<script>never closed").text() == "kept"
    assert Page("<p title='>'>x</p><!-- open").text() == "x"
    assert [Page(h).text() for h in (None, "", "<p> \n </p>", "<br>")] == [""] * 4


def test_templates_of_a_host_go_from_each_page(spark):
    page = "<body><div class='top'>Welcome to us</div><div class='story'><p>Story {0} tells of {0}.</p></div><div>Call us</div>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(12)]
    rows += [(50 + i, f"http://b.example/{i}", page.format(i)) for i in range(3)]
    # All pages of this host are copies: nothing tells template and story apart.
    rows += [(80 + i, "HTTP://C.example:80/x", page.format(7)) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in site_trees.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert all(got[i] == f"Story {i} tells of {i}." for i in range(12))
    assert all(got[50 + i] == f"Welcome to us\nStory {i} tells of {i}.\nCall us" for i in range(3))
    assert all(got[80 + i] == "Welcome to us\nStory 7 tells of 7.\nCall us" for i in range(12))


def test_importance_follows_the_entropy(spark):
    rows = [(i, "http://a.example", f"<body><h2>Same</h2><p>text {i}</p>") for i in range(12)]
    nodes = site_trees.importance(spark.createDataFrame(rows, SCHEMA)).collect()
    shares = sorted(round(r["importance"], 6) for r in nodes)
    assert shares[0] == 0.0 and max(shares) == site_trees.CONTENT_WEIGHT and {r["n_pages"] for r in nodes} == {12}


def test_nulls_repeated_rows_and_extra_columns(spark):
    rows = [(1, None, "<p>x</p>"), (1, None, "<p>x</p>"), (None, "no url", None), (2, "http://a", "")]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    out = site_trees.main_text(df)
    assert out.columns == [*(c for c in df.columns if c != "html"), "text", "n_chars"] and unharmed(out)
    assert sorted(((r["page_id"], r["text"], r["n_chars"]) for r in out.collect()), key=repr) == sorted(
        [(1, "x", 1), (1, "x", 1), (None, "", 0), (2, "", 0)], key=repr
    )
    assert site_trees.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_template_of_few_of_a_hosts_pages_goes_however_many_pages_the_host_has(spark):
    page = "<body><div class='story'><p>Story {0} tells of {0}.</p></div>{1}"
    block = lambda i: "<div class='shop'>Shop notes</div>" if i % 25 == 0 else ""
    rows = [(i, "http://a.example/x", page.format(i, block(i))) for i in range(300)]
    # Copies, a page without html and a host of its own without templates.
    rows += [(0, *rows[0][1:]), (900, "http://a.example/x", None), (901, "http://b.example/", page.format(901, block(0)))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = sorted([(i, f"Story {i} tells of {i}.") for i in [*range(300), 0]] + [(900, ""), (901, "Story 901 tells of 901.\nShop notes")])
    # As one list a host, and page by page.
    for options in ({}, {"listed": 0}):
        assert sorted((r["page_id"], r["text"]) for r in site_trees.main_text(df, **options).collect()) == want
