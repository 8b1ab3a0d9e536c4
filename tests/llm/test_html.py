import html
import re

import helpers
from helpers import F
from servelens.llm.html_text import extract, main_text


def plain(page):
    """The fixture's pages have one article of headings and paragraphs; all else is not main text."""
    body = page[page.index("<article>") + 9:]
    body = body[:body.index("</article>")] if "</article>" in body else body
    blocks = re.split(r"</?(?:p|h[1-6])>", body)
    texts = [" ".join(html.unescape(re.sub("<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_fixture(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == plain(r.html), r.page_id
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert len(got) == pages.count()


ARTICLE = "<h1>Title &amp; more</h1><p>First   paragraph, with <b>bold</b> text &lt;here&gt;.</p><ul><li>One item.<li>Two, items</ul><p>Last\nwords<br>end."
TEXT = "Title & more\n\nFirst paragraph, with bold text <here>.\n\nOne item.\n\nTwo, items\n\nLast words end."


def test_asides_go_and_content_stays():
    shells = ["<article>{}</article>", "<main>{}</main>", "<div class='content'><div class=post-body>{}</div></div>", "<table><tr><td>{}</td></tr></table>"]
    noise = ("<header><p>Site header, welcome to it. Much text, all of it dull.</p></header><nav><a href=x>Home</a> <a href=y>About</a></nav>"
             "<div id='cookie-notice'>We use cookies, as all do. Accept them, please.</div><aside><p>Side text, unrelated, long enough to count.</p></aside>"
             "<form><label>Name</label><input><p>Form words, please fill.</p></form><script>if (a<b) document.write('<p>no</p>')</script>"
             "<div class=\"comments\"><p>Nice article, I liked it, really. Thanks!</p></div><!-- <p>gone</p> --><style>p>a{}</style>")
    for shell in shells:
        page = f"<html><head><title>T</title></head><body>{noise}{shell.format(ARTICLE)}{noise}<footer>&copy; us</footer></body></html>"
        assert main_text(page) == TEXT, shell
        assert main_text(f"<html><body>{shell.format(noise + ARTICLE + noise)}") == TEXT, shell


def test_broken_and_odd():
    assert main_text("") == "" and main_text("<html><body></body>") == "" and main_text("<script>x") == ""
    assert main_text("just text, no &eacute; tags < 5") == "just text, no é tags < 5"
    assert main_text("<p>one<p>two</div></p><b>three") == "one\n\ntwo\n\nthree"
    assert main_text("<article><p>cut &am") == "cut &am"
    assert main_text('<p title="a>b">x</p>') == "x"
    assert main_text("<div>" * 20000 + "deep" + "</div>" * 20000) == "deep"
    assert main_text("<p>" + "word, " * 50000) == ("word, " * 50000).strip()
    assert main_text("<" * 50000).startswith("<")
    assert main_text("<a href=' " * 3000 + ">") == ""


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", "<p>a, b.</p>"), (2, "u", "<p>a, b.</p>")], "page_id long, url string, html string")
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in extract(df.withColumn("text", F.lit(1))).collect())
    assert got == [(0, "", 0), (1, "", 0), (2, "a, b.", 5), (2, "a, b.", 5)]
    assert extract(df.filter("page_id = 9")).count() == 0


def test_wrappers_named_after_an_aside_keep_the_text():
    side = "<div class='sidebar'><p>Side text, unrelated, and dull.</p></div>"
    talk = "<div class='comments'><article class='comment'><p>Nice one, thanks.</p></article></div>"
    for name in ("class='content has-sidebar'", "class='content-sidebar-wrap'", "class='post with-comments'", "id=mainWithSidebar", "class='no-ads page'"):
        for shell in ("<article>{}</article>", "<main>{}</main>", "{}", "<div class='entry no-comments'>{}</div>"):
            for tag in ("div", "section", "page-root"):
                assert main_text(f"<html><body><{tag} {name}>{shell.format(ARTICLE)}{side}{talk}</{tag}></body></html>") == TEXT, (name, shell, tag)
    assert main_text(f"<body><article>{ARTICLE}<p>More <span class='share-box'>12 shares</span> here.</p></article>") == TEXT + "\n\nMore here."
    assert main_text(f"<body><article><div class='entry with-comments'>{ARTICLE}</div></article>{talk}") == TEXT


LONG = "<p>A sentence of the text, long enough to count; it goes on, with commas, and ends here.</p>"
SENTENCE = "A sentence of the text, long enough to count; it goes on, with commas, and ends here."


def test_title_intro_and_sections_beside_the_body_stay():
    outer = "<html><body><div><a href=x>Home</a> <a href=y>About</a></div>{}<div>Powered by us</div></body></html>"
    rest = "\n\n".join([SENTENCE] * 6)
    assert main_text(outer.format(f"<div class=post><h1>Title</h1><p>intro</p><div class=body>{LONG * 6}</div></div>")) == "Title\n\nintro\n\n" + rest
    assert main_text(outer.format(f"<div class=post><div class=title><h1>Title</h1></div><div class=body>{LONG * 6}</div></div>")) == "Title\n\n" + rest
    for left, right in ((13, 7), (10, 10), (18, 2)):  # sections of 65 and 35 %, and others
        got = main_text(outer.format(f"<div class=post><section>{LONG * left}</section><section><h2>More</h2>{LONG * right}</section></div>"))
        assert got == "\n\n".join([SENTENCE] * left + ["More"] + [SENTENCE] * right)
    assert main_text(outer.format(f"<div class=a><div>{LONG * 13}</div></div><div class=b><div><ul><li>{SENTENCE}<li>short</ul>{LONG * 6}</div></div>")) \
        == "\n\n".join([SENTENCE] * 14 + ["short"] + [SENTENCE] * 6)


def test_boilerplate_without_links_and_names_goes():
    page = f"<body><div class=post><h1>Title</h1><div>123 views</div>{LONG * 4}<div><span>Posted in misc</span></div>{LONG * 4}<div>All rights kept</div></div>"
    assert main_text(page) == "\n\n".join(["Title"] + [SENTENCE] * 8)
    table = "<table><tr><td>1<td>2<tr><td>3<td>4</table>"
    assert main_text(f"<body><div>{LONG * 4}{table}{LONG * 2}</div><div>Tel. 12</div>") == "\n\n".join([SENTENCE] * 4 + list("1234") + [SENTENCE] * 2)


def test_what_belongs_to_an_article_though_its_tag_or_name_says_otherwise():
    rest = "\n\n".join([SENTENCE] * 4)
    page = "<html><body><header><p>Our site, the best of all.</p></header><article>{}" + LONG * 4 + "</article></body></html>"
    assert main_text(page.format("<header><h1>Title of it</h1><p>By A. Writer</p><nav><a href=x>Up</a></nav></header>")) == "Title of it\n\nBy A. Writer\n\n" + rest
    for name in ("class='related-work'", "class='comments-policy'", "class='search-algorithm'", "id=adsorption-notice-board"):
        for tag in ("div", "section", "p"):
            inner = "Body text of it, with a comma."
            assert main_text(page.format(f"<{tag} {name}>{inner}</{tag}>")) == inner + "\n\n" + rest, (name, tag)
    assert main_text(page.format("<p class='notice'>Note this, it matters.</p>")) == "Note this, it matters.\n\n" + rest
    for name in ("class='related-posts'", "class='share-links box'", "class='advert'", "id=comments", "class='newsletter-box'"):
        assert main_text(page.format(f"<div {name}>Dull things, as ever.</div>")) == rest, name
    assert main_text("<body><article><p>Press <button>OK</button> and <label>this</label> now, please.</p><button>Buy</button></article>") == "Press OK and this now, please."


def test_a_form_around_the_page_is_a_wrapper():
    rest = "\n\n".join([SENTENCE] * 4)
    small = "<form><p>Your name, please.</p><input><button>Go</button></form>"
    for shell in ("<article>{}</article>", "<div id=content>{}</div>", "<main>{}</main>"):
        page = "<html><body><form id=aspnetForm><nav><a href=x>Home</a></nav>" + shell.format(LONG * 4) + small + "</form></body></html>"
        assert main_text(page) == rest, shell
        assert main_text("<body>" + shell.format(LONG * 4) + small + "</body>") == rest, shell


def test_articles_beside_the_largest_one_stay():
    two = f"<body><nav><a href=x>Home</a></nav><article><h2>One</h2>{LONG}</article><article><h2>Two</h2>{LONG * 5}</article><div>All rights kept</div></body>"
    assert main_text(two) == "\n\n".join(["One", SENTENCE, "Two"] + [SENTENCE] * 5)
