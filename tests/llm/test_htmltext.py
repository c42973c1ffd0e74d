"""Main text of pages with templates, broken markup and awkward rows."""

import random

import pytest
from small import rows_of

from rowtide.llm import htmltext


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def extract(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "'y' AS host", "'z' AS URL")
    return {r["page_id"]: r for r in rows_of(htmltext.main_text(df))}


def page(rng, i, blocks):
    body = "".join(f"<p>{b}</p>" for b in blocks[1:])
    return (
        f'<!DOCTYPE html><html><head><title>t{i}</title><style>p{{}}</style><script>var t="</p>";track({i});</script></head><body>'
        f"<nav><ul><li><a href='/a'>{words(rng, 1)}</a></li></ul></nav><!-- ad {i} --><div class=\"ad\">{words(rng, 9)}.</div>"
        f"<article><h1>{blocks[0]}</h1>{body}</article><aside>{words(rng, 30)}</aside>"
        f"<div id='comments'><p>{words(rng, 20)}</p></div><footer>&copy; host &middot; {words(rng, 6)}</footer></body></html>"
    )


def test_articles(spark):
    rng, pages, want = random.Random(1), [], {}
    repeated = words(rng, 25)
    for i in range(40):
        blocks = [words(rng, 5), *[words(rng, rng.randrange(1, 60)) for _ in range(rng.randrange(1, 6))]]
        if i % 3 == 0:
            blocks.append(repeated)  # part of many articles, not of the template
        pages.append((i, f"https://{'a' if i < 30 else 'b'}.example.com/{i}", page(rng, i, blocks)))
        want[i] = "\n\n".join(blocks)
    got = extract(spark, pages)
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == pages[i][1] for i, r in got.items())


def test_templates_without_telling_names(spark):
    rng, pages, want = random.Random(2), [], {}
    for i in range(25):
        blocks = [words(rng, rng.randrange(20, 80)) for _ in range(rng.randrange(2, 6))]
        links = "".join(f"<a href='/{k}'>{words(rng, 2)}</a> " for k in range(12))
        html = (
            f"<html><body><div class=x1>{links}</div><div class=x2>Welcome to the site of all sites</div>"
            f"<div class=x3>{''.join(f'<div>{b}</div>' for b in blocks)}</div><div class=x4><span>{words(rng, 3)}</span></div></body></html>"
        )
        pages.append((i, f"http://plain.example.org/{i}", html))
        want[i] = "\n\n".join(blocks)
    assert {i: r["text"] for i, r in extract(spark, pages).items()} == want


def test_copies_of_one_article_are_no_template(spark):
    """The same article under different menus, and near copies that make up half of a host without telling names."""
    rng, pages, want = random.Random(4), [], {}
    blocks = [words(rng, 6), *[words(rng, 40) for _ in range(4)]]
    body = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
    for i in range(12):
        menu = "".join(f"<a href='/{k}'>{words(rng, 2)}</a> " for k in range(5))
        html = f"<html><head><script>track({i})</script></head><body><div class=x1>{menu}</div><article>{body}</article></body></html>"
        pages.append((i, f"http://copies.example.com/{i}", html))
        want[i] = "\n\n".join(blocks)
    for i in range(100, 140):
        own = [words(rng, 30) for _ in range(4)]
        if i % 2:
            own = [*blocks[1:], words(rng, 3)]
        paragraphs = "".join(f"<p>{b}</p>" for b in own)
        share = "<p><a href='/s'>Read more of this site</a></p>"  # constant links go
        html = f"<html><body><div class=x1><a href='/{i}'>{words(rng, 2)}</a></div><div class=x3>{paragraphs}{share}</div></body></html>"
        pages.append((i, f"http://half.example.com/{i}", html))
        want[i] = "\n\n".join(own)
    assert {i: r["text"] for i, r in extract(spark, pages).items()} == want


def test_names_that_only_mention_what_is_dropped(spark):
    cases = {
        1: ("<article class='post category-social'><p>a</p></article><p>x</p>", "a"),
        2: ("<div id='content' class='has-sidebar comments-open'><p>b</p><div class='social-share'>s</div></div>", "b"),
        3: ("<article><p>c</p><section id='related-work'><h2 id='search-and-login'>Search</h2><p>d</p></section></article>", "c\n\nSearch\n\nd"),
        4: ("<main class=widget><h2 id=comments class=header>e</h2><p>f</p></main>", "e\n\nf"),
        5: ("<p>g</p><div class='cookie-notice'>n</div><div id='comment-17'>m</div><div class='site-header wide'>h</div>", "g"),
        6: ("<article class='social'><p>h</p><div class='related posts-list'>r</div></article>", "h"),
    }
    pages = [(i, f"http://h{i}.example.com/", html) for i, (html, _) in cases.items()]
    rng, want = random.Random(6), {i: text for i, (_, text) in cases.items()}
    for i in range(100, 120):  # the host's whole text is in an element that is called a sidebar
        blocks = [words(rng, 30), words(rng, 30)]
        inner = f"<p>{blocks[0]}</p><p>{blocks[1]}</p><div class=comments>{words(rng, 9)}</div>"
        pages.append((i, f"http://odd.example.com/{i}", f"<body><div class=top1>Site</div><div id=content class=left-sidebar>{inner}</div></body>"))
        want[i] = "\n\n".join(blocks)
    assert {i: r["text"] for i, r in extract(spark, pages).items()} == want


def test_markup_references_and_white_space(spark):
    cases = {
        1: ("<p>a &amp;amp; b&nbsp;&lt;c&gt; &#233;&#x1F4A1;\n\t d</p>", "a &amp; b <c> é💡 d"),
        2: ("<article><p><b>One two.<br><p>Three <i>f</i>our<li>five<li>six</article>", "One two.\n\nThree four\n\nfive\n\nsix"),
        3: ("<p>open <b>text <a href=x", "open text"),
        4: ("text only", "text only"),
        5: ("<script>if (a<b) {'</p>'}</script><p>x<style>y</style>z</p><noscript>n</noscript>", "xz"),
        6: ("<main><header><h1>Title</h1></header><p>Body</p><form>f</form><div class='share-bar'>s</div></main><p>out</p>", "Title\n\nBody"),
        7: ("<body class='has-sidebar'><header>h</header><p>kept<!-- c <p>no</p> --> too</p></body>", "kept too"),
        8: (None, ""),
        9: ("", ""),
        10: ("<article></article>", ""),
        11: ("<p title='a > b'>q</p><P>R</P><br/>s<hr>t", "q\n\nR\n\ns\n\nt"),
        12: ("<article><p>post</p><div class=comment><p>first!</p></div><section id=comments>c</section></article>", "post"),
        13: ("<p>" + "long " * 50_000 + "</p>", ("long " * 50_000).strip()),
        14: ("a < b and 3 > 2", "a < b and 3 > 2"),
    }
    pages = [(i, f"http://h{i}.example.com/", html) for i, (html, _) in cases.items()]
    pages += [(100, None, "<p>no url</p>"), (None, "not a url", "<p>no id</p>")]
    pages += [(200 + i, "http://same.example.com/x", "<html><body><article><p>copy</p></article></body></html>") for i in range(12)]
    got = extract(spark, pages)
    assert {i: got[i]["text"] for i in cases} == {i: text for i, (_, text) in cases.items()}
    assert got[100]["text"] == "no url" and got[None]["text"] == "no id"
    assert {got[200 + i]["text"] for i in range(12)} == {"copy"}


def test_empty(spark):
    assert extract(spark, []) == {}


def text_alone(html):
    return htmltext.extract(html, None, frozenset())


def test_quotes_comments_and_unfinished_tags():
    assert text_alone('<p title="5" tall">Hello text one</p>') == "Hello text one"
    assert text_alone("<p data-x=it's>Hello text</p><p>Don't stop</p><p>It's third</p>") == "Hello text\n\nDon't stop\n\nIt's third"
    assert text_alone("<!--><p>one</p><!---><p>two</p><!-- x > --><p>three</p><!-- a --!><p>four</p>") == "one\n\ntwo\n\nthree\n\nfour"
    assert text_alone("<p title='a>b' class=\"x y\">kept</p><p>a < b and 3<4</p>") == "kept\n\na < b and 3<4"
    assert text_alone('<p title="never closed>first</p><p>second</p>') == "first\n\nsecond"
    assert text_alone("<p>before</p><p class=x") == "before"
    assert text_alone("<p>a</p><script>if (a < b) x('</p>')</script ><style>p{}</STYLE><p>b</p>") == "a\n\nb"
    assert text_alone("<p>a</p><? php > <!doctype html> </> </ x><p>b</p>") == "a\n\nb"
    assert text_alone("<P CLASS='AD'>gone</P><p>stays</p>") == "stays"
    assert text_alone("<p>one<p>two<li>three<li>four") == "one\n\ntwo\n\nthree\n\nfour"


@pytest.mark.parametrize(
    "name",
    ["reader-comments", "user-comments", "post-comments", "article-comments", "comment-thread", "related-articles", "social-media", "entry-footer",
     "privacy-notice", "mobile-menu"],
)
def test_what_readers_and_others_add_inside_an_article_goes(name):
    html = f"<article><p>The article itself.</p><div class='{name}'><p>Nobody wrote this.</p></div><p>Its end.</p></article>"
    assert text_alone(html) == "The article itself.\n\nIts end."


def test_time_is_linear():
    import time

    start = time.perf_counter()
    text_alone("<div " * 200_000)
    text_alone("<p a='" * 150_000 + "x")
    text_alone("<!--" * 200_000)
    text_alone("<script>" * 100_000 + "<b" * 100_000)
    deep = "<div><p>x</p>" * 50_000
    assert text_alone(deep).count("x") == 50_000
    tokens = htmltext.page_tokens(deep + "</div></span>" * 50_000)
    assert max(t["volume"] for t in tokens) == 50_000
    assert time.perf_counter() - start < 30


def test_volumes_are_what_elements_hold():
    html = "<div id=a><p>one</p><div id=b><p>two three</p><a>link</a></div></div><div class=ad><p>buy</p></div>"
    volumes = sorted(t["volume"] for t in htmltext.page_tokens(html) if t["kind"] == "e")
    assert volumes == [0, len("one"), len("two three"), len("two three"), len("one") + len("two three")]
    named = [t for t in htmltext.page_tokens(html) if t["kind"] == "n"]
    assert [t["volume"] for t in named] == [len("buy")]
