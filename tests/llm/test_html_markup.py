"""Markup of real pages: boilerplate told by evidence, blocks that inline elements leave whole, odd markup, linear time."""

import time
import tracemalloc

import pytest

from shiftlens.llm.html_extraction import Page, called

WORDS = ("the river turned south past the old mill and nobody on the bank had seen the boat since the first light of that morning "
         "while the town behind them was still asleep").split()


def prose(k, n=30):
    return " ".join(WORDS[(k * 7 + i * (k + 3)) % len(WORDS)] for i in range(n))


BODY = [prose(k) for k in range(4)]
PARAS = "".join(f"<p>{t}</p>" for t in BODY)


@pytest.mark.parametrize("markup, text", [
    ('<h1 class="entry-header">A title of words</h1>', "A title of words"),
    ('<div class="article-header"><h1>A title of words</h1></div>', "A title of words"),
    (f'<section class="related-work"><p>{prose(9)}</p></section>', prose(9)),
    (f'<div class="modal-verbs"><p>{prose(9)}</p></div>', prose(9)),
    (f'<div id="sharing-economy"><p>{prose(9)}</p></div>', prose(9)),
    (f'<p class="social-history-intro">{prose(9)}</p>', prose(9)),
])
def test_what_a_class_word_does_not_drop_inside_the_article(markup, text):
    assert Page(f"<body><article>{markup}{PARAS}</article></body>").text([]) == "\n".join([text, *BODY])


@pytest.mark.parametrize("name", [
    "ad-container", "comments-wrapper", "cookie-container", "newsletter-wrapper", "main-navigation", "page-footer", "sidebar-wrap",
    "commentlist", "adsbygoogle", "site-header", "related-posts", "share-buttons", "socialIcons", "widget_area", "comment-content",
    "Sidebar-Left", "ad-top-1", "cookie-banner", "breadcrumbs-list", "pagination"])
def test_what_is_boilerplate_goes(name):
    extra = f'<div class="{name}"><p>{prose(11, 12)}</p></div>'
    for page in (f"<body><article>{PARAS}{extra}</article></body>", f"<body><div class=post>{extra}{PARAS}</div></body>"):
        assert Page(page).text([]) == "\n".join(BODY)


def test_links_decide_where_the_words_may_be_a_subject():
    links = "".join(f'<li><a href="/{k}">{prose(k, 5)}</a></li>' for k in range(6))
    page = f'<body><article>{PARAS}<div class="related-stories-today"><ul>{links}</ul></div></article></body>'
    assert Page(page).text([]) == "\n".join(BODY)


SCHEMES = {
    "blog": '<div id="page" class="site"><div id="primary" class="content-area"><main id="main" class="site-main"><article id="post-7" '
            'class="post-7 post type-post status-publish format-standard category-social tag-cookies"><div class="entry-content">{}</div>'
            '<div class="entry-footer"><a href=x>tags</a></div></article></main></div><div id="secondary" class="widget-area sidebar">'
            '<a href=x>side</a> words</div></div>',
    "theme": '<div class="wrapper has-sidebar no-footer"><div class="content column"><div class="post-body text-formatted">{}</div></div></div>',
    "docs": '<div class="layout-container"><div class="sidebar"><ul><li><a href=a>A</a></ul></div><div class="md-content"><div '
            'class="md-content__inner md-typeset">{}</div></div></div>',
    "wiki": '<div id="content" class="mw-body" role="main"><div id="bodyContent"><div id="mw-content-text">{}</div></div></div>'
            '<div id="mw-navigation"><a href=x>Menu</a></div><div id="footer">Text is under a licence</div>',
    "news": '<section class="story"><header class="story__header"><span>By</span></header><div class="story__body js-body">{}</div>'
            '<aside>Aside</aside></section>',
    "shop": '<div class="row"><div class="col-md-8 main"><div class="description">{}</div></div><div class="col-md-4 sidebar-right">'
            '<p>Buy now while stocks last</p></div></div>',
    "table": '<table width=100%><tr><td class="nav"><a href=x>Home</a><td class="main">{}<tr><td colspan=2 class="copyright">All rights</table>',
    "forum": '<div class="topic"><div class="postbody"><div class="content">{}</div></div><div class="comments-list"><p>First!</p></div></div>',
    "utility": '<div class="flex w-1/2 md:w-2/3"><div class="prose lg:prose-xl">{}</div></div><div class="fixed bottom-0 cookie-bar">We use cookies</div>',
    "camel": '<div class="pageLayout"><div class="ArticleBody_root__x7">{}</div><div class="NewsletterSignup">Sign up for more</div></div>',
    "plain": "<div>{}</div><div class=footer>(c) someone</div>",
    "state": '<div class="post comments-open" id="post-9">{}<div id="respond" class="comment-respond"><p>Leave a reply</p></div></div>',
}


@pytest.mark.parametrize("scheme", sorted(SCHEMES))
def test_class_schemes_of_real_pages_give_the_article(scheme):
    frame = SCHEMES[scheme]
    top = '<header class="site-header"><nav><a href=/>Home</a></nav></header><div class="cookie-notice">Accept all of this</div>'
    assert Page(f"<!DOCTYPE html><html><head><title>T</title></head><body>{top}{frame.format(PARAS)}</body></html>").text([]) == "\n".join(BODY)


@pytest.mark.parametrize("markup, text", [
    ("<p>wo<svg><path d=x></svg>rd</p>", "word"), ("<p>foo <script>x</script>bar</p>", "foo bar"),
    ("<p>a <span hidden>no</span>b <label>no</label>c<noscript>no</noscript> d<iframe src=x>no</iframe>e</p>", "a b c de"),
    ("<p>x<style>p{}</style>y<object>no</object>z</p>", "xyz"), ("<p>one<br>two</p>", "one two"),
    ('<p title="5" wide">inch</p>', "inch"), ("<p data-x=it's>own</p>", "own"), ("<p a=\"b>c\">in</p>", "in"),
    ("<p x='>'y=\"'>\">q</p>", "q"), ("<!--><p>seen</p>", "seen"), ("<!---><p>seen</p>", "seen"), ("<!-- a --!><p>seen</p>", "seen"),
    ("<p>a < b &amp; c <3 d</p>", "a < b & c <3 d"), ("<p>x</ p>y</p>", "xy"), ("<p>kept <a href='cut off", "kept"),
    ("<p>kept<!-- cut off <b>", "kept"), ("<p/class=x>slash", "slash"), ("<?xml version='1'?><p>pi</p>", "pi"),
])
def test_odd_markup_leaves_text_whole_and_no_markup_in_it(markup, text):
    assert Page(f"<body><div>{markup}").text([]) == text


@pytest.mark.parametrize("piece", ["<div>", "<a '", "<a =\"", "<b></i>", "<i><div><b></i>", "<!-", "<", "<div class=\"ad x\">", "<p>a", "<table><tr><td>",
                                   "<ul><li>", "<script", "</x", "<a href='", "&amp", "<span class=related-x>y"])
def test_time_and_memory_are_linear(piece):
    source = (piece * (200_000 // len(piece)))
    Page(source[:1000])
    start = time.process_time()
    Page(source).text([])
    assert time.process_time() - start < 5  # seconds; a quadratic reader takes minutes
    tracemalloc.start()
    Page(source[:50_000]).text([])
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()


def test_classes_and_ids_by_word():
    assert called("div", {"class": "page-footer"})[0] == 1 and called("div", {"class": "related-work"})[0] == 2
    assert called("h2", {"class": "footer"})[0] == 0 and called("div", {"class": "no-sidebar"})[0] == 0
    assert called("div", {"class": "comment-body"})[:2] == (1, True)


def test_slices_are_bounded_by_bytes():
    import pyarrow as pa

    from shiftlens.llm.common import slices

    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "t": ["x" * 10, None, "y" * 35, "", "z" * 5, "w" * 6, "v" * 90]})
    got = [part.column("id").to_pylist() for part in slices(batch, "t", most_bytes=20, most_rows=3)]
    assert got == [[0, 1], [2], [3, 4, 5], [6]]
    assert list(slices(batch.slice(0, 0), "t")) == []
