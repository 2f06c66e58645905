"""Main text of pages."""

import time

import pytest

from dossierlake.llm import extract
from dossierlake.llm.labelled_pages import PAGES

ARTICLE = "<article><h1>T &amp; U</h1><p>One  two\n three&nbsp;four <b>five</b>six.<br>Seven</p><ul><li>a b c d</li></ul></article>"
TEXT = "T & U\nOne two three four fivesix. Seven\na b c d"


def plain(markup):
    """The markup with a space for every tag."""
    parts, at = [], 0
    for tag in extract.tags(markup):
        parts.append(markup[at : tag.start])
        at = tag.end
    return " ".join([*parts, markup[at:]])


def test_parts_of_a_page():
    page = (
        '<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        '<header><a href="/">Home page of all things</a></header><nav><ul><li><a>Menu</a></li></ul></nav>'
        '<!-- ad --><div class="ad">Buy now, buy now, buy now.</div>' + ARTICLE +
        '<div class="comments"><p>Long reader comment with many words in it, more than the text has, really.</p></div>'
        "<aside>Side words</aside><form>Mail <input></form><footer>&copy; us</footer></body></html>"
    )
    assert extract.main_text(page) == TEXT


def test_adverts_inside_the_text_are_left_out():
    page = ARTICLE.replace("<ul>", '<div class="ad-slot">x y z</div><script>1</script><ul>')
    assert extract.main_text(page) == TEXT
    wrapped = f'<body class="has-sidebar"><div class="with-sidebar">{ARTICLE}</div></body>'
    assert extract.main_text(wrapped) == TEXT


def test_no_part_of_an_article_is_cut():
    para = "<p>" + " ".join(f"w{i}" for i in range(20)) + "</p>"
    short = "<p>Two words</p>"
    items = "<ul><li>Flour</li><li>Two eggs</li></ul>"
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Name{i}</a></li>" for i in range(40)) + "</ul>"
    cells = "<table>" + "<tr><td>1</td><td>2</td></tr>" * 20 + "</table>"
    outside = "<div><ul><li><a>Other</a></li></ul></div>"
    for around in ("<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>"):
        for part in (items, links, cells):
            for inner in (part + para, para + part, para + part + short, short + part + para):
                page = outside + around.format(inner) + outside
                assert extract.main_text(page).split() == plain(inner).split()


def test_class_names_do_not_hide_a_whole_text():
    para = "<p>" + " ".join(f"w{i}" for i in range(20)) + "</p>"
    body = extract.main_text(para)
    assert extract.main_text(f"<div class='content-with-sidebar'>{para}</div>") == body
    assert extract.main_text(f"<article><h1>T</h1><div class='elementor-widget-text'>{para}</div></article>") == f"T\n{body}"
    assert extract.main_text(f"<article><div class='entry-header'><h1>T</h1></div>{para}</article>") == f"T\n{body}"
    assert extract.main_text(f"<div class='widget'>{para}</div>") == body
    nested = f"<div class='page-with-menu'><div class='related-widget-x'>{para}</div></div>"
    assert extract.main_text(nested) == body
    # What is smaller than the text stays closed off, and so do whole names that tell.
    assert extract.main_text(f"{para}<div class='my-ad-box'>Buy now</div><div class='comments'>{para * 3}</div>") == body


def test_odd_markup():
    assert extract.main_text(None) == "" == extract.main_text("") == extract.main_text("<p></p><!-- a -->")
    assert extract.main_text("just words here") == "just words here"
    assert extract.main_text("<p>a < b and c > d</p>") == "a < b and c > d"
    assert extract.main_text("<p>cut off <b>in the middle of a tag <a href='x") == "cut off in the middle of a tag"
    assert extract.main_text("<p>one<p>two<P>three") == "one\ntwo\nthree"
    assert extract.main_text('<p title="a > b">quoted</p>') == "quoted"
    assert extract.main_text("<script>never ends <p>x</p>") == ""
    long = "<p>" + "word " * 200_000 + "</p>"
    assert len(extract.main_text(long)) == 999_999


def test_forms_and_longer_class_names_hide_no_text():
    words = " ".join(f"w{i}" for i in range(30))
    for inner in (f"<main><article><p>{words}</p></article></main>", f"<div><p>{words}</p></div>"):
        assert extract.main_text(f"<form action='x'>{inner}</form>") == words
        assert extract.main_text(f"<body><form id='aspnetForm'><div>{inner}</div></form></body>") == words
    mail = "<form><label>Mail</label><input><button>Send it now</button></form>"
    assert extract.main_text(f"<article><p>{words}</p>{mail}</article>") == words
    part = '<div class="elementor-widget-text"><p>some other body text</p></div>'
    assert extract.main_text(f"<article><p>{words}</p>{part}</article>") == f"{words}\nsome other body text"
    assert extract.main_text(f"{part}<article><p>{words}</p></article>{part}") == words


def test_pieces_of_markup():
    page = '<!-- a > b --><p title="x > y">1 < 2</p><svg/><SCRIPT src="a">if (a<b) "</p>"</SCRIPT ><![CDATA[z]]><br/>'
    found = [(t.name or t.raw, t.close, page[t.start : t.end]) for t in extract.tags(page)]
    assert found == [
        ("", False, "<!-- a > b -->"), ("p", False, '<p title="x > y">'), ("p", True, "</p>"), ("svg", False, "<svg/>"),
        ("script", False, '<SCRIPT src="a">if (a<b) "</p>"</SCRIPT >'), ("", False, "<![CDATA[z]]>"),
        ("br", False, "<br/>"),
    ]
    assert plain('x<a title="never closed>y</a>z') == "x y z"
    assert plain("a <b") == "a  " and plain("a < b") == "a < b" and plain("a<!-- b") == "a "


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, '<a ">x"' * 150_000, '<a "' * 250_000, "<!--" * 250_000, "<![CDATA[" * 100_000 + ">",
     "<script " * 120_000 + ">", "<" * 1_000_000, '<div class="x-menu-y">' * 10_000 + "word " * 50,
     "<div>" * 10_000 + "</b>" * 10_000 + "word", "<form>" * 10_000 + "word"],
)
def test_broken_and_deep_markup_takes_linear_time(page):
    started = time.time()
    extract.main_text(page)
    assert time.time() - started < 10


def test_stretch_equals_brute_force():
    """The chosen blocks have the highest sum of all contiguous ones."""
    w = extract.default_weights()
    blocks = [("li", 1), ("li", 1), ("p", 9), ("li", 1), ("p", 30), ("li", 1), ("li", 1), ("li", 1), ("p", 6)]
    page = "".join(f"<{t}>{' '.join([f'{t}{i}'] * n)}</{t}>" for i, (t, n) in enumerate(blocks))
    best = max(
        ((sum(n * w.word for _, n in blocks[i:j]) - sum(w.tags[t] for t, _ in blocks[i:j]) + w.tags[blocks[i][0]] / 2
          + w.tags[blocks[j - 1][0]] / 2, i, j) for i in range(9) for j in range(i + 1, 10)),
    )
    found = extract.main_text(page).split("\n")
    assert found == [" ".join([f"{t}{i}"] * n) for i, (t, n) in enumerate(blocks)][best[1] : best[2]]


def test_labelled_pages_are_told_apart():
    for page in PAGES:
        text = extract.main_text("".join(markup for markup, _ in page))
        outside = [plain(markup).split() for markup, label in page if label == 0]
        for words in outside:
            assert not words or " ".join(words) not in text


def test_query_rows(spark):
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (None, None, None), (2, "v", "")]
    frame = spark.createDataFrame([(*r, "?") for r in rows], "page_id bigint, url string, html string, text string")
    got = sorted((tuple(r) for r in extract.extract(frame).collect()), key=repr)
    assert got == sorted([(i, u, TEXT if h else "", len(TEXT) if h else 0) for i, u, h in rows], key=repr)
    assert extract.extract(frame.limit(0)).count() == 0
