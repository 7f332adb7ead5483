"""Main text: parts beside and inside the article, however long, and text that must not be lost with them."""

import math

import pytest

from skyledger.llm import html_text

WORDS = "on that day the people of the town went down to the river and spoke at some length about what had been seen there"
ART = [f"Paragraph {k}: {WORDS}." for k in range(4)]
LONG = [f"Reader {k} says that {WORDS}, and {WORDS}, and again {WORDS}." for k in range(9)]


def ps(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def page(body):
    return f"<html><head><title>t</title></head><body><nav><a href=/>Home</a></nav>{body}<footer>&copy; us</footer></body></html>"


PARTS = [f"<div class='comments'>{ps(LONG)}</div>", f"<aside>{ps(LONG)}</aside>", f"<footer>{ps(LONG)}</footer>",
         f"<section id=comments-area>{ps(LONG)}</section>", f"<div class='user-comments list'>{ps(LONG)}</div>",
         f"<form>{ps(LONG[:2])}</form>", f"<div role=complementary>{ps(LONG)}</div>", f"<div class=cookie-notice>{ps(LONG)}</div>",
         f"<aside><article>{ps(LONG)}</article></aside>"]


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("frame", ["<article>%s</article>", "<main>%s</main>", "<div id=content>%s</div>", "<div><div>%s</div></div>"])
def test_longer_parts_beside_and_inside_the_article(frame, part):
    want = "\n".join(ART)
    assert html_text.main_text(page(frame % ps(ART) + part)) == want
    assert html_text.main_text(page(part + frame % ps(ART))) == want
    assert html_text.main_text(page(frame % (ps(ART) + part))) == want


def test_header_with_a_heading_belongs_to_its_article():
    body = f"<header><h1>Site</h1></header><article><header><h1>Title</h1><p>By Ann</p></header>{ps(ART)}</article>"
    assert html_text.main_text(page(body)) == "\n".join(["Title", "By Ann", *ART])


def test_paragraphs_with_links_stay_and_link_lists_go():
    see = "<p>See <a href=/1>the first report of the river</a> and <a href=/2>the second report of the town</a>.</p>"
    text = "See the first report of the river and the second report of the town."
    links = "<ul>" + "".join(f"<li><a href=/{k}>another page {k}</a>" for k in range(9)) + "</ul>"
    for frame in ("<article>%s</article>", "<div>%s</div>"):
        assert html_text.main_text(page(frame % (ps(ART[:2]) + see + links + ps(ART[2:])))) == "\n".join([*ART[:2], text, *ART[2:]])


def test_pages_without_article_keep_headings_intro_and_short_sections():
    body = f"<h1>Head</h1><p>A short intro.</p><div>{ps(ART)}</div><div><h2>More</h2><p>Two words.</p></div><div>{ps(ART[:3])}</div>"
    assert html_text.main_text(page(body)) == "\n".join(["Head", "A short intro.", *ART, "More", "Two words.", *ART[:3]])


def test_text_inside_a_form_or_with_teasers():
    assert html_text.main_text(page(f"<h1>Head</h1><form>{ps(ART)}<select><option>x</select></form>")) == "\n".join(["Head", *ART])
    teasers = "".join(f"<article><p>Teaser {k}</p></article>" for k in range(3))
    assert html_text.main_text(page(f"<div id=text>{ps(ART)}</div><aside>{teasers}</aside>")) == "\n".join(ART)


def brute(node):
    """Counts and density of a plain tree ``(tag, child, ...)``, by recursion over its definition."""
    chars = tags = link_chars = link_tags = 0
    for k in node[1:]:
        if isinstance(k, str):
            chars += len(k)
        else:
            c, t, lc, lt = brute(k)
            chars, tags, link_chars, link_tags = chars + c, tags + t + 1, link_chars + lc, link_tags + lt + (k[0] == "a")
    return chars, tags, chars if node[0] == "a" else link_chars, link_tags


def test_density_equals_its_definition():
    tree = ("div", ("p", "some text of a page", ("a", "with a link"), "and more"), ("ul", ("li", ("a", "one")), ("li", ("a", "two"))),
            ("p", "plain words only"))

    def mark(x):
        return x if isinstance(x, str) else f"<{x[0]}>" + "".join(map(mark, x[1:])) + f"</{x[0]}>"

    root = html_text.parse(mark(tree))
    nodes = html_text._measure(root)
    c0, _, l0, _ = brute(("html", tree))
    flat = []

    def walk(x):
        flat.append(x)
        for k in x[1:]:
            if not isinstance(k, str):
                walk(k)

    walk(("html", tree))
    got = sorted((x.tag, x.chars, x.tags, x.link_chars, round(x.density, 9)) for x in nodes)
    want = []
    for x in flat:
        c, t, lc, lt = brute(x)
        t1, lc1, lt1 = max(t, 1), max(lc, 1), max(lt, 1)
        b = math.log(c / max(c - lc, 1) * lc + l0 / c0 * c + math.e)
        f = math.log(max(c / lc1 * t1 / lt1, 1)) / b
        want.append((x[0], c, t, lc, round(c / t1 * (f if lc else max(f, 1.0)), 9)))
    assert got == sorted(want)


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "<p>x"), (1, "<p>x")], "page_id int, html string")
    assert [r.text for r in html_text.extract(df).collect()] == ["x", "x"]
    assert html_text.extract(df.limit(0)).collect() == []
