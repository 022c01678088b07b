"""HTML extraction against answers written by hand: articles in plain elements, long pages,
broken markup."""

import random

import pytest

from ledgerlake.llm import extract

WORDS = ("the harvest of this valley was late and small but every family found enough to bring home before the first snow came down from "
         "those hills while children sang old songs beside a slow river that carried leaves and light toward distant towns").split()


def _sentence(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + "."


def _page(r, wrap, paragraphs):
    """(html, main text): ``wrap`` is the opening and closing of the article's element."""
    main = [" ".join(r.choice(WORDS) for _ in range(5)).title()] + [_sentence(r, r.randrange(12, 45)) for _ in range(paragraphs)]
    links = "".join(f'<li><a href="/{w}">{w.title()}</a></li>' for w in r.sample(WORDS, 6))
    body = f"<h1>{main[0]}</h1>" + "".join(f"<p>{x}</p>" for x in main[1:])
    return (f'<!DOCTYPE html><html><head><title>{main[0]}</title><style>p{{margin:0}}</style></head><body><div class="header"><a href="/">Home</a></div>'
            f'<ul class="menu">{links}</ul>{wrap[0]}{body}{wrap[1]}<div class="sidebar"><p>{_sentence(r, 9)}</p></div>'
            f'<div class="comments"><p>{_sentence(r, 14)}</p><p>{_sentence(r, 8)}</p></div><form><label>Your name</label></form>'
            f'<div id="footer">Copyright {r.randrange(1990, 2020)} all rights reserved</div></body></html>', "\n".join(main))


def _extract(spark, pages, **kw):
    df = spark.createDataFrame([(i, f"http://h/{i}", p) for i, p in enumerate(pages)], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in extract.main_text(df, **kw).collect()}


@pytest.mark.parametrize("wrap", [('<div class="content">', "</div>"), ('<div id="x7"><div>', "</div></div>"), ("<table><tr><td>", "</td></tr></table>"),
                                  ("<section>", "</section>")])
def test_pages_without_an_article(spark, wrap):
    r = random.Random(wrap[0])
    pages = [_page(r, wrap, r.randrange(3, 9)) for _ in range(40)]
    got = _extract(spark, [p for p, _ in pages])
    right = sum(got[i] == text for i, (_, text) in enumerate(pages))
    assert right >= 38 and all(got.values())


def test_articles_and_plain_pages_together(spark):
    r = random.Random(1)
    wraps = [("<article>", "</article>")] * 3 + [('<div class="content">', "</div>")]
    pages = [_page(r, wraps[i % 4], r.randrange(3, 9)) for i in range(120)]
    got = _extract(spark, [p for p, _ in pages])
    assert sum(got[i] == text for i, (_, text) in enumerate(pages)) >= 114


def test_long_pages_are_read_and_learned_from_whole(spark):
    r = random.Random(2)
    pages = [_page(r, ("<article>", "</article>"), 150 if i % 10 == 0 else 6) for i in range(60)]
    got = _extract(spark, [p for p, _ in pages])
    assert [i for i, (_, text) in enumerate(pages) if got[i] != text] == []


def test_dense_element_of_a_page():
    page = extract.blocks('<html><body><div class="nav">A</div><div class="c"><h2>Title here</h2><p>' + 'one two three four five ' * 8 + '</p>'
                          '<p><a href="/">all linked words of it</a></p></div><p>short one</p>'
                          "<p>a longer paragraph outside that says eight words or more</p></body></html>")
    assert extract.dense(page) == [False, True, True, False, False, None]
    assert extract.dense([]) == [] and extract.dense(extract.blocks("<a>only links</a>")) == [False]


def test_broken_markup():
    assert extract.blocks("<p>one<!-- never closed <p>two") == [(("p",), "one", 0.0)]
    assert [b[1] for b in extract.blocks("<p>one<p>two<div>three</p>four")] == ["one", "two", "three", "four"]
    assert [b[1] for b in extract.blocks("a<script>b</p>c")] == ["a"]
    assert [b[1] for b in extract.blocks("<p>a &amp; b&nbsp;&#x41; < c</p><p class='x")] == ["a & b A < c"]


def test_the_sample_is_bounded_and_takes_copies_once(spark):
    rows = [(7, "http://h/same", "<p>same</p>")] * 500 + [(i, f"http://h/{i}", f"<p>{i}</p>") for i in range(500)] + [(None, None, "<p>null</p>"), (8, "u", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(7)
    got = extract.sample(df, "page_id", "url", "html", 100)
    assert 20 < len(got) <= 100 and len(set(got)) == len(got) and got == extract.sample(df.repartition(2), "page_id", "url", "html", 100)
    assert len(extract.sample(df, "page_id", "url", "html", 10_000)) == 502
    assert extract.sample(df.limit(0), "page_id", "url", "html", 100) == []
