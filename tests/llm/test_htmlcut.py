from __future__ import annotations

import html as entities
import random
import re
from itertools import product

from dialogeval.llm import htmlcut as h
from dialogeval.llm.queries import QUERIES


def test_tables_against_their_mark_up(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op10_html_extraction"](spark, sf_dir).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        body = re.search("<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])


def energy(scores, edges, side):
    cost = sum(-s if s < 0 and inside else s if s > 0 and not inside else 0 for s, inside in zip(scores, side, strict=True))
    return cost + sum(c for a, b, c in edges if side[a] != side[b])


def test_minimum_cut_against_all_cuts():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randrange(1, 9)
        scores = [rng.choice((-2, -1, -0.5, 0, 0.5, 1, 2)) * rng.random() for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.random()) for _ in range(rng.randrange(2 * n))]
        edges = [e for e in edges if e[0] != e[1]]
        best = min(energy(scores, edges, side) for side in product((False, True), repeat=n))
        assert abs(energy(scores, edges, h.minimum_cut(scores, edges)) - best) < 1e-6


OTHER = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><a href=/>Home</a></header>
<div class="cookie-notice">We use cookies.</div><div id="content"><h1>Head &amp; line</h1>
<p>The first paragraph of the text, with several words, and a <a href=x>link</a> in it.<br>Next&nbsp;line.
<div class='advert'>Buy now!</div><p>Short one.<p>The last paragraph says a little more than that, and ends here.</p>
<form action=/s><label>Mail</label><input><button>Send</button></form></div>
<aside><p>Related things that are not part of the text at all, but long enough to be a paragraph.</p></aside>
<section class="comments"><p>I liked this article very much, it has many words, thank you for it.</p></section>
<script>var a = "<p>no</p>";</script><!-- <p>no</p> --><footer>&copy; 2020 Someone</footer></body></html>"""


def test_other_mark_up():
    expected = (
        "Head & line\nThe first paragraph of the text, with several words, and a link in it. Next line.\nShort one.\n"
        "The last paragraph says a little more than that, and ends here."
    )
    assert h.main_text(OTHER, h.PRIOR)[0] == expected


LONG = "This paragraph says what the page is about. It has several sentences of some words. They all belong to it."


def test_harmless_attributes_hide_nothing():
    for harmless in (
        'style="max-width:none"', "style='list-style: none; border:none'", "style=text-decoration:none", 'title="The hidden cost"',
        'title="a hidden b" class=x', "data-x=' style=\"display:none\" '", 'hidden="false"', 'aria-hidden="false"', 'data-hidden="1"',
        'style="display:none;display:block"', "style=\"background:url('a;display:none')\"", 'alt="class=hidden" "hidden"',
        'style="/* display:none; */ color:red"', 'data-style="display:none"', 'hidden="until-found"',
    ):
        page = f"<article><div {harmless}><p {harmless}>{LONG}</p></div></article>"
        assert h.main_text(page, h.PRIOR)[0] == LONG, harmless
    for hiding in (
        "hidden", "HIDDEN=''", 'title="x"hidden', "aria-hidden=true", 'style="display:none"', "STYLE='color:red; Display : NONE !important'",
        "style=display:none", 'style="display:none!important;display:block"', 'style="display:n&#111;ne"', "hidden /",
    ):
        page = f"<article><p>{LONG}</p><div {hiding}><p>Not {LONG}</p></div></article>"
        assert h.main_text(page, h.PRIOR)[0] == LONG, hiding


def test_wrappers_of_the_whole_page(spark, sf_dir):
    fitted = h.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    paragraphs = [f"{i}. {LONG}" for i in range(4)]
    plain = "".join(f"<p>{x}</p>" for x in paragraphs)
    aside = "<nav><a href=/>Home</a></nav>", "<aside><p>Related things to read.</p></aside><footer>Legal words</footer>"
    for weights in (h.PRIOR, fitted):
        for inner in (f"<article>{plain}</article>", f"<main><div><div>{plain}</div></div></main>", f"<div>{plain}</div>"):
            for wrapper in (
                "<form action=x>{}</form>", '<div class="container has-sidebar">{}</div>', '<div id="search-page">{}</div>',
                '<form><div class="sidebar-layout"><div>{}</div></div></form>', "<fieldset><form>{}</form></fieldset>",
            ):
                for page in (aside[0] + wrapper.format(inner) + aside[1], wrapper.format(aside[0] + inner + aside[1])):
                    assert h.main_text(f"<body>{page}</body>", weights)[0] == "\n".join(paragraphs), page
        # What is aside within the main text or beside it stays aside.
        for extra in (
            f"<form><p>{LONG}</p></form>", f"<div class=related><p>{LONG}</p></div>", f'<article class="comment-body"><p>{LONG}</p></article>',
            f"<section id=comments>{plain}{plain}</section>", f"<footer><div><p>{LONG}</p></div></footer>",
        ):
            page = f"<form><article>{plain}{extra}</article></form>"
            assert h.main_text(page, weights)[0] == "\n".join(paragraphs), page
            page = f"<article>{plain}</article>{extra}"
            assert h.main_text(page, weights)[0] == "\n".join(paragraphs), page


def test_hidden_inline_elements():
    for page in (
        f"<p>{{}}<span hidden>no <span>no</span> no</span>{LONG}</p>", f'<p>{LONG}<a href=x style="display:none">no</a></p>',
        f"<p>{LONG}<b aria-hidden=true>no</p>", f'<p>{LONG}</p><span style="display:none"><div><p>No {LONG}</p></div></span>',
        f"<div><p>{LONG} <i hidden>no</p></div>", f"<p>{LONG}<x-note HIDDEN>no<br>no</x-note></p>", f"<div><i hidden>no</div><p>{LONG}</p>",
    ):
        assert h.main_text(f"<article>{page.replace('{}', '')}</article>", h.PRIOR)[0] == LONG, page
    shown = f'<p><span title="hidden">{LONG}</span> <input type=hidden hidden><span style="color:red">Seen.</span> <br hidden>End.</p>'
    assert h.main_text(f"<article>{shown}</article>", h.PRIOR)[0] == f"{LONG} Seen. End."


def test_formulas_and_raw_elements():
    formula = "<math><semantics><mrow><mi>a</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding=tex>a=2</annotation></semantics></math>"
    script = "<script src=//cdn.x/>var a=1;</script>"
    for raw in (script, '<script src="x"/>var a;</script>', "<svg/>", '<svg viewBox="0 0 1 1" />', "<svg class=a/>no</svg>", '<iframe src="x" />'):
        page = f"<article><p>{LONG}</p>{raw}<p>The formula {formula} is well known.</p></article>"
        assert h.main_text(page, h.PRIOR)[0] == f"{LONG}\nThe formula a=2 is well known.", raw
    page = f'<?xml version="1.0"?><html><body><article><script src="x"/><p>{LONG}</p><script>x</script></article></body></html>'
    assert h.main_text(page, h.PRIOR)[0] == LONG


def test_comments_known_by_their_heading(spark, sf_dir):
    fitted = h.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    text = "\n".join(f"{i}. {LONG}" for i in range(4))
    plain = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    said = f"<div><p>{LONG}</p></div><ul><li>{LONG}</li></ul>"
    for weights in (h.PRIOR, fitted):
        for title in ("Comments", "3 comments", "Comments (12)", "Leave a reply", "2 Responses to &quot;x&quot;", "Kommentare:", "Commentaires",
                      "Comentarios"):
            for section in (f"<section><h2>{title}</h2>{said}</section>", f"<h3>{title}</h3>{said}", f"<div><div><h2>{title}</h2></div>{said}</div>"):
                for page in (f"<main>{plain}{section}</main>", f"<article>{plain}</article>{section}", f"<main><div>{plain}</div>{section}</main>"):
                    assert h.main_text(f"<body>{page}<footer>x</footer></body>", weights)[0] == text, page
        # Other headings, the next heading of the rank and the title of a page say nothing of readers.
        for title in ("Comments on the budget of the town", "Discussion", "Remarks"):
            assert h.main_text(f"<main><h2>{title}</h2>{plain}</main>", weights)[0] == f"{title}\n{text}"
        page = f"<main>{plain}<h3>Comments</h3>{said}<h2>Method</h2><p>{LONG}</p></main>"
        assert h.main_text(page, weights)[0] == f"{text}\nMethod\n{LONG}"
        assert h.main_text(f"<main><h1>Comments</h1>{plain}</main>", weights)[0] == f"Comments\n{text}"


def test_short_paragraphs_without_any_labels():
    assert h.main_text("<body><p>One short line.</p><p>And one more line.</p></body>", h.PRIOR)[0] == "One short line.\nAnd one more line."


def test_edges(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (3, "u", "<script>x"), (4, "u", "just words of a text < that & is >"),
            (5, "u", "<article><p>a&#65;&lt;b&gt;</article>"), (6, "u", "<div" * 3000), (7, "u", "<p>" + "long text. " * 50_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, text int")
    got = {r["page_id"]: r for r in h.extract(df).collect()}
    assert h.extract(df).count() == 8 and got[1]["text"] == "" and got[None]["text"] == "" and got[3]["text"] == ""
    assert got[5]["text"] == "aA<b>" and got[7]["n_chars"] == len("long text. " * 50_000) - 1
    assert h.extract(df.limit(0)).count() == 0
