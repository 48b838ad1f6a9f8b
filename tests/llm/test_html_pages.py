"""Main containers, noise on any element, and votes that change a page."""

from __future__ import annotations

import pytest

from cueflow.llm import html_text as h

LONG = "This sentence is plain text of the story and goes on for a while. " * 6


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<body><div class=post><div class=lead>A lead of some forty characters or more, here.</div><div class=text>{LONG}</div></div></body>", f"A lead of some forty characters or more, here.\n\n{LONG.strip()}"),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='t'>x=1</annotation></math> hold.</p></article>", "Let x=1 hold."),
        (f"<article><header><h1>Title</h1></header><p>{LONG}</p><section id='related-work'><p>Others did this.</p></section></article>", f"Title\n\n{LONG.strip()}\n\nOthers did this."),
        (f"<main><ul class='nav menu'><li>Home<ul><li>Deep</li></ul></li><li>About</li></ul><p>{LONG}</p></main>", LONG.strip()),
        (f"<main><p class='advert'>Buy<p>{LONG}</main>", LONG.strip()),
        (f"<main><p>{LONG}</p><ol class='comments'><li>first</li><li>second</li></ol></main>", LONG.strip()),
        (f"<main><p>{LONG}<span class='share-buttons'>Share <span>this</span> now</span> End.</p></main>", f"{LONG}End.".strip()),
        (f"<main><ul><li class=promo>Buy<ul><li>more</li></ul><li>Kept item</ul><p>{LONG}</p></main>", f"Kept item\n\n{LONG.strip()}"),
        (f"<body><header>Site</header><div role=main><h2 class='header'>Heading</h2><p>{LONG}</p></div><div class=box>Some words that stand beside it, long enough to be dense text.</div></body>", f"Heading\n\n{LONG.strip()}"),
        (f"<body><div hidden><p>secret</p></div><p style='display: none'>x</p><table><tr><td>{LONG}</td></tr></table></body>", LONG.strip()),
    ],
)
def test_pages(page, want):
    assert h.extract(page) == want


def test_deep_pages_take_linear_time():
    deep = "".join(f"<div class=c{chr(97 + k % 26)}>" for k in range(60_000)) + f"<p>{LONG}</p>"
    assert h.extract(deep) == LONG.strip()


def test_votes_of_a_host_change_a_page(spark):
    story = lambda k: f"<body><div class=story><p>Story {k}. {LONG}</p></div><div class=extra><p>Short.</p></div></body>"
    odd = f"<body><div class=story><p>Only a little story here, but it is the story.</p></div><div class=extra><p>{LONG * 30}</p></div></body>"
    other = f"<body><div class=extra><p>{LONG}</p></div></body>"
    rows = [(k, f"http://one.example/{k}", story(k)) for k in range(60)] + [(100, "http://one.example/odd", odd), (101, "HTTP://user@two.example:80/x", odd), (102, "http://one.example/other", other), (103, None, odd)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out, name = h.main_text(df)
    got = {r.page_id: r[name] for r in out.collect()}
    assert got[100] == "Only a little story here, but it is the story."
    assert got[101] == got[103]
    assert got[101].endswith((LONG * 30).strip())
    assert got[102] == LONG.strip()  # lacks the host's path
    assert got[5] == f"Story 5. {LONG.strip()}"


def test_leads_of_some_pages_raise_the_path(spark):
    lead = "<div class=lead>A lead paragraph that stands in a container of its own.</div>"
    page = lambda k: f"<body><div class=post>{lead if k % 3 == 0 else ''}<div class=text><p>{k}. {LONG}</p></div></div></body>"
    df = spark.createDataFrame([(k, f"http://one.example/{k}", page(k)) for k in range(30)], "page_id long, url string, html string")
    assert [r.path for r in h.host_paths(df).collect()] == ["body>div.post"]
    out, name = h.main_text(df)
    assert all(("A lead paragraph" in r[name]) == (r.page_id % 3 == 0) and r[name].endswith(f"{r.page_id}. {LONG.strip()}") for r in out.collect())
