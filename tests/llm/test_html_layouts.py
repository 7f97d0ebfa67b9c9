import itertools

import pytest

from tidemark.llm import html_text

PARAGRAPHS = [f"Paragraph {k} of the story tells at some length what happened, to whom and why it matters to all of us." for k in range(4)]
STORY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
PAGES = {
    "plain": "<div id=content>{}</div>",
    "server form": '<form method=post action="./p.aspx" id="aspnetForm"><input type=hidden name=v><div id=content>{}</div></form>',
    "article": "<div class=wrap><article>{}</article></div>",
    "form around an article": '<form id="form1"><div><article>{}</article></div></form>',
    "main": '<main><div class="text">{}</div></main>',
}
HEADS = {
    "none": ("", []),
    "first heading": ("<h1>The headline</h1>", ["The headline"]),
    "header": ("<header><h1>The headline</h1><p>An intro that stands above it all.</p><nav><a href=/>Home</a></nav></header>", ["The headline", "An intro that stands above it all."]),
}
ONE = '<{t} class="{c}"><div class="by"><span class="author">Ann</span> <time>May 5</time></div><p>I do not agree at all with what is said here, and neither does anyone I know.</p><a class="reply-link" href="#">Reply</a></{t}>'
COMMENTS = {
    "none": "",
    "named": f'<div id="comments"><h3>Comments</h3>{ONE.format(t="div", c="c")}</div>',
    "responses": f'<section id="responses"><h3>2 responses</h3>{ONE.format(t="article", c="r") * 2}</section>',
    "discussion": f'<div class="discussion">{ONE.format(t="div", c="x")}</div>',
    "siblings": f'<ul>{ONE.format(t="li", c="u7") * 12}</ul>',
}
ROUND = '<html><body><header><a href=/>Site</a> of news</header><form class="search"><label>Search the site</label><input></form>{}<form action="/mail"><p>Get our letter every week.</p><input name=mail></form><footer>All rights reserved</footer></body></html>'


@pytest.mark.parametrize(("page", "head", "comments"), [x for x in itertools.product(PAGES, HEADS, COMMENTS) if x[1] != "header" or x[0] not in ("plain", "server form")])
def test_layout(page, head, comments):
    """The story and its head, whatever is around it, and without comments inside or behind it."""
    top, want = HEADS[head]
    want = "\n\n".join(want + PARAGRAPHS)
    inside = ROUND.format(PAGES[page].format(top + STORY + COMMENTS[comments]))
    behind = ROUND.format(PAGES[page].format(top + STORY) + COMMENTS[comments])
    assert html_text.extract(inside) == want and html_text.extract(behind) == want


def test_what_is_no_comment():
    section = '<section id="discussion"><h2>Discussion</h2><p>We found that the results hold for all of the samples that we took.</p></section>'
    page = f"<article><h1>A paper</h1>{STORY}{section}</article>"
    assert html_text.extract(page).endswith("that we took.") and "Discussion" in html_text.extract(page)
    listing = "".join(f'<div class=post><span class=author>A{k}</span><time>May</time><p>{p}</p></div>' for k, p in enumerate(PARAGRAPHS))
    assert all(p in html_text.extract(f"<body><div id=list>{listing}</div></body>") for p in PARAGRAPHS)
    thread = f'<body><div class="thread">{ONE.format(t="div", c="p") * 3}</div></body>'
    assert "I do not agree" in html_text.extract(thread)  # nothing else is there


def test_a_form_with_the_text_beside_an_article_is_no_content():
    long_form = "<form>" + "".join(f"<p>Question {k}: how satisfied are you with this part of the service we gave you?</p>" for k in range(20)) + "</form>"
    assert html_text.extract(f"<body><article><h1>News</h1><p>Short but true.</p></article>{long_form}</body>") == "News\n\nShort but true."
