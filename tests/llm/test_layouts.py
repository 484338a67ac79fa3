"""Extraction from hand-labelled pages of layouts that the training pages' generator can't make."""

from collections import Counter

import pytest

from fieldmart.llm import treemodel

EXACT = [
    ("<html><body><div><h1>Title here</h1></div><div><p>First paragraph of the story, long enough to read.</p><p>Second paragraph follows it.</p></div></body></html>", "Title here\nFirst paragraph of the story, long enough to read.\nSecond paragraph follows it."),
    ("<p>Only one paragraph of text on this page.</p>", "Only one paragraph of text on this page."),
    ("Just plain text without any markup at all.", "Just plain text without any markup at all."),
    ("<html><body><table><tr><td><a href=/a>Home</a> <a href=/b>News</a> <a href=/c>About</a></td><td><h1>Story</h1><p>The story text runs on for a while here.</p><p>And it has another part.</p></td></tr></table></body></html>", "Story\nThe story text runs on for a while here.\nAnd it has another part."),
    ('<html><body><article><h1>Story</h1><p>The text of the story itself.</p></article><div id="comments"><ol class="commentlist"><li>I liked this very much, thanks.</li><li>So did I.</li></ol></div></body></html>', "Story\nThe text of the story itself."),
]
RIVER = "The river rose two metres overnight and covered the lower fields before the farmers could move their machines."
CREWS = "Crews worked until morning to close the gap in the dam, and most of the roads are open again."
COUNCIL = "The council will meet on Thursday to decide who pays for the repairs."
MENU = '<a href="/">Home</a> <a href="/world">World</a> <a href="/sport">Sport</a> <a href="/about">About us</a>'
STORY = f"{RIVER}\n{CREWS}\n{COUNCIL}"
P = f"<p>{RIVER}</p><p>{CREWS}</p><p>{COUNCIL}</p>"
PAGES = [
    (f"<body>{MENU}<hr><h2>Flood</h2>{P}<hr><small>Copyright 2001</small></body>", f"Flood\n{STORY}"),
    (f"<html><head><title>Flood</title></head><body><center><font size=5>Flood</font></center>{P}</body></html>", f"Flood\n{STORY}"),
    (f'<html><body><div id="top"><ul><li><a href="/">Home</a></li><li><a href="/x">Archive</a></li></ul></div><div id="content"><h1>Flood</h1>{P}</div><div id="footer">All rights reserved</div></body></html>', f"Flood\n{STORY}"),
    (f'<html><body><div class="page"><div class="row"><div class="col nav"><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></div><div class="col main"><h1>Flood</h1>{P}</div></div></div></body></html>', f"Flood\n{STORY}"),
    (f"<html><body><main><header><h1>Flood</h1></header>{P}</main><footer><p>Contact the editors</p></footer></body></html>", f"Flood\n{STORY}"),
    (f"<!doctype html><title>Flood</title>{P}", STORY),
    (f"<html><body><table width=100%><tr><td colspan=2>The Daily Paper</td></tr><tr><td width=20%><a href=/a>Front</a><br><a href=/b>Local</a><br><a href=/c>Letters</a></td><td><b>Flood</b>{P}</td></tr><tr><td colspan=2>Copyright The Daily Paper</td></tr></table></body></html>", f"Flood\n{STORY}"),
    (f'<html><body><article class="post"><h1>Flood</h1>{P}</article><section id="respond"><h3>Leave a reply</h3><form><textarea></textarea><button>Send</button></form></section></body></html>', f"Flood\n{STORY}"),
    (f'<html><body><article><h1>Flood</h1>{P}</article><section class="comments-area"><h2>2 thoughts</h2><ol><li><div class="comment-body"><p>My cellar is full of water too.</p></div></li><li><div class="comment-body"><p>Thank you to the crews.</p></div></li></ol></section></body></html>', f"Flood\n{STORY}"),
    (f'<html><body><div class="cookie-banner"><p>We use cookies to make this site better.</p><button>Accept</button></div><div class="article-body"><h1>Flood</h1>{P}</div></body></html>', f"Flood\n{STORY}"),
    (f'<html><body><nav>{MENU}</nav><div class="entry-content">{P}<div class="ad">Buy our boats today</div><p>More follows tomorrow.</p></div></body></html>', f"{STORY}\nMore follows tomorrow."),
    (f"<div><div><div>{P}</div></div></div>", STORY),
    (f"<h1>Flood</h1>\n{RIVER}<br><br>{CREWS}<br><br>{COUNCIL}", f"Flood\n{RIVER} {CREWS} {COUNCIL}"),
    (f'<html><body><div role="navigation"><ul><li><a href="/">Home</a></li></ul></div><div role="main"><h1>Flood</h1>{P}</div></body></html>', f"Flood\n{STORY}"),
    (f'<html><body><section class="story"><h1>Flood</h1>{P}</section><aside><h3>Most read</h3><ul><li><a href="/1">Storm over the coast</a></li><li><a href="/2">New bridge opens</a></li></ul></aside></body></html>', f"Flood\n{STORY}"),
    (f"<html><body><script>document.write('<p>no</p>')</script><style>p {{ color: red }}</style><div><h1>Flood</h1>{P}</div></body></html>", f"Flood\n{STORY}"),
    (f'<html><body><div id="header"><h2>The Daily Paper</h2></div><div id="post"><h1>Flood</h1>{P}<ul class="share"><li><a href="/s">Share</a></li><li><a href="/t">Print</a></li></ul></div></body></html>', f"Flood\n{STORY}"),
    (f"<html><body><div><h1>Flood</h1><blockquote>{RIVER}</blockquote><pre>{CREWS}</pre><ul><li>{COUNCIL}</li></ul></div></body></html>", f"Flood\n{STORY}"),
    (f'<html><body><form action="/search"><label>Search this site</label><input name=q></form><article><p>{RIVER}</p><figure><img src=a.png><figcaption>The river at noon</figcaption></figure><p>{CREWS}</p></article></body></html>', f"{RIVER}\nThe river at noon\n{CREWS}"),
    (f'<html><body><ul id="menu"><li><a href="/a">Start</a></li><li><a href="/b">Contact</a></li></ul><div><p>{RIVER}</p></div><div><p>{CREWS}</p></div><div class="footer">Imprint</div></body></html>', f"{RIVER}\n{CREWS}"),
]


@pytest.fixture(scope="module")
def model():
    model = treemodel.TreeModel()
    model.unary, model.pair = treemodel.trained()
    return model


@pytest.mark.parametrize("page, text", EXACT)
def test_pages_that_were_lost(model, page, text):
    assert treemodel.main_text(page, model) == text


def f1(got, want):
    a, b = Counter(got.split()), Counter(want.split())
    both = sum((a & b).values())
    return 2 * both / max(1, sum(a.values()) + sum(b.values()))


def test_words_of_hand_labelled_pages(model):
    scores = [f1(treemodel.main_text(page, model), text) for page, text in PAGES]
    assert sum(scores) / len(scores) >= 0.95 and sorted(scores)[1] >= 0.9, [round(x, 3) for x in scores]
