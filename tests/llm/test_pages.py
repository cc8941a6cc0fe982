"""Noise with unique content, exempt wrappers, the style tree by plain counting and the join by host."""

import math
from collections import Counter, defaultdict

import pytest

from medalloy.llm import html_extract as hx

SCHEMA = "page_id long, url string, html string"


def texts(spark, page, n=30, host="h.example"):
    rows = [(i, f"http://{host}/{i}", page(i)) for i in range(n)]
    got = {r.page_id: r.text for r in hx.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == n
    return got


PAGES = {
    "comments": (lambda i: f"<article class='post'><h1>Head {i}</h1><p>Story {i} words.</p></article><section id='comments' class='comments-area'><ol><li>"
                           f"<article class='comment'><p>Reader says {i * 13}</p></article></li><li><article><p>Another {i * 7}</p></article></li></ol></section>",
                 lambda i: f"Head {i} Story {i} words."),
    "named": (lambda i: f"<div class='content'><p>Story {i} words here.</p></div><div class='comments'>Reader {i} wrote {i * 13}</div>"
                        f"<div class='sidebar'>Today {i}: weather {i * 3}</div><div class='ad'>Buy item {i}</div><div class='footer'>Printed {i * 5}</div>"
                        f"<form><label>Mail {i}</label></form>", lambda i: f"Story {i} words here."),
    "main": (lambda i: f"<main><p>Main {i}</p><div class='comments'>No {i * 3}</div><div class='related'><article>More {i * 5}</article></div>"
                       f"<ul class='share'><li>Send {i}</li></ul><p>End {i}</p></main>", lambda i: f"Main {i} End {i}"),
    "teaser": (lambda i: f"<div class='content'><p>{'Long story ' * 9}{i}</p></div><div class='related'><article>More {i * 5}</article></div>",
               lambda i: f"{'Long story ' * 9}{i}"),
    "menu": (lambda i: f"<div class='page menu'><article><p>Wrapped {i} {'text ' * 9}</p></article></div><p>Foot {i}</p>", lambda i: f"Wrapped {i} {'text ' * 9}".strip()),
    "form": (lambda i: f"<form><div class='header'>Top {i}</div><p>Body {i} {'text ' * 9}</p><div class='cookie notice'>Allow {i}?</div></form><p>Tail {i}</p>",
             lambda i: f"Body {i} {'text ' * 9}Tail {i}"),
    "code": (lambda i: f"<article><pre>x = {i} <span class='comment'># why {i}</span></pre><xmp>a<b>{i}</xmp><math>{i}+1</math></article>", lambda i: f"x = {i} # why {i} a<b>{i} {i}+1"),
}


@pytest.mark.parametrize("name", PAGES)
def test_noise_with_unique_content(spark, name):
    page, want = PAGES[name]
    assert texts(spark, page) == {i: want(i) for i in range(30)}


def plain_low(rows):
    """(host, node) below the threshold, by counting contents and their entropies page by page."""
    held, all_held = defaultdict(lambda: defaultdict(Counter)), defaultdict(lambda: defaultdict(Counter))
    for _, url, html in rows:
        own = {(node, hx._open(role, content), text) for node, role, content, text in hx.blocks(html) if role != 2}
        host = hx._host(url)
        for node, kind, text in own:
            held[host][node, kind][text] += 1
            all_held[""][node, kind][text] += 1
        for node, kind in {x[:2] for x in own}:
            held[host][node, kind][None] += 1
            all_held[""][node, kind][None] += 1

    def importance(contents):
        n = contents[None]
        each = [math.log(c) / math.log(n) for t, c in contents.items() if t is not None] if n > 1 else []
        return n, 1 - sum(each) / len(each) if each else 1.0

    low = set()
    for host, nodes in held.items():
        for (node, kind), contents in nodes.items():
            n, own = importance(contents)
            drawn = (n * own + hx.PRIOR_PAGES * importance(all_held[""][node, kind])[1]) / (n + hx.PRIOR_PAGES)
            if kind and drawn < (hx.NAMED_THRESHOLD if kind == 2 else hx.THRESHOLD):
                low.add((host, hx._signed(node)))
    return low


def hosts(spark):
    rows = [(h * 100 + i, f"http://h{h}.example/{i}", f"<div class='box'>Same on all {h}</div><div><p>Text {h} {i}</p><p class='social'>Twice {i // 2}</p></div>"
             f"<div class='page-footer'>Rights {h % 2}</div><table><tr><td>Cell {i % 3}</td></tr></table>") for h in range(4) for i in range(h * 4 + 1)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_style_tree_by_plain_counting(spark):
    rows, df = hosts(spark)
    low = {(r.host, r.node) for r in hx.low_nodes(df.select("url", "html")).collect()}
    assert low == plain_low(rows) and len(low) > 4
    for r in hx.extract(df).collect():
        own = {node for host, node in low if host == hx._host(r.url)}
        found = hx.blocks(next(h for i, _, h in rows if i == r.page_id))
        assert r.text == " ".join(t for node, role, content, t in found if hx.kept(role, content, hx._signed(node) in own, False))


def test_join_by_host_gives_the_same_texts(spark, monkeypatch):
    _, df = hosts(spark)
    sent = sorted(map(tuple, hx.extract(df).collect()))
    monkeypatch.setattr(hx, "MAX_SENT_NODES", 0)
    assert sorted(map(tuple, hx.extract(df).collect())) == sent
