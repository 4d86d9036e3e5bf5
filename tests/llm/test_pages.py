"""Main text of pages and url verdicts."""

from __future__ import annotations

import re

import pytest

from tilldeck.llm.html_text import content_lines, extract_main_text, main_text, named_part
from tilldeck.llm.urls import host_links, spread, url_verdicts

LONG = "This sentence is part of the article and has a good number of words in it."
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        (f"<nav>{MENU}</nav><article><h1>T &amp; t</h1><p>{LONG}<p>Short.</article><footer>F</footer>", f"T & t\n{LONG}\nShort."),
        (f"<head><title>x</title><body>{MENU}<div><p>{LONG}</p><p>{LONG}</p><p>Ok</p></div><div>{MENU}</div>", f"{LONG}\n{LONG}\nOk"),
        (f"<article><p>{LONG}</p><div class='ad-box x'>Buy</div><aside>Side</aside><p>End &eacute;&#233;</article>", f"{LONG}\nEnd éé"),
        (f"<div class=ad>Ad<article><p>{LONG} a\n\t b&nbsp;c<br>d</p></article>", f"{LONG} a b c d"),
        (f"<article><header><h2>Head</h2><span>by me</span></header><p>{LONG}</article>", f"Head\n{LONG}"),
        (
            f"<main><article><p>{LONG}</p></article><section id=comments><article><p>{LONG * 3}</p></article></section></main>",
            LONG,
        ),
        (f"<article><script>var a='</p><p>no';</script><style>p{{}}</style><form>Name <input></form><p>{LONG}</article>", LONG),
        (f"<article><p>{LONG}</p><div class='cookie-notice'><p>{LONG}</p></div><!-- <p>no</p> --><p>cut <b>off", f"{LONG}\ncut off"),
        ("<p>a", "a"),
    ],
)
def test_main_text(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (
            f"<div><h1>T</h1><p>intro</p><section>{LONG} {LONG} {LONG}</section><section>short</section></div>",
            f"T\nintro\n{LONG} {LONG} {LONG}\nshort",
        ),
        (f"<article><p>A {LONG}</p></article><article><p>{LONG} {LONG}</p></article>", f"A {LONG}\n{LONG} {LONG}"),
        (f"<body><div>{MENU}</div><div><h2>H</h2><p>{LONG}</p></div><div>{MENU}</div></body>", f"H\n{LONG}"),
    ],
)
def test_all_content_regions_are_covered(html, text):
    assert main_text(html) == text


def test_content_lines_cluster_dense_text():
    content = content_lines(["Home", "About", LONG, "Short.", LONG, "Terms"], [4, 4, 2, 2, 2, 5])
    assert content.tolist() == [False, True, True, True, True, True] or content[2:5].all()
    assert not content[0]


def test_pages_without_text_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(1, "u", None, "t", "c"), (None, None, f"<p>{LONG}", "t", "c"), (1, "u", None, "t", "c")],
        "page_id long, url string, html string, text string, carried string",
    )
    rows = extract_main_text(df).collect()
    assert [tuple(r) for r in rows] == [(1, "u", ""), (None, None, LONG), (1, "u", "")]
    assert extract_main_text(df.where("false")).collect() == []


RULES = ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")


def ruled(host, path):
    fits = [
        (len(r), r, v)
        for r, v in RULES
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])
    ]
    return max(fits)[1:] if fits else (None, None)


def test_rules_and_url_parts(spark):
    urls = {
        "http://A.Example.ORG/en/12?x": ("a.example.org", "/en/12"),
        "https://example.org/es/#a": ("example.org", "/es/"),
        "x://badexample.org/es/1": ("badexample.org", "/es/1"),
        "http://m.x.com/de/1": ("m.x.com", "/de/1"),
        "http://m.x.com/fr/": ("m.x.com", "/fr/"),
        "http://y.net/a://b.org/c": ("y.net", "/a://b.org/c"),
        "http://y.org": ("y.org", ""),
        "http://É.com/DE/": ("É.com", "/DE/"),
        "no scheme": ("", ""),
        "http://": ("", ""),
        None: ("", ""),
    }
    rows = [(i, u, None, "h", "v") for i, u in enumerate(urls)]
    df = spark.createDataFrame([*rows, (None, "http://y.net/q", "", "h", "v")], "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: r for r in url_verdicts(df).collect()}
    assert len(got) == len(urls) + 1
    for i, (host, path) in enumerate(urls.values()):
        rule, verdict = ruled(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        if verdict:
            assert got[i].verdict == verdict
    assert got[8].verdict == "allow" and got[None].verdict == "allow"
    assert url_verdicts(df.where("false")).collect() == []


def ranks(edges, seeds, damping, rounds):
    rank = {h: s * (1 - damping) for h, s in seeds.items()}
    for _ in range(rounds):
        new = {h: s * (1 - damping) for h, s in seeds.items()}
        for source, targets in edges.items():
            for target, n in targets.items():
                if source in rank:
                    share = rank[source] * n / sum(targets.values()) * damping
                    new[target] = new.get(target, 0) + share
        rank = new
    return rank


def test_trust_and_distrust_spread_along_links(spark):
    link = "<a class=x href='http://{}/p'>t</a>"
    pages = [
        ("http://good.org/a", [("mid.net", 2), ("far.net", 1)]),
        ("http://mid.net/a", [("far.net", 1)]),
        ("http://liar.net/a", [("shop.com", 3), ("mid.net", 1)]),
        ("http://shop.com/de/1", [("good.org", 1)]),
        ("http://helper.net/a", [("liar.net", 1)]),
    ]
    rows = [(i, u, "".join(link.format(h) * n for h, n in out) + "<a href=/own>o</a>") for i, (u, out) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = {"good.org": {"mid.net": 2, "far.net": 1}, "mid.net": {"far.net": 1}, "liar.net": {"shop.com": 3, "mid.net": 1}, "shop.com": {"good.org": 1}, "helper.net": {"liar.net": 1}}
    got = {(r.source, r.target): r.links for r in host_links(df).collect()}
    assert got == {(s, t): n for s, targets in edges.items() for t, n in targets.items()}
    back: dict[str, dict[str, int]] = {}
    for s, targets in edges.items():
        for t, n in targets.items():
            back.setdefault(t, {})[s] = n
    trust, distrust = ranks(edges, {"good.org": 1}, 0.85, 20), ranks(back, {"shop.com": 1}, 0.85, 20)
    for r in url_verdicts(df).collect():
        assert r.trust == pytest.approx(trust.get(r.host, 0)) and r.distrust == pytest.approx(distrust.get(r.host, 0))
        if r.rule is None:
            assert r.verdict == ("block" if distrust.get(r.host, 0) > trust.get(r.host, 0) else "allow")
    verdicts = {r.host: r.verdict for r in url_verdicts(df).collect()}
    assert verdicts["liar.net"] == verdicts["helper.net"] == "block" and verdicts["mid.net"] == "allow"
    none = spark.createDataFrame([], "source string, target string, links long")
    assert spread(none, spark.createDataFrame([("a", 2)], "host string, seed long")).collect()[0].host == "a"

DENSE = "A long sentence of the article goes on here with many words and no tags at all, so that it is dense. " * 3


@pytest.mark.parametrize(
    "markup, kept",
    [
        ('<div class="post-comments"><p>A reader disagrees with all of this at some length, as readers do.</p></div>', False),
        ('<div class="comment-body"><p>A reader disagrees with all of this at some length, as readers do.</p></div>', False),
        ('<div class="entry-footer"><p>Filed under this and that, posted by someone on a day.</p></div>', False),
        ('<div class="content-sidebar"><p>More stories from elsewhere that nobody asked for today.</p></div>', False),
        ('<div class="content-ad"><p>Buy now and save, this offer ends tonight at twelve sharp.</p></div>', False),
        ('<section class="job-search"><p>Looking for work takes months, the figures of last year say.</p></section>', True),
        ('<div class="content sidebar-left"><p>The layout has a sidebar, the text is the article.</p></div>', True),
        ('<div class="has-comments"><p>A page that allows comments has a text of its own.</p></div>', True),
        ("<p>Press <button>here</p><p>The rest of the article follows an unclosed button.</p>", True),
        ("<div>Press <button>here</div><p>The rest follows a button its parent has closed.</p>", True),
    ],
)
def test_names_are_judged_by_their_parts_and_mute_elements_end_with_parents(markup, kept):
    page = f"<html><body><article><h1>Title</h1><p>{DENSE}</p>{markup}<p>{DENSE}</p></article></body></html>"
    last = re.sub("<[^>]*>", "\n", markup).strip().split("\n")[-1]
    lines = main_text(page).split("\n")
    assert lines[0] == "Title" and lines[1] == DENSE.strip() and lines[-1] == DENSE.strip()
    assert (last in lines) is kept


@pytest.mark.parametrize(
    "names, part",
    [("post-comments", 2), ("comment_content", 2), ("ad", 1), ("main-ad", 1), ("article-body", 0), ("post", 0), ("job-search", 0),
     ("site search", 1), ("content comments", 2), ("no-sidebar", 0), ("shadow", 0), ("", 0), ("footer-links story", 0)],
)
def test_names_of_elements(names, part):
    assert named_part(names) == part


def test_trust_reaches_hosts_many_links_away(spark):
    count = 45
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(count)], "source string, target string, links long")
    got = {r.host: r.rank for r in spread(edges, spark.createDataFrame([("h0", 1)], "host string, seed long"), tolerance=1e-9).collect()}
    assert got[f"h{count}"] == pytest.approx(0.15 * 0.85**count, rel=1e-6)


def test_ties_and_repeated_pages_of_a_host(spark):
    page = ("http://a.org/x", '<a href="http://b.net/">b</a>')
    blocked = ("http://c.com/de/x", '<a href="http://b.net/">b</a>')
    rows = [(1, *page), (1, *page), (2, *page), (3, *blocked), (4, "http://b.net/p", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.verdict) for r in url_verdicts(df).collect())
    assert got == [(1, "allow"), (1, "allow"), (2, "allow"), (3, "block"), (4, "allow")]
