"""Pages built from known articles: hosts of several templates and sizes, each text known."""

from __future__ import annotations

import random

import pytest

from fabula.llm import wrappers

SCHEMA = "page_id long, url string, html string, text string, host string, wrapper string"


def texts(spark, pages):
    rows = [(*p, "x", "y", "z") for p in pages]
    return {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def words(rng, n):
    return " ".join(rng.choice(("alpha", "beta", "gamma", "delta", "omega", "sigma")) + str(rng.randrange(999)) for _ in range(n))


def article(rng):
    """Blocks of an article as (html, text)."""
    out = [(f"<h1>{(t := words(rng, 4))}</h1>", t)]
    for _ in range(rng.randint(2, 6)):
        kind, t = rng.randrange(5), words(rng, rng.randint(12, 30))
        u = words(rng, 6)
        out += {
            0: [(f"<p>{t}</p>", t)], 1: [(f"<p>{t} <b>bold</b> <a href=x>link</a>", f"{t} bold link")], 2: [(f"<h2>{u}</h2>", u), (f"<p>{t}</p>", t)],
            3: [("<ul>", None), (f"<li>{t}</li>", t), (f"<li>{u}</li>", u), ("</ul>", None)], 4: [(f"<blockquote><p>{t}</p></blockquote>", t)],
        }[kind]
    return "".join(h for h, _ in out), "\n".join(t for _, t in out if t)


def neutral(body, k, rng):
    return f"<html><body><div class=a1><div class=b7>Site name</div><div class=b8><a href=/>Home</a> <a href=/n>News</a></div><div class=b9>{body}</div><div class=c1><p>Visitor {k} says {words(rng, 4)}</p></div><div class=c2>Copyright, all rights</div></div></body></html>"


def bare(body, k, rng):
    return f"<html><body><div>Site name</div><div><a href=/>Home</a><a href=/n>News</a></div><div>{body}</div><div>Visitor {k}: {words(rng, 4)}</div><div>Copyright</div></body></html>"


def modern(body, k, rng):
    return f"<body><header><a>Home</a></header><nav><a>News</a></nav><main><article>{body}<aside>Aside {k}</aside></article><div class=related>Other {k}</div></main><footer>Foot</footer>"


def nested(body, k, rng):
    return f"<body><div id=page-{k}><div class=menu><ul><li><a>Home</a></li></ul></div><div class=wrap><div class=post>{body}</div></div><div class=sidebar><p>Side {k}</p></div><div class=comments><p>Comment {k}</p></div></div>"


@pytest.mark.parametrize("template", [neutral, bare, modern, nested])
def test_hosts_of_any_size(spark, template):
    rng, pages, want = random.Random(template.__name__), [], {}
    for host, n in enumerate((1, 2, 12)):
        for k in range(n):
            body, text = article(rng)
            i = 100 * host + k
            pages.append((i, f"https://h{host}.example.org/{k}", template(body, k, rng)))
            want[i] = text
    assert texts(spark, pages) == want


def test_two_templates_of_one_host(spark):
    rng, pages, want = random.Random(4), [], {}
    for k in range(30):
        body, text = article(rng)
        pages.append((k, f"https://h.example.org/{k}", (neutral, modern, nested)[k % 3](body, k, rng)))
        want[k] = text
    assert texts(spark, pages) == want


@pytest.mark.parametrize("outer", ["<article>{}</article>", "<div class=entry>{}</div>"])
@pytest.mark.parametrize("n", [1, 2, 12])
def test_sections_with_telling_names_are_article(spark, outer, n):
    body = "<h1>Shares {k}</h1><p>The price of page {k} rose, said the paper on page {k}.</p><div class='share-price'><p>12.{k} euro a share</p></div><section class='search-results'><p>They searched {k} houses.</p></section><section class=related><h2>Related</h2><p>A case {k} like it.</p></section>"
    want = "Shares {k}\nThe price of page {k} rose, said the paper on page {k}.\n12.{k} euro a share\nThey searched {k} houses.\nRelated\nA case {k} like it."
    pages = [(k, f"http://a.org/{k}", f"<body><nav><a>Home</a></nav>{outer.format(body)}<footer>Foot</footer></body>".replace("{k}", str(k))) for k in range(n)]
    assert texts(spark, pages) == {k: want.replace("{k}", str(k)) for k in range(n)}


def test_alignment_decides(spark, monkeypatch):
    """What stands at one place on all pages is known only by aligning them; without alignment the result is another."""
    page = "<body><div><p>The same long notice stands on each page of this host, before the news, word by word.</p><p>It has two paragraphs of many words, and more words than the news.</p></div><div><p>News {k}: something has happened in town {k}.</p></div></body>"
    pages = [page.replace("{k}", str(k)) for k in range(5)]
    w = wrappers.infer(pages)
    got = [wrappers.extract(p, wrappers.Rules(w, wrappers.decide(w))) for p in pages]
    assert got == [f"News {k}: something has happened in town {k}." for k in range(5)]
    monkeypatch.setattr(wrappers, "matched", lambda a, b: [*((x, None) for x in a), *((None, y) for y in b)])
    w = wrappers.infer(pages)
    assert [wrappers.extract(p, wrappers.Rules(w, wrappers.decide(w))) for p in pages] != got


def test_partial_wrappers_add_up():
    rng = random.Random(9)
    pages = [neutral(article(rng)[0], k, rng) for k in range(24)]
    whole = wrappers.infer(pages)
    parts = [wrappers.infer(pages[k::4]) for k in range(4)]
    merged = parts[0]
    for p in parts[1:]:
        merged = wrappers.align(merged, p)
    assert merged.pages == whole.pages == 24
    for a, b in zip((whole, merged), (merged, whole)):
        rules = wrappers.Rules(a, wrappers.decide(a))
        other = wrappers.Rules(b, wrappers.decide(b))
        assert [wrappers.extract(p, rules) for p in pages] == [wrappers.extract(p, other) for p in pages]


def test_wrappers_stay_small_and_odd_pages_are_whole(spark):
    many = "".join(f"<div class=k{j}><p>Part {j}.</p></div>" for j in range(700))
    deep = "<div>" * 3000 + "<p>At the bottom</p>"
    pages = [(k, "http://a.org", f"<article>{many}</article>") for k in range(3)] + [(5, "http://b.org", deep), (6, "http://b.org", "<p>" + "long " * 200_000), (7, "http://c.org", ""), (8, None, None), (9, "http://c.org", "&lt;<b>&#x41;&amp;</b>\t &nbsp;x")]
    got = texts(spark, pages)
    assert got[0] == got[1] == got[2] == "\n".join(f"Part {j}." for j in range(700))
    assert got[5] == "At the bottom" and got[6] == ("long " * 200_000).strip() and got[7] == got[8] == "" and got[9] == "< A& x".replace("< A", "<A")
    w = wrappers.infer([p[2] for p in pages[:3]])
    assert max(len(x.kids) for x in wrappers._nodes(w)) <= wrappers.LIMIT
    assert texts(spark, []) == {}
