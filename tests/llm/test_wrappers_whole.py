"""What stands on few pages of a host is extracted as well."""

from __future__ import annotations

import pytest

from fabula.llm import wrappers

SCHEMA = "page_id long, url string, html string"


def texts(spark, pages):
    return {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(pages, SCHEMA)).collect()}


def plain(k, more="", mark="class='wrap'"):
    return f"<html><body><div>Site name</div><div class='menu'><a>Home</a></div><div {mark}><h1>Title {k}</h1><p>Text of page {k}, some words long.</p>{more}</div></body></html>"


@pytest.mark.parametrize("more, line", [("<blockquote>Rare quote</blockquote>", "Rare quote"), ("<table><tr><td>Rare cell</td></tr></table>", "Rare cell"), ("<ul><li>Rare item</li></ul>", "Rare item")])
def test_blocks_of_one_page_in_many(spark, more, line):
    for odd in (3, 41):
        got = texts(spark, [(k, f"http://a.org/{k}", plain(k, more if k == odd else "")) for k in range(60)])
        for k in range(60):
            assert got[k] == f"Title {k}\nText of page {k}, some words long." + (f"\n{line}" if k == odd else "")


@pytest.mark.parametrize("mark", ["id='post-{}'", "id='{}-slug'", "id=s{}"])
def test_ids_by_page(spark, mark):
    got = texts(spark, [(k, f"http://a.org/{k}", plain(k, mark=mark.format(k))) for k in range(95, 140)])
    assert all(got[k].endswith(f"Title {k}\nText of page {k}, some words long.") and "Home" not in got[k] for k in got)


def test_a_template_with_article_and_one_without(spark):
    pages = [(k, f"http://a.org/{k}", plain(k) if k % 2 else f"<body><article><p>Article {k}</p></article><div>Other</div></body>") for k in range(60)]
    got = texts(spark, pages)
    assert all(got[k] == (f"Title {k}\nText of page {k}, some words long." if k % 2 else f"Article {k}") for k in range(60))


def test_late_in_a_long_page(spark):
    pages = [(k, f"http://a.org/{k}", plain(k, "".join(f"<p class='c{j}'>Part {j} of {k}</p>" for j in range(1500)) + "<pre>last {k}</pre>".replace("{k}", str(k)))) for k in range(4)]
    assert all(t.endswith(f"Part 1499 of {k}\nlast {k}") for k, t in texts(spark, pages).items())
