"""URL verdicts against hand-made cases and a plain walk over the alias graph."""

from __future__ import annotations

import random

import pytest

from zonecast.llm.url_filter import Rule, filter_urls

RULES = [
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def judge(spark, pages, redirects=None, rules=RULES):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    edges = None if redirects is None else spark.createDataFrame(redirects, "source string, target string")
    return filter_urls(df, rules, edges)


def test_rules_hosts_and_paths(spark):
    urls = [
        "https://A.Example.NET/en/1?x=/de/", "http://example.net/de/", "http://badexample.net/en/", "http://example.com/de",
        "http://x.example.com/de/a#b", "http://b.org/fr/", "http://b.org", "no scheme", None, "", "ftp://net/", "a://b://c/d",
        "http://net?x", "http://É.NET/", "http://x.net/" + "a" * 300_000,
    ]
    got = {r["page_id"]: r for r in judge(spark, [(i, u, None) for i, u in enumerate(urls)]).collect()}
    found = [(got[i]["host"], got[i]["path"][:9], got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))]
    assert found == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/de/", "net/", "block"),
        ("badexample.net", "/en/", "net/", "block"), ("example.com", "/de", None, "allow"),
        ("x.example.com", "/de/a", "example.com/de/", "block"), ("b.org", "/fr/", "org/fr/", "allow"), ("b.org", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("net", "/", "net/", "block"),
        ("b:", "//c/d", None, "allow"), ("net", "", None, "allow"), ("É.net", "/", "net/", "block"), ("x.net", "/aaaaaaaa", "net/", "block"),
    ]


def test_decisions_reach_aliases(spark):
    link = lambda to: f'<html><head><LINK rel="canonical" href="{to}"></head>'
    pages = [
        (1, "http://a.org/x", link("https://b.org/y")), (2, "https://b.org/y", link("//c.net/z")), (3, "https://c.net/z", None),
        (4, "https://www.a.org/x/?utm_source=feed#top", None), (5, "https://a.org/x?id=2", None),
        (6, "http://d.org/q", "<meta http-equiv=refresh content='0; URL=/fr/home'>"), (7, "https://d.org/fr/home", link("http://e.net/")),
        (8, "http://e.net/", None), (9, "http://f.org/", None), (9, "http://f.org/", None), (10, "http://g.org/", link("http://f.org")),
        (11, "http://h.org/a/b", link("c?x=1&amp;y=2")), (12, "http://h.org/a/c?x=1&y=2", None), (13, "http://far.org/", "<link <link <link"),
    ]
    redirects = [("http://f.org", "http://bad.net/1"), ("http://h.org/a/c?x=1&y=2", "http://i.com/"), ("http://i.com", "http://x.example.com/de/1"), (None, "http://f.org")]
    # http://bad.net/1 is no page and blocks its aliases all the same.
    pages += [(21, "http://x.example.com/de/1", None)]
    got = {r["page_id"]: r["verdict"] for r in judge(spark, pages, redirects).collect()}
    assert got == {
        1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "block", 10: "block",
        11: "block", 12: "block", 13: "allow", 21: "block",
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_a_walk(spark, seed):
    draw = random.Random(seed)
    names = [f"http://s{i}.{draw.choice(['com', 'org', 'net', 'example.com'])}/{draw.choice(['de', 'fr', 'en', 'x'])}/p" for i in range(80)]
    pages = [(i, u, None) for i, u in enumerate(names)]
    redirects = [(draw.choice(names), draw.choice(names)) for _ in range(60)]
    rows = judge(spark, pages, redirects).collect()
    assert len(rows) == 80
    by_url = {r["url"]: r for r in rows}
    near = {u: {u} for u in names}
    for a, b in redirects:
        near[a].add(b)
        near[b].add(a)
    verdict = {r.host + r.path: r.verdict for r in RULES}
    for u, r in by_url.items():
        seen, todo = {u}, [u]
        while todo:
            for v in near[todo.pop()] - seen:
                seen.add(v)
                todo.append(v)
        own = {verdict[by_url[v]["rule"]] for v in seen if by_url[v]["rule"]}
        wanted = verdict[r["rule"]] if r["rule"] else "allow" if "allow" in own or "block" not in own else "block"
        assert r["verdict"] == wanted, (u, seen)


def test_empty_tables_other_columns_and_hot_addresses(spark):
    df = spark.createDataFrame([(1, "http://a.net/", "x", 1, "r", "n", 5)], "page_id long, url string, html string, host int, rule string, _node string, _blocked int")
    got = filter_urls(df, RULES)
    assert got.columns == ["page_id", "url", "html", "host", "rule", "_node", "_blocked", "path", "verdict"]
    row = got.first()
    assert (row["host"], row["rule"], row["verdict"], row["_node"]) == ("a.net", "net/", "block", "n")
    assert filter_urls(df.where("false"), RULES).count() == 0
    assert [r["verdict"] for r in filter_urls(df, []).collect()] == ["allow"]
    hot = [(i, "http://hot.org/", '<link rel=canonical href="http://t.org/">') for i in range(400)] + [(500, "http://t.org/", None)]
    hot += [(600, "http://u.net/", "<link href='http://hot.org' rel='canonical'>")]
    assert {r["verdict"] for r in judge(spark, hot).collect()} == {"block"}
    with pytest.raises(ValueError):
        filter_urls(df, RULES * 1000)


def test_long_pages(spark):
    pages = [(i, "http://a.org/", text * 60_000) for i, text in enumerate(["<link ", "<meta>", "<link rel=canonical href=", "rel = 'canonical", "<"])]
    assert {r["verdict"] for r in judge(spark, pages).collect()} == {"allow"}
