"""URL rules and aliases against a plain reading of their definition."""

from __future__ import annotations

import random

import pytest

from tidelake.llm import url_filter as uf
from tidelake.llm.base import ship
from tidelake.llm.queries import URL_RULES, oracles

RULES = "host string, path string, verdict string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    stop = min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def rule_of(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    return max(fits)[2:] if fits else (None, None)


def node(url):
    scheme, rest = url.split("://", 1)
    rest = rest.split("#")[0]
    host = parts(url)[0]
    return f"{scheme.lower()}://{host}{rest[len(host):]}"


def brute(pages, rules, edges):
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        group[root(node(a))] = root(node(b))
    fate = {}
    for url in {u for e in edges for u in e} | {u for _, u in pages if u and "://" in u}:
        if node(url) in group:
            fate.setdefault(root(node(url)), set()).add(rule_of(url, rules)[1])
    out = []
    for key, url in pages:
        rule, verdict = rule_of(url, rules)
        if verdict is None:
            around = fate.get(root(node(url)), set()) if url and "://" in url and node(url) in group else set()
            verdict = "block" if "block" in around and "allow" not in around else "allow"
        out.append((key, *parts(url), rule, verdict))
    return sorted(out, key=repr)


def run(spark, pages, rules, html=None, redirects=None):
    ship(spark)
    frame = spark.createDataFrame([(k, u, (html or {}).get(u)) for k, u in pages], "page_id long, url string, html string")
    given = None if redirects is None else spark.createDataFrame(redirects, "source string, target string")
    got = uf.judge(frame, spark.createDataFrame(rules, RULES), redirects=given)
    return sorted((tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def test_rules_alone(spark):
    urls = [
        "https://blog.example.com/en/1?x", "https://www.example.com/en/2", "https://a.www.example.com/en/2#t", "HTTP://EXAMPLE.COM/en/", "http://example.com/EN/", "http://example.com/de/en/",
        "http://a.example.net/es/1", "http://net/fr/", "http://xnet/fr/", "http://.net/es/", "http://example.com", "http://example.com?/en/", None, "", "no scheme/en/", "mailto:x",
        "ftp://u@example.com:80/en/", "http:///en/x", "a://b://example.com/en/", "http://example.org/en/", "http://ÉXAMPLE.com/en/", "http://line\nbreak.com/e\nn",
    ]
    pages = list(enumerate(urls)) + [(0, urls[0]), (None, urls[1])]
    assert run(spark, pages, URL_RULES) == brute(pages, URL_RULES, [])


def test_random_graph_and_rules(spark):
    draw = random.Random(3)
    hosts = ["a.com", "b.a.com", "c.net", "d.org", "x.d.org", "e.io"]
    urls = [f"{draw.choice(['http', 'https', 'HTTPS'])}://{draw.choice(hosts)}/{draw.choice(['en', 'de'])}/{i % 40}{draw.choice(['', '#t', '?q=1'])}" for i in range(300)]
    rules = [("a.com", "/en/", "block"), ("b.a.com", "/en/1", "allow"), ("org", "/de/", "block"), ("d.org", "/de/2", "allow"), ("a.com", "/en/", "allow")]
    edges = [(draw.choice(urls), draw.choice([*urls, "http://unseen.org/de/9", "http://other.e.io/"])) for _ in range(130)]
    pages = list(enumerate(urls))
    clean = [r for r in rules if r != ("a.com", "/en/", "block")]  # a rule given both ways allows
    assert run(spark, pages, rules, redirects=edges) == brute(pages, clean, edges)


def test_canonical_links_and_refreshes_of_pages(spark):
    blocked, allowed = "https://bad.example.com/en/1", "https://www.example.com/en/1"
    html = {
        "http://a.org/1": f'<head><LINK data-x="a>b" href="{blocked}" rel="alternate CANONICAL">',
        "http://a.org/2": '<meta content="0; URL=\'/1#part\'" http-equiv=Refresh>',
        "http://a.org/3": f'<!-- <link rel="canonical" href="{blocked}"> --><script>"<link rel=canonical href={blocked}>"</script>',
        "http://a.org/4": f'<link rel=canonical href={blocked}><link rel=canonical href={allowed}>',
        "http://a.org/5": '<base href="http://a.org/x/"><link rel=canonical href="../1?a=1&amp;b=2">',
        "http://a.org/1?a=1&b=2": f'<link rel=canonical href="{blocked}">',
        "http://a.org/6": '<link rel=canonical href="http://[broken"><link rel=canonical><meta http-equiv=refresh content=5><link rel=canonical href="http://a.org/6#self">',
        "http://a.org/7": "<![if canonical <!x",
    }
    pages = [(i, u) for i, u in enumerate([*html, blocked, allowed])]
    # 4 names an allowed url beside the blocked one, which ties all that name the blocked one to it.
    edges = [("http://a.org/1", blocked), ("http://a.org/2", "http://a.org/1"), ("http://a.org/4", blocked), ("http://a.org/4", allowed), ("http://a.org/5", "http://a.org/1?a=1&b=2"), ("http://a.org/1?a=1&b=2", blocked)]
    assert run(spark, pages, URL_RULES, html) == brute(pages, URL_RULES, edges)
    html["http://a.org/4"] = ""
    edges = [e for e in edges if e[0] != "http://a.org/4"]
    got = run(spark, pages, URL_RULES, html)
    assert got == brute(pages, URL_RULES, edges)
    assert [r[4] for r in got[:8]] == ["block", "block", "allow", "allow", "block", "block", "allow", "allow"]


def test_a_chain_and_a_hub(spark):
    chain = [f"http://c.io/{i}" for i in range(60)]
    hub = [f"http://h.io/{i}" for i in range(200)]
    edges = list(zip(chain, chain[1:])) + [(u, hub[0]) for u in hub] + [(hub[7], "http://s.net/es/1")]
    pages = list(enumerate(chain + hub))
    got = run(spark, pages, URL_RULES, redirects=edges)
    assert got == brute(pages, URL_RULES, edges)
    assert sum(r[4] == "block" for r in got) == 200


def test_empty_tables_and_clashing_names(spark):
    ship(spark)
    assert run(spark, [], URL_RULES) == []
    assert run(spark, [(1, "http://a.com/")], []) == [(1, "a.com", "/", None, "allow")]
    frame = spark.createDataFrame([("k", "http://a.net/es/", "", 1, 2, 3, 4, 5, 6)], "page_id string, url string, html string, Host int, _host int, _NODE int, ending int, component int, _aliases int")
    redirects = spark.createDataFrame([("http://a.net/es/", "http://b.io/")], "source string, target string")
    got = uf.judge(frame, spark.createDataFrame(URL_RULES, RULES), redirects=redirects)
    assert got.columns == ["page_id", "url", "_host", "_NODE", "ending", "component", "_aliases", "host", "path", "rule", "verdict"]
    assert tuple(got.first()) == ("k", "http://a.net/es/", 2, 3, 4, 5, 6, "a.net", "/es/", "net/es/", "block")


def test_sql_states_the_same(spark):
    duckdb = pytest.importorskip("duckdb")
    blocked = "https://bad.example.com/en/1"
    html = {"http://a.org/1": f'<link rel="canonical" href="{blocked}">', "http://a.org/2": '<meta http-equiv="refresh" content="0; url=http://a.org/1">'}
    pages = [(1, "http://a.org/1"), (2, "http://a.org/2#x"), (2, "http://a.org/2"), (3, None), (4, blocked), (5, "http://q.net/fr/?x")]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [(k, u, html.get(u)) for k, u in pages])
    wanted = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({oracles()['op12_url_filter']})").fetchall()
    assert run(spark, pages, URL_RULES, html) == sorted(wanted, key=repr)
