import re

import numpy as np
import pytest

from shardstream.llm.queries import op3_link_graph_filter
from shardstream.llm.urls import DAMPING, MAX_DISTRUST, judge_pages

RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
PAGES = "page_id bigint, url string, html string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_by_hand(host, path):
    fit = []
    for rule in RULES:
        rule_host, _, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            fit.append(rule)
    return max(fit, key=len, default=None)


def test_rules_on_all_pages(spark, small):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = op3_link_graph_filter(spark, small).collect()
    assert len(rows) == len(urls)
    for row in rows:
        assert (row.host, row.path) == parts(urls[row.page_id])
        assert row.rule == rule_by_hand(row.host, row.path)
        assert row.verdict in ("allow", "block")
        if row.rule:
            assert row.verdict == RULES[row.rule]


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://A.COM", "http://x.com/", "HTTP://WWW.Example.COM/en/?q", "http://b.example.com/en/1#f",
        "http://www.example.com/EN/", "a://b://c.net/es/", "http://net/es/x", "http://notnet/es/", "http://x.net?/es/",
        "http://É.net/fr/\nnew", "http://user@x.com:80/y", "://", "http://x.com/", "http://x.com/",
    ]
    pages = spark.createDataFrame([(k, u, None) for k, u in enumerate(urls)] + [(None, None, None)], PAGES)
    pages = pages.selectExpr("*", "'x' as host", "'y' as verdict", "1 as salt")
    for row in judge_pages(pages).collect():
        url = None if row.page_id is None else urls[row.page_id]
        assert (row.host, row.path) == parts(url), url
        assert row.rule == rule_by_hand(*parts(url))
        if not row.host:
            assert row.verdict == "allow"
    assert judge_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_addresses_of_links_are_seeds(spark):
    """Hosts without pages in the table count by what links say of them."""
    links = {"ring.org": ["x.net/es/a", "x.net/es/b"], "mixed.org": ["y.net/fr/1", "y.net/ok"], "fine.org": ["y.net/other"], "own.net": ["own.net/es/"]}
    pages = [(k, f"http://{h}/", "".join(f'<a href="https://{t}">' for t in to)) for k, (h, to) in enumerate(links.items())]
    rows = {r.host: r for r in judge_pages(spark.createDataFrame(pages, PAGES)).collect()}
    assert rows["ring.org"].distrust == pytest.approx(DAMPING, abs=0.01)  # all links to x.net are blocked
    assert rows["mixed.org"].distrust == pytest.approx(DAMPING / 3 / 2, abs=0.01)  # one of three to y.net, half of its links
    assert rows["own.net"].distrust == 0  # a host's links to itself say nothing
    assert [rows[h].verdict for h in links] == ["block", "allow", "allow", "allow"]


def test_rounds_end_by_themselves_on_a_ring(spark):
    n = 30
    pages = [(k, f"http://h{k}.{'com' if k == 0 else 'org'}/", f'<a href="//h{(k + 1) % n}.{"com" if (k + 1) % n == 0 else "org"}/">') for k in range(n)]
    rows = {r.host: r.trust for r in judge_pages(spark.createDataFrame(pages, PAGES)).collect()}
    for k in (0, 1, n - 1):
        assert rows[f"h{k}.{'com' if k == 0 else 'org'}"] == pytest.approx(DAMPING**k / (1 - DAMPING**n), abs=0.01)


def ranked(seeds, weights):
    """Scores of the dense recurrence score = seed + damping * passed."""
    scores = seeds.copy()
    for _ in range(200):
        scores = seeds + DAMPING * weights @ scores
    return scores


def test_trust_and_distrust_follow_links(spark):
    links = {
        "good.com": ["shop.org", "news.org"], "fine.com": ["news.org"], "bad.net": ["farm.org"], "farm.org": ["bad.net"],
        "ring.org": ["bad.net", "farm.org"], "shop.org": ["bad.net"], "news.org": [], "far.org": ["ring.org"],
        "spam.net": [], "puppet.org": ["spam.net"],
    }
    paths = {"bad.net": "/fr/", "spam.net": "/es/"}
    pages = [
        (k, f"http://{h}{paths.get(h, '/')}", "".join(f'<a HREF="//{t}/x">' for t in to) + '<a href="/own">')
        for k, (h, to) in enumerate(links.items())
    ]
    rows = {r.host: r for r in judge_pages(spark.createDataFrame(pages, PAGES)).collect()}
    names = sorted(links)
    n = np.array([[links[a].count(b) for b in names] for a in names], float)
    out, into = n.sum(1, keepdims=True), n.sum(0, keepdims=True)
    forward = np.divide(n, out, out=np.zeros_like(n), where=out > 0).T
    backward = np.divide(n, into, out=np.zeros_like(n), where=into > 0)
    trust = ranked(np.array([float(h.endswith("com")) for h in names]), forward)
    distrust = ranked(np.array([float(h in paths) for h in names]), backward)
    for k, h in enumerate(names):
        assert rows[h].trust == pytest.approx(trust[k], abs=0.01), h
        assert rows[h].distrust == pytest.approx(distrust[k], abs=0.01), h
        if rows[h].rule is None:
            bad = rows[h].distrust > MAX_DISTRUST and rows[h].distrust > rows[h].trust
            assert rows[h].verdict == ("block" if bad else "allow")
    assert rows["puppet.org"].verdict == "block" and rows["news.org"].verdict == "allow"
