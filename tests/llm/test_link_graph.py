import collections
import random
import re

import pytest

from termloom.llm import link_graph
from termloom.llm.link_graph import Rule

SCHEMA = "page_id long, url string, html string"
FIXED = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host) :])[0]


def rule_of(host, path):
    fits = []
    for site, verdict in FIXED:
        own, start = site.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append((len(site), site, verdict))
    return max(fits)[1:] if fits else (None, None)


ROUNDS = 11


def pagerank(seeds, edges, damping=0.85):
    total = sum(seeds.values())
    if not total:
        return {}
    seed = {h: w / total for h, w in seeds.items()}
    out = collections.Counter()
    for (a, _), n in edges.items():
        out[a] += n
    score = dict(seed)
    for _ in range(ROUNDS):
        new = collections.Counter()
        for (a, b), n in edges.items():
            new[b] += damping * score.get(a, 0) * n / out[a]
        back = 1 - sum(new.values())
        for h, s in seed.items():
            new[h] += back * s
        score = new
    return score


def plain(pages):
    pages_of, seeds, edges = collections.Counter(), {"allow": collections.Counter(), "block": collections.Counter()}, collections.Counter()
    for _, url, html in pages:
        host, path = split(url)
        if host:
            pages_of[host] += 1
            verdict = rule_of(host, path)[1]
            if verdict:
                seeds[verdict][host] += 1
        for link in re.findall(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'>]*)""", html or ""):
            other = split(link if "://" in link else "http:" + link)[0]
            if host and other and other != host:
                edges[host, other] += 1
    trust = pagerank(seeds["allow"], edges)
    distrust = pagerank(seeds["block"], {(b, a): n for (a, b), n in edges.items()})
    out = []
    for page, url, _ in pages:
        host, path = split(url)
        site, verdict = rule_of(host, path)
        n = pages_of[host] or 1
        good = trust.get(host, 0) * sum(seeds["allow"].values()) / n
        bad = distrust.get(host, 0) * sum(seeds["block"].values()) / n
        out.append((page, host, path, site, verdict or ("block" if bad >= 0.5 and bad > good else "allow")))
    return sorted(out, key=repr)


def run(spark, pages):
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], SCHEMA + ", host string, pages long")
    out = link_graph.judge(frame, rounds=ROUNDS).select("page_id", "host", "path", "rule", "verdict").collect()
    return sorted(map(tuple, out), key=repr)


def test_equals_plain_version(spark):
    rng = random.Random(1)
    hosts = ["a.net", "x.example.net", "b.example.com", "c.org", "www.c.org", "farm.io", "good.io", "D.io", "hub.io"]
    paths = ["", "/", "/en/1", "/de/2?q=http://z.io/", "/fr/3#top", "?x", "/EN/"]
    pages = []
    for i in range(250):
        host = rng.choice(hosts) if i % 3 else "hub.io"
        links = "".join(f'<a href="https://{rng.choice(hosts)}/p">' for _ in range(rng.randrange(4)) if host != "D.io")
        if host == "farm.io":
            links = "<A HREF = '//a.net/1'><a href=http://A.net>"
        pages.append((i, f"http://{host}{rng.choice(paths)}", links))
    pages += [(900, None, None), (901, "no host", ""), (902, "://", "<a href='//a.net'>"), (None, "http://farm.io/", None)]
    pages += [pages[5]] * 3
    wanted = plain(pages)
    assert run(spark, pages) == wanted


def test_who_links_to_blocked_hosts_is_blocked(spark):
    pages = [(i, f"http://a.net/{i}", None) for i in range(10)]
    pages += [(20 + i, f"http://farm.io/{i}", "<a href='http://a.net/'>") for i in range(2)]
    pages += [(30 + i, f"http://good.io/{i}", "<a href='http://farm.io/'>" if i > 8 else "") for i in range(10)]
    pages += [(50, "http://c.org/fr/", "<a href='//kept.io'>"), (51, "http://kept.io/", "<a href='//a.net'>")]
    verdicts = {h: v for _, h, _, _, v in run(spark, pages)}
    assert run(spark, pages) == plain(pages)
    assert verdicts == {"a.net": "block", "farm.io": "block", "good.io": "allow", "c.org": "allow", "kept.io": "block"}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_whole_table_equals_plain_version(spark):
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    assert run(spark, pages) == plain(pages)


@pytest.mark.parametrize(("url", "site"), [("http://net/", "net/"), ("http://net", None), ("http://anet/", None), ("http://X.Example.NET/en/1", "example.net/en/"), ("http://example.net/EN/", "net/"), ("ftp://q.org/fr/", "org/fr/"), ("http://a.net:80/", None)])
def test_longest_rule(spark, url, site):
    assert run(spark, [(1, url, None)])[0][3] == site


def test_no_rules(spark):
    frame = spark.createDataFrame([(1, "http://a.net/", None)], SCHEMA)
    assert link_graph.judge(frame, rules=()).first().verdict == "allow"
    assert link_graph.judge(frame, rules=(Rule("a.net/", "block"),)).first().verdict == "block"


def test_every_host_of_a_long_chain_gets_a_score(spark):
    links = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(70)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("trust", "h0", 1.0)], "kind string, host string, weight double")
    scores = {r["host"]: r["score"] for r in link_graph.propagate(seeds, links).collect()}
    assert len(scores) == 71 and all(s > 0 for s in scores.values())
    assert scores["h70"] < scores["h69"] < scores["h1"]
