import math
import re
from collections import defaultdict

import numpy as np
import pytest

from siltstone.llm import reputation
from siltstone.llm.common import table
from siltstone.llm.reputation import RULES, candidates, domains, judge, op13_urls, reputations, rule_table, tails


def parts(url):
    """Host and path by plain string work."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    best = None
    for rule, verdict in RULES:
        at, slash, below = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + below) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


def integral(a, b, x):
    """Probability beyond ``x`` of a beta variable, by the midpoint rule on the logit scale."""
    z = np.linspace(math.log(x / (1 - x)), 400, 400_001)
    mid = (z[1:] + z[:-1]) / 2
    log = -a * np.logaddexp(0, -mid) - b * np.logaddexp(0, mid) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
    return (np.exp(log) * (z[1] - z[0])).sum()


def plain_reputations(counts):
    """The hierarchy walked host by host: {host: (rate, beyond)}."""
    name = lambda h, k: ".".join(h.split(".")[-k:])
    dom, suf = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for h, (n, k) in counts.items():
        for t, key in ((dom, name(h, 2)), (suf, name(h, 1))):
            t[key][0] += n
            t[key][1] += k
    total = [sum(v[i] for v in suf.values()) for i in (0, 1)]

    def rho(children):
        up = down = 0.0
        for n, k, pn, pk in children:
            if n > 1:
                m = (pk + 0.5) / (pn + 1)
                up += (k - n * m) ** 2 - n * m * (1 - m)
                down += n * (n - 1) * m * (1 - m)
        return min(0.5, max(0.001, up / down)) if down else 0.1

    rhos = [
        rho([(*v, *total) for v in suf.values()]),
        rho([(*v, *suf[name(d, 1)]) for d, v in dom.items()]),
        rho([(*v, *dom[name(h, 2)]) for h, v in counts.items()]),
    ]
    out = {}
    for h, own in counts.items():
        levels = [total, suf[name(h, 1)], dom[name(h, 2)], own]
        m, t = 0.5, 1.0
        for (n, k), (below_n, below_k), r in zip(levels, levels[1:], rhos):
            m, t = (t * m + k - below_k) / (t + n - below_n), t + n - below_n
            t = 1 / (1 / (t + 1) + t / (t + 1) * r) - 1  # variances of both steps, r = 1 / (s + 1)
        a, b = m * t + own[1], (1 - m) * t + own[0] - own[1]
        out[h] = (a / (a + b), integral(a, b, 0.5))
    return out


def test_tails_equal_the_integral():
    a = np.array([0.5, 0.66, 3.0, 40.0, 900.0, 1.0, 0.05])
    b = np.array([0.5, 0.34, 9.0, 41.0, 100.0, 1.0, 2.0])
    for x in (0.2, 0.5, 0.9):
        assert tails(a, b, x) == pytest.approx([integral(p, q, x) for p, q in zip(a, b)], abs=2e-6)


def test_query_equals_the_plain_version(spark, sf):
    rows = {r.page_id: r for r in op13_urls(spark, sf).collect()}
    pages = table(spark, sf, "pages").collect()
    assert len(rows) == len(pages) == table(spark, sf, "pages").count()
    counts = defaultdict(lambda: [0, 0])
    for p in pages:
        host, path = parts(p.url)
        found = ruled(host, path)
        counts[host][0] += found is not None
        counts[host][1] += found is not None and found[1] == "block"
    known = plain_reputations(counts)
    for p in pages:
        host, path = parts(p.url)
        got, found = rows[p.page_id], ruled(host, path)
        assert (got.host, got.path) == (host, path)
        assert got.rule == (found[0] if found else None)
        rate, beyond = known[host]
        assert got.rate == pytest.approx(rate, abs=1e-6) and got.beyond == pytest.approx(beyond, abs=1e-5)
        assert got.verdict == (found[1] if found else "block" if beyond >= 0.95 else "allow")


def test_odd_urls_and_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "://EXAMPLE.com/en/", "HTTP://WWW.Example.COM/en/x?/y", "http://a.net", "http://a.net?/es/", "http://a.net/es/#/fr/",
        "http://notexample.com/en/", "http://xnet/es/", "http://net/es/", "ftp://u:p@a.net:81/es/", "http://a.com://b.net/es/", "http://É.com/En/", "http://a..com/",
        "http://" + "a." * 5000 + "net/es/" + "x" * 100_000, "http://a.net/es/", "http://a.net/es/",
    ]
    df = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, _id string")
    rows = {r.page_id: r for r in judge(df, rule_table(spark)).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        host, path = parts(u)
        found = ruled(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, found[0] if found else None), u
        assert rows[i].verdict in ("allow", "block")
    assert judge(df.limit(0), rule_table(spark)).collect() == []


def test_ties_between_rules(spark):
    rules = rule_table(spark, [("b.com/", "allow"), ("com/xy", "block"), ("com/xy", "allow"), ("a.org/", "allow"), ("a.org/", "block"), ("a.org/", "block")])
    hosts = spark.createDataFrame([("b.com",), ("a.org",), ("x.y",)], "host string")
    got = {r.host: [(x.rule, x.verdict) for x in r._rules] for r in candidates(hosts, rules).collect()}
    assert got == {
        "b.com": [("b.com/", "allow"), ("com/xy", "block"), ("com/xy", "allow")],
        "a.org": [("a.org/", "block"), ("a.org/", "allow")],
    }


def test_domains(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.shop.co.uk", "10.0.0.1:80", "me@x.org:8080", "", "[::1]"]
    got = {r.host: (r._domain, r._suffix) for r in domains(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()}
    assert got == {
        "a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"), "x.shop.co.uk": ("shop.co.uk", "co.uk"),
        "10.0.0.1:80": ("10.0.0.1", ""), "me@x.org:8080": ("x.org", "org"), "": ("", ""), "[::1]": ("[::1]", ""),
    }


def test_reputation_comes_down_from_the_domain(spark):
    """A new host of a domain whose hosts are all bad is blocked, one of a mixed or unknown domain is not."""
    counts = {f"h{i}.bad.net": (20, 20) for i in range(8)} | {f"h{i}.good.org": (20, 0) for i in range(8)}
    counts |= {f"h{i}.mixed.com": (20, 8 + i % 5) for i in range(8)}
    counts |= {"new.bad.net": (0, 0), "new.good.org": (0, 0), "new.mixed.com": (0, 0), "new.never.seen": (0, 0)}
    df = spark.createDataFrame([(h, *v) for h, v in counts.items()], "host string, n long, k long")
    got = {r.host: r for r in reputations(df).collect()}
    blocked = {h for h, r in got.items() if r.beyond >= 0.95}
    assert blocked == {h for h in counts if h.endswith("bad.net")}
    plain = plain_reputations(counts)
    for h, r in got.items():
        assert (r.rate, r.beyond) == (pytest.approx(plain[h][0], abs=1e-6), pytest.approx(plain[h][1], abs=1e-5))


def test_given_outcomes(spark):
    pages = spark.createDataFrame([(1, "http://a.x.org/1"), (2, "http://b.y.org/1")], "page_id long, url string")
    labels = [(f"http://a.x.org/{i}", True) for i in range(30)] + [(f"http://b.y.org/{i}", False) for i in range(30)] + [(None, None), ("http://b.y.org/", None)]
    outcomes = spark.createDataFrame(labels, "url string, bad boolean")
    empty = rule_table(spark, [])
    assert {r.page_id: r.verdict for r in judge(pages, empty, outcomes).collect()} == {1: "block", 2: "allow"}
    assert {r.verdict for r in judge(pages, empty).collect()} == {"allow"}
    assert reputation.SURE > 0.5
