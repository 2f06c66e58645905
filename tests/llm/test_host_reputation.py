"""Host reputation: rules, levels and verdicts against a plain version."""

import math
import random

import pytest
from pyspark.sql import functions as F

from dossierlake.llm import host_reputation as hr
from dossierlake.llm.queries import RULES
from dossierlake.session import work_dir

PAGES = "page_id bigint, url string, html string, host string, PATH string, bad boolean, mean string, pages string"
URLS = [
    (1, "http://Shop.Example.ORG/ES/1?x=/es/"),
    (2, "https://example.org/es/1#a"),
    (3, "https://notexample.org/es/1"),
    (4, "https://www.example.org/en/12"),
    (5, "https://www.example.org/en/2"),
    (6, "http://a.com/fr/"),
    (7, "http://a.com/de/x"),
    (8, "http://com/de/x"),
    (9, "http://org"),
    (10, "http://org?q#f"),
    (11, None),
    (12, "no scheme/at all"),
    (13, ""),
    (14, "://"),
    (15, "a://b://c/d"),
    (None, "http://example.net/"),
    (16, "http://me@b.example.net:80/x\ny?z"),
    (16, "http://me@b.example.net:80/x\ny?z"),
    (17, "http://ÄÖ.De/İ"),
    (18, "http://10.0.0.1:8080/de/"),
    (19, "http://[::1]/x"),
    (20, "http://long.example.net/" + "y" * 100_000),
    (21, "http://shop.co.uk./x"),
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:end], rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return host, path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def plain_precision(groups):
    excess = sum((k - n * m) ** 2 - n * m * (1 - m) for n, k, m in groups)
    room = sum(n * (n - 1) * m * (1 - m) for n, k, m in groups)
    rho = min(max(excess / room, hr.RHO[0]), hr.RHO[1]) if room else hr.RHO[2]
    return 1 / rho - 1


def plain_blocked(seen, outcomes, levels):
    """seen: set of (page, host); levels: host -> (domain, suffix)."""
    counts = {h: [0, 0] for _, h in seen}
    for page, host in seen:
        if page in outcomes:
            counts[host][0] += 1
            counts[host][1] += outcomes[page]
    n, k = (sum(c[i] for c in counts.values()) for i in (0, 1))

    def grouped(at):
        out = {}
        for h, c in counts.items():
            g = out.setdefault(levels[h][at], [0, 0])
            g[0] += c[0]
            g[1] += c[1]
        return out

    def means(groups, prior):
        p = plain_precision([(*c, prior(g)) for g, c in groups.items()])
        return {g: (c[1] + p * prior(g)) / (c[0] + p) for g, c in groups.items()}, p

    suffix, _ = means(grouped(1), lambda g: (k + 1) / (n + 2))
    above = {d: s for d, s in levels.values()}
    domain, _ = means(grouped(0), lambda g: suffix[above[g]])
    _, p = means(counts, lambda h: domain[levels[h][0]])
    out = {}
    for h, (n, k) in counts.items():
        a, b = k + p * domain[levels[h][0]], n - k + p * (1 - domain[levels[h][0]])
        out[h] = a / (a + b) - hr.Z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) > hr.LIMIT
    return out


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "?", "?", True, "?", "?") for i, u in rows], PAGES).repartition(3)


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, bad boolean")


def test_parts_and_rules(spark):
    judged = hr.judge(pages(spark, URLS), outcomes(spark, []), RULES)
    assert judged.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = []
    for i, url in URLS:
        host, path = plain_parts(url)
        rule = plain_rule(host, path, RULES)
        want.append((i, host, path, rule and rule.name, rule.verdict if rule else "allow"))
    assert sorted(map(tuple, judged.collect()), key=repr) == sorted(want, key=repr)
    named = {r.page_id: r.rule for r in judged.collect()}
    assert named[2] == "example.org/es/" and named[3] == "org/" and named[4] == "example.org/en/1"
    assert named[1] == "org/" and named[9] is None and named[8] == "com/de/"


@pytest.mark.parametrize("host, domain, suffix", [
    ("a.b.example.com", "example.com", "com"), ("x.shop.co.uk", "shop.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"),
    ("com", "com", "com"), ("", "", ""), ("me@w.a.org:80", "a.org", "org"), ("a.org.", "a.org", "org"),
    ("10.0.0.1:80", "10.0.0.1", "10.0.0.1"), ("[::1]", "[::1]", "[::1]"),
])
def test_levels(spark, host, domain, suffix):
    found = spark.createDataFrame([(host,)], "host string").select(*hr.domain_and_suffix(F.col("host"))).first()
    assert tuple(found) == (domain, suffix)


def test_verdicts_like_the_plain_version(spark):
    r = random.Random(5)
    hosts = [f"h{i}.d{i % 7}.{('com', 'net', 'co.uk')[i % 3]}" for i in range(40)]
    rate = {h: (0.95 if i % 7 == 3 else 0.1) for i, h in enumerate(hosts)}
    # One host holds a third of all pages; ids come back on other hosts, and some rows twice.
    rows = [(i, f"http://{hosts[0] if i % 3 == 0 else r.choice(hosts[:38])}/p{i % 9}") for i in range(3000)]
    rows += rows[:50] + [(i, f"http://{hosts[39]}/x") for i in range(9000, 9040)]
    labels = [(i, r.random() < rate[u.split("/")[2]]) for i, u in rows[:3000] if r.random() < 0.4]
    labels += [(labels[0][0], True), (None, True), (5, None), (10**12, True)]
    known = {}
    for i, bad in labels:
        if i is not None and bad is not None:
            known[i] = max(known.get(i, 0), int(bad))
    seen = {(i, u.split("/")[2]) for i, u in rows}
    levels = {}
    for h in hosts:
        parts = h.split(".")
        two = ".".join(parts[-2:]) in hr.SUFFIXES
        levels[h] = (".".join(parts[-3:] if two else parts[-2:]), ".".join(parts[-2:] if two else parts[-1:]))
    want = plain_blocked(seen, known, levels)
    judged = hr.judge(pages(spark, rows), outcomes(spark, labels)).collect()
    assert len(judged) == len(rows)
    assert {row.host: row.verdict == "block" for row in judged} == {h: want[h] for _, h in seen}
    assert any(want.values()) and not all(want.values())
    assert {r.verdict for r in judged if r.host == hosts[0]} == {"allow"}


def test_a_host_without_labels_has_what_its_domain_says(spark):
    rows = [(i, f"http://h{i % 5}.bad.com/") for i in range(200)] + [(i, f"http://h{i % 5}.good.com/") for i in range(200, 800)]
    labels = [(i, i < 200) for i in range(800)]
    rows += [(9001, "http://new.bad.com/"), (9002, "http://new.good.com/")]
    verdicts = {r.host: r.verdict for r in hr.judge(pages(spark, rows), outcomes(spark, labels)).collect()}
    assert verdicts["new.bad.com"] == "block" and verdicts["new.good.com"] == "allow"


def test_empty_and_unlabelled(spark):
    assert hr.judge(pages(spark, []), outcomes(spark, [(1, True)]), RULES).collect() == []
    lone = hr.judge(pages(spark, [(None, None), (1, "http://a.net/")]), outcomes(spark, [(None, True), (1, None)])).collect()
    assert {tuple(r) for r in lone} == {(None, "", "", None, "allow"), (1, "a.net", "/", None, "allow")}


def test_page_outcomes(spark):
    rows = [(1, 1, 0), (2, 0, None), (3, None, 1), (4, None, None), (None, 0, 0)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    assert {tuple(r) for r in hr.page_outcomes(labels).collect()} == {(1, False), (2, True), (3, True), (None, True)}


def test_nothing_runs_in_python(spark):
    path = work_dir(spark, "pages")
    pages(spark, URLS).write.parquet(path)
    plan = hr.judge(spark.read.parquet(path), outcomes(spark, [(1, True)]), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
