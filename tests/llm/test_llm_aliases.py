"""URL rules, addresses and the spread of block decisions, against plain Python."""

import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from trackloom.llm import aliases, tables
from trackloom.llm.queries import URL_RULES

RULES = "verdict string, host string, path string"
PAGES = "page_id long, url string, html string"


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path, rules):
    best = None
    for verdict, h, p in rules:
        if h and (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            rank = (len(h + (p or "")), len(h), verdict == "allow")
            best = max(best or (rank, h + (p or ""), verdict), (rank, h + (p or ""), verdict))
    return best[1:] if best else (None, None)


def plain_address(url):
    host, path = split_url(url)
    if url is None or "://" not in url:
        return None
    query = url.split("#", 1)[0].split("?", 1)[1] if "?" in url.split("#", 1)[0] else ""
    asked = [p for p in query.split("&") if p and not p.startswith("utm_")]
    return re.sub(":(80|443)$", "", host) + path.rstrip("/") + ("?" + "&".join(asked) if asked else "")


def plain_verdicts(pages, rules, links, redirects=()):
    """links: page_id -> absolute targets. Union-find over addresses."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for page_id, url, _ in pages:
        for target in links.get(page_id, ()):
            if plain_address(url) and plain_address(target):
                parent[find(plain_address(url))] = find(plain_address(target))
    for a, b in redirects:
        if plain_address(a) and plain_address(b):
            parent[find(plain_address(a))] = find(plain_address(b))
    out, tainted = [], set()
    for page_id, url, _ in pages:
        rule, verdict = plain_rule(*split_url(url), rules)
        if verdict == "block":
            tainted.add(find(plain_address(url)))
        out.append((page_id, url, rule, verdict))
    return sorted(
        (p, *split_url(u), str(r), v or ("block" if u and plain_address(u) and find(plain_address(u)) in tainted else "allow"))
        for p, u, r, v in out
    )


def rows(df):
    return sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in df.collect())


URLS = [
    "http://a.Example.com/en/1", "https://www.example.com/en/1", "https://example.com/en", "https://example.com/en/",
    "https://x.net/es/1?utm_source=feed", "http://x.net/es/1/", "http://x.net:80/es/1", "https://x.net/es?q=1&utm_x=2#top",
    "https://x.net/es", "https://org/es/", "https://xnet/es/1", "ftp://.net/fr/", "no scheme", "", None,
    "a://b://c.com/x", "http://COM", "http://com?x/y", "http://ÄÖ.COM/é#a?b", "https://user@x.net:8080/es/", "https://x.net/es/1",
]


def test_hosts_paths_rules_and_addresses(spark):
    pages = [(i, u, None) for i, u in enumerate(URLS)]
    df = spark.createDataFrame(pages, PAGES)
    got = aliases.judge(df, spark.createDataFrame(URL_RULES, RULES))
    assert rows(got) == plain_verdicts(pages, URL_RULES, {})
    shown = df.select("url", aliases.address(F.col("url")).alias("a")).collect()
    assert {r.url: r.a for r in shown} == {u: plain_address(u) for u in URLS}
    # "/es" fits no rule, yet servers redirect it to "/es/", which one blocks.
    assert {r.page_id: r.verdict for r in got.collect()}[8] == "allow"


def test_blocks_spread_over_links_and_allows_hold(spark):
    html = {
        1: "<head><LINK href='https://bad.net/es/9' rel='alternate Canonical'></head>",
        2: '<meta http-equiv="Refresh" content="0; URL=\'/two?a=1&amp;b=2\'">',
        4: "<!-- <link rel=canonical href=https://bad.net/es/9> --><script>'<link rel=canonical href=//bad.net/es/9>'</script>",
        5: "<link rel=canonical href=//bad.net/es/9>",
        6: "<link rel=stylesheet href=//bad.net/es/9>",
        7: '<link rel="canonical" href="../up/./x?y">',
        8: "<link rel='canonical' href=''><link rel='canonical'>",
    }
    pages = [
        (0, "https://bad.net/es/9", None),
        (1, "https://a.org/one", html[1]),
        (2, "https://a.org/1/start", html[2]),
        (3, "http://a.org/two/?a=1&b=2", '<link rel=canonical href="https://a.org/one#x">'),
        (4, "https://b.org/", html[4]),
        (5, "https://c.com/mine", html[5]),
        (6, "https://d.org/", html[6]),
        (7, "https://e.org/a/b/c", html[7]),
        (8, "https://f.org/", html[8]),
        (9, "https://e.org/a/up/x?y", "<link rel=canonical href=https://bad.net/es/9>"),
        (9, "https://e.org/a/up/x?y", None),
        (None, "https://moved.org/old", None),
        (11, "https://moved.org/new", None),
        (12, None, "<link rel=canonical href=https://bad.net/es/9>"),
    ]
    links = {
        1: ["https://bad.net/es/9"], 2: ["https://a.org/two?a=1&b=2"], 3: ["https://a.org/one"], 5: ["https://bad.net/es/9"],
        7: [urljoin("https://e.org/a/b/c", "../up/./x?y")], 9: ["https://bad.net/es/9"],
    }
    moved = [("http://moved.org/old", "https://a.org/one"), (None, "https://bad.net/es/9"), ("x", None)]
    df = spark.createDataFrame(pages, PAGES).withColumn("verdict", F.lit("clash")).withColumn("node", F.lit(1))
    got = aliases.judge(df, spark.createDataFrame(URL_RULES, RULES), spark.createDataFrame(moved, "from_url string, to_url string"))
    shown = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got.collect())
    want = plain_verdicts([(str(p), u, h) for p, u, h in pages], URL_RULES, {str(k): v for k, v in links.items()}, moved)
    assert shown == want
    verdicts = {p: v for p, *_, v in shown}
    assert [verdicts[str(i)] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, None, 11, 12)] == (
        ["block"] * 3 + ["allow"] * 3 + ["block", "allow", "block", "block", "allow", "allow"]
    )


def test_many_rules_and_long_chains(spark):
    draw = random.Random(1)
    hosts = [".".join(draw.choice("abc") for _ in range(draw.randint(1, 4))) for _ in range(40)]
    paths = ["/" + "".join(draw.choice("xy/") for _ in range(draw.randint(0, 6))) for _ in range(40)]
    rules = [(draw.choice(["allow", "block"]), draw.choice(hosts), draw.choice([*paths, None, ""])) for _ in range(60)]
    urls = [f"http://{draw.choice(hosts)}{draw.choice(paths)}" for _ in range(150)] + [f"http://chain.z/{i}" for i in range(70)]
    links = {i: [draw.choice(urls[:150])] for i in range(150) if draw.random() < 0.1}
    links |= {150 + i: [f"https://chain.z/{i + 1}"] for i in range(69)}
    links[219] = [urls[0]]
    pages = [(i, u, "".join(f'<link rel="canonical" href="{t}">' for t in links.get(i, ()))) for i, u in enumerate(urls)]
    got = aliases.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(rules, RULES))
    assert rows(got) == plain_verdicts(pages, rules, links)


def test_empty_tables_and_very_long_pages(spark):
    none = spark.createDataFrame([], PAGES)
    assert aliases.judge(none, spark.createDataFrame(URL_RULES, RULES)).count() == 0
    long = "x" * 300_000
    html = f"<p>{'<b>' * 100_000}<link rel=canonical href=//x.net/es/1>{long}"
    pages = [(1, "http://q.org/" + long, html), (2, "http://x.net/es/1", None)]
    got = aliases.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame([], RULES)).collect()
    assert {(r.page_id, len(r.path), r.rule, r.verdict) for r in got} == {(1, 300_001, None, "allow"), (2, 5, None, "allow")}
    got = aliases.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(URL_RULES, RULES)).collect()
    assert {(r.page_id, r.verdict) for r in got} == {(1, "block"), (2, "block")}


@pytest.mark.parametrize("few", [0, 100])
def test_only_rules_are_broadcast(spark, monkeypatch, few):
    """Relations with a row per place, node or component grow with the pages, however well they pack."""
    monkeypatch.setattr(aliases, "FEW_RULES", few)
    plans, plain = [], aliases.materialize

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(aliases, "materialize", watched)
    monkeypatch.setattr(tables, "materialize", watched)
    link = '<link rel="canonical" href="http://a.com/{}">'
    pages = spark.createDataFrame([(i, f"http://a.com/{i}", link.format(i // 2)) for i in range(40)], PAGES)
    judged = aliases.judge(pages, spark.createDataFrame([("block", "a.com", "/1")], RULES))
    plans.append(judged._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("BroadcastExchange") for p in plans) == (few > 0)
    assert sum("BroadcastExchange" in p and "Scan ExistingRDD" not in p.split("BroadcastExchange")[1] for p in plans) == 0
    assert sum(p.count("SortMergeJoin") for p in plans) >= 7
    # All are chained to the first page, and some of the chain are blocked.
    assert {r.verdict for r in judged.collect()} == {"block"}
