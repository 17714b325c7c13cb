"""URL rules against plain Python, and the mined rules against brute force."""

import itertools
import math
from collections import Counter

from pyspark.sql import functions as F

from talewright.llm import url_rules
from talewright.llm.url_rules import RULES, judge, parse, tokens


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(v, r) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    rule = max(fits, key=lambda x: len(x[1]), default=(None, None))
    return host, path, rule[1], rule[0]


URLS = [None, "", "no scheme", "http://", "HTTP://Sub.Example.ORG/es/1?x=/de/", "https://example.org/en/1", "https://example.org/en/2", "https://notorg/x",
        "https://a.org", "https://a.org?x", "https://a.org#/es/", "https://org/", "https://a.com/fr/", "https://a.com/fr", "https://b.com/de/9#f", "x://y://z.org/a",
        "https://example.org/es/\n/q", "https://Éa.org/ü", "https://myexample.org/es/", "https://a..org/..", "https://.org/"]


def test_hosts_paths_and_fixed_rules(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[5]), (5, URLS[5])], "page_id long, url string")
    rows = rows.withColumn("host", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("tokens", F.lit("t"))
    got = judge(rows).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = plain(URLS[r.page_id] if r.page_id is not None else URLS[5])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict is None or r.verdict == verdict
        assert r.verdict in ("allow", "block")
    assert judge(rows.limit(0)).collect() == []
    only = rows.where("page_id in (0, 1, 2)")
    assert {r.verdict for r in judge(only).collect()} == {"allow"}       # nothing to mine from


def test_mined_rules_equal_brute_force(spark, sf001):
    pages = spark.read.parquet(f"{sf001}/pages.parquet")
    toks = {r.page_id: frozenset(r.t) for r in parse(pages).select("page_id", tokens().alias("t")).collect()}
    rows = {r.page_id: r for r in judge(pages).collect()}
    fixed = {i: plain(u)[3] for i, u in pages.select("page_id", "url").collect()}
    judged = [(toks[i], v) for i, v in fixed.items() if v]
    both, alone = Counter(), Counter()
    for t, v in judged:
        for n in range(1, len(t) + 1):
            for a in itertools.combinations(sorted(t), n):
                alone[a] += 1
                both[a, v] += 1
    least = math.ceil(url_rules.MIN_SUPPORT * len(judged))
    rules = [(c / alone[a], c / len(judged), frozenset(a), v) for (a, v), c in both.items() if c >= least and c / alone[a] >= url_rules.MIN_CONFIDENCE]
    for i, v in fixed.items():
        fits = [(c, s, v2) for c, s, a, v2 in rules if a <= toks[i]]
        if v:
            assert rows[i].verdict == v
        elif not fits:
            assert rows[i].verdict == url_rules.DEFAULT
        elif len({v2 for c, s, v2 in fits if c == max(f[0] for f in fits)}) == 1:
            assert rows[i].verdict == max(fits)[2]


def test_tokens_far_behind_count(spark):
    pad = lambda i, n: "&".join(f"u{i}x{j}={j}" for j in range(n))
    urls = []
    for i in range(40):
        urls += [f"https://s{i}.com/de/{i}?{pad(i, 20)}&bad=1", f"https://t{i}.org/a/{i}?{pad(i, 18)}&good"]
        urls += [f"https://v{i}.com/de/" + f"{i}/" * 20 + "deep"]
        # a template of 30 parameters that always come together: 2 ** 30 sets of them
        urls += [f"https://w{i}.com/de/{i}?" + "&".join(f"t{j}={i}" for j in range(30))]
    path = "/".join(f"y{j}" for j in range(21))
    open_urls = {f"https://z.net/?{pad(99, 25)}&bad=7": "block", f"https://z.net/?{pad(99, 25)}&good=7": "allow", f"https://z.net/{path}/deep": "block",
                 f"https://z.net/{path}/x/deep": "allow", f"https://z.net/?{pad(99, 3)}": "allow", "https://z.net/?t25=x": "block", "https://z.net/?t0&t29": "block"}
    rows = spark.createDataFrame(list(enumerate([*urls, *open_urls])), "page_id long, url string")
    got = {r.page_id: r for r in judge(rows).collect()}
    assert len(got) == len(rows.collect())
    for i, (url, verdict) in enumerate(open_urls.items(), len(urls)):
        assert (got[i].rule, got[i].verdict) == (None, verdict), url


def test_tokens_are_not_cut(spark):
    url = "https://a.b.net/" + "/".join(f"d{j}" for j in range(40)) + "?" + "&".join(f"k{j}=1" for j in range(40))
    got = parse(spark.createDataFrame([(url,)], "url string")).select(tokens().alias("t")).first().t
    assert sorted(got) == sorted(["s:https", "h1:net", "h2:b", "h3:a", *[f"p{j}:d{j}" for j in range(40)], *[f"q:k{j}" for j in range(40)]])
