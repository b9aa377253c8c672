"""URL rules against a plain loop over all rules."""

import collections
import random

import pytest
from frames import clashing

from marketbars.llm import queries, urlrules
from marketbars.llm.urlrules import judge

URLS = "page_id bigint, url string, html string"
RULES = "host string, path string, verdict string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def brute(pages, rules, default="allow"):
    out = collections.Counter()
    kept = {}
    for host, path, verdict in rules:
        if None not in (host, path, verdict):
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path
            kept[key] = max(kept.get(key, ""), verdict)
    for page_id, url, *_ in pages:
        host, path = parts(url)
        fits = [
            (len(h + p), len(h), h + p, v)
            for (h, p), v in kept.items()
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, 0, None, default))
        out[page_id, host, path, best[2], best[3]] += 1
    return out


def got(frame):
    return collections.Counter(
        (r.page_id, r.host, r.path, r.rule, r.verdict) for r in frame.collect()
    )


ODD = [
    (1, "http://Example.ORG/es/x?q=1#t", "h"),
    (1, "http://Example.ORG/es/x?q=1#t", "h"),
    (2, None, None),
    (3, "no scheme.org/es/", None),
    (4, "http://", "x"),
    (None, "https://a.b.example.org/en/1", ""),
    (5, "https://org/", ""),
    (6, "https://example.org", ""),
    (7, "https://example.org?x=/es/", ""),
    (8, "http://notexample.org/es/", ""),
    (9, "http:///es/", ""),
    (10, "ftp://x://y.org/es", ""),
    (11, "http://ÉX.fr.com/fr/é\n/漢", ""),
    (12, "http://" + "a." * 3000 + "com/de/" + "x/" * 20_000, ""),
    (13, "http://com/de/\U0010ffff", ""),
    (14, "http://m.com./fr/", ""),
    (15, "", ""),
]
ODD_RULES = [
    *queries.URL_RULES,
    ("COM", "/fr/", "block"),
    ("com", "/de/x/x", "allow"),
    ("com", "/de/\U0010ffff", "allow"),
    ("", "/es", "block"),
    ("org", "", "block"),
    (None, "/", "block"),
    ("org", None, "block"),
    ("org", "/", None),
]


@pytest.mark.parametrize("run", [1, 2000])
def test_odd_urls(spark, run):
    pages = clashing(spark.createDataFrame(ODD, URLS))
    rules = clashing(spark.createDataFrame(ODD_RULES, RULES))
    assert got(judge(pages, rules, run=run)) == brute(ODD, ODD_RULES)
    assert got(judge(pages, rules, "block", run=run)) == brute(ODD, ODD_RULES, "block")


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame(ODD, URLS)
    assert got(judge(pages, spark.createDataFrame([], RULES))) == brute(ODD, [])
    rules = spark.createDataFrame(ODD_RULES, RULES)
    assert judge(spark.createDataFrame([], URLS), rules).collect() == []
    elsewhere = spark.createDataFrame([("nowhere", "/", "block")], RULES)
    assert got(judge(pages, elsewhere)) == brute(ODD, [])


def test_nested_rules_and_a_crowded_domain(spark):
    rng = random.Random(4)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "com", "x.org"]
    steps = ["/", "/a", "/a/", "/a/b", "/a/b/c", "/ab", "/b", ""]
    rules = [
        (rng.choice(hosts), rng.choice(steps), rng.choice(["allow", "block"])) for _ in range(25)
    ]
    # Two thirds of the rows are of one domain, a third is one url.
    pages = [(i, "http://c.b.a.com/a/b/c/d", "") for i in range(300)]
    for i in range(600):
        host = rng.choice([*hosts, "c.b.a.com", "z.c.b.a.com", "y.x.org"])
        pages.append((i, f"http://{host}{rng.choice(steps)}{rng.choice('abc/')}?{i}", ""))
    frame, table = spark.createDataFrame(pages, URLS), spark.createDataFrame(rules, RULES)
    for run in (1, 7, 10_000):
        assert got(judge(frame, table, run=run)) == brute(pages, rules)


def test_query_on_the_test_table(spark, sf_dir):
    pages = [tuple(r) for r in queries.table(spark, sf_dir, "pages").collect()]
    result = queries.QUERIES["op13_url_filters"](spark, sf_dir)
    assert got(result) == brute(pages, queries.URL_RULES)


def test_rows_of_one_domain_are_dealt_to_runs(spark, monkeypatch):
    seen = {}
    sweep = urlrules._sweep

    def watched(probes, rules, runs):
        seen.update({r.base: r.n_runs for r in runs.collect()})
        return sweep(probes, rules, runs)

    monkeypatch.setattr(urlrules, "_sweep", watched)
    pages = [(i, f"http://a.com/{i}", "") for i in range(100)]
    rules = [("com", f"/{i}", "block") for i in range(20)] + [("org", "/", "block")]
    frame = spark.createDataFrame(pages, URLS)
    judged = judge(frame, spark.createDataFrame(rules, RULES), run=10)
    assert got(judged) == brute(pages, rules)
    assert seen == {"com.": 5}
