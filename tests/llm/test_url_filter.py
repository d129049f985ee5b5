import re
from collections import defaultdict

from pyspark.sql import functions as F

from rainspark.llm import queries, url_filter
from tests.llm.helpers import SF, table


def judge(spark, urls, labels=()):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x"))
    outcomes = spark.createDataFrame(list(labels), "page_id long, bad boolean")
    rows = url_filter.judge(pages, outcomes, queries.URL_RULES).collect()
    return {r.page_id: r for r in rows}


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://WWW.Example.COM/en/a?b=/x#y", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        ("https://a.example.com/EN/", "a.example.com", "/EN/", "com/", "allow"),
        ("https://a.com", "a.com", "", None, "allow"),
        ("x://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
        ("x://b.net/fr", "b.net", "/fr", None, "allow"),
        ("x://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://a://b/c", "a:", "//b/c", None, "allow"),
        ("http://ÀB.net?x", "Àb.net", "", None, "allow"),
    ]
    got = judge(spark, [c[0] for c in cases])
    for i, (_, *want) in enumerate(cases):
        assert [got[i].host, got[i].path, got[i].rule, got[i].verdict] == want, cases[i]
    assert judge(spark, []) == {}


def test_reputation_shrinks_towards_the_domain(spark):
    urls = [f"http://spam.bad.org/{i}" for i in range(40)] + [f"http://good{i % 5}.fine.org/{i}" for i in range(60)]
    urls += ["http://new.bad.org/", "http://new.fine.org/"]
    labels = [(i, i < 40) for i in range(100)]
    got = judge(spark, urls, labels)
    assert {got[i].verdict for i in range(40)} == {"block"}
    assert {got[i].verdict for i in range(40, 100)} == {"allow"}
    assert got[100].bad_mean > got[101].bad_mean


def test_one_bad_label_is_no_proof(spark):
    urls = ["http://a.x.org/1"] + [f"http://h{i}.y{i}.org/" for i in range(50)]
    got = judge(spark, urls, [(i, i == 0) for i in range(51)])
    assert got[0].verdict == "allow"


def brute_weight(groups, most=20.0):
    groups = [g for g in groups if g[0]]
    every, one = sum(n * m * (1 - m) for n, _, m in groups), sum(m * (1 - m) for _, _, m in groups)
    if not every or every - one <= 0:
        return most
    r = (sum(n * (k / n - m) ** 2 for n, k, m in groups) - one) / (every - one)
    return most if r <= 0 else min(max((1 - r) / r, 1.0), most)


def brute_worse(hosts, outcomes):
    """host -> whether its lower posterior bound is above the overall share. hosts: page_id -> host."""
    count = defaultdict(lambda: [0, 0])
    for page, host in hosts:
        count[host][0] += page in outcomes
        count[host][1] += outcomes.get(page, False)
    n, k = (sum(c[i] for c in count.values()) for i in range(2))
    mean = (k + 0.5) / (n + 1) if n else 0.0

    def names(host):
        bare = re.sub(r":[0-9]*$|\.$", "", re.sub(r"^.*@", "", host))
        labels = bare.split(".")
        suffix = labels[-1]
        if len(labels) > 1 and labels[-2] in url_filter.SECOND_LEVEL and re.fullmatch("[a-z]{2}", suffix):
            suffix = ".".join(labels[-2:])
        rest = bare[: len(bare) - len(suffix) - 1]
        return suffix, f"{rest.split('.')[-1]}.{suffix}" if rest else bare

    by = {h: names(h) for h in count}

    def summed(place):
        out = defaultdict(lambda: [0, 0])
        for h, (a, b) in count.items():
            out[place(h)][0] += a
            out[place(h)][1] += b
        return out

    def weight(groups, prior):
        return brute_weight([(a, b, prior[g]) for g, (a, b) in groups.items()])

    def without(groups, prior, w, part, g):
        """Mean of group g without the counts of one of its parts."""
        return (groups[g][1] - part[1] + w * prior[g]) / (groups[g][0] - part[0] + w)

    suffixes, domains = summed(lambda h: by[h][0]), summed(lambda h: by[h])
    top = dict.fromkeys(suffixes, mean)
    w = weight(suffixes, top)
    middle = {d: without(suffixes, top, w, domains[d], d[0]) for d in domains}
    w = weight(domains, middle)
    low = {h: without(domains, middle, w, count[h], by[h]) for h in count}
    w = weight(count, low)
    out = {}
    for h, (a, b) in count.items():
        alpha, beta = b + w * low[h], a - b + w * (1 - low[h])
        m = alpha / (alpha + beta)
        out[h] = m - (m * (1 - m) / (alpha + beta + 1)) ** 0.5 > mean
    return out


def test_query_against_brute_force_and_verdicts_vary(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        rows = queries.op9_url_reputation(spark, sf).collect()
        labels = table(spark, "labels", sf).collect()
        outcomes = {}
        for r in labels:
            outcomes[r.doc_id] = outcomes.get(r.doc_id, False) or r.quality == 0 or r.toxic == 1
        worse = brute_worse([(r.page_id, r.host) for r in rows], outcomes)
        assert len(rows) == table(spark, "pages", sf).count()
        for r in rows:
            if r.rule is None:
                assert r.verdict == ("block" if worse[r.host] else "allow")
    assert {r.verdict for r in rows if r.rule is None} == {"allow", "block"}  # by reputation alone


def test_suffix_table_and_null_ids(spark):
    pages = spark.createDataFrame([(None, "http://a.b.co.uk/"), (1, "http://a.b.co.uk/"), (1, "http://a.b.co.uk/"), (2, "http://c.github.io/x")], "page_id long, url string")
    outcomes = spark.createDataFrame([(1, True), (1, False), (None, True)], "page_id long, bad boolean")
    listed = spark.createDataFrame([("uk",), ("co.uk",), ("github.io",), ("io",)], "suffix string")
    rows = url_filter.judge(pages, outcomes, [], suffixes=listed).collect()
    assert len(rows) == 4 and len({(r.bad_mean, r.verdict) for r in rows if r.host == "a.b.co.uk"}) == 1
    hosts = spark.createDataFrame([("h1", "a.b.co.uk"), ("h2", "c.github.io"), ("h3", "x.local")], "host string, name string")
    assert {r.host: r.suffix for r in url_filter.listed_suffix(hosts, listed).collect()} == {"h1": "co.uk", "h2": "github.io", "h3": "local"}
