from itertools import combinations, product

import pytest

from quillprep.llm.urls import GIVEN, RuleParams, judge, matched, mine


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    for c in "?#":
        path = path.split(c, 1)[0]
    return host, path


def plain_rule(host, path):
    fit = [g for g in GIVEN if (host == g.host or host.endswith("." + g.host)) and path.startswith(g.path)]
    return max(fit, key=lambda g: len(g.name)) if fit else None


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM/en/x", "https://www.example.com/en/", "https://m.www.example.com/en/1?x#y", "http://example.com", "http://example.com?en/",
    "http://example.com#/en/", "x://foo.net/es/1", "x://foo.net/fr", "x://foo.net/fr/", "x://foonet/fr/", "x://com/", "x://a.com/x://b.net/es/", "http://b.org/é?q=1&&r=2", "://net/es/",
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "t", "u") for r in rows], "page_id long, url string, tokens string, row string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_hosts_paths_and_given_rules(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[4]), (3, URLS[3])]
    got = judge(pages(spark, rows), labels(spark, [])).collect()
    assert len(got) == len(rows)
    for r in got:
        want = {plain(u) for i, u in rows if i == r.page_id}
        assert (r.host, r.path) in want
        rule = plain_rule(r.host, r.path)
        assert (r.rule, r.verdict) == ((rule.name, rule.verdict) if rule else (None, "allow"))


def brute_rules(baskets, params):
    n, out = len(baskets), []
    items = sorted({t for tokens, _ in baskets for t in tokens})
    for size in range(1, params.most_tokens + 1):
        for a in combinations(items, size):
            fit = [bad for tokens, bad in baskets if set(a) <= set(tokens)]
            hits = sum(fit)
            if hits and hits / n >= max(params.support, params.least_rows / n) and hits / len(fit) >= params.confidence:
                if not any(set(o) < set(a) for o in out):
                    out.append(a)
    return {frozenset(a) for a in out}


def test_mined_rules_against_brute_force(spark):
    baskets = [(["a", "b", "h"], True)] * 8 + [(["a", "h"], False)] * 9 + [(["b", "h"], False)] * 9 + [(["c", "h"], True)] * 6 + [(["c", "d", "h"], True)] * 5 + [(["e"], True)]
    params = RuleParams(support=0.01, confidence=0.8, least_rows=4)
    got = mine(spark.createDataFrame(baskets, "tokens array<string>, bad boolean"), params).collect()
    assert {frozenset(r.antecedent) for r in got} == brute_rules(baskets, params) == {frozenset("ab"), frozenset("c"), frozenset("d")}
    assert all(r.anchor in r.antecedent and r.confidence >= 0.8 for r in got)


def test_mined_rules_block(spark):
    rows = [(i, f"http://spam.example.org/en/{i}") for i in range(40)] + [(100 + i, f"http://good.example.org/en/{100 + i}") for i in range(80)]
    rows += [(500, "http://spam.example.org/x"), (501, "http://spam.example.com/de/1"), (502, "http://good.example.org/")]
    marks = [(i, 0, 0) for i in range(40)] + [(100 + i, 1, 0) for i in range(80)] + [(None, 0, 0), (7, None, None), (8, 1, 1)]
    got = {r.page_id: r for r in judge(pages(spark, rows), labels(spark, marks)).collect()}
    assert got[500].verdict == got[3].verdict == "block" and got[500].rule is None and got[500].confidence == pytest.approx(1.0)
    assert (got[501].verdict, got[501].rule) == ("allow", "com/")
    assert got[502].verdict == got[150].verdict == "allow"


def test_tokens_of_the_same_urls_are_one_item(spark):
    many = [f"x{k:02}" for k in range(40)]
    baskets = [([*many, "h"], True)] * 30 + [(["a", "b", "h"], True)] * 9 + [(["a", "b", "c", "h"], False)] * 9 + [(["h"], False)] * 60
    params = RuleParams(support=0.01, confidence=0.4, least_rows=4)
    got = mine(spark.createDataFrame(baskets, "tokens array<string>, bad boolean"), params).collect()
    few = [([t for t in tokens if t not in many[1:]], bad) for tokens, bad in baskets]
    expanded = {frozenset(x) for r in got for x in product(*r.alternatives)}
    assert expanded == brute_rules(few, params) | {frozenset([t]) for t in many} == {frozenset([t]) for t in [*many, "a", "b"]}
    rules = mine(spark.createDataFrame(baskets, "tokens array<string>, bad boolean"), params)
    asked = spark.createDataFrame([(1, ["x39"]), (2, ["b", "z"]), (3, ["c", "h"])], "row long, tokens array<string>")
    assert {r.row for r in matched(asked, rules).collect()} == {1, 2}


def test_empty(spark):
    assert judge(pages(spark, [(1, "x")]).filter("false"), labels(spark, [])).count() == 0
