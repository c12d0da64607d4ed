"""Exact dedup and url rules: SQL twins, edge cases, brute force."""

import random

import pytest
from helpers import EDGE, LONG, table

from txlens.llm import exact_dedup, url_filter
from txlens.llm.exact_dedup import exact_dedup as dedup
from txlens.llm.url_filter import RULES, filter_urls


def test_edge_cases_have_defined_results(spark):
    rows = dedup(table(spark, EDGE, clash=True)).collect()
    assert len(rows) == len(EDGE)
    by = {(r.doc_id, r.group_size): r for r in rows}
    # Two rows of id 1 and the null id share a text; ids come before null.
    assert by[(1, 3)].kept and by[(1, 3)].keep_id == 1
    assert not by[(None, 3)].kept
    # Null, empty and blank texts are equal; the blank one has most code points.
    assert by[(4, 4)].kept and not by[(3, 4)].kept and by[(2, 4)].keep_id == 4
    assert by[(5, 1)].kept and by[(6, 1)].kept


def test_empty_table(spark):
    assert dedup(table(spark, []).limit(0)).count() == 0


def test_hot_copies_and_an_overfull_filter_give_the_same_rows(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(i, "hot text" if i % 3 == 0 else f"t {rnd.randrange(400)}" + " " * rnd.randrange(3)) for i in range(1500)]
    docs = table(spark, rows).repartition(8)
    usual = sorted(map(tuple, dedup(docs).collect()))
    groups = {}
    for i, t in rows:
        groups.setdefault(t.replace(" ", ""), []).append((-len(t), i))
    expected = {i: (min(groups[t.replace(" ", "")])[1], len(groups[t.replace(" ", "")])) for i, t in rows}
    assert {r[0]: (r[1], r[2]) for r in usual} == expected
    for name in ("MAX_FILTER_WORDS", "MAX_GROUPS"):
        monkeypatch.setattr(exact_dedup, name, 3)
    assert sorted(map(tuple, dedup(docs).collect())) == usual
    # A filter with almost no bits only lets more rows be compared.
    assert sorted(map(tuple, dedup(docs, bits_per_key=1).collect())) == usual


def fits(host, path, rule):
    _, h, t = rule
    return (host == h or host.endswith("." + h)) and path.startswith(t)


def brute(host, path, rules):
    found = [r for r in rules if fits(host, path, r)]
    if not found:
        return None, "allow"
    size = max(len(r[1] + r[2]) for r in found)
    best = [r for r in found if len(r[1] + r[2]) == size]
    return best[0][1] + best[0][2], "block" if any(r[0] == "block" for r in best) else "allow"


URLS = [
    None, "", "no scheme/en/", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?y#z",
    "https://a.b.example.com/en/1", "x://example.com/EN/", "http://net/es/", "http://anet/es/", "http://a.net/fr/",
    "http://a.net/fr", "http://example.com?u=http://b.net/es/", "ftp://é.com/ü/", "http://a..com/", "a://b://c.com/",
]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_urls_against_brute_force(spark):
    rnd = random.Random(5)
    hosts = ["com", "example.com", "www.example.com", "m.www.example.com", "net", "a.net", "b.a.net", "org"]
    urls = URLS + [
        f"http://{rnd.choice(hosts)}{rnd.choice(['', '/', '/en/', '/es/x', '/fr/', '/e', '/en'])}{rnd.choice(['', '?q', '#f'])}"
        for _ in range(400)
    ]
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    for r in filter_urls(pages(spark, urls), rules).collect():
        assert (r.rule, r.verdict) == brute(r.host, r.path, RULES), r
    out = {r.page_id: (r.host, r.path) for r in filter_urls(pages(spark, URLS), rules).collect()}
    assert out[0] == out[1] == out[2] == ("", "")
    assert out[6] == ("www.example.com", "/en/x") and out[13] == ("example.com", "")
    assert out[16] == ("b:", "//c.com/")


@pytest.mark.parametrize("limit", [url_filter.MAX_FILTER_KEYS, 10])
def test_many_rules_by_cascade_and_by_join(spark, monkeypatch, limit):
    """With more listed keys several levels are needed; the way for oversized lists agrees."""
    monkeypatch.setattr(url_filter, "MAX_FILTER_KEYS", limit)
    rnd = random.Random(8)
    rules = list({(h := f"h{rnd.randrange(300)}.com", p := rnd.choice(["/", "/a/", "/b"])): ("block", h, p) for _ in range(150)}.values())
    urls = [f"http://{rnd.choice(['', 'x.'])}h{rnd.randrange(600)}.com{rnd.choice(['/', '/a/b', '/b', ''])}" for _ in range(1500)]
    listed = spark.createDataFrame(rules, "verdict string, host string, path string")
    for r in filter_urls(pages(spark, urls), listed).collect():
        assert (r.rule, r.verdict) == brute(r.host, r.path, rules), r


def test_no_pages_and_no_rules(spark):
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    assert filter_urls(pages(spark, ["http://a.com/"]).limit(0), rules).count() == 0
    row = filter_urls(pages(spark, ["http://a.com/"]).selectExpr("*", "1 AS host", "2 AS rule"), rules.limit(0)).first()
    assert (row.host, row.rule, row.verdict) == ("a.com", None, "allow")


def test_long_texts_are_kept_whole(spark):
    rows = dedup(table(spark, [(1, LONG + "a"), (2, LONG + "b"), (3, LONG.replace(" ", "\n") + "a")])).collect()
    assert {r.doc_id: r.keep_id for r in rows} == {1: 1, 2: 2, 3: 1}


def test_ties_are_settled_alike_by_cascade_and_join(spark, monkeypatch):
    """Equally long rules: the block rule wins, whichever way is taken; very long hosts cost no more."""
    rules = [("block", "a.bc", "/"), ("allow", "bc", "/x/"), ("allow", "q.rs", "/"), ("block", "rs", "/y/"), ("allow", "a.b.c.d", "/")]
    deep = ".".join(f"l{i}" for i in range(20_000))
    urls = ["http://a.bc/x/y", "http://q.rs/y/", f"http://{deep}.a.bc/x/", f"https://{deep}.x/", "http://z.a.b.c.d/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame(rules, "verdict string, host string, path string")
    expected = [("a.bc/", "block"), ("rs/y/", "block"), ("a.bc/", "block"), (None, "allow"), ("a.b.c.d/", "allow")]
    for limit in (url_filter.MAX_FILTER_KEYS, 2):
        monkeypatch.setattr(url_filter, "MAX_FILTER_KEYS", limit)
        found = filter_urls(pages, listed).orderBy("page_id").collect()
        assert [(r.rule, r.verdict) for r in found] == expected
