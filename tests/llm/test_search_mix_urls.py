"""Top-k search, source mix and URL filter: edge cases, brute force and SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_sql import same_rows
from vecshelf.llm import mixing, topk, url_filter
from vecshelf.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, sql, name):
    same_rows(queries()[name](spark, SF), sql, oracle_sql()[name])


def brute(ids, vectors, asked, k):
    out = []
    for q, v in asked:
        scores = sorted((-int(np.dot(v, w)), i) for i, w in zip(ids, vectors) if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, k", [(8_192, 20), (40, 7), (16, 3)])
def test_top_k(spark, monkeypatch, shard, k):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", 9)
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((150, 6)).round(2)
    vectors[40:90] = vectors[40]  # ties
    vectors[100:120] *= 40
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    odd = [(500, None, "x"), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (502, [float("nan")] * 6, "x"), (None, [1.0] * 6, "x")]
    odd += [(503, [float("inf")] * 6, "x")]
    items = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, score string")
    found = topk.top_k(items.where("vec_id % 5 = 0"), items, k)
    whole = np.floor(64 * vectors)
    want = brute(range(150), whole, [(i, whole[i]) for i in range(0, 150, 5)], k)
    assert sorted(map(tuple, found.collect())) == want


def test_top_k_edges(spark):
    items = spark.createDataFrame([(0, [1.0]), (1, [0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(items.where("vec_id = 0"), items).collect()] == [(0, 1, 1, 64 * 32)]
    assert topk.top_k(items.limit(0), items).count() == 0
    assert topk.top_k(items, items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        topk.top_k(items, spark.createDataFrame([(2, [1.0, 2.0])], items.schema))


def test_inverse_demand(spark):
    for schedule in (*mixing.SCHEDULES, ((0.0, 0.0), (0.3, 2.0), (1.0, 0.0))):
        shares = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
        df = spark.createDataFrame([(s,) for s in shares], "f double")
        at = [r[0] for r in df.select(mixing.inverse_demand(schedule, F.col("f"))).collect()]
        x, y = zip(*schedule)
        for share, t in zip(shares, at):
            grid = np.linspace(0, t, 20_001)
            assert abs(np.trapezoid(np.interp(grid, x, y), grid) / mixing.integral(schedule) - share) < 1e-6


def test_mix(spark):
    rows = [(i, "w " * (i % 37 + 1), f"s{i % 5}" if i % 5 else None) for i in range(400)]
    rows += [(1000, None, "s1"), (1001, "", "empty"), (None, "a b", "s1"), (1002, "z " * 5000, "long"), (5, "w", "s2")]
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, source string, size int, key int")
    found = mixing.mixed(docs).collect()
    again = mixing.mixed(docs.repartition(7)).collect()

    def plain(xs):
        return sorted((repr(tuple(r)) for r in xs))

    assert len(found) == len(rows) and plain(found) == plain(again)
    by = {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and len(r.positions) == (r.taken // r.size if r.size else 0)
        by.setdefault((r.source, r.source_size, r.target), []).append(r)
    assert abs(sum(t for _, _, t in by) - 1.5 * sum(s for _, s, _ in by)) < 1e-6
    for (source, size, target), held in by.items():
        assert sum(r.size for r in held) == size and target <= 2 * size
        if source != "long":
            assert abs(sum(r.taken for r in held) - target) <= max(r.size for r in held)
    ordered = mixing.training_order(docs)
    assert ordered.columns == docs.columns
    assert ordered.count() == sum(len(r.positions) for r in found if r.doc_id != 5) + 2 * max(
        len(r.positions) for r in found if r.doc_id == 5
    )
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.training_order(docs.limit(0)).count() == 0


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("allow", "com/fr/"), ("block", "com/de/"), ("block", "b.net/")]


def test_url_rules_and_aliases(spark):
    pages = [
        (1, "https://EXAMPLE.org/es/1?q"), (2, "http://x.example.org/en#top"), (3, "https://notexample.org/es/"),
        (4, "https://a.com/de/2"), (5, None), (6, "no scheme"), (7, "https://c.net/one"), (8, "https://c.net/two#x"),
        (9, "https://d.net/"), (10, "https://e.org/hit"), (11, "ftp://b.net"), (12, "https://b.net/"), (12, "https://b.net/"),
        (None, "https://a.com/fr/"), (13, "https://f.net/p"),
    ]
    edges = [
        ("https://c.net/one#f", "https://b.net/z"), ("https://c.net/two", "https://c.net/one"),  # inherits a block
        ("https://d.net/", "https://b.net/y"), ("https://d.net/", "https://g.org/ok"),  # block and allow: allow
        ("https://e.org/hit", "https://b.net/w"),  # its own allow goes first
        (None, "https://f.net/p"), ("https://f.net/p", "https://f.net/p"),
    ]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, host string")
    links = spark.createDataFrame(edges, "a string, b string")
    found = {r.page_id: r for r in url_filter.judged(df, RULES, links).collect()}
    verdicts = {k: (r.rule, r.verdict, r.inherited) for k, r in found.items()}
    assert verdicts == {
        1: ("example.org/es/", "block", False), 2: ("org/", "allow", False), 3: ("org/", "allow", False),
        4: ("com/de/", "block", False), 5: (None, "allow", False), 6: (None, "allow", False),
        7: (None, "block", True), 8: (None, "block", True), 9: (None, "allow", False), 10: ("org/", "allow", False),
        11: (None, "allow", False), 12: ("b.net/", "block", False), None: ("com/fr/", "allow", False),
        13: (None, "allow", False),
    }
    assert (found[1].host, found[1].path, found[11].host, found[11].path) == ("example.org", "/es/1", "b.net", "")
    assert (found[5].host, found[6].path) == ("", "")
    assert url_filter.judged(df, RULES, links.limit(0)).count() == len(pages)
    assert url_filter.judged(df.limit(0), RULES, links).count() == 0


def test_canonical_links(spark):
    html = {
        "http://a.net/x/1": '<LINK href="/canon" rel="canonical">',
        "http://a.net/2": "<meta http-equiv='refresh' content='0; url=https://b.net/q'>",
        "http://a.net/3": '<link rel=canonical href="//c.net/z">',
        "http://a.net/4": '<link rel="stylesheet" href="/s.css">canonical',
        "http://a.net/5": None,
    }
    pages = spark.createDataFrame([*html.items(), (None, '<link rel="canonical" href="/x">')], "url string, html string")
    assert sorted(map(tuple, url_filter.canonical_links(pages).collect())) == [
        ("http://a.net/2", "https://b.net/q"), ("http://a.net/3", "http://c.net/z"), ("http://a.net/x/1", "http://a.net/canon"),
    ]


def test_url_query_against_brute_force(spark):
    from vecshelf.llm.queries import URL_RULES

    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    for r in queries()["op3_url_filter"](spark, SF).collect():
        rest = urls[r.page_id].partition("://")[2].split("#")[0].split("?")[0]
        host, slash, path = rest.partition("/")
        fits = [
            (len(rule), rule, action) for action, rule in URL_RULES
            if f".{host}".endswith("." + rule.partition("/")[0]) and (slash + path).startswith("/" + rule.partition("/")[2])
        ]
        best = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host.lower(), slash + path, best[1], best[2])
