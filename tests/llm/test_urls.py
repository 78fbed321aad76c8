from __future__ import annotations

import duckdb
import pytest

from plumbline.llm import queries
from plumbline.llm.urls import judge_urls, literal
from pyspark.sql import functions as F

RULES = queries.URL_RULES


def judged(spark, rows, **more):
    frame = spark.createDataFrame(rows, "page_id long, url string, label string").selectExpr("*", "1 AS host", "2 AS rows", "3 AS node")
    return {r.page_id: r for r in judge_urls(frame, RULES, label_col="label", **more).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.NET/en/1?x#y", "http://example.net", "http://example.net/fr/", "ftp://example.com/de/a/b",
        "http://myexample.com/de/1", "http://x.org/fr/2#t", "http://x.org/FR/2", "http://net/a", "http://internet/a", "http://e.net:80/a",
        "a://b?c/d", "http:///x", "http://x.example.com/de", "http://ex\nample.net/a\nb", "://x.net/y://z.net/en/",
    ]
    got = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "", None, "allow"), ("example.net", "/fr/", "net/", "block"), ("example.com", "/de/a/b", "example.com/de/", "block"),
        ("myexample.com", "/de/1", None, "allow"), ("x.org", "/fr/2", "org/fr/", "allow"), ("x.org", "/FR/2", None, "allow"),
        ("net", "/a", "net/", "block"), ("internet", "/a", None, "allow"), ("e.net:80", "/a", None, "allow"), ("b", "", None, "allow"),
        ("", "/x", None, "allow"), ("x.example.com", "/de", None, "allow"), ("ex\nample.net", "/a\nb", "net/", "block"),
        ("x.net", "/y://z.net/en/", "net/", "block"),
    ]


def tree_rows():
    rows = [(i, f"http://shop.com/item/{i}", "block" if i % 10 else None) for i in range(40)]
    rows += [(100 + i, f"http://shop.com/news/{i}.html", "allow" if i % 2 else None) for i in range(40)]
    rows += [(200 + i, f"http://shop.com/{k}/x{i}/y", None) for i in range(30) for k in ("blue",)]
    rows += [(300 + i, f"http://shop.com/green/x{i}/y", None) for i in range(28)]
    rows += [(400 + i, f"http://other.com/item/{i}", None) for i in range(5)]
    deep = "/".join("abcdefghijkl")
    rows += [(500, f"http://deep.com/{deep}", "block"), (501, f"http://deep.com/{deep}", "block"), (502, "http://deep.com/*/{x|y}", None)]
    rows += [(600 + i, "http://hot.com/same", "block" if i < 30 else None) for i in range(60)]
    return rows + [(None, "http://shop.com/item/7", "block")]


def test_templates_reject_by_known_paths(spark):
    got = judged(spark, tree_rows())
    assert got[10].template == "/item/*" and got[10].verdict == "block" and got[10].purity == pytest.approx(37 / 38)
    assert got[102].template == "/news/*" and got[102].verdict == "allow"
    assert got[205].template == got[305].template == "/{blue|green}/*/y" and got[205].verdict == "allow"
    assert got[400].template == "/item/*" and got[400].verdict == "allow"
    # one distinct path counts once, however many rows it has
    assert got[650].verdict == "allow" and got[650].purity == pytest.approx(2 / 3)
    assert got[500].template == "/*/*/*/*/*/*/*" and got[502].template == "/*/*"
    assert spark.range(1).select(literal(F.lit("*{a}|b"))).first()[0] == "%2A%7Ba%7D%7Cb"


def test_sql_gives_the_same(spark):
    rows = [(i, u, None) for i, (_, u, _) in enumerate(tree_rows())]
    rows += [(1000 + i, f"http://a.example.com/{'de' if i % 3 else 'en'}/p{i % 70}/{i % 4}", None) for i in range(200)] + [(2000, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, label string")
    got = {tuple(r) for r in judge_urls(frame, RULES, keep=["page_id"]).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    found = con.execute(queries.SQL["op11_url_templates"])
    names = [d[0] for d in found.description]
    order = [names.index(c) for c in ("page_id", "host", "path", "rule", "template", "purity", "verdict")]
    assert got == {tuple(r[k] for k in order) for r in found.fetchall()}


def test_no_rows_and_no_rules(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(empty, RULES).collect() == []
    one = judge_urls(spark.createDataFrame([(1, "http://a.net/b")], "page_id long, url string"), ()).collect()
    assert [(r.page_id, r.rule, r.verdict) for r in one] == [(1, None, "allow")]
    with pytest.raises(ValueError):
        judge_urls(empty, [("deny", "net/")])
