import random

import pytest
from pyspark.sql import functions as F

from roadflux.llm.queries import RULES
from roadflux.llm.urlfilter import judged, link_targets, undotted

PAGE = "page_id bigint, url string, html string, host string"


def canon(to):
    return f'<head><LINK href="{to}" rel="canonical"></head>'


def fresh(to):
    return f"<meta http-equiv='refresh' content='0; url={to}'>"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], PAGE)


def verdicts(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in df.collect()}


def test_rules(spark):
    got = verdicts(
        judged(
            pages(
                spark,
                [
                    (1, "https://A.Example.NET/en/1?x#y", None), (2, "http://example.net/de/", None), (3, "ftp://sub.org/fr/x", ""), (4, "http://example.com/de/a/b", None), (5, "http://notexample.com/de/", None),
                    (6, "http://net/", None), (7, "http://x.net", None), (8, None, None), (9, "no scheme", None), (10, "", None), (11, "http://x.org?a=http://y/fr/", None), (12, "http://Ünet.NET/#/en/", None), (13, "x://example.net/en/", None),
                ],
            ),
            RULES,
        )
    )
    assert got == {
        1: ("a.example.net", "/en/1", "example.net/en/", "allow"), 2: ("example.net", "/de/", "net/", "block"), 3: ("sub.org", "/fr/x", "org/fr/", "allow"), 4: ("example.com", "/de/a/b", "example.com/de/", "block"),
        5: ("notexample.com", "/de/", None, "allow"), 6: ("net", "/", "net/", "block"), 7: ("x.net", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"),
        11: ("x.org", "", None, "allow"), 12: ("Ünet.net", "/", "net/", "block"), 13: ("example.net", "/en/", "example.net/en/", "allow"),
    }


def test_decisions_pass_to_aliases(spark):
    rows = [
        (1, "http://a.info/x", canon("http://bad.net/x")),  # alias of a blocked url
        (2, "http://b.info/x", fresh("http://a.info/x#top")),  # alias of that alias
        (3, "https://b.info/x?q=1", None),  # another query is another url
        (4, "http://c.info/", canon("http://bad.net/y")), (5, "http://c.info", fresh("http://good.org/fr/")),  # blocked and allowed: allow first
        (6, "http://bad.net/y", None),  # its own rule stands
        (7, "http://d.info/p/q", canon("../x")), (10, "http://d.info/x?", None), (8, "http://e.info/", canon("")), (9, "http://e.info/", None),
        (1, "http://a.info/x", canon("http://bad.net/x")),
    ]
    got = verdicts(judged(pages(spark, rows), RULES))
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "allow", 8: "allow", 9: "allow", 10: "allow"}


def test_links_as_a_browser_reads_them(spark):
    rows = [
        (1, None, canon("http:///")), (2, "no scheme", None), (3, "http:///", canon("http://bad.net/")), (4, "http:///x", None),  # urls without a host part have no node
        (5, "http://a.info/x", canon("/go?u=http://bad.net/p")), (6, "http://a.info/go?u=http://bad.net/p", None),  # the scheme is not at the start
        (7, "http://b.info/f/g", canon("#top")), (8, "http://b.info/f/h", canon("http://bad.net/")), (9, "http://b.info/f/", None),
        (10, "http://c.info/f/g?a=1", canon("?id=2")), (11, "http://c.info/f/g?id=2", canon("http://bad.net/")), (12, "http://c.info/f/?id=2", None),
        (13, "http://d.info/x?a=1&b=2", None), (14, "http://d.info/y", canon("/x?a=1&amp;b=2")), (15, "http://d.info/z", canon("x?a=1&#38;b=2") + fresh("http://bad.net/")),
        (16, "http://e.info/p/q/r", canon("../../x/./y/")), (17, "http://e.info/x/y/", canon("http://bad.net/")), (18, "http://e.info/p/q/../../x/y/", None),
        (19, "http://f.info/", canon("mailto:someone@bad.net") + canon("javascript:go('http://bad.net/')")), (20, "http://g.info/", canon("http://h.info/") + canon("http://bad.net/")),
    ]
    got = {k: v[3] for k, v in verdicts(judged(pages(spark, rows), RULES)).items()}
    assert {k for k, v in got.items() if v == "block"} == {3, 8, 10, 11, 13, 14, 15, 16, 17, 18, 20}


@pytest.mark.parametrize("path", ["", "/", "/a", "/a/..", "/a/.", "/a/../..", "/./a//b/../c", "/a/b/..", "/.hidden/x", "/a..b/", "/../x/"])
def test_dot_segments(spark, path):
    from urllib.parse import urljoin

    got = spark.createDataFrame([(path,)], "path string").select(undotted(F.col("path"))).first()[0]
    assert got == (urljoin("http://h", path).removeprefix("http://h") or "/")


def test_rules_by_join_are_the_compiled_rules(spark):
    rnd = random.Random(3)
    hosts = ["net", "a.net", "b.a.net", "org", "x.org", "c.b.a.net", "et", "", "info"]
    paths = ["", "/", "/e", "/en/", "/en/x", "/de/", "/d"]
    rules = [(rnd.choice(["block", "allow"]), rnd.choice(hosts[:6]) + rnd.choice(paths[1:])) for _ in range(30)]
    rows = pages(spark, [(i, rnd.choice(["http://", "x://", ""]) + rnd.choice(hosts) + rnd.choice(paths) + rnd.choice(["", "?q", "#f"]), canon(f"http://{rnd.choice(hosts[:6])}/")) for i in range(120)])
    table = spark.createDataFrame([*rules, (None, "net/"), ("block", None)], "verdict string, rule string")
    assert verdicts(judged(rows, rules)) == verdicts(judged(rows, table))
    many = [*rules, *[("block", f"site{i}.example/") for i in range(3000)]]
    assert verdicts(judged(rows, rules)) == verdicts(judged(rows, many))


def test_given_redirects(spark):
    more = spark.createDataFrame([("http://a.info/", "http://b.info/"), ("http://b.info/", "http://x.net/"), (None, "http://c.info/")], "src string, dst string")
    got = verdicts(judged(pages(spark, [(1, "https://a.info/", None), (2, "http://c.info/", None)]), RULES, more))
    assert got[1][3] == "block" and got[2][3] == "allow"


def test_targets(spark):
    rows = [(i, "https://h.info/d/e?x=1", canon(to)) for i, to in enumerate(["/r", "//o.info/s", "f", "http://z.info/?q"])]
    assert {r.dst for r in link_targets(pages(spark, rows)).collect()} == {"https://h.info/r", "https://o.info/s", "https://h.info/d/f", "http://z.info/?q"}


def test_nothing_and_native(spark):
    df = judged(pages(spark, [(1, None, None)]).limit(0), RULES)
    assert df.count() == 0
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_very_long_page(spark):
    html = "<p>" + "text " * 400_000 + canon("http://bad.net/")
    assert verdicts(judged(pages(spark, [(1, "http://q.info/", html)]), RULES))[1][3] == "block"
