import random

from tabloom.llm import components, url_filter


def judge(spark, rows, *extra):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in extra:
        pages = pages.selectExpr("*", f"'clash' AS {name}")
    found = url_filter.judge(pages, url_filter.rule_table(spark)).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}


def canonical(to):
    return f'<html><head><LINK href="{to}" rel=canonical></head></html>'


def refresh(to):
    return f"<meta http-equiv='refresh' content=\"0; url={to}\">"


def test_rules(spark):
    got = judge(
        spark,
        [
            (1, "http://A.Example.NET/en/x?q#f", ""),
            (2, "https://example.net/de/", None),
            (3, "http://notexample.net", ""),
            (4, "http://www.example.com/de/a", ""),
            (5, "http://wikipedia.org/fr/", ""),
            (6, None, ""),
            (7, "no scheme", ""),
            (8, "x://y/://net/", ""),
            (9, "http://net/", ""),
        ],
    )
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("example.net", "/de/", "net/", "block")
    assert got[3] == ("notexample.net", "", None, "allow")
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2:] == ("org/fr/", "allow")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8][:2] == ("y", "/://net/") and got[9][2:] == ("net/", "block")


def test_blocks_reach_aliases_and_allow_goes_first(spark):
    got = judge(
        spark,
        [
            (1, "http://bad.net/home", ""),
            (2, "http://a.edu/1", canonical("http://bad.net/home")),
            (3, "http://a.edu/2", refresh("/1")),
            (4, "http://a.edu/dir/3", canonical("../x")),
            (5, "https://a.edu/2#part", ""),
            (6, "http://b.edu/", canonical("http://bad.net/other")),
            (7, "http://good.org/fr/", canonical("http://bad.net/other")),
            (8, "http://c.edu/", canonical("//gone.net/")),
            (9, "http://a.edu/2?page=2", ""),
        ],
    )
    assert [got[i][3] for i in range(1, 10)] == ["block", "block", "block", "allow", "block", "allow", "allow", "block", "allow"]


def test_repeated_rows_clashes_and_empty_tables(spark):
    rows = [(1, "http://x.net/", canonical("http://y.edu/")), (2, "http://y.edu/", None)]
    assert judge(spark, rows, "host", "path", "rule", "verdict", "alias", "component", "tag")[2][3] == "block"
    assert judge(spark, []) == {}
    assert len(judge(spark, [(i, "http://x.net/", "<link>" * 1000) for i in range(5)])) == 5


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(f"n{rng.randint(0, 300):03d}", f"n{rng.randint(0, 300):03d}") for _ in range(220)]
    edges += [(f"path{i:03d}", f"path{i + 1:03d}") for i in range(200)] + [("hub", f"leaf{i}") for i in range(300)]
    edges += [("loop", "loop"), (None, "x")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    frame = spark.createDataFrame(edges, "a string, b string")
    got = {r["node"]: r["component"] for r in components.connected_components(frame, "a", "b").collect()}
    assert got == {x: find(x) for x in root}
    assert components.connected_components(frame.limit(0), "a", "b").count() == 0
