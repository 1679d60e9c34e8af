from pyspark.sql import functions as F

from cartlane.llm import urls


def judged(spark, pages, outcomes=()):
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("n", F.lit(1))
    known = spark.createDataFrame(list(outcomes), "id long, bad int")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_pages(df, known).collect()}


def test_hosts_paths_and_rules(spark):
    got = judged(
        spark,
        [
            (1, "https://WWW.Example.NET/en/a?b#c"), (2, "http://example.net/de/"), (3, "x://example.com/de/1"),
            (4, "http://badexample.com/de/1"), (5, "http://a.org/fr/?x"), (6, "http://a.org/FR/"), (7, "http://net"),
            (8, "http://net/"), (9, None), (10, "no scheme"), (11, ""), (12, "a://b://c/d"), (13, "http://É.org?x/y"),
            (14, "http://h\n.net/é#"), (15, "://x.org#/fr/"),
        ],
    )
    assert got == {
        1: ("www.example.net", "/en/a", "example.net/en/", "allow"),
        2: ("example.net", "/de/", "net/", "block"),
        3: ("example.com", "/de/1", "example.com/de/", "block"),
        4: ("badexample.com", "/de/1", None, "allow"),
        5: ("a.org", "/fr/", "org/fr/", "allow"),
        6: ("a.org", "/FR/", None, "allow"),
        7: ("net", "", None, "allow"),
        8: ("net", "/", "net/", "block"),
        9: ("", "", None, "allow"),
        10: ("", "", None, "allow"),
        11: ("", "", None, "allow"),
        12: ("b:", "//c/d", None, "allow"),
        13: ("É.org", "", None, "allow"),
        14: ("h\n.net", "/é", "net/", "block"),
        15: ("x.org", "", None, "allow"),
    }


def test_reputation_shrinks_to_domain_and_suffix(spark):
    pages, outcomes = [], []
    for d in range(30):
        for h in range(4):
            for p in range(6):
                n = len(pages)
                pages.append((n, f"http://h{h}.dom{d}.org/{p}"))
                if h < 3:
                    outcomes.append((n, int(d < 5)))
    pages.append((9999, "http://new.other.org/"))
    got = judged(spark, pages, outcomes)
    blocked = {v[0] for v in got.values() if v[3] == "block"}
    # Bad domains are blocked, also their host without a label; a single bad page would not do.
    assert {f"h{h}.dom{d}.org" for d in range(5) for h in range(3)} <= blocked
    assert not any(f".dom{d}.org" in h for d in range(5, 30) for h in blocked)
    assert got[9999][3] == "allow"


def test_posterior_is_the_beta_binomial(spark):
    hosts = spark.createDataFrame([("a.x.org", 10, 9), ("b.x.org", 0, 0), ("c.y.org", 4, 0)], "host string, n long, bad long")
    got = {r["host"]: r for r in urls.host_reputation(hosts).collect()}
    assert got["a.x.org"]["mean"] > got["b.x.org"]["mean"] > got["c.y.org"]["mean"]
    assert all(r["bound"] < r["mean"] for r in got.values())
    assert got["b.x.org"]["bound"] < got["a.x.org"]["bound"]


def test_suffixes(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("localhost",), ("",), ("x.y.com",)], "h string")
    got = [tuple(r) for r in df.select(urls.domain_of(F.col("h")), urls.suffix_of(F.col("h"))).collect()]
    assert got == [("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("localhost", "localhost"), ("", ""), ("y.com", "com")]


def test_empty(spark):
    assert judged(spark, []) == {}


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = urls.judge_pages(pages, spark.createDataFrame([(1, 1)], "id long, bad int"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
