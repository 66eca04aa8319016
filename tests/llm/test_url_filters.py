import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tellerloom.llm import oracle, url_filters
from tellerloom.staging import Staging
from tests.comparing import rows, spark_rows

SCHEMA = "page_id long, url string, html string"
HOSTS = [f"h{i}.example.{t}" for i in range(20) for t in ("com", "net", "org")] + ["a.io", "B.io"]
URLS = [None, "", "nourl", "HTTP://A.io/En/", "http://x.net", "http://net/a", "x://example.com/de/?q"]
URLS += ["a://b://c.net/x", "http://myexample.com/de/1", "http://www.example.net/en/1", "http://\n.net/"]


def made(n: int, seed: int, hosts=HOSTS) -> list[tuple]:
    rng = random.Random(seed)

    def address():
        return f"{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{rng.randint(1, 9)}"

    def link():
        name, mark = rng.choice(["href", "HREF"]), rng.choice(["", "'", '"'])
        scheme = rng.choice(["http://", "https://", "//"])
        return f"<p><a class=x {name}={mark}{scheme}{address()}{mark}> x</a>"

    def html():
        found = "".join(link() for _ in range(rng.randint(0, 4)))
        return rng.choice([found, found, found, "<a href='/own'>", "", None])

    return [
        (
            rng.choice([None, i, i, i]),
            rng.choice([f"http://{address()}?x#y"] * 12 + [rng.choice(URLS)]),
            html(),
        )
        for i in range(n)
    ]


def in_sql(pages: list[tuple]) -> tuple[list[str], list[tuple]]:
    duck = duckdb.connect()
    frame = pd.DataFrame(pages, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"})
    duck.register("pages", frame)
    cursor = duck.execute(oracle.URL_VERDICTS)
    names = [c[0] for c in cursor.description]
    return names, rows(names, cursor.fetchall())


def test_verdicts_are_those_of_sql(spark):
    pages = made(300, 1) + made(100, 2, HOSTS[:3])
    pages += pages[:5]
    frame = spark.createDataFrame(pages, SCHEMA).selectExpr(
        "*", "1 AS host", "'x' AS verdict", "2 AS kind", "3 AS slice", "4 AS place", "5 AS score"
    )
    columns, got = spark_rows(url_filters.verdicts(frame, slice_links=2))
    names, expected = in_sql(pages)
    assert columns == sorted(names)
    assert got == expected
    judged = [r for r in got if r[4] is None]
    assert {r[6] for r in judged} == {"allow", "block"}


def test_hosts_paths_and_rules(spark):
    cases = {
        "https://WWW.Example.NET/en/1?q#f": ("www.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/EN/1": ("example.net", "/EN/1", "net/", "block"),
        "http://example.com?/de/": ("example.com", "", None, None),
        "http://a.example.com/de/x?y": ("a.example.com", "/de/x", "example.com/de/", "block"),
        "http://badexample.com/de/x": ("badexample.com", "/de/x", None, None),
        "http://ÄB.org/fr/#": ("Äb.org", "/fr/", "org/fr/", "allow"),
        "http://net": ("net", "", None, None),
        "//x.net/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    pages = spark.createDataFrame([(u, 1) for u in cases], "url string, _ruled int")
    got = {r.url: tuple(r.place) for r in url_filters.judged(pages.drop("_ruled")).collect()}
    assert got == cases


def test_longest_rule_wins_and_the_first_of_equals(spark):
    rules = [("block", "a.b/"), ("allow", "b/xyz/"), ("allow", "b/xy"), ("block", "c/1"), ("allow", "c/1")]
    pages = spark.createDataFrame([("s://a.b/xyz/1",), ("s://a.b/xy",), ("s://c/12",)], "url string")
    got = [r.place.rule for r in url_filters.judged(pages, rules).collect()]
    assert got == ["b/xyz/", "a.b/", "c/1"]
    assert url_filters.judged(pages, rules).collect()[2].place.verdict == "block"
    with pytest.raises(ValueError):
        url_filters.rule_of(F.col("h"), F.col("p"), [("block", f"h{i}/") for i in range(999)])


def test_distrust_runs_against_the_links_and_trust_along_them(spark):
    known = spark.createDataFrame(
        [("spam", "block", 2), ("good", "allow", 3), ("farm", None, 1)], "host string, verdict string, n long"
    )
    edges = spark.createDataFrame(
        [("farm", "spam"), ("hub", "farm"), ("good", "near"), ("near", "far"), ("spam", "victim")],
        "source string, target string",
    )
    scores = {
        r.host: (r.trust, r.distrust)
        for r in url_filters.host_scores(known, edges, Staging(spark)).collect()
    }
    assert scores == {
        "spam": (0, 150_000),
        "farm": (0, 127_500),
        "hub": (0, 108_375),
        "good": (150_000, 0),
        "near": (127_500, 0),
        "far": (108_375, 0),
    }


def test_no_pages_and_pages_without_links(spark):
    assert url_filters.verdicts(spark.createDataFrame([], SCHEMA)).count() == 0
    pages = [(1, "http://a.io/x", None), (1, "http://a.io/x", None), (None, None, None)]
    rows = url_filters.verdicts(spark.createDataFrame(pages, SCHEMA)).collect()
    assert [r.verdict for r in rows] == ["allow"] * 3
