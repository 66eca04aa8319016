import random
from itertools import permutations
from math import factorial

import duckdb
import pandas as pd
import pytest

from tellerloom.llm import filter_audit, oracle
from tests.comparing import rows, spark_rows
from tests.llm.odd import no_documents, odd_documents

LABELS = "doc_id long, quality int, toxic int, source string"


def made(n: int, seed: int) -> list[tuple]:
    """Few texts under many ids, some null or repeated, in parts of very different size."""
    rng = random.Random(seed)
    words = ["a", "B", "c#", "dd", "ÉÉ", "x" * 30]
    texts = [None, "", " \t", "ABC", "#"] + [
        " ".join(rng.choices(words[: rng.randint(1, 6)], k=rng.randint(40, 70))) for _ in range(20)
    ] + [" ".join(f"w{i}" for i in range(k)) for k in (49, 50, 51)]
    parts = [None, "", "s", "s", "s", "t"]
    return [
        (rng.choice([None, *[rng.randint(-5, n)] * 9]), rng.choice(texts), rng.choice(parts))
        for _ in range(n)
    ]


def test_report_of_odd_rows_is_that_of_sql(spark):
    docs = made(400, 1)
    rng = random.Random(2)
    marks = [
        (rng.choice([None, i, i, i + 1]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]), "x")
        for i in range(-5, 300)
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS good", "2 AS failed", "'x' AS part", "3 AS `key`", "4 AS spread", "5 AS same", "6 AS id"
    )
    columns, got = spark_rows(filter_audit.audit(frame, spark.createDataFrame(marks, LABELS)))
    duck = duckdb.connect()
    ids = {"doc_id": "Int64"}
    documents = pd.DataFrame(docs, columns=["doc_id", "text", "source"]).astype(ids)
    labels = pd.DataFrame(marks, columns=["doc_id", "quality", "toxic", "s"]).astype(
        {**ids, "quality": "Int64", "toxic": "Int64"}
    )
    duck.register("documents", documents)
    duck.register("labels", labels)
    cursor = duck.execute(oracle.FILTER_AUDIT)
    names = [c[0] for c in cursor.description]
    assert columns == sorted(names)
    assert got == rows(names, cursor.fetchall())
    assert len(got) == 3 * 120 * 5


@pytest.mark.parametrize("n", [1, 3, 4])
def test_potential_gives_the_shapley_value(spark, n):
    rng = random.Random(n)
    counts = [
        (part, failed, rng.randint(0, 10**12), 0, 0)
        for part in ("p", "q")
        for failed in range(1 << n)
        if rng.random() < 0.8
    ]
    frame = spark.createDataFrame(
        counts, "part string, failed int, documents long, good long, toxic long"
    )
    names = [f"filter{i}" for i in range(n)]
    got = {(r.part, r["filter"]): r for r in filter_audit.report(frame, names).collect()}

    def value(part, filters):
        return sum(c[2] for c in counts if c[0] == part and any(c[1] >> i & 1 for i in filters))

    for (part, name), row in got.items():
        i = names.index(name)
        orders = [order[: order.index(i)] for order in permutations(range(n))]
        want = sum(value(part, (*before, i)) - value(part, before) for before in orders)
        assert row.shapley == want
    assert len(got) == 2 * n
    total = sum(got["p", name].shapley for name in names)
    assert total == factorial(n) * value("p", range(n))


def test_removals_of_an_order_add_up(spark):
    labels = spark.createDataFrame([], LABELS)
    rows = filter_audit.audit(odd_documents(spark), labels).collect()
    assert {r.part for r in rows} == {""} and len(rows) == 600
    for order in {r.filter_order for r in rows}:
        steps = sorted((r for r in rows if r.filter_order == order), key=lambda r: r.step)
        left = 13
        for r in steps:
            left -= r.removed
            assert (r.kept, r.good_lost, r.toxic_lost) == (left, 0, 0)
            assert r["filter"] == order[r.step - 1]


def test_no_documents_and_too_many_filters(spark):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(no_documents(spark), labels).count() == 0
    with pytest.raises(ValueError):
        filter_audit.report(None, "ABCDEFG")


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame(made(50, 3), "doc_id long, text string, source string")
    plan = filter_audit.audit(frame, spark.createDataFrame([], LABELS))
    assert "Python" not in plan._jdf.queryExecution().toString()
