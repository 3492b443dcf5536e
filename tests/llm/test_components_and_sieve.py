import random

import pytest

from roadflux.llm.components import connected_components
from roadflux.llm.sieve import with_maybe


def union_find(links):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for u, v in links:
        if u is not None and v is not None and u != v:
            a, b = root(u), root(v)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


CASES = [
    [], [(1, 1)], [(None, 2), (3, None)], [(5, 3), (3, 5), (5, 3)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(60, i) for i in range(60)], [(i, (i * 7 + 3) % 90) for i in range(90)], [(-(2**62), 2**62), (2**62, 0), (7, 8)],
]


@pytest.mark.parametrize("links", CASES, ids=range(len(CASES)))
def test_components(spark, links):
    df = spark.createDataFrame(links, "u bigint, v bigint")
    assert {r.node: r.component for r in connected_components(df).collect()} == union_find(links)


def test_components_of_a_random_forest(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)]
    got = connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.component for r in got} == union_find(links)


def test_components_that_do_not_settle_raise(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "u bigint, v bigint")
    with pytest.raises(RuntimeError):
        connected_components(chain, max_rounds=1)


def test_sieve_has_no_false_negative(spark):
    members = spark.range(0, 900).selectExpr("id * 7 as k")
    rows = with_maybe(spark.range(0, 9000), "id", members, "k", "may")
    assert rows.columns == ["id", "may"] and rows.count() == 9000
    assert rows.where("id % 7 = 0 and id < 6300 and not may").count() == 0
    assert rows.where("may").count() < 950
    assert with_maybe(spark.range(5), "id", members.limit(0), "k", "may").where("may").count() == 0
