"""Components, links found in rounds, and joins on keys of very unequal size, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from gamelake.llm import graph
from gamelake.llm.tables import written


def smallest_reachable(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(99, i) for i in range(1, 50)],
    [(random.Random(5).randrange(60 + s), random.Random(s).randrange(60)) for s in range(45)] * 2])
def test_components(spark, links):
    rows = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = smallest_reachable(links)
    assert {r["id"]: r["component"] for r in rows} == {x: c for x, c in want.items() if x != c}
    assert len(rows) == len({r["id"] for r in rows})


def test_rounds_join_all_components(spark, monkeypatch):
    """Numbers 7 apart are linked, one bucket holds all: hubs of many rounds are needed."""
    monkeypatch.setattr(graph, "HUB_STEP", 3)
    members = written(spark.createDataFrame([(0, i) for i in range(50)], "key long, id long"), "members")
    comps, links = graph.linked_components(members, lambda pairs: pairs.filter((F.col("b") - F.col("a")) == 7))
    found = {(r["a"], r["b"]) for r in links.collect()}
    assert found <= {(i, i + 7) for i in range(43)} and links.count() == len(found)
    assert {r["id"]: r["component"] for r in comps.collect()} == {i: i % 7 for i in range(7, 50)}


def test_join_few_with_a_hot_key(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"))
    few = rows.groupBy("k").agg(F.max("id").alias("top"), F.count("*").alias("n"))
    got = graph.join_few(rows, written(few, "few"), "k", "id", "n").select("id", "k", "top").collect()
    assert sorted((r["id"], r["top"]) for r in got) == [(i, 3999 if i < 4000 else i) for i in range(5000)]
    assert graph.join_few(rows.limit(0), written(few.limit(0), "few"), "k", "id", "n").count() == 0
