"""Centroid clustering against plain integer Lloyd rounds; the query against DuckDB."""

import hashlib
import math
import random

import duckdb

from gamelake.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>, cluster string, inertia int"


def plain(rows, k, rounds, dimensions):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
               if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) and abs(64 * x) < 2**27 for x in v)]
    seeds = sorted(vectors, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    heads = [v for _, v in seeds]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(heads))

    for _ in range(rounds):
        members = {}
        for _, v in vectors:
            members.setdefault(near(v)[1], []).append(v)
        heads = [[sum(col) // len(members[j]) for col in zip(*members[j])] if j in members else c for j, c in enumerate(heads)]
    final = [(i, *near(v)) for i, v in vectors]
    sums = {j: sum(d for _, d, c in final if c == j) for j in range(len(heads))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in heads]
    return sorted([(i, c, d, sums[c], sum(sums.values()), names[c]) for i, d, c in final], key=str)


def got(spark, rows, k, rounds, dimensions):
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = centroids.cluster(vectors, k, rounds, dimensions=dimensions)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted([tuple(r) for r in out.collect()], key=str)


def float32(x):
    import numpy as np
    return float(np.float32(x))


def test_equals_plain_rounds(spark):
    rng = random.Random(3)
    rows = [(i, [float32(rng.gauss(i % 5, 1)) for _ in range(6)]) for i in range(300)]
    assert got(spark, rows, 8, 3, 6) == plain(rows, 8, 3, 6)


def test_edge_rows(spark):
    rng = random.Random(5)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float32(rng.uniform(-2, 2)), float32(rng.uniform(-2, 2))]) for i in range(20)]
    rows += rows[:3] + [(None, [1.0, 1.0]), (None, [1.0, 1.0]), (30, None), (31, []), (32, [1.0]), (33, [1.0, 2.0, 3.0]), (34, [1.0, None]),
                        (35, [nan, 1.0]), (36, [1.0, inf]), (37, [1.0, -inf]), (38, [3e38, 1.0]), (39, [0.0, -0.0]), (40, [-0.001, 0.001])]
    assert got(spark, rows, 4, 3, 2) == plain(rows, 4, 3, 2)
    assert got(spark, rows[:3], 16, 3, 2) == plain(rows[:3], 16, 3, 2)  # fewer vectors than centroids
    ties = [(i, [0.0, 0.0]) for i in range(9)]  # equal vectors: the later centroids stay empty
    assert got(spark, ties, 4, 3, 2) == plain(ties, 4, 3, 2)
    assert got(spark, [(1, None)], 4, 3, 2) == [] and got(spark, [], 4, 3, 2) == []


def test_no_python_in_the_plan(spark):
    vectors = spark.createDataFrame([(1, [0.5, 1.0])], "vec_id long, embedding array<float>")
    plan = centroids.integers(vectors, 2).select(centroids.nearest([[1, 2], [3, 4]]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_against_sql(spark, sf):
    duckdb.execute(f"create or replace view embeddings as select * from '{sf}/embeddings.parquet'")
    want = duckdb.execute(queries.OP13_SQL)
    names = [d[0] for d in want.description]
    rows = want.fetchall()
    assert sorted(map(tuple, queries.op13_centroid_clusters(spark, sf).select(*names).collect())) == sorted(rows) and rows
