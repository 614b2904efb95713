"""Connected components and hub-wise pair search over candidate buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gamelake.llm.sieve import may_hold, sieve
from gamelake.llm.tables import Parts, written

#: Ranks up to which a bucket's members have served as hubs after each round.
HUB_STEP = 256


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b).

    Alternating large-star / small-star steps: links shrink to stars around
    each component's smallest id in a logarithmic number of rounds. A round
    is one job of aggregates with map-side combine and equi-joins; the links
    are stars when a round leaves them as they were, told by their count and
    two sums of hashes, which are taken while they are written.
    Nodes without links are not returned; repeated and self links are ignored.
    """
    edges = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter("u <> v").distinct())
    edges, before = _counted(edges)
    while before[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # The larger end's smallest neighbour takes over its other neighbours.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges, now = _counted(small)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _counted(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, with their count and two sums of their hashes."""
    seen = Observation()
    wide = [F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)")) for seed in (1, 2)]
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), wide[0].alias("h1"), wide[1].alias("h2")), "edges")
    return out, (seen.get["n"], seen.get["h1"], seen.get["h2"])


def linked_components(members: DataFrame, check: Callable[[DataFrame], DataFrame],
                      bound: tuple[Callable[[DataFrame], DataFrame], Callable[[str, str], Column]] | None = None,
                      ) -> tuple[DataFrame, DataFrame]:
    """Components of all links between members that share a bucket.

    ``members`` (key, id), distinct rows, is read several times a round: pass a
    written table. ``check`` maps candidate pairs (a, b) to the confirmed ones.
    Round 1 tests each bucket's smallest id against its other members; what it
    links is one component, so later rounds test further hubs only against
    members of other components, until no bucket holds an untested pair from
    two components. No bucket is cut:
    every pair that could join two components is tested, yet a group of
    near copies costs one pair per member instead of all pairs.

    ``bound``: a function of ids (id) that gives them a struct column
    ``profile``, and a condition on two profiles that every linked pair
    meets; later rounds leave out pairs that miss it.

    Returns (id, component) of linked ids and the confirmed links (a, b).
    """
    buckets = members.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top"))
    first = (members.join(buckets.filter("hub <> top").select("key", "hub"), "key").filter("id <> hub")
             .select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())
    links = Parts("links")
    comps = components(links.add(check(first)))
    done, profiles = 1, None
    while True:
        labelled = (members.join(comps, "id", "left")
                    .select("key", "id", F.coalesce("component", "id").alias("c")))
        open_keys = (labelled.groupBy("key").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
                     .filter((F.col("n") > done + 1) & (F.col("lo") != F.col("hi"))).select("key"))
        rest = written(labelled.join(open_keys, "key", "left_semi"), "open")
        if rest.isEmpty():
            return comps, links.all()
        if bound is None:
            rest = rest.withColumn("profile", F.lit(True))
        else:
            if profiles is None:
                profiles = written(bound[0](rest.select("id").distinct()), "profiles")
            rest = rest.join(profiles, "id")
        rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
        upto = done * HUB_STEP
        hubs = (rest.withColumn("r", rank).filter(F.col("r") <= upto).filter(F.col("r") > done)
                .select("key", F.col("id").alias("a"), F.col("c").alias("ca"), F.col("profile").alias("pa")))
        near = bound[1]("profile", "pa") if bound else F.lit(True)
        pairs = (rest.join(hubs, (rest["key"] == hubs["key"]) & (F.col("id") > F.col("a")) & (F.col("c") != F.col("ca")) & near)
                 .select("a", F.col("id").alias("b")).distinct())
        # Pairs of two components are not among the links found so far.
        more = links.add(check(pairs))
        if not more.isEmpty():
            # The stars found so far stand for their links.
            comps = components(more.unionByName(comps.select(F.col("id").alias("a"), F.col("component").alias("b"))))
        done = upto


#: Rows of one key from which the key is dealt over ``SPREAD`` tasks.
HOT, SPREAD = 1000, 64


def join_few(rows: DataFrame, few: DataFrame, key: str, by: str, n: str) -> DataFrame:
    """``rows`` joined with the one row that ``few`` holds for their ``key``.

    ``few`` counts the rows of each key in column ``n``, which goes. Rows of a
    key of ``HOT`` or more are dealt by ``by`` over ``SPREAD`` tasks, each of
    which gets the key's row of ``few``; so no key stands in one task. Both
    sides put the same question to the same sieve, so every row finds its partner.
    """
    hot = sieve(few.filter(F.col(n) >= HOT).select(key), key)
    zero, last = F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long")
    spread = may_hold(hot, F.col(key))
    dealt = rows.withColumn("_part", F.when(spread, F.pmod(F.xxhash64(by), F.lit(SPREAD))).otherwise(zero))
    parts = few.drop(n).withColumn("_part", F.explode(F.when(spread, F.sequence(zero, last)).otherwise(F.array(zero))))
    return dealt.join(parts, [key, "_part"]).drop("_part")
