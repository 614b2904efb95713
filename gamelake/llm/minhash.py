"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text becomes the set of its distinct word shingles (64-bit hashes)
   and a MinHash signature; texts with equal sets form one class.
2. Banded signatures give buckets; candidates are tested hub-wise
   (``graph.linked_components``), so copies never expand into all pairs;
   later rounds skip pairs whose items that no other open text has already
   rule out the threshold.
3. A candidate pair's signatures are compared batch by batch. With a uniform
   prior the similarity's posterior after m of n agreements is
   Beta(m + 1, n - m + 1); the pair is pruned as soon as the posterior
   probability of reaching the threshold is below ``miss``.
4. Survivors are confirmed on their full shingle sets.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm import blocks
from gamelake.llm.graph import components, linked_components
from gamelake.llm.sieve import may_hold, sieve
from gamelake.llm.tables import small_batches, written

BANDS, ROWS = 25, 5
HASHES = 128
#: Hash classes of items whose counts bound an intersection.
CLASSES = 64
_rng = np.random.default_rng(20240817)
_MUL = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)

_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                     ("sig", pa.binary())])
_SETS = pa.schema([("id", pa.int64()), ("sig", pa.binary()), ("items", pa.binary())])


def shingle_sets(block: blocks.Block, k: int):
    """Sorted distinct shingle hashes of each text of a lower-cased block."""
    starts, ends = block.words()
    word = block.hashes(starts, ends)
    first = np.searchsorted(starts, block.offs)  # word number at which each text begins
    n = len(word)
    if n >= k:
        roll = word[: n - k + 1].copy()
        for i in range(1, k):
            roll = blocks.mix64(roll * np.uint64(0xD6E8FEB86659FD93) + word[i: n - k + 1 + i])
    for d in range(len(block)):
        lo, hi = int(first[d]), int(first[d + 1])
        if hi - lo >= k:
            yield blocks.distinct(roll[lo: hi - k + 1])
        elif hi > lo:  # fewer words than a shingle: the whole sequence is one
            h = np.uint64(hi - lo)
            with np.errstate(over="ignore"):
                for w in word[lo:hi]:
                    h = blocks.mix64(np.asarray([h * np.uint64(0xA0761D6478BD642F) + w], dtype=np.uint64))[0]
            yield np.asarray([h], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def signature(items: np.ndarray) -> np.ndarray:
    x = (items >> np.uint64(32)).astype(np.uint32)[:, None]
    sig = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(sig, (x[i: i + 256] * _MUL + _ADD).min(axis=0), out=sig)
    return sig


def _sketches(k: int, with_sets: bool):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in blocks.text_blocks(batch.column(1), blocks.LOWER_AZ):
                sizes, f1, f2, sigs, sets = [], [], [], [], []
                for items in shingle_sets(block, k):
                    sizes.append(len(items))
                    mixed = blocks.mix64(items)
                    f1.append(mixed.sum(dtype=np.uint64).astype(np.int64))
                    f2.append(blocks.mix64(mixed ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                    sigs.append(signature(items).tobytes() if len(items) else b"")
                    if with_sets:
                        sets.append(items.tobytes())
                own = ids.slice(block.lo, len(block))
                cols = [own, pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())] if with_sets else \
                    [own, pa.array(sizes, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                     pa.array(sigs, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, schema=_SETS if with_sets else _SKETCH)

    return run


def _items(batches):
    """(id, item) for each item of each set."""
    for batch in batches:
        for i in range(batch.num_rows):
            items = np.frombuffer(batch.column("items")[i].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(items), batch.column("id")[i].as_py(), np.int64)),
                                              pa.array(items)], names=["id", "item"])


def agreement_floor(threshold: float, miss: float, batch: int) -> list[tuple[int, int]]:
    """(n, least m) per comparison batch: with fewer than m agreements among the
    first n hashes, P(similarity >= threshold) is under ``miss``."""
    floor = []
    for n in range(batch, HASHES + 1, batch):
        total, least = 0.0, n + 1
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                least = m
                break
        floor.append((n, least))
    return floor


def _verified(percent: int, miss: float, batch: int):
    floor = agreement_floor(percent / 100, miss, batch)

    def run(batches):
        for rows in batches:
            n = rows.num_rows
            if not n:
                continue
            a, b, sig_a, sig_b, set_a, set_b = rows.columns
            one = np.frombuffer(b"".join(sig_a.to_pylist()), np.uint32).reshape(n, HASHES)
            two = np.frombuffer(b"".join(sig_b.to_pylist()), np.uint32).reshape(n, HASHES)
            alive = np.arange(n)
            agreed = np.zeros(n, dtype=np.int64)
            done = 0
            for upto, least in floor:
                agreed[alive] += (one[alive, done:upto] == two[alive, done:upto]).sum(axis=1)
                alive = alive[agreed[alive] >= least]
                done = upto
            kept = []
            for i in alive.tolist():
                x = np.frombuffer(set_a[i].as_py(), np.uint64)
                y = np.frombuffer(set_b[i].as_py(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([a.take(pa.array(kept, pa.int64())), b.take(pa.array(kept, pa.int64()))],
                                             names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = 1e-6, batch: int = 16) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links, kept) for every row of ``docs``.

    ``docs`` needs doc_id (long) and text; other columns are ignored, whatever
    their names. Sets with ``100 * intersection >= percent * union`` are
    linked; component_id is the smallest doc_id reachable; n_links counts the
    confirmed links of the text's class, besides its equal sets.

    Null or wordless texts have an empty set (n_shingles 0) and are linked
    with nothing. A text of fewer than ``k`` words is one shingle. Rows that
    repeat a doc_id with equal sets get the same answer; where the texts
    differ, each row's own set decides and the id counts as linked to both.
    A null doc_id takes no part: component_id null, kept true. An empty table
    gives an empty result.

    Chance that a pair exactly at 0.8 shares no band: (1 - 0.8**5)**25 = 5e-5.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = written(text.mapInArrow(_sketches(k, False), "doc_id long, n_shingles long, f1 long, f2 long, sig binary"),
                       "sketches")
    live = sketches.filter("n_shingles > 0 and doc_id is not null")
    classes = written(live.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")

    heads = live.join(classes.select(F.col("rep").alias("doc_id"), "f1", "f2", "n_shingles"),
                      ["doc_id", "f1", "f2", "n_shingles"], "left_semi")
    size = 4 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", b * size + 1, size)) for b in range(BANDS)])
    banded = heads.select(F.explode(keys).alias("key"), F.col("doc_id").alias("id"))
    shared = banded.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi").select("key")
    members = written(banded.join(shared, "key", "left_semi").distinct(), "buckets")

    needed = written(members.select("id").distinct(), "needed")
    sets = written(text.filter(may_hold(sieve(needed, "id"), F.col("doc_id"))).join(needed, F.col("doc_id") == F.col("id"), "left_semi")
                   .mapInArrow(_sketches(k, True), "id long, sig binary, items binary").dropDuplicates(["id", "items"]), "sets")
    verify = _verified(percent, miss, batch)

    def check(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"), F.col("items").alias("set_a"))
        two = sets.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"), F.col("items").alias("set_b"))
        rows = pairs.join(one, "a").join(two, "b").select("a", "b", "sig_a", "sig_b", "set_a", "set_b")
        small_batches(spark, 200)
        found = written(rows.mapInArrow(verify, "a long, b long").distinct(), "verified")
        small_batches(spark)
        return found

    def profiles(ids: DataFrame) -> DataFrame:
        """Least set size, and by hash class of the items how many another of ``ids`` has too."""
        own = sets.join(ids, "id", "left_semi")
        items = own.mapInArrow(_items, "id long, item long")
        common = items.groupBy("item").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi").select("item")
        counts = (items.join(common, "item", "left_semi").distinct().groupBy("id", F.col("item").bitwiseAND(F.lit(CLASSES - 1)).alias("g"))
                  .agg(F.count("*").alias("n")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("g", "n"))).alias("by")))
        shared = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(CLASSES - 1).cast("long")),
                             lambda g: F.coalesce(F.try_element_at("by", g), F.lit(0).cast("long")).cast("int"))
        return (own.groupBy("id").agg(F.min((F.octet_length("items") / 8).cast("long")).alias("least")).join(counts, "id", "left")
                .select("id", F.struct("least", shared.alias("shared")).alias("profile")))

    def within(x: str, y: str):
        """Upper bound of the similarity: class by class, at best one's shared items are among the other's."""
        common = F.aggregate(F.zip_with(F.col(f"{x}.shared"), F.col(f"{y}.shared"), lambda p, q: F.least(p, q)), F.lit(0), lambda s, n: s + n)
        return 100 * common >= percent * (F.col(f"{x}.least") + F.col(f"{y}.least") - common)

    # A doc_id that repeats with different texts ties its classes together.
    several = (live.join(classes, ["f1", "f2", "n_shingles"]).groupBy("doc_id")
               .agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b").select("a", "b"))
    comps, links = linked_components(members, check, (profiles, within))
    if not several.isEmpty():
        links = written(links.unionByName(several).distinct(), "links")
        comps = components(links)
    degree = (links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links")))
    known = (classes.join(comps, classes.rep == comps.id, "left").join(degree, "rep", "left")
             .select("f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("c"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    base = sketches.select("doc_id", "n_shingles", "f1", "f2")
    return (base.join(known, ["f1", "f2", "n_shingles"], "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("c")))
                        .otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the one kept of its group."""
    kept = near_duplicates(docs, **options).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(kept, docs["doc_id"] == kept["_gone"], "left_anti")
