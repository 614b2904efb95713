"""Temperature mixing of sources, realised as budgeted block permutations.

With token shares p, the mix has weights w ~ p**x. The exponent x in [0, 1]
(1: shares as they are, 0: uniform) is bisected to the largest that reaches a
target entropy, or the smallest whose epochs stay within a repetition limit.
The budget lets the most plentiful source (against its weight) pass exactly
once, so no document is lost and scarcer sources repeat.

An epoch of a source is a permutation of its documents by a 60-bit hash of
(seed, epoch, doc_id), dealt in ``BLOCKS`` blocks (the hash's top bits). All
epochs but the last are whole; the last is cut at the hash up to which its
tokens fit the source's rest of budget. The cut is found by block sums, then
by sums within the one block that holds it, so no task sees a whole source
and the text is read twice, never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gamelake.llm.tables import written

SEED = "mix"
BITS = 12
BLOCKS = 1 << BITS
SECTIONS = 64
ROUNDS = 7


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(doc_id: Column, epoch: Column) -> Column:
    """60-bit place of a document in an epoch's permutation."""
    name = F.concat_ws(":", F.lit(SEED), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def _source_key(source: Column) -> Column:
    """Sources as non-null keys (a null source is a source of its own)."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def solve_exponent(shares: DataFrame, target_entropy: float | None, max_repeats: float | None) -> float:
    """Exponent for (p) shares; a few bounded aggregates, ``SECTIONS`` trial values each.

    ``target_entropy``: share of the greatest entropy (of uniform weights).
    ``max_repeats``: most epochs of any source.
    """
    ends = shares.agg(F.min("p").alias("least"), F.max("p").alias("most"), F.count("*").alias("n")).first()
    if ends["n"] < 2:
        return 1.0
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        trial = [lo + (hi - lo) * i / SECTIONS for i in range(SECTIONS + 1)]
        if target_entropy is not None:
            sums = (shares.select("p", F.explode(F.array(*[F.lit(x) for x in trial])).alias("x")).groupBy("x")
                    .agg(F.sum(F.pow("p", "x")).alias("z"), F.sum(F.pow("p", "x") * F.log("p")).alias("s")))
            good = {r["x"]: r["ok"] for r in sums.select(
                "x", ((F.log("z") - F.col("x") * F.col("s") / F.col("z")) >= target_entropy * F.log(F.lit(float(ends["n"])))).alias("ok")).collect()}
            top = max((i for i, x in enumerate(trial) if good[x]), default=0)
            if top == SECTIONS:
                return hi
            lo, hi = trial[top], trial[top + 1]
        else:
            spread = ends["most"] / ends["least"]
            top = min((i for i, x in enumerate(trial) if spread ** (1.0 - x) <= max_repeats), default=SECTIONS)
            if top == 0:
                return lo
            lo, hi = trial[top - 1], trial[top]
    return lo if target_entropy is not None else hi


def plan(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None) -> tuple[DataFrame, float]:
    """(skey, tokens, weight, quota, whole, cut) per source with words, and the exponent.

    ``whole`` epochs of every document and one more of those whose place in
    the epoch after is at most ``cut`` (-1: none).
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either target_entropy or max_repeats")
    if max_repeats is not None and max_repeats < 1:
        raise ValueError("max_repeats is at least 1")
    narrow = written(docs.select(_source_key(F.col("source")).alias("skey"), F.col("doc_id").alias("doc_id"),
                                 words_of(F.col("text")).alias("tokens")), "tokens")
    totals = narrow.groupBy("skey").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    whole = totals.agg(F.sum("tokens").alias("all")).first()["all"] or 0
    shares = written(totals.withColumn("p", F.col("tokens") / F.lit(float(whole or 1))), "shares")
    x = solve_exponent(shares, target_entropy, max_repeats)
    sums = shares.agg(F.sum(F.pow("p", F.lit(x))).alias("z"), F.max("p").alias("most")).first()
    z, most = sums["z"] or 1.0, sums["most"] or 1.0
    budget = whole * z * most ** (1.0 - x)
    quotas = (shares.withColumn("weight", F.pow("p", F.lit(x)) / F.lit(z))
              .withColumn("quota", F.round(F.col("weight") * F.lit(budget)).cast("long"))
              .withColumn("whole", F.floor(F.col("quota") / F.col("tokens")).cast("long"))
              .withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens")))
    # Block sums of the last epoch, the block where the rest runs out, then that block's documents.
    placed = (narrow.join(quotas.select("skey", "whole", "rest"), "skey")
              .select("skey", "rest", "tokens", order_key(F.col("doc_id"), F.col("whole")).alias("place"))
              .withColumn("block", F.shiftright("place", 60 - BITS)))
    running = Window.partitionBy("skey").orderBy("block")
    blocks = (placed.groupBy("skey", "rest", "block").agg(F.sum("tokens").alias("sum"))
              .withColumn("upto", F.sum("sum").over(running)))
    first = (blocks.filter(F.col("upto") > F.col("rest")).groupBy("skey")
             .agg(F.min("block").alias("block"), F.min(F.col("upto") - F.col("sum")).alias("before")))
    inner = (placed.join(first, ["skey", "block"])
             .withColumn("upto", F.col("before") + F.sum("tokens").over(Window.partitionBy("skey").orderBy("place")))
             .filter(F.col("upto") <= F.col("rest")).groupBy("skey").agg(F.max("place").alias("inside")))
    cut = first.join(inner, "skey", "left").select(
        "skey", F.coalesce("inside", F.shiftleft(F.col("block").cast("long"), 60 - BITS) - 1).alias("cut"))
    done = (quotas.join(cut, "skey", "left")
            .select("skey", "tokens", "weight", "quota", "whole", F.coalesce("cut", F.lit(-1).cast("long")).alias("cut")))
    return written(done, "quotas"), x


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None) -> DataFrame:
    """``docs`` once per epoch that takes the document, with mix_epoch, mix_block, mix_order.

    Training order: by mix_epoch, then mix_block and mix_order, source beside
    source. Tokens are words ``[^\\x20\\x09-\\x0D]+``. Null is a source like any
    other; documents of sources without a word (null and empty texts only)
    pass once in epoch 0. Rows that repeat a doc_id within a source share
    their places and are taken or left together; a null doc_id has one place
    per epoch. One source alone passes once. An empty table gives no rows.
    Columns of ``docs`` named like the three new ones are replaced.
    """
    quotas, _ = plan(docs, target_entropy, max_repeats)
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_doc"), _source_key(docs["source"]).alias("skey"))
    taken = packed.join(quotas.select("skey", "whole", "cut"), "skey", "left")
    whole = F.coalesce("whole", F.lit(1).cast("long"))
    more = F.when(order_key(F.col("_doc.doc_id"), whole) <= F.coalesce("cut", F.lit(-1).cast("long")), 1).otherwise(0)
    rows = (taken.withColumn("_n", whole + more).filter("_n > 0")
            .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))))
    place = order_key(F.col("_doc.doc_id"), F.col("mix_epoch"))
    return rows.select(*[F.col("_doc")[c].alias(c) for c in names if c not in ("mix_epoch", "mix_block", "mix_order")],
                       "mix_epoch", F.shiftright(place, 60 - BITS).alias("mix_block"), place.alias("mix_order"))
