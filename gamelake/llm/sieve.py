"""A hash filter of fixed size that keeps rows without a partner out of a join's shuffle.

It only saves work: every row that has a partner passes, however many values
are marked. Its size does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filter has 2**SIEVE_BITS bits (1 MB).
SIEVE_BITS = 23


def sieve(keys: DataFrame, name: str) -> DataFrame:
    """One row with a bit array (fixed size) in which each value of column ``name`` has its bit set."""
    words = 1 << (SIEVE_BITS - 6)
    bit = F.pmod(F.xxhash64(F.lit("sieve"), name), F.lit(1 << SIEVE_BITS))
    marks = keys.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits"))
    slots = keys.sparkSession.range(words).join(marks, F.col("id") == F.col("word"), "left")
    return slots.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
                                 lambda s: s["bits"]).alias("words"))


def may_hold(marks: DataFrame, column: Column) -> Column:
    """Whether the value may be among the marked ones (never false for one that is)."""
    bit = F.pmod(F.xxhash64(F.lit("sieve"), column), F.lit(1 << SIEVE_BITS))
    word = F.get(marks.scalar(), F.shiftright(bit, 6).cast("int"))
    return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))) != 0
