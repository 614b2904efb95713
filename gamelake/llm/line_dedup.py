"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

Two lines within ``max_edits`` edits: cut the shorter into ``max_edits + 1``
segments, and one of them stands unchanged in the longer, at a place that the
lengths and the segment's number leave few choices for. Every line therefore
gets one key per (length of the shorter line, segment number, substring); lines
that share a key are candidates (``graph.linked_components``), filtered by
letter counts and confirmed by a banded bit-parallel edit distance.
Equal lines are one class from the start. Of each component of linked lines
the first line of the document with the smallest doc_id stays; with ``direct``,
so does every line that is near no earlier line that stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.graph import join_few, linked_components
from gamelake.llm.sieve import may_hold, sieve
from gamelake.llm.tables import Parts, written

#: Edits allowed between near lines.
MAX_EDITS = 2
#: Shorter lines (code points) are joined only if equal: two edits would be too large a part of them.
MIN_CHARS = 20
#: Letter classes whose counts differ by at most 2 * edits in near lines.
_CLASSES = (*"abcdefghijklmnopqrstuvwxyz", " .,", "0123456789")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line, h, h2): the distinct worded lines of each row, in order."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = text.select("doc_id", F.posexplode(F.array_distinct(F.split("text", "\n"))).alias("pos", "line"))
    return (found.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
            .select("doc_id", "pos", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2")))


def segment_keys(lines: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, h): the keys each line (h, line, n code points) is listed and looked up under.

    One row per choice of (how many code points shorter the shorter line is,
    segment, shift of the segment), computed row by row in generated code.
    """
    parts = max_edits + 1
    choices = F.array(*[F.struct(F.lit(less).alias("less"), F.lit(i).alias("i"), F.lit(move).alias("move"))
                        for less in range(max_edits + 1) for i in range(parts)
                        for move in range(max(-i, less - (max_edits - i)), min(i, less + (max_edits - i)) + 1)])
    rows = lines.select("h", "line", "n", F.explode(choices).alias("c")).select(
        "h", "line", "n", (F.col("n") - F.col("c.less")).alias("length"), F.col("c.i").alias("i"), F.col("c.move").alias("move"))
    base = F.expr(f"cast(length div {parts} as int)")
    plain = F.lit(parts) - F.col("length") % parts  # so many segments of the base length come first
    size = base + F.when(F.col("i") >= plain, 1).otherwise(0)
    at = base * F.col("i") + F.greatest(F.lit(0), F.col("i") - plain) + 1 + F.col("move")
    return (rows.filter(F.col("length") >= min_chars).filter((at >= 1) & (at + size - 1 <= F.col("n")))
            .select(F.xxhash64("length", "i", F.substring("line", at, size)).alias("key"), "h"))


def within_edits(a: Column, b: Column, max_edits: int = MAX_EDITS) -> Column:
    """Whether two strings are within ``max_edits`` edits, by a banded bit-parallel distance.

    The bits of two longs hold the vertical steps (+1 and -1) of the band of
    2 * max_edits + 1 diagonals, which moves down the longer string by one per
    character of the shorter; the distance is read off at the band's lowest
    diagonal, then along the last row.
    """
    width = 2 * max_edits + 2
    full = (1 << width) - 1
    swap = F.char_length(a) >= F.char_length(b)
    one, two = F.split(F.when(swap, a).otherwise(b), ""), F.split(F.when(swap, b).otherwise(a), "")
    n_one, n_two = F.greatest(F.char_length(a), F.char_length(b)), F.least(F.char_length(a), F.char_length(b))
    top, side = 1 << (width - 1), 1 << (width - 2)

    def long(x: int) -> Column:
        return F.lit(x).cast("long")

    def matches(s: Column, i: Column) -> Column:
        """Bit k: whether character i of the shorter equals row i + max_edits + 1 - width + k of the longer."""
        c = F.get(s["two"], i)
        bits = [F.when(F.get(s["one"], i + (max_edits + 1 - width + k)) == c, long(1 << k)).otherwise(long(0)) for k in range(width)]
        x = bits[0]
        for bit in bits[1:]:
            x = x.bitwiseOR(bit)
        return F.struct(x.alias("x"), (i < s["n"] - max_edits).alias("down"))

    # The strings' characters are bound once; the walk itself carries only longs.
    columns = F.element_at(F.transform(
        F.array(F.struct(one.alias("one"), two.alias("two"), n_one.alias("n"), n_two.alias("m"))),
        lambda s: F.transform(F.sequence(F.lit(0), s["m"] - 1), lambda i: matches(s, i))), 1)

    def step(s: Column, e: Column) -> Column:
        x, vp, vn = e["x"], s["vp"], s["vn"]
        d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(long(full))
        return F.struct(s["mask"].alias("mask"), vp.alias("vp"), vn.alias("vn"), s["d"].alias("d"), d0.alias("d0"), e["down"].alias("down"))

    def turn(s: Column) -> Column:
        d0, vp, vn, mask, down = s["d0"], s["vp"], s["vn"], s["mask"], s["down"]
        hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(long(full))
        hn = d0.bitwiseAND(vp)
        grow = F.when(down, F.when(d0.bitwiseAND(long(top)) == 0, 1).otherwise(0)).otherwise(
            F.when(hp.bitwiseAND(mask) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(mask) != 0, 1).otherwise(0))
        low = F.shiftright(d0, 1)
        return F.struct(F.when(down, mask).otherwise(F.shiftright(mask, 1)).alias("mask"),
                        hn.bitwiseOR(F.bitwise_not(low.bitwiseOR(hp))).bitwiseAND(long(full)).alias("vp"),
                        low.bitwiseAND(hp).alias("vn"), (s["d"] + grow).alias("d"))

    start = F.struct(long(side).alias("mask"), long((full << (width - max_edits - 1)) & full).alias("vp"),
                     long(0).alias("vn"), F.lit(max_edits).alias("d"))
    walked = F.aggregate(columns, start, lambda s, e: F.element_at(F.transform(F.array(step(s, e)), turn), 1), lambda s: s["d"])
    return (n_one - n_two <= max_edits) & (walked <= max_edits)


def _near_kept(linked: DataFrame, members: DataFrame, texts: DataFrame, check, alike) -> DataFrame:
    """(id, head): the line that stays for each linked line: itself or a near, earlier one.

    ``linked`` (id, component, place): lines are taken in the order of place; one
    near no line that stays, stays. A component's first line stays; what is not
    near it is settled in rounds: a line that is the first left over in all of its
    buckets stays, as near lines share a bucket, and its near lines go. A round
    tests one line a bucket against the others.
    """
    texts = texts.withColumnRenamed("h", "id")
    heads = (linked.groupBy("component").agg(F.min("place").alias("first"), F.count("*").alias("n"))
             .join(texts, F.col("first.id") == F.col("id"))
             .select("component", F.col("first.id").alias("head"), F.col("line").alias("head_line"), F.col("counts").alias("head_counts"), "n"))
    heads = written(heads, "heads")
    near = (F.col("id") == F.col("head")) | alike("line", "head_line", "counts", "head_counts")
    settled = Parts("kept-lines")
    new = settled.add(join_few(linked.join(texts, "id"), heads, "component", "id", "n").filter(near).select("id", "head"))
    left = members.join(linked, "id").select("key", "component", "id", "place")
    while True:
        left = left.join(new, "id", "left_anti").select("key", "component", "id", "place")
        low = left.groupBy("key", "component").agg(F.min("place").alias("low"))
        left = written(left.join(low, ["key", "component"]), "lines-left")
        if left.isEmpty():
            return settled.all()
        stay = left.groupBy("id").agg(F.min(F.col("place") == F.col("low")).alias("stays")).filter("stays").select("id")
        pairs = (left.filter("place <> low").select(F.col("low.id").alias("a"), F.col("id").alias("b"))
                 .join(stay.withColumnRenamed("id", "a"), "a", "left_semi").distinct())
        gone = check(pairs).groupBy("b").agg(F.min("a").alias("head"))
        new = settled.add(gone.select(F.col("b").alias("id"), "head").unionByName(stay.select("id", F.col("id").alias("head"))))


def line_classes(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, direct: bool = False) -> DataFrame:
    """(h, h2, n_docs, n_links, doc_id, keep_h, keep_h2) per class of equal lines.

    doc_id and (keep_h, keep_h2): the document and the line that stay for the
    class's component or, with ``direct``, for the class by ``_near_kept``.
    """
    lines = _lines(docs)
    first = lines.filter("doc_id is not null").groupBy("h", "h2").agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("doc_id"), F.min_by("pos", "doc_id").alias("pos"))
    classes = written(first, "line-classes")

    chars = F.char_length("line")
    long_lines = lines.filter("doc_id is not null").filter(chars >= min_chars)
    # Twelve keys a line, read twice below: cheaper to write than to compute again.
    keyed = written(segment_keys(long_lines.select("h", "line", chars.alias("n")), max_edits, min_chars), "line-keys")
    shared = written(keyed.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo <> hi").select("key"), "shared-keys")
    members = written(keyed.filter(may_hold(sieve(shared, "key"), F.col("key"))).distinct()
                      .join(shared, "key", "left_semi").select("key", F.col("h").alias("id")), "line-buckets")
    needed = written(members.select("id").distinct(), "needed-lines")
    counts = F.array(*[F.char_length("line") - F.char_length(F.translate("line", c, "")) for c in _CLASSES])
    texts = written(long_lines.select("h", "line").filter(may_hold(sieve(needed, "id"), F.col("h")))
                    .join(needed, F.col("h") == F.col("id"), "left_semi").groupBy("h").agg(F.min("line").alias("line"))
                    .withColumn("counts", counts), "line-texts")

    def near_counts(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(F.col(x), F.col(y), lambda p, q: F.abs(p - q)), F.lit(0), lambda s, p: s + p) <= 2 * max_edits

    def counted(ids: DataFrame) -> DataFrame:
        return texts.join(ids, F.col("h") == F.col("id"), "left_semi").select(F.col("h").alias("id"), F.col("counts").alias("profile"))

    def check(pairs: DataFrame) -> DataFrame:
        one = texts.select(F.col("h").alias("a"), F.col("line").alias("line_a"), F.col("counts").alias("counts_a"))
        two = texts.select(F.col("h").alias("b"), F.col("line").alias("line_b"), F.col("counts").alias("counts_b"))
        near = pairs.join(one, "a").join(two, "b").filter(near_counts("counts_a", "counts_b"))
        return near.filter(within_edits(F.col("line_a"), F.col("line_b"), max_edits)).select("a", "b")

    def alike(line_a: str, line_b: str, counts_a: str, counts_b: str) -> Column:
        return F.when(near_counts(counts_a, counts_b), within_edits(F.col(line_a), F.col(line_b), max_edits)).otherwise(False)

    comps, links = linked_components(members, check, (counted, near_counts))
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    tied = (classes.join(comps, F.col("h") == F.col("id"), "left").drop("id").join(degree, F.col("h") == F.col("id"), "left").drop("id")
            .withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
            .withColumn("component", F.when(F.col("n_links") > 0, F.coalesce("component", "h"))))
    tied = written(tied, "tied-lines")
    if direct:
        linked = tied.filter("n_links > 0").groupBy("h").agg(
            F.min("component").alias("component"), F.min(F.struct("doc_id", "pos", F.col("h").alias("id"))).alias("place"))
        kept = _near_kept(linked.withColumnRenamed("h", "id"), members, texts, check, alike).withColumnRenamed("head", "keep")
        # The line that stays names its component anew.
        tied = written(tied.drop("component").join(kept, F.col("h") == F.col("id"), "left").drop("id")
                       .withColumnRenamed("keep", "component"), "tied-lines")
    names = ["h", "h2", "n_docs", "n_links"]
    linked = tied.filter("n_links > 0")
    heads = written(linked.groupBy("component").agg(F.min(F.struct("doc_id", "pos", "h", "h2")).alias("head"), F.count("*").alias("n")), "heads")
    return (join_few(linked, heads, "component", "h", "n")
            .select(*names, "head.doc_id", F.col("head.h").alias("keep_h"), F.col("head.h2").alias("keep_h2"))
            .unionByName(tied.filter("n_links = 0").select(*names, "doc_id", F.col("h").alias("keep_h"), F.col("h2").alias("keep_h2"))))


def dedup_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                direct: bool = False) -> DataFrame:
    """``docs`` with duplicate lines taken out of text; adds n_lines, n_removed.

    Lines are split at \\n; a line with no word is never a duplicate. Of
    equal lines and of lines (at least ``min_chars`` code points) that chains
    of at most ``max_edits`` edits connect, the first of the document with the
    smallest doc_id stays, everywhere else they go, inside a document too.
    ``direct``: chains do not count; in the order of doc_id and place a line goes
    only if it is within ``max_edits`` edits of an earlier line that stays.
    Null texts stay null with 0 lines; a text all of whose lines go is empty.
    A null doc_id takes no part and keeps its text. Rows that repeat a doc_id
    keep or lose the same lines. n_chars, where present, is left as it was.
    An empty table gives no rows. Columns named n_lines or n_removed are
    replaced; other columns pass through.
    """
    classes = written(line_classes(docs, max_edits, min_chars, direct), "line-decisions")
    doubtful = classes.filter((F.col("n_docs") > 1) | (F.col("n_links") > 0))
    lines = _lines(docs).filter("doc_id is not null").select("doc_id", "h", "h2")
    lost = (lines.filter(may_hold(sieve(doubtful, "h"), F.col("h")))
            .join(doubtful.withColumnRenamed("doc_id", "keep_doc"), ["h", "h2"])
            .filter((F.col("doc_id") != F.col("keep_doc")) | (F.col("h") != F.col("keep_h")) | (F.col("h2") != F.col("keep_h2")))
            .groupBy("doc_id").agg(F.collect_set("h").alias("gone")).withColumnRenamed("doc_id", "_id"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_doc"))
    joined = packed.join(lost, F.col("_doc.doc_id").cast("long") == F.col("_id"), "left")
    parts = F.split(F.col("_doc.text").cast("string"), "\n")
    gone = F.coalesce("gone", F.array().cast("array<bigint>"))
    # A line stays if it has no word, or is not lost and is the first of its kind in its text.
    # The split text and the lost hashes are bound once, for all lines.
    kept = F.element_at(F.transform(F.array(F.struct(parts.alias("all"), gone.alias("gone"))), lambda s: F.filter(
        s["all"], lambda line, i: ~line.rlike(r"[^\x20\x09-\x0D]")
        | (~F.array_contains(s["gone"], F.xxhash64(line)) & (F.array_position(s["all"], line) == i + 1)))), 1)
    whole = F.col("_doc.doc_id").isNull() | F.col("_doc.text").isNull()
    done = joined.select("_doc", parts.alias("_parts"), F.when(whole, parts).otherwise(kept).alias("_kept"))
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")
    return done.select(*[(F.array_join("_kept", "\n") if c == "text" else F.col("_doc")[c]).alias(c) for c in names],
                       size("_parts").alias("n_lines"), (size("_parts") - size("_kept")).alias("n_removed"))
