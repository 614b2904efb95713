"""Quality rules as statistics of whole texts, judged by an isolation forest.

The rule statistics of a document (its rates of symbols, repeats, case, word
lengths ..., as log1p, without limits) are points; a forest of random splits
isolates anomalous points after few steps. The forest is fitted on a bounded random sample (``TREES`` trees of
``SAMPLE`` documents each, drawn by a hash of the doc_id), each tree on a few
statistics. Trees count by how well their path lengths tell good from bad in a
bounded sample of the labelled rows, so that statistics in which good documents
vary as widely as bad ones do not hide the others. Every document is scored,
and the score above which a document is rejected is calibrated on all labelled
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm import blocks
from gamelake.llm.tables import small_batches, written

TREES, SAMPLE = 128, 256
#: Most statistics a tree splits.
TREE_FEATURES = 3
#: Score bins of the calibration.
BINS = 2000
#: Share of good labelled documents that the calibrated threshold may reject.
MAX_LOSS = 0.005
WINDOW = 8
#: Fixed symbol set of the rule.
SYMBOLS = "#*$%&|<>"

_IS_SYMBOL = np.zeros(256, dtype=np.int64)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
_IS_UPPER = np.zeros(256, dtype=np.int64)
_IS_UPPER[65:91] = 1
_IS_LETTER = np.zeros(256, dtype=np.int64)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = 1
_IS_DIGIT = np.zeros(256, dtype=np.int64)
_IS_DIGIT[48:58] = 1
_IS_MARK = np.zeros(256, dtype=np.int64)
_IS_MARK[[ord(c) for c in "!?"]] = 1
#: Bytes that begin a code point and are not white space.
_IS_CHAR = np.ones(256, dtype=np.int64)
_IS_CHAR[0x80:0xC0] = 0
_IS_CHAR[blocks.WORD_SPACE] = 0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The rates, as log1p, are the points that the forest splits.
FEATURES = ("symbol_rate", "mark_rate", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mean_word",
            "same_as_last", "bare_word_share")
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS],
                     *[(f, pa.float64()) for f in FEATURES], ("text_hash", pa.int64())])
_DDL = ", ".join(["doc_id long", *[f"{c} long" for c in COUNTS], *[f"{f} double" for f in FEATURES], "text_hash long"])


def block_statistics(block: blocks.Block) -> dict[str, np.ndarray]:
    buf, offs, n = block.buf, block.offs, len(block)

    def per_text(values: np.ndarray, bounds: np.ndarray = offs) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    starts, ends = block.words()
    word = block.hashes(starts, ends)
    first = np.searchsorted(starts, offs)
    n_words = np.diff(first)
    salt = blocks.mix64(np.arange(1, n + 1, dtype=np.uint64))

    # \n-split lines that hold a word and equal an earlier line of their text.
    breaks = np.flatnonzero(buf == 10)
    begin = blocks.distinct(np.concatenate([offs[:-1], breaks + 1]))
    begin = begin[begin < len(buf)]
    if len(begin):
        owner = block.doc_of(begin)
        stop = np.minimum(np.append(begin[1:], len(buf)), offs[owner + 1])
        stop = stop - (buf[stop - 1] == 10)
        wordy = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
        begin, stop, owner = begin[wordy], stop[wordy], owner[wordy]
        key = block.hashes(begin, stop) ^ salt[owner]
        again = np.ones(len(key), dtype=bool)
        again[np.unique(key, return_index=True)[1]] = False
        lines = np.bincount(owner, minlength=n)
        dup_lines = np.bincount(owner[again], minlength=n)
    else:
        lines = dup_lines = np.zeros(n, dtype=np.int64)

    # Words covered by word windows that stand twice or more in their text.
    covered = np.zeros(len(word), dtype=np.int64)
    if len(word) >= WINDOW:
        owner_w = np.repeat(np.arange(n), n_words)
        roll = word[: len(word) - WINDOW + 1] ^ salt[owner_w[: len(word) - WINDOW + 1]]
        for i in range(1, WINDOW):
            roll = blocks.mix64(roll * np.uint64(0xD6E8FEB86659FD93) + word[i: len(word) - WINDOW + 1 + i])
        inside = owner_w[: len(roll)] == owner_w[WINDOW - 1:]
        ranked = np.sort(roll[inside])
        twice = ranked[1:][ranked[1:] == ranked[:-1]]
        if len(twice):
            mark = np.zeros(len(word) + 1, dtype=np.int64)
            at = np.flatnonzero(inside & blocks.among(roll, twice))
            np.add.at(mark, at, 1)
            np.add.at(mark, at + WINDOW, -1)
            covered = (np.cumsum(mark[:-1]) > 0).astype(np.int64)

    same = np.zeros(len(word), dtype=np.int64)
    same[1:] = word[1:] == word[:-1]
    same[first[:-1][n_words > 0]] = 0  # a text's first word has none before it
    letters = np.concatenate([[0], np.cumsum(_IS_LETTER[buf] + (buf >= 0xC3))])
    bare = (letters[ends] == letters[starts]).astype(np.int64)
    some = np.maximum(n_words, 1)
    word_chars = per_text(_IS_CHAR[buf])
    n_symbols = per_text(_IS_SYMBOL[buf])
    n_letters = np.maximum(per_text(_IS_LETTER[buf]), 1)
    repeat = per_text(covered, first)

    rates = {
        "symbol_rate": n_symbols / some, "mark_rate": per_text(_IS_MARK[buf]) / some,
        "dup_line_share": dup_lines / np.maximum(lines, 1), "repeat_share": repeat / some,
        "upper_share": per_text(_IS_UPPER[buf]) / n_letters, "digit_share": per_text(_IS_DIGIT[buf]) / np.maximum(word_chars, 1),
        "mean_word": word_chars / some, "same_as_last": per_text(same, first) / some,
        "bare_word_share": per_text(bare, first) / some,
    }
    counts = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": dup_lines,
              "n_repeat_words": repeat}
    return counts | {name: np.log1p(np.where(n_words > 0, value, 0.0)) for name, value in rates.items()}


def _statistics(batches):
    for batch in batches:
        for block in blocks.text_blocks(batch.column(1)):
            found = block_statistics(block)
            given = [batch.column(i).slice(block.lo, len(block)) for i in (0, 2)]
            cols = [given[0], *[pa.array(found[f.name], f.type) for f in _SCHEMA if f.name in found], given[1]]
            yield pa.RecordBatch.from_arrays(cols, schema=_SCHEMA)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the rules, the points the forest splits, and a hash of the text."""
    small_batches(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    return text.mapInArrow(_statistics, _DDL)


def _usual_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


def grow(points: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> list[dict[str, np.ndarray]]:
    """Isolation trees as flat arrays (feature -1: leaf, whose value is its path length).

    Each tree splits 1 to ``TREE_FEATURES`` features, drawn anew.
    """
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(sample, 2)))) + 2
    forest = []
    for _ in range(trees if len(points) else 0):
        rows = points[rng.choice(len(points), min(sample, len(points)), replace=False)]
        own = rng.choice(points.shape[1], min(int(rng.integers(1, TREE_FEATURES + 1)), points.shape[1]), replace=False)
        feature, value, left, right = [], [], [], []

        def node(part: np.ndarray, depth: int) -> int:
            me = len(feature)
            feature.append(-1)
            value.append(depth + _usual_path(len(part)))
            left.append(me)
            right.append(me)
            low, high = part.min(axis=0), part.max(axis=0)
            spread = own[high[own] > low[own]]
            if depth < limit and len(part) > 1 and len(spread):
                f = int(rng.choice(spread))
                cut = rng.uniform(low[f], high[f])
                side = part[:, f] <= cut
                feature[me], value[me] = f, cut
                left[me] = node(part[side], depth + 1)
                right[me] = node(part[~side], depth + 1)
            return me

        node(rows, 0)
        forest.append({"feature": np.asarray(feature), "value": np.asarray(value), "left": np.asarray(left), "right": np.asarray(right)})
    return forest


def paths(points: np.ndarray, forest: list[dict[str, np.ndarray]], sample: int = SAMPLE) -> np.ndarray:
    """Path length of each point in each tree; 1 is usual, shorter is more anomalous."""
    out = np.empty((len(points), len(forest)))
    rows = np.arange(len(points))
    for t, tree in enumerate(forest):
        at = np.zeros(len(points), dtype=np.int64)
        while True:
            f = tree["feature"][at]
            if (f < 0).all():
                break
            go = points[rows, np.maximum(f, 0)] <= tree["value"][at]
            at = np.where(f < 0, at, np.where(go, tree["left"][at], tree["right"][at]))
        out[:, t] = tree["value"][at]
    return out / _usual_path(sample)


def weigh(lengths: np.ndarray, good: np.ndarray, rounds: int = 500, ridge: float = 1e-4) -> np.ndarray:
    """Weight of each tree (none negative, sum 1) from the path lengths of labelled points.

    Logistic regression of bad on short paths, both labels with equal weight in
    all, by accelerated projected gradients. Equal weights without both labels
    or if no tree's paths are shorter for bad points.
    """
    equal = np.full(lengths.shape[1], 1.0 / max(lengths.shape[1], 1))
    if not good.any() or good.all() or not len(equal):
        return equal
    side = np.where(good, -1.0, 1.0)
    share = np.where(good, 0.5 / good.sum(), 0.5 / (~good).sum())
    short = lengths.mean(axis=0) - lengths
    step = 1.0 / (np.linalg.eigvalsh(short.T @ (short * share[:, None]))[-1] / 4 + ridge)
    weight = ahead = np.ones(len(equal))
    shift, turn = 0.0, 1.0
    for _ in range(rounds):
        pull = side * share / (1 + np.exp(np.clip(side * (short @ ahead + shift), -30, 30)))
        new = np.maximum(0.0, ahead + step * (short.T @ pull - ridge * ahead))
        shift += 2 * pull.sum()
        turn, last = (1 + np.sqrt(1 + 4 * turn * turn)) / 2, turn
        ahead = np.maximum(0.0, new + (last - 1) / turn * (new - weight))
        weight = new
    return weight / weight.sum() if weight.sum() > 0 else equal


def anomaly(points: np.ndarray, forest: list[dict[str, np.ndarray]], weight: np.ndarray | None = None,
            sample: int = SAMPLE) -> np.ndarray:
    """Isolation score in (0, 1); 0.5 is usual, larger is more anomalous. ``weight``: of each tree (None: equal)."""
    if not forest:
        return np.full(len(points), 0.5)
    return np.exp2(-np.average(paths(points, forest, sample), axis=1, weights=weight))


def _scored(forest, weight):
    names = [*COUNTS, *FEATURES]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = np.column_stack([batch.column(1 + names.index(f)).to_numpy() for f in FEATURES])
            score = pa.array(anomaly(points, forest, weight), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: 1 + len(COUNTS)], score, batch.columns[-1]],
                                              names=["doc_id", *COUNTS, "anomaly", "text_hash"])

    return run


def calibrate(histogram: list[tuple[float, int, int]], max_loss: float = MAX_LOSS) -> float | None:
    """Lowest score limit that rejects at most ``max_loss`` of the good rows.

    ``histogram``: (score bin's lower end, good rows, bad rows). Among the
    limits within that loss the one with most (bad - good) rejections wins,
    ties to the higher one; it is placed halfway to the next lower score seen.
    None without good and bad rows.
    """
    good = sum(g for _, g, _ in histogram)
    bad = sum(b for _, _, b in histogram)
    if not good or not bad:
        return None
    ranked = sorted(histogram, reverse=True)
    best, limit, lost, caught = 0, None, 0, 0
    for i, (score, g, b) in enumerate(ranked):
        lost, caught = lost + g, caught + b
        if lost <= max_loss * good and caught - lost > best:
            below = ranked[i + 1][0] if i + 1 < len(ranked) else score
            best, limit = caught - lost, (score + below) / 2
    return limit


def judge(docs: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """(doc_id, the five counts, base_failed, kept, anomaly) for every row of ``docs``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in
    repeated 8-word windows. Other rows are kept while their anomaly score (in
    steps of 1 / ``BINS``) is under the calibrated limit. ``labels``: doc_id, quality (1 good, 0 bad;
    other values and nulls are ignored, repeated rows count by their lowest).

    Null and empty texts have zero counts and fail. A null doc_id is judged
    like any other row but never used for calibration. Rows repeat as given.
    Without good or bad labels the forest rejects nothing. Empty tables give
    empty results. Extra columns are ignored.
    """
    return _judged(docs, labels, max_loss).drop("text_hash")


def _judged(docs: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """``judge`` with the hash of each row's text, which tells apart rows that share a doc_id."""
    found = written(statistics(docs), "rules")
    usable = found.filter((F.col("n_words") >= 20) & (100 * F.col("n_repeat_words") <= 30 * F.col("n_words")))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("forest")), F.lit(1_000_000))
    total = usable.count()
    share = min(1.0, TREES * SAMPLE / max(total, 1))
    drawn = usable.filter(draw < int(1_000_000 * share))
    points = np.asarray(sorted(tuple(r) for r in drawn.select(*FEATURES).collect()), dtype=float)
    forest = grow(points.reshape(-1, len(FEATURES)))
    verdicts = written(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
                       .filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality")), "verdicts")
    judged = usable.join(verdicts, "doc_id")
    sizes = {r["quality"]: r["n"] for r in judged.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    part = [min(1.0, TREES * SAMPLE / 2 / max(sizes.get(q, 0), 1)) for q in (0, 1)]
    shown = judged.filter(draw < F.when(F.col("quality") == 1, int(1_000_000 * part[1])).otherwise(int(1_000_000 * part[0])))
    known = np.asarray(sorted(tuple(r) for r in shown.select("quality", *FEATURES).collect()), dtype=float).reshape(-1, 1 + len(FEATURES))
    weight = weigh(paths(known[:, 1:], forest), known[:, 0] == 1)
    scored = written(found.mapInArrow(_scored(forest, weight), ", ".join(["doc_id long", *[f"{c} long" for c in COUNTS], "anomaly double", "text_hash long"])),
                     "scores")
    level = F.floor(F.col("anomaly") * BINS)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    bins = (scored.filter(~base).join(verdicts, "doc_id").groupBy(level.alias("bin"))
            .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).collect())
    limit = calibrate([(r["bin"] / BINS, r["good"], r["bad"]) for r in bins], max_loss)
    usual = level / BINS < limit if limit is not None else F.lit(True)
    return scored.select("doc_id", *COUNTS, base.alias("base_failed"), (~base & usual).alias("kept"), "anomaly", "text_hash")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as given.

    Every row is judged by its own text, whether its doc_id is null or stands
    in other rows too: only the bad ones of such rows go. Null and empty texts
    go (they fail the base rules). Without good or bad labels only the base
    rules reject. Empty tables give empty results; columns of any other name
    pass through.
    """
    bad = (_judged(docs, labels, **options).filter("not kept")
           .select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash")).distinct())
    own = docs["doc_id"].cast("long").eqNullSafe(bad["_gone"]) & (F.xxhash64(docs["text"].cast("string")) == bad["_hash"])
    return docs.join(bad, own, "left_anti")
