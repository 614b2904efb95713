"""Toxicity: a string-kernel support vector machine over words, with Nyström landmarks.

The kernel of two words sums, over all three-letter subsequences they share,
``DECAY`` to the power of the stretches these span (at most ``SPAN`` letters),
each word scaled by its length. Gapped insults and insults with inserted
letters so stay near the plain ones. Words are projected on landmark words
(Nyström); a linear support vector machine is trained there on words of
labelled texts. Its weights collapse to one number per three-letter sequence,
by which every word of every text is scored; a text is as toxic as its worst
words, calibrated to a probability.

Labels belong to whole texts, so training starts from words seen
significantly more in toxic than in clean texts (in distinct surroundings, so
that copies of a text do not count), and a bounded sample of
labelled rows (``SAMPLE`` texts of either label, drawn by a hash) is used.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm import blocks
from gamelake.llm.tables import small_batches, written

#: Labelled texts of either label that training reads, at most about this many.
SAMPLE = 3000
LANDMARKS = 300
TOXIC_WORDS, CLEAN_WORDS = 1500, 5000
#: Rounds of training; after each but the last, the clean words nearest to toxic ones join.
ROUNDS, HARD_WORDS = 4, 2500
DECAY, SPAN = 0.7, 7
LONG = 20
LETTERS = 32
SEQUENCES = LETTERS ** 3

#: Letter number by code point up to U+017F (0: no letter). Digits and signs that stand for letters count as those.
_LETTER = np.zeros(0x180 + 1, dtype=np.uint8)
for _c in range(0x180):
    _base = unicodedata.normalize("NFD", chr(_c))[0].lower()
    if "a" <= _base <= "z":
        _LETTER[_c] = ord(_base) - 96
for _sign, _base in zip("013457@$", "oieastas"):
    _LETTER[ord(_sign)] = ord(_base) - 96
for _c in "éèêë":
    _LETTER[ord(_c)] = 29
for _c in "äöüóúàâôû":
    _LETTER[ord(_c)] = 30
_LETTER[0xDF] = 27  # ß
_LETTER[0x180] = 28  # any further letter
#: Stands before every word, so that beginnings count.
_BEGIN = 31
_GAPS = [(i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]
_WEIGHTS = np.asarray([DECAY ** (j + 1) for _, j in _GAPS])


def _word_scale(n: np.ndarray) -> np.ndarray:
    """Length of a word's image if all its subsequences were distinct; beyond
    ``LONG`` letters it grows with the word, so that repetition adds nothing."""
    n = np.asarray(n)
    places = np.maximum(np.minimum(n, LONG)[:, None] - np.asarray([j for _, j in _GAPS])[None, :], 0)
    return np.sqrt((places * _WEIGHTS[None, :] ** 2).sum(axis=1)) * np.maximum(n / LONG, 1.0)


def fold(block: blocks.Block) -> blocks.Block:
    """The block's words as letter numbers (1..30), words split by 32.

    Signs within a word are dropped; three or more single characters in a row
    are one word, so spaced-out words are whole again.
    """
    codes = np.frombuffer(block.buf.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    begins = block.buf & 0xC0 != 0x80
    place = np.concatenate([[0], np.cumsum(begins)])
    offs = place[block.offs]
    letters = _LETTER[np.minimum(codes, 0x180)]
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    wide = blocks.Block(0, len(block), np.zeros(len(codes), np.uint8), offs)
    starts, ends = wide.runs(~space)
    joined = np.zeros(len(codes), dtype=bool)
    if len(starts):
        count = np.concatenate([[0], np.cumsum(letters > 0)])
        single = count[ends] - count[starts] == 1
        near = np.zeros(len(starts), dtype=bool)
        near[1:] = (starts[1:] - ends[:-1] == 1) & (wide.doc_of(starts[1:]) == wide.doc_of(starts[:-1])) & single[1:] & single[:-1]
        run = np.cumsum(~near)
        long = np.bincount(run)[run] >= 3
        joined[starts[near & long] - 1] = True
    out = np.where(space & ~joined, 32, letters).astype(np.uint8)
    keep = out > 0
    kept = np.concatenate([[0], np.cumsum(keep)])
    return blocks.Block(block.lo, block.hi, out[keep], kept[offs])


def word_runs(folded: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
    return folded.runs(folded.buf != 32)


def _sums(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of weight x table value over each word's three-letter subsequences."""
    code = letters.astype(np.int64)
    stop = np.zeros(len(letters), dtype=np.int64)
    stop[:] = np.repeat(ends, ends - starts) if len(starts) else 0
    at = np.arange(len(letters))
    total = np.zeros(len(letters), dtype=np.float64)
    for (i, j), weight in zip(_GAPS, _WEIGHTS):
        ok = np.flatnonzero(at + j < stop)
        if len(ok):
            total[ok] += weight * table[(code[ok] << 10) | (code[ok + i] << 5) | code[ok + j]]
    cum = np.concatenate([[0.0], np.cumsum(total)])
    return cum[ends] - cum[starts]


def _image(word: bytes) -> dict[int, float]:
    """Scaled image of a word: weight of each of its three-letter subsequences."""
    out: dict[int, float] = {}
    for a in range(len(word)):
        for (i, j), weight in zip(_GAPS, _WEIGHTS):
            if a + j < len(word):
                key = (word[a] << 10) | (word[a + i] << 5) | word[a + j]
                out[key] = out.get(key, 0.0) + float(weight)
    scale = float(_word_scale(np.asarray([len(word)]))[0]) or 1.0
    return {k: v / scale for k, v in out.items()}


@dataclass
class Model:
    #: Weight per three-letter sequence, the machine's offset, slope and offset of the probability.
    table: np.ndarray
    bias: float
    slope: float
    shift: float


def _distinct_words(folded: blocks.Block):
    """(letters, starts, ends) of the block's distinct words, the number of each word, first word of each text."""
    starts, ends = word_runs(folded)
    key = folded.hashes(starts, ends)
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    s, n = starts[first] - 1, ends[first] - starts[first] + 1
    e = np.cumsum(n)
    letters = np.concatenate([folded.buf, [0]])[np.arange(int(e[-1]) if len(e) else 0) + np.repeat(s - (e - n), n)].astype(np.uint8)
    letters[e - n] = _BEGIN
    return letters, e - n, e, which, np.searchsorted(starts, folded.offs)


def worst_words(block: blocks.Block, model: Model) -> np.ndarray:
    """Machine's value of each text's worst word (texts without words: -4)."""
    folded = fold(block)
    letters, s, e, which, first = _distinct_words(folded)
    out = np.full(len(block), -4.0)
    if len(s):
        scale = np.maximum(_word_scale(np.arange(int((e - s).max()) + 1)), 1e-9)
        value = _sums(letters, s, e, model.table) / scale[e - s] + model.bias
        full = np.flatnonzero(first[1:] > first[:-1])
        out[full] = np.maximum.reduceat(value[which], first[:-1][full])
    return np.clip(out, -4.0, 4.0)


_WORDS = pa.schema([("toxic", pa.int32()), ("word", pa.binary()), ("after", pa.int64())])


def _sample_words(batches):
    """Folded words (3 to 40 letters) of labelled texts, with a hash of the word before."""
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for block in blocks.text_blocks(pc.utf8_lower(batch.column(0))):
            folded = fold(block)
            starts, ends = word_runs(folded)
            first = np.searchsorted(starts, folded.offs)
            key = folded.hashes(starts, ends).view(np.int64)
            raw = folded.buf.tobytes()
            for d in range(len(block)):
                lo, hi = int(first[d]), int(first[d + 1])
                before = [0, *key[lo:hi].tolist()]
                own = {(bytes([_BEGIN]) + raw[a:b], c) for a, b, c in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist(), before)
                       if 3 <= b - a <= 40}
                yield pa.RecordBatch.from_arrays([pa.array([labels[block.lo + d]] * len(own), pa.int32()), pa.array([w for w, _ in own], pa.binary()),
                                                  pa.array([c for _, c in own], pa.int64())], schema=_WORDS)


def _inserted(word: bytes) -> list[bytes]:
    """A toxic word with one letter put in, at places and with letters that follow from the word."""
    if len(word) < 6:
        return []
    places = sorted({2 + (i * (len(word) - 3)) // 4 for i in range(4)})
    return [word[:at] + bytes([1 + (7 * at + 5 * word[at] + 3 * len(word)) % 26]) + word[at:] for at in places]


def _nystrom(words: list[bytes], landmarks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Images of the landmarks (dense), the whitening of their kernel, projections of the words."""
    base = np.zeros((len(landmarks), SEQUENCES), dtype=np.float32)
    for i, w in enumerate(landmarks):
        for k, v in _image(w).items():
            base[i, k] = v
    values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    use = values > 1e-6 * values.max()
    white = vectors[:, use] / np.sqrt(values[use])
    kernel = np.zeros((len(words), len(landmarks)))
    for i, w in enumerate(words):
        image = _image(w)
        if image:
            kernel[i] = base[:, list(image)] @ np.asarray(list(image.values()), dtype=np.float32)
    return base, white, kernel @ white


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300, cost: float = 20.0) -> np.ndarray:
    """Weights (last: offset) of a linear machine with squared hinge loss, by Newton-type steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) / cost
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        active = y * (x @ w) < 1
        xa = x[active] * weight[active, None]
        new = np.linalg.solve(ridge + xa.T @ x[active], xa.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = 0.5 * w + 0.5 * new
    return w


def _logistic(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability of label 1, by Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    target = np.where(label == 1, 1 - 1 / (label.sum() + 2), 1 / ((label == 0).sum() + 2))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * value + b, -30, 30)))
        r, g = np.maximum(p * (1 - p), 1e-9), p - target
        h = np.array([[(r * value * value).sum() + 1e-3, (r * value).sum()], [(r * value).sum(), r.sum() + 1e-3]])
        move = np.linalg.solve(h, [(g * value).sum() + 1e-3 * a, g.sum() + 1e-3 * b])
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(a), float(b)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on labelled rows of ``docs`` (doc_id, text); ``labels``: doc_id, toxic 0 or 1.

    Null ids, texts and labels are left out; an id labelled both ways counts
    as toxic. None without texts of both labels.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit("toxic")), F.lit(1_000_000))
    part = F.when(F.col("toxic") == 1, int(1e6 * min(1, SAMPLE / sizes[1]))).otherwise(int(1e6 * min(1, SAMPLE / sizes[0])))
    drawn = marks.filter(draw < part)
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    # About 2 * SAMPLE ids at any size of the input.
    sample = written(text.join(F.broadcast(drawn), "id").select("text", "toxic"), "labelled-sample")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    # A word counts once per word before it: copies of a text add nothing.
    seen = written(sample.mapInArrow(_sample_words, "toxic int, word binary, after long").distinct().groupBy("word")
                   .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "sample-words")
    rate = totals[1] / (totals[0] + totals[1])
    usual = rate * (F.col("bad") + F.col("good"))
    surplus = (F.col("bad") - usual) / F.sqrt(usual * (1 - rate))
    # Significant surplus, and at least 9 of 10 sightings in toxic texts.
    suspects = (seen.filter((surplus >= 5) & (F.col("bad") * F.lit(1 - rate) >= 9 * F.col("good") * F.lit(rate)))
                .orderBy(surplus.desc(), "word").limit(TOXIC_WORDS).select("word", "bad").collect())
    clean = seen.filter("good >= 1").filter(surplus < 2).select("word", "good")
    plain = (clean.orderBy(F.when(F.col("good") >= 20, 0).otherwise(1), F.xxhash64("word"), "word").limit(CLEAN_WORDS)
             .select("word").collect())
    if not suspects or not plain:
        return None
    bad, good = [bytes(r["word"]) for r in suspects], [bytes(r["word"]) for r in plain]
    hard: list[bytes] = []
    altered = [v for w in bad for v in _inserted(w)]
    marks = bad + altered
    trust = np.sqrt([float(r["bad"]) for r in suspects])
    trust = np.concatenate([trust, 0.5 * np.repeat(trust, [len(_inserted(w)) for w in bad])])
    for turn in range(ROUNDS):
        words = marks + hard + [w for w in good if w not in set(hard)]
        landmarks = bad[: LANDMARKS // 2] + words[len(marks):][: LANDMARKS - min(len(bad), LANDMARKS // 2)]
        base, white, x = _nystrom(words, landmarks)
        y = np.where(np.arange(len(words)) < len(marks), 1.0, -1.0)
        weight = np.ones(len(words))
        weight[: len(marks)] = trust * (len(words) - len(marks)) / trust.sum()
        w = _hinge(x, y, weight)
        model = Model((base.T @ (white @ w[:-1])).astype(np.float64), float(w[-1]), 1.0, 0.0)
        if turn + 1 < ROUNDS:
            near = (clean.mapInArrow(_word_values(model), "word binary, value double").filter("value > -0.5")
                    .orderBy(F.col("value").desc(), "word").limit(HARD_WORDS).select("word").collect())
            known = set(hard)
            hard += [v for v in (bytes(r["word"]) for r in near) if v not in known]
    scored = sample.select(F.lit(None).cast("long").alias("doc_id"), "text", "toxic")
    rows = scored.mapInArrow(_scored(model, True), "doc_id long, value double, toxic int").select("value", "toxic").collect()
    value, label = np.asarray([r["value"] for r in rows]), np.asarray([r["toxic"] for r in rows])
    model.slope, model.shift = _logistic(value, label)
    return model


def _word_values(model: Model):
    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            n = np.fromiter(map(len, words), np.int64, len(words))
            e = np.cumsum(n)
            value = _sums(np.frombuffer(b"".join(words), np.uint8), e - n, e, model.table)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value / np.maximum(_word_scale(n), 1e-9) + model.bias)],
                                             names=["word", "value"])

    return run


def _scored(model: Model, labelled: bool):
    def run(batches):
        for batch in batches:
            for block in blocks.text_blocks(pc.utf8_lower(batch.column(1))):
                value = worst_words(block, model)
                cols = [batch.column(0).slice(block.lo, len(block))]
                if labelled:
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(value), batch.column(2).slice(block.lo, len(block))],
                                                     names=["doc_id", "value", "toxic"])
                else:
                    p = 1 / (1 + np.exp(-np.clip(model.slope * value + model.shift, -30, 30)))
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                     names=["doc_id", "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text).

    score: probability of label 1; predicted: 1 from 0.5 on. Null, empty and
    wordless texts get the lowest value any text can get. Without a model all
    rows score 0. Rows are answered one by one, null and repeated ids too;
    empty tables give empty results; extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return text.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return text.mapInArrow(_scored(model, False), "doc_id long, score double, predicted int")
