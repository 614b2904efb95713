"""Language spans: script ranges narrow the candidates, Viterbi labels the words.

Words are letter runs of one script; scripts written without spaces give a word
per code point. Every word gets a score per language from hashed byte trigrams
(which do not cross texts); a language that does not use the word's script never
labels it, and words of a script that no learnt language uses are ``und`` spans.
The best labelling maximises the scores
less a penalty per change of language. Texts for which no stretch of words
gains more than half the penalty in another language are one span (exact: s
such stretches need at least s - 1 changes; found by largest partial sums); only the others walk the Viterbi recurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm import blocks
from gamelake.llm.tables import small_batches

SLOTS = 1 << 16
#: Scores are multiples of 1 / GRAIN, so sums are exact and do not depend on the texts beside a text.
GRAIN = 1 << 12
PENALTY = 12.0
#: Least score of a word against the best language, so that one odd word cannot switch the text.
FLOOR = -8.0
#: Fixed first code points of script ranges; a range ends where the next begins.
SCRIPTS = ((0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"),
           (0x600, "Arabic"), (0x900, "Devanagari"), (0x980, "Indic"), (0xE00, "Thai"), (0xE80, "Lao"),
           (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1780, "Khmer"),
           (0x1800, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2E80, "Han"), (0x3040, "Kana"),
           (0x3100, "Han"), (0xA4D0, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Other"),
           (0x20000, "Han"))
#: Fixed scripts written without spaces between words.
UNSPACED = ("Thai", "Lao", "Myanmar", "Khmer", "Kana", "Han")
#: Fixed ranges beyond ASCII that hold signs and no letters (first, last code point).
SIGNS = ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x2000, 0x2070), (0x20A0, 0x20CF),
         (0x2190, 0x2BFF), (0x2E00, 0x2E2E), (0x3000, 0x3004), (0x3008, 0x3020), (0xFE00, 0xFE6F), (0xFF00, 0xFF20),
         (0x1F000, 0x1FAFF))
#: Least share of a language's words for a script to count as its own.
SCRIPT_SHARE = 0.01

_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.asarray([c for c, _ in SCRIPTS])
_SCRIPT = np.asarray([_NAMES.index(name) for _, name in SCRIPTS])
_LATIN = _NAMES.index("Latin")
_UNSPACED = np.isin(_NAMES, UNSPACED)
_SIGN_EDGES = np.asarray(SIGNS).ravel() + np.tile([0, 1], len(SIGNS))
_COUNTS = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _words(block: blocks.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(which bytes belong to letters, starts, ends and scripts of the words)."""
    buf, n = block.buf, len(block.buf)
    letter = (buf >= 97) & (buf <= 122)
    script = np.full(n, _LATIN, dtype=np.int8)
    cut = np.ones(n + 1, dtype=bool)
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        b0 = buf[lead].astype(np.int64)
        tail = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int64) & 63
        b1, b2, b3 = tail[lead + 1], tail[lead + 2], tail[lead + 3]
        size = np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4))
        point = np.where(size == 2, ((b0 & 31) << 6) | b1, np.where(
            size == 3, ((b0 & 15) << 12) | (b1 << 6) | b2, ((b0 & 7) << 18) | (b1 << 12) | (b2 << 6) | b3))
        kind = _SCRIPT[np.searchsorted(_FIRST, point, side="right") - 1]
        sign = np.searchsorted(_SIGN_EDGES, point, side="right") % 2 == 1
        for i in range(4):
            at = lead[size > i] + i
            script[at], letter[at] = kind[size > i], ~sign[size > i]
    key = np.where(letter, script, -1)
    np.not_equal(key[1:], key[:-1], out=cut[1:n])
    if len(lead):
        cut[lead[_UNSPACED[kind]]] = True
    cut[block.offs] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    inside = letter[starts]
    return letter, starts[inside], ends[inside], script[starts[inside]]


def _trigrams(block: blocks.Block, letter: np.ndarray) -> np.ndarray:
    """Trigram slot of each byte; a text's first and last letters have blanks beside them."""
    own = np.where(letter, block.buf, 32).astype(np.uint32)
    before, after = np.full(len(own), 32, np.uint32), np.full(len(own), 32, np.uint32)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[block.offs[block.offs < len(own)]] = 32
    after[block.offs[block.offs > 0] - 1] = 32
    code = (before << 16) | (own << 8) | after
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def _count(batches):
    grams: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for block in blocks.text_blocks(pc.utf8_lower(batch.column(0))):
            letter, starts, _, script = _words(block)
            slot = _trigrams(block, letter)
            first = np.searchsorted(starts, block.offs)
            for d in range(len(block)):
                mine = grams.setdefault(langs[block.lo + d], np.zeros(SLOTS + len(_NAMES), np.int64))
                lo, hi = block.offs[d], block.offs[d + 1]
                mine[:SLOTS] += np.bincount(slot[lo:hi][letter[lo:hi]], minlength=SLOTS)
                mine[SLOTS:] += np.bincount(script[first[d]:first[d + 1]], minlength=len(_NAMES))
    for lang, n in grams.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                          pa.array(n[at], pa.int64())], schema=_COUNTS)


class Model:
    def __init__(self, langs: list[str], scores: np.ndarray, allowed: np.ndarray):
        self.langs, self.scores, self.allowed = langs, scores, allowed


def learn(docs: DataFrame) -> Model:
    """Trigram and script statistics of all rows with text and lang.

    They are counted in Spark per language and slot; the model is
    languages x ``SLOTS`` numbers, whatever the rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        "text is not null and lang is not null")
    counted = (rows.mapInArrow(_count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(counted.column("lang").to_pylist()))
    table = np.zeros((len(langs), SLOTS + len(_NAMES)))
    if langs:
        place = {lang: i for i, lang in enumerate(langs)}
        row = np.asarray([place[x] for x in counted.column("lang").to_pylist()])
        table[row, counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    grams, scripts = table[:, :SLOTS], table[:, SLOTS:]
    scores = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * SLOTS))
    scores = np.round(scores * GRAIN) / GRAIN
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(langs, scores, allowed)


def word_scores(block: blocks.Block, model: Model, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(score per word and language, at most 0; starts; ends; whether some language uses the word's script).

    A language that does not use a script scores worse than two changes, so
    that no best labelling gives it such a word.
    """
    letter, starts, ends, script = _words(block)
    slot = _trigrams(block, letter)
    out = np.zeros((len(starts), len(model.langs)))
    for i in range(len(model.langs)):
        total = np.concatenate([[0.0], np.cumsum(model.scores[i][slot])])
        out[:, i] = total[ends] - total[starts]
    fits = model.allowed[:, script].T
    known = fits.any(axis=1)
    out[~fits] = -np.inf
    out[~known] = 0.0  # a script of no known language says nothing
    out -= out.max(axis=1, keepdims=True)
    out = np.maximum(out, FLOOR)
    out[~fits & known[:, None]] = FLOOR - np.ceil(2 * penalty) - 1
    return out, starts, ends, known


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best language of each word; ``scores`` of all texts in a row, ``lengths`` words each.

    All texts advance together; equal totals stay in the language, then the
    first one wins.
    """
    n, k = scores.shape
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    left = lengths[order]
    back = np.zeros((n, k), dtype=np.int16)
    best = scores[np.minimum(begin, max(n - 1, 0))].copy()
    final = best.copy()
    for t in range(1, int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -t, side="left"))
        at = begin[:live] + t
        now = best[:live]
        top = now.argmax(axis=1)
        jump = now[np.arange(live), top] - penalty
        stay = now >= jump[:, None]
        back[at] = np.where(stay, np.arange(k), top[:, None])
        best = np.where(stay, now, jump[:, None]) + scores[at]
        final[:live] = best
    path = np.zeros(n, dtype=np.int64)
    state = final.argmax(axis=1)
    for t in range(int(left[0]) - 1 if len(left) else -1, -1, -1):
        live = int(np.searchsorted(-left, -t, side="left"))
        at = begin[:live] + t
        path[at] = state[:live]
        if t:
            state[:live] = back[at, state[:live]]
    return path


def one_language(scores: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """(best single language, whether more than one may be better) of each text."""
    n, k = scores.shape
    owner = np.repeat(np.arange(len(lengths)), lengths)
    total = np.column_stack([np.bincount(owner, weights=scores[:, i], minlength=len(lengths)) for i in range(k)])
    top = total.argmax(axis=1)
    base = scores[np.arange(n), top[owner]]
    mixed = np.zeros(len(lengths), dtype=bool)
    step = owner * (2 * (n * -scores.min(initial=FLOOR) + 1.0))  # each text's sums lie below those before it
    for i in range(k):
        gain = np.cumsum(scores[:, i] - base) - step
        least = np.minimum.accumulate(gain - (scores[:, i] - base))
        mixed[owner[gain - least > penalty / 2]] = True
    return top, mixed


def label_words(scores: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """``viterbi`` with the texts of one language found first."""
    top, mixed = one_language(scores, lengths, penalty)
    path = np.repeat(top, lengths)
    pick = np.repeat(mixed, lengths)
    if mixed.any():
        path[pick] = viterbi(scores[pick], lengths[mixed], penalty)
    return path


_LABELS = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(
    pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())])))])


def _labelled(model: Model, penalty: float):
    k = len(model.langs)

    def run(batches):
        for batch in batches:
            sizes, lengths, tops, mixeds, knowns, hard, letters = [], [], [], [], [], [], []
            for block in blocks.text_blocks(pc.utf8_lower(batch.column(1))):
                scores, starts, ends, known = (word_scores(block, model, penalty) if k else
                                               (np.zeros((0, 0)), np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)))
                first = np.searchsorted(starts, block.offs)
                n = np.diff(first)
                if len(starts):
                    top, mixed = one_language(scores, n, penalty)
                    hard.append(scores[np.repeat(mixed, n)])
                else:
                    top, mixed = np.zeros(len(block), int), np.zeros(len(block), bool)
                ascii_letters = np.concatenate([[0], np.cumsum((block.buf >= 97) & (block.buf <= 122))])
                for d in range(len(block)):
                    lo, hi = block.offs[d], block.offs[d + 1]
                    letters.append(n[d] > 0 and (ascii_letters[hi] > ascii_letters[lo]
                                                 or any(c.isalpha() for c in block.buf[lo:hi].tobytes().decode("utf-8"))))
                for got, one in ((sizes, ends - starts), (lengths, n), (tops, top), (mixeds, mixed), (knowns, known)):
                    got.append(one)
            if not lengths:
                continue
            sizes, lengths, tops, mixeds, knowns = (np.concatenate(x) for x in (sizes, lengths, tops, mixeds, knowns))
            path = np.repeat(tops, lengths)
            if mixeds.any():  # one walk for all mixed texts of the batch
                path[np.repeat(mixeds, lengths)] = viterbi(np.concatenate(hard), lengths[mixeds], penalty)
            path[~knowns] = k
            names = [*model.langs, "und"]
            pred, share, spans = [], [], []
            at = 0
            for d, n in enumerate(lengths.tolist()):
                own, size = path[at: at + n], sizes[at: at + n]
                at += n
                if not letters[d]:
                    pred.append("und")
                    share.append(0.0)
                    spans.append([])
                    continue
                part = np.bincount(own, weights=size, minlength=k + 1)
                win = int(part[:k].argmax())
                pred.append(model.langs[win])
                share.append(float(part[win] / part.sum()))
                cut = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [n]]).tolist()
                spans.append([{"lang": names[own[a]], "first_word": a, "n_words": b - a} for a, b in zip(cut[:-1], cut[1:])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(share, pa.float64()),
                                              pa.array(spans, _LABELS.field("spans").type)], schema=_LABELS)

    return run


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """(doc_id, lang_pred, score, spans) for every row of ``docs`` (doc_id, text).

    spans: the labelled stretches of words (runs of letters of one script,
    lower-cased; single code points of scripts without spaces) in order, ``und``
    where no learnt language uses the script; lang_pred: the learnt language of
    most letter bytes (ties and none: first in name order); score: its share of
    all letter bytes. An answer depends on the text alone. Null texts and texts without letters,
    and all texts when no language was learnt, are ``und`` with score 0 and no
    spans. Null doc_ids and repeated rows are answered row by row; empty
    tables give empty results; extra columns are ignored.
    """
    small_batches(docs.sparkSession, 4000)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_labelled(model, penalty), "doc_id long, lang_pred string, score double, "
                           "spans array<struct<lang:string,first_word:int,n_words:int>>")
