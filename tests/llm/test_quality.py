"""Rule statistics against a plain re-count; forest and calibration behaviour."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from gamelake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed)


def test_statistics_match_plain_count(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for d, text in texts:
        r = rows[d]
        assert tuple(r[c] for c in (*quality.COUNTS, "base_failed")) == plain(text), d
        assert not (r["base_failed"] and r["kept"])


def test_anomalies_are_rejected_and_good_kept(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.judge(docs, labels).join(labels, "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in out if r["quality"] == 1]
    bad = [r["kept"] for r in out if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_edge_rows(spark):
    line = "same line again here\n"
    long = " ".join(f"w{i}" for i in range(40000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, line * 3), (5, long), (6, "a" * 50000), (7, "x\n\nx\n \nx"),
            (8, "# * $ é ß z " * 10), (None, "word"), (4, line * 3)]
    docs = spark.createDataFrame([(i, t, 7, 0) for i, t in rows], "doc_id long, text string, n_words int, quality int")
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 0, 0), (8, None, None), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    out = quality.judge(docs, labels).collect()
    assert sorted(tuple(r[c] for c in (*quality.COUNTS, "base_failed")) for r in out) == sorted(plain(t) for _, t in rows)
    assert quality.judge(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [5]


def test_bad_inside_and_outside_usual_ranges_differ_from_good(spark):
    """Bad documents whose rates are all common ones (longer words, some digits) are rejected if the labels say so,
    and rates beyond any limit stay apart."""
    rng = np.random.default_rng(5)

    def text(size, marks):
        words = ["".join(rng.choice(list("abcdefgh"), max(3, int(rng.normal(size, 1))))) for _ in range(60)]
        return " ".join(words) + marks

    rows = [(i, text(8.5, " 12") if i % 10 == 0 else text(5, "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(300)], "doc_id long, quality int")
    out = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    assert np.mean([out[i] for i in range(600) if i % 10]) > 0.98 and np.mean([out[i] for i in range(300, 600, 10)]) < 0.1
    [block] = list(quality.blocks.text_blocks(pa.array([" ".join(["x" * 11] * 20), " ".join(["x" * 500] * 20)])))
    assert np.diff(quality.block_statistics(block)["mean_word"])[0] > 1


def test_calibration_limits():
    assert quality.calibrate([]) is None and quality.calibrate([(0.5, 3, 0)]) is None
    assert quality.calibrate([(0.4, 100, 0), (0.6, 0, 10)]) == 0.5
    assert quality.calibrate([(0.4, 50, 0), (0.6, 50, 10)], max_loss=0.1) is None


def plain_rates(text):
    """The nine rates of one text, read off the rules."""
    words, own = WORD.findall(text), Counter(text)
    n, chars = len(words), sum(map(len, WORD.findall(text)))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = sum(own[c] for c in own if c.isascii() and c.isalpha())
    _, _, symbols, dup, covered, _ = plain(text)
    same = sum(a == b for a, b in zip(words, words[1:]))
    bare = sum(not re.search(r"[A-Za-zÀ-\U0010FFFF]", w) for w in words)
    some = max(n, 1)
    return [symbols / some, (own["!"] + own["?"]) / some, dup / max(len(lines), 1), covered / some,
            sum(own[c] for c in own if c.isascii() and c.isupper()) / max(letters, 1), sum(own[c] for c in "0123456789") / max(chars, 1),
            chars / some, same / some, bare / some]


def test_all_rates_match_a_plain_count_whatever_stands_beside():
    rng = np.random.default_rng(4)
    parts = ["hello", "hello", "there", "we", "WE", "12", "#", "é", "!?", "\n", "a b c d e f g h", "…"]
    texts = ["we say hello", "hello there my friend", "friend", "friend friend", "", "\n", "x"]
    texts += [" ".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(80)]
    for order in (np.arange(len(texts)), rng.permutation(len(texts))):
        rows = [texts[i] for i in order]
        [block] = list(quality.blocks.text_blocks(pa.array(rows)))
        got = quality.block_statistics(block)
        want = np.log1p([plain_rates(t) if WORD.search(t) else [0.0] * 9 for t in rows])
        assert np.allclose(np.column_stack([got[f] for f in quality.FEATURES]), want, rtol=0, atol=1e-12)


def test_rows_that_share_an_id_are_judged_apart(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(None, good), (None, "bad"), (5, good), (5, "bad"), (5, None), (6, good), (6, good)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, text_hash int")
    kept = quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, good), (5, good), (6, good), (6, good)]
