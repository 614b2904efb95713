"""Toxicity: held-out accuracy, gapped and altered insults, kernel by definition, edge rows."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from gamelake.llm import blocks, toxicity


def test_held_out_accuracy_and_tolerance(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.learn(docs.filter(~out), labels.filter(~out))
    rows = toxicity.score(docs.filter(out), model).join(labels, "doc_id").select("toxic", "predicted").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.9
    texts = ["the i.d.i.o.t said", "an i d i o t too", "id-iot", "plain words of the day"]
    [block] = list(toxicity.blocks.text_blocks(pc.utf8_lower(pa.array(texts))))
    value = toxicity.worst_words(block, model)
    assert (value[:3] > value[3] + 1).all()
    rows = [(1, None), (2, ""), (3, " \n"), (4, "idiot " * 20000), (5, "x" * 30000), (None, "idiot"), (5, "é ß 漢 1")]
    df = spark.createDataFrame([(d, t, 1.0, 7) for d, t in rows], "doc_id long, text string, score double, value int")
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert [r["predicted"] for r in got][:6] == [0, 0, 0, 1, 0, 1]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels) is None
    assert {tuple(r) for r in toxicity.score(docs, None).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_word_sums_follow_the_kernel():
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(1, 31, n).tolist()) for n in (1, 2, 3, 5, 9, 12)]
    other = toxicity._image(bytes(rng.integers(1, 31, 10).tolist()))
    table = np.zeros(toxicity.SEQUENCES)
    table[list(other)] = list(other.values())
    n = np.asarray([len(w) for w in words])
    e = np.cumsum(n)
    sums = toxicity._sums(np.frombuffer(b"".join(words), np.uint8), e - n, e, table)
    scale = np.maximum(toxicity._word_scale(n), 1e-9)
    for w, got in zip(words, sums / scale):
        assert abs(got - sum(v * other.get(k, 0.0) for k, v in toxicity._image(w).items())) < 1e-9


def test_folding_joins_spaced_letters():
    [block] = list(blocks.text_blocks(pa.array(["you i d i o t! a b", "1d-10t", ""])))
    folded = toxicity.fold(block)
    starts, ends = toxicity.word_runs(folded)
    words = ["".join(chr(96 + c) for c in folded.buf[a:b]) for a, b in zip(starts, ends)]
    assert words[:2] == ["you", "idiotab"] and words[2] == "idiot"


def test_values_do_not_depend_on_neighbours():
    """A text alone and among others in any order: equal but for the last bits of running sums."""
    rng = np.random.default_rng(11)
    model = toxicity.Model(rng.normal(size=toxicity.SEQUENCES), -0.3, 1.0, 0.0)
    texts = ["", "one", "a b", "i d i o t", "fox zzz", "zzz fox", "пример слова", "é ß 漢 1", " \n", "x" * 5000, "end a", "b begin", "one"]

    def values(rows):
        [block] = list(blocks.text_blocks(pc.utf8_lower(pa.array(rows))))
        return toxicity.worst_words(block, model)

    alone = np.concatenate([values([t]) for t in texts])
    for _ in range(5):
        order = rng.permutation(len(texts))
        assert np.abs(values([texts[i] for i in order]) - alone[order]).max() < 1e-9
