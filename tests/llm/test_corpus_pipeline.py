"""The pipeline's stages against what each promises, on whole small tables."""

import corpus_pipeline
from gamelake.llm import packing

from test_line_dedup import brute as brute_lines
from test_minhash import brute as brute_near


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, given = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.written(stage(spark, docs, sf), name)
        after = docs.collect()
        given.append((name, before, after))
        if name != "packing":
            assert docs.columns == columns
    (_, raw, good), (_, _, lined), (_, _, single), (_, _, mixed), (_, _, packed) = given
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    lost_good = [r["doc_id"] for r in raw if labels.get(r["doc_id"]) == 1 and r["doc_id"] not in kept and len((r["text"] or "").split()) >= 20]
    assert len(lost_good) <= 0.02 * len(raw) and len(good) < len(raw)
    texts = brute_lines([(r["doc_id"], r["text"]) for r in good])
    assert {r["doc_id"]: r["text"] for r in lined} == {d: t for d, t in texts.items() if t.split()}
    near = brute_near([(r["doc_id"], r["text"]) for r in lined], 5)
    assert {r["doc_id"] for r in single} == {d for d, (_, _, keep) in near.items() if keep}
    assert {r["doc_id"] for r in mixed} == {r["doc_id"] for r in single} and len(mixed) >= len(single)
    assert {p["doc_id"] for p in packed} == {r["doc_id"] for r in mixed}
    assert sum(p["start"] == 0 for p in packed) == len(mixed) and max(p["length"] for p in packed) <= packing.LENGTH
