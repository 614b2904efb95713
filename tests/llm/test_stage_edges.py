"""Every stage of the corpus pipeline on edge rows and on an empty table."""

import corpus_pipeline
import pytest

STAGES = dict(corpus_pipeline.STAGES)


def edge_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    base = docs.filter("text is not null").orderBy("doc_id").limit(3).collect()
    at = {c: i for i, c in enumerate(docs.columns)}

    def row(like, **new):
        out = list(like)
        for c, v in new.items():
            out[at[c]] = v
        return tuple(out)

    rows = [tuple(base[0]), tuple(base[0]), row(base[1], doc_id=900001, text=None), row(base[1], doc_id=900002, text=""),
            row(base[1], doc_id=None), row(base[2], doc_id=900003, text=" ".join(f"w{i}" for i in range(60000))),
            tuple(None for _ in docs.columns), row(base[2], doc_id=900004), row(base[2], doc_id=900005)]
    return spark.createDataFrame(rows, docs.schema)


@pytest.mark.parametrize("name", list(STAGES))
def test_edge_rows_and_empty_table(spark, sf, name):
    docs = edge_rows(spark, sf)
    got = STAGES[name](spark, docs, sf)
    rows = got.collect()
    empty = STAGES[name](spark, docs.limit(0), sf)
    assert empty.columns == got.columns and empty.count() == 0
    if name == "packing":
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
        return
    assert got.columns == docs.columns
    given = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in rows} <= given
    ids = [r["doc_id"] for r in rows]
    if name == "line_dedup":
        assert {900001, 900002, 900003} <= set(ids) and next(r["text"] for r in rows if r["doc_id"] == 900001) is None
    if name == "minhash_near_dedup":
        assert {900001, 900002, 900003} <= set(ids) and not {900004, 900005} <= set(ids)
    if name == "source_mixing":
        assert set(ids) == given
