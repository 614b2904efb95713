"""Ranked lexical search (operator 11): documents stream through an index of the items.

The usual roles are reversed. The items' terms form a small inverted index
(term -> items), which is broadcast; the documents are read twice and never
shuffled. The first reading counts documents, terms and the document
frequency of the items' terms. The second scores each document against the
index and keeps, per task and item, the k best; those heaps are merged by
item. Items beyond ``POSTINGS`` index entries are searched in blocks, each
with both readings, so the broadcast stays bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.blocks import LOWER_AZ, among, text_blocks
from gamelake.llm.tables import small_batches

#: Most (term, item) entries and items of one broadcast index (one item's own terms may go beyond).
POSTINGS, ITEMS = 1_000_000, 20_000
#: Cells (documents x items) scored at a time in a task.
CELLS = 1 << 21
#: Tasks whose heaps are merged together before the last merge.
MERGED = 256

#: Letters and digits of ASCII and everything beyond ASCII.
TERM_BYTES = np.zeros(256, dtype=bool)
TERM_BYTES[48:58] = TERM_BYTES[65:91] = TERM_BYTES[97:123] = TERM_BYTES[128:] = True
#: Stands for a document without an id: after all others among equal scores.
NO_ID = np.iinfo(np.int64).max


def terms(block) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every term of a block of texts, and the text it stands in."""
    begins, ends = block.runs(TERM_BYTES[block.buf])
    return block.hashes(begins, ends), block.doc_of(begins)


class Index:
    """Sorted term hashes with their items: ``items[bounds[t]:bounds[t + 1]]`` hold term t."""

    def __init__(self, owners: np.ndarray, hashes: np.ndarray, n_items: int):
        pairs = np.unique(np.rec.fromarrays([hashes, owners], names="h,o"))
        self.terms, first = np.unique(pairs["h"], return_index=True)
        self.items = pairs["o"].astype(np.int64)
        self.bounds = np.append(first, len(pairs)).astype(np.int64)
        self.n_items = n_items

    def counts(self, block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text of the block, and (text, term, tf) of those in the index."""
        hashes, doc = terms(block)
        found = among(hashes, self.terms)
        size = max(len(self.terms), 1)
        key, tf = np.unique(doc[found] * size + np.searchsorted(self.terms, hashes[found]), return_counts=True)
        return np.bincount(doc, minlength=len(block)), key // size, key % size, tf.astype(np.int64)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, Index]]:
    """The items in blocks of bounded index size, in id order. Rows that share an id are one item."""
    ids: list = []
    owners, hashes, held = [], [], 0
    rows = items.select(id_col, text_col).orderBy(F.asc_nulls_last(id_col)).toLocalIterator(prefetchPartitions=False)
    for item, text in rows:
        if not ids or item != ids[-1]:
            if held >= POSTINGS or len(ids) >= ITEMS:
                yield ids, Index(np.concatenate(owners), np.concatenate(hashes), len(ids))
                ids, owners, hashes, held = [], [], [], 0
            ids.append(item)
        for block in text_blocks(pa.array([text], pa.string()), LOWER_AZ):
            found = np.unique(terms(block)[0])
            owners.append(np.full(len(found), len(ids) - 1))
            hashes.append(found)
            held += len(found)
    if ids:
        yield ids, Index(np.concatenate(owners), np.concatenate(hashes), len(ids))


def _counted(shared):
    """Rows (term, n) of a task: document frequencies of the index terms, -1 documents with a term, -2 all their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        df = np.zeros(len(index.terms), np.int64)
        docs = total = 0
        for batch in batches:
            for block in text_blocks(batch.column(0), LOWER_AZ):
                n, _, term, _ = index.counts(block)
                df += np.bincount(term, minlength=len(df))
                docs, total = docs + int((n > 0).sum()), total + int(n.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, [-1, -2])), pa.array(np.append(df[seen], [docs, total]))], ["term", "n"])
    return run


def best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k entries of each item with highest score, equal ones by document, sorted by item."""
    order = np.lexsort((doc, -score, item))
    item, score, doc = item[order], score[order], doc[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return item[place < k], score[place < k], doc[place < k]


def _heaps(shared, shared_weights, docs: int, total: int, k: int):
    """Rows (item, score, doc_id) of a task: its k best documents of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights = shared.value, shared_weights.value
        heap = tuple(np.zeros(0, np.int64) for _ in range(3))
        floor = np.ones(index.n_items, np.int64)  # what a document must reach to enter
        step = max(CELLS // index.n_items, 1)
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy()
            for block in text_blocks(batch.column(1), LOWER_AZ):
                n, text, term, tf = index.counts(block)
                # Python integers: 90 * n * N may pass 64 bits on a huge corpus.
                m = np.array([100 - 90 + 90 * x * docs // total for x in n.tolist()], dtype=np.int64)
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[text]))
                for lo in range(0, len(block), step):
                    a, b = np.searchsorted(text, [lo, lo + step])
                    width = index.bounds[term[a:b] + 1] - index.bounds[term[a:b]]
                    at = np.repeat(index.bounds[term[a:b]] - np.append(0, np.cumsum(width)[:-1]), width) + np.arange(width.sum())
                    cells = np.zeros((min(step, len(block) - lo), index.n_items), np.int64)
                    np.add.at(cells.reshape(-1), np.repeat(text[a:b] - lo, width) * index.n_items + index.items[at], np.repeat(value[a:b], width))
                    doc, item = np.nonzero(cells >= floor)
                    if len(doc):
                        new = (item, cells[doc, item], ids[block.lo + lo + doc])
                        heap = best(*[np.concatenate(pair) for pair in zip(heap, new)], k)
                        full = np.flatnonzero(np.bincount(heap[0], minlength=index.n_items) >= k)
                        floor[full] = heap[1][np.searchsorted(heap[0], full, side="right") - 1]
        yield pa.RecordBatch.from_arrays([pa.array(heap[0]), pa.array(heap[1]), pa.array(heap[2], mask=heap[2] == NO_ID)], ["item", "score", "doc_id"])
    return run


def _top(heaps: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(items: DataFrame, docs: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0.

    Every row of ``docs`` is a document, also where ids repeat; one without an
    id comes last among equal scores. Null and empty texts hold no term; an
    item without terms, or whose terms stand nowhere, gives no row. Rows of
    ``items`` with the same id are one item. Whole texts of any length are
    read. Without items or documents there are no rows; other columns are
    ignored. Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_batches(spark, 400)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text"))
    id_type = items.schema[item_id].dataType.simpleString()
    out = None
    for ids, index in item_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(index)
        counted = texts.select("text").mapInArrow(_counted(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        stats = {r["term"]: r["n"] for r in counted.collect()}  # one row for each term of the index
        n_docs, n_terms = stats.pop(-1, 0), stats.pop(-2, 0)
        if not n_docs:
            break
        weights = spark.sparkContext.broadcast(np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * stats.get(t, 0) + 1))) for t in range(len(index.terms))], dtype=np.int64))
        heaps = texts.mapInArrow(_heaps(shared, weights, n_docs, n_terms, k), "item long, score long, doc_id long")
        heaps = _top(heaps.withColumn("lot", F.spark_partition_id() % F.lit(MERGED)), k, "item", "lot")
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {id_type}")
        found = _top(heaps, k, "item").join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    return out
