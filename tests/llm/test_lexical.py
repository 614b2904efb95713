"""Reversed lexical search against a document-by-document count; the query against DuckDB."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from gamelake.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string, score string, rank int"


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(items, docs, k=10):
    counts = [(doc, Counter(words(text))) for doc, text in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    sets = defaultdict(set)
    for item, text in items:
        sets[item] |= set(words(text))
    out = []
    for item, terms in sets.items():
        scored = []
        for doc, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // total if total else 10
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, items, docs, parts=3, k=10):
    docs = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(parts)
    rows = lexical.search(spark.createDataFrame(items, ITEMS), docs, k)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in rows.collect()], key=repr)


def corpus(n, seed=4):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "été", "日本", "a1", "b", "x" * 50, "naïve", "42", "Über", "k9"] + [f"w{i}" for i in range(60)]
    def text(size):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "-", "\n", "...", "_", "`"]) for _ in range(size))
    docs = [(i, text(rng.choice([0, 1, 5, 30, 200]))) for i in range(n)]
    items = [(i, text(rng.choice([0, 2, 8, 25]))) for i in range(30)]
    return items, docs


def test_equals_plain_scores(spark):
    items, docs = corpus(400)
    assert found(spark, items, docs) == plain(items, docs)


def test_item_blocks_give_the_same(spark, monkeypatch):
    items, docs = corpus(120, seed=9)
    monkeypatch.setattr(lexical, "POSTINGS", 40)
    monkeypatch.setattr(lexical, "CELLS", 64)
    assert found(spark, items, docs) == plain(items, docs)


def test_edge_rows(spark):
    same = [(i, "apple pie") for i in range(40, 0, -1)]
    docs = same + [(7, "apple pie"), (None, "apple pie"), (1000, None), (1001, ""), (1002, " .,;"), (1003, "pear " * 200_000), (1004, "plum")]
    items = [(1, "apple pie pie"), (2, None), (3, ""), (4, "nowhere"), (5, "PEAR"), (5, "plum"), (None, "plum")]
    got = found(spark, items, docs, parts=5)
    assert got == plain(items, docs)
    assert [r[2] for r in sorted(got, key=lambda r: (str(r[0]), r[1])) if r[0] == 1] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9]
    assert found(spark, items, []) == [] and found(spark, [], docs) == []
    assert found(spark, items, [(1, None)]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZz09é_ .\x7f日{@[`/:"), max_size=12), min_size=1, max_size=5))
def test_terms_as_the_pattern_finds_them(texts):
    import pyarrow as pa

    from gamelake.llm.blocks import LOWER_AZ, text_blocks
    for block in text_blocks(pa.array(texts), LOWER_AZ):
        begins, ends = block.runs(lexical.TERM_BYTES[block.buf])
        got = [(int(d), bytes(block.buf[b:e]).decode()) for b, e, d in zip(begins, ends, block.doc_of(begins))]
        assert got == [(i, w) for i, text in enumerate(texts) for w in words(text)]


def test_query_against_sql(spark, sf):
    for name in ("documents", "benchmark"):
        duckdb.execute(f"create or replace view {name} as select * from '{sf}/{name}.parquet'")
    want = duckdb.execute(queries.OP11_SQL).fetchall()
    got = queries.op11_reversed_search(spark, sf).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want
