"""Mixing against a plain re-computation: exponent, quotas, cut, epochs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from gamelake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def place(doc_id, epoch):
    name = f"mix:{epoch}:{'null' if doc_id is None else doc_id}"
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def plain(rows, target_entropy=None, max_repeats=None):
    """Counter of (doc_id, source, epoch)."""
    tokens = [(d, s, len(WORD.findall(t or ""))) for d, s, t in rows]
    total = defaultdict(int)
    for _, s, n in tokens:
        total[s] += n
    total = {s: n for s, n in total.items() if n}
    out = Counter()
    if total:
        whole = sum(total.values())
        p = {s: n / whole for s, n in total.items()}

        def entropy(x):
            z = sum(v ** x for v in p.values())
            return -sum(v ** x / z * math.log(v ** x / z) for v in p.values())

        lo, hi = 0.0, 1.0
        if len(p) == 1:
            x = 1.0
        elif target_entropy is not None:
            x = 1.0 if entropy(1.0) >= target_entropy * math.log(len(p)) else None
            while x is None and hi - lo > 1e-13:
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if entropy(mid) >= target_entropy * math.log(len(p)) else (lo, mid)
            x = lo if x is None else x
        else:
            spread = max(p.values()) / min(p.values())
            x = 0.0 if spread <= max_repeats else 1 - math.log(max_repeats) / math.log(spread)
        most = max(p.values())
    for s in {s for _, s, _ in tokens}:
        own = [(d, n) for d, q, n in tokens if q == s]
        if s not in total:
            out.update((d, s, 0) for d, _ in own)
            continue
        quota = round(total[s] * (most / p[s]) ** (1 - x))
        epochs, rest = divmod(quota, total[s])
        for e in range(epochs):
            out.update((d, s, e) for d, _ in own)
        by = defaultdict(list)
        for d, n in own:
            by[place(d, epochs)].append((d, n))
        for k in sorted(by):
            rest -= sum(n for _, n in by[k])
            if rest < 0:
                break
            out.update((d, s, epochs) for d, _ in by[k])
    return out


def got(df):
    return Counter((r["doc_id"], r["source"], r["mix_epoch"]) for r in df.collect())


@pytest.mark.parametrize("options", [{"target_entropy": 0.99}, {"max_repeats": 1.5}, {"target_entropy": 0.1}, {"max_repeats": 1.0}])
def test_matches_plain_mix(spark, sf, options):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    out = mixing.mix(docs, **options)
    assert out.columns == [*docs.columns, "mix_epoch", "mix_block", "mix_order"]
    assert got(out) == plain(rows, **options)


def test_weights_meet_the_target(spark, sf):
    quotas, x = mixing.plan(spark.read.parquet(f"{sf}/documents.parquet"), target_entropy=0.99)
    w = [r["weight"] for r in quotas.collect()]
    assert 0 < x < 1 and abs(sum(w) - 1) < 1e-9
    assert abs(-sum(v * math.log(v) for v in w) / math.log(len(w)) - 0.99) < 1e-6


def test_edge_rows(spark):
    rows = [(1, "a", "x " * 5000), (2, "a", None), (3, None, "one two"), (3, None, "one two"), (None, None, "w"),
            (4, "null", "one"), (5, "empty", ""), (6, "empty", None), (7, "b", "k " * 40), (8, "=b", "k")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, text string, mix_epoch int, skey string")
    for options in ({"target_entropy": 0.9}, {"max_repeats": 3.0}):
        out = mixing.mix(df, **options)
        assert got(out) == plain(rows, **options)
        assert "skey" in out.columns
    assert mixing.mix(df.limit(0), target_entropy=0.5).count() == 0
    assert got(mixing.mix(df.filter("source = 'a'"), max_repeats=2.0)) == {(1, "a", 0): 1, (2, "a", 0): 1}
    with pytest.raises(ValueError):
        mixing.mix(df)
