"""MinHash near-duplicates against brute force over all pairs of shingle sets."""

import re

from gamelake.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, k, percent=80):
    sets = {d: shingles(t, k) for d, t in rows}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                top[q] = p
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_matches_brute_force_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    for k in (4, 5):
        assert got(minhash.near_duplicates(docs, k=k)) == brute(rows, k)


def test_edge_rows_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, long), (8, long + " x"),
            (9, "ÄB c d e f"), (10, "äb c d e f"), (10, "äb c d e f"), (11, "one two three four five six")]
    df = spark.createDataFrame([(i, t, "x", 1, True) for i, t in rows], "doc_id long, text string, sig string, id int, kept boolean")
    out = [tuple(r) for r in minhash.near_duplicates(df, k=4).collect()]
    assert len(out) == len(rows)
    by = {r[0]: r for r in out}
    assert by[1][1:3] == (0, 1) and by[2][1:3] == (0, 2) and by[3][1:3] == (0, 3)
    assert by[4][2] == by[5][2] == 4 and not by[5][4]
    assert by[6][2] == 6 and by[7][2] == by[8][2] == 7 and by[9][2] == 9 and by[10][2] == 10
    none = spark.createDataFrame([(None, "a b c d"), (3, "a b c d")], "doc_id long, text string")
    assert {r[0]: r[2] for r in minhash.near_duplicates(none).collect()} == {None: None, 3: 3}
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    assert minhash.keep_one(df, k=4).columns == df.columns


def test_chain_of_near_copies_is_one_component(spark):
    """Links that no hub shares still join one component (hub rounds)."""
    import random

    rnd = random.Random(5)
    words = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[rnd.randrange(200)] = f"n{i}"
        words[rnd.randrange(200)] = f"m{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.near_duplicates(df, k=4)) == brute(rows, 4)


def test_agreement_floor_is_a_posterior_bound():
    floor = dict(minhash.agreement_floor(0.8, 1e-6, 16))
    assert floor[16] < floor[64] < floor[128] < 0.8 * 128
