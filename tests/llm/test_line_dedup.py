"""Line dedup against brute force over all pairs of lines."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gamelake.llm import line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]")


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def within(a, b, edits):
    """Whether at most ``edits`` edits lead from a to b (tries each edit at the first difference)."""
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    if not a or not b:
        return max(len(a), len(b)) <= edits
    return edits > 0 and (within(a[1:], b[1:], edits - 1) or within(a[1:], b, edits - 1) or within(a, b[1:], edits - 1))


def brute(rows, edits=2, least=20):
    """doc_id -> text after dedup, for distinct doc_ids."""
    seen = {}
    for d, t in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for pos, line in enumerate(dict.fromkeys(t.split("\n"))):
            if WORD.search(line):
                seen.setdefault(line, (d, pos))
    top = {line: line for line in seen}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    names = [x for x in seen if len(x) >= least]
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if abs(len(a) - len(b)) <= edits and within(a, b, edits):
                top[find(a)] = find(b)
    head = {}
    for line in seen:
        r = find(line)
        head[r] = min(head.get(r, (seen[line], line)), (seen[line], line))
    out = {}
    for d, t in rows:
        if d is None or t is None:
            out[d] = t
            continue
        kept, own = [], set()
        for line in t.split("\n"):
            if WORD.search(line):
                (doc, _), first = head[find(line)]
                if doc != d or first != line or line in own:
                    continue
                own.add(line)
            kept.append(line)
        out[d] = "\n".join(kept)
    return out


def got(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def near_rows(seed, docs=40):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randrange(3, 70))) for _ in range(25)]
    rows = []
    for d in range(docs):
        lines = []
        for _ in range(rnd.randrange(0, 9)):
            line = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                p = rnd.randrange(len(line) + 1)
                k = rnd.randrange(3)
                if k == 0:
                    line.insert(p, rnd.choice("abcé"))
                elif line and k == 1:
                    line.pop(p % len(line))
                elif line:
                    line[p % len(line)] = "z"
            lines.append("".join(line))
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = near_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(line_dedup.dedup_lines(df)) == brute(rows)


def greedy(rows, edits=2, least=20):
    """doc_id -> text, where a line goes only if an earlier line that stays is equal or near."""
    stays, out = [], {}
    for d, t in sorted(rows):
        kept = []
        for line in t.split("\n"):
            if WORD.search(line):
                if line in stays or len(line) >= least and any(
                        len(x) >= least and abs(len(x) - len(line)) <= edits and within(x, line, edits) for x in stays):
                    continue
                stays.append(line)
            kept.append(line)
        out[d] = "\n".join(kept)
    return out


def test_direct_keeps_lines_far_from_the_kept_one(spark):
    chain = [(i, "item of the list number " + "7" * i + "0" * (12 - i)) for i in range(13)]
    for rows in (chain, near_rows(1), near_rows(2)):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert got(line_dedup.dedup_lines(df, direct=True)) == greedy(rows)


def test_distance_filter(spark):
    rnd = random.Random(9)
    pairs = []
    for _ in range(400):
        a = "".join(rnd.choice("abcé") for _ in range(rnd.randrange(4, 90)))
        b = list(a)
        for _ in range(rnd.randrange(0, 5)):
            p = rnd.randrange(len(b) + 1)
            b[p:p + rnd.randrange(2)] = rnd.choice(["", "a", "x"])
        if len(b) > 3:
            pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2):
        rows = df.select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), edits).alias("ok")).collect()
        assert all(r["ok"] == (distance(r["a"], r["b"]) <= edits) for r in rows)


def test_edge_rows(spark):
    long = "y" * 40000
    rows = [(1, None), (2, ""), (3, " \n\n\t"), (4, "short\nshort\nother"), (5, "short\n\n\nanother line with some words"),
            (6, "another line with some wordz"), (7, long), (8, long + "z\nkeep"), (9, "short")]
    df = spark.createDataFrame([(d, t, 3, "s", "h") for d, t in rows], "doc_id long, text string, n_lines int, key string, h string")
    out = line_dedup.dedup_lines(df)
    assert got(out) == brute(rows)
    assert out.columns == ["doc_id", "text", "key", "h", "n_lines", "n_removed"]
    counts = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in out.collect()}
    assert counts[1] == (0, 0) and counts[2] == (1, 0) and counts[4] == (3, 1) and counts[9] == (1, 1) and counts[8] == (2, 1)
    none = spark.createDataFrame([(None, "short line\nshort line"), (1, "short line"), (1, "short line")], "doc_id long, text string")
    texts = sorted(r["text"] for r in line_dedup.dedup_lines(none).collect())
    assert texts == ["short line", "short line", "short line\nshort line"]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(near_rows(3, 5), "doc_id long, text string")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
