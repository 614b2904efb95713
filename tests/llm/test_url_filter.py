"""Temporal URL lists against a day-by-day replay of the entries; the query against DuckDB."""

import datetime as dt
import random
import re

import duckdb

from gamelake.llm import queries, url_filter

HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)")
PATH = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)")


def plain(captures, entries):
    out = []
    for page, url, day in captures:
        host = HOST.match(url or "")
        host = host.group(1).lower() if host else ""
        path = PATH.match(url or "")
        steps = path.group(1).split("/") if path else [""]
        keys = set()
        if host:
            labels = host.split(".")
            keys |= {("host", ".".join(labels[i:])) for i in range(len(labels))}
            keys |= {("path", (host + "/".join(steps[:i])).lower()) for i in range(2, len(steps) + 1)}
        active = set()
        for name, kind, pattern in {e[:3] for e in entries if None not in e}:
            if day is None or (kind, pattern) not in keys:
                continue
            past = [(d, a) for n, k, p, d, a in entries if (n, k, p) == (name, kind, pattern) and d is not None and a in ("add", "remove") and d <= day]
            if past:
                last = max(d for d, _ in past)
                if all(a == "add" for d, a in past if d == last):
                    active.add((name, pattern))
        lists = sorted({n for n, _ in active})
        best = min(((-len(p), p) for _, p in active), default=(0, None))[1]
        out.append((page, host, day, len(active), ",".join(lists), best, bool(set(lists) - {"allow"}) and "allow" not in lists))
    return out


def key(rows):
    return sorted(rows, key=repr)


def test_replay(spark):
    rnd = random.Random(6)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(40))
    hosts = ["a.example.com", "b.example.com", "example.com", "x.org"]
    entries = [(rnd.choice(["spam", "ads", "allow"]), *rnd.choice([("host", rnd.choice(hosts)), ("path", rnd.choice(hosts) + rnd.choice(["/", "/q", "/q/r"]))]),
                day(), rnd.choice(["add", "remove"])) for _ in range(150)]
    entries += [("spam", "host", None, day(), "add"), ("spam", "host", "x.org", None, "add"), (None, "host", "x.org", day(), "add")]
    captures = [(i, rnd.choice(["http://", "HTTPS://u:p@"]) + rnd.choice(hosts).upper() + rnd.choice(["", "/", "/q/r/s?x=/z", "/Q#f", ":80/q"]), day())
                for i in range(300)]
    captures += [(900, None, day()), (901, "not a url", day()), (902, "http://x.org/" + "p/" * 3000, None), (903, "", None)] + captures[:1]
    cdf = spark.createDataFrame([(*c, "x") for c in captures], "page_id long, url string, fetched date, lists string")
    edf = spark.createDataFrame(entries, "list string, kind string, pattern string, day date, action string")
    assert key(tuple(r) for r in url_filter.judge(cdf, edf).collect()) == key(plain(captures, entries))
    assert {r["blocked"] for r in url_filter.judge(cdf, edf.limit(0)).collect()} == {False}
    assert url_filter.judge(cdf.limit(0), edf).count() == 0


def test_query_matches_duckdb(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    want = con.execute(queries.OP8_SQL).fetchall()
    got = queries.op8_temporal_url_lists(spark, sf).collect()
    assert key(tuple(r) for r in got) == key(want) and any(r["blocked"] for r in got)
