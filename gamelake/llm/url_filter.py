"""URL filters that change over time: every capture is judged by the list entries of its day.

Dated ``add`` and ``remove`` entries of (list, kind, pattern) become validity
intervals. A capture's keys (its host and parent domains, its path prefixes)
meet a pattern's intervals in one equi-join, where the few intervals of a
pattern are one sorted array; the as-of condition picks those that hold at
fetch time. A popular host so gives one row per capture, not one per interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A list of this name lifts what other lists block.
ALLOW = "allow"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _HOST, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), _PATH, 1)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to) from dated entries.

    ``entries``: list, kind ('host' or 'path'), pattern, day (date), action
    ('add' or 'remove'). Rows with nulls or other actions are left out. An
    entry holds from its add to the day of its next remove (exclusive; null:
    still open). On one day a remove wins; repeated adds and removes change
    nothing.
    """
    daily = (entries.filter("list is not null and pattern is not null and day is not null and kind in ('host', 'path') "
                            "and action in ('add', 'remove')")
             .groupBy("list", "kind", F.lower("pattern").alias("pattern"), "day").agg(F.min(F.col("action") == "add").alias("on")))
    order = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    turns = (daily.withColumn("was", F.coalesce(F.lag("on").over(order), F.lit(False))).filter("`on` <> was")
             .withColumn("valid_to", F.lead("day").over(order)))
    return turns.filter("`on`").select("list", "kind", "pattern", F.col("day").alias("valid_from"), "valid_to")


def keys_of(url: Column) -> Column:
    """Array of (kind, key): host and parent domains; host with each path prefix at a '/'."""
    host = host_of(url)
    labels, steps = F.split(host, r"\."), F.split(path_of(url), "/")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.struct(F.lit("host").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    paths = F.transform(F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))),
                        lambda i: F.struct(F.lit("path").alias("kind"),
                                           F.lower(F.concat(host, F.array_join(F.slice(steps, 1, i), "/"))).alias("key")))
    return F.when(host == "", F.array().cast("array<struct<kind:string,key:string>>")).otherwise(
        F.array_distinct(F.concat(hosts, F.when(F.size(steps) > 1, paths).otherwise(F.array().cast("array<struct<kind:string,key:string>>")))))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, host, fetched, n_active, lists, pattern, blocked) per row of ``captures``.

    ``captures``: page_id, url, fetched (date). n_active: entries that hold on
    the day; lists: their distinct lists, sorted, comma-separated; pattern:
    the longest that holds (ties: first in text order; null: none); blocked:
    some list but ``ALLOW`` holds, and that does not. Null or malformed URLs
    and null days match nothing. Rows of equal page_id, url and day are
    answered once per row. Empty captures give no rows, empty lists block
    nothing. Extra columns are ignored.
    """
    history = (intervals(entries).groupBy("kind", F.col("pattern").alias("key"))
               .agg(F.sort_array(F.collect_list(F.struct("valid_from", "valid_to", "list"))).alias("history")))
    base = captures.select("page_id", "url", "fetched").groupBy("page_id", "url", "fetched").agg(F.count("*").alias("rows"))
    keyed = base.select("page_id", "url", "fetched", "rows", F.explode_outer(keys_of(F.col("url"))).alias("k")).select(
        "page_id", "url", "fetched", "rows", F.col("k.kind").alias("kind"), F.col("k.key").alias("key"))
    holds = F.filter(F.coalesce("history", F.array().cast("array<struct<valid_from:date,valid_to:date,list:string>>")),
                     lambda e: F.coalesce((e["valid_from"] <= F.col("fetched")) & (e["valid_to"].isNull() | (F.col("fetched") < e["valid_to"])),
                                          F.lit(False)))
    met = (keyed.join(history, ["kind", "key"], "left").withColumn("active", holds)
           .select("page_id", "url", "fetched", "rows", F.size("active").cast("long").alias("n"),
                   F.transform("active", lambda e: e["list"]).alias("names"),
                   F.when(F.size("active") > 0, F.struct((-F.char_length("key")).alias("short"), "key")).alias("best")))
    found = met.groupBy("page_id", "url", "fetched", "rows").agg(
        F.sum("n").alias("n_active"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("lists"),
        F.min("best").alias("best"))
    return (found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("page_id", host_of(F.col("url")).alias("host"), "fetched", "n_active", F.array_join("lists", ",").alias("lists"),
                    F.col("best.key").alias("pattern"),
                    ((F.size(F.filter("lists", lambda x: x != ALLOW)) > 0) & ~F.array_contains("lists", ALLOW)).alias("blocked")))
