"""The daily control cycle over the saved state: rosters, archive refresh,
current-month sync, backfill.

Each step reads the newest state, works out its requests, folds the answers
in and commits; a failed day resumes at the step that did not commit, and a
concurrent run is refused (``StaleVersion``) instead of overwritten. What
the source system fetches comes in through ``Answers``: functions from a
table of requests to a table of answers (a join with landed files, say).
Every request set and state lives in tables; nothing loops over players.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.operators import bronze
from gamelake.operators import state as ST
from gamelake.sources import raw, state_store

#: Tables of up to this size are broadcast within a day (a backfill queue, say).
BROADCAST = "256k"


@contextmanager
def shuffled(spark: SparkSession) -> Iterator[None]:
    """Joins of tables that grow with the players are shuffled: a table's files
    are far smaller than its rows, and each broadcast passes through the driver."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, BROADCAST)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


@dataclass(frozen=True)
class Answers:
    """Where a day's answers come from.

    ``lists``: requests (title, username) -> (username, archives[]), no row for a failed fetch;
    ``games``: requests (username, month_key, etag, last_modified) -> (username, month_key,
    status_code, etag, last_modified, game_count), each pair once;
    ``raw_months``: (username, month_key) whose raw document exists.
    """

    lists: Callable[[DataFrame], DataFrame]
    games: Callable[[DataFrame], DataFrame]
    raw_months: DataFrame


#: Counts of a day, one row per title.
REPORT = ("active", "new", "removed", "refreshed", "changed", "updated", "not_modified", "empty", "error",
          "backfill_players", "backfill_months", "still_pending")


def snapshot_rosters(spark: SparkSession, root: str, rosters: DataFrame, ds: str, now: str) -> DataFrame:
    """F1-F3: today's roster documents (title, snapshot_date, players[]) into titles and players.

    A title without a document today is left alone, its players too."""
    seen = state_store.read(spark, root)
    documents = ST.normalize_roster(rosters)
    members = ST.roster_members(documents)
    titles = F.broadcast(documents.select("title").distinct())
    known = seen.players.join(titles, "title", "left_semi")
    others = seen.players.join(titles, "title", "left_anti")
    change = ST.roster_diff(known, members).groupBy("title").agg(
        *[F.count_if(F.col("change") == c).alias(n) for c, n in (("new", "new"), ("removed", "removed"), ("kept", "kept"))])
    counts = change.select("title", (F.col("new") + F.col("kept")).alias("active"), "new", "removed")
    counts = _kept(spark, root, counts, "rosters", ds)
    players = ST.upsert_players(known, members, ds).unionByName(SC.conform(others, SC.PLAYER_STATE))
    state_store.commit(spark, root, seen, titles=ST.upsert_titles(seen.titles, documents, ds, now), players=players)
    return counts


def refresh_archives(spark: SparkSession, root: str, answers: Answers, current_month: str, ds: str, now: str) -> DataFrame:
    """F4-F9: archive lists of the players that are due."""
    seen = state_store.read(spark, root)
    due = seen.players.filter(ST.refresh_due(seen.players, now)).select("title", "username")
    results = due.join(ST.refresh_results(answers.lists(due), current_month, now), "username")
    results = _kept(spark, root, results, "refresh_results", ds)
    old = seen.players.select("title", "username", F.col("archive_hash").alias("_old"))
    counts = results.join(old, ["title", "username"]).groupBy("title").agg(
        F.count(F.lit(1)).alias("refreshed"), F.count_if(ST.archive_changed("archive_hash", "_old")).alias("changed"))
    counts = _kept(spark, root, counts, "refresh", ds)
    players, index = ST.apply_refresh(seen.players, seen.index, results, current_month, ds)
    state_store.commit(spark, root, seen, players=players, index=index)
    _drop(spark, root, "refresh_results", ds)
    return counts


def sync_current_month(spark: SparkSession, root: str, answers: Answers, current_month: str, ds: str, now: str) -> DataFrame:
    """F10-F13: roll the month over where it ended, then fetch the current month where it may have changed."""
    seen = state_store.read(spark, root)
    players, index = ST.month_rollover(seen.players, seen.index, current_month)
    rolled = state_store.commit(spark, root, seen, players=players, index=index)
    requests = ST.sync_requests(rolled.players, current_month)
    responses = _kept(spark, root, answers.games(_once(requests)), "sync_responses", ds)
    counts = _kept(spark, root, ST.sync_report(requests, responses), "sync", ds)
    state_store.commit(spark, root, rolled, players=ST.apply_sync(rolled.players, requests, responses, now))
    _drop(spark, root, "sync_responses", ds)
    return counts


def backfill(spark: SparkSession, root: str, answers: Answers, current_month: str, ds: str,
             players_per_run: int | None, months_per_player: int | None) -> DataFrame:
    """F14-F16: the first pending months of the first queued players of each title."""
    seen = state_store.read(spark, root)
    queue = ST.backfill_queue(seen.players, seen.index, current_month, players_per_run, months_per_player)
    queue = _kept(spark, root, queue, "backfill_queue", ds)
    wanted = queue.filter(F.col("month_key").isNotNull()).select("username", "month_key").distinct()
    missing = wanted.join(answers.raw_months.select("username", "month_key").distinct(), ["username", "month_key"], "left_anti")
    none = F.lit(None).cast("string")
    responses = answers.games(missing.select("username", "month_key", none.alias("etag"), none.alias("last_modified")))
    responses = _kept(spark, root, responses, "backfill_responses", ds)
    index, result = ST.apply_backfill(queue, seen.index, answers.raw_months, responses)
    result = _kept(spark, root, result, "backfill", ds)
    counts = ST.backfill_report(seen.players, result).select(
        "title", F.col("players").alias("backfill_players"), F.col("months_processed").alias("backfill_months"),
        F.col("players_still_pending").alias("still_pending"))
    state_store.commit(spark, root, seen, players=ST.apply_backfill_result(seen.players, result), index=index)
    _drop(spark, root, "backfill_queue", ds)
    _drop(spark, root, "backfill_responses", ds)
    return counts


def _once(requests: DataFrame) -> DataFrame:
    """One request per (username, month): a player's titles share the fetch; the token of the first title is sent."""
    tokens = F.min_by(F.struct("etag", "last_modified"), F.col("title"))
    return requests.groupBy("username", "month_key").agg(tokens.alias("t")).select("username", "month_key", "t.etag", "t.last_modified")


def _path(root: str, step: str, ds: str) -> str:
    return f"{root.rstrip('/')}/state/reports/{step}/ds={ds}"


def _drop(spark: SparkSession, root: str, step: str, ds: str) -> None:
    """A table that several results of one step were made from, once they are saved."""
    raw.delete(spark, _path(root, step, ds))


def _kept(spark: SparkSession, root: str, df: DataFrame, step: str, ds: str) -> DataFrame:
    """A step's result as a table of its own: its inputs are versions that later commits drop."""
    path = _path(root, step, ds)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_day(spark: SparkSession, root: str, rosters: DataFrame, answers: Answers, ds: str, now: str,
            current_month: str | None = None, players_per_run: int | None = ST.BACKFILL_PLAYERS_PER_RUN,
            months_per_player: int | None = ST.BACKFILL_MONTHS_PER_PLAYER) -> DataFrame:
    """One day's cycle against the state under ``root``; returns the counts of each step per title.

    ``current_month`` defaults to the month of ``ds``. Running a day twice
    finds nothing due and nothing new, and repeats the sync and backfill
    requests of what is still open."""
    current_month = current_month or ds[:7]
    with shuffled(spark):
        parts = [
            snapshot_rosters(spark, root, rosters, ds, now),
            refresh_archives(spark, root, answers, current_month, ds, now),
            sync_current_month(spark, root, answers, current_month, ds, now),
            backfill(spark, root, answers, current_month, ds, players_per_run, months_per_player),
        ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "title", "full_outer")
    return out.select(F.lit(ds).alias("ds"), "title", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in REPORT])


def title_lookup(spark: SparkSession, root: str) -> DataFrame:
    """B5 from the saved state: every player ever listed, removed ones too, with the title of highest priority."""
    return bronze.title_lookup(state_store.read(spark, root).players)
