"""Incremental control state as tables.

``player_state`` (one row per title and player) and ``player_index`` (one row
per player with stored / archive / pending month lists) replace per-player
JSON manifests. Every step is a join of the current state with the day's
inputs (roster, archive lists, fetch responses) and yields the next state;
nothing loops over players on the driver. Write a new state version and
never overwrite the table being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.functions import exprs as X

# Fixed parameters of the refresh rules (defaults of the source system).
ARCHIVE_REFRESH_DAYS = 30
ACTIVE_ARCHIVE_REFRESH_HOURS = 24
BACKFILL_PLAYERS_PER_RUN = 10
BACKFILL_MONTHS_PER_PLAYER = 6
RAW_PREFIX = "raw"


# --- key formats --------------------------------------------------------------
def username_prefix(username: str | Column) -> Column:
    p = F.lower(F.substring(X.col(username), 1, 2))
    return F.when(p == "", F.lit("__")).otherwise(p)


def player_index_key(username: str | Column) -> Column:
    u = X.col(username)
    return F.concat(F.lit("state/player_index/username_prefix="), username_prefix(u), F.lit("/username="), u,
                    F.lit("/index.json"))


def player_games_key(username: str | Column, month_key: str | Column) -> Column:
    mk = X.col(month_key)
    return F.concat(F.lit(f"{RAW_PREFIX}/player_games/year="), F.substring(mk, 1, 4), F.lit("/month="),
                    F.substring(mk, 6, 2), F.lit("/username="), X.col(username), F.lit(".json"))


def archive_snapshot_key(username: str | Column, ds: str) -> Column:
    return F.concat(F.lit(f"{RAW_PREFIX}/player_archives/"), X.col(username), F.lit(f"/{ds}.json"))


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SC.struct(SC.PLAYER_STATE))


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SC.struct(SC.PLAYER_INDEX))


def new_player_defaults(username: Column, title: Column) -> dict[str, Column]:
    """Field values of a player never seen before."""
    return {
        "username": username, "title": title, "status": F.lit("active"),
        "has_current_month_archive": F.lit(False), "current_month_game_count": F.lit(0),
        "backfill_pending": F.lit(False), "backfill_pending_count": F.lit(0),
        "player_index_key": player_index_key(username),
    }


# --- F1 / F2 / F3 --------------------------------------------------------------
def normalize_roster(snapshots: DataFrame) -> DataFrame:
    """Roster documents -> distinct sorted players and their count."""
    players = F.array_sort(F.array_distinct(F.filter("players", lambda p: p.isNotNull())))
    return snapshots.select("title", "snapshot_date", players.alias("players")).withColumn(
        "player_count", F.size("players").cast("int"))


def snapshot_key(title: str | Column, ds: str | Column) -> Column:
    return F.concat(F.lit(f"{RAW_PREFIX}/titled_players/"), X.col(title), F.lit("/"), X.col(ds), F.lit(".json"))


def upsert_titles(titles: DataFrame, snapshots: DataFrame, ds: str, saved_at: str) -> DataFrame:
    """Title records after the day's roster documents: a title with a document
    gets its date and key; every other record stays."""
    today = snapshots.filter(F.col("title").isNotNull()).select("title").distinct().withColumn("_today", F.lit(True))
    j = titles.join(today, "title", "full_outer")
    new = {"latest_snapshot_date": F.lit(ds), "last_snapshot_key": snapshot_key("title", F.lit(ds)),
           "last_updated_at": F.to_timestamp(F.lit(saved_at))}
    return j.select(*[F.when(F.col("_today"), new[n]).otherwise(F.col(n)).cast(t).alias(n) if n in new else F.col(n)
                      for n, t in SC.TITLE_STATE])


def roster_members(snapshots: DataFrame) -> DataFrame:
    """(title, username) rows of normalized roster documents."""
    return snapshots.select("title", F.explode("players").alias("username"))


def roster_diff(state: DataFrame, current: DataFrame) -> DataFrame:
    """Compare the active set with today's roster: change in new/removed/kept."""
    active = state.filter(F.col("status") == "active").select("title", "username", F.lit(True).alias("_was"))
    today = current.select("title", "username", F.lit(True).alias("_is")).distinct()
    j = active.join(today, ["title", "username"], "full_outer")
    change = (F.when(F.col("_was").isNull(), "new").when(F.col("_is").isNull(), "removed").otherwise("kept"))
    return j.select("title", "username", change.alias("change"))


def upsert_players(state: DataFrame, current: DataFrame, ds: str) -> DataFrame:
    """Apply today's roster (title, username) to the state.

    Present -> active, first seen kept (or ds), last seen = ds, removal cleared.
    Active but absent -> removed on ds. Absent and not active -> untouched.
    """
    today = current.select("title", "username").distinct().withColumn("_present", F.lit(True))
    j = state.join(today, ["title", "username"], "full_outer")
    present = F.coalesce(F.col("_present"), F.lit(False))
    new = F.col("status").isNull() & present
    dflt = new_player_defaults(F.col("username"), F.col("title"))
    out = []
    for name, dtype in SC.PLAYER_STATE:
        c = F.col(name)
        if name == "status":
            c = (F.when(present, F.lit("active"))
                 .when(F.col("status") == "active", F.lit("removed")).otherwise(F.col("status")))
        elif name == "first_seen_snapshot_date":
            c = F.when(present, F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(ds))).otherwise(F.col(name))
        elif name == "last_seen_snapshot_date":
            c = F.when(present, F.lit(ds)).otherwise(F.col(name))
        elif name == "removed_snapshot_date":
            c = (F.when(present, F.lit(None).cast("string"))
                 .when(F.col("status") == "active", F.lit(ds)).otherwise(F.col(name)))
        elif name in dflt and name not in ("username", "title"):
            c = F.when(new, dflt[name]).otherwise(F.col(name))
        out.append(c.cast(dtype).alias(name))
    return j.select(*out)


# --- F4 -------------------------------------------------------------------------
def refresh_due(state: DataFrame, now: str | Column, hours: int = ACTIVE_ARCHIVE_REFRESH_HOURS,
                days: int = ARCHIVE_REFRESH_DAYS) -> Column:
    """Active and (never checked, or >= ``hours`` old with a current-month
    archive, or >= ``days`` old without one)."""
    t = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    last = F.col("archive_last_checked_at")
    has_cur = F.coalesce(F.col("has_current_month_archive"), F.lit(False))
    age_ok = F.when(has_cur, last <= t - F.expr(f"INTERVAL {int(hours)} HOURS")).otherwise(
        last <= t - F.expr(f"INTERVAL {int(days)} DAYS"))
    return (F.col("status") == "active") & (last.isNull() | age_ok)


# --- F5 / F6 / F7 / F8 -------------------------------------------------------------
def archive_months(urls: str | Column) -> Column:
    """Archive URL list -> sorted distinct 'YYYY-MM' keys."""
    ms = F.transform(F.array_distinct(X.col(urls)), lambda u: X.archive_month(u))
    return F.array_sort(F.array_distinct(F.filter(ms, lambda m: m.isNotNull())))


def archive_changed(new_hash: str | Column, old_hash: str | Column) -> Column:
    return ~X.col(new_hash).eqNullSafe(X.col(old_hash))


def pending_backfill(archive: str | Column, stored: str | Column, current_month: str | Column) -> Column:
    """Archive months not stored and not the current month, in archive order."""
    stored_c = F.coalesce(X.col(stored), F.array().cast("array<string>"))
    cur = F.array(X.col(current_month) if not isinstance(current_month, str) else F.lit(current_month))
    return F.array_except(F.array_except(X.col(archive), stored_c), cur)


def refresh_results(archive_lists: DataFrame, current_month: str, checked_at: str) -> DataFrame:
    """(username, archives[]) fetched lists -> refresh results per player."""
    months = archive_months("archives")
    return archive_lists.select(
        "username",
        F.to_timestamp(F.lit(checked_at)).alias("checked_at"),
        months.alias("archive_months"),
    ).select(
        "username", "checked_at", "archive_months",
        X.month_list_hash("archive_months").alias("archive_hash"),
        F.try_element_at("archive_months", F.lit(-1)).alias("latest_archive_month"),
        F.array_contains("archive_months", current_month).alias("has_current_month_archive"),
    )


# --- F9 -----------------------------------------------------------------------------
def apply_refresh(state: DataFrame, index: DataFrame, results: DataFrame, current_month: str,
                  ds: str) -> tuple[DataFrame, DataFrame]:
    """Fold refresh results into (state, index). Only a changed hash writes a
    new archive snapshot key and index lists; unchanged players keep their
    pending count.

    Results belong to (title, username) when they carry a title, else to the
    player's active rows: a row whose player has left the title is not
    stamped. A player's titles share one index row."""
    r = results.select("username", *[F.col(c).alias(f"r_{c}") for c in results.columns if c != "username"])
    ix = index.select("username", F.col("stored_months").alias("i_stored"))
    r = r.withColumnRenamed("username", "r_username")
    mine = (F.col("title") == F.col("r_title")) if "title" in results.columns else (F.col("status") == "active")
    s = state.join(r, (F.col("username") == F.col("r_username")) & mine, "left").join(ix, "username", "left")
    got = F.col("r_archive_hash").isNotNull()
    changed = got & archive_changed("r_archive_hash", "archive_hash")
    pending = pending_backfill("r_archive_months", "i_stored", current_month)
    count = F.when(changed, F.size(pending)).otherwise(F.coalesce(F.col("backfill_pending_count"), F.lit(0)))
    upd = {
        "archive_last_checked_at": F.col("r_checked_at"),
        "archive_hash": F.col("r_archive_hash"),
        "archive_snapshot_key": F.when(changed, archive_snapshot_key("username", ds)).otherwise(F.col("archive_snapshot_key")),
        "latest_archive_month": F.col("r_latest_archive_month"),
        "has_current_month_archive": F.col("r_has_current_month_archive"),
        "backfill_pending": count > 0,
        "backfill_pending_count": count,
    }
    new_state = s.select(*[F.when(got, upd[n]).otherwise(F.col(n)).cast(t).alias(n) if n in upd else F.col(n)
                           for n, t in SC.PLAYER_STATE])
    # Index rows change only for changed players; new players get a row. Where
    # a player's titles were answered apart, the last title in name order
    # stands, as if the titles were worked through one after the other.
    lists = F.struct(F.col("r_archive_months").alias("archive_months"), pending.alias("pending_backfill_months"))
    ch = (s.filter(changed).groupBy("username").agg(F.max_by(lists, F.col("title")).alias("_l"))
          .select("username", "_l.archive_months", "_l.pending_backfill_months",
                  archive_snapshot_key("username", ds).alias("latest_archive_snapshot_key")))
    new_index = (index.join(ch.withColumnRenamed("archive_months", "n_archive").withColumnRenamed(
        "pending_backfill_months", "n_pending").withColumnRenamed("latest_archive_snapshot_key", "n_key"),
        "username", "full_outer")
        .select("username",
                F.coalesce("stored_months", F.array().cast("array<string>")).alias("stored_months"),
                F.coalesce("n_archive", "archive_months").alias("archive_months"),
                F.coalesce("n_pending", "pending_backfill_months").alias("pending_backfill_months"),
                F.coalesce("n_key", "latest_archive_snapshot_key").alias("latest_archive_snapshot_key"),
                F.when(F.col("n_key").isNotNull(), F.current_timestamp()).otherwise(F.col("updated_at")).alias("updated_at")))
    return new_state, SC.conform(new_index, SC.PLAYER_INDEX)


# --- F10 ------------------------------------------------------------------------------
def month_rollover(state: DataFrame, index: DataFrame, current_month: str) -> tuple[DataFrame, DataFrame]:
    """A player whose current month lies in the past gets it added to stored
    months; the state's current-month fields are reset."""
    prev = F.col("current_month_key")
    roll = prev.isNotNull() & (prev != F.lit(current_month)) & F.col("current_month_game_key").isNotNull()
    rolled = state.filter(roll).select("username", prev.alias("_prev"))
    reset = {"current_month_key": F.lit(None), "current_month_etag": F.lit(None),
             "current_month_last_modified": F.lit(None), "current_month_game_key": F.lit(None),
             "current_month_game_count": F.lit(0)}
    new_state = state.select(*[F.when(roll, reset[n]).otherwise(F.col(n)).cast(t).alias(n) if n in reset else F.col(n)
                               for n, t in SC.PLAYER_STATE])
    add = rolled.groupBy("username").agg(F.collect_set("_prev").alias("_add"))
    j = index.join(add, "username", "full_outer")
    stored = F.array_sort(F.array_union(F.coalesce("stored_months", F.array().cast("array<string>")),
                                        F.coalesce("_add", F.array().cast("array<string>"))))
    new_index = j.select(
        "username", stored.alias("stored_months"),
        *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("archive_months", "pending_backfill_months")],
        "latest_archive_snapshot_key",
        F.when(F.col("_add").isNotNull(), F.current_timestamp()).otherwise(F.col("updated_at")).alias("updated_at"))
    return new_state, SC.conform(new_index, SC.PLAYER_INDEX)


# --- F11 / F12 / F13 ------------------------------------------------------------------
def sync_candidates(state: DataFrame) -> DataFrame:
    return state.filter((F.col("status") == "active") & F.coalesce("has_current_month_archive", F.lit(False)))


def sync_requests(state: DataFrame, month_key: str) -> DataFrame:
    """Conditional-request tokens are reused only for the same month."""
    same = F.col("current_month_key") == F.lit(month_key)
    return sync_candidates(state).select(
        "title", "username", F.lit(month_key).alias("month_key"),
        F.when(same, F.col("current_month_etag")).alias("etag"),
        F.when(same, F.col("current_month_last_modified")).alias("last_modified"))


def classify_responses(responses: DataFrame) -> DataFrame:
    """304 -> not_modified; 404 -> empty; 2xx -> updated with a body, else empty;
    any other answer (429, 5xx, none) -> error."""
    code = F.col("status_code")
    status = (F.when(code == 304, "not_modified").when(code == 404, "empty")
              .when(code.between(200, 299), F.when(F.col("game_count").isNull(), "empty").otherwise("updated"))
              .otherwise("error"))
    return responses.withColumn("sync_status", status)


def apply_sync(state: DataFrame, requests: DataFrame, responses: DataFrame, checked_at: str) -> DataFrame:
    """Fold fetch results into the state: every answered request stamps the
    sync time (a failed one leaves the state as it was); only ``updated``
    touches the current-month fields."""
    cls = classify_responses(responses)
    res = requests.join(cls.select("username", "month_key", "sync_status", F.col("etag").alias("r_etag"),
                                   F.col("last_modified").alias("r_last_modified") if "last_modified" in responses.columns
                                   else F.lit(None).cast("string").alias("r_last_modified"),
                                   F.col("game_count").alias("r_game_count")),
                        ["username", "month_key"], "inner")
    res = res.select("title", "username", F.col("month_key").alias("r_month"), "sync_status", "r_etag",
                     "r_last_modified", "r_game_count")
    s = state.join(res, ["title", "username"], "left")
    answered = F.col("sync_status").isNotNull() & (F.col("sync_status") != "error")
    upd = F.col("sync_status") == "updated"
    new = {
        "last_game_sync_at": F.when(answered, F.to_timestamp(F.lit(checked_at))).otherwise(F.col("last_game_sync_at")),
        "current_month_key": F.when(upd, F.col("r_month")).otherwise(F.col("current_month_key")),
        "current_month_etag": F.when(upd, F.col("r_etag")).otherwise(F.col("current_month_etag")),
        "current_month_last_modified": F.when(upd, F.col("r_last_modified")).otherwise(F.col("current_month_last_modified")),
        "current_month_game_key": F.when(upd, player_games_key("username", "r_month")).otherwise(F.col("current_month_game_key")),
        "current_month_game_count": F.when(upd, F.col("r_game_count")).otherwise(F.col("current_month_game_count")),
    }
    return s.select(*[new[n].cast(t).alias(n) if n in new else F.col(n) for n, t in SC.PLAYER_STATE])


def sync_report(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Counts per title: updated / not_modified / empty / errors (no answer)."""
    cls = classify_responses(responses).select("username", "month_key", "sync_status")
    j = requests.join(cls, ["username", "month_key"], "left")
    st = F.coalesce(F.col("sync_status"), F.lit("error"))
    return j.groupBy("title").agg(*[F.sum(F.when(st == s, 1).otherwise(0)).cast("bigint").alias(s)
                                    for s in ("updated", "not_modified", "empty", "error")])


# --- F14 / F15 / F16 ------------------------------------------------------------------
def backfill_queue(state: DataFrame, index: DataFrame, current_month: str,
                   players_per_run: int | None, months_per_player: int | None) -> DataFrame:
    """Per title (all of them where a limit is None) the first ``players_per_run`` players (by name) with pending
    months, and for each the first ``months_per_player`` pending months other
    than the current one. The per-title top-k runs as a window whose partial
    limit is applied before the shuffle, so a title never gathers in one task
    whole."""
    from pyspark.sql import Window
    w = Window.partitionBy("title").orderBy(F.col("username").asc_nulls_last())
    queued = state.filter(F.coalesce("backfill_pending_count", F.lit(0)) > 0)
    if players_per_run is not None:
        queued = queued.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= players_per_run).drop("_rn")
    j = queued.select("title", "username").join(index.select("username", "pending_backfill_months"), "username", "left")
    months = F.filter(F.coalesce("pending_backfill_months", F.array().cast("array<string>")), lambda m: m != F.lit(current_month))
    if months_per_player is not None:
        months = F.slice(months, 1, months_per_player)
    return j.select("title", "username", F.posexplode_outer(months).alias("month_pos", "month_key"))


def apply_backfill(queue: DataFrame, index: DataFrame, raw_present: DataFrame,
                   responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A queued month becomes stored if its raw file exists or the fetch
    returned a body; otherwise (404, empty) it stays pending. Returns the new
    index (one row per username) and a result (processed, remaining) per
    (title, username). A month that a player's two titles both queued is
    fetched once and counts for the first title in name order."""
    q = queue.filter(F.col("month_key").isNotNull())
    have = raw_present.select("username", "month_key", F.lit(True).alias("_raw")).distinct()
    ok_fetch = classify_responses(responses).filter(F.col("sync_status") == "updated").select(
        "username", "month_key", F.lit(True).alias("_got")).distinct()
    marked = q.join(have, ["username", "month_key"], "left").join(ok_fetch, ["username", "month_key"], "left")
    done = F.coalesce("_raw", "_got", F.lit(False))
    once = marked.groupBy("username", "month_key").agg(F.min("title").alias("title"), F.max(done).alias("_done"))
    counted = once.groupBy("title", "username").agg(F.sum(F.when(F.col("_done"), 1).otherwise(0)).alias("processed"))
    per_player = once.groupBy("username").agg(F.collect_set(F.when(F.col("_done"), F.col("month_key"))).alias("_add"))
    queued = queue.select("title", "username").distinct().join(counted, ["title", "username"], "left")
    j = index.join(per_player, "username", "left")
    empty = F.array().cast("array<string>")
    # A player with eligible months gets its index rewritten (even when every
    # fetch failed); one with none keeps it, and reports its whole pending list.
    eligible = F.col("_add").isNotNull()
    stored = F.array_sort(F.array_union(F.coalesce("stored_months", empty), F.coalesce("_add", empty)))
    pending = F.filter(F.coalesce("pending_backfill_months", empty), lambda m: ~F.array_contains(stored, m))
    new_index = j.select(
        "username", F.when(eligible, stored).otherwise(F.col("stored_months")).alias("stored_months"), "archive_months",
        F.when(eligible, pending).otherwise(F.col("pending_backfill_months")).alias("pending_backfill_months"),
        "latest_archive_snapshot_key",
        F.when(eligible, F.current_timestamp()).otherwise(F.col("updated_at")).alias("updated_at"))
    remaining = F.when(eligible, F.size(pending)).otherwise(F.size(F.coalesce("pending_backfill_months", empty)))
    # Every queued player reports, also one without an index row (nothing pending).
    result = queued.join(j, "username", "left").select(
        "title", "username", F.coalesce("processed", F.lit(0)).cast("bigint").alias("processed"),
        F.coalesce(remaining, F.lit(0)).cast("int").alias("remaining"))
    return SC.conform(new_index, SC.PLAYER_INDEX), result


def apply_backfill_result(state: DataFrame, result: DataFrame) -> DataFrame:
    r = result.select("title", "username", F.col("remaining").alias("_rem"))
    s = state.join(r, ["title", "username"], "left")
    got = F.col("_rem").isNotNull()
    return s.select(*[
        (F.when(got, F.col("_rem")).otherwise(F.col(n)) if n == "backfill_pending_count"
         else F.when(got, F.col("_rem") > 0).otherwise(F.col(n)) if n == "backfill_pending" else F.col(n)).cast(t).alias(n)
        for n, t in SC.PLAYER_STATE])


def backfill_report(state: DataFrame, result: DataFrame) -> DataFrame:
    """Per title: players processed, months processed, players still pending."""
    j = state.select("title", "username").join(result, ["title", "username"], "inner")
    return j.groupBy("title").agg(
        F.count(F.lit(1)).cast("bigint").alias("players"),
        F.sum("processed").cast("bigint").alias("months_processed"),
        F.sum(F.when(F.col("remaining") > 0, 1).otherwise(0)).cast("bigint").alias("players_still_pending"))


# --- F17 / F18 / F19 --------------------------------------------------------------------
def latest_roster(snapshots: DataFrame, key: str = "raw_key") -> DataFrame:
    """Per title, the snapshot document with the greatest key: keys first, then
    the winners' documents by a semi join. A key names one document."""
    best = snapshots.filter(F.col("title").isNotNull()).groupBy("title").agg(F.max(key).alias(key))
    return snapshots.join(best, ["title", key], "left_semi").select("title", *[c for c in snapshots.columns if c != "title"])


LEGACY_GAME_KEY = r"^.*/([^/]+)/(\d{4})/(\d{2})\.json$"


def stored_months(paths: DataFrame, path: str = "path") -> DataFrame:
    """Legacy raw paths ``.../{user}/{YYYY}/{MM}.json`` -> user, sorted months."""
    u = F.regexp_extract(path, LEGACY_GAME_KEY, 1)
    mk = F.concat(F.regexp_extract(path, LEGACY_GAME_KEY, 2), F.lit("-"), F.regexp_extract(path, LEGACY_GAME_KEY, 3))
    m = paths.select(u.alias("username"), mk.alias("month_key")).filter(F.col("username") != "")
    return m.groupBy("username").agg(F.array_sort(F.collect_set("month_key")).alias("stored_months"))


def bootstrap(latest_snapshots: DataFrame, latest_lists: DataFrame, stored: DataFrame,
              current_docs: DataFrame, current_month: str, checked_at: str) -> tuple[DataFrame, DataFrame]:
    """Seed (state, index) for every player of each title's latest roster.

    ``latest_snapshots``: title, snapshot_date, players[] (one per title);
    ``latest_lists``: username, raw_key, archives[] (A3 result);
    ``stored``: username, stored_months[]; ``current_docs``: username, game_count
    of the current month's raw document.
    """
    empty = F.array().cast("array<string>")
    players = latest_snapshots.select("title", "snapshot_date",
                                      F.explode(F.array_sort(F.array_distinct("players"))).alias("username"))
    lists = latest_lists.select("username", F.col("raw_key").alias("a_key"), archive_months("archives").alias("a_months"))
    j = (players.join(lists, "username", "left").join(stored, "username", "left")
         .join(current_docs.select("username", F.col("game_count").alias("c_count")), "username", "left"))
    daily = F.regexp_extract("a_key", r"/(\d{4}-\d{2}-\d{2})\.json$", 1)
    has_list = F.col("a_key").isNotNull()
    months = F.coalesce("a_months", empty)
    st = F.coalesce("stored_months", empty)
    pending = F.filter(months, lambda m: ~F.array_contains(st, m) & (m != F.lit(current_month)))
    has_cur_doc = F.array_contains(st, current_month)
    state = j.select(
        "username", "title", F.lit("active").alias("status"),
        F.col("snapshot_date").alias("first_seen_snapshot_date"), F.col("snapshot_date").alias("last_seen_snapshot_date"),
        F.lit(None).cast("string").alias("removed_snapshot_date"),
        F.when(has_list, F.when(daily != "", F.to_timestamp(F.concat(daily, F.lit(" 00:00:00"))))
               .otherwise(F.to_timestamp(F.lit(checked_at)))).alias("archive_last_checked_at"),
        F.when(has_list, X.month_list_hash(months)).alias("archive_hash"),
        F.when(has_list, F.col("a_key")).alias("archive_snapshot_key"),
        F.when(has_list, F.try_element_at(months, F.lit(-1))).alias("latest_archive_month"),
        F.when(has_list, F.array_contains(months, current_month)).otherwise(F.lit(False)).alias("has_current_month_archive"),
        F.when(has_cur_doc, F.lit(current_month)).alias("current_month_key"),
        F.lit(None).cast("string").alias("current_month_etag"),
        F.lit(None).cast("string").alias("current_month_last_modified"),
        F.when(has_cur_doc, player_games_key("username", F.lit(current_month))).alias("current_month_game_key"),
        F.when(has_cur_doc & F.col("c_count").isNotNull(), F.col("c_count")).otherwise(F.lit(0)).alias("current_month_game_count"),
        F.lit(None).cast("timestamp").alias("last_game_sync_at"),
        (F.size(pending) > 0).alias("backfill_pending"),
        F.size(pending).alias("backfill_pending_count"),
        player_index_key("username").alias("player_index_key"),
    )
    index = j.select("username", st.alias("stored_months"), months.alias("archive_months"),
                     pending.alias("pending_backfill_months"), F.col("a_key").alias("latest_archive_snapshot_key"),
                     F.current_timestamp().alias("updated_at")).dropDuplicates(["username"])
    return SC.conform(state, SC.PLAYER_STATE), SC.conform(index, SC.PLAYER_INDEX)

