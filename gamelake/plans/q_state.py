"""Contract queries for the control state (F1..F19) and archive-list scans.

Spark side chains the state operators (roster upserts, refresh, sync,
backfill). The oracle states the same rules relationally: month lists are
row sets and only the final answers are aggregated into text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.functions import exprs as X
from gamelake.operators import state as ST
from gamelake.plans.contract import block, oracle, register
from gamelake.sources import fixtures, raw, state_store

DAY1, DAY2, DAY3 = "2024-01-01", "2024-01-02", "2024-01-03"
NOW = "2024-01-02 12:00:00"
CURRENT = "1996-05"
STORED_BEFORE = "1996-01"


def _empty() -> F.Column:
    return F.array().cast("array<string>")


def _j(c) -> F.Column:
    return F.array_join(F.coalesce(X.col(c), _empty()), ",")


def _ts(c) -> F.Column:
    return F.date_format(X.col(c), "yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------------------
# Shared fixture SQL (Spark SQL with DataFrame parameters, DuckDB as CTEs)
# ---------------------------------------------------------------------------
DAY = "select title, username from {fx_roster} where snapshot_date = '%s'"

STATE_EXT = """
select s.username, s.title, s.status, s.first_seen_snapshot_date, s.last_seen_snapshot_date, s.removed_snapshot_date,
  case when s.k % 11 = 0 then null
    else timestamp '2024-01-02 12:00:00' - INTERVAL 1 DAY * (s.k % 45) - INTERVAL 1 HOUR * (s.k % 30) end as archive_last_checked_at,
  case when s.k % 4 = 0 then h.archive_hash when s.k % 4 = 1 then null else 'stale' end as archive_hash,
  case when s.k % 4 = 0 then concat('raw/player_archives/', s.username, '/2023-12-01.json') end as archive_snapshot_key,
  cast(null as string) as latest_archive_month,
  s.k % 3 = 0 as has_current_month_archive,
  case s.k % 4 when 0 then '1996-04' when 1 then '1996-05' end as current_month_key,
  case when s.k % 4 in (0, 1) then concat('e', cast(s.k as string)) end as current_month_etag,
  case when s.k % 4 in (0, 1) then concat('lm', cast(s.k as string)) end as current_month_last_modified,
  case when s.k % 4 in (0, 1) and s.k % 8 <> 4 then concat('raw/player_games/year=1996/month=0', cast(4 + s.k % 4 as string),
    '/username=', s.username, '.json') end as current_month_game_key,
  cast(case when s.k % 4 in (0, 1) then s.k % 50 else 0 end as int) as current_month_game_count,
  cast(null as timestamp) as last_game_sync_at,
  s.k % 5 > 0 as backfill_pending,
  cast(s.k % 5 as int) as backfill_pending_count,
  s.player_index_key
from (select *, cast(substr(username, 9) as int) as k from {state}) s
left join {hashes} h on h.username = s.username
"""

# Archive-list documents per player with keys of each rank: a dated file for
# even players, an older dated file for multiples of 3, a legacy monthly file
# for all, and an unrecognised file for multiples of 5.
ARCHIVE_DOCS = """
select username, raw_key, archive_url from (
  select username, concat('raw/player_archives/', username, '/2024-01-01.json') as raw_key, archive_url
  from {fx_archives} where cast(substr(username, 9) as int) % 2 = 0
  union all
  select username, concat('raw/player_archives/', username, '/2023-12-31.json') as raw_key, archive_url
  from {fx_archives} where cast(substr(username, 9) as int) % 3 = 0 and archive_url < concat('https://api.games.example/player/', username, '/games/1997')
  union all
  select username, concat('raw/player_archives/', username, '/1996/12.json') as raw_key, archive_url
  from {fx_archives}
  union all
  select username, concat('raw/player_archives/', username, '/notes.json') as raw_key, archive_url
  from {fx_archives} where cast(substr(username, 9) as int) % 5 = 0
) d
"""

LEGACY_PATHS = """
select concat('raw/player_games/', username, '/', substr(month_key, 1, 4), '/', substr(month_key, 6, 2), '.json') as path
from {fx_stored}
union all
select distinct concat('raw/player_games/', username, '/readme.txt') as path from {fx_stored}
"""


def _spark_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(text, **frames)


def _oracle_text(text: str, **names: str) -> str:
    return text.format(**names)


# ---------------------------------------------------------------------------
# Spark chain
# ---------------------------------------------------------------------------
def day(spark, sf, d):
    return _spark_sql(spark, DAY % d, fx_roster=fixtures.view(spark, sf, "fx_roster"))


def state1(spark, sf):
    return ST.upsert_players(ST.empty_state(spark), day(spark, sf, DAY1), DAY1)


def state2(spark, sf):
    return ST.upsert_players(state1(spark, sf), day(spark, sf, DAY2), DAY2)


def state3(spark, sf):
    return ST.upsert_players(state2(spark, sf), day(spark, sf, DAY1), DAY3)


def archive_lists(spark, sf) -> DataFrame:
    """(username, archives[]) — one player's list is bounded by their months."""
    return fixtures.view(spark, sf, "fx_archives").groupBy("username").agg(
        F.collect_list("archive_url").alias("archives"))


def refresh_all(spark, sf) -> DataFrame:
    return ST.refresh_results(archive_lists(spark, sf), CURRENT, NOW)


def state_ext(spark, sf) -> DataFrame:
    hashes = refresh_all(spark, sf).select("username", "archive_hash")
    return SC.conform(_spark_sql(spark, STATE_EXT, state=state2(spark, sf), hashes=hashes), SC.PLAYER_STATE)


def index0(spark, sf) -> DataFrame:
    st = fixtures.view(spark, sf, "fx_stored").filter(F.col("month_key") < STORED_BEFORE)
    idx = st.groupBy("username").agg(F.array_sort(F.collect_set("month_key")).alias("stored_months"))
    return SC.conform(idx, SC.PLAYER_INDEX, {"archive_months": _empty(), "pending_backfill_months": _empty()})


def refreshed(spark, sf) -> tuple[DataFrame, DataFrame]:
    s = state_ext(spark, sf)
    due = s.filter(ST.refresh_due(s, NOW)).select("username")
    results = refresh_all(spark, sf).join(due, "username", "left_semi")
    return ST.apply_refresh(s, index0(spark, sf), results, CURRENT, DAY2)


def after_refresh(spark, sf) -> tuple[DataFrame, DataFrame]:
    """State and index after the refresh, saved once per input like any step of the control cycle."""
    from gamelake.session import scratch_path
    root = scratch_path(spark, "fixture", fixtures.input_token(spark, sf), "refreshed")

    def save(tmp: str) -> None:
        s, ix = refreshed(spark, sf)
        state_store.commit(spark, tmp, state_store.read(spark, tmp), players=s, index=ix)

    saved = state_store.read(spark, raw.publish(spark, root, save))
    return saved.players, saved.index


def queue(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    s, ix = after_refresh(spark, sf)
    return s, ix, ST.backfill_queue(s, ix, CURRENT, ST.BACKFILL_PLAYERS_PER_RUN, ST.BACKFILL_MONTHS_PER_PLAYER)


def raw_present(spark, sf) -> DataFrame:
    return fixtures.view(spark, sf, "fx_stored").filter(F.col("month_key") >= STORED_BEFORE)


def backfill(spark, sf):
    s, ix, q = queue(spark, sf)
    new_ix, result = ST.apply_backfill(q, ix, raw_present(spark, sf), fixtures.view(spark, sf, "fx_responses"))
    return s, new_ix, result


# ---------------------------------------------------------------------------
# Oracle blocks
# ---------------------------------------------------------------------------
block("s_day1", DAY.format(fx_roster="fx_roster") % DAY1, ("fx_roster",))
block("s_day2", DAY.format(fx_roster="fx_roster") % DAY2, ("fx_roster",))


def _upsert_sql(prev: str | None, today: str, ds: str) -> str:
    if prev is None:
        return f"""
select username, title, 'active' as status, '{ds}' as first_seen_snapshot_date, '{ds}' as last_seen_snapshot_date,
  cast(null as varchar) as removed_snapshot_date,
  concat('state/player_index/username_prefix=', lower(substr(username, 1, 2)), '/username=', username, '/index.json') as player_index_key
from (select distinct title, username from {today}) t"""
    return f"""
select coalesce(s.username, t.username) as username, coalesce(s.title, t.title) as title,
  case when t.username is not null then 'active' when s.status = 'active' then 'removed' else s.status end as status,
  case when t.username is not null then coalesce(nullif(s.first_seen_snapshot_date, ''), '{ds}') else s.first_seen_snapshot_date end as first_seen_snapshot_date,
  case when t.username is not null then '{ds}' else s.last_seen_snapshot_date end as last_seen_snapshot_date,
  case when t.username is not null then null when s.status = 'active' then '{ds}' else s.removed_snapshot_date end as removed_snapshot_date,
  coalesce(s.player_index_key, concat('state/player_index/username_prefix=', lower(substr(t.username, 1, 2)), '/username=', t.username, '/index.json')) as player_index_key
from {prev} s full outer join (select distinct title, username from {today}) t on s.title = t.title and s.username = t.username"""


block("s_state1", _upsert_sql(None, "s_day1", DAY1), ("s_day1",))
block("s_state2", _upsert_sql("s_state1", "s_day2", DAY2), ("s_state1", "s_day2"))
block("s_state3", _upsert_sql("s_state2", "s_day1", DAY3), ("s_state2", "s_day1"))

_MONTH_OF_URL = ("concat(list_extract(string_split(rtrim(archive_url, '/'), '/'), -2), '-', "
                 "case when length(list_extract(string_split(rtrim(archive_url, '/'), '/'), -1)) >= 2 "
                 "then list_extract(string_split(rtrim(archive_url, '/'), '/'), -1) "
                 "else lpad(list_extract(string_split(rtrim(archive_url, '/'), '/'), -1), 2, '0') end)")
block("s_arch", f"select distinct username, {_MONTH_OF_URL} as month_key from fx_archives", ("fx_archives",))
block("s_hash", """
select username,
  sha256(case when count(*) = 0 then '[]' else '["' || string_agg(month_key, '", "' order by month_key) || '"]' end) as archive_hash,
  max(month_key) as latest_archive_month, bool_or(month_key = '%s') as has_current_month_archive
from s_arch group by username""" % CURRENT, ("s_arch",))
block("s_ext", _oracle_text(STATE_EXT, state="s_state2", hashes="s_hash"), ("s_state2", "s_hash"))
block("s_stored0", f"select username, month_key from fx_stored where month_key < '{STORED_BEFORE}'", ("fx_stored",))

block("s_due", f"""
select * from s_ext
where status = 'active' and (archive_last_checked_at is null or case when coalesce(has_current_month_archive, false)
  then archive_last_checked_at <= timestamp '{NOW}' - INTERVAL 24 HOUR
  else archive_last_checked_at <= timestamp '{NOW}' - INTERVAL 30 DAY end)""", ("s_ext",))

block("s_pending_all", f"""
select a.username, a.month_key from s_arch a
where a.month_key <> '{CURRENT}'
  and not exists (select 1 from s_stored0 s where s.username = a.username and s.month_key = a.month_key)""",
      ("s_arch", "s_stored0"))

block("s_refreshed", """
select d.username, h.archive_hash, h.latest_archive_month, h.has_current_month_archive,
  not (h.archive_hash is not distinct from d.archive_hash) as changed
from s_due d join s_hash h on h.username = d.username""", ("s_due", "s_hash"))

block("s_f9", f"""
select s.title, s.username, s.status,
  case when r.username is not null then timestamp '{NOW}' else s.archive_last_checked_at end as archive_last_checked_at,
  case when r.username is not null then r.archive_hash else s.archive_hash end as archive_hash,
  case when r.changed then concat('raw/player_archives/', s.username, '/{DAY2}.json') else s.archive_snapshot_key end as archive_snapshot_key,
  case when r.username is not null then r.latest_archive_month else s.latest_archive_month end as latest_archive_month,
  case when r.username is not null then r.has_current_month_archive else s.has_current_month_archive end as has_current_month_archive,
  case when r.changed then coalesce(p.n, 0) when r.username is not null then coalesce(s.backfill_pending_count, 0)
    else s.backfill_pending_count end as backfill_pending_count,
  s.current_month_key
from s_ext s
left join s_refreshed r on r.username = s.username
left join (select username, count(*) as n from s_pending_all group by 1) p on p.username = s.username""",
      ("s_ext", "s_refreshed", "s_pending_all"))

# Index after the refresh, as row sets: stored, archive, pending.
block("s_ix_users", """
select username from s_stored0 union select username from s_refreshed where changed""", ("s_stored0", "s_refreshed"))
block("s_ix_arch", """
select a.username, a.month_key from s_arch a join s_refreshed r on r.username = a.username and r.changed""",
      ("s_arch", "s_refreshed"))
block("s_ix_pending", """
select p.username, p.month_key from s_pending_all p join s_refreshed r on r.username = p.username and r.changed""",
      ("s_pending_all", "s_refreshed"))

block("s_queue", f"""
select title, username, case when month_key is not null then cast(mrn - 1 as integer) end as month_pos, month_key
from (
  select q.title, q.username, p.month_key,
    row_number() over (partition by q.username order by p.month_key) as mrn
  from (select title, username from (
          select title, username, row_number() over (partition by title order by username) as rn
          from s_f9 where coalesce(backfill_pending_count, 0) > 0) x where rn <= 10) q
  left join s_ix_pending p on p.username = q.username and p.month_key <> '{CURRENT}'
) y
where mrn <= 6""", ("s_f9", "s_ix_pending"))

block("s_raw_present", f"select username, month_key from fx_stored where month_key >= '{STORED_BEFORE}'", ("fx_stored",))
block("s_done", """
select q.username, q.month_key from s_queue q
where q.month_key is not null and (
  exists (select 1 from s_raw_present r where r.username = q.username and r.month_key = q.month_key)
  or exists (select 1 from fx_responses f where f.username = q.username and f.month_key = q.month_key
             and f.status_code not in (304, 404) and f.game_count is not null))""",
      ("s_queue", "s_raw_present", "fx_responses"))
block("s_eligible", "select distinct username from s_queue where month_key is not null", ("s_queue",))
block("s_stored1", """
select username, month_key from s_stored0
union select username, month_key from s_done""", ("s_stored0", "s_done"))
block("s_pending1", """
select p.username, p.month_key from s_ix_pending p
where not (p.username in (select username from s_eligible)
           and exists (select 1 from s_stored1 s where s.username = p.username and s.month_key = p.month_key))""",
      ("s_ix_pending", "s_eligible", "s_stored1"))


def _agg(table: str, alias: str) -> str:
    return (f"coalesce((select string_agg(month_key, ',' order by month_key) from {table} t "
            f"where t.username = u.username), '') as {alias}")


# ---------------------------------------------------------------------------
# Contract queries
# ---------------------------------------------------------------------------
@register("roster_normalize", oracle("""
select title, snapshot_date, cast(row_number() over (partition by title, snapshot_date order by username) - 1 as integer) as pos,
  username, cast(count(*) over (partition by title, snapshot_date) as integer) as player_count
from (select distinct title, snapshot_date, username from fx_roster) r""", "fx_roster"))
def q_roster_normalize(spark, sf):
    from gamelake.plans.q_bronze import roster_documents
    n = ST.normalize_roster(roster_documents(spark, sf))
    return n.select("title", "snapshot_date", F.posexplode("players").alias("pos", "username"), "player_count")


@register("roster_diff", oracle("""
select coalesce(s.title, t.title) as title, coalesce(s.username, t.username) as username,
  case when s.username is null then 'new' when t.username is null then 'removed' else 'kept' end as change
from (select title, username from s_state1 where status = 'active') s
full outer join (select distinct title, username from s_day2) t on s.title = t.title and s.username = t.username""",
    "s_state1", "s_day2"))
def q_roster_diff(spark, sf):
    return ST.roster_diff(state1(spark, sf), day(spark, sf, DAY2))


@register("player_state_upsert", oracle("""
select title, username, status, first_seen_snapshot_date, last_seen_snapshot_date, removed_snapshot_date, player_index_key
from s_state3""", "s_state3"))
def q_player_state_upsert(spark, sf):
    return state3(spark, sf).select("title", "username", "status", "first_seen_snapshot_date",
                                    "last_seen_snapshot_date", "removed_snapshot_date", "player_index_key")


@register("refresh_due", oracle("select title, username from s_due", "s_due"))
def q_refresh_due(spark, sf):
    s = state_ext(spark, sf)
    return s.filter(ST.refresh_due(s, NOW)).select("title", "username")


@register("archive_months", oracle("""
select u.username, """ + _agg("s_arch", "archive_months") + """, cast((select count(*) from s_arch t where t.username = u.username) as integer) as n_months
from (select distinct username from s_arch) u""", "s_arch"))
def q_archive_months(spark, sf):
    r = refresh_all(spark, sf)
    return r.select("username", _j("archive_months").alias("archive_months"),
                    F.size("archive_months").cast("int").alias("n_months"))


@register("archive_hash", oracle("select username, archive_hash, latest_archive_month, has_current_month_archive from s_hash",
                                 "s_hash"))
def q_archive_hash(spark, sf):
    return refresh_all(spark, sf).select("username", "archive_hash", "latest_archive_month", "has_current_month_archive")


@register("archive_changed", oracle("""
select s.username, not (h.archive_hash is not distinct from s.archive_hash) as changed
from s_ext s join s_hash h on h.username = s.username""", "s_ext", "s_hash"))
def q_archive_changed(spark, sf):
    s = state_ext(spark, sf)
    r = refresh_all(spark, sf).select("username", F.col("archive_hash").alias("new_hash"))
    return s.join(r, "username").select("username", ST.archive_changed("new_hash", "archive_hash").alias("changed"))


@register("pending_backfill", oracle("""
select u.username, """ + _agg("s_pending_all", "pending") + """,
  cast((select count(*) from s_pending_all t where t.username = u.username) as integer) as n_pending
from (select distinct username from s_arch) u""", "s_arch", "s_pending_all"))
def q_pending_backfill(spark, sf):
    r = refresh_all(spark, sf)
    j = r.join(index0(spark, sf).select("username", "stored_months"), "username", "left")
    p = ST.pending_backfill("archive_months", "stored_months", CURRENT)
    return j.select("username", _j(p).alias("pending"), F.size(p).cast("int").alias("n_pending"))


@register("archive_refresh_apply", oracle("""
select title, username, strftime(archive_last_checked_at, '%Y-%m-%d %H:%M:%S') as checked_at, archive_hash,
  archive_snapshot_key, latest_archive_month, has_current_month_archive,
  coalesce(backfill_pending_count, 0) > 0 as backfill_pending, cast(backfill_pending_count as integer) as backfill_pending_count
from s_f9""", "s_f9"))
def q_archive_refresh_apply(spark, sf):
    s, _ = refreshed(spark, sf)
    return s.select("title", "username", _ts("archive_last_checked_at").alias("checked_at"), "archive_hash",
                    "archive_snapshot_key", "latest_archive_month", "has_current_month_archive",
                    F.coalesce(F.col("backfill_pending_count"), F.lit(0)).__gt__(0).alias("backfill_pending"),
                    "backfill_pending_count")


@register("archive_refresh_index", oracle("""
select u.username, """ + _agg("s_stored0", "stored_months") + ", " + _agg("s_ix_arch", "archive_months") + ", "
    + _agg("s_ix_pending", "pending_backfill_months") + """,
  case when u.username in (select username from s_refreshed where changed)
    then concat('raw/player_archives/', u.username, '/""" + DAY2 + """.json') end as latest_archive_snapshot_key
from s_ix_users u""", "s_ix_users", "s_stored0", "s_ix_arch", "s_ix_pending", "s_refreshed"))
def q_archive_refresh_index(spark, sf):
    _, ix = refreshed(spark, sf)
    return ix.select("username", _j("stored_months").alias("stored_months"), _j("archive_months").alias("archive_months"),
                     _j("pending_backfill_months").alias("pending_backfill_months"), "latest_archive_snapshot_key")


@register("month_rollover", oracle(f"""
select username, case when roll then null else current_month_key end as current_month_key,
  case when roll then null else current_month_game_key end as current_month_game_key,
  case when roll then 0 else current_month_game_count end as current_month_game_count
from (select *, current_month_key is not null and current_month_key <> '{CURRENT}' and current_month_game_key is not null as roll
      from s_ext) s""", "s_ext"))
def q_month_rollover(spark, sf):
    s, _ = ST.month_rollover(state_ext(spark, sf), index0(spark, sf), CURRENT)
    return s.select("username", "current_month_key", "current_month_game_key", "current_month_game_count")


@register("month_rollover_index", oracle(f"""
select u.username, coalesce((select string_agg(month_key, ',' order by month_key) from (
    select month_key from s_stored0 t where t.username = u.username
    union select current_month_key from s_ext e where e.username = u.username and e.current_month_key is not null
      and e.current_month_key <> '{CURRENT}' and e.current_month_game_key is not null) m), '') as stored_months
from (select username from s_stored0 union
      select username from s_ext where current_month_key is not null and current_month_key <> '{CURRENT}'
        and current_month_game_key is not null) u""", "s_stored0", "s_ext"))
def q_month_rollover_index(spark, sf):
    _, ix = ST.month_rollover(state_ext(spark, sf), index0(spark, sf), CURRENT)
    return ix.select("username", _j("stored_months").alias("stored_months"))


@register("sync_candidates", oracle(
    "select title, username from s_ext where status = 'active' and coalesce(has_current_month_archive, false)", "s_ext"))
def q_sync_candidates(spark, sf):
    return ST.sync_candidates(state_ext(spark, sf)).select("title", "username")


@register("sync_requests", oracle(f"""
select title, username, '{CURRENT}' as month_key,
  case when current_month_key = '{CURRENT}' then current_month_etag end as etag,
  case when current_month_key = '{CURRENT}' then current_month_last_modified end as last_modified
from s_ext where status = 'active' and coalesce(has_current_month_archive, false)""", "s_ext"))
def q_sync_requests(spark, sf):
    return ST.sync_requests(state_ext(spark, sf), CURRENT)


_CLS = """(select username, month_key, etag as r_etag, game_count as r_game_count,
  case when status_code = 304 then 'not_modified' when status_code = 404 or game_count is null then 'empty'
    else 'updated' end as sync_status from fx_responses)"""


@register("sync_apply", oracle(f"""
select s.title, s.username,
  case when c.sync_status is not null then '{NOW}' end as last_game_sync_at,
  case when c.sync_status = 'updated' then '{CURRENT}' else s.current_month_key end as current_month_key,
  case when c.sync_status = 'updated' then c.r_etag else s.current_month_etag end as current_month_etag,
  case when c.sync_status = 'updated' then concat('raw/player_games/year=1996/month=05/username=', s.username, '.json')
    else s.current_month_game_key end as current_month_game_key,
  case when c.sync_status = 'updated' then c.r_game_count else s.current_month_game_count end as current_month_game_count
from s_ext s
left join {_CLS} c on c.username = s.username and c.month_key = '{CURRENT}'
  and s.status = 'active' and coalesce(s.has_current_month_archive, false)""", "s_ext", "fx_responses"))
def q_sync_apply(spark, sf):
    s = state_ext(spark, sf)
    out = ST.apply_sync(s, ST.sync_requests(s, CURRENT), fixtures.view(spark, sf, "fx_responses"), NOW)
    return out.select("title", "username", _ts("last_game_sync_at").alias("last_game_sync_at"), "current_month_key",
                      "current_month_etag", "current_month_game_key", "current_month_game_count")


@register("sync_report", oracle(f"""
select s.title,
  cast(sum(case when c.sync_status = 'updated' then 1 else 0 end) as bigint) as updated,
  cast(sum(case when c.sync_status = 'not_modified' then 1 else 0 end) as bigint) as not_modified,
  cast(sum(case when c.sync_status = 'empty' then 1 else 0 end) as bigint) as empty,
  cast(sum(case when c.sync_status is null then 1 else 0 end) as bigint) as error
from (select * from s_ext where status = 'active' and coalesce(has_current_month_archive, false)) s
left join {_CLS} c on c.username = s.username and c.month_key = '{CURRENT}'
group by s.title""", "s_ext", "fx_responses"))
def q_sync_report(spark, sf):
    s = state_ext(spark, sf)
    return ST.sync_report(ST.sync_requests(s, CURRENT), fixtures.view(spark, sf, "fx_responses"))


@register("backfill_queue", oracle("select title, username, month_pos, month_key from s_queue", "s_queue"))
def q_backfill_queue(spark, sf):
    _, _, q = queue(spark, sf)
    return q.select("title", "username", F.when(F.col("month_key").isNotNull(), F.col("month_pos")).cast("int").alias("month_pos"),
                    "month_key")


@register("backfill_apply", oracle("""
select u.username, """ + _agg("s_stored1", "stored_months") + ", " + _agg("s_pending1", "pending_backfill_months") + """
from (select username from s_stored0 union select username from s_refreshed where changed) u""",
    "s_stored0", "s_refreshed", "s_stored1", "s_pending1"))
def q_backfill_apply(spark, sf):
    _, ix, _ = backfill(spark, sf)
    return ix.select("username", _j("stored_months").alias("stored_months"),
                     _j("pending_backfill_months").alias("pending_backfill_months"))


block("s_result", """
select q.title, q.username,
  cast(case when q.title = (select min(f.title) from s_queue f where f.username = q.username)
    then (select count(*) from s_done d where d.username = q.username) else 0 end as bigint) as processed,
  cast(case when q.username in (select username from s_eligible)
    then (select count(*) from s_pending1 p where p.username = q.username)
    else (select count(*) from s_ix_pending p where p.username = q.username) end as integer) as remaining
from (select distinct title, username from s_queue) q""", ("s_queue", "s_done", "s_eligible", "s_pending1", "s_ix_pending"))


@register("backfill_result", oracle("select title, username, processed, remaining from s_result", "s_result"))
def q_backfill_result(spark, sf):
    _, _, result = backfill(spark, sf)
    return result


@register("backfill_report", oracle("""
select s.title, count(*) as players, cast(sum(r.processed) as bigint) as months_processed,
  cast(sum(case when r.remaining > 0 then 1 else 0 end) as bigint) as players_still_pending
from s_f9 s join s_result r on r.username = s.username and r.title = s.title group by s.title""", "s_f9", "s_result"))
def q_backfill_report(spark, sf):
    s, _, result = backfill(spark, sf)
    return ST.backfill_report(s, result)


# --- archive lists, roster snapshots, legacy paths, bootstrap ---------------------
def archive_docs(spark, sf) -> DataFrame:
    d = _spark_sql(spark, ARCHIVE_DOCS, fx_archives=fixtures.view(spark, sf, "fx_archives"))
    return d.groupBy("username", "raw_key").agg(F.collect_list("archive_url").alias("archives"))


_RANK = ("case when regexp_matches(raw_key, '/\\d{4}-\\d{2}-\\d{2}\\.json$') then 2 "
         "when regexp_matches(raw_key, '/\\d{4}/\\d{2}\\.json$') then 1 else 0 end")
_RANKV = ("case when regexp_matches(raw_key, '/\\d{4}-\\d{2}-\\d{2}\\.json$') then regexp_extract(raw_key, '/(\\d{4}-\\d{2}-\\d{2})\\.json$', 1) "
          "when regexp_matches(raw_key, '/\\d{4}/\\d{2}\\.json$') then regexp_extract(raw_key, '/(\\d{4})/(\\d{2})\\.json$', 1) || '-' || "
          "regexp_extract(raw_key, '/(\\d{4})/(\\d{2})\\.json$', 2) else raw_key end")
block("s_archive_docs", _oracle_text(ARCHIVE_DOCS, fx_archives="fx_archives"), ("fx_archives",))
block("s_latest_list", f"""
select username, raw_key from (
  select username, raw_key, row_number() over (partition by username order by {_RANK} desc, {_RANKV} desc) as rn
  from (select distinct username, raw_key from s_archive_docs) d
) r where rn = 1""", ("s_archive_docs",))


@register("latest_archive_list", oracle("""
select l.username, l.raw_key, cast(count(*) as integer) as archive_count
from s_latest_list l join s_archive_docs d on d.username = l.username and d.raw_key = l.raw_key
group by l.username, l.raw_key""", "s_latest_list", "s_archive_docs"))
def q_latest_archive_list(spark, sf):
    latest = raw.latest_archive_list(archive_docs(spark, sf))
    return latest.select("username", "raw_key", F.size("archives").cast("int").alias("archive_count"))


@register("latest_roster", oracle("""
select title, max(snapshot_date) as snapshot_date from fx_roster group by title""", "fx_roster"))
def q_latest_roster(spark, sf):
    from gamelake.plans.q_bronze import roster_documents
    docs = roster_documents(spark, sf).withColumn(
        "raw_key", F.concat(F.lit("raw/titled_players/"), "title", F.lit("/"), "snapshot_date", F.lit(".json")))
    return ST.latest_roster(docs).select("title", "snapshot_date")


block("s_legacy_paths", _oracle_text(LEGACY_PATHS, fx_stored="fx_stored"), ("fx_stored",))


@register("stored_months", oracle("""
select regexp_extract(path, '^.*/([^/]+)/(\\d{4})/(\\d{2})\\.json$', 1) as username,
  string_agg(distinct regexp_extract(path, '^.*/([^/]+)/(\\d{4})/(\\d{2})\\.json$', 2) || '-' ||
    regexp_extract(path, '^.*/([^/]+)/(\\d{4})/(\\d{2})\\.json$', 3), ',' order by regexp_extract(path, '^.*/([^/]+)/(\\d{4})/(\\d{2})\\.json$', 2) || '-' ||
    regexp_extract(path, '^.*/([^/]+)/(\\d{4})/(\\d{2})\\.json$', 3)) as stored_months
from s_legacy_paths
where regexp_extract(path, '^.*/([^/]+)/(\\d{4})/(\\d{2})\\.json$', 1) <> ''
group by 1""", "s_legacy_paths"))
def q_stored_months(spark, sf):
    paths = _spark_sql(spark, LEGACY_PATHS, fx_stored=fixtures.view(spark, sf, "fx_stored"))
    return ST.stored_months(paths).select("username", _j("stored_months").alias("stored_months"))


block("s_boot_players", """
select distinct r.title, r.snapshot_date, r.username from fx_roster r
join (select title, max(snapshot_date) as d from fx_roster group by title) m on m.title = r.title and m.d = r.snapshot_date""",
      ("fx_roster",))
block("s_boot_arch", f"""
select distinct d.username, {_MONTH_OF_URL} as month_key
from s_archive_docs d join s_latest_list l on l.username = d.username and l.raw_key = d.raw_key""",
      ("s_archive_docs", "s_latest_list"))
block("s_boot_stored", "select distinct username, month_key from fx_stored", ("fx_stored",))
block("s_boot_pending", f"""
select a.username, a.month_key from s_boot_arch a
where a.month_key <> '{CURRENT}'
  and not exists (select 1 from s_boot_stored s where s.username = a.username and s.month_key = a.month_key)""",
      ("s_boot_arch", "s_boot_stored"))


@register("bootstrap_state", oracle(f"""
select p.title, p.username, p.snapshot_date as first_seen_snapshot_date,
  case when l.raw_key is null then null
    when regexp_matches(l.raw_key, '/\\d{{4}}-\\d{{2}}-\\d{{2}}\\.json$')
      then regexp_extract(l.raw_key, '/(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.json$', 1) || ' 00:00:00'
    else '{NOW}' end as checked_at,
  case when l.raw_key is not null then sha256(coalesce('["' || (select string_agg(month_key, '", "' order by month_key)
    from s_boot_arch a where a.username = p.username) || '"]', '[]')) end as archive_hash,
  l.raw_key as archive_snapshot_key,
  case when l.raw_key is not null then (select max(month_key) from s_boot_arch a where a.username = p.username) end as latest_archive_month,
  coalesce(l.raw_key is not null and exists (select 1 from s_boot_arch a where a.username = p.username and a.month_key = '{CURRENT}'), false) as has_current_month_archive,
  case when exists (select 1 from s_boot_stored s where s.username = p.username and s.month_key = '{CURRENT}') then '{CURRENT}' end as current_month_key,
  cast(case when exists (select 1 from s_boot_stored s where s.username = p.username and s.month_key = '{CURRENT}')
    then coalesce((select max(game_count) from fx_responses f where f.username = p.username and f.month_key = '{CURRENT}' and f.status_code = 200), 0)
    else 0 end as integer) as current_month_game_count,
  cast((select count(*) from s_boot_pending b where b.username = p.username) as integer) as backfill_pending_count
from s_boot_players p left join s_latest_list l on l.username = p.username""",
    "s_boot_players", "s_latest_list", "s_boot_arch", "s_boot_stored", "s_boot_pending", "fx_responses"))
def q_bootstrap_state(spark, sf):
    s, _ = _bootstrap(spark, sf)
    return s.select("title", "username", "first_seen_snapshot_date", _ts("archive_last_checked_at").alias("checked_at"),
                    "archive_hash", "archive_snapshot_key", "latest_archive_month", "has_current_month_archive",
                    "current_month_key", "current_month_game_count", "backfill_pending_count")


def _bootstrap(spark, sf):
    from gamelake.plans.q_bronze import roster_documents
    docs = roster_documents(spark, sf).withColumn(
        "raw_key", F.concat(F.lit("raw/titled_players/"), "title", F.lit("/"), "snapshot_date", F.lit(".json")))
    latest = ST.latest_roster(docs)
    lists = raw.latest_archive_list(archive_docs(spark, sf))
    stored = ST.stored_months(fixtures.view(spark, sf, "fx_stored").select(
        F.concat(F.lit("raw/player_games/"), "username", F.lit("/"), F.substring("month_key", 1, 4), F.lit("/"),
                 F.substring("month_key", 6, 2), F.lit(".json")).alias("path")))
    cur = (fixtures.view(spark, sf, "fx_responses")
           .filter((F.col("month_key") == CURRENT) & (F.col("status_code") == 200)).select("username", "game_count"))
    return ST.bootstrap(latest, lists, stored, cur, CURRENT, NOW)


@register("bootstrap_index", oracle("""
select p.username,
  coalesce((select string_agg(month_key, ',' order by month_key) from s_boot_stored s where s.username = p.username), '') as stored_months,
  coalesce((select string_agg(month_key, ',' order by month_key) from s_boot_arch a where a.username = p.username), '') as archive_months,
  coalesce((select string_agg(month_key, ',' order by month_key) from s_boot_pending b where b.username = p.username), '') as pending_backfill_months,
  l.raw_key as latest_archive_snapshot_key
from (select distinct username from s_boot_players) p left join s_latest_list l on l.username = p.username""",
    "s_boot_players", "s_boot_stored", "s_boot_arch", "s_boot_pending", "s_latest_list"))
def q_bootstrap_index(spark, sf):
    _, ix = _bootstrap(spark, sf)
    return ix.select("username", _j("stored_months").alias("stored_months"), _j("archive_months").alias("archive_months"),
                     _j("pending_backfill_months").alias("pending_backfill_months"), "latest_archive_snapshot_key")
