"""Contract queries for the saved control state and the daily cycle over it (A14, F1..F17 together, B5 from the state).

Three days run once per input directory against a fresh state folder, with
promoted players, players on two rosters, failed list fetches and 429, 500,
404, 304 and empty answers. The oracle replays the days on row sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.operators import state as ST
from gamelake.plans import daily, q_state, sqlx
from gamelake.plans.contract import block, oracle, register
from gamelake.sources import fixtures, raw, state_store

DAYS = ("1996-05-30", "1996-05-31", "1996-06-01")


def _now(ds: str) -> str:
    return f"{ds} 12:00:00"


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def landed(spark: SparkSession, sf: str, root: str) -> dict[str, DataFrame]:
    """What the three days fetch, as landed files: written once, read by every step."""
    rosters, lists, answers, months = (fixtures.view(spark, sf, f"fx_cycle_{n}") for n in ("roster", "lists", "answers", "raw"))
    tables = {
        "rosters": rosters.groupBy("day", "title").agg(F.collect_list("username").alias("players")),
        "lists": lists.groupBy("day", "username").agg(F.collect_list("archive_url").alias("archives")),
        "answers": answers, "raw_months": months}
    with daily.shuffled(spark):
        for name, df in tables.items():
            df.write.partitionBy(*[c for c in ("day",) if c in df.columns]).parquet(f"{root}/landed/{name}")
    return {n: spark.read.schema(df.schema).parquet(f"{root}/landed/{n}") for n, df in tables.items()}


def run_days(spark: SparkSession, sf: str, root: str) -> None:
    files = landed(spark, sf, root)
    for d, ds in enumerate(DAYS, 1):
        documents = files["rosters"].filter(F.col("day") == d).select("title", "players", F.lit(ds).alias("snapshot_date"))
        todays = files["lists"].filter(F.col("day") == d).select("username", "archives")
        source = daily.Answers(
            lists=lambda due, todays=todays: todays.join(due.select("username").distinct(), "username", "left_semi"),
            games=lambda requests: requests.select("username", "month_key").join(files["answers"], ["username", "month_key"]),
            raw_months=files["raw_months"])
        report = daily.run_day(spark, root, documents, source, ds, _now(ds))
        report.write.parquet(f"{root}/day_reports/day={d}")


def cycle_root(spark: SparkSession, sf: str) -> str:
    from gamelake.session import scratch_path
    root = scratch_path(spark, "fixture", fixtures.input_token(spark, sf), "cycle")
    return raw.publish(spark, root, lambda tmp: run_days(spark, sf, tmp))


def control(spark: SparkSession, sf: str) -> state_store.Control:
    return state_store.read(spark, cycle_root(spark, sf))


# ---------------------------------------------------------------------------
# Oracle: the days as row sets
# ---------------------------------------------------------------------------
_FIELDS = ("title, username, status, first_seen, last_seen, removed, checked, hash, snap_key, latest, has_cur, cur_key, cur_etag, "
           "game_key, cur_count, synced, pending")
block("c0_p", """
select * from (select cast(null as varchar) as title, cast(null as varchar) as username, cast(null as varchar) as status,
  cast(null as varchar) as first_seen, cast(null as varchar) as last_seen, cast(null as varchar) as removed,
  cast(null as timestamp) as checked, cast(null as varchar) as hash, cast(null as varchar) as snap_key, cast(null as varchar) as latest,
  false as has_cur, cast(null as varchar) as cur_key, cast(null as varchar) as cur_etag, cast(null as varchar) as game_key,
  cast(0 as integer) as cur_count, cast(null as timestamp) as synced, cast(0 as integer) as pending) x where false""")
for _n in ("stored", "arch", "pend"):
    block(f"c0_{_n}", "select * from (select cast(null as varchar) as username, cast(null as varchar) as month_key) x where false")
block("c0_ix", "select * from (select cast(null as varchar) as username, cast(null as varchar) as list_key) x where false")
block("c0_titles", "select * from (select cast(null as varchar) as title, cast(null as varchar) as ds) x where false")

_URL_MONTH = ("concat(list_extract(string_split(archive_url, '/'), -2), '-', lpad(list_extract(string_split(archive_url, '/'), -1), 2, '0'))")


def _keep(fields: str, alias: str, **new: str) -> str:
    return ", ".join(f"{new[f]} as {f}" if f in new else f"{alias}.{f}" for f in fields.split(", "))


def _day_blocks(d: int, ds: str) -> None:
    cur, now, o, c = ds[:7], _now(ds), f"c{d - 1}", f"c{d}"

    def add(name: str, text: str, *deps: str) -> None:
        block(f"{c}_{name}", text, deps)

    add("today", f"select distinct title, username from fx_cycle_roster where day = {d}", "fx_cycle_roster")
    add("titles", f"""
select title, ds from {o}_titles where title not in (select title from {c}_today)
union all select distinct title, '{ds}' from {c}_today""", f"{o}_titles", f"{c}_today")
    add("change", f"""
select coalesce(s.title, t.title) as title, case when s.username is null then 'new' when t.username is null then 'removed' else 'kept' end as change
from (select title, username from {o}_p where status = 'active' and title in (select title from {c}_today)) s
full outer join {c}_today t on t.title = s.title and t.username = s.username""", f"{o}_p", f"{c}_today")
    here = "t.username is not null"
    gone = f"{here} is false and s.status = 'active' and s.title in (select title from {c}_today)"
    add("p1", f"""
select """ + _keep(_FIELDS, "s", title="coalesce(s.title, t.title)", username="coalesce(s.username, t.username)",
                   status=f"case when {here} then 'active' when {gone} then 'removed' else s.status end",
                   first_seen=f"case when {here} then coalesce(s.first_seen, '{ds}') else s.first_seen end",
                   last_seen=f"case when {here} then '{ds}' else s.last_seen end",
                   removed=f"case when {here} then null when {gone} then '{ds}' else s.removed end",
                   has_cur="coalesce(s.has_cur, false)", cur_count="coalesce(s.cur_count, 0)", pending="coalesce(s.pending, 0)") + f"""
from {o}_p s full outer join {c}_today t on t.title = s.title and t.username = s.username""", f"{o}_p", f"{c}_today")
    add("list", f"""
select distinct username, case when archive_url is not null then {_URL_MONTH} end as month_key from fx_cycle_lists where day = {d}""",
        "fx_cycle_lists")
    add("hash", f"""
select username, sha256(coalesce('["' || string_agg(month_key, '", "' order by month_key) || '"]', '[]')) as hash, max(month_key) as latest,
  coalesce(bool_or(month_key = '{cur}'), false) as has_cur from {c}_list group by username""", f"{c}_list")
    add("res", f"""
select p.title, p.username, h.hash, h.latest, h.has_cur, p.hash is distinct from h.hash as changed
from {c}_p1 p join {c}_hash h on h.username = p.username
where p.status = 'active' and (p.checked is null or p.checked <= timestamp '{now}' - case when p.has_cur then interval 24 hour else interval 30 day end)""",
        f"{c}_p1", f"{c}_hash")
    add("chg", f"select distinct username from {c}_res where changed", f"{c}_res")
    add("pnew", f"""
select l.username, l.month_key from {c}_list l join {c}_chg using (username)
where l.month_key is not null and l.month_key <> '{cur}'
  and not exists (select 1 from {o}_stored s where s.username = l.username and s.month_key = l.month_key)""", f"{c}_list", f"{c}_chg", f"{o}_stored")
    got = "r.username is not null"
    add("p2", f"""
select """ + _keep(_FIELDS, "p", checked=f"case when {got} then timestamp '{now}' else p.checked end",
                   hash=f"case when {got} then r.hash else p.hash end",
                   snap_key=f"case when r.changed then concat('raw/player_archives/', p.username, '/{ds}.json') else p.snap_key end",
                   latest=f"case when {got} then r.latest else p.latest end", has_cur=f"case when {got} then r.has_cur else p.has_cur end",
                   pending="cast(case when r.changed then coalesce(n.n, 0) else p.pending end as integer)") + f"""
from {c}_p1 p left join {c}_res r on r.title = p.title and r.username = p.username
left join (select username, count(*) as n from {c}_pnew group by 1) n on n.username = p.username""", f"{c}_p1", f"{c}_res", f"{c}_pnew")
    for name, new in (("arch", f"select l.username, l.month_key from {c}_list l join {c}_chg using (username) where l.month_key is not null"),
                      ("pend", f"select username, month_key from {c}_pnew")):
        add(f"{name}2", f"select username, month_key from {o}_{name} where username not in (select username from {c}_chg)\nunion all {new}",
            f"{o}_{name}", f"{c}_chg", f"{c}_list", f"{c}_pnew")
    add("rolled", f"""
select distinct username, cur_key as month_key from {c}_p2 where cur_key is not null and cur_key <> '{cur}' and game_key is not null""", f"{c}_p2")
    add("stored3", f"select username, month_key from {o}_stored union select username, month_key from {c}_rolled", f"{o}_stored", f"{c}_rolled")
    add("ix", f"""
select username, max(list_key) as list_key from (
  select username, list_key from {o}_ix where username not in (select username from {c}_chg)
  union all select username, concat('raw/player_archives/', username, '/{ds}.json') from {c}_chg
  union all select username, null from {c}_rolled) u group by username""", f"{o}_ix", f"{c}_chg", f"{c}_rolled")
    roll = f"(p.cur_key is not null and p.cur_key <> '{cur}' and p.game_key is not null)"
    add("p3", "select " + _keep(_FIELDS, "p", **{f: f"case when {roll} then null else p.{f} end" for f in ("cur_key", "cur_etag", "game_key")},
                                cur_count=f"case when {roll} then 0 else p.cur_count end") + f" from {c}_p2 p", f"{c}_p2")
    add("answer", """
select username, month_key, etag, game_count, case when status_code = 304 then 'not_modified' when status_code = 404 then 'empty'
  when status_code not between 200 and 299 then 'error' when game_count is null then 'empty' else 'updated' end as answer
from fx_cycle_answers""", "fx_cycle_answers")
    add("sync", f"""
select p.title, p.username, coalesce(a.answer, 'error') as answer, a.etag, a.game_count
from {c}_p3 p left join {c}_answer a on a.username = p.username and a.month_key = '{cur}'
where p.status = 'active' and p.has_cur""", f"{c}_p3", f"{c}_answer")
    upd = "y.answer = 'updated'"
    add("p4", "select " + _keep(_FIELDS, "p", synced=f"case when y.answer <> 'error' then timestamp '{now}' else p.synced end",
                                cur_key=f"case when {upd} then '{cur}' else p.cur_key end", cur_etag=f"case when {upd} then y.etag else p.cur_etag end",
                                game_key=f"case when {upd} then concat('raw/player_games/year={cur[:4]}/month={cur[5:]}/username=', p.username, '.json') else p.game_key end",
                                cur_count=f"case when {upd} then y.game_count else p.cur_count end")
        + f" from {c}_p3 p left join {c}_sync y on y.title = p.title and y.username = p.username", f"{c}_p3", f"{c}_sync")
    add("queue", f"""
select q.title, q.username, m.month_key from (
  select title, username from (select title, username, row_number() over (partition by title order by username) as rn
    from {c}_p4 where pending > 0) r where rn <= 10) q
left join (select username, month_key, row_number() over (partition by username order by month_key) as rn
  from {c}_pend2 where month_key <> '{cur}') m on m.username = q.username and m.rn <= 6""", f"{c}_p4", f"{c}_pend2")
    add("done", f"""
select username, month_key, min(title) as title from {c}_queue q
where month_key is not null and (exists (select 1 from fx_cycle_raw r where r.username = q.username and r.month_key = q.month_key)
  or exists (select 1 from {c}_answer a where a.username = q.username and a.month_key = q.month_key and a.answer = 'updated'))
group by 1, 2""", f"{c}_queue", f"{c}_answer", "fx_cycle_raw")
    add("stored", f"select username, month_key from {c}_stored3 union select username, month_key from {c}_done", f"{c}_stored3", f"{c}_done")
    add("arch", f"select username, month_key from {c}_arch2", f"{c}_arch2")
    add("pend", f"""
select username, month_key from {c}_pend2 p
where not (username in (select username from {c}_queue where month_key is not null)
  and exists (select 1 from {c}_stored s where s.username = p.username and s.month_key = p.month_key))""", f"{c}_pend2", f"{c}_queue", f"{c}_stored")
    add("result", f"""
select q.title, q.username, (select count(*) from {c}_done x where x.title = q.title and x.username = q.username) as processed,
  (select count(*) from {c}_pend p where p.username = q.username) as remaining
from (select distinct title, username from {c}_queue) q""", f"{c}_queue", f"{c}_done", f"{c}_pend")
    add("p", "select " + _keep(_FIELDS, "p", pending="cast(coalesce(r.remaining, p.pending) as integer)")
        + f" from {c}_p4 p left join {c}_result r on r.title = p.title and r.username = p.username", f"{c}_p4", f"{c}_result")

    def tally(alias: str, source: str, *counts: str) -> str:
        return f"left join (select title, {', '.join(counts)} from {c}_{source} group by title) {alias} using (title)"

    add("report", f"""
select '{ds}' as ds, t.title, """ + ", ".join(f"cast(coalesce({n}, 0) as bigint) as \"{n}\"" for n in daily.REPORT) + f"""
from (select distinct title from {c}_p) t
""" + "\n".join([
        tally("a", "change", "count(*) filter (change <> 'removed') as active", "count(*) filter (change = 'new') as new",
              "count(*) filter (change = 'removed') as removed"),
        tally("b", "res", "count(*) as refreshed", "count(*) filter (changed) as changed"),
        tally("e", "sync", *[f"count(*) filter (answer = '{a}') as {a}" for a in ("updated", "not_modified", "empty", "error")]),
        tally("f", "result", "count(*) as backfill_players", "sum(processed) as backfill_months", "count(*) filter (remaining > 0) as still_pending"),
    ]), f"{c}_change", f"{c}_res", f"{c}_sync", f"{c}_result", f"{c}_p")


for _d, _ds in enumerate(DAYS, 1):
    _day_blocks(_d, _ds)


# ---------------------------------------------------------------------------
# Contract queries
# ---------------------------------------------------------------------------
_STAMP = "strftime({x}, '%Y-%m-%d %H:%M:%S')"


@register("daily_cycle", oracle(f"""
select title, username, status, first_seen as first_seen_snapshot_date, last_seen as last_seen_snapshot_date, removed as removed_snapshot_date,
  {_STAMP.format(x='checked')} as checked_at, hash as archive_hash, snap_key as archive_snapshot_key, latest as latest_archive_month,
  has_cur as has_current_month_archive, cur_key as current_month_key, cur_etag as current_month_etag, game_key as current_month_game_key,
  cur_count as current_month_game_count, {_STAMP.format(x='synced')} as synced_at, pending > 0 as backfill_pending,
  pending as backfill_pending_count
from c3_p""", "c3_p"))
def q_daily_cycle(spark, sf) -> DataFrame:
    return control(spark, sf).players.select(
        "title", "username", "status", "first_seen_snapshot_date", "last_seen_snapshot_date", "removed_snapshot_date",
        q_state._ts("archive_last_checked_at").alias("checked_at"), "archive_hash", "archive_snapshot_key", "latest_archive_month",
        "has_current_month_archive", "current_month_key", "current_month_etag", "current_month_game_key", "current_month_game_count",
        q_state._ts("last_game_sync_at").alias("synced_at"), "backfill_pending", "backfill_pending_count")


@register("daily_cycle_index", oracle("select u.username, " + ", ".join(q_state._agg(f"c3_{t}", n) for t, n in (
    ("stored", "stored_months"), ("arch", "archive_months"), ("pend", "pending_backfill_months")))
    + ", u.list_key as latest_archive_snapshot_key from c3_ix u", "c3_ix", "c3_stored", "c3_arch", "c3_pend"))
def q_daily_cycle_index(spark, sf) -> DataFrame:
    return control(spark, sf).index.select(
        "username", *[q_state._j(c).alias(c) for c in ("stored_months", "archive_months", "pending_backfill_months")],
        "latest_archive_snapshot_key")


@register("daily_report", oracle("\nunion all\n".join(f"select * from c{d}_report" for d in (1, 2, 3)), "c1_report", "c2_report", "c3_report"))
def q_daily_report(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{cycle_root(spark, sf)}/day_reports").drop("day")


@register("title_state", oracle("""
select title, ds as latest_snapshot_date, concat('raw/titled_players/', title, '/', ds, '.json') as last_snapshot_key,
  ds || ' 12:00:00' as updated_at from c3_titles""", "c3_titles"))
def q_title_state(spark, sf) -> DataFrame:
    return control(spark, sf).titles.select("title", "latest_snapshot_date", "last_snapshot_key", q_state._ts("last_updated_at").alias("updated_at"))


@register("title_lookup_saved", oracle(f"""
select username, arg_min(title, {sqlx.title_priority('title')}) as title from c3_p group by username""", "c3_p"))
def q_title_lookup_saved(spark, sf) -> DataFrame:
    return daily.title_lookup(spark, cycle_root(spark, sf))


@register("state_roundtrip", oracle("""
select s.title, s.username, s.status, s.archive_hash, s.current_month_key, s.current_month_game_key, s.backfill_pending_count,
  coalesce((select string_agg(month_key, ',' order by month_key) from s_stored0 t where t.username = s.username), '') as stored_months,
  cast(2 as integer) as version
from s_ext s where s.status = 'active'""", "s_ext", "s_stored0"))
def q_state_roundtrip(spark, sf) -> DataFrame:
    """Saved, read back, and saved again with fewer players; the index of the first save stays."""
    import uuid

    from gamelake.session import scratch_path
    root = scratch_path(spark, "state-roundtrip", uuid.uuid4().hex[:8])
    first = state_store.commit(spark, root, state_store.read(spark, root), players=q_state.state_ext(spark, sf), index=q_state.index0(spark, sf))
    state_store.commit(spark, root, first, players=first.players.filter(F.col("status") == "active"))
    now = state_store.read(spark, root)
    stored = now.index.select("username", q_state._j("stored_months").alias("stored"))
    return now.players.join(stored, "username", "left").select(
        "title", "username", "status", "archive_hash", "current_month_key", "current_month_game_key", "backfill_pending_count",
        F.coalesce("stored", F.lit("")).alias("stored_months"), F.lit(now.version.number).alias("version"))
