"""Contract queries for the lake layout (A4..A18) and the end-to-end build (G4).

The lake is built once per input directory by ``pipeline.run`` over the
fixture landing zone; these queries read its written tables back. The
oracle follows the same rules from the flat fixture rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gamelake.operators import bronze, layout
from gamelake.plans import q_bronze
from gamelake.plans import q_silver_gold as SG
from gamelake.plans.contract import block, oracle, register
from gamelake.sources import fixtures, lake, raw

SCAN_MONTHS = ("1995-03", "1995-04", "1997-11")


def _lake(spark, sf):
    return fixtures.lake(spark, sf)


def _in(months) -> str:
    return ", ".join(f"'{m}'" for m in months)


# --- oracle: silver and gold over the bronze tables ---------------------------------
_WITH_MONTH = "(select *, year || '-' || month as month_key from {0}) m"
block("p_silver_games", SG.silver_games_sql(_WITH_MONTH.format("bronze_games")), ("bronze_games",))
block("p_silver_facts", SG.silver_facts_sql(_WITH_MONTH.format("bronze_facts")), ("bronze_facts",))
for _name, _rule, _source in (("p_h2h_games", SG.h2h_games_sql, "p_silver_games"), ("p_h2h_monthly", SG.h2h_monthly_sql, "p_h2h_games"),
                              ("p_h2h_summary", SG.h2h_summary_sql, "p_h2h_monthly"),
                              ("p_player_month_activity", SG.player_month_activity_sql, "p_silver_facts"),
                              ("p_title_month_activity", SG.title_month_activity_sql, "p_player_month_activity")):
    block(_name, _rule(_source), (_source,))


# --- A4 / A5 / A6 / A7 / A9 / G4 ------------------------------------------------------
@register("bronze_scan", oracle(f"""
select year, month, bucket, count(*) as games from bronze_games
where concat(year, '-', month) in ({_in(SCAN_MONTHS)}) group by 1, 2, 3""", "bronze_games"))
def q_bronze_scan(spark, sf):
    g = lake.read_bronze_games(spark, _lake(spark, sf), list(SCAN_MONTHS))
    return g.groupBy("year", "month", "bucket").agg(F.count(F.lit(1)).alias("games"))


@register("bronze_roundtrip", oracle(f"select {q_bronze.GAMES_CORE_COLS} from bronze_games", "bronze_games"))
def q_bronze_roundtrip(spark, sf):
    g = lake.read_bronze_games(spark, _lake(spark, sf))
    return g.withColumn("source_player_usernames", F.array_join("source_player_usernames", ",")).select(
        *[c.strip() for c in q_bronze.GAMES_CORE_COLS.split(",")])


@register("bronze_facts_roundtrip", oracle(f"select {q_bronze.FACT_COLS} from bronze_facts", "bronze_facts"))
def q_bronze_facts_roundtrip(spark, sf):
    f = lake.read_bronze_facts(spark, _lake(spark, sf))
    return f.select(*[c.strip() for c in q_bronze.FACT_COLS.split(",")])


SILVER_COLS = ("month_key, year, month, game_uuid, game_url, game_date, end_time_utc, time_class, rated, opening_url, "
               "opening_name, has_pgn, has_tcn, has_accuracies, white_username, white_title, white_rating, white_result, "
               "white_score, white_accuracy, black_username, black_title, black_rating, black_result, black_score, "
               "black_accuracy, winner_color, source_key_count, source_player_count, is_titled_matchup")


@register("silver_roundtrip", oracle(f"select {SILVER_COLS} from p_silver_games", "p_silver_games"))
def q_silver_roundtrip(spark, sf):
    return lake.read(spark, _lake(spark, sf), lake.SILVER_GAMES).select(*[c.strip() for c in SILVER_COLS.split(",")])


@register("silver_facts_roundtrip", oracle(
    "select month_key, game_uuid, username, title, color, rating, score, result, accuracy, score_band from p_silver_facts",
    "p_silver_facts"))
def q_silver_facts_roundtrip(spark, sf):
    return lake.read(spark, _lake(spark, sf), lake.SILVER_FACTS).select(
        "month_key", "game_uuid", "username", "title", "color", "rating", "score", "result", "accuracy", "score_band")


@register("silver_roster_roundtrip", oracle("select * from silver_roster", "silver_roster"))
def q_silver_roster_roundtrip(spark, sf):
    return lake.read(spark, _lake(spark, sf), lake.SILVER_ROSTER).select(
        "snapshot_date", "title", "username", "snapshot_player_count", "snapshot_position", "snapshot_rank")


@register("gold_scan_all_months", oracle("select * from p_title_month_activity", "p_title_month_activity"))
def q_gold_scan_all_months(spark, sf):
    df = lake.read(spark, _lake(spark, sf), "gold/title_month_activity")
    cols = ["month_key", "year", "month", "title", "active_players", "total_games", "total_wins", "total_draws",
            "total_losses", "rated_games", "unrated_games", "games_vs_titled", "games_vs_non_titled",
            "avg_games_per_active_player", "avg_unique_opponents", "avg_player_score_rate", "avg_player_rating"]
    return df.select(*cols)


@register("pipeline_end_to_end", oracle("select * from p_h2h_summary", "p_h2h_summary"))
def q_pipeline_end_to_end(spark, sf):
    return lake.read_full(spark, _lake(spark, sf), lake.GOLD_SUMMARY)


@register("pipeline_h2h_monthly", oracle("select * from p_h2h_monthly", "p_h2h_monthly"))
def q_pipeline_h2h_monthly(spark, sf):
    df = lake.read(spark, _lake(spark, sf), "gold/head_to_head_monthly")
    return df.select("month_key", "year", "month", "pair_bucket", "pair_key", "player_a", "player_b", "games_played",
                     "player_a_wins", "player_b_wins", "draws", "player_a_white_games", "player_a_black_games",
                     "player_b_white_games", "player_b_black_games", "rated_games", "first_game_date", "last_game_date")


# --- A12 / A13 ------------------------------------------------------------------------
@register("raw_feed_repack", oracle("select feed_user, year, month, pos, uuid, url from fx_occ", "fx_occ"))
def q_raw_feed_repack(spark, sf):
    from gamelake.session import scratch_path
    occ = q_bronze.occurrences(spark, sf)
    root = scratch_path(spark, "fixture", fixtures.input_token(spark, sf), "repack", "player_games")
    raw.publish(spark, root, lambda tmp: raw.write_lines(raw.packed_lines(occ, "feed_user"), tmp))
    again = bronze.explode_feed(raw.read_feed(spark, root, opened=False))
    return again.select(F.regexp_extract("raw_key", r"/feed=([^/]+)/", 1).alias("feed_user"), "year", "month", "pos",
                        "uuid", "url")


@register("available_raw_months", oracle("select distinct concat(year, '-', month) as month_key from fx_feed", "fx_feed"))
def q_available_raw_months(spark, sf):
    return raw.months_available(spark, fixtures.landing_zone(spark, sf))


# --- A15 / A16 ------------------------------------------------------------------------
RELAYOUT_KEYS = """
select concat('raw/player_games/', username, '/', substr(month_key, 1, 4), '/', substr(month_key, 6, 2), '.json') as key
from {fx_stored}
union all
select distinct concat('raw/player_games/', username, '/readme.txt') as key from {fx_stored}
union all
select concat('raw/player_games/year=', substr(month_key, 1, 4), '/month=', substr(month_key, 6, 2), '/username=', username, '.json') as key
from {fx_responses} where status_code = 200
"""
block("l_keys", RELAYOUT_KEYS.format(fx_stored="fx_stored", fx_responses="fx_responses"), ("fx_stored", "fx_responses"))
_LEG = "'^raw/player_games/([^/]+)/(\\d{4})/(\\d{2})\\.json$'"
block("l_plan", f"""
select key,
  case when starts_with(key, 'raw/player_games/year=') then 'already_new'
    when regexp_extract(key, {_LEG}, 1) <> '' then 'move' else 'unrecognized' end as action,
  case when not starts_with(key, 'raw/player_games/year=') and regexp_extract(key, {_LEG}, 1) <> ''
    then concat('raw/player_games/year=', regexp_extract(key, {_LEG}, 2), '/month=', regexp_extract(key, {_LEG}, 3),
                '/username=', regexp_extract(key, {_LEG}, 1), '.json') end as new_key
from l_keys""", ("l_keys",))


def _keys(spark, sf):
    return spark.sql(RELAYOUT_KEYS, fx_stored=fixtures.view(spark, sf, "fx_stored"),
                     fx_responses=fixtures.view(spark, sf, "fx_responses"))


@register("relayout_plan", oracle("select key, action, new_key from l_plan", "l_plan"))
def q_relayout_plan(spark, sf):
    return layout.relayout_plan(_keys(spark, sf))


SHARDS = ("customer00000001", "customer0000014", "")


def _report_sql(prefix: str) -> str:
    return f"""
select '{prefix}' as prefix, cast(coalesce(sum(case when action = 'move' then 1 else 0 end), 0) as bigint) as planned,
  cast(0 as bigint) as moved, cast(0 as bigint) as failed,
  cast(coalesce(sum(case when action = 'already_new' then 1 else 0 end), 0) as bigint) as already_new,
  cast(coalesce(sum(case when action = 'unrecognized' then 1 else 0 end), 0) as bigint) as unrecognized,
  true as dry_run
from l_plan where starts_with(key, 'raw/player_games/{prefix}')"""


@register("relayout_report", oracle("\nunion all\n".join(_report_sql(p) for p in SHARDS), "l_plan"))
def q_relayout_report(spark, sf):
    keys = _keys(spark, sf)
    out = None
    for p in SHARDS:
        r = layout.relayout_report(layout.relayout_plan(layout.shard(keys, p)), p, dry_run=True)
        out = r if out is None else out.unionByName(r)
    return out


# A legacy tree of the feed documents: (key, value), every 17th month cut short, and a stray file per player.
CUT = "(cast(year as int) * 12 + cast(month as int)) % 17 = 0"
RUNS = (("1", "Player1"), ("2", ""), ("3", ""))


def legacy_feed(spark, sf):
    docs = fixtures.feed_documents(spark, sf)
    body = F.to_json(F.struct("username", "month_key", "game_count", "games"))
    key = F.concat(F.lit("raw/player_games/"), "feed", F.lit("/"), "year", F.lit("/"), "month", F.lit(".json"))
    cut = F.when(F.expr(CUT), F.expr("substring(v, 1, length(v) - 40)")).otherwise(F.col("v"))
    moved = docs.withColumn("v", body).select(key.alias("key"), cut.alias("value"))
    stray = docs.select(F.concat(F.lit("raw/player_games/"), "feed", F.lit("/readme.txt")).alias("key"), F.lit("{}").alias("value")).distinct()
    return moved.unionByName(stray)


def _run_sql(run: str, prefix: str, seen: str | None) -> str:
    mine = f"starts_with(key, 'raw/player_games/{prefix}')"
    again = f"starts_with(key, 'raw/player_games/{seen}')" if seen is not None else "false"
    return f"""
select '{run}' as run, '{prefix}' as prefix, count(*) filter (doc and {mine} and (cut or not {again})) as planned,
  count(*) filter (doc and {mine} and not cut and not {again}) as moved, count(*) filter (doc and {mine} and cut) as failed,
  count(*) filter (doc and {mine} and not cut and {again}) as already_new, count(*) filter (not doc and {mine}) as unrecognized,
  count(*) filter (doc and not cut and ({mine} or {again})) as documents,
  cast(coalesce(sum(games) filter (doc and not cut and ({mine} or {again})), 0) as bigint) as games
from l_legacy"""


block("l_legacy", f"""
select concat('raw/player_games/', feed_user, '/', year, '/', month, '.json') as key, {CUT} as cut, true as doc, count(*) as games
from fx_occ group by feed_user, year, month
union all select distinct concat('raw/player_games/', feed_user, '/readme.txt'), false, false, 0 from fx_occ""", ("fx_occ",))


@register("relayout_run", oracle("\nunion all\n".join(
    [_run_sql("1", "Player1", None), _run_sql("2", "", "Player1"), _run_sql("3", "", "")]), "l_legacy"))
def q_relayout_run(spark, sf):
    """One shard, then everything, then everything again; after each run the new tree is read back whole."""
    import uuid

    from gamelake.session import scratch_path
    home = scratch_path(spark, "relayout", uuid.uuid4().hex[:8])
    documents = legacy_feed(spark, sf)
    with raw.one_by_one(spark):
        documents.write.option("compression", "zstd").parquet(f"{home}/legacy")
    legacy = spark.read.parquet(f"{home}/legacy")
    out = None
    for run, prefix in RUNS:
        report = layout.relayout_run(legacy.select("key"), lambda keys: legacy.join(keys.select("key"), "key", "left_semi"),
                                     f"{home}/new", f"{home}/moves", prefix, run)
        held = raw.read_feed(spark, f"{home}/new", opened=False).agg(F.count(F.lit(1)).alias("documents"),
                                                       F.coalesce(F.sum(F.size("games")), F.lit(0)).alias("games"))
        row = report.join(F.broadcast(held), F.lit(True)).select(F.lit(run).alias("run"), "prefix", "planned", "moved", "failed",
                                                                 "already_new", "unrecognized", "documents", "games")
        row = layout._stored(row, f"{home}/rows")
        out = row if out is None else out.unionByName(row)
    return out


# --- A17 / A18 ------------------------------------------------------------------------
@register("adhoc_count", oracle("""
select count(*) as n from bronze_games where year = '1995' and month = '03'""", "bronze_games"))
def q_adhoc_count(spark, sf):
    games = lake.read_bronze_games(spark, _lake(spark, sf))
    return layout.run_sql(spark, "select count(*) as n from {games} where year = :y and month = :m",
                          {"games": games}, {"y": "1995", "m": "03"})


@register("head_n", oracle("""
select *, (select count(*) from h2h_monthly) as total_rows
from (select * from h2h_monthly order by pair_key, month_key limit 50) s""", "h2h_monthly"))
def q_head_n(spark, sf):
    from gamelake.plans.q_silver_gold import pair_monthly
    return layout.head_n(pair_monthly(spark, sf), 50, [F.col("pair_key"), F.col("month_key")])


@register("bronze_roster_roundtrip", oracle(
    "select snapshot_date, title, username, snapshot_player_count, snapshot_position from fx_roster", "fx_roster"))
def q_bronze_roster_roundtrip(spark, sf):
    return lake.read(spark, _lake(spark, sf), lake.BRONZE_ROSTER).select(
        "snapshot_date", "title", "username", "snapshot_player_count", "snapshot_position")
