"""Contract queries for the raw -> bronze layer (A1, B1..B21).

Spark side: fixture feed documents are written as JSON files once per input
directory (under the checkpoint root) and read back with the declared
schema, so parsing, partition discovery and ``raw_key`` from file paths are
exercised. Oracle side: the same occurrences as flat rows (``fx_feed``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.operators import bronze
from gamelake.plans import sqlx
from gamelake.plans.contract import block, oracle, register
from gamelake.sources import fixtures, raw


# ---------------------------------------------------------------------------
# Spark inputs
# ---------------------------------------------------------------------------
def feed(spark: SparkSession, sf: str) -> DataFrame:
    return raw.read_feed(spark, fixtures.landing_zone(spark, sf), opened=False)


def occurrences(spark: SparkSession, sf: str) -> DataFrame:
    occ = bronze.explode_feed(feed(spark, sf))
    return occ.withColumn("feed_user", F.regexp_extract("raw_key", r"/feed=([^/]+)/", 1))


def bronze_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return bronze.build_bronze(feed(spark, sf), fixtures.titles(spark, sf))


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("source_player_usernames", F.array_join("source_player_usernames", ","))


# ---------------------------------------------------------------------------
# Oracle blocks
# ---------------------------------------------------------------------------
_TRUTHY_JSON = ("coalesce(regexp_replace({x}, '\\s', '', 'g') not in ('', '{{}}', '[]', 'null', 'false', '0', '0.0', '\"\"'), false)")

block("fx_occ", """
select raw_key, year, month, pos - 1 as pos, regexp_extract(raw_key, 'username=([^/]+)\\.json$', 1) as feed_user,
  case when count(source_username) over (partition by raw_key) = count(*) over (partition by raw_key)
    then max(source_username) over (partition by raw_key) end as source_username,
  uuid, url, end_time, time_class, rated, eco, pgn, accuracies, white_username, white_rating, white_result,
  black_username, black_rating, black_result,
  coalesce(nullif(uuid, ''), nullif(url, '')) as game_key
from fx_feed
""", ("fx_feed",))

block("fx_first", """
select * exclude (rn) from (
  select *, row_number() over (partition by year, month, game_key order by raw_key, pos) as rn
  from fx_occ where game_key is not null
) r where rn = 1
""", ("fx_occ",))

block("fx_merge_agg", f"""
select year, month, game_key,
  first(eco order by raw_key, pos) filter (where length(eco) > 0) as fill_eco,
  first(accuracies order by raw_key, pos) filter (where {_TRUTHY_JSON.format(x='accuracies')}) as fill_accuracies,
  bool_or(coalesce(length(pgn) > 0, false)) as has_pgn,
  cast(count(distinct raw_key) as integer) as source_key_count,
  cast(count(distinct source_username) filter (where source_username <> '') as integer) as source_player_count,
  coalesce(array_to_string(list_sort(list(distinct source_username) filter (where source_username <> '')), ','), '') as source_player_usernames
from fx_occ where game_key is not null
group by 1, 2, 3
""", ("fx_occ",))

block("fx_merged", """
select f.year, f.month, f.game_key, f.uuid, f.url, f.end_time, f.time_class, f.rated,
  coalesce(a.fill_eco, f.eco) as eco, coalesce(a.fill_accuracies, f.accuracies) as accuracies,
  a.has_pgn, false as has_tcn, f.white_username, f.white_rating, f.white_result,
  f.black_username, f.black_rating, f.black_result,
  a.source_key_count, a.source_player_count, a.source_player_usernames
from fx_first f join fx_merge_agg a on a.year = f.year and a.month = f.month and a.game_key = f.game_key
""", ("fx_first", "fx_merge_agg"))

block("fx_title_members", fixtures.oracle_titles(), ("fx_games",))

block("fx_title_lookup", f"""
select username, arg_min(title, {sqlx.title_priority('title')}) as title
from fx_title_members
where {sqlx.title_priority('title')} > 0 and username is not null
group by username
""", ("fx_title_members",))

_OBJ = "(case when json_valid(accuracies) then json_type(accuracies) = 'OBJECT' else false end)"


def _acc(side: str) -> str:
    return (f"case when {_OBJ} then try_cast(trim(json_extract_string(accuracies, '$.{side}')) as double) end")


block("bronze_games", f"""
select year, month, {sqlx.bucket('game_uuid')} as bucket, game_uuid, game_url, substr(end_time_utc, 1, 10) as game_date,
  end_time_utc, time_class, rated, opening_url, opening_name, has_pgn, has_tcn, has_accuracies,
  white_username, white_title, white_rating, white_result, white_score, white_accuracy,
  black_username, black_title, black_rating, black_result, black_score, black_accuracy,
  {sqlx.winner_color('white_score', 'black_score')} as winner_color,
  source_key_count, source_player_count, source_player_usernames
from (
  select m.year, m.month, m.game_key as game_uuid, m.url as game_url, {sqlx.epoch_to_iso('m.end_time')} as end_time_utc,
    m.time_class, m.rated, m.eco as opening_url, {sqlx.opening_name('m.eco')} as opening_name, m.has_pgn, m.has_tcn,
    coalesce(case when {_OBJ} then len(json_keys(accuracies)) > 0 end, false) as has_accuracies,
    m.white_username, wt.title as white_title, {sqlx.coerce_number('m.white_rating')} as white_rating,
    m.white_result, {sqlx.result_score('m.white_result')} as white_score, {_acc('white')} as white_accuracy,
    m.black_username, bt.title as black_title, {sqlx.coerce_number('m.black_rating')} as black_rating,
    m.black_result, {sqlx.result_score('m.black_result')} as black_score, {_acc('black')} as black_accuracy,
    m.source_key_count, m.source_player_count, m.source_player_usernames
  from fx_merged m
  left join fx_title_lookup wt on wt.username = m.white_username
  left join fx_title_lookup bt on bt.username = m.black_username
) g
""", ("fx_merged", "fx_title_lookup"))

_BF = """
select year, month, game_uuid, game_url, game_date, end_time_utc, time_class, rated, opening_url, opening_name,
  winner_color, has_pgn, has_tcn, has_accuracies,
  {me}_username as username, {me}_title as title, {op}_username as opponent_username, {op}_title as opponent_title,
  '{me}' as color, {me}_rating as rating, {op}_rating as opponent_rating, {me}_rating - {op}_rating as rating_diff,
  {me}_result as result, {me}_score as score, {me}_accuracy as accuracy, {op}_accuracy as opponent_accuracy,
  {me}_title is not null as is_titled_player, {op}_title is not null as is_titled_opponent
from bronze_games where coalesce(length({me}_username) > 0, false)
"""
block("bronze_facts_raw", _BF.format(me="white", op="black") + "union all" + _BF.format(me="black", op="white"),
      ("bronze_games",))
block("bronze_facts", f"select *, {sqlx.bucket("game_uuid || '::' || username")} as bucket from bronze_facts_raw",
      ("bronze_facts_raw",))


# ---------------------------------------------------------------------------
# Contract queries
# ---------------------------------------------------------------------------
@register("raw_feed_scan", oracle("""
select year, month, regexp_extract(raw_key, 'username=([^/]+)\\.json$', 1) as feed_user,
  case when count(source_username) = count(*) then max(source_username) end as username,
  concat(year, '-', month) as month_key, cast(count(*) as integer) as game_count
from fx_feed group by raw_key, year, month
""", "fx_feed"))
def q_raw_feed_scan(spark, sf):
    return feed(spark, sf).select("year", "month", F.col("feed").alias("feed_user"), "username", "month_key", "game_count")


OCC_COLS = ("year, month, feed_user, source_username, pos, uuid, url, end_time, time_class, rated, eco, pgn, accuracies, "
            "white_username, white_rating, white_result, black_username, black_rating, black_result")


@register("feed_explode", oracle(f"select {OCC_COLS} from fx_occ", "fx_occ"))
def q_feed_explode(spark, sf):
    o = occurrences(spark, sf)
    o = (o.withColumn("white_username", F.col("white.username")).withColumn("white_rating", F.col("white.rating"))
         .withColumn("white_result", F.col("white.result")).withColumn("black_username", F.col("black.username"))
         .withColumn("black_rating", F.col("black.rating")).withColumn("black_result", F.col("black.result")))
    return o.select(*[c.strip() for c in OCC_COLS.split(",")])


@register("game_key", oracle("select year, month, feed_user, pos, game_key from fx_occ", "fx_occ"))
def q_game_key(spark, sf):
    return occurrences(spark, sf).select("year", "month", "feed_user", "pos", bronze.game_key().alias("game_key"))


MERGE_COLS = ("year, month, game_key, uuid, url, end_time, time_class, rated, eco, accuracies, has_pgn, has_tcn, "
              "white_username, white_rating, white_result, black_username, black_rating, black_result")


@register("game_merge", oracle(f"select {MERGE_COLS} from fx_merged", "fx_merged"))
def q_game_merge(spark, sf):
    m = bronze.merge_games(bronze.explode_feed(feed(spark, sf)))
    m = (m.withColumn("white_username", F.col("white.username")).withColumn("white_rating", F.col("white.rating"))
         .withColumn("white_result", F.col("white.result")).withColumn("black_username", F.col("black.username"))
         .withColumn("black_rating", F.col("black.rating")).withColumn("black_result", F.col("black.result")))
    return m.select(*[c.strip() for c in MERGE_COLS.split(",")])


@register("game_provenance", oracle(
    "select year, month, game_key, source_key_count, source_player_count, source_player_usernames from fx_merged",
    "fx_merged"))
def q_game_provenance(spark, sf):
    m = bronze.merge_games(bronze.explode_feed(feed(spark, sf)))
    return _joined(m.select("year", "month", "game_key", "source_key_count", "source_player_count",
                            "source_player_usernames"))


@register("title_lookup", oracle("select username, title from fx_title_lookup", "fx_title_lookup"))
def q_title_lookup(spark, sf):
    return bronze.title_lookup(fixtures.titles(spark, sf))


def _games(spark, sf, *cols):
    g, _ = bronze_tables(spark, sf)
    return _joined(g).select(*cols)


@register("title_enrich", oracle(
    "select year, month, game_uuid, white_username, white_title, black_username, black_title from bronze_games",
    "bronze_games"))
def q_title_enrich(spark, sf):
    return _games(spark, sf, "year", "month", "game_uuid", "white_username", "white_title", "black_username", "black_title")


@register("result_score", oracle(
    "select year, month, game_uuid, white_result, white_score, black_result, black_score from bronze_games", "bronze_games"))
def q_result_score(spark, sf):
    return _games(spark, sf, "year", "month", "game_uuid", "white_result", "white_score", "black_result", "black_score")


@register("winner_color", oracle(
    "select winner_color, count(*) as n from bronze_games group by 1", "bronze_games"))
def q_winner_color(spark, sf):
    g, _ = bronze_tables(spark, sf)
    return g.groupBy("winner_color").agg(F.count(F.lit(1)).alias("n"))


@register("epoch_to_iso", oracle(
    "select year, month, game_uuid, end_time_utc, game_date from bronze_games", "bronze_games"))
def q_epoch_to_iso(spark, sf):
    return _games(spark, sf, "year", "month", "game_uuid", "end_time_utc", "game_date")


@register("coerce_number", oracle(
    "select year, month, game_uuid, white_rating, black_rating from bronze_games", "bronze_games"))
def q_coerce_number(spark, sf):
    return _games(spark, sf, "year", "month", "game_uuid", "white_rating", "black_rating")


@register("opening_name", oracle(
    "select opening_url, opening_name, count(*) as n from bronze_games group by 1, 2", "bronze_games"))
def q_opening_name(spark, sf):
    g, _ = bronze_tables(spark, sf)
    return g.groupBy("opening_url", "opening_name").agg(F.count(F.lit(1)).alias("n"))


@register("presence_flags", oracle(
    "select year, month, game_uuid, has_pgn, has_tcn, has_accuracies from bronze_games", "bronze_games"))
def q_presence_flags(spark, sf):
    return _games(spark, sf, "year", "month", "game_uuid", "has_pgn", "has_tcn", "has_accuracies")


@register("accuracy_extract", oracle(
    "select year, month, game_uuid, white_accuracy, black_accuracy from bronze_games", "bronze_games"))
def q_accuracy_extract(spark, sf):
    return _games(spark, sf, "year", "month", "game_uuid", "white_accuracy", "black_accuracy")


GAMES_CORE_COLS = ("year, month, bucket, game_uuid, game_url, game_date, end_time_utc, time_class, rated, opening_url, "
                   "opening_name, has_pgn, has_tcn, has_accuracies, white_username, white_title, white_rating, "
                   "white_result, white_score, white_accuracy, black_username, black_title, black_rating, black_result, "
                   "black_score, black_accuracy, winner_color, source_key_count, source_player_count, "
                   "source_player_usernames")


@register("bronze_games_core", oracle(f"select {GAMES_CORE_COLS} from bronze_games", "bronze_games"))
def q_bronze_games_core(spark, sf):
    return _games(spark, sf, *[c.strip() for c in GAMES_CORE_COLS.split(",")])


FACT_COLS = ("year, month, bucket, game_uuid, game_url, game_date, end_time_utc, time_class, rated, opening_url, "
             "opening_name, winner_color, has_pgn, has_tcn, has_accuracies, username, title, opponent_username, "
             "opponent_title, color, rating, opponent_rating, rating_diff, result, score, accuracy, opponent_accuracy, "
             "is_titled_player, is_titled_opponent")


@register("bronze_player_facts", oracle(f"select {FACT_COLS} from bronze_facts", "bronze_facts"))
def q_bronze_player_facts(spark, sf):
    _, f = bronze_tables(spark, sf)
    return f.select(*[c.strip() for c in FACT_COLS.split(",")])


@register("hash_bucket", oracle(
    "select year, month, bucket, count(*) as games from bronze_games group by 1, 2, 3", "bronze_games"))
def q_hash_bucket(spark, sf):
    g, _ = bronze_tables(spark, sf)
    return g.groupBy("year", "month", "bucket").agg(F.count(F.lit(1)).alias("games"))


@register("facts_bucketed", oracle(
    "select year, month, bucket, count(*) as player_rows from bronze_facts group by 1, 2, 3", "bronze_facts"))
def q_facts_bucketed(spark, sf):
    _, f = bronze_tables(spark, sf)
    return f.groupBy("year", "month", "bucket").agg(F.count(F.lit(1)).alias("player_rows"))


@register("bronze_month_counts", oracle("""
select g.year, g.month, g.unique_games, coalesce(f.player_rows, 0) as player_rows
from (select year, month, count(*) as unique_games from bronze_games group by 1, 2) g
left join (select year, month, count(*) as player_rows from bronze_facts group by 1, 2) f
  on f.year = g.year and f.month = g.month
""", "bronze_games", "bronze_facts"))
def q_bronze_month_counts(spark, sf):
    from gamelake.plans import pipeline
    g, f = bronze_tables(spark, sf)
    return pipeline.month_counts(g, f)


# --- B20 roster flatten: documents per (date, title), flattened back ------------
def roster_documents(spark: SparkSession, sf: str) -> DataFrame:
    """fx_roster rows packed into one snapshot document per (date, title);
    a document is one title's roster, bounded by the titled population."""
    r = fixtures.view(spark, sf, "fx_roster")
    return r.groupBy("snapshot_date", "title").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("snapshot_position", "username"))),
                    lambda x: x["username"]).alias("players")
    ).withColumn("player_count", F.size("players").cast("int"))


@register("bronze_roster", oracle("""
select snapshot_date, title, username, snapshot_player_count, snapshot_position from fx_roster
""", "fx_roster"))
def q_bronze_roster(spark, sf):
    return bronze.roster_rows(roster_documents(spark, sf))


@register("roster_scan", oracle("""
select title, snapshot_date, cast(count(*) as integer) as player_count from fx_roster group by 1, 2
""", "fx_roster"))
def q_roster_scan(spark, sf):
    from gamelake.session import scratch_path
    root = scratch_path(spark, "fixture", fixtures.input_token(spark, sf), "raw", "titled_players")

    def write(tmp):
        (roster_documents(spark, sf).withColumn("t", F.col("title")).withColumn("d", F.col("snapshot_date"))
         .select("title", "snapshot_date", "player_count", "players", "t", "d")
         .write.mode("overwrite").partitionBy("t", "d").json(tmp))
    raw.publish(spark, root, write)
    return raw.read_rosters(spark, root).select("title", "snapshot_date", "player_count")

