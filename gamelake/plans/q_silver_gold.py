"""Contract queries for silver (C) and gold (D) on the fixture games."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.functions import exprs as X
from gamelake.operators import bronze, gold, silver
from gamelake.plans import sqlx
from gamelake.plans.contract import block, oracle, register
from gamelake.sources import fixtures

# ---------------------------------------------------------------------------
# Spark inputs derived from the fixture games
# ---------------------------------------------------------------------------


def _staged(fx: DataFrame) -> DataFrame:
    fx = (fx.withColumn("opening_name", X.opening_name("opening_url"))
            .withColumn("winner_color", X.winner_color("white_score", "black_score"))
            .withColumn("bucket", X.hash_bucket("game_uuid")))
    return silver.stage_games(fx)


def stg_games(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(fixtures.view(spark, sf, "fx_games"))


def stg_games_by_game(spark: SparkSession, sf: str) -> DataFrame:
    """``stg_games`` dealt by game before the staging, for the dedups."""
    return _staged(fixtures.games_by_game(spark, sf))


def silver_games(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_games(stg_games_by_game(spark, sf))


def _facts(games: DataFrame) -> DataFrame:
    return silver.stage_facts(bronze.player_rows(games))


def stg_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _facts(stg_games(spark, sf))


def stg_facts_by_game(spark: SparkSession, sf: str) -> DataFrame:
    return _facts(stg_games_by_game(spark, sf))


def silver_facts(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_facts(stg_facts_by_game(spark, sf))


def pair_games(spark: SparkSession, sf: str) -> DataFrame:
    return gold.h2h_games(silver_games(spark, sf))


def pair_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.h2h_monthly(pair_games(spark, sf))


# ---------------------------------------------------------------------------
# Oracle blocks (DuckDB)
# ---------------------------------------------------------------------------
GAME_TIE = ("game_date, time_class, rated, opening_url, opening_name, white_username, white_title, white_rating, "
            "white_score, black_username, black_title, black_rating, black_score, winner_color")
FACT_TIE = ("game_url, game_date, time_class, rated, opening_url, opening_name, winner_color, opponent_username, "
            "rating, opponent_rating, rating_diff, score, is_titled_player, is_titled_opponent")


def _nl(cols: str) -> str:
    return ", ".join(f"{c.strip()} asc nulls last" for c in cols.split(","))


block("stg_games", f"""
select year, month, month_key, {sqlx.bucket('game_uuid')} as bucket, game_uuid, game_url,
  cast(game_date as varchar) as game_date, time_class, rated, opening_url, {sqlx.opening_name('opening_url')} as opening_name,
  white_username, white_title, white_rating, white_score, black_username, black_title, black_rating, black_score,
  {sqlx.winner_color('white_score', 'black_score')} as winner_color, source_key_count, source_player_count
from fx_games
""", ("fx_games",))

def silver_games_sql(source: str) -> str:
    """The kept row of each game of ``source``, cleaned."""
    return f"""
select * replace (cast(game_date as date) as game_date, lower(time_class) as time_class, rated is not distinct from true as rated),
  (white_title || black_title) is not null as is_titled_matchup
from (select distinct on (year, month, game_uuid) * from {source} where game_uuid is not null
      order by year, month, game_uuid, source_key_count desc nulls last, source_player_count desc nulls last, {_nl("game_url, " + GAME_TIE)}) kept
"""


block("silver_games", silver_games_sql("stg_games"), ("stg_games",))

_FACT_SIDE = """
select year, month, month_key, game_uuid, game_url, game_date, time_class, rated, opening_url, opening_name, winner_color,
  {me}_username as username, {me}_title as title, {op}_username as opponent_username, {op}_title as opponent_title,
  '{me}' as color, {me}_rating as rating, {op}_rating as opponent_rating, {me}_rating - {op}_rating as rating_diff,
  {me}_score as score, {me}_title is not null as is_titled_player, {op}_title is not null as is_titled_opponent
from stg_games where coalesce(length({me}_username) > 0, false)
"""
block("stg_facts", _FACT_SIDE.format(me="white", op="black") + "union all" + _FACT_SIDE.format(me="black", op="white"),
      ("stg_games",))

def first_facts_sql(source: str) -> str:
    """The kept row of each player of a game: titled first, then against a titled opponent, then by colour."""
    return f"""
select distinct on (year, month, game_uuid, username) * from {source} where game_uuid is not null and username is not null
order by year, month, game_uuid, username, title is null, opponent_title is null, {_nl("color, " + FACT_TIE)}
"""


def silver_facts_sql(source: str) -> str:
    return f"""
select * replace (cast(game_date as date) as game_date, lower(time_class) as time_class, rated is not distinct from true as rated),
  case score when 1 then 'win' when 0.5 then 'draw' when 0 then 'loss' else 'unknown' end as score_band
from ({first_facts_sql(source)}) kept
where title is not null and is_titled_player
"""


block("silver_facts", silver_facts_sql("stg_facts"), ("stg_facts",))

MONTH = "month_key, year, month"


def _side(color: str) -> str:
    fields = ", ".join(f"{f} := {color}_{f}" for f in gold.PAIR_SIDE_FIELDS)
    return f"struct_pack({fields}, color := '{color}')"


def h2h_games_sql(source: str) -> str:
    """Each game once as an ordered pair (p1, p2) of its sides."""
    names = ", ".join(f"p{i}.{f} as player_{x}_{f}" for f in ("title", "color", "rating", "score") for i, x in ((1, "a"), (2, "b")))
    return f"""
select * exclude (w, b, p1, p2), p1.username as player_a, p2.username as player_b, {names},
  player_a || '::' || player_b as pair_key, {sqlx.pair_bucket("player_a || '::' || player_b")} as pair_bucket,
  case when p1.score = p2.score then 'draw' else if(p1.score > p2.score, p1, p2).username end as winner_username,
  winner_username as result_label
from (
  select *, if(lower(w.username) <= lower(b.username), w, b) as p1, if(lower(w.username) <= lower(b.username), b, w) as p2
  from (select *, {_side("white")} as w, {_side("black")} as b from {source}) sided
  where lower(w.username) <> lower(b.username)
) paired
"""


PAIR = "pair_bucket, pair_key, player_a, player_b"
#: What each pair count counts, over a pair's games.
PAIR_RULES = {"games_played": "true", "player_a_wins": "player_a_score = 1", "player_b_wins": "player_b_score = 1",
              "draws": "player_a_score = 0.5 and player_b_score = 0.5"}
PAIR_RULES |= {f"player_{x}_{color}_games": f"player_{x}_color = '{color}'" for x in "ab" for color in ("white", "black")}
PAIR_RULES |= {"rated_games": "rated"}


def _counts(rules: dict[str, str]) -> str:
    return ", ".join(f"count(*) filter ({rule}) as {name}" for name, rule in rules.items())


def _sums(names) -> str:
    return ", ".join(f"cast(sum({n}) as bigint) as {n}" for n in names)


def h2h_monthly_sql(source: str) -> str:
    return f"""
select {MONTH}, {PAIR}, {_counts(PAIR_RULES)}, min(game_date) as first_game_date, max(game_date) as last_game_date
from {source} group by all
"""


def h2h_summary_sql(source: str) -> str:
    rates = {"player_a_win_rate": "player_a_wins", "player_b_win_rate": "player_b_wins", "draw_rate": "draws"}
    return f"""
select *, {", ".join(sqlx.round_like(f"{n} / nullif(games_played, 0)", 4) + f" as {r}" for r, n in rates.items())}
from (select {PAIR}, {_sums(PAIR_RULES)}, min(first_game_date) as first_game_date, max(last_game_date) as last_game_date
      from {source} group by all) t
"""


ACTIVITY_RULES = {"games_played": "true", "wins": "score = 1", "draws": "score = 0.5", "losses": "score = 0", "rated_games": "rated",
                  "unrated_games": "not rated", "games_vs_titled": "is_titled_opponent", "games_vs_non_titled": "not is_titled_opponent"}


def player_month_activity_sql(source: str) -> str:
    return f"""
select {MONTH}, title, username, {_counts(ACTIVITY_RULES)}, count(distinct opponent_username) as unique_opponents,
  avg(rating) as avg_rating, avg(score) as score_rate
from {source} group by all
"""


def title_month_activity_sql(source: str) -> str:
    totals = {"total_games": "games_played", "total_wins": "wins", "total_draws": "draws", "total_losses": "losses"}
    totals |= {n: n for n in ("rated_games", "unrated_games", "games_vs_titled", "games_vs_non_titled")}
    means = {"avg_unique_opponents": ("unique_opponents", 2), "avg_player_score_rate": ("score_rate", 4), "avg_player_rating": ("avg_rating", 2)}
    return f"""
select {MONTH}, title, count(*) as active_players, {", ".join(f"cast(sum({n}) as bigint) as {t}" for t, n in totals.items())},
  {sqlx.round_like("sum(games_played)::double / nullif(count(*), 0)", 2)} as avg_games_per_active_player,
  {", ".join(sqlx.round_stable(f"avg({n}::double)", d) + f" as {m}" for m, (n, d) in means.items())}
from {source} group by all
"""


for _name, _rule, _source in (("h2h_games", h2h_games_sql, "silver_games"), ("h2h_monthly", h2h_monthly_sql, "h2h_games"),
                              ("h2h_summary", h2h_summary_sql, "h2h_monthly"),
                              ("player_month_activity", player_month_activity_sql, "silver_facts"),
                              ("title_month_activity", title_month_activity_sql, "player_month_activity")):
    block(_name, _rule(_source), (_source,))

block("player_month_ratings", f"""
select *, max_rating - min_rating as rating_range
from (select {MONTH}, title, username, count(rating) as games_played, stddev_pop(rating) as rating_stddev,
        {", ".join(f"{f}(rating) as {f}_rating" for f in ("avg", "min", "max"))}
      from silver_facts group by all having count(rating) > 0) r
""", ("silver_facts",))

_SPREAD = {f"{f}_rating_range": f"{f}(rating_range)" for f in ("median", "min", "max")}
_MEANS = {"avg_games_per_player": "games_played", "avg_rating_range": "rating_range", "avg_rating_stddev": "rating_stddev",
          "avg_player_rating": "avg_rating"}
block("title_month_volatility", f"""
select {MONTH}, title, count(*) as player_months,
  {", ".join(sqlx.round_like(x, 2) + f" as {n}" for n, x in _SPREAD.items())},
  {", ".join(sqlx.round_stable(f"avg({x}::double)", 2) + f" as {n}" for n, x in _MEANS.items())}
from player_month_ratings where rating_range is not null and games_played > 1 group by all
""", ("player_month_ratings",))

_HALVES = ("white", "black")
block("title_month_color", f"""
select {MONTH}, title, total_games,
  {", ".join(f"{c}_games, " + sqlx.round_like(f"{c}_points", 2) + f" as {c}_score_points, " + sqlx.round_like(f"{c}_rate", 4)
             + f" as {c}_score_rate" for c in _HALVES)},
  {sqlx.round_like("white_rate - black_rate", 4)} as white_minus_black
from (
  select *, {", ".join(f"{c}_points / nullif({c}_games, 0) as {c}_rate" for c in _HALVES)}
  from (select {MONTH}, title, count(*) as total_games,
          {", ".join(f"count(*) filter (color = '{c}') as {c}_games, sum(if(color = '{c}', score, 0)) as {c}_points" for c in _HALVES)}
        from silver_facts group by all) halves
) rated
""", ("silver_facts",))


# ---------------------------------------------------------------------------
# Contract queries
# ---------------------------------------------------------------------------
SILVER_GAME_COLS = ("month_key, year, month, game_uuid, game_url, game_date, time_class, rated, opening_url, opening_name, "
                    "white_username, white_title, white_rating, white_score, black_username, black_title, black_rating, "
                    "black_score, winner_color, source_key_count, source_player_count, is_titled_matchup")
SILVER_FACT_COLS = ("month_key, year, month, game_uuid, game_url, game_date, time_class, rated, opening_url, opening_name, "
                    "winner_color, username, title, opponent_username, opponent_title, color, rating, opponent_rating, "
                    "rating_diff, score, is_titled_player, is_titled_opponent, score_band")


def _cols(s: str) -> list[str]:
    return [c.strip() for c in s.split(",")]


@register("stg_games", oracle(
    "select year, month, month_key, bucket, game_uuid, game_url, game_date, time_class, rated, opening_url, "
    "opening_name, winner_color, source_key_count from stg_games", "stg_games"))
def q_stg_games(spark, sf):
    return stg_games(spark, sf).select(*_cols("year, month, month_key, bucket, game_uuid, game_url, game_date, time_class, "
                                              "rated, opening_url, opening_name, winner_color, source_key_count"))


@register("silver_dedup_games", oracle("select year, month, game_uuid, game_url, source_key_count, source_player_count, "
                                       "white_rating, black_rating from silver_games", "silver_games"))
def q_silver_dedup_games(spark, sf):
    return silver.dedup_games(stg_games_by_game(spark, sf)).select(
        "year", "month", "game_uuid", "game_url", "source_key_count", "source_player_count", "white_rating", "black_rating")


@register("silver_games_core", oracle(f"select {SILVER_GAME_COLS} from silver_games", "silver_games"))
def q_silver_games_core(spark, sf):
    return silver_games(spark, sf).select(*_cols(SILVER_GAME_COLS))


@register("stg_facts", oracle("select year, month, month_key, game_uuid, username, title, opponent_username, color, "
                              "rating, opponent_rating, rating_diff, score, is_titled_player, is_titled_opponent "
                              "from stg_facts", "stg_facts"))
def q_stg_facts(spark, sf):
    return stg_facts(spark, sf).select(*_cols(
        "year, month, month_key, game_uuid, username, title, opponent_username, color, rating, opponent_rating, "
        "rating_diff, score, is_titled_player, is_titled_opponent"))


@register("silver_dedup_facts", oracle(
    f"select year, month, game_uuid, username, color, rating, opponent_username from ({first_facts_sql('stg_facts')}) f", "stg_facts"))
def q_silver_dedup_facts(spark, sf):
    return silver.dedup_facts(stg_facts_by_game(spark, sf)).select(
        "year", "month", "game_uuid", "username", "color", "rating", "opponent_username")


@register("silver_player_facts", oracle(f"select {SILVER_FACT_COLS} from silver_facts", "silver_facts"))
def q_silver_player_facts(spark, sf):
    return silver_facts(spark, sf).select(*_cols(SILVER_FACT_COLS))


@register("score_band", oracle("select score_band, count(*) as n from silver_facts group by 1", "silver_facts"))
def q_score_band(spark, sf):
    return silver_facts(spark, sf).groupBy("score_band").agg(F.count(F.lit(1)).alias("n"))


H2H_GAME_COLS = ("month_key, year, month, pair_bucket, pair_key, player_a, player_b, player_a_title, player_b_title, "
                 "player_a_color, player_b_color, player_a_rating, player_b_rating, player_a_score, player_b_score, "
                 "winner_username, result_label, game_uuid, game_url, game_date, time_class, rated, opening_url, "
                 "opening_name, white_username, black_username, winner_color")


@register("h2h_games", oracle(f"select {H2H_GAME_COLS} from h2h_games", "h2h_games"))
def q_h2h_games(spark, sf):
    return pair_games(spark, sf).select(*_cols(H2H_GAME_COLS))


@register("h2h_monthly", oracle("select * from h2h_monthly", "h2h_monthly"))
def q_h2h_monthly(spark, sf):
    return pair_monthly(spark, sf)


@register("h2h_summary", oracle("select * from h2h_summary", "h2h_summary"))
def q_h2h_summary(spark, sf):
    return gold.h2h_summary(pair_monthly(spark, sf))


@register("player_month_activity", oracle("select * from player_month_activity", "player_month_activity"))
def q_player_month_activity(spark, sf):
    return gold.player_month_activity(silver_facts(spark, sf))


@register("title_month_activity", oracle("select * from title_month_activity", "title_month_activity"))
def q_title_month_activity(spark, sf):
    return gold.title_month_activity(silver_facts(spark, sf))


@register("player_month_ratings", oracle(f"""
select month_key, year, month, title, username, games_played, avg_rating, min_rating, max_rating, rating_range,
  {sqlx.round_like('rating_stddev', 6)} as rating_stddev
from player_month_ratings""", "player_month_ratings"))
def q_player_month_ratings(spark, sf):
    return gold.player_month_ratings(silver_facts(spark, sf)).withColumn(
        "rating_stddev", X.round_like("rating_stddev", 6))


@register("title_month_volatility", oracle("select * from title_month_volatility", "title_month_volatility"))
def q_title_month_volatility(spark, sf):
    return gold.title_month_volatility(silver_facts(spark, sf))


@register("title_month_color", oracle("select * from title_month_color", "title_month_color"))
def q_title_month_color(spark, sf):
    return gold.title_month_color(silver_facts(spark, sf))
