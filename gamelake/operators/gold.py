"""Silver -> gold marts.

Two-level marts (player-month -> title-month, monthly pairs -> all-time pairs)
keep both levels as separate ``groupBy``s; Spark adds the partial (map-side)
aggregation to each, so hot players, titles or pairs never gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.functions import exprs as X

MONTH_COLS = ("month_key", "year", "month")


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def _ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den, F.lit(0))


def _month(df: DataFrame, month: str | None, months: Sequence[str] | None) -> DataFrame:
    return df.filter(X.month_filter(month, months))


# --- D1 / D2 ----------------------------------------------------------------
def player_month_activity(facts: DataFrame, month: str | None = None, months: Sequence[str] | None = None) -> DataFrame:
    f = _month(facts, month, months)
    return f.groupBy(*MONTH_COLS, "title", "username").agg(
        F.count(F.lit(1)).alias("games_played"),
        _count_if(F.col("score") == 1.0).alias("wins"),
        _count_if(F.col("score") == 0.5).alias("draws"),
        _count_if(F.col("score") == 0.0).alias("losses"),
        _count_if(F.col("rated")).alias("rated_games"),
        _count_if(~F.col("rated")).alias("unrated_games"),
        _count_if(F.col("is_titled_opponent")).alias("games_vs_titled"),
        _count_if(~F.col("is_titled_opponent")).alias("games_vs_non_titled"),
        F.count_distinct("opponent_username").alias("unique_opponents"),
        F.avg("rating").alias("avg_rating"),
        F.avg("score").alias("score_rate"),
    )


def title_month_activity(facts: DataFrame, month: str | None = None, months: Sequence[str] | None = None) -> DataFrame:
    pm = player_month_activity(facts, month, months)
    return pm.groupBy(*MONTH_COLS, "title").agg(
        F.count(F.lit(1)).alias("active_players"),
        F.sum("games_played").alias("total_games"),
        F.sum("wins").alias("total_wins"),
        F.sum("draws").alias("total_draws"),
        F.sum("losses").alias("total_losses"),
        F.sum("rated_games").alias("rated_games"),
        F.sum("unrated_games").alias("unrated_games"),
        F.sum("games_vs_titled").alias("games_vs_titled"),
        F.sum("games_vs_non_titled").alias("games_vs_non_titled"),
        X.round_like(_ratio(F.sum("games_played"), F.count(F.lit(1))), 2).alias("avg_games_per_active_player"),
        X.round_stable(F.avg(F.col("unique_opponents").cast("double")), 2).alias("avg_unique_opponents"),
        X.round_stable(F.avg("score_rate"), 4).alias("avg_player_score_rate"),
        X.round_stable(F.avg("avg_rating"), 2).alias("avg_player_rating"),
    )


# --- D3 / D4 ----------------------------------------------------------------
def player_month_ratings(facts: DataFrame, month: str | None = None, months: Sequence[str] | None = None) -> DataFrame:
    f = _month(facts, month, months).filter(F.col("rating").isNotNull())
    return f.groupBy(*MONTH_COLS, "title", "username").agg(
        F.count(F.lit(1)).alias("games_played"),
        F.avg("rating").alias("avg_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        (F.max("rating") - F.min("rating")).alias("rating_range"),
        F.stddev_pop("rating").alias("rating_stddev"),
    )


def title_month_volatility(facts: DataFrame, month: str | None = None, months: Sequence[str] | None = None) -> DataFrame:
    pm = player_month_ratings(facts, month, months)
    pm = pm.filter((F.col("games_played") >= 2) & F.col("rating_range").isNotNull())
    return pm.groupBy(*MONTH_COLS, "title").agg(
        F.count(F.lit(1)).alias("player_months"),
        X.round_stable(F.avg(F.col("games_played").cast("double")), 2).alias("avg_games_per_player"),
        X.round_stable(F.avg("rating_range"), 2).alias("avg_rating_range"),
        X.round_like(F.median("rating_range"), 2).alias("median_rating_range"),
        X.round_like(F.min("rating_range"), 2).alias("min_rating_range"),
        X.round_like(F.max("rating_range"), 2).alias("max_rating_range"),
        X.round_stable(F.avg("rating_stddev"), 2).alias("avg_rating_stddev"),
        X.round_stable(F.avg("avg_rating"), 2).alias("avg_player_rating"),
    )


# --- D5 ---------------------------------------------------------------------
def title_month_color(facts: DataFrame, month: str | None = None, months: Sequence[str] | None = None) -> DataFrame:
    f = _month(facts, month, months)
    white, black = F.col("color") == "white", F.col("color") == "black"
    w_games = F.sum(F.when(white, 1).otherwise(0))
    b_games = F.sum(F.when(black, 1).otherwise(0))
    w_pts = F.sum(F.when(white, F.col("score")).otherwise(F.lit(0.0)))
    b_pts = F.sum(F.when(black, F.col("score")).otherwise(F.lit(0.0)))
    w_rate, b_rate = _ratio(w_pts, w_games), _ratio(b_pts, b_games)
    return f.groupBy(*MONTH_COLS, "title").agg(
        w_games.cast("bigint").alias("white_games"),
        X.round_like(w_pts, 2).alias("white_score_points"),
        X.round_like(w_rate, 4).alias("white_score_rate"),
        b_games.cast("bigint").alias("black_games"),
        X.round_like(b_pts, 2).alias("black_score_points"),
        X.round_like(b_rate, 4).alias("black_score_rate"),
        X.round_like(w_rate - b_rate, 4).alias("white_minus_black"),
        F.count(F.lit(1)).alias("total_games"),
    )


# --- D6 .. D9 ---------------------------------------------------------------
PAIR_SIDE_FIELDS = ("username", "title", "rating", "score")


def h2h_games(games: DataFrame, month: str | None = None, months: Sequence[str] | None = None,
              null_score_winner: str = "player_b") -> DataFrame:
    """Games between two distinct players, oriented so the smaller lower-cased
    name is player A (ties: white).

    ``null_score_winner='player_b'`` keeps the defined outcome when a score is
    missing (B is named winner); ``'null'`` yields null instead.
    """
    g = _month(games, month, months).filter(
        F.col("white_username").isNotNull() & F.col("black_username").isNotNull()
        & (F.lower("white_username") != F.lower("black_username")))

    def side(a: str, b: str) -> Column:
        fields = [F.col(f"{a}_{f}").alias(f"a_{f}") for f in PAIR_SIDE_FIELDS]
        fields += [F.col(f"{b}_{f}").alias(f"b_{f}") for f in PAIR_SIDE_FIELDS]
        return F.struct(*fields, F.lit(a).alias("a_color"), F.lit(b).alias("b_color"))

    white_is_a = F.lower("white_username") <= F.lower("black_username")
    p = g.withColumn("_p", F.when(white_is_a, side("white", "black")).otherwise(side("black", "white")))
    a_score, b_score = F.col("_p.a_score"), F.col("_p.b_score")
    pa, pb = F.col("_p.a_username"), F.col("_p.b_username")
    winner = F.when(a_score == b_score, F.lit("draw")).when(a_score > b_score, pa)
    if null_score_winner == "null":
        winner = winner.when(a_score < b_score, pb)
    else:
        winner = winner.otherwise(pb)
    pair_key = F.concat(pa, F.lit("::"), pb)
    return p.select(
        *MONTH_COLS,
        X.pair_bucket(pair_key).alias("pair_bucket"),
        pair_key.alias("pair_key"),
        pa.alias("player_a"), pb.alias("player_b"),
        F.col("_p.a_title").alias("player_a_title"), F.col("_p.b_title").alias("player_b_title"),
        F.col("_p.a_color").alias("player_a_color"), F.col("_p.b_color").alias("player_b_color"),
        F.col("_p.a_rating").alias("player_a_rating"), F.col("_p.b_rating").alias("player_b_rating"),
        a_score.alias("player_a_score"), b_score.alias("player_b_score"),
        winner.alias("winner_username"), winner.alias("result_label"),
        "game_uuid", "game_url", "game_date", "end_time_utc", "time_class", "time_control", "rated", "rules",
        "opening_url", "opening_name", "white_username", "black_username", "winner_color",
    )


# --- D10 / D11 --------------------------------------------------------------
PAIR_KEYS = ("pair_bucket", "pair_key", "player_a", "player_b")
PAIR_COUNTS = ("games_played", "player_a_wins", "player_b_wins", "draws", "player_a_white_games",
               "player_a_black_games", "player_b_white_games", "player_b_black_games", "rated_games")


def h2h_monthly(pair_games: DataFrame, month: str | None = None, months: Sequence[str] | None = None) -> DataFrame:
    g = _month(pair_games, month, months)
    a, b = F.col("player_a_score"), F.col("player_b_score")
    return g.groupBy(*MONTH_COLS, *PAIR_KEYS).agg(
        F.count(F.lit(1)).alias("games_played"),
        _count_if(a == 1.0).alias("player_a_wins"),
        _count_if(b == 1.0).alias("player_b_wins"),
        _count_if((a == 0.5) & (b == 0.5)).alias("draws"),
        _count_if(F.col("player_a_color") == "white").alias("player_a_white_games"),
        _count_if(F.col("player_a_color") == "black").alias("player_a_black_games"),
        _count_if(F.col("player_b_color") == "white").alias("player_b_white_games"),
        _count_if(F.col("player_b_color") == "black").alias("player_b_black_games"),
        _count_if(F.col("rated")).alias("rated_games"),
        F.min("game_date").alias("first_game_date"),
        F.max("game_date").alias("last_game_date"),
    )


def h2h_summary(monthly: DataFrame) -> DataFrame:
    """All-time pairs from the monthly mart (re-aggregable sums, not games)."""
    sums = [F.sum(c).cast("bigint").alias(c) for c in PAIR_COUNTS]
    games = F.sum("games_played")
    return monthly.groupBy(*PAIR_KEYS).agg(
        *sums,
        F.min("first_game_date").alias("first_game_date"),
        F.max("last_game_date").alias("last_game_date"),
        X.round_like(_ratio(F.sum("player_a_wins"), games), 4).alias("player_a_win_rate"),
        X.round_like(_ratio(F.sum("player_b_wins"), games), 4).alias("player_b_win_rate"),
        X.round_like(_ratio(F.sum("draws"), games), 4).alias("draw_rate"),
    )
