"""Interactive questions over the gold marts and silver tables.

Each function takes the table(s) and plain parameters and returns a lazy
DataFrame; the caller decides whether to ``collect``/``toPandas``. Filters
are Column predicates on partition or data columns, so they reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.functions import exprs as X


# --- E1 / E2 / E3 ---------------------------------------------------------------
def available_months(activity: DataFrame) -> DataFrame:
    return activity.select("month_key").filter(F.col("month_key").isNotNull()).distinct().orderBy("month_key")


def available_titles(activity: DataFrame) -> DataFrame:
    return activity.select("title").filter(F.col("title").isNotNull()).distinct().orderBy("title")


def available_players(roster: DataFrame) -> DataFrame:
    return (roster.groupBy(F.lower("username").alias("username"))
            .agg(F.min("title").alias("title"), F.max("snapshot_date").alias("latest_snapshot_date"))
            .orderBy(F.col("username").asc_nulls_last()))


# --- E4 / E5 --------------------------------------------------------------------
def range_titles(start_month: str, end_month: str, titles: Sequence[str] = ()) -> Column:
    """Inclusive month-key range (text comparison) and an optional title list."""
    cond = (F.col("month_key") >= F.lit(start_month)) & (F.col("month_key") <= F.lit(end_month))
    if titles:
        cond = cond & F.col("title").isin(list(titles))
    return cond


def player_filter(username: str, month_key: str | None = None, game_date: str | None = None) -> Column:
    cond = F.lower("username") == F.lit(username.lower())
    if month_key:
        cond = cond & (F.col("month_key") == F.lit(month_key))
    if game_date:
        cond = cond & (F.col("game_date").cast("string") == F.lit(game_date))
    return cond


# --- E6 / E7 / E8 ---------------------------------------------------------------
def _load(df: DataFrame, cols: list[Column], start: str, end: str, titles: Sequence[str]) -> DataFrame:
    return df.filter(range_titles(start, end, titles)).select(*cols).orderBy(
        F.col("month_key").asc_nulls_last(), F.col("title").asc_nulls_last())


def load_activity(activity: DataFrame, start: str, end: str, titles: Sequence[str] = ()) -> DataFrame:
    return _load(activity, [
        F.col("month_key"), F.col("title"),
        F.col("active_players").cast("bigint").alias("active_players"),
        F.col("total_games").cast("bigint").alias("total_games"),
        *[F.col(c).cast("double").alias(c) for c in
          ("avg_games_per_active_player", "avg_unique_opponents", "avg_player_score_rate", "avg_player_rating")],
    ], start, end, titles)


def load_volatility(volatility: DataFrame, start: str, end: str, titles: Sequence[str] = ()) -> DataFrame:
    return _load(volatility, [
        F.col("month_key"), F.col("title"), F.col("player_months").cast("bigint").alias("player_months"),
        *[F.col(c).cast("double").alias(c) for c in
          ("avg_games_per_player", "avg_rating_range", "median_rating_range", "avg_rating_stddev", "avg_player_rating")],
    ], start, end, titles)


def load_color(color: DataFrame, start: str, end: str, titles: Sequence[str] = ()) -> DataFrame:
    return _load(color, [
        F.col("month_key"), F.col("title"),
        F.col("white_games").cast("bigint").alias("white_games"),
        F.col("white_score_rate").cast("double").alias("white_score_rate"),
        F.col("black_games").cast("bigint").alias("black_games"),
        F.col("black_score_rate").cast("double").alias("black_score_rate"),
        F.col("white_minus_black").cast("double").alias("white_minus_black"),
        F.col("total_games").cast("bigint").alias("total_games"),
    ], start, end, titles)


# --- E9 / E10 / E11 ---------------------------------------------------------------
def normalize_pair(player_one: str, player_two: str) -> tuple[str, str]:
    a, b = player_one.strip().lower(), player_two.strip().lower()
    return (a, b) if a <= b else (b, a)


def normalize_pair_cols(one: str | Column, two: str | Column) -> tuple[Column, Column]:
    """Column form of ``normalize_pair`` for a table of name pairs."""
    a, b = X.normalize_name(one), X.normalize_name(two)
    return F.least(a, b), F.greatest(a, b)


def _pair(df: DataFrame, one: str, two: str) -> DataFrame:
    a, b = normalize_pair(one, two)
    return df.filter((F.lower("player_a") == F.lit(a)) & (F.lower("player_b") == F.lit(b)))


def h2h_lookup(summary: DataFrame, one: str, two: str) -> DataFrame:
    return _pair(summary, one, two).select(
        "player_a", "player_b",
        *[F.col(c).cast("bigint").alias(c) for c in ("games_played", "player_a_wins", "player_b_wins", "draws", "rated_games")],
        "first_game_date", "last_game_date",
        *[F.col(c).cast("double").alias(c) for c in ("player_a_win_rate", "player_b_win_rate", "draw_rate")])


def h2h_game_list(pair_games: DataFrame, one: str, two: str) -> DataFrame:
    return _pair(pair_games, one, two).select(
        "game_date", "time_class", "rated", "opening_name", "white_username", "black_username", "winner_username",
        "player_a", "player_b", "player_a_color", "player_a_score", "player_b_score", "game_url",
    ).orderBy(F.col("game_date").desc_nulls_last(), F.col("game_url").desc_nulls_last())


# --- E12 .. E16 -------------------------------------------------------------------
def player_months(facts: DataFrame, username: str) -> DataFrame:
    return (facts.filter(player_filter(username)).select("month_key").distinct()
            .orderBy(F.col("month_key").desc_nulls_last()))


def player_days(facts: DataFrame, username: str, month_key: str) -> DataFrame:
    return (facts.filter(player_filter(username, month_key)).select(F.col("game_date").cast("string").alias("game_date"))
            .distinct().orderBy(F.col("game_date").desc_nulls_last()))


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def player_summary(facts: DataFrame, username: str, month_key: str, game_date: str | None = None) -> DataFrame:
    """One row even when nothing matches (a global aggregate)."""
    return facts.filter(player_filter(username, month_key, game_date)).agg(
        F.min("title").alias("title"),
        F.count(F.lit(1)).cast("bigint").alias("games_played"),
        _count_if(F.col("score") == 1.0).alias("wins"),
        _count_if(F.col("score") == 0.5).alias("draws"),
        _count_if(F.col("score") == 0.0).alias("losses"),
        F.avg("score").cast("double").alias("avg_score"),
        F.avg("rating").cast("double").alias("avg_rating"),
        F.avg("rating_diff").cast("double").alias("avg_rating_diff"),
        F.count_distinct("opponent_username").cast("bigint").alias("unique_opponents"),
        F.min("game_date").alias("first_game_date"),
        F.max("game_date").alias("last_game_date"),
    )


def player_daily_counts(facts: DataFrame, username: str, month_key: str) -> DataFrame:
    return (facts.filter(player_filter(username, month_key))
            .groupBy(F.col("game_date").cast("string").alias("game_date"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("games_played")).orderBy("game_date"))


def player_games(facts: DataFrame, username: str, month_key: str, game_date: str | None = None) -> DataFrame:
    return facts.filter(player_filter(username, month_key, game_date)).select(
        F.col("game_date").cast("string").alias("game_date"), "time_class", "rated", "color", "opponent_username",
        "opponent_title", X.rint_bigint("rating").alias("rating"), X.rint_bigint("opponent_rating").alias("opponent_rating"),
        X.rint_bigint("rating_diff").alias("rating_diff"), "result", F.col("score").cast("double").alias("score"),
        "opening_name", "game_url",
    ).orderBy(F.col("game_date").desc_nulls_last(), F.col("game_url").desc_nulls_last())


# --- E17 / E18 / E19 ----------------------------------------------------------------
def pivot_by_title(df: DataFrame, value: str, titles: Sequence[str] | None = None) -> DataFrame:
    """Month x title grid of one measure; a missing cell is 0.

    The columns are the caller's ``titles`` (a title filter), else the titles
    the result holds: one small distinct, the known ones first, then any
    others by name.
    """
    if titles is None:
        held = {r["title"] for r in df.select("title").filter(F.col("title").isNotNull()).distinct().collect()}
        titles = [t for t in X.TITLES if t in held] + sorted(held - set(X.TITLES))
    return (df.groupBy("month_key").pivot("title", list(titles)).agg(F.first(value)).fillna(0)
            .orderBy("month_key"))


def lenient_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Result columns to double where they parse, else null."""
    return df.select(*[X.coerce_number(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def default_window(months: DataFrame, last_n: int = 12) -> DataFrame:
    """(start_month, end_month): from the ``last_n``-th last available month to
    the last one. A top-k over distinct months, so a single small row."""
    top = months.select("month_key").filter(F.col("month_key").isNotNull()).distinct().orderBy(
        F.col("month_key").desc()).limit(last_n)
    return top.agg(F.min("month_key").alias("start_month"), F.max("month_key").alias("end_month"))
