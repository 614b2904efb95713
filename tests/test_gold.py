"""Gold mart properties and edge cases."""

from pyspark.sql import functions as F

from gamelake.operators import gold
from gamelake.plans import q_silver_gold as SG


def facts(spark, rows):
    return spark.createDataFrame(rows, "month_key string, year string, month string, title string, username string, "
                                       "opponent_username string, color string, rating double, score double, "
                                       "rated boolean, is_titled_opponent boolean")


def test_volatility_needs_two_rated_games(spark):
    f = facts(spark, [("2024-01", "2024", "01", "GM", "a", "x", "white", 2500.0, 1.0, True, False),
                      ("2024-01", "2024", "01", "GM", "b", "x", "white", 2400.0, 1.0, True, False),
                      ("2024-01", "2024", "01", "GM", "b", "y", "black", 2410.0, 0.0, True, False),
                      ("2024-01", "2024", "01", "GM", "b", "y", "black", None, 0.0, True, False)])
    r = gold.title_month_volatility(f).collect()
    assert len(r) == 1 and r[0].player_months == 1 and r[0].avg_rating_range == 10.0
    assert r[0].avg_rating_stddev == 5.0


def test_color_only_black(spark):
    f = facts(spark, [("2024-01", "2024", "01", "GM", "a", "x", "black", 2500.0, 1.0, True, False),
                      ("2024-01", "2024", "01", "GM", "a", "y", "black", 2500.0, 0.5, True, False)])
    r = gold.title_month_color(f).collect()[0]
    assert r.white_games == 0 and r.white_score_rate is None and r.white_minus_black is None
    assert r.black_score_rate == 0.75 and r.total_games == 2


def test_monthly_pairs_sum_to_summary(spark, sf):
    monthly = SG.pair_monthly(spark, sf)
    summary = gold.h2h_summary(monthly)
    m = monthly.groupBy("pair_key").agg(F.sum("games_played").alias("g"), F.sum("draws").alias("d"))
    j = summary.join(m, "pair_key")
    assert j.filter((F.col("g") != F.col("games_played")) | (F.col("d") != F.col("draws"))).count() == 0
    bad = summary.filter(F.col("player_a_wins") + F.col("player_b_wins") + F.col("draws") > F.col("games_played"))
    assert bad.count() == 0


def test_color_split_adds_up(spark, sf):
    c = gold.title_month_color(SG.silver_facts(spark, sf))
    assert c.filter(F.col("white_games") + F.col("black_games") != F.col("total_games")).count() == 0


def test_one_row_per_key_after_dedup(spark, sf):
    g = SG.silver_games(spark, sf)
    assert g.groupBy("year", "month", "game_uuid").count().filter("count > 1").count() == 0
    f = SG.silver_facts(spark, sf)
    assert f.groupBy("year", "month", "game_uuid", "username").count().filter("count > 1").count() == 0
