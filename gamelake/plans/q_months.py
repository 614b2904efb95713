"""Contract queries for month selection (G1..G3) and C4..C6 filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from gamelake.functions import exprs as X
from gamelake.operators import months
from gamelake.plans import q_bronze
from gamelake.plans import q_silver_gold as SG
from gamelake.plans.contract import oracle, register
from gamelake.sources import fixtures, raw

CONF = {"month_keys": "1993-02, 1993-03", "month_key": "1994-07", "start_month": "1995-11",
        "end_month": "1996-02", "years": ["1997"]}
YEARS = ("1993", "1997")


@register("month_range", oracle("""
select o_custkey, strftime(m, '%Y-%m') as month_key
from (select o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
        interval 1 month)) as m
      from orders group by o_custkey) t"""))
def q_month_range(spark, sf):
    o = fixtures.base_table(spark, sf, "orders")
    span = o.groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("s"),
                                      F.date_format(F.max("o_orderdate"), "yyyy-MM").alias("e"))
    return span.select("o_custkey", F.explode(months.month_range_col("s", "e")).alias("month_key"))


def _available(spark, sf):
    return raw.months_available(spark, fixtures.landing_zone(spark, sf))


@register("months_of_years", oracle(f"""
select distinct concat(year, '-', month) as month_key from fx_feed where year in ({", ".join(repr(y) for y in YEARS)})""",
    "fx_feed"))
def q_months_of_years(spark, sf):
    return months.months_of_years(_available(spark, sf), YEARS)


_RESOLVED = """
select month_key from (values ('1993-02'), ('1993-03'), ('1994-07')) v(month_key)
union select strftime(m, '%Y-%m') from (select unnest(generate_series(date '1995-11-01', date '1996-02-01', interval 1 month)) as m) g
union select distinct concat(year, '-', month) from fx_feed where year = '1997'"""


@register("resolve_months", oracle(_RESOLVED, "fx_feed"))
def q_resolve_months(spark, sf):
    return months.resolve_months(spark, _available(spark, sf), CONF, "2024-01-02")


@register("month_selection_feed", oracle(f"""
select year, month, regexp_extract(raw_key, 'username=([^/]+)\\.json$', 1) as feed_user, count(*) as n_games
from fx_feed where concat(year, '-', month) in ({_RESOLVED})
group by raw_key, year, month""", "fx_feed"))
def q_month_selection_feed(spark, sf):
    sel = months.resolve_months(spark, _available(spark, sf), CONF, "2024-01-02")
    docs = months.select_months(q_bronze.feed(spark, sf), sel)
    return docs.select("year", "month", F.col("feed").alias("feed_user"), F.size("games").cast("bigint").alias("n_games"))


@register("month_key_expr", oracle("""
select concat(cast(year as varchar), '-', lpad(cast(month as varchar), 2, '0')) as month_key, count(*) as n
from silver_games group by 1""", "silver_games"))
def q_month_key_expr(spark, sf):
    g = SG.silver_games(spark, sf)
    return g.groupBy(X.month_key("year", "month").alias("month_key")).agg(F.count(F.lit(1)).alias("n"))


@register("month_filter", oracle("""
select 'single' as mode, count(*) as n from silver_games where month_key = '1995-03'
union all select 'list', count(*) from silver_games where month_key in ('1995-03', '1996-07', '1998-01')
union all select 'none', count(*) from silver_games""", "silver_games"))
def q_month_filter(spark, sf):
    g = SG.silver_games(spark, sf)
    parts = [("single", X.month_filter("1995-03")), ("list", X.month_filter(months=["1995-03", "1996-07", "1998-01"])),
             ("none", X.month_filter())]
    # All three counts in one reading of the games.
    counts = g.agg(*[F.count_if(cond).alias(mode) for mode, cond in parts])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(mode).alias("mode"), F.col(mode).alias("n")) for mode, _ in parts])).alias("r")
                         ).select("r.mode", "r.n")


@register("snapshot_filter", oracle("""
select 'day' as mode, count(*) as n from silver_roster where snapshot_date = '2024-01-02'
union all select 'none', count(*) from silver_roster""", "silver_roster"))
def q_snapshot_filter(spark, sf):
    from gamelake.operators import silver
    r = silver.silver_roster(silver.stage_roster(fixtures.view(spark, sf, "fx_roster")))
    a = r.filter(X.snapshot_filter("2024-01-02")).groupBy().agg(F.lit("day").alias("mode"), F.count(F.lit(1)).alias("n"))
    b = r.filter(X.snapshot_filter(None)).groupBy().agg(F.lit("none").alias("mode"), F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)
