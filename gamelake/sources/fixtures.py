"""Fixture views over the generated TPC-H-shaped tables.

The source system ships no test data, so game feeds, rosters, archive lists
and fetch responses are derived from ``lineitem``/``orders``/``part``/
``customer`` by the SQL below. The same text runs in Spark SQL (tables bound
as DataFrame parameters) and in DuckDB (as CTEs of the oracle queries), so
both engines see identical inputs whose size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gamelake.session import configure

BASE_TABLES = ("lineitem", "orders", "part", "customer")

# Each view text uses {lineitem} / {orders} / {part} / {customer} / {fx_*}
# placeholders for the tables it reads.
#: The columns of FX_GAMES.
GAME_ROW = """select
  concat(cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0')) as month_key,
  cast(year(o_orderdate) as varchar(4)) as year,
  lpad(cast(month(o_orderdate) as varchar(2)), 2, '0') as month,
  game_uuid,
  concat('https://games.example/live/', game_uuid, '-', cast(l_suppkey as varchar(20))) as game_url,
  cast(o_orderdate as date) as game_date,
  case when l_discount < 0.03 then 'Blitz' when l_discount < 0.06 then 'bullet' when l_discount < 0.09 then 'rapid' else null end as time_class,
  case when l_tax >= 0.075 then null else l_linestatus = 'O' end as rated,
  concat('https://games.example/openings/', replace(p_type, ' ', '-')) as opening_url,
  concat('Player', cast(wid as varchar(9))) as white_username,
  case wid % 12 when 0 then 'GM' when 1 then 'WGM' when 2 then 'IM' when 3 then 'WIM' when 4 then 'FM' when 5 then 'WFM' when 6 then 'NM' when 7 then 'WNM' when 8 then 'CM' when 9 then 'WCM' else null end as white_title,
  case when l_linenumber = 6 and l_tax < 0.005 then null else 2000e0 + l_quantity * 10 end as white_rating,
  case when l_returnflag = 'R' then 1.0e0 when l_returnflag = 'A' then 0.0e0 when l_linestatus = 'F' and l_linenumber = 7 then null else 0.5e0 end as white_score,
  concat(case when l_linenumber % 2 = 1 then 'player' else 'Player' end, cast(bid as varchar(9))) as black_username,
  case bid % 12 when 0 then 'GM' when 1 then 'WGM' when 2 then 'IM' when 3 then 'WIM' when 4 then 'FM' when 5 then 'WFM' when 6 then 'NM' when 7 then 'WNM' when 8 then 'CM' when 9 then 'WCM' else null end as black_title,
  2000e0 + (l_partkey % 500) as black_rating,
  case when l_returnflag = 'R' then 0.0e0 when l_returnflag = 'A' then 1.0e0 when l_linestatus = 'F' and l_linenumber = 7 then null else 0.5e0 end as black_score,
  cast(1 + l_suppkey % 3 as int) as source_key_count,
  cast(1 + l_partkey % 2 as int) as source_player_count
"""

FX_GAMES = """
with j as (
  select l.*, o.o_orderdate, o.o_custkey % 24 as wid, l.l_partkey % 24 as bid, p.p_type,
    concat('g', cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) as game_uuid
  from {lineitem} l
  join {orders} o on o.o_orderkey = l.l_orderkey
  join {part} p on p.p_partkey = l.l_partkey
)
""" + GAME_ROW + """from j
"""

#: The game columns of FX_FEED.
FEED_GAME = """  case when l_partkey % 50 = 0 then '' else gid end as uuid,
  case when l_partkey % 100 = 0 then null else concat('https://games.example/live/', gid) end as url,
  case when l_partkey % 77 = 0 then 'bad' else cast(789000000 + (l_orderkey % 15000) * 13999 as varchar(20)) end as end_time,
  case when l_discount < 0.03 then 'Blitz' when l_discount < 0.06 then 'bullet' when l_discount < 0.09 then 'rapid' else null end as time_class,
  case when l_tax >= 0.075 then null else l_linestatus = 'O' end as rated,
  case when side = 'white' and l_linenumber % 3 = 0 then null else concat('https://games.example/openings/', replace(p_type, ' ', '-')) end as eco,
  case when side = 'black' and l_suppkey % 2 = 1 then '' else 'pgn-text' end as pgn,
  case when l_suppkey % 5 = 0 then concat(chr(34), 'n/a', chr(34)) when l_suppkey % 5 = 1 then '{{}}' when l_suppkey % 5 = 2 then concat(chr(34), '{{', chr(92), chr(34), 'white', chr(92), chr(34), ':50}}', chr(34)) when l_partkey % 10 = 0 then 'null' else concat('{{"black":"x","white":', cast(l_linenumber + 80 as varchar(5)), '}}') end as accuracies,
  concat('Player', cast(wid as varchar(9))) as white_username,
  case when l_linenumber = 6 then '' else cast(2000 + l_suppkey as varchar(9)) end as white_rating,
  case when l_returnflag = 'R' then 'win' when l_returnflag = 'A' then 'resigned' when l_linenumber = 7 then null else 'repetition' end as white_result,
  case when bid = 0 and l_linenumber = 1 then '' else concat(case when l_linenumber % 2 = 1 then 'player' else 'Player' end, cast(bid as varchar(9))) end as black_username,
  cast(2000 + l_partkey % 500 as varchar(9)) as black_rating,
  case when l_returnflag = 'R' then 'checkmated' when l_returnflag = 'A' then 'win' when l_linenumber = 7 then null else 'agreed' end as black_result"""

FX_FEED = """
with base as (
  select l.*, o.o_orderdate, o.o_custkey % 24 as wid, l.l_partkey % 24 as bid, p.p_type,
    concat('g', cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) as gid
  from {lineitem} l
  join {orders} o on o.o_orderkey = l.l_orderkey
  join {part} p on p.p_partkey = l.l_partkey
),
sides as (
  select base.*, 'white' as side, concat('Player', cast(wid as varchar(9))) as feed_user from base
  union all
  select base.*, 'black' as side, concat('Player', cast(bid as varchar(9))) as feed_user from base where l_suppkey % 4 <> 0
),
keyed as (
  select sides.*,
    concat('raw/player_games/year=', cast(year(o_orderdate) as varchar(4)), '/month=', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0'), '/username=', feed_user, '.json') as raw_key
  from sides
)
select
  raw_key,
  cast(year(o_orderdate) as varchar(4)) as year,
  lpad(cast(month(o_orderdate) as varchar(2)), 2, '0') as month,
  case when wid = 23 and side = 'white' then null else feed_user end as source_username,
  cast(row_number() over (partition by raw_key order by gid, side, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) as int) as pos,
""" + FEED_GAME + """
from keyed
"""

FX_ROSTER = """
with days as (
  select '2024-01-01' as snapshot_date, c_custkey, c_name, c_nationkey from {customer} where c_custkey % 7 <> 0
  union all
  select '2024-01-02' as snapshot_date, c_custkey, c_name, c_nationkey from {customer} where c_custkey % 5 <> 0
)
select snapshot_date,
  case c_nationkey % 10 when 0 then 'GM' when 1 then 'WGM' when 2 then 'IM' when 3 then 'WIM' when 4 then 'FM' when 5 then 'WFM' when 6 then 'NM' when 7 then 'WNM' when 8 then 'CM' else 'WCM' end as title,
  lower(replace(c_name, '#', '')) as username,
  cast(count(*) over (partition by snapshot_date, c_nationkey % 10) as int) as snapshot_player_count,
  cast(row_number() over (partition by snapshot_date, c_nationkey % 10 order by c_custkey) as int) as snapshot_position
from days
"""

FX_ARCHIVES = """
select distinct lower(replace(c_name, '#', '')) as username,
  concat('https://api.games.example/player/', lower(replace(c_name, '#', '')), '/games/', cast(year(o_orderdate) as varchar(4)), '/', cast(month(o_orderdate) as varchar(2))) as archive_url
from {orders} join {customer} on c_custkey = o_custkey
"""

FX_STORED = """
select distinct lower(replace(c_name, '#', '')) as username,
  concat(cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0')) as month_key
from {orders} join {customer} on c_custkey = o_custkey
where o_orderstatus = 'F'
"""

FX_RESPONSES = """
select username, month_key,
  case st when 'F' then 200 when 'O' then 304 else 404 end as status_code,
  substr(md5(concat(username, month_key)), 1, 12) as etag,
  cast(n as int) as game_count
from (
  select lower(replace(c_name, '#', '')) as username,
    concat(cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0')) as month_key,
    min(o_orderstatus) as st, count(*) as n
  from {orders} join {customer} on c_custkey = o_custkey
  group by 1, 2
) q
"""


# --- inputs of the daily control cycle: three days -------------------------------
def _title_of(n: str) -> str:
    names = ("GM", "WGM", "IM", "WIM", "FM", "WFM", "NM", "WNM", "CM", "WCM")
    return f"case {n} " + " ".join(f"when {i} then '{t}'" for i, t in enumerate(names)) + " end"


# Players come and go; every 13th moves to another title on day 2, every 11th is on two rosters.
FX_CYCLE_ROSTER = f"""
with c as (
  select c_custkey as k, c_nationkey % 10 as t, lower(replace(c_name, '#', '')) as username from {{customer}}
),
listed as (
  select 1 as day, k, t, username from c where k % 7 <> 0
  union all select 2 as day, k, case when k % 13 = 0 then (t + 1) % 10 else t end as t, username from c where k % 5 <> 0
  union all select 3 as day, k, case when k % 13 = 0 then (t + 1) % 10 else t end as t, username from c where k % 7 <> 0
)
select day, {_title_of('t')} as title, username from listed
union all
select day, {_title_of('(t + 5) % 10')} as title, username from listed where k % 11 = 0
"""

# Archive lists grow by the day; on day 1 every 17th fetch fails (no row), and players without orders have empty lists (null url).
FX_CYCLE_LISTS = """
with m as (
  select distinct o_custkey as k, cast(year(o_orderdate) as varchar(4)) as y, cast(month(o_orderdate) as varchar(2)) as m,
    concat(cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0')) as month_key
  from {orders}
),
days as (select 1 as day, '1996-04' as last union all select 2 as day, '1996-05' as last union all select 3 as day, '1997-12' as last)
select day, lower(replace(c_name, '#', '')) as username,
  case when month_key <= last then concat('https://api.games.example/player/', lower(replace(c_name, '#', '')), '/games/', y, '/', m) end as archive_url
from {customer} cross join days left join m on k = c_custkey
where not (day = 1 and c_custkey % 17 = 0)
"""

# Answers for a player's month: 429, 500, 404, 304, an empty body, or games.
FX_CYCLE_ANSWERS = """
select lower(replace(c_name, '#', '')) as username,
  concat(cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0')) as month_key,
  case (c_custkey + month(o_orderdate)) % 9 when 0 then 429 when 1 then 500 when 2 then 404 when 3 then 304 else 200 end as status_code,
  substr(md5(concat(c_name, cast(month(o_orderdate) as varchar(2)))), 1, 12) as etag,
  cast(case when (c_custkey + month(o_orderdate)) % 9 = 4 then null else count(*) end as int) as game_count
from {orders} join {customer} on c_custkey = o_custkey
group by c_custkey, c_name, year(o_orderdate), month(o_orderdate)
"""

FX_CYCLE_RAW = """
select distinct lower(replace(c_name, '#', '')) as username,
  concat(cast(year(o_orderdate) as varchar(4)), '-', lpad(cast(month(o_orderdate) as varchar(2)), 2, '0')) as month_key
from {orders} join {customer} on c_custkey = o_custkey
where (c_custkey + month(o_orderdate)) % 4 = 0
"""

VIEWS = {
    "fx_cycle_roster": FX_CYCLE_ROSTER,
    "fx_cycle_lists": FX_CYCLE_LISTS,
    "fx_cycle_answers": FX_CYCLE_ANSWERS,
    "fx_cycle_raw": FX_CYCLE_RAW,
    "fx_games": FX_GAMES,
    "fx_feed": FX_FEED,
    "fx_roster": FX_ROSTER,
    "fx_archives": FX_ARCHIVES,
    "fx_stored": FX_STORED,
    "fx_responses": FX_RESPONSES,
}


def _placeholders(text: str) -> list[str]:
    return [t for t in BASE_TABLES if "{" + t + "}" in text]


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture view ``name`` as a Spark DataFrame over ``sf_dir``."""
    configure(spark)
    text = VIEWS[name]
    tables = {t: base_table(spark, sf_dir, t) for t in _placeholders(text)}
    return spark.sql(text, **tables)


# ---------------------------------------------------------------------------
# Raw landing zone built from fx_feed (JSON written and read back by Spark)
# ---------------------------------------------------------------------------
# Title memberships for the feed's players: each side's title as in fx_games,
# plus a lower-priority second roster for GM/IM players, so the priority rule
# decides. Added here (not in the source system) to drive the title lookup.
FX_TITLES = """
select distinct white_title as title, white_username as username from {fx_games} g where white_title is not null
union
select distinct black_title as title, black_username as username from {fx_games} g where black_title is not null
union
select distinct 'WCM' as title, white_username as username from {fx_games} g where white_title in ('GM', 'IM')
"""


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX_TITLES in one pass over fx_games (the SQL text scans it three times),
    written once per input directory: of a table that lies there Spark knows the
    size, and need not shuffle the games to join a small one."""
    from pyspark.sql import functions as F

    from gamelake.session import scratch_path
    from gamelake.sources import raw

    def write(tmp: str) -> None:
        g = view(spark, sf_dir, "fx_games")
        pairs = F.array(
            F.struct(F.col("white_title").alias("title"), F.col("white_username").alias("username")),
            F.struct(F.col("black_title").alias("title"), F.col("black_username").alias("username")),
            F.struct(F.when(F.col("white_title").isin("GM", "IM"), F.lit("WCM")).alias("title"),
                     F.col("white_username").alias("username")))
        (g.select(F.explode(pairs).alias("p")).select("p.title", "p.username")
         .filter(F.col("title").isNotNull()).distinct().write.parquet(tmp))

    root = raw.publish(spark, scratch_path(spark, "fixture", input_token(spark, sf_dir), "titles"), write)
    return spark.read.schema("title string, username string").parquet(root)


def oracle_titles() -> str:
    return FX_TITLES.format(fx_games="fx_games")


def games_by_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of fx_games with a ``game_uuid``, dealt by it (``silver.by_game``):
    the columns they are made of cross the shuffle, and their text is made behind it."""
    from pyspark.sql import functions as F

    from gamelake.operators.silver import by_game

    configure(spark)
    line, orders, part = (base_table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", (F.col("o_custkey") % 24).alias("wid"))
    j = line.join(orders, "l_orderkey").join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    j = j.withColumn("game_uuid", F.concat(F.lit("g"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")))
    return spark.sql(GAME_ROW + "from {j}", j=by_game(j).withColumn("bid", F.col("l_partkey") % 24))


#: The columns by which FX_FEED numbers the games of a document, in its order.
FEED_ORDER = ("gid", "side", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax")


#: Of these, the columns that nothing but that order reads.
TIE_BREAK = ("l_quantity", "l_extendedprice", "l_shipdate")


def _line_mark():
    """Equal for lineitems that FEED_ORDER tells apart by its later columns only (and for few others: a hash)."""
    from pyspark.sql import functions as F

    return F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of the lineitems whose numbering takes a tie-break, usually few, written once per input directory."""
    from pyspark.sql import functions as F

    from gamelake.session import scratch_path
    from gamelake.sources import raw

    marks = base_table(spark, sf_dir, "lineitem").select(_line_mark().alias("mark"))
    ties = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark")
    root = raw.publish(spark, scratch_path(spark, "fixture", input_token(spark, sf_dir), "ties"), lambda tmp: ties.write.parquet(tmp))
    return spark.read.schema("mark long").parquet(root)


def feed_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of FX_FEED before text is made of them: a lineitem with its
    order's month, the white player's number and the part's type, once for
    each side that has a feed. ``ym`` and ``doc`` name the document; what can
    be told from other columns is left to ``feed_documents``, behind the shuffle,
    and columns that only break ties are carried where there is one."""
    from pyspark.sql import functions as F

    configure(spark)
    line, orders, part = (base_table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    # A line without a number has a null gid, like lines of other orders: its tie-break stays.
    tied = F.col("tie").isNotNull() | F.col("l_linenumber").isNull() | F.col("l_suppkey").isNull()
    line = line.withColumn("mark", _line_mark()).join(line_ties(spark, sf_dir).select("mark", F.lit(True).alias("tie")), "mark", "left").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        *[F.when(tied, F.col(c)).alias(c) for c in TIE_BREAK])
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("ym"),
                           (F.col("o_custkey") % 24).alias("wid"))
    base = line.join(orders, "l_orderkey").join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    sides = F.when(F.col("l_suppkey") % 4 != 0, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    # A row without a month or a player has no file name: those of a month are one document, as in FX_FEED.
    return base.select(*base.columns, F.explode(sides).alias("white")).withColumn("doc", F.when(F.col("ym").isNotNull(), _player()))


def _player():
    from pyspark.sql import functions as F

    return F.when(F.col("white"), F.col("wid")).otherwise(F.col("l_partkey") % 24)


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_feed occurrences packed into one feed document per raw_key.

    A document holds one player's month, so its size is bounded by the games
    one player can play in a month. The document's username is null when any
    of its occurrences lacks one (the feed's missing-username case).

    The plain rows are dealt by document, once, and sorted as they are; games
    are made of them as a document is collected, and it stays where it is.
    """
    from pyspark.sql import functions as F

    from gamelake.sources.raw import spread

    fx = spread(feed_sides(spark, sf_dir), "ym", "doc").withColumns(_told() | {"source_username": _source_username()})
    docs = spark.sql("select ym, doc, case when count(source_username) = count(*) then max(source_username) end as username,\n"
                     "sort_array(collect_list(struct(" + ", ".join(FEED_ORDER) + ", struct(" + FEED_GAME + ") as g))) as _games\n"
                     "from {fx} group by ym, doc", fx=fx)
    feed = _feed_of()
    docs = docs.withColumns({c: feed[c] for c in ("year", "month")})
    return docs.select(
        "username", "year", "month", F.concat_ws("-", "year", "month").alias("month_key"),
        F.size("_games").cast("int").alias("game_count"),
        F.transform("_games", lambda x: _feed_game(x["g"])).alias("games"), feed["feed"].alias("feed"))


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``feed_documents`` line by line (``raw.game_lines``): their text is made behind the sort
    of the plain rows, and no task holds one. Games that FEED_ORDER does not tell apart lie in the order of what
    is left of their rows."""
    from pyspark.sql import functions as F

    from gamelake.sources import raw

    rows = raw.spread(feed_sides(spark, sf_dir), "ym", "doc").withColumns(_told())
    fields = F.expr("struct(" + FEED_GAME.format() + ")")
    return raw.game_lines(rows, ("ym", "doc"), _feed_of(), _source_username(), _feed_game(fields),
                          (*FEED_ORDER, "l_linestatus", "p_type", "wid", "l_returnflag"))


def _feed_of():
    """year, month and feed of a document's ``ym`` and ``doc``."""
    from pyspark.sql import functions as F

    return {"year": F.floor(F.col("ym") / 100).cast("string"), "month": F.lpad((F.col("ym") % 100).cast("string"), 2, "0"),
            "feed": F.concat(F.lit("Player"), F.col("doc").cast("string"))}


def _told():
    """What ``feed_sides`` leaves out, since its other columns tell it."""
    from pyspark.sql import functions as F

    return {"bid": F.col("l_partkey") % 24, "side": F.when(F.col("white"), "white").otherwise("black"),
            "gid": F.concat(F.lit("g"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))}


def _source_username():
    from pyspark.sql import functions as F

    return F.when(F.col("white") & (F.col("wid") == 23), None).otherwise(F.concat(F.lit("Player"), _player().cast("string")))


def _feed_game(g):
    """The columns of FEED_GAME -> a game as in a feed document."""
    from pyspark.sql import functions as F

    none = lambda name: F.lit(None).cast("string").alias(name)
    side = lambda s: F.struct(*[g[f"{s}_{f}"].alias(f) for f in ("username", "rating", "result")]).alias(s)
    return F.struct(
        *[g[f].alias(f) for f in ("uuid", "url", "end_time", "time_class")], none("time_control"), g["rated"].alias("rated"), none("rules"),
        g["eco"].alias("eco"), none("initial_setup"), none("fen"), g["pgn"].alias("pgn"), none("tcn"),
        F.try_parse_json(g["accuracies"]).alias("accuracies"), side("white"), side("black"))


def input_token(spark: SparkSession, sf_dir: str) -> str:
    """Names one input in one application: its files with sizes and times, and
    the application, so that neither changed data nor changed code meets an
    older answer in a shared folder."""
    from gamelake.session import path_token
    from gamelake.sources import raw

    files = [f for t in BASE_TABLES for f in raw.file_marks(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")]
    return path_token("\n".join([spark.sparkContext.applicationId, sf_dir.rstrip("/"), *sorted(files)]))


def landing_zone(spark: SparkSession, sf_dir: str) -> str:
    """Write the fixture feed documents once per input directory under the
    checkpoint root and return the ``player_games`` root."""
    from gamelake.session import scratch_path
    from gamelake.sources import raw

    root = scratch_path(spark, "fixture", input_token(spark, sf_dir), "raw", "player_games")
    return raw.publish(spark, root, lambda tmp: raw.write_lines(feed_lines(spark, sf_dir), tmp))


def lake(spark: SparkSession, sf_dir: str) -> str:
    """Run the layered build once per input directory over the fixture
    landing zone (all months) and return the lake root."""
    from gamelake.plans import pipeline
    from gamelake.session import scratch_path
    from gamelake.sources import raw

    raw_root = landing_zone(spark, sf_dir)
    root = scratch_path(spark, "fixture", input_token(spark, sf_dir), "lake")

    def build(tmp: str) -> None:
        pipeline.run(spark, raw_root, tmp, months=None, roster_members=titles(spark, sf_dir),
                     roster=view(spark, sf_dir, "fx_roster"))

    return raw.publish(spark, root, build)
