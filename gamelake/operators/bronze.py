"""Raw feed documents -> bronze ``games_core`` / ``player_game_facts`` / ``roster_daily``.

All column work is built-in expressions. The only shuffle before the sink is
the merge on (year, month, game key); it is an aggregate, so partial
aggregation collapses repeated sightings of a game map-side. PGN/TCN text is
reduced to a presence flag before the shuffle; only the flags survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake import schemas as SC
from gamelake.functions import exprs as X

# Fields a later sighting may fill when the first sighting lacks them.
FILL_FIELDS = ("accuracies", "pgn", "tcn", "eco", "fen", "initial_setup")
FIRST_FIELDS = ("uuid", "url", "end_time", "time_class", "time_control", "rated", "rules", "white", "black")
# Of these, the fields that travel by themselves: a query that reads no more of a game shuffles no more of it.
SIDES = ("white", "black")


# --- B1 / B2 ----------------------------------------------------------------
def repeated_positions(games: str | Column) -> Column:
    """Positions of the games of one document whose key an earlier game of it
    has: one sort of the keys and one pass, inside the array."""
    keyed = F.transform(X.col(games), lambda g, i: F.struct(game_key(g["uuid"], g["url"]).alias("key"), i.alias("pos")))
    ranked = F.array_sort(F.filter(keyed, lambda x: x["key"].isNotNull()))
    start = F.struct(F.lit("").alias("key"), F.array().cast("array<int>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        found = F.when(acc["key"] == x["key"], F.concat(acc["found"], F.array(x["pos"]))).otherwise(acc["found"])
        return F.struct(F.coalesce(x["key"], F.lit("")).alias("key"), found.alias("found"))

    return F.aggregate(ranked, start, step, lambda acc: acc["found"])


def explode_feed(feed: DataFrame) -> DataFrame:
    """One row per game occurrence: raw_key, year, month, source_username, pos, game.*, again.

    ``again`` marks a game whose key stands earlier in the same document, so
    that documents can be counted later without comparing them. Games that are
    JSON texts (``read_feed`` with ``opened=False``) are opened one at a time
    and have no ``again``."""
    if feed.schema["games"].dataType == SC.SA:
        occ = feed.select("raw_key", "year", "month", F.col("username").alias("source_username"), F.posexplode("games").alias("pos", "game"))
        occ = occ.withColumn("game", F.from_json("game", SC.GAME_IN_FILE, {"mode": "FAILFAST"})).select(*occ.columns[:-1], "game.*")
        return occ.withColumn("accuracies", F.to_json("accuracies"))
    docs = feed.select("raw_key", "year", "month", F.col("username").alias("source_username"), "games",
                       repeated_positions("games").alias("repeats"))
    occ = docs.select(
        "raw_key", "year", "month", "source_username", "repeats",
        F.posexplode("games").alias("pos", "game"),
    ).select("raw_key", "year", "month", "source_username", "pos", "game.*", F.array_contains("repeats", F.col("pos")).alias("again"))
    # From here on ``accuracies`` is JSON text, in which a text value stays quoted.
    if "accuracies" in occ.columns and isinstance(occ.schema["accuracies"].dataType, T.VariantType):
        occ = occ.withColumn("accuracies", F.to_json("accuracies"))
    return occ


def game_key(uuid: str | Column = "uuid", url: str | Column = "url") -> Column:
    return F.coalesce(F.nullif(X.col(uuid), F.lit("")), F.nullif(X.col(url), F.lit("")))


def keyed_occurrences(occ: DataFrame) -> DataFrame:
    return occ.withColumn("game_key", game_key()).filter(F.col("game_key").isNotNull())


# --- B3 / B4 ----------------------------------------------------------------
def truthy_json(text: str | Column) -> Column:
    """Truthiness of a raw JSON value read as text: empty containers, null,
    false, zero and '' are falsy."""
    t = F.regexp_replace(X.col(text), r"\s", "")
    return F.coalesce(~t.isin("", "{}", "[]", "null", "false", "0", "0.0", '""'), F.lit(False))


def _truthy(field: str) -> Column:
    return truthy_json(field) if field == "accuracies" else X.truthy_text(field)


def merge_games(occ: DataFrame) -> DataFrame:
    """First sighting wins, in (raw_key, pos) order; the fill fields take the
    first truthy sighting. Provenance: distinct files and source users.

    One aggregation, combined map-side, so the payload crosses one exchange
    and a game seen in thousands of feeds leaves each map task as one row.
    Files are counted by their first sighting of the game where ``again`` of
    ``explode_feed`` tells it (a plain sum), else as a set of names.
    """
    k = keyed_occurrences(occ)
    files = F.sum(F.when(F.col("again"), 0).otherwise(1)) if "again" in k.columns else F.size(F.collect_set("raw_key"))
    fill = ("accuracies", "eco", "fen", "initial_setup")
    order = F.struct("raw_key", "pos")
    k = k.withColumns({f"_has_{f}": _truthy(f) for f in (*fill, "pgn", "tcn")})
    # A truthy value of the first sighting is the first truthy one: it travels once.
    about = [f for f in FIRST_FIELDS if f not in SIDES]
    merged = k.groupBy("year", "month", "game_key").agg(
        F.min_by(F.struct(*about, *[F.when(~F.col(f"_has_{f}"), F.col(f)).alias(f"first_{f}") for f in fill]), order).alias("g"),
        F.min_by(F.struct(*SIDES), order).alias("sides"),
        *[F.min_by(f, F.when(F.col(f"_has_{f}"), order)).alias(f"fill_{f}") for f in fill],
        *[F.max(f"_has_{f}").alias(f"has_{f}") for f in ("pgn", "tcn")],
        files.alias("source_key_count"),
        F.array_sort(F.collect_set(F.nullif(F.col("source_username"), F.lit("")))).alias("source_player_usernames"),
    )
    out = [F.col("year"), F.col("month"), F.col("game_key")]
    out += [F.col(f"{'sides' if f in SIDES else 'g'}.{f}").alias(f) for f in FIRST_FIELDS]
    out += [F.coalesce(F.col(f"fill_{f}"), F.col(f"g.first_{f}")).alias(f) for f in fill]
    out += [F.col("has_pgn"), F.col("has_tcn"), F.col("source_key_count").cast("int").alias("source_key_count"),
            F.size("source_player_usernames").cast("int").alias("source_player_count"), F.col("source_player_usernames")]
    return merged.select(*out)


# --- B5 / B6 ----------------------------------------------------------------
def title_lookup(roster_members: DataFrame) -> DataFrame:
    """(title, username) memberships -> username -> the highest-priority title."""
    prio = F.array_position(F.array(*[F.lit(t) for t in X.TITLES]), F.col("title"))
    m = roster_members.select("username", "title", prio.alias("prio")).filter(
        (F.col("prio") > 0) & F.col("username").isNotNull())
    return m.groupBy("username").agg(F.min_by("title", "prio").alias("title"))


def title_enrich(games: DataFrame, lookup: DataFrame) -> DataFrame:
    """Exact (case-sensitive) username match on both sides; AQE picks the join
    from runtime sizes."""
    lk = lookup.select("username", "title")
    w = lk.select(F.col("username").alias("_wu"), F.col("title").alias("white_title"))
    b = lk.select(F.col("username").alias("_bu"), F.col("title").alias("black_title"))
    out = games.join(w, games["white_username"] == w["_wu"], "left").drop("_wu")
    return out.join(b, out["black_username"] == b["_bu"], "left").drop("_bu")


# --- B7 .. B15 ----------------------------------------------------------------
def games_core_rows(merged: DataFrame) -> DataFrame:
    """Merged games (with white/black structs) -> the 31 bronze columns + year, month."""
    # Parsed once for the three columns made of it.
    merged = merged.withColumn("_accuracies", X.accuracies_map("accuracies"))
    g = merged.select(
        "year", "month",
        F.col("game_key").alias("game_uuid"), F.col("url").alias("game_url"),
        X.epoch_to_iso("end_time").alias("end_time_utc"),
        "time_class", "time_control", "rated", "rules", F.col("eco").alias("opening_url"),
        X.opening_name("eco").alias("opening_name"), "initial_setup", "fen", "has_pgn", "has_tcn",
        X.has_entries("_accuracies").alias("has_accuracies"),
        F.col("white.username").alias("white_username"),
        X.coerce_number("white.rating").alias("white_rating"),
        F.col("white.result").alias("white_result"),
        X.result_score("white.result").alias("white_score"),
        X.entry_number("_accuracies", "white").alias("white_accuracy"),
        F.col("black.username").alias("black_username"),
        X.coerce_number("black.rating").alias("black_rating"),
        F.col("black.result").alias("black_result"),
        X.result_score("black.result").alias("black_score"),
        X.entry_number("_accuracies", "black").alias("black_accuracy"),
        "source_key_count", "source_player_count", "source_player_usernames",
        *[c for c in ("white_title", "black_title") if c in merged.columns],
    )
    g = g.withColumn("game_date", X.iso_to_date_text("end_time_utc"))
    g = g.withColumn("winner_color", X.winner_color("white_score", "black_score"))
    return SC.conform(g, SC.MONTH_PARTS + SC.GAMES_CORE, {})


# --- B16 / B17 ----------------------------------------------------------------
def player_rows(games: DataFrame, shared: list[str] | None = None) -> DataFrame:
    """Each game -> up to two player-perspective rows; a side without a
    username is skipped. One pass with ``explode``, not a self-union."""
    shared = shared if shared is not None else [c for c in SC.names(SC.FACT_SHARED) if c in games.columns]
    carry = [c for c in ("month_key", "year", "month", "bucket") if c in games.columns]
    have = set(games.columns)

    def opt(name: str, dtype: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast(dtype)

    def side(me: str, opp: str) -> Column:
        my_r, op_r = opt(f"{me}_rating", "double"), opt(f"{opp}_rating", "double")
        return F.struct(
            opt(f"{me}_username", "string").alias("username"),
            opt(f"{me}_title", "string").alias("title"),
            opt(f"{opp}_username", "string").alias("opponent_username"),
            opt(f"{opp}_title", "string").alias("opponent_title"),
            F.lit(me).alias("color"),
            my_r.alias("rating"), op_r.alias("opponent_rating"), (my_r - op_r).alias("rating_diff"),
            opt(f"{me}_result", "string").alias("result"),
            opt(f"{me}_score", "double").alias("score"),
            opt(f"{me}_accuracy", "double").alias("accuracy"),
            opt(f"{opp}_accuracy", "double").alias("opponent_accuracy"),
            opt(f"{me}_title", "string").isNotNull().alias("is_titled_player"),
            opt(f"{opp}_title", "string").isNotNull().alias("is_titled_opponent"),
        )

    rows = games.select(*carry, *shared, F.explode(F.array(side("white", "black"), side("black", "white"))).alias("_s"))
    rows = rows.filter(X.truthy_text("_s.username"))
    return rows.select(*carry, *shared, "_s.*")


# --- B18 / B19 ----------------------------------------------------------------
def with_game_bucket(games: DataFrame, buckets: int = X.DEFAULT_BUCKETS) -> DataFrame:
    return games.withColumn("bucket", X.hash_bucket("game_uuid", buckets))


def with_fact_bucket(facts: DataFrame, buckets: int = X.DEFAULT_BUCKETS) -> DataFrame:
    return facts.withColumn("bucket", X.hash_bucket(F.concat_ws("::", "game_uuid", "username"), buckets))


# --- B20 ----------------------------------------------------------------------
def roster_rows(snapshots: DataFrame) -> DataFrame:
    """Roster documents -> one row per listed player with 1-based position."""
    return snapshots.select(
        F.col("snapshot_date").cast("string").alias("snapshot_date"), "title",
        F.posexplode("players").alias("_pos", "username"),
        F.size("players").cast("int").alias("snapshot_player_count"),
    ).select("snapshot_date", "title", "username", "snapshot_player_count",
             (F.col("_pos") + 1).cast("int").alias("snapshot_position"))


# --- whole bronze build -------------------------------------------------------
def build_bronze(feed: DataFrame, roster_members: DataFrame | None,
                 buckets: int = X.DEFAULT_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Feed documents (with raw_key) + (title, username) roster memberships ->
    (games_core, player_game_facts), both with their bucket column."""
    lookup = title_lookup(roster_members) if roster_members is not None else None
    merged = merge_games(explode_feed(feed))
    merged = merged.withColumn("white_username", F.col("white.username")).withColumn(
        "black_username", F.col("black.username"))
    if lookup is not None:
        merged = title_enrich(merged, lookup)
    merged = merged.drop("white_username", "black_username")
    games = with_game_bucket(games_core_rows(merged), buckets)
    facts = with_fact_bucket(player_rows(games), buckets)
    facts = SC.conform(facts, SC.MONTH_PARTS + SC.PLAYER_FACTS + [("bucket", SC.S)])
    return games, facts
