"""Declared schemas of every table (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, L, B, DT = (T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType())
SA = T.ArrayType(T.StringType())
#: Directory of a null value of a partition column.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- raw landing zone -------------------------------------------------------
SIDE = struct([("username", S), ("rating", S), ("result", S)])
# Fields of uncertain JSON type (end_time, rating) are read as text and coerced
# afterwards; a wrong-typed field then nulls one value, not the whole document.
GAME = struct([
    ("uuid", S), ("url", S), ("end_time", S), ("time_class", S), ("time_control", S), ("rated", B),
    ("rules", S), ("eco", S), ("initial_setup", S), ("fen", S), ("pgn", S), ("tcn", S),
    ("accuracies", S), ("white", SIDE), ("black", SIDE),
])
# In files ``accuracies`` is read as a variant, which tells an object from a
# text that holds one; in ``GAME`` it is JSON text.
GAME_IN_FILE = struct([(f.name, T.VariantType() if f.name == "accuracies" else f.dataType) for f in GAME.fields])
FEED_DOC = struct([
    ("username", S), ("year", S), ("month", S), ("month_key", S), ("game_count", I),
    ("games", T.ArrayType(GAME)),
])
FEED_FILE = struct([(f.name, T.ArrayType(GAME_IN_FILE) if f.name == "games" else f.dataType) for f in FEED_DOC.fields])
ROSTER_DOC = struct([("title", S), ("snapshot_date", S), ("player_count", I), ("players", SA)])
ARCHIVE_DOC = struct([("title", S), ("username", S), ("snapshot_date", S), ("archive_count", I), ("archives", SA)])

# --- bronze -----------------------------------------------------------------
GAMES_CORE = [
    ("game_uuid", S), ("game_url", S), ("game_date", S), ("end_time_utc", S), ("time_class", S),
    ("time_control", S), ("rated", B), ("rules", S), ("opening_url", S), ("opening_name", S),
    ("initial_setup", S), ("fen", S), ("has_pgn", B), ("has_tcn", B), ("has_accuracies", B),
    ("white_username", S), ("white_title", S), ("white_rating", D), ("white_result", S), ("white_score", D),
    ("white_accuracy", D), ("black_username", S), ("black_title", S), ("black_rating", D), ("black_result", S),
    ("black_score", D), ("black_accuracy", D), ("winner_color", S), ("source_key_count", I),
    ("source_player_count", I), ("source_player_usernames", SA),
]
FACT_SHARED = [
    ("game_uuid", S), ("game_url", S), ("game_date", S), ("end_time_utc", S), ("time_class", S),
    ("time_control", S), ("rated", B), ("rules", S), ("opening_url", S), ("opening_name", S),
    ("winner_color", S), ("has_pgn", B), ("has_tcn", B), ("has_accuracies", B),
]
FACT_SIDE = [
    ("username", S), ("title", S), ("opponent_username", S), ("opponent_title", S), ("color", S),
    ("rating", D), ("opponent_rating", D), ("rating_diff", D), ("result", S), ("score", D),
    ("accuracy", D), ("opponent_accuracy", D), ("is_titled_player", B), ("is_titled_opponent", B),
]
PLAYER_FACTS = FACT_SHARED + FACT_SIDE
ROSTER_DAILY = [("username", S), ("snapshot_player_count", I), ("snapshot_position", I)]

MONTH_PARTS = [("year", S), ("month", S)]
BUCKET_PARTS = MONTH_PARTS + [("bucket", S)]
ROSTER_PARTS = [("snapshot_date", S), ("title", S)]

# --- staging (typed projection of bronze + month_key) ------------------------
STG_GAMES = [("year", S), ("month", S), ("month_key", S), ("bucket", S)] + GAMES_CORE
STG_FACTS = [("year", S), ("month", S), ("month_key", S), ("bucket", S)] + PLAYER_FACTS
STG_ROSTER = [("snapshot_date", S), ("title", S), ("username", S), ("snapshot_player_count", I),
              ("snapshot_position", I)]

# --- control state ----------------------------------------------------------
TS = T.TimestampType()
PLAYER_STATE = [
    ("username", S), ("title", S), ("status", S), ("first_seen_snapshot_date", S),
    ("last_seen_snapshot_date", S), ("removed_snapshot_date", S), ("archive_last_checked_at", TS),
    ("archive_hash", S), ("archive_snapshot_key", S), ("latest_archive_month", S),
    ("has_current_month_archive", B), ("current_month_key", S), ("current_month_etag", S),
    ("current_month_last_modified", S), ("current_month_game_key", S), ("current_month_game_count", I),
    ("last_game_sync_at", TS), ("backfill_pending", B), ("backfill_pending_count", I), ("player_index_key", S),
]
TITLE_STATE = [("title", S), ("latest_snapshot_date", S), ("last_snapshot_key", S), ("last_updated_at", TS)]
PLAYER_INDEX = [
    ("username", S), ("stored_months", SA), ("archive_months", SA), ("pending_backfill_months", SA),
    ("latest_archive_snapshot_key", S), ("updated_at", TS),
]


def names(fields: list[tuple[str, T.DataType]]) -> list[str]:
    return [n for n, _ in fields]


def conform(df: DataFrame, fields: list[tuple[str, T.DataType]], fill: dict[str, Column] | None = None) -> DataFrame:
    """Project ``df`` onto ``fields`` in order: cast present columns, add typed
    nulls (or the given expressions) for missing ones."""
    fill = fill or {}
    have = set(df.columns)
    cols = []
    for name, dtype in fields:
        if name in fill:
            cols.append(fill[name].cast(dtype).alias(name))
        elif name in have:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)
