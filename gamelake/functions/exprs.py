"""Column expressions shared by the layers.

Every function returns a ``Column`` built from Spark built-ins, so it stays in
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's, in its own order.
# ---------------------------------------------------------------------------
# Title codes in priority order (a player on two rosters takes the first).
TITLES = ("GM", "WGM", "IM", "WIM", "FM", "WFM", "NM", "WNM", "CM", "WCM")
# Result codes that score as a draw; "win" scores 1, any other non-empty code 0.
DRAW_RESULTS = ("agreed", "repetition", "stalemate", "insufficient", "50move", "timevsinsufficient")
# Default number of hash buckets per month in bronze.
DEFAULT_BUCKETS = 16
# ISO-8601 text as written by the feed normaliser, e.g. 2026-01-01T00:00:00+00:00.
ISO_UTC_PATTERN = "yyyy-MM-dd'T'HH:mm:ssxxx"
# Epoch seconds representable as a calendar date with a four-digit year.
EPOCH_MIN, EPOCH_MAX = -62135596800, 253402300799


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


# --- B7 / B8 -----------------------------------------------------------------
def result_score(result: str | Column) -> Column:
    """Result code -> score: empty/null -> null, win -> 1, draw codes -> 0.5, else 0."""
    r = col(result)
    return (
        F.when(r.isNull() | (r == ""), _null("double"))
        .when(r == "win", F.lit(1.0))
        .when(r.isin(*DRAW_RESULTS), F.lit(0.5))
        .otherwise(F.lit(0.0))
    )


def winner_color(white_score: str | Column, black_score: str | Column) -> Column:
    w, b = col(white_score), col(black_score)
    return (
        F.when(w.isNull() | b.isNull(), _null("string"))
        .when(w == b, F.lit("draw"))
        .when(w > b, F.lit("white"))
        .otherwise(F.lit("black"))
    )


# --- B9 / B10 / B11 ----------------------------------------------------------
def epoch_to_iso(value: str | Column) -> Column:
    """Lenient epoch seconds (text) -> ISO-8601 UTC text; bad values -> null.

    Needs ``spark.sql.session.timeZone=UTC`` (set by ``session.configure``).
    """
    secs = col(value).cast("string").try_cast("bigint")
    ok = secs.between(EPOCH_MIN, EPOCH_MAX)
    return F.when(ok, F.date_format(F.timestamp_seconds(secs), ISO_UTC_PATTERN))


def iso_to_date_text(iso: str | Column) -> Column:
    c = col(iso)
    return F.when(c.isNotNull() & (c != ""), F.substring(c, 1, 10))


def coerce_number(value: str | Column) -> Column:
    """null / '' / unparsable -> null, else the number as double."""
    return F.trim(col(value).cast("string")).try_cast("double")


# --- B12 ---------------------------------------------------------------------
def opening_name(url: str | Column) -> Column:
    """Opening URL -> its last path segment with '-' as spaces; no path -> null.

    Pure regex (no URL parser): drop query/fragment, params of the last
    segment, scheme and authority, then trailing slashes.
    """
    u = col(url)
    p = F.regexp_replace(u, r"[?#].*$", "")
    p = F.regexp_replace(p, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/]*)?", "")
    p = F.regexp_replace(p, r";[^/]*$", "")
    p = F.regexp_replace(p, r"/+$", "")
    last = F.regexp_extract(p, r"([^/]*)$", 1)
    return F.when(u.isNotNull() & (u != "") & (p != ""), F.replace(last, F.lit("-"), F.lit(" ")))


# --- B13 / B14 ---------------------------------------------------------------
def truthy_text(value: str | Column) -> Column:
    c = col(value)
    return F.coalesce(F.length(c) > 0, F.lit(False))


def accuracies_map(raw_json: str | Column) -> Column:
    """Raw accuracies JSON text -> map; anything but an object -> null."""
    return F.from_json(col(raw_json), "map<string,string>")


def has_entries(found: str | Column) -> Column:
    return F.coalesce(F.size(col(found)) > 0, F.lit(False))


def has_accuracies(raw_json: str | Column) -> Column:
    return has_entries(accuracies_map(raw_json))


def entry_number(found: str | Column, side: str) -> Column:
    return coerce_number(F.element_at(col(found), F.lit(side)))


def accuracy_of(raw_json: str | Column, side: str) -> Column:
    return entry_number(accuracies_map(raw_json), side)


# --- B18 / D9 ----------------------------------------------------------------
def hash_bucket(value: str | Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """First 8 hex digits of md5, mod ``buckets`` (at least 1), as 2-digit text."""
    n = max(int(buckets), 1)
    h = F.conv(F.substring(F.md5(col(value)), 1, 8), 16, 10).cast("bigint") % F.lit(n)
    text = F.when(h < 10, F.concat(F.lit("0"), h.cast("string"))).otherwise(h.cast("string"))
    return F.coalesce(text, F.lit("null"))


def pair_bucket(pair_key: str | Column) -> Column:
    return F.substring(F.md5(col(pair_key)), 1, 2)


# --- C4 / C5 / C6 ------------------------------------------------------------
def month_key(year: str | Column = "year", month: str | Column = "month") -> Column:
    return F.concat(col(year).cast("string"), F.lit("-"), F.lpad(col(month).cast("string"), 2, "0"))


def month_filter(month: str | None = None, months: Sequence[str] | None = None,
                 year: str | Column = "year", month_col: str | Column = "month") -> Column:
    """Single month, a list of months, or no filter; stays a partition filter."""
    key = month_key(year, month_col)
    if month:
        return key == F.lit(month)
    if months:
        return key.isin(list(months))
    return F.lit(True)


def snapshot_filter(snapshot_date: str | None = None, column: str | Column = "snapshot_date") -> Column:
    if snapshot_date:
        return col(column).cast("string") == F.lit(snapshot_date)
    return F.lit(True)


# --- rounding parity ---------------------------------------------------------
def round_like(value: str | Column, digits: int) -> Column:
    """Round by scaling in binary (x * 10^n, half away from zero, / 10^n).

    Plain ``round`` goes through decimals and differs on binary ties such as
    1.005; this form gives the values the marts are defined with.
    """
    scale = float(10 ** digits)
    return F.round(col(value) * F.lit(scale), 0) / F.lit(scale)


def round_stable(value: str | Column, digits: int, guard: int = 9) -> Column:
    """``round_like`` for means of means: the sum's last bits depend on the
    order rows are added in (partitioning), so the value is first settled at
    ``guard`` digits; a result on a rounding tie is then the same every run."""
    return round_like(round_like(value, guard), digits)


def rint_bigint(value: str | Column) -> Column:
    """double -> bigint rounding half to even (not truncation)."""
    return F.rint(col(value)).cast("bigint")


# --- E9 ----------------------------------------------------------------------
def normalize_name(value: str | Column) -> Column:
    return F.lower(F.trim(col(value)))


# --- F5 / F6 -----------------------------------------------------------------
def archive_month(url: str | Column) -> Column:
    """Archive URL -> 'YYYY-MM' from its last two path parts (month zero-padded)."""
    parts = F.split(F.regexp_replace(col(url), r"/+$", ""), "/")
    ok = F.size(parts) >= 2
    m = F.try_element_at(parts, F.lit(-1))
    # Zero-pad to two characters, never cut a longer part.
    m = F.when(F.length(m) >= 2, m).otherwise(F.lpad(m, 2, "0"))
    return F.when(ok, F.concat(F.try_element_at(parts, F.lit(-2)), F.lit("-"), m))


def month_list_hash(months: str | Column) -> Column:
    """sha256 of the month list rendered as a JSON array with ', ' separators."""
    m = col(months)
    body = F.when(F.size(m) > 0, F.concat(F.lit('["'), F.array_join(m, '", "'), F.lit('"]'))).otherwise(F.lit("[]"))
    return F.sha2(body, 256)
