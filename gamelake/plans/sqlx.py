"""DuckDB SQL snippets for the oracle texts, one per shared Spark expression.

They state in SQL what ``functions.exprs`` states with Columns, so the oracle
texts below read like the source system's own SQL.
"""

from __future__ import annotations

from gamelake.functions.exprs import DRAW_RESULTS, TITLES


def quote_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def bucket(expr: str, n: int = 16) -> str:
    return f"printf('%02d', (('0x' || substr(md5({expr}), 1, 8))::BIGINT % {max(n, 1)})::INT)"


def pair_bucket(expr: str) -> str:
    return f"substr(md5({expr}), 1, 2)"


def opening_name(u: str) -> str:
    p = f"regexp_replace({u}, '[?#].*$', '')"
    p = f"regexp_replace({p}, '^([A-Za-z][A-Za-z0-9+.\\-]*:)?(//[^/]*)?', '')"
    p = f"regexp_replace({p}, ';[^/]*$', '')"
    p = f"regexp_replace({p}, '/+$', '')"
    return (f"case when {u} is not null and {u} <> '' and {p} <> '' "
            f"then replace(regexp_extract({p}, '([^/]*)$', 1), '-', ' ') end")


def winner_color(w: str, b: str) -> str:
    return (f"case when {w} is null or {b} is null then null when {w} = {b} then 'draw' "
            f"when {w} > {b} then 'white' else 'black' end")


def result_score(r: str) -> str:
    return (f"case when {r} is null or {r} = '' then null when {r} = 'win' then 1.0e0 "
            f"when {r} in ({quote_list(DRAW_RESULTS)}) then 0.5e0 else 0.0e0 end")


def epoch_to_iso(x: str) -> str:
    secs = f"(case when regexp_full_match(trim({x}), '[+-]?[0-9]+') then try_cast(trim({x}) as bigint) end)"
    return (f"case when {secs} between -62135596800 and 253402300799 "
            f"then strftime(to_timestamp({secs}), '%Y-%m-%dT%H:%M:%S') || '+00:00' end")


def coerce_number(x: str) -> str:
    return f"try_cast(trim({x}) as double)"


def truthy(x: str) -> str:
    return f"coalesce(length({x}) > 0, false)"


def round_like(x: str, n: int) -> str:
    # DuckDB rounds doubles by scaling in binary; + 0.0 folds -0.0 into 0.0.
    return f"(round({x}, {n}) + 0.0)"


def title_priority(t: str) -> str:
    return f"list_position([{quote_list(TITLES)}], {t})"


def round_stable(x: str, n: int, guard: int = 9) -> str:
    return f"(round(round({x}, {guard}) + 0.0, {n}) + 0.0)"
