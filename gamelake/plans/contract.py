"""Registry of contract queries: a Spark builder and, where SQL can say the
same thing, the DuckDB text it must agree with.

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the given
tables (or data Spark derives from them). Oracle texts are assembled from
named SQL blocks with their dependencies, so each block is written once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gamelake.sources import fixtures

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    build: Builder
    oracle: str | None


REGISTRY: dict[str, Entry] = {}

# name -> (dependencies, SQL body). Fixture views are blocks too.
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}


def block(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    BLOCKS[name] = (deps, sql)


def _resolve(names, seen: list[str]) -> None:
    for n in names:
        if n in seen:
            continue
        if n in fixtures.VIEWS:
            seen.append(n)
            continue
        deps, _ = BLOCKS[n]
        _resolve(deps, seen)
        seen.append(n)


def oracle(final_sql: str, *needs: str) -> str:
    order: list[str] = []
    _resolve(needs, order)
    parts = []
    for n in order:
        if n in fixtures.VIEWS:
            text = fixtures.VIEWS[n].format(**{t: t for t in fixtures.BASE_TABLES})
        else:
            text = BLOCKS[n][1]
        parts.append(f"{n} as (\n{text.strip()}\n)")
    head = ("with " + ",\n".join(parts) + "\n") if parts else ""
    return head + final_sql.strip()


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate contract query {name}")
        REGISTRY[name] = Entry(fn, oracle_sql)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the modules fills the registry.
    from gamelake.plans import (  # noqa: F401
        q_bronze, q_cycle, q_explore, q_layout, q_months, q_silver_gold, q_state,
    )
    return REGISTRY
