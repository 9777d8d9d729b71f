"""Registry of named plans: Spark builder + DuckDB oracle + output schema.

Every plan declares its output columns once.  Both the Spark result and the
oracle SQL are projected onto that schema — same names, same casts, doubles
rounded to a fixed number of places (sums of doubles differ in the last bits
with summation order) — so the two sides compare like for like.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.numeric import round_half_up, round_half_up_sql

PLACES = 4

_SPARK_TYPES = {"string": "string", "double": "double", "bigint": "bigint", "date": "string"}
_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "date": "VARCHAR"}


@dataclass(frozen=True)
class Plan:
    name: str
    ops: str
    build: Callable[[SparkSession, str], DataFrame]
    schema: tuple[tuple[str, str], ...]
    sql: str | None
    places: int = PLACES


REGISTRY: dict[str, Plan] = {}

_MODULES = ("cleaning", "customers", "inventory", "demand", "quality", "decisions",
            "models", "model_forecasts", "streams")


def parse_schema(schema: str) -> tuple[tuple[str, str], ...]:
    """``name type`` pairs; ``double:N`` rounds that column to N places
    (quantile outputs of 4-place data are exact at 8 places)."""
    out = []
    for part in schema.split(","):
        name, typ = part.split()
        if typ.split(":")[0] not in _SPARK_TYPES:
            raise ValueError(f"unsupported output type {typ!r} for {name}")
        out.append((name, typ))
    return tuple(out)


def _places(typ: str, default: int) -> int:
    return int(typ.split(":")[1]) if ":" in typ else default


def register(name: str, ops: str, schema: str, sql: str | None = None, places: int = PLACES):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate plan {name}")
        REGISTRY[name] = Plan(name, ops, fn, parse_schema(schema), sql, places)
        return fn
    return deco


def conform_output(df: DataFrame, schema, places: int = PLACES) -> DataFrame:
    cols = []
    for name, typ in schema:
        c = F.col(name)
        if typ.startswith("double"):
            c = round_half_up(c.cast("double"), _places(typ, places)) + F.lit(0.0)
        elif typ == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        else:
            c = c.cast(_SPARK_TYPES[typ])
        cols.append(c.alias(name))
    return df.select(*cols)


def conform_sql(sql: str, schema, places: int = PLACES) -> str:
    cols = []
    for name, typ in schema:
        q = f'q."{name}"'
        if typ.startswith("double"):
            cols.append(f'CAST({round_half_up_sql(f"CAST({q} AS DOUBLE)", _places(typ, places))} + 0.0 AS DOUBLE) AS "{name}"')
        elif typ == "date":
            cols.append(f'strftime(CAST({q} AS DATE), \'%Y-%m-%d\') AS "{name}"')
        else:
            cols.append(f'CAST({q} AS {_SQL_TYPES[typ]}) AS "{name}"')
    return f"SELECT {', '.join(cols)}\nFROM (\n{sql}\n) AS q"


def load_all() -> dict[str, Plan]:
    for m in _MODULES:
        importlib.import_module(f"tillroll.plans.{m}")
    return REGISTRY


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plans = load_all()

    def make(p: Plan):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return conform_output(p.build(spark, sf_dir), p.schema, p.places)
        run.__name__ = p.name
        return run
    return {name: make(p) for name, p in plans.items()}


def oracle_queries() -> dict[str, str]:
    plans = load_all()
    return {name: conform_sql(p.sql, p.schema, p.places) for name, p in plans.items() if p.sql}
