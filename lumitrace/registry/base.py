"""Registration and the rounding both engines share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumitrace.functions.display import round_to

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is the equivalent statement, if there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded half-up, integers as long."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_to(c.cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def rnd(expr: str, digits: int = 6) -> str:
    """SQL form of `round_to`."""
    scale = f"1e{digits}::DOUBLE"
    return f"(floor(({expr})::DOUBLE * {scale} + 0.5::DOUBLE) / {scale})"


def rnds(*names: str, digits: int = 6, table: str = "") -> str:
    """Rounded columns under their own names."""
    dot = f"{table}." if table else ""
    return ", ".join(f"{rnd(dot + n, digits)} AS {n}" for n in names)


def sep_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """SQL form of the separation in degrees."""
    d = f"radians(({dec1}) - ({dec2})) / 2"
    a = f"radians(({ra1}) - ({ra2})) / 2"
    return (
        f"degrees(2 * asin(least(1.0::DOUBLE, sqrt(sin({d}) * sin({d}) + cos(radians({dec1})) * cos(radians({dec2})) "
        f"* sin({a}) * sin({a})))))"
    )


def lifted_sql(ra: str) -> str:
    return f"(CASE WHEN {ra} <= 0.1::DOUBLE THEN {ra} + 360.0::DOUBLE ELSE {ra} END)"
