"""One column list per query, applied to both the Spark result and the SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SQL_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def fields(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in spec.split(",")]


# Decimal places of a double, unless its kind names others ("double:15").
PLACES = 6


def places(kind: str) -> int:
    return int(kind.partition(":")[2] or PLACES)


def off_edge(kind: str) -> str:
    """0.003 of the last place.

    Values such as x / 28 often lie exactly on a rounding edge, where the last bit decides;
    this moves them off it on both sides, and is too small to stand in for a value.
    """
    return f"3e-{places(kind) + 3}"


def shape(df: DataFrame, spec: str) -> DataFrame:
    """Select and cast; doubles to their number of places, without a negative zero."""
    cols = []
    for name, kind in fields(spec):
        c = F.col(name).cast(kind.partition(":")[0])
        cols.append((F.round(c + F.lit(float(off_edge(kind))), places(kind)) + F.lit(0.0) if kind.startswith("double") else c).alias(name))
    return df.select(*cols)


def shaped_sql(spec: str, ctes: str, body: str) -> str:
    cols = []
    for name, kind in fields(spec):
        c = f"CAST({name} AS {SQL_TYPES[kind.partition(':')[0]]})"
        if kind.startswith("double"):
            c = f"round({c} + {off_edge(kind)}, {places(kind)}) + CAST(0 AS DOUBLE)"
        cols.append(f"{c} AS {name}")
    head = f"WITH {ctes}\n" if ctes else ""
    return f"{head}SELECT {', '.join(cols)} FROM (\n{body}\n) AS q"
