"""Small constant tables as plan literals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return repr(value)


def literal_table(spark: SparkSession, rows: Iterable[tuple], columns: str) -> DataFrame:
    """Constant rows with ``columns`` as "name type, name type".

    Unlike ``createDataFrame`` over a Python list this is a local relation: the planner knows its
    rows and size, and a join with it needs no job to collect the side.
    """
    fields = [part.split() for part in columns.split(",")]
    values = ", ".join("(" + ", ".join(map(_sql_literal, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST(c{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields))
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS rows({names})")
