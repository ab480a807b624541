"""Registry of queries: the Spark side, the SQL side, and the shared output rounding."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.deploy import ship_package

Run = Callable[[SparkSession, str], DataFrame]


def _nudge(digits: int) -> float:
    """Shift before rounding, far below the last digit kept.

    A mean of cents is often an exact rounding tie, which the last bit of a sum would decide; the
    shift decides it alike in both engines. The 0.0 added after rounding turns -0.0 into 0.0.
    """
    return 0.37 * 10.0 ** -(digits + 3)


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None = None
    digits: dict[str, int] = field(default_factory=dict)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """Run, rounding the named columns: the two engines add doubles in different orders."""
        ship_package(spark)
        df = self.run(spark, sf_dir)
        return df.withColumns({
            c: F.round(F.col(c) + _nudge(n), n) + 0.0 for c, n in self.digits.items()
        })

    def oracle(self) -> str | None:
        if self.sql is None or not self.digits:
            return self.sql
        rounded = ", ".join(
            f"round(CAST({c} AS DOUBLE) + {_nudge(n)!r}, {n}) + 0.0 AS {c}"
            for c, n in self.digits.items()
        )
        return f"SELECT * REPLACE ({rounded}) FROM (\n{self.sql}\n) AS result"


QUERIES: dict[str, Query] = {}


def register(name: str, run: Run, sql: str | None = None, **digits: int) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = Query(name, run, sql, digits)
