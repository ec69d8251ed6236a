"""Registry of named queries: a Spark builder and, where SQL can express
it, the DuckDB twin used as the correctness oracle.

Every builder takes (spark, sf_dir) and reads the given tables (or data
Spark derives from them), so its work grows with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: decimals kept for floating-point outputs on both sides
DIGITS = 6


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    round_cols: Sequence[str] = field(default_factory=tuple)
    operators: Sequence[str] = field(default_factory=tuple)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.round_cols:
            df = df.select(*[
                F.round(F.col(f"`{c}`"), DIGITS).alias(c) if c in set(self.round_cols)
                else F.col(f"`{c}`") for c in df.columns])
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.round_cols:
            return self.sql
        repl = ", ".join(f'round("{c}", {DIGITS}) AS "{c}"' for c in self.round_cols)
        return f"SELECT * REPLACE ({repl}) FROM (\n{self.sql}\n) AS __q"


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, round_cols: Sequence[str] = (),
          operators: Sequence[str] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(round_cols), tuple(operators))
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # importing the modules fills the registry
    from cohortlens.plans import (  # noqa: F401
        q_profile, q_prep, q_metrics, q_models, q_neighbors, q_ensemble, q_explain, q_score, q_sources, q_missing,
        q_fixed_models,
    )
    return REGISTRY
