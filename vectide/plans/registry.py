"""Registered queries: a Spark plan over the given tables and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    plans: dict[str, Plan] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None):
        def register(plan: Plan) -> Plan:
            if name in self.plans:
                raise ValueError(f"query registered twice: {name}")
            self.plans[name] = plan
            if sql is not None:
                self.sql[name] = sql
            return plan

        return register


REGISTRY = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
