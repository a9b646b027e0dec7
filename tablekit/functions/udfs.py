"""The UDF surface.

* ``register_sql_functions`` defines SQL functions (``CREATE TEMPORARY
  FUNCTION ... RETURN expr``). Catalyst inlines them, so they run inside
  whole-stage codegen -- no Python worker.
* ``wheel_slot`` is a vectorized (Arrow batch) Python function.
* ``pick_one`` is the zero-argument random choice, as a seeded built-in
  expression instead of a Python UDF.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

def register_sql_functions(spark: SparkSession) -> None:
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION pair_count(n BIGINT) "
              "RETURNS BIGINT RETURN n * (n + 1) div 2")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION doubled_all(v ARRAY<INT>) "
              "RETURNS ARRAY<INT> RETURN transform(v, x -> 2 * x)")


# Python workers need not import this package to run the UDFs defined here:
# their functions travel by value with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _wheel_slot(n: pd.Series) -> pd.Series:
    """Slot 0..36 that a number lands on, turning 17 slots a step."""
    return (17 * n + 5) % 37


wheel_slot = F.pandas_udf(_wheel_slot, returnType=LongType())


def register_wheel_slot(spark: SparkSession, name: str = "wheel_slot") -> None:
    spark.udf.register(name, wheel_slot)


def pick_one(values: list[str], seed: int) -> Column:
    """Uniform random pick from ``values`` (seeded, so a re-run task gives the
    same picks for the same partitioning)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(F.rand(seed) * len(values)) + 1).cast("int"))
