"""Every query of the engine's own operators, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FLAGSHIP = "stage_state_latest"


def register(name: str, sql: str | None = None):
    """Decorator: adds a query under a name, and its SQL where SQL can express it."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register(
    "pricing_summary",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n_items FROM lineitem
       GROUP BY l_returnflag, l_linestatus""",
)
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n_items"))
