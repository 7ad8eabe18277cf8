"""The list of queries, and small helpers that both sides of a pair share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can state it, the SQL it must agree with."""

    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


# ---- the Spark side -------------------------------------------------------


def r(col: Column | str, digits: int = 6) -> Column:
    """Round a double for comparison (and turn -0.0 into 0.0)."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits) + F.lit(0.0)


def big(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")


def line_key() -> Column:
    """Unique in lineitem: order, line, part, supplier and the price in cents."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with a unique key and short names."""
    return table(spark, folder, "lineitem").select(
        line_key().alias("id"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.col("l_linenumber").cast("bigint").alias("num"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


def holed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with NULLs put in by rule, as the tables hold none."""
    num = F.col("num")
    return lines(spark, folder).select(
        "id",
        F.when(num % 5 != 0, F.col("qty")).alias("a"),
        F.when(num % 3 != 0, F.col("price")).alias("b"),
        F.col("disc").alias("c"),
        F.when(num % 2 != 0, F.col("tax")).alias("d"),
        F.lit(None).cast("double").alias("e"),
    )


# ---- the SQL side ---------------------------------------------------------

SQL_LINES = """(SELECT l_orderkey||'-'||l_linenumber||'-'||l_partkey||'-'||l_suppkey||'-'||CAST(round(l_extendedprice * 100) AS BIGINT) AS id,
 l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax,
 CAST(l_linenumber AS BIGINT) AS num, l_returnflag AS flag, l_linestatus AS status FROM lineitem)"""

SQL_HOLED = f"""(SELECT id, CASE WHEN num % 5 <> 0 THEN qty END AS a, CASE WHEN num % 3 <> 0 THEN price END AS b,
 disc AS c, CASE WHEN num % 2 <> 0 THEN tax END AS d, CAST(NULL AS DOUBLE) AS e FROM {SQL_LINES})"""


def sql_round(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


def sql_hash(seed: int, key: str) -> str:
    return f"md5('{seed}:'||{key})"


def sql_uniform(seed: int, key: str) -> str:
    return f"(CAST('0x'||substr(md5('{seed}:'||{key}),1,13) AS BIGINT)/4503599627370496.0)"
