"""The supplied tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions import column
from quillon.plans.funding import add_label
from quillon.session import materialize, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as projects: posted on the order date, funded on the last ship date (missing without lines).

    Not written out: a query reads the columns and joins it needs. Queries that read it more than once
    keep the columns they use (``kept_projects``).
    """
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("funded"))
    people = (
        table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("c_mktsegment").alias("poverty"), F.col("n_name").alias("state"),
                F.col("r_name").alias("metro"), F.col("c_acctbal").alias("balance"))
    )
    orders = spread(table(spark, sf_dir, "orders"))
    joined = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        people, F.col("o_custkey") == F.col("c_custkey"), "left")
    named = joined.select(
        F.col("o_orderkey").alias("projectid"), F.col("o_custkey").alias("teacher"), F.col("o_orderdate").alias("posted"),
        "funded", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("grade"),
        F.col("o_orderstatus").alias("resource"), "poverty", "state", "metro", "balance")
    return add_label(named, "posted", "funded")


def kept_projects(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The given columns of the projects, joined once and written out."""
    return materialize(projects(spark, sf_dir).select(*columns))


# The same view for the SQL side.
PROJECTS_SQL = """
projects AS (
  SELECT o_orderkey AS projectid, o_custkey AS teacher, o_orderdate AS posted, funded, o_totalprice AS price,
         o_orderpriority AS grade, o_orderstatus AS resource, c_mktsegment AS poverty, n_name AS state,
         r_name AS metro, c_acctbal AS balance,
         CAST(floor((epoch_us(funded) - epoch_us(o_orderdate)) / 86400000000.0) AS BIGINT) AS days,
         coalesce(floor((epoch_us(funded) - epoch_us(o_orderdate)) / 86400000000.0) > 60, false) AS late
  FROM orders
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS funded FROM lineitem GROUP BY 1) s ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)
"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score with many ties, the label, and the year as the group."""
    p = projects(spark, sf_dir)
    return p.select("projectid", F.year("posted").alias("year"), F.floor(F.col("price") / 1000).cast("double").alias("score"),
                    F.col("not_fully_funded_60days").alias("late"))


SCORES_SQL = PROJECTS_SQL + """,
scores AS (
  SELECT projectid, CAST(year(posted) AS INT) AS year, CAST(floor(price / 1000) AS DOUBLE) AS score,
         CAST(late AS INT) AS late FROM projects)
"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits: sums may be added up in another order elsewhere."""
    def tidy(field: T.StructField) -> Column:
        c = column(field.name)
        return F.round(c, digits).alias(field.name) if isinstance(field.dataType, T.DoubleType) else c

    return df.select(*[tidy(f) for f in df.schema.fields])
