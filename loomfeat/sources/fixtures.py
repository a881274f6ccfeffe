"""Map the driver's parquet tables onto the reference's table roles (FIXTURES.md part 2).

| role (reference)              | driver table            |
| ----------------------------- | ----------------------- |
| application (entity spine)    | customer                |
| bureau / previous application | orders                  |
| bureau balance                | lineitem                |
| instalment payments           | lineitem joined orders  |
| POS / card monthly history    | events                  |
| labelled rows for encoders    | documents left-join labels |

Every role is a lazy DataFrame: projections and filters applied later are
pushed into the parquet scans by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeat.functions.exprs import days_offset
from loomfeat.sources.io import read_table

# Fixed values of the mapping (reference dates that make every offset <= 0).
ORDERS_REF_DATE = "2001-08-02"
INSTALMENT_REF_DATE = "2001-11-05"
INSTALMENT_DUE_SHIFT_DAYS = 60
EVENTS_REF_TS = "2024-01-31"
OVERDUE_RETURNFLAG = "R"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity spine: one row per ``c_custkey``; ``target`` = negative balance."""
    c = table(spark, sf_dir, "customer")
    return c.withColumn("target", (F.col("c_acctbal") < 0).cast("int"))


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan table: entity ``o_custkey``, loan ``o_orderkey``, status, category, amount, day offset."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn("o_days", days_offset("o_orderdate", ORDERS_REF_DATE))


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly loan status table: loan ``l_orderkey``, status ``l_returnflag``."""
    return table(spark, sf_dir, "lineitem")


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instalment payments: one row per line item, enriched with its order's customer."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey"),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        (F.col("l_quantity").cast("int") % 4).alias("i_version"),
        F.col("l_extendedprice").alias("i_due"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("i_paid"),
        (days_offset("o_orderdate", INSTALMENT_REF_DATE) + F.lit(INSTALMENT_DUE_SHIFT_DAYS)).alias("i_days_due"),
        days_offset("l_shipdate", INSTALMENT_REF_DATE).alias("i_days_paid"),
    )


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly history: entity ``user_id``, loan ``event_type``, amount ``value``, offset ``e_days``."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("e_days", days_offset("ts", EVENTS_REF_TS))


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for encoders and metrics: documents with ``quality`` (NULL = unlabelled)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")
