"""Applicant-like tables derived from the star schema and the document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import BAD, GOOD


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def labelled_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that carry a quality label, as (row_id, amount, lang, source, description, target)."""
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.col("n_chars").alias("amount"),
        "lang",
        "source",
        F.col("text").alias("description"),
        F.when(F.col("quality") == 1, GOOD).otherwise(BAD).alias("target"),
    )


def applicants(spark: SparkSession, folder: str, duration: bool = True) -> DataFrame:
    """One applicant per order with the nine feature columns, a request id and a target.

    ``duration`` needs the line items; queries that do not use it skip that scan and join.
    """
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    if duration:
        quantity = (
            table(spark, folder, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum("l_quantity").alias("quantity"))
        )
        rows = rows.join(quantity, "o_orderkey", "left")
    balance = F.col("c_acctbal")
    columns = {
        "row_id": F.col("o_orderkey"),
        "request_id": F.col("c_nationkey"),
        "credit_amount": F.col("o_totalprice"),
        "balance": balance,
        "duration": F.coalesce(F.col("quantity"), F.lit(0.0)) if duration else None,
        "sex": F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female"),
        "job": F.col("c_nationkey") % 4,
        "housing": F.when(F.col("c_custkey") % 3 == 0, "own").when(F.col("c_custkey") % 3 == 1, "rent").otherwise("free"),
        "saving_accounts": F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")),
        "checking_account": F.when(balance < 0, "little").when(balance < 5000, "moderate").when(balance < 9000, "rich"),
        "purpose": F.col("c_mktsegment"),
        "target": F.when(F.col("o_orderstatus") == "F", BAD).otherwise(GOOD),
    }
    return rows.select(*[c.alias(name) for name, c in columns.items() if c is not None])


def numbers_as_whole(df: DataFrame) -> DataFrame:
    """Whole-number age, credit amount and duration, as in applicant files."""
    return df.withColumns(
        {
            "age": F.floor(F.abs("balance")).cast("long") % 47 + 19,
            "credit_amount": F.floor("credit_amount").cast("long"),
            "duration": F.floor("duration").cast("long"),
        }
    )
