"""Map the driver's TPC-H-like tables onto the four staging inputs.

The landed CSV files of the community product are not available, so the
staging tables are derived from ``customer/nation/supplier/orders/lineitem``:
customers are users, suppliers are groups (each administered by the user with
the same id), orders are messages and order lines are group-log events.
Everything is a join or an aggregate Spark plans and shuffles; nothing is
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.sources.staging import conform


def _read(spark: SparkSession, sf_dir: str, name: str, _reads: dict | None = None) -> DataFrame:
    if _reads is not None and name in _reads:
        return _reads[name]
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if _reads is not None:
        _reads[name] = df
    return df


def staging_users(spark: SparkSession, sf_dir: str, _reads: dict | None = None) -> DataFrame:
    customer = _read(spark, sf_dir, "customer", _reads)
    nation = _read(spark, sf_dir, "nation", _reads)
    first_order = (
        _read(spark, sf_dir, "orders", _reads)
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order_dt"))
    )
    df = (
        customer.join(first_order, customer.c_custkey == first_order.o_custkey, "left")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("chat_name"),
            F.col("first_order_dt").alias("registration_dt"),
            F.col("n_name").alias("country"),
            (F.col("c_custkey") % 80 + 10).alias("age"),
        )
    )
    return conform(df, "users")


def staging_groups(spark: SparkSession, sf_dir: str, _reads: dict | None = None) -> DataFrame:
    supplier = _read(spark, sf_dir, "supplier", _reads)
    first_ship = (
        _read(spark, sf_dir, "lineitem", _reads)
        .groupBy("l_suppkey")
        .agg(F.min("l_shipdate").alias("first_ship_dt"))
    )
    df = supplier.join(first_ship, supplier.s_suppkey == first_ship.l_suppkey, "left").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_suppkey").alias("admin_id"),
        F.col("s_name").alias("group_name"),
        F.col("first_ship_dt").alias("registration_dt"),
        (F.col("s_acctbal") < 0).alias("is_private"),
    )
    return conform(df, "groups")


def staging_dialogs(spark: SparkSession, sf_dir: str, _reads: dict | None = None) -> DataFrame:
    orders = _read(spark, sf_dir, "orders", _reads)
    order_group = (
        _read(spark, sf_dir, "lineitem", _reads)
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("first_suppkey"))
    )
    df = orders.join(order_group, orders.o_orderkey == order_group.l_orderkey, "left").select(
        F.col("o_orderkey").alias("message_id"),
        F.col("o_orderdate").alias("message_dt"),
        F.col("o_custkey").alias("message_from"),
        (F.col("o_custkey") + 1).alias("message_to"),
        F.col("o_orderpriority").alias("message"),
        F.col("first_suppkey").alias("message_group"),
    )
    return conform(df, "dialogs")


def staging_group_log(spark: SparkSession, sf_dir: str, _reads: dict | None = None) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem", _reads)
    orders = _read(spark, sf_dir, "orders", _reads).select("o_orderkey", "o_custkey")
    df = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("l_suppkey").alias("group_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("l_linenumber") == 1, F.lit(None))
        .otherwise(F.col("l_suppkey"))
        .alias("user_id_from"),
        F.when(F.col("l_returnflag") == "A", "add")
        .when(F.col("l_returnflag") == "R", "leave")
        .otherwise("other")
        .alias("event"),
        F.col("l_shipdate").alias("event_datetime"),
    )
    return conform(df, "group_log")


STAGING_BUILDERS = {
    "users": staging_users,
    "groups": staging_groups,
    "dialogs": staging_dialogs,
    "group_log": staging_group_log,
}


def staging_from_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four staging frames (lazy); each driver table is read once and shared."""
    reads: dict = {}
    return {name: build(spark, sf_dir, reads) for name, build in STAGING_BUILDERS.items()}
