"""The input tables, and the customer and order views the business questions are about."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Order status letters of the input and the words the business rules use.
STATUS_WORDS = {"F": "completed", "O": "pending", "P": "cancelled"}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, by: str) -> DataFrame:
    """Give every core a share of a small input whose rows are dear to process, such as texts.

    An input of many files already has more parts than there are cores and stays as it is:
    moving large texts would cost more than it brings.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > 2 * cores:
        return df
    return df.repartition(cores, by)


def status_word(letter):
    word = F.lit(None).cast("string")
    for code, text in STATUS_WORDS.items():
        word = F.when(letter == code, text).otherwise(word)
    return word


def order_facts(spark: SparkSession, folder: str, timed: bool = False) -> DataFrame:
    """One row per order with the columns that need no join.

    `timed` adds `ordered_at`, the stored time, whose bounds reach the scan; those of the day computed from it do not.
    """
    return read_table(spark, folder, "orders").select(
        *([F.col("o_orderdate").alias("ordered_at")] if timed else []),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("order_amount"),
        status_word(F.col("o_orderstatus")).alias("order_status"),
    )


def customer_facts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with segment and region; nation and region are fixed small tables."""
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    customer = read_table(spark, folder, "customer")
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("r_name").alias("region"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Per order: quantity, discount and the category of its dearest line.

    The lines collapse to one row per order before `part` is joined. The closing
    aggregate changes no row; it tells the optimizer that `order_id` is unique, so a
    left join to this frame vanishes from queries that use none of its columns.
    """
    lines = read_table(spark, folder, "lineitem")
    per_order = lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.max(
            F.struct("l_extendedprice", -F.col("l_linenumber"), -F.col("l_partkey"), F.col("l_partkey").alias("part"))
        )["part"].alias("part_id"),
        F.sum("l_quantity").cast("int").alias("quantity"),
        F.try_divide(
            F.sum(F.col("l_extendedprice") * F.col("l_discount")), F.sum("l_extendedprice")
        ).alias("discount_applied"),
    )
    part = read_table(spark, folder, "part").select(F.col("p_partkey").alias("part_id"), "p_type")
    return (
        per_order.join(part, "part_id", "left")
        .groupBy("order_id")
        .agg(
            F.max("p_type").alias("product_category"),
            F.max("quantity").alias("quantity"),
            F.max("discount_applied").alias("discount_applied"),
        )
    )


def business_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The documented `orders` table."""
    regions = (
        customer_facts(spark, folder)
        .groupBy("customer_id")
        .agg(F.max("region").alias("shipping_region"))
    )
    return (
        order_facts(spark, folder)
        .join(order_lines(spark, folder), "order_id", "left")
        .join(regions, "customer_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_date",
            "order_amount",
            "order_status",
            "product_category",
            "quantity",
            "discount_applied",
            "shipping_region",
        )
    )


def business_customers(spark: SparkSession, folder: str, churn_days: int = 90) -> DataFrame:
    """The documented `customers` table; activity is measured at the last order day of the data."""
    orders = order_facts(spark, folder)
    activity = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("registration_date"),
        F.max("order_date").alias("last_order"),
        F.sum(F.when(F.col("order_status") == "completed", F.col("order_amount"))).alias("lifetime_value"),
    )
    as_of = orders.agg(F.max("order_date")).scalar()
    idle = F.datediff(as_of, F.col("last_order"))
    return (
        customer_facts(spark, folder)
        .join(activity, "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            F.lit(None).cast("string").alias("email"),
            F.lit(None).cast("string").alias("phone"),
            "registration_date",
            "customer_segment",
            "region",
            F.coalesce(idle <= churn_days, F.lit(False)).alias("is_active"),
            F.coalesce("lifetime_value", F.lit(0.0)).alias("lifetime_value"),
        )
    )


def register_business_views(spark: SparkSession, folder: str) -> list[str]:
    """Make the documented tables visible to SQL; returns their names."""
    business_customers(spark, folder).createOrReplaceTempView("customers")
    business_orders(spark, folder).createOrReplaceTempView("orders")
    return ["customers", "orders"]
