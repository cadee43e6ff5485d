"""Panels derived from the order and event tables.

Money is summed as decimals: the result then does not depend on the order in
which tasks finish, so a rerun after a lost executor gives the same panel. Rows without a date
are in no period; a period outside a panel's bounds raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.scalars import ratio
from panelkit.spec import YEAR_MAX, YEAR_MIN, PanelSpec

#: Months are counted as year * 12 + month, days as days since 1970-01-01.
MONTHS = (YEAR_MIN * 12 + 1, YEAR_MAX * 12 + 12)
DAYS = (-25567, 47846)

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

NATION_MONTH = PanelSpec(
    target="log_sales", features=("log_orders", "urgent_share", "open_share"), period_bounds=MONTHS
)
CUSTOMER_YEAR = PanelSpec(
    target="log_sales",
    features=("n_orders", "urgent_share", "log_ticket_f", "log_ticket_o"),
    period_bounds=(YEAR_MIN, YEAR_MAX),
)
CUSTOMER_DAY = PanelSpec(target="log_sales", features=("urgent_share",), period_bounds=DAYS)
USER_DAY = PanelSpec(features=EVENT_TYPES, period_bounds=DAYS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _share(condition: Column) -> Column:
    return ratio(F.sum(condition.cast("bigint")), F.count(F.lit(1)))


def _log_sum(c: Column) -> Column:
    return F.log(F.sum(c).cast("double"))


def nation_month(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per nation and month: a balanced panel with a region column.

    Only five columns of the orders are read and joined to two of the
    customers. A customer with a large part of all orders is split by adaptive
    skew handling, and the group-by sums map-side down to nations x months.
    """
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("entity"), F.col("r_name").alias("region")
    )
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    sales = (
        orders.select(
            "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus",
            month.cast("int").alias("period"),
        )
        .where("period is not null")
        .withColumn("period", NATION_MONTH.checked_time())
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "period")
        .agg(
            _log_sum(_money("o_totalprice")).alias("log_sales"),
            F.count(F.lit(1)).alias("n_orders"),
            _share(F.col("o_orderpriority") == "1-URGENT").alias("urgent_share"),
            _share(F.col("o_orderstatus") == "O").alias("open_share"),
        )
    )
    return sales.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "entity",
        "region",
        "period",
        "log_sales",
        F.log(F.col("n_orders").cast("double")).alias("log_orders"),
        "urgent_share",
        "open_share",
    )


def customer_year(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per customer and year: a gappy panel whose ticket sizes may be null."""
    orders = table(spark, folder, "orders")

    def ticket(status: str) -> Column:
        chosen = F.when(F.col("o_orderstatus") == status, _money("o_totalprice"))
        mean = ratio(F.sum(chosen), F.count(chosen))
        return F.log(F.when(mean > 0, mean))

    return (
        orders.select(
            F.col("o_custkey").alias("entity"),
            F.year("o_orderdate").cast("int").alias("period"),
            "o_totalprice",
            "o_orderpriority",
            "o_orderstatus",
        )
        .where("period is not null")
        .withColumn("period", CUSTOMER_YEAR.checked_time())
        .groupBy("entity", "period")
        .agg(
            _log_sum(_money("o_totalprice")).alias("log_sales"),
            F.count(F.lit(1)).cast("double").alias("n_orders"),
            _share(F.col("o_orderpriority") == "1-URGENT").alias("urgent_share"),
            ticket("F").alias("log_ticket_f"),
            ticket("O").alias("log_ticket_o"),
        )
    )


def customer_day(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per customer and day: few rows for each of very many periods."""
    orders = table(spark, folder, "orders")
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date"))
    return (
        orders.select(
            F.col("o_custkey").alias("entity"), day.cast("int").alias("period"), "o_totalprice", "o_orderpriority"
        )
        .where("period is not null")
        .withColumn("period", CUSTOMER_DAY.checked_time())
        .groupBy("entity", "period")
        .agg(
            _log_sum(_money("o_totalprice")).alias("log_sales"),
            _share(F.col("o_orderpriority") == "1-URGENT").alias("urgent_share"),
        )
    )


def user_day(spark: SparkSession, folder: str) -> DataFrame:
    """Event value per user and day, a column per event type; null if none occurred."""
    events = table(spark, folder, "events")
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    return (
        events.select(
            F.col("user_id").alias("entity"), day.cast("int").alias("period"), "event_type", "value"
        )
        .where("period is not null")
        .withColumn("period", USER_DAY.checked_time())
        .groupBy("entity", "period")
        .agg(
            *[
                F.sum(F.when(F.col("event_type") == e, _money("value"))).cast("double").alias(e)
                for e in EVENT_TYPES
            ]
        )
    )


def sales_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per nation with a column per year: the shape of a raw indicator file."""
    year = F.floor((F.col("period") - 1) / 12).cast("int")
    by_year = nation_month(spark, folder).withColumn("year", year)
    years = [r["year"] for r in by_year.select("year").distinct().orderBy("year").collect()]
    return (
        by_year.groupBy(F.col("entity").alias("Country Name"))
        .pivot("year", years)
        .agg(F.avg("log_sales"))
    )
