"""Sales fact, raw sheet and sale events built from the order, part and event tables.

Dimension keys are unique and every join is a left join, so a join that contributes no
wanted column cannot change the rows and is left out.  A daily total thus reads nothing
but the line items.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.operators.dictionary import RAW_SPECS, RAW_TO_NAME


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


# Columns of the sales fact by the table they come from, as SQL over the joined tables.
# The day-of-month shocks on production cost make every anomaly level occur.
LINE_COLUMNS = {
    "sale_date": "CAST(l_shipdate AS DATE)",
    "storage_gb": "CAST(128 * (1 + l_partkey % 4) AS INT)",
    "refresh_rate_hz": "CAST(60 + 30 * (l_partkey % 3) AS INT)",
    "os": "IF(l_partkey % 2 = 0, 'os_a', 'os_b')",
    "user_rating": "CAST(1 + l_orderkey % 5 AS INT)",
    "unit_price": "CAST(FLOOR(l_extendedprice / NULLIF(l_quantity, 0D)) AS INT)",
    "sales_qty": "CAST(l_quantity AS INT)",
    "production_cost": "l_extendedprice * CAST(35 + l_partkey % 40 AS DOUBLE) / 100D * "
    "CASE DAY(l_shipdate) WHEN 6 THEN 1.08D WHEN 13 THEN 1.2D WHEN 27 THEN 1.5D ELSE 1D END",
    "marketing_cost_total": "l_extendedprice * l_discount",
    "logistics_cost": "l_extendedprice * l_tax * 0.5D",
    "platform_commission_total": "l_extendedprice * 0.05D",
    "after_sales_cost": "IF(l_returnflag = 'R', l_extendedprice * 0.02D, NULL)",
    "case_sales": "l_extendedprice * 0.01D",
    "earphone_sales": "l_extendedprice * 0.008D",
    "charger_sales": "l_extendedprice * 0.006D",
    "cable_sales": "l_extendedprice * 0.004D",
    "screen_protector_sales": "l_extendedprice * 0.002D",
    "accessory_sales_total": "IF(l_linenumber <> 7, l_extendedprice * 0.03D, NULL)",
    "warranty_1y_sales": "l_extendedprice * 0.01D",
    "warranty_2y_sales": "l_extendedprice * 0.02D",
    "accident_insurance_sales": "l_extendedprice * 0.005D",
    "screen_insurance_sales": "l_extendedprice * 0.005D",
    "warranty_total_sales": "CAST(FLOOR(l_extendedprice * 0.04D) AS INT)",
}
PART_COLUMNS = {
    "brand": "p_brand",
    "model": "p_name",
    "processor": "p_type",
    "camera_pixel_wan": "CAST(p_size * 100 AS INT)",
    "battery_capacity_mah": "CAST(3000 + p_size * 40 AS INT)",
    "screen_size_inch": "5D + CAST(p_size AS DOUBLE) / 50D",
}
ORDER_COLUMNS = {"promotion": "IF(o_orderpriority = '4-NOT SPECIFIED', '  ', o_orderpriority)"}
CUSTOMER_COLUMNS = {
    "user_age": "IF(c_custkey % 97 <> 0, CAST(15 + c_custkey % 50 AS INT), NULL)",
    "user_gender": "IF(c_custkey % 2 = 0, 'F', 'M')",
    "user_member_level": "c_mktsegment",
}
NATION_COLUMNS = {"user_city": "n_name"}
ALL_COLUMNS = LINE_COLUMNS | PART_COLUMNS | ORDER_COLUMNS | CUSTOMER_COLUMNS | NATION_COLUMNS


def sales_fact(spark: SparkSession, root: str, columns: Iterable[str] | None = None) -> DataFrame:
    """One sale per line item, with only the joins that the wanted columns need.

    Customers and nations join the orders first: orders are the smaller side, so the line
    items cross the network once for orders and once for parts.  No side is forced to be
    broadcast; Spark does so by its own size statistics, and adaptive execution splits a
    part or customer that holds a large share of the rows.
    """
    wanted = [name for name in schemas.ODS.names if columns is None or name in set(columns)]

    def needs(*groups: dict[str, str]) -> bool:
        return any(name in group for group in groups for name in wanted)

    fact = table(spark, root, "lineitem")
    if needs(ORDER_COLUMNS, CUSTOMER_COLUMNS, NATION_COLUMNS):
        orders = table(spark, root, "orders")
        if needs(CUSTOMER_COLUMNS, NATION_COLUMNS):
            customers = table(spark, root, "customer")
            if needs(NATION_COLUMNS):
                customers = customers.join(
                    table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
                )
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        fact = fact.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if needs(PART_COLUMNS):
        fact = fact.join(table(spark, root, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return fact.selectExpr(*[f"{ALL_COLUMNS[name]} AS {name}" for name in wanted])


def sale_events(spark: SparkSession, root: str) -> DataFrame:
    """One sale event per row of the event table, time cast to a zoned timestamp."""
    quantity = F.lit(1) + F.col("user_id") % 60
    price = F.floor(F.col("value") * 100)
    worth = price * quantity
    event_id = F.col("event_id")
    return table(spark, root, "events").select(
        event_id.cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("brand"),
        F.concat(F.lit("M"), (F.col("user_id") % 9).cast("string")).alias("model"),
        F.when(event_id % 7 != 0, F.col("event_type")).alias("promotion"),
        price.cast("int").alias("unit_price"),
        quantity.cast("int").alias("sales_qty"),
        (worth * (F.lit(30) + event_id % 50).cast("double") / F.lit(100.0)).alias("production_cost"),
        (worth * (F.lit(2) * (event_id % 23)).cast("double") / F.lit(100.0)).alias("marketing_cost_total"),
    )


def sale_event_json(events: DataFrame) -> DataFrame:
    """Events as the JSON text a broker would deliver, in a ``value`` column."""
    return events.select(
        F.to_json(
            F.struct(
                F.col("event_id").alias("eventId"),
                F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("eventTime"),
                "brand",
                "model",
                "promotion",
                F.col("unit_price").alias("unitPrice"),
                F.col("sales_qty").alias("salesQty"),
                F.col("production_cost").alias("productionCost"),
                F.col("marketing_cost_total").alias("marketingCostTotal"),
            )
        ).alias("value")
    )


# Units behind the spec numbers of the raw sheet.
SPEC_UNITS = {
    "camera_pixel_wan": "万",
    "battery_capacity_mah": "mAh",
    "screen_size_inch": "英寸",
    "storage_gb": "GB",
    "refresh_rate_hz": "Hz",
}


def raw_sheet(spark: SparkSession, root: str, copies: int = 1) -> DataFrame:
    """The sales fact as the raw sheet would hold it: display names, all text, with units.

    Labels get tabs and ideographic spaces around them, whole numbers a ``.0``, and every
    row occurs ``copies`` times.
    """
    fact = sales_fact(spark, root)
    if copies > 1:
        repeats = F.explode(F.array(*[F.lit(i) for i in range(copies)]))
        fact = fact.withColumn("_copy", repeats).drop("_copy")
    display = {name: raw for raw, name in (RAW_TO_NAME | RAW_SPECS).items()}

    def as_text(name: str, dtype: str) -> Column:
        value = F.col(name)
        if name in SPEC_UNITS:
            return F.concat(value.cast("string"), F.lit(SPEC_UNITS[name]))
        if dtype == "int":
            return F.concat(value.cast("string"), F.lit(".0"))
        if dtype == "string":
            return F.concat(F.lit("\t"), value, F.lit("　"))
        return value.cast("string")

    return fact.select(*[as_text(name, dtype).alias(display[name]) for name, dtype in fact.dtypes])
