"""Sale events from broker messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import schemas

# JSON field names of a sale event and their column names.
FIELD_NAMES = {
    "eventId": "event_id",
    "storageGb": "storage_gb",
    "unitPrice": "unit_price",
    "salesQty": "sales_qty",
    "productionCost": "production_cost",
    "marketingCostTotal": "marketing_cost_total",
    "userCity": "user_city",
    "userAge": "user_age",
    "userGender": "user_gender",
    "userMemberLevel": "user_member_level",
}


def event_time(text: Column) -> Column:
    """ISO text, or the ``[y,M,d,H,m,s,nanos]`` array some JSON writers produce."""
    fields = F.from_json(text, "array<int>")

    def field(position: int) -> Column:
        return F.coalesce(F.get(fields, F.lit(position)), F.lit(0))

    seconds = field(5).cast("decimal(16,6)") + F.floor(field(6) / F.lit(1000)).cast("decimal(16,6)") / F.lit(1000000)
    built = F.try_make_timestamp(
        years=field(0), months=field(1), days=field(2), hours=field(3), mins=field(4), secs=seconds
    )
    is_array = F.trim(text).startswith("[") & (F.size(fields) >= 3)
    return F.when(is_array, built).otherwise(text.try_cast("timestamp"))


def parse_events(messages: DataFrame) -> DataFrame:
    """Columns of the events in ``value``; a malformed message gives a row of NULLs."""
    event = F.from_json(F.col("value").cast("string"), schemas.SALE_EVENT)
    fields = messages.select(event.alias("e")).select("e.*")
    timed = fields.withColumn("eventTime", event_time(F.col("eventTime")))
    return timed.withColumnsRenamed({"eventTime": "event_time", **FIELD_NAMES})
